"""The corpus pipeline: documents to packed sequences.

Every stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet
and read again as the next stage's documents. All but the last keep the columns of
documents. A reordering by sources is a filter by design: it takes each document zero to
two times, as its source's target asks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import mixing, near_duplicates, packing, pseudonyms, quality
from aerolake.llm.common import staged, table


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of the smallest id."""
    return near_duplicates.keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with keyed pseudonyms; ``n_chars`` follows the text."""
    hidden = pseudonyms.hide_pii(docs, pseudonyms.QUERY_KEY)
    if "n_chars" not in docs.columns:
        return hidden
    kind = docs.schema["n_chars"].dataType
    return hidden.select(*[F.length("text").cast(kind).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share of the mix asks."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, neighbouring documents together."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good_documents),
    ("near_duplicates", drop_near_duplicates),
    ("pii", hide_personal_data),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# A trained classifier, signatures and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
