"""Quality classifier: a linear-chain conditional random field over a text's lines.

The field is fitted on the lines of a bounded sample of labelled documents, every line
bearing its document's label; its features are the line's own look and that of its
neighbours. A document's score is the mean of its lines' forward-backward marginals of
the good label, weighted by line length.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm import crf
from aerolake.llm.common import query, table
from aerolake.llm.lines import N_FEATURES, line_table

SAMPLE_DOCS = 3000  # labelled documents that the field is fitted on, at most
SAMPLE_LINES = 150  # neighbouring lines that each of them gives to the fit, at most; scores use all lines
CUT = 0.3
FOLDS = 5


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the folds; fold 0 is held out. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)).cast("int")


def window(features: np.ndarray, text: str | None, most: int) -> np.ndarray:
    """The rows of ``features``, or at most ``most`` neighbouring ones that a hash of the whole text
    picks: every line is as likely to be among them, the first and the last too."""
    if len(features) <= most:
        return features
    at = xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass")) % (len(features) + most - 1)
    return features[max(0, at - most + 1):at + 1]


def sample_lines(docs: DataFrame, labels: DataFrame, label: str = "quality", keep: Column | None = None,
                 most_docs: int = SAMPLE_DOCS, most_lines: int = SAMPLE_LINES):
    """``(features, lengths, labels)`` of the lines of at most ``most_docs`` labelled documents, of
    a longer one ``most_lines`` neighbouring lines from anywhere in it.

    The labelled ids of smallest hash are taken, so the sample is the same in every
    run. Rows with a null id or label count for nothing; of several labels of one id
    the largest counts, of several documents with one id the text that sorts first.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if keep is not None:
        rows = rows.filter(keep)
    ids = (rows.groupBy("doc_id").agg(F.max("label").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs))
    texts = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
             .groupBy("doc_id", "label").agg(F.min("text").alias("text")))

    def parts(batches):
        for batch in batches:
            found = [(window(line_table(text)[0], text, most_lines), y) for text, y in zip(batch["text"], batch["label"])]
            yield pd.DataFrame({
                "label": [y for _, y in found], "n": [len(x) for x, _ in found],
                "x": [x.astype("<f4").tobytes() for x, _ in found]})

    rows = texts.mapInPandas(parts, "label int, n int, x binary").toPandas()
    rows = rows[rows["n"] > 0].sort_values(["label", "n", "x"])
    if not len(rows):
        return np.zeros((0, N_FEATURES)), np.zeros(0, int), np.zeros(0, int)
    features = np.frombuffer(b"".join(rows["x"]), "<f4").reshape(-1, N_FEATURES).astype(float)
    lengths = rows["n"].to_numpy()
    return features, lengths, np.repeat(rows["label"].to_numpy(), lengths)


def fit_quality(docs: DataFrame, labels: DataFrame) -> crf.Chain:
    """The field, fitted on labelled documents outside the held-out fold only.

    Without any usable label all lines score one half.
    """
    return crf.fit(*sample_lines(docs, labels, keep=fold_of(F.col("doc_id")) != 0))


def scorer(chain: crf.Chain) -> Callable[[Column], Column]:
    """A column function from whole texts to scores from 0 to 1; a text without a word scores 0."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        tables = [line_table(text) for text in texts]
        lengths = np.array([len(w) for _, w in tables], int)
        out = np.zeros(len(tables))
        if lengths.sum():
            rows = chain.scores(np.concatenate([x for x, _ in tables]))
            good = crf.marginals(chain, rows, crf.Layout(lengths))[0][:, 1]
            for i, part in enumerate(np.split(good, np.cumsum(lengths)[:-1])):
                if lengths[i]:
                    out[i] = min(max(np.average(part, weights=tables[i][1]), 0.0), 1.0)
        return pd.Series(out)

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Reads ``doc_id, text`` of ``docs`` and ``doc_id, quality`` of ``labels``; other columns are
    not read. Null and blank texts score 0; repeated rows score alike; an empty table
    gives an empty result.
    """
    score = scorer(fit_quality(docs, labels))
    return docs.select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), score(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    score = scorer(fit_quality(docs, labels))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"), score(F.col("text")).alias("score"))
    return rows.filter(F.col("score") >= cut).select("doc.*")


@query("op5_line_crf_quality")
def op5_line_crf_quality(spark, sf):
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
