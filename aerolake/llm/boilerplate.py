"""Quality rules by line labelling: Viterbi decoding marks content and boilerplate lines.

The field is fitted on a bounded sample of labelled documents. A line of a good
document is content; a line of a bad one starts as boilerplate, and after each fit
the lines of bad documents get the labels that the field decodes for them, so that
clean lines in bad documents do not teach it. A document is kept when its share of
content, by line length, is large enough.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm import crf
from aerolake.llm.common import query, table
from aerolake.llm.lines import line_table, text_counts
from aerolake.llm.quality import sample_lines

ROUNDS = 3
CONTENT_SHARE = 0.5
# Fixed values of the contract.
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_lines long, content_share double")


def fit_boilerplate(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> crf.Chain:
    """The field after ``rounds`` fits; without any usable label every line is boilerplate."""
    features, lengths, given = sample_lines(docs, labels)
    now, chain = given, crf.fit(features, lengths, given)
    for _ in range(rounds - 1):
        found = crf.viterbi(chain, chain.scores(features), crf.Layout(lengths))
        now, before = np.where(given == 1, 1, found), now
        if (now == before).all():
            break
        chain = crf.fit(features, lengths, now)
    return chain


def line_rules(docs: DataFrame, chain: crf.Chain, least_share: float = CONTENT_SHARE) -> DataFrame:
    """The counts, ``n_lines``, ``content_share``, ``base_failed`` and ``kept`` for every row of ``docs``.

    Reads ``doc_id, text``; other columns are not read. A null or blank text has no
    words and fails the base rules; its share is 0. Repeated rows are judged alike;
    an empty table gives an empty result.
    """

    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        tables = [line_table(text) for text in texts]
        lengths = np.array([len(w) for _, w in tables], int)
        share = np.zeros(len(tables))
        if lengths.sum():
            scores = chain.scores(np.concatenate([x for x, _ in tables]))
            marks = crf.viterbi(chain, scores, crf.Layout(lengths))
            for i, part in enumerate(np.split(marks, np.cumsum(lengths)[:-1])):
                if lengths[i]:
                    share[i] = np.average(part, weights=tables[i][1])
        counts = np.array([text_counts(text) for text in texts], np.int64).reshape(-1, 5)
        names = [field.split()[0] for field in RESULT.split(", ")]
        return pd.DataFrame(dict(zip(names, [*counts.T, lengths, share])))

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (docs.select("doc_id", judge(F.col("text")).alias("r")).select("doc_id", "r.*")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= least_share)))


@query("op9_line_rules")
def op9_line_rules(spark, sf):
    docs = table(spark, sf, "documents")
    return line_rules(docs, fit_boilerplate(docs, table(spark, sf, "labels")))
