import math
from collections import Counter

import cases
import numpy as np
import pytest

from aerolake.llm import backoff
from aerolake.llm.common import QUERIES


def brute(rows, order, alpha=0.4):
    split = [(t or "").encode().split() for _, t in rows]
    own = [Counter(tuple(w[k - n + 1:k + 1]) for n in range(1, order + 1) for k in range(n - 1, len(w))) for w in split]
    total = sum(own, Counter())
    size, out = sum(map(len, split)), []
    for (i, _), w, c in zip(rows, split, own):
        score, top, unseen, rest = 0.0, 0, 0, size - len(w)
        for k in range(len(w)):
            full = min(k + 1, order)
            for n in range(full, 0, -1):
                gram = tuple(w[k - n + 1:k + 1])
                found = total[gram] - c[gram]
                if found:
                    under = rest if n == 1 else total[gram[:-1]] - c[gram[:-1]]
                    score += math.log(found / under) + (full - n) * math.log(alpha)
                    top += n == full
                    break
            else:
                unseen += 1
                score += full * math.log(alpha) - math.log(rest + 1)
        out.append((repr(i), len(w), top, unseen, round(score, 4)))
    return sorted(out)


@pytest.mark.parametrize("order, bucket_bytes", [(2, 8_000_000), (3, 20_000), (1, 20_000)])
def test_matches_counting(spark, order, bucket_bytes):
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = backoff.backoff_scores(docs, order=order, bucket_bytes=bucket_bytes).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.n_top, r.n_unseen, round(r.log_score, 4)) for r in got) == brute(rows, order)
    for r in got:
        assert (r.mean_log_score is None) == (r.n_tokens == 0)


def test_empty_table_and_a_single_row(spark):
    assert backoff.backoff_scores(cases.empty(spark)).collect() == []
    one = spark.createDataFrame([(1, "a b a")], "doc_id long, text string")
    assert [(r.n_tokens, r.n_unseen) for r in backoff.backoff_scores(one).collect()] == [(3, 3)]


def test_more_buckets_than_a_table_may_have(spark):
    rows = [(i, f"a b c {i % 3} d e {i % 5}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        got = backoff.backoff_scores(df, bucket_bytes=50).collect()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
    assert sorted((repr(r.doc_id), r.n_tokens, r.n_top, r.n_unseen, round(r.log_score, 4)) for r in got) == brute(rows, 2)


def test_the_query_backs_off_from_trigrams(spark, tmp_path):
    rows = [(i, f"a b c {i % 3} d e {i % 5}") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op7_stupid_backoff"](spark, str(tmp_path)).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.n_top, r.n_unseen, round(r.log_score, 4)) for r in got) == brute(rows, 3)


@pytest.mark.parametrize("keys", [[0], [2**64 - 1], [0, 1, 2**40, 2**63, 2**64 - 1], list(range(5, 5000, 7))])
def test_packed_counts_come_back(keys):
    keys = np.array(keys, np.uint64)
    counts = np.arange(1, len(keys) + 1) * 300_000_000
    got = backoff._unpack(*backoff._pack(keys, counts))
    assert got[0].tolist() == keys.tolist() and got[1].tolist() == counts.tolist()
