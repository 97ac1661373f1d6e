import random
import cases
import numpy as np
import pytest

from aerolake.llm import anchors, repeats
from aerolake.llm.run_index import NEVER, RunIndex


def brute(rows, least=50):
    """(doc_id, text) rows to (doc_id, n_bytes, spans, kept), string by string."""
    data = [(i, (t or "").encode()) for i, t in rows]
    order = lambda i: NEVER if i is None else i
    first = {}
    for i, t in data:
        for k in range(len(t) - least + 1):
            s = t[k:k + least]
            first[s] = min(order(i), first.get(s, NEVER))
    out = []
    for i, t in data:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - least + 1):
            if first[t[k:k + least]] < order(i):
                gone[k:k + least] = True
        turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])))
        spans = tuple(zip(turns[::2].tolist(), turns[1::2].tolist()))
        out.append((repr(i), len(t), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out)


def got_rows(df):
    rows = df.collect()
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in rows)
    return sorted((repr(r.doc_id), r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in rows)


@pytest.mark.parametrize("bucket_bytes, hot_docs", [(4_000_000, 1000), (20_000, 1000), (20_000, 1)])
def test_awkward_rows(spark, bucket_bytes, hot_docs):
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got_rows(repeats.removed_spans(docs, bucket_bytes=bucket_bytes, hot_docs=hot_docs)) == brute(rows)


def test_passages_and_periods(spark):
    rng = random.Random(5)
    passage = cases.sentence(rng, 60)
    rows = [(i, f"{cases.sentence(rng, 9)} {passage[rng.randint(0, 50):]} {cases.sentence(rng, 9)}") for i in range(30)]
    rows += [(100 + i, "ing " * n) for i, n in enumerate((5, 13, 200, 300))] + [(200, "é" * 60), (201, "é" * 61)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_rows(repeats.removed_spans(df, bucket_bytes=2000, hot_docs=10)) == brute(rows)


def test_empty_table(spark):
    assert repeats.removed_spans(cases.empty(spark)).collect() == []


def test_segments_hold_every_string_once_under_one_representative():
    rng = random.Random(6)
    texts = [bytes(rng.choice(b"ab ") for _ in range(rng.randint(0, 400))) for _ in range(20)] + [b"x" * 2000, b""]
    by = {}
    seen = set()
    for t, s, n, anchor in zip(*anchors.segments(texts)):
        assert 0 < n <= anchors.MOST_STARTS
        for k in range(s, s + n):
            assert (t, k) not in seen and k + 50 <= len(texts[t])
            seen.add((t, k))
            assert by.setdefault(texts[t][k:k + 50], anchor) == anchor
    assert len(seen) == sum(max(len(t) - 49, 0) for t in texts)


@pytest.mark.parametrize("seed", range(60))
def test_run_index_matches_a_search(seed):
    rng = random.Random(seed)
    least, letters = rng.choice([1, 2, 3, 5, 8, 13, 50]), b"abc\x00\xff"[:rng.randint(2, 5)]
    base = bytes(rng.choice(letters) for _ in range(90))
    strings = []
    for _ in range(rng.randint(1, 12)):
        at = rng.randint(0, 80)
        s = bytearray(base[at:at + rng.randint(1, 90)])
        if rng.random() < 0.5:
            s[rng.randrange(len(s))] = rng.choice(letters)
        strings.append(bytes(s))
    owner = [rng.randint(0, 5) for _ in strings]
    patterns = strings + [bytes(rng.choice(b"abcde") for _ in range(rng.randint(1, 90))) for _ in range(3)]
    want = []
    for p in patterns:
        for k in range(len(p)):
            s = p[k:k + least]
            want.append(min([o for t, o in zip(strings, owner) if s in t], default=NEVER) if len(s) == least else NEVER)
    as_arrays = lambda x: (np.frombuffer(b"".join(x), np.uint8), np.array([len(s) for s in x]))
    index = RunIndex(*as_arrays(strings), np.array(owner), least)
    assert index.first_owners(*as_arrays(patterns)).tolist() == want
    text = b"".join(strings)
    assert len(index.starts) <= len(text) + len(strings)
