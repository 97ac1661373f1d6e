import random

import cases
import numpy as np
import pytest

from aerolake.llm import darts, graphs
from aerolake.llm import near_duplicates as nd


def shingle_set(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def components_of(rows, threshold=0.8):
    """A class for each text, by comparing all texts, and all classes."""
    texts = sorted({t or "" for _, t in rows})
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    at = {t: find(i) for i, t in enumerate(texts)}
    return at, set(at.values())


def classes(rows, threshold=0.8):
    """The smallest id of each row's class."""
    at, low = components_of(rows, threshold)[0], {}
    for i, t in rows:
        key = at[t or ""]
        if i is not None:
            low[key] = min(i, low.get(key, i))
    return sorted((repr(i), repr(low.get(at[t or ""]))) for i, t in rows)


def got_classes(df):
    return sorted((repr(r.doc_id), repr(r.class_id)) for r in df.collect())


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95])
def test_agreement_is_weighted_similarity(similarity):
    rng = np.random.default_rng(3)
    sets, want = [], []
    for n in rng.integers(1, 900, 60):
        ids = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
        a = rng.integers(1, 9, n).astype(float)
        b = np.where(rng.random(n) < similarity, a, rng.integers(1, 9, n)).astype(float)
        sets += [(ids, a), (ids, b)]
        want.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    signature = darts.signatures(sets)
    found = (signature[::2] == signature[1::2]).mean(1)
    assert abs(found.mean() - np.mean(want)) < 0.015
    alone = np.concatenate([darts.signatures([s]) for s in sets[:10]])
    assert (alone == signature[:10]).all()  # does not depend on what else is in the batch


def test_weights_count_for_more_than_presence():
    ids = np.arange(1, 3, dtype=np.uint64)
    a, b = darts.signatures([(ids, np.array([8.0, 1.0])), (ids, np.array([1.0, 8.0]))], 2000)
    assert abs((a == b).mean() - 2 / 16) < 0.03
    assert (darts.signatures([(ids[:0], np.zeros(0))]) == np.uint64(2 ** 64 - 1)).all()


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = nd.near_duplicates(docs)
    assert got_classes(found) == classes(rows)
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(components_of(rows)[1])
    assert nd.near_duplicates(cases.empty(spark)).collect() == []
    assert nd.keep_one(cases.empty(spark)).collect() == []


def group(rng, n, changes):
    """A text and ``n`` copies with some words changed each."""
    base = cases.sentence(rng, 200).split()
    out = [" ".join(base)]
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(200), changes):
            words[at] = cases.sentence(rng, 1)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("bucket, tile", [(32, 512), (1, 3)])
def test_groups_lose_no_link(spark, monkeypatch, bucket, tile):
    monkeypatch.setattr(nd, "PAIR_BUCKET", bucket)
    monkeypatch.setattr(nd, "TILE", tile)
    rng = random.Random(bucket)
    # Copies of three changes are linked to their base, but mostly not to each other.
    texts = group(rng, 40, 3) + group(rng, 30, 2)[1:] + group(rng, 20, 5) + [cases.sentence(rng, 50) for _ in range(20)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_classes(nd.near_duplicates(df)) == classes(rows)


def test_components_of_a_long_chain(spark, monkeypatch):
    n = 300
    order = list(range(n))
    random.Random(4).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000), (1000, 1001)]
    found = graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
    monkeypatch.setattr(graphs, "FEW_NODES", 0)
    found = graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).collect() == []
