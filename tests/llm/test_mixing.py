import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import cases
import pytest

from aerolake.llm import common, mixing


def brute(rows):
    """(doc_id, text, source) rows to (doc_id, size, source_size, target, taken), by sorting."""
    found = []
    for doc_id, text, source in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        key = " ".join(str(x) for x in ("mix", doc_id, text) if x is not None)
        found.append((doc_id, size, source, int(hashlib.md5(key.encode()).hexdigest()[:15], 16)))
    sizes = defaultdict(int)
    for _, size, source, _ in found:
        sizes[source] += size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    budget, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        left = [s for s in names if s not in full]
        if not left or not budget:
            level = Fraction(0)
            break
        level = (budget - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in left)
        more = {s for s in left if level * weight[s] > 2 * sizes[s]}
        if not more:
            break
        full |= more
    out = []
    for s in names:
        target = min(2 * sizes[s], level * weight[s]) if s not in full else Fraction(2 * sizes[s])
        copies = target // sizes[s] if sizes[s] else 0
        rest, upto, extra = target - copies * sizes[s], 0, set()
        own = [f for f in found if f[2] == s]
        for h in sorted({f[3] for f in own}):
            n = sum(f[1] for f in own if f[3] == h)
            if 2 * upto + n < 2 * rest:
                extra.add(h)
            upto += n
        out += [(d, n, sizes[s], float(target), int(n * (copies + (h in extra)))) for d, n, _, h in own]
    return out


def canonical(rows):
    return sorted((repr(r[0]), r[1], r[2], round(r[3], 6), r[4]) for r in rows)


def test_awkward_rows_match_a_sorting_mix(spark):
    docs = cases.documents(spark)
    want = brute([(r.doc_id, r.text, r.source) for r in docs.collect()])
    got = [tuple(r) for r in mixing.mix_report(docs).collect()]
    assert canonical(got) == canonical(want)
    assert canonical(got) == canonical([tuple(r) for r in mixing.mix_report(docs.repartition(3)).collect()])


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = cases.documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    report = mixing.mix_report(docs).filter("size > 0").agg({"taken": "sum"}).first()[0]
    words = mixed.select(common.n_words(mixed["text"]).alias("w")).agg({"w": "sum"}).first()[0]
    assert words == report


def test_empty_table(spark):
    assert mixing.mix_report(cases.empty(spark)).collect() == []
    assert mixing.mix(cases.empty(spark)).collect() == []


def test_many_sources_take_the_salted_join(spark, monkeypatch):
    docs = cases.documents(spark)
    want = canonical([tuple(r) for r in mixing.mix_report(docs).collect()])
    monkeypatch.setattr(common, "SMALL_ROWS", 0)
    assert canonical([tuple(r) for r in mixing.mix_report(docs).collect()]) == want


@pytest.mark.parametrize("share", [0.5, 1.0, 2.0])
def test_targets_add_up(spark, share):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 7), ("d", 0)], "source string, source_size long")
    rows = mixing.source_targets(sizes, share=share).collect()
    assert abs(sum(r.target for r in rows) - share * 1117) < 1e-6
    assert all(r.target <= 2 * r.source_size + 1e-9 for r in rows)
