import hashlib
import zlib
from collections import defaultdict

import pytest

import cases
from aerolake.llm import merkle
from aerolake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return h(*[enc(row.get(c)) for c in ("doc_id", "source", "lang", "n_chars")], enc(text))


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 16 * 16
        out.append((level[start:i], level[i + 1:start + 16]))
        i //= 16
    return out


def brute(rows):
    by = defaultdict(list)
    for row in rows:
        by[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row, row["text"]), row))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, (_, _, leaf, row) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            steps = way(trees[s], i) + way(top, at)
            told = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
            back = leaf_of(row, lowered(row["text"])) if told else leaf
            for left, right in steps:
                back = h(*left, back, *right)
            root = top[-1][0]
            out.append((row["doc_id"], leaf, trees[s][-1][0], root, h(*[x for a, b in steps for x in a + b]), back, back == root))
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.collect()), key=str)


def test_awkward_rows(spark):
    docs = cases.documents(spark).withColumnRenamed("size", "leaf").withColumnRenamed("n", "idx").withColumnRenamed("row", "tree")
    rows = [r.asDict() for r in docs.collect()]
    assert result(merkle.manifest(docs)) == brute(rows)
    assert merkle.manifest(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("n", [1, 16, 17])
def test_small_tables(spark, n):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    assert result(merkle.manifest(docs)) == brute([r.asDict() for r in docs.collect()])


def test_hot_source_and_many_sources(spark, monkeypatch):
    """Deep trees, copies of far ancestors for few neighbours, more sources than one run holds."""
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 291}" if i % 7 else None, "en", i, "Ä b C" * (i % 4)) for i in range(15000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(7)
    assert result(merkle.manifest(docs)) == brute([r.asDict() for r in docs.collect()])


def test_query_notices_tampering(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = result(QUERIES["op11_merkle_proofs"](spark, SF))
    assert got == brute(rows)
    changed = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] != lowered(r["text"])}
    assert {r[0] for r in got if not r[-1]} == changed
