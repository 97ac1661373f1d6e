import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import cases
from aerolake.llm import byte_pairs
from aerolake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=byte_pairs.read_ranks(byte_pairs.RANKS))


@pytest.fixture(scope="module")
def own():
    return byte_pairs.Encoder(byte_pairs.RANKS, public_tokenizers.PATTERN)


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def contracted(ranks, word):
    """The leftmost pair of least rank, one at a time."""
    parts = [bytes([b]) for b in word]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_query_equals_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_byte_pairs"](spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, rows)


def test_awkward_rows(spark, library):
    docs = cases.documents(spark).withColumnRenamed("size", "n_tokens").withColumnRenamed("n", "ids_sha256")
    got = byte_pairs.round_trip(docs).collect()
    assert sorted(map(tuple, got), key=str) == expected(library, docs.select("doc_id", "text").collect())
    assert byte_pairs.round_trip(cases.empty(spark)).collect() == []


def test_ids_and_bytes(spark, library):
    docs = spark.createDataFrame([(1, "Grüße, 你好 \U0001f600 don't  \n\n x"), (2, None)], "doc_id long, text string")
    one, two = sorted(byte_pairs.round_trip(docs, keep=True).collect())
    assert one.ids == library.encode_ordinary("Grüße, 你好 \U0001f600 don't  \n\n x")
    assert bytes(one.decoded).decode() == "Grüße, 你好 \U0001f600 don't  \n\n x"
    assert two.ids == [] and bytes(two.decoded) == b"" and two.ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_words_merge_as_one_pair_at_a_time(own):
    rng = random.Random(3)
    alphabets = [b"ab", b"aeioust ", b"the", "éàü你".encode(), bytes(range(256)), b"0", b"-=", b"xX"]
    words = [bytes(rng.choices(rng.choice(alphabets), k=rng.randint(1, 60))) for _ in range(3000)]
    words += [b"a" * n for n in range(1, 80)] + [b"=" * 1001, b" " * 777, b"ab" * 300]
    expected_ids = [contracted(own.whole, w) for w in words]
    assert own.merge(words) == expected_ids
    assert own.merge(words, byte_pairs.MERGE_LONG) == expected_ids


def test_inverted_vocabulary():
    """A token made of parts of larger rank comes first as soon as its parts stand together."""
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {b"bc": 300, b"aa": 260, b"aabc": 259, b"abc": 290, b"xy": 258, b"xyx": 257, b"xyxy": 256}
    merges = byte_pairs.merge_table(ranks).to_pydict()
    again = dict(zip(merges["merged"], merges["again"]))
    assert not again[260] and not again[300] and not again[258] and again[256]
    own = byte_pairs.Encoder.__new__(byte_pairs.Encoder)
    import duckdb
    own.db, own.whole = duckdb.connect(), ranks
    rows = byte_pairs.merge_table(ranks)  # noqa: F841
    own.db.execute("CREATE TABLE merges AS FROM rows")
    own.byte_ids = __import__("numpy").arange(256, dtype="int32")
    rng = random.Random(5)
    words = [bytes(rng.choices(b"abcxy", k=rng.randint(1, 30))) for _ in range(2000)]
    expected_ids = [contracted(ranks, w) for w in words]
    assert own.merge(words) == expected_ids
    assert own.merge(words, byte_pairs.MERGE_LONG) == expected_ids


def test_pieces_and_forgetting(spark, library, own, monkeypatch):
    rng = random.Random(9)
    text = " ".join(cases.sentence(rng, 40) + rng.choice([".", "\n\n  ", "!!", "\t"]) for _ in range(60))
    texts = [text, "", text[::-1], None, "tail"]
    for name, value in (("LONG_TEXT", 100), ("WORDS_AT_ONCE", 57), ("MOST_WORDS", 90), ("MERGED_AT_ONCE", 7), ("LONG_WORD", 5)):
        monkeypatch.setattr(byte_pairs, name, value)
    got = [[] for _ in texts]
    for places, pieces in byte_pairs._pieces(own, texts):
        encoded = own.encode(pieces)
        decoded = own.decode([ids for ids, _ in encoded])
        words = list(own.numbers)
        for i, (ids, decimals), data, piece in zip(places, encoded, decoded, pieces):
            assert ",".join(map(str, ids)) == decimals and data == "".join(words[n] for n in piece).encode()
            got[i] += ids.tolist()
    assert got == [library.encode_ordinary(t or "") for t in texts]
