import itertools
import zlib
from collections import defaultdict

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolake.llm import packing
from aerolake.llm.hilbert import hilbert_keys


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_touch(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


@given(st.lists(st.text(alphabet=st.sampled_from("aBé́'sß1 \t\n. <|>"), max_size=30), max_size=5))
@settings(max_examples=60, deadline=None)
def test_words_in_a_row_are_the_whole_text(texts):
    texts = texts + ["<|endoftext|> a", ""]
    words = packing._tokens(packing.TOKENIZER)
    assert [x.tolist() for x in words.encode(texts)[0]] == [x.tolist() for x in words.whole(texts)]


@given(st.lists(st.integers(1, 70), max_size=30))
@settings(max_examples=60, deadline=None)
def test_packer_fills_every_sequence(sizes):
    packer = packing.Packer(5, 16)
    for row, n in enumerate(sizes):
        packer.add(row, n)
    packer.close(packing.cuts_of(packer.filled))
    seen, filled = defaultdict(int), defaultdict(int)
    for row, start, n, sequence, offset in packer.pieces:
        assert start == seen[row] and offset == filled[sequence] and n > 0
        seen[row] += n
        filled[sequence] += n
    assert dict(seen) == dict(enumerate(sizes))
    assert all(n <= 16 and n & (n - 1) == 0 for n in filled.values())


@pytest.mark.parametrize("tokens_a_task", [4_000_000, 20_000])
def test_pieces_hold_every_token_once(spark, tokens_a_task):
    docs = cases.documents(spark)
    words = packing._tokens(packing.TOKENIZER)
    want = sorted(tuple([*ids.tolist(), 1]) for ids in words.whole([r.text or "" for r in docs.collect()]))
    rows = packing.pack(docs, tokens_a_task=tokens_a_task).collect()
    whole, by_sequence = defaultdict(int), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and 0 <= r.start and r.start + r.length <= r.doc_tokens
        whole[r.doc_id, r.doc_tokens] += r.length
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, want))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0
    singles = [r for r in rows if r.length == r.doc_tokens]
    assert {tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in singles} <= set(want)


def test_query_digest(spark):
    docs = cases.documents(spark, with_null_ids=False).dropDuplicates(["doc_id"])
    words = packing._tokens(packing.TOKENIZER)
    ids = {r.doc_id: np.append(words.whole([r.text or ""])[0], 1) for r in docs.collect()}
    rows = packing.pack(docs).selectExpr("*", "crc32(ids) AS c").collect()
    assert {r.doc_id for r in rows} == set(ids)
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length].astype("<u4")
        assert zlib.crc32(part.tobytes()) == r.c and r.doc_tokens == len(ids[r.doc_id])


def test_empty_table_and_bad_length(spark):
    assert packing.pack(cases.empty(spark)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(cases.empty(spark), length=1000)
