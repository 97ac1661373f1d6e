"""Packing along a space-filling curve.

Documents are tokenised once; the words' hashed count vector is projected to a few
dimensions and placed on a Hilbert curve. The stored token ids are range-sorted by that
key, and each range is cut into sequences in curve order, so a sequence holds documents
of like wording. The end of a range is cut into sequences of a power of two tokens,
which need no padding, so nothing is padded at all.
"""

from __future__ import annotations

import itertools
import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import query, staged, table
from aerolake.llm.hilbert import hilbert_keys

LENGTH = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"  # a name for public_tokenizers.path, or a path with a slash
DIMENSIONS, KEY_BITS = 4, 15
BUCKETS = 1 << 14  # hashed word vector
SPREAD = 6.0  # stretches the mean projection before it is cut into cells
TOKENS_A_TASK = 4_000_000
MOST_WORDS = 500_000  # words that a worker remembers

_open: dict[str, "WordTokens"] = {}
_JOINED = 200  # words that one call of the tokenizer gets


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


class WordTokens:
    """Token ids and projected vectors of words, remembered.

    The tokenizer never joins across white space, so a text's ids are its words' ids in
    a row; texts that spell a special token are left to the tokenizer as a whole. When
    too many words are remembered, those seen least go.
    """

    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if "/" not in name:
            import public_tokenizers

            name = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(name)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.axes = np.random.default_rng(17).standard_normal((BUCKETS, DIMENSIONS))
        upper, lower = self.whole(["Aa BCD", "aa bcd"])
        self.folds = upper.tolist() == lower.tolist()
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if mark:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self.at = _Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.starts = self.sizes = self.seen = np.zeros(0, np.int64)
        self.places = np.zeros((0, DIMENSIONS))

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]) -> None:
        """Tokens and places of words that were numbered last."""
        sizes = np.zeros(len(words), np.int64)
        plain = np.array([w.isalpha() for w in words], bool)
        found: list[np.ndarray] = []
        for rows, split in ((np.flatnonzero(plain), self.by_ends), (np.flatnonzero(~plain), self.by_offsets)):
            for at in range(0, len(rows), _JOINED):
                part = rows[at:at + _JOINED]
                ids, sizes[part] = split([words[i].decode() for i in part.tolist()])
                found.append(ids)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        starts = np.zeros(len(words), np.int64)
        starts[order] = len(self.ids) + np.cumsum(sizes[order]) - sizes[order]
        self.starts = np.concatenate([self.starts, starts])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *found])
        buckets = [xxhash.xxh32_intdigest(w) % BUCKETS for w in words]
        self.places = np.concatenate([self.places, self.axes[buckets]])
        self.seen = np.concatenate([self.seen, np.zeros(len(words), np.int64)])

    def by_offsets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words joined by blanks, and how many are whose."""
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        owner = np.searchsorted(begins, [a for a, _ in found.offsets], side="right") - 1
        return np.array(found.ids, np.uint32), np.bincount(owner, minlength=len(texts))

    def by_ends(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only, by the mark of their last token; offsets take time."""
        if self.ends is None:
            return self.by_offsets(texts)
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(texts) or last[-1] != len(ids) - 1:
            return self.by_offsets(texts)
        return ids, np.diff(last, prepend=-1)

    def trim(self) -> None:
        keep = np.sort(np.argsort(-self.seen, kind="stable")[:MOST_WORDS // 2])
        keep = keep[self.seen[keep] > 1]
        words = list(self.at)
        self.at = _Numbers(zip([words[i] for i in keep.tolist()], range(len(keep))))
        self.ids = self.ids[_runs(self.starts[keep], self.sizes[keep])]
        self.sizes = self.sizes[keep]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.places, self.seen = self.places[keep], self.seen[keep] // 2

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Token ids and Hilbert keys of the texts."""
        if len(self.at) > MOST_WORDS:
            self.trim()
        known, rows = len(self.at), []
        for text in texts:
            data = text.encode()
            words = (data.lower() if self.folds else data).split()
            rows.append(np.fromiter(map(self.at.__getitem__, words), np.int64, len(words)))
        if len(self.at) > known:
            self.learn(list(itertools.islice(self.at, known, None)))
        lengths = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.seen += np.bincount(flat, minlength=len(self.seen))
        ids = self.ids[_runs(self.starts[flat], self.sizes[flat])]
        upto = np.append(0, np.cumsum(self.sizes[flat]))[np.append(0, np.cumsum(lengths))]
        out = [ids[a:b] for a, b in zip(upto, upto[1:])]
        middle = np.zeros((len(rows), DIMENSIONS))
        some = np.flatnonzero(lengths)
        if len(some):
            begins = (np.cumsum(lengths) - lengths)[some]
            middle[some] = np.add.reduceat(self.places[flat], begins) / lengths[some, None]
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = self.whole([text])[0]
        cells = np.minimum((1 / (1 + np.exp(-SPREAD * middle)) * (1 << KEY_BITS)).astype(np.int64), (1 << KEY_BITS) - 1)
        return out, hilbert_keys(cells, KEY_BITS)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of all runs in a row."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _tokens(name: str) -> WordTokens:
    if name not in _open:
        _open[name] = WordTokens(name)
    return _open[name]


# Rows of a batch that are encoded together; bounds what a worker holds.
_AT_ONCE_BYTES = 2_000_000


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    start = size = 0
    for i, value in enumerate(batch.column(column)):
        size += value.as_buffer().size if value.is_valid else 0
        if size >= _AT_ONCE_BYTES:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < len(batch):
        yield batch.slice(start)


def tokenised(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """``doc_id, key, n_tokens, ids`` of every row: its Hilbert key and its token ids with the
    end id, as little-endian unsigned 32-bit numbers if the vocabulary needs them, else 16-bit."""

    def encode(batches):
        words = _tokens(tokenizer)
        kind = "<u2" if words.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        end = np.array([end_id], kind).tobytes()
        for whole in batches:
            for batch in _slices(whole, "text"):
                ids, keys = words.encode([t or "" for t in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), pa.array(keys, pa.int64()),
                    pa.array([len(x) + 1 for x in ids], pa.int64()),
                    pa.array([x.astype(kind).tobytes() + end for x in ids], pa.binary()),
                ], names=["doc_id", "key", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, key long, n_tokens long, ids binary")


def cuts_of(rest: int) -> list[int]:
    """The sizes, powers of two and largest first, that add up to ``rest``."""
    return [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Packer:
    """Cuts a stream of documents into sequences; ``pieces`` holds what is settled."""

    def __init__(self, first_sequence: int, length: int):
        self.sequence, self.length, self.filled = first_sequence, length, 0
        self.pieces: list[tuple] = []  # document row, start, length, sequence, offset
        self.open: list[list[int]] = []  # of the sequence that is not full yet

    def add(self, row, n: int) -> None:
        start = 0
        while start < n:
            size = min(n - start, self.length - self.filled)
            self.open.append([row, start, size])
            self.filled, start = self.filled + size, start + size
            if self.filled == self.length:
                self.close([self.length])

    def close(self, sizes: list[int]) -> None:
        """Settle the open pieces as sequences of ``sizes`` tokens, which they fill exactly."""
        queue = list(reversed(self.open))
        for size in sizes:
            offset = 0
            while offset < size:
                row, start, n = queue.pop()
                part = min(n, size - offset)
                self.pieces.append((row, start, part, self.sequence, offset))
                offset += part
                if part < n:
                    queue.append([row, start + part, n - part])
            self.sequence += 1
        self.open, self.filled = [], 0


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, end_id: int = END_ID,
         tokens_a_task: int = TOKENS_A_TASK) -> DataFrame:
    """All documents packed: a row per piece, ``doc_id, start, length, doc_tokens, sequence_id,
    offset, ids`` (the piece's ids as little-endian unsigned 32-bit numbers).

    Reads ``doc_id, text``; other columns are not read. A null or empty text is the end
    id alone; each of several rows with one id is packed for itself; ties on the curve are
    broken by id, and rows alike spread over ranges by their stored place; an empty
    table gives an empty result. ``length`` must be a power of two.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    stored = staged(tokenised(docs, tokenizer, end_id).withColumn("place", F.monotonically_increasing_id()), "packing")
    total = stored.agg(F.sum("n_tokens")).first()[0] or 0
    keys = ("key", "spread", "place")
    ranged = (stored.withColumn("spread", F.xxhash64("doc_id"))
              .repartitionByRange(max(1, math.ceil(total / tokens_a_task)), *keys)
              .sortWithinPartitions(*keys).select("doc_id", "n_tokens", "ids"))
    schema = docs.select("doc_id").schema
    doc_type = schema["doc_id"].dataType.simpleString()

    def cut(batches):
        packer = Packer(TaskContext.get().partitionId() << 32, length)
        held: dict[int, tuple] = {}  # documents with unsettled pieces
        row = 0

        def settled(arrow_type) -> pa.RecordBatch:
            pieces, packer.pieces = packer.pieces, []
            used = [held[p[0]] for p in pieces]
            return pa.RecordBatch.from_arrays([
                pa.array([u[0] for u in used], arrow_type),
                *[pa.array([p[k] for p in pieces], pa.int64()) for k in (1, 2)],
                pa.array([len(u[1]) for u in used], pa.int64()),
                *[pa.array([p[k] for p in pieces], pa.int64()) for k in (3, 4)],
                pa.array([u[1][p[1]:p[1] + p[2]].astype("<u4").tobytes() for u, p in zip(used, pieces)], pa.binary()),
            ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        arrow_type = pa.null()
        for whole in batches:
            arrow_type = whole.schema.field("doc_id").type
            for batch in _slices(whole, "ids"):
                ids, sizes = batch.column("ids").to_pylist(), batch.column("n_tokens").to_pylist()
                for doc_id, data, n in zip(batch.column("doc_id").to_pylist(), ids, sizes):
                    held[row] = (doc_id, np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4"))
                    packer.add(row, n)
                    row += 1
                if packer.pieces:
                    yield settled(arrow_type)
                left = {p[0] for p in packer.open}
                held = {k: v for k, v in held.items() if k in left}
        packer.close(cuts_of(packer.filled))
        if packer.pieces:
            yield settled(arrow_type)

    return ranged.mapInArrow(cut, f"doc_id {doc_type}, start long, length long, doc_tokens long, "
                                  "sequence_id long, offset long, ids binary")


@query("op1_hilbert_packing")
def op1_hilbert_packing(spark, sf):
    return pack(table(spark, sf, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
