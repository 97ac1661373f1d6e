"""Byte-level BPE encoding and decoding with recursive queries in each partition.

A task splits its texts into words and asks an embedded database for the words it has
not met before: their bytes are token-position rows, and a recursive query joins
neighbouring tokens to the merge table and contracts each word's leftmost pair of least
rank until no pair is left. The same database decodes: the tokens of a text join the
vocabulary, and an ordered aggregation puts their bytes together again. Tasks need
nothing of each other, so nothing is shuffled and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import query, table
from aerolake.llm.packing import _slices

RANKS = "byte_bpe_multi_50k.tiktoken"  # a name for public_tokenizers.path, or a path with a slash
WORDS_AT_ONCE = 250_000  # words of texts that are looked up, and decoded, together
MERGED_AT_ONCE = 20_000  # words that one recursive query gets
MOST_WORDS = 1_000_000  # different words that a worker remembers
LONG_WORD = 64  # bytes
LONG_TEXT = 1_000_000  # characters above which a text's words are taken piece by piece

# A word's leftmost pair of least rank is contracted; k is the word's number and, in the lower
# half, the place of a token's first byte. A token that was merged into its neighbour is -1.
MERGE = """
WITH RECURSIVE token(k, id) USING KEY (k) AS (
  SELECT k, id FROM start
  UNION ALL
  (WITH line AS (
     SELECT k, id, lead(id) OVER place AS next_id, lead(k) OVER place AS next_k, lag(k) OVER place AS last_k
     FROM token WHERE id >= 0 WINDOW place AS (ORDER BY k)),
   least AS (
     SELECT k >> 32 AS word, min((merged::BIGINT << 32) + (k & 4294967295)) AS pair
     FROM line JOIN merges ON l = id AND r = next_id WHERE next_k >> 32 = k >> 32 GROUP BY 1),
   chosen AS (SELECT word, (word << 32) + (pair & 4294967295) AS place, (pair >> 32)::INT AS merged FROM least)
   SELECT k, CASE WHEN k = place THEN merged WHEN last_k = place THEN -1 ELSE id END
   FROM line JOIN chosen ON word = k >> 32))
SELECT (k >> 32)::INT AS word, list(id ORDER BY k) AS ids FROM token WHERE id >= 0 GROUP BY 1 ORDER BY 1
"""

# The same for long words, which else took a step per merge: the equal pairs right of the chosen
# one (every other one of an overlapping run) are contracted with it, unless a pair with the new
# token could have a smaller rank still ("again").
MERGE_LONG = """
WITH RECURSIVE token(k, id) USING KEY (k) AS (
  SELECT k, id FROM start
  UNION ALL
  (WITH line AS (
     SELECT k, id, row_number() OVER place AS i, lead(id) OVER place AS next_id, lead(k) OVER place AS next_k
     FROM token WHERE id >= 0 WINDOW place AS (ORDER BY k)),
   pairs AS (
     SELECT k >> 32 AS word, k, next_k, i, merged, again FROM line JOIN merges ON l = id AND r = next_id
     WHERE next_k >> 32 = k >> 32),
   least AS (SELECT word, min(merged) AS best FROM pairs GROUP BY word),
   equal AS (
     SELECT pairs.*, row_number() OVER (PARTITION BY word ORDER BY k) AS nth
     FROM pairs JOIN least USING (word) WHERE merged = best),
   chosen AS (
     SELECT * FROM equal WHERE again OR nth = 1
     QUALIFY row_number() OVER (PARTITION BY word, i - nth ORDER BY k) % 2 = 1),
   changes AS (SELECT k, merged AS id FROM chosen UNION ALL SELECT next_k, -1 FROM chosen)
   SELECT line.k, coalesce(changes.id, line.id)
   FROM line LEFT JOIN changes ON changes.k = line.k WHERE line.k >> 32 IN (SELECT word FROM least)))
SELECT (k >> 32)::INT AS word, list(id ORDER BY k) AS ids FROM token WHERE id >= 0 GROUP BY 1 ORDER BY 1
"""

DECODE = """
SELECT piece, unhex(string_agg(hex, '' ORDER BY place)) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY piece ORDER BY piece
"""


def read_ranks(name: str) -> dict[bytes, int]:
    """The vocabulary file: a token's bytes in base64 and its rank on each line."""
    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    with open(name, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """``l, r, merged, again``: every way to put a token together of two others. ``again``
    holds unless a pair with the new token has a smaller rank than the token itself."""
    rows = np.array([(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items()
                     for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks], np.int32).reshape(-1, 3)
    l, r, merged = rows.T
    earlier = np.concatenate([l[merged < l], r[merged < r]])
    return pa.table({"l": l, "r": r, "merged": merged, "again": ~np.isin(merged, earlier)})


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Encoder:
    """Token ids of words, remembered, and bytes of ids, by a worker's own database."""

    def __init__(self, name: str, pattern: str):
        import duckdb
        import regex

        ranks = read_ranks(name)
        self.pattern = regex.compile(pattern)
        # What it gets at once is bounded, so it needs no files.
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        merges = merge_table(ranks)  # noqa: F841  the queries name these tables
        vocabulary = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS FROM merges")
        self.db.execute("CREATE TABLE vocabulary AS FROM vocabulary")
        self.whole = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.decimals: list[str] = []  # of each word: its ids with commas
        self.ids = np.zeros(0, np.int32)
        self.starts = self.sizes = np.zeros(0, np.int64)

    def split(self, text: str) -> Iterator[list[int]]:
        """The numbers of a text's words, of a long text some at a time."""
        if len(text) <= LONG_TEXT:
            yield list(map(self.numbers.__getitem__, self.pattern.findall(text)))
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while some := list(itertools.islice(found, WORDS_AT_ONCE)):
            yield list(map(self.numbers.__getitem__, some))

    def merge(self, words: list[bytes], merge: str = MERGE) -> list[list[int]]:
        """The ids of each word, contracted pair by pair."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        start = pa.table({"k": (np.repeat(np.arange(len(words)), sizes) << 32) + place,  # noqa: F841
                          "id": self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]})
        return [ids for _, ids in self.db.execute(merge).fetchall()]

    def learn(self) -> None:
        """Ids of the words that were numbered last. A word that is a token is that token."""
        n = len(self.numbers) - len(self.decimals)
        words = [w.encode() for w in itertools.islice(reversed(self.numbers), n)][::-1]
        found: dict[bytes, list[int]] = {w: [self.whole[w]] for w in words if w in self.whole}
        short = [w for w in words if w not in found and len(w) <= LONG_WORD]
        long = [w for w in words if w not in found and len(w) > LONG_WORD]
        for at in range(0, len(short), MERGED_AT_ONCE):
            some = short[at:at + MERGED_AT_ONCE]
            found.update(zip(some, self.merge(some)))
        found.update(zip(long, self.merge(long, MERGE_LONG)))
        ids = [found[w] for w in words]
        sizes = np.array([len(i) for i in ids], np.int64)
        self.decimals += [",".join(map(str, i)) for i in ids]
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(ids), np.int32)])

    def encode(self, pieces: list[list[int]]) -> list[tuple[np.ndarray, str]]:
        """The ids of each list of word numbers, also as decimal text with commas."""
        self.learn()
        out = []
        for piece in pieces:
            at = np.array(piece, np.int64)
            sizes = self.sizes[at]
            ends = np.cumsum(sizes)
            flat = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - self.starts[at], sizes)
            out.append((self.ids[flat], ",".join(map(self.decimals.__getitem__, piece))))
        return out

    def decode(self, pieces: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        sizes = [len(p) for p in pieces]
        flat = np.concatenate([np.zeros(0, np.int32), *pieces])
        tokens = pa.table({"piece": np.repeat(np.arange(len(pieces), dtype=np.int32), sizes),  # noqa: F841
                           "place": np.arange(len(flat)), "id": flat})
        found = self.db.execute(DECODE).fetchall()
        out = [b""] * len(pieces)
        for piece, data in found:
            out[piece] = data
        return out


_open: dict[tuple[str, str], Encoder] = {}


def encoder(name: str, pattern: str) -> Encoder:
    """The worker's encoder; opened once."""
    if (name, pattern) not in _open:
        _open[name, pattern] = Encoder(name, pattern)
    return _open[name, pattern]


def _pieces(own: Encoder, texts: list[str | None]) -> Iterator[tuple[list[int], list[list[int]]]]:
    """Lists of word numbers of the texts with the texts' places, some ``WORDS_AT_ONCE`` words
    at a time. Numbers hold until the next are taken."""
    places, pieces, n = [], [], 0
    for i, text in enumerate(texts):
        for words in own.split(text or ""):
            places.append(i)
            pieces.append(words)
            n += len(words)
            if n >= WORDS_AT_ONCE:
                yield places, pieces
                places, pieces, n = [], [], 0
                if len(own.numbers) > MOST_WORDS:
                    own.forget()
    yield places, pieces


def round_trip(docs: DataFrame, ranks: str = RANKS, pattern: str | None = None, keep: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``, and with
    ``keep`` also ``ids array<int>`` and ``decoded binary``.

    Reads ``doc_id, text``; other columns are not read. A text is split by ``pattern`` (by
    default the one that belongs to the public rank files), each word is encoded by itself
    without special tokens, and the ids are decoded again. ``ids_sha256`` is over the
    decimal ids joined by commas, ``decoded_sha256`` over the decoded bytes. A null text
    counts as empty; an empty one has no tokens and the hash of nothing. Rows may repeat and
    ids may be null: every row gives a row. An empty table gives an empty result. Words are
    never cut; a worker holds a bounded number of words, but each one wholly.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        split_by = pattern
        if split_by is None:
            import public_tokenizers

            split_by = public_tokenizers.PATTERN
        own = encoder(ranks, split_by)
        for batch in (part for whole in batches for part in _slices(whole, "text")):
            texts = batch.column("text").to_pylist()
            counts = [0] * len(texts)
            hashes = [(hashlib.sha256(), hashlib.sha256()) for _ in texts]
            kept = [([], []) for _ in texts]
            for places, pieces in _pieces(own, texts):
                encoded = own.encode(pieces)
                decoded = own.decode([ids for ids, _ in encoded])
                for i, (ids, decimals), data in zip(places, encoded, decoded):
                    if len(ids):
                        hashes[i][0].update(("," if counts[i] else "").encode() + decimals.encode())
                        hashes[i][1].update(data)
                        counts[i] += len(ids)
                        if keep:
                            kept[i][0].append(ids)
                            kept[i][1].append(data)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()),
                       pa.array([a.hexdigest() for a, _ in hashes]), pa.array([b.hexdigest() for _, b in hashes])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns += [pa.array([np.concatenate([np.zeros(0, np.int32), *ids]).tolist() for ids, _ in kept], pa.list_(pa.int32())),
                            pa.array([b"".join(data) for _, data in kept], pa.binary())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    more = ", ids array<int>, decoded binary" if keep else ""
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")


@query("op13_byte_pairs")
def op13_byte_pairs(spark, sf):
    return round_trip(table(spark, sf, "documents"))
