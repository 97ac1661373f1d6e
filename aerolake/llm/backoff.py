"""Language-model scores by stupid backoff, with count tables that cover the whole corpus.

Every bucket of documents explodes its n-grams and sends the distinct ones with their
counts to the part of their hash; a part adds the counts up and answers each bucket; the
buckets join the answers to their n-grams again and add up every document's score.
Frequent n-grams are one entry per bucket, so no part is hot.

A document is scored on the rest of the corpus: its own occurrences are subtracted from
every count.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.buckets import by_part, in_place, store_buckets
from aerolake.llm.common import query, table
from aerolake.llm.darts import MOST_WORDS, _words, mix

ORDER, ALPHA = 2, 0.4
QUERY_ORDER = 3  # of the registered query
BUCKET_BYTES = 8_000_000
RAW_BYTES = 5  # low bytes of a step between sorted hashes; they do not compress
_SENT = "part long, bucket long, n int, size int, steps binary, rest binary"
_RESULT = "doc_id {}, n_tokens long, n_top long, n_unseen long, log_score double"


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and how many each text has."""
    if len(_words) > MOST_WORDS:
        _words.clear()
    split = [t.split() for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    return np.fromiter((_words[w] for s in split for w in s), np.uint64, int(sizes.sum())), sizes


def _grams(words: np.ndarray, nth: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n up to ``order``: where an n-gram ends, and its hash. ``nth`` counts a text's words."""
    out, h = [], mix(words)
    for n in range(1, order + 1):
        ends = np.flatnonzero(nth >= n - 1)
        if n > 1:
            longer = np.zeros(len(words), np.uint64)
            longer[ends] = mix(h[ends - 1] * np.uint64(0x9E3779B97F4A7C15) + words[ends])
            h = longer
        out.append((ends, h[ends]))
    return out


def _nth(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _narrow(numbers: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs, byte by byte, compressed."""
    data = np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8)
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8)
    return zlib.compress(data[:, :width].T.tobytes(), 1)


def _wide(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(-1, size)
    out = np.zeros((size, 8), np.uint8)
    out[:, :len(planes)] = planes.T
    return out.reshape(-1).view("<u8")


def _pack(keys: np.ndarray, counts: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct keys and their counts: how many, the low bytes of the steps, and the rest."""
    steps = np.diff(keys, prepend=np.uint64(0))
    low = np.ascontiguousarray(steps, "<u8").view(np.uint8).reshape(-1, 8)[:, :RAW_BYTES]
    high = _narrow(steps >> np.uint64(8 * RAW_BYTES))
    return len(keys), low.tobytes(), len(high).to_bytes(4, "little") + high + _narrow(counts)


def _unpack(size: int, steps: bytes, rest: bytes) -> tuple[np.ndarray, np.ndarray]:
    low = np.zeros((size, 8), np.uint8)
    low[:, :RAW_BYTES] = np.frombuffer(steps, np.uint8).reshape(size, RAW_BYTES)
    cut = 4 + int.from_bytes(rest[:4], "little")
    high = _wide(rest[4:cut], size) << np.uint64(8 * RAW_BYTES)
    return np.cumsum(low.reshape(-1).view("<u8") | high, dtype=np.uint64), _wide(rest[cut:], size)


def backoff_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_tokens, n_top, n_unseen, log_score, mean_log_score``, a row per row of ``docs``.

    Reads ``doc_id, text``; other columns are not read. Words are runs of anything but
    ASCII white space. A word's score is the count of the longest n-gram (up to ``order``
    words, within the text) that ends in it and occurs in another row, over the count of
    its context, times ``alpha`` for each word the n-gram was shortened by; a word that no
    other row has counts as once in all other words and one more, one step further back.
    ``n_top`` words found their longest n-gram, ``n_unseen`` none. Null and blank texts
    have no words, score 0 and a null mean. Rows alike are scored on each other; an
    empty table gives an empty result.
    """
    stored, parts = store_buckets(docs, bucket_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def send(group: pd.DataFrame) -> pd.DataFrame:
        words, sizes = _tokens(in_place(group)["data"].tolist())
        bucket, out = int(group["bucket"].iloc[0]), []
        for n, (_, hashes) in enumerate(_grams(words, _nth(sizes), order), 1):
            grams, counts = np.unique(hashes, return_counts=True)
            # A part's hashes differ by multiples of the number of parts.
            out += [(part, bucket, n, *_pack(grams[at] // np.uint64(parts), counts[at]))
                    for part, at in by_part(grams, parts)]
        return pd.DataFrame(out, columns=["part", "bucket", "n", "size", "steps", "rest"])

    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        grams, counts = zip(*map(_unpack, group["size"], group["steps"], group["rest"]))
        distinct, which = np.unique(np.concatenate(grams), return_inverse=True)
        which = which.ravel()
        totals = np.bincount(which, weights=np.concatenate(counts), minlength=len(distinct)).astype("<u8")[which]
        cut = np.split(totals, np.cumsum([len(g) for g in grams])[:-1])
        return pd.DataFrame({"bucket": group["bucket"], "part": group["part"], "n": group["n"],
                             "totals": [_narrow(t) for t in cut]})

    sent = stored.groupBy("bucket").applyInPandas(send, _SENT)
    totals = sent.groupBy("n", "part").applyInPandas(add_up, "bucket long, part long, n int, totals binary")
    n_corpus = _corpus_size(docs)

    def score(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = in_place(group)
        words, sizes = _tokens(rows["data"].tolist())
        nth, owner = _nth(sizes), np.repeat(np.arange(len(sizes)), sizes)
        given = {(n, p): t for n, p, t in zip(answers["n"], answers["part"], answers["totals"])}
        others = []  # for each n: how often the n-gram that ends at a word occurs in other rows
        for n, (ends, hashes) in enumerate(_grams(words, nth, order), 1):
            grams, which = np.unique(hashes, return_inverse=True)
            which = which.ravel()
            whole = np.zeros(len(grams), np.int64)
            for part, at in by_part(grams, parts):
                whole[at] = _wide(given[n, part], len(at))
            _, pair, own = np.unique(owner[ends] * max(len(grams), 1) + which, return_inverse=True, return_counts=True)
            found = np.zeros(len(words), np.int64)
            found[ends] = whole[which] - own[pair.ravel()]
            others.append(found)
        rest = (n_corpus - sizes)[owner]
        full = np.minimum(nth + 1, order)  # the longest n-gram there is
        value = full * np.log(alpha) - np.log(rest + 1.0)
        used = np.zeros(len(words), np.int64)
        for n, found in enumerate(others, 1):
            hit = found > 0
            under = rest if n == 1 else np.append(0, others[n - 2][:-1])
            value[hit] = np.log(found[hit]) - np.log(under[hit]) + (full[hit] - n) * np.log(alpha)
            used[hit] = n
        count = lambda mask: np.bincount(owner[mask], minlength=len(sizes))
        return pd.DataFrame({
            "doc_id": rows["doc_id"].to_numpy(), "n_tokens": sizes, "n_top": count(used == full),
            "n_unseen": count(used == 0), "log_score": np.bincount(owner, weights=value, minlength=len(sizes))})

    scored = stored.groupBy("bucket").cogroup(totals.groupBy("bucket")).applyInPandas(score, _RESULT.format(kind))
    return scored.withColumn("mean_log_score", F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens")))


def _corpus_size(docs: DataFrame) -> int:
    from aerolake.llm.common import n_words

    return docs.agg(F.sum(n_words(F.col("text")))).first()[0] or 0


@query("op7_stupid_backoff")
def op7_stupid_backoff(spark, sf):
    return backoff_scores(table(spark, sf, "documents"), order=QUERY_ORDER)
