"""Removes passages that an earlier document holds too, by run-length indexes.

1. Texts are stored in buckets of a few megabytes and cut into segments (``anchors``): a
   string of 50 bytes lies in a segment of the same representative wherever it occurs.
2. Representatives are counted over all documents; one found in a single document
   cannot hold a repeated string.
3. Each bucket sends its distinct segments with a repeated representative, once each and
   with the smallest document id that has it, to the part the representative belongs to.
   Representatives of very many documents send their 50-byte strings one by one to the
   part of the string's own hash, so no part holds all neighbours of a common passage.
4. Each part builds a run-length compressed Burrows-Wheeler index of the segments that
   can be the earlier ones and streams those that can be the later ones through it; for
   every string start the index tells the smallest document that holds the string.
5. The answers, a bit per string start, go back to the buckets, which cut the texts.

Buckets are co-located: texts are shuffled once, into the stored buckets. A bucket, a
part and an answer are bounded by bytes; how often a passage occurs adds to none of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.anchors import LEAST, segments
from aerolake.llm.buckets import by_part, in_place, store_buckets
from aerolake.llm.common import query, staged, table
from aerolake.llm.darts import mix
from aerolake.llm.run_index import NEVER, RunIndex

BUCKET_BYTES = 4_000_000
HOT_DOCS = 1000  # a representative of more documents is spread by whole strings


def _string_hashes(data: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """A hash of the ``least`` bytes from each place."""
    out = np.zeros(len(at), np.uint64)
    for k in range(0, least, 8):
        word = np.zeros(len(at), np.uint64)
        for j in range(k, min(k + 8, least)):
            word = word << np.uint64(8) | data[at + j]
        out = mix(out + word)
    return out


def _bucket_texts(docs: pd.DataFrame) -> tuple[pd.DataFrame, list[bytes], np.ndarray]:
    """A bucket's rows in stored order, their texts and their ids (a null id is the largest)."""
    docs = in_place(docs)
    ids = np.array([NEVER if pd.isna(i) else int(i) for i in docs["doc_id"]], np.int64)
    return docs, docs["data"].tolist(), ids


def _anchor_table(texts: list[bytes], least: int):
    """Segments, the distinct representatives in order, and each segment's among them."""
    text, start, starts, anchor = segments(texts, least)
    distinct, which = np.unique(anchor, return_inverse=True)
    return text, start, starts, distinct, which.ravel()


class _Plan:
    """What a bucket sends: its distinct segments by part, and where each of them stands."""

    def __init__(self, texts: list[bytes], ids: np.ndarray, marks: dict[int, bytes], parts: int, least: int):
        text, start, starts, distinct, which = _anchor_table(texts, least)
        mark = np.zeros(len(distinct), np.uint8)
        home = (distinct % np.uint64(parts)).astype(np.int64)
        for part, at in by_part(distinct, parts):
            if part in marks:
                mark[at] = np.frombuffer(marks[part], np.uint8)
        shared = np.flatnonzero(mark[which] > 0)
        text, start, starts, hot = text[shared], start[shared], starts[shared], mark[which[shared]] == 2
        route = home[which[shared]]
        if hot.any():  # single strings instead
            nth = np.arange(starts[hot].sum()) - np.repeat(np.cumsum(starts[hot]) - starts[hot], starts[hot])
            one_text = np.repeat(text[hot], starts[hot])
            one_start = np.repeat(start[hot], starts[hot]) + nth
            sizes = np.array([len(t) for t in texts], np.int64)
            data = np.frombuffer(b"".join(texts), np.uint8)
            hashes = _string_hashes(data, (np.cumsum(sizes) - sizes)[one_text] + one_start, least)
            text, start = np.append(text[~hot], one_text), np.append(start[~hot], one_start)
            route = np.append(route[~hot], (hashes % np.uint64(parts)).astype(np.int64))
            starts = np.append(starts[~hot], np.ones(len(one_text), np.int64))
        self.text, self.start, self.starts = text, start, starts
        seen: dict[bytes, int] = {}
        get = seen.setdefault
        self.which = np.fromiter(
            (get(texts[t][s:s + n + least - 1], len(seen)) for t, s, n in zip(text.tolist(), start.tolist(), starts.tolist())),
            np.int64, len(text))
        self.content = list(seen)
        first = np.full(len(seen), NEVER, np.int64)
        np.minimum.at(first, self.which, ids[text])
        self.first = first
        self.part = np.zeros(len(seen), np.int64)
        self.part[self.which] = route
        self.order = np.argsort(self.part, kind="stable")
        self.parts, at = np.unique(self.part[self.order], return_index=True)
        self.groups = np.split(self.order, at[1:]) if len(at) else []


_SENT = "part long, bucket long, data binary, sizes binary, first binary"


def removed_spans(docs: DataFrame, least: int = LEAST, bucket_bytes: int = BUCKET_BYTES,
                  hot_docs: int = HOT_DOCS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` of every row: the removed runs as
    ``(start, end)`` in bytes, and the remaining bytes in a row.

    Reads ``doc_id`` (whole numbers) and ``text``; other columns are not read. A byte of a
    text's UTF-8 form is removed if a string of ``least`` bytes that covers it also starts
    in a row with a smaller id; rows with one id remove nothing from each other. Null
    texts are empty; a null id counts as larger than all others; texts shorter than
    ``least`` are kept whole; an empty table gives an empty result.
    """
    buckets, parts = store_buckets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), bucket_bytes)

    def count(group: pd.DataFrame) -> pd.DataFrame:
        _, texts, _ = _bucket_texts(group)
        text, _, _, distinct, which = _anchor_table(texts, least)
        pairs = np.unique(which * max(len(texts), 1) + text)
        number = np.minimum(np.bincount(pairs // max(len(texts), 1), minlength=len(distinct)), 65535).astype("<u2")
        own = by_part(distinct, parts)
        return pd.DataFrame({"part": [p for p, _ in own], "bucket": int(group["bucket"].iloc[0]),
                             "anchors": [distinct[at].astype("<u8").tobytes() for _, at in own],
                             "docs": [number[at].tobytes() for _, at in own]})

    def mark(group: pd.DataFrame) -> pd.DataFrame:
        anchors = [np.frombuffer(a, "<u8") for a in group["anchors"]]
        number = np.concatenate([np.frombuffer(d, "<u2") for d in group["docs"]]).astype(np.int64)
        distinct, which = np.unique(np.concatenate(anchors), return_inverse=True)
        docs_of = np.bincount(which.ravel(), weights=number, minlength=len(distinct))
        marks = ((docs_of > 1).astype(np.uint8) + (docs_of > hot_docs))[which.ravel()].astype(np.uint8)
        cut = np.split(marks, np.cumsum([len(a) for a in anchors])[:-1])
        return pd.DataFrame({"bucket": group["bucket"], "part": group["part"], "marks": [c.tobytes() for c in cut]})

    def send(group: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        names = [f.split()[0] for f in _SENT.split(", ")]
        if not len(group) or not len(marks):
            return pd.DataFrame({c: [] for c in names}, dtype=object)
        _, texts, ids = _bucket_texts(group)
        plan = _Plan(texts, ids, dict(zip(marks["part"], marks["marks"])), parts, least)
        bucket = int(group["bucket"].iloc[0])
        return pd.DataFrame([
            (int(part), bucket, b"".join(plan.content[i] for i in own),
             np.array([len(plan.content[i]) for i in own], "<u4").tobytes(), plan.first[own].astype("<i8").tobytes())
            for part, own in zip(plan.parts, plan.groups)], columns=names)

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        seen: dict[bytes, int] = {}
        which, firsts = [], []
        for data, sizes, first in zip(group["data"], group["sizes"], group["first"]):
            ends = np.cumsum(np.frombuffer(sizes, "<u4").astype(np.int64)).tolist()
            which.append([seen.setdefault(data[a:b], len(seen)) for a, b in zip([0, *ends], ends)])
            firsts.append(np.frombuffer(first, "<i8"))
        owner = np.full(len(seen), NEVER, np.int64)
        for at, first in zip(which, firsts):
            np.minimum.at(owner, at, first)
        content = list(seen)
        del seen
        sizes = np.array([len(c) for c in content], np.int64)
        found = np.repeat(owner, sizes)
        # Of the variants of one representative, that of the smallest owner has nothing
        # earlier to find, and that of the largest nothing to give; variants of a single
        # string each differ.
        kin = np.unique(segments(content, least)[3], return_inverse=True)[1].ravel()
        low, high, longest = np.full((3, len(content)), NEVER)
        high[:], longest[:] = -NEVER, 0
        np.minimum.at(low, kin, owner)
        np.maximum.at(high, kin, owner)
        np.maximum.at(longest, kin, sizes)
        open_ = longest[kin] > least
        given, asked = np.flatnonzero(open_ & (owner < high[kin])), np.flatnonzero(open_ & (owner > low[kin]))
        if len(given) and len(asked):
            joined = lambda own: np.frombuffer(b"".join([content[i] for i in own.tolist()]), np.uint8)
            index = RunIndex(joined(given), sizes[given], owner[given], least)
            places = np.repeat(np.cumsum(sizes)[asked] - np.cumsum(sizes[asked]), sizes[asked]) + np.arange(sizes[asked].sum())
            found[places] = np.minimum(found[places], index.first_owners(joined(asked), sizes[asked]))
        begins = np.cumsum(sizes) - sizes
        out = []
        for at, first in zip(which, firsts):
            starts = sizes[at] - least + 1
            nth = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
            earlier = found[np.repeat(begins[at], starts) + nth] < np.repeat(first, starts)
            out.append(np.packbits(earlier).tobytes())
        return pd.DataFrame({"bucket": group["bucket"], "part": group["part"], "earlier": out})

    def cut(group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs, texts, ids = _bucket_texts(group)
        sizes = np.array([len(t) for t in texts], np.int64)
        begins = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        edge = np.zeros(total + 1, np.int32)
        if len(answers):
            marks = answers.dropna(subset=["marks"])
            plan = _Plan(texts, ids, dict(zip(marks["part"], marks["marks"])), parts, least)
            bits = answers.dropna(subset=["earlier"])
            bits = dict(zip(bits["part"], bits["earlier"]))
            width = np.array([len(c) - least + 1 for c in plan.content], np.int64)
            at = np.cumsum(width) - width
            earlier = np.zeros(int(width.sum()), bool)
            for part, own in zip(plan.parts, plan.groups):
                got = np.unpackbits(np.frombuffer(bits[part], np.uint8), count=int(width[own].sum())).astype(bool)
                nth = np.arange(len(got)) - np.repeat(np.cumsum(width[own]) - width[own], width[own])
                earlier[np.repeat(at[own], width[own]) + nth] = got
            starts = plan.starts
            nth = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
            # A string is gone if an earlier document has it, in this bucket or in another.
            gone = earlier[np.repeat(at[plan.which], starts) + nth] | np.repeat(
                ids[plan.text] > plan.first[plan.which], starts)
            place = (np.repeat(begins[plan.text] + plan.start, starts) + nth)[gone]
            edge[:] = np.bincount(place, minlength=total + 1) - np.bincount(place + least, minlength=total + 1)
        covered = np.cumsum(edge[:-1]) > 0
        spans, kept = [], []
        for text, a, n in zip(texts, begins.tolist(), sizes.tolist()):
            own = covered[a:a + n]
            if own.any():
                turns = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(turns[::2], turns[1::2])])
                kept.append(np.frombuffer(text, np.uint8)[~own].tobytes())
            else:
                spans.append([])
                kept.append(text)
        return pd.DataFrame({
            "doc_id": docs["doc_id"].astype("Int64").to_numpy(object, na_value=None), "n_bytes": sizes,
            "n_removed": [sum(s["end"] - s["start"] for s in span) for span in spans], "spans": spans, "kept": kept})

    by_bucket = buckets.groupBy("bucket")
    counted = by_bucket.applyInPandas(count, "part long, bucket long, anchors binary, docs binary")
    marks = staged(counted.groupBy("part").applyInPandas(mark, "bucket long, part long, marks binary")
                   .filter(F.expr("marks != cast(repeat('\\0', length(marks)) AS binary)")), "marks")
    sent = by_bucket.cogroup(marks.groupBy("bucket")).applyInPandas(send, _SENT)
    answers = sent.groupBy("part").applyInPandas(answer, "bucket long, part long, earlier binary")
    both = marks.select("bucket", "part", "marks", F.lit(None).cast("binary").alias("earlier")).unionByName(
        answers.select("bucket", "part", F.lit(None).cast("binary").alias("marks"), "earlier"))
    return by_bucket.cogroup(both.groupBy("bucket")).applyInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")


@query("op2_run_index_repeats")
def op2_run_index_repeats(spark, sf):
    return removed_spans(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
