"""Cuts texts into segments that every copy of a passage shares.

A string of ``LEAST`` bytes is represented by the smallest hash of the ``GRAM``-byte
strings in it. Neighbouring strings with the same representative form a segment, so
wherever a string occurs, in whatever document, it lies in a segment of the same
representative. Equal strings can thus be found by bringing equal representatives together.
"""

from __future__ import annotations

import numpy as np

from aerolake.llm.darts import mix

LEAST, GRAM = 50, 24
MOST_STARTS = 256  # string starts in a segment; longer runs (periodic text) are cut


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram``-byte string (a multiple of 8)."""
    n = len(data) - gram + 1
    total = np.zeros(n, np.uint64)
    for at in range(0, gram, 8):
        words = np.empty(n, np.uint64)
        for phase in range(8):
            part = data[at + phase:at + phase + (n - phase + 7) // 8 * 8]
            whole = part[:len(part) // 8 * 8].view("<u8") if len(part) >= 8 else np.zeros(0, np.uint64)
            words[phase::8][:len(whole)] = whole
        total = mix(total + words)
    return total


def segments(texts: list[bytes], least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``(text, start, starts, anchor)`` of all segments: the text's number, the first string
    start in it, how many strings start in the segment, and their representative."""
    sizes = np.array([len(t) for t in texts], np.int64)
    empty = np.zeros(0, np.int64)
    if not len(sizes) or sizes.max() < least:
        return empty, empty, empty, np.zeros(0, np.uint64)
    data = np.frombuffer(b"".join(texts) + bytes(8 + gram), np.uint8)
    total = int(sizes.sum())
    low = _gram_hashes(data[:total + 8 + gram], gram)[:total]
    # Smallest over a window of least - gram + 1 grams, by doubling.
    width = least - gram + 1
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - least + 1, 0))
    fits = np.maximum(sizes - least + 1, 0)
    at = np.arange(len(owner)) + np.repeat(begins - (np.cumsum(fits) - fits), fits)
    low = low[at]
    turn = np.flatnonzero((low[1:] != low[:-1]) | (owner[1:] != owner[:-1])) + 1
    first = np.concatenate([[0], turn])
    long = np.diff(np.append(first, len(low)))
    if long.max() > MOST_STARTS:
        cuts = -(-long // MOST_STARTS)
        nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        first = np.repeat(first, cuts) + nth * MOST_STARTS
        long = np.diff(np.append(first, len(low)))
    text = owner[first]
    return text, at[first] - begins[text], long, low[first]
