"""A run-length compressed Burrows-Wheeler index of byte strings, with matching statistics.

The index keeps the runs of the transform, the text positions of each run's first and
last row, and the strings themselves to compare with. Patterns are streamed right to
left, all at once: a row whose run has the wanted byte is mapped back within the run;
any other row jumps to the nearest run of that byte above or below, whichever sampled
end agrees longer with the current match. So each position of a pattern gets the length
of its longest match, here up to ``least`` bytes, and a place where it occurs.
"""

from __future__ import annotations

import numpy as np

NEVER = np.iinfo(np.int64).max


class RunIndex:
    def __init__(self, data: np.ndarray, sizes: np.ndarray, owner: np.ndarray, least: int):
        """``data`` holds the strings one after the other, ``sizes`` their lengths and ``owner``
        the number of the document each belongs to."""
        self.least = least
        m, n = len(sizes), len(data) + len(sizes)
        string = np.repeat(np.arange(m), sizes + 1)
        end = np.repeat(np.cumsum(sizes + 1) - 1, sizes + 1)  # the separator that closes the string
        left = end - np.arange(n)
        text = np.zeros(n, np.int16)
        text[left > 0] = data.astype(np.int16) + 1
        rank, self.first_at = self._sorted(text, string, left, owner)
        rows = np.empty(n, np.int64)  # the suffix array, dropped once the runs are cut
        rows[rank] = np.arange(n)
        last = text[rows - 1]
        starts = np.concatenate([[0], np.flatnonzero(last[1:] != last[:-1]) + 1])
        ends = np.append(starts[1:], n) - 1
        self.text = np.concatenate([text, np.zeros(least, np.int16)])
        self.starts, self.ends, self.heads = starts, ends, last[starts].astype(np.int64)
        self.run_of = np.repeat(np.arange(len(starts), dtype=np.int32), ends - starts + 1)  # saves searches
        self.place_first, self.place_last = rows[starts], rows[ends]
        # Where the first row of each run is mapped: by byte, then by order of rows.
        by = np.argsort(self.heads, kind="stable")
        lengths = (ends - starts + 1)[by]
        self.base = np.empty(len(starts), np.int64)
        self.base[by] = np.cumsum(lengths) - lengths
        self.by_byte = self.heads[by] * len(starts) + by

    def _sorted(self, text, string, left, owner):
        """Ranks of all suffixes, and for each text position the smallest owner of its first
        ``least`` bytes. Suffixes end at their separator, and separators rank by string."""
        # The first key holds as many bytes as fit into 62 bits, numbered among those that occur.
        used = np.bincount(text, minlength=257) > 0
        used[0] = True
        number = (np.cumsum(used) - 1).astype(np.int64)
        bits = max(1, int(number[-1]).bit_length())
        n, h = len(text), min(62 // bits, self.least)
        places = np.arange(n)
        key = np.zeros(n, np.int64)
        padded = np.concatenate([number[text], np.zeros(h, np.int64)])
        for k in range(h):
            key <<= bits
            key |= np.where(left > k, padded[k:k + n], 0)
        order = np.argsort(key)
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(np.append(True, key[order][1:] != key[order][:-1]), places, 0))
        first_at = None
        tied = places
        while True:
            if first_at is None and 2 * h > self.least:
                first_at = self._first_owner(rank, left, string, owner, h)
            size = np.bincount(rank[tied], minlength=n)
            tied = tied[size[rank[tied]] > 1]
            if not len(tied):
                break
            second = np.where(left[tied] > h, n + rank[np.minimum(tied + h, n - 1)], string[tied])
            order = np.argsort(rank[tied] * (2 * n) + second)
            a, b = rank[tied][order], second[order]
            new_a = np.append(True, a[1:] != a[:-1])
            new_b = new_a | np.append(True, b[1:] != b[:-1])
            at = np.arange(len(a))
            rank[tied[order]] = (a + np.maximum.accumulate(np.where(new_b, at, 0))
                                 - np.maximum.accumulate(np.where(new_a, at, 0)))
            h *= 2
        if first_at is None:
            first_at = self._first_owner(rank, left, string, owner, None)
        return rank, first_at

    def _first_owner(self, rank, left, string, owner, h):
        out = np.full(len(rank), NEVER, np.int64)
        at = np.flatnonzero(left >= self.least)
        if not len(at):
            return out
        if h is None:  # all ranks differ already, so does every string of this length
            out[at] = owner[string[at]]
            return out
        # The first h bytes and the last h bytes of a string tell it whole.
        a, b = rank[at], rank[at + self.least - h]
        order = np.argsort(a * len(rank) + b)
        new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
        group = np.flatnonzero(new)
        low = np.minimum.reduceat(owner[string[at]][order], group)
        out[at[order]] = np.repeat(low, np.diff(np.append(group, len(at))))
        return out

    def _agreement(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How many bytes from ``p`` and from ``q`` agree, up to ``least``."""
        out = np.zeros(len(p), np.int64)
        alive = np.arange(len(p))
        for k in range(self.least):
            alive = alive[self.text[p[alive] + k] == self.text[q[alive] + k]]
            if not len(alive):
                break
            out[alive] += 1
        return out

    def first_owners(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each byte of the patterns: the smallest owner of the ``least`` bytes that start
        there, ``NEVER`` if the index does not hold them or the pattern ends before."""
        out = np.full(len(data), NEVER, np.int64)
        order = np.argsort(-sizes, kind="stable")
        long, at = sizes[order], (np.cumsum(sizes) - 1)[order]
        lanes = len(order)
        row = np.zeros(lanes, np.int64)
        place = np.full(lanes, self.place_first[0] if len(self.starts) else 0)
        match = np.zeros(lanes, np.int64)
        runs = len(self.starts)
        for step in range(int(long[0]) if lanes else 0):
            lanes = int(np.searchsorted(-long, -step, side="left"))
            row, place, match = row[:lanes], place[:lanes], match[:lanes]
            i = at[:lanes] - step
            byte = data[i].astype(np.int64) + 1
            run = self.run_of[row]
            off = np.flatnonzero(self.heads[run] != byte)
            lost = off[:0]
            if len(off):
                slot = np.searchsorted(self.by_byte, byte[off] * runs + run[off])
                below = self.by_byte[np.minimum(slot, runs - 1)]
                above = self.by_byte[np.maximum(slot - 1, 0)]
                has_below = (slot < runs) & (below // runs == byte[off])
                has_above = (slot > 0) & (above // runs == byte[off])
                below, above = below % runs, above % runs
                agree_below = np.where(has_below, self._agreement(place[off], self.place_first[below]), -1)
                agree_above = np.where(has_above, self._agreement(place[off], self.place_last[above]), -1)
                down = agree_below >= agree_above
                run[off] = np.where(down, below, above)
                row[off] = np.where(down, self.starts[below], self.ends[above])
                place[off] = np.where(down, self.place_first[below], self.place_last[above])
                match[off] = np.minimum(match[off], np.maximum(agree_below, agree_above))
                lost = off[~has_below & ~has_above]
            row = self.base[run] + row - self.starts[run]
            place = place - 1
            match = match + 1
            if len(lost):  # the byte is nowhere in the index
                row[lost], place[lost], match[lost] = 0, self.place_first[0], 0
            full = np.flatnonzero(match >= self.least)
            out[i[full]] = self.first_at[place[full]]
        return out
