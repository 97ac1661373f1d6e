"""Word shingles and DartMinHash signatures of weighted sets, for many texts at once.

Every element owns a random field of darts over weight and rank, one dart per unit of
area on average, each dart aimed at one coordinate. A set is hit by the darts that lie
below its elements' weights, and its signature keeps the darts of lowest rank, one per
coordinate. Two sets agree in a coordinate with the probability of their weighted
Jaccard similarity. Ranks are thrown unit by unit until every coordinate is hit, so a
signature costs about as many darts as it has coordinates times their logarithm, or as
the set has weight, whichever is more.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
COORDINATES, ROWS = 150, 5  # 30 bands of 5: a pair of similarity 0.8 is missed once in 100,000
BANDS = COORDINATES // ROWS
MOST_WORDS = 200_000  # words whose hash a worker remembers; more, and it starts afresh

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                 0x589965CC75374CC3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Whole 64-bit hashes of 64-bit numbers."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _WordHash()


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of all runs of five words, sorted, and how often each occurs.

    A text of fewer words is one shingle of them all; a text without a word has none.
    """
    if len(_words) > MOST_WORDS:
        _words.clear()
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n, k = max(len(h) - SHINGLE + 1, 1), min(SHINGLE, len(h))
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += mix(h[i:i + n] * _ODD[i])
    return np.unique(mix(total), return_counts=True)


# Chances that a Poisson number of mean 1 is at most 0, 1, 2, ..., as 64-bit thresholds.
_CHANCES = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, n + 1)) for n in range(16)])
_POISSON = (np.minimum(_CHANCES, 1.0)[:-1] * 2.0 ** 53).astype(np.uint64) << np.uint64(11)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int = COORDINATES) -> np.ndarray:
    """The signature of each ``(elements, weights)`` as a row of ``k`` numbers; weights are
    positive. An empty set's row is all ones (the largest number)."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(sets), k), none, np.uint64)
    flat = out.ravel()
    sizes = np.array([len(e) for e, _ in sets], np.int64)
    if not sizes.sum():
        return out
    element = np.concatenate([e for e, _ in sets])
    weight = np.concatenate([w for _, w in sets]).astype(float)
    owner = np.repeat(np.arange(len(sets)), sizes)
    unit = 0
    while len(element):
        level = 0
        while True:
            # Weights from 0 to 1, 1 to 2, 2 to 4, ...: as the band grows twice as wide,
            # a unit of rank is cut into twice as many parts, so each part has one dart.
            floor, parts = (0.0, 1) if level == 0 else (2.0 ** (level - 1), 1 << (level - 1))
            deep = weight > floor
            if not deep.any():
                break
            _throw(flat, k, element[deep], weight[deep], owner[deep], unit, level, floor, parts)
            level += 1
        unit += 1
        open_ = (out == none).any(1)[owner]
        element, weight, owner = element[open_], weight[open_], owner[open_]
    return out


def _throw(flat, k, element, weight, owner, unit, level, floor, parts) -> None:
    place = np.arange(unit * parts, (unit + 1) * parts, dtype=np.uint64)
    field = mix(element[:, None] ^ mix(place * np.uint64(64) + np.uint64(level))[None, :])
    number = np.searchsorted(_POISSON, field.ravel(), side="right")
    at = np.repeat(np.arange(field.size), number)
    if not len(at):
        return
    nth = np.arange(len(at)) - np.repeat(np.cumsum(number) - number, number)
    dart = mix(field.ravel()[at] + nth.astype(np.uint64) * _A)
    row, part = at // parts, at % parts
    if level or (weight < 1).any():
        span = 1.0 if level == 0 else floor
        high = floor + span * (mix(dart ^ _B) >> np.uint64(11)).astype(float) / 2.0 ** 53
        hit = high < weight[row]
        dart, row, part = dart[hit], row[hit], part[hit]
    fall = mix(dart ^ _GOLD)
    rank = unit + (part + (fall >> np.uint64(11)).astype(float) / 2.0 ** 53) / parts
    # 40 bits of rank above 24 bits that tell darts of equal rank apart.
    code = (np.minimum(rank * 2.0 ** 24, 2.0 ** 40 - 1).astype(np.uint64) << np.uint64(24)) | (fall & np.uint64(0xFFFFFF))
    aim = owner[row] * k + (dart % np.uint64(k)).astype(np.int64)
    np.minimum.at(flat, aim, code)


def band_hashes(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A hash per band of each signature row; bands of different places never share one."""
    n, k = signature.shape
    cut = signature.reshape(n, k // rows, rows)
    total = np.broadcast_to(np.arange(k // rows, dtype=np.uint64)[None, :], cut.shape[:2]).copy()
    for i in range(rows):
        total = mix(total * _ODD[0] + cut[:, :, i])
    return total.view(np.int64)


def short_code(signature: np.ndarray) -> np.ndarray:
    """16 bits of each coordinate, enough to estimate a similarity."""
    return (mix(signature) >> np.uint64(48)).astype("<u2")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact Jaccard similarity of two sorted sets; two empty sets are equal."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)
