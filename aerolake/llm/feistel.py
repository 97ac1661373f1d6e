"""A keyed permutation of ``0 .. n-1`` for any ``n``: a Feistel network with cycle walking."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

ROUNDS = 10


def _mask(key: bytes, tweak: bytes, turn: int, half: int, bits: int) -> int:
    size = (bits + 7) // 8
    data = b"%d:%b%d:%b%d:%x" % (len(key), key, len(tweak), tweak, turn, half)
    return int.from_bytes(hashlib.shake_256(data).digest(size), "big") & ((1 << bits) - 1)


def _network(x: int, bits: int, key: bytes, tweak: bytes, back: bool) -> int:
    """A permutation of all ``bits``-bit numbers, or its inverse."""
    low = bits // 2
    high = bits - low
    a, b = x >> low, x & ((1 << low) - 1)
    for turn in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
        if turn % 2:
            b ^= _mask(key, tweak, turn, a, low)
        else:
            a ^= _mask(key, tweak, turn, b, high)
    return a << low | b


def permute(x: int, n: int, key: bytes, tweak: bytes = b"", valid: Callable[[int], bool] | None = None,
            back: bool = False) -> int:
    """The image of ``x`` in a permutation of the valid numbers below ``n``.

    The network permutes the next power of two; its steps are repeated until they
    reach a valid number again, which keeps it a permutation. ``back`` inverts it.
    """
    bits = max(2, (n - 1).bit_length())
    while True:
        x = _network(x, bits, key, tweak, back)
        if x < n and (valid is None or valid(x)):
            return x
