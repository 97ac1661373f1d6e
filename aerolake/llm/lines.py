"""What a text and its lines look like: exact counts of a text, feature vectors of its lines."""

from __future__ import annotations

from collections import Counter

import numpy as np

# Fixed values.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\r\x0b\x0c"
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_STOPS = b".!?"
_MARKS = b"!?;:=_~^+/\\@[]{}()\"'"

N_OWN = 18  # features of a line by itself
N_FEATURES = 3 * N_OWN + 2  # own, line before, line after; first line, last line


def line_table(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """``(features, weights)`` of the lines of ``text`` that have a word.

    A line is what stands between newlines, its weight its length in bytes. A null or
    blank text has no lines.
    """
    rows, weights = [], []
    seen: set[bytes] = set()
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        if not words:
            continue
        rows.append(_features(line, words, line in seen))
        weights.append(len(line))
        seen.add(line)
    if not rows:
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0)
    own = np.array(rows, np.float32)
    out = np.zeros((len(own), N_FEATURES), np.float32)
    out[:, :N_OWN] = own
    out[1:, N_OWN:2 * N_OWN] = own[:-1]
    out[:-1, 2 * N_OWN:3 * N_OWN] = own[1:]
    out[0, -2] = out[-1, -1] = 1
    return out, np.array(weights, float)


def _features(line: bytes, words: list[bytes], seen: bool) -> tuple:
    n, m = len(line), len(words)
    distinct = set(words)
    same = sum(map(bytes.__eq__, words, words[1:])) / m
    symbols = (n - len(line.translate(None, SYMBOLS))) / n
    upper = (n - len(line.translate(None, _UPPER))) / n
    marks = (n - len(line.translate(None, _MARKS))) / n
    spread = len(distinct) / m
    short = len(line.translate(None, SPACE)) / m
    return (
        min(np.log1p(m), 8) / 4, min(np.log1p(n), 10) / 5, min(short, 30) / 10,
        symbols, symbols > 0.03, symbols > 0.15,
        marks, marks > 0.06, upper, upper > 0.3,
        (n - len(line.translate(None, _DIGITS))) / n,
        same, same > 0.2, spread, (spread < 0.5) and m > 12,
        line.rstrip()[-1:] in _STOPS, line[:1] in _LOWER, seen,
    )


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a whole text.

    Words are runs of anything but ASCII white space; ``word_chars`` are their code
    points; ``n_symbols`` the characters of ``#*$%&|<>``; ``n_dup_lines`` the lines with a
    word that equal an earlier line; ``n_repeat_words`` the words that stand in a window of
    three words found twice or more. A null text counts as empty.
    """
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len(text) - (len(data) - len(data.translate(None, SPACE)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = Counter(data.split(b"\n"))
    copies = sum(k - 1 for line, k in lines.items() if k > 1 and line.strip(SPACE))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        end = 0  # first word not counted yet
        for i, window in enumerate(windows):
            if times[window] > 1:
                repeated += i + 3 - max(end, i)
                end = i + 3
    return len(words), chars, symbols, copies, repeated
