"""Counts and statistics of one text, for use inside tasks.

Words are runs of characters other than ASCII white space, lines are what stands between
newlines. All functions take whole texts as UTF-8 bytes, whose own split() knows exactly
these white-space characters.
"""

from __future__ import annotations

import math
from operator import eq

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_DIGITS = b"0123456789"
_MARKS = b".,;:!?'\"()-"
_TAILS = bytes(range(0x80, 0xC0))  # bytes of a code point after its first


def without(data: bytes, drop: bytes) -> int:
    """How many bytes of data are in drop."""
    return len(data) - len(data.translate(None, drop))


def code_points(data: bytes) -> int:
    return len(data.translate(None, _TAILS))


def word_lines(data: bytes) -> list[bytes]:
    """The lines that hold a word."""
    return [line for line in data.split(b"\n") if line.strip()]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs twice or more; the first one counts too."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for window in windows:
        (twice if window in seen else seen).add(window)
    covered, end = 0, 0  # words before `end` are counted
    for k, window in enumerate(windows):
        if window in twice:
            covered += k + 3 - max(k, end)
            end = k + 3
    return covered


def base_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = data.split()
    lines = word_lines(data)
    return (
        len(words),
        code_points(data) - without(data, _SPACE),
        without(data, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


LINE_FEATURES = 12


def line_features(line: bytes, again: bool) -> list[float]:
    """What a line looks like, each between 0 and about 1; `again`: an earlier line equals it."""
    words = line.split()
    n, chars = len(words), max(1, len(line))
    upper, lower = without(line, _UPPER), without(line, _LOWER)
    short = sum(map((4).__gt__, map(len, words)))
    return [
        1.0,
        min(1.0, 8 * without(line, SYMBOLS) / chars),
        upper / max(1, upper + lower),
        1 - len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        min(1.0, line.count(b"!!") / n),
        min(1.0, 2 * words.count(b"|") / n),
        short / n,
        min(1.0, math.log1p(n) / 6),
        1.0 if line.rstrip()[-1:] in b".!?" else 0.0,
        min(1.0, without(line, _DIGITS) / chars * 4),
        1.0 if again else 0.0,
    ]


DOCUMENT_STATS = 20


def document_stats(data: bytes) -> list[float]:
    """Statistics of a whole text; zeros where there is no word."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * DOCUMENT_STATS
    lines = word_lines(data)
    chars = len(data)
    distinct = len(set(words))
    upper, lower = without(data, _UPPER), without(data, _LOWER)
    lengths = list(map(len, words))
    mean = sum(lengths) / n
    capital = sum(word[:1].isupper() for word in words)
    return [
        math.log1p(n),
        math.log1p(len(lines)),
        math.log1p(n / len(lines)),
        mean,
        math.sqrt(max(0.0, sum(k * k for k in lengths) / n - mean * mean)),
        math.log1p(max(lengths)),
        1000 * without(data, SYMBOLS) / chars,
        upper / max(1, upper + lower),
        capital / n,
        without(data, _DIGITS) / chars,
        without(data, _MARKS) / chars,
        data.count(b".") / n,
        data.count(b"!!") / n,
        words.count(b"|") / n,
        sum(map((4).__gt__, lengths)) / n,
        distinct / n,
        math.log(distinct + 1) / math.log(n + 1),
        sum(map(eq, words, words[1:])) / n,
        repeated_words(words) / n,
        1 - len(set(lines)) / len(lines),
    ]
