"""Character-class and repetition statistics of a text, as small numpy helpers."""

from __future__ import annotations

import numpy as np

from replyscope.llm.common import covered, split_words, window_hashes, word_hashes

#: Fixed classes of a code point, in this order.
CLASSES = ("lower", "upper", "other_letter", "digit", "space", "newline", "stop", "symbol", "punctuation", "other")
SYMBOLS = b"#*$%&|<>"
STOPS = b".,;:"
_BY_BYTE = np.full(256, CLASSES.index("other"), np.int64)
_BY_BYTE[[*range(97, 123)]] = CLASSES.index("lower")
_BY_BYTE[[*range(65, 91)]] = CLASSES.index("upper")
_BY_BYTE[[*range(0xC3, 0xF5)]] = CLASSES.index("other_letter")
_BY_BYTE[[*range(48, 58)]] = CLASSES.index("digit")
_BY_BYTE[[9, 11, 12, 13, 32]] = CLASSES.index("space")
_BY_BYTE[10] = CLASSES.index("newline")
_BY_BYTE[[*b"!\"'()-/?@[\\]^_`{}~+="]] = CLASSES.index("punctuation")
_BY_BYTE[[*SYMBOLS]] = CLASSES.index("symbol")
_BY_BYTE[[*STOPS]] = CLASSES.index("stop")
_SLICE = 1 << 20


def byte_counts(text: bytes) -> np.ndarray:
    """How often every byte occurs; long texts are counted in slices."""
    body = np.frombuffer(text, np.uint8)
    return sum((np.bincount(body[at : at + _SLICE], minlength=256) for at in range(0, len(body), _SLICE)), np.zeros(256, np.int64))


def class_counts(counts: np.ndarray) -> np.ndarray:
    """Code points of every class. A code point is counted at its first byte."""
    points = counts.copy()
    points[0x80:0xC0] = 0
    return np.bincount(_BY_BYTE, weights=points, minlength=len(CLASSES)).astype(np.int64)


def code_points(counts: np.ndarray) -> int:
    return int(counts.sum() - counts[0x80:0xC0].sum())


def repeated_words(words: list[bytes], size: int = 8) -> int:
    """Words in windows of `size` words that are found twice or more in the text."""
    windows = window_hashes(word_hashes(words), size)
    if len(windows) < 2:
        return 0
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1)
    return int(covered(len(words), starts, size).sum()) if len(starts) else 0


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def base_statistics(text: bytes | None) -> tuple[np.ndarray, list[bytes], dict[str, int]]:
    """Byte counts, words, and the counts of the base rules. Null is empty."""
    text = text or b""
    counts, words = byte_counts(text), split_words(text)
    spaces = int(counts[9:14].sum() + counts[32])
    return counts, words, {
        "n_words": len(words),
        "word_chars": code_points(counts) - spaces,
        "n_symbols": int(counts[[*SYMBOLS]].sum()),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(words),
    }
