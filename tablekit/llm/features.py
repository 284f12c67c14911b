"""Measures of a text's surface, for the quality classifier."""

from __future__ import annotations

import re

import numpy as np

NAMES = (
    "log_bytes", "log_words", "word_length", "upper_share", "digit_share", "punct_share", "symbol_share", "space_share",
    "high_byte_share", "distinct_words", "repeated_neighbour", "repeated_line", "line_words", "bare_symbol_words", "long_words",
    "loud_words", "ends_of_sentences", "byte_entropy",
)

_LOUD = re.compile(rb"[!?#*$%&@~^|]{2,}")


def _class_table() -> np.ndarray:
    """A row of 0/1 for each byte value: upper, digit, punctuation, symbol, space, non-ASCII."""
    table = np.zeros((256, 6))
    for byte in range(256):
        char = chr(byte)
        table[byte] = [
            "A" <= char <= "Z",
            "0" <= char <= "9",
            char in ".,;:!?'\"()-",
            byte < 128 and char.isprintable() and not char.isalnum() and char not in " .,;:!?'\"()-",
            char in " \t\n\r\v\f",
            byte > 127,
        ]
    return table


_CLASSES = _class_table()


def features(text: str | None) -> np.ndarray:
    """The measures of a whole text; of an empty or null one all are 0."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return np.zeros(len(NAMES))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, m = len(data), len(words)
    upper, digit, punct, symbol, space, high = counts @ _CLASSES / n
    present = counts[counts > 0] / n
    lines = [line for line in data.split(b"\n") if line]
    bare = sum(not word.isalnum() and not any(c > 127 or 48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123 for c in word) for word in words if len(word) < 4)
    return np.array(
        [
            np.log1p(n), np.log1p(m), (n - n * space) / m, upper, digit, punct, symbol, space, high,
            len(set(words)) / m, sum(map(bytes.__eq__, words, words[1:])) / m, 1 - len(set(lines)) / max(1, len(lines)), np.log1p(m / max(1, len(lines))),
            bare / m, sum(len(w) > 20 for w in words) / m, len(_LOUD.findall(data)) / m, (counts[46] + counts[33] + counts[63]) / m, -(present * np.log2(present)).sum(),
        ]
    )
