"""Encode texts chunk by chunk, remembering the ids of chunks seen before.

Byte-level tokenizers cut a text before any single space that stands between two
characters that are no white space. Ids of the part before such a cut do not depend on
the part after it, so a text's ids are those of its chunks, one after another. Texts
with other white space around a space are encoded whole.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np

MOST_REMEMBERED = 300_000
LONGEST_REMEMBERED = 48


def process_store() -> dict:
    """A dict that lives as long as the worker process, for what later tasks can reuse."""
    holder = sys.modules.setdefault("_tablekit_llm_store", types.ModuleType("_tablekit_llm_store"))
    return holder.__dict__.setdefault("kept", {})


def empty_store() -> None:
    """Give back what earlier tasks left in this worker process: up to some 100 MB that
    tasks of another kind do without. Whoever needs it again builds it again."""
    process_store().clear()


class Remembered(dict):
    """Chunk to packed ids; None for a chunk that must not be cut off.

    Two generations of at most ``most`` entries, of some 200 bytes each, bound the
    memory. What is remembered changes nothing but the time.
    """

    def __init__(self, encode: Callable[[str], np.ndarray], lead: str, most: int):
        super().__init__()
        self.encode, self.lead, self.most, self.older = encode, lead, most, {}

    def __missing__(self, chunk: str):
        packed = self.older.get(chunk, 0)
        if packed == 0:
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                return None
            packed = self.encode(self.lead + chunk).tobytes()
            if len(chunk) > LONGEST_REMEMBERED:
                return packed
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[chunk] = packed
        return packed


class ChunkEncoder:
    """``encode`` gives the ids of any text as an array of ``dtype``; texts for which
    ``whole`` is true are never cut."""

    def __init__(self, encode: Callable[[str], np.ndarray], dtype: np.dtype, whole: Callable[[str], bool], most: int = MOST_REMEMBERED):
        self.encode, self.dtype, self.whole = encode, dtype, whole
        self.inner, self.first = Remembered(encode, " ", most), Remembered(encode, "", most // 10)

    def ids(self, text: str) -> np.ndarray:
        if self.whole(text):
            return self.encode(text)
        first, *rest = text.split(" ")
        if not rest or not first or first[-1].isspace():
            return self.encode(text)
        packed = list(map(self.inner.__getitem__, rest))
        if None in packed:
            return self.encode(text)
        packed.insert(0, self.first[first] or self.encode(first).tobytes())
        return np.frombuffer(b"".join(packed), self.dtype)
