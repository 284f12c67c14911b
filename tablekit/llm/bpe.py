"""Byte-pair encoding and decoding, from a vocabulary file of a byte-level tokenizer."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.chunks import ChunkEncoder, process_store
from tablekit.llm.common import free_name

# Fixed value: how byte-level tokenizers of this kind cut a text before merging.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones for themselves,
    all others for the characters from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    symbols, spare = [], 256
    for byte in range(256):
        symbols.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return symbols


class Bpe:
    """The tokenizer described by ``definition``, the text of its JSON file."""

    def __init__(self, definition: str):
        said = json.loads(definition)
        model, before = said["model"], said["pre_tokenizer"]
        odd = [said["normalizer"], said["post_processor"], model.get("dropout"), model.get("unk_token"), model.get("continuing_subword_prefix"), model.get("end_of_word_suffix")]
        flags = [t[k] for t in said["added_tokens"] for k in ("single_word", "lstrip", "rstrip")]
        if any(odd) or any(flags) or model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            raise ValueError("only plain byte-level BPE without a normalizer is supported")
        ids, symbols = model["vocab"], byte_symbols()
        self.byte_ids = [ids.get(symbol) for symbol in symbols]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in said["added_tokens"]}
        found = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, found))) if found else None
        back = {symbol: byte for byte, symbol in enumerate(symbols)}
        size = max([*ids.values(), *self.added.values()]) + 1
        strings = [b""] * size
        for token, i in [*ids.items(), *self.added.items()]:
            strings[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.strings = Joined(strings)
        self.decimals = Joined([b"%d," % i for i in range(size)])
        self.chunks = ChunkEncoder(self.encode_whole, self.dtype, lambda text: bool(self.special and self.special.search(text)))

    def encode(self, text: str) -> np.ndarray:
        return self.chunks.ids(text)

    def encode_whole(self, text: str) -> np.ndarray:
        out: list[int] = []
        at = 0
        for hit in self.special.finditer(text) if self.special else ():
            self._words(text[at : hit.start()], out)
            out.append(self.added[hit.group()])
            at = hit.end()
        self._words(text[at:], out)
        return np.array(out, self.dtype)

    def _words(self, text: str, out: list[int]) -> None:
        for word in WORDS.findall(text):
            out += self._merged([self.byte_ids[b] for b in word.encode()])

    def _merged(self, ids: list[int]) -> list[int]:
        """Apply the merges of lowest rank first, leftmost first among equals.

        The heap holds (rank, position, left id, right id); an entry is stale, and
        skipped, once either symbol is gone or has become another.
        """
        end = len(ids)
        if end == 1:
            return ids
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = []
        for i in range(end - 1):
            if merge := self.merges.get((ids[i], ids[i + 1])):
                heap.append((merge[0], i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= end or ids[j] != right:
                continue
            ids[i], ids[j] = self.merges[left, right][1], None
            after[i] = k = after[j]
            if k < end:
                before[k] = i
                if merge := self.merges.get((ids[i], ids[k])):
                    heapq.heappush(heap, (merge[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (merge := self.merges.get((ids[h], ids[i]))):
                heapq.heappush(heap, (merge[0], h, ids[h], ids[i]))
        return [x for x in ids if x is not None]

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary strings, one after another; what is not UTF-8 becomes U+FFFD."""
        return self.strings.concatenated(ids).decode("utf-8", "replace")

    def decimal(self, ids: np.ndarray) -> bytes:
        return self.decimals.concatenated(ids)[:-1]


class Joined:
    """Byte strings kept end to end, to concatenate many of them by number at once."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def concatenated(self, numbers: np.ndarray, at_once: int = 1 << 18) -> bytes:
        parts = []
        for i in range(0, len(numbers), at_once):
            some = numbers[i : i + at_once]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            shift = np.repeat(self.starts[some] - (ends - lengths), lengths)
            parts.append(self.bytes[shift + np.arange(len(shift))].tobytes())
        return b"".join(parts)


def load(definition: str) -> Bpe:
    """The tokenizer, built once per worker process."""
    store, key = process_store(), ("bpe", hashlib.sha256(definition.encode()).digest())
    if key not in store:
        store[key] = Bpe(definition)
    return store[key]


def read_definition(path: str) -> str:
    """The tokenizer file's text: read on the driver and broadcast, as it has a few MB at
    most and executors need not have it."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def count_tokens(df: DataFrame, tokenizer_path: str, name: str, text: str = "text") -> DataFrame:
    """All columns of ``df`` with the number of ids of each whole text under ``name``."""
    place = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])
    definition = df.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(definition.value)
        for batch in batches:
            counts = [len(bpe.encode(value.as_py() or "")) for value in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)


DIGESTS = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_decode(df: DataFrame, tokenizer_path: str, text: str = "text", keep: list[str] | None = None, ids: str | None = None, decoded: str | None = None) -> DataFrame:
    """The columns ``keep`` (all, if None) with digests of each whole text's ids and of
    the text decoded from them.

    n_tokens: how many ids; ids_sha256: of the decimal ids joined by commas;
    decoded_sha256: of the decoded text. ``ids`` and ``decoded`` name further columns
    for the ids themselves (array of int) and the decoded text. Null and empty texts
    have no ids. The columns of the frame win: where a name is taken, the new column
    gets underscores after it. Rows are neither moved nor dropped, whatever they hold.
    """
    kept = list(df.columns if keep is None else keep)
    names = []
    for wanted in [*DIGESTS, *(n for n in (ids, decoded) if n)]:
        names.append(free_name([*kept, *names], wanted))
    source = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias(free_name(kept, "__text")))
    kinds = [T.LongType(), T.StringType(), T.StringType(), *([T.ArrayType(T.IntegerType())] if ids else []), *([T.StringType()] if decoded else [])]
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(n, k) for n, k in zip(names, kinds))])
    definition = df.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))
    with_ids, with_text = bool(ids), bool(decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(definition.value)
        for batch in batches:
            rows = []
            for value in batch.column(batch.num_columns - 1):
                found = bpe.encode(value.as_py() or "")
                back = bpe.decode(found)
                row = [len(found), hashlib.sha256(bpe.decimal(found)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()]
                rows.append(row + [found.astype("<i4")] * with_ids + [back] * with_text)
            columns = list(zip(*rows)) or [[]] * len(names)
            arrow = [pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32())] * with_ids), *([pa.string()] * with_text)]
            made = [pa.array(c, k) for c, k in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], *names])

    return source.mapInArrow(run, schema)
