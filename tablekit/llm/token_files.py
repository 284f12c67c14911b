"""Token ids in binary files: fixed-width bit packing in blocks, with random access.

A file is, in this order and little-endian: the magic ``TIDS``, bits per id (u32), ids
per block (u32); the blocks, each a whole number of bytes with its ids packed from the
lowest bit on; the offset of each block (u64 each); the offset of these offsets, and the
number of ids (u64 each).
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablekit.llm.bpe import read_definition
from tablekit.llm.chunks import ChunkEncoder, process_store
from tablekit.llm.common import staged
from tablekit.session import fresh_path

MAGIC, HEAD = b"TIDS", "<4sII"
BLOCK_IDS = 1 << 15
MOST_REMEMBERED = 800_000  # chunks in each of two generations: the library is slow to ask


def packed(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpacked(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return planes.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class Writer:
    """Writes one file, a block at a time."""

    def __init__(self, sink, bits: int, block: int = BLOCK_IDS):
        self.sink, self.bits, self.block = sink, bits, block
        self.pending, self.waiting, self.count, self.offsets, self.at = [], 0, 0, [], struct.calcsize(HEAD)
        self.sink.write(struct.pack(HEAD, MAGIC, bits, block))

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            ready = np.concatenate(self.pending)
            whole = len(ready) // self.block * self.block
            for i in range(0, whole, self.block):
                self._put(ready[i : i + self.block])
            self.pending, self.waiting = [ready[whole:]], len(ready) - whole

    def _put(self, ids: np.ndarray) -> None:
        data = packed(ids, self.bits)
        self.offsets.append(self.at)
        self.sink.write(data)
        self.at += len(data)
        self.count += len(ids)

    def close(self) -> None:
        if self.waiting:
            self._put(np.concatenate(self.pending))
        self.sink.write(np.array([*self.offsets, self.at, self.count], "<u8").tobytes())
        self.sink.close()


class Reader:
    """Random access to the ids of one file; reads no more than the blocks asked for."""

    def __init__(self, source):
        self.source = source
        magic, self.bits, self.block = struct.unpack(HEAD, self._read(0, struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        end = source.size()
        offsets_at, self.count = struct.unpack("<QQ", self._read(end - 16, 16))
        self.offsets = np.frombuffer(self._read(offsets_at, end - 16 - offsets_at), "<u8").astype(np.int64)
        self.offsets = np.append(self.offsets, offsets_at)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def ids(self, start: int, count: int) -> np.ndarray:
        if not 0 <= start <= start + count <= self.count:
            raise IndexError("beyond the ids of the file")
        if not count:
            return np.empty(0, "<u4")
        first, last = start // self.block, (start + count - 1) // self.block
        data = self._read(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        parts = []
        for b in range(first, last + 1):
            size = min(self.block, self.count - b * self.block)
            begin = int(self.offsets[b] - self.offsets[first])
            parts.append(unpacked(data[begin : begin + int(self.offsets[b + 1] - self.offsets[b])], self.bits, size))
        return np.concatenate(parts)[start - first * self.block :][:count]


def _encoder(definition: str) -> tuple[Callable[[str], np.ndarray], int]:
    """The tokenizers library's encoding, asked once per distinct chunk a worker meets,
    and the bits that the largest id needs."""
    store, key = process_store(), ("tokenizers", hashlib.sha256(definition.encode()).digest())
    if key not in store:
        tokenizer = Tokenizer.from_str(definition)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        bits = max(1, (max(tokenizer.get_vocab(with_added_tokens=True).values())).bit_length())
        dtype = np.dtype("<u2" if bits <= 16 else "<u4")
        whole = lambda text: any(token in text for token in added)
        encode = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype)
        store[key] = (ChunkEncoder(encode, dtype, whole, MOST_REMEMBERED).ids, bits)
    return store[key]


def write_token_files(df: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and write the ids, in ascending order of ``id``, to files
    in ``folder``, which all executors must reach by this path. Returns the index: id,
    file, start (in the whole corpus), at (in the file), n_tokens, with the end id counted.

    Null and empty texts have the end id only. Null ids come first; rows that repeat an
    id follow each other, ordered by text. Other columns are not read. The rows are
    sorted by range, so files are of like size and in order. A task writes to a name of
    its own and reports it with its rows; what a lost task wrote is never referred to.
    """
    definition = df.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))
    rows = df.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bits = _encoder(definition.value)
        writer, name, at = None, f"{folder}/ids-{uuid4().hex}.bin", 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                system, path = pyarrow.fs.FileSystem.from_uri(name)
                system.create_dir(path.rpartition("/")[0], recursive=True)
                writer = Writer(system.open_output_stream(path), bits)
            sizes = []
            for value in batch.column(1):
                ids = encode(value.as_py() or "")
                writer.add(ids)
                sizes.append(len(ids))
                if end_id is not None:
                    writer.add(np.array([end_id], ids.dtype))
                    sizes[-1] += 1
            n = np.array(sizes, np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name] * len(n)), pa.array(starts), pa.array(n)], names=["id", "file", "at", "n_tokens"])
        if writer:
            writer.close()

    index = staged(rows.mapInArrow(run, "id bigint, file string, at bigint, n_tokens bigint"), "token-index")
    files = index.groupBy("file").agg(F.min("id").alias("first"), F.sum("n_tokens").alias("n"))
    order = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    files = files.select("file", (F.sum("n").over(order) - F.col("n")).alias("before"))  # a row per file
    return index.join(files, "file").select("id", "file", (F.col("before") + F.col("at")).alias("start"), "at", "n_tokens")


def read_token_files(index: DataFrame) -> DataFrame:
    """The index with ids_crc32: of each row's ids as little-endian unsigned 32-bit
    integers, read from the files by random access."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            file, at, n = batch.column("file").to_pylist(), np.asarray(batch.column("at")), np.asarray(batch.column("n_tokens"))
            sums = np.zeros(len(at), np.int64)
            order, i = np.lexsort((at, np.array(file))), 0
            while i < len(order):  # neighbours in a file are read at once, up to a few MB
                j, first = i + 1, order[i]
                while j < len(order) and file[order[j]] == file[first] and at[order[j]] == at[order[j - 1]] + n[order[j - 1]] and at[order[j]] + n[order[j]] - at[first] < 1 << 20:
                    j += 1
                if file[first] != name:
                    name = file[first]
                    system, path = pyarrow.fs.FileSystem.from_uri(name)
                    reader = Reader(system.open_input_file(path))
                some = order[i:j]
                ids = reader.ids(int(at[first]), int(n[some].sum()))
                for k, part in zip(some, np.split(ids, np.cumsum(n[some])[:-1])):
                    sums[k] = zlib.crc32(part.astype("<u4").tobytes())
                i = j
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums)], names=[*batch.schema.names, "ids_crc32"])

    return index.mapInArrow(run, "id bigint, file string, start bigint, at bigint, n_tokens bigint, ids_crc32 bigint")


def token_folder(df: DataFrame) -> str:
    """A new folder for token files in the shared folder."""
    return fresh_path(df.sparkSession, "token-files")
