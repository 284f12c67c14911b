"""Removal of byte strings that already occurred, by suffix arrays over candidate regions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.chunks import empty_store, process_store
from tablekit.llm.common import discard, free_name, mix64, odd_powers, staged
from tablekit.llm.suffix_array import later_windows

WIDTH, GRAM = 100, 24
SPAN = WIDTH - GRAM + 1  # places of a gram in a string of WIDTH bytes
SHARD_REGIONS = 2000
_BASE, _OTHER_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_BLOCK_BYTES = 1 << 20
_PIECE_BYTES = 1 << 14  # of a block, so many are hashed at a time: their hashes stay in the cache
_PARTS = 4  # of the places of a gram in a string, for what a shard leaves out
_CUT_REGIONS = 8192  # in a batch


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best() over every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def _choices(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Grams of 24 bytes chosen by winnowing from texts laid end to end: place, hash, and
    the starts of the first and last string that choose it.

    Every string of 100 bytes within a text chooses the gram of smallest hash in it, of
    equal ones the first. So equal strings choose an equal one at the same place, and the
    strings that choose one gram start one after the other.
    """
    n = len(data)
    if n < WIDTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    powers = odd_powers(_BASE, GRAM)
    h = mix64(np.arange(1, 257, dtype=np.uint64) * powers[1])[data]
    by_size = {1: h}
    for size in (1, 2, 4, 8):
        h = h[:-size] + h[size:] * powers[size]
        by_size[2 * size] = h
    count = n - GRAM + 1
    h = mix64(by_size[16][:count] + by_size[8][16 : 16 + count] * powers[16])
    # 32 bits of the hash, and the place to tell equal ones apart
    least = _sliding((h & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64), SPAN, np.minimum)
    choice = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    full = sizes > 0
    beyond = np.maximum((begins + sizes)[full, None] - np.arange(1, WIDTH), begins[full, None]).ravel()
    choice[beyond[beyond < len(choice)]] = -1  # strings that would leave their text
    first = np.flatnonzero(np.append(True, choice[1:] != choice[:-1]))
    last = np.append(first[1:], len(choice)) - 1
    inside = choice[first] >= 0
    first, last = first[inside], last[inside]
    return choice[first], h[choice[first]], first, last


def fingerprints(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the chosen grams alone."""
    return _choices(data, begins, sizes)[:2]


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """``count`` powers and inverse powers at least, made once in a worker process."""
    made = process_store().get("powers")
    if made is None or len(made[0]) < count:
        made = odd_powers(_OTHER_BASE, count), odd_powers(pow(_OTHER_BASE, -1, 2**64), count)
        process_store()["powers"] = made
    return made


def substring_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[begin:end]; equal bytes have equal ones, wherever they are."""
    table = mix64(np.arange(1000, 1256, dtype=np.uint64))[data]
    powers, inverse = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table * powers[: len(data)])])
    return (sums[end] - sums[begin]) * inverse[begin]


def region_digests(data: np.ndarray, gram: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[begin:end], the bytes around each gram, and of its place there."""
    return mix64(substring_hashes(data, begin, end) + ((gram - begin) * 512 + end - begin).astype(np.uint64))


def placed_grams(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, digests: bool = True) -> tuple[np.ndarray, ...]:
    """The chosen grams of a block: place, hash, number of the text, begin and end of the
    region, which is the bytes of all strings that choose the gram, and the region's
    digest (nothing, if ``digests`` are not wanted).

    What a gram and its region are depends on the WIDTH bytes before and after it. So a
    block is worked on in pieces with as much around them, in bounded memory.
    """
    parts = []
    full = np.flatnonzero(sizes)  # empty texts begin where the next does
    starts, stops = begins[full], (begins + sizes)[full]
    for start in range(0, max(1, len(data)), _PIECE_BYTES):
        low, high = max(0, start - WIDTH), min(len(data), start + _PIECE_BYTES + WIDTH)
        here = slice(np.searchsorted(stops, low, "right"), np.searchsorted(starts, high))
        first, last = np.maximum(starts[here], low), np.minimum(stops[here], high)
        at, gram, begin, end = _choices(data[low:high], first - low, last - first)
        inside = (at + low >= start) & (at + low < start + _PIECE_BYTES)
        at, gram, begin, end = at[inside], gram[inside], begin[inside], end[inside] + WIDTH
        if len(at):
            owner = full[np.searchsorted(starts, at + low, "right") - 1]
            parts.append((at + low, gram, owner, begin + low, end + low, region_digests(data[low:high], at, begin, end) if digests else gram[:0]))
    if not parts:
        parts = [tuple(np.empty(0, kind) for kind in (np.int64, np.uint64, np.int64, np.int64, np.int64, np.uint64))]
    return tuple(np.concatenate(column) for column in zip(*parts))


def _laid_out(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts or of byte strings, end to end, and where each begins, and the
    last ends; nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    texts = texts.fill_null(b"") if texts.null_count else texts
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]


def _blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Some texts at a time: number of the first, bytes end to end, begins, sizes."""
    data, offsets = _laid_out(texts)
    first = 0
    while first < len(texts):
        last = min(len(texts), int(np.searchsorted(offsets, offsets[first] + _BLOCK_BYTES)))
        last = max(last, first + 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first:last] - offsets[first], np.diff(offsets[first : last + 1])
        first = last


def _gathered(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """data[begin : begin + size] for each of them, end to end."""
    return data[np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)]


def _flat(lists: pa.Array, names: Sequence[str]) -> tuple[np.ndarray, ...]:
    """Rows of lists of structs, and the named fields; a null list is empty."""
    row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
    values = lists.flatten()
    return row, *(np.asarray(pc.struct_field(values, name)) for name in names)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    empty_store()
    for batch in batches:
        for _, data, begins, sizes in _blocks(batch.column(0)):
            with np.errstate(over="ignore"):
                found = placed_grams(data, begins, sizes, digests=False)[1]
            grams, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], names=["gram", "n"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's grams with the digest of their region and how far it goes to the left
    and right. Of equal regions in one text only the first goes on; the others are
    removed here and now: rows with an end, neighbours put together."""
    for batch in batches:
        id, tag = np.asarray(batch.column(1)), np.asarray(batch.column(2))
        for first, data, begins, sizes in _blocks(batch.column(0)):
            with np.errstate(over="ignore"):
                at, gram, owner, begin, end, digest = placed_grams(data, begins, sizes)
                same = mix64(mix64(gram + mix64(digest)) + owner.astype(np.uint64))
            _, new = np.unique(same, return_index=True)
            again = np.ones(len(at), bool)
            again[new] = False
            again = np.flatnonzero(again)
            apart = np.append(True, (begin[again][1:] > end[again][:-1]) | (owner[again][1:] != owner[again][:-1]))[: len(again)]
            heads = np.flatnonzero(apart)
            stops = np.maximum.reduceat(end[again], heads) if len(heads) else heads
            take = np.concatenate([new, again[heads]]).astype(np.int64)
            place = np.concatenate([at[new], begin[again[heads]]]) - begins[owner[take]]
            stop = np.concatenate([np.zeros(len(new), np.int64), stops - begins[owner[again[heads]]]])
            left, right = (at - begin)[take].astype(np.int8), (end - at)[take].astype(np.int8)
            columns = [gram.view(np.int64)[take], digest.view(np.int64)[take], id[first + owner[take]], tag[first + owner[take]], place.astype(np.int32), stop.astype(np.int32), left, right]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "digest", "id", "tag", "at", "end", "left", "right"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the regions around the listed grams of each text."""
    for batch in batches:
        id, tag = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        data, offsets = _laid_out(batch.column(2))
        listed = _flat(batch.column(3), ["gram", "kinds", "at", "left", "right"])
        for some in range(0, len(listed[0]), _CUT_REGIONS):
            row, gram, kinds, at, left, right = (column[some : some + _CUT_REGIONS] for column in listed)
            size = left.astype(np.int64) + right
            stops = np.append(0, np.cumsum(size)).astype(np.int32)
            region = _gathered(data, offsets[row] + at - left, size)
            region = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(stops), pa.py_buffer(region)])
            columns = [gram, kinds, id[row], tag[row], at, left.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), region], names=["gram", "kinds", "id", "tag", "at", "left", "region"])


def _alike(data: np.ndarray, gram: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Numbers of the regions that may share a string with another one of the same gram,
    with the begin and end of what may be shared.

    All strings with the gram at places low to high have the bytes from low before it to
    WIDTH - high after it in common. Where no other region has the same bytes there, none
    has the same string.
    """
    least, most = np.full(len(at), WIDTH), np.full(len(at), -1)
    edges = np.linspace(0, SPAN, _PARTS + 1).astype(np.int64)
    salted = mix64(gram.view(np.uint64))
    for low, high in zip(edges[:-1], edges[1:] - 1):
        here = np.flatnonzero((at - begin >= low) & (WIDTH - (end - at) <= high))
        key = mix64(substring_hashes(data, at[here] - low, at[here] + WIDTH - high) + salted[here])
        _, which, n = np.unique(key, return_inverse=True, return_counts=True)
        here = here[n[which] > 1]
        least[here] = np.minimum(least[here], low)
        most[here] = high
    found = np.flatnonzero(most >= 0)
    at, begin, end = at[found], begin[found], end[found]
    return found, np.maximum(begin, at - most[found]), np.minimum(end, at + WIDTH - least[found])


def _searched(table: pa.Table) -> pa.Table:
    """Spans of one shard: its regions' suffix array, runs of common prefixes of WIDTH
    bytes, and all but the earliest place of each run."""
    ids, rows, place = (np.asarray(table.column(c)) for c in ("id", "tag", "at"))
    order = np.lexsort((rows, ids))
    new = np.append(True, (np.diff(ids[order]) != 0) | (np.diff(rows[order]) != 0))
    document = np.empty(len(ids), np.int64)
    document[order] = np.cumsum(new)
    data, offsets = _laid_out(table.column("region"))
    at = offsets[:-1] + np.asarray(table.column("left"))
    with np.errstate(over="ignore"):
        of, begin, end = _alike(data, np.asarray(table.column("gram")), at, offsets[:-1], offsets[1:])
    start = place[of].astype(np.int64) - (at[of] - begin)
    found = later_windows(_gathered(data, begin, end - begin), end - begin, document[of], start, WIDTH)
    region, first, last = found.T
    return pa.table({"id": ids[of[region]], "tag": rows[of[region]], "begin": (start[region] + first).astype(np.int32), "end": (start[region] + last + WIDTH).astype(np.int32)})


def _halves(regions: DataFrame) -> DataFrame:
    """Split regions by where the gram lies in a string, lo to hi: two halves, each with
    the bytes that all its strings share as a new key, and only the bytes they need."""
    middle = F.expr("(lo + hi) div 2").cast("int")
    halves = F.explode(F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct((middle + 1).alias("lo"), F.col("hi")))).alias("half")
    out = regions.select("gram", "id", "tag", "at", "left", "region", halves)
    # strings of the region have the gram at left, left - 1, ... down to left + WIDTH - size
    low = F.greatest(F.col("half.lo"), F.col("left") + WIDTH - F.octet_length("region"))
    high = F.least(F.col("half.hi"), F.col("left"))
    out = out.select("*", low.alias("a"), high.alias("b")).where("a <= b and half.lo <= half.hi")
    cut = lambda begin, end: F.substring("region", F.col("left") - begin + 1, end + begin)  # noqa: E731  bytes -begin..end around the gram
    key = F.xxhash64("gram", "half", cut(F.col("half.lo"), F.lit(WIDTH) - F.col("half.hi")))
    region = cut(F.col("b"), F.lit(WIDTH) - F.col("a"))
    out = out.select(key.alias("gram"), "id", "tag", "at", F.col("b").alias("left"), region.alias("region"), "half.lo", "half.hi")
    return out.withColumn("digest", F.xxhash64("left", "region"))


def _classes(members: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """The earliest member of each region of a gram, and how many regions the gram has."""
    first = members.groupBy("gram", "digest").agg(F.min(F.struct("id", "tag", "at", *more)).alias("first"))
    first = staged(first.select("gram", "digest", "first.*"), "classes")
    kinds = first.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    return first, staged(kinds, "kinds")


def _copies(members: DataFrame, first: DataFrame) -> DataFrame:
    """Members of a region other than its earliest."""
    first = first.select("gram", "digest", F.struct("id", "tag", "at").alias("first"))
    return members.join(first, ["gram", "digest"]).where("(id, tag, at) > (first.id, first.tag, first.at)")


def repeated_spans(df: DataFrame) -> DataFrame:
    """From (id, tag, text) the spans (id, tag, begin, end), with overlaps, of bytes that
    lie in strings of 100 bytes which start earlier too.

    1. Winnowing counts the grams of all texts; those met once cannot be in a repeat.
    2. The others are compared by the digest of the region around them, the bytes of
       all strings that choose the gram: equal regions but the earliest are repeats from
       end to end.
    3. Where a gram has different regions, one of each goes to a shard of some 2000,
       whose suffix array and common prefixes find the repeats, but for parts of
       regions that by their hash no other region of the gram has. A gram with more than
       4000 is split by where in a string it lies and by the bytes around it, again
       and again, so no gram is too large for a shard.

    Each step is written to the shared folder, counts before they are joined back: so AQE
    can split the joins on a large gram. Grams and digests are shuffled, never all members
    of one gram to one task.
    """
    text = df.where("id is not null and text is not null")
    counts = text.select("text").mapInArrow(_counted, "gram bigint, n bigint")
    repeated = staged(counts.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "grams")
    places = text.select("text", "id", "tag").mapInArrow(_placed, "gram bigint, digest bigint, id bigint, tag int, at int, end int, left tinyint, right tinyint")
    members = staged(places.join(repeated, "gram", "left_semi"), "members")
    spans = [members.where("end > 0").select("id", "tag", F.col("at").alias("begin"), "end")]
    around = ((F.col("at") - F.col("left")).alias("begin"), (F.col("at") + F.col("right")).alias("end"))
    whole = members.where("end = 0").drop("end")
    first, kinds = _classes(whole, "left", "right")
    spans.append(staged(_copies(whole, first).select("id", "tag", *around), "spans"))
    lists = first.join(kinds, "gram").groupBy("id", "tag").agg(F.collect_list(F.struct("gram", "at", "left", "right", "kinds")).alias("grams"))
    cut = text.join(lists, ["id", "tag"]).select("id", "tag", "text", "grams")
    regions = cut.mapInArrow(_cut_out, "gram bigint, kinds bigint, id bigint, tag int, at int, left int, region binary")
    regions = staged(regions.withColumns({"lo": F.lit(0), "hi": F.lit(SPAN - 1)}), "regions")
    discard(repeated, first, kinds)
    while True:
        large = F.col("kinds") > 2 * SHARD_REGIONS
        here, larger = regions.agg(F.count_if(~large).alias("a"), F.count_if(large).alias("b")).first()
        packed = F.pmod(F.xxhash64("gram"), F.lit(max(1, ceil(here / SHARD_REGIONS))))
        alone = F.col("kinds") > SHARD_REGIONS // 8  # so that no shard gets several large grams
        shard = F.struct(alone, F.when(alone, F.col("gram")).otherwise(packed)).alias("shard")
        found = regions.where(~large).select(shard, "gram", "id", "tag", "at", "left", "region")
        spans.append(staged(found.groupBy("shard").applyInArrow(lambda t: _searched(t), "id bigint, tag int, begin int, end int"), "spans"))
        if not larger:
            break
        halves = staged(_halves(regions.where(large)), "halves")
        first, kinds = _classes(halves, "left", "region", "lo", "hi")
        begin = F.col("at") - F.col("left")
        spans.append(staged(_copies(halves, first).select("id", "tag", begin.alias("begin"), (begin + F.octet_length("region")).alias("end")), "spans"))
        regions = staged(first.join(kinds, "gram"), "regions")
        discard(halves, first, kinds)
    out = spans[0]
    for more in spans[1:]:
        out = out.union(more)
    return out


def _runs(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, begin and end in ``data`` of the maximal runs that spans within texts cover."""
    begin, end = offsets[row] + begin, np.minimum(offsets[row] + end, offsets[row + 1])
    order = np.lexsort((begin, row))
    row, begin, top = row[order], begin[order], np.maximum.accumulate(end[order])
    heads = np.flatnonzero(np.append(True, (begin[1:] > top[:-1]) | (row[1:] != row[:-1]))[: len(row)])
    return row[heads], begin[heads], top[np.append(heads[1:], len(row)) - 1] if len(heads) else heads


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", kept: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (all, if not given) with n_bytes, n_removed, n_spans
    and kept_sha256 of each whole text as UTF-8, and the text that is left if ``kept``
    names a column for it.

    A byte goes if a string of 100 bytes covers it that also starts earlier: under a
    smaller id, or in the same text further left. Null texts count as empty and stay
    null. Rows with a null id are left as they are and make nothing else a repeat. Rows
    that repeat an id are told apart by a hash of their texts; equal ones get equal
    results. Where a character is removed in part, what is left of it is dropped from
    the ``kept`` text (not from the digest). Names already taken get underscores.
    """
    columns = list(df.columns if keep is None else keep)
    names = []
    for wanted in ("n_bytes", "n_removed", "n_spans", "kept_sha256", *([kept] if kept else [])):
        names.append(free_name([*columns, *names], wanted))
    tag = F.xxhash64(F.col(f"`{text}`").cast("string")).bitwiseAND(F.lit(2**31 - 1)).cast("int")
    source = df.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("given"), tag.alias("tag"), F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    spans = repeated_spans(source.select("id", "tag", "text")).groupBy("id", "tag").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    both = source.join(spans, ["id", "tag"], "left")
    with_text = bool(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _laid_out(batch.column("text"))
            row, begin, end = _runs(data, offsets, *_flat(batch.column("spans"), ["begin", "end"]))
            n_spans = np.bincount(row, minlength=batch.num_rows)
            after = np.append(0, np.cumsum(n_spans)).tolist()
            removed = np.append(0, np.cumsum(end - begin))
            n_removed = np.diff(removed[after])
            whole, begin, end, bounds = memoryview(data), begin.tolist(), end.tolist(), offsets.tolist()
            digests, texts = [], []
            for i, null in enumerate(batch.column("text").is_null().to_pylist()):
                edges = [bounds[i], bounds[i + 1]]
                for k in range(after[i], after[i + 1]):
                    edges[-1:-1] = begin[k], end[k]
                left = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))
                digests.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    texts.append(None if null else left.decode("utf-8", "ignore"))
            made = [np.diff(offsets), n_removed, n_spans.astype(np.int64)]
            strings = [digests, texts] if with_text else [digests]
            yield pa.RecordBatch.from_arrays([batch.column("given"), *(pa.array(c) for c in made), *(pa.array(c, pa.string()) for c in strings)], names=["given", *names])

    kinds = [T.LongType(), T.LongType(), T.LongType(), T.StringType(), *([T.StringType()] * with_text)]
    schema = T.StructType([source.schema["given"], *(T.StructField(n, k) for n, k in zip(names, kinds))])
    return both.select("given", "text", "spans").mapInArrow(run, schema).select("given.*", *names)
