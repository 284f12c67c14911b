"""Near-duplicate documents by fast similarity sketching, banding and exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.chunks import empty_store
from tablekit.llm.common import bounded_batches, discard, free_name, mix64, odd_powers, staged
from tablekit.llm.components import connected_components

BANDS, ROWS = 24, 4
BLOCK = 1000  # documents on either side of one comparison task
_MOST_WORDS = 400_000
_GOLDEN = 0x9E3779B97F4A7C15


class _WordHashes(dict):
    """64-bit hashes of words, some of them remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words_each: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text; words are runs
    of anything but ASCII white space, A-Z lower-cased. Fewer words make one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(words_each, len(words))
    weights = odd_powers(_GOLDEN, n + 1)[1:]
    total = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        total = mix64(total + h[i : len(h) - n + 1 + i] * weights[i])
    return np.unique(total)


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A sketch of ``size`` 32-bit coordinates for each set that is not empty.

    Round i throws every element into a random bin with a random value; the first round
    to reach a bin fixes its smallest value. After ``size`` random rounds as many more
    send all elements to one bin each, so that every coordinate is filled, with one to
    two rounds for sets larger than size * ln(size). Two sets agree on a coordinate with
    a probability equal to their Jaccard similarity, with Chernoff-like concentration.
    """
    out = np.zeros((len(sets), size), np.uint64)
    none = np.uint64(2**64 - 1)
    out[:] = none
    lengths = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), lengths)
    items = np.concatenate([*sets, np.empty(0, np.uint64)])
    flat = out.reshape(-1)
    with np.errstate(over="ignore"):
        for turn in range(2 * size):
            if not len(items):
                break
            h = mix64(items + np.uint64((turn + 1) * _GOLDEN % 2**64))
            bins = ((h >> np.uint64(40)) * np.uint64(size) >> np.uint64(24)).astype(np.int64) if turn < size else np.full(len(h), turn - size)
            slot = owner * size + bins
            value = np.uint64(turn << 32) | (h & np.uint64(0xFFFFFFFF))
            np.minimum.at(flat, slot, value)  # later rounds have larger values
            open_sets = (out == none).any(axis=1)
            going = open_sets[owner]
            owner, items = owner[going], items[going]
        return (mix64(out) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketched(df: DataFrame, words_each: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_store()
        hashes = _WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                with np.errstate(over="ignore"):
                    sets = [shingle_set(t.as_py(), words_each, hashes) for t in batch.column(1)]
                    made = sketches(sets, BANDS * ROWS)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                flat = pa.array(made.reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (BANDS * ROWS)), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), lists], names=["id", "n", "same", "sketch"]
                )

    return df.mapInArrow(run, "id bigint, n bigint, same binary, sketch array<int>")


def _with_sets(df: DataFrame, words_each: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                with np.errstate(over="ignore"):
                    sets = [shingle_set(t.as_py(), words_each, hashes).view(np.int64) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])

    return df.mapInArrow(run, "id bigint, shingles array<bigint>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("c"), (F.size("sa") + F.size("sb")).alias("s"))
    return both.where(f"100 * c >= {percent} * (s - c)").select("a", "b")


def _compared_blocks(df: DataFrame, percent: int) -> DataFrame:
    """Within each task (hub, sb, mb): link strays to members of other components, through
    a table of their shingles; a spanning forest of the links is all that comes out."""

    def run(table: pa.Table) -> pa.Table:
        stray = np.asarray(table.column("stray"))
        ids, part = np.asarray(table.column("id")), np.asarray(table.column("part"))
        lists = table.column("shingles").combine_chunks()
        sets = [np.asarray(x.values) for x in lists]
        sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        values = np.concatenate([*sets, np.empty(0, np.int64)])
        members = np.flatnonzero(stray == 0)
        where = np.full(len(sets), -1)
        where[members] = np.arange(len(members))
        is_member = where[owner] >= 0
        m_values, m_owner = values[is_member], where[owner[is_member]]
        order = np.argsort(m_values, kind="stable")
        m_values, m_owner = m_values[order], m_owner[order]
        a, b = [], []
        for i in np.flatnonzero(stray == 1):
            lo, hi = np.searchsorted(m_values, sets[i], "left"), np.searchsorted(m_values, sets[i], "right")
            lengths = hi - lo
            found = m_owner[np.repeat(lo - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]
            common = np.bincount(found, minlength=len(members))
            union = sizes[i] + sizes[members] - common
            hit = members[(100 * common >= percent * union) & (part[members] != part[i])]
            _, one_each = np.unique(part[hit], return_index=True)  # one link to a component says it all
            a += [ids[i]] * len(one_each)
            b += list(ids[hit[one_each]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return df.groupBy("hub", "sb", "mb").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", words_each: int = 5, percent: int = 80) -> DataFrame:
    """(``id``, n_shingles, component_id, kept) for every row of ``df``.

    Rows whose sets of word shingles have a Jaccard similarity of percent/100 or more are
    linked; component_id is the smallest id reachable by links. Candidates agree in one
    of 24 bands of 4 coordinates (a pair at 0.8 is missed with a probability of 3e-6);
    every link is confirmed on the full sets.

    Null and empty texts, and those of white space only, have an empty set and no link.
    A null id never links: component_id is null and the row is kept. Rows that repeat an
    id are one node. Other columns are not read.

    Equal sets are merged first. In each band's bucket the members are checked against
    one hub, the member met most often in all buckets; only members outside the hub's
    component are then compared with the others, in blocks of 1000 by 1000. So no bucket,
    whatever its size, is gathered in one task or written out as pairs, and no link
    between components is lost.
    """
    spark = df.sparkSession
    source = df.select(F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    with bounded_batches(spark):
        signed = staged(_sketched(source, words_each), "sketches")
    usable = signed.where("id is not null and n > 0")
    # What is joined back to the rows it was counted from is written first: AQE can split
    # the hot keys of such a join only if neither side is an aggregate.
    same = staged(usable.groupBy("same").agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch")), "same")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("sketch", i * ROWS + 1, ROWS)))
    posted = staged(same.select("rep", F.explode(bands).alias("key")), "bands")
    sizes = staged(posted.groupBy("key").agg(F.count("*").alias("met")).where("met > 1"), "bucket_sizes")
    shared = staged(posted.join(sizes, "key"), "buckets")
    weight = shared.groupBy("rep").agg(F.sum("met").alias("weight"))
    hubs = staged(shared.join(weight, "rep").groupBy("key").agg(F.max_by("rep", F.struct("weight", -F.col("rep"))).alias("hub")), "hubs")
    cluster = staged(shared.join(hubs, "key").select("hub", "rep").distinct(), "clusters")
    wanted = cluster.select(F.col("rep").alias("id")).distinct()
    # by sort-merge at every size: the list of candidates grows with the input
    with bounded_batches(spark):
        sets = staged(_with_sets(source.join(wanted.hint("merge"), "id", "left_semi"), words_each), "sets")

    pairs = cluster.where("hub <> rep").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    links = staged(_linked(pairs, sets, percent).distinct(), "links")
    first = connected_components(links)

    parts = first.select(F.col("id").alias("rep"), F.col("component").alias("part"))
    at_hub = first.select(F.col("id").alias("hub"), F.col("component").alias("hub_part"))
    known = cluster.join(parts, "rep", "left").join(at_hub, "hub", "left")
    known = known.select("hub", "rep", F.coalesce("part", "rep").alias("part"), F.coalesce("hub_part", "hub").alias("hub_part"))
    known = staged(known.withColumn("stray", (F.col("part") != F.col("hub_part")).cast("int")), "clusters")
    counts = known.where("rep <> hub").groupBy("hub").agg(F.count("*").alias("members"), F.sum("stray").alias("strays"))
    counts = staged(counts.where("strays > 0 and members > 1"), "cluster_sizes")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    todo = known.where("rep <> hub").join(counts, "hub").select("hub", "rep", "part", "stray", blocks("members").alias("m"), blocks("strays").alias("s"))
    mine = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(n)).cast("int")
    as_member = todo.select("hub", "rep", "part", F.lit(0).alias("stray"), mine("m", 1).alias("mb"), F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("sb"))
    as_stray = todo.where("stray = 1").select("hub", "rep", "part", F.lit(1).alias("stray"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("mb"), mine("s", 2).alias("sb"))
    tasks = as_member.unionByName(as_stray).withColumnRenamed("rep", "id").join(sets, "id")
    more = staged(_compared_blocks(tasks, percent), "links")
    if more.isEmpty():
        labels = first
    else:
        labels = connected_components(links.union(more))
    to_rep = usable.select("id", "same").join(same.select("same", "rep"), "same").select("id", "rep")
    of_rep = labels.select(F.col("id").alias("rep"), "component")
    # an id met with several sets ties their components together
    joined = to_rep.join(of_rep, "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    joined = joined.groupBy("id").agg(F.min("component").alias("component"))
    id_as, n_as, part_as, kept_as = id, free_name([id], "n_shingles"), free_name([id], "component_id"), free_name([id], "kept")
    out = signed.select("id", "n").join(joined, "id", "left")
    part = F.coalesce("component", "id")
    discard(posted, sizes, shared, hubs, cluster, counts, known, sets, links, more)
    return out.select(F.col("id").alias(id_as), F.col("n").alias(n_as), part.alias(part_as), F.coalesce(part == F.col("id"), F.lit(True)).alias(kept_as))
