"""Near-duplicate vectors by cross-polytope hashing, multiprobe buckets and exact checks."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, log1p, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import discard, free_name, mix64, staged
from tablekit.llm.components import connected_components
from tablekit.llm.vectors import matrix, numbers, unit, usable

TABLES, PROBES = 12, 2
MISS, PAIRS, MOST_TABLES = 1e-5, 512, 64
BLOCK, TASK_POSTS = 1000, 5000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(rows, width)
        step *= 2
    return x / np.sqrt(width)


def bucket_keys(x: np.ndarray, hashes: int, tables: int = TABLES) -> np.ndarray:
    """For each row and table, 1 + PROBES bucket keys: home first, then the likeliest others.

    A hash turns the vector by three rounds of random signs and a Hadamard transform and
    names the nearest corner of the cross-polytope, the largest coordinate with its sign.
    A bucket is named by ``hashes`` of them. Probes put the second largest coordinate in
    place of the largest where the two are closest. Without any hash all rows meet.
    """
    rows = len(x)
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((rows, width))
    padded[:, : x.shape[1]] = x
    out = np.empty((rows, tables, 1 + PROBES), np.uint64)
    at = np.arange(rows)
    for t in range(tables):
        best, second, gap = (np.empty((rows, hashes), k) for k in (np.uint64, np.uint64, float))
        for k in range(hashes):
            y = padded
            for turn in range(3):
                bits = mix64(np.arange(width, dtype=np.uint64) + np.uint64((((t * hashes + k) * 3 + turn) << 32) + 1))
                y = hadamard(y * (1.0 - 2.0 * (bits & np.uint64(1)).astype(float)))
            size = np.abs(y)
            a = size.argmax(axis=1)
            first = size[at, a]
            size[at, a] = -1
            b = size.argmax(axis=1)
            gap[:, k] = first - size[at, b]
            best[:, k] = 2 * a + (y[at, a] < 0)
            second[:, k] = 2 * b + (y[at, b] < 0)
        order = np.argsort(gap, axis=1, kind="stable")
        for p in range(1 + PROBES):
            code = best.copy()
            if p and hashes:
                swap = order[:, min(p, hashes) - 1]
                code[at, swap] = second[at, swap]
            key = np.full(rows, (width << 8) + t, np.uint64)
            for k in range(hashes):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + code[:, k] + np.uint64(1))
            out[:, t, p] = key
    return out


def hit_rate(dimension: int, hashes: int, least: float) -> float:
    """How likely two vectors with a cosine of ``least`` meet in one table: the share of
    random pairs that do, less three standard errors."""
    if dimension < 2 or not hashes:
        return 1.0
    rng = np.random.default_rng(0)
    x, z = unit(rng.normal(size=(PAIRS, dimension))), rng.normal(size=(PAIRS, dimension))
    z = unit(z - (x * z).sum(axis=1, keepdims=True) * x)
    with np.errstate(over="ignore"):
        a, b = (bucket_keys(v, hashes) for v in (x, least * x + sqrt(max(0.0, 1 - least * least)) * z))
    met = ((a[:, :, :1] == b) | (b[:, :, :1] == a)).any(axis=2)
    rate = float(met.mean())
    return max(0.0, rate - 3 * sqrt(rate * (1 - rate) / met.size))


def tables_for(dimension: int, hashes: int, least: float) -> tuple[int, int]:
    """Hashes per bucket and tables with which a pair at ``least`` is missed with a
    probability of MISS at most: fewer hashes than asked for, down to none and so one
    bucket of all rows, where that would take more than MOST_TABLES tables."""
    while hashes:
        rate = hit_rate(dimension, hashes, least)
        if rate >= 1:
            return hashes, TABLES
        tables = max(TABLES, ceil(log(MISS) / log1p(-rate))) if rate else MOST_TABLES + 1
        if tables <= MOST_TABLES:
            return hashes, tables
        hashes -= 1
    return 0, 1


def _keyed(df: DataFrame, hashes: int, tables: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = np.asarray(whole.column(1).value_lengths())
            for size in np.unique(sizes):
                batch = whole.filter(pa.array(sizes == size))
                x = matrix(batch.column(1))
                with np.errstate(over="ignore"):
                    keys = bucket_keys(unit(x), hashes, tables).view(np.int64)
                same = pa.array([xxhash.xxh3_128_digest(row.tobytes()) for row in x + 0.0], pa.binary())
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * keys[0].size)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), same, pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))], names=["id", "label", "mark", "same", "keys"])

    return df.mapInArrow(run, "id bigint, label string, mark bigint, same binary, keys array<bigint>")


def _met_before(mine: np.ndarray, theirs: np.ndarray, table: int, key: int) -> np.ndarray:
    """For pairs of rows of keys (pair, table, key): do they meet in an earlier table, or
    in this one under a smaller key? They meet where one is at home in a bucket of the
    other, so that each pair counts in one bucket only."""
    out = np.zeros(len(mine), bool)
    left = np.arange(len(mine))
    for t in range(table + 1):
        a, b = mine[left, t], theirs[left, t]
        hit = np.zeros(len(left), bool)
        for p in range(1 + PROBES):
            for x, y in ((a[:, 0], b[:, p]), (a[:, p], b[:, 0])):
                hit |= (x == y) & ((t < table) | (x < key))
        out[left[hit]] = True
        left = left[~hit]
    return out


def _pairs_of(x: np.ndarray, y: np.ndarray, same: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.nonzero(x @ y.T >= least - 1e-9)
    if same:
        a, b = a[a < b], b[a < b]
    exact = (x[a] * y[b]).sum(axis=1) >= least
    return a[exact], b[exact]


def _linked(table: pa.Table, least: float) -> pa.Table:
    """Compare the members of each bucket (or of two blocks of one): links per member,
    weighted by the copies of the other, and a spanning forest of the links."""
    if not table.num_rows:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    key, spot, side = (np.asarray(table.column(c)) for c in ("key", "spot", "side"))
    ids, copies = np.asarray(table.column("id")), np.asarray(table.column("copies"))
    keys = matrix(table.column("keys")).reshape(len(ids), -1, 1 + PROBES)
    lists = table.column("vector").combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    begins = np.cumsum(sizes) - sizes
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((ids, side, sizes, key))
    edges = np.flatnonzero(np.append(True, (np.diff(key[order]) != 0) | (np.diff(sizes[order]) != 0)))
    firsts, seconds = [], []
    for begin, end in zip(edges, np.append(edges[1:], len(order))):
        members = order[begin:end]
        if len(members) < 2:
            continue
        x = unit(flat[begins[members][:, None] + np.arange(sizes[members[0]])])
        home = spot[members] % (1 + PROBES) == 0
        two = side[members] == 1
        if two.any():
            i, j = np.flatnonzero(~two), np.flatnonzero(two)
            a, b = _pairs_of(x[i], x[j], False, least)
            a, b = i[a], j[b]
        else:
            a, b = _pairs_of(x, x, True, least)
        valid = home[a] | home[b]
        a, b = members[a[valid]], members[b[valid]]
        fresh = ~_met_before(keys[a], keys[b], int(spot[members[0]]) // (1 + PROBES), int(key[members[0]])) & (ids[a] != ids[b])
        firsts.append(a[fresh])
        seconds.append(b[fresh])
    a, b = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (firsts, seconds))
    count = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
    # the smallest id reachable within this task, as one link for each member
    nodes, at = np.unique(ids, return_inverse=True)
    label, before = np.arange(len(nodes)), None
    while before is None or (label != before).any():
        before = label.copy()
        low = np.minimum(label[at[a]], label[at[b]])
        np.minimum.at(label, at[a], low)
        np.minimum.at(label, at[b], low)
        label = label[label]
    some = count > 0
    return pa.table({"a": ids[some], "b": nodes[label[at[some]]], "n": count[some].astype(np.int64)})


def near_vectors(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.98) -> DataFrame:
    """(``id``, n_links, component_id, kept) for every row: how many other rows of the
    same label have a cosine of ``least`` or more, and the smallest id reachable by links.

    Vectors that are null, zero, empty or hold null or non-finite components, and rows
    without a label or an id, link with nothing. Vectors of different lengths never link.
    Rows that repeat an id, with one vector or several, are rows of their own: each has
    the links of its own vector and label, and a component reaches only through these.

    Equal vectors of a label are merged and counted first. Buckets with one member go no
    further; the others are compared in the tasks of their key, large ones in blocks of
    1000 by 1000. Only counts and a spanning forest leave a task, never all pairs; a pair
    that meets in several buckets counts in the first. The number of hashes per bucket
    follows the number of vectors, so buckets stay small as the input grows, and the
    number of tables follows the hashes, so that a pair is missed no more often.
    """
    rows = numbers(df, id, vector, F.col(f"`{label}`").cast("string").alias("label")).where("label is not null")
    rows = rows.withColumn("mark", F.xxhash64("vector"))  # tells the vectors of one id apart
    there = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    width = 1 << max(1, ((there["d"] or 1) - 1).bit_length())
    hashes = max(1, ceil(log(8 * max(2, there["n"])) / log(2 * width)))
    hashes, tables = tables_for(there["d"] or 1, hashes, least)
    keyed = staged(_keyed(rows, hashes, tables), "keyed")
    merged = keyed.groupBy("label", "same").agg(F.min(F.struct("id", "mark")).alias("first"), F.count("*").alias("copies"), F.first("keys").alias("keys"))
    merged = merged.select("label", "same", F.col("first.id").alias("rep"), F.col("first.mark").alias("mark"), "copies", "keys", F.monotonically_increasing_id().alias("node"))
    merged = staged(merged.withColumn("keys", F.transform("keys", lambda k: F.xxhash64("label", k))), "merged")
    posts = merged.select("node", F.posexplode("keys").alias("spot", "key"))
    posts = staged(posts.groupBy("node", "key").agg(F.min("spot").alias("spot")), "posts")
    at_home = F.count_if(F.pmod("spot", F.lit(1 + PROBES)) == 0)
    buckets = posts.groupBy("key").agg(F.count("*").alias("met"), at_home.alias("home")).where("met > 1 and home > 0").select("key", "met")
    buckets = staged(buckets, "bucket_sizes")  # no aggregate on either side: AQE can split a hot bucket
    shared = staged(posts.join(buckets, "key"), "shared")
    tasks = max(1, ceil(shared.count() / TASK_POSTS))
    blocks = F.ceil(F.col("met") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = shared.withColumn("blocks", blocks).withColumn("mine", mine)
    other = spread.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    task = F.when(F.col("blocks") == 1, F.struct(F.pmod("key", F.lit(tasks)).alias("key"), F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    task = task.otherwise(F.struct(F.col("key"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))
    other = other.select("node", "key", "spot", task.alias("task"), F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"))
    payload = merged.select("node", "copies", "keys")
    firsts = merged.select(F.col("rep").alias("id"), "label", "mark", "node")
    vectors = rows.join(firsts, ["id", "label", "mark"]).dropDuplicates(["id", "label", "mark", "node"]).select("node", "vector")
    full = other.join(payload, "node").join(vectors, "node").withColumnRenamed("node", "id")
    found = full.groupBy("task").applyInArrow(lambda t: _linked(t, least), "a bigint, b bigint, n bigint")
    found = staged(found, "links")
    discard(posts, buckets, shared)
    parts = connected_components(found.select("a", "b")).select(F.col("id").alias("node"), "component")
    parts = staged(parts.join(merged.select("node", "rep"), "node"), "parts")
    lowest = parts.groupBy("component").agg(F.min("rep").alias("lowest"))
    parts = parts.join(lowest, "component").select("node", "lowest")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    of_class = merged.select("label", "same", "node", "rep", "copies").join(counts, "node", "left").join(parts, "node", "left")
    links = F.col("copies") - 1 + F.coalesce("n", F.lit(0))
    mine = keyed.select("id", "label", "same").join(of_class, ["label", "same"]).select("id", links.alias("n"), F.coalesce("lowest", "rep").alias("component"))
    takes_part = usable(vector) & F.col(f"`{id}`").isNotNull() & F.col(f"`{label}`").cast("string").isNotNull()
    others = df.where(~takes_part).select(F.col(f"`{id}`").cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("component"))
    all_rows = mine.unionAll(others)
    part = F.coalesce("component", "id")
    names = [id, *(free_name([id], n) for n in ("n_links", "component_id", "kept"))]
    columns = (F.col("id"), F.coalesce("n", F.lit(0)).cast("bigint"), part, F.coalesce(part == F.col("id"), F.lit(True)))
    return all_rows.select(*(c.alias(n) for c, n in zip(columns, names)))
