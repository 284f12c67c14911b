"""Approximate nearest neighbours by permutations of pivots."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import staged
from tablekit.llm.vectors import matrix, numbers, unit

PIVOTS, PREFIX, SAMPLE = 256, 96, 4096
SHARE = 0.3  # of a shard's vectors that is ranked by the original measure
SHARD_ROWS, QUERY_BLOCK = 16_384, 4_096


def choose_pivots(sample: np.ndarray) -> np.ndarray:
    """Up to PIVOTS unit vectors, each the one farthest from those before it, so that a
    crowd of near copies gives one or two."""
    sample = np.unique(unit(sample), axis=0)
    chosen, nearest = [0], sample @ sample[0]
    while len(chosen) < min(PIVOTS, len(sample)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen]


def _with_permutations(df: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the numbers of each vector's nearest pivots, nearest first; none for vectors
    of a length that the sample lacks."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = np.asarray(whole.column(1).value_lengths())
            for size in np.unique(sizes):
                batch = whole.filter(pa.array(sizes == size))
                known = shared.value.get(int(size), np.empty((0, size)))
                near = np.argsort(-(unit(matrix(batch.column(1))) @ known.T), axis=1, kind="stable")[:, :PREFIX].astype(np.int16)
                offsets = pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(near.reshape(-1)))], names=["id", "vector", "near"])

    return df.mapInArrow(run, "id bigint, vector array<double>, near array<smallint>")


def _searched(table: pa.Table, k: int) -> pa.Table:
    """Search one block of queries in one shard.

    The shard's pivot inverted files hold, for each pivot, the vectors that have it among
    their nearest, with its place there. A query reads the files of its own pivots and
    adds up the footrule distance; a pivot that a vector lacks counts as one place behind
    the last. The nearest SHARE of the vectors, and all that tie with the last of them,
    are ranked by cosine on the original vectors.
    """
    is_query = np.asarray(table.column("is_query"))
    ids, x, near = np.asarray(table.column("id")), unit(matrix(table.column("vector"))), matrix(table.column("near")) if len(table) else None
    rows, queries = np.flatnonzero(~is_query), np.flatnonzero(is_query)
    out: list[list] = [[], [], []]
    if len(rows) and len(queries):
        prefix = near.shape[1]
        pivot, place, owner = near[rows].reshape(-1), np.tile(np.arange(prefix), len(rows)), np.repeat(np.arange(len(rows)), prefix)
        order = np.argsort(pivot, kind="stable")
        posted, places = owner[order], place[order].astype(np.int32)
        files = np.searchsorted(pivot[order], np.arange(PIVOTS + 1))
        base, base_ids = x[rows], ids[rows]
        wanted = min(len(rows), max(ceil(SHARE * len(rows)), k + 1))
        for q in queries:
            rule = np.zeros(len(rows), np.int32)
            for at, p in enumerate(near[q]):
                file = slice(files[p], files[p + 1])
                rule[posted[file]] += np.abs(places[file] - at) - (prefix - at)
            candidates = np.flatnonzero(rule <= np.partition(rule, wanted - 1)[wanted - 1])
            candidates = candidates[base_ids[candidates] != ids[q]]
            if not len(candidates):
                continue
            rough = base[candidates] @ x[q]
            top = min(k, len(rough))
            candidates = candidates[rough >= np.partition(rough, -top)[-top] - 1e-9]
            exact = np.clip((base[candidates] * x[q]).sum(axis=1), -1, 1)
            best = np.lexsort((base_ids[candidates], -exact))[:k]
            for column, values in zip(out, ([ids[q]] * len(best), base_ids[candidates[best]], exact[best])):
                column.extend(values)
    return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})


def nearest(df: DataFrame, every: int, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows found nearest by cosine to each row
    whose id is divisible by ``every``, ties to the smaller id.

    Null vectors, those that are zero, empty or hold null or non-finite components, and
    rows without an id take no part. Only vectors of equal length are compared. Rows that
    repeat a query's id are the query itself and are not found by it; the one with the
    smallest vector (compared number by number) asks for all of them. A row that repeats
    another id may be found as often as it is there.

    Pivots come from a sample of 4096 rows, whatever the size of the table; every row is
    indexed. Rows are dealt by hash to shards of some 16,384, queries to blocks of 4096;
    each pair of shard and block is one task, of bounded size. Recall is measured against
    brute force in tests/llm and in the README.
    """
    rows = numbers(df, id, vector)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow().column(0).to_pylist()
    by_size: dict[int, list] = {}
    for one in sample:
        by_size.setdefault(len(one), []).append(one)
    pivots = {size: choose_pivots(np.array(some)) for size, some in by_size.items()}
    index = staged(_with_permutations(rows, pivots), "permutations")
    query = F.pmod("id", F.lit(every)) == 0
    counts = index.agg(F.count("*").alias("n"), F.count_if(query).alias("q")).first()  # a repeated id only makes blocks smaller
    shards, blocks = max(1, ceil(counts["n"] / SHARD_ROWS)), max(1, ceil(counts["q"] / QUERY_BLOCK))
    dealt = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = index.select("*", F.lit(False).alias("is_query"), dealt(shards, 1).alias("shard"), every_one(blocks).alias("block"))
    asking = index.where(query).groupBy("id").agg(F.min(F.struct("vector", "near")).alias("row")).select("id", "row.*")
    asked = asking.select("*", F.lit(True).alias("is_query"), every_one(shards).alias("shard"), dealt(blocks, 2).alias("block"))
    tasks = base.unionByName(asked).groupBy("shard", "block", F.size("vector").alias("size"))
    found = tasks.applyInArrow(lambda t: _searched(t, k), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
