"""Hard negatives from candidate lists that the anchors of a cluster share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import discard, staged
from tablekit.llm.vectors import matrix

CLUSTERS, SAMPLE, ROUNDS = 64, 4096, 10
SHARD_NUMBERS = 1 << 22  # components of the candidates in one task, 34 MB
LEAST_SHARD_NUMBERS = 1 << 18  # and in small tables, so that all cores have work
TOGETHER = 256  # anchors of a cluster that walk a list at the same time
STEP = 512  # candidates of a list that are scored at a time
_SLACK = 1e-9  # what rounding may take from a bound, as a share of the lengths
_EXACT = 2**53


def integer_vectors(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component, in double precision."""
    return F.transform(F.col(f"`{vector}`"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero for a zero vector) and lengths."""
    x = x.astype(np.float64)
    length = np.sqrt((x * x).sum(axis=1))
    return x / np.maximum(length, 1e-300)[:, None], length


def fit_centres(sample: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """Unit centres of clusters by direction (spherical k-means from the farthest points)."""
    x = np.unique(_directions(sample)[0], axis=0)  # in an order of its own, whatever that of the rows
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(clusters, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    centres = x[chosen]
    for _ in range(ROUNDS):
        of = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        found, length = _directions(sums)
        centres = np.where(length[:, None] > 0, found, centres)
    return centres


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two integer matrices."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("the inner products of these vectors do not fit a 64-bit integer")
    return a @ b.T


@dataclass
class Shard:
    """The candidates of one task, and their list for the cluster at hand."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def __post_init__(self) -> None:
        self.directions, self.lengths = _directions(self.vectors)
        self.cluster = None

    def sort_for(self, cluster: int, centre: np.ndarray, radius: float) -> None:
        """Order candidates by the most that any anchor within ``radius`` of the centre
        could score with them, for an anchor of length 1: length * cos(angle to the centre
        - radius). Done once per cluster; all its anchors walk the same list."""
        if self.cluster == cluster:
            return
        angle = np.arccos(np.clip(self.directions @ centre, -1, 1))
        bound = self.lengths * (np.cos(np.maximum(0, angle - radius)) + _SLACK)
        self.order = np.argsort(-bound, kind="stable")
        self.bound, self.cluster = bound[self.order], cluster


def best_of_shard(
    shard: Shard, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, k: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each anchor and each of its limits, the ``k`` candidates of the shard that
    score highest, ties to the smaller id, among those with low <= score <= high, of the
    anchor's label (``same``, other rows only) or of another.

    Yields (anchor number, limit number, ids, scores). Anchors walk the sorted list step
    by step and leave it when nothing that is still to come can matter: the bound times
    their length is below the k-th best, or the lowest score, of every limit. That is
    certain, as a bound with its slack is never below a score.
    """
    length = _directions(anchors)[1]
    none = np.empty(0, np.int64)
    best = {(i, j): (none, none) for i in range(low.shape[0]) for j in range(low.shape[1])}
    needed = np.where(low <= high, low, np.iinfo(np.int64).max)
    walking = np.arange(len(anchors))
    for begin in range(0, len(shard.order), STEP):
        most = length[walking] * shard.bound[begin]
        walking = walking[(most[:, None] >= needed[walking]).any(axis=1)]
        if not len(walking):
            break
        rows = shard.order[begin : begin + STEP]
        score = _scores(anchors[walking], shard.vectors[rows])
        found, of = shard.ids[rows], shard.labels[rows]
        fits = (of[None, :] == labels[walking][:, None]) == same
        if same:
            fits &= found[None, :] != ids[walking][:, None]
        for j in range(low.shape[1]):
            ok = fits & (score >= needed[walking, j][:, None]) & (score <= high[walking, j][:, None])
            for r in np.flatnonzero(ok.any(axis=1)):
                i, new = int(walking[r]), np.flatnonzero(ok[r])
                all_ids, all_scores = np.append(best[i, j][0], found[new]), np.append(best[i, j][1], score[r, new])
                top = np.lexsort((all_ids, -all_scores))[:k]
                best[i, j] = all_ids[top], all_scores[top]
                if len(top) == k:
                    needed[i, j] = all_scores[top[-1]]
    for (i, j), (found, scores) in best.items():
        if len(found):
            yield i, j, found, scores


@dataclass
class Clusters:
    """Centres by vector length, and the largest angle between a centre and its anchors."""

    centres: dict[int, np.ndarray]
    radii: dict[tuple[int, int], float]

    def of(self, size: int, cluster: int) -> tuple[np.ndarray, float]:
        """Without a centre (lengths that the sample lacks) only the vectors' lengths bound
        a score."""
        if size not in self.centres:
            return np.zeros(size), np.pi
        return self.centres[size][cluster], self.radii[size, cluster] + 1e-7


def _assigned(anchors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Adds cluster and angle to each anchor."""
    shared = anchors.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = np.asarray(whole.column(2).value_lengths())
            for size in np.unique(sizes):
                batch = whole.filter(pa.array(sizes == size))
                cluster, angle = np.zeros(len(batch), np.int32), np.zeros(len(batch))
                if size in shared.value:
                    x, length = _directions(_rows(batch.column(2), int(size)))
                    near = x @ shared.value[size].T
                    cluster = np.argmax(near, axis=1).astype(np.int32)
                    angle = np.where(length > 0, np.arccos(np.clip(near.max(axis=1), -1, 1)), 0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster), pa.array(angle)], names=["id", "label", "vector", "cluster", "angle"])

    return anchors.mapInArrow(run, "id bigint, label bigint, vector array<bigint>, cluster int, angle double")


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return matrix(column) if size else np.zeros((len(column), 0), np.int64)


def _walk(tasks: DataFrame, clusters: Clusters, same: bool, k: int) -> DataFrame:
    """Candidates and anchors as ``tasks`` has them, sorted by (shard, size, is_anchor,
    cluster): each shard's candidates are loaded once, its anchors pass by in blocks."""
    shared = tasks.sparkSession.sparkContext.broadcast(clusters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Clusters = shared.value
        at, pending, shard, block = None, [], None, []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block
            if block and shard is not None:
                parts = list(zip(*[parts for _, parts in block]))
                ids, labels, vectors, tags, scores, low, high = (np.concatenate(p) for p in parts)
                size, cluster = at[1], block[0][0]
                shard.sort_for(cluster, *known.of(size, cluster))
                out: list[list[np.ndarray]] = [[], [], [], [], []]
                for begin in range(0, len(ids), TOGETHER):
                    own = slice(begin, begin + TOGETHER)
                    for i, j, found, got in best_of_shard(shard, ids[own], labels[own], vectors[own], same, low[own], high[own], k):
                        n = len(found)
                        for column, values in zip(out, (np.full(n, ids[own][i]), np.full(n, tags[own][i, j]), np.full(n, scores[own][i, j]), found, got)):
                            column.append(values)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["anchor_id", "tag", "tag_score", "id", "score"])
            block = []

        for batch in batches:
            keys = [np.asarray(batch.column(c)).astype(np.int64) for c in ("shard", "size", "is_anchor", "cluster")]
            code = np.stack(keys, axis=1)
            cuts = np.flatnonzero((code[1:] != code[:-1]).any(axis=1)) + 1
            for part, first in zip(np.split(np.arange(len(code)), cuts), [0, *cuts]):
                if not len(part):
                    continue
                own, size, is_anchor, cluster = (int(x) for x in code[first])
                if at != (own, size):
                    yield from flush()
                    at, pending, shard = (own, size), [], None
                rows = batch.slice(int(first), len(part))
                ids, labels = (np.asarray(rows.column(c)) for c in ("id", "label"))
                vectors = _rows(rows.column("vector"), size)
                if not is_anchor:
                    pending.append((ids, labels, vectors))
                    continue
                if shard is None and pending:
                    shard, pending = Shard(*(np.concatenate(c) for c in zip(*pending))), []
                if block and (block[0][0] != cluster or sum(len(p[0]) for _, p in block) >= TOGETHER):
                    yield from flush()
                block.append((cluster, (ids, labels, vectors, *(matrix(rows.column(c)) for c in ("tags", "tag_scores", "low", "high")))))
        yield from flush()

    found = tasks.repartition("shard").sortWithinPartitions("shard", "size", "is_anchor", "cluster")
    return found.mapInArrow(run, "anchor_id bigint, tag bigint, tag_score bigint, id bigint, score bigint")


def _floor_percent(percent: int, score: str) -> Column:
    """floor(percent * score / 100) in whole numbers, without a product beyond the score."""
    rest = f"pmod({score}, 100)"
    return F.expr(f"({score} - {rest}) div 100 * {percent} + ({percent} * {rest} - pmod({percent} * {rest}, 100)) div 100")


def hard_negatives(
    df: DataFrame,
    every: int,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. A score is the inner product
    of floor(256 * x) of the components, in whole numbers; higher scores come first, ties
    by the smaller id. An anchor's positives are its first ``positives`` other rows of its
    label (whole numbers). For each of them the first ``negatives`` rows of other labels
    with a score from ``least`` to ``most`` percent of the positive's are returned.

    Rows without an id or label, and null vectors or those with a null or non-finite
    component, take no part; zero vectors do. Only vectors of equal length are compared;
    empty ones score 0 among themselves. A repeated id stands for one row, the one with
    the smallest label, then vector. An anchor without positives, and an empty table, give
    no rows. Numbers whose products do not fit a bigint raise an error.

    Candidates are dealt by hash to shards of some 4 million components (fewer where that
    leaves cores without work), and every
    anchor is sent to each shard: with one row in a hundred an anchor, far fewer rows than
    the candidates would be. In a shard the anchors of one cluster share one candidate
    list, sorted once by an angular bound, and walk it until the bound proves that nothing
    further can count. Centres come from a sample of some 4096 anchors, whatever the size;
    they change the order of the lists, never a result.
    """
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    usable = F.col(f"`{id}`").isNotNull() & F.col(f"`{label}`").isNotNull() & F.coalesce(finite, F.lit(False))
    rows = df.where(usable).select(F.col(f"`{id}`").cast("bigint").alias("id"), F.struct(F.col(f"`{label}`").cast("bigint").alias("label"), integer_vectors(vector).alias("vector")).alias("row"))
    base = staged(rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.vector", F.size("row.vector").alias("size")), "vectors")
    chosen = base.where(F.pmod("id", F.lit(every)) == 0).select("id", "label", "vector")
    counts = base.agg(F.sum("size").cast("bigint").alias("numbers"), F.count_if(F.pmod("id", F.lit(every)) == 0).alias("anchors")).first()
    some = F.pmod(F.xxhash64("id"), F.lit(2**31)) < int(min(1, SAMPLE / max(1, counts["anchors"])) * 2**31)
    by_size: dict[int, list] = {}
    for one in chosen.where(some).select("vector").toArrow().column(0).to_pylist():
        by_size.setdefault(len(one), []).append(one)
    centres = {size: fit_centres(np.array(some)) for size, some in by_size.items() if size}
    anchors = staged(_assigned(chosen, centres).withColumn("size", F.size("vector")), "anchors")
    spread = anchors.where(F.col("size").isin([*centres])).groupBy("size", "cluster").agg(F.max("angle").alias("angle"))
    clusters = Clusters(centres, {(r["size"], r["cluster"]): r["angle"] for r in spread.collect()})
    total = counts["numbers"] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    shards = max(1, ceil(total / SHARD_NUMBERS), min(cores, ceil(total / LEAST_SHARD_NUMBERS)))
    none = F.lit(None).cast("array<bigint>")
    candidates = base.select(
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "size", F.lit(0).alias("is_anchor"), F.lit(0).alias("cluster"),
        "id", "label", "vector", none.alias("tags"), none.alias("tag_scores"), none.alias("low"), none.alias("high"),
    )

    def searched(asked: DataFrame, same: bool, k: int) -> DataFrame:
        everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
        sent = asked.select(everywhere, "size", F.lit(1).alias("is_anchor"), "cluster", "id", "label", "vector", "tags", "tag_scores", "low", "high")
        best = _walk(candidates.unionByName(sent), clusters, same, k)
        first = Window.partitionBy("anchor_id", "tag").orderBy(F.desc("score"), "id")
        return best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)

    one = lambda value: F.array(F.lit(value).cast("bigint"))
    anyone = anchors.select("*", one(0).alias("tags"), one(0).alias("tag_scores"), one(-(2**63)).alias("low"), one(2**63 - 1).alias("high"))
    of_label = staged(searched(anyone, True, positives).select("anchor_id", "rank", F.col("id").alias("tag"), F.col("score").alias("tag_score")), "positives")
    bounds = of_label.select("*", (-_floor_percent(-least, "tag_score")).alias("low"), _floor_percent(most, "tag_score").alias("high"))
    lists = bounds.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "tag", "tag_score", "low", "high"))).alias("p"))
    padded = lambda name, fill: F.concat(F.col(f"p.{name}"), F.array_repeat(F.lit(fill).cast("bigint"), F.lit(positives) - F.size("p")))
    limits = lists.select(F.col("anchor_id").alias("id"), padded("tag", 0).alias("tags"), padded("tag_score", 0).alias("tag_scores"), padded("low", 2**63 - 1).alias("low"), padded("high", -(2**63)).alias("high"))
    found = staged(searched(anchors.join(limits, "id"), False, negatives), "negatives")
    discard(base, anchors, of_label)
    return found.select(
        "anchor_id", F.col("tag").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("tag_score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
