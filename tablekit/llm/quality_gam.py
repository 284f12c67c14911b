"""A quality classifier: a generalised additive model with pairwise interactions.

log-odds = intercept + one table value per feature + one per chosen pair of features. The
tables are learnt by cyclic boosting: in turn, each feature gets a shallow tree on the
current residuals, shrunken and added to its table; then pairs do, on a coarser grid.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.chunks import empty_store
from tablekit.llm.common import bounded_batches, free_name
from tablekit.llm.features import NAMES, features

MOST_TRAINING_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 64, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
_LEAST_HESSIAN, _RIDGE = 3.0, 1.0


@dataclass
class Gam:
    """``cuts``: per feature the upper ends of its bins but the last; ``tables``: per
    feature the value of each bin; ``pairs``: (i, j, grid of values)."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(self.cuts)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row: one table lookup and addition per term."""
        at = self.bins(x)
        total = np.full(len(x), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[at[:, i]]
        for i, j, grid in self.pairs:
            total += grid[_coarse(at[:, i], len(self.tables[i])), _coarse(at[:, j], len(self.tables[j]))]
        return 1 / (1 + np.exp(-total))


def _coarse(at: np.ndarray, bins: int) -> np.ndarray:
    return at * PAIR_BINS // max(bins, 1)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place (first bin of the right part) of the best cut; gain 0 if there is none."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + _RIDGE) + gr**2 / (hr + _RIDGE) - g.sum() ** 2 / (h.sum() + _RIDGE)
    gain = np.where((hl >= _LEAST_HESSIAN) & (hr >= _LEAST_HESSIAN), gain, 0.0)
    if not len(gain):
        return 0.0, 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf value of each bin of a tree over one feature, cut at most ``depth`` deep."""
    gain, at = _best_cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + _RIDGE))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts one axis once, and each side once
    along the other axis."""
    best = (0.0, np.full(g.shape, g.sum() / (h.sum() + _RIDGE)))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for at in range(1, len(a)):
            values, score = [], 0.0
            for part in (slice(None, at), slice(at, None)):
                gs, hs = a[part].sum(axis=0), b[part].sum(axis=0)
                gain, _ = _best_cut(gs, hs)
                score += gain + gs.sum() ** 2 / (hs.sum() + _RIDGE)
                values.append(np.broadcast_to(_tree(gs, hs, 1), a[part].shape))
            score -= g.sum() ** 2 / (h.sum() + _RIDGE)
            if score > best[0] + 1e-12:
                grid = np.concatenate(values)
                best = (score, grid.T if flip else grid)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Learn from features and 0/1 labels. With no rows every text scores 0.5; with one
    label only, near that label. Columns without variation get a single bin."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Gam(float(np.log(rate / (1 - rate))), [], [], [])
    for i in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0)
        cuts = cuts[cuts < x[:, i].max()] if len(cuts) else cuts
        model.cuts.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
    if len(np.unique(y)) < 2:
        return model
    at = model.bins(x)
    total = np.full(len(x), model.intercept)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, table in enumerate(model.tables):
            if len(table) > 1:
                g, h = residuals()
                step = RATE * _tree(np.bincount(at[:, i], g, len(table)), np.bincount(at[:, i], h, len(table)), 2)
                table += step
                total += step[at[:, i]]
    coarse = np.stack([_coarse(at[:, i], len(t)) for i, t in enumerate(model.tables)], axis=1)

    def histograms(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = residuals()
        cell, size = coarse[:, i] * PAIR_BINS + coarse[:, j], PAIR_BINS**2
        return np.bincount(cell, g, size).reshape(PAIR_BINS, -1), np.bincount(cell, h, size).reshape(PAIR_BINS, -1)

    gains = [(_pair_tree(*histograms(i, j))[0], i, j) for i in range(x.shape[1]) for j in range(i)]
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for gain, i, j in sorted(gains, reverse=True)[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, grid in model.pairs:
            step = RATE * _pair_tree(*histograms(i, j))[1]
            grid += step
            total += step[coarse[:, i], coarse[:, j]]
    return model


def train(df: DataFrame, label: str, text: str = "text", key: str = "doc_id", most: int = MOST_TRAINING_ROWS) -> Gam:
    """Fit on rows whose ``label`` is 0 or 1, whole texts. Beyond about ``most`` rows those
    with the smallest hash of ``key`` are taken, so the driver gets at most some ``most``
    rows of 18 numbers; that bound does not depend on the size of the corpus."""
    labelled = df.where(F.col(f"`{label}`").isin(0, 1)).select(F.col(f"`{key}`").cast("string").alias("k"), F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{label}`").cast("int").alias("y"))
    there = labelled.count()
    if there > most:
        share = int(most / there * 2**31)
        labelled = labelled.where(F.pmod(F.xxhash64("k"), F.lit(2**31)) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.float64()))], names=["k", "y", "x"])

    with bounded_batches(df.sparkSession):
        rows = labelled.mapInArrow(run, "k string, y int, x array<double>").toArrow().to_pydict()
    order = sorted(range(len(rows["y"])), key=lambda i: (rows["k"][i] or "", rows["y"][i], rows["x"][i]))
    x = np.array([rows["x"][i] for i in order]).reshape(len(order), len(NAMES))
    return fit(x, np.array([rows["y"][i] for i in order], float))


def score(df: DataFrame, model: Gam, text: str = "text", wanted: str = "score") -> DataFrame:
    """All columns of ``df`` and the probability of label 1 of each whole text, from 0 to
    1. Null and empty texts get the score of a text without words. Where ``wanted`` is
    taken, the new column gets underscores after its name."""
    name = free_name(df.columns, wanted)
    place = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast((model.intercept, model.cuts, model.tables, model.pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_store()
        known = Gam(*shared.value)
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(place)]).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(known.scores(x))], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema)
