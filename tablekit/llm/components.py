"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import discard, staged


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has bigint columns a, b. Returns (id, component), one row per id in a
    link, with component the smallest id reachable.

    Each round every node points at its smallest neighbour, pointers are followed once
    more, and the links are carried over to what their ends point at. Links only shrink,
    a path at least halves, and the minimum per node is combined before it is shuffled,
    so a node with very many links is no hot spot. Every round is written to the shared
    folder; nothing is collected.
    """
    pairs = staged(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while True:
        ends = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = ends.groupBy("a").agg(F.min("b").alias("b"))
        step = staged(nearest.select(F.col("a").alias("id"), F.least("a", "b").alias("parent")), "pointers")
        onward = step.select(F.col("id").alias("parent"), F.col("parent").alias("onward"))
        jump = staged(step.join(onward, "parent").select("id", F.col("onward").alias("root")), "pointers")
        if labels is None:
            moved = jump.select("id", F.col("root").alias("component"))
        else:
            to = jump.select(F.col("id").alias("component"), "root")
            moved = labels.join(to, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
        new_labels = staged(moved, "labels")
        at_a = jump.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        at_b = jump.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        carried = pairs.join(at_a, "a").join(at_b, "b").where("ra <> rb")
        carried = carried.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        new_pairs = staged(carried, "links")
        discard(pairs, step, jump, *([labels] if labels is not None else []))
        pairs, labels = new_pairs, new_labels
        if pairs.isEmpty():
            discard(pairs)
            return labels
