"""Sharding along a Hilbert curve through quantised metadata, in SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import free_name, staged

BITS = 5  # of each dimension: with three of them at most 32,768 cells
GROUP_ROWS, MOST_GROUPS = 256, 8192


def quantised(df: DataFrame, value: Column, levels: int = 1 << BITS) -> Column:
    """A text or number as one of ``levels`` numbers in the order of its values, so that
    a range of values is a range of numbers and minima and maxima prune files.

    Up to ``levels`` distinct values each have a number of their own, spread over all.
    More of them are cut at quantiles over all rows: numbers as they are, texts by their
    first seven bytes. Null comes first.
    """
    found = df.select(value.alias("v")).distinct().limit(levels + 1).collect()
    values = sorted(r["v"] for r in found if r["v"] is not None)
    if len(found) <= levels:
        below = F.size(F.filter(F.array(*map(F.lit, values)), lambda cut: cut <= value)) if values else F.lit(0)
        return F.floor(F.coalesce(below - int(len(values) == len(found)), F.lit(0)) * levels / max(1, len(found))).cast("int")
    number = value if not isinstance(values[0], str) else _leading_bytes(value)
    shares = [i / levels for i in range(1, levels)]
    cuts = df.agg(F.percentile_approx(number, shares, 10_000).alias("cuts")).first()["cuts"]
    below = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= number))
    return F.coalesce(F.when(value.isNotNull(), below), F.lit(0)).cast("int")


def _leading_bytes(text: Column) -> Column:
    """The first seven bytes of a text as a number of the same order."""
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), F.lit(1), F.lit(7))), 14, "0"), 16, 10).cast("bigint")


def hilbert_index(dimensions: Sequence[Column], bits: int = BITS) -> Column:
    """Place of a cell on the Hilbert curve, as a bigint.

    The cell's bits are taken plane by plane from the top. Within a plane the bits of
    all dimensions, seen from the current corner and direction of the curve, are the
    Gray code of the next digit; that digit decides corner and direction of the next.
    """
    n = len(dimensions)
    top = F.lit((1 << n) - 1).cast("bigint")
    one = F.lit(1).cast("bigint")

    def rotated_right(x: Column, by: Column) -> Column:
        return _right(x, by).bitwiseOR(_left(x, n - by)).bitwiseAND(top)

    def rotated_left(x: Column, by: Column) -> Column:
        return rotated_right(x, F.pmod(n - by, F.lit(n)))

    def step(state: Column, plane: Column) -> Column:
        label = sum(((_right(d.cast("bigint"), plane).bitwiseAND(one)) * (1 << i) for i, d in enumerate(dimensions)), F.lit(0).cast("bigint"))
        seen = rotated_right(label.bitwiseXOR(state["corner"]), F.pmod(state["turn"] + 1, F.lit(n)))
        digit = F.aggregate(F.sequence(F.lit(1), F.lit(n)), seen, lambda d, i: d.bitwiseXOR(_right(seen, i)))
        even = F.when(digit == 0, F.lit(0).cast("bigint")).otherwise((digit - 1 - F.pmod(digit - 1, F.lit(2))))
        corner = even.bitwiseXOR(_right(even, F.lit(1)))
        odd = F.when(digit == 0, F.lit(0).cast("bigint")).otherwise(F.when(digit % 2 == 0, digit - 1).otherwise(digit))
        ones = F.aggregate(F.sequence(F.lit(0), F.lit(n)), F.lit(0), lambda c, i: F.when((c == i) & (_right(odd, i).bitwiseAND(one) == 1), c + 1).otherwise(c))
        return F.struct(
            (state["index"] * (1 << n) + digit).alias("index"),
            state["corner"].bitwiseXOR(rotated_left(corner, F.pmod(state["turn"] + 1, F.lit(n)))).alias("corner"),
            F.pmod(state["turn"] + F.pmod(ones, F.lit(n)) + 1, F.lit(n)).cast("int").alias("turn"),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("index"), F.lit(0).cast("bigint").alias("corner"), F.lit(0).alias("turn"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), zero, step, lambda s: s["index"])


def _right(x: Column, by: Column) -> Column:
    return F.call_function("shiftright", x, by.cast("int"))


def _left(x: Column, by: Column) -> Column:
    return F.call_function("shiftleft", x, by.cast("int"))


def hilbert_shards(df: DataFrame, dimensions: Sequence[Column], order: Sequence[Column], shards: int) -> DataFrame:
    """All columns of ``df`` with shard and slot: ``df`` in the order of its cells on the
    curve, cut into ``shards`` runs whose row counts differ by one at most; slot counts
    from 0 within a shard. ``dimensions`` are numbers of 0 to 31, as ``quantised`` gives
    them; rows of one cell are
    in the order of a hash of ``order``, then of ``order`` itself, and rows equal in all
    of it are interchangeable. Names already taken get underscores after them.

    A row's place is the number of rows in earlier cells, in earlier groups of its cell,
    and before it in its group. Cells are split by hash into groups of some 256 rows, at
    most 8192, so a cell that holds a third of all rows is no hot spot. Cells are few
    (32,768 for three dimensions), whatever the input; they are joined by broadcast.
    """
    cell = [f"__q{i}" for i in range(len(dimensions))]
    rows = staged(df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("given"), F.struct(*order).alias("by"), *(d.alias(c) for d, c in zip(dimensions, cell))), "rows")
    cells = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    curve = Window.orderBy("index")
    cells = cells.withColumn("index", hilbert_index([F.col(c) for c in cell]))
    cells = cells.withColumn("before", F.sum("n").over(curve.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n"))
    cells = staged(cells.withColumn("groups", F.least(F.lit(MOST_GROUPS), F.ceil(F.col("n") / GROUP_ROWS)).cast("int")), "cells")
    hash_of = F.xxhash64("by")
    placed = rows.join(F.broadcast(cells.drop("n")), cell).withColumn("group", F.pmod(hash_of, F.col("groups")).cast("int"))
    groups = placed.groupBy("index", "before", "group").agg(F.count("*").alias("n"))
    within = Window.partitionBy("index").orderBy("group").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = groups.select("index", "group", (F.col("before") + F.sum("n").over(within) - F.col("n")).alias("start"))
    total = rows.count()
    numbered = placed.withColumn("nth", F.row_number().over(Window.partitionBy("index", "group").orderBy("by")) - 1)
    place = (F.col("start") + F.col("nth")).alias("place")
    ranked = numbered.join(starts, ["index", "group"]).select("given", place)
    rows_there = max(total, 1)
    shard = F.expr(f"CAST(place * {shards} DIV {rows_there} AS INT)")
    first = F.expr(f"(CAST(__shard AS BIGINT) * {rows_there} + {shards - 1}) DIV {shards}")
    names = [free_name(df.columns, "shard"), free_name(df.columns, "slot")]
    return ranked.withColumn("__shard", shard).select("given.*", F.col("__shard").alias(names[0]), (F.col("place") - first).alias(names[1]))
