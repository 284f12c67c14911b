"""Temperature mixing of sources, realised as budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import discard, free_name, staged

TOKEN_BYTES = 4
BLOCK_ROWS = 256
LEVELS, ROUNDS = 5, 8  # bisection steps asked for in one job, and jobs


def estimated_tokens(text: str = "text") -> Column:
    """Tokens of a text, at one per started 4 bytes of UTF-8; none for null."""
    return F.coalesce(F.ceil(F.octet_length(F.col(f"`{text}`").cast("string")) / TOKEN_BYTES), F.lit(0)).cast("bigint")


def permutation_key(id: str = "doc_id", seed: int = 0) -> Column:
    """Place of a row in its source's permutation; rows of one id share it."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))).cast("binary"))


def _sums(totals: DataFrame, total: int, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent a: sum of p^a, and of p^a ln p, over the sources' shares p."""
    p = F.col("tokens") / F.lit(float(total))
    rows = totals.where("tokens > 0").select(p.alias("p"), F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    rows = rows.groupBy("a").agg(F.sum(F.pow("p", "a")).alias("z"), F.sum(F.pow("p", "a") * F.log("p")).alias("d"))
    return {r["a"]: (r["z"], r["d"]) for r in rows.collect()}


def _midpoints(lo: float, hi: float, levels: int) -> list[float]:
    if not levels:
        return []
    mid = (lo + hi) / 2
    return [mid, *_midpoints(lo, mid, levels - 1), *_midpoints(mid, hi, levels - 1)]


def _bisect(totals: DataFrame, total: int, low_side) -> float:
    """The exponent in [0, 1] up to which ``low_side(a, z, d)`` holds, by bisection. The
    sums of all midpoints that the next five steps can reach come from one job, so only
    two numbers per midpoint reach the driver, however many sources there are."""
    if low_side(1.0, *_sums(totals, total, [1.0])[1.0]):
        return 1.0
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        sums = _sums(totals, total, _midpoints(lo, hi, LEVELS))
        for _ in range(LEVELS):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if low_side(mid, *sums[mid]) else (lo, mid)
    return (lo + hi) / 2


def mixing_plan(rows: DataFrame, entropy: float, most_repeats: float, budget: int | None = None) -> DataFrame:
    """From rows (source, tokens, place), one row per source: source, tokens, weight,
    passes, cut. A row is taken ``passes`` times, and once more if its place is at most
    ``cut``.

    Weights are p^a, normalised, p being a source's share of the tokens. The exponent a
    is the largest in [0, 1] whose entropy is at least ``entropy`` times that of equal
    weights; it is raised, if need be, until no source is taken more than
    ``most_repeats`` times on average over its tokens. A budget beyond that many times
    all tokens cannot be met and raises ``ValueError``. The budget (default: all tokens there are) times the weight
    is what a source gives: whole passes, and of one more pass the blocks that fit, in
    permuted order, and the rows of the next block that fit.
    """
    totals = staged(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "sources")
    found = totals.agg(F.sum("tokens").alias("t"), F.count_if(F.col("tokens") > 0).alias("k"), F.min(F.expr("if(tokens > 0, tokens, null)")).alias("least")).first()
    total, sources = found["t"] or 0, found["k"]
    budget = total if budget is None else budget
    if total and budget > most_repeats * total:
        raise ValueError(f"a budget of {budget} takes {total} tokens more than {most_repeats} times")
    exponent, norm = 1.0, 1.0
    if total:
        goal, rarest = entropy * math.log(sources), found["least"] / total
        even = _bisect(totals, total, lambda a, z, d: math.log(z) - a * d / z >= goal)
        limit = _bisect(totals, total, lambda a, z, d: rarest ** (a - 1) / z * budget / total > most_repeats)
        exponent = max(even, limit)
        norm = _sums(totals, total, [exponent])[exponent][0]
    p = F.col("tokens") / F.lit(float(max(total, 1)))
    weight = F.when(F.col("tokens") > 0, F.round(F.pow(p, F.lit(exponent)) / F.lit(norm), 9)).otherwise(0.0)
    want = F.floor(F.col("weight") * F.lit(float(budget))).cast("bigint")
    # hexadecimal digits of the place that name a block of some 256 rows
    digits = F.least(F.lit(6), F.greatest(F.lit(0), F.ceil(F.log(F.col("n") / BLOCK_ROWS) / F.log(F.lit(16.0))))).cast("int")
    plan = totals.withColumn("weight", weight).withColumn("want", want)
    plan = plan.withColumn("passes", F.when(F.col("tokens") > 0, F.expr("want div tokens")).otherwise(F.lit(1)).cast("bigint"))
    plan = plan.withColumn("rest", F.greatest(F.lit(0).cast("bigint"), F.col("want") - F.col("passes") * F.col("tokens")))
    plan = staged(plan.withColumn("digits", digits), "plan")

    of = lambda frame: frame.select(F.col("source").alias("s"), "rest", "digits")
    blocked = rows.join(of(plan), F.col("source").eqNullSafe(F.col("s"))).withColumn("block", F.substring("place", F.lit(1), F.col("digits")))
    sums = blocked.groupBy("source", "rest", "block").agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy("source").orderBy("block"))
    edge = sums.withColumn("upto", upto).where("upto > rest").groupBy("source").agg(F.min_by(F.struct("block", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")), "block").alias("edge"))
    edge = staged(edge.select(F.col("source").alias("s"), "edge.*"), "edges")
    inside = blocked.drop("s").join(edge.withColumnRenamed("block", "at"), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("at")))
    so_far = F.sum("tokens").over(Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = inside.withColumn("so_far", so_far).where("so_far <= left").groupBy(F.col("source").alias("s2")).agg(F.max("place").alias("last"))
    cuts = edge.join(last, F.col("s").eqNullSafe(F.col("s2")), "left").select("s", F.coalesce("last", "block").alias("cut"))
    out = plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
    return staged(out.select("source", "tokens", "weight", "passes", F.coalesce("cut", F.lit("")).alias("cut")), "plan")


def mix(df: DataFrame, entropy: float, most_repeats: float, budget: int | None = None, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0, tokens: str | None = None) -> DataFrame:
    """All rows and columns of ``df`` with n_tokens, weight (of the source) and copies
    (how often the mixture takes the row; 0: not at all). ``tokens`` names a column of
    token counts (null: none); without it they are estimated from the text's bytes.

    A null source is a source of its own. Sources without any token have weight 0, and
    their rows are taken once. Rows that repeat an id are taken alike. Names already
    taken get underscores after them. Only ids, sources and token counts are shuffled;
    a row's copies follow from its source's line in the plan.
    """
    names = []
    for wanted in ("n_tokens", "weight", "copies"):
        names.append(free_name([*df.columns, *names], wanted))
    key = F.col(f"`{source}`").cast("string")
    count = estimated_tokens(text) if tokens is None else F.coalesce(F.col(f"`{tokens}`").cast("bigint"), F.lit(0).cast("bigint"))
    rows = staged(df.select(key.alias("source"), count.alias("tokens"), permutation_key(id, seed).alias("place")), "places")
    plan = mixing_plan(rows, entropy, most_repeats, budget).select(F.struct("source", "weight", "passes", "cut").alias("__plan"))
    discard(rows)
    joined = df.join(plan, key.eqNullSafe(F.col("__plan.source")))
    copies = F.col("__plan.passes") + (permutation_key(id, seed) <= F.col("__plan.cut")).cast("bigint")
    made = (count, F.col("__plan.weight"), copies)
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), *(c.alias(n) for c, n in zip(made, names)))
