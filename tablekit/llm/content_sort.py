"""Exact copies of texts, found by sorting the texts themselves."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.llm.common import discard, free_name, staged

# A text is cut into slices if it has more than a partition's share of a sample of so
# many rows for each partition.
SAMPLE_PER_PARTITION = 40
LEAST_SAMPLE = 100_000
START = 32  # characters of a text that go into the splitters


def normalised(text: str) -> Column:
    """The text with one space for each run of white space (ASCII); null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _hot_texts(hashes: DataFrame, partitions: int) -> DataFrame:
    """Hashes of texts with more than a partition's share of a sample of all rows.

    By that rule there are no more of them than partitions, at 8 bytes each: small enough
    to broadcast whatever the input. A text missed here costs time, never a result.
    """
    rows = hashes.count()
    share = min(1.0, max(LEAST_SAMPLE, SAMPLE_PER_PARTITION * partitions) / max(1, rows))
    some = hashes.sample(share, 13) if share < 1 else hashes
    least = max(2, ceil(share * rows / partitions))
    return some.groupBy("hash").count().where(F.col("count") >= least).select(F.col("hash").alias("hot"))


def exact_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row, with keep_id, group_size, kept and text_sha256.

    Texts are equal if they are the same after each run of ASCII white space became one
    space; null counts as empty. Of equal texts the row with the smallest id stays:
    ``keep_id`` is that id, ``group_size`` the number of rows with the text. Exactly one
    row of a group is kept, also if rows repeat an id; null ids come last, so a group
    without any other has a null keep_id. Names already taken get underscores after
    them. An empty table gives an empty result.

    Rows are range-partitioned and sorted by the text: its first characters, a hash of the
    whole, then the whole. So equal texts stand next to each other and a window compares
    each with its neighbour in full; the splitters that Spark samples, and sends to the
    driver, hold the first two only, some 60 bytes each however long texts are. A text
    that a sample finds in more than a partition's share of the rows is cut into as many
    slices as there are partitions, by a hash of the id; each slice is sorted and compared
    in the same way, and then, once more, the first rows of the slices.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{id}`").alias("id"), normalised(text).alias("norm"))
    rows = rows.select("*", F.left("norm", F.lit(START)).alias("start"), F.xxhash64("norm").alias("hash"))
    hot = staged(_hot_texts(rows.select("hash"), partitions), "hot_texts")
    any_hot = not hot.isEmpty()
    if any_hot:
        cut = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(partitions)).cast("int") + 1).otherwise(0)
        rows = rows.join(F.broadcast(hot), F.col("hash") == F.col("hot"), "left").withColumn("slice", cut)
    else:
        discard(hot)
        rows = rows.withColumn("slice", F.lit(0))
    ranges = ["start", "hash", *(["slice"] if any_hot else [])]  # a constant would spoil the match
    in_order = Window.partitionBy(*ranges, "norm").orderBy(F.col("id").asc_nulls_last())
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, first, n = F.row_number().over(in_order), F.first("id").over(whole), F.count("*").over(whole)
    placed = rows.repartitionByRange(*ranges).select("row", "id", "slice", "norm", place.alias("place"), first.alias("first"), n.alias("n"))
    names = [free_name(keep, name) for name in ("keep_id", "group_size", "kept", "text_sha256")]
    sha, leads = F.sha2("norm", 256), F.col("place") == 1
    if not any_hot:
        return placed.select("row.*", F.col("first").alias(names[0]), F.col("n").alias(names[1]), leads.alias(names[2]), sha.alias(names[3]))

    head = F.when((F.col("slice") > 0) & leads, F.col("norm")).alias("head")
    sorted_rows = staged(placed.select("row", "id", "slice", "place", "first", "n", sha.alias("sha"), head), "sorted_texts")
    discard(hot)
    heads = sorted_rows.where(F.col("head").isNotNull()).withColumn("hash", F.xxhash64("head")).repartitionByRange("hash")
    one_text = Window.partitionBy("hash", "head").orderBy(F.col("first").asc_nulls_last())
    all_of_it = one_text.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = heads.select("sha", F.row_number().over(one_text).alias("k"), F.first("first").over(all_of_it).alias("keep"), F.sum("n").over(all_of_it).alias("total"))
    # one row for each hot text, of which there are no more than partitions
    groups = staged(total.where("k = 1").select("sha", "keep", "total"), "hot_groups")
    joined = sorted_rows.join(F.broadcast(groups), "sha", "left")
    sliced = F.col("total").isNotNull()
    keep_id = F.when(sliced, F.col("keep")).otherwise(F.col("first"))
    return joined.select(
        "row.*",
        keep_id.alias(names[0]),
        F.coalesce("total", "n").alias(names[1]),
        (leads & F.col("id").eqNullSafe(keep_id)).alias(names[2]),
        F.col("sha").alias(names[3]),
    )
