from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from conftest import SF_DIR
from plans import estimated_bytes, final_plan
from verification.fixtures import raw_table
from tablekit.operators import is_broadcastable, left_join
from tablekit.plans import RENTAL_STORE_SPECS, clean, inventory_model, rental_model
from tablekit.plans.models import INVENTORY_MODEL_COLUMNS, RENTAL_MODEL_COLUMNS


def valid(spark, name):
    return clean(raw_table(spark, SF_DIR, name), RENTAL_STORE_SPECS[name]).valid


@pytest.fixture(scope="module")
def tables(spark):
    return {name: valid(spark, name) for name in RENTAL_STORE_SPECS}


def model_of(tables):
    return rental_model(tables["rental"], tables["customer"], tables["inventory"], tables["film"])


def joins_in(plan: str) -> int:
    return plan.count("SortMergeJoin")


def test_left_join_repeats_keeps_and_blanks(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, r string")
    joined = sorted(left_join(left, right, "k").collect(), key=str)
    assert joined == sorted([(1, "a", "x"), (1, "a", "y"), (2, "b", None), (None, "c", None)], key=str)


def test_text_and_number_keys_meet_as_numbers(spark):
    left = spark.createDataFrame([("1",), ("2.0",), ("x",), (None,)], "k string")
    right = spark.createDataFrame([(1, "one"), (2, "two")], "k bigint, r string")
    assert {tuple(r) for r in left_join(left, right, "k").collect()} == {
        ("1", "one"),
        ("2.0", "two"),
        ("x", None),
        (None, None),
    }
    assert left_join(right, left.withColumn("t", F.lit(1)), "k").count() == 2


def test_models_have_one_row_per_fact_and_the_declared_columns(tables):
    items = inventory_model(tables["inventory"], tables["store"], tables["film"])
    rentals = model_of(tables)
    assert items.columns == list(INVENTORY_MODEL_COLUMNS)
    assert rentals.columns == list(RENTAL_MODEL_COLUMNS)
    assert items.count() == tables["inventory"].count()
    assert rentals.count() == tables["rental"].count()


def test_every_join_order_gives_the_same_rental_model(spark, conf, tables):
    small = model_of(tables)
    assert joins_in(final_plan(small)) == 0
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    large = model_of(tables)
    assert joins_in(final_plan(large)) == 3
    assert not is_broadcastable(tables["film"])
    assert large.exceptAll(small).count() == 0 and small.exceptAll(large).count() == 0


def test_only_the_inventory_join_shuffles_rentals_when_just_films_are_large(spark, conf, tables):
    """Customers, small enough to broadcast, come after the one sort-merge join of the
    rentals; films, too large, were joined to the inventory before it."""
    copies = [tables["film"].withColumn("film_id", F.col("film_id") + 10**6 * i) for i in range(8)]
    films = reduce(DataFrame.unionAll, copies)
    limit = max(estimated_bytes(valid(spark, "customer")), estimated_bytes(tables["film"]))
    conf("spark.sql.autoBroadcastJoinThreshold", str(limit))
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert is_broadcastable(tables["customer"]) and not is_broadcastable(films)
    model = rental_model(tables["rental"], tables["customer"], tables["inventory"], films)
    plan = final_plan(model)
    assert plan.index("BroadcastHashJoin [customer_id") < plan.index("SortMergeJoin [inventory_id")
    assert plan.index("SortMergeJoin [inventory_id") < plan.index("SortMergeJoin [film_id")
    expected = model_of(tables)
    assert model.exceptAll(expected).count() == 0 and expected.exceptAll(model).count() == 0


def test_missing_dimension_columns_become_typed_nulls(spark, tables):
    film = tables["film"].drop("special_features", "length")
    model = inventory_model(tables["inventory"], tables["store"], film)
    assert dict(model.dtypes)["special_features"] == "string"
    assert dict(model.dtypes)["duration_minutes"] == "bigint"
    assert model.where(F.col("special_features").isNotNull()).count() == 0


def test_column_case_does_not_matter_to_models(tables):
    film = tables["film"].withColumnRenamed("title", "Title").withColumnRenamed("film_id", "FILM_ID")
    model = inventory_model(tables["inventory"], tables["store"], film)
    expected = inventory_model(tables["inventory"], tables["store"], tables["film"])
    assert model.exceptAll(expected).count() == 0 and model.columns == expected.columns


def test_duplicate_stores_repeat_inventory_rows(tables):
    twice = tables["store"].unionAll(tables["store"])
    items = inventory_model(tables["inventory"], tables["store"], tables["film"])
    doubled = inventory_model(tables["inventory"], twice, tables["film"])
    matched = left_join(
        tables["inventory"].select("store_id"), tables["store"].select("store_id", F.lit(1).alias("hit")), "store_id"
    )
    assert doubled.count() == items.count() + matched.where("hit = 1").count()


@pytest.mark.parametrize("hot", [7, None])
def test_hot_key_is_split(spark, conf, hot):
    """A third of the rows on one key, or without one: AQE splits that partition."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    key = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("bigint")).otherwise(F.col("id") % 1000)
    facts = spark.range(0, 90_000, 1, 8).select("id", key.alias("k"))
    dims = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("d"), "id").alias("name"))
    joined = left_join(facts, dims, "k")
    assert "skew=true" in final_plan(joined)
    named = joined.where("name = 'd7'" if hot else "name IS NULL")
    assert joined.count() == 90_000 and named.count() >= 30_000
