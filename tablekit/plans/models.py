"""Wide models: one row per fact, dimension columns joined on from the left."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablekit.functions.columns import fold_case, quoted
from tablekit.operators.joins import is_broadcastable, left_join
from tablekit.plans.specs import CUSTOMER, FILM, INVENTORY, RENTAL, RENTAL_STORE_SPECS, STORE
from tablekit.sinks.tables import TableSink
from tablekit.sources.catalog import load_table

FILM_COLUMNS = (
    "title",
    "release_year",
    "rental_duration",
    "rental_rate",
    "duration_minutes",
    "replacement_cost",
    "rating",
    "special_features",
)
INVENTORY_MODEL_COLUMNS = ("inventory_id", "store_id", "film_id", *FILM_COLUMNS)
RENTAL_MODEL_COLUMNS = (
    "rental_id",
    "inventory_id",
    "customer_id",
    "staff_id",
    "store_id",
    "film_id",
    "rental_date",
    "return_date",
    "full_name",
    "email",
    "active",
    "create_date",
    *FILM_COLUMNS,
)


def inventory_model(inventory: DataFrame, store: DataFrame, film: DataFrame) -> DataFrame:
    """Inventory with its film. The store adds no column; several store rows with
    one id still repeat the inventory row."""
    items = with_columns(inventory, INVENTORY.columns)
    stores = with_columns(store, STORE.columns)
    return left_join(left_join(items, stores, "store_id"), _films(film), "film_id").select(
        *INVENTORY_MODEL_COLUMNS
    )


def rental_model(
    rental: DataFrame, customer: DataFrame, inventory: DataFrame, film: DataFrame
) -> DataFrame:
    """Rentals with their customer, inventory item and that item's film.

    The film key belongs to the inventory, so a film may be joined to the inventory
    before or after the rentals, and the other two joins may swap, with the same
    result. The rentals are by far the largest table, and the order keeps what they
    carry through a shuffle small: sides to be broadcast come last, since they need
    none; a film table too large for that joins the smaller inventory.
    """
    rentals = with_columns(rental, RENTAL.columns)
    items = with_columns(inventory, INVENTORY.columns)
    customers, films = _customers(customer), _films(film)
    if is_broadcastable(films):
        wide = left_join(rentals, items, "inventory_id")
        wide = left_join(left_join(wide, customers, "customer_id"), films, "film_id")
    else:
        sides = [(customers, "customer_id"), (left_join(items, films, "film_id"), "inventory_id")]
        if is_broadcastable(customers):
            sides.reverse()
        wide = reduce(lambda left, side: left_join(left, *side), sides, rentals)
    return wide.select(*RENTAL_MODEL_COLUMNS)


def _films(film: DataFrame) -> DataFrame:
    return with_columns(film, FILM.columns).withColumnRenamed("length", "duration_minutes")


def _customers(customer: DataFrame) -> DataFrame:
    people = with_columns(customer, CUSTOMER.columns)
    return people.select(
        "customer_id",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "email",
        "active",
        "create_date",
    )


def full_name(first: Column, last: Column) -> Column:
    """Both names with a space between, null if either is."""
    return F.concat(first, F.lit(" "), last)


def with_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Just ``columns`` of ``df``; those it lacks as nulls of the given type."""
    spark = df.sparkSession
    present = {fold_case(spark, c): c for c in df.columns}
    found = {c: present.get(fold_case(spark, c)) for c in columns}
    return df.select(
        *[(quoted(found[c]) if found[c] else F.lit(None).cast(t)).alias(c) for c, t in columns.items()]
    )


def build_models(
    spark: SparkSession,
    database: str,
    base_path: str,
    mode: str = "append",
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Load the cleaned tables as views and store both models next to them.

    ``partition_by`` names partition columns per model. Unlike the table run this stops
    at the first error.
    """
    tables = {name: load_table(spark, database, name) for name in RENTAL_STORE_SPECS}
    models = {
        "inventory_model": inventory_model(tables["inventory"], tables["store"], tables["film"]),
        "rental_model": rental_model(
            tables["rental"], tables["customer"], tables["inventory"], tables["film"]
        ),
    }
    sink = TableSink(spark, database, base_path)
    for name, model in models.items():
        sink.save(model, name, (partition_by or {}).get(name, ()), mode)
    return {name: spark.table(sink.name(name)) for name in models}
