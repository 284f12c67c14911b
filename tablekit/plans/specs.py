"""Table specs: the rules, model columns and partitioning of every table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, types as T

from tablekit.operators.normalize import normalize
from tablekit.operators.rules import Rule, Split, apply_rules

TIMESTAMP, INTEGER, DOUBLE = T.TimestampType(), T.IntegerType(), T.DoubleType()

# The text stored in the error column of rejected rows.
MESSAGES = {
    TIMESTAMP: "Error en {column}: no es Timestamp válido",
    INTEGER: "Error en {column}: no es entero válido",
    DOUBLE: "Error en {column}: no es Double válido",
}


@dataclass(frozen=True)
class TableSpec:
    """One table.

    ``columns`` are the columns the models read, with the type to assume where a
    load came without them. ``transform`` replaces the standard cleaning with any
    function from a frame to a ``Split``; with neither rules nor transform the
    table is written as it is. ``rebalance`` is passed on to the sink.
    """

    name: str
    rules: tuple[Rule, ...] = ()
    columns: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    transform: Callable[[DataFrame], Split] | None = None
    rebalance: bool | None = None


def typed_rule(column: str, type: T.DataType) -> Rule:
    return Rule(column, type, MESSAGES[type].format(column=column))


def clean(df: DataFrame, spec: TableSpec, watch: Observation | None = None) -> Split:
    """Apply the spec's transform, or its normalisation and rules, to ``df``."""
    if spec.transform is not None:
        return Split(*spec.transform(df))
    if not spec.rules:
        return Split(df, None)
    return apply_rules(normalize(df), spec.rules, watch)


FILM = TableSpec(
    "film",
    rules=(
        typed_rule("last_update", TIMESTAMP),
        typed_rule("release_year", INTEGER),
        typed_rule("rental_rate", DOUBLE),
        typed_rule("replacement_cost", DOUBLE),
    ),
    columns={
        "film_id": "bigint",
        "title": "string",
        "release_year": "int",
        "rental_duration": "bigint",
        "rental_rate": "double",
        "length": "bigint",
        "replacement_cost": "double",
        "rating": "string",
        "special_features": "string",
    },
)
INVENTORY = TableSpec(
    "inventory",
    rules=(typed_rule("last_update", TIMESTAMP),),
    columns={"inventory_id": "bigint", "store_id": "bigint", "film_id": "bigint"},
)
RENTAL = TableSpec(
    "rental",
    rules=(
        typed_rule("last_update", TIMESTAMP),
        typed_rule("rental_date", TIMESTAMP),
        typed_rule("return_date", TIMESTAMP),
    ),
    columns={
        "rental_id": "bigint",
        "inventory_id": "bigint",
        "customer_id": "bigint",
        "staff_id": "bigint",
        "rental_date": "timestamp",
        "return_date": "timestamp",
    },
    partition_by=("rental_date",),
)
CUSTOMER = TableSpec(
    "customer",
    rules=(typed_rule("last_update", TIMESTAMP), typed_rule("create_date", TIMESTAMP)),
    columns={
        "customer_id": "bigint",
        "first_name": "string",
        "last_name": "string",
        "email": "string",
        "active": "bigint",
        "create_date": "timestamp",
    },
)
STORE = TableSpec(
    "store",
    rules=(typed_rule("last_update", TIMESTAMP),),
    columns={"store_id": "bigint"},
)

# In the order they are loaded.
RENTAL_STORE_SPECS = {s.name: s for s in (FILM, INVENTORY, RENTAL, CUSTOMER, STORE)}
