"""One query per operator, each over whole test tables.

Timestamps leave as TIMESTAMP_NTZ, the type the other engine's TIMESTAMP has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablekit.functions.columns import quoted
from tablekit.operators import (
    Rule,
    Split,
    apply_rules,
    combine_frames,
    date_partition,
    drop_null_columns,
    left_join,
    normalize,
    null_tokens,
    strip_headers,
    trim_strings,
)
from tablekit.plans import (
    RENTAL_STORE_SPECS,
    TableSpec,
    build_models,
    clean,
    inventory_model,
    rental_model,
    run_pipeline,
)
from tablekit.plans.models import full_name
from tablekit.plans.specs import DOUBLE, INTEGER, STORE, TIMESTAMP, typed_rule
from tablekit.session import fresh_path
from tablekit.sinks import TableSink
from tablekit.sinks.tables import SchemaConflict
from tablekit.sources import infer_types, load_table, open_workbooks, run_query, sheet_frame, sheet_sources, stage_sheets
from verification.fixtures import RAW_SQL, as_workbooks, encode_workbook, given_table, raw_table, write_workbooks
from verification.oracles import REPORT_QUERY

Query = Callable[[SparkSession, str], DataFrame]


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the wall clock they show."""
    zoned = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.select(
        *[quoted(c).cast("timestamp_ntz").alias(c) if c in zoned else quoted(c) for c in df.columns]
    )


def dates_as_text(df: DataFrame, column: str) -> DataFrame:
    """Engines hand dates to Python in different classes; their text is the same."""
    return df.withColumn(column, F.col(column).cast("string"))


def new_sink(spark: SparkSession) -> TableSink:
    return TableSink(spark, f"check_{uuid4().hex}", fresh_path(spark, "tables"))


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> Split:
    return clean(raw_table(spark, sf_dir, name), RENTAL_STORE_SPECS[name])


def valid(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return cleaned(spark, sf_dir, name).valid


# Sources and sinks


def sheet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    workbooks = as_workbooks(given_table(spark, sf_dir, "orders"), "orders")
    return without_zone(sheet_frame(stage_sheets(workbooks, ["orders"]), "orders"))


def infer_types_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    workbooks = as_workbooks(given_table(spark, sf_dir, "orders"), "orders")
    text = sheet_frame(stage_sheets(workbooks, ["orders"]), "orders", infer=False)
    return spark.createDataFrame(
        list(infer_types(text).items()), "column_name string, column_type string"
    )


def renamed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in workbooks of two layouts: the second names its columns in other case and
    order, with blanks, and has cells beyond its header."""
    orders = given_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    whole = as_workbooks(orders.where("o_orderkey % 2 = 0"), "orders")
    other = orders.where("o_orderkey % 2 <> 0").select(
        F.col("o_custkey").alias(" O_CUSTKEY"), F.col("o_orderkey").alias("O_OrderKey "), F.lit(None).cast("string").alias(" "), F.col("o_orderpriority").alias("")
    )
    return whole.unionAll(as_workbooks(other, "orders"))


def sheet_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells of sheets whose headers differ; a column without a name is ``_c3``."""
    return sheet_frame(stage_sheets(renamed_orders(spark, sf_dir), ["orders"]), "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.col("_c3").alias("unnamed")
    )


def sheet_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per sheet, with one workbook more that cannot be read for *customer*."""
    rows = [as_workbooks(given_table(spark, sf_dir, t), t) for t in ("customer", "supplier", "orders")]
    broken = spark.createDataFrame([("broken.xlsx", bytearray(encode_workbook({"customer": [["c"], [1]]})[:200]))], "path string, content binary")
    books = combine_frames(rows)
    sheets = ["supplier", "orders"]
    good = stage_sheets(books, sheets)
    mixed = stage_sheets(broken.unionAll(rows[0]), ["customer"])
    counts = [sheet_frame(good, s).agg(F.lit(s).alias("sheet"), F.count("*").alias("n"), F.lit("").alias("cause")) for s in sheets]
    read = mixed.agg(F.lit("customer").alias("sheet"), F.count("cells").alias("n"), F.max(F.regexp_extract("error", "^[A-Za-z]+", 0)).alias("cause"))
    return combine_frames([*counts, read])


def sheet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook files in the shared folder, found and read by path."""
    folder = fresh_path(spark, "workbooks")
    write_workbooks(as_workbooks(given_table(spark, sf_dir, "customer"), "customer"), folder)
    customers = sheet_frame(stage_sheets(open_workbooks(spark, f"{folder}/*.xlsx"), ["customer"]), "customer")
    return customers.withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


def infer_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys padded with zeros, long digit strings and signs come back letter for letter."""
    customers = given_table(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("padded"),
        F.concat(F.lit("1234567890123456"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("long"),
        F.concat(F.lit("+44"), F.col("c_custkey").cast("string")).alias("signed"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("e1")).alias("exponent"),
        "c_custkey",
    )
    return sheet_frame(stage_sheets(as_workbooks(customers, "ids"), ["ids"]), "ids")


def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    sink.save(given_table(spark, sf_dir, "customer"), "customer")
    view = f"customer_{uuid4().hex}"
    load_table(spark, sink.database, "customer", view)
    return spark.table(view)


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    sink.save(valid(spark, sf_dir, "store"), "store")
    return without_zone(spark.table(sink.name("store")))


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    rentals, partition_by = date_partition(valid(spark, sf_dir, "rental"), ["rental_date"])
    sink.save(rentals, "rental", partition_by)
    stored = spark.table(sink.name("rental"))
    one_day = F.col("rental_date_partition") == F.lit("2003-05-23").cast("date")
    return dates_as_text(without_zone(stored.where(one_day)), "rental_date_partition")


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    stores = valid(spark, sf_dir, "store")
    sink.save(stores, "store")
    sink.save(stores, "store")
    return without_zone(spark.table(sink.name("store")))


def sink_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    suppliers = given_table(spark, sf_dir, "supplier")
    sink.save(suppliers.drop("s_acctbal"), "supplier")
    sink.save(suppliers.drop("s_nationkey"), "supplier")
    return spark.table(sink.name("supplier"))


def sink_overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rentals, then those of 2003 again with the staff blanked: only the days
    of that year are replaced."""
    sink = new_sink(spark)
    rentals, partition_by = date_partition(valid(spark, sf_dir, "rental"), ["rental_date"])
    sink.save(rentals, "rental", partition_by)
    of_2003 = rentals.where(F.year("rental_date") == 2003)
    sink.save(
        of_2003.withColumn("staff_id", F.lit(None).cast("bigint")),
        "rental",
        partition_by,
        mode="overwrite_partitions",
    )
    stored = without_zone(spark.table(sink.name("rental")))
    return dates_as_text(stored, "rental_date_partition")


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """A session that overwrites partitions one by one unless told otherwise."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers by nation, then only those of some nations: the others are gone,
    also in a session set to dynamic overwrite."""
    sink = new_sink(spark)
    customers = given_table(spark, sf_dir, "customer")
    with dynamic_overwrite(spark):
        sink.save(customers, "customer", ["c_nationkey"])
        sink.save(customers.where("c_nationkey < 5"), "customer", ["c_nationkey"], mode="overwrite")
    return spark.table(sink.name("customer"))


def overwrite_by_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load without any value under ``overwrite``: rows left of the one before it, and
    of another that was only added to."""
    sink, raw = new_sink(spark), raw_table(spark, sf_dir, "film")
    specs = [TableSpec(n, rules=RENTAL_STORE_SPECS["film"].rules, partition_by=("rating",)) for n in ("replaced", "kept")]
    nothing = raw.select(*[F.lit(None).cast(t).alias(c) for c, t in raw.dtypes])
    with dynamic_overwrite(spark):
        run_pipeline(specs, {s.name: lambda: raw for s in specs}, sink)
        reports = [run_pipeline([s], {s.name: lambda: nothing}, sink, mode).results[0] for s, mode in zip(specs, ("overwrite", "append"))]
    rows = [(r.table_name, r.status, spark.table(sink.name(r.table_name)).count(), spark.table(sink.name(f"{r.table_name}_errors")).count()) for r in reports]
    return spark.createDataFrame(rows, "table_name string, status string, n_valid bigint, n_rejected bigint")


def sink_widen_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that grow under their stored rows: whole numbers, floats, dates."""
    sink, lines = new_sink(spark), given_table(spark, sf_dir, "lineitem")
    small = lines.select(F.col("l_orderkey").cast("int").alias("key"), F.col("l_linenumber").cast("smallint").alias("line"), F.col("l_quantity").cast("float").alias("quantity"), F.col("l_shipdate").cast("date").alias("shipped"))
    large = lines.select((F.col("l_orderkey") + 2**40).alias("key"), F.col("l_linenumber").alias("line"), (F.col("l_quantity") + 0.1).alias("quantity"), F.col("l_shipdate").alias("shipped"))
    sink.save(small, "lines")
    sink.save(large, "lines")
    return spark.table(sink.name("lines"))


def run_started_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named run started twice, with a run that fails between its two writes before:
    valid rows and errors are there once each."""
    sink, spec, raw = new_sink(spark), RENTAL_STORE_SPECS["film"], raw_table(spark, sf_dir, "film")
    broken = TableSpec("film", transform=lambda df: Split(*clean(df, spec)[:1], df.select(F.raise_error(F.lit("no")).alias("x"))))
    for one in (broken, spec, spec):
        run_pipeline([one], {"film": lambda: raw}, sink, name="monday")
    stored = without_zone(spark.table(sink.name("film"))).withColumn("data_quality_error", F.lit(""))
    errors = spark.table(sink.name("film_errors"))
    texts = lambda df: df.select("film_id", "title", "release_year", "data_quality_error")
    return texts(stored.withColumn("release_year", F.col("release_year").cast("string"))).unionByName(texts(errors))


def sheet_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the workbooks, then all of them twice, each loaded once."""
    sink, folder = new_sink(spark), fresh_path(spark, "workbooks")
    customers = given_table(spark, sf_dir, "customer")
    half = F.col("c_custkey") % 2 == 0
    for part in (customers.where(half), customers.where(~half), None):
        if part is not None:
            write_workbooks(as_workbooks(part, "customer"), folder)
        with sheet_sources(spark, f"{folder}/*.xlsx", ["customer"], sink) as sources:
            run_pipeline([TableSpec("customer")], sources, sink)
    return spark.table(sink.name("customer")).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


def sheet_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found while parsing, from the summaries of the workbooks."""
    frame = sheet_frame(stage_sheets(as_workbooks(given_table(spark, sf_dir, "orders"), "orders"), ["orders"]), "orders")
    return spark.createDataFrame(frame.dtypes, "column_name string, column_type string")


def reject_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    sink.save(cleaned(spark, sf_dir, "film").rejected, "film_errors")
    return spark.table(sink.name("film_errors"))


def film_runs(spark: SparkSession, sf_dir: str, second_mode: str) -> DataFrame:
    """Films of two runs, the second with the later half only: stored errors."""
    sink, raw = new_sink(spark), raw_table(spark, sf_dir, "film")
    spec = RENTAL_STORE_SPECS["film"]
    partitioned = TableSpec("film", rules=spec.rules, partition_by=("rating",))
    half = F.col("film_id") % 2 == 0
    run_pipeline([partitioned], {"film": lambda: raw.where(half)}, sink)
    run_pipeline([partitioned], {"film": lambda: raw.where(~half)}, sink, mode=second_mode)
    return spark.table(sink.name("film_errors"))


def reject_overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return film_runs(spark, sf_dir, "overwrite_partitions")


def reject_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return film_runs(spark, sf_dir, "overwrite")


def sink_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers beyond 2^53 are refused by a double column, and stay exact where
    the stored type can hold them."""
    sink = new_sink(spark)
    keys = given_table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 2**53).alias("key"), F.col("o_custkey").cast("int").alias("small"))
    sink.save(keys.select(F.col("small").cast("double").alias("key"), "small"), "loose")
    sink.save(keys.select(F.col("small").alias("key"), "small"), "loose")
    try:
        sink.save(keys, "loose")
        refused = False
    except SchemaConflict:
        refused = True
    sink.save(keys.select("key", "small"), "exact")
    sink.save(keys.select(F.col("small").alias("key"), "small"), "exact")
    return spark.table(sink.name("exact")).select("key", "small", F.lit(refused).alias("refused"))


def stored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned tables stored, loaded, joined and stored again: both models read back."""
    sink = new_sink(spark)
    for name in RENTAL_STORE_SPECS:
        sink.save(valid(spark, sf_dir, name), name)
    build_models(spark, sink.database, sink.base_path, partition_by={"rental_model": ["store_id"]})
    rentals, items = (load_table(spark, sink.database, f"{n}_model", f"{n}_{uuid4().hex}") for n in ("rental", "inventory"))
    both = rentals.withColumn("model", F.lit("rental")).unionByName(items.withColumn("model", F.lit("inventory")), allowMissingColumns=True)
    return without_zone(both)


# Normalisation


def strip_headers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given_table(spark, sf_dir, "lineitem")
    padded = lines.toDF(*[f" {c}\t" for c in lines.columns])
    return without_zone(strip_headers(padded))


def trim_strings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(raw_table(spark, sf_dir, "film"))


def null_tokens_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_tokens(trim_strings(raw_table(spark, sf_dir, "film")))


def drop_null_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(raw_table(spark, sf_dir, "film"))


def drop_null_columns_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem column stays but two: one blank throughout, one dropped as the
    ``NULL`` text; a column with a value in few rows stays too."""
    lines = given_table(spark, sf_dir, "lineitem")
    sparse = F.when(F.col("l_quantity") == 50, F.col("l_orderkey"))
    raw = lines.withColumns(
        {"blank": F.lit(None).cast("double"), "null_text": F.lit(" NULL "), "sparse": sparse}
    )
    return drop_null_columns(null_tokens(trim_strings(raw)))


# Rules


def cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(valid(spark, sf_dir, "inventory"))


def cast_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = typed_rule("release_year", INTEGER)
    return apply_rules(normalize(raw_table(spark, sf_dir, "film")), [rule]).valid


def cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [typed_rule("rental_rate", DOUBLE), typed_rule("replacement_cost", DOUBLE)]
    return apply_rules(normalize(raw_table(spark, sf_dir, "film")), rules).valid


def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = typed_rule("release_year", INTEGER)
    return apply_rules(normalize(raw_table(spark, sf_dir, "film")), [rule]).rejected


def rule_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir, "rental").rejected


def missing_column_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [typed_rule("opened_on", TIMESTAMP), *STORE.rules]
    split = apply_rules(normalize(raw_table(spark, sf_dir, "store")), rules)
    skipped = F.lit(",".join(split.skipped)).alias("skipped_rules")
    return without_zone(split.valid.select("*", skipped))


def nullable_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rentals whose return date may be open."""
    rules = [
        Rule(r.column, r.type, r.message, nullable=r.column == "return_date")
        for r in RENTAL_STORE_SPECS["rental"].rules
    ]
    return without_zone(apply_rules(normalize(raw_table(spark, sf_dir, "rental")), rules).valid)


def union_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors of every table in one frame; region has none to give."""

    def errors(name: str, key: str) -> DataFrame:
        rejected = cleaned(spark, sf_dir, name).rejected
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(rejected.columns)]
        return rejected.select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), F.concat_ws("|", *fields).alias("fields"))

    passed_through = clean(given_table(spark, sf_dir, "region"), TableSpec("region")).rejected
    keys = {
        "film": "film_id",
        "inventory": "inventory_id",
        "rental": "rental_id",
        "customer": "customer_id",
        "store": "store_id",
    }
    return combine_frames([passed_through, *[errors(n, k) for n, k in keys.items()]])


def date_partition_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given_table(spark, sf_dir, "events")
    return dates_as_text(date_partition(events, ["ts", "event_type", "absent"])[0], "ts_partition")


# Joins, SQL and models


def full_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = normalize(raw_table(spark, sf_dir, "customer"))
    return people.select(
        "customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name")
    )


def prefixed(df: DataFrame, prefix: str, *keys: str) -> DataFrame:
    """Every column but ``keys`` under a name of its side."""
    return df.select(*[F.col(c) if c in keys else F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def left_join_keyonly(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = valid(spark, sf_dir, "store").select("store_id")
    return without_zone(left_join(valid(spark, sf_dir, "inventory"), stores.unionAll(stores), "store_id"))


def left_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    films = prefixed(valid(spark, sf_dir, "film"), "film", "film_id")
    return without_zone(left_join(valid(spark, sf_dir, "inventory"), films, "film_id"))


def left_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The film key comes from the inventory side, null where that did not match."""
    items = prefixed(valid(spark, sf_dir, "inventory"), "item", "inventory_id", "film_id")
    films = prefixed(valid(spark, sf_dir, "film"), "film", "film_id")
    rentals = valid(spark, sf_dir, "rental")
    return without_zone(left_join(left_join(rentals, items, "inventory_id"), films, "film_id"))


def sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = {t: f"{t}_{uuid4().hex}" for t in ("lineitem", "orders", "customer")}
    for table, view in views.items():
        given_table(spark, sf_dir, table).createOrReplaceTempView(view)
    return run_query(spark, REPORT_QUERY.format(**views))


def inventory_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [valid(spark, sf_dir, n) for n in ("inventory", "store", "film")]
    return without_zone(inventory_model(*frames))


def rental_model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [valid(spark, sf_dir, n) for n in ("rental", "customer", "inventory", "film")]
    return without_zone(rental_model(*frames))


# Tables and runs


def clean_query(name: str) -> Query:
    return lambda spark, sf_dir: without_zone(valid(spark, sf_dir, name))


def open_orders_apart(orders: DataFrame) -> Split:
    """A user's own transform: orders still open are errors."""
    is_open = F.col("o_orderstatus") == "O"
    return Split(
        orders.where(~is_open), orders.where(is_open).withColumn("data_quality_error", F.lit("open"))
    )


def custom_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = TableSpec("orders", transform=open_orders_apart)
    split = clean(given_table(spark, sf_dir, "orders"), spec)
    return combine_frames([split.valid.withColumn("data_quality_error", F.lit("")), split.rejected])


def passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = new_sink(spark)
    load = {"events": lambda: given_table(spark, sf_dir, "events")}
    run_pipeline([TableSpec("events")], load, sink)
    return spark.table(sink.name("events"))


def table_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables, one without a source to load, and one without rules."""
    specs = [*RENTAL_STORE_SPECS.values(), TableSpec("payment"), TableSpec("region")]
    load = {name: (lambda name=name: raw_table(spark, sf_dir, name)) for name in RAW_SQL}
    load["region"] = lambda: given_table(spark, sf_dir, "region")
    report = run_pipeline(specs, load, new_sink(spark)).frame(spark)
    return report.withColumn("skipped_rules", F.array_join("skipped_rules", ",")).drop("error")


QUERIES: dict[str, Query] = {
    "sheet_scan": sheet_scan,
    "infer_types": infer_types_query,
    "infer_text_ids": infer_text_ids,
    "sheet_ragged": sheet_ragged,
    "sheet_isolation": sheet_isolation,
    "sheet_files": sheet_files,
    "sheet_ledger": sheet_ledger,
    "sheet_types": sheet_types,
    "catalog_scan": catalog_scan,
    "sink_roundtrip": sink_roundtrip,
    "sink_partitioned": sink_partitioned,
    "sink_append": sink_append,
    "sink_evolve": sink_evolve,
    "sink_overwrite_partitions": sink_overwrite_partitions,
    "sink_widen": sink_widen,
    "sink_widen_types": sink_widen_types,
    "sink_overwrite": sink_overwrite,
    "overwrite_by_nothing": overwrite_by_nothing,
    "run_started_again": run_started_again,
    "reject_sink": reject_sink,
    "reject_overwrite": reject_overwrite,
    "reject_overwrite_partitions": reject_overwrite_partitions,
    "stored_models": stored_models,
    "strip_headers": strip_headers_query,
    "trim_strings": trim_strings_query,
    "null_tokens": null_tokens_query,
    "drop_null_columns": drop_null_columns_query,
    "drop_null_columns_wide": drop_null_columns_wide,
    "cast_timestamp": cast_timestamp,
    "cast_integer": cast_integer,
    "cast_double": cast_double,
    "reject_rows": reject_rows,
    "rule_chain": rule_chain,
    "missing_column_rule": missing_column_rule,
    "nullable_rule": nullable_rule,
    "union_rejects": union_rejects,
    "date_partition": date_partition_query,
    "full_name": full_name_query,
    "left_join_keyonly": left_join_keyonly,
    "left_join": left_join_query,
    "left_join_chain": left_join_chain,
    "sql_query": sql_query,
    "inventory_model": inventory_model_query,
    "rental_model": rental_model_query,
    **{f"clean_{name}": clean_query(name) for name in RENTAL_STORE_SPECS},
    "custom_transform": custom_transform,
    "passthrough": passthrough,
    "table_run_report": table_run_report,
}
