"""SQL for DuckDB that states the expected result of each query on its own terms."""

from __future__ import annotations

from verification.fixtures import RAW_SQL

# What each dirty table looks like once clean: its columns (text ones marked) and
# its rules in order, as (column, type, error text).
TEXT, PLAIN = "text", "plain"
TIMESTAMP, INTEGER, DOUBLE = "TIMESTAMP", "INTEGER", "DOUBLE"
COLUMNS = {
    "film": {
        "film_id": PLAIN,
        "title": TEXT,
        "release_year": TEXT,
        "rental_duration": PLAIN,
        "rental_rate": TEXT,
        "length": PLAIN,
        "replacement_cost": TEXT,
        "rating": TEXT,
        "special_features": TEXT,
        "last_update": TEXT,
    },
    "store": {"store_id": PLAIN, "store_name": TEXT, "last_update": TEXT},
    "inventory": {"inventory_id": PLAIN, "film_id": PLAIN, "store_id": PLAIN, "last_update": TEXT},
    "customer": {
        "customer_id": PLAIN,
        "first_name": TEXT,
        "last_name": TEXT,
        "email": TEXT,
        "active": PLAIN,
        "create_date": TEXT,
        "last_update": TEXT,
    },
    "rental": {
        "rental_id": PLAIN,
        "inventory_id": PLAIN,
        "customer_id": PLAIN,
        "staff_id": PLAIN,
        "rental_date": TEXT,
        "return_date": TEXT,
        "last_update": TEXT,
    },
}
# The stored error texts.
LAST_UPDATE = ("last_update", TIMESTAMP, "Error en last_update: no es Timestamp válido")
RELEASE_YEAR = ("release_year", INTEGER, "Error en release_year: no es entero válido")
RENTAL_RATE = ("rental_rate", DOUBLE, "Error en rental_rate: no es Double válido")
REPLACEMENT_COST = ("replacement_cost", DOUBLE, "Error en replacement_cost: no es Double válido")
RENTAL_DATE = ("rental_date", TIMESTAMP, "Error en rental_date: no es Timestamp válido")
RETURN_DATE = ("return_date", TIMESTAMP, "Error en return_date: no es Timestamp válido")
CREATE_DATE = ("create_date", TIMESTAMP, "Error en create_date: no es Timestamp válido")
RULES = {
    "film": [LAST_UPDATE, RELEASE_YEAR, RENTAL_RATE, REPLACEMENT_COST],
    "store": [LAST_UPDATE],
    "inventory": [LAST_UPDATE],
    "customer": [LAST_UPDATE, CREATE_DATE],
    "rental": [LAST_UPDATE, RENTAL_DATE, RETURN_DATE],
}
GIVEN = {t: t for t in ("part", "supplier", "orders", "customer", "lineitem")}

FILM_SIDE = ", ".join(f"f.{c} AS film_{c}" for c in COLUMNS["film"] if c != "film_id")

FILM_MODEL_SQL = """f.title, f.release_year, f.rental_duration, f.rental_rate,
       f.length AS duration_minutes, f.replacement_cost, f.rating, f.special_features"""

# Plain SQL for both engines.
REPORT_QUERY = """
SELECT c_mktsegment, o_orderpriority, n_lines, quantity,
       CAST(RANK() OVER (PARTITION BY c_mktsegment ORDER BY quantity DESC, o_orderpriority) AS BIGINT) AS place
FROM (SELECT c_mktsegment, o_orderpriority, COUNT(*) AS n_lines,
             CAST(SUM(l_quantity) AS BIGINT) AS quantity
      FROM {lineitem} LEFT JOIN {orders} ON l_orderkey = o_orderkey
           LEFT JOIN {customer} ON o_custkey = c_custkey
      GROUP BY c_mktsegment, o_orderpriority) AS totals
"""


def raw(name: str) -> str:
    return RAW_SQL[name].format(**GIVEN)


def normalized(name: str) -> str:
    columns = ", ".join(
        f"NULLIF(TRIM({c}), 'NULL') AS {c}" if kind == TEXT else c for c, kind in COLUMNS[name].items()
    )
    return f"SELECT {columns} FROM ({raw(name)}) AS dirty"


def fails(rule: tuple[str, str, str]) -> str:
    return f"TRY_CAST({rule[0]} AS {rule[1]}) IS NULL"


def valid(name: str, rules: list | None = None) -> str:
    rules = RULES[name] if rules is None else rules
    types = {column: type for column, type, _ in rules}
    columns = ", ".join(f"TRY_CAST({c} AS {types[c]}) AS {c}" if c in types else c for c in COLUMNS[name])
    kept = " AND ".join(f"NOT ({fails(rule)})" for rule in rules)
    return f"SELECT {columns} FROM ({normalized(name)}) AS n WHERE {kept}"


def rejected(name: str, rules: list | None = None) -> str:
    rules = RULES[name] if rules is None else rules
    position = {column: i for i, (column, _, _) in enumerate(rules)}
    first_broken = " ".join(f"WHEN {fails(rule)} THEN {i}" for i, rule in enumerate(rules))
    columns = ", ".join(
        f"CASE WHEN broken > {position[c]} THEN CAST(TRY_CAST({c} AS {rules[position[c]][1]}) AS VARCHAR) "
        f"ELSE {c} END AS {c}"
        if c in position
        else c
        for c in COLUMNS[name]
    )
    messages = " ".join(f"WHEN {i} THEN '{message}'" for i, (_, _, message) in enumerate(rules))
    return (
        f"SELECT {columns}, CASE broken {messages} END AS data_quality_error "
        f"FROM (SELECT *, CASE {first_broken} END AS broken FROM ({normalized(name)}) AS n) AS judged "
        f"WHERE broken IS NOT NULL"
    )


def with_valid(*names: str) -> str:
    return "WITH " + ", ".join(f"{name}_ok AS ({valid(name)})" for name in names)


def errors(name: str, key: str) -> str:
    fields = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '~')" for c in sorted([*COLUMNS[name], "data_quality_error"]))
    return f"SELECT '{name}' AS table_name, {key} AS row_key, CONCAT_WS('|', {fields}) AS fields FROM ({rejected(name)}) AS r"


def report_row(name: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, 'ok' AS status, "
        f"(SELECT COUNT(*) FROM ({valid(name)}) AS v) AS n_valid, "
        f"(SELECT COUNT(*) FROM ({rejected(name)}) AS r) AS n_rejected, "
        f"'' AS skipped_rules, CAST(NULL AS VARCHAR) AS failed_stage"
    )


RENTALS_PARTITIONED = f"SELECT *, CAST(CAST(rental_date AS DATE) AS VARCHAR) AS rental_date_partition FROM ({valid('rental')}) AS r"

OPEN_RENTALS = f"""
SELECT rental_id, inventory_id, customer_id, staff_id,
       CAST(rental_date AS TIMESTAMP) AS rental_date, CAST(return_date AS TIMESTAMP) AS return_date,
       CAST(last_update AS TIMESTAMP) AS last_update
FROM ({normalized('rental')}) AS n
WHERE TRY_CAST(last_update AS TIMESTAMP) IS NOT NULL AND TRY_CAST(rental_date AS TIMESTAMP) IS NOT NULL
  AND (return_date IS NULL OR TRY_CAST(return_date AS TIMESTAMP) IS NOT NULL)"""

ORDER_TYPES = """
SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
  ('o_totalprice', 'double'), ('o_orderdate', 'timestamp'), ('o_orderpriority', 'string'))
  AS t(column_name, column_type)"""

ORACLES: dict[str, str] = {
    "sheet_scan": "SELECT * FROM orders",
    "infer_types": ORDER_TYPES,
    "sheet_types": ORDER_TYPES,
    "infer_text_ids": """
        SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS padded,
               '1234567890123456' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS long,
               '+44' || c_custkey AS signed, c_custkey || 'e1' AS exponent, c_custkey FROM customer""",
    "sheet_ragged": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS unnamed FROM orders""",
    "sheet_isolation": """
        SELECT 'customer' AS sheet, COUNT(*) AS n, 'BadZipFile' AS cause FROM customer
        UNION ALL SELECT 'supplier', COUNT(*), '' FROM supplier UNION ALL SELECT 'orders', COUNT(*), '' FROM orders""",
    "sheet_files": "SELECT * FROM customer",
    "catalog_scan": "SELECT * FROM customer",
    "sink_roundtrip": valid("store"),
    "sink_partitioned": f"SELECT * FROM ({RENTALS_PARTITIONED}) AS p WHERE rental_date_partition = '2003-05-23'",
    "sink_append": f"{with_valid('store')} SELECT * FROM store_ok UNION ALL SELECT * FROM store_ok",
    "sink_evolve": """
        SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier
        UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
    "sink_overwrite_partitions": f"""
        SELECT * REPLACE (CASE WHEN YEAR(rental_date) = 2003 THEN NULL ELSE staff_id END AS staff_id)
        FROM ({RENTALS_PARTITIONED}) AS p""",
    "sink_widen": """
        SELECT o_orderkey + 9007199254740992 AS key, CAST(o_custkey AS INTEGER) AS small, TRUE AS refused FROM orders
        UNION ALL SELECT o_custkey, CAST(o_custkey AS INTEGER), TRUE FROM orders""",
    "sink_widen_types": """
        SELECT l_orderkey AS key, l_linenumber AS line, l_quantity AS quantity, date_trunc('day', l_shipdate)::TIMESTAMP AS shipped FROM lineitem
        UNION ALL SELECT l_orderkey + 1099511627776, l_linenumber, l_quantity + 0.1, l_shipdate FROM lineitem""",
    "sink_overwrite": "SELECT * FROM customer WHERE c_nationkey < 5",
    "overwrite_by_nothing": f"""
        SELECT 'replaced' AS table_name, 'empty' AS status, 0::BIGINT AS n_valid, 0::BIGINT AS n_rejected
        UNION ALL SELECT 'kept', 'empty', (SELECT COUNT(*) FROM ({valid('film')}) AS v), (SELECT COUNT(*) FROM ({rejected('film')}) AS r)""",
    "run_started_again": f"""
        SELECT film_id, title, CAST(release_year AS VARCHAR) AS release_year, '' AS data_quality_error FROM ({valid('film')}) AS v
        UNION ALL SELECT film_id, title, release_year, data_quality_error FROM ({rejected('film')}) AS r""",
    "sheet_ledger": "SELECT * FROM customer",
    "reject_sink": rejected("film"),
    "reject_overwrite": f"SELECT * FROM ({rejected('film')}) AS r WHERE film_id % 2 <> 0",
    "reject_overwrite_partitions": rejected("film"),
    "stored_models": f"""{with_valid('inventory', 'store', 'rental', 'customer', 'film')}
        SELECT 'rental' AS model, r.rental_id, r.inventory_id, r.customer_id, r.staff_id, i.store_id, i.film_id,
               r.rental_date, r.return_date, c.first_name || ' ' || c.last_name AS full_name,
               c.email, c.active, c.create_date, {FILM_MODEL_SQL}
        FROM rental_ok r LEFT JOIN customer_ok c ON c.customer_id = r.customer_id
        LEFT JOIN inventory_ok i ON i.inventory_id = r.inventory_id LEFT JOIN film_ok f ON f.film_id = i.film_id
        UNION ALL
        SELECT 'inventory', NULL, i.inventory_id, NULL, NULL, i.store_id, i.film_id,
               NULL, NULL, NULL, NULL, NULL, NULL, {FILM_MODEL_SQL}
        FROM inventory_ok i LEFT JOIN store_ok s ON i.store_id = s.store_id LEFT JOIN film_ok f ON i.film_id = f.film_id""",
    "strip_headers": "SELECT * FROM lineitem",
    "trim_strings": f"""
        SELECT film_id, TRIM(title) AS title, TRIM(release_year) AS release_year, rental_duration,
               TRIM(rental_rate) AS rental_rate, length, TRIM(replacement_cost) AS replacement_cost,
               TRIM(rating) AS rating, TRIM(special_features) AS special_features,
               TRIM(unused_code) AS unused_code, TRIM(last_update) AS last_update
        FROM ({raw('film')}) AS dirty""",
    "null_tokens": f"SELECT *, CAST(NULL AS VARCHAR) AS unused_code FROM ({normalized('film')}) AS n",
    "drop_null_columns": normalized("film"),
    "drop_null_columns_wide": "SELECT *, CASE WHEN l_quantity = 50 THEN l_orderkey END AS sparse FROM lineitem",
    "cast_timestamp": valid("inventory"),
    "cast_integer": valid("film", [RELEASE_YEAR]),
    "cast_double": valid("film", [RENTAL_RATE, REPLACEMENT_COST]),
    "reject_rows": rejected("film", [RELEASE_YEAR]),
    "rule_chain": rejected("rental"),
    "missing_column_rule": f"SELECT *, 'opened_on' AS skipped_rules FROM ({valid('store')}) AS s",
    "nullable_rule": OPEN_RENTALS,
    "union_rejects": " UNION ALL ".join(
        [
            errors("film", "film_id"),
            errors("inventory", "inventory_id"),
            errors("rental", "rental_id"),
            errors("customer", "customer_id"),
            errors("store", "store_id"),
        ]
    ),
    "date_partition": "SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS ts_partition FROM events",
    "full_name": f"SELECT customer_id, first_name || ' ' || last_name AS full_name FROM ({normalized('customer')}) AS n",
    "left_join_keyonly": f"""{with_valid('inventory', 'store')}
        SELECT i.* FROM inventory_ok i
        LEFT JOIN (SELECT * FROM store_ok UNION ALL SELECT * FROM store_ok) s ON i.store_id = s.store_id""",
    "left_join": f"""{with_valid('inventory', 'film')}
        SELECT i.*, {FILM_SIDE} FROM inventory_ok i LEFT JOIN film_ok f ON i.film_id = f.film_id""",
    "left_join_chain": f"""{with_valid('rental', 'inventory', 'film')}
        SELECT r.*, i.film_id, i.store_id AS item_store_id, i.last_update AS item_last_update, {FILM_SIDE}
        FROM rental_ok r LEFT JOIN inventory_ok i ON i.inventory_id = r.inventory_id
        LEFT JOIN film_ok f ON f.film_id = i.film_id""",
    "sql_query": REPORT_QUERY.format(**GIVEN),
    "inventory_model": f"""{with_valid('inventory', 'store', 'film')}
        SELECT i.inventory_id, i.store_id, i.film_id, {FILM_MODEL_SQL}
        FROM inventory_ok i LEFT JOIN store_ok s ON i.store_id = s.store_id
        LEFT JOIN film_ok f ON i.film_id = f.film_id""",
    "rental_model": f"""{with_valid('rental', 'customer', 'inventory', 'film')}
        SELECT r.rental_id, r.inventory_id, r.customer_id, r.staff_id, i.store_id, i.film_id,
               r.rental_date, r.return_date, c.first_name || ' ' || c.last_name AS full_name,
               c.email, c.active, c.create_date, {FILM_MODEL_SQL}
        FROM rental_ok r LEFT JOIN customer_ok c ON c.customer_id = r.customer_id
        LEFT JOIN inventory_ok i ON i.inventory_id = r.inventory_id
        LEFT JOIN film_ok f ON f.film_id = i.film_id""",
    **{f"clean_{name}": valid(name) for name in COLUMNS},
    "custom_transform": """
        SELECT *, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE '' END AS data_quality_error FROM orders""",
    "passthrough": "SELECT * FROM events",
    "table_run_report": " UNION ALL ".join(
        [
            *[report_row(name) for name in COLUMNS],
            "SELECT 'payment', 'failed', NULL, NULL, '', 'load'",
            "SELECT 'region', 'ok', (SELECT COUNT(*) FROM region), NULL, '', NULL",
        ]
    ),
}
