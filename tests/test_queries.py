"""Every registered query against its SQL in another engine."""

import pytest

import __spark_entry__ as contract
from conftest import SF_DIR
from verification.compare import differences, given_tables
from verification.oracles import ORACLES
from verification.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return given_tables(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_sql(spark, connection, key):
    result = contract.queries()[key](spark, SF_DIR)
    assert differences(result, connection.sql(contract.oracle_sql()[key])) == []


def test_entry_gives_the_rental_model(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("key", ["clean_rental", "sheet_scan", "date_partition", "sink_partitioned", "clean_film"])
@pytest.mark.parametrize("option", [("spark.sql.session.timeZone", "Asia/Tokyo"), ("spark.sql.ansi.enabled", "false")])
def test_result_does_not_depend_on_the_session(spark, connection, conf, key, option):
    conf(*option)
    result = contract.queries()[key](spark, SF_DIR)
    assert differences(result, connection.sql(contract.oracle_sql()[key])) == []


def test_widening_takes_keys_beyond_a_smallint(spark, tmp_path):
    keys = [(1, 40_000), (2, 2**31 - 1), (2, 7), (3, None)]
    spark.createDataFrame(keys, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    found = contract.queries()["sink_widen"](spark, str(tmp_path)).collect()
    rows = [(key + 2**53, small, True) for key, small in keys] + [(small, small, True) for _, small in keys]
    assert sorted(found, key=str) == sorted(rows, key=str)
