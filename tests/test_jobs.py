"""Workbooks to models, through both jobs."""

from conftest import SF_DIR
from verification.fixtures import RAW_SQL, encode_workbook, raw_table
from tablekit.jobs import load
from tablekit.plans import RENTAL_STORE_SPECS, build_models, clean


def test_workbooks_to_models(spark, tmp_path):
    sheets = {}
    for name in RAW_SQL:
        rows = raw_table(spark, SF_DIR, name).limit(150)
        sheets[name] = [rows.columns, *[tuple(r) for r in rows.collect()]]
    halves = [{n: [rows[0], *rows[1 + half :: 2]] for n, rows in sheets.items()} for half in (0, 1)]
    for i, half in enumerate(halves):
        (tmp_path / f"part{i}.xlsx").write_bytes(encode_workbook(half))

    report = load(spark, str(tmp_path / "*.xlsx"), "jobs_test", str(tmp_path / "tables"))
    assert [r.table_name for r in report.results] == list(RENTAL_STORE_SPECS)
    for result in report.results:
        frame = spark.createDataFrame(sheets[result.table_name][1:], sheets[result.table_name][0])
        expected = clean(frame, RENTAL_STORE_SPECS[result.table_name])
        assert result.status == "ok", result
        assert (result.n_valid, result.n_rejected) == (expected.valid.count(), expected.rejected.count())

    models = build_models(spark, "jobs_test", str(tmp_path / "tables"))
    counts = {r.table_name: r.n_valid for r in report.results}
    assert models["inventory_model"].count() == counts["inventory"]
    assert models["rental_model"].count() >= counts["rental"] > 0


def test_only_new_workbooks_are_loaded(spark, tmp_path):
    def book(name, *ids):
        films = [["film_id", "title", "last_update"], *[[i, f"film {i}", "2006-02-15 04:34:33"] for i in ids]]
        stores = [["store_id", "last_update"], *[[i, "2006-02-15 04:34:33"] for i in ids]]
        (tmp_path / name).write_bytes(encode_workbook({"film": films, "store": stores}))

    def load_new():
        report = load(spark, str(tmp_path / "*.xlsx"), "ledger_test", str(tmp_path / "tables"), only_new=True)
        status = {r.table_name: (r.status, r.n_valid) for r in report.results}
        return status["film"], status["store"]

    stored = lambda table, key: sorted(r[key] for r in spark.table(f"ledger_test.{table}").collect())
    book("a.xlsx", 1, 2)
    book("b [x].xlsx", 3)
    assert load_new() == (("ok", 3), ("ok", 3))
    assert load_new() == (("current", None), ("current", None))
    assert stored("film", "film_id") == [1, 2, 3]
    book("c.xlsx", 4)
    book("b [x].xlsx", 5)  # changed
    assert load_new() == (("ok", 2), ("ok", 2))
    assert load_new() == (("current", None), ("current", None))
    assert stored("film", "film_id") == stored("store", "store_id") == [1, 2, 3, 4, 5]
    ledger = spark.table("ledger_test.film_loads")
    assert sorted(r["path"].rpartition("/")[2] for r in ledger.collect()) == ["a.xlsx", "b [x].xlsx", "b [x].xlsx", "c.xlsx"]
    # a table that starts later loads what the others have had
    spark.sql("DROP TABLE ledger_test.store_loads")
    for name in ("store_loads",):
        import shutil

        shutil.rmtree(tmp_path / "tables" / name)
    assert load_new() == (("current", None), ("ok", 4))


def test_append_stays_the_default(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(encode_workbook({"store": [["store_id", "last_update"], [1, "2006-02-15 04:34:33"]]}))
    for _ in range(2):
        load(spark, str(tmp_path / "*.xlsx"), "append_test", str(tmp_path / "tables"))
    assert spark.table("append_test.store").count() == 2
    assert not spark.catalog.tableExists("append_test.store_loads")
