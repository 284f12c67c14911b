import pytest
from pyspark.sql import functions as F, types as T

from conftest import SF_DIR
from verification.fixtures import RAW_SQL, raw_table
from tablekit.operators import Rule, Split
from tablekit.plans import RENTAL_STORE_SPECS, TableSpec, build_models, run_pipeline

SPEC = TableSpec("t", rules=(Rule("n", T.IntegerType(), "bad n"),))


def run(sink, df, spec=SPEC, **options):
    return run_pipeline([spec], {spec.name: lambda: df}, sink, **options).results[0]


def test_valid_and_rejected_rows_are_stored_and_counted(spark, sink):
    df = spark.createDataFrame([("1",), ("x",), ("2",)], "` n` string")
    result = run(sink, df)
    assert (result.status, result.n_valid, result.n_rejected) == ("ok", 2, 1)
    assert sorted(spark.table(sink.name("t")).collect()) == [(1,), (2,)]
    assert spark.table(sink.name("t_errors")).collect() == [("x", "bad n")]


def test_clean_table_still_gets_an_empty_error_table(spark, sink):
    result = run(sink, spark.createDataFrame([("1",)], "n string"))
    assert (result.n_valid, result.n_rejected) == (1, 0)
    errors = spark.table(sink.name("t_errors"))
    assert errors.count() == 0 and errors.columns == ["n", "data_quality_error"]


def test_a_clean_source_is_not_read_again_for_errors(spark, sink, tmp_path):
    """One probe and one pass: the error table of a clean source costs no scan."""
    spark.range(100).select(F.col("id").cast("string").alias("n")).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    result = run(sink, source.mapInArrow(counted, source.schema))
    assert (result.n_valid, result.n_rejected) == (100, 0)
    assert reads.value <= 200


def counting_reads(spark, tmp_path, values):
    """A source and the number of rows that were read from it."""
    path = str(tmp_path / "in")
    spark.createDataFrame([(v,) for v in values], "n string").repartition(4).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(path)
    return source.mapInArrow(counted, source.schema), reads


def test_both_sides_come_out_of_one_pass_over_the_source(spark, sink, tmp_path):
    df, reads = counting_reads(spark, tmp_path, [str(i) if i % 3 else f"x{i}" for i in range(90)])
    result = run(sink, df)
    assert (result.n_valid, result.n_rejected) == (60, 30)
    assert reads.value <= 180  # the probe for empty columns, and one pass
    assert sorted(r["n"] for r in spark.table(sink.name("t")).collect()) == [i for i in range(90) if i % 3]
    assert spark.table(sink.name("t")).columns == ["n"]
    assert {r["n"] for r in spark.table(sink.name("t_errors")).collect()} == {f"x{3 * i}" for i in range(30)}


@pytest.mark.parametrize("mode", ["append", "overwrite"])
@pytest.mark.parametrize("at", ["between writes", "before the manifest", "while publishing", "before the catalog"])
def test_a_killed_run_started_again_is_neither_half_nor_doubled(spark, sink, monkeypatch, mode, at):
    from tablekit.sinks import publication
    from tablekit.sinks.files import FileStore
    from tablekit.sinks.tables import TableRun

    spec = TableSpec("t", SPEC.rules, partition_by=("k",))
    load = lambda values: spark.createDataFrame([(v, v[-1]) for v in values], "n string, k string")
    assert run(sink, load(["1", "x"]), spec).status == "ok"

    class Killed(BaseException):
        pass

    def kill(*_, **__):
        raise Killed

    with monkeypatch.context() as patched:
        patched.setattr(FileStore, "remove", lambda self, path: None)  # a killed process tidies nothing
        if at == "between writes":
            real = TableRun.write
            patched.setattr(TableRun, "write", lambda self, df, table, *a, **k: kill() if table == "t_errors" else real(self, df, table, *a, **k))
        elif at == "before the manifest":
            patched.setattr(FileStore, "write_json", kill)
        elif at == "while publishing":
            real_step = publication._carry_out
            patched.setattr(publication, "_carry_out", lambda sink, files, folder, step, again: kill() if step.table == "t_errors" else real_step(sink, files, folder, step, again))
        else:
            patched.setattr(publication, "_register", kill)
        with pytest.raises(Killed):
            run(sink, load(["2", "y", "3"]), spec, mode=mode, name="monday")
    if at in ("between writes", "before the manifest"):
        assert [tuple(r) for r in spark.table(sink.name("t")).select("n", "k").collect()] == [(1, "1")]

    again = run(sink, load(["2", "y", "3"]), spec, mode=mode, name="monday")
    assert (again.status, again.n_valid, again.n_rejected) == ("ok", 2, 1)
    before = [(1, "1")] if mode == "append" else []
    spark.catalog.refreshTable(sink.name("t"))
    assert sorted(tuple(r) for r in spark.table(sink.name("t")).select("n", "k").collect()) == [*before, (2, "2"), (3, "3")]
    errors = sorted(r["n"] for r in spark.table(sink.name("t_errors")).collect())
    assert errors == (["x", "y"] if mode == "append" else ["y"])

    assert run(sink, load(["2", "y", "3"]), spec, mode=mode, name="monday") == again
    assert spark.table(sink.name("t")).count() == len(before) + 2
    assert run(sink, load(["4"]), spec, mode=mode, name="tuesday").n_valid == 1
    sink.remove_unpublished()
    left = [n for n, _ in FileStore(spark).names(f"{sink.root()}/_runs")]
    assert left == ["monday.t", "tuesday.t"]
    assert all(n == "done.json" for run_name in left for n, _ in FileStore(spark).names(f"{sink.root()}/_runs/{run_name}"))


def test_an_unfinished_run_is_completed_by_the_next_writer_of_its_tables(spark, sink, monkeypatch):
    from tablekit.sinks import publication

    sink.save(spark.range(2), "t")
    with monkeypatch.context() as patched:
        patched.setattr(publication, "_complete", lambda *a, **k: None)
        sink.save(spark.range(10, 12), "t")
    assert spark.table(sink.name("t")).count() == 2
    sink.save(spark.range(3), "other")
    assert spark.table(sink.name("t")).count() == 2
    sink.save(spark.range(20, 21), "t")
    assert sorted(r["id"] for r in spark.table(sink.name("t")).collect()) == [0, 1, 10, 11, 20]


def test_a_failed_write_leaves_both_tables_as_they_were(spark, sink):
    assert run(sink, spark.createDataFrame([("1",), ("x",)], "n string")).status == "ok"
    bad = spark.createDataFrame([("2",), ("y",)], "n string").withColumn("t", F.when(F.col("n") == "y", F.raise_error(F.lit("boom"))).otherwise("a"))
    result = run(sink, bad)
    assert (result.status, result.n_valid) == ("failed", None)
    assert (spark.table(sink.name("t")).count(), spark.table(sink.name("t_errors")).count()) == (1, 1)


def test_tables_run_side_by_side_and_report_in_order(spark, sink, conf):
    import threading

    together, before = threading.Barrier(4, timeout=60), spark.conf.get("spark.sql.shuffle.partitions")

    def source(k):
        def load():
            together.wait()  # passes only if four tables load at the same time
            if k == 2:
                raise OSError("gone")
            return spark.createDataFrame([(str(i),) for i in range(k)] + [("x",)], "n string")

        return load

    specs = [TableSpec(f"t{k}", SPEC.rules) for k in range(4)]
    report = run_pipeline(specs, {f"t{k}": source(k) for k in range(4)}, sink)
    assert [(r.table_name, r.status, r.n_valid, r.n_rejected) for r in report.results] == [
        ("t0", "ok", 0, 1), ("t1", "ok", 1, 1), ("t2", "failed", None, None), ("t3", "ok", 3, 1),
    ]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_overwrite_leaves_nothing_of_earlier_runs(spark, sink):
    def rows(*values):
        return spark.createDataFrame([(v, 1) for v in values], "n string, k int")

    run(sink, rows("1", "x"), mode="overwrite")
    run(sink, rows(None), mode="overwrite")  # the rule's column has no value: nothing is judged
    assert spark.table(sink.name("t_errors")).count() == 0
    run(sink, rows("1", "x"), mode="overwrite")
    result = run(sink, spark.createDataFrame([(None, None)], "n string, k int"), mode="overwrite")
    assert result.status == "empty"
    assert (spark.table(sink.name("t")).count(), spark.table(sink.name("t_errors")).count()) == (0, 0)


def test_overwritten_partitions_keep_errors_of_the_others(spark, sink):
    spec = TableSpec("t", rules=(Rule("n", T.IntegerType(), "bad n"),), partition_by=("k",))
    for day, values in (("a", "1xy"), ("b", "2z"), ("b", "3")):
        run(sink, spark.createDataFrame([(v, day) for v in values], "n string, k string"), spec, mode="append" if day == "a" else "overwrite_partitions")
    assert sorted(spark.table(sink.name("t")).select("n", "k").collect()) == [(1, "a"), (3, "b")]
    assert sorted(r["n"] for r in spark.table(sink.name("t_errors")).collect()) == ["x", "y", "z"]


def test_one_failing_table_leaves_the_others(spark, sink):
    def broken():
        raise FileNotFoundError("no such sheet")

    good = spark.createDataFrame([("1",)], "n string")
    rules = (Rule("n", T.IntegerType(), "bad n"),)
    specs = [TableSpec(name, rules) for name in ("a", "b", "c", "d")]
    sources = {"a": lambda: good, "b": broken, "c": lambda: good}
    report = run_pipeline(specs, sources, sink)
    assert [(r.table_name, r.status, r.failed_stage) for r in report.results] == [
        ("a", "ok", None),
        ("b", "failed", "load"),
        ("c", "ok", None),
        ("d", "failed", "load"),
    ]
    assert "no such sheet" in report.results[1].error
    frame = report.frame(spark)
    assert frame.count() == 4 and frame.where("status = 'failed'").count() == 2


def test_failure_inside_spark_is_reported_with_its_stage(spark, sink):
    df = spark.createDataFrame([("1",), ("0",)], "n string")
    late = TableSpec("t", transform=lambda d: Split(d.select(F.raise_error(F.lit("boom")).alias("x")), None))
    result = run(sink, df, late)
    assert (result.status, result.failed_stage) == ("failed", "write_valid") and "boom" in result.error


def test_a_table_without_rules_is_stored_as_it_is(spark, sink):
    df = spark.createDataFrame([(" x ", None)], "` a ` string, b string")
    result = run(sink, df, TableSpec("t"))
    assert (result.n_valid, result.n_rejected) == (1, None)
    assert spark.table(sink.name("t")).columns == [" a ", "b"]
    assert not spark.catalog.tableExists(sink.name("t_errors"))


def test_custom_transform_replaces_the_rules(spark, sink):
    def halves(df):
        return df.where("n = '1'"), df.where("n <> '1'").withColumn("data_quality_error", F.lit("not one"))

    df = spark.createDataFrame([("1",), ("2",)], "n string")
    result = run(sink, df, TableSpec("t", SPEC.rules, transform=halves))
    assert (result.n_valid, result.n_rejected) == (1, 1)
    assert spark.table(sink.name("t_errors")).collect() == [("2", "not one")]


def test_empty_input_writes_nothing(spark, sink):
    result = run(sink, spark.createDataFrame([], "n string"))
    assert (result.status, result.skipped_rules) == ("empty", ("n",))
    assert not spark.catalog.tableExists(sink.name("t"))


def test_skipped_rules_are_reported(spark, sink):
    result = run(sink, spark.createDataFrame([(1,)], "other int"))
    assert (result.status, result.skipped_rules, result.n_rejected) == ("ok", ("n",), None)


def test_partition_field_that_is_missing_fails_its_table(spark, sink):
    spec = TableSpec("t", SPEC.rules, partition_by=("day",))
    result = run(sink, spark.createDataFrame([("1",)], "n string"), spec)
    assert (result.status, result.failed_stage) == ("failed", "write_valid")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    from tablekit.sinks import TableSink

    sink = TableSink(spark, "loaded", str(tmp_path_factory.mktemp("loaded")))
    load = {name: (lambda name=name: raw_table(spark, SF_DIR, name)) for name in RAW_SQL}
    report = run_pipeline(RENTAL_STORE_SPECS.values(), load, sink)
    return sink, {r.table_name: r for r in report.results}


def test_five_tables_load_and_balance(spark, loaded):
    sink, results = loaded
    for name, result in results.items():
        assert result.status == "ok", result
        assert result.n_valid + result.n_rejected == raw_table(spark, SF_DIR, name).count()
        assert spark.table(sink.name(name)).count() == result.n_valid
        assert spark.table(sink.name(f"{name}_errors")).count() == result.n_rejected
    assert "rental_date_partition" in spark.table(sink.name("rental")).columns


def test_models_are_built_from_the_stored_tables(spark, loaded):
    sink, results = loaded
    models = build_models(spark, sink.database, sink.base_path, mode="overwrite")
    assert models["inventory_model"].count() == results["inventory"].n_valid
    assert models["rental_model"].count() == results["rental"].n_valid
    assert spark.table(sink.name("rental_model")).columns == models["rental_model"].columns


def test_models_stop_at_a_missing_table(spark, sink):
    sink.save(spark.range(1), "film")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        build_models(spark, sink.database, sink.base_path)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_counts_arrive_when_every_row_of_a_partitioned_table_is_rejected(spark, sink, conf, broadcast, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    spark.createDataFrame([("x", "d"), ("y", "d")] * 50, "n string, day string").write.parquet(str(tmp_path / "in"))
    spec = TableSpec("t", SPEC.rules, partition_by=("day",))
    result = run(sink, spark.read.parquet(str(tmp_path / "in")), spec)
    assert (result.status, result.n_valid, result.n_rejected) == ("ok", 0, 100)
    again = run(sink, spark.read.parquet(str(tmp_path / "in")), spec)
    assert (again.status, again.n_valid, again.n_rejected) == ("ok", 0, 100), again
