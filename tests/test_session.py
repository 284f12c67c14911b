from types import SimpleNamespace

import pytest

from tablekit import session
from tablekit.session import fresh_path, input_bytes, path_exists, remove_path, shared_dir, sized_shuffles, stage

PARTITIONS = "spark.sql.shuffle.partitions"


def test_shared_folder_is_the_configured_one():
    conf = SimpleNamespace(get=lambda key, default: "hdfs://shared/ckpt/")
    assert shared_dir(SimpleNamespace(conf=conf)) == "hdfs://shared/ckpt"


def test_a_cluster_without_shared_folder_is_refused():
    context = SimpleNamespace(master="spark://host:7077", applicationId="x")
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(spark)


def test_staged_frame_reads_its_copy(spark):
    path = fresh_path(spark, "t")
    staged = stage(spark.range(5), path)
    assert staged.count() == 5 and path_exists(spark, path)
    remove_path(spark, path)
    assert not path_exists(spark, path)


def test_shuffles_grow_with_the_input_and_only_for_the_block(spark, monkeypatch, tmp_path):
    spark.range(10_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    before = spark.conf.get(PARTITIONS)
    with sized_shuffles(df):
        assert spark.conf.get(PARTITIONS) == before
    monkeypatch.setattr(session, "SHUFFLE_PARTITION_BYTES", input_bytes(df) // 40)
    with pytest.raises(ZeroDivisionError), sized_shuffles(df.join(df, "id")):
        assert int(spark.conf.get(PARTITIONS)) >= 80
        1 / 0
    assert spark.conf.get(PARTITIONS) == before


def test_shuffles_of_a_session_that_set_no_number_keep_the_default(spark, conf):
    conf(PARTITIONS, "1")
    spark.conf.unset(PARTITIONS)
    default = spark.conf.get(PARTITIONS)
    with sized_shuffles(spark.range(10)), sized_shuffles(spark.range(10)):
        assert int(spark.conf.get(PARTITIONS)) == int(default) > 1
    assert spark.conf.get(PARTITIONS, None) is None and spark.conf.get(PARTITIONS) == default


def test_sources_of_unknown_size_do_not_grow_shuffles(spark):
    assert input_bytes(spark.createDataFrame([(1,)], "n int")) == 0
    assert input_bytes(spark.range(1000)) == 8000


def test_partition_count_is_bounded():
    assert session.shuffle_partitions_for(100 << 40) == session.MOST_SHUFFLE_PARTITIONS
    assert session.shuffle_partitions_for(1) == 1
