import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from tablekit.llm import chunks, minhash, suffix_dedup
from tablekit.llm.common import staged

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def batch_bound(spark):
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.unset(BATCH_BYTES)
    yield
    spark.conf.unset(BATCH_BYTES) if before is None else spark.conf.set(BATCH_BYTES, before)


def test_batches_of_texts_are_bounded_in_bytes(spark, batch_bound):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    docs = spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 800).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(4000).alias("n_chars"))
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(BATCH_BYTES)
        stage(spark, docs.limit(20), SF_DIR)
        met = docs.mapInArrow(sizes, "n bigint, bytes bigint").collect()
        assert sum(r["n"] for r in met) == 3000
        assert max(r["bytes"] for r in met) < 3 << 20
    spark.conf.set(BATCH_BYTES, "1m")
    corpus_pipeline.quality(spark, docs.limit(20), SF_DIR)
    assert spark.conf.get(BATCH_BYTES) == "1m"


@pytest.mark.parametrize("own", [None, "1m"])
def test_near_duplicates_bounds_its_batches_only(spark, batch_bound, monkeypatch, own):
    if own:
        spark.conf.set(BATCH_BYTES, own)
    held = {}

    def noted(df, label):
        held.setdefault(label, spark.conf.get(BATCH_BYTES, None))
        return staged(df, label)

    monkeypatch.setattr(minhash, "staged", noted)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id bigint, text string")
    assert minhash.near_duplicates(docs).where("kept").count() == 2
    assert held["sketches"] == held["sets"] == (own or "2m") and held["bands"] == own
    assert spark.conf.get(BATCH_BYTES, None) == own


def test_tasks_without_a_tokenizer_give_its_memory_back():
    class Frame:
        def mapInArrow(self, run, schema):
            return run

    for run in (minhash._sketched(Frame(), 5), suffix_dedup._counted):
        chunks.process_store()["a tokenizer"] = "and its chunks"
        assert list(run(iter([]))) == []
        assert not chunks.process_store()
