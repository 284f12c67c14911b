"""A corpus made ready for training: each stage works on all that the one before it kept.

In every stage a null text counts as empty, an empty table gives an empty result, and
columns that a stage does not name pass through it. Texts are worked on whole.

Each stage bounds the bytes of the batches that go to its Python tasks, in the session and
for good, as its result is read only later; a bound that the session has set stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.bpe import count_tokens, encode_decode
from tablekit.llm.common import bound_batches, discard, free_name, scratch, staged, table
from tablekit.llm.minhash import near_duplicates
from tablekit.llm.mixing import mix
from tablekit.llm.quality_gam import score, train
from tablekit.llm.queries import ENTROPY, MOST_REPEATS, QUALITY_THRESHOLD, TOKENIZER
from tablekit.llm.suffix_dedup import remove_repeats


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_bounded_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return bounded


@in_bounded_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.7, learnt from the labels there are.

    Empty texts are scored like any other. Rows that repeat an id are scored each for
    itself; for learning, each of them and each label of an id counts.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = train(docs.select("doc_id", "text").join(labels, "doc_id"), "quality")
    score_as = free_name(docs.columns, "__score")
    return score(docs, model, wanted=score_as).where(F.col(score_as) >= QUALITY_THRESHOLD).drop(score_as)


@in_bounded_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of shingles are linked at 0.8: that with the
    smallest id. Shingles have five words, the usual size; only the contract of the
    query of this operator asks for four.

    Rows equal in id and text become one first (that with the smallest other columns);
    rows of one id with different texts stay or go together. Texts without words, and
    rows without an id, always stay.
    """
    repeated = staged(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select("doc_id"), "repeated")
    if repeated.isEmpty():
        discard(repeated)
        once = docs
    else:
        others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
        again = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("__"), *others)).alias("__rest"))
        again = again.select("doc_id", "text", "__rest.*").select(docs.columns)
        once = staged(docs.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(again), "once")
    dropped = near_duplicates(once).where("not kept").select("doc_id").distinct()
    return once.join(dropped, "doc_id", "left_anti").select(docs.columns)


@in_bounded_batches
def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that lie in strings of 100 bytes met earlier; n_chars is
    that of what is left. No row goes, also if nothing is left of its text. Rows without
    an id are left as they are; those that repeat an id are told apart by their texts."""
    others = [c for c in docs.columns if c != "text"]
    left = remove_repeats(docs, kept="__left", keep=others).withColumn("text", F.col("__left"))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


@in_bounded_batches
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of their sources takes them, by the tokens that
    the next stage makes of their texts. A null source is a source of its own; rows of a
    source without any token are taken once. Rows that repeat an id are taken alike."""
    count = free_name(docs.columns, "__tokens")
    counted = staged(count_tokens(docs, public_tokenizers.path(TOKENIZER), count), "counted")
    mixed = mix(counted, ENTROPY, MOST_REPEATS, tokens=count).where("copies > 0")
    once = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return mixed.select(*docs.columns, once.alias("__copy")).drop("__copy")


@in_bounded_batches
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, with their digest and that of the text decoded from them. An
    empty text has no ids; rows that repeat an id are encoded each for itself."""
    return encode_decode(docs, public_tokenizers.path(TOKENIZER), keep=["doc_id", "lang", "source"], ids="ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("source_mixture", mixture),
    ("bpe_tokens", tokens),
]
# SQL can express neither the classifier nor the merges; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again. What a
    stage wrote on its way, and its input, is removed when its output is there; the last
    stage's input stays, as the result reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            after = keep(staged(stage(spark, docs, sf_dir), name))
        if hasattr(docs, "_staged_path"):
            discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)


@contextmanager
def result(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """What ``run`` gives, for as long as the context lasts; nothing is left after it."""
    with scratch(spark):
        yield run(spark, sf_dir)
