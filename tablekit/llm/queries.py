"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import language_id
from tablekit.llm.bpe import encode_decode
from tablekit.llm.common import crc32_text, table
from tablekit.llm.content_sort import exact_duplicates
from tablekit.llm.embedding_dedup import near_vectors
from tablekit.llm.hard_negatives import hard_negatives
from tablekit.llm.hilbert import hilbert_shards, quantised
from tablekit.llm.minhash import near_duplicates
from tablekit.llm.mixing import mix
from tablekit.llm.oracles import ORACLES as ORACLES
from tablekit.llm.permutation_index import nearest
from tablekit.llm.position_index import spelling_variants, word_counts
from tablekit.llm.quality_gam import score, train
from tablekit.llm.suffix_dedup import remove_repeats
from tablekit.llm.token_files import read_token_files, token_folder, write_token_files

TOKENIZER = "byte_bpe_50k.json"
QUALITY_THRESHOLD = 0.7
SHARDS = 24
ENTROPY, MOST_REPEATS = 0.995, 4.0


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words_each=4, percent=80)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), keep=["doc_id"])


def op4_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    index = write_token_files(documents, token_folder(documents), public_tokenizers.path(TOKENIZER), end_id=0)
    return read_token_files(index).select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op6_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that repeat an id are learnt from, and predicted, each for itself."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(crc32_text("doc_id"), F.lit(3)) == 1
    filters = language_id.train(documents.where(~held_out))
    return language_id.predict(documents.select("doc_id", "text"), filters).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = (F.octet_length(data) + 8).cast("bigint")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", size.alias("size"), F.crc32(data).alias("text_crc32"))
    dimensions = [quantised(documents, F.col(c)) for c in ("source", "lang", "size")]
    order = [F.col("doc_id"), F.col("text_crc32")]
    return hilbert_shards(documents, dimensions, order, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(documents, keep=["doc_id"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that repeat an id, and several labels of one id, are each a row to learn from;
    every row is scored once, whatever its labels."""
    documents, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    fold = F.pmod(crc32_text("doc_id"), F.lit(4)) == 2
    learned = documents.where(~fold).join(labels.select("doc_id", "quality"), "doc_id")
    scored = score(documents, train(learned, "quality"))
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), ENTROPY, MOST_REPEATS)
    return mixed.select("doc_id", "source", "n_tokens", "weight", "copies")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(table(spark, sf_dir, "documents"), least_length=5, least_count=3, typo_every=97)
    return spelling_variants(counts, ratio=2)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), every=100)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_bpe": op3_bpe,
    "op4_permutation_index": op4_permutation_index,
    "op5_token_files": op5_token_files,
    "op6_language_filters": op6_language_filters,
    "op7_hilbert_shards": op7_hilbert_shards,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_quality_gam": op9_quality_gam,
    "op10_temperature_mixing": op10_temperature_mixing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_exact_dedup": op13_exact_dedup,
}
