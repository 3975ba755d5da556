"""The operator queries ``opN_*`` with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm import (decontaminate, near_dedup, ngram_lm, order_minhash, packing, pii, quality, runs,
                           simple8b, slots, toxicity, whitening, wrapper)

SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.token_files(_table(spark, sf_dir, "documents"),
                                public_tokenizers.path("word_bpe_49k.json"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         "sequence_id", "offset", "segment")


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"),
                               _table(spark, sf_dir, "benchmark"))


def op6_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = slots.shard(_table(spark, sf_dir, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_text(_table(spark, sf_dir, "pages"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id", toxicity.held_out(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD_OUT).alias("held_out"),
        "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "n_toxic")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.select(
        "doc_id", toxicity.held_out(F.col("doc_id"), quality.FOLDS, quality.HELD_OUT).alias("held_out"),
        "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = toxicity.held_out(F.col("doc_id"), ngram_lm.FOLDS, ngram_lm.HELD_OUT)
    return ngram_lm.language_model_scores(_table(spark, sf_dir, "documents"), ~held)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_report(_table(spark, sf_dir, "documents"), change=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_files, op2_order_minhash, op3_pii_spans, op4_vector_packing, op5_benchmark_leaks,
        op6_slot_shards, op7_page_text, op8_near_duplicates, op9_toxicity, op10_quality,
        op11_language_model, op12_whitening, op13_periodic_runs)}

#: Tokenizers, learned models, hash families and code-point offsets have no SQL form here;
#: these queries are tested against brute force, round trips and held-out accuracy.
ORACLES: dict[str, str] = {}
