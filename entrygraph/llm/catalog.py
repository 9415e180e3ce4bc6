"""Registered queries over the corpus tables: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entrygraph.llm import align, bpe, decontaminate, html, licenses, lines, lm, periods, pii, quality, sharding, simhash, suffixes
from entrygraph.llm.common import table, text_or_empty

RANKS = "byte_bpe_multi_50k.tiktoken"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), 3)
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty(F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.crc32(text).alias("text_crc32"), sharding.size_of(F.col("text")).alias("size"), F.xxhash64(text).alias("group"))
    placed = docs.withColumn("old_shard", F.pmod("group", F.lit(32)).cast("int"))
    return sharding.transfer(placed, 32, 40).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
    return quality.score_quality(table(spark, sf_dir, "documents")).select(*names)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_report(table(spark, sf_dir, "documents"), plant=True)


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def queries() -> dict:
    found = (op1_lines, op2_pii, op3_byte_bpe, op4_licenses, op5_suffixes, op6_simhash, op7_sharding, op8_decontaminate, op9_language_model, op10_quality, op11_alignment, op12_periodic_runs, op13_main_text)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict:
    return {"op1_lines": lines.ORACLE, "op8_decontaminate": decontaminate.ORACLE}
