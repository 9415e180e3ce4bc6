"""The corpus pipeline: five stages, each written as Parquet and reread by the next.

Every stage takes (spark, docs, sf_dir) and works on all documents its
predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entrygraph.llm import bpe, decontaminate, lines, quality, simhash
from entrygraph.llm.common import staged, table

#: Words to a shingle in the near-duplicate stage.
SHINGLE = 5
RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules together hold for good."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier; those left without a word go."""
    done = lines.clean_lines(docs).filter("text rlike '[^ \\t-\\r]'")
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, at a shingle similarity of 0.8: the smallest doc_id."""
    return simhash.keep_one(docs, SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the decoded bytes."""
    return bpe.encode_documents(docs, public_tokenizers.path(RANKS), with_ids=True)


STAGES = [
    ("quality", quality_rules),
    ("lines", line_dedup),
    ("near_duplicates", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Expectation maximisation and fingerprints have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the written table after each cuts the lineage."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
