"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns a DataFrame;
all but the last return the columns of documents. Nulls, blank texts, repeated rows and extra columns are
treated as the operators' modules say; an empty input gives an empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from confluo.llm import byte_bpe, decontamination, line_dedup, lsh_forest, quality_rules
from confluo.llm.common import documents, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the certified rules reject go."""
    return quality_rules.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go from the texts."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return lsh_forest.first_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes they decode to."""
    return byte_bpe.digest_documents(docs, *byte_bpe.production())


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("decontamination", decontaminate), ("byte_bpe", encode)]

#: Shingle sets, suffixes of signatures and BPE merges have no SQL here; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each written before the next reads it."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
