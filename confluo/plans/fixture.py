"""Business records derived from the documents table by one SQL text that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.operators.features import PAIR

RECORDS = """
SELECT 'S' || CAST(doc_id % 3 + 1 AS STRING) || '-' || CAST(doc_id AS STRING) AS entity_id,
  replace(substr(text, 1, 80), chr(10), ' ') || CASE doc_id % 5 WHEN 0 THEN ' LLC' WHEN 1 THEN ' Pvt. Ltd.' WHEN 2 THEN '' WHEN 3 THEN ' & Co' ELSE ' Company, Inc.' END AS business_name,
  replace(substr(text, 81, 160), chr(10), ' ') || CASE doc_id % 4
    WHEN 0 THEN ', 12 Main St, Springfield ' || CAST(10000 + doc_id * 37 % 90000 AS STRING)
    WHEN 1 THEN ', Flat No 403 Marg ' || CAST(10000 + doc_id * 37 % 90000 AS STRING)
    WHEN 2 THEN ', Hill Rd, New Delhi ' || CAST(100000 + doc_id * 53 % 800000 AS STRING)
    ELSE ', दिल्ली ' || CAST(100000 + doc_id * 53 % 800000 AS STRING) END AS business_address,
  lang AS country
FROM documents"""
TRUTH = """
SELECT 'S1-' || CAST(a.doc_id AS STRING) AS source1_entity_id, 'S' || CAST(b.doc_id % 3 + 1 AS STRING) || '-' || CAST(b.doc_id AS STRING) AS candidate_entity_id
FROM documents a JOIN documents b ON a.text = b.text WHERE a.doc_id % 3 = 0 AND b.doc_id % 3 <> 0"""


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    # The table's name is bound for this statement alone.
    return spark.sql(text.replace("FROM documents", "FROM {documents}"), documents=spark.read.parquet(f"{sf_dir}/documents.parquet"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, RECORDS)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRUTH by digests of the texts, so that no text is shuffled."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.md5("text").alias("digest"))
    other = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string"))
    one = docs.where("doc_id % 3 = 0").select("digest", F.concat(F.lit("S1-"), F.col("doc_id").cast("string")).alias(PAIR[0]))
    return one.join(docs.where("doc_id % 3 <> 0").select("digest", other.alias(PAIR[1])), "digest").select(*PAIR)


def primary(records: DataFrame) -> DataFrame:
    return records.where(F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias(PAIR[0]))
