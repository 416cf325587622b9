"""Deterministic samples and splits: rows are ordered by md5 of id and seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from confluo.operators.features import PAIR
from confluo.operators.order import ranked
from confluo.operators.records import with_source

STRATA = {"none": 400, "one": 600, "many": 2000}


def order_key(c, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(c).cast("string"), F.lit(f"-{seed}")))


def stratum(n: Column) -> Column:
    return F.when(n == 0, "none").when(n == 1, "one").otherwise("many")


def match_counts(s1: DataFrame, truth: DataFrame) -> DataFrame:
    n = truth.groupBy(PAIR[0]).agg(F.count("*").alias("matches"))
    return s1.select(PAIR[0]).join(n, PAIR[0], "left").select(PAIR[0], F.coalesce("matches", F.lit(0)).cast("long").alias("matches"))


def stratified_sample(s1: DataFrame, truth: DataFrame, sizes: dict[str, int] | None = None, seed: int = 42) -> DataFrame:
    """Primary ids with their stratum by number of matches, a fixed number from each."""
    sizes = sizes or STRATA
    rows = match_counts(s1, truth).withColumn("stratum", stratum(F.col("matches")))
    most = F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))])
    return ranked(rows, "stratum", order_key(PAIR[0], seed), PAIR[0], most[F.col("stratum")]).select(PAIR[0], "stratum", "matches")


def true_records(records: DataFrame, sample: DataFrame, truth: DataFrame) -> DataFrame:
    """The records that match a sampled primary record."""
    ids = truth.join(sample, PAIR[0], "left_semi").select(F.col(PAIR[1]).alias("entity_id"))
    return records.join(ids, "entity_id", "left_semi")


def distractors(records: DataFrame, sample: DataFrame, truth: DataFrame, per_source: int = 5000, seed: int = 42) -> DataFrame:
    """Records of each other source that match nothing sampled, a fixed number a source."""
    ids = truth.join(sample, PAIR[0], "left_semi").select(F.col(PAIR[1]).alias("entity_id"))
    pool = with_source(records).where("src <> 'S1'").join(ids, "entity_id", "left_anti")
    return ranked(pool, "src", order_key("entity_id", seed), "entity_id", F.lit(per_source)).select(*pool.columns)


def sample_fixture(records: DataFrame, truth: DataFrame, sizes: dict[str, int] | None = None, per_source: int = 5000) -> DataFrame:
    """Sampled primary records, all their matches and the distractors, each id once."""
    s1 = with_source(records).where("src = 'S1'")
    sample = stratified_sample(s1.select(F.col("entity_id").alias(PAIR[0])), truth, sizes)
    own = records.join(sample.select(F.col(PAIR[0]).alias("entity_id")), "entity_id", "left_semi")
    rest = distractors(records, sample, truth, per_source).select(*records.columns)
    return own.unionByName(true_records(records, sample, truth)).unionByName(rest).dropDuplicates(["entity_id"])


def grouped_split(features: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """features with is_val: whole primary records, the same share of those with and without a match."""
    n = features.groupBy(PAIR[0]).agg((F.count_if("is_match") == 0).alias("single"))
    val = ranked(n, "single", order_key(PAIR[0], seed), PAIR[0]).select(PAIR[0], (F.col("_r") <= F.ceil(F.col("_n") * share)).alias("is_val"))
    return features.join(val, PAIR[0])


def leakage(split: DataFrame) -> DataFrame:
    """n of the primary records on both sides: 0."""
    return split.groupBy(PAIR[0]).agg(F.countDistinct("is_val").alias("k")).agg(F.count_if(F.col("k") > 1).alias("n"))


def few_rows(df: DataFrame, key: str, n: int, seed: int = 419) -> DataFrame:
    return df.orderBy(order_key(key, seed), key).limit(n)
