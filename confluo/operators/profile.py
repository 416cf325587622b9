"""Profiles of the truth and of how it shares out records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.operators.features import PAIR
from confluo.operators.records import with_source
from confluo.operators.sampling import match_counts


def truth_profile(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """n, singles, mean numbers of S2 and S3 matches over all primary records."""
    own = truth.groupBy(PAIR[0]).agg(F.count_if(F.col(PAIR[1]).startswith("S2-")).alias("s2"), F.count_if(F.col(PAIR[1]).startswith("S3-")).alias("s3"))
    rows = s1.select(PAIR[0]).join(own, PAIR[0], "left").fillna(0)
    return rows.agg(F.count("*").alias("n"), F.count_if((F.col("s2") == 0) & (F.col("s3") == 0)).alias("singles"), F.round(F.avg("s2"), 6).alias("mean_s2"), F.round(F.avg("s3"), 6).alias("mean_s3"))


def match_histogram(s1: DataFrame, truth: DataFrame) -> DataFrame:
    return match_counts(s1, truth).groupBy("matches").agg(F.count("*").alias("n"))


def owner_conflicts(truth: DataFrame) -> DataFrame:
    """Candidates that several primary records claim."""
    return truth.distinct().groupBy(PAIR[1]).agg(F.count("*").alias("owners"), F.min(PAIR[0]).alias("first_owner")).where("owners > 1")


def unmatched(records: DataFrame, truth: DataFrame) -> DataFrame:
    """src, n of the other sources' records that match nothing."""
    left = with_source(records).where("src <> 'S1'").join(truth.select(F.col(PAIR[1]).alias("entity_id")), "entity_id", "left_anti")
    return left.groupBy("src").agg(F.count("*").alias("n"))


def matched_records(records: DataFrame, truth: DataFrame) -> DataFrame:
    """The pairs of truth beside both raw names."""
    name = lambda k, to: records.select(F.col("entity_id").alias(k), F.col("business_name").alias(to))
    return truth.join(name(PAIR[0], "source1_name"), PAIR[0]).join(name(PAIR[1], "candidate_name"), PAIR[1])
