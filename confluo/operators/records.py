"""Raw records to clean records, and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.functions import text as t


def with_source(df: DataFrame) -> DataFrame:
    """src: the digits of the id's prefix (S1-, S2-, S3-); a table of numbered records has it."""
    return df if dict(df.dtypes)["entity_id"] != "string" else df.withColumn("src", F.substring("entity_id", 1, 2))


def clean(df: DataFrame) -> DataFrame:
    """The raw columns with name_clean, name_legal_suffix, name_is_domain, address_clean, postal_code, has_non_latin_script."""
    df = df.select(*[t.blank(F.col(c)).alias(c) if k == "string" else F.col(c) for c, k in df.dtypes])
    df = df.withColumns({"_n": t.normalize_text(F.col("business_name")), "_a": t.normalize_text(F.col("business_address"))})
    name, suffix = t.split_suffix(F.col("_n"))
    return df.withColumns({
        "name_clean": name, "name_legal_suffix": suffix, "name_is_domain": t.is_domain(F.col("business_name")),
        "address_clean": t.expand_address(F.col("_a")), "postal_code": t.postal_code(F.col("business_address")), "has_non_latin_script": t.has_non_latin(F.col("business_address")),
    }).drop("_n", "_a")


def clean_stats(df: DataFrame) -> DataFrame:
    """Per source: rows, and counts of domains, non-Latin addresses, postal codes and blanks."""
    count = lambda c, name: F.count_if(c).alias(name)
    return with_source(df).groupBy("src").agg(
        F.count("*").alias("n"), count(F.col("name_is_domain"), "domains"), count(F.col("has_non_latin_script"), "non_latin"), count(F.col("postal_code") != "", "postal"),
        count(F.trim("business_name") == "", "blank_name"), count(F.trim("business_address") == "", "blank_address"), count(F.trim("country") == "", "blank_country"),
    )


def country_histogram(df: DataFrame) -> DataFrame:
    return with_source(df).groupBy("src", "country").agg(F.count("*").alias("n"))


def countries(df: DataFrame) -> list[str]:
    """The countries met, India and US first, then by name: a small set, read to check a restriction to one."""
    names = [r[0] for r in df.select("country").distinct().collect()]
    return sorted(names, key=lambda c: ({"India": 0, "US": 1}.get(c, 2), c))


def only_country(df: DataFrame, country: str) -> DataFrame:
    if country not in countries(df):
        raise ValueError(f"unknown country {country!r}")
    return df.where(F.col("country") == country)


def first_rows(df: DataFrame, order: str, key: str = "entity_id") -> DataFrame:
    """The first row of each key by an ordinal."""
    return _one_row(df, F.min_by, order, key)


def last_rows(df: DataFrame, order: str, key: str = "entity_id") -> DataFrame:
    """The last row of each key by an ordinal."""
    return _one_row(df, F.max_by, order, key)


def _one_row(df: DataFrame, pick, order: str, key: str) -> DataFrame:
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(pick(F.struct(*cols), F.col(order)).alias("_r")).select(key, "_r.*").select(*df.columns)
