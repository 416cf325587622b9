"""Features and labels of candidate pairs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.functions import meetings
from confluo.functions import similarity as s
from confluo.functions.text import truthy
from confluo.operators.order import percentiles

FEATURES = ["name_token_sort_ratio", "name_token_set_ratio", "name_char_ngram_jaccard", "address_token_jaccard", "address_char_ngram_jaccard", "postal_code_match", "country_match", "legal_suffix_match", "either_is_domain", "either_has_non_latin_script"]
PAIR = ["source1_entity_id", "candidate_entity_id"]
_TEXT = ["name_clean", "address_clean", "postal_code", "country", "name_legal_suffix"]
_FLAGS = ["name_is_domain", "has_non_latin_script"]


def with_records(pairs: DataFrame, clean: DataFrame, text: list[str] = _TEXT, flags: list[str] = _FLAGS) -> DataFrame:
    """pairs with both records' fields (text and flags) as a_* and b_*; fields of unknown ids are blank. Ids carry their source, so one join a side does."""

    kinds = dict(clean.dtypes)
    flag = lambda c: truthy(F.col(c)) if kinds[c] == "string" else F.col(c)  # noqa: E731  a text file's flags are words

    def side(tag: str, key: str) -> DataFrame:
        return clean.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{tag}_{c}") for c in text], *[flag(c).alias(f"{tag}_{c}") for c in flags])

    out = pairs.join(side("a", PAIR[0]), PAIR[0], "left").join(side("b", PAIR[1]), PAIR[1], "left")
    fill = {f"{t}_{c}": F.coalesce(f"{t}_{c}", F.lit("")) for t in "ab" for c in text} | {f"{t}_{c}": F.coalesce(f"{t}_{c}", F.lit(False)) for t in "ab" for c in flags}
    return out.withColumns(fill)


def unknown_sources(pairs: DataFrame) -> DataFrame:
    """n of the pairs whose candidate has neither the S2- nor the S3- prefix."""
    return pairs.agg(F.count_if(~F.col(PAIR[1]).rlike("^S[23]-")).alias("n"))


def name_address(both: DataFrame) -> dict:
    return {"name_char_ngram_jaccard": s.gram_jaccard(F.col("a_name_clean"), F.col("b_name_clean")), "address_token_jaccard": s.token_jaccard(F.col("a_address_clean"), F.col("b_address_clean")), "address_char_ngram_jaccard": s.gram_jaccard(F.col("a_address_clean"), F.col("b_address_clean"))}


def with_sets(clean: DataFrame) -> DataFrame:
    """entity_id, country, name_clean, address_clean with what the two measures of a pair need of each record alone: name_grams, how many windows its name has, and address_words, its words once each."""
    kept = ["entity_id", "country", "name_clean", "address_clean"]
    columns = clean.select(*kept[:2], *[F.coalesce(c, F.lit("")).alias(c) for c in kept[2:]])

    # Not as column functions, for whose sake cleaning would run once more.
    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = pa.array(map(meetings.gram_count, batch.column("name_clean").to_pylist()), pa.int32())
            words = pa.array(map(meetings.word_set, batch.column("address_clean").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, grams, words], names=[*kept, "name_grams", "address_words"])

    return columns.mapInArrow(made, "entity_id string, country string, name_clean string, address_clean string, name_grams int, address_words string")


def name_address_alone(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """name_char_ngram_jaccard and address_token_jaccard of each pair, without its ids, as name_address gives them. sets: from with_sets."""
    fields = {"name_clean": "", "name_grams": 0, "address_words": ""}
    side = lambda t, key: sets.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{t}_{c}") for c in fields])
    both = pairs.join(side("a", PAIR[0]), PAIR[0], "left").join(side("b", PAIR[1]), PAIR[1], "left")
    both = both.select(*[F.coalesce(f"{t}_{c}", F.lit(none)).alias(f"{t}_{c}") for t in "ab" for c, none in fields.items()])

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, p, v, b, q, w = batch.columns
            out = [meetings.gram_meetings(a, b, p.to_numpy(), q.to_numpy()), meetings.word_meetings(v, w)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["name_char_ngram_jaccard", "address_token_jaccard"])

    return both.mapInArrow(measured, "name_char_ngram_jaccard double, address_token_jaccard double")


def ratios() -> dict:
    return {"name_token_sort_ratio": s.token_sort_ratio(F.col("a_name_clean"), F.col("b_name_clean")), "name_token_set_ratio": s.token_set_ratio(F.col("a_name_clean"), F.col("b_name_clean"))}


def context() -> dict:
    state = lambda c: s.three_state(F.col(f"a_{c}"), F.col(f"b_{c}"))
    flag = lambda c: s.either(F.col(f"a_{c}"), F.col(f"b_{c}"))
    return {"postal_code_match": state("postal_code"), "country_match": state("country"), "legal_suffix_match": state("name_legal_suffix"), "either_is_domain": flag("name_is_domain"), "either_has_non_latin_script": flag("has_non_latin_script")}


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with is_match, from truth's exploded pairs."""
    known = truth.select(*PAIR).distinct().withColumn("is_match", F.lit(True))
    return pairs.join(known, PAIR, "left").withColumn("is_match", F.coalesce("is_match", F.lit(False)))


def pair_features(pairs: DataFrame, clean: DataFrame, truth: DataFrame | None = None) -> DataFrame:
    """The contract's columns: two ids, ten floats, and is_match if truth is given."""
    # Pairs get their labels while they are two ids wide.
    narrow = pairs.select(*PAIR) if truth is None else label(pairs.select(*PAIR), truth)
    both = with_records(narrow, clean)
    columns = ratios() | name_address(both) | context()
    return both.select(*PAIR, *[columns[f].cast("float").alias(f) for f in FEATURES], *narrow.columns[2:])


def comparable(features: DataFrame) -> DataFrame:
    """n, comparable, percent of pairs whose postal codes can be compared."""
    n = F.count_if(F.col("postal_code_match") != -1)
    return features.agg(F.count("*").alias("n"), n.alias("comparable"), F.round(F.coalesce(F.try_divide(100.0 * n, F.count("*")), F.lit(0.0)), 6).alias("percent"))


def means_by_label(features: DataFrame) -> DataFrame:
    """n and the mean of each feature by is_match; rows without a label are a group of their own."""
    return features.groupBy("is_match").agg(F.count("*").alias("n"), *[F.round(F.avg(c), 6).alias(c) for c in FEATURES if c in features.columns])


def describe(features: DataFrame, columns: list[str]) -> DataFrame:
    """One row a column: count, mean, std, least, quartiles, most; all columns in one pass, quartiles from the counts of values."""
    long = features.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")).select("x.*")
    v = F.col("value")
    whole = long.groupBy("feature").agg(F.count(v).alias("n"), F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev(v), 6).alias("std"), F.round(F.min(v), 6).alias("least"), F.round(F.max(v), 6).alias("most"))
    parts = percentiles(long, "feature", "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return whole.join(parts, "feature", "left").select("feature", "n", "mean", "std", "least", *[F.round(p, 6).alias(p) for p in ("p25", "p50", "p75")], "most")
