"""Registered queries: every operator applied to the derived records of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.functions import text as t
from confluo.operators import assign, blocking, features, model, profile, records, sampling, validate
from confluo.operators.features import PAIR
from confluo.plans import fixture
from confluo.sources import tables
from confluo.sources.staging import staged

#: Candidates a source for the queries on pairs (the operator's own), and the small cap that shows the cap's effect.
FEW, SMALL_CAP = blocking.PER_SOURCE, 3
QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return fixture.records(spark, d)


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return records.clean(_raw(spark, d))


def _clean_table(spark: SparkSession, d: str) -> DataFrame:
    """Clean records, written: blocking and features read them up to ten times, and cleaning costs more than a read."""
    return staged(_clean(spark, d), "clean")


def _pairs(clean: DataFrame, k: int = FEW, cap: int | None = blocking.POSTING_CAP) -> DataFrame:
    return blocking.candidates(clean, k, cap).select(F.col("s1").alias(PAIR[0]), F.col("cand").alias(PAIR[1]))


def _score():
    return F.round((F.col("name_char_ngram_jaccard") + F.col("address_token_jaccard")) / 2, 6).alias("score")


def _scores(spark: SparkSession, d: str) -> DataFrame:
    """The score of each pair alone: no labels, so no join with the truth, which leaves a pair one row anyway, and no other fields of the records."""
    # In the order of ids before they are cleaned, since dealing rows out by ranges reads them twice.
    clean = staged(blocking.numbered(features.with_sets(records.clean(blocking.in_order(_raw(spark, d))))), "clean")
    return features.name_address_alone(_pairs(clean), clean).select(_score())


def _cheap(spark: SparkSession, d: str, all_ten: bool = False) -> DataFrame:
    """Pairs with the set features (or all), is_match and score, the mean of two of them."""
    clean = _clean_table(spark, d)
    both = features.with_records(features.label(_pairs(clean), fixture.truth(spark, d)), clean)
    made = (features.ratios() if all_ten else {}) | features.name_address(both) | features.context()
    out = both.select(*PAIR, *[c.alias(n) for n, c in made.items()], "is_match")
    return out.withColumn("score", _score())


def _s1(spark: SparkSession, d: str) -> DataFrame:
    return fixture.primary(_raw(spark, d))


@query
def normalize_text(spark, d):
    return _raw(spark, d).select("entity_id", t.normalize_text(F.col("business_name")).alias("name"), t.normalize_text(F.col("business_address")).alias("address"))


@query
def acronym_collapse(spark, d):
    """Dotted initials made of each name's first letters."""
    c = F.lower(F.concat_ws(".", F.substring("business_name", 1, 1), F.substring("country", 1, 1), F.lit("c. "), F.col("business_name")))
    return _raw(spark, d).select("entity_id", t.collapse_acronyms(c).alias("name"))


@query
def transliterate_nfc(spark, d):
    return _raw(spark, d).select("entity_id", t.fold_latin(F.lower("business_name")).alias("name"))


@query
def name_suffix(spark, d):
    return _clean(spark, d).select("entity_id", "name_clean", "name_legal_suffix")


@query
def domain_flag(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet")
    return pages.select("page_id", t.is_domain(F.col("url")).alias("is_domain"), t.is_domain(F.split_part("url", F.lit("?"), F.lit(1))).alias("bare_is_domain"))


@query
def postal_code(spark, d):
    return _raw(spark, d).select("entity_id", t.postal_code(F.col("business_address")).alias("postal_code"))


@query
def address_expand(spark, d):
    return _clean(spark, d).select("entity_id", "address_clean")


@query
def non_latin_flag(spark, d):
    return _raw(spark, d).select("entity_id", t.has_non_latin(F.col("business_address")).alias("non_latin"), t.has_non_latin(F.col("business_name")).alias("name_non_latin"))


@query
def clean_records(spark, d):
    return _clean(spark, d)


@query
def clean_stats(spark, d):
    return records.clean_stats(_clean(spark, d))


@query
def country_histogram(spark, d):
    return records.country_histogram(_raw(spark, d))


@query
def token_postings(spark, d):
    rows = blocking.token_rows(_clean(spark, d), "name_clean")
    return rows.groupBy("country", "token").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("records"))


@query
def common_tokens(spark, d):
    return blocking.common_tokens(_clean_table(spark, d), "address_clean")


@query
def posting_cap(spark, d):
    return blocking.postings(_clean_table(spark, d), "name_clean", SMALL_CAP)


@query
def block_name(spark, d):
    return blocking.shared_tokens(_clean_table(spark, d), "name_clean")


@query
def block_address(spark, d):
    return blocking.shared_tokens(_clean_table(spark, d), "address_clean", blocking.ADDRESS_LEAST)


@query
def candidate_topk(spark, d):
    return blocking.candidates(_clean_table(spark, d))


@query
def candidate_lists(spark, d):
    clean = _clean_table(spark, d)
    return blocking.candidate_lists(clean, blocking.candidates(clean, FEW))


@query
def candidate_stats(spark, d):
    clean = _clean_table(spark, d)
    return blocking.candidate_stats(blocking.candidate_lists(clean, blocking.candidates(clean, FEW)))


@query
def explode_pairs(spark, d):
    return tables.explode_pairs(candidate_lists(spark, d))


@query
def first_ten_pairs(spark, d):
    return blocking.first_ten(_raw(spark, d))


@query
def label_pairs(spark, d):
    return features.label(_pairs(_clean_table(spark, d)), fixture.truth(spark, d))


@query
def name_ngram_jaccard(spark, d):
    return _cheap(spark, d).select(*PAIR, F.round("name_char_ngram_jaccard", 6).alias("jaccard"))


@query
def address_jaccard(spark, d):
    return _cheap(spark, d).select(*PAIR, F.round("address_token_jaccard", 6).alias("tokens"), F.round("address_char_ngram_jaccard", 6).alias("grams"))


@query
def context_features(spark, d):
    return _cheap(spark, d).select(*PAIR, "postal_code_match", "country_match", "legal_suffix_match", "either_is_domain", "either_has_non_latin_script")


def _ratio(spark, d, name):
    clean = _clean_table(spark, d)
    return features.with_records(_pairs(clean), clean).select(*PAIR, F.round(features.ratios()[name], 6).alias("ratio"))


@query
def token_sort_ratio(spark, d):
    return _ratio(spark, d, "name_token_sort_ratio")


@query
def token_set_ratio(spark, d):
    return _ratio(spark, d, "name_token_set_ratio")


def _features(spark: SparkSession, d: str, cap: int | None = blocking.POSTING_CAP) -> DataFrame:
    clean = _clean_table(spark, d)
    return features.pair_features(_pairs(clean, cap=cap), clean, fixture.truth(spark, d))


@query
def pair_features(spark, d):
    return _features(spark, d)


@query
def comparable_postal(spark, d):
    return features.comparable(_cheap(spark, d))


@query
def feature_means_by_label(spark, d):
    return features.means_by_label(_cheap(spark, d, True))


@query
def feature_describe(spark, d):
    # Written, since moments and quartiles read them each: pairs and features are made once.
    return features.describe(staged(_cheap(spark, d, True).select(*features.FEATURES), "features"), features.FEATURES)


@query
def class_balance(spark, d):
    return model.class_balance(_cheap(spark, d))


@query
def grouped_split(spark, d):
    # Written, since the split reads them twice: blocking runs once.
    return sampling.grouped_split(staged(_cheap(spark, d).select(*PAIR, "is_match"), "labels"))


@query
def split_leakage(spark, d):
    return sampling.leakage(grouped_split(spark, d))


@query
def stratified_sample(spark, d):
    return sampling.stratified_sample(_s1(spark, d), fixture.truth(spark, d), {"none": 100, "one": 10, "many": 5})


@query
def distractors(spark, d):
    own = sampling.stratified_sample(_s1(spark, d), fixture.truth(spark, d), {"none": 100, "one": 10, "many": 5})
    return sampling.distractors(_raw(spark, d), own, fixture.truth(spark, d), 50).select("entity_id", "src")


@query
def sample_fixture(spark, d):
    return sampling.sample_fixture(_raw(spark, d), fixture.truth(spark, d), {"none": 100, "one": 10, "many": 5}, 50).select("entity_id")


@query
def pair_metrics(spark, d):
    return assign.pair_metrics(_cheap(spark, d))


@query
def auc_ap(spark, d):
    return assign.ranking_metrics(_cheap(spark, d))


@query
def score_summary(spark, d):
    # Written, since the counts and the median read them each: pairs are scored once.
    return assign.score_summary(staged(_scores(spark, d), "scores"))


_MODELS: dict = {}


def _boosted(spark, d):
    """The features of the pairs of all postings of rare words, with no cap, and the classifier fitted to them with the operator's own rounds: once for a session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _MODELS:
        rows = staged(_features(spark, d, None), "features")
        _MODELS[key] = rows, model.fit(rows)
    return _MODELS[key]


@query
def gbt_scores(spark, d):
    rows, m = _boosted(spark, d)
    return model.score(m, rows)


@query
def gbt_importance(spark, d):
    return model.importance(_boosted(spark, d)[1])


@query
def assign_one_to_one(spark, d):
    return assign.assign(_cheap(spark, d), 0.3)


@query
def match_lists(spark, d):
    return assign.packed_matches(_s1(spark, d), assign.assign(_cheap(spark, d), 0.3))


@query
def entity_f05(spark, d):
    return assign.entity_f05(assign.assign(_cheap(spark, d), 0.3), fixture.truth(spark, d), _s1(spark, d)).withColumn("f05", F.round("f05", 6))


@query
def macro_f05(spark, d):
    return assign.macro_f05(assign.assign(_cheap(spark, d), 0.3), fixture.truth(spark, d), _s1(spark, d))


@query
def threshold_sweep(spark, d):
    return assign.threshold_sweep(_cheap(spark, d), fixture.truth(spark, d), _s1(spark, d))


def faulty_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a match list made from the truth, with faults by document number."""
    return fixture._sql(spark, d, FAULTY)


FAULTY = """
SELECT doc_id + 2 AS line, CASE
    WHEN doc_id % 30 = 0 THEN 'S1-' || CAST(doc_id AS STRING)
    WHEN doc_id % 30 = 3 THEN 'S1-' || CAST(doc_id AS STRING) || chr(9) || 'S2-1,S2-1'
    WHEN doc_id % 30 = 6 THEN 'S1-' || CAST(doc_id AS STRING) || chr(9) || 'S1-3,X-9'
    WHEN doc_id % 30 = 7 THEN 'S1-' || CAST(doc_id - 1 AS STRING) || chr(9) || 'S3-2'
    WHEN doc_id % 30 = 9 THEN 'S1-' || CAST(doc_id AS STRING) || chr(9) || 'S2-999999'
    WHEN doc_id % 30 = 10 THEN '  '
    WHEN doc_id % 3 = 0 THEN 'S1-' || CAST(doc_id AS STRING) || chr(9)
    ELSE '' END AS value
FROM documents"""


@query
def validate_matches(spark, d):
    raw = _raw(spark, d)
    others = raw.where(~F.col("entity_id").startswith("S1-"))
    return validate.validate(validate.split_lines(faulty_lines(spark, d)), fixture.primary(raw).select(F.col(PAIR[0]).alias("entity_id")), fixture.truth(spark, d), others)


@query
def truth_profile(spark, d):
    return profile.truth_profile(_s1(spark, d), fixture.truth(spark, d))


@query
def match_histogram(spark, d):
    return profile.match_histogram(_s1(spark, d), fixture.truth(spark, d))


@query
def owner_conflicts(spark, d):
    return profile.owner_conflicts(fixture.truth(spark, d))


@query
def unmatched(spark, d):
    return profile.unmatched(_raw(spark, d), fixture.truth(spark, d))


@query
def matched_records(spark, d):
    return profile.matched_records(_raw(spark, d), fixture.truth(spark, d))
