"""Command line: normalize, block, features, train, score, assign, evaluate, validate, sample, profile. Run as python -m confluo.cli."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.operators import assign, blocking, features, model, profile, records, sampling, validate
from confluo.operators.features import PAIR
from confluo.sources import tables
from confluo.sources.staging import staged


def session() -> SparkSession:
    return SparkSession.builder.appName("confluo").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _all(spark: SparkSession, paths: list[str]) -> DataFrame:
    parts = [tables.read_table(spark, p) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _truth(spark: SparkSession, path: str) -> DataFrame:
    return tables.explode_pairs(tables.read_table(spark, path), PAIR[0], "matched_entity_ids", PAIR[1])


def _s1(df: DataFrame) -> DataFrame:
    return df.where(F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias(PAIR[0]))


def normalize(spark, a):
    clean = records.clean(_all(spark, a.inputs))
    tables.write_parquet(clean, a.output)
    records.clean_stats(spark.read.parquet(a.output)).show()


def block(spark, a):
    clean = _all(spark, a.inputs)
    if a.country:
        clean = records.only_country(clean, a.country)
    lists = staged(blocking.candidate_lists(clean, blocking.candidates(clean, a.per_source)), "lists")
    tables.write_packed(lists.withColumn("_o", F.col(PAIR[0])), a.output, "_o")
    blocking.candidate_stats(lists).show()


def make_features(spark, a):
    truth = _truth(spark, a.truth) if a.truth else None
    pairs = tables.read_pairs(spark, a.candidates)
    if n := features.unknown_sources(pairs).first()["n"]:
        print(f"warning: {n} candidates have neither the S2- nor the S3- prefix")
    tables.write_parquet(features.pair_features(pairs, _all(spark, a.inputs), truth), a.output)


def train(spark, a):
    rows = spark.read.parquet(a.features)
    fitted = model.fit(rows, a.rounds)
    model.save(fitted, a.model)
    model.importance(fitted).show()
    scored = model.score(fitted, rows)
    tables.write_parquet(scored, a.output)
    held = features.label(scored.join(sampling.grouped_split(rows).where("is_val").select(*PAIR, "is_match"), PAIR).drop("is_match"), rows.where("is_match"))
    assign.pair_metrics(held).show()
    assign.ranking_metrics(held).show()


def score(spark, a):
    rows = spark.read.parquet(a.features)
    tables.write_parquet(model.score(model.load(a.model), rows), a.output)
    scores = spark.read.parquet(a.output)
    assign.score_summary(scores).show()
    if not assign.same_rows(scores, rows):
        raise ValueError("the numbers of scores and of pairs differ")


def do_assign(spark, a):
    s1 = _s1(_all(spark, a.inputs))
    scores = spark.read.parquet(a.scores)
    limit = a.threshold
    if limit is None:
        limit = assign.best_threshold(assign.threshold_sweep(scores, _truth(spark, a.truth), s1))
    tables.write_matches(assign.packed_matches(s1, assign.assign(scores, limit)), a.output)


def evaluate(spark, a):
    assign.macro_f05(_truth(spark, a.matches), _truth(spark, a.truth), _s1(_all(spark, a.inputs))).show()


def do_validate(spark, a):
    for p in (a.test, *(a.check_ids or ()), *([a.candidates] if a.candidates else [])):
        if not p.endswith(".parquet") and tables.invalid_text(spark, p):
            raise ValueError(f"{p} is not UTF-8 text")
    required = tables.read_ids(spark, a.test)
    known = None
    for p in a.check_ids or ():
        ids = tables.read_ids(spark, p)
        known = ids if known is None else known.union(ids)
    cand = tables.read_pairs(spark, a.candidates) if a.candidates else None
    errors, report = validate.validate_file(spark, a.matches, "matches", required, candidates=cand, known=known)
    if report is not None:
        report.show(truncate=False)
    for e in errors:
        print(f"error: {e}")
    return int(bool(errors) or not validate.passed(report))


def sample(spark, a):
    tables.write_delimited(sampling.sample_fixture(_all(spark, a.inputs), _truth(spark, a.truth)), a.output)


def do_profile(spark, a):
    raw, truth = _all(spark, a.inputs), _truth(spark, a.truth)
    s1 = _s1(raw)
    for df in (records.country_histogram(raw), profile.truth_profile(s1, truth), profile.match_histogram(s1, truth), profile.owner_conflicts(truth), profile.unmatched(raw, truth), sampling.few_rows(profile.matched_records(raw, truth), PAIR[0], 10)):
        df.show(truncate=False)


COMMANDS = {
    "normalize": (normalize, ["inputs", "output"]),
    "block": (block, ["inputs", "output", "country?", "per_source"]),
    "features": (make_features, ["inputs", "candidates", "output", "truth?"]),
    "train": (train, ["features", "model", "output", "rounds"]),
    "score": (score, ["features", "model", "output"]),
    "assign": (do_assign, ["inputs", "scores", "output", "threshold?", "truth?"]),
    "evaluate": (evaluate, ["inputs", "matches", "truth"]),
    "validate": (do_validate, ["matches", "test", "candidates?", "check_ids?"]),
    "sample": (sample, ["inputs", "truth", "output"]),
    "profile": (do_profile, ["inputs", "truth"]),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="confluo")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, (_, flags) in COMMANDS.items():
        p = sub.add_parser(name)
        for f in flags:
            flag, optional = "--" + f.rstrip("?").replace("_", "-"), f.endswith("?")
            if f in ("per_source", "rounds"):
                p.add_argument(flag, type=int, default={"per_source": blocking.PER_SOURCE, "rounds": 500}[f])
            elif f == "threshold?":
                p.add_argument(flag, type=float)
            else:
                p.add_argument(flag, required=not optional, nargs="+" if f in ("inputs", "check_ids?") else None)
    a = parser.parse_args(argv)
    try:
        return COMMANDS[a.command][0](session(), a) or 0
    except (OSError, ValueError, AnalysisException) as e:  # such as a missing file
        print(f"FAIL: {e}")
        return 1


if __name__ == "__main__":
    sys.exit(main())
