import pytest
from pyspark.sql import functions as F

from confluo.operators import assign, blocking, features, model, records, sampling, validate
from confluo.operators.features import PAIR
from confluo.sources import tables
from confluo.streaming.clean import clean_stream

SCORES = "source1_entity_id string, candidate_entity_id string, score double"
PAIRS = "source1_entity_id string, candidate_entity_id string"


def test_worked_example(spark):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "source1_entity_id string")
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1")], PAIRS)
    got = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-1", "S3-2"), ("S1-3", "S2-9")], PAIRS)
    f = {r[PAIR[0]]: r.f05 for r in assign.entity_f05(got, truth, s1).collect()}
    assert f["S1-1"] == pytest.approx(0.714, abs=5e-4) and f["S1-2"] == 1 and f["S1-3"] == 0


def test_assignment_and_sweep(spark):
    rows = [("S1-1", "S2-1", 0.9), ("S1-2", "S2-1", 0.9), ("S1-2", "S2-2", 0.4), ("S1-3", "S3-1", 0.2)]
    scores = spark.createDataFrame(rows, SCORES)
    assert {tuple(r) for r in assign.assign(scores, 0.4).collect()} == {("S1-1", "S2-1", 0.9), ("S1-2", "S2-2", 0.4)}
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "source1_entity_id string")
    truth = spark.createDataFrame([("S1-1", "S2-1")], PAIRS)
    sweep = assign.threshold_sweep(scores, truth, s1)
    for r in sweep.collect():
        assert r.macro_f05 == assign.macro_f05(assign.assign(scores, r.threshold), truth, s1).first().macro_f05
    assert assign.best_threshold(sweep) == 0.9


def test_ranking_metrics(spark):
    scored = spark.createDataFrame([(0.9, True), (0.8, False), (0.8, True), (0.1, False)], "score double, is_match boolean")
    got = assign.ranking_metrics(scored).first()
    assert got.auc == pytest.approx(0.875) and got.average_precision == pytest.approx((1 + 2 / 3) / 2, abs=1e-6)


def test_blocking_ties_and_multiplicity(spark):
    rows = [("S1-1", "a a b", "x y z", "US"), ("S2-1", "a a", "", "US"), ("S2-2", "b", "", "US"), ("S3-1", "q", "x y z", "US"), ("S3-2", "a", "", "FR"), ("S3-3", None, "x y", "US")]
    clean = spark.createDataFrame(rows, "entity_id string, name_clean string, address_clean string, country string")
    got = {(r.cand, r.method, r.shared, r["rank"]) for r in blocking.candidates(clean).collect()}
    assert got == {("S2-1", 0, 4, 1), ("S2-2", 0, 1, 2), ("S3-1", 1, 3, 1)}
    assert [tuple(r) for r in blocking.candidate_lists(clean, blocking.candidates(clean)).collect()] == [("S1-1", "S2-1,S2-2,S3-1")]
    assert blocking.candidates(clean.limit(0)).count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNA\t"x, y"\t\nS2-1\t\tb\tUS\n')
    df = tables.read_table(spark, str(tmp_path / "a.tsv"), tables.RECORD)
    assert [tuple(r) for r in df.collect()] == [("S1-1", "NA", "x, y", ""), ("S2-1", "", "b", "US")]
    (tmp_path / "p.tsv").write_text("source1_entity_id\tcandidate_entity_ids\n S1-1 \tS2-1, S2-2\nS1-2\t\n")
    assert sorted(map(tuple, tables.read_pairs(spark, str(tmp_path / "p.tsv")).collect())) == [("S1-1", "S2-1"), ("S1-1", "S2-2")]
    assert [r.entity_id for r in tables.read_ids(spark, str(tmp_path / "a.tsv")).orderBy("entity_id").collect()] == ["S1-1", "S2-1"]
    with pytest.raises(ValueError):
        tables.read_pairs(spark, str(tmp_path / "a.tsv"))
    lists = spark.createDataFrame([("S1-2", ""), ("S1-1", "S2-1,S2-2")], "source1_entity_id string, matched_entity_ids string")
    tables.write_matches(lists, str(tmp_path / "out"), 1)
    out = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert out == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-2\nS1-2\t\n"
    required = spark.createDataFrame([("S1-1",), ("S1-3",)], "entity_id string")
    (tmp_path / "m.tsv").write_text(out)
    errors, report = validate.validate_file(spark, str(tmp_path / "m.tsv"), "matches", required)
    got = {r.rule: (r.n, r.examples) for r in report.collect()}
    assert not errors and got["missing"] == (1, "S1-3") and got["extra"] == (1, "S1-2") and not validate.passed(report)
    (tmp_path / "c.csv").write_text("a,b\n1,2\n")
    assert validate.validate_file(spark, str(tmp_path / "c.csv"), "matches", required)[0] == ["comma-separated header"]
    assert validate.validate_file(spark, str(tmp_path / "none"), "matches", required)[0]


def test_scan_pushes_filter_and_columns(spark, tmp_path):
    spark.createDataFrame([("S1-1", "a", "b", "US", "z")], "entity_id string, name_clean string, address_clean string, country string, other string").write.parquet(str(tmp_path / "c"))
    plan = tables.read_clean(spark, str(tmp_path / "c"), "US")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(country,US)" in plan and "other" not in plan


def test_split_model_and_empty_scoring(spark, tmp_path):
    rows = [(f"S1-{i}", f"S2-{i}-{k}", *[float((i * 7 + k * 3 + j) % 10) / 10 + (0.5 if k == 0 and i % 2 else 0.0) for j in range(10)], k == 0 and i % 2 == 1) for i in range(40) for k in range(3)]
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, " + ", ".join(f"{f} double" for f in features.FEATURES) + ", is_match boolean")
    split = sampling.grouped_split(df)
    assert sampling.leakage(split).first().n == 0
    assert split.where("is_val").select(PAIR[0]).distinct().count() == 8
    fitted = model.fit(df, rounds=3, depth=2)
    model.save(fitted, str(tmp_path / "m"))
    again = model.load(str(tmp_path / "m"))
    scores = model.score(again, df)
    assert scores.where("score < 0 OR score > 1 OR score IS NULL").isEmpty() and scores.count() == len(rows)
    assert model.score(again, df.limit(0)).count() == 0
    assert model.importance(fitted).agg(F.sum("percent")).first()[0] == pytest.approx(100, abs=1e-3)


def test_unknown_country_and_last_rows(spark):
    df = spark.createDataFrame([("a", "US", 1), ("a", "India", 2)], "entity_id string, country string, o int")
    with pytest.raises(ValueError):
        records.only_country(df, "FR")
    assert records.countries(df) == ["India", "US"]
    assert records.last_rows(df, "o").first().country == "India"


def test_stream(spark, tmp_path):
    raw = spark.createDataFrame([("S1-1", "Acme LLC", "x, Paris 75001", "FR")], tables.RECORD)
    raw.write.parquet(str(tmp_path / "in"))
    clean_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).first()
    assert (got.name_clean, got.name_legal_suffix, got.postal_code) == ("acme", "llc", "75001")
