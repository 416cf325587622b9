"""The command line from raw tables to a checked match list, files as they come, and plans."""

import random

import pytest
from pyspark.sql import functions as F

from confluo import cli
from confluo.functions import similarity as s
from confluo.functions import text as t
from confluo.operators import assign, features, order, records, sampling, validate
from confluo.operators.features import PAIR
from confluo.plans import fixture
from confluo.sources import staging, tables
from confluo.streaming.clean import score_stream

DATA = "/root/testdata/sf0.001"


def one(spark, f, *values):
    row = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first().x


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """The derived records and their truth, as the contract's files."""
    at = tmp_path_factory.mktemp("cli")
    raw = fixture.records(spark, DATA).toPandas()
    raw.to_csv(at / "raw.tsv", sep="\t", index=False)
    truth = fixture.truth(spark, DATA).toPandas().groupby(PAIR[0])[PAIR[1]].agg(",".join)
    s1 = raw[raw.entity_id.str.startswith("S1-")].entity_id
    lines = [f"{i}\t{truth.get(i, '')}" for i in s1]
    (at / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "\n".join(lines) + "\n")
    (at / "test1.tsv").write_text("entity_id\tbusiness_name\n" + "\n".join(f"{i}\tx" for i in s1) + "\n")
    return at


def test_command_line(spark, files, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    run = lambda *a: cli.main([str(x) for x in a])
    assert run("normalize", "--inputs", files / "raw.tsv", "--output", files / "clean.parquet") == 0
    assert run("block", "--inputs", files / "clean.parquet", "--output", files / "cand", "--per-source", 5) == 0
    text = "".join(p.read_text() for p in sorted((files / "cand").glob("part-*")))
    (files / "cand.tsv").write_text(text)
    assert text.startswith("source1_entity_id\tcandidate_entity_ids\n")
    assert run("block", "--inputs", files / "clean.parquet", "--output", files / "none", "--country", "Mars") == 1
    assert run("features", "--inputs", files / "clean.parquet", "--candidates", files / "cand.tsv", "--output", files / "f.parquet", "--truth", files / "truth.tsv") == 0
    rows = spark.read.parquet(str(files / "f.parquet"))
    assert rows.columns == [*PAIR, *features.FEATURES, "is_match"] and dict(rows.dtypes)["name_token_set_ratio"] == "float"
    assert run("train", "--features", files / "f.parquet", "--model", files / "model", "--output", files / "scores.parquet", "--rounds", 2) == 0
    assert run("score", "--features", files / "f.parquet", "--model", files / "model", "--output", files / "again.parquet") == 0
    assert spark.read.parquet(str(files / "again.parquet")).count() == rows.count()
    for name, more in (("m", ["--threshold", 0.5]), ("tuned", ["--truth", files / "truth.tsv"])):
        assert run("assign", "--inputs", files / "raw.tsv", "--scores", files / "scores.parquet", "--output", files / name, *more) == 0
        (files / f"{name}.tsv").write_text("".join(p.read_text() for p in sorted((files / name).glob("part-*"))))
    assert run("evaluate", "--inputs", files / "raw.tsv", "--matches", files / "m.tsv", "--truth", files / "truth.tsv") == 0
    capsys.readouterr()
    check = ["validate", "--matches", files / "m.tsv", "--test", files / "test1.tsv"]
    assert run(*check, "--candidates", files / "cand.tsv", "--check-ids", files / "raw.tsv") == 0
    assert run("validate", "--matches", files / "none.tsv", "--test", files / "test1.tsv") == 1
    assert run(*check[:4], files / "missing.tsv") == 1
    bad = (files / "m.tsv").read_bytes()
    (files / "bad.tsv").write_bytes(bad[:-1] + b",S2-\xe9\n")
    assert run("validate", "--matches", files / "bad.tsv", "--test", files / "test1.tsv") == 1
    assert run("validate", "--matches", files / "m.tsv", "--test", files / "bad.tsv") == 1
    assert "not UTF-8" in capsys.readouterr().out
    (files / "odd.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-3\tX9-1\n")
    assert run("features", "--inputs", files / "clean.parquet", "--candidates", files / "odd.tsv", "--output", files / "odd.parquet") == 0
    assert "1 candidates have neither" in capsys.readouterr().out
    assert run("sample", "--inputs", files / "raw.tsv", "--truth", files / "truth.tsv", "--output", files / "sample") == 0
    assert run("profile", "--inputs", files / "raw.tsv", "--truth", files / "truth.tsv") == 0
    assert sampling.few_rows(records.clean(fixture.records(spark, DATA)), "entity_id", 4).count() == 4


def test_scores_of_a_stream(spark, files, tmp_path):
    from confluo.operators import model

    rows = spark.read.parquet(str(files / "f.parquet"))
    rows.write.parquet(str(tmp_path / "in"))
    score_stream(spark, model.load(str(files / "model")), str(tmp_path / "in"), rows.schema.simpleString()[7:-1].replace(",", ", ").replace(":", " "), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.count()


def test_digits_and_letters_of_other_scripts(spark):
    assert one(spark, t.postal_code, "x, Delhi ११०००१") == "११०००१"
    assert one(spark, t.postal_code, "x, Delhi 110001 ११") == ""
    assert one(spark, t.fold_latin, "é ɑɔə ʃ ß ł ﬁ") == "e ao@ S ss l fi"
    assert [one(spark, t.has_non_latin, x) for x in ("abc", "é ñ ß", "ª", "µ", "दिल्ली", "x 中", "́", "—", None)] == [False, False, True, True, True, True, True, False, False]
    assert one(spark, t.collapse_acronyms, "l.l.c. u.s.a l.p.") == "llc us.a lp"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_ratios_beside_plain_python(spark):
    rnd = random.Random(2)
    words = ["acme", "acne", "beta", "bet", "co", "é", "中文", "x"]
    rows = [[" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 5))) for _ in "ab"] for _ in range(300)]

    def ratio(x, y):
        return 1.0 if not x and not y else 2 * plain_lcs(x, y) / (len(x) + len(y))

    def sorted_words(x, y):
        return 0.0 if not x or not y else ratio(" ".join(sorted(x.split())), " ".join(sorted(y.split())))

    def sets(x, y):
        a, b = set(x.split()), set(y.split())
        if not a or not b:
            return 0.0
        if a & b and (a <= b or b <= a):
            return 1.0
        both, left, right = (" ".join(sorted(z)) for z in (a & b, a - b, b - a))
        joined = [" ".join(z for z in (both, w) if z) for w in (left, right)]
        apart = len(left) + len(right) - 2 * plain_lcs(left, right)
        best = 1 - apart / (len(joined[0]) + len(joined[1]))
        return max(best, *[ratio(both, z) for z in joined]) if both else best

    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", s.token_sort_ratio(F.col("a"), F.col("b")).alias("x"), s.token_set_ratio(F.col("a"), F.col("b")).alias("y")).collect()
    for r in got:
        assert (r.x, r.y) == (pytest.approx(sorted_words(r.a, r.b)), pytest.approx(sets(r.a, r.b))), (r.a, r.b)


@pytest.mark.parametrize("alphabet", ["abc ", "ab中\U0001f600é ", "many"])
def test_gram_jaccards_beside_sets(alphabet, monkeypatch):
    rnd = random.Random(len(alphabet))
    letters = alphabet if alphabet != "many" else [chr(i) for i in range(0x4E00, 0x9E00)] + ["a", " "] * 5000
    pairs = [["".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 3, 4, 30, 200]))) for _ in range(600)] for _ in "ab"]
    grams = lambda x: {x[i : i + 3] for i in range(max(1, len(x) - 2))}
    want = [0.0 if not x.strip(" ") or not y.strip(" ") else len(grams(x) & grams(y)) / len(grams(x) | grams(y)) for x, y in zip(*pairs)]
    assert s.gram_jaccards(*pairs).tolist() == want
    monkeypatch.setattr(s, "CELLS", 500)
    assert s.gram_jaccards(*pairs).tolist() == want
    if alphabet == "many":
        wide = [x * 40 for x in pairs]
        monkeypatch.setattr(s, "CELLS", 1 << 30)
        assert len(set("".join(wide[0]))).bit_length() * 3 + len(wide[0]).bit_length() > 50
        assert s.gram_jaccards(*wide).tolist() == want * 40


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        df = tables.read_lines(spark, str(tmp_path / "a.txt"))
        assert [(r.line, r.value) for r in df.orderBy("line").collect()] == list(enumerate(lines, 1))
    finally:
        spark.conf.set(key, before)
    (tmp_path / "e.txt").write_text("")
    assert tables.read_lines(spark, str(tmp_path / "e.txt")).count() == 0


def test_places_and_percentiles(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), rnd.choice([rnd.random() * 3 - 1.5, 0.5, float(rnd.randrange(-9, 9))]), i) for i in range(500)] + [("a", None, 500)]
    df = spark.createDataFrame(rows, "g string, v double, k long")
    got = {r.g: (r.p, r.q) for r in order.percentiles(df, "g", "v", {"p": 0.25, "q": 0.5}).collect()}
    want = {r.g: (r.p, r.q) for r in df.groupBy("g").agg(F.percentile("v", 0.25).alias("p"), F.percentile("v", 0.5).alias("q")).collect()}
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g]) for g in got)
    placed = order.ranked(df, "g", sampling.order_key("k"), "k").collect()
    for g in "ab":
        own = sorted((r for r in placed if r.g == g), key=lambda r: r._r)
        assert [r._r for r in own] == list(range(1, len(own) + 1)) and {r._n for r in own} == {len(own)}
    few = order.ranked(df, "g", sampling.order_key("k"), "k", F.lit(7)).collect()
    assert {(r.k, r._r) for r in few} == {(r.k, r._r) for r in placed if r._r <= 7}
    sums = order.running(df.where("v IS NOT NULL").groupBy("g", "v").agg(F.count("*").alias("n")), ["g"], "v", {"n": "upto"}, down=True).collect()
    for r in sums:
        assert r.upto == sum(x.n for x in sums if x.g == r.g and x.v >= r.v)


def test_first_and_last_rows(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", None, 5)], "entity_id string, v string, o int")
    assert {tuple(r) for r in records.first_rows(df, "o").collect()} == {("a", "y", 1), ("b", None, 5)}
    assert {tuple(r) for r in records.last_rows(df, "o").collect()} == {("a", "x", 2), ("b", None, 5)}


def test_flags_of_text_files(spark):
    clean = spark.createDataFrame([("S1-1", "a", "b", "", "US", "", "True", "no"), ("S2-1", "a", "b", "", "US", "", "", "yes")], "entity_id string, name_clean string, address_clean string, postal_code string, country string, name_legal_suffix string, name_is_domain string, has_non_latin_script string")
    got = features.pair_features(spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S9-1")], ", ".join(f"{c} string" for c in PAIR)), clean).orderBy(PAIR[1]).collect()
    assert [(r.either_is_domain, r.either_has_non_latin_script, r.country_match, r.name_token_set_ratio) for r in got] == [(1, 1, 1, 1), (1, 0, -1, 0)]
    assert [one(spark, t.truthy, x) for x in ("TRUE", " 1", "yes", "t", "0", "", None)] == [True, True, True, True, False, False, False]


@pytest.mark.parametrize("made", ["grouped_split", "auc_ap", "score_summary", "feature_describe"])
def test_no_window_holds_a_whole_table(spark, made):
    """Windows over one or two keys see blocks' counts only, never rows of pairs."""
    scored = spark.createDataFrame([("S1-1", "S2-1", 0.5, True)], "source1_entity_id string, candidate_entity_id string, score double, is_match boolean")
    plans = {"grouped_split": lambda: sampling.grouped_split(scored), "auc_ap": lambda: assign.ranking_metrics(scored), "score_summary": lambda: assign.score_summary(scored), "feature_describe": lambda: features.describe(scored, ["score"])}
    plan = plans[made]()._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_b" in line or "sum(_k" in line for line in windows)


def test_header_and_shared_folder(spark, monkeypatch):
    assert validate.check_header(None, validate.HEADERS["matches"]) == ["empty file"]
    assert validate.check_header("a\tb", validate.HEADERS["matches"]) == ["unexpected header"]
    assert validate.check_header("Source1_Entity_Id \tmatched_entity_ids", validate.HEADERS["matches"]) == []

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *_: None)})

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))}))

    with pytest.raises(RuntimeError):
        staging.shared_dir(Cluster())
