"""What queries on pairs do once, and what a pair may cost."""

import random
import time

import pytest

from confluo.functions import similarity as s
from confluo.operators import blocking
from confluo.plans import catalogue
from confluo.plans.catalogue import QUERIES

DATA = "/root/testdata/sf0.001"


def _texts(rnd, n, words):
    known = ["".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(rnd.randrange(2, 10))) for _ in range(500)]
    return [" ".join(rnd.choice(known) for _ in range(words)) for _ in range(n)]


def _seconds(f):
    took = []
    for _ in range(3):
        start = time.process_time()
        f()
        took.append(time.process_time() - start)
    return min(took)


@pytest.mark.parametrize("words", [12, 28])
def test_grams_cost_less_than_plain_sets(words):
    rnd = random.Random(words)
    a, b = _texts(rnd, 4000, words), _texts(rnd, 4000, words)
    grams = lambda x: {x[i : i + 3] for i in range(max(1, len(x) - 2))}

    def plain():
        for x, y in zip(a, b):
            p, q = grams(x), grams(y)
            len(p & q) / len(p | q)

    assert _seconds(lambda: s.gram_jaccards(a, b)) < _seconds(plain)


def test_blocks_and_letters_change_nothing(monkeypatch):
    rnd = random.Random(5)
    a, b = ([x[: rnd.randrange(200)] + rnd.choice(["", "é", "中文", " "]) for x in _texts(rnd, 400, 20)] + ["", "a", "  ", "a b"] for _ in "ab")
    want = [f(a, b).tolist() for f in (s.gram_jaccards, s.sort_ratios, s.set_ratios)]
    monkeypatch.setattr(s, "ROWS", 700)
    monkeypatch.setattr(s, "CELLS", 500)
    monkeypatch.setattr(s, "LETTERS", 0)
    assert [f(a, b).tolist() for f in (s.gram_jaccards, s.sort_ratios, s.set_ratios)] == want


def test_word_jaccards_beside_sets():
    rnd = random.Random(6)
    a, b = ([" ".join(rnd.choice(["a", "b", "c", "", "dd"]) for _ in range(rnd.randrange(5))) for _ in range(500)] for _ in "ab")
    sets = [[set(x.split(" ")) - {""} for x in side] for side in (a, b)]
    assert s.word_jaccards(a, b).tolist() == [len(p & q) / len(p | q) if p and q else 0.0 for p, q in zip(*sets)]


def _plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_are_labelled_while_narrow(spark):
    """No features go through the join with the truth."""
    for name in ("pair_features", "feature_means_by_label"):
        lines = _plan(spark, name).splitlines()
        measured = max(i for i, line in enumerate(lines) if "ArrowEvalPython" in line)
        assert measured < min(i for i, line in enumerate(lines) if "Join" in line), name


def test_description_makes_features_once(spark):
    assert "name_clean" not in _plan(spark, "feature_describe")


def test_summary_makes_scores_once(spark):
    assert "name_clean" not in _plan(spark, "score_summary")


def test_summary_needs_no_labels(spark, monkeypatch):
    """Scores come without the truth, and are those of the labelled pairs."""
    want = sorted(r.score for r in catalogue._cheap(spark, DATA).select("score").collect())
    monkeypatch.setattr(catalogue.fixture, "truth", None)
    assert QUERIES["score_summary"](spark, DATA).first().n == len(want)
    assert sorted(r.score for r in catalogue._scores(spark, DATA).collect()) == want


def test_equal_pairs_are_measured_once():
    seen = []

    def lengths(a, b):
        seen.append(len(a))
        return s.np.array([len(x) - len(y) for x, y in zip(a, b)])

    assert s._once(lengths, ["a", "bb", "a", "a"], ["", "b", "", "b"]).tolist() == [1, 1, 1, 0] and seen == [3]
    assert s._once(lengths, [], []).tolist() == []


@pytest.mark.parametrize("name", ["grouped_split", "split_leakage"])
def test_split_blocks_once(spark, name):
    assert "name_clean" not in _plan(spark, name)


def test_candidates_shuffle_pairs_once(spark):
    rows = [("S1-1", "a b", "x y z", "US"), ("S2-1", "a", "x y", "US"), ("S3-1", "q", "x y z", "US")]
    clean = spark.createDataFrame(rows, "entity_id string, name_clean string, address_clean string, country string")
    plan = blocking.candidates(clean)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(s1#" in line for line in plan.splitlines()) == 1
    assert {tuple(r) for r in blocking.candidates(clean).collect()} == {("S1-1", "S2-1", "S2", 0, 1, 1), ("S1-1", "S3-1", "S3", 1, 3, 1)}


def _plain_candidates(rows, per_source, cap):
    """blocking.candidates by loops over rows (id, name, address), one country, no common words."""
    met = {}
    for k in (1, 2):
        words = {}
        for r in sorted(r for r in rows if not r[0].startswith("S1")):
            for w in r[k].split():
                words.setdefault(w, []).append(r[0])
        for r in (r for r in rows if r[0].startswith("S1")):
            for w in r[k].split():
                for other in words.get(w, [])[:cap]:
                    met.setdefault((r[0], other), {1: 0, 2: 0})[k] += 1
    out, groups = set(), {}
    for (s1, cand), n in met.items():
        if n[1] or n[2] >= blocking.ADDRESS_LEAST:
            groups.setdefault((s1, cand[:2]), []).append((0 if n[1] else 1, -(n[1] or n[2]), cand))
    for (s1, src), pairs in groups.items():
        out |= {(s1, cand, src, method, -less, i) for i, (method, less, cand) in enumerate(sorted(pairs)[:per_source], 1)}
    return out


@pytest.mark.parametrize("per_batch", [1, 7, 10000])
def test_candidates_meet_in_lists(spark, monkeypatch, per_batch):
    """Ids go through the join and the shuffle in lists; sums and ranks are those of plain loops, wherever lists and batches end."""
    rnd = random.Random(per_batch)
    some = lambda n: " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(n)))
    rows = [(f"S{i % 3 + 1}-{i}", some(3), some(6)) for i in range(30)]
    monkeypatch.setattr(blocking, "CHUNK", 3)
    monkeypatch.setattr(blocking, "FLOOR", 1000)
    clean = spark.createDataFrame([(*r, "US") for r in rows], "entity_id string, name_clean string, address_clean string, country string")
    sizes = {len(r.cands) for r in blocking._met_lists(clean, "address_clean", 8).collect()}
    assert max(sizes) == 3
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        got = {tuple(r) for r in blocking.candidates(clean, 4, 8).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert got == _plain_candidates(rows, 4, 8) and got


@pytest.mark.parametrize("per_source", [1, 2, 4, 50])
def test_sources_that_names_fill_need_no_addresses(spark, monkeypatch, per_source):
    """Without a cap the lists by address are those of the sources that no name word fills; candidates are those of plain loops."""
    rnd = random.Random(per_source)
    some = lambda words, n: " ".join(rnd.choice(words) for _ in range(rnd.randrange(n)))
    rows = [(f"S{i % 3 + 1}-{i}", some("abcdefghijkl", 4), some("stuvwxyz", 7)) for i in range(60)]
    monkeypatch.setattr(blocking, "FLOOR", 1000)
    clean = spark.createDataFrame([(*r, "US") for r in rows], "entity_id string, name_clean string, address_clean string, country string")
    whole = blocking._met_lists(clean, "address_clean", None).count()
    fewer = blocking._met_lists(blocking._with_full(clean, "name_clean", per_source, None), "address_clean", None).count()
    assert fewer < whole if per_source < 50 else fewer == whole
    assert {tuple(r) for r in blocking.candidates(clean, per_source, None).collect()} == _plain_candidates(rows, per_source, None)
