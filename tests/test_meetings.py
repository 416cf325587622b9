"""Measures of pairs that share a right side: those of the plain ones, for less."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from confluo.functions import meetings as m
from confluo.functions import similarity as s
from confluo.operators import blocking
from confluo.plans import catalogue
from confluo.sources.staging import staged


def _pairs(rnd, n, letters, sides=20):
    some = lambda: "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 3, 4, 30, 90])))
    right = [some() for _ in range(sides)] + ["", " ", "  ", "ab", "a a"]
    return [rnd.choice([some(), rnd.choice(right)]) for _ in range(n)], [rnd.choice(right) for _ in range(n)]


def _grams(a, b):
    return m.gram_meetings(pa.array(a, pa.string()), pa.array(b, pa.string()), *[np.array([m.gram_count(x) for x in side]) for side in (a, b)])


def _words(a, b):
    return m.word_meetings(*[pa.array([m.word_set(x) for x in side], pa.string()) for side in (a, b)])


@pytest.mark.parametrize("text", [1, 300, 1 << 22])
@pytest.mark.parametrize("letters", ["ab ", "abcdefghij 0123456789", "".join(map(chr, range(32, 127))), "aé中𝄞 \x00"])
def test_meetings_beside_plain_measures(monkeypatch, letters, text):
    monkeypatch.setattr(m, "TEXT", text)
    monkeypatch.setattr(m, "RIGHTS", 3)
    a, b = _pairs(random.Random(text), 300, letters)
    assert _grams(a, b).tolist() == s.gram_jaccards(a, b).tolist()
    assert _words(a, b).tolist() == s.word_jaccards(a, b).tolist()


def test_no_pairs():
    assert _grams([], []).tolist() == [] and _words([], []).tolist() == []


def test_pairs_cost_less_by_meetings():
    rnd = random.Random(3)
    known = ["".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(rnd.randrange(2, 10))) for _ in range(500)]
    text = lambda words: " ".join(rnd.choice(known) for _ in range(words))
    rights = [text(26) for _ in range(120)]
    a, b = [text(26) for _ in range(5000)], [rights[i * 120 // 5000] for i in range(5000)]
    p, q = (np.array([m.gram_count(x) for x in side]) for side in (a, b))
    x, y, v, w = pa.array(a), pa.array(b), pa.array([m.word_set(t) for t in a]), pa.array([m.word_set(t) for t in b])

    def seconds(*work):
        took = []
        for _ in range(3):
            start = time.process_time()
            for f in work:
                f()
            took.append(time.process_time() - start)
        return min(took)

    assert seconds(lambda: m.gram_meetings(x, y, p, q), lambda: m.word_meetings(v, w)) < 0.75 * seconds(lambda: s.gram_jaccards(a, b), lambda: s.word_jaccards(a, b))


def test_summary_measures_by_meetings(spark):
    """No pair's texts go through the column functions."""
    plan = catalogue._scores(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow measured" in plan and "ArrowEvalPython" not in plan


def _records(n, seed):
    rnd = random.Random(seed)
    some = lambda k: " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(k)))
    ids = [f"S{i % 3 + 1}-{i * 37 % 1000}" for i in range(n)]
    # Ids that stand twice, and a blank one.
    return [(x, some(3), some(6), "US") for x in [*ids, *ids[:6], "", ""]]


@pytest.mark.parametrize("per_batch", [1, 7, 10000])
def test_numbers_give_the_candidates_of_ids(spark, monkeypatch, per_batch):
    monkeypatch.setattr(blocking, "CHUNK", 3)
    monkeypatch.setattr(blocking, "FLOOR", 1000)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        clean = spark.createDataFrame(_records(40, per_batch), "entity_id string, name_clean string, address_clean string, country string")
        known = staged(blocking.numbered(blocking.in_order(clean).withColumn("old", F.col("entity_id"))), "numbered")
        name = {r.entity_id: r.old for r in known.collect()}
        assert len(name) == len(set(name.values())) and [name[k] for k in sorted(name)] == sorted(name.values())
        got = [(name[r.s1], name[r.cand], *r[2:]) for r in blocking.candidates(known, 4, 8).collect()]
        want = [tuple(r) for r in blocking.candidates(clean, 4, 8).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert sorted(got) == sorted(want) and want


def test_numbers_too_wide_for_one_integer():
    rows = {"s1": [5, 5, 9], "method": [0, 1, 1], "m1": [1, 2, 1 << 20], "src": ["S2", "S3", "S2"], "cands": [[1 << 61, 7], [1 << 61, 1 << 61], [7, 3]]}
    table = pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64())))})
    assert [tuple(r.values()) for r in blocking._best(table, 50).to_pylist()] == [(5, 7, "S2", 0, 1, 1), (5, 1 << 61, "S2", 0, 1, 2), (5, 1 << 61, "S3", 1, 4, 1), (9, 3, "S2", 1, 1 << 20, 1), (9, 7, "S2", 1, 1 << 20, 2)]


def test_summary_blocks_on_numbers(spark):
    plan = catalogue._scores(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow ranked" in plan and "ReadSchema: struct<entity_id:bigint" in plan and "entity_id:string" not in plan
