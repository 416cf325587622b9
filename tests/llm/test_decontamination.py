"""Long items, short items, long texts, and the query's own columns."""

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from confluo.llm import decontamination


def edit_distance(item, text):
    """The least edits from item to any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize(("m", "edits"), [(3_000, 40), (24_000, 200), (50_000, 60)])
def test_long_items(m, edits):
    """Substitutions far apart, and none at the ends, leave one place and one least number of edits."""
    rnd = random.Random(m)
    item = [rnd.choice("abcdefgh") for _ in range(m)]
    copy, step = list(item), m // (edits + 1)
    for k in range(1, edits + 1):
        copy[k * step] = "z"
    before, after = ("".join(rnd.choice("uvwxy") for _ in range(n)) for n in (500, 700))
    found = decontamination.Benchmark([(1, "".join(item))]).regions([before + "".join(copy) + after, before])
    assert found == [[(0, 500, 500 + m, edits)], []]


@pytest.mark.parametrize("m", [1, 7, 8, 10, 15, 16, 20, 23, 30, 31, 40])
def test_short_items_get_all_their_edits(m):
    rnd = random.Random(m)
    for _ in range(20):
        item = "".join(rnd.choice("abcd") for _ in range(m))
        x = list(item)
        for _ in range(rnd.randint(0, m // 10 + 1)):
            x[rnd.randrange(len(x))] = rnd.choice("abcdz")
        text = "".join(rnd.choice("abcd") for _ in range(40)) + "".join(x) + "cab"
        near = edit_distance(item, text)
        assert [x[3] for x in decontamination.Benchmark([(5, item)]).regions([text])[0]] == ([near] if near <= m // 10 else [])


def test_search_in_steps(monkeypatch):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 300))) for _ in range(30)]
    items = [(i, t[20:60]) for i, t in enumerate(texts)]
    whole = decontamination.Benchmark(items).regions(texts)
    monkeypatch.setattr(decontamination, "STEP", 37)
    assert decontamination.Benchmark(items).regions(texts) == whole


def test_query_columns(spark, tmp_path):
    """Every column of op6 beside brute force, nulls, blanks and repeated rows and items included; the files are named as the query's."""
    rnd = random.Random(4)
    items = [(i, "".join(rnd.choice("abcdef ") for _ in range(45)).strip()) for i in range(6)] + [(6, None), (7, " "), (2, "one more item of words")]
    texts = [None, "", " "] + ["".join(rnd.choice("abcdef ") for _ in range(60)) + (items[i % 6][1] if i % 3 else "") + "xyz" + (items[8][1].upper() if i % 4 == 0 else "") for i in range(30)]
    rows = [(i if i != 5 else None, t) for i, t in enumerate(texts)] + [(8, texts[8])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = []
    for i, t in rows:
        t = decontamination.normal(t or "")
        known = [(j, decontamination.normal(x or "")) for j, x in items]
        near = [(j, d) for j, x in known if x and (d := edit_distance(x, t)) <= len(x) // 10]
        ids = sorted({j for j, _ in near})
        want.append((i, bool(near), len(ids), tuple(ids), min((d for _, d in near), default=None)))
    got = [(r.doc_id, r.contaminated, r.n_items, tuple(r.item_ids), r.least_edits) for r in decontamination.op6_decontamination(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_any_column_names(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma", "r", 1, [1]), (2, "delta", "s", 2, None), (None, None, None, None, None)], "doc_id long, text string, _row string, regions int, spans array<int>")
    got = decontamination.decontaminated(docs, spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string"))
    assert got.columns == docs.columns and {r._row for r in got.collect()} == {"s", None}
    assert decontamination.decontaminated(docs.where(F.lit(False)), spark.createDataFrame([(1, "alpha")], "item_id long, text string")).count() == 0
