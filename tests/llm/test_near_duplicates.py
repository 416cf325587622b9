"""The LSH forest where its regions are dense, and rows with odd columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from confluo.llm import graph, lsh_forest


def boilerplate(pairs=1500, seed=5):
    """Texts that share 140 of their 170 shingles (Jaccard 0.70); each is paired with one that shares 6 to 10 more (0.753 to 0.789)."""
    rnd, common = random.Random(seed), [f"b{i}" for i in range(144)]
    own = lambda n: [f"o{rnd.getrandbits(60)}" for _ in range(n)]
    rows = []
    for k in range(pairs):
        # A break of n own words before and after the shared part makes shingles that differ.
        more, tail = 6 + k % 5, own(10)
        a = common + tail[: k % 5 + 6] + own(30 - more)
        b = common + tail[: k % 5 + 6] + own(30 - more)
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    return rows


def test_pairs_among_boilerplate_are_found(spark):
    rows = boilerplate()
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows]
    like = lambda a, b: len(a & b) / len(a | b)
    assert all(0.75 <= like(sets[i], sets[i + 1]) < 0.8 for i in range(0, len(rows), 2))
    assert 0.69 < like(sets[0], sets[2]) < 0.71
    random.Random(1).shuffle(rows)
    got = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).select("doc_id", "component_id").collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i in range(len(rows))}


@pytest.mark.parametrize("two", [False, True])
def test_merging_joins_all_that_is_similar(two):
    """Random sets of few values: the components of all pairs, by the scan of one block or of two, equal brute force."""
    rnd = np.random.default_rng(3)
    for _ in range(10):
        base = rnd.integers(0, 1 << 60, 40, dtype=np.uint64)
        sets = [np.unique(np.concatenate([rnd.choice(base, 36, replace=False), rnd.integers(0, 1 << 60, rnd.integers(0, 4), dtype=np.uint64)])) for _ in range(30)]
        rows = [[*range(30)], [*range(30)], [lsh_forest.signature(s).astype(">u2").tobytes() for s in sets], [s.tobytes() for s in sets]]
        sides = ([x[:12] for x in rows], [x[12:] for x in rows]) if two else (rows, None)
        links = [x for tree in range(lsh_forest.TREES) for x in lsh_forest.merging(*sides, tree)]
        same = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
        near = {(i, j) for i in range(30) for j in range(i) if 100 * same(i, j) >= 75 * (len(sets[i]) + len(sets[j]) - same(i, j)) and (not two or (j < 12) != (i < 12))}
        assert {(max(p), min(p)) for p in links} <= near

        def components(pairs):
            root = list(range(30))
            for _ in range(30):
                for a, b in pairs:
                    root[a] = root[b] = min(root[a], root[b])
            return root

        assert components(links) == components(near)


def test_any_column_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 5, "x", "r"), (2, "a b c d e f", 6, "y", "s"), (None, None, 7, "z", "t"), (3, " ", None, None, None)], "doc_id long, text string, mark int, row string, kept string")
    got = lsh_forest.first_of_each(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} == {(1, "a b c d e f", 5, "x", "r"), (None, None, 7, "z", "t"), (3, " ", None, None, None)}
    assert lsh_forest.first_of_each(docs.limit(0)).count() == 0


def test_very_long_texts(spark):
    words = [f"w{i}" for i in range(60_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:50_000])), (3, " ".join(words[:40_000])), (4, "x" * 300_000), (5, "x" * 300_000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in lsh_forest.near_duplicates(docs).collect()}
    assert got == {1: (59_996, 1), 2: (49_996, 1), 3: (39_996, 1), 4: (1, 4), 5: (1, 4)}
    assert lsh_forest.near_duplicates(docs.where(F.lit(False))).count() == 0


def test_components_by_one_task_and_by_rounds(spark):
    """Paths and random links over several tasks: both ways give the smallest node reachable; few links take few jobs."""
    rnd = random.Random(2)
    links = [(k, k + 1) for k in range(0, 60)] + [(rnd.randrange(100, 400), rnd.randrange(100, 400)) for _ in range(180)] + [(7, 7), (None, 5), (500, 500)]
    rnd.shuffle(links)
    root = {n: n for pair in links for n in pair if None not in pair and pair[0] != pair[1]}
    for _ in range(400):
        for a, b in links:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    group, tracker = "components", spark.sparkContext.statusTracker()
    for local in (graph.LOCAL, 0):
        spark.sparkContext.setJobGroup(f"{group}-{local}", "")
        got = graph.components(df, local)
        jobs = len(tracker.getJobIdsForGroup(f"{group}-{local}"))
        assert {r.node: r.root for r in got.collect()} == root
        assert not local or jobs <= 6
    assert graph.components(df.where("a = b")).collect() == []
