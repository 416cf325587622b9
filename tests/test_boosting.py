"""Boosted trees in one barrier stage: the same trees as one task's, and as plain loops' rules give."""

import numpy as np
import pytest

from confluo.operators import boosting, features, model
from confluo.operators.features import PAIR


def _rows(n=3000, seed=3):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.random((10, n)), 2)
    x[5:8], x[8:] = rnd.integers(-1, 2, (3, n)), rnd.integers(0, 2, (2, n))
    return x, (x[0] + x[3] * (x[5] > 0) + 0.2 * rnd.random(n)) > 1.2


@pytest.fixture(scope="module")
def pairs(spark):
    x, match = _rows()
    rows = [(f"S1-{i // 3}", f"S2-{i}", *map(float, x[:, i]), bool(match[i])) for i in range(len(match))]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in PAIR) + ", " + ", ".join(f"{f} float" for f in features.FEATURES) + ", is_match boolean").cache()


def _jobs(spark, group, f):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return f(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_rounds_are_no_jobs(spark, pairs):
    """Boosting is one stage, however many rounds; its rows meet in tasks' sums, and the trees are those of one task with all rows."""
    (few, a), (many, b) = (_jobs(spark, f"rounds-{k}", lambda k=k: model.fit(pairs, rounds=k, patience=0.0)) for k in (3, 30))
    assert b < a + 27 and len(few.feature) == 3 and len(many.feature) == 30
    from confluo.operators.sampling import grouped_split

    rows = grouped_split(pairs).toPandas()
    bins = boosting.binned([rows[f].to_numpy() for f in features.FEATURES], few.cuts)
    weight = model.class_balance(pairs).first()["weight"]
    alone = boosting.boost(bins, rows.is_match.to_numpy(), rows.is_val.to_numpy(), weight, few.cuts, 30, 5, 0.05, 0.0, lambda x: x)
    assert np.abs(alone.margins(bins) - many.margins(bins)).max() < 1e-6
    scores = {(r[0], r[1]): r.score for r in model.score(many, pairs).collect()}
    right = sum((scores[i, c] >= 0.5) == m for i, c, m in zip(rows[PAIR[0]], rows[PAIR[1]], rows.is_match))
    assert len(scores) == len(rows) and right > 0.93 * len(rows)


def test_first_tree_beside_plain_loops():
    """The first tree's splits are the best by weighted variance, its values the weighted means; margins are those of a walk down the trees."""
    x, match = _rows(400)
    cuts = [sorted({(a + b) / 2 for a, b in zip(v, v[1:])}) for v in (np.unique(np.round(r * 4) / 4) for r in x)]
    bins = boosting.binned(list(x), cuts)
    weight, none = 2.0, np.zeros(len(match), bool)
    got = boosting.boost(bins, match, none, weight, cuts, 4, 3, 0.1, 0.001, lambda a: a)
    y, w = np.where(match, 1.0, -1.0), np.where(match, weight, 1.0)
    loss = lambda at: (w[at] * (y[at] - np.average(y[at], weights=w[at])) ** 2).sum() if at.any() else 0.0

    def check(k, at, level):
        if level == 3:
            assert not at.any() or got.value[0][k - 7] == pytest.approx(np.average(y[at], weights=w[at]))
            return
        best = max(loss(at) - loss(at & (b <= c)) - loss(at & (b > c)) for b in bins for c in range(b.max()))
        f, c = got.feature[0][k], got.last[0][k]
        left = at & (bins[f] <= c) if f >= 0 else at
        assert loss(at) - loss(left) - loss(at & ~left) == pytest.approx(max(best, 0), abs=1e-6)
        check(2 * k + 1, left, level + 1)
        check(2 * k + 2, at & ~left, level + 1)

    check(0, ~none, 0)
    walked = np.zeros(len(match))
    for feature, last, value in zip(got.feature, got.last, got.value):
        for i in range(len(match)):
            k = 0
            while k < 7:
                k = 2 * k + 1 + int(feature[k] >= 0 and bins[feature[k]][i] > last[k])
            walked[i] += value[k - 7]
    assert len(got.feature) == 4 and np.allclose(walked, got.margins(bins))


def test_boosting_stops_when_the_held_out_loss_does():
    x, match = _rows(2000)
    match = match ^ (np.random.default_rng(1).random(2000) < 0.2)
    cuts = [[k / 8 for k in range(1, 8)]] * 10
    val = np.arange(2000) % 4 == 0
    trees = boosting.boost(boosting.binned(list(x), cuts), match, val, 1.0, cuts, 400, 5, 0.05, 0.001, lambda a: a)
    assert 1 < len(trees.feature) < 400
