"""A gradient-boosted pair classifier."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.operators.boosting import DEEPEST, Trees, binned, boosted, packed
from confluo.operators.features import FEATURES, PAIR
from confluo.operators.order import running
from confluo.operators.sampling import grouped_split
from confluo.sources.staging import drop, staged

#: Bins of a feature, at most.
BINS = 32


def class_balance(features: DataFrame) -> DataFrame:
    """pos, neg, weight of a positive row (1 if there are none)."""
    n = features.agg(F.count_if("is_match").alias("pos"), F.count_if(~F.col("is_match")).alias("neg"))
    return n.withColumn("weight", F.round(F.coalesce(F.try_divide("neg", "pos"), F.lit(1.0)), 6))


def _value_weights(rows: DataFrame) -> DataFrame:
    """feature, value, w, of all rows that are not held out: the weight of each value of each feature."""

    def folded(parts: list) -> list:
        out = []
        for i in range(len(FEATURES)):
            value, at = np.unique(np.concatenate([p[i][0] for p in parts]), return_inverse=True)
            out.append((value, np.bincount(at, np.concatenate([p[i][1] for p in parts]), len(value))))
        return out

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for batch in batches:
            w = batch.column("_w").to_numpy(zero_copy_only=False)
            parts.append([(batch.column(f).to_numpy(zero_copy_only=False).astype(np.float64), w) for f in FEATURES])
            if len(parts) == 32:
                parts = [folded(parts)]
        for i, (value, w) in enumerate(folded(parts) if parts else []):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), i, np.int32)), pa.array(value), pa.array(w)], names=["feature", "value", "w"])

    each = rows.where("NOT is_val").select(*FEATURES, "_w").mapInArrow(counted, "feature int, value double, w double")
    return staged(each.groupBy("feature", "value").agg(F.sum("w").alias("w")), "values")


def cuts(rows: DataFrame, bins: int = BINS) -> list[list[float]]:
    """For each feature the values between bins of like weight, at most; between all its values if they are no more than bins. Rows held out are not looked at."""
    known = running(_value_weights(rows), ["feature"], "value", {"w": "_to"})
    whole = known.groupBy("feature").agg(F.sum("w").alias("_all"), F.count("*").alias("_values"))
    few, many = known.join(whole.where(F.col("_values") <= bins), "feature"), known.join(whole.where(F.col("_values") > bins), "feature")
    # A value is in the bin where its weight begins.
    at = F.least(F.greatest(F.floor((F.col("_to") - F.col("w")) / F.col("_all") * bins), F.lit(0)), F.lit(bins - 1))
    ends = few.select("feature", F.col("value").alias("least"), F.col("value").alias("most")).unionByName(many.groupBy("feature", at.alias("_bin")).agg(F.min("value").alias("least"), F.max("value").alias("most")).drop("_bin"))
    found: dict[int, list] = {i: [] for i in range(len(FEATURES))}
    for r in sorted(ends.collect()):
        found[r.feature].append(r)
    return [[(x.most + y.least) / 2 for x, y in zip(f, f[1:])] for f in found.values()]


def fit(features: DataFrame, rounds: int = 500, depth: int = 5, step: float = 0.05, patience: float = 0.001, share: float = 0.2) -> Trees:
    """Boosted trees with logistic loss, of 6 levels at most; boosting stops when the held-out records' loss no longer falls.

    One barrier stage with a task for each free core holds all rows, a byte for each feature.
    """
    if depth > DEEPEST:
        raise ValueError(f"trees have {DEEPEST} levels at most")
    weight, sc = float(class_balance(features).first()["weight"]), features.sparkSession.sparkContext._jsc.sc()
    # Written, since cuts and trees read the split each.
    rows = staged(grouped_split(features, share).select(*FEATURES, "is_match", "is_val", F.when(F.col("is_match"), weight).otherwise(1.0).alias("_w")), "split")
    ends = cuts(rows)
    tasks = max(1, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))
    blocks = rows.select(*FEATURES, "is_match", "is_val").mapInArrow(packed(FEATURES, ends), "block binary").repartition(tasks)
    found = blocks.mapInArrow(boosted(ends, weight, rounds, depth, step, patience), "trees string", barrier=True).collect()
    drop(rows)
    return Trees.from_json(found[0]["trees"])


def score(model: Trees, features: DataFrame) -> DataFrame:
    """Two ids and score; of no rows, none."""
    kinds = dict(features.dtypes)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = model.margins(binned([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], model.cuts))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in PAIR], pa.array((1 / (1 + np.exp(-2 * margin))).astype(np.float32))], names=[*PAIR, "score"])

    return features.select(*PAIR, *FEATURES).mapInArrow(scored, ", ".join(f"{c} {kinds[c]}" for c in PAIR) + ", score float")


def importance(model: Trees) -> DataFrame:
    """feature, percent of the gain, largest first."""
    total = sum(model.gains) or 1.0
    rows = [(f, float(round(100 * g / total, 6))) for f, g in zip(FEATURES, model.gains)]
    return SparkSession.active().createDataFrame(rows, "feature string, percent double").orderBy(F.desc("percent"), "feature")


def save(model: Trees, path: str) -> None:
    SparkSession.active().createDataFrame([(model.to_json(),)], "trees string").coalesce(1).write.mode("overwrite").parquet(path)


def load(path: str) -> Trees:
    return Trees.from_json(SparkSession.active().read.parquet(path).first()["trees"])
