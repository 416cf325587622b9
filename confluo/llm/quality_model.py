"""A quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A text's features are its words and pairs of neighbours, each as written (lower case) and as a shape
(runs of letters, digits and marks), hashed to 2^BITS places, with log(1 + count) scaled to length 1;
a pair of equal words also counts as a repeat. The weights are learnt in one pass, in the order of a
hash of doc_id, over at most SAMPLE labelled rows (the documented bound); their ids, at most 16 bytes
each, are broadcast. The weights, 4 * 2^BITS bytes, are broadcast to score every row.

Empty and null texts have the bias alone and get its score. With no labels every score is 0.5. A
doc_id labelled twice counts once, as 1 if any label says so; rows with a null id are scored only.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.llm.common import MULT, Remembered, documents, map_arrow, mixed, utf8, written

BITS, SAMPLE, THRESHOLD = 18, 12_000, 0.3
RATE, SMOOTH, L1, L2 = 2.0, 1.0, 0.02, 0.01

_RUNS = re.compile(r"([A-ZÀ-Þ])+|([a-zß-ÿ])+|(\d)+|(.)\4*", re.S)


def _shape(word: str) -> str:
    return _RUNS.sub(lambda m: "X" if m[1] else "x" if m[2] else "9" if m[3] else m[4], word)


def _codes(word: bytes) -> tuple[int, int]:
    import xxhash

    return xxhash.xxh64_intdigest(word.lower()), xxhash.xxh64_intdigest("\0" + _shape(word.decode("utf-8", "replace")))


_CODES = Remembered(_codes)


def features(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places (sorted, distinct) and values; place 0 is the bias."""
    words = text.split()
    codes = np.array(list(map(_CODES.__getitem__, words)), np.uint64).reshape(-1, 2)
    raw, shape = codes[:, 0], codes[:, 1]
    pairs = [mixed(x[:-1] * MULT + x[1:]) for x in (raw, shape)]
    repeats = np.full(int((raw[1:] == raw[:-1]).sum()), 0x5EED, np.uint64)
    at, counts = np.unique(mixed(np.concatenate([raw, shape, *pairs, repeats])) >> np.uint64(64 - bits), return_counts=True)
    at, value = at.astype(np.int64), np.log1p(counts).astype(np.float64)
    if len(at):
        value /= np.sqrt((value * value).sum())
    return np.concatenate([[0], at[at > 0]]), np.concatenate([[1.0], value[at > 0]])


class Leader:
    """Follow-the-regularised-leader with per-place rates for logistic loss."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((SMOOTH + np.sqrt(n)) / RATE + L2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (sigmoid(w @ value) - label) * value
        s = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / RATE
        self.z[at] += g - s * w
        self.n[at] += g * g


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def held_out(c: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> np.ndarray:
    """The weights, from at most sample labelled rows that are not held out."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("_label")).where(~held_out(F.col("doc_id")))
    chosen = known.withColumn("_order", F.xxhash64("doc_id")).orderBy("_order", "doc_id").limit(sample)
    rows = docs.select("doc_id", utf8().alias("text")).join(F.broadcast(chosen), "doc_id")

    def extract(batch):
        made = [features(t, bits) for t in batch.column("text").to_pylist()]
        yield {"_order": batch.column("_order"), "doc_id": batch.column("doc_id"), "label": batch.column("_label"), "at": [a.astype("<u4").tobytes() for a, _ in made], "value": [v.astype("<f4").tobytes() for _, v in made]}

    table = written(map_arrow(rows, extract, f"_order long, doc_id {dict(docs.dtypes)['doc_id']}, label int, at binary, value binary"), "features")

    def learn(batches):
        import pyarrow as pa

        model, seen = Leader(bits), 0
        for batch in batches:
            for at, value, label in zip(batch.column("at").to_pylist(), batch.column("value").to_pylist(), batch.column("label").to_pylist()):
                model.learn(np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(value, "<f4").astype(np.float64), int(label == 1))
                seen += 1
        if seen:
            yield pa.RecordBatch.from_pydict({"weights": pa.array([model.weights().astype("<f4").tobytes()], pa.binary())})

    # One task follows the leader: its input is at most sample rows, whatever the size of the tables.
    got = table.repartition(1).sortWithinPartitions("_order", "doc_id", F.xxhash64("at")).mapInArrow(learn, "weights binary").first()
    return np.frombuffer(got["weights"], "<f4") if got else np.zeros(1 << bits, "<f4")


def score(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""
    bits, shared = len(weights).bit_length() - 1, docs.sparkSession.sparkContext.broadcast(weights)

    def work(batch):
        w = shared.value
        scores = []
        for t in batch.column("text").to_pylist():
            at, value = features(t, bits)
            scores.append(float(sigmoid(w[at] @ value)))
        yield {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), utf8().alias("text"))
    return map_arrow(rows, work, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
