"""What the training-data operators share: inputs, written tables, word hashes."""

from __future__ import annotations

import gc
import time

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from confluo.sources.staging import drop, fresh_path  # noqa: F401
from confluo.sources.staging import staged as written

#: Rows in one Arrow batch at most; texts are long, so it is well below Spark's default.
BATCH_ROWS = 512
#: Entries of a worker's word caches; a full cache is emptied and filled anew.
CACHE_WORDS = 300_000

MULT = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of a span that is hashed with all others; the mask of a step's bytes, by how many are left.
LONG_WORD, _MASKS = 256, np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of plans that have run; it acts on what both garbage collectors have let go."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, so that long texts do not fill a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, BATCH_ROWS)


def bitmap(df: DataFrame, column: str, bits: int = 27) -> np.ndarray:
    """A bit for the leading bits of each 64-bit hash in a column: 2^(bits - 3) bytes at any size, built by the executors. What it marks is a superset of what df holds."""
    at = F.shiftrightunsigned(column, 64 - bits)
    pages = df.select(F.shiftright(at, 15).alias("page"), at.bitwiseAND(F.lit(32767)).alias("bit")).groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << bits - 15, 4096), np.uint8)
    for r in pages.collect():  # 2^(bits - 15) pages at most
        out[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def is_marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which 64-bit hashes a bitmap marks."""
    at = hashes.view(np.uint64) >> np.uint64(61 - len(marks).bit_length() + 1)
    return (marks[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)) != 0


def utf8(column: str = "text"):
    """The text's bytes, empty for null."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def map_arrow(df: DataFrame, work, schema: str) -> DataFrame:
    """mapInArrow where work takes a RecordBatch and yields RecordBatches or dicts of columns."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(df.sparkSession)
    form = to_arrow_schema(StructType.fromDDL(schema) if hasattr(StructType, "fromDDL") else df.sparkSession.createDataFrame([], schema).schema)

    def run(batches):
        for batch in batches:
            for out in work(batch):
                yield as_batch(out, form)

    return df.mapInArrow(run, schema)


def as_batch(columns: dict, form: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in form], schema=form)


class Remembered(dict):
    """A bounded dict that computes what it misses."""

    def __init__(self, make, limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.make(key)
        return value


WORDS = Remembered(xxhash.xxh64_intdigest)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))


def word_spans(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs outside ASCII white space) of a uint8 array."""
    edge = np.empty(len(buffer) + 2, np.int8)
    edge[0] = edge[-1] = 0
    np.not_equal(buffer, 32, out=edge[1:-1].view(bool))
    edge[1:-1] &= (buffer - np.uint8(9)) > 4
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    return turns[::2], turns[1::2]


def span_hashes(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, eight bytes a step for all spans at once; spans over LONG_WORD bytes by xxh64."""
    size = end - start
    padded = raw + bytes(8)
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    out = eight[start]
    out &= _MASKS[np.minimum(size, 8)]
    out ^= _SIZES[np.minimum(size, LONG_WORD)]
    out *= MULT
    out = mixed(out)
    left = np.flatnonzero((size > 8) & (size <= LONG_WORD))
    at, rest = start[left] + 8, size[left] - 8
    while len(left):
        chunk = eight[at] & _MASKS[np.minimum(rest, 8)]
        out[left] = mixed((out[left] ^ chunk) * MULT)
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(raw[start[i] : end[i]])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SIZES = mixed(np.arange(LONG_WORD + 1, dtype=np.uint64) * MULT)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k consecutive items, in order; empty if there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= MULT
        out += hashes[j : n + j]
    return mixed(out)
