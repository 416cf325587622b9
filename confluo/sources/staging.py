"""Tables that one plan reads several times, written once."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no spark.checkpoint.dir and runs on one machine, as in tests.
OWN_DIR = "/tmp/checkpoints/confluo"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or our own on a local master."""
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at.rstrip("/")
    if (by_user := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        return by_user.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return OWN_DIR


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None:
        return
    try:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session has ended; the folder stays for whoever cleans the shared directory
        return


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, removed when the driver ends."""
    path = f"{shared_dir(spark)}/confluo-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, removed when the driver ends.

    Its readers take only the columns they use, and a lost executor loses none of it.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged = path
    return table


def drop(*tables: DataFrame) -> None:
    """Remove staged tables that no plan will read any more."""
    for t in tables:
        _remove(t.sparkSession, t._staged)
