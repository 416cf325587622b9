"""Jump consistent hashing in column expressions: stable keys to shards without a ring table.

The 64-bit key is the first half of md5(doc_id as text). The jump's generator, key * 2862933555777941757
+ 1 modulo 2^64, is done on 32- and 16-bit limbs, since ANSI arithmetic does not wrap. A key moves,
when one shard is added, only into the new one, and with probability 1 / (shards + 1).

Slots number the rows of each shard from 0 without gaps, in the order of (key, doc_id, text_crc32,
size). That order is dealt out in blocks of the key's leading bits, which are uniform, and blocks of
the checksum below them, so no task holds a shard; the blocks' counts, at most shards * blocks rows,
give each block its first slot. Equal rows share a place in the order, and either may come first.

A null doc_id is a key of its own ('' with a marker), a null text has no bytes: size 1, checksum 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from confluo.llm.common import documents, utf8

SHARDS = 8
#: Fixed value of the published generator.
JUMP_FACTOR = 2862933555777941757
_LOW = 0xFFFFFFFF


def stable_key(c: Column) -> Column:
    """64 bits of a key's text, as a signed long."""
    h = F.md5(F.coalesce(c.cast("string"), F.lit("\u0000null")))
    half = lambda at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def _next_key(k: Column) -> Column:
    """k * JUMP_FACTOR + 1 modulo 2^64, without overflow."""
    lo, hi = k.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(k, 32)
    c = [(JUMP_FACTOR >> (16 * i)) & 0xFFFF for i in range(4)]
    part = lambda x: F.shiftleft(x.bitwiseAND(F.lit(0xFFFF).cast("long")), 16)
    low = lo * c[0] + part(lo * c[1]) + 1
    high = F.shiftrightunsigned(low, 32) + F.shiftrightunsigned(lo * c[1], 16) + lo * c[2] + part(lo * c[3]) + hi * c[0] + part(hi * c[1])
    return F.shiftleft(high.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key, 0 to shards - 1. At most shards jumps are made, as each goes further."""

    def step(s: Column, _: Column) -> Column:
        def jumped(k: Column) -> Column:
            to = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(k, 33) + 1).cast("double")))
            return F.struct(k.alias("key"), s["j"].alias("b"), to.cast("long").alias("j"))

        return F.when(s["j"] >= shards, s).otherwise(F.transform(F.array(_next_key(s["key"])), jumped)[0])

    first = F.struct(key.alias("key"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), first, step, lambda s: s["b"]).cast("int")


def gapless(df: DataFrame, group: str, high: Column, order: list[str], blocks: int) -> DataFrame:
    """df with slot: its rows' places in each group, by high (unsigned 32 bits in a long) first and then order, which begins with what high comes from."""
    df = df.withColumn("_hi", F.floor(high * blocks / F.lit(float(1 << 32))).cast("int"))
    counts = df.groupBy(group, "_hi").agg(F.count("*").alias("_n"))
    base = counts.select(group, "_hi", (F.sum("_n").over(Window.partitionBy(group).orderBy("_hi")) - F.col("_n")).alias("_base"))
    at = df.withColumn("_at", F.row_number().over(Window.partitionBy(group, "_hi").orderBy(*order)))
    return at.join(base, [group, "_hi"]).withColumn("slot", (F.col("_base") + F.col("_at") - 1).cast("long")).drop("_hi", "_base", "_at")


def shard_documents(docs: DataFrame, shards: int = SHARDS, blocks: int | None = None) -> DataFrame:
    """Each row's doc_id, size, text_crc32, law, shard, slot, grown_shard (with one shard more)."""
    blocks = blocks or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", (F.octet_length(utf8()) + 1).cast("long").alias("size"), F.crc32(utf8()).alias("text_crc32"), stable_key(F.col("doc_id")).alias("_key"))
    rows = rows.withColumns({"shard": jump_shard(F.col("_key"), shards), "grown_shard": jump_shard(F.col("_key"), shards + 1), "_top": F.shiftrightunsigned("_key", 32), "_rest": F.col("_key").bitwiseAND(F.lit(_LOW))})
    out = gapless(rows, "shard", F.col("_top"), ["_top", "_rest", "doc_id", "text_crc32", "size"], blocks)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


def _oracle() -> str:
    """The same by chained steps: every jump of a 64-bit key, one after another."""
    mod = "18446744073709551616::HUGEINT"

    def steps(shards: int, tag: str) -> str:
        out = [f"{tag}0 AS (SELECT rid, k, -1::BIGINT AS b, 0::BIGINT AS j FROM keyed)"]
        for i in range(1, shards + 1):
            out.append(
                f"{tag}{i} AS (SELECT rid, k2 AS k, CASE WHEN j < {shards} THEN j ELSE b END AS b, CASE WHEN j < {shards} THEN floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((k2 // 8589934592) + 1)::DOUBLE))::BIGINT ELSE j END AS j "
                f"FROM (SELECT rid, b, j, ((((k // 4294967296) * {JUMP_FACTOR}::HUGEINT % 4294967296) * 4294967296 + (k % 4294967296) * {JUMP_FACTOR}::HUGEINT) + 1) % {mod} AS k2 FROM {tag}{i - 1}))"
            )
        return ",\n".join(out)

    parts = [
        # CRC-32 (reflected, 0xEDB88320) has no function here: it is folded over the text's bytes.
        "tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i)))",
        "raw AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS x, md5(coalesce(doc_id::VARCHAR, chr(0) || 'null')) AS h FROM documents)",
        "keyed AS (SELECT rid, doc_id, strlen(x) + 1 AS size, ('0x' || substr(h, 1, 8))::UBIGINT::HUGEINT * 4294967296 + ('0x' || substr(h, 9, 8))::UBIGINT::HUGEINT AS k FROM raw)",
        "bytes AS (SELECT rid, hex(encode(x)) AS hx FROM raw)",
        "crc AS (SELECT rid, xor(list_reduce([4294967295::BIGINT] || list_transform(range(length(hx) // 2), lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT), lambda c, v: xor(c // 256, t[(xor(c, v) % 256) + 1])), 4294967295) AS text_crc32 FROM bytes, tab)",
        steps(SHARDS, "a"),
        steps(SHARDS + 1, "g"),
    ]
    return "WITH " + ",\n".join(parts) + (
        f"\nSELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, a.b::INTEGER AS shard, "
        f"(row_number() OVER (PARTITION BY a.b ORDER BY keyed.k, doc_id, text_crc32, size) - 1)::BIGINT AS slot, g.b::INTEGER AS grown_shard "
        f"FROM keyed JOIN crc USING (rid) JOIN a{SHARDS} a USING (rid) JOIN g{SHARDS + 1} g USING (rid)"
    )


ORACLE_SQL = {"op4_sharding": _oracle()}
