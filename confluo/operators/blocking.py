"""Candidate pairs by shared rare words, within a country."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from confluo.functions.text import tokens
from confluo.operators.records import with_source

POSTING_CAP, PER_SOURCE, ADDRESS_LEAST, SMALL, FLOOR = 1000, 50, 3, 100_000, 10
#: Postings in a row of the token join, at most: a word with more has several rows.
CHUNK = 64


def token_rows(df: DataFrame, column: str, *also: str) -> DataFrame:
    """entity_id, src, country, token: a row for every word, repeats included, with the columns also."""
    return with_source(df).select("entity_id", "src", "country", *also, F.explode(tokens(F.col(column))).alias("token"))


def limits(df: DataFrame) -> DataFrame:
    """country, n, most: a word met more than most times among the others' rows is common there."""
    n = with_source(df).where("src <> 'S1'").groupBy("country").agg(F.count("*").alias("n"))
    return n.withColumn("most", F.greatest(F.lit(FLOOR), F.expr(f"n div if(n > {SMALL}, 200, 100)")))


def common_tokens(df: DataFrame, column: str) -> DataFrame:
    """country, token, n of the common words."""
    counts = token_rows(df, column).where("src <> 'S1'").groupBy("country", "token").agg(F.count("*").alias("n"))
    return counts.join(limits(df).select("country", "most"), "country").where("n > most").select("country", "token", "n")


def _kept(df: DataFrame, column: str, cap: int | None) -> DataFrame:
    """country, token, entity_id, src, _r: the others' rare words, at most cap rows a word (None: all) in the order of (src, entity_id), numbered from 1."""
    rare = token_rows(df, column).where("src <> 'S1'").join(common_tokens(df, column), ["country", "token"], "left_anti")
    # Sorted by word first: countries are few, so that most comparisons would go beyond them.
    order = Window.partitionBy("token", "country").orderBy("src", "entity_id")
    every = rare.withColumn("_r", F.row_number().over(order))
    return every if cap is None else every.where(F.col("_r") <= cap)


def postings(df: DataFrame, column: str, cap: int = POSTING_CAP) -> DataFrame:
    """country, token, entity_id, src, m: the others' rare words with their multiplicity, at most cap rows a word in the order of (src, entity_id)."""
    return _kept(df, column, cap).groupBy("country", "token", "entity_id", "src").agg(F.count("*").alias("m"))


def _own(df: DataFrame, column: str, *also: str) -> DataFrame:
    """country, token, s1, m1: the words of each primary record with their multiplicity, and the columns also of its row."""
    return token_rows(df, column, *also).where("src = 'S1'").groupBy("country", "token", F.col("entity_id").alias("s1"), *also).agg(F.count("*").alias("m1"))


def _met(df: DataFrame, column: str, cap: int) -> DataFrame:
    """s1, cand, src, shared: a row for each rare word that a pair shares, with the product of both multiplicities."""
    return _own(df, column).join(postings(df, column, cap), ["country", "token"]).select("s1", F.col("entity_id").alias("cand"), "src", (F.col("m1") * F.col("m")).alias("shared"))


def _met_lists(df: DataFrame, column: str, cap: int | None) -> DataFrame:
    """s1, m1, src, cands: each rare word of a primary record with the others of a source that have it, an id as often as it has the word; at most CHUNK ids a row. Sources in a record's _full are left out."""
    lists = _kept(df, column, cap).groupBy("token", "country", "src", F.floor((F.col("_r") - 1) / CHUNK).alias("_k")).agg(F.collect_list("entity_id").alias("cands"))
    if "_full" not in df.columns:
        return _own(df, column).join(lists, ["token", "country"]).select("s1", "m1", "src", "cands")
    own = _own(df, column, "_full").withColumnsRenamed({"token": "_token", "country": "_country"})
    open_ = F.coalesce(~F.array_contains("_full", F.col("src")), F.lit(True))
    return own.join(lists, (F.col("_token") == F.col("token")) & (F.col("_country") == F.col("country")) & open_).select("s1", "m1", "src", "cands")


def _with_full(df: DataFrame, column: str, per_source: int, cap: int | None) -> DataFrame:
    """df with _full: the sources of which one rare word of a primary record's column alone brings per_source others or more (null: none)."""
    enough = postings(df, column, cap).groupBy("token", "country", "src").agg(F.count("*").alias("_n")).where(F.col("_n") >= per_source)
    full = _own(df, column).join(enough, ["token", "country"]).groupBy(F.col("s1").alias("entity_id")).agg(F.collect_set("src").alias("_full"))
    return df.join(full, "entity_id", "left")


def shared_tokens(df: DataFrame, column: str, least: int = 1, cap: int = POSTING_CAP) -> DataFrame:
    """s1, cand, src, shared: pairs that share least rare words or more; a repeated word counts by both multiplicities."""
    return _met(df, column, cap).groupBy("s1", "cand", "src").agg(F.sum("shared").alias("shared")).where(F.col("shared") >= least)


def _numbers(ids: pa.Array) -> tuple[pa.Array | None, np.ndarray]:
    """Ids as numbers in their order, and the ids by number; ids that are numbers stay."""
    if pa.types.is_integer(ids.type):
        return None, ids.to_numpy()
    coded = ids.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), place[coded.indices.to_numpy()]


def _best(rows: pa.Table, per_source: int) -> pa.RecordBatch:
    """Whole primary records' lists (s1, method, m1, src, cands) to their ranked candidates: the sums and ranks of all their pairs at once."""
    lists, owner, source = (rows[c].combine_chunks() for c in ("cands", "s1", "src"))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    owner, source, (ids, cand) = owner.dictionary_encode(), source.dictionary_encode(), _numbers(lists.flatten())
    group, m1 = owner.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy(), rows["m1"].to_numpy()
    # One sort of integers: record and source, id, method, multiplicity.
    many = int(m1.max(initial=0)).bit_length()
    high, wide = int(group.max(initial=0)).bit_length(), int(cand.max(initial=0)).bit_length()
    if high + wide + 1 + many > 63 or cand.min(initial=0) < 0:
        known, cand = np.unique(cand, return_inverse=True)
        wide = len(known).bit_length()
    else:
        known = None
    row = group << wide + 1 + many | (rows["method"].to_numpy() == 0).astype(np.int64) << many | m1
    key = np.repeat(row, sizes) | cand << 1 + many
    key.sort()
    pair = key >> 1 + many
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    m1 = key & (1 << many) - 1
    both, by_name = (np.add.reduceat(x, first) if len(first) else x for x in (m1, m1 * (key >> many & 1)))
    by_address = both - by_name
    pick = np.flatnonzero((by_name >= 1) | (by_address >= ADDRESS_LEAST))
    group, at = np.divmod(pair[first[pick]], 1 << wide)
    by_name, by_address = by_name[pick], by_address[pick]
    method, shared = np.where(by_name >= 1, 0, 1), np.where(by_name >= 1, by_name, by_address)
    # Pairs stand in the order of their ids, which this sort keeps among equals.
    most = int(shared.max(initial=0)) + 1
    order = np.argsort((group * 2 + method) * most - shared, kind="stable")
    group = group[order]
    start = np.flatnonzero(np.diff(group, prepend=-1))
    rank = np.arange(1, len(group) + 1) - np.repeat(start, np.diff(start, append=len(group)))
    order, group, rank = order[rank <= per_source], group[rank <= per_source], rank[rank <= per_source]
    at = at[order] if known is None else known[at[order]]
    s1, src = np.divmod(group, max(len(source.dictionary), 1))
    out = [owner.dictionary.take(pa.array(s1)), pa.array(at) if ids is None else ids.take(pa.array(at)), source.dictionary.take(pa.array(src)), pa.array(method[order], pa.int32()), pa.array(shared[order], pa.int64()), pa.array(rank, pa.int32())]
    return pa.RecordBatch.from_arrays(out, names=["s1", "cand", "src", "method", "shared", "rank"])


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches in the order of s1 as tables that end where a record ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        s1 = batch.column("s1")
        cut = pc.index(s1, s1[-1]).as_py()
        if not cut and held and held[-1].column("s1")[-1].equals(s1[-1]):
            held.append(batch)
            continue
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def candidates(df: DataFrame, per_source: int = PER_SOURCE, cap: int | None = POSTING_CAP) -> DataFrame:
    """s1, cand, src, method, shared, rank: pairs by name (method 0) before pairs by address alone (1), then by shared words and id, the first per_source of each source.

    A rare word brings the first cap of its postings, or all of them (None).

    Ids may be numbers in the order of the ids, with src beside them (numbered): they are a third of the bytes and need no look-up.
    """
    # Pairs by address alone stand behind those by name: a source that a name fills needs no lists by address. With no cap lists grow with the input, so that these are left out.
    by_address = df if cap is not None else _with_full(df, "name_clean", per_source, cap)
    # A pair's words come from different tasks. One shuffle by s1, of at most cap ids (if any) a word and record, serves sums and ranks; ids go as lists, not as rows.
    met = _met_lists(df, "name_clean", cap).withColumn("method", F.lit(0)).unionByName(_met_lists(by_address, "address_clean", cap).withColumn("method", F.lit(1))).repartition("s1").sortWithinPartitions("s1")

    def ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (_best(rows, per_source) for rows in _whole(batches))

    kind = dict(df.dtypes)["entity_id"]
    return met.mapInArrow(ranked, f"s1 {kind}, cand {kind}, src string, method int, shared long, rank int")


def in_order(df: DataFrame) -> DataFrame:
    """df in the order of entity_id: no id stands in two partitions, and partitions follow each other."""
    key, n = F.coalesce("entity_id", F.lit("")), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, key).sortWithinPartitions(key)


def numbered(df: DataFrame) -> DataFrame:
    """df, rows as in_order leaves them, with src and with numbers in the order of the ids as entity_id. To be written before it is read twice."""
    rest = [c for c in df.columns if c != "entity_id"]

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        last, n = None, TaskContext.get().partitionId() << 32
        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column("entity_id")
            new = np.ones(len(ids), bool)
            new[0] = ids[0].as_py() != last
            new[1:] = pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
            at = n + np.cumsum(new)
            last, n = ids[-1].as_py(), int(at[-1])
            yield pa.RecordBatch.from_arrays([pa.array(at), pc.utf8_slice_codeunits(ids, 0, 2), *[batch.column(c) for c in rest]], names=["entity_id", "src", *rest])

    kinds = dict(df.dtypes)
    return df.mapInArrow(made, ", ".join(["entity_id long", "src string", *[f"{c} {kinds[c]}" for c in rest]]))


def candidate_lists(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """source1_entity_id, candidate_entity_ids: every primary record with its comma list, S2 before S3, in rank order; blank if there is none."""
    packed = pairs.groupBy("s1").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("src", "rank", "cand"))), lambda x: x["cand"]), ",").alias("ids"))
    s1 = with_source(df).where("src = 'S1'").select(F.col("entity_id").alias("s1"))
    return s1.join(packed, "s1", "left").select(F.col("s1").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("candidate_entity_ids"))


def candidate_stats(lists: DataFrame) -> DataFrame:
    n = F.size(F.filter(F.split("candidate_entity_ids", ","), lambda x: x != ""))
    return lists.agg(F.count("*").alias("s1"), F.sum(n).cast("long").alias("pairs"), F.round(F.avg(n), 6).alias("average"), F.count_if(n == 0).alias("without"))


def first_ten(df: DataFrame, per_source: int = 10) -> DataFrame:
    """A stand-in for candidates: every primary record with the first ids of each other source. The right side has at most 2 * per_source rows."""
    s = with_source(df)
    few = [s.where(F.col("src") == k).select("entity_id").distinct().orderBy("entity_id").limit(per_source) for k in ("S2", "S3")]
    right = few[0].union(few[1]).select(F.col("entity_id").alias("candidate_entity_id"))
    return s.where("src = 'S1'").select(F.col("entity_id").alias("source1_entity_id")).crossJoin(F.broadcast(right))
