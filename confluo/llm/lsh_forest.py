"""MinHash near-duplicates by an LSH forest, with every link confirmed on full shingle sets.

Words are runs outside ASCII white space, A-Z in lower case; a set holds the distinct 5-word shingles
(64-bit hashes), or the whole sequence of a shorter text. Equal sets (128-bit digests) form one class.
Every class has SIZE minhash digits; tree t orders the classes by the digits from 4 t on. Classes that
share the first four digits of a tree are a region; regions of one class end there. Candidates are

- LCP neighbours: each class with the next NEAR in the tree's order, or the next CLOSE in a region of over
  DENSE classes, where the longest common prefixes stand beside each other anyway (the order is
  range-partitioned, so a hot region spreads over tasks; the ends of partitions are joined in a small
  second pass), and
- each class with the leader of its region: the one with the most company over all trees, which is the
  hub if a region holds edited copies of one text. Regions of over DENSE classes are cut at deeper
  prefixes (6, 8 and 12 digits), each with its own leader.

These find nearly all components at little cost, but not every pair of a region is among them. So, when
their links are known, all other pairs of a region of over NEAR + 1 classes are compared too, unless both
ends are connected already (`unconnected`): the classes of a region outside its largest component
meet all its classes, in blocks of about BLOCK classes and BLOCK_SHINGLES shingles that are dealt over tasks. The tasks
have the full sets and verify there, the most alike first, so no pairs leave them but the links that
join two components. Two classes that share a region are thus in one component or have been compared.

A pair whose digits agree in under LEAST of SIZE places is not verified: at the threshold of 0.75 the
agreement is below that with probability under 1e-11, and four digits meet in none of the 32 trees with
probability 5e-6. First each class's best candidate is verified, then all whose ends are not connected
yet. Verification counts the shingles that both full sets hold.
The work on unconnected pairs grows with their number: with the square of a group of texts that are alike
in over about a half, but not enough to be connected.

Null or blank texts have no set: n_shingles 0, no links. Rows with a null doc_id take no part: they are
kept, with a null component. Rows that repeat a doc_id are nodes of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from confluo.llm.common import bitmap, documents, drop, is_marked, map_arrow, shingles, small_batches, utf8, word_hashes, written
from confluo.llm.graph import components, stars

K, SIZE, TREES, DEPTH = 5, 128, 32, 4
NEAR, CLOSE, DENSE, LEAST = 7, 1, 16, 62
BLOCK, BLOCK_SHINGLES = 4096, 1 << 22
PERCENT = 75

_RNG = np.random.default_rng(20_011)
_A = _RNG.integers(0, 1 << 32, SIZE, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, SIZE, dtype=np.uint64).astype(np.uint32)
_MIX = np.uint32(0x9E3779B1)


def shingle_set(text: bytes, k: int = K) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    words = word_hashes(text.lower().split())
    return np.unique(shingles(words, min(k, len(words)) or 1))


def signature(members: np.ndarray) -> np.ndarray:
    """SIZE minhash digits of 16 bits."""
    x, low = (members >> np.uint64(32)).astype(np.uint32), np.full(SIZE, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(low, (x[i : i + 512, None] * _A + _B).min(axis=0), out=low)
    low ^= low >> np.uint32(15)
    return (low * _MIX >> np.uint32(16)).astype(np.uint16)


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text), n_shingles, digest and digits of each row."""

    def work(batch):
        n, digest, digits = [], [], []
        for text in batch.column("text").to_pylist():
            s = shingle_set(text)
            n.append(len(s))
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            digits.append(signature(s).astype(">u2").tobytes() if len(s) else None)
        yield {"doc_id": batch.column("doc_id"), "mark": batch.column("mark"), "n_shingles": n, "digest": digest, "digits": digits}

    rows = docs.select("doc_id", F.xxhash64(utf8()).alias("mark"), utf8().alias("text"))
    return map_arrow(rows, work, f"doc_id {dict(docs.dtypes)['doc_id']}, mark long, n_shingles long, digest binary, digits binary")


def _neighbours(order: DataFrame) -> DataFrame:
    """a, b: rows of order (region, size, digits, c) at most NEAR apart, CLOSE in a dense region, in the sorted order and in the same region."""

    def scan(batches):
        import pyarrow as pa

        form = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("region", pa.int64()), ("size", pa.int64()), ("digits", pa.binary())])
        region, size, c, digits, first, n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), [], True, 0
        for batch in batches:
            n += batch.num_rows
            region, size, c = (np.concatenate([x, batch.column(k).to_numpy()]) for k, x in (("region", region), ("size", size), ("c", c)))
            digits = digits + batch.column("digits").to_pylist()
            new = len(c) - batch.num_rows
            a, b = [], []
            for d in range(1, NEAR + 1):
                at = np.arange(max(new, d), len(c))
                at = at[(region[at] == region[at - d]) & ((d <= CLOSE) | (size[at] <= DENSE))]
                a.append(c[at - d])
                b.append(c[at])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.binary())], schema=form)
            if first:  # rows at a partition's two ends, for the second pass
                yield pa.RecordBatch.from_arrays([pa.array(c[:NEAR]), pa.nulls(len(c[:NEAR]), pa.int64()), pa.array(region[:NEAR]), pa.array(size[:NEAR]), pa.array(digits[:NEAR], pa.binary())], schema=form)
                first = False
            region, size, c, digits = region[-NEAR:], size[-NEAR:], c[-NEAR:], digits[-NEAR:]
        if n > NEAR:
            m = min(NEAR, n - NEAR)
            yield pa.RecordBatch.from_arrays([pa.array(c[-m:]), pa.nulls(m, pa.int64()), pa.array(region[-m:]), pa.array(size[-m:]), pa.array(digits[-m:], pa.binary())], schema=form)

    form = "a long, b long, region long, size long, digits binary"
    by = ["region", "digits", "c"]
    first = written(order.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(scan, form), "neighbours")
    ends = first.where("b IS NULL").select("region", "size", "digits", F.col("a").alias("c"))
    second = ends.repartition(1).sortWithinPartitions(*by).mapInArrow(scan, form)  # 2 * NEAR rows a partition
    return first.unionByName(second).where("b IS NOT NULL").select("a", "b")


def _leaders(active: DataFrame) -> DataFrame:
    """a, b: each class with its region's leader, at every depth that applies."""
    # A class has TREES rows at most.
    active = active.withColumn("weight", F.sum("size").over(Window.partitionBy("c")))
    deep = [F.when(F.col("size") > DENSE, F.xxhash64("region", F.expr(f"substring(digits, 1, {n})"))) for n in (4, 8, 16)]
    at = active.select("c", "weight", F.explode(F.array_compact(F.array("region", *deep))).alias("region"))
    lead = at.groupBy("region").agg(F.max(F.struct("weight", "c"))["c"].alias("b"), F.count("*").alias("n")).where("n > 1").select("region", "b")
    return at.select("region", F.col("c").alias("a")).join(lead, "region").select("a", "b")


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """leaf, hub (the end with more company over all trees), agree, w (the hub's company) and both texts' marks for each pair of classes (c, mark, digits) to be verified; the classes by region."""
    trees = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(F.xxhash64(t, F.substring(F.col("twice"), t * 8 + 1, F.lit(8))).alias("region"), F.substring(F.col("twice"), t * 8 + 9, F.lit(16)).alias("digits"), t.alias("tree")))
    rows = classes.select("c", F.concat("digits", "digits").alias("twice")).select("c", F.explode(trees).alias("t")).select("c", "t.region", "t.digits", "t.tree")
    shared = rows.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
    active = written(rows.join(shared, "region"), "active")
    pairs = _neighbours(active.select("region", "size", "digits", "c")).union(_leaders(active)).where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    known = classes.join(active.groupBy("c").agg(F.sum("size").alias("weight")), "c")
    one, two = (known.select(F.col("c").alias(k), F.col("digits").alias(f"{k}_digits"), F.col("weight").alias(f"{k}_weight"), F.col("mark").alias(f"{k}_mark")) for k in "ab")

    def compare(batch):
        x, y = (np.frombuffer(b"".join(batch.column(f"{k}_digits").to_pylist()), ">u2").reshape(-1, SIZE) for k in "ab")
        agree = (x == y).sum(axis=1)
        keep = np.flatnonzero(agree >= LEAST)
        (a, wa, ma), (b, wb, mb) = ([batch.column(c).to_numpy()[keep] for c in (k, f"{k}_weight", f"{k}_mark")] for k in "ab")
        up = (wa > wb) | (wa == wb) & (a < b)
        yield {"leaf": np.where(up, b, a), "hub": np.where(up, a, b), "agree": agree[keep].astype(np.int32), "w": np.maximum(wa, wb), "leaf_mark": np.where(up, mb, ma), "hub_mark": np.where(up, ma, mb)}

    likely = map_arrow(pairs.join(one, "a").join(two, "b"), compare, "leaf long, hub long, agree int, w long, leaf_mark long, hub_mark long")
    return written(likely, "pairs"), active


def _jobs(active: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """region, tree, i, j, side, c, root: the classes of regions of over NEAR + 1 classes with different roots, dealt to jobs so that all pairs outside the largest component meet.

    A job (i, j) has block i of the others (side 0) and block j of the others (side 1; none if i = j) or, below zero, of the largest component.
    """
    dense = active.where(F.col("size") > NEAR + 1).select("region", "tree", "c").join(classes.select("c", "n_shingles"), "c")
    dense = dense.join(roots.select(F.col("node").alias("c"), "root"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    parts = dense.groupBy("region", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("m")).groupBy("region")
    parts = parts.agg(F.count("*").alias("roots"), F.sum("n").alias("n"), F.sum("m").alias("m"), F.max(F.struct("n", "root", "m")).alias("top")).where("roots > 1")
    blocks = lambda n, m: F.ceil(F.greatest(n / BLOCK, m / BLOCK_SHINGLES)).cast("int")
    parts = parts.select("region", F.col("top.root").alias("top"), blocks(F.col("top.n"), F.col("top.m")).alias("tops"), blocks(F.col("n") - F.col("top.n"), F.col("m") - F.col("top.m")).alias("others"))
    some = lambda n: F.sequence(F.lit(0), n - 1)
    job = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    of = lambda n: F.pmod(F.xxhash64("c"), n).cast("int")
    tops, others = F.col("tops"), F.col("others")
    top = F.transform(some(others), lambda i: job(i, -1 - of(tops), 1))
    with_top = F.transform(some(tops), lambda j: job(of(others), -1 - j, 0))
    low = F.transform(F.sequence(of(others), others - 1), lambda j: job(of(others), j, 0))
    high = F.transform(F.filter(some(others), lambda i: i < of(others)), lambda i: job(i, of(others), 1))
    dealt = dense.join(parts, "region").withColumn("job", F.explode(F.when(F.col("root") == F.col("top"), top).otherwise(F.concat(with_top, low, high))))
    return dealt.select("region", "tree", "job.*", "c", "root")


def merging(one, two, tree: int, percent: int = PERCENT):
    """(a, b) of pairs of rows of one and two, or of one with itself, that are similar and join different components; rows are lists c, root, digits, members.

    Pairs whose first common tree is another are left to it. Every pair is compared, or its ends are connected by then.
    """
    c, root, digits, members = (x + y for x, y in zip(one, two)) if two else one
    own, c = len(one[0]), np.array(c, np.int64)
    label = np.unique(np.array(root, np.int64), return_inverse=True)[1]
    digits = np.frombuffer(b"".join(digits), ">u2").reshape(-1, SIZE).astype(np.uint16)
    n = np.fromiter((len(m) >> 3 for m in members), np.int64, len(members))
    start = np.cumsum(n) - n
    values, ids = np.unique(np.frombuffer(b"".join(members), np.uint64), return_inverse=True)
    mine = np.zeros(len(values), bool)

    def similar(i, j):
        """Which rows j are similar to row i, whose shingles are marked."""
        at = np.arange(n[j].sum()) - np.repeat(np.cumsum(n[j]) - n[j] - start[j], n[j])
        same = np.add.reduceat(mine[ids[at]], np.cumsum(n[j]) - n[j], dtype=np.int64)
        return 100 * same >= percent * (n[i] + n[j] - same)

    for i in range(own):
        j = np.arange(own if two else i + 1, len(c))
        j = j[(label[j] != label[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
        same = digits[j] == digits[i]
        agree = same.sum(axis=1)
        likely = np.flatnonzero(agree >= LEAST)
        likely = likely[same[likely].reshape(len(likely), TREES, DEPTH).all(axis=2).argmax(axis=1) == tree]
        j = j[likely[np.argsort(-agree[likely], kind="stable")]]
        if not len(j):
            continue
        mine[ids[start[i] : start[i] + n[i]]] = True
        # The most alike first: what they connect need not be compared.
        for part in (j[:8], j[8:]):
            part = part[label[part] != label[i]]
            for k in part[similar(i, part)].tolist() if len(part) else ():
                if label[k] != label[i]:
                    yield c[i], c[k]
                    label[label == label[k]] = label[i]
        mine[ids[start[i] : start[i] + n[i]]] = False


def unconnected(docs: DataFrame, active: DataFrame, classes: DataFrame, roots: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, tuple[DataFrame, ...]] | None:
    """a, b: links between components among the classes of dense regions, found by comparing all pairs there that are not connected, and the tables that are read for it; None if all are."""
    jobs = written(_jobs(active, classes, roots), "jobs")
    if jobs.isEmpty():
        drop(jobs)
        return None
    sets = _sets(docs, classes, classes.join(jobs.select("c").distinct(), "c", "left_semi").select("first.mark"))
    dealt = jobs.join(classes.select("c", "digits"), "c").join(sets, "c")

    def scan(batches):
        import pyarrow as pa

        def out():
            found = list(merging(sides[0], None if key[2] == key[3] else sides[1], key[1], percent)) if sides[0][0] else []
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["a", "b"])

        key, sides = None, None
        for batch in batches:
            for region, tree, i, j, side, *row in zip(*(batch.column(k).to_pylist() for k in ("region", "tree", "i", "j", "side", "c", "root", "digits", "members"))):
                if key != (region, tree, i, j):
                    if key:
                        yield out()
                    key, sides = (region, tree, i, j), [[[] for _ in range(4)] for _ in range(2)]
                for values, x in zip(sides[side], row):
                    values.append(x)
        if key:
            yield out()

    by = ["region", "tree", "i", "j"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(scan, "a long, b long"), (jobs, sets)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: links that connect what the pairs (leaf, hub) with sets (c, members) that similar connect; a forest of each task's."""

    def similar(batches):
        import pyarrow as pa

        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                same = len(np.intersect1d(one, two, assume_unique=True))
                ok.append(100 * same >= percent * (len(one) + len(two) - same))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(ok, pa.bool_())) for k in ("leaf", "hub")], ["a", "b"])

    small_batches(pairs.sparkSession)
    leaf, hub = (sets.select(F.col("c").alias(k), F.col("members").alias(m)) for k, m in (("leaf", "x"), ("hub", "y")))
    return pairs.select("leaf", "hub").join(leaf, "leaf").join(hub, "hub").mapInArrow(lambda batches: stars(similar(batches)), "a long, b long")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """leaf, hub of the pairs whose ends are not connected."""
    rooted = lambda k: roots.select(F.col("node").alias(k), F.col("root").alias(f"{k}_root"))
    return pairs.join(rooted("leaf"), "leaf", "left").join(rooted("hub"), "hub", "left").where("coalesce(leaf_root, leaf) <> coalesce(hub_root, hub)").select("leaf", "hub")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, mark, n_shingles, component_id, kept for each row of docs (doc_id, text)."""
    rows = written(profiles(docs), "profiles")
    classes = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.first("digits").alias("digits"), F.first("n_shingles").alias("n_shingles"))
    classes = written(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    pairs, active = candidates(classes.select("c", "first.mark", "digits"))
    sets = _sets(docs, classes, pairs.select(F.explode(F.array("leaf_mark", "hub_mark")).alias("mark")))
    # A class's best candidate: the most agreement in steps of eight, then the hub with the most company.
    best = pairs.groupBy("leaf").agg(F.max(F.struct(F.floor(F.col("agree") / 8).alias("step"), "w", "hub"))["hub"].alias("hub"))
    roots = components(verified(best, sets), spanned=True)
    more = verified(_apart(pairs.join(best, ["leaf", "hub"], "left_anti"), roots), sets)
    # What is connected is so by its root.
    roots = components(more.union(roots), spanned=True)
    drop(sets, pairs)
    if (found := unconnected(docs, active, classes, roots)) is not None:
        more, read = found
        roots = components(more.union(roots), spanned=True)
        drop(*read)
    drop(active)
    named = classes.select("digest", "c", F.col("first.doc_id").alias("doc")).join(roots, F.col("c") == F.col("node"), "left")
    named = named.select("digest", "doc", F.coalesce("root", "c").alias("root"))
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = named.join(least, "root").select("digest", "component_id")
    out = rows.join(named, "digest", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "mark", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _sets(docs: DataFrame, classes: DataFrame, marks: DataFrame) -> DataFrame:
    """c, members for the classes of the texts marked (mark), and of some others, from their first documents' texts; a scan knows them by a bitmap of fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(marks, "mark"))

    def work(batch):
        import pyarrow as pa

        hit = pa.array(np.flatnonzero(is_marked(shared.value, batch.column("mark").to_numpy())))
        yield {k: batch.column(k).take(hit) for k in ("doc_id", "mark")} | {"members": [shingle_set(t).tobytes() for t in batch.column("text").take(hit).to_pylist()]}

    rows = docs.select("doc_id", F.xxhash64(utf8()).alias("mark"), utf8().alias("text"))
    # Rows that repeat a document give its set once.
    made = map_arrow(rows, work, f"doc_id {dict(docs.dtypes)['doc_id']}, mark long, members binary").dropDuplicates(["doc_id", "mark"])
    return written(made.join(classes.select("c", "first.doc_id", "first.mark"), ["doc_id", "mark"]).select("c", "members"), "sets")


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs that are first in their component, with docs' columns, whatever their names; rows that repeat both id and text are one document to it and stay or go together."""
    gone = near_duplicates(docs.select("doc_id", "text")).where("NOT kept").select("doc_id", "mark").distinct()
    # The row travels as one struct, so that no column's name can clash.
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select("row", F.xxhash64(utf8("row.text")).alias("mark"))
    same = (whole["row.doc_id"] == gone["doc_id"]) & (whole["mark"] == gone["mark"])
    return whole.join(gone, same, "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("mark")
