"""Connected components by spanning forests, joins and aggregates; nothing is gathered on the driver but counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import drop, written

#: Links of the tasks' forests that one task takes at most (16 bytes each); more go by rounds of joins.
LOCAL = 1 << 20


def stars(links: Iterable[pa.RecordBatch], whole: bool = False) -> Iterator[pa.RecordBatch]:
    """a, b (the smallest node that a reaches by these links) for each node that is not the smallest itself; for all nodes if whole."""
    links = list(links)
    a, b = (np.concatenate([np.zeros(0, np.int64), *(x.column(k).to_numpy() for x in links)]) for k in range(2))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(one):
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while (root[root] != root).any():
            root = root[root]
        one, two = root[one], root[two]
        open_ = one != two
        one, two = one[open_], two[open_]
    out = np.flatnonzero((root != np.arange(len(nodes))) | whole)
    yield pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[root[out]])], ["a", "b"])


def components(links: DataFrame, local: int = LOCAL, spanned: bool = False) -> DataFrame:
    """node, root (the smallest node reachable) for each node of links (a, b). Null ends and loops are ignored; no links give no rows.

    Every task leaves of its links a forest, which connects the same nodes (spanned: links come so). One task
    joins the forests if they have up to local links; else rounds do. Each round takes the smallest root among a node's neighbours and then its root's root, so paths
    shorten to half or less; rounds end when nothing changes. Roots are written out every round.
    """
    links = links.where("a <> b").select("a", "b")
    forest = written(links if spanned else links.mapInArrow(stars, "a long, b long"), "forest")
    if forest.count() <= local:
        roots = written(forest.repartition(1).mapInArrow(lambda links: stars(links, True), "a long, b long").toDF("node", "root"), "roots")
        drop(forest)
        return roots
    both = forest.distinct()
    both = written(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    # The smallest neighbour of each node, which itself may be the smaller: partial sums meet by key.
    roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).select("node", F.least("node", "root").alias("root"))
    roots = last = written(roots, "roots")
    while True:
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        mine = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        up = roots.select(F.col("node").alias("next"), F.col("root").alias("top"))
        # A root may learn of a smaller one too: what its followers have found goes to it.
        told = mine.where("next < root").groupBy(F.col("root").alias("node")).agg(F.min("next").alias("told"))
        step = mine.join(up, "next").join(told, "node", "left").select("node", "root", F.least("next", "top", "told").alias("next"))
        step = written(step, "roots")
        drop(last)
        if step.where("next < root").isEmpty():
            drop(both, forest)
            return step.select("node", "root")
        roots, last = step.select("node", F.col("next").alias("root")), step
