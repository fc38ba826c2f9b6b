"""Connected components of a graph given as rows, by contracting it round by round."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored

#: Once the counted edges of a contracted graph are no more than this, one task joins them: a round takes some ten stages
#: however few its edges are.
LAST_EDGES = 1 << 16


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b): node, label, where label is the smallest node of the component."""
    edges = [np.stack([c.to_numpy() for c in batch.columns]) for batch in batches if batch.num_rows]
    if not edges:
        return
    node, at = np.unique(np.concatenate(edges, axis=1), return_inverse=True)
    up = list(range(len(node)))
    for pair in at.reshape(2, -1).T.tolist():
        for k in (0, 1):
            while up[pair[k]] != pair[k]:
                up[pair[k]] = pair[k] = up[up[pair[k]]]
        up[max(pair)] = min(pair)
    for k, above in enumerate(up):  # those above have smaller places, so they are done already
        up[k] = up[above]
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[up])], ["node", "label"])


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``edges`` (a, b: long): node, label, where label is the smallest node of the component. ``known``: components
    (node, label) that other edges have made already; its nodes are in the result too.

    Each round, every node moves to the neighbour, or itself, that comes first in an order by hash; two rounds share an
    order, so a star is one node after them and a chain, whose order is random, loses a part of its nodes. Edges are
    led to the new nodes; those within a node and repeated ones vanish, so the rows of all rounds together are in
    proportion to the edges. The last ``LAST_EDGES`` are joined by one task. Tables in the shared folder cut the lineage.
    """

    def led(pairs: DataFrame, to: DataFrame) -> DataFrame:
        """``pairs`` between what their ends have moved to (node, label)."""
        for side in "ab":
            ends = to.select(F.col("node").alias(side), F.col("label").alias("to_" + side))
            pairs = pairs.join(ends, side, "left").withColumn(side, F.coalesce("to_" + side, side)).drop("to_" + side)
        return pairs

    def distinct(pairs: DataFrame) -> DataFrame:
        return stored(pairs.where("a != b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")

    given = edges.select("a", "b")
    if known is None:
        start = given.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        given = distinct(given)
    else:
        # Nodes without known edges are components of their own.
        ends = given.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        start = known.select("node", "label").unionByName(
            ends.join(known, "node", "left_anti").select("node", F.col("node").alias("label")))
        given = distinct(led(given, known))
    moves: list[DataFrame] = []
    while left := given.count():
        if left <= LAST_EDGES:
            moves.append(stored(given.coalesce(1).mapInArrow(_united, "node long, label long"), "moves"))
            break
        order = lambda c: F.struct(F.xxhash64(c, F.lit(len(moves) // 2)).alias("hash"), F.col(c).alias("at"))
        both = given.select(F.col("a").alias("node"), F.col("b").alias("other")).union(given.select("b", "a"))
        first = both.groupBy("node").agg(F.min(order("other")).alias("first"))
        moves.append(stored(first.select(
            "node", F.least("first", order("node"))["at"].alias("label")), "moves"))
        given = distinct(led(given, moves[-1]))
    to = None  # where each node of a round ends
    for move in reversed(moves):
        if to is not None:
            last = to.select(F.col("node").alias("label"), F.col("label").alias("end"))
            move = move.join(last, "label", "left").select("node", F.coalesce("end", "label").alias("label"))
        to = move
    if to is None:
        return stored(start if known is not None else start.withColumn("label", F.col("node")), "labels")
    to = stored(to, "moved")
    if known is None:
        found = start.join(to, "node", "left").select("node", F.coalesce("label", "node").alias("end"))
    else:
        found = start.join(to.select(F.col("node").alias("label"), F.col("label").alias("end")), "label", "left").select(
            "node", F.coalesce("end", "label").alias("end"))
    found = stored(found, "ends")
    least = found.groupBy("end").agg(F.min("node").alias("label"))
    return stored(found.join(least, "end").select("node", "label"), "labels")
