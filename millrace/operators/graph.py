"""Graphs as two tables: ``nodes(id)`` and ``edges(source, destination)``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..session import scratch, settings
from .ranking import first_n

# Edge direction as seen from the node asked about, and the hop limit.
OUTGOING = "OUTGOING_CITES"
INCOMING = "INCOMING_CITED_BY"
MAX_HOPS = 15

#: Frontiers up to so many nodes are looked up by name; up to the second size they are broadcast (16 bytes a row).
LOOKUP_NODES = 500
FRONTIER_BROADCAST_ROWS = 200_000
EDGES_PER_PARTITION = 2_000_000
MOST_PARTITIONS = 20_000
ROW_GROUP_BYTES = 1 << 20
PAGE_ROWS = 2_000

PATH_SCHEMA = T.StructType([
    T.StructField("start", T.LongType()),
    T.StructField("finish", T.LongType()),
    T.StructField("hop_count", T.IntegerType()),
    T.StructField("path", T.ArrayType(T.LongType())),
])


def merge_edges(edges: DataFrame) -> DataFrame:
    """Each relationship once."""
    return edges.select("source", "destination").distinct()


def node_union(edges: DataFrame) -> DataFrame:
    """Every endpoint once, from a single pass over the edges."""
    return edges.select(F.explode(F.array("source", "destination")).alias("id")).distinct()


def graph_build(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) with create-if-absent semantics; edges with a null end are left out."""
    whole = edges.filter(F.col("source").isNotNull() & F.col("destination").isNotNull())
    return node_union(whole), merge_edges(whole)


def undirected(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, from a single pass."""
    both = F.array(
        F.struct(F.col("source").alias("a"), F.col("destination").alias("b")),
        F.struct(F.col("destination").alias("a"), F.col("source").alias("b")),
    )
    return edges.select(F.inline(both)).toDF("source", "destination")


def in_degree(edges: DataFrame, nodes: DataFrame | None = None, include_zero: bool = False) -> DataFrame:
    """``(id, in_degree)``: incoming edges per node, optionally with nodes that have none.

    Nodes enter the same aggregate with weight zero, so no join is needed and a hot
    destination is reduced on the map side.
    """
    if not include_zero:
        return edges.groupBy(F.col("destination").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))
    if nodes is None:
        ends = F.array(
            F.struct(F.col("source").alias("id"), F.lit(0).cast("bigint").alias("hit")),
            F.struct(F.col("destination").alias("id"), F.lit(1).cast("bigint").alias("hit")),
        )
        return edges.select(F.inline(ends)).groupBy("id").agg(F.sum("hit").alias("in_degree"))
    marked = nodes.select("id", F.lit(0).cast("bigint").alias("hit"), F.lit(1).alias("known")).unionByName(
        edges.select(
            F.col("destination").alias("id"), F.lit(1).cast("bigint").alias("hit"), F.lit(0).alias("known")
        )
    )
    return (
        marked.groupBy("id")
        .agg(F.sum("hit").alias("in_degree"), F.max("known").alias("known"))
        .filter(F.col("known") == 1)
        .select("id", "in_degree")
    )


def top_in_degree(degrees: DataFrame, k: int) -> DataFrame:
    return first_n(degrees, [F.desc("in_degree"), F.asc("id")], k)


def point_lookup(nodes: DataFrame, node_id: int) -> DataFrame:
    return nodes.filter(F.col("id") == F.lit(node_id))


def neighbors(edges: DataFrame, target: int | Column) -> DataFrame:
    """``(target, neighbor, direction)`` of one node, both directions, in order.

    One filtered pass: an edge leaving the target is outgoing (a self-loop too), any other
    match is incoming. A reciprocal pair is two edges and gives two rows.
    """
    wanted = target if isinstance(target, Column) else F.lit(target)
    leaving = F.col("source") == wanted
    return (
        edges.filter(leaving | (F.col("destination") == wanted))
        .select(
            wanted.cast("bigint").alias("target"),
            F.when(leaving, F.col("destination")).otherwise(F.col("source")).alias("neighbor"),
            F.when(leaving, F.lit(OUTGOING)).otherwise(F.lit(INCOMING)).alias("direction"),
        )
        .orderBy("neighbor", "direction")
    )


class Adjacency:
    """Undirected edges laid out once for repeated frontier steps.

    Edges are stored as Parquet in order of ``(source, destination)``, dealt by range of both, so a node holding a third
    of the graph lies in many files and every other node in one or two. Row groups are small: a step from a few nodes
    names them in the filter, and their statistics and page index leave only the pages that may hold those nodes.
    """

    def __init__(self, edges: DataFrame):
        spark = edges.sparkSession
        both = undirected(edges)
        # Partitions follow the size of the graph, at least one per core.
        self.parts = max(spark.sparkContext.defaultParallelism, min(2 * edges.count() // EDGES_PER_PARTITION, MOST_PARTITIONS))
        self.path = scratch(spark, "adjacency")
        both.repartitionByRange(self.parts, "source", "destination").sortWithinPartitions("source", "destination").write.option(
            "parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS).parquet(self.path)
        self.edges = spark.read.schema("source bigint, destination bigint").parquet(self.path)

    def holds(self, *nodes: int) -> bool:
        return self.edges.filter(F.col("source").isin(*nodes)).select("source").distinct().count() == len(set(nodes))

    def touching(self, frontier: Level) -> DataFrame:
        """Edges that leave the frontier: by pruned lookup, by broadcast, or by a shuffle join in which adaptive
        execution splits hot nodes, as the frontier's size allows."""
        if frontier.ids is not None:
            return self.edges.filter(F.col("source").isin(*frontier.ids))
        ids = frontier.table.select(F.col("id").alias("source"))
        return self.edges.join(F.broadcast(ids) if frontier.size <= FRONTIER_BROADCAST_ROWS else ids, "source")

    def step(self, frontier: Level) -> DataFrame:
        """``(id, parent)`` one edge away; the smallest parent wins."""
        return self.touching(frontier).groupBy(F.col("destination").alias("id")).agg(F.min("source").alias("parent"))


@dataclass(frozen=True)
class Level:
    """Nodes at one distance from an end: a stored table ``(id, parent)``, its size, and the ids where they are few."""

    table: DataFrame
    size: int
    ids: tuple[int, ...] | None

    def without(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose id is not in this level."""
        if self.ids is not None:
            return df.filter(~F.col("id").isin(*self.ids)) if self.ids else df
        return df.join(self.table.select("id"), "id", "left_anti")

    def within(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose id is in this level."""
        if self.ids is not None:
            return df.filter(F.col("id").isin(*self.ids))
        return df.join(self.table.select("id"), "id", "left_semi")


def _level(df: DataFrame, label: str) -> Level:
    """Store a level; its few ids come to the driver, a large one stays where it is."""
    spark = df.sparkSession
    path, seen = scratch(spark, label), Observation(label)
    df.observe(seen, F.count(F.lit(1)).alias("size")).write.parquet(path)
    table = spark.read.schema("id bigint, parent bigint").parquet(path)
    size = seen.get["size"]
    few = tuple(r["id"] for r in table.select("id").collect()) if 0 < size <= LOOKUP_NODES else () if not size else None
    return Level(table, size, few)


def _first_level(spark: SparkSession, node: int) -> Level:
    return Level(spark.range(node, node + 1).select("id", F.lit(None).cast("bigint").alias("parent")), 1, (node,))


def _pushdown(spark: SparkSession):
    """Filters naming a frontier reach the row groups as a list of values, not as a range from its least to its largest."""
    return settings(spark, {"spark.sql.parquet.pushdown.inFilterThreshold": str(LOOKUP_NODES)})


def shortest_path(
    edges: DataFrame, start: int, finish: int, max_hops: int = MAX_HOPS
) -> DataFrame:
    """One shortest undirected path of 1..``max_hops`` edges, or no row: the smallest one in node order.

    Breadth-first levels grow from both ends, always at the end whose last level is smaller, until the last levels
    meet. A level can only touch itself and its two neighbours, so older levels are not compared again. From where the
    ends meet, the nodes on shortest paths are followed back to ``start``, each with its smallest successor; beyond,
    the levels of ``finish`` hold each node's smallest neighbour nearer to it. Every level is a table in the shared
    folder, so lineage stays one hop deep; the path is read off by one lookup of one row a level.
    """
    spark = edges.sparkSession
    nothing = spark.createDataFrame([], PATH_SCHEMA)
    if start == finish:
        return nothing
    graph = Adjacency(edges)
    with _pushdown(spark):
        if not graph.holds(start, finish):
            return nothing
        levels = _meet(graph, start, finish, max_hops)
    return _walk_back(levels, start, finish) if levels else nothing


def frontier_levels(graph: Adjacency, start: int, hops: int) -> list[DataFrame]:
    """``(id, parent)`` of the nodes first met at hop 1, 2, ... from ``start``; ends early when nothing new is met."""
    spark = graph.edges.sparkSession
    levels = [_first_level(spark, start)]
    with _pushdown(spark):
        for _ in range(hops):
            level = _next_level(graph, levels)
            if not level.size:
                break
            levels.append(level)
    return [level.table for level in levels[1:]]


def _next_level(graph: Adjacency, levels: list[Level]) -> Level:
    reached = graph.step(levels[-1])
    for known in levels[-2:]:
        reached = known.without(reached)
    return _level(reached, f"level-{len(levels)}")


def _meet(graph: Adjacency, start: int, finish: int, max_hops: int) -> list[DataFrame] | None:
    """Tables ``(id, parent)`` from ``finish`` to ``start`` in which parents lead along the smallest shortest path, or
    none if the ends don't meet."""
    spark = graph.edges.sparkSession
    ahead, back = [_first_level(spark, start)], [_first_level(spark, finish)]
    while True:
        met = _common(ahead[-1], back[-1])
        if met.size:
            break
        if len(ahead) + len(back) - 2 == max_hops:
            return None
        own = ahead if ahead[-1].size < back[-1].size else back
        own.append(_next_level(graph, own))
        if not own[-1].size:
            return None
    on_path = []  # from the meeting level back to the start: only nodes on shortest paths, with their smallest successor
    for level in reversed(ahead[:-1]):
        met = _level(level.within(graph.step(met)), f"on-path-{len(on_path)}")
        on_path.append(met)
    return [level.table for level in back + on_path]


def _common(left: Level, right: Level) -> Level:
    if left.ids is not None and right.ids is not None:
        both = tuple(set(left.ids) & set(right.ids))
        return Level(right.table.filter(F.col("id").isin(*both)) if both else right.table.limit(0), len(both), both)
    small, large = (left, right) if left.size <= right.size else (right, left)
    return _level(small.within(large.table), "met")


def _walk_back(levels: list[DataFrame], start: int, finish: int) -> DataFrame:
    """Follow the parents from ``start``; the walk is a single row joined to each level."""
    walk = levels[-1].filter(F.col("id") == start).select(
        F.array("id").alias("path"), F.col("parent").alias("next")
    )
    for level in reversed(levels[1:-1]):
        walk = level.join(F.broadcast(walk), F.col("id") == F.col("next")).select(
            F.array_append("path", F.col("id")).alias("path"), F.col("parent").alias("next")
        )
    return walk.select(
        F.lit(start).cast("bigint").alias("start"),
        F.lit(finish).cast("bigint").alias("finish"),
        F.size("path").alias("hop_count"),
        F.array_append("path", F.col("next")).alias("path"),
    )
