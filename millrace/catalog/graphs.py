"""Graph queries. An edge is an order line: order -> part, parts offset to keep ids apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.graph import (
    Adjacency, frontier_levels, graph_build, in_degree, merge_edges, neighbors, node_union, shortest_path, top_in_degree, undirected,
)
from ..operators.ranking import ranked, ranked_all
from ..operators.workers import allocation, skew_compare, skew_workers, totals, worker_grid
from ..plans.graphs import profile_steps, rank_edge_file, rank_in_degree
from ..session import scratch
from ..sinks.tables import write_graph, write_lines
from .registry import query, table

PART_OFFSET = 1_000_000_000
_EDGES = f"SELECT l_orderkey AS source, {PART_OFFSET} + l_partkey AS destination FROM lineitem"


def edges_of(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("source"), (F.col("l_partkey") + PART_OFFSET).alias("destination")
    )


@query("node_union", f"""
    WITH e AS ({_EDGES}) SELECT source AS id FROM e UNION SELECT destination FROM e""")
def _node_union(spark, sf):
    return node_union(edges_of(spark, sf))


@query("merge_edges", f"SELECT DISTINCT * FROM ({_EDGES})")
def _merge_edges(spark, sf):
    return merge_edges(edges_of(spark, sf))


@query("count_total", f"SELECT count(*) AS edges FROM (SELECT DISTINCT * FROM ({_EDGES}))")
def _count_total(spark, sf):
    return merge_edges(edges_of(spark, sf)).agg(F.count(F.lit(1)).alias("edges"))


@query("undirected_closure", f"""
    WITH e AS ({_EDGES}) SELECT source, destination FROM e UNION ALL SELECT destination, source FROM e""")
def _undirected(spark, sf):
    return undirected(edges_of(spark, sf))


@query("undirected_match", f"""
    WITH e AS (SELECT DISTINCT * FROM ({_EDGES}))
    SELECT node, count(*) AS touching FROM (
        SELECT source AS node FROM e UNION ALL SELECT destination FROM e) GROUP BY node""")
def _undirected_match(spark, sf):
    both = undirected(merge_edges(edges_of(spark, sf)))
    return both.groupBy(F.col("source").alias("node")).agg(F.count(F.lit(1)).alias("touching"))


@query("count_by_key", f"SELECT destination AS id, count(*) AS in_degree FROM ({_EDGES}) GROUP BY destination")
def _count_by_key(spark, sf):
    return in_degree(edges_of(spark, sf))


_ZERO = f"""
    WITH e AS (SELECT DISTINCT * FROM ({_EDGES})), n AS (SELECT source AS id FROM e UNION SELECT destination FROM e)
    SELECT n.id, count(e.source) AS in_degree FROM n LEFT JOIN e ON e.destination = n.id GROUP BY n.id"""


@query("count_with_zero", _ZERO)
def _count_with_zero(spark, sf):
    return in_degree(merge_edges(edges_of(spark, sf)), include_zero=True)


@query("optional_match", _ZERO)
def _optional_match(spark, sf):
    nodes, edges = graph_build(edges_of(spark, sf))
    return in_degree(edges, nodes, include_zero=True)


@query("topk_indegree", f"""
    SELECT destination AS id, count(*) AS in_degree FROM ({_EDGES}) GROUP BY destination
    ORDER BY in_degree DESC, id LIMIT 50""")
def _topk(spark, sf):
    return top_in_degree(in_degree(edges_of(spark, sf)), 50)


@query("topk_indegree_zero", f"SELECT * FROM ({_ZERO}) ORDER BY in_degree DESC, id LIMIT 10")
def _topk_zero(spark, sf):
    return top_in_degree(in_degree(merge_edges(edges_of(spark, sf)), include_zero=True), 10)


_RANKED = f"""
    SELECT row_number() OVER (ORDER BY in_degree DESC, destination) AS rank, destination, in_degree
    FROM (SELECT destination, count(*) AS in_degree FROM ({_EDGES}) GROUP BY destination
          ORDER BY in_degree DESC, destination LIMIT 50)"""


@query("rank_rows", _RANKED)
def _rank_rows(spark, sf):
    return rank_in_degree(edges_of(spark, sf), 50)


@query("csv_rank_sink", _RANKED)
def _csv_rank_sink(spark, sf):
    """The whole batch job: edge text in, counted while ranked, one CSV out."""
    text, target = scratch(spark, "graph-text"), scratch(spark, "ranking")
    write_lines(edges_of(spark, sf), F.concat_ws("\t", "source", "destination"), text)
    rank_edge_file(spark, text, target, 50, table(spark, sf, "lineitem").count())
    return spark.read.schema("rank bigint, destination bigint, in_degree bigint").option("header", True).csv(target)


@query("graph_build", f"""
    WITH e AS (SELECT DISTINCT * FROM ({_EDGES}))
    SELECT (SELECT count(*) FROM (SELECT source FROM e UNION SELECT destination FROM e)) AS nodes,
           (SELECT count(*) FROM e) AS edges""")
def _graph_build(spark, sf):
    nodes, edges = graph_build(edges_of(spark, sf))
    sizes = nodes.select(F.lit(1).alias("node"), F.lit(0).alias("edge")).unionByName(
        edges.select(F.lit(0).alias("node"), F.lit(1).alias("edge")))
    return sizes.agg(F.sum("node").alias("nodes"), F.sum("edge").alias("edges"))


@query("graph_tables_sink", f"SELECT DISTINCT * FROM ({_EDGES})")
def _graph_tables_sink(spark, sf):
    path = scratch(spark, "graph")
    write_graph(edges_of(spark, sf), path)
    return spark.read.parquet(f"{path}/edges")


@query("neighbors", f"""
    WITH e AS (SELECT DISTINCT * FROM ({_EDGES})),
    hub AS (SELECT destination AS id FROM e GROUP BY destination ORDER BY count(*) DESC, id LIMIT 1)
    SELECT hub.id AS target, CASE WHEN source = hub.id THEN destination ELSE source END AS neighbor,
           CASE WHEN source = hub.id THEN 'OUTGOING_CITES' ELSE 'INCOMING_CITED_BY' END AS direction
    FROM e, hub WHERE source = hub.id OR destination = hub.id""")
def _neighbors(spark, sf):
    """Neighbours of the most referenced node."""
    edges = merge_edges(edges_of(spark, sf))
    hub = top_in_degree(in_degree(edges), 1).select("id").scalar()
    return neighbors(edges, hub)


_WALK = f"""
    WITH RECURSIVE e AS (SELECT DISTINCT * FROM ({_EDGES})),
    u AS (SELECT source AS a, destination AS b FROM e UNION SELECT destination, source FROM e),
    reach(id, hop) AS (
        SELECT CAST(1 AS BIGINT), 0
        UNION
        SELECT u.b, reach.hop + 1 FROM reach JOIN u ON u.a = reach.id WHERE reach.hop < {{hops}}),
    dist AS (SELECT id, min(hop) AS d FROM reach GROUP BY id)"""


@query("shortest_path", _WALK.format(hops=8) + """,
    walk(id, d, path) AS (
        SELECT id, d, [id] FROM dist WHERE id = 0
        UNION ALL
        SELECT nxt.id, nxt.d, list_append(walk.path, nxt.id) FROM walk JOIN LATERAL (
            SELECT min(u.b) AS id, walk.d - 1 AS d FROM u JOIN dist ON dist.id = u.b AND dist.d = walk.d - 1
            WHERE u.a = walk.id) nxt ON true
        WHERE walk.d > 0)
    SELECT CAST(0 AS BIGINT) AS start, CAST(1 AS BIGINT) AS finish, len(path) - 1 AS hop_count,
           array_to_string(path, '>') AS path
    FROM walk WHERE d = 0""")
def _shortest_path(spark, sf):
    """From order 0 to order 1 over the whole graph; the path is returned as text."""
    found = shortest_path(edges_of(spark, sf), 0, 1)
    return found.select(
        "start", "finish", F.col("hop_count").cast("bigint").alias("hop_count"),
        F.concat_ws(">", F.col("path").cast("array<string>")).alias("path"),
    )


@query("profile_steps", f"""
    WITH e AS ({_EDGES}), d AS (SELECT DISTINCT * FROM e), g AS (
        SELECT destination, count(*) AS n FROM d GROUP BY destination)
    SELECT 0 AS place, 'source' AS step, count(*) AS rows FROM e
    UNION ALL SELECT 1, 'merge edges', count(*) FROM d
    UNION ALL SELECT 2, 'in-degree', count(*) FROM g
    UNION ALL SELECT 3, 'above one', count(*) FROM g WHERE n > 1""")
def _profile_steps(spark, sf):
    """Rows that each step of a ranking passes on."""
    return profile_steps(edges_of(spark, sf), [
        ("merge edges", merge_edges), ("in-degree", in_degree), ("above one", lambda df: df.filter("in_degree > 1"))])


@query("frontier_join", _WALK.format(hops=5) + """
    SELECT dist.id, CAST(dist.d AS BIGINT) AS hop, min(u.b) AS parent
    FROM dist JOIN u ON u.a = dist.id JOIN dist before ON before.id = u.b AND before.d = dist.d - 1
    GROUP BY dist.id, dist.d""")
def _frontier_join(spark, sf):
    """Five hops from one node without revisits, by the join used for large frontiers; every node met, its hop and
    smallest parent."""
    levels = frontier_levels(Adjacency(edges_of(spark, sf)), 1, 5)
    met = levels[0].withColumn("hop", F.lit(1).cast("bigint"))
    for hop, level in enumerate(levels[1:], 2):
        met = met.unionByName(level.withColumn("hop", F.lit(hop).cast("bigint")))
    return met.select("id", "hop", "parent")


# --- work per worker: stage = return flag, worker = supplier ---------------------------

_SUMS = """count(*) AS tasks, CAST(sum(l_partkey) AS BIGINT) AS input_records,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS shuffle_read_bytes,
           CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS shuffle_write_bytes"""
_ALLOCATED = f"SELECT l_returnflag, l_suppkey, {_SUMS} FROM lineitem GROUP BY l_returnflag, l_suppkey"
_METRICS = ["tasks", "input_records", "shuffle_read_bytes", "shuffle_write_bytes"]
_LONG = f"""UNPIVOT ({_ALLOCATED}) ON {', '.join(_METRICS)} INTO NAME metric VALUE value"""


def _allocated(spark, sf):
    return allocation(table(spark, sf, "lineitem"), ["l_returnflag", "l_suppkey"], {
        "input_records": F.col("l_partkey"),
        "shuffle_read_bytes": F.col("l_quantity").cast("bigint"),
        "shuffle_write_bytes": F.floor("l_extendedprice"),
    })


@query("allocation_by_worker", _ALLOCATED)
def _allocation(spark, sf):
    return _allocated(spark, sf)


@query("stage_totals", f"""
    SELECT l_returnflag, {', '.join(f'CAST(sum({m}) AS BIGINT) AS {m}' for m in _METRICS)}
    FROM ({_ALLOCATED}) GROUP BY l_returnflag""")
def _stage_totals(spark, sf):
    return totals(_allocated(spark, sf), ["l_returnflag"], _METRICS)


@query("skew_compare", f"""
    WITH long AS ({_LONG}), ends AS (
        SELECT l_returnflag, metric, min(value) AS minimum, max(value) AS maximum, count(*) AS worker_count
        FROM long GROUP BY ALL)
    SELECT e.l_returnflag, e.metric, e.minimum, e.maximum,
           CASE WHEN e.minimum > 0 THEN round(e.maximum / e.minimum, 3) END AS max_to_min_ratio,
           count(*) FILTER (WHERE l.value = e.maximum) AS workers_at_maximum,
           count(*) FILTER (WHERE l.value = 0) AS workers_with_zero, e.worker_count
    FROM ends e JOIN long l USING (l_returnflag, metric)
    GROUP BY e.l_returnflag, e.metric, e.minimum, e.maximum, e.worker_count""")
def _skew_compare(spark, sf):
    return skew_compare(_allocated(spark, sf), ["l_returnflag"])


@query("skew_workers", f"""
    WITH long AS ({_LONG}), ends AS (
        SELECT l_returnflag, metric, max(value) AS maximum FROM long GROUP BY ALL)
    SELECT l_returnflag, metric, l_suppkey, value, value = maximum AS at_maximum, value = 0 AS at_zero
    FROM long JOIN ends USING (l_returnflag, metric) WHERE value = maximum OR value = 0""")
def _skew_workers(spark, sf):
    return skew_workers(_allocated(spark, sf), ["l_returnflag"], "l_suppkey")


@query("stage_worker_grid", f"""
    SELECT f.l_returnflag, s.s_suppkey AS worker, coalesce(a.tasks, 0) AS tasks,
           coalesce(a.input_records, 0) AS input_records
    FROM (SELECT DISTINCT l_returnflag FROM lineitem) f CROSS JOIN supplier s LEFT JOIN (
        SELECT l_returnflag, l_suppkey, {_SUMS} FROM lineitem WHERE l_tax >= 0.08 AND l_discount >= 0.10
        GROUP BY ALL) a ON a.l_returnflag = f.l_returnflag AND a.l_suppkey = s.s_suppkey""")
def _stage_worker_grid(spark, sf):
    """Only some lines count as work here, so that idle workers occur."""
    done = table(spark, sf, "lineitem").filter((F.col("l_tax") >= 0.08) & (F.col("l_discount") >= 0.10))
    roster = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("worker"))
    flags = [r[0] for r in table(spark, sf, "lineitem").select("l_returnflag").distinct().collect()]
    return worker_grid(
        done.withColumnRenamed("l_suppkey", "worker"), roster, "worker", "l_returnflag", sorted(flags),
        {"input_records": F.col("l_partkey")},
    )


@query("sorted_ids", f"SELECT row_number() OVER (ORDER BY in_degree DESC, id) AS place, id FROM ({_ZERO})")
def _sorted_ids(spark, sf):
    """The place of every node, those nobody refers to included."""
    degrees = in_degree(merge_edges(edges_of(spark, sf)), include_zero=True)
    return ranked_all(degrees, [F.desc("in_degree"), F.asc("id")], "place").select("place", "id")
