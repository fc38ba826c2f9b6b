"""Graph operators on small graphs, against brute force, and with one node holding most edges."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph
from millrace.operators.graph import (
    INCOMING, OUTGOING, Adjacency, graph_build, in_degree, neighbors, shortest_path, top_in_degree, undirected,
)
from millrace.session import settings
from millrace.plans.graphs import import_graph, profile_plan, rank_edge_file, rank_in_degree

CITATIONS = [(3858825, 3484134), (3858825, 3635420), (3858826, 3635420), (3858826, 3741496), (3858824, 3741496),
             (3858824, 253889), (3858824, 253889)]


def edges_of(spark, pairs):
    return spark.createDataFrame(list(pairs), "source bigint, destination bigint")


def rows(df):
    return [tuple(r) for r in df.collect()]


def smallest_path(pairs, start, finish, max_hops=15):
    """Breadth-first search in plain Python."""
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    if start == finish or start not in near or finish not in near:
        return None
    far, todo = {finish: 0}, deque([finish])
    while todo:
        at = todo.popleft()
        for to in near[at]:
            if to not in far:
                far[to] = far[at] + 1
                todo.append(to)
    if far.get(start, max_hops + 1) > max_hops:
        return None
    path = [start]
    while path[-1] != finish:
        path.append(min(n for n in near[path[-1]] if far[n] == far[path[-1]] - 1))
    return path


def test_build(spark):
    nodes, edges = graph_build(edges_of(spark, CITATIONS + [(None, 1), (2, None)]))
    assert (nodes.count(), edges.count()) == (7, 6)


def test_in_degree(spark):
    nodes, edges = graph_build(edges_of(spark, CITATIONS))
    ranked = [(3635420, 2), (3741496, 2), (253889, 1), (3484134, 1), (3858824, 0), (3858825, 0), (3858826, 0)]
    assert rows(top_in_degree(in_degree(edges, include_zero=True), 10)) == ranked
    assert rows(top_in_degree(in_degree(edges, nodes, include_zero=True), 10)) == ranked
    assert rows(top_in_degree(in_degree(edges), 10)) == ranked[:4]
    few = nodes.filter("id < 3700000")
    assert {r[0] for r in rows(in_degree(edges, few, include_zero=True))} == {r[0] for r in rows(few)}
    assert in_degree(edges).agg(F.sum("in_degree")).first()[0] == edges.count()


def test_neighbors(spark):
    _, edges = graph_build(edges_of(spark, CITATIONS))
    assert rows(neighbors(edges, 3858826)) == [(3858826, 3635420, OUTGOING), (3858826, 3741496, OUTGOING)]
    loops = edges_of(spark, [(1, 2), (2, 1), (1, 1), (3, 1)])
    assert rows(neighbors(loops, 1)) == [(1, 1, OUTGOING), (1, 2, INCOMING), (1, 2, OUTGOING), (1, 3, INCOMING)]


def test_shortest_path_of_the_citations(spark):
    found = shortest_path(edges_of(spark, CITATIONS), 3484134, 253889).first()
    assert found["hop_count"] == 6
    assert found["path"] == [3484134, 3858825, 3635420, 3858826, 3741496, 3858824, 253889]


@pytest.mark.parametrize("pairs,start,finish,expected", [
    ([(1, 2), (2, 4), (1, 3), (3, 4)], 1, 4, [1, 2, 4]),
    ([(n, n + 1) for n in range(16)], 0, 15, list(range(16))),
    ([(n, n + 1) for n in range(16)], 0, 16, None),
    ([(1, 2)], 1, 9, None),
    ([(1, 2)], 1, 1, None),
    ([(1, 2), (3, 4)], 1, 4, None),
    ([(5, 4)], 4, 5, [4, 5]),
])
def test_shortest_path_cases(spark, pairs, start, finish, expected):
    got = [r["path"] for r in shortest_path(edges_of(spark, pairs), start, finish).collect()]
    assert got == ([expected] if expected else [])


@pytest.mark.parametrize("small", [True, False])
def test_shortest_path_with_a_hub_equals_brute_force(spark, monkeypatch, small):
    """A third of the edges touch one node; both ways of joining the frontier are exercised."""
    if not small:
        monkeypatch.setattr(graph, "FRONTIER_BROADCAST_ROWS", 0)
    chance = random.Random(7)
    pairs = [(0, n) for n in range(1, 200)] + [
        (chance.randrange(1, 400), chance.randrange(1, 400)) for _ in range(330)]
    pairs += [(1000 + n, 1001 + n) for n in range(4)] + [(1004, 17)]
    expected = smallest_path(pairs, 1000, 399)
    got = shortest_path(edges_of(spark, pairs), 1000, 399).collect()
    assert [r["path"] for r in got] == ([expected] if expected else [])


def scanned_rows(df):
    """Rows that the file scans of an executed query put out."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def visit(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if node.getClass().getSimpleName() in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec"):
            return visit(node.plan())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(plan)
    return sum(found)


def test_hub_edges_are_spread_and_a_step_reads_little(spark):
    """A hub's edges lie in many files; a step from another node reads a few pages of one or two of them."""
    hub = spark.range(300_000).select(F.lit(0).cast("bigint").alias("source"), (F.col("id") + 1).alias("destination"))
    more = spark.range(300_000).select((F.col("id") * 7 % 300_000 + 1).alias("source"), (F.col("id") + 400_000).alias("destination"))
    laid_out = Adjacency(hub.unionByName(more))
    sizes = laid_out.edges.filter("source = 0").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 2 and max(r["count"] for r in sizes) < 1_200_000 / 4
    step = laid_out.step(graph._first_level(spark, 123_456))
    assert {r["id"] for r in step.collect()} == {0, 400_000 + next(i for i in range(300_000) if i * 7 % 300_000 + 1 == 123_456)}
    assert scanned_rows(step) < 20_000
    few = graph.Level(spark.range(1).select("id", F.lit(None).cast("bigint").alias("parent")), 3, (5, 77_000, 299_000))
    with graph._pushdown(spark):
        assert scanned_rows(laid_out.step(few)) < 60_000


@pytest.mark.parametrize("lookup, broadcast", [(500, 200_000), (0, 200_000), (0, 0), (3, 10)])
def test_both_ends_meet_on_the_smallest_path(spark, monkeypatch, lookup, broadcast):
    """Ladders have very many shortest paths; every way of stepping finds the smallest one."""
    monkeypatch.setattr(graph, "LOOKUP_NODES", lookup)
    monkeypatch.setattr(graph, "FRONTIER_BROADCAST_ROWS", broadcast)
    chance = random.Random(lookup + broadcast)
    names = chance.sample(range(1000), 26)
    layers = [names[:1]] + [names[1 + 4 * k:5 + 4 * k] for k in range(6)] + [names[25:]]
    pairs = [(a, b) if chance.random() < 0.5 else (b, a) for one, two in zip(layers, layers[1:]) for a in one for b in two
             if chance.random() < 0.8 or a == one[0] and b == two[0]]
    start, finish = names[0], names[25]
    expected = smallest_path(pairs, start, finish)
    assert [r["path"] for r in shortest_path(edges_of(spark, pairs), start, finish).collect()] == [expected]
    hops = len(expected) - 1
    assert shortest_path(edges_of(spark, pairs), start, finish, max_hops=hops - 1).collect() == []
    assert len(shortest_path(edges_of(spark, pairs), start, finish, max_hops=hops).collect()) == 1


def test_undirected(spark):
    assert sorted(rows(undirected(edges_of(spark, [(1, 2)])))) == [(1, 2), (2, 1)]


def test_rank_edge_file(spark, tmp_path):
    source, target = tmp_path / "edges.txt", str(tmp_path / "rank")
    source.write_text("# c\n1\t3\n2 3\n4 5\nbad\n")
    assert rank_edge_file(spark, str(source), target, k=2, expected=3) == 3
    files = [f for f in (tmp_path / "rank").iterdir() if f.suffix == ".csv"]
    assert [f.read_text() for f in files] == ["rank,destination,in_degree\n1,3,2\n2,5,1\n"]
    with pytest.raises(RuntimeError, match="found 3 edges; expected 4"):
        rank_edge_file(spark, str(source), str(tmp_path / "again"), expected=4)


def test_import_graph(spark, tmp_path):
    source, target = tmp_path / "edges.csv", str(tmp_path / "graph")
    source.write_text("source,target\n10,11\n10,11\n11,12\na,1\n,4\n")
    with pytest.raises(Exception, match="malformed edge at"):
        import_graph(spark, str(source), str(tmp_path / "strict"))
    kept = str(tmp_path / "kept")
    import_graph(spark, str(source), target, expected=2, quarantine=kept)
    assert spark.read.json(kept).count() == 2
    assert sorted(rows(spark.read.parquet(f"{target}/edges"))) == [(10, 11), (11, 12)]
    assert sorted(rows(spark.read.parquet(f"{target}/nodes"))) == [(10,), (11,), (12,)]
    with pytest.raises(RuntimeError, match="expected 5 edges|expected 5"):
        import_graph(spark, str(source), str(tmp_path / "again"), expected=5, mode="drop")


def test_edges_without_an_end_are_not_stored_silently(spark, tmp_path):
    from millrace.sinks.tables import write_graph

    with pytest.raises(Exception, match="an edge has no destination"):
        write_graph(edges_of(spark, [(1, 2), (3, None)]), str(tmp_path / "graph"))


def test_rank_uses_a_top_k_plan(spark):
    plan = profile_plan(rank_in_degree(edges_of(spark, CITATIONS), 3), "simple")
    assert "TakeOrderedAndProject" in plan
