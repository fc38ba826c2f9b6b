"""Event-log analytics on a log Spark wrote, and imbalance figures on hand-made tables."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from millrace.operators.contracts import ContractError
from millrace.operators.workers import METRICS, skew_compare, skew_workers, worker_grid
from millrace.plans import joblog as jl
from millrace.sources import joblog as kinds
from millrace.sources.files import latest_file
from millrace.operators.contracts import reject_split
from millrace.sources.joblog import judge_event_lines, open_event_log, read_event_log, store_event_log

JOB = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").appName("sample").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.dir", sys.argv[1]).config("spark.sql.shuffle.partitions", "3").getOrCreate())
df = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count()
df.orderBy("k").collect()
df.join(df.withColumnRenamed("count", "n"), "k").count()
spark.stop()
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("log")
    (base / "job.py").write_text(JOB)
    (base / "events").mkdir()
    subprocess.run([sys.executable, str(base / "job.py"), str(base / "events")], check=True, timeout=180,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    return str(base / "events")


@pytest.fixture(scope="module")
def events(folder):
    found = []
    for root, _, names in os.walk(folder):
        for name in names:
            if name.startswith("events_"):
                with open(os.path.join(root, name)) as lines:
                    found += [json.loads(line) for line in lines]
    assert found
    return found


@pytest.fixture(scope="module")
def log(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("parsed") / "events")
    store_event_log(read_event_log(spark, folder), path)
    return open_event_log(spark, path)


def named(events, name):
    return [e for e in events if e["Event"].endswith(name)]


def test_latest_log(spark, folder):
    assert "events_1_" in latest_file(spark, folder).first()["path"]


def test_application_and_jobs(log, events):
    app = log_app = jl.log_application(log).first()
    assert app["name"] == "sample" and app["application_id"] == log_app["app_id"]
    assert app["ended_at_epoch_ms"] >= app["started_at_epoch_ms"]
    jobs = {r["job_id"]: (r["stage_ids"], r["sql_execution_id"]) for r in jl.log_jobs(log).collect()}
    expected = {
        e["Job ID"]: (e["Stage IDs"], int(e["Properties"]["spark.sql.execution.id"]))
        for e in named(events, "JobStart")}
    assert jobs == expected


def test_stages_and_rdds(log, events):
    stages = {r["stage_id"]: r for r in jl.log_stages(log).collect()}
    told = [s for e in named(events, "JobStart") for s in e["Stage Infos"]] + [
        e["Stage Info"] for e in named(events, "StageCompleted")]
    assert set(stages) == {s["Stage ID"] for s in told}
    edges = {(r["parent_stage_id"], r["child_stage_id"]) for r in jl.stage_dag(jl.log_stages(log)).collect()}
    assert edges == {(p, s["Stage ID"]) for s in told for p in s["Parent IDs"]}
    pairs = {(r["stage_id"], r["rdd_id"]) for r in jl.stage_rdds(log).collect()}
    assert pairs == {(s["Stage ID"], r["RDD ID"]) for s in told for r in s["RDD Info"]}
    rdds = {r["rdd_id"]: r for r in jl.log_rdds(log).collect()}
    last = {r["RDD ID"]: r for s in told for r in s["RDD Info"]}
    assert {k: v["name"] for k, v in rdds.items()} == {k: v["Name"] for k, v in last.items()}
    scopes = {k: json.loads(v["Scope"])["name"] for k, v in last.items() if "Scope" in v}
    assert {k: rdds[k]["scope_name"] for k in scopes} == scopes
    lineage = {(r["parent_rdd_id"], r["child_rdd_id"]) for r in jl.rdd_lineage(jl.log_rdds(log)).collect()}
    assert lineage == {(p, k) for k, v in last.items() for p in v["Parent IDs"]}


def test_tasks_and_stage_metrics(log, events):
    tasks = jl.log_tasks(log)
    ended = [e for e in named(events, "TaskEnd") if e["Task End Reason"]["Reason"] == "Success"]
    assert tasks.count() == len(ended)
    written = sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in ended)
    read = sum(e["Task Metrics"]["Shuffle Read Metrics"][k] for e in ended
               for k in ("Remote Bytes Read", "Local Bytes Read"))
    metrics = jl.log_stage_metrics(log, tasks)
    sums = metrics.agg(F.sum("shuffle_write_bytes"), F.sum("shuffle_read_bytes")).first()
    assert tuple(sums) == (written, read) and written > 0
    times = {e["Stage Info"]["Stage ID"]: e["Stage Info"]["Completion Time"] - e["Stage Info"]["Submission Time"]
             for e in named(events, "StageCompleted")}
    assert {r["stage_id"]: r["duration_ms"] for r in metrics.collect()} == times
    grid = jl.app_worker_grid(tasks, jl.workers(log)).collect()
    assert len(grid) == 1 and grid[0]["tasks"] == len(ended) and grid[0]["worker"].startswith("driver@")


def preorder(plan, nodes, edges, parent=None):
    me = len(nodes)
    nodes.append(plan["nodeName"])
    if parent is not None:
        edges.append((parent, me))
    for child in plan["children"]:
        preorder(child, nodes, edges, me)
    return nodes, edges


def test_plans(log, events):
    executions = {r["execution_id"]: r for r in jl.log_sql_executions(log).collect()}
    started = {e["executionId"]: e for e in named(events, "SQLExecutionStart")}
    assert set(executions) == set(started)
    assert all(executions[k]["initial_physical_plan"] == v["physicalPlanDescription"] for k, v in started.items())
    assert all(executions[k]["duration_ms"] >= 0 for k in started)
    operators = jl.plan_operators(jl.plan_trees(log))
    got = {}
    for r in operators.orderBy("node_id").collect():
        got.setdefault((r["execution_id"], r["sequence"]), []).append((r["node_name"], r["parent_node_id"]))
    seen = {}
    for e in events:
        if e["Event"].endswith(("SQLExecutionStart", "SQLAdaptiveExecutionUpdate")):
            first = e["Event"].endswith("SQLExecutionStart")
            number = 0 if first else seen.get(e["executionId"], 0) + 1
            seen[e["executionId"]] = number
            names, edges = preorder(e["sparkPlanInfo"], [], [])
            above = {child: parent for parent, child in edges}
            expected = [(n, above.get(i)) for i, n in enumerate(names)]
            assert got.pop((e["executionId"], number)) == expected
    assert not got
    jobs = jl.job_execution_join(jl.log_jobs(log), jl.log_sql_executions(log))
    assert jobs.count() == len(named(events, "JobStart"))


def test_deep_plan_needs_several_passes(spark):
    def chain(depth):
        return {"nodeName": f"n{depth}", "children": [chain(depth + 1)] if depth < 10 else []}

    tree = {"nodeName": "top", "children": [chain(1), {"nodeName": "side", "children": []}]}
    trees = spark.createDataFrame([("a", 1, 0, json.dumps(tree))], "app_id string, execution_id long, sequence long, t string")
    trees = trees.select("app_id", "execution_id", "sequence", F.parse_json("t").alias("plan"))
    got = [(r["node_name"], r["parent_node_id"]) for r in jl.plan_operators(trees).orderBy("node_id").collect()]
    names, edges = preorder(tree, [], [])
    above = {child: parent for parent, child in edges}
    assert got == [(n, above.get(i)) for i, n in enumerate(names)]


def test_report_and_gate(spark, log, tmp_path):
    jl.expect_complete_log(log)
    with pytest.raises(ContractError, match="incomplete"):
        jl.expect_complete_log(log.filter(~F.col("event").endswith("JobStart")))
    with pytest.raises(ContractError, match="no event log"):
        jl.expect_complete_log(log.filter("false"))
    path = str(tmp_path / "report")
    jl.write_report(log, path)
    row = spark.read.json(f"{path}/summary").first()
    assert row["stage_count"] == jl.log_stages(log).count()
    assert row["initial_sql_operator_count"] == jl.plan_operators(jl.plan_trees(log)).filter("sequence = 0").count()
    assert spark.read.parquet(f"{path}/stage_metrics").count() > 0


@pytest.mark.parametrize("work,expected,at_max,at_zero", [
    ({"w1": 4, "w2": 2}, (2, 4, 2.0, 1, 0, 2), {"w1"}, set()),
    ({"w1": 4, "w2": 0}, (0, 4, None, 1, 1, 2), {"w1"}, {"w2"}),
    ({"w1": 0, "w2": 0}, (0, 0, None, 2, 2, 2), {"w1", "w2"}, {"w1", "w2"}),
    ({"w1": 10, "w2": 3}, (3, 10, 3.333, 1, 0, 2), {"w1"}, set()),
])
def test_skew(spark, work, expected, at_max, at_zero):
    df = spark.createDataFrame([("s", w, n) for w, n in work.items()], "stage string, worker string, tasks long")
    row = skew_compare(df, ["stage"], ["tasks"]).first()
    assert tuple(row)[2:] == expected
    placed = skew_workers(df, ["stage"], "worker", ["tasks"]).collect()
    assert {r["worker"] for r in placed if r["at_maximum"]} == at_max
    assert {r["worker"] for r in placed if r["at_zero"]} == at_zero
    # The same figures when the idle workers are not listed but only counted.
    busy = df.filter("tasks > 0")
    missing = spark.createDataFrame([("s", df.count() - busy.count())], "stage string, missing long")
    assert tuple(skew_compare(busy, ["stage"], ["tasks"], missing).first())[2:] == expected


def test_skew_of_a_stage_without_workers(spark):
    nothing = spark.createDataFrame([], "stage string, tasks long")
    missing = spark.createDataFrame([("s", 0)], "stage string, missing long")
    assert tuple(skew_compare(nothing, ["stage"], ["tasks"], missing).first())[2:5] == (None, None, None)


def test_worker_grid(spark):
    tasks = spark.createDataFrame([("w1", "a", 3), ("w9", "b", 5)], "worker string, stage string, n long")
    roster = spark.createDataFrame([("w1",), ("w2",)], "worker string")
    grid = worker_grid(tasks, roster, "worker", "stage", ["a", "b"], {"n": F.col("n")})
    got = {(r["stage"], r["worker"]): (r["tasks"], r["n"]) for r in grid.collect()}
    assert got == {("a", "w1"): (1, 3), ("b", "w1"): (0, 0), ("a", "w2"): (0, 0), ("b", "w2"): (0, 0),
                   ("a", "w9"): (0, 0), ("b", "w9"): (1, 5)}
    assert len(METRICS) == 4


def test_lines_that_are_no_events(spark, tmp_path):
    (tmp_path / "app-9").write_text('{"Event":"SparkListenerApplicationStart","App ID":"app-9"}\n{"Event":"Spark\nword\n')
    path = str(tmp_path / "app-9")
    with pytest.raises(Exception, match="line is not JSON"):
        read_event_log(spark, path).collect()
    assert read_event_log(spark, path, mode="drop").count() == 1
    _, rejected = reject_split(judge_event_lines(spark, path))
    assert rejected.count() == 2 and rejected.select("block.file").first()[0].endswith("app-9")


def test_blank_ids_and_later_stages(spark, tmp_path):
    lines = [
        {"Event": "SparkListenerExecutorAdded", "Executor ID": "1", "Executor Info": {"Host": ""}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 0, "Task Info": {"Executor ID": "", "Host": ""}},
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [0, 1], "Stage Infos": [
            {"Stage ID": 0, "RDD Info": []}, {"Stage ID": 1, "RDD Info": [{"RDD ID": 4}]}]},
    ]
    (tmp_path / "app-8").write_text("".join(json.dumps(line) + "\n" for line in lines))
    log = read_event_log(spark, str(tmp_path / "app-8"))
    assert [tuple(r) for r in jl.workers(log).collect()] == [("app-8", "1@unknown")]
    assert jl.log_tasks(log).first()["worker"] == "unknown@unknown"
    assert jl.completeness(log).first()["stages_with_rdds"] == 1


def test_summary_straight_from_the_log_is_the_same(log):
    stages, rdds = jl.log_stages(log), jl.log_rdds(log)
    whole = jl.dag_summary(stages, rdds, jl.log_sql_executions(log), jl.plan_operators(jl.plan_trees(log)))
    assert jl.summary_of_log(log).collect() == whole.collect()


# --- operators of the log's own plans ---------------------------------------------------------

def test_operator_rows_are_what_the_queries_put_out(log):
    """The first query groups 1,000 rows of 4 partitions into 7 groups, which the sort's sampling reads once more."""
    metrics = jl.operator_metrics(log)
    first = metrics.agg(F.min("execution_id")).first()[0]
    rows_of = {}
    for r in jl.operator_profile(metrics.filter(F.col("execution_id") == first)).collect():
        rows_of.setdefault(r["node_name"].split(" ")[0], []).append(r["rows"])
    assert rows_of["Range"] == [1000]
    assert sorted(rows_of["HashAggregate"]) == [14, 28]
    times = jl.operator_profile(metrics).filter("node_name = 'Sort'").select("time_ms", "spill_bytes").collect()
    assert times and all(r["time_ms"] is not None and r["spill_bytes"] == 0 for r in times)


def test_metrics_nobody_reported_are_null(log):
    never = jl.operator_metrics(log).filter("updates IS NULL")
    assert never.filter("total IS NOT NULL").count() == 0


def test_preorder_needs_no_window_and_no_join(log):
    from millrace.plans.graphs import profile_plan

    plan = profile_plan(jl.plan_operators(jl.plan_trees(log).filter("sequence = 0")), "simple")
    assert "Window" not in plan and "Join" not in plan and "Exchange" not in plan


def test_stage_metrics_sort_no_event(log):
    from millrace.plans.graphs import profile_plan

    plan = profile_plan(jl.log_stage_metrics(log, jl.log_tasks(log)), "simple")
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert all("body" not in line for line in sorts)


PROFILED = """
import sys
sys.path.insert(0, sys.argv[2])
from pyspark.sql import SparkSession, functions as F
from millrace.plans.joblog import profile_run
spark = (SparkSession.builder.master("local[2]").appName("profiled").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.dir", sys.argv[1]).config("spark.sql.shuffle.partitions", "3").getOrCreate())
df = spark.range(0, 900, 1, 3).filter("id % 3 = 0").groupBy((F.col("id") % 10).alias("k")).count()
profile_run(df).coalesce(1).write.json(sys.argv[1] + "/profile")
spark.stop()
"""


def test_a_query_is_profiled_from_its_own_log(spark, tmp_path):
    (tmp_path / "job.py").write_text(PROFILED)
    (tmp_path / "events").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, str(tmp_path / "job.py"), str(tmp_path / "events"), root], check=True, timeout=240,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    got = {r["node_name"]: r["rows"] for r in spark.read.json(str(tmp_path / "events" / "profile")).collect() if r["rows"] is not None}
    assert got["Filter"] == 300 and got["Range"] == 900 and got["HashAggregate"] in (10, 30)
    with pytest.raises(ValueError, match="eventLog"):
        jl.profile_run(spark.range(3))


# --- compressed logs --------------------------------------------------------------------------

def test_compressed_logs_give_the_same_tables(spark, folder, tmp_path):
    import zstandard

    packed = tmp_path / "packed"
    for root, _, names in os.walk(folder):
        for name in names:
            if name.startswith("events_"):
                with open(os.path.join(root, name), "rb") as file:
                    data = file.read()
                target = packed / os.path.relpath(root, folder)
                target.mkdir(parents=True, exist_ok=True)
                half = data.rfind(b"\n", 0, len(data) // 2) + 1
                codec = zstandard.ZstdCompressor()  # two frames, as a log that was flushed
                (target / (name + ".zstd")).write_bytes(codec.compress(data[:half]) + codec.compress(data[half:]))
    plain, other = read_event_log(spark, folder), read_event_log(spark, str(packed))
    for table in (jl.log_application, jl.log_jobs, jl.log_stages, jl.log_rdds, jl.log_tasks, jl.log_sql_executions,
                  lambda log: jl.plan_operators(jl.plan_trees(log))):
        assert sorted(map(repr, table(plain).collect())) == sorted(map(repr, table(other).collect()))
    whole = next(p for p in packed.rglob("*.zstd"))
    whole.write_bytes(whole.read_bytes()[:-200])  # still being written
    with pytest.raises(Exception, match="not JSON"):
        read_event_log(spark, str(packed)).count()
    assert 0 < read_event_log(spark, str(packed), mode="drop").count() < other_count(plain)


def other_count(log):
    return log.count()


def test_a_log_with_default_settings_is_read(spark, tmp_path):
    (tmp_path / "job.py").write_text(JOB.replace('.config("spark.eventLog.compress", "false")', ""))
    (tmp_path / "events").mkdir()
    subprocess.run([sys.executable, str(tmp_path / "job.py"), str(tmp_path / "events")], check=True, timeout=180,
                   stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    assert [n for _, _, names in os.walk(tmp_path / "events") for n in names if n.endswith(".zstd")]
    log = read_event_log(spark, str(tmp_path / "events"))
    assert jl.completeness(log).first()["complete"]
    rows_of = {r["node_name"]: r["rows"] for r in jl.operator_profile(jl.operator_metrics(log)).collect()}
    assert 1000 in rows_of.values()


# --- disk ---------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders of two applications, an order key twice and one null; lines without host, supplier or order among them."""
    path = str(tmp_path_factory.mktemp("tables"))
    orders = [(k, k % 7, "FOP"[k % 3], 100.5 + k, f"{1 + k % 2}-URGENT") for k in range(60)] + [
        (3, 3, "F", 7.0, "1-URGENT"), (None, 2, "F", 8.0, "2-HIGH")]
    lines = [(k, k * 3 + n, (k + n) % 5, n, float(n), 10.7 * k, "RAN"[n % 3], "FO"[k % 2])
             for k in range(62) for n in range(1, 8)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
                          ).withColumn("o_orderdate", F.timestamp_millis(F.lit(86_400_000))).write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_returnflag string, l_linestatus string").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(k, k) for k in range(4)], "s_suppkey long, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    return path


def files_below(path):
    path = path.removeprefix("file:")
    return [os.path.join(root, name) for root, _, names in os.walk(path) for name in names if name.startswith("part-")]


def test_text_of_the_derived_log_is_packed_and_in_log_order(spark, tables):
    from millrace.catalog import joblogs

    path = joblogs.raw_log(spark, tables)
    assert files_below(path) and all(name.endswith(".gz") for name in files_below(path))
    log = read_event_log(spark, path)
    counts = {r["event"]: r["count"] for r in log.groupBy("event").count().collect()}
    assert [counts[kind] for kind in (kinds.JOB_START, kinds.STAGE_COMPLETED, kinds.TASK_END, kinds.EXECUTOR_ADDED)] == [62, 62, 61 * 7, 20]
    names = {r["stage_id"]: r["name"] for r in jl.log_stages(log).collect() if r["stage_id"] is not None}
    assert names == {n: "scan" if n % 2 == 0 else "result done" for n in range(120)}
    updates = jl.log_plan_updates(log).filter("physical_plan IS NOT NULL").collect()
    for key in {(r["app_id"], r["execution_id"]) for r in updates}:
        told = sorted((r["sequence"], int(r["physical_plan"].split()[1])) for r in updates if (r["app_id"], r["execution_id"]) == key)
        assert [k for _, k in told] == sorted(k for _, k in told)


def test_parsed_text_is_deleted(spark, tables, monkeypatch):
    from millrace.catalog import joblogs
    from millrace.session import scratch

    made = []
    monkeypatch.setattr(joblogs, "scratch", lambda *a: made.append(scratch(*a)) or made[-1])
    log = joblogs.event_log(spark, tables)
    assert not files_below(next(path for path in made if "event-log" in path))
    plain = read_event_log(spark, joblogs.raw_log(spark, tables))
    for table in (jl.log_application, jl.log_jobs, jl.log_rdds, jl.log_tasks, jl.log_plan_updates, jl.summary_of_log):
        said = [df.drop("block", "line", "plan") for df in (table(log), table(plain))]
        assert sorted(map(repr, said[0].collect())) == sorted(map(repr, said[1].collect()))


def test_a_line_is_parsed_once_and_no_body_is_shuffled(spark, folder, tmp_path):
    from millrace.plans.graphs import profile_plan

    plan = profile_plan(read_event_log(spark, folder), "simple")
    assert plan.count("parseJson") == 1
    store_event_log(read_event_log(spark, folder), str(tmp_path / "events"))
    before = open_event_log(spark, str(tmp_path / "events")).count()
    store_event_log(read_event_log(spark, folder), str(tmp_path / "events"), mode="append")
    assert open_event_log(spark, str(tmp_path / "events")).count() == 2 * before
    assert all(".zstd." in name for name in files_below(str(tmp_path / "events")))


def test_tasks_with_a_host_are_not_joined(spark, tables):
    from millrace.catalog import joblogs

    log = joblogs.event_log(spark, tables)
    hosts = {r["worker"] for r in jl.log_tasks(log).collect()}
    # Line 7 has no host: that of its executor counts, or unknown for supplier 0, the driver, and 4, which is not there.
    assert {"1@node-1", "1@rack-1", "4@node-4", "4@unknown", "0@unknown"} <= hosts
    path = log.filter("false")
    assert jl.log_tasks(path).count() == 0


def test_stage_skew_shuffles_a_row_a_worker(spark, tables):
    from millrace.catalog import joblogs
    from millrace.plans.graphs import profile_plan

    log = joblogs.event_log(spark, tables)
    skew = jl.stage_skew(log, jl.log_tasks(log))
    assert not [line for line in profile_plan(skew, "simple").splitlines() if "Exchange" in line and "metric" in line]
    df = spark.createDataFrame([(s, w, s * w) for s in range(5) for w in range(3)], "stage long, worker long, tasks long")
    missing = spark.createDataFrame([(s, s % 2) for s in range(6)], "stage long, missing long")
    got, apart = (sorted(map(tuple, skew_compare(df, ["stage"], ["tasks"], missing, together=t).collect()), key=repr) for t in (True, False))
    assert got == apart and len(got) == 6


def test_report_leaves_no_scratch_tables(spark, log, tmp_path, monkeypatch):
    from millrace import session

    made = []
    monkeypatch.setattr(session, "scratch", lambda spark, label, own=session.scratch: made.append(own(spark, label)) or made[-1])
    jl.write_report(log, str(tmp_path / "report"))
    assert made and not [name for path in made for name in files_below(path)]
    assert all(name.endswith(".json.gz") for name in files_below(str(tmp_path / "report")) if ".json" in name)
