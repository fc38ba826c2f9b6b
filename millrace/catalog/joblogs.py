"""Job-log queries over an event log derived from the tables, so it grows with them.

Application = order priority, SQL execution = customer, job = order with two stages,
task = order line, executor = supplier. ``tests/test_joblog.py`` reads logs Spark wrote.

Events are JSON of some 600 bytes made from rows of some 40, so rows are joined and sorted before they become JSON, and
the text is written gzipped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.workers import METRICS
from ..plans import joblog as jl
from ..session import remove, scratch, sparing_disk
from ..sources import joblog as kinds
from ..sources.files import latest_file
from ..sources.joblog import open_event_log, read_event_log, store_event_log
from .registry import query, table

_APP = "'app-' || substr(o_orderpriority, 1, 1)"
_DONE = """
    SELECT 'app-' || substr(o_orderpriority, 1, 1) AS app_id,
           2 * l_orderkey + CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END AS stage_id, CAST(0 AS BIGINT) AS attempt_id,
           l_suppkey || '@' || CASE WHEN l_linenumber < 7 THEN 'node-' || l_suppkey
                                    WHEN l_suppkey = 0 THEN 'unknown' ELSE 'rack-' || s_nationkey END AS worker,
           l_partkey AS input_records,
           CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(l_quantity AS BIGINT) + l_linenumber END AS shuffle_read_bytes,
           CAST(floor(l_extendedprice) AS BIGINT) AS shuffle_write_bytes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'F')"""
_SUMS = """count(*) AS tasks, CAST(sum(input_records) AS BIGINT) AS input_records,
           CAST(sum(shuffle_read_bytes) AS BIGINT) AS shuffle_read_bytes,
           CAST(sum(shuffle_write_bytes) AS BIGINT) AS shuffle_write_bytes"""
_APPS = f"(SELECT DISTINCT {_APP} AS app_id FROM orders)"
_ROSTER = f"""SELECT app_id, s_suppkey || '@rack-' || s_nationkey AS worker
    FROM supplier, {_APPS} WHERE s_suppkey <> 0"""


# --- the derived log -------------------------------------------------------------------

def _object(**fields: Column) -> Column:
    """A struct with the given JSON names (``__`` stands for a space)."""
    return F.struct(*[value.alias(name.replace("__", " ")) for name, value in fields.items()])


def _ids(*ids: Column) -> Column:
    return F.array(*ids).cast("array<bigint>")


def _rdd(number: Column, name: str, parents: Column, scope: str) -> Column:
    return _object(
        RDD__ID=number, Name=F.lit(name), Scope=F.lit(scope), Callsite=F.lit("main"), Parent__IDs=parents,
        Storage__Level=_object(Replication=F.lit(1)), Barrier=F.lit(False),
        DeterministicLevel=F.lit("DETERMINATE"), Number__of__Partitions=F.lit(4),
    )


def _stage(number: Column, name: str, parents: Column, rdds: Column, **more: Column) -> Column:
    return _object(
        Stage__ID=number, Stage__Attempt__ID=F.lit(0), Stage__Name=F.lit(name), Number__of__Tasks=F.lit(7),
        Parent__IDs=parents, Details=F.lit("at main"), RDD__Info=rdds, **more,
    )


def _plan(name: str, *children: Column, **more: Column) -> Column:
    below = F.array(*children) if children else F.array().cast("array<string>")
    return _object(nodeName=F.lit(name), metadata=F.create_map().cast("map<string,string>"),
                   metrics=F.array().cast("array<string>"), children=below, **more)


def _metric(name: str, accumulator: Column, kind: str) -> Column:
    return _object(name=F.lit(name), accumulatorId=accumulator, metricType=F.lit(kind))


def _added(accumulator: Column, update: Column) -> Column:
    return _object(ID=accumulator, Name=F.lit("a metric"), Update=update.cast("string"), Metadata=F.lit("sql"))


def _task_rows(spark, sf) -> DataFrame:
    """What the event of a task is made of: order lines with their order's application and customer."""
    failed = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("quantity"),
        F.floor("l_extendedprice").alias("price"),
        F.when(failed, "ExceptionFailure").when(F.col("l_returnflag") != "A", "Success").alias("reason"))
    orders = _orders(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "app_id", "o_custkey")
    return lines.join(orders, "l_orderkey")


def _orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").withColumn("app_id", F.concat(F.lit("app-"), F.substring("o_orderpriority", 1, 1)))


_TASK_KEY = "l_orderkey"


def _tasks_first(events: list) -> list[tuple[int, tuple[DataFrame, str, Column]]]:
    """Numbered events; tasks, whose join takes the most disk, come while nothing else takes up any."""
    return sorted(enumerate(events), key=lambda item: item[1][1] != _TASK_KEY)


def _events(spark, sf, tasks: DataFrame) -> list[tuple[DataFrame, str, Column]]:
    """``(rows with app_id, key, JSON)`` of every kind of event, in log order; within a kind the log is sorted by key."""
    orders = _orders(spark, sf)
    suppliers = table(spark, sf, "supplier")
    placed = F.unix_millis(F.col("o_orderdate").cast("timestamp"))

    def event(df: DataFrame, key: str, name: str, **fields: Column) -> tuple[DataFrame, str, Column]:
        return df, key, F.to_json(_object(Event=F.lit(name), **fields))

    apps = orders.groupBy("app_id").agg(
        F.min("o_orderpriority").alias("name"), F.min(placed).alias("first"), F.max(placed).alias("last"))
    executors = suppliers.withColumn(
        "app_id", F.explode(F.array(*[F.lit(f"app-{n}") for n in range(1, 6)])))
    executions = orders.select("app_id", "o_custkey").distinct()
    customer, order = F.col("o_custkey"), F.col("o_orderkey")
    first, second = order * 2, order * 2 + 1
    scan, shuffled, mapped = order * 3, order * 3 + 1, order * 3 + 2
    scope = '{"id":"1","name":"Exchange"}'
    execution = F.when(F.col("o_orderstatus") != "P", customer.cast("string"))
    done = F.when(F.col("o_orderstatus") != "O", placed + F.floor("o_totalprice"))
    tree = _object(
        nodeName=F.lit("Aggregate"), simpleString=F.concat(F.lit("Aggregate "), customer),
        metadata=F.create_map().cast("map<string,string>"), metrics=F.array(
            _metric("number of output rows", customer * 10, "sum"), _metric("spill size", customer * 10 + 1, "size"),
            _metric("aggregate time", customer * 10 + 2, "nsTiming"), _metric("peak memory", customer * 10 + 3, "size")),
        children=F.array(
            F.to_variant_object(_plan("Exchange", _plan("Scan orders"))),
            F.to_variant_object(_plan("Scan customer")),
        ),
    )
    metrics = _object(
        Input__Metrics=_object(Records__Read=F.col("l_partkey")),
        Shuffle__Read__Metrics=F.when(F.col("l_linenumber") > 1, _object(
            Remote__Bytes__Read=F.col("quantity"), Local__Bytes__Read=F.col("l_linenumber"))),
        Shuffle__Write__Metrics=_object(Shuffle__Bytes__Written=F.col("price")),
    )
    reason = F.when(F.col("reason").isNotNull(), _object(Reason=F.col("reason")))
    return [
        event(apps, "first", kinds.APP_START,
              App__Name=F.col("name"), App__ID=F.col("app_id"), Timestamp=F.col("first")),
        event(executors, "s_suppkey", kinds.EXECUTOR_ADDED,
              Executor__ID=F.when(F.col("s_suppkey") == 0, "driver").otherwise(F.col("s_suppkey").cast("string")),
              Executor__Info=_object(Host=F.concat(F.lit("rack-"), F.col("s_nationkey")))),
        event(executions, "o_custkey", kinds.SQL_START,
              executionId=customer, description=F.concat(F.lit("customer "), customer), details=F.lit("at main"),
              time=customer * 1000, physicalPlanDescription=F.concat(F.lit("== plan "), customer),
              sparkPlanInfo=tree),
        event(orders, "o_orderkey", kinds.JOB_START, Job__ID=order, Stage__IDs=_ids(first, second), Stage__Infos=F.array(
            _stage(first, "scan", _ids(), F.array(_rdd(scan, "scan", _ids(), "raw"))),
            _stage(second, "result", _ids(first), F.array(_rdd(shuffled, "shuffled", _ids(scan), scope)))),
              Properties=F.struct(execution.alias("spark.sql.execution.id"))),
        event(orders.filter(F.col("o_orderstatus") == "F"), "o_orderkey", kinds.SQL_UPDATE,
              executionId=customer, physicalPlanDescription=F.concat(F.lit("update "), order),
              sparkPlanInfo=_plan("AdaptiveSparkPlan", _plan("Scan orders"))),
        event(tasks, _TASK_KEY, kinds.TASK_END,
              Stage__ID=F.col("l_orderkey") * 2 + (F.col("l_linenumber") > 3).cast("int"),
              Stage__Attempt__ID=F.lit(0), Task__End__Reason=reason,
              Task__Info=_object(
                  Executor__ID=F.col("l_suppkey").cast("string"),
                  Host=F.when(F.col("l_linenumber") < 7, F.concat(F.lit("node-"), F.col("l_suppkey"))),
                  Accumulables=F.array(
                      _added(customer * 10, F.col("l_linenumber")), _added(customer * 10 + 1, F.col("price")),
                      _added(customer * 10 + 2, F.col("quantity") * 1_000_000))),
              Task__Metrics=metrics),
        event(orders, "o_orderkey", kinds.STAGE_COMPLETED, Stage__Info=_stage(
            second, "result done", _ids(first), F.array(
                _rdd(shuffled, "shuffled", _ids(scan), scope), _rdd(mapped, "mapped", _ids(shuffled), "raw")),
            Submission__Time=placed, Completion__Time=done)),
        event(executions.filter(customer % 2 == 0), "o_custkey", kinds.DRIVER_UPDATES, executionId=customer,
              accumUpdates=F.array(F.array(customer * 10, F.lit(1000).cast("bigint")))),
        event(executions, "o_custkey", kinds.SQL_END, executionId=customer, time=customer * 1000 + 500),
        event(apps, "last", kinds.APP_END, Timestamp=F.col("last")),
    ]


def _write_text(spark, event: tuple[DataFrame, str, Column], path: str) -> None:
    """One kind of event as gzipped text below ``path``, a folder for each application.

    Files are named in order of application and key; those of tasks, which end in any order, are sorted each by itself.
    """
    rows, key, line = event
    order = rows.sortWithinPartitions if key == _TASK_KEY else rows.orderBy
    with sparing_disk(spark):
        order("app_id", key).select("app_id", line.alias("value")).write.partitionBy("app_id").text(path, compression="gzip")


_WRITTEN: dict[tuple[str, str, str], str] = {}


def raw_log(spark, sf) -> str:
    """Folder of the derived text logs, written once per session and data folder; paths sort in log order."""
    key = (spark.sparkContext.applicationId, sf, "raw")
    if key not in _WRITTEN:
        path = scratch(spark, "event-log")
        for rank, event in _tasks_first(_events(spark, sf, _task_rows(spark, sf))):
            _write_text(spark, event, f"{path}/rank={rank}")
        _WRITTEN[key] = path
    return _WRITTEN[key]


def event_log(spark, sf) -> DataFrame:
    """The derived log as a parsed table, kept by event kind.

    Text is parsed as it comes, one kind after the other, and deleted once it is.
    """
    key = (spark.sparkContext.applicationId, sf, "parsed")
    if key not in _WRITTEN:
        raw, path = scratch(spark, "event-log"), scratch(spark, "events")
        for rank, event in _tasks_first(_events(spark, sf, _task_rows(spark, sf))):
            text = f"{raw}/rank={rank}"
            _write_text(spark, event, text)
            store_event_log(read_event_log(spark, text), path, mode="append")
            remove(spark, text)
        _WRITTEN[key] = path
    return open_event_log(spark, _WRITTEN[key])


def _text(ids: str) -> Column:
    return F.concat_ws(",", F.col(ids).cast("array<string>")).alias(ids)


# --- queries ---------------------------------------------------------------------------

@query("read_event_log", f"""
    SELECT app_id, event, count(*) AS events FROM (
        SELECT {_APP} AS app_id, unnest(['SparkListenerJobStart', 'SparkListenerStageCompleted']) AS event FROM orders
        UNION ALL SELECT {_APP}, 'SparkListenerTaskEnd' FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL SELECT app_id, 'SparkListenerExecutorAdded' FROM supplier, {_APPS}
        UNION ALL SELECT app_id, unnest(['SparkListenerApplicationStart', 'SparkListenerApplicationEnd']) FROM {_APPS}
        UNION ALL SELECT {_APP}, '{kinds.SQL_UPDATE}' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT app_id, unnest(['{kinds.SQL_START}', '{kinds.SQL_END}']) FROM (
            SELECT DISTINCT {_APP} AS app_id, o_custkey FROM orders)
        UNION ALL SELECT DISTINCT ON ({_APP}, o_custkey) {_APP}, '{kinds.DRIVER_UPDATES}' FROM orders
            WHERE o_custkey % 2 = 0)
    GROUP BY app_id, event""")
def _read_event_log(spark, sf):
    log = read_event_log(spark, raw_log(spark, sf))
    return log.groupBy("app_id", "event").agg(F.count(F.lit(1)).alias("events"))


@query("latest_log", f"SELECT 'app-5' AS app_id, count(*) AS jobs FROM orders WHERE {_APP} = 'app-5'")
def _latest_log(spark, sf):
    """Logs are written one application after the other; the newest is read."""
    path, kept = scratch(spark, "logs"), scratch(spark, "task-rows")
    with sparing_disk(spark):  # joined once, not for each application
        rows = _task_rows(spark, sf)
        rows.write.partitionBy("app_id").parquet(kept)
    tasks = spark.read.schema(rows.schema).parquet(kept)
    for number in range(1, 6):
        mine = F.col("app_id") == f"app-{number}"
        texts = [rows.filter(mine).select(line.alias("value")) for rows, _, line in _events(spark, sf, tasks)]
        with sparing_disk(spark):
            reduce(DataFrame.unionByName, texts).write.text(f"{path}/app_id=app-{number}", compression="gzip")
    newest = latest_file(spark, path).first()["path"]
    log = read_event_log(spark, newest.rsplit("/", 1)[0])
    return jl.log_jobs(log).groupBy("app_id").agg(F.count(F.lit(1)).alias("jobs"))


@query("log_application", f"""
    SELECT {_APP} AS app_id, min(o_orderpriority) AS name, {_APP} AS application_id,
           epoch_ms(min(o_orderdate)) AS started_at_epoch_ms, epoch_ms(max(o_orderdate)) AS ended_at_epoch_ms
    FROM orders GROUP BY {_APP}""")
def _log_application(spark, sf):
    return jl.log_application(event_log(spark, sf))


@query("log_jobs", f"""
    SELECT {_APP} AS app_id, o_orderkey AS job_id, (2 * o_orderkey) || ',' || (2 * o_orderkey + 1) AS stage_ids,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS sql_execution_id
    FROM orders""")
def _log_jobs(spark, sf):
    return jl.log_jobs(event_log(spark, sf)).select("app_id", "job_id", _text("stage_ids"), "sql_execution_id")


@query("log_stages", f"""
    SELECT {_APP} AS app_id, 2 * o_orderkey + s AS stage_id, CAST(0 AS BIGINT) AS attempt_id,
           CASE s WHEN 0 THEN 'scan' ELSE 'result done' END AS name, 'at main' AS details,
           CAST(7 AS BIGINT) AS number_of_tasks,
           CASE s WHEN 0 THEN '' ELSE CAST(2 * o_orderkey AS VARCHAR) END AS parent_stage_ids
    FROM orders, range(2) AS two(s)""")
def _log_stages(spark, sf):
    stages = jl.log_stages(event_log(spark, sf))
    return stages.withColumn("parent_stage_ids", _text("parent_stage_ids"))


@query("merge_stage_rdds", f"""
    SELECT {_APP} AS app_id, 2 * o_orderkey + CASE WHEN r = 0 THEN 0 ELSE 1 END AS stage_id,
           3 * o_orderkey + r AS rdd_id
    FROM orders, range(3) AS three(r)""")
def _merge_stage_rdds(spark, sf):
    return jl.stage_rdds(event_log(spark, sf))


@query("log_rdds", f"""
    SELECT {_APP} AS app_id, 3 * o_orderkey + r AS rdd_id,
           CASE r WHEN 0 THEN 'scan' WHEN 1 THEN 'shuffled' ELSE 'mapped' END AS name,
           CASE r WHEN 0 THEN '' ELSE CAST(3 * o_orderkey + r - 1 AS VARCHAR) END AS parent_rdd_ids,
           CAST(4 AS BIGINT) AS number_of_partitions, CAST(0 AS BIGINT) AS number_of_cached_partitions,
           '{{"Replication":1}}' AS storage_level, CAST(0 AS BIGINT) AS memory_size_bytes,
           CAST(0 AS BIGINT) AS disk_size_bytes,
           CASE r WHEN 1 THEN '{{"id":"1","name":"Exchange"}}' ELSE 'raw' END AS scope,
           CASE r WHEN 1 THEN 'Exchange' END AS scope_name, 'main' AS callsite, false AS barrier,
           'DETERMINATE' AS deterministic_level
    FROM orders, range(3) AS three(r)""")
def _log_rdds(spark, sf):
    return jl.log_rdds(event_log(spark, sf)).withColumn("parent_rdd_ids", _text("parent_rdd_ids"))


@query("log_executors", f"""
    SELECT app_id, CAST(s_suppkey AS VARCHAR) AS executor_id, 'rack-' || s_nationkey AS host
    FROM supplier, {_APPS} WHERE s_suppkey <> 0""")
def _log_executors(spark, sf):
    return jl.log_executors(event_log(spark, sf))


@query("log_tasks", _DONE)
def _log_tasks(spark, sf):
    return jl.log_tasks(event_log(spark, sf))


@query("success_tasks", f"SELECT app_id, count(*) AS tasks FROM ({_DONE}) GROUP BY app_id")
def _success_tasks(spark, sf):
    return jl.log_tasks(event_log(spark, sf)).groupBy("app_id").agg(F.count(F.lit(1)).alias("tasks"))


@query("log_stage_metrics", f"""
    SELECT {_APP} AS app_id, 2 * o_orderkey + 1 AS stage_id, CAST(0 AS BIGINT) AS attempt_id, 'result done' AS name,
           CASE WHEN o_orderstatus <> 'O' THEN CAST(floor(o_totalprice) AS BIGINT) END AS duration_ms,
           coalesce(shuffle_read_bytes, 0) AS shuffle_read_bytes,
           coalesce(shuffle_write_bytes, 0) AS shuffle_write_bytes
    FROM orders LEFT JOIN (SELECT stage_id, {_SUMS} FROM ({_DONE}) GROUP BY stage_id) d
    ON d.stage_id = 2 * o_orderkey + 1""")
def _log_stage_metrics(spark, sf):
    log = event_log(spark, sf)
    return jl.log_stage_metrics(log, jl.log_tasks(log))


@query("stage_allocation", f"""
    SELECT app_id, stage_id, attempt_id, worker, {_SUMS} FROM ({_DONE}) GROUP BY ALL""")
def _stage_allocation(spark, sf):
    return jl.allocation_by_worker(jl.log_tasks(event_log(spark, sf)))


_GRID = f"""
    SELECT coalesce(d.app_id, r.app_id) AS app_id, coalesce(d.worker, r.worker) AS worker,
           {', '.join(f'coalesce(d.{m}, 0) AS {m}' for m in METRICS)}
    FROM (SELECT app_id, worker, {_SUMS} FROM ({_DONE}) GROUP BY app_id, worker) d
    FULL JOIN ({_ROSTER}) r ON d.app_id = r.app_id AND d.worker = r.worker"""


@query("app_worker_grid", _GRID)
def _app_worker_grid(spark, sf):
    log = event_log(spark, sf)
    return jl.app_worker_grid(jl.log_tasks(log), jl.workers(log))


def _skew_sql(keys: str, grid: str) -> str:
    return f"""
    WITH long AS (UNPIVOT ({grid}) ON {', '.join(METRICS)} INTO NAME metric VALUE value),
    ends AS (SELECT {keys}, metric, min(value) AS minimum, max(value) AS maximum, count(*) AS worker_count
             FROM long GROUP BY ALL)
    SELECT {keys}, metric, minimum, maximum,
           CASE WHEN minimum > 0 THEN round(maximum / minimum, 3) END AS max_to_min_ratio,
           count(*) FILTER (WHERE value = maximum) AS workers_at_maximum,
           count(*) FILTER (WHERE value = 0) AS workers_with_zero, worker_count
    FROM ends JOIN long USING ({keys}, metric) GROUP BY {keys}, metric, minimum, maximum, worker_count"""


@query("log_report_app_skew", _skew_sql("app_id", _GRID))
def _app_skew(spark, sf):
    log = event_log(spark, sf)
    return jl.app_skew(jl.app_worker_grid(jl.log_tasks(log), jl.workers(log)))


@query("log_report_stage_skew", _skew_sql("app_id, stage_id, attempt_id", f"""
    SELECT coalesce(d.app_id, r.app_id) AS app_id, coalesce(d.stage_id, r.stage_id) AS stage_id,
           CAST(0 AS BIGINT) AS attempt_id, coalesce(d.worker, r.worker) AS worker,
           {', '.join(f'coalesce(d.{m}, 0) AS {m}' for m in METRICS)}
    FROM (SELECT app_id, stage_id, worker, {_SUMS} FROM ({_DONE}) WHERE stage_id % 2 = 1
          GROUP BY app_id, stage_id, worker) d
    FULL JOIN (SELECT w.app_id, w.worker, 2 * o_orderkey + 1 AS stage_id
               FROM ({_ROSTER}) w JOIN orders ON w.app_id = {_APP}) r
    ON d.app_id = r.app_id AND d.stage_id = r.stage_id AND d.worker = r.worker"""))
def _stage_skew(spark, sf):
    log = event_log(spark, sf)
    return jl.stage_skew(log, jl.log_tasks(log))


@query("log_sql_executions", f"""
    SELECT {_APP} AS app_id, o_custkey AS execution_id, 'customer ' || o_custkey AS description,
           o_custkey * 1000 AS started_at_epoch_ms, '== plan ' || o_custkey AS initial_physical_plan,
           o_custkey * 1000 + 500 AS ended_at_epoch_ms, CAST(500 AS BIGINT) AS duration_ms,
           count(*) FILTER (WHERE o_orderstatus = 'F') AS adaptive_plan_updates
    FROM orders GROUP BY {_APP}, o_custkey""")
def _log_sql_executions(spark, sf):
    return jl.log_sql_executions(event_log(spark, sf)).drop(
        "root_execution_id", "details", "modified_configs", "job_tags")


@query("job_execution_join", f"""
    SELECT {_APP} AS app_id, o_custkey AS execution_id, o_orderkey AS job_id FROM orders WHERE o_orderstatus <> 'P'""")
def _job_execution_join(spark, sf):
    log = event_log(spark, sf)
    return jl.job_execution_join(jl.log_jobs(log), jl.log_sql_executions(log))


@query("log_plan_updates", f"""
    SELECT {_APP} AS app_id, o_custkey AS execution_id, 'update ' || o_orderkey AS physical_plan,
           row_number() OVER (PARTITION BY {_APP}, o_custkey ORDER BY o_orderkey) AS sequence
    FROM orders WHERE o_orderstatus = 'F'""")
def _log_plan_updates(spark, sf):
    return jl.log_plan_updates(event_log(spark, sf)).select("app_id", "execution_id", "physical_plan", "sequence")


_TREES = f"""
    SELECT DISTINCT {_APP} AS app_id, o_custkey AS execution_id, CAST(0 AS BIGINT) AS sequence,
           [('Aggregate', -1), ('Exchange', 0), ('Scan orders', 1), ('Scan customer', 0)] AS ops FROM orders
    UNION ALL
    SELECT {_APP}, o_custkey, row_number() OVER (PARTITION BY {_APP}, o_custkey ORDER BY o_orderkey),
           [('AdaptiveSparkPlan', -1), ('Scan orders', 0)] FROM orders WHERE o_orderstatus = 'F'"""


@query("plan_operators", f"""
    SELECT app_id, execution_id, sequence, CAST(i - 1 AS BIGINT) AS node_id,
           CAST(nullif(struct_extract(ops[i], 2), -1) AS BIGINT) AS parent_node_id,
           struct_extract(ops[i], 1) AS node_name,
           CASE WHEN sequence = 0 AND i = 1 THEN 'Aggregate ' || execution_id END AS simple_string
    FROM (SELECT *, unnest(range(1, len(ops) + 1)) AS i FROM ({_TREES}))""")
def _plan_operators(spark, sf):
    nodes = jl.plan_operators(jl.plan_trees(event_log(spark, sf)))
    return nodes.select(
        "app_id", "execution_id", "sequence", F.col("node_id").cast("bigint").alias("node_id"),
        F.col("parent_node_id").cast("bigint").alias("parent_node_id"), "node_name", "simple_string",
    )


@query("plan_edges", f"""
    SELECT app_id, execution_id, sequence, CAST(struct_extract(ops[i], 2) AS BIGINT) AS parent_node_id,
           CAST(i - 1 AS BIGINT) AS child_node_id
    FROM (SELECT *, unnest(range(1, len(ops) + 1)) AS i FROM ({_TREES})) WHERE struct_extract(ops[i], 2) >= 0""")
def _plan_edges(spark, sf):
    edges = jl.plan_edges(jl.plan_operators(jl.plan_trees(event_log(spark, sf))))
    return edges.withColumns({n: F.col(n).cast("bigint") for n in ("parent_node_id", "child_node_id")})


@query("profile_plan", f"""
    WITH done AS (
        SELECT {_APP} AS app_id, o_custkey AS execution_id, l_linenumber AS n, l_quantity AS q, l_extendedprice AS p
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND NOT (l_returnflag = 'R' AND l_linestatus = 'F')),
    updated AS (SELECT DISTINCT {_APP} AS app_id, o_custkey AS execution_id FROM orders WHERE o_orderstatus = 'F'),
    plain AS (
        SELECT app_id, execution_id, sum(n) AS added, sum(CAST(floor(p) AS BIGINT)) AS spilled,
               sum(CAST(CAST(q AS BIGINT) AS DOUBLE)) AS millis
        FROM done ANTI JOIN updated USING (app_id, execution_id) GROUP BY ALL)
    SELECT app_id, execution_id, 0::BIGINT AS node_id, 'Aggregate' AS node_name,
           CAST(CASE WHEN execution_id % 2 = 0 THEN coalesce(added, 0) + 1000 ELSE added END AS BIGINT) AS rows,
           millis AS time_ms, CAST(spilled AS BIGINT) AS spill_bytes FROM plain
    UNION ALL
    SELECT app_id, execution_id, node_id, node_name, NULL, NULL, NULL FROM plain,
        (VALUES (1::BIGINT, 'Exchange'), (2, 'Scan orders'), (3, 'Scan customer')) AS below(node_id, node_name)
    UNION ALL
    SELECT app_id, execution_id, node_id, node_name, NULL, NULL, NULL FROM updated,
        (VALUES (0::BIGINT, 'AdaptiveSparkPlan'), (1, 'Scan orders')) AS last(node_id, node_name)""")
def _profile_plan(spark, sf):
    """Rows, time and spill of every operator of each execution's last plan, from the updates tasks and driver logged."""
    profile = jl.operator_profile(jl.operator_metrics(event_log(spark, sf)))
    return profile.select("app_id", "execution_id", F.col("node_id").cast("bigint").alias("node_id"), "node_name", "rows",
                          "time_ms", "spill_bytes")


@query("stage_dag", f"""
    SELECT {_APP} AS app_id, 2 * o_orderkey AS parent_stage_id, 2 * o_orderkey + 1 AS child_stage_id FROM orders""")
def _stage_dag(spark, sf):
    return jl.stage_dag(jl.log_stages(event_log(spark, sf)))


@query("rdd_lineage", f"""
    SELECT {_APP} AS app_id, 3 * o_orderkey + r AS parent_rdd_id, 3 * o_orderkey + r + 1 AS child_rdd_id
    FROM orders, range(2) AS two(r)""")
def _rdd_lineage(spark, sf):
    return jl.rdd_lineage(jl.log_rdds(event_log(spark, sf)))


_SUMMARY = f"""
    SELECT {_APP} AS app_id, 2 * count(*) AS stage_count, count(*) AS stage_edge_count, 3 * count(*) AS rdd_count,
           2 * count(*) AS rdd_edge_count, count(DISTINCT o_custkey) AS sql_execution_count,
           4 * count(DISTINCT o_custkey) AS initial_sql_operator_count,
           count(*) FILTER (WHERE o_orderstatus = 'F') AS adaptive_sql_plan_update_count
    FROM orders GROUP BY {_APP}"""


@query("dag_summary", _SUMMARY)
def _dag_summary(spark, sf):
    return jl.summary_of_log(event_log(spark, sf))


@query("expect_complete_log", f"""
    SELECT {_APP} AS app_id, CAST(1 AS BIGINT) AS applications, count(*) AS jobs, count(*) AS completed_stages,
           3 * count(*) AS stages_with_rdds, count(DISTINCT o_custkey) AS executions,
           CAST(0 AS BIGINT) AS without_plan, true AS complete
    FROM orders GROUP BY {_APP}""")
def _expect_complete_log(spark, sf):
    return jl.completeness(event_log(spark, sf))


@query("metrics_report_sink", _SUMMARY)
def _metrics_report_sink(spark, sf):
    path = scratch(spark, "report")
    jl.write_report(event_log(spark, sf), path)
    counts = ", ".join(f"{name} bigint" for name in jl.SUMMARY)
    return spark.read.schema(f"app_id string, {counts}").json(f"{path}/summary")

