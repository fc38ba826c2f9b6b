"""What ran: applications, jobs, stages, RDDs, tasks, SQL plans and their graphs.

Every function takes the event table of :mod:`millrace.sources.joblog`, which may hold any
number of applications, and returns one flat table with ``app_id``. Lists that can grow with
the data (jobs of an execution, RDDs of a stage, workers at an extreme) are rows, not arrays.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import compute_once
from ..operators.contracts import ContractError
from ..operators.joins import join_lookup
from ..operators.ranking import sequence_within
from ..operators.workers import METRICS, allocation, skew_compare, skew_workers, totals
from ..session import pin_as_table, pins_dropped, sparing_disk
from ..sources import joblog as kinds
from ..sources.joblog import read_event_log

POSITION = ("block", "line")
PLAN_LEVELS_PER_PASS = 4


def value(path: str, kind: str, doc: str | Column = "body") -> Column:
    return F.try_variant_get(doc, path, kind)


def _of(log: DataFrame, *events: str) -> DataFrame:
    return log.filter(F.col("event").isin(*events))


def _json(column: Column) -> Column:
    return F.to_json(column)


def log_application(log: DataFrame) -> DataFrame:
    started = F.col("event") == kinds.APP_START
    return _of(log, kinds.APP_START, kinds.APP_END).groupBy("app_id").agg(
        F.max(F.when(started, value('$["App Name"]', "string"))).alias("name"),
        F.max(F.when(started, value('$["App ID"]', "string"))).alias("application_id"),
        F.max(F.when(started, value("$.Timestamp", "bigint"))).alias("started_at_epoch_ms"),
        F.max(F.when(~started, value("$.Timestamp", "bigint"))).alias("ended_at_epoch_ms"),
    )


def log_jobs(log: DataFrame) -> DataFrame:
    return _of(log, kinds.JOB_START).select(
        "app_id",
        value('$["Job ID"]', "bigint").alias("job_id"),
        value('$["Stage IDs"]', "array<bigint>").alias("stage_ids"),
        value('$.Properties["spark.sql.execution.id"]', "string").try_cast("bigint").alias("sql_execution_id"),
    )


def _stage_sightings(log: DataFrame) -> DataFrame:
    """Each time a stage is described, with its place in the log."""
    described = F.when(
        F.col("event") == kinds.JOB_START, value('$["Stage Infos"]', "array<variant>")
    ).otherwise(F.array(value('$["Stage Info"]', "variant")))
    return _of(log, kinds.JOB_START, kinds.STAGE_COMPLETED).select(
        "app_id", *POSITION, F.posexplode(described).alias("nth", "stage")
    )


def _rdd_sightings(log: DataFrame) -> DataFrame:
    """Each time an RDD is described, with the stage it is described in."""
    return _stage_sightings(log).select(
        "app_id", *POSITION, "nth", value('$["Stage ID"]', "bigint", "stage").alias("stage_id"),
        F.posexplode(value('$["RDD Info"]', "array<variant>", "stage")).alias("rdd_nth", "rdd"),
    )


def _ids(path: str, doc: str) -> Column:
    return F.coalesce(value(path, "array<bigint>", doc), F.array().cast("array<bigint>"))


def _number(path: str, doc: str | Column = "body") -> Column:
    return F.coalesce(value(path, "bigint", doc), F.lit(0))


def _last_sighting(sightings: DataFrame, keys: dict[str, Column], place: list[str], facts: Column) -> DataFrame:
    """The facts last told about each key; only facts, not documents, are sorted and shuffled."""
    told = compute_once(sightings, ["app_id", *place], **keys, facts=facts)
    return (
        told.groupBy("app_id", *keys)
        .agg(F.max_by("facts", F.struct(*place)).alias("last"))
        .select("app_id", *keys, "last.*")
    )


def log_stages(log: DataFrame) -> DataFrame:
    """Each stage as last described."""
    stage = "stage"
    facts = F.struct(
        _number('$["Stage Attempt ID"]', stage).alias("attempt_id"),
        value('$["Stage Name"]', "string", stage).alias("name"),
        value("$.Details", "string", stage).alias("details"),
        _number('$["Number of Tasks"]', stage).alias("number_of_tasks"),
        _ids('$["Parent IDs"]', stage).alias("parent_stage_ids"),
    )
    keys = {"stage_id": value('$["Stage ID"]', "bigint", stage)}
    return _last_sighting(_stage_sightings(log), keys, [*POSITION, "nth"], facts)


def stage_rdds(log: DataFrame) -> DataFrame:
    """RDDs of each stage: the union over all its descriptions, one row per pair."""
    return _rdd_sightings(log).select(
        "app_id", "stage_id", value('$["RDD ID"]', "bigint", "rdd").alias("rdd_id")
    ).distinct()


def log_rdds(log: DataFrame) -> DataFrame:
    """Each RDD as last described."""
    rdd = "rdd"
    scope = value("$.Scope", "string", rdd)
    facts = F.struct(
        value("$.Name", "string", rdd).alias("name"),
        _ids('$["Parent IDs"]', rdd).alias("parent_rdd_ids"),
        _number('$["Number of Partitions"]', rdd).alias("number_of_partitions"),
        _number('$["Number of Cached Partitions"]', rdd).alias("number_of_cached_partitions"),
        _json(value('$["Storage Level"]', "variant", rdd)).alias("storage_level"),
        _number('$["Memory Size"]', rdd).alias("memory_size_bytes"),
        _number('$["Disk Size"]', rdd).alias("disk_size_bytes"),
        scope.alias("scope"),
        value("$.name", "string", F.try_parse_json(scope)).alias("scope_name"),
        value("$.Callsite", "string", rdd).alias("callsite"),
        F.coalesce(value("$.Barrier", "boolean", rdd), F.lit(False)).alias("barrier"),
        value("$.DeterministicLevel", "string", rdd).alias("deterministic_level"),
    )
    keys = {"rdd_id": value('$["RDD ID"]', "bigint", rdd)}
    return _last_sighting(_rdd_sightings(log), keys, [*POSITION, "nth", "rdd_nth"], facts)


def _named(path: str) -> Column:
    """A text that is ``unknown`` where the log has none or an empty one."""
    return F.coalesce(F.nullif(value(path, "string"), F.lit("")), F.lit("unknown"))


def log_executors(log: DataFrame) -> DataFrame:
    """Registered executors and their hosts; the driver does not count."""
    return (
        _of(log, kinds.EXECUTOR_ADDED)
        .select(
            "app_id", *POSITION,
            _named('$["Executor ID"]').alias("executor_id"),
            _named('$["Executor Info"].Host').alias("host"),
        )
        .filter(F.col("executor_id") != "driver")
        .groupBy("app_id", "executor_id")
        .agg(F.max_by("host", F.struct(*POSITION)).alias("host"))
    )


def workers(log: DataFrame) -> DataFrame:
    """Registered workers as ``executor@host``."""
    return log_executors(log).select("app_id", F.concat_ws("@", "executor_id", "host").alias("worker"))


def success(reason: Column) -> Column:
    return reason.isNull() | (reason == "Success")


def _is(kind: str) -> Column:
    return F.col("event") == kind


def log_tasks(log: DataFrame) -> DataFrame:
    """Successful tasks with their worker, records read and shuffle bytes."""
    tasks = (
        _of(log, kinds.TASK_END)
        .filter(success(value('$["Task End Reason"].Reason', "string")))
        .select(
            "app_id",
            value('$["Stage ID"]', "bigint").alias("stage_id"),
            F.coalesce(value('$["Stage Attempt ID"]', "bigint"), F.lit(0)).alias("attempt_id"),
            _named('$["Task Info"]["Executor ID"]').alias("executor_id"),
            F.nullif(value('$["Task Info"].Host', "string"), F.lit("")).alias("task_host"),
            _number('$["Task Metrics"]["Input Metrics"]["Records Read"]').alias("input_records"),
            (
                _number('$["Task Metrics"]["Shuffle Read Metrics"]["Remote Bytes Read"]')
                + _number('$["Task Metrics"]["Shuffle Read Metrics"]["Local Bytes Read"]')
            ).alias("shuffle_read_bytes"),
            _number(
                '$["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]'
            ).alias("shuffle_write_bytes"),
        )
    )
    # Tasks mostly name their host, so only the others meet the executors.
    named = tasks.filter(F.col("task_host").isNotNull()).withColumn("host", F.lit(None).cast("string"))
    hosted = named.unionByName(join_lookup(
        tasks.filter(F.col("task_host").isNull()), log_executors(log), ["app_id", "executor_id"], "left"))
    host = F.coalesce("task_host", "host", F.lit("unknown"))
    return hosted.select(
        "app_id", "stage_id", "attempt_id", F.concat_ws("@", "executor_id", host).alias("worker"),
        *METRICS[1:],
    )


def allocation_by_worker(tasks: DataFrame, per_stage: bool = True) -> DataFrame:
    """Tasks, records and bytes per worker, per stage attempt or for the whole application."""
    keys = ["app_id", *(["stage_id", "attempt_id"] if per_stage else []), "worker"]
    return allocation(tasks, keys, {name: F.col(name) for name in METRICS[1:]})


def app_worker_grid(tasks: DataFrame, registered: DataFrame) -> DataFrame:
    """Allocation per application and worker, with registered workers that did nothing at 0."""
    done = allocation_by_worker(tasks, per_stage=False)
    idle = registered.select(
        "app_id", "worker", *[F.lit(0).cast("bigint").alias(name) for name in METRICS]
    )
    return done.unionByName(idle).groupBy("app_id", "worker").agg(
        *[F.sum(name).alias(name) for name in METRICS]
    )


def log_stage_metrics(log: DataFrame, tasks: DataFrame) -> DataFrame:
    """Completed stages keyed by (stage, attempt): duration and shuffle totals."""
    stage = '$["Stage Info"]'
    facts = F.struct(
        value(f'{stage}["Stage Name"]', "string").alias("name"),
        (
            value(f'{stage}["Completion Time"]', "bigint") - value(f'{stage}["Submission Time"]', "bigint")
        ).alias("duration_ms"),
    )
    ids = {"stage_id": value(f'{stage}["Stage ID"]', "bigint"),
           "attempt_id": F.coalesce(value(f'{stage}["Stage Attempt ID"]', "bigint"), F.lit(0))}
    completed = _last_sighting(_of(log, kinds.STAGE_COMPLETED), ids, list(POSITION), facts)
    keys = ["app_id", *ids]
    sums = totals(tasks, keys, ["shuffle_read_bytes", "shuffle_write_bytes"])
    return completed.join(sums, keys, "left").fillna(0, ["shuffle_read_bytes", "shuffle_write_bytes"])


def stage_skew(log: DataFrame, tasks: DataFrame) -> DataFrame:
    """Worker comparison per completed stage attempt, idle registered workers included as 0."""
    keys = ["app_id", "stage_id", "attempt_id"]
    registered = workers(log)
    with sparing_disk(log.sparkSession):
        done = pin_as_table(join_lookup(  # read by the counts of workers and by the comparison
            allocation_by_worker(tasks), registered.withColumn("listed", F.lit(1)), ["app_id", "worker"], "left"
        ), "stage-allocation")
    completed = _of(log, kinds.STAGE_COMPLETED).select(
        "app_id",
        value('$["Stage Info"]["Stage ID"]', "bigint").alias("stage_id"),
        F.coalesce(value('$["Stage Info"]["Stage Attempt ID"]', "bigint"), F.lit(0)).alias("attempt_id"),
    ).distinct()
    present = done.groupBy(*keys).agg(F.count("listed").alias("listed"))
    sizes = registered.groupBy("app_id").agg(F.count(F.lit(1)).alias("roster"))
    missing = join_lookup(completed.join(present, keys, "left"), sizes, ["app_id"], "left").select(
        *keys, (F.coalesce("roster", F.lit(0)) - F.coalesce("listed", F.lit(0))).alias("missing")
    )
    return skew_compare(done.select(*keys, *METRICS), keys, METRICS, missing, together=True)


def app_skew(grid: DataFrame) -> DataFrame:
    return skew_compare(grid, ["app_id"], METRICS)


def app_skew_workers(grid: DataFrame) -> DataFrame:
    return skew_workers(grid, ["app_id"], "worker", METRICS)


def log_sql_executions(log: DataFrame) -> DataFrame:
    """SQL executions with description, times and plan text, from one aggregate.

    An execution known only from an update or an end event still has a row.
    """
    begun = F.struct(
        value("$.rootExecutionId", "bigint").alias("root_execution_id"),
        value("$.description", "string").alias("description"),
        value("$.details", "string").alias("details"),
        value("$.time", "bigint").alias("started_at_epoch_ms"),
        value("$.physicalPlanDescription", "string").alias("initial_physical_plan"),
        _json(value("$.modifiedConfigs", "variant")).alias("modified_configs"),
        _json(value("$.jobTags", "variant")).alias("job_tags"),
    )
    place = F.struct(*POSITION)
    # Facts are taken out first, so that no event body goes into the aggregate.
    told = compute_once(
        _of(log, kinds.SQL_START, kinds.SQL_UPDATE, kinds.SQL_END), ["app_id", "event", *POSITION],
        execution_id=value("$.executionId", "bigint"), begun=F.when(_is(kinds.SQL_START), begun),
        ended=F.when(_is(kinds.SQL_END), value("$.time", "bigint")),
    )
    return (
        told.groupBy("app_id", "execution_id")
        .agg(
            F.max_by("begun", F.when(_is(kinds.SQL_START), place)).alias("begun"),
            F.max_by("ended", F.when(_is(kinds.SQL_END), place)).alias("ended_at_epoch_ms"),
            F.count(F.when(_is(kinds.SQL_UPDATE), 1)).alias("adaptive_plan_updates"),
        )
        .select(
            "app_id", "execution_id", "begun.*", "ended_at_epoch_ms",
            (F.col("ended_at_epoch_ms") - F.col("begun.started_at_epoch_ms")).alias("duration_ms"),
            "adaptive_plan_updates",
        )
    )


def job_execution_join(jobs: DataFrame, executions: DataFrame) -> DataFrame:
    """``(app_id, execution_id, job_id)``: the jobs each SQL execution started."""
    linked = jobs.filter(F.col("sql_execution_id").isNotNull()).select(
        "app_id", F.col("sql_execution_id").alias("execution_id"), "job_id"
    )
    return join_lookup(linked, executions.select("app_id", "execution_id"), ["app_id", "execution_id"])


def log_plan_updates(log: DataFrame) -> DataFrame:
    """Adaptive plan updates, numbered from 1 per execution in log order."""
    updates = _of(log, kinds.SQL_UPDATE).select(
        "app_id", value("$.executionId", "bigint").alias("execution_id"), *POSITION,
        value("$.physicalPlanDescription", "string").alias("physical_plan"),
        value("$.sparkPlanInfo", "variant").alias("plan"),
    )
    return sequence_within(updates, ["app_id", "execution_id"], ["block"], ["line"], "sequence")


def plan_trees(log: DataFrame) -> DataFrame:
    """One row per plan tree: the initial plan is sequence 0, updates follow from 1."""
    initial = _of(log, kinds.SQL_START).select(
        "app_id", value("$.executionId", "bigint").alias("execution_id"),
        F.lit(0).cast("bigint").alias("sequence"), value("$.sparkPlanInfo", "variant").alias("plan"),
    )
    updates = log_plan_updates(log).select("app_id", "execution_id", "sequence", "plan")
    return initial.unionByName(updates).filter(F.col("plan").isNotNull())


def plan_operators(trees: DataFrame) -> DataFrame:
    """Nodes of nested plan trees in preorder, each with its parent (null at the root).

    A tree stays in its row: level by level, its nodes are appended to an array with their paths, a few levels in each
    pass; only trees with deeper nodes go into the next pass. Sorted by path the array is in preorder, so a node's
    number is its place there and its parent's number that of the path without the last step. Nothing is shuffled.
    """
    keys = ["app_id", "execution_id", "sequence"]
    root = F.array(F.struct(F.array().cast("array<int>").alias("at"), F.col("plan").alias("node")))
    todo = trees.select(*keys, F.array().cast(_NODES).alias("done"), root.alias("level"))
    found: DataFrame | None = None
    while True:
        for _ in range(PLAN_LEVELS_PER_PASS):
            facts = F.transform("level", _node_facts)
            todo = compute_once(todo, keys, done=F.concat("done", facts), level=_children(F.col("level")))
        stored = pin_as_table(todo, "plan-levels")
        nodes = _numbered(stored.filter(F.size("level") == 0), keys)
        found = nodes if found is None else found.unionByName(nodes)
        todo = stored.filter(F.size("level") > 0)
        if todo.isEmpty():
            return found


_NODES = "array<struct<at:array<int>,node_name:string,simple_string:string,metadata:string,metrics:string>>"


def _node_facts(item: Column) -> Column:
    node = item["node"]
    return F.struct(
        item["at"].alias("at"), value("$.nodeName", "string", node).alias("node_name"),
        value("$.simpleString", "string", node).alias("simple_string"),
        _json(value("$.metadata", "variant", node)).alias("metadata"),
        _json(value("$.metrics", "variant", node)).alias("metrics"),
    )


def _children(nodes: Column) -> Column:
    """The child nodes of an array of nodes, with their paths."""

    def below(parent: Column) -> Column:
        kids = F.coalesce(
            value("$.children", "array<variant>", parent["node"]), F.array().cast("array<variant>")
        )
        return F.transform(
            kids, lambda kid, nth: F.struct(F.array_append(parent["at"], nth).alias("at"), kid.alias("node"))
        )

    return F.flatten(F.transform(nodes, below))


def _numbered(trees: DataFrame, keys: list[str]) -> DataFrame:
    """One row a node from one row a tree."""
    ordered = compute_once(trees, keys, nodes=F.sort_array("done"))
    listed = compute_once(ordered, [*keys, "nodes"], paths=F.transform("nodes", lambda n: n["at"]))
    at = F.col("node.at")
    above = F.when(F.size(at) > 0, F.array_position("paths", F.slice(at, F.lit(1), F.size(at) - 1)) - 1)
    return listed.select(*keys, "paths", F.posexplode("nodes").alias("node_id", "node")).select(
        *keys, "node_id", above.cast("int").alias("parent_node_id"), "node.node_name", "node.simple_string", "node.metadata",
        "node.metrics")


def plan_edges(operators: DataFrame) -> DataFrame:
    return operators.filter(F.col("parent_node_id").isNotNull()).select(
        "app_id", "execution_id", "sequence", "parent_node_id", F.col("node_id").alias("child_node_id")
    )


_METRICS = "array<struct<name:string,accumulatorId:bigint,metricType:string>>"


def accumulator_totals(log: DataFrame) -> DataFrame:
    """``(app_id, accumulator_id, total, updates)``: what successful tasks and the driver added to each SQL metric."""
    of_tasks = _of(log, kinds.TASK_END).filter(success(value('$["Task End Reason"].Reason', "string"))).select(
        "app_id", F.explode(value('$["Task Info"].Accumulables', "array<variant>")).alias("one"))
    added = of_tasks.select(
        "app_id", value("$.ID", "bigint", "one").alias("accumulator_id"),
        value("$.Update", "string", "one").try_cast("bigint").alias("added"),
        value("$.Metadata", "string", "one").alias("kind")).filter("kind = 'sql'").drop("kind")
    of_driver = _of(log, kinds.DRIVER_UPDATES).select(
        "app_id", F.explode(value("$.accumUpdates", "array<array<bigint>>")).alias("one")).select(
        "app_id", F.col("one")[0].alias("accumulator_id"), F.col("one")[1].alias("added"))
    return added.unionByName(of_driver).groupBy("app_id", "accumulator_id").agg(
        F.sum("added").alias("total"), F.count("added").alias("updates"))


def operator_metrics(log: DataFrame) -> DataFrame:
    """Every metric of every operator of each execution's last plan, with what was measured: ``(app_id, execution_id,
    sequence, node_id, parent_node_id, node_name, metric, metric_type, total, updates)``; null where nothing reported.

    The last plan is that of the newest adaptive update, or the initial one. Only its metric ids meet the sums of the
    log's accumulator updates, which are reduced before the join.
    """
    trees = plan_trees(log)
    newest = trees.groupBy("app_id", "execution_id").agg(F.max("sequence").alias("sequence"))
    last = trees.join(newest, ["app_id", "execution_id", "sequence"])
    listed = plan_operators(last).select(
        "app_id", "execution_id", "sequence", "node_id", "parent_node_id", "node_name",
        F.explode_outer(F.from_json("metrics", _METRICS)).alias("metric"))
    named = listed.select(*[n for n in listed.columns if n != "metric"], F.col("metric.name").alias("metric"),
                          F.col("metric.metricType").alias("metric_type"), F.col("metric.accumulatorId").alias("accumulator_id"))
    return named.join(accumulator_totals(log), ["app_id", "accumulator_id"], "left").drop("accumulator_id")


def operator_profile(metrics: DataFrame) -> DataFrame:
    """One row per operator: rows put out, milliseconds, and bytes spilled; null where the operator does not measure it.

    ``metrics`` is what :func:`operator_metrics` gives. Times are those Spark measures in an operator, summed over tasks.
    """
    name, total = F.col("metric"), F.col("total")
    millis = F.when(F.col("metric_type") == "nsTiming", total / 1_000_000).when(
        F.col("metric_type") == "timing", total.cast("double"))
    return metrics.groupBy("app_id", "execution_id", "sequence", "node_id", "parent_node_id", "node_name").agg(
        F.sum(F.when(name == "number of output rows", total)).alias("rows"), F.sum(millis).alias("time_ms"),
        F.sum(F.when(name == "spill size", total)).alias("spill_bytes"))


def profile_run(df: DataFrame, wait: float = 20.0) -> DataFrame:
    """Run a query and report its operators as :func:`operator_profile` does, from the session's own event log.

    The session must write an uncompressed event log. The result is computed in full and discarded. The log is written
    behind the query, so its end is awaited, for ``wait`` seconds at most.
    """
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    conf = context.getConf()
    if conf.get("spark.eventLog.enabled", "false") != "true" or conf.get("spark.eventLog.compress", "true") == "true":
        raise ValueError("profiling needs spark.eventLog.enabled=true and spark.eventLog.compress=false")
    name = f"profile-{uuid.uuid4().hex}"
    context.setJobDescription(name)
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        context.setJobDescription(None)
    path = f"{conf.get('spark.eventLog.dir').rstrip('/')}/*{context.applicationId}*"
    until = time.monotonic() + wait
    while True:
        log = pin_as_table(read_event_log(spark, path, mode="drop"), "own-log")
        own = log_sql_executions(log).filter((F.col("description") == name) & F.col("ended_at_epoch_ms").isNotNull())
        found = [r["execution_id"] for r in own.select("execution_id").collect()]
        if found:
            return operator_profile(operator_metrics(log.filter(
                ~F.col("event").isin(kinds.SQL_START, kinds.SQL_UPDATE) | value("$.executionId", "bigint").isin(found))))
        if time.monotonic() > until:
            raise TimeoutError(f"the end of the query is not in {path}")
        time.sleep(0.5)


def stage_dag(stages: DataFrame) -> DataFrame:
    return stages.select(
        "app_id", F.explode("parent_stage_ids").alias("parent_stage_id"), F.col("stage_id").alias("child_stage_id")
    ).distinct()


def rdd_lineage(rdds: DataFrame) -> DataFrame:
    return rdds.select(
        "app_id", F.explode("parent_rdd_ids").alias("parent_rdd_id"), F.col("rdd_id").alias("child_rdd_id")
    ).distinct()


# The counts of a summary row.
SUMMARY = (
    "stage_count",
    "stage_edge_count",
    "rdd_count",
    "rdd_edge_count",
    "sql_execution_count",
    "initial_sql_operator_count",
    "adaptive_sql_plan_update_count",
)


def dag_summary(
    stages: DataFrame, rdds: DataFrame, executions: DataFrame, operators: DataFrame
) -> DataFrame:
    """One row per application with the size of its graphs.

    Every table is first reduced to one row per application; those few rows are merged by
    one more aggregate, so nothing is joined.
    """
    rows = F.count(F.lit(1))
    initial = operators.filter(F.col("sequence") == 0)
    counts = [
        _counts(stages, stage_count=rows),
        _counts(stage_dag(stages), stage_edge_count=rows),
        _counts(rdds, rdd_count=rows),
        _counts(rdd_lineage(rdds), rdd_edge_count=rows),
        _counts(executions, sql_execution_count=rows,
                adaptive_sql_plan_update_count=F.sum("adaptive_plan_updates")),
        _counts(initial, initial_sql_operator_count=rows),
    ]
    merged = counts[0]
    for more in counts[1:]:
        merged = merged.unionByName(more, allowMissingColumns=True)
    return merged.groupBy("app_id").agg(*[
        F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in SUMMARY
    ])


def summary_of_log(log: DataFrame) -> DataFrame:
    """What :func:`dag_summary` says, straight from the log: only ids, parents and counts are read.

    Stages and RDDs are reduced to their last parents in one aggregate each; of plans, only those that
    executions began with are opened, and their nodes are counted level by level within the row. One count is made
    after the other, so that the shuffle files of only one take up disk.
    """
    rows = F.count(F.lit(1))

    def graph(sightings: DataFrame, key: Column, place: list[str], parents: Column) -> DataFrame:
        return _last_sighting(sightings, {"id": key}, place, F.struct(parents.alias("parents")))

    stages = graph(_stage_sightings(log), value('$["Stage ID"]', "bigint", "stage"), [*POSITION, "nth"],
                   _ids('$["Parent IDs"]', "stage"))
    rdds = graph(_rdd_sightings(log), value('$["RDD ID"]', "bigint", "rdd"), [*POSITION, "nth", "rdd_nth"],
                 _ids('$["Parent IDs"]', "rdd"))
    executions = _of(log, kinds.SQL_START, kinds.SQL_UPDATE, kinds.SQL_END).select(
        "app_id", value("$.executionId", "bigint").alias("execution_id"), _is(kinds.SQL_UPDATE).cast("int").alias("update")
    ).groupBy("app_id", "execution_id").agg(F.sum("update").alias("updates"))
    edges = F.sum(F.size(F.array_distinct("parents")))
    counts = [
        _counts(stages, stage_count=rows, stage_edge_count=edges),
        _counts(rdds, rdd_count=rows, rdd_edge_count=edges),
        _counts(executions, sql_execution_count=rows, adaptive_sql_plan_update_count=F.sum("updates")),
        _counts(_plan_sizes(log), initial_sql_operator_count=F.sum("nodes")),
    ]
    with sparing_disk(log.sparkSession):
        counts = [pin_as_table(table, "counts") for table in counts]
    merged = counts[0]
    for more in counts[1:]:
        merged = merged.unionByName(more, allowMissingColumns=True)
    return merged.groupBy("app_id").agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in SUMMARY])


def _plan_sizes(log: DataFrame) -> DataFrame:
    """``(app_id, nodes)`` parts of the number of nodes of every plan that an execution began with."""
    none = F.array().cast("array<variant>")
    level = _of(log, kinds.SQL_START).select(
        "app_id", F.array(value("$.sparkPlanInfo", "variant")).alias("level")).filter(F.col("level")[0].isNotNull())
    parts = None
    while True:
        counted = level.withColumn("nodes", F.lit(0).cast("bigint"))
        for _ in range(2 * PLAN_LEVELS_PER_PASS):
            below = F.flatten(F.transform("level", lambda node: F.coalesce(
                value("$.children", "array<variant>", node), none)))
            counted = compute_once(counted, ["app_id"], nodes=F.col("nodes") + F.size("level"), level=below)
        stored = pin_as_table(counted, "plan-sizes")
        parts = stored.select("app_id", "nodes") if parts is None else parts.unionByName(stored.select("app_id", "nodes"))
        level = stored.filter(F.size("level") > 0).select("app_id", "level")
        if level.isEmpty():
            return parts


def _counts(table: DataFrame, **counts: Column) -> DataFrame:
    return table.groupBy("app_id").agg(*[value.alias(name) for name, value in counts.items()])


def completeness(log: DataFrame) -> DataFrame:
    """Per application, whether the log holds everything a report needs."""
    def rdds(stage: Column) -> Column:
        return F.coalesce(F.size(F.try_variant_get(stage, '$["RDD Info"]', "array<variant>")) > 0, F.lit(False))

    # Every stage of a job counts, and every completed stage.
    submitted = F.size(F.filter(value('$["Stage Infos"]', "array<variant>"), rdds))
    completed = rdds(value('$["Stage Info"]', "variant")).cast("int")
    with_rdds = F.coalesce(F.greatest(submitted, F.lit(0)), F.lit(0)) + completed
    events = log.groupBy("app_id").agg(
        F.count(F.when(_is(kinds.APP_START) & value('$["App ID"]', "string").isNotNull(), 1)).alias("applications"),
        F.count(F.when(_is(kinds.JOB_START), 1)).alias("jobs"),
        F.count(F.when(_is(kinds.STAGE_COMPLETED), 1)).alias("completed_stages"),
        F.sum(with_rdds).alias("stages_with_rdds"),
    )
    executions = log_sql_executions(log).groupBy("app_id").agg(
        F.count(F.lit(1)).alias("executions"),
        F.count(F.when(F.coalesce(F.length("initial_physical_plan"), F.lit(0)) == 0, 1)).alias("without_plan"),
    )
    names = ("applications", "jobs", "completed_stages", "stages_with_rdds", "executions")
    joined = events.join(executions, "app_id", "left").fillna(0, ["executions", "without_plan"])
    complete = F.col("without_plan") == 0
    for name in names:
        complete = complete & (F.col(name) > 0)
    return joined.select("app_id", *names, "without_plan", complete.alias("complete"))


def expect_complete_log(log: DataFrame) -> None:
    broken = completeness(log).filter(~F.col("complete")).take(1)
    if broken:
        raise ContractError(f"incomplete event log: {broken[0].asDict()}")
    if not log.take(1):
        raise ContractError("no event log found")


def write_report(log: DataFrame, path: str) -> None:
    """Every entity table below ``path`` as Parquet, and the summaries as gzipped JSON.

    A table is written once; whatever is derived from it reads the written copy.
    """
    spark = log.sparkSession

    def keep(name: str, table: Callable[[], DataFrame]) -> DataFrame:
        with sparing_disk(spark), pins_dropped(spark):
            made = table()
            made.write.parquet(f"{path}/{name}")
        return spark.read.schema(made.schema).parquet(f"{path}/{name}")

    def tell(name: str, table: Callable[[], DataFrame]) -> None:
        with sparing_disk(spark), pins_dropped(spark):
            table().write.json(f"{path}/{name}", compression="gzip")

    tasks = keep("tasks", lambda: log_tasks(log))
    tell("stage_skew", lambda: stage_skew(log, tasks))  # needs the most disk beside the report
    keep("application", lambda: log_application(log))
    jobs = keep("jobs", lambda: log_jobs(log))
    stages = keep("stages", lambda: log_stages(log))
    keep("stage_rdds", lambda: stage_rdds(log))
    keep("stage_edges", lambda: stage_dag(stages))
    rdds = keep("rdds", lambda: log_rdds(log))
    keep("rdd_edges", lambda: rdd_lineage(rdds))
    executions = keep("sql_executions", lambda: log_sql_executions(log))
    keep("execution_jobs", lambda: job_execution_join(jobs, executions))
    operators = keep("plan_operators", lambda: plan_operators(plan_trees(log)))
    keep("plan_edges", lambda: plan_edges(operators))
    keep("plan_profile", lambda: operator_profile(operator_metrics(log)))
    keep("stage_metrics", lambda: log_stage_metrics(log, tasks))
    keep("stage_allocation", lambda: allocation_by_worker(tasks))
    grid = keep("application_allocation", lambda: app_worker_grid(tasks, workers(log)))
    tell("summary", lambda: dag_summary(stages, rdds, executions, operators))
    tell("application_skew", lambda: app_skew(grid))
    tell("application_skew_workers", lambda: app_skew_workers(grid))
