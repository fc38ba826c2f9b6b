"""How work is spread over workers: allocation, totals and imbalance.

Allocations are sparse: a registered worker without tasks has no row and counts as zero.
The full stage-by-worker product is only built for stages the caller lists.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .joins import join_lookup

# What is compared between workers.
METRICS = ("tasks", "input_records", "shuffle_read_bytes", "shuffle_write_bytes")


def allocation(tasks: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Task count and metric sums per key; a missing metric is zero."""
    return tasks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tasks"),
        *[F.sum(F.coalesce(value, F.lit(0))).alias(name) for name, value in sums.items()],
    )


def totals(allocated: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return allocated.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in metrics])


def worker_grid(
    tasks: DataFrame, roster: DataFrame, worker: str, stage: str, stages: Sequence, metrics: Mapping[str, Column]
) -> DataFrame:
    """Every worker in the roster, or seen in tasks, for each of the listed stages; no work is 0.

    The listed stages are what bounds the product. Work in a stage that is not listed stops the
    job, so that nothing is left out unseen.
    """
    names = ("tasks", *metrics)
    known = F.array(*[F.lit(value) for value in stages])
    listed = F.when(F.array_contains(known, F.col(stage)), F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit("stage is not listed: "), F.coalesce(F.col(stage).cast("string"), F.lit("null")))).cast("boolean"))
    done = allocation(tasks.filter(listed), [stage, worker], metrics)
    everyone = roster.select(worker).union(done.select(worker)).distinct()
    cells = everyone.select(F.explode(known).alias(stage), worker)
    return cells.join(done, [stage, worker], "left").select(
        stage, worker, *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in names])


def skew_compare(
    allocated: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str] = METRICS,
    missing: DataFrame | None = None,
    together: bool = False,
) -> DataFrame:
    """Per key and metric: minimum, maximum, their ratio, and how many workers sit at either end.

    ``missing(keys, missing)`` has one row per key to report and says how many registered
    workers have no row in ``allocated``; they count as zeros, also for a key without any
    work. Two aggregates, the first of which merges equal values, so no group is collected.

    With ``together`` a key's workers are dealt to one task before each becomes a row a metric, which is a fraction of
    the shuffle; it suits keys of which there are many.
    """
    wide = allocated.select(*keys, *metrics)
    if missing is not None:
        nobody = missing.select(*keys, *[F.lit(None).cast("bigint").alias(name) for name in metrics])
        wide = wide.unionByName(nobody)
    long = _long(wide.repartition(*keys) if together else wide, keys, metrics)
    ends = (
        long.groupBy(*keys, "metric", "value").agg(F.count("value").alias("workers"))
        .groupBy(*keys, "metric").agg(
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.max_by("workers", "value").alias("at_high"),
            F.sum(F.when(F.col("value") == 0, F.col("workers")).otherwise(0)).alias("at_zero"),
            F.sum("workers").alias("seen"),
        )
    )
    if missing is None:
        ends = ends.withColumn("missing", F.lit(0))
    else:
        ends = ends.join(missing, list(keys))
    idle = F.col("missing")
    # Metrics are never negative, so idle workers lower the minimum to zero.
    bounded = ends.withColumns({
        "minimum": F.when(idle > 0, F.lit(0)).otherwise(F.col("low")),
        "maximum": F.when(idle > 0, F.coalesce("high", F.lit(0))).otherwise(F.col("high")),
    })
    at_maximum = F.when(F.col("high") == F.col("maximum"), F.col("at_high")).otherwise(0) + F.when(
        F.col("maximum") == 0, idle
    ).otherwise(0)
    return bounded.select(
        *keys, "metric", "minimum", "maximum",
        F.when(F.col("minimum") > 0, F.round(F.col("maximum") / F.col("minimum"), 3)).alias("max_to_min_ratio"),
        at_maximum.alias("workers_at_maximum"),
        (F.col("at_zero") + idle).alias("workers_with_zero"),
        (F.col("seen") + idle).alias("worker_count"),
    )


def _long(wide: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    # Unlike unpivot, this keeps what is known about how rows are dealt out.
    return wide.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in metrics])))


def skew_workers(
    allocated: DataFrame, keys: Sequence[str], worker: str, metrics: Sequence[str] = METRICS
) -> DataFrame:
    """The workers behind the counts: one row per worker at the maximum or at zero."""
    long = allocated.unpivot([*keys, worker], list(metrics), "metric", "value")
    top = long.groupBy(*keys, "metric").agg(F.max("value").alias("maximum"))
    placed = join_lookup(long, top, [*keys, "metric"])
    return placed.filter((F.col("value") == F.col("maximum")) | (F.col("value") == 0)).select(
        *keys, "metric", worker, "value",
        (F.col("value") == F.col("maximum")).alias("at_maximum"),
        (F.col("value") == 0).alias("at_zero"),
    )
