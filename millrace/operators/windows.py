"""Aggregates over epoch-aligned time windows. Windows without rows are not emitted."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import as_interval


def tumbling(df: DataFrame, ts: str, keys: Sequence[str], every: timedelta, *aggregates: Column) -> DataFrame:
    """``(keys, window_start, window_end, aggregates)`` per window of length ``every``.

    Also valid on a stream whose ``ts`` carries a watermark.
    """
    grouped = df.groupBy(F.window(ts, as_interval(every)), *keys).agg(*aggregates)
    rest = [name for name in grouped.columns if name not in ("window", *keys)]
    return grouped.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )


def tumbling_mean(df: DataFrame, ts: str, value: str, keys: Sequence[str], every: timedelta) -> DataFrame:
    present = df.filter(_present(df, value))
    return tumbling(present, ts, keys, every, F.avg(value).alias("value"))


def tumbling_sum(
    df: DataFrame, ts: str, value: str, keys: Sequence[str], every: timedelta, name: str = "total"
) -> DataFrame:
    return tumbling(df, ts, keys, every, F.sum(value).alias(name))


def sliding_mean(
    df: DataFrame, ts: str, value: str, keys: Sequence[str], every: timedelta, period: timedelta
) -> DataFrame:
    """Mean over the last ``period``, every ``every``.

    When the period is a whole number of steps, rows are first reduced to one (sum, count)
    pane per step; only panes, not rows, are copied to the windows they belong to.
    """
    present = df.filter(_present(df, value))
    if period % every:
        grouped = present.groupBy(
            F.window(ts, as_interval(period), as_interval(every)), *keys
        ).agg(F.avg(value).alias("value"))
        return grouped.select(
            *keys,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "value",
        )
    panes = tumbling(
        present, ts, keys, every, F.sum(value).alias("pane_sum"), F.count(value).alias("pane_count")
    )
    steps = period // every
    shifts = F.array(*[F.expr(f"INTERVAL {_seconds(every * step)} SECOND") for step in range(steps)])
    spread = panes.select("*", F.explode(shifts).alias("shift")).withColumn(
        "window_end", F.col("window_end") + F.col("shift")
    )
    return (
        spread.groupBy("window_end", *keys)
        .agg((F.sum("pane_sum") / F.sum("pane_count")).alias("value"))
        .select(
            *keys,
            (F.col("window_end") - F.expr(f"INTERVAL {_seconds(period)} SECOND")).alias("window_start"),
            "window_end",
            "value",
        )
    )


def _present(df: DataFrame, value: str) -> Column:
    """Neither null nor not-a-number: one NaN would spoil every window it is in."""
    known = F.col(value).isNotNull()
    return known & ~F.isnan(value) if df.schema[value].dataType.typeName() in ("double", "float") else known


def _seconds(length: timedelta) -> str:
    return f"'{length.total_seconds():.6f}'"
