"""Reading a stored time series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..sinks.points import stored_points


def read_bucket(
    spark: SparkSession, path: str, ts: str, start: datetime | None = None, stop: datetime | None = None
) -> DataFrame:
    """Every record of a stored series, also overwritten ones; with one bound or both, only the partitions they touch
    are read. A write that was sent again counts once. ``sinks.points.read_points`` gives current values only."""
    return stored_points(spark, path, ts, start, stop)
