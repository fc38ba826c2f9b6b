"""Complete time-series jobs: ingest, scheduled downsampling, throughput."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone
from time import perf_counter

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.contracts import ContractError, counted
from ..operators.points import relative_range
from ..operators.windows import tumbling_mean
from ..sinks.points import merge_small_writes, read_points, write_points
from ..sources.files import POSITION, with_position_number
from ..sources.weather import read_weather
from ..streaming.run import upsert_writer

# How often the downsampling job runs, how long its results are kept.
EVERY = timedelta(hours=1)
KEEP = timedelta(hours=720)
DELAY = "10 seconds"
DOWNSAMPLED = ["window_start", "value"]


def measured_write(df: DataFrame, write: Callable[[DataFrame], None], name: str = "ingest") -> dict:
    """Run a write and report rows, seconds and rows per second, counted as they pass."""
    watched, seen = counted(df, name)
    began = perf_counter()
    write(watched)
    seconds = perf_counter() - began
    rows = seen.get["rows"]
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds else None}


def ingest_weather(
    spark: SparkSession, csv_path: str, bucket: str, batch: int, expected: int | None = None, writer: str = "weather"
) -> dict:
    """Check, type and store a weather CSV; its count is a gate after the write.

    ``writer`` and ``batch`` name the write: sent again it replaces itself, and nothing else.
    """
    points = read_weather(spark, csv_path)
    numbered = with_position_number(points, csv_path)
    report = measured_write(
        numbered, lambda df: write_points(df, bucket, "time", batch, F.col(POSITION), writer=writer)
    )
    if expected is not None and report["rows"] != expected:
        raise ContractError(f"found {report['rows']} rows; expected {expected}")
    return report


def downsample(
    df: DataFrame, ts: str, value: str, keys: Sequence[str], as_of: datetime, every: timedelta = EVERY
) -> DataFrame:
    """Means of the last ``every`` before ``as_of``. Backfilling is calling it per tick."""
    return tumbling_mean(relative_range(df, ts, every, as_of), ts, value, keys, every)


def downsample_task(
    df: DataFrame, ts: str, value: str, keys: Sequence[str], as_of: datetime, target: str,
    every: timedelta = EVERY,
) -> None:
    """One scheduled run: downsample and store under the tick, so a re-run replaces itself and no other run.

    ``as_of`` is a multiple of ``every`` in UTC (a moment without a zone is UTC), so windows are never cut in half.
    """
    moment = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    since = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    if since % every:
        raise ValueError(f"{as_of} is not on a multiple of {every}")
    write_points(
        downsample(df, ts, value, keys, as_of, every), target, "window_end", since // timedelta(microseconds=1), F.lit(0),
        writer="downsample",
    )
    merge_small_writes(df.sparkSession, target, "window_end", [*keys, "window_end"], DOWNSAMPLED, optional=())


def downsample_stream(
    stream: DataFrame, ts: str, value: str, keys: Sequence[str], target: str, checkpoint: str, every: timedelta = EVERY,
    delay: str = DELAY,
) -> DataStreamWriter:
    """The same means kept up to date by a stream: each window is stored once, when the watermark has passed its end.

    Start it with ``trigger(availableNow=True)`` from a scheduler, or with a processing-time trigger to keep it running.
    A run with nothing new stores nothing; a micro-batch delivered again replaces itself. ``ts`` is a timestamp.
    """
    means = tumbling_mean(stream.withWatermark(ts, delay), ts, value, keys, every)
    return upsert_writer(means, target, "window_end", F.lit(0), checkpoint, identity=[*keys, "window_end"],
                         fields=DOWNSAMPLED, optional=()).outputMode("append")


def read_downsampled(
    spark: SparkSession, target: str, keys: Sequence[str], as_of: datetime, keep: timedelta = KEEP
) -> DataFrame:
    """Stored means that are within retention: keys, window_start, window_end, value."""
    return read_points(
        spark, target, [*keys, "window_end"], ["window_start", "value"], optional=(), ts="window_end", keep=keep,
        as_of=as_of,
    ).select(*keys, "window_start", "window_end", "value")
