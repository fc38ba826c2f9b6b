"""Running streams: ordered replay, draining what is there, idempotent upserts."""

from __future__ import annotations

import hashlib
import math
from datetime import datetime, timedelta, timezone
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..functions.clock import instant
from ..session import SETTINGS, estimated_bytes, scratch, settings
from ..sinks.points import merge_small_writes, write_points


FILE_BYTES = 128 * 1024 * 1024
#: Bytes of a table that one chunk of a replay, and so one micro-batch, holds at about.
CHUNK_BYTES = 64 * FILE_BYTES
LEAST_CHUNKS = 4


def replay_chunks(df: DataFrame) -> int:
    """Chunks for a table of this size: they grow in number with it, not in size."""
    return max(LEAST_CHUNKS, math.ceil(estimated_bytes(df) / CHUNK_BYTES))


def replay_files(df: DataFrame, chunks: int) -> int:
    """Files per chunk that keep one file near the usual split size."""
    return max(2, math.ceil(estimated_bytes(df) / chunks / FILE_BYTES))


def write_replay(df: DataFrame, ts: str, path: str, chunks: int, files: int) -> None:
    """Cut a table into at most ``chunks`` consecutive time spans of about as many rows and append them in that order.

    A file stream reads files by age, so the folder replays in event-time order when it is
    read with ``maxFilesPerTrigger`` equal to ``files``. The table is laid out by time once;
    the bounds are quantiles of time, so a busy hour is cut as finely as its rows demand.
    Rows of one moment stay together. Each chunk reads only its own part of what was laid
    out, and is written by the whole cluster.
    """
    kind = df.schema[ts].dataType.typeName()
    sorted_once = scratch(df.sparkSession, "replay-order")
    df.repartitionByRange(chunks * files, ts).sortWithinPartitions(ts).write.parquet(sorted_once)
    laid_out = df.sparkSession.read.schema(df.schema).parquet(sorted_once)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    shares = [n / chunks for n in range(1, chunks)]
    bounds = laid_out.agg(F.percentile_approx(micros, shares, 100 * chunks)).first()[0]
    if bounds is None:
        return
    moments = [instant(datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=m), kind) for m in sorted(set(bounds))]
    for number in range(len(moments) + 1):
        span = laid_out
        if number:
            span = span.filter(F.col(ts) >= moments[number - 1])
        if number < len(moments):
            span = span.filter(F.col(ts) < moments[number])
        span.repartition(files).write.mode("append").parquet(path)


def replay(spark: SparkSession, path: str, schema: StructType | str, files: int) -> DataFrame:
    """Stream a replay folder, ``files`` files per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def start(
    writer: DataStreamWriter, spark: SparkSession, state_partitions: int | None = None
) -> StreamingQuery:
    """Start a stream with this package's state settings.

    A stream keeps the number of state partitions it first started with; without
    ``state_partitions`` it is the session's ``spark.sql.shuffle.partitions``.
    """
    wanted = {k: v for k, v in SETTINGS.items() if "stateStore" in k}
    wanted["spark.sql.streaming.numRecentProgressUpdates"] = "10000"
    if state_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    with settings(spark, wanted):
        return writer.start()


_dropped: dict[str, dict[int, int]] = {}


def _note_dropped(query: StreamingQuery) -> None:
    """Add the reports that a query still holds to what is known of it; it forgets old ones."""
    known = _dropped.setdefault(str(query.runId), {})
    for progress in query.recentProgress:
        known[progress["batchId"]] = sum(o["numRowsDroppedByWatermark"] for o in progress["stateOperators"])


def drain(writer: DataStreamWriter, spark: SparkSession, state_partitions: int | None = None) -> StreamingQuery:
    """Process everything available now, then stop; what an hourly schedule would call."""
    query = start(writer.trigger(availableNow=True), spark, state_partitions)
    while not query.awaitTermination(1):
        _note_dropped(query)
    _note_dropped(query)
    return query


def late_rows(query: StreamingQuery) -> int:
    """Records dropped because their window was already closed, over all micro-batches of a drained query.

    For one that runs on by itself, call it now and then: a query remembers 10,000 reports.
    """
    _note_dropped(query)
    return sum(_dropped[str(query.runId)].values())


def upsert_writer(
    stream: DataFrame, path: str, ts: str, order: Column, checkpoint: str, grain: str = "day", writer: str | None = None,
    identity: Sequence[str] | None = None, fields: Sequence[str] | None = None, optional: Sequence[str] | None = None,
) -> DataStreamWriter:
    """Store a stream of points. A micro-batch delivered again replaces itself.

    Batch numbers begin anew with every checkpoint, so the checkpoint names the writer unless ``writer`` does. With
    ``identity`` and ``fields``, small writes are merged in place as they add up, so folders stay few however long the
    stream runs.
    """
    name = writer or "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def store(batch: DataFrame, batch_id: int) -> None:
        write_points(batch, path, ts, batch_id, order, grain, name)
        if identity is not None and fields is not None:
            merge_small_writes(batch.sparkSession, path, ts, identity, fields, grain, optional)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def file_writer(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataStreamWriter:
    """Append closed results to files, exactly once."""
    return (
        stream.writeStream.format(fmt).outputMode("append").options(**(options or {}))
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def print_writer(stream: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Show results as text on the console."""
    return (
        stream.writeStream.format("console").outputMode("append").option("truncate", False)
        .option("checkpointLocation", checkpoint)
    )
