"""Spark event logs as a table of events."""

from __future__ import annotations

import types

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.once import compute_once
from ..operators.contracts import fail_fast, judge, reject_split
from ..session import settings

# Event names of interest.
APP_START = "SparkListenerApplicationStart"
APP_END = "SparkListenerApplicationEnd"
JOB_START = "SparkListenerJobStart"
EXECUTOR_ADDED = "SparkListenerExecutorAdded"
STAGE_COMPLETED = "SparkListenerStageCompleted"
TASK_END = "SparkListenerTaskEnd"
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
SQL_UPDATE = "org.apache.spark.sql.execution.ui.SparkListenerSQLAdaptiveExecutionUpdate"
SQL_END = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"
DRIVER_UPDATES = "org.apache.spark.sql.execution.ui.SparkListenerDriverAccumUpdates"
KINDS = (
    APP_START, APP_END, JOB_START, EXECUTOR_ADDED, STAGE_COMPLETED, TASK_END, SQL_START, SQL_UPDATE, SQL_END,
    DRIVER_UPDATES,
)
COMPRESSED = ".zstd"

#: Of a task's events of one kind that are being written, so much is held in memory.
KIND_BYTES = 16 << 20
_BY_KIND = {
    "spark.sql.maxConcurrentOutputFileWriters": str(len(KINDS)), "spark.sql.variant.writeShredding.enabled": "false",
    "spark.sql.variant.inferShreddingSchema": "false",
}
_PACKED = {
    "compression": "zstd", "parquet.compression.codec.zstd.level": "5", "parquet.page.size": str(4 << 20),
    "parquet.block.size": str(KIND_BYTES),
}


def app_of(path: Column) -> Column:
    """Application a log file belongs to: its ``app_id=`` folder, else the log's own name."""
    # Looked at for every line, so patterns are left alone where a plain search says that they can't match.
    folder = F.when(F.contains(path, F.lit("/app_id=")), F.regexp_extract(path, r"/app_id=([^/]+)/", 1))
    name = F.element_at(F.split(path, "/"), -1)
    rolling = F.regexp_extract(name, r"^events_\d+_(.+?)(?:\.zstd)?(?:\.inprogress)?$", 1)
    single = F.regexp_replace(name, r"(?:\.zstd)?(?:\.inprogress)?$", "")
    return F.coalesce(F.nullif(folder, F.lit("")), F.nullif(rolling, F.lit("")), single)


def _decompress(batches):
    """Lines of compressed files with their numbers; runs in Spark's Python workers, one task a few files."""
    import io

    import pyarrow as pa
    import zstandard

    def batch(path, lines, first):
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * len(lines)), pa.array(range(first, first + len(lines)), pa.int64()),
             pa.array([line.decode("utf-8", "replace").rstrip("\r\n") for line in lines])], ["path", "line", "value"])

    for files in batches:
        for path, content in zip(files.column(0), files.column(1)):
            source = io.BytesIO(content.as_buffer())
            # A log that is still being written ends within a frame; what is complete is read.
            reader = io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True), 1 << 20)
            lines, first, size = [], 0, 0
            for line in reader:
                lines.append(line)
                size += len(line)
                if size > 4 << 20:
                    yield batch(path.as_py(), lines, first)
                    lines, first, size = [], first + len(lines), 0
            if lines:
                yield batch(path.as_py(), lines, first)


def _block(path: Column, start: Column) -> Column:
    part = F.coalesce(F.when(F.contains(path, F.lit("/events_")), F.regexp_extract(
        path, r"/events_(\d+)_[^/]*$", 1).try_cast("bigint")), F.lit(0))
    return F.struct(part.alias("part"), path.alias("file"), start.alias("start")).alias("block")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(app_id, block, line, value)`` of plain and compressed logs below a path."""
    file_path = F.col("_metadata.file_path")
    lines = (
        spark.read.option("recursiveFileLookup", True).text(path)
        .filter(~(F.endswith(file_path, F.lit(COMPRESSED)) | F.endswith(file_path, F.lit(COMPRESSED + ".inprogress"))))
        .select(
            app_of(file_path).alias("app_id"), _block(file_path, F.col("_metadata.file_block_start")),
            F.monotonically_increasing_id().alias("line"), "value",
        )
    )
    packed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", f"*{COMPRESSED}{{,.inprogress}}").load(path)
    if packed.select("path").isEmpty():
        return lines
    # The worker gets the function itself, so the package need not be installed there.
    unpack = types.FunctionType(_decompress.__code__, {"__builtins__": __builtins__}, "unpack")
    unpacked = packed.select("path", "content").mapInArrow(unpack, "path string, line bigint, value string")
    return lines.unionByName(unpacked.select(
        app_of(F.col("path")).alias("app_id"), _block(F.col("path"), F.lit(0).cast("bigint")), "line", "value"))


def judge_event_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of event logs, parsed, with its position and ``reject_reason`` where it is no event.

    Plain logs are split by Spark. Logs compressed with zstd, Spark's default, are taken whole, each by one task that
    decompresses it as a stream; rolled logs keep such a file near ``spark.eventLog.rolling.maxFileSize``.
    """
    # Each in a step of its own: the filters on what comes of it would parse the line again.
    parsed = compute_once(_lines(spark, path), ["app_id", "block", "line"], body=F.try_parse_json("value"))
    lines = compute_once(parsed, event=F.try_variant_get("body", "$.Event", "string"))
    return judge(lines, [
        (F.col("body").isNotNull(), "line is not JSON (truncated, or a compressed log read as text)"),
        (F.col("event").isNotNull(), "line has no event name"),
    ])


def read_event_log(spark: SparkSession, path: str, mode: str = "fail") -> DataFrame:
    """``(app_id, block, line, event, body)``, one row per event of interest.

    ``path`` may name one log, a folder of logs or a glob. ``(block, line)`` sorts in log
    order: the block is one split of one file, so it never holds more than the split size.
    A line that is no event stops the job with its position; ``mode="drop"`` leaves such
    lines out, for logs that are still being written. ``judge_event_lines`` gives both sides.
    """
    judged = judge_event_lines(spark, path)
    if mode == "fail":
        events = fail_fast(judged, F.to_json(F.struct("block", "line")))
    elif mode == "drop":
        events, _ = reject_split(judged)
    else:
        raise ValueError(f"mode is 'drop' or 'fail', not {mode!r}")
    return events.filter(F.col("event").isin(*KINDS))


def store_event_log(log: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Keep parsed events by kind, so that each report reads only the kinds it needs.

    Bodies are neither shuffled nor sorted: a task has one file open for each kind, of which there are few. They are
    kept whole, as taking them apart into columns costs more time than parsing them.
    """
    with settings(log.sparkSession, _BY_KIND):
        log.write.mode(mode).partitionBy("event").options(**_PACKED).parquet(path)


def open_event_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("app_id", "block", "line", "event", "body")
