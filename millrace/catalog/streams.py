"""Streaming queries. Sensor = user_id, count = whole part of value, time = ts to the millisecond."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clock import from_epoch_millis
from ..session import scratch
from ..sinks.points import read_points
from ..sinks.tables import write_lines
from ..streaming.run import (
    drain, file_writer, late_rows, replay, replay_chunks, replay_files, upsert_writer, write_replay,
)
from ..streaming.telemetry import (
    COUNT, EVENT_TIME, MILLIS, SENSOR, TOTAL, judge_messages, parse_messages, read_stream_messages, window_result_json,
    window_totals, with_watermark,
)
from .contracts import message_texts
from .registry import as_ntz, query, table

_MS = "(epoch_us(ts) // 1000)"
_BATCH_TOTALS = """
    SELECT CAST(user_id AS VARCHAR) AS sensor_id, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
           CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS vehicle_count_total
    FROM events {where} GROUP BY ALL"""
_CLOSED = f"""SELECT * FROM ({_BATCH_TOTALS.format(where='')})
    WHERE window_end <= (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 10 SECOND FROM events)"""

_AS_JSON = """
    SELECT '{"sensor_id":"' || sensor_id || '","window_start_ms":' || epoch_ms(window_start)
           || ',"window_end_ms":' || epoch_ms(window_end) || ',"vehicle_count_total":' || vehicle_count_total
           || '}' AS value FROM """


def _replayed(spark, df, path):
    """A table written and then streamed in event-time order."""
    chunks = replay_chunks(df)
    files = replay_files(df, chunks)
    write_replay(df, "ts", path, chunks, files)
    return replay(spark, path, df.schema, files)


def _replayed_texts(spark, sf, malformed):
    """Messages of all events as a stream, replayed in event-time order."""
    path = scratch(spark, "replay")
    texts = message_texts(spark, sf, malformed).select("ts", "value")
    return _replayed(spark, texts, path)


def _stored(spark, stream, label):
    """Run a stream over everything available into files; returns its table and the query."""
    target = scratch(spark, label)
    done = drain(file_writer(stream, target, scratch(spark, f"{label}-state")), spark)
    return spark.read.parquet(target), done


@query("read_stream_messages", f"""
    SELECT CAST(user_id AS VARCHAR) AS sensor_id, CAST(trunc(value) AS BIGINT) AS vehicle_count,
           {_MS} AS event_timestamp_ms FROM events""")
def _read_stream_messages(spark, sf):
    """Messages of all events in a text folder, followed as a stream and parsed strictly."""
    folder = scratch(spark, "message-texts")
    write_lines(message_texts(spark, sf, malformed=False), F.col("value"), folder)
    stream = parse_messages(read_stream_messages(spark, "text", {}, folder))
    read, _ = _stored(spark, stream.select(SENSOR, COUNT, MILLIS), "messages")
    return read


@query("window_totals_batch", _BATCH_TOTALS.format(where=""))
def _window_totals_batch(spark, sf):
    texts = message_texts(spark, sf, malformed=False)
    return as_ntz(window_totals(parse_messages(texts)), "window_start", "window_end")


@query("window_result_json", _AS_JSON + f"({_BATCH_TOTALS.format(where='')})")
def _window_result_json(spark, sf):
    return window_result_json(window_totals(parse_messages(message_texts(spark, sf, malformed=False))))


@query("stream_tumbling_sum", _CLOSED)
def _stream_tumbling_sum(spark, sf):
    """Strict messages in, 15-minute totals out once their window has closed."""
    telemetry = parse_messages(_replayed_texts(spark, sf, malformed=False))
    totals, _ = _stored(spark, window_totals(with_watermark(telemetry)), "totals")
    return as_ntz(totals, "window_start", "window_end")


@query("print_sink", _AS_JSON + f"({_CLOSED})")
def _print_sink(spark, sf):
    """The same job, with malformed-tolerant parsing, ending in JSON text lines."""
    telemetry = parse_messages(_replayed_texts(spark, sf, malformed=False), mode="drop")
    lines = window_result_json(window_totals(with_watermark(telemetry)))
    target = scratch(spark, "lines")
    drain(file_writer(lines, target, scratch(spark, "lines-state"), "text"), spark)
    return spark.read.text(target)


@query("stream_replay", f"""
    SELECT event_id, {_MS} AS event_timestamp_ms FROM events""")
def _stream_replay(spark, sf):
    path = scratch(spark, "replay")
    events = table(spark, sf, "events").select("event_id", "ts")
    copied, _ = _stored(spark, _replayed(spark, events, path), "copied")
    return copied.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias(MILLIS))


@query("stream_reject_split", """
    SELECT reject_reason, count(*) AS records FROM (
        SELECT CASE event_id % 12
            WHEN 0 THEN 'none' WHEN 10 THEN 'none' WHEN 11 THEN 'none'
            WHEN 3 THEN 'vehicle_count is missing' WHEN 4 THEN 'event_timestamp_ms is missing'
            WHEN 5 THEN 'sensor_id is empty' WHEN 6 THEN 'sensor_id is empty' WHEN 7 THEN 'message is not JSON'
            WHEN 9 THEN 'sensor_id is missing' ELSE 'vehicle_count is not an integral number' END AS reject_reason
        FROM events) GROUP BY reject_reason""")
def _stream_reject_split(spark, sf):
    """Valid and malformed messages of one stream, the latter kept with their reason."""
    judged = judge_messages(_replayed_texts(spark, sf, malformed=True))
    kept, _ = _stored(spark, judged.select("value", "reject_reason"), "judged")
    return kept.groupBy(F.coalesce("reject_reason", F.lit("none")).alias("reject_reason")).agg(
        F.count(F.lit(1)).alias("records"))


@query("late_drop", f"""
    SELECT window_end, CAST(sum(total) AS BIGINT) AS total FROM (
        SELECT time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
               sum(CAST(trunc(value) AS BIGINT)) AS total
        FROM events GROUP BY 1)
    WHERE window_end <= (SELECT max(date_trunc('millisecond', ts)) - INTERVAL 10 SECOND FROM events)
    GROUP BY window_end""")
def _late_drop(spark, sf):
    """All events in order, then all of them again, too late: no total may change."""
    path = scratch(spark, "replay")
    events = table(spark, sf, "events").select(
        F.col("ts"), F.col("value").cast("bigint").alias(COUNT))
    chunks = replay_chunks(events)
    files = replay_files(events, chunks)
    write_replay(events, "ts", path, chunks, files)
    last = events.agg(F.max("ts").alias("last")).first()["last"]
    # One marker far ahead moves the watermark past every window before the repeat arrives.
    marker = spark.createDataFrame([(last, 0)], "ts timestamp_ntz, vehicle_count bigint")
    for _ in range(2):
        marker.repartition(files).write.mode("append").parquet(path)
    closed = F.lit(last).cast("timestamp") - F.expr("INTERVAL 10 SECONDS")
    repeat = events.filter(F.window("ts", "15 minutes")["end"].cast("timestamp") <= closed)
    repeat.repartition(files).write.mode("append").parquet(path)
    stream = with_watermark(
        replay(spark, path, "ts timestamp_ntz, vehicle_count bigint", files)
        .withColumn(EVENT_TIME, from_epoch_millis(F.unix_millis(F.col("ts").cast("timestamp"))))
    )
    totals, done = _stored(
        spark, window_totals(stream.withColumn(SENSOR, F.lit("all"))), "late")
    if not late_rows(done):
        raise AssertionError("the repeated events were not dropped")
    return as_ntz(totals, "window_end").select("window_end", F.col(TOTAL).alias("total"))


@query("stream_upsert", """
    SELECT user_id, event_type, arg_max(value, ts) AS value FROM events GROUP BY ALL""")
def _stream_upsert(spark, sf):
    """Points of a stream stored twice over; each point ends with its latest value."""
    path, target = scratch(spark, "replay"), scratch(spark, "upserts")
    events = table(spark, sf, "events").select("ts", "user_id", "event_type", "value")
    chunks = replay_chunks(events)
    files = replay_files(events, chunks)
    write_replay(events, "ts", path, chunks, files)
    for _ in range(2):  # a second run from the start redelivers every batch
        stream = replay(spark, path, "ts timestamp_ntz, user_id bigint, event_type string, value double", files)
        drain(upsert_writer(stream, target, "ts", F.col("ts"), scratch(spark, "upsert-state"), "month"), spark)
    return read_points(spark, target, ["user_id", "event_type"], ["value"])
