"""Time-series queries. Measurement = events, tag = event_type, field = value, time = ts."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ..functions.clock import epoch_millis
from ..operators.anomalies import field_stats, outside, two_sigma_anomalies
from ..operators.points import (
    distinct_points, latest_point, relative_range, retain, series_filter, time_range, unpivot_fields,
)
from ..operators.windows import sliding_mean, tumbling_mean, tumbling_sum
from ..plans.timeseries import downsample, downsample_stream, downsample_task, measured_write, read_downsampled
from ..session import scratch
from ..sinks.points import (
    FANOUT, compact_points, merge_small_writes, read_points, retain_in_place, write_points, writes,
)
from ..sources.points import read_bucket
from ..streaming.run import drain, replay, replay_chunks, replay_files, write_replay
from .registry import as_ntz, query, rounded, table

WEEK = (datetime(2024, 1, 8), datetime(2024, 1, 15))
TICK = datetime(2024, 1, 20, 12)
QUARTER, HOUR, KEEP = timedelta(minutes=15), timedelta(hours=1), timedelta(hours=240)
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]

_WEEK_SQL = "ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'"


@query("time_range", f"SELECT event_id, ts, value FROM events WHERE {_WEEK_SQL}")
def _time_range(spark, sf):
    return time_range(table(spark, sf, "events"), "ts", *WEEK).select("event_id", "ts", "value")


@query("relative_range", """
    SELECT event_id, ts, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 11:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'""")
def _relative_range(spark, sf):
    return relative_range(table(spark, sf, "events"), "ts", HOUR, TICK).select("event_id", "ts", "value")


@query("series_filter", f"SELECT ts, value FROM events WHERE {_WEEK_SQL} AND event_type = 'view' AND value IS NOT NULL")
def _series_filter(spark, sf):
    ranged = time_range(table(spark, sf, "events"), "ts", *WEEK)
    return series_filter(ranged, {"event_type": "view"}, "value", ["ts"])


@query("band_filter", "SELECT event_id, value FROM events WHERE value > 150 OR value < 1")
def _band_filter(spark, sf):
    events = table(spark, sf, "events")
    return events.filter(outside(F.col("value"), F.lit(1.0), F.lit(150.0))).select("event_id", "value")


@query("read_bucket", f"SELECT event_id, ts, event_type, value FROM events WHERE {_WEEK_SQL}")
def _read_bucket(spark, sf):
    path = scratch(spark, "bucket")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    write_points(events, path, "ts", 0, F.col("event_id"))
    return read_bucket(spark, path, "ts", *WEEK).select("event_id", "ts", "event_type", "value")


def _nudged(means):
    """Means of values with two decimals can lie exactly between two roundings, where engines differ."""
    return means.withColumn("value", F.col("value") + F.lit(1e-10))


@query("sliding_mean", """
    SELECT event_type, w - INTERVAL 1 HOUR AS window_start, w AS window_end, round(avg(value) + 1e-10, 8) AS value
    FROM (SELECT event_type, value,
                 time_bucket(INTERVAL 15 MINUTE, ts) + CAST(i + 1 AS INTEGER) * INTERVAL 15 MINUTE AS w
          FROM events, range(4) AS steps(i))
    GROUP BY event_type, w""")
def _sliding_mean(spark, sf):
    means = sliding_mean(table(spark, sf, "events"), "ts", "value", ["event_type"], QUARTER, HOUR)
    return rounded(_nudged(means), 8, "value")


@query("sliding_mean_all", """
    SELECT w - INTERVAL 1 HOUR AS window_start, w AS window_end, round(avg(value) + 1e-10, 8) AS value
    FROM (SELECT value, time_bucket(INTERVAL 15 MINUTE, ts) + CAST(i + 1 AS INTEGER) * INTERVAL 15 MINUTE AS w
          FROM events, range(4) AS steps(i))
    GROUP BY w""")
def _sliding_mean_all(spark, sf):
    means = sliding_mean(table(spark, sf, "events"), "ts", "value", [], QUARTER, HOUR)
    return rounded(_nudged(means), 8, "value")


@query("tumbling_mean", """
    SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, round(avg(value), 8) AS value
    FROM events GROUP BY ALL""")
def _tumbling_mean(spark, sf):
    return rounded(tumbling_mean(table(spark, sf, "events"), "ts", "value", ["event_type"], HOUR), 8, "value")


@query("tumbling_sum", """
    SELECT user_id, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
           CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS total
    FROM events GROUP BY ALL""")
def _tumbling_sum(spark, sf):
    counted = table(spark, sf, "events").select("user_id", "ts", F.col("value").cast("bigint").alias("vehicles"))
    return tumbling_sum(counted, "ts", "vehicles", ["user_id"], QUARTER)


@query("field_stats", """
    SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS deviation
    FROM events GROUP BY event_type""")
def _field_stats(spark, sf):
    return rounded(field_stats(table(spark, sf, "events"), "value", ["event_type"]), 6, "mean", "deviation")


@query("regroup_field_stats", f"""
    SELECT field, round(avg(value), 5) AS mean, round(stddev_pop(value), 5) AS deviation
    FROM (UNPIVOT (SELECT {', '.join(MEASURES)} FROM lineitem) ON {', '.join(MEASURES)} INTO NAME field VALUE value)
    GROUP BY field""")
def _regroup(spark, sf):
    long = unpivot_fields(table(spark, sf, "lineitem"), ["l_returnflag"], MEASURES)
    return rounded(field_stats(long, "value", ["field"]), 5, "mean", "deviation")


_BAND = """
    SELECT e.event_id, e.ts, e.event_type, e.value, round(s.mean, 6) AS mean, round(s.deviation, 6) AS deviation
    FROM events e JOIN (SELECT {key} avg(value) AS mean, stddev_pop(value) AS deviation FROM events {group}) s
    ON {match}
    WHERE e.value > s.mean + 2 * s.deviation OR e.value < s.mean - 2 * s.deviation"""
_ANOMALY = ["event_id", "ts", "event_type", "value", "mean", "deviation"]


@query("two_sigma_anomalies", _BAND.format(key="", group="", match="true"))
def _two_sigma(spark, sf):
    found = two_sigma_anomalies(table(spark, sf, "events").select(*_ANOMALY[:4]), "value")
    return rounded(found.select(*_ANOMALY), 6, "mean", "deviation")


@query("two_sigma_by_type", _BAND.format(
    key="event_type,", group="GROUP BY event_type", match="e.event_type = s.event_type"))
def _two_sigma_by_type(spark, sf):
    found = two_sigma_anomalies(table(spark, sf, "events").select(*_ANOMALY[:4]), "value", ["event_type"])
    return rounded(found.select(*_ANOMALY), 6, "mean", "deviation")


@query("unpivot_fields", f"""
    SELECT l_orderkey, l_linenumber, field, value
    FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, {', '.join(MEASURES)} FROM lineitem)
          ON {', '.join(MEASURES)} INTO NAME field VALUE value)""")
def _unpivot(spark, sf):
    return unpivot_fields(table(spark, sf, "lineitem"), LINE, MEASURES)


_LATEST = f"""
    SELECT l_orderkey, l_linenumber, {{fields}} FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) AS n
        FROM lineitem) WHERE n = 1"""


@query("latest_point", _LATEST.format(fields="l_quantity, l_extendedprice, l_shipdate"))
def _latest_point(spark, sf):
    return latest_point(
        table(spark, sf, "lineitem"), LINE, ["l_quantity", "l_extendedprice", "l_shipdate"], LINE_ORDER,
        optional=(),
    )


@query("latest_point_partial", """
    SELECT user_id, event_type, arg_max(value, ts) AS value,
           arg_max(CASE WHEN value >= 50 THEN props END, ts) FILTER (WHERE value >= 50) AS props
    FROM events GROUP BY ALL""")
def _latest_point_partial(spark, sf):
    events = table(spark, sf, "events").withColumn("props", F.when(F.col("value") >= 50, F.col("props")))
    return latest_point(events, ["user_id", "event_type"], ["value", "props"], ["ts"])


@query("distinct_points", "SELECT count(*) AS points FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def _distinct_points(spark, sf):
    return distinct_points(table(spark, sf, "lineitem"), LINE).agg(F.count(F.lit(1)).alias("points"))


@query("retention", """
    SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 240 HOUR""")
def _retention(spark, sf):
    return retain(table(spark, sf, "events"), "ts", KEEP, datetime(2024, 1, 30, 23)).select("event_id", "ts")


@query("downsample", """
    SELECT event_type, TIMESTAMP '2024-01-20 11:00:00' AS window_start,
           TIMESTAMP '2024-01-20 12:00:00' AS window_end, round(avg(value), 8) AS value
    FROM events WHERE ts >= TIMESTAMP '2024-01-20 11:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'
    GROUP BY event_type""")
def _downsample(spark, sf):
    return rounded(downsample(table(spark, sf, "events"), "ts", "value", ["event_type"], TICK), 8, "value")


@query("downsample_task", """
    SELECT event_type, TIMESTAMP '2024-01-20 11:00:00' AS window_start,
           TIMESTAMP '2024-01-20 12:00:00' AS window_end, round(avg(value), 8) AS value
    FROM events WHERE ts >= TIMESTAMP '2024-01-20 11:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'
    GROUP BY event_type""")
def _downsample_task(spark, sf):
    target = scratch(spark, "hourly")
    for _ in range(2):  # the second run of a tick must not add anything
        downsample_task(table(spark, sf, "events"), "ts", "value", ["event_type"], TICK, target)
    stored = read_points(spark, target, ["event_type", "window_end"], ["window_start", "value"])
    return rounded(stored.select("event_type", "window_start", "window_end", "value"), 8, "value")


_FIELDS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _append_by_flag(spark, sf, path):
    """Three appends (one per return flag), the middle one sent twice."""
    lines = table(spark, sf, "lineitem")
    for batch, flag in ((0, "A"), (1, "N"), (1, "N"), (2, "R")):
        part = lines.filter(F.col("l_returnflag") == flag)
        write_points(part.select(*LINE, "l_shipdate", *_FIELDS), path, "l_shipdate", batch, _line_order(), "year")


def _line_order():
    """Ship date, part, supplier, quantity and price as one number that sorts as they do."""
    digits = ((F.unix_date(F.col("l_shipdate").cast("date")), 5), (F.col("l_partkey"), 7), (F.col("l_suppkey"), 4),
              (F.col("l_quantity"), 2), (F.round(F.col("l_extendedprice") * 100), 9))
    place, total = 0, F.lit(0).cast("decimal(27,0)")
    for value, width in reversed(digits):
        total = total + value.cast("decimal(9,0)") * F.lit("1" + "0" * place).cast("decimal(24,0)")
        place += width
    return total.cast("decimal(27,0)")


_UPSERT = f"""
    SELECT l_orderkey, l_linenumber, {', '.join(_FIELDS)} FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_returnflag DESC, l_shipdate DESC, {', '.join(c + ' DESC' for c in _FIELDS)}) AS n
        FROM lineitem {{where}}) WHERE n = 1"""


@query("upsert_sink", _UPSERT.format(where=""))
def _upsert_sink(spark, sf):
    path = scratch(spark, "points")
    _append_by_flag(spark, sf, path)
    return read_points(spark, path, LINE, _FIELDS, optional=())


@query("retention_compact", _UPSERT.format(where="WHERE l_shipdate >= TIMESTAMP '2000-01-01'"))
def _retention_compact(spark, sf):
    path, kept = scratch(spark, "points"), scratch(spark, "kept")
    _append_by_flag(spark, sf, path)
    compact_points(spark, path, kept, "l_shipdate", LINE, ["l_shipdate", *_FIELDS],
                   timedelta(hours=24), datetime(2000, 1, 2), "year")
    return read_points(spark, kept, LINE, _FIELDS)


@query("read_points_range", f"""
    SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_extendedprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber, l_shipdate
            ORDER BY l_returnflag DESC, l_shipdate DESC, {', '.join(c + ' DESC' for c in _FIELDS)}) AS n
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-03-01' AND l_shipdate < TIMESTAMP '1997-02-01') WHERE n = 1""")
def _read_points_range(spark, sf):
    """Current points of a time range: other years are not read."""
    path = scratch(spark, "points")
    _append_by_flag(spark, sf, path)
    return read_points(spark, path, [*LINE, "l_shipdate"], ["l_quantity", "l_extendedprice"], optional=(),
                       ts="l_shipdate", start=datetime(1996, 3, 1), stop=datetime(1997, 2, 1))


@query("read_bucket_since", "SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-25'")
def _read_bucket_since(spark, sf):
    """One bound only; the write was sent twice."""
    path = scratch(spark, "bucket")
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    for _ in range(2):
        write_points(events, path, "ts", 0, F.col("event_id"))
    return read_bucket(spark, path, "ts", start=datetime(2024, 1, 25)).select("event_id", "ts", "value")


@query("upsert_after_compaction", """
    SELECT user_id, event_type, arg_max(value, (part, event_id)) AS value
    FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS part FROM events) GROUP BY ALL""")
def _upsert_after_compaction(spark, sf):
    """A store is compacted; then other writers, whose batches begin at 0 as well, add to it."""
    path, kept = scratch(spark, "points"), scratch(spark, "compacted")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    identity = ["user_id", "event_type"]
    write_points(events.filter("event_id % 3 <> 0"), path, "ts", 0, F.col("event_id"))
    compact_points(spark, path, kept, "ts", identity, ["event_id", "ts", "value"], timedelta(0), TICK)
    for number in (0, 1):
        part = events.filter(F.col("event_id") % 3 == 0).filter(F.col("event_id") % 2 == number)
        write_points(part, kept, "ts", 0, F.col("event_id"), writer=f"part-{number}")
    # Both parts come after the compaction; between them, the larger event wins.
    both = read_bucket(spark, kept, "ts").withColumn(
        "place", F.when(F.col("ingest_writer") == "compaction", F.lit(-1)).otherwise(F.col("event_id")))
    return latest_point(both, identity, ["value"], ["place"], optional=())


_TICKS = [TICK + HOUR * n for n in (0, 1, 2, 1, 5)]  # one of them twice


@query("downsample_ticks", """
    SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, round(avg(value), 8) AS value
    FROM events
    WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR IN (
        TIMESTAMP '2024-01-20 13:00:00', TIMESTAMP '2024-01-20 14:00:00', TIMESTAMP '2024-01-20 17:00:00')
    GROUP BY ALL""")
def _downsample_ticks(spark, sf):
    """Several ticks, one run twice; the first has left retention when they are read back."""
    target = scratch(spark, "hourly")
    for tick in _TICKS:
        downsample_task(table(spark, sf, "events"), "ts", "value", ["event_type"], tick, target)
    kept = read_downsampled(spark, target, ["event_type"], TICK + HOUR * 5, keep=HOUR * 4)
    return rounded(kept, 8, "value")


@query("downsample_schedule", """
    SELECT event_type, window_start, window_end, round(value, 8) AS value FROM (
        SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
               time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, avg(value) AS value
        FROM events GROUP BY ALL)
    WHERE window_end <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events)""")
def _downsample_schedule(spark, sf):
    """Hourly means by a stream that a scheduler starts twice; the second run finds nothing new."""
    path, target, state = scratch(spark, "replay"), scratch(spark, "hourly"), scratch(spark, "downsample-state")
    events = table(spark, sf, "events").select("ts", "event_type", "value")
    chunks = replay_chunks(events)
    files = replay_files(events, chunks)
    write_replay(events, "ts", path, chunks, files)
    for _ in range(2):
        stream = replay(spark, path, "ts timestamp_ntz, event_type string, value double", files).withColumn(
            "ts", F.col("ts").cast("timestamp"))
        drain(downsample_stream(stream, "ts", "value", ["event_type"], target, state), spark)
    means = read_points(spark, target, ["event_type", "window_end"], ["window_start", "value"], optional=())
    return rounded(as_ntz(means, "window_start", "window_end"), 8, "value").select(
        "event_type", "window_start", "window_end", "value")


@query("retention_in_place", """
    SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 36 HOUR""")
def _retention_in_place(spark, sf):
    """A store of many writes ends what is older than 36 hours, in place."""
    path = scratch(spark, "bucket")
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    for part in range(4):
        first = date(2024, 1, 1) + timedelta(days=8 * part)
        days = events.filter(F.col("ts").cast("date").between(F.lit(first), F.lit(first + timedelta(days=7))))
        write_points(days, path, "ts", part, F.col("event_id"))
    retain_in_place(spark, path, "ts", timedelta(hours=36), TICK)
    return read_bucket(spark, path, "ts").select("event_id", "ts", "value")


@query("merged_writes", """
    SELECT user_id, event_type, arg_max(value, (event_id % 40, event_id)) AS value FROM events GROUP BY ALL""")
def _merged_writes(spark, sf):
    """Forty small writes leave a few folders; each point still ends with the value of its last write."""
    path = scratch(spark, "points")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    identity = ["user_id", "event_type"]
    for number in range(40):
        write_points(events.filter(F.col("event_id") % 40 == number), path, "ts", number, F.col("event_id"), "month")
        merge_small_writes(spark, path, "ts", identity, ["ts", "value"], "month", optional=())
    if len(writes(spark, path)) > 2 + FANOUT:
        raise AssertionError("small writes were not merged")
    return read_points(spark, path, identity, ["value"], optional=())


@query("throughput_rows", "SELECT count(*) AS rows FROM events")
def _throughput(spark, sf):
    path = scratch(spark, "measured")
    report = measured_write(table(spark, sf, "events"), lambda df: df.write.parquet(path))
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored")).select(
        F.when(F.col("stored") == report["rows"], F.col("stored")).alias("rows")
    )


@query("epoch_window_bounds", """
    SELECT user_id, epoch_ms(time_bucket(INTERVAL 15 MINUTE, ts)) AS window_start_ms,
           epoch_ms(time_bucket(INTERVAL 15 MINUTE, ts)) + 900000 AS window_end_ms, count(*) AS readings
    FROM events GROUP BY ALL""")
def _epoch_window_bounds(spark, sf):
    from ..operators.windows import tumbling

    windows = tumbling(table(spark, sf, "events"), "ts", ["user_id"], QUARTER, F.count(F.lit(1)).alias("readings"))
    return windows.select(
        "user_id", epoch_millis(F.col("window_start")).alias("window_start_ms"),
        epoch_millis(F.col("window_end")).alias("window_end_ms"), "readings",
    )
