"""Traffic telemetry: strict JSON messages, event-time totals, and their batch twin."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import messages
from ..functions.clock import as_interval, epoch_millis, from_epoch_millis, iso_timestamp_utc
from ..functions.once import compute_once
from ..functions.text import finite_double, strip
from ..operators.contracts import fail_fast, judge, reject_split
from ..operators.windows import tumbling_sum
from ..sinks.tables import keyed_json

# Window length, tolerated lateness, message and result field names.
WINDOW = timedelta(minutes=15)
LATENESS = timedelta(seconds=10)
SENSOR = "sensor_id"
COUNT = "vehicle_count"
MILLIS = "event_timestamp_ms"
TOTAL = "vehicle_count_total"

EVENT_TIME = "event_time"


def read_stream_messages(
    spark: SparkSession, source: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    """A stream of message texts in ``value``.

    ``source="kafka"`` reads a topic from its earliest offset; ``source="text"`` or
    ``"parquet"`` follows a folder. Kafka needs its connector on the session's class path.
    """
    reader = spark.readStream.format(source).options(**options)
    if source == "kafka":
        if "startingOffsets" not in options:
            reader = reader.option("startingOffsets", "earliest")
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if source == "parquet":
        reader = reader.schema("value string")
    return reader.load(path).select("value")


def telemetry_projection(rows: DataFrame) -> DataFrame:
    """Source rows ``(record_id, read_date, atd_device_id, volume)`` as judged telemetry."""
    typed = compute_once(rows, **{
        SENSOR: F.col("atd_device_id").cast("string"),
        MILLIS: epoch_millis(iso_timestamp_utc(F.col("read_date"))),
        # Truncates toward zero; null when the number does not fit 64 bits.
        COUNT: finite_double(F.col("volume")).try_cast("bigint"),
    })
    return judge(typed, [
        (F.col(SENSOR).isNotNull(), "atd_device_id is missing"),
        (F.col(MILLIS).isNotNull(), "read_date is not an ISO timestamp"),
        (F.col(COUNT).isNotNull(), "volume is not a number"),
    ])


def telemetry_messages(valid: DataFrame) -> DataFrame:
    """``(key, value)`` messages, keyed by sensor so that one sensor stays in order."""
    return keyed_json(
        valid, F.col(SENSOR),
        **{SENSOR: F.col(SENSOR), MILLIS: F.col(MILLIS), COUNT: F.col(COUNT)},
    )


def judge_messages(texts: DataFrame, value: str = "value") -> DataFrame:
    """Strictly parse messages: every field present, whole numbers only, sensor not empty."""
    doc = F.col("_doc")
    parsed = compute_once(texts, _doc=messages.document(F.col(value)))
    kinds = compute_once(
        parsed, **{f"_{name}": messages.value_type(doc, name) for name in (SENSOR, COUNT, MILLIS)}
    )
    kind = {name: F.col(f"_{name}") for name in (SENSOR, COUNT, MILLIS)}
    typed = compute_once(kinds, **{
        SENSOR: F.when(messages.is_scalar(kind[SENSOR]), strip(messages.text(doc, SENSOR))),
        COUNT: F.when(messages.is_integral(kind[COUNT]), messages.whole(doc, COUNT)),
        MILLIS: F.when(messages.is_integral(kind[MILLIS]), messages.whole(doc, MILLIS)),
    })
    rules = [
        (doc.isNotNull(), "message is not JSON"),
        *[(messages.is_present(kind[name]), f"{name} is missing") for name in (SENSOR, COUNT, MILLIS)],
        (F.length(SENSOR) > 0, f"{SENSOR} is empty"),
        *[(F.col(name).isNotNull(), f"{name} is not an integral number") for name in (COUNT, MILLIS)],
    ]
    return judge(typed, rules).drop("_doc", *[f"_{name}" for name in kind])


def parse_messages(texts: DataFrame, value: str = "value", mode: str = "fail") -> DataFrame:
    """Typed ``(sensor_id, vehicle_count, event_timestamp_ms, event_time)``.

    ``mode="fail"`` stops the job at a malformed message; ``"drop"`` leaves it out.
    """
    judged = judge_messages(texts, value)
    kept = fail_fast(judged, F.col(value)) if mode == "fail" else reject_split(judged)[0]
    return kept.select(
        SENSOR, COUNT, MILLIS, from_epoch_millis(F.col(MILLIS)).alias(EVENT_TIME)
    )


def with_watermark(df: DataFrame, event_time: str = EVENT_TIME, lateness: timedelta = LATENESS) -> DataFrame:
    return df.withWatermark(event_time, as_interval(lateness))


def window_totals(telemetry: DataFrame, every: timedelta = WINDOW) -> DataFrame:
    """Vehicle total per sensor and window; the same plan serves a batch and a stream."""
    return tumbling_sum(telemetry, EVENT_TIME, COUNT, [SENSOR], every, TOTAL)


def window_result_json(totals: DataFrame) -> DataFrame:
    """Each total as one compact JSON text in ``value``."""
    return totals.select(
        messages.compact_json(**{
            SENSOR: F.col(SENSOR),
            "window_start_ms": epoch_millis(F.col("window_start")),
            "window_end_ms": epoch_millis(F.col("window_end")),
            TOTAL: F.col(TOTAL),
        }).alias("value")
    )
