"""Timestamps: parsing to UTC instants, epoch milliseconds and interval helpers."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

# Accepted layouts of a timestamp with a UTC offset.
OFFSET_LAYOUTS = (
    "yyyy-M-d H:m:s.SSSSSS xx",
    "yyyy-M-d H:m:s.SSSSSS xxx",
    "yyyy-M-d H:m:s.SSSSSS X",
)

_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
_ISO_LOCAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:[.]\d{1,9})?)?$"
_ISO_ZONED = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:[.]\d{1,9})?)?(?:Z|[+-]\d{2}:?\d{2})$"
)


def offset_timestamp_utc(text: Column) -> Column:
    """``2006-04-01 00:00:00.000 +0200`` as an instant; null when it does not parse."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in OFFSET_LAYOUTS])


def iso_timestamp_utc(text: Column) -> Column:
    """ISO-8601 as an instant; ``Z`` accepted, no offset means UTC, null when malformed."""
    # Spark's cast wants seconds.
    text = F.regexp_replace(text, r"^(.{10}[T ]\d{2}:\d{2})(?=Z|[+-]|$)", "$1:00")
    zoned = (
        F.when(text.rlike(_ISO_ZONED), text)
        .when(text.rlike(_ISO_LOCAL), F.concat(text, F.lit("Z")))
        .when(text.rlike(_ISO_DATE), F.concat(text, F.lit("T00:00:00Z")))
    )
    return zoned.try_cast("timestamp")


def epoch_millis(instant: Column) -> Column:
    return F.unix_millis(instant.cast("timestamp"))


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def as_interval(length: timedelta) -> str:
    """A duration in the form Spark's window and watermark functions read."""
    return f"{length // timedelta(microseconds=1)} microseconds"


def interval(length: timedelta) -> Column:
    return F.expr(f"INTERVAL '{length.total_seconds():.6f}' SECOND")


def instant(moment: datetime, like: str) -> Column:
    """A literal of ``moment`` in the column type ``like`` (timestamp or timestamp_ntz)."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    if like == "timestamp_ntz":
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(moment.isoformat(sep=" ") + "Z").cast("timestamp")
