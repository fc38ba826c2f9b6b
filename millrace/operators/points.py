"""Selecting and resolving time-series points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.clock import instant

# Columns a stored series may be partitioned by: the first day of the span a point is in.
SPANS = {"day": "span_day", "month": "span_month", "year": "span_year"}


def span_of(ts: Column, grain: str) -> Column:
    return F.to_date(F.date_trunc(grain, ts))


def _utc_day(moment: datetime) -> date:
    """The date in UTC; a moment without a zone is UTC already."""
    return (moment.astimezone(timezone.utc) if moment.tzinfo else moment).date()


def _within_spans(df: DataFrame, start: datetime | None, stop: datetime | None = None) -> DataFrame:
    """On a partitioned series, keep only the partitions the range touches."""
    for grain, name in SPANS.items():
        if name in df.columns:
            if start is not None:
                df = df.filter(F.col(name) >= F.lit(_first_day(start, grain)))
            if stop is not None:
                df = df.filter(F.col(name) <= F.lit(_utc_day(stop)))
    return df


def _first_day(moment: datetime, grain: str) -> date:
    first = _utc_day(moment)
    if grain != "day":
        first = first.replace(day=1)
    return first.replace(month=1) if grain == "year" else first


def time_range(df: DataFrame, ts: str, start: datetime | None = None, stop: datetime | None = None) -> DataFrame:
    """Half-open ``[start, stop)``; either bound may be missing. On a partitioned series, whole spans are pruned too."""
    kind = df.schema[ts].dataType.typeName()
    if start is not None:
        df = df.filter(F.col(ts) >= instant(start, kind))
    if stop is not None:
        df = df.filter(F.col(ts) < instant(stop, kind))
    return _within_spans(df, start, stop)


def relative_range(df: DataFrame, ts: str, every: timedelta, as_of: datetime) -> DataFrame:
    """``[as_of - every, as_of)``; the scheduler's tick is passed in, never read from a clock."""
    return time_range(df, ts, as_of - every, as_of)


def series_filter(df: DataFrame, tags: Mapping[str, Any], field: str, keep: Sequence[str]) -> DataFrame:
    """Rows whose tags all match and that carry ``field``, with only the columns needed."""
    matched = df
    for name, wanted in tags.items():
        matched = matched.filter(F.col(name) == F.lit(wanted))
    return matched.filter(F.col(field).isNotNull()).select(*keep, field)


def unpivot_fields(df: DataFrame, tags: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Wide points as ``(tags, field, value)`` rows; absent fields give no row."""
    return df.unpivot(list(tags), list(fields), "field", "value").filter(F.col("value").isNotNull())


def latest_point(
    df: DataFrame,
    identity: Sequence[str],
    fields: Sequence[str],
    order: Sequence[str | Column],
    optional: Sequence[str] | None = None,
) -> DataFrame:
    """Last write wins per identity, field by field.

    A later write that omits an ``optional`` field (null) leaves the earlier value in place.
    All fields are optional unless told otherwise; fields every write carries are resolved
    together. The result is an ordinary partial-then-final aggregate, so an identity written
    very often is reduced before the shuffle. With an order of fixed width, fields of fixed
    width are aggregated by hash; other fields sort.
    """
    optional = list(fields) if optional is None else list(optional)
    always = [name for name in fields if name not in optional]
    place = F.struct(*order) if len(order) > 1 else F.col(order[0]) if isinstance(order[0], str) else order[0]
    kinds = {f.name: f.dataType for f in df.select(*fields, place.alias("_place")).schema}
    fixed = _fixed_width(kinds["_place"])
    # Records with equal order give the same record for every field: they are met in the same sequence.
    alone = [name for name in always if fixed and _fixed_width(kinds[name])]
    together = [name for name in always if name not in alone]
    newest = [F.max_by(F.struct(*together), place).alias("_newest")] if together else []
    single = [F.max_by(name, place).alias(name) for name in alone]
    kept = [F.max_by(F.col(name), F.when(F.col(name).isNotNull(), place)).alias(name) for name in optional]
    resolved = df.groupBy(*identity).agg(*newest, *single, *kept)
    return resolved.select(
        *identity,
        *[F.col(f"_newest.{name}").alias(name) if name in together else F.col(name) for name in fields],
    )


def _fixed_width(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def distinct_points(df: DataFrame, identity: Sequence[str]) -> DataFrame:
    return df.select(*identity).distinct()


def retain(df: DataFrame, ts: str, keep: timedelta, as_of: datetime) -> DataFrame:
    """Rows not older than ``as_of - keep``; a zero duration keeps everything."""
    if not keep:
        return df
    cut = as_of - keep
    kind = df.schema[ts].dataType.typeName()
    return _within_spans(df.filter(F.col(ts) >= instant(cut, kind)), cut)
