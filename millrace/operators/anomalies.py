"""Population statistics and readings outside a band around the mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_finite
from .joins import join_lookup


def field_stats(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation per key, both from one aggregate."""
    return df.filter(is_finite(F.col(value))).groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation")
    )


def outside(value: Column, low: Column, high: Column) -> Column:
    """Strictly above ``high`` or strictly below ``low``."""
    return (value > high) | (value < low)


def two_sigma_anomalies(
    df: DataFrame, value: str, keys: Sequence[str] = (), width: float = 2.0
) -> DataFrame:
    """Rows more than ``width`` population deviations from the mean, with mean and deviation.

    Two passes over the input, one to aggregate and one to filter; no window over the
    whole table. Without keys the statistics are a single row, read once and put into the
    filter as constants, which the scan can then use to skip row groups.
    """
    finite = df.filter(is_finite(F.col(value)))
    reach = width * F.col("deviation")
    stats = field_stats(df, value, keys).select(
        *keys, "mean", "deviation", (F.col("mean") - reach).alias("_low"), (F.col("mean") + reach).alias("_high")
    )
    if keys:
        judged = join_lookup(finite, stats, keys)
        kept = judged.filter(outside(F.col(value), F.col("_low"), F.col("_high")))
        return kept.drop("_low", "_high")
    mean, deviation, low, high = (F.lit(number).cast("double") for number in stats.first())
    return finite.filter(outside(F.col(value), low, high)).withColumns({"mean": mean, "deviation": deviation})
