"""Evaluating costly expressions once per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, keep: Sequence[str] = ("*",), /, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections refer to instead of repeating.

    A filter on an ordinary computed column is moved below it and evaluates the expression
    again, once per mention. A generator is a boundary the optimizer does not move filters
    across, and a one-element ``inline`` stays inside generated code.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))
