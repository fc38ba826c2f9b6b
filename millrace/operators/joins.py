"""Joins to a lookup side that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import pin

BROADCAST_ROWS = 200_000


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join each fact row to the lookup row of its key.

    The lookup is computed once and counted. Up to ``broadcast_rows`` rows it is sent to
    the executors, so the facts are not shuffled at all. Beyond that it is a shuffle join,
    where adaptive execution splits partitions made large by a hot key.
    """
    lookup = pin(lookup)
    if lookup.count() <= broadcast_rows:
        lookup = F.broadcast(lookup)
    return facts.join(lookup, list(keys), how)
