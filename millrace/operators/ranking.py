"""Orders, top-k and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import estimated_bytes, pin_as_table


TASK_BYTES = 128 * 1024 * 1024
SINGLE_TASK_ROWS = 20_000_000


def in_order(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Total order over the whole table (range-partitioned sort)."""
    return df.orderBy(*order)


def first_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps at most ``n`` rows.

    The last step sees ``n`` rows of every task. Where that would be too many for one task,
    groups of tasks are reduced to their first ``n`` in between.
    """
    tasks = estimated_bytes(df) // TASK_BYTES + 1
    if n * tasks > SINGLE_TASK_ROWS:
        groups = max(int((tasks) ** 0.5), 2)
        group = Window.partitionBy("_group").orderBy(*order)
        df = (
            df.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(groups)))
            .withColumn("_place", F.row_number().over(group))
            .filter(F.col("_place") <= n)
            .drop("_group", "_place")
        )
    return df.orderBy(*order).limit(n)


def ranked(few: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """1-based rank of an already limited table (its ``limit`` bounds the single window)."""
    return few.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def ranked_all(df: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """1-based place of every row in a total order, without a task that sees them all.

    Rows are range-partitioned and sorted once into a table; each partition is numbered by
    itself and moved up by the rows before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = pin_as_table(laid_out.withColumn("_id", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_id", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1
    return numbered.join(F.broadcast(offsets), part == F.col("_part")).select(  # one row for each partition
        *df.columns, place.alias(name))


def sequence_within(
    df: DataFrame, keys: Sequence[str], chunk: Sequence[str], order: Sequence[str | Column], name: str
) -> DataFrame:
    """1-based position of each row within its key, in ``(chunk, order)`` order.

    ``chunk`` is a coarse prefix of the order whose groups are known to be small, such as
    one split of an input file. Rows are numbered inside their chunk and moved up by the
    rows of the key in earlier chunks, so a key of any size never meets in one task.
    """
    per_chunk = df.groupBy(*keys, *chunk).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        *keys, *chunk, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys, *chunk).orderBy(*order)
    numbered = df.withColumn("_inside", F.row_number().over(inside))
    return (
        numbered.join(offsets, [*keys, *chunk])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_before", "_inside")
    )
