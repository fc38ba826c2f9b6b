"""Data contracts: per-record rules, quarantine or fail-fast, and whole-table gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

REASON = "reject_reason"


class ContractError(RuntimeError):
    """A gate over a whole table did not hold."""


def first_failure(rules: Sequence[tuple[Column, str | Column]]) -> Column:
    """Reason of the first rule that does not hold, null when all hold.

    A rule that evaluates to null counts as failed.
    """
    return F.coalesce(*[
        F.when(~F.coalesce(ok, F.lit(False)), reason if isinstance(reason, Column) else F.lit(reason))
        for ok, reason in rules
    ])


def judge(df: DataFrame, rules: Sequence[tuple[Column, str | Column]]) -> DataFrame:
    """Add ``reject_reason``, so that one pass feeds both sides of a split."""
    return df.withColumn(REASON, first_failure(rules))


def reject_split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); every record is in exactly one of them."""
    valid = judged.filter(F.col(REASON).isNull()).drop(REASON)
    rejected = judged.filter(F.col(REASON).isNotNull())
    return valid, rejected


def fail_fast(judged: DataFrame, position: Column) -> DataFrame:
    """Valid records only; the first malformed one met stops the job with its position."""
    message = F.concat_ws(": ", position.cast("string"), F.col(REASON))
    holds = F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return judged.filter(holds).drop(REASON)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action (a write) runs, instead of in a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def count_report(df: DataFrame, expected: int, check: str) -> DataFrame:
    """One row ``(check, observed, expected, ok)``."""
    return df.agg(F.count(F.lit(1)).alias("observed")).select(
        F.lit(check).alias("check"),
        "observed",
        F.lit(expected).cast("bigint").alias("expected"),
        (F.col("observed") == expected).alias("ok"),
    )


def expect_count(df: DataFrame, expected: int, what: str = "rows") -> int:
    observed = df.count()
    if observed != expected:
        raise ContractError(f"found {observed} {what}; expected {expected}")
    return observed


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def expect_unique(df: DataFrame, keys: Sequence[str]) -> None:
    broken = duplicates(df, keys).take(1)
    if broken:
        raise ContractError(f"key {tuple(keys)} is not unique, for example {broken[0].asDict()}")


def shape_report(df: DataFrame, integers: Sequence[str], expected: int) -> DataFrame:
    """One row telling whether all named text cells are integers and the count is right."""
    from ..functions.text import whole_number

    all_whole = F.lit(True)
    for name in integers:
        all_whole = all_whole & whole_number(F.col(name)).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("observed"),
        F.count(F.when(~all_whole, 1)).alias("malformed"),
    ).select(
        F.lit("csv_shape").alias("check"),
        "observed",
        F.lit(expected).cast("bigint").alias("expected"),
        "malformed",
        ((F.col("observed") == expected) & (F.col("malformed") == 0)).alias("ok"),
    )
