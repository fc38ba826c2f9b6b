"""Complete graph jobs: in-degree ranking of an edge file, import of a citation graph."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.contracts import ContractError, counted, expect_count, expect_unique, fail_fast, reject_split
from ..operators.graph import in_degree, top_in_degree
from ..operators.ranking import ranked
from ..session import pin_as_table
from ..sinks.tables import quarantine_sink, write_graph, write_rank_csv
from ..sources.files import POSITION, judge_edge_csv, read_edge_text


def rank_in_degree(edges: DataFrame, k: int) -> DataFrame:
    """``(rank, destination, in_degree)`` of the ``k`` most referenced nodes."""
    order = [F.desc("in_degree"), F.asc("id")]
    top = ranked(top_in_degree(in_degree(edges), k), order)
    return top.select("rank", F.col("id").alias("destination"), "in_degree")


def rank_edge_file(
    spark: SparkSession, path: str, target: str, k: int = 50, expected: int | None = None
) -> int:
    """Rank an edge file into one CSV; the edges are counted while they are ranked."""
    edges, seen = counted(read_edge_text(spark, path), "edges")
    write_rank_csv(rank_in_degree(edges, k), target)
    rows = seen.get["rows"]
    if expected is not None and rows != expected:
        raise ContractError(f"found {rows} edges; expected {expected}")
    return rows


def import_graph(
    spark: SparkSession, csv_path: str, target: str, expected: int | None = None, mode: str = "fail",
    quarantine: str | None = None,
) -> None:
    """Load an edge CSV as node and edge tables, with the uniqueness and count gates. The file is parsed once.

    A malformed row, or one with a null end, stops the import with its position. With ``mode="drop"`` such rows are
    left out, and with a ``quarantine`` folder they are kept there with their reason.
    """
    judged = judge_edge_csv(spark, csv_path)
    if quarantine is not None:
        kept, rejected = reject_split(pin_as_table(judged, "judged-edges"))
        quarantine_sink(rejected, quarantine, "edges")
    elif mode == "fail":
        kept = fail_fast(judged, F.concat(F.lit("malformed edge at "), F.to_json(POSITION)))
    elif mode == "drop":
        kept, _ = reject_split(judged)
    else:
        raise ValueError(f"mode is 'drop' or 'fail', not {mode!r}")
    write_graph(kept.select("source", "destination"), target)
    expect_unique(spark.read.parquet(f"{target}/nodes"), ["id"])
    if expected is not None:
        expect_count(spark.read.parquet(f"{target}/edges"), expected, "edges")


def profile_steps(source: DataFrame, steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Run ``source`` through the named steps once and report ``(place, step, rows)`` for each.

    Rows are counted as they pass, so profiling costs one run of the query.
    """
    df, seen = counted(source, "step-0")
    passed = [("source", seen)]
    for place, (name, step) in enumerate(steps, 1):
        df, seen = counted(step(df), f"step-{place}")
        passed.append((name, seen))
    df.write.format("noop").mode("overwrite").save()
    return source.sparkSession.createDataFrame(
        [(place, name, seen.get["rows"]) for place, (name, seen) in enumerate(passed)], "place int, step string, rows bigint")


def profile_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text; ``plans.joblog.profile_run`` gives rows, times and spill per operator."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
