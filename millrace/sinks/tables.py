"""Rank lists, edge lists, graph tables, keyed JSON and text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.messages import compact_json
from ..operators.contracts import REASON
from ..operators.graph import merge_edges, node_union


def write_rank_csv(few: DataFrame, path: str) -> None:
    """A limited ranking as one CSV file with a header."""
    few.coalesce(1).write.option("header", True).csv(path)


def write_edge_csv(edges: DataFrame, path: str) -> None:
    edges.select(F.col("source"), F.col("destination").alias("target")).write.option(
        "header", True
    ).csv(path)


def write_graph(edges: DataFrame, path: str) -> None:
    """Edges, each once, and the nodes they touch; the input is read once, nodes come from the written edges.

    An edge with a null end stops the job; reject or leave out such edges before.
    """
    whole = [F.coalesce(F.col(end), F.raise_error(F.lit(f"an edge has no {end}")).cast("bigint")).alias(end)
             for end in ("source", "destination")]
    merge_edges(edges.select(*whole)).write.parquet(f"{path}/edges")
    written = edges.sparkSession.read.schema("source bigint, destination bigint").parquet(f"{path}/edges")
    node_union(written).write.parquet(f"{path}/nodes")


def keyed_json(df: DataFrame, key: Column, **fields: Column) -> DataFrame:
    """``(key, value)`` messages, value as compact JSON."""
    return df.select(key.cast("string").alias("key"), compact_json(**fields).alias("value"))


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    df.select(line.alias("value")).write.text(path)


def quarantine_sink(rejected: DataFrame, path: str, label: str) -> None:
    """Keep rejected records, as JSON lines by reason below ``path``, under what they were rejected from.

    Sent again under the same label they replace themselves.
    """
    whole = F.to_json(F.struct(*[F.col(f"`{name}`") for name in rejected.columns if name != REASON]))
    rejected.select(REASON, whole.alias("record")).write.mode("overwrite").partitionBy(REASON).json(
        f"{path.rstrip('/')}/rejected_from={label}")
