"""Batch sources. Schemas are always declared, never inferred."""

from __future__ import annotations

import csv
import types
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.once import compute_once
from ..functions.text import is_data_line, strip, whole_number, words
from ..operators.contracts import ContractError, fail_fast, judge, reject_split
from ..operators.joins import join_lookup
from ..operators.ranking import ranked_all
from ..session import settings

# Accepted header of an edge CSV.
EDGE_HEADER = ("source", "target")

POSITION = "line_position"


#: A file's first rows are read by a task of its own, however small it is.
_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.files.openCostInBytes": "128m"}


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, bytes)`` of every file below a path or glob; contents are not read."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))


def _first_row(batches):
    """The first row of a partition; what follows is not read. Runs in Spark's Python workers."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _is_header(line: Column, header: Sequence[str]) -> Column:
    """Whether a line is the header as it is written plainly, or with every cell quoted; others are looked at one by one."""
    bare = F.regexp_replace(F.regexp_replace(line, "^\ufeff", ""), "\r$", "")
    quoted = ['"' + name.replace('"', '""') + '"' for name in header]
    plain = [own if set(name) & set(',"\r\n') else name for name, own in zip(header, quoted)]
    return bare.isin(",".join(plain), ",".join(quoted))


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, value)``: the first line of every file that has one, read by one task a file.

    Run it inside ``settings(spark, _FILE_A_TASK)``, which deals the files out that way.
    """
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file"), "value")
    # The worker gets the function itself, so the package need not be installed there.
    first = types.FunctionType(_first_row.__code__, {"__builtins__": __builtins__}, "first")
    return lines.mapInArrow(first, "file string, value string")


def expect_header(spark: SparkSession, path: str, header: Sequence[str]) -> None:
    """Every file begins with exactly ``header``, case and order included; a byte-order mark may go before it.

    One job reads the start of each file and tells how many there were by first line; the driver sees each different
    line once, not each file.
    """
    files = len(spark.read.text(path)._jdf.inputFiles())  # a number: the names stay where Spark keeps them
    if not files:
        raise ContractError(f"no file at {path}")
    with settings(spark, _FILE_A_TASK):
        kinds = first_lines(spark, path).groupBy(
            F.when(_is_header(F.col("value"), header), F.lit(None).cast("string")).otherwise(F.col("value")).alias("value")
        ).agg(F.count(F.lit(1)).alias("files"), F.min("file").alias("file"))
        seen = 0
        for row in kinds.toLocalIterator():
            seen += row["files"]
            if row["value"] is not None:
                found = next(csv.reader([row["value"].removeprefix("\ufeff")]), [])
                if found != list(header):
                    raise ContractError(f"{row['file']} has the header {found}; expected the header {list(header)}")
    if seen < files:
        raise ContractError(f"{files - seen} of {files} files at {path} are empty; expected the header {list(header)}")


def read_csv_contract(spark: SparkSession, path: str, header: Sequence[str]) -> DataFrame:
    """A CSV whose header must be exactly ``header``, in order; all cells as text.

    A byte-order mark is tolerated, a different header or an empty file is an error at once,
    whatever columns are read later, and a row with too few or too many cells shows up in
    ``_corrupt_record``.
    """
    cells = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = (
        spark.read.schema(cells.add("_corrupt_record", T.StringType()))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )
    expect_header(spark, path, header)
    return rows


def position() -> Column:
    """``line_position`` of a record read from files: it sorts in reading order."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).alias(POSITION)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value`` with ``line_position``, which sorts in reading order."""
    return spark.read.text(path).select("value", position())


def with_position_number(records: DataFrame, path: str) -> DataFrame:
    """Records read from ``path`` with their ``line_position`` as one number that sorts alike.

    Files are numbered in order of name by a joined table, up to 10**8 of them; blocks of a file lie further apart than
    the unit they are counted in here.
    """
    spark = records.sparkSession
    files = ranked_all(listed_files(spark, path).select("file"), [F.asc("file")], "file_number")
    numbered = join_lookup(records.withColumn("file", F.col(f"{POSITION}.file")), files, ["file"])
    row = F.col(f"{POSITION}.line").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.shiftright(F.col(f"{POSITION}.block"), 12)
    number = (
        F.col("file_number").cast("decimal(8,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)")
        + block.cast("decimal(9,0)") * F.lit("1" + "0" * 10).cast("decimal(11,0)")
        + row.cast("decimal(10,0)")
    ).cast("decimal(27,0)")
    return numbered.withColumn(POSITION, number).drop("file", "file_number")


def judge_edge_lines(lines: DataFrame) -> DataFrame:
    """Parse data lines to ``(source, destination)`` and keep the reason where that fails."""
    fielded = compute_once(lines, fields=words(F.col("value"))).filter(is_data_line(F.col("fields")))
    typed = compute_once(
        fielded,
        source=F.get("fields", F.lit(0)).try_cast("bigint"),
        destination=F.get("fields", F.lit(1)).try_cast("bigint"),
    )
    return judge(typed, [
        (F.size("fields") == 2, F.concat(F.lit("expected 2 fields, found "), F.size("fields").cast("string"))),
        (F.col("source").isNotNull(), "source is not an integer"),
        (F.col("destination").isNotNull(), "destination is not an integer"),
    ]).drop("fields")


def _edges_only(judged: DataFrame, mode: str, message: Column) -> DataFrame:
    if mode == "drop":
        kept, _ = reject_split(judged)
    elif mode == "fail":
        kept = fail_fast(judged, message)
    else:
        raise ValueError(f"mode is 'drop' or 'fail', not {mode!r}")
    return kept.select("source", "destination")


def parse_edges(lines: DataFrame, mode: str = "drop") -> DataFrame:
    """Edges from text lines; malformed lines are dropped or (``mode="fail"``) stop the job.

    Lines that carry their position are named by it as well.
    """
    message = F.concat(F.lit("malformed edge '"), strip(F.col("value")), F.lit("'"))
    if POSITION in lines.columns:
        message = F.concat(message, F.lit(" at "), F.to_json(POSITION))
    return _edges_only(judge_edge_lines(lines), mode, message)


def read_edge_text(spark: SparkSession, path: str, mode: str = "drop") -> DataFrame:
    """Whitespace-separated ``source destination`` lines with ``#`` comments."""
    return parse_edges(read_lines(spark, path) if mode == "fail" else spark.read.text(path), mode)


def judge_edge_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a ``source,target`` CSV as ``(source, destination)`` with their position and ``reject_reason``."""
    cells = read_csv_contract(spark, path, EDGE_HEADER).select("source", "target", "_corrupt_record", position())
    typed = compute_once(
        cells.withColumnsRenamed({"source": "source_text", "target": "target_text"}),
        source=whole_number(F.col("source_text")), destination=whole_number(F.col("target_text")),
    )
    return judge(typed, [
        (F.col("_corrupt_record").isNull(), "row does not match the header"),
        (F.col("source").isNotNull(), "source is not an integer"),
        (F.col("destination").isNotNull(), "target is not an integer"),
    ])


def read_edge_csv(spark: SparkSession, path: str, mode: str = "drop") -> DataFrame:
    """``source,target`` CSV; malformed rows are dropped or (``mode="fail"``) stop the job with their position.

    ``judge_edge_csv`` gives both sides.
    """
    judged = judge_edge_csv(spark, path)
    return _edges_only(judged, mode, F.concat(F.lit("malformed edge at "), F.to_json(POSITION)))


def latest_file(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, modified)`` of the newest visible file below ``folder``; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("path", F.col("modificationTime").alias("modified"), "length")
        .filter(F.col("length") > 0)
    )
    return files.orderBy(F.desc("modified"), F.desc("path")).limit(1).select("path", "modified")
