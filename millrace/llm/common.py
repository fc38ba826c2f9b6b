"""What several operators share: words as Spark expressions, checked broadcasts, scratch tables."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

import millrace
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import pin_as_table

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast up to so many bytes, by its counted rows.
BROADCAST_BYTES = 32 << 20


def n_words(text: Column) -> Column:
    """Number of words as long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_side(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows stay below ``BROADCAST_BYTES``; else as it is,
    so that Spark shuffles. ``df`` should be stored already, since it is counted here."""
    counted = df.count() if rows is None else rows
    return F.broadcast(df) if counted * row_bytes <= BROADCAST_BYTES else df


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; later uses don't compute it again."""
    return pin_as_table(df, "llm-" + label)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Spark's Python workers, once per application.

    Where it is installed on all machines this changes nothing; a session started by hand needs it.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(millrace.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace.zip")
    with open(path, "wb") as file:
        file.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)  # the driver serves it to every executor
    _shipped.add(application)
