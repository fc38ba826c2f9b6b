"""Storing points. A write never touches what another writer stored; identities are resolved on read.

Below a store lie ``ingest_writer=W/ingest_batch=N/ingest_sequence=S/ingest_attempt=T`` and the commit log of
:mod:`millrace.sinks.storelog`, which alone says which of these folders count. Writer and batch name a write: sent
again, it keeps its place ``S`` among all writes and takes a new attempt, which replaces the one before once it is
complete. Batch numbers belong to their writer alone: a new stream, a compaction and a hand-made ingest may all begin
at 0. Small writes are merged in place, a fixed number of one size at a time, so that a store fed by very many ticks or
micro-batches has few folders, and every record is rewritten only a few times.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.points import SPANS, latest_point, retain, span_of, time_range
from .storelog import StoreLog, Write

WRITER, BATCH, SEQUENCE, ATTEMPT = "ingest_writer", "ingest_batch", "ingest_sequence", "ingest_attempt"
ORDER = "ingest_order"
#: The one type of ``ingest_order``, and how far the order of a record is below the number of its write. Together they
#: make one number of fixed width, so that resolving identities needs no sort.
ORDER_TYPE, PLACE_TYPE, STEP = "decimal(27,0)", "decimal(38,0)", "1" + "0" * 27
COMPACTION = "compaction"
#: So many neighbouring writes of one level are merged into one of the next.
FANOUT = 16


def writes(spark: SparkSession, path: str) -> list[Write]:
    """The live writes of a store, in order, from the newest manifest."""
    return list(StoreLog(spark, path).read().writes)


def _order_number(order: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        order = F.unix_micros(order.cast("timestamp"))
    elif isinstance(kind, T.TimestampType):
        order = F.unix_micros(order)
    elif isinstance(kind, T.DateType):
        order = F.unix_date(order)
    elif not isinstance(kind, (T.IntegralType, T.DecimalType)):
        raise TypeError(f"the order of a record is a whole number or a time, not {kind.simpleString()}")
    return order.cast(ORDER_TYPE)


def _place() -> Column:
    """Where a record stands among all that were ever stored: its write, then its order there."""
    write = F.col(SEQUENCE).cast("decimal(10,0)") * F.lit(STEP).cast("decimal(28,0)")
    return (write + F.col(ORDER)).cast(PLACE_TYPE)


def write_points(
    df: DataFrame, path: str, ts: str, batch: int, order: Column, grain: str = "day", writer: str = "ingest"
) -> None:
    """Append ``df`` as write ``batch`` of ``writer``, partitioned by ``grain`` (day, month, year).

    ``order`` is the position of a record inside the write: a whole number or a time. The rebalance hint gives each
    span evenly sized files, splitting a span that holds much more than the others.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", writer):
        raise ValueError(f"a writer is named by letters, digits, '_', '.' and '-', not {writer!r}")
    log = StoreLog(df.sparkSession, path)
    sequence = log.begin(writer, batch)
    try:
        write = _store(df, path, ts, order, grain, Write(writer, batch, sequence, _attempt(), ""))
    except BaseException:
        log.give_up(sequence)
        raise
    log.end(write)


def _attempt() -> int:
    return time.time_ns() // 1000


def _store(df: DataFrame, path: str, ts: str, order: Column, grain: str, name: Write) -> Write:
    span = SPANS[grain]
    kept = df.withColumn(span, span_of(F.col(ts), grain)).withColumn(
        ORDER, _order_number(order, df.select(order.alias("o")).schema["o"].dataType))
    home = f"{path.rstrip('/')}/{WRITER}={name.writer}/{BATCH}={name.batch}/{SEQUENCE}={name.sequence}/{ATTEMPT}={name.attempt}"
    kept.hint("rebalance", span).write.mode("errorifexists").partitionBy(span).parquet(home)
    return replace(name, path=home)


def stored_points(
    spark: SparkSession, path: str, ts: str | None = None, start: datetime | None = None, stop: datetime | None = None
) -> DataFrame:
    """Every stored record of complete writes, also overwritten ones; with bounds on ``ts``, other spans are pruned."""
    known = writes(spark, path)
    if not known:
        raise FileNotFoundError(f"no complete write below {path}")
    stored = _read(spark, path, known)
    return stored if ts is None else time_range(stored, ts, start, stop)


def _read(spark: SparkSession, path: str, chosen: Sequence[Write]) -> DataFrame:
    return spark.read.option("basePath", path).parquet(*[w.path for w in chosen])


def read_points(
    spark: SparkSession,
    path: str,
    identity: Sequence[str],
    fields: Sequence[str],
    optional: Sequence[str] | None = None,
    ts: str | None = None,
    start: datetime | None = None,
    stop: datetime | None = None,
    keep: timedelta | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """The current value of every field of every point, in ``[start, stop)`` of ``ts`` where given, either bound alone.

    ``ts`` must be part of the identity then, so that a point and what overwrites it lie in the same span. ``keep`` and
    ``as_of`` leave out what retention has ended.
    """
    if ts is not None and ts not in identity:
        raise ValueError(f"{ts} is not part of the identity {list(identity)}")
    if keep is not None and (ts is None or as_of is None):
        raise ValueError("retention needs the time column and the moment it is judged at")
    stored = stored_points(spark, path, ts, start, stop)
    if keep is not None:
        stored = retain(stored, ts, keep, as_of)
    return latest_point(stored, identity, fields, [_place()], optional)


def compact_points(
    spark: SparkSession,
    path: str,
    target: str,
    ts: str,
    identity: Sequence[str],
    fields: Sequence[str],
    keep: timedelta,
    as_of: datetime,
    grain: str = "day",
    optional: Sequence[str] | None = None,
) -> None:
    """Write the current points that are within retention to ``target``, as a write of the compaction's own.

    Spans before the cut are pruned, not read. The old folder is left to the caller, so a reader of it is never
    disturbed. Later writes to ``target``, whatever their batch numbers, come after it.
    """
    stored = retain(stored_points(spark, path), ts, keep, as_of)
    current = latest_point(stored, identity, fields, [_place()], optional)
    number = max((w.batch for w in writes(spark, target) if w.writer == COMPACTION), default=-1) + 1
    write_points(current, target, ts, number, F.lit(0), grain, COMPACTION)


def merge_small_writes(
    spark: SparkSession,
    path: str,
    ts: str,
    identity: Sequence[str],
    fields: Sequence[str],
    grain: str = "day",
    optional: Sequence[str] | None = None,
    keep: timedelta = timedelta(0),
    as_of: datetime | None = None,
) -> int:
    """Merge runs of ``FANOUT`` neighbouring small writes in place; returns how many merges were done.

    A merge keeps the current value of every field among the merged writes and takes the place of the last of them.
    Writes under way hold back what is younger than they. What retention has ended by ``as_of`` is not copied. Records
    of equal order within one write are met in any sequence, before and after a merge.
    """
    log, done = StoreLog(spark, path), 0
    while True:
        run = _mergeable(log.read().settled())
        if not run:
            return done
        stored = _read(spark, path, run)
        if keep:
            stored = retain(stored, ts, keep, as_of)
        current = latest_point(stored, identity, fields, [_place()], optional)
        level, sequence = run[0].level + 1, run[-1].sequence
        new = Write(COMPACTION, sequence, sequence, _attempt(), "", level)
        if not log.swap(run, _store(current, path, ts, F.lit(0), grain, new)):
            return done  # another merge was faster
        done += 1


def _mergeable(settled: tuple[Write, ...]) -> tuple[Write, ...]:
    """The oldest ``FANOUT`` neighbours of one level, if there are so many."""
    run: list[Write] = []
    for write in settled:
        run = [*run, write] if run and run[-1].level == write.level else [write]
        if len(run) == FANOUT:
            return tuple(run)
    return ()


def retain_in_place(spark: SparkSession, path: str, ts: str, keep: timedelta, as_of: datetime, grain: str = "day") -> int:
    """End what is older than ``as_of - keep`` in the store itself; returns how many writes were touched.

    A write that lies before the cut altogether is dropped; of one that straddles it, the rest is copied, spans before
    the cut being pruned, and takes its place. Records, not only current points, are kept. Writes that arrive meanwhile
    stay as they are.
    """
    if not keep:
        return 0
    log, touched = StoreLog(spark, path), 0
    cut = span_of(F.lit(as_of - keep), grain)
    span = SPANS[grain]
    for write in log.read().settled():
        spans = _spans(spark, write, span)
        if not spans or min(spans) >= spark.range(1).select(cut.alias("c")).first()["c"]:
            continue
        rest = retain(_read(spark, path, [write]), ts, keep, as_of)
        rest = rest.drop(WRITER, BATCH, SEQUENCE, ATTEMPT, span)
        new = None
        if not rest.isEmpty():
            new = _store(rest, path, ts, F.col(ORDER), grain, replace(write, attempt=_attempt()))
        touched += log.swap((write,), new)
    return touched


def _spans(spark: SparkSession, write: Write, span: str) -> list[date]:
    """The spans a write has, from its folder names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(write.path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    found = [re.fullmatch(rf"{span}=(\d+-\d+-\d+)", name) for name in names]
    return [date.fromisoformat(m[1]) for m in found if m]
