"""Session settings, the shared scratch area and the two ways results are pinned."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Keeps large window state off the heap and checkpoints only what changed.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "millrace",
    master: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the settings this package is written for.

    Without ``master`` the launcher (``spark-submit``) decides; executor sizes and
    shuffle partitions are left to it as well.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Set SQL options for the duration of a block and put the old ones back."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """What is written in the block gives its shuffle files back at once, not when the driver's garbage is collected;
    Parquet is packed with zstd."""
    with settings(spark, {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd",
    }):
        yield


_pinned: list[list[str]] = []


@contextmanager
def pins_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`pin_as_table` makes in the block are deleted at its end; nothing may read them after it."""
    _pinned.append([])
    try:
        yield
    finally:
        for path in _pinned.pop():
            remove(spark, path)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    root = shared_root(spark)
    return f"{root}/millrace/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch data that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a result, for choosing between plans before running one."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, reliably, and cut its lineage (reliable checkpoint)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def pin_as_table(df: DataFrame, label: str) -> DataFrame:
    """Like :func:`pin`, but columnar, so later reads prune columns and row groups."""
    path = scratch(df.sparkSession, label)
    if _pinned:
        _pinned[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
