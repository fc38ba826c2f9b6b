"""Hard negatives by coordinate pruning: length buckets with sorted coordinate lists, feasible ranges, exact scores.

Vectors become whole numbers and lie in the shared folder in order of length, longest first. A task walks through its
part in buckets of vectors of about one length; a bucket holds, for each coordinate that is asked for, its unit
vectors' values in order. For an anchor with unit vector a that needs a score of at least s, a row of the bucket must
have cosine >= c = s / (|anchor| * longest length of the bucket). If c is above 1 the bucket is passed over. Otherwise
the value of coordinate f must lie in a_f c -+ sqrt((1 - a_f**2) (1 - c**2)); the ranges of the anchor's largest
coordinates (the focus) are looked up in their lists and intersected, and what is left is scored exactly. The score
needed rises as an anchor finds better rows.

Anchors go out in blocks of bounded size, one after another; each block's rows are written before the next is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.session import scratch

from .common import stored

SCALE = 256
ANCHOR_BLOCK_BYTES = 16 << 20  # of anchors and their positives, broadcast at once
BUCKET = 2_048
FOCUS = 4
SLACK = 1e-9
#: A row of the table of vectors per partition, at about; partitions follow the table's size.
PARTITION_ROWS = 200_000
#: Squared lengths up to which every score is a long.
LONGEST = float(1 << 62)
NEVER = np.iinfo(np.int64).max


class Bucket:
    """Vectors of about one length, with the order of each coordinate's values among their unit vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, data: np.ndarray):
        self.ids, self.labels, self.data = ids, labels, data
        self.length = _lengths(data)
        self.longest = float(self.length.max())
        self.unit = data / np.where(self.length > 0, self.length, 1)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._lists:
            order = np.argsort(self.unit[:, f])
            self._lists[f] = order, self.unit[order, f]
        return self._lists[f]

    def feasible(self, unit: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray | None:
        """Rows that may have this cosine at least with the unit vector; none stands for all of them."""
        if cosine <= 0:
            return None
        ranges = []
        for f in focus.tolist():
            order, values = self.coordinate(f)
            spread = np.sqrt(max(0.0, 1 - unit[f] ** 2) * max(0.0, 1 - cosine ** 2)) + SLACK
            # Cosines from here up to 1: the low end falls and the high end rises no further once it passes the anchor.
            low = -1.0 if unit[f] < 0 and -unit[f] >= cosine else unit[f] * cosine - spread
            high = 1.0 if unit[f] > 0 and unit[f] >= cosine else unit[f] * cosine + spread
            begin, end = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            if end - begin < len(values):
                ranges.append((end - begin, order[begin:end]))
        if not ranges:
            return None
        ranges.sort(key=lambda r: r[0])
        rows = ranges[0][1]
        if len(ranges) > 1:
            met = np.zeros(len(self.ids), dtype=np.int8)
            for _, own in ranges:
                met[own] += 1
            rows = rows[met[rows] == len(ranges)]
        return rows


def _lengths(data: np.ndarray) -> np.ndarray:
    wide = data.astype(np.float64)
    return np.sqrt((wide * wide).sum(axis=-1))


def _scores(data: np.ndarray, length: float, anchor: np.ndarray, own: float) -> np.ndarray:
    if length * own < 2.0 ** 52:  # doubles hold every partial sum exactly
        return np.rint(data.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return (data * anchor).sum(axis=1)  # whole numbers; partial sums are bounded by the lengths


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k by falling score, then rising id."""
    if len(score) > 8 * k:
        cut = np.partition(score, len(score) - k)[len(score) - k]
        keep = score >= cut
        score, ids = score[keep], ids[keep]
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


class _Best:
    """The first k rows found so far."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def floor(self) -> int | None:
        return int(self.score[-1]) if len(self.score) == self.k else None

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        floor = self.floor()
        if floor is not None:
            keep = score >= floor
            score, ids = score[keep], ids[keep]
        if len(score):
            self.score, self.ids = _first(np.concatenate([self.score, score]), np.concatenate([self.ids, ids]), self.k)


def _least(positive: int, percent: int) -> int:
    """The smallest whole score of which 100 times is at least ``percent`` times the positive's."""
    return -((-percent * positive) // 100)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)
    return flat, offsets


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    """Buckets of up to ``BUCKET`` rows in the order they come, vectors of one number of components each."""
    for batch in batches:
        flat, offsets = _matrix(batch.column(2))
        ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        sizes = np.diff(offsets)
        for begin in range(0, batch.num_rows, BUCKET):
            rows = np.arange(begin, min(begin + BUCKET, batch.num_rows))
            for size in np.unique(sizes[rows]).tolist():
                own = rows[sizes[rows] == size]
                yield Bucket(ids[own], labels[own], flat[offsets[own][:, None] + np.arange(size)])


class Anchor:
    def __init__(self, number: int, label: int, data: np.ndarray):
        self.id, self.label, self.data = number, label, data
        self.length = float(_lengths(data))
        self.unit = data / self.length if self.length else data.astype(np.float64)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS]

    def scored(self, bucket: Bucket, least: int | None, same_label: bool) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the bucket's rows with (or without) the anchor's label that may reach ``least``."""
        nothing = np.zeros(0, dtype=np.int64)
        if bucket.data.shape[1] != len(self.data):
            return nothing, nothing
        rows = None
        if least is not None and least > 0:
            reach = self.length * bucket.longest
            if least > reach * (1 + SLACK):
                return nothing, nothing
            rows = bucket.feasible(self.unit, self.focus, least / reach * (1 - SLACK))
        if rows is None:
            rows = np.arange(len(bucket.ids))
        rows = rows[(bucket.labels[rows] == self.label) == same_label]
        rows = rows[bucket.ids[rows] != self.id]
        if not len(rows):
            return nothing, nothing
        return _scores(bucket.data[rows], bucket.longest, self.data, self.length), bucket.ids[rows]


def _positives(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = [Anchor(*a) for a in sent.value]
        best = [_Best(k) for _ in anchors]
        by_label: dict[int, list[int]] = {}
        for i, a in enumerate(anchors):
            by_label.setdefault(a.label, []).append(i)
        for bucket in _buckets(batches):
            for label in np.unique(bucket.labels).tolist():
                for i in by_label.get(label, ()):
                    best[i].add(*anchors[i].scored(bucket, best[i].floor(), True))
        rows = [(a.id, s, n) for a, b in zip(anchors, best) for s, n in zip(b.score.tolist(), b.ids.tolist())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["anchor_id", "score", "id"])

    return run


def _negatives(sent, sent_positives, k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = [a for a in (Anchor(*a) for a in sent.value) if a.id in sent_positives.value]
        wanted = [[(n, s, _least(s, percent), _Best(k)) for n, s in sent_positives.value[a.id]
                   if _least(s, percent) <= s] for a in anchors]
        for bucket in _buckets(batches):
            for anchor, own in zip(anchors, wanted):
                if not own:
                    continue
                floors = [low if (f := b.floor()) is None else max(low, f) for _, _, low, b in own]
                score, ids = anchor.scored(bucket, min(floors), False)
                if not len(score):
                    continue
                for (_, positive, _, b), floor in zip(own, floors):
                    keep = (score >= floor) & (score <= positive)
                    if keep.any():
                        b.add(score[keep], ids[keep])
        rows = [(a.id, n, p, s, i) for a, own in zip(anchors, wanted) for n, p, _, b in own
                for s, i in zip(b.score.tolist(), b.ids.tolist())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                             ["anchor_id", "positive_id", "positive_score", "score", "id"])

    return run


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, relabel_every: int | None,
              labels: int) -> DataFrame:
    """id, label, x of the rows that take part, one an id, stored by falling length."""
    entries, spark = F.col("entries"), vectors.sparkSession
    label = F.col("label")
    if relabel_every:
        label = F.when(F.col("id") % relabel_every == 0, (label + 1) % labels).otherwise(label)
    usable = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("entries")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & entries.isNotNull()).where(
        F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(2.0 ** 54)))
    ).select("id", label.alias("label"), F.transform(entries, lambda c: F.floor(c * F.lit(float(SCALE)))).alias("x"))
    one = usable.groupBy("id").agg(F.min(F.struct("label", "x")).alias("row")).select("id", "row.*")
    one = one.withColumn("length2", F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))).where(
        F.col("length2") <= F.lit(LONGEST))
    one = stored(one, "whole-vectors")
    parts = max(spark.sparkContext.defaultParallelism, one.count() // PARTITION_ROWS)
    # Rows of one length, copies for instance, are spread by their ids.
    salt = F.xxhash64("id")
    ordered = one.withColumn("salt", salt).repartitionByRange(parts, F.desc("length2"), "salt")
    return stored(ordered.sortWithinPartitions(F.desc("length2")).select("id", "label", "x"), "by-length")


def hard_negatives(vectors: DataFrame, anchor_every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80,
                   relabel_every: int | None = 7, labels: int = 10, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (id divisible by
    ``anchor_every``) and each of its ``positives`` best rows of the same label, the best ``negatives`` rows of other
    labels whose score lies between ``percent`` hundredths of the positive's and the positive's own.

    Entries become floor(256 x); a score is the whole inner product; ties go to the smaller id. A label whose row's id
    is divisible by ``relabel_every`` becomes (label + 1) % ``labels`` first. Rows whose id, label or vector is null,
    or whose vector holds a null, non-finite or giant entry (so that a score could leave the range of long), take no
    part. An id stands for one row: of several, that with the smallest label, then vector. Vectors of another length
    than the anchor's are none of its candidates; empty vectors score 0. A negative positive score has no negatives,
    as its range is empty. Fewer rows where there are fewer candidates. Other columns are ignored.
    """
    spark = vectors.sparkSession
    pool = _prepared(vectors, id_col, vector_col, label_col, relabel_every, labels)
    anchors = pool.where(F.col("id") % anchor_every == 0)
    counted = anchors.agg(F.count(F.lit(1)), F.sum(F.size("x"))).first()
    size = counted[0] * (64 + 64 * positives) + 8 * (counted[1] or 0)
    blocks = max(1, -(-size // ANCHOR_BLOCK_BYTES))
    number = F.pmod(F.xxhash64("id"), F.lit(blocks))
    place = scratch(spark, "llm-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for block in range(blocks):
        found = _one_block(spark, pool, anchors.where(number == block), positives, negatives, percent)
        if found is not None:
            found.write.parquet(f"{place}/block={block}")
        elif block == 0:
            spark.createDataFrame([], schema).write.parquet(f"{place}/block=0")
    return spark.read.schema(schema).parquet(f"{place}/block=*")


def _one_block(spark: SparkSession, pool: DataFrame, anchors: DataFrame, positives: int, negatives: int,
               percent: int) -> DataFrame | None:
    asked = anchors.toArrow().combine_chunks()
    flat, offsets = _matrix(asked["x"])
    sent = spark.sparkContext.broadcast([
        (i, label, flat[offsets[r]:offsets[r + 1]].copy())
        for r, (i, label) in enumerate(zip(asked["id"].to_pylist(), asked["label"].to_pylist()))])
    if not sent.value:
        return None
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = pool.mapInArrow(_positives(sent, positives), "anchor_id long, score long, id long").withColumn(
        "rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    by_anchor: dict[int, list[tuple[int, int]]] = {}
    for row in near.select("anchor_id", "id", "score").toArrow().to_pylist():  # at most ``positives`` an anchor of the block
        by_anchor.setdefault(row["anchor_id"], []).append((row["id"], row["score"]))
    sent_positives = spark.sparkContext.broadcast(by_anchor)
    schema = "anchor_id long, positive_id long, positive_score long, score long, id long"
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return pool.mapInArrow(_negatives(sent, sent_positives, negatives, percent), schema).withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
