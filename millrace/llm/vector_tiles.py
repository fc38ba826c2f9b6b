"""Nearest neighbours by a block matrix join: int8 product tiles bound every cosine, survivors are recomputed.

Queries go out in blocks of bounded size, one broadcast each; Spark tasks walk through all vectors in tiles. In a
tile, unit vectors are rounded to int8. With ``x = x8 * sx + ex`` the product of two rounded vectors is off by at most
``|ex| + |x8 * sx| * |ey|``, so each tile gives an upper and a lower bound for every cosine. A pair survives unless its
upper bound lies below the k-th best score its query already has, or below the k-th best lower bound of the tile.
Survivors get their cosine in double precision from the original vectors and go into the query's heap. A task returns
k rows for each query; Spark merges them. Nothing is approximate in the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

QUERY_BLOCK = 32_768  # queries broadcast at once
QUERY_TILE = 1_024
VECTOR_TILE = 4_096
LEVELS = 127


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the usable rows, one pair of arrays for each number of components."""
    ids, vectors = batch.column(0), batch.column(1)
    keep = ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    flat = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    sizes = np.diff(offsets)
    for size in np.unique(sizes[keep & (sizes > 0)]).tolist():
        rows = np.flatnonzero(keep & (sizes == size))
        data = flat[offsets[rows][:, None] + np.arange(size)]
        good = np.isfinite(data).all(axis=1)
        good[good] = (data[good] != 0).any(axis=1)
        if good.any():
            yield ids.take(pa.array(rows[good])).to_numpy(zero_copy_only=False).astype(np.int64), data[good]


def lengths(data: np.ndarray) -> np.ndarray:
    return np.sqrt((data * data).sum(axis=1))


class Rounded:
    """Vectors with their int8 form and what is needed to bound the error of a product."""

    def __init__(self, ids: np.ndarray, data: np.ndarray):
        # Squares of very large or small components leave the range of doubles. Powers of two change no bit of a cosine.
        data = np.ldexp(data, -np.frexp(np.abs(data).max(axis=1, keepdims=True))[1])
        self.ids, self.data, self.length = ids, data, lengths(data)
        unit = data / self.length[:, None]
        self.step = np.abs(unit).max(axis=1) / LEVELS
        self.small = np.rint(unit / self.step[:, None]).astype(np.int8)
        back = self.small * self.step[:, None]
        self.error, self.norm = lengths(unit - back) + 1e-9, lengths(back) + 1e-9


def cosines(left: np.ndarray, right: np.ndarray, left_length: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """Cosines row by row. The same pair of vectors gives the same bits wherever it stands."""
    return (left * right).sum(axis=1) / (left_length * right_length)


def _tile(q: Rounded, v: Rounded, rows: slice, cols: slice, heaps: list[list], best: np.ndarray, k: int,
          skip_same_id: bool) -> None:
    # Products of int8 summed up in float32 are whole numbers below 2**24 for up to 1,040 components; else float64.
    kind = np.float32 if q.small.shape[1] * LEVELS * LEVELS < 1 << 24 else np.float64
    product = q.small[rows].astype(kind) @ v.small[cols].astype(kind).T
    middle = product * (q.step[rows][:, None] * v.step[cols][None, :])
    spread = q.error[rows][:, None] + q.norm[rows][:, None] * v.error[cols][None, :] + 1e-6
    if skip_same_id:
        same = q.ids[rows][:, None] == v.ids[cols][None, :]
        middle = np.where(same, -9.0, middle)
    lower = middle - spread
    floor = best[rows]
    if lower.shape[1] >= k:
        floor = np.maximum(floor, np.partition(lower, lower.shape[1] - k, axis=1)[:, lower.shape[1] - k])
    i, j = np.nonzero((middle + spread >= floor[:, None]) & (middle > -8.0))
    for begin in range(0, len(i), 65_536):
        a, b = i[begin:begin + 65_536] + rows.start, j[begin:begin + 65_536] + cols.start
        score = cosines(q.data[a], v.data[b], q.length[a], v.length[b])
        for row, pair in zip(a.tolist(), zip(score.tolist(), (-v.ids[b]).tolist())):
            heap = heaps[row]
            if len(heap) < k:
                heapq.heappush(heap, pair)
            elif pair > heap[0]:
                heapq.heapreplace(heap, pair)
    for row in np.unique(i + rows.start).tolist():
        if len(heaps[row]) == k:
            best[row] = max(best[row], heaps[row][0][0])


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest cosine to each row of ``queries``: query_id, rank, id, score.

    Nearest first, ties to the smaller id; fewer rows where there are fewer candidates. A row is never its own
    candidate: ids that equal the query's are left out. An id with several rows is a candidate with each of them, repeated
    rows included, and may take several ranks. Components may have any finite size. Vectors that are null, zero, empty or hold null or non-finite
    components, and rows without an id, take no part; vectors of other lengths are no candidates of a query. A query
    id that occurs twice with different vectors is answered for the smallest of them. Other columns are ignored.
    """
    spark = queries.sparkSession
    asked = queries.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).where("id IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector"))
    # Vectors stay as they were stored until a task widens them.
    pool = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    found = None
    for number in range(blocks):
        part = asked.where(block == number).toArrow().combine_chunks()
        sent = spark.sparkContext.broadcast([pair for batch in part.to_batches() for pair in _matrices(batch)])
        one = pool.mapInArrow(_search(sent, k), "query_id long, id long, score double")
        found = one if found is None else found.unionByName(one)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "score")


def _search(sent, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = [Rounded(ids, data) for ids, data in sent.value]
        heaps = [[[] for _ in g.ids] for g in groups]
        best = [np.full(len(g.ids), -np.inf) for g in groups]
        for batch in batches:
            for begin in range(0, batch.num_rows, VECTOR_TILE):
                for ids, data in _matrices(batch.slice(begin, VECTOR_TILE)):
                    v = Rounded(ids, data)
                    for g, heap, floor in zip(groups, heaps, best):
                        if g.data.shape[1] != data.shape[1]:
                            continue
                        for top in range(0, len(g.ids), QUERY_TILE):
                            rows = slice(top, min(top + QUERY_TILE, len(g.ids)))
                            _tile(g, v, rows, slice(0, len(ids)), heap, floor, k, True)
        for g, heap in zip(groups, heaps):
            rows = [(q, -i, s) for q, own in zip(g.ids.tolist(), heap) for s, i in own]
            if rows:
                query, own, score = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(own, pa.int64()), pa.array(score, pa.float64())],
                    ["query_id", "id", "score"])

    return search
