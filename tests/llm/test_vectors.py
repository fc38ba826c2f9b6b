"""Whitening and hard negatives against numpy and brute force, and on odd input."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.coordinate_search import Anchor, Bucket, hard_negatives
from millrace.llm.whitening import ROUNDING, Centred, leading_pairs, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def whole(vector, scale=64, offset=1_000_000):
    return [math.floor(scale * float(np.float32(c))) + offset for c in vector]


def random_rows(n, size, seed=3, labels=10):
    pick = np.random.default_rng(seed)
    scale = np.linspace(0.05, 1.0, size)
    return [(i, (pick.standard_normal(size) * scale).astype(np.float32).tolist(), int(pick.integers(labels)))
            for i in range(n)]


# --- 11 whitening ---------------------------------------------------------------------------

@pytest.mark.parametrize("size, n", [(64, 3000), (64, 40), (7, 500), (150, 2000), (1, 9)])
def test_eigenpairs_reach_double_precision(size, n):
    pick = np.random.default_rng(size)
    x = np.floor(pick.standard_normal((n, size)) * 8)
    c = x - x.mean(axis=0)
    matrix = c.T @ c / n
    values, vectors = leading_pairs(lambda u: c.T @ (c @ u) / n, size, 16)
    expected = np.linalg.eigvalsh(matrix)[::-1][:len(values)]
    assert len(values) == min(16, size)
    assert np.abs(values - expected).max() <= 1e-13 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.sqrt(((matrix @ vectors - vectors * values) ** 2).sum(axis=0)).max() <= 2 * ROUNDING * expected[0]


def test_equal_eigenvalues_and_no_variance():
    matrix = np.diag([5.0] * 20 + [1.0] * 30)
    values, vectors = leading_pairs(lambda u: matrix @ u, 50, 16)
    assert np.allclose(values, 5, rtol=1e-14) and np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-13)
    assert (leading_pairs(lambda u: 0 * u, 50, 16)[0] == 0).all()


def test_deviation_is_exact_beyond_doubles():
    rows = np.array([[5, 1 << 40], [7, -(1 << 40)], [9, 3]], dtype=np.int64)
    total = rows.sum(axis=0).tolist()
    centre = Centred(3, total)
    exact = [sum((3 * a - t) ** 2 for a, t in zip(r, total)) for r in rows.tolist()]
    assert centre.deviation(rows) == [e if e < 1 << 63 else None for e in exact]


def test_whitening_equals_numpy(spark):
    rows = random_rows(700, 24)
    rows += [(1000 + i, rows[5][1], 1) for i in range(300)]  # one vector very often: once in the fit
    odd = [(None, rows[9][1], 2), (2000, None, 1), (2001, [NAN] + [0.0] * 23, 1), (2002, [INF] * 24, 1),
           (2003, [None] + [0.0] * 23, 1), (2004, [1.0, 2.0], 1), (2005, [], 1), (7, rows[7][1], 3)]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumn("component", F.lit("x")).withColumn("x", F.lit(1)).repartition(5)
    got = whiten(df).collect()
    kept = [(i, whole(v)) for i, v, _ in rows + [odd[0], odd[-1]]]
    fit = np.array(sorted({tuple(v) for _, v in kept}), dtype=np.int64)
    n = len(fit)
    c = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    total = fit.sum(axis=0).tolist()
    assert len(got) == 16 * len(kept)
    expected = {}
    for number, v in kept:
        deviation = sum((n * a - t) ** 2 for a, t in zip(v, total))
        projected = (np.array(v) - fit.mean(axis=0)) @ vectors[:, :16] / np.sqrt(values[:16])
        expected[number] = deviation, projected
    for row in got:
        deviation, projected = expected[row["vec_id"]]
        assert (row["n"], row["deviation"]) == (n, deviation)
        k = row["component"] - 1
        assert abs(abs(row["whitened"]) - abs(projected[k])) < 1e-9
        assert abs(row["explained"] / (values[k] / values.sum()) - 1) < 1e-10
        assert 0 <= row["identity_error"] < 1e-10
    copies = [r for r in got if r["vec_id"] in (5, 1000, 1299) and r["component"] == 1]
    assert len({r["whitened"] for r in copies}) == 1 and len(copies) == 3


def test_whitening_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty).collect() == [] and whiten(empty).columns[0] == "vec_id"
    assert whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0], 1)] * 3, SCHEMA)).collect() == []
    line = whiten(spark.createDataFrame([(1, [0.0, 0.0], 1), (2, [1.0, 1.0], 1)], SCHEMA)).collect()
    assert {(r["vec_id"], r["component"], round(abs(r["whitened"]), 12)) for r in line} == {(1, 1, 1.0), (2, 1, 1.0)}


# --- 13 hard negatives ----------------------------------------------------------------------

def brute_negatives(rows, positives=5, negatives=5):
    known = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        own = ((label + 1) % 10 if i % 7 == 0 else label), whole(v, 256, 0)
        known[i] = min(known.get(i, own), own)
    out = []
    for a, (label, x) in known.items():
        if a % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in known.items()
                  if i != a and len(y) == len(x)]
        for p, i, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fits = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:negatives]
            out += [(a, i, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_negatives_equal_brute_force(spark):
    rows = random_rows(900, 6) + [(5000 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.1], i % 3) for i in range(400)]
    rows += [(None, [1.0] * 6, 1), (6001, None, 1), (6002, [1.0] * 6, None), (6003, [NAN] * 6, 1), (6004, [INF] * 6, 1),
             (6005, [None] * 6, 1), (6100, [1.0, 2.0], 1), (6101, [], 1), (6200, [], 1), (6201, [0.0] * 6, 1),
             (6300, [0.0] * 6, 1), rows[3], rows[100], (100, rows[4][1], 0), (6400, [1e17] * 6, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("id", F.lit(1)).repartition(7)
    got = collected(hard_negatives(df))
    assert got == brute_negatives([r for r in rows if r[0] != 6400])
    assert len(got) > 100


def test_negatives_of_long_vectors_and_few_rows(spark):
    pick = random.Random(4)
    big = [(i, [pick.uniform(-1, 1) * 2.0 ** 18 for _ in range(3)], i % 2) for i in range(0, 400, 10)]
    assert collected(hard_negatives(spark.createDataFrame(big, SCHEMA))) == brute_negatives(big)
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hard_negatives(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)).collect() == []
    pair = [(100, [1.0], 1), (101, [1.0], 1), (102, [0.9], 2), (103, [0.7], 2), (104, [1.1], 2)]
    assert collected(hard_negatives(spark.createDataFrame(pair, SCHEMA))) == brute_negatives(pair)


def test_blocks_of_anchors_change_nothing(spark, monkeypatch):
    from millrace.llm import coordinate_search

    rows = random_rows(1200, 5, seed=8)
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(coordinate_search, "ANCHOR_BLOCK_BYTES", 1500)
    assert collected(hard_negatives(df)) == brute_negatives(rows)


def test_feasible_ranges_lose_nothing():
    pick = np.random.default_rng(2)
    data = (pick.standard_normal((500, 4)) * 50).astype(np.int64)
    bucket = Bucket(np.arange(500), np.zeros(500, dtype=np.int64), data)
    for row in range(40):
        anchor = Anchor(-1, 0, data[row] if row % 2 else -data[row])
        cosines = bucket.unit @ anchor.unit
        for least in (0.2, 0.6, 0.9, 0.999):
            rows = bucket.feasible(anchor.unit, anchor.focus, least)
            if rows is not None:
                assert set(np.flatnonzero(cosines >= least)) <= set(rows.tolist())
        assert len(bucket.feasible(anchor.unit, anchor.focus, 0.95)) < 250
