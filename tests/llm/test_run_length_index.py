"""Long repeated strings against brute force over every 50-byte string."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import run_length_index
from millrace.llm.run_length_index import LENGTH, RunLengthIndex, repeated_strings, seeds, without_long_repeats
from millrace.llm.words import text_bytes


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row, from all strings of all documents."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        if i is not None:
            for at in range(len(b) - LENGTH + 1):
                own = b[at:at + LENGTH]
                first[own] = min(first.get(own, i), i)
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, dtype=bool)
        if i is not None:
            for at in range(len(b) - LENGTH + 1):
                if first[b[at:at + LENGTH]] < i:
                    gone[at:at + LENGTH] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in without_long_repeats(df).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


def repetitive(seed, n):
    """Documents of shared passages with small changes, runs of one letter, short periods and copies."""
    pick = random.Random(seed)
    letters = "abcdefg é漢\n"
    passages = ["".join(pick.choice(letters) for _ in range(pick.choice([30, 55, 90, 200, 600]))) for _ in range(25)]
    passages += ["=" * 120, "ab" * 80, "x" * 50, "common line that is in very many of these documents, word for word"]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(pick.randint(0, 6)):
            part = pick.choice(passages)
            if pick.random() < 0.4 and part:
                at = pick.randrange(len(part))
                part = part[:at] + pick.choice(letters) + part[at + 1:]
            if pick.random() < 0.3:
                part = part[pick.randrange(len(part)):]
            parts.append(part)
            parts.append("".join(pick.choice(letters) for _ in range(pick.choice([0, 1, 7, 40]))))
        texts.append("".join(parts))
    return texts + texts[:10]


@pytest.mark.parametrize("hot", [run_length_index.HOT, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(run_length_index, "HOT", hot)
    monkeypatch.setattr(run_length_index, "CHUNK", 500)
    monkeypatch.setattr(run_length_index, "CONTEXTS_PER_TASK", 300)
    texts = repetitive(hot, 220)
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    rows = [(i * 3 - 50, texts[k]) for i, k in enumerate(order)]
    long = "y".join(repetitive(9, 60))
    rows += [(9000, None), (9001, ""), (9002, "short"), (None, texts[0] + "q" * 70), (9003, "q" * 70), (9004, long),
             (9005, "head" + long), rows[5], (rows[6][0], "another text of one id " + texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn(
        "print", F.lit(1)).withColumn("spans", F.lit(2)).repartition(6)
    got, expected = found(df), brute(rows)
    assert got == expected
    assert sum(r[2] for r in got) > 20_000 and any(r[3] > 2 for r in got)


def test_empty_and_small_tables(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert without_long_repeats(empty).collect() == []
    rows = [(1, "z" * 49), (2, "z" * 49), (3, None)]
    assert found(spark.createDataFrame(rows, "doc_id int, text string")) == brute(rows)
    rows = [(2, "z" * 50), (1, "z" * 50)]
    assert found(spark.createDataFrame(rows, "doc_id int, text string")) == brute(rows)


def test_every_string_has_a_seed_at_its_own_place(monkeypatch):
    pick = random.Random(3)
    texts = ["".join(pick.choice("ab c") for _ in range(pick.choice([0, 10, 49, 50, 51, 400]))) for _ in range(80)]
    raw, offsets = text_bytes(pa.array(texts))
    row, at, key = seeds(raw, offsets)
    chosen = set(at.tolist())
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        assert all(any(p in chosen for p in range(i, i + 25)) for i in range(low, high - LENGTH + 1))
    assert ((at >= offsets[row]) & (at + run_length_index.SEED <= offsets[row + 1])).all()
    monkeypatch.setattr(run_length_index, "SLAB", 100)  # long texts are read in slabs
    again = seeds(raw, offsets)
    assert (again[1] == at).all() and (again[2] == key).all()


def test_matching_statistics_equal_brute_force():
    pick = random.Random(1)
    for _ in range(150):
        strings = [[pick.randrange(3) for _ in range(pick.randint(1, 12))] for _ in range(pick.randint(1, 8))]
        index = RunLengthIndex(np.array(sum(strings, [])), np.repeat(np.arange(len(strings)), [len(s) for s in strings]))
        patterns = np.array([[pick.randrange(4) for _ in range(10)] for _ in range(6)])
        valid = np.ones_like(patterns, dtype=bool)
        valid[0, :3], valid[1, 7:] = False, False
        got = index.statistics(patterns, valid)
        known = {tuple(s[i:j]) for s in strings for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for row in range(6):
            end = 7 if row == 1 else 10
            for col in range(10):
                length = 0
                while valid[row, col] and col + length < end and tuple(patterns[row, col:col + length + 1].tolist()) in known:
                    length += 1
                assert got[row, col] == length


def test_runs_are_fewer_than_letters_in_repetitive_text():
    strings = [[k % 7 for k in range(40)] for _ in range(50)]
    index = RunLengthIndex(np.array(sum(strings, [])), np.repeat(np.arange(50), 40))
    assert len(index.start) < 200


def test_a_context_meets_smaller_documents_only():
    data = np.zeros((4, run_length_index.WIDTH), dtype=np.uint8)
    data[1, 0] = 1  # differs in the first byte
    data[3, -1] = 1  # differs in the last byte
    reach = np.full(4, run_length_index.REACH)
    found_ = repeated_strings(np.zeros(4, dtype=np.int64), np.array([1, 2, 2, 3]), data, reach, reach)
    every = (1 << run_length_index.REACH + 1) - 1
    assert found_.tolist() == [0, every ^ 1 << run_length_index.REACH, every, every ^ 1]
