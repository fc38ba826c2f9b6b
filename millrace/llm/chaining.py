"""Substring dedup by collinear chaining: fuzzy passages that a document shares with an earlier one.

1. Seeds are five-word runs picked by winnowing: of any eight neighbouring runs at least one is kept, so twelve equal
   words always share a seed. Texts are read whole.
2. Seeds join by hash. Each occurrence is matched with one earlier occurrence only, in the document with the smallest
   id (the holder), so a passage in m documents gives m - 1 matches per seed and no pairs among them. Of seeds that are
   frequent within a task only those in its smallest document are shuffled; the others meet the holder's places later.
3. For each document and holder, matches in order in both texts are chained: a match adds ``GAIN`` words, gaps cost
   ``GAP`` per word, and the best predecessor comes from a Fenwick tree over positions in the holder.
4. Chains are aligned word by word between and beyond their seeds, and cut where text between is unlike. A passage
   counts from 40 aligned words and three quarters equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fresh, small_side, stored
from .words import SHINGLE, Words, pieces

WINNOW = 8
GAIN, GAP = 4.5, 0.1
MIN_SEEDS, MIN_WORDS = 3, 40
#: A passage has at least 3 equal words in 4.
SAME, OF = 3, 4
#: Up to so many unlike words part no passage in two; below what the shortest passage gains, so none is lost by it.
JOINED = 15
FLANK = 64
#: Seeds that a task gathers before it reduces the frequent ones, and the count that makes a seed frequent.
GATHERED, OFTEN = 1_000_000, 8
#: Seeds that a task joins, about; they are held there.
SEED_ROWS = 500_000
#: Entries of an alignment table that are held at once; gaps between seeds with a larger table are aligned in halves.
CELLS = 250_000

_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def winnowed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of the five-word runs that are the least of some eight neighbouring ones."""
    at, value = words.windows(SHINGLE)
    if not len(at):
        return at, value
    row = words.row[at]
    shift = np.cumsum(np.concatenate([[0], (row[1:] != row[:-1]).astype(np.int64)])) * (WINNOW - 1) + WINNOW - 1
    place = np.arange(len(at)) + shift
    line = np.full(int(place[-1]) + WINNOW, _LAST)
    line[place] = value
    least = line
    for step in (1, 2, 4):
        least = np.minimum(least[:-step], least[step:])  # of WINNOW values from here on
    most = least
    for step in (1, 2, 4):
        most = np.maximum(most[:-step], most[step:])  # the largest of these minima over all windows with a value
    keep = most[place - (WINNOW - 1)] == value
    return at[keep], value[keep]


NORMAL, MARKED, FREQUENT = 0, 1, 2


def _ranks(seed: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows in order of seed and doc: which occurrence of the seed in the document each is, and how many there are."""
    run = np.flatnonzero(np.concatenate([[True], (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])]))
    times = np.diff(np.concatenate([run, [len(seed)]]))
    return np.arange(len(seed)) - np.repeat(run, times), np.repeat(times, times)


def _seeds(docs: DataFrame, frequent: bool) -> DataFrame:
    """seed, doc, at, kind, place (which occurrence in the document). Without ``frequent``: all seeds, but of one that is
    frequent in a task only those in the task's smallest document, marked. With it: the other occurrences of these."""

    def reduce(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        seed, doc, at = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((at, doc, seed))
        seed, doc, at = seed[order], doc[order], at[order]
        once = np.concatenate([[True], (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])])
        seed, doc, at = seed[once], doc[once], at[once]  # repeated rows
        begins = np.flatnonzero(np.concatenate([[True], (seed[1:] != seed[:-1])]))
        size = np.diff(np.concatenate([begins, [len(seed)]]))
        often = np.repeat(size >= OFTEN, size)
        kind = np.where(often, np.where(doc == np.repeat(doc[begins], size), MARKED, FREQUENT), NORMAL)
        keep = (kind == FREQUENT) == frequent
        place = _ranks(seed, doc)[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(seed[keep].view(np.int64)), pa.array(doc[keep]), pa.array(at[keep].astype(np.int32)),
             pa.array(kind[keep].astype(np.int32)), pa.array(place[keep].astype(np.int32))],
            ["seed", "doc", "at", "kind", "place"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(piece.column(1))
                at, seed = winnowed(words)
                row = words.row[at]
                doc = piece.column(0).to_numpy(zero_copy_only=False)[row].astype(np.int64)
                parts.append((seed, doc, at - words.first[row]))
                size += len(seed)
                if size >= GATHERED:
                    yield reduce(parts)
                    parts, size = [], 0
        if size:
            yield reduce(parts)

    return docs.mapInArrow(run, "seed long, doc long, at int, kind int, place int")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches (doc, at, holder, holder_at) and, with a null doc, the holders of marked seeds (the seed in at's place)
    with all ``places`` of the seed there."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return

    def column(k: int) -> np.ndarray:
        return np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in got])

    # Most seeds occur once: they go before other columns are copied, and whole columns are held one at a time.
    seed = column(0)
    order = np.argsort(seed)
    seed = seed[order]
    same = seed[1:] == seed[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (column(3)[order] == MARKED)
    order, seed = order[shared], seed[shared]
    doc, at, kind = (column(k)[order] for k in (1, 2, 3))
    del got
    order = np.lexsort((-kind, at, doc, seed))
    seed, doc, at, kind = seed[order], doc[order], at[order], kind[order]
    once = np.concatenate([[True], (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])])[:len(seed)]
    seed, doc, at, kind = seed[once], doc[once], at[once], kind[once]  # repeated rows
    if not len(seed):
        return
    begins = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
    sizes = np.diff(np.concatenate([begins, [len(seed)]]))
    first = np.repeat(begins, sizes)
    # The second occurrence in a document is matched with the holder's second, and so on, from the first again after the last.
    count, times = _ranks(seed, doc)
    match = first + count % times[first]
    other = np.flatnonzero(doc != doc[first])
    marked = begins[np.add.reduceat((kind == MARKED).astype(np.int64), begins) > 0]
    n, m = len(other), len(marked)
    starts = np.concatenate([[0], np.cumsum(times[marked])])
    held = np.repeat(marked - starts[:-1], times[marked]) + np.arange(starts[-1])
    places = pa.ListArray.from_arrays(
        pa.array(np.concatenate([np.zeros(n, dtype=np.int64), starts]).astype(np.int32)), pa.array(at[held].astype(np.int32)))
    unknown = np.arange(n + m) >= n
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([doc[other], doc[marked]]), mask=unknown),
         pa.array(np.concatenate([at[other].astype(np.int64), seed[marked]])),
         pa.array(np.concatenate([doc[first[other]], doc[marked]])),
         pa.array(np.concatenate([at[match[other]], at[marked]]).astype(np.int32)), places],
        ["doc", "at", "holder", "holder_at", "places"])


def chains(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Chains among matches (positions ``x`` and ``y``, in order of x, then of falling y): indices of their matches.

    The score of a match is ``GAIN`` plus the best earlier score less ``GAP`` for each word between, on average of both
    sides. A Fenwick tree over y holds the best score so far, with its distance from the origin added back.
    """
    n = len(x)
    place = np.searchsorted(np.unique(y), y).tolist()
    depth = [GAP / 2 * s for s in (x.astype(np.int64) + y.astype(np.int64)).tolist()]
    top = max(place) + 1
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (top + 1)
    score, back = [0.0] * n, [-1] * n
    for i in range(n):
        best, k = (-1e18, -1), place[i]  # strictly smaller y
        while k > 0:
            if tree[k] > best:
                best = tree[k]
            k &= k - 1
        value = best[0] - depth[i]
        if value > 0:
            score[i], back[i] = GAIN + value, best[1]
        else:
            score[i] = GAIN
        mine, k = (score[i] + depth[i], i), place[i] + 1
        while k <= top:
            if mine > tree[k]:
                tree[k] = mine
            k += k & -k
    used, found = [False] * n, []
    for end in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        i = end
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if len(chain) >= MIN_SEEDS:
            found.append(np.array(chain[::-1]))
    return found


CHAIN = ("doc long, holder long, doc_from int, doc_to int, holder_from int, holder_to int, "
         "x array<int>, y array<int>")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not got:
        return
    doc, at, holder, holder_at = (np.concatenate(c).astype(np.int64) for c in zip(*got))
    order = np.lexsort((-holder_at, at, holder, doc))
    doc, at, holder, holder_at = doc[order], at[order], holder[order], holder_at[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (holder[1:] != holder[:-1])])
    begins = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([begins, [len(doc)]]))
    rows = []
    for begin, size in zip(begins[sizes >= MIN_SEEDS].tolist(), sizes[sizes >= MIN_SEEDS].tolist()):
        x, y = at[begin:begin + size], holder_at[begin:begin + size]
        for chain in chains(x, y):
            cx, cy = x[chain], y[chain]
            # Flanks can add less than what is missing to the shortest passage.
            if cx[-1] - cx[0] + SHINGLE + 2 * FLANK >= MIN_WORDS:
                rows.append((doc[begin], holder[begin], cx, cy))
        if len(rows) >= 2000:
            yield _chain_batch(rows)
            rows = []
    if rows:
        yield _chain_batch(rows)


def _chain_batch(rows) -> pa.RecordBatch:
    def cut(values):  # slices begin and end on multiples of FLANK, so that many chains ask for the same ones
        low = [max(0, (int(v[0]) - FLANK) // FLANK * FLANK) for v in values]
        return low, [-(-(int(v[-1]) + SHINGLE + FLANK) // FLANK) * FLANK for v in values]

    x, y = [r[2] for r in rows], [r[3] for r in rows]
    (a, b), (c, d) = cut(x), cut(y)
    numbers = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([int(r[0]) for r in rows], pa.int64()), pa.array([int(r[1]) for r in rows], pa.int64()),
         *(pa.array(v, pa.int32()) for v in (a, b, c, d)),
         pa.array([v.tolist() for v in x], numbers), pa.array([v.tolist() for v in y], numbers)],
        ["doc", "holder", "doc_from", "doc_to", "holder_from", "holder_to", "x", "y"])


def _slices(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, low, high, variant (hash of the row's text), words (hashes from word ``low`` to before ``high``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                words = Words(piece.column("text"))
                got = [words.hash[words.first[r]:words.first[r + 1]][low:high].tobytes() for r, (low, high) in enumerate(
                    zip(piece.column("low").to_pylist(), piece.column("high").to_pylist()))]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc"), piece.column("low"), piece.column("high"), piece.column("variant"),
                     pa.array(got, pa.binary())], ["doc", "low", "high", "variant", "words"])

    asked = stored(wanted, "slices-asked")
    keyed = docs.select(F.col("doc_id").alias("id"), "text")
    return keyed.join(small_side(asked, 24), keyed["id"] == asked["doc"]).select(
        "doc", "low", "high", F.xxhash64("text").alias("variant"), "text").mapInArrow(
        run, "doc long, low int, high int, variant long, words binary")


def _lengths(a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
    """Lengths of the longest common subsequences of the first words of ``a``, one more each time, with every start of ``b``."""
    row = np.zeros(len(b) + 1, dtype=np.int32)
    yield row
    for word in a:
        new = np.zeros_like(row)
        np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == word)), out=new[1:])
        row = new
        yield row


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both word lists of a longest common subsequence. Larger tables are halved, so memory stays linear."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    begin = n if same.all() else int(same.argmin())
    same = a[len(a) - n + begin:][::-1] == b[len(b) - n + begin:][::-1]
    end = n - begin if same.all() else int(same.argmin())
    head, tail = np.arange(begin), np.arange(-end, 0)
    inner_a, inner_b = a[begin:len(a) - end], b[begin:len(b) - end]
    if not len(inner_a) or not len(inner_b):
        i = j = np.zeros(0, dtype=np.int64)
    elif len(inner_a) > len(inner_b):
        j, i = _inner(inner_b, inner_a)
    else:
        i, j = _inner(inner_a, inner_b)
    return (np.concatenate([head, i + begin, tail + len(a)]), np.concatenate([head, j + begin, tail + len(b)]))


def _inner(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(a) > 1 and len(a) * len(b) > CELLS:
        half = len(a) // 2
        *_, left = _lengths(a[:half], b)
        *_, right = _lengths(a[half:][::-1], b[::-1])
        cut = int((left + right[::-1]).argmax())
        (i, j), (k, m) = _common(a[:half], b[:cut]), _common(a[half:], b[cut:])
        return np.concatenate([i, k + half]), np.concatenate([j, m + cut])
    table = np.stack(list(_lengths(a, b)))
    i, j, out = len(a), len(b), []
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    i, j = np.array(out[::-1], dtype=np.int64).reshape(-1, 2).T
    return i, j


def _extend(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of equal words up to where two lists stop being alike, seen from their start."""
    n = min(len(a), len(b), FLANK)
    if not n:
        return np.zeros(0, dtype=np.int64)
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    at = int(score.argmax())
    return np.flatnonzero(same[:at + 1]) if score[at] > 0 else np.zeros(0, dtype=np.int64)


def _equal(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the equal words of a chain, in order, in both word lists. ``x``, ``y``: where seeds begin."""
    end_a, end_b = x[-1] + SHINGLE, y[-1] + SHINGLE
    before, after = _extend(a[:x[0]][::-1], b[:y[0]][::-1])[::-1], _extend(a[end_a:], b[end_b:])
    i, j = [x[0] - 1 - before], [y[0] - 1 - before]
    for k in range(len(x) - 1):
        p, q = _common(a[x[k]:x[k + 1]], b[y[k]:y[k + 1]])
        i.append(p + x[k])
        j.append(q + y[k])
    last = np.flatnonzero(a[x[-1]:end_a] == b[y[-1]:end_b])
    return np.concatenate([*i, last + x[-1], after + end_a]), np.concatenate([*j, last + y[-1], after + end_b])


def align(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[int, int, int, int, int]:
    """Ends of a whole chain in both word lists (from, to, from, to) and its equal words."""
    i, j = _equal(a, b, x, y)
    return int(i[0]), int(i[-1]) + 1, int(j[0]), int(j[-1]) + 1, len(i)


def passages(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The passages of a chain, each as :func:`align` gives it.

    Runs of equal words without a gap are joined so that every passage has enough words and enough of them equal, and
    the passages together have the most equal words, less unequal ones and ``JOINED`` for each passage. Text between
    passages belongs to none.
    """
    i, j = _equal(a, b, x, y)
    if not len(i):
        return []
    gap = np.flatnonzero((np.diff(i) > 1) | (np.diff(j) > 1)) + 1
    first, stop = np.concatenate([[0], gap]), np.concatenate([gap, [len(i)]])
    begin_a, begin_b, end_a, end_b = i[first], j[first], i[stop - 1] + 1, j[stop - 1] + 1
    best, back = np.zeros(len(first) + 1, dtype=np.int64), []
    for k in range(len(first)):
        length = np.maximum(end_a[k] - begin_a[:k + 1], end_b[k] - begin_b[:k + 1])
        equal = stop[k] - first[:k + 1]
        total = np.where((end_a[k] - begin_a[:k + 1] >= MIN_WORDS) & (equal * OF >= SAME * length),
                         best[:k + 1] + 2 * equal - length - JOINED, -1)
        at = int(total.argmax())
        taken = total[at] > best[k]
        best[k + 1] = total[at] if taken else best[k]
        back.append(at if taken else -1)
    found, k = [], len(first) - 1
    while k >= 0:
        at = back[k]
        if at >= 0:
            found.append((int(begin_a[at]), int(end_a[k]), int(begin_b[at]), int(end_b[k]), int(stop[k] - first[at])))
        k = at - 1 if at >= 0 else k - 1
    return found[::-1]


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        table = {name: batch.column(name).to_pylist() for name in (
            "doc", "holder", "doc_from", "holder_from", "variant")}
        for k in range(batch.num_rows):
            a, b = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint64) for c in ("doc_words", "holder_words"))
            low, there = table["doc_from"][k], table["holder_from"][k]
            x = batch.column("x")[k].values.to_numpy() - low
            y = batch.column("y")[k].values.to_numpy() - there
            if x[-1] + SHINGLE > len(a) or y[-1] + SHINGLE > len(b):
                continue  # seeds of another row with the same id
            for begin, end, begin_b, end_b, equal in passages(a, b, x, y):
                rows.append((table["doc"][k], table["variant"][k], low + begin, low + end, table["holder"][k],
                             there + begin_b, there + end_b, equal))
        columns = list(zip(*rows)) if rows else [[]] * 8
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(v) for v in c], pa.int64()) for c in columns],
            ["doc_id", "variant", "from_word", "to_word", "source_id", "source_from", "source_to", "equal_words"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages that repeat one in a document with a smaller id: doc_id, variant, from_word, to_word, source_id,
    source_from, source_to, equal_words.

    Word positions count from 0, ends are exclusive; ``variant`` is xxhash64 of the row's text. A passage has at least
    40 words, three quarters of them equal to the source's in order (A-Z lower-cased). Rows without an id take no
    part; null, empty and short texts have no passages; repeated rows count as one document, and rows that share an id
    are not compared with each other. An empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, -(-size // (28 * SEED_ROWS)))
    found = stored(_seeds(docs, False).drop("place").repartition(parts, "seed").mapInArrow(
        _joined, "doc long, at long, holder long, holder_at int, places array<int>"), "matches")
    holders = stored(found.where("doc IS NULL").select(
        F.col("at").alias("seed"), F.col("holder").alias("first"), "places"), "holders")
    held = holders.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("places")), F.lit(0)).alias("places")).first()
    often = _seeds(docs, True).select("seed", "doc", "at", "place").join(
        small_side(holders, 24, held["n"] + held["places"] // 6), "seed").where("doc != first").select(
        "doc", F.col("at").cast("long").alias("at"), F.col("first").alias("holder"),
        F.expr("places[place % size(places)]").alias("holder_at"))
    matches = found.where("doc IS NOT NULL").select("doc", "at", "holder", "holder_at").unionByName(often).distinct()
    made = stored(matches.repartition("doc").mapInArrow(_chained, CHAIN), "chains")
    wanted = made.select("doc", F.col("doc_from").alias("low"), F.col("doc_to").alias("high")).union(
        made.select("holder", "holder_from", "holder_to")).distinct()
    slices = stored(_slices(docs, wanted), "slices")
    own = slices.select("doc", F.col("low").alias("doc_from"), F.col("high").alias("doc_to"), "variant",
                        F.col("words").alias("doc_words"))
    there = slices.select(F.col("doc").alias("holder"), F.col("low").alias("holder_from"),
                          F.col("high").alias("holder_to"), F.col("words").alias("holder_words"))
    both = made.join(own, ["doc", "doc_from", "doc_to"]).join(there, ["holder", "holder_from", "holder_to"])
    return both.select(
        "doc", "holder", "doc_from", "holder_from", "variant", "x", "y", "doc_words", "holder_words").mapInArrow(
        _aligned, "doc_id long, variant long, from_word long, to_word long, source_id long, source_from long, "
                  "source_to long, equal_words long").distinct()


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages cut out of the text, from the first byte of their first word to the last of their
    last; the earliest holder keeps its passage. Columns and rows stay; ``length_col``, if there, is counted anew."""
    spans = stored(repeated_passages(docs, id_col, text_col).groupBy("doc_id", "variant").agg(
        F.sort_array(F.collect_set(F.struct("from_word", "to_word"))).alias("spans")), "spans")
    names = {n: fresh(docs, "__cut_" + n) for n in ("doc_id", "variant", "spans")}
    cuts = small_side(spans.select(*[F.col(n).alias(m) for n, m in names.items()]), 64)
    joined = docs.join(
        cuts, (docs[id_col].cast("long") == F.col(names["doc_id"]))
        & (F.xxhash64(docs[text_col]) == F.col(names["variant"])), "left").select(*docs.columns, names["spans"])
    at, name = docs.columns.index(text_col), names["spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(at), batch.column(batch.num_columns - 1)
            rows = np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False))
            if len(rows):
                new = texts.to_pylist()
                for r in rows.tolist():
                    new[r] = _cut(new[r], spans[r].as_py())
                texts = pa.array(new, texts.type)
            columns = list(batch.columns[:-1])
            columns[at] = texts
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    cut = joined.mapInArrow(run, docs.schema)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        cut = cut.withColumn(length_col, F.length(text_col).cast(kind)).select(*docs.columns)
    return cut


def _cut(text: str, spans: list[dict]) -> str:
    words = Words(pa.array([text]))
    raw, out, upto = text.encode(), [], 0
    for span in spans:
        begin, end = span["from_word"], min(span["to_word"], len(words.start))
        if begin >= end:
            continue
        first, last = int(words.start[begin]), int(words.end[end - 1])
        out.append(raw[upto:max(upto, first)])
        upto = max(upto, last)
    return (b"".join(out) + raw[upto:]).decode()
