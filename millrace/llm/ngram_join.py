"""N-gram Jaccard join: which documents share at least three quarters of their five-word shingles.

1. Every text becomes a set of 64-bit shingle hashes. Equal sets collapse into one class by a fingerprint of the set,
   with a bitmap of hashed shingles (two bits of room for each).
2. Two sets that link share shingles among the first quarter of each in any fixed order of all shingles. The order
   here is by hash, with very frequent shingles last. The shingles of these first quarters are the keys of tiles; in a
   tile, only sets with sizes within 3 : 4 meet.
3. A small tile gives all its pairs; in two large sets at least three keys must agree. Large tiles first compare every
   set with one centre. While large tiles still hold several components, they are dealt again by size band, and within
   a band by blocks of bounded bytes on both sides: the sets outside the largest component meet the sets of other
   components in their own band and its neighbours. First each is joined with its likeliest partner only, round by
   round. When that finds no more, the pairs that bitmaps still allow make clusters, for which a tile returns at most
   one pair a set. A set is in one cluster only; there the sets meet with their sorted arrays, dealt in the same way,
   pairs are counted exactly, and a block returns one link for any two components, so at most one a set again.
4. In a pair, the bits that one bitmap has and the other lacks bound the overlap from above. Pairs that pass are
   counted exactly on sorted arrays, the likeliest of each set first; pairs within a component are not counted again.

The order of shingles needs the frequent ones only roughly; it changes the work, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import BROADCAST_BYTES, small_side, stored
from .components import components
from .words import mix, pieces, shingle_sets

#: Frequent shingles are those in more documents than total / this; so there are at most as many.
FREQUENT_SHARE = 1 << 20
FREQUENT_LEAST = 64
#: Shingles gathered by a task before it counts them, and the count from which it reports one.
COUNTED, REPORTED = 2_000_000, 3
SMALL_TILE = 8
#: From this size on, both sets of a pair must agree in so many keys; each then has that many less one more.
LARGE_SET, LARGE_KEYS = 12, 3
#: Rows of one side of a block at most, and bytes of what a block holds of one side.
BLOCK, BLOCK_BYTES = 4096, 32 << 20
#: Sizes of a band lie within this ratio; it is over 4 : 3, so sets that link are in one band or in neighbours.
BAND = 1.34
#: Keys a task sorts, as long as there are no more than so many tasks; beyond that the tasks grow, and Spark spills.
TILE_ROWS, TILE_TASKS = 600_000, 50_000
#: Rows of sorted keys that a task looks at together.
CHUNK = 1 << 17
#: Rounds at most in which sets of large tiles are joined with their likeliest partner before all pairs are tried.
ROUNDS = 2


def _bitmap(shingles: np.ndarray) -> bytes:
    width = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    bits = np.zeros(width, dtype=bool)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _fingerprint(shingles: np.ndarray) -> int:
    total = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(shingles))], dtype=np.uint64)).view(np.int64)[0])


def _read(docs: DataFrame) -> DataFrame:
    """doc_id, n, class (fingerprint; null without words), bits; and rows without them that hold what a task counted of
    its shingles (key, times), those left out that it saw less than ``REPORTED`` times."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "class", "bits", "key", "times"]
        lists, waiting, gathered = pa.list_(pa.int64()), [], 0

        def counted(ids: pa.DataType) -> pa.RecordBatch:
            key, times = np.unique(np.concatenate(waiting), return_counts=True)
            often = times >= REPORTED
            return pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, t) for t in (ids, pa.int64(), pa.int64(), pa.binary())),
                 *(pa.array([c[often]], lists) for c in (key.view(np.int64), times))], names)

        for batch in batches:
            for piece in pieces(batch, "text"):
                size, own, bits = [], [], []
                for shingles in shingle_sets(piece.column(1)):
                    size.append(len(shingles))
                    own.append(_fingerprint(shingles) if len(shingles) else None)
                    bits.append(_bitmap(shingles) if len(shingles) else None)
                    waiting.append(shingles)
                    gathered += len(shingles)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(size, pa.int64()), pa.array(own, pa.int64()), pa.array(bits, pa.binary()),
                     pa.nulls(len(size), lists), pa.nulls(len(size), lists)], names)
                if gathered >= COUNTED:
                    yield counted(piece.column(0).type)
                    waiting, gathered = [], 0
        if gathered:
            yield counted(piece.column(0).type)

    return docs.mapInArrow(run, f"doc_id {kind}, n long, class long, bits binary, key array<long>, times array<long>")


def _frequent(counted: DataFrame, total: int) -> np.ndarray:
    """The very frequent shingles, sorted: at most ``FREQUENT_SHARE`` numbers whatever the corpus."""
    least = max(FREQUENT_LEAST, total // FREQUENT_SHARE)
    each = counted.select(F.explode(F.arrays_zip("key", "times")).alias("one")).select("one.key", "one.times")
    found = each.groupBy("key").agg(F.sum("times").alias("n")).where(F.col("n") > least)
    return np.sort(found.select("key").toArrow()["key"].to_numpy().view(np.uint64))


def _keys(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """key, class, n (negative: the key is frequent): the first quarter of each set, plus what large sets add."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for piece in pieces(batch, "text"):
                keys, own, size = [], [], []
                for shingles in shingle_sets(piece.column(1)):
                    n = len(shingles)
                    if not n:
                        continue
                    last = np.zeros(n, dtype=bool)
                    if len(known):
                        at = np.searchsorted(known, shingles)
                        last = known[np.minimum(at, len(known) - 1)] == shingles
                    take = min(n, n - (3 * n + 3) // 4 + (LARGE_KEYS if n >= LARGE_SET else 1))
                    rare = shingles[~last][:take]
                    common = shingles[last][:take - len(rare)]
                    keys += [rare, common]
                    own.append(np.full(take, _fingerprint(shingles)))
                    size.append(np.where(np.arange(take) < len(rare), n, -n))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(own)),
                         pa.array(np.concatenate(size).astype(np.int32))], ["key", "class", "n"])

    return docs.mapInArrow(run, "key long, class long, n int")


def _chunks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[list[np.ndarray], bool]]:
    """The first ``n`` columns as arrays of about ``CHUNK`` rows, and whether more rows may follow."""
    waiting: list[list[np.ndarray]] = [[np.zeros(0, dtype=np.int64)] * n]
    size = 0
    for batch in batches:
        waiting.append([c.to_numpy(zero_copy_only=False) for c in batch.columns[:n]])
        size += batch.num_rows
        if size >= CHUNK:
            yield [np.concatenate(c) for c in zip(*waiting)], True
            waiting, size = waiting[:1], 0
    yield [np.concatenate(c) for c in zip(*waiting)], False


def _close(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return 4 * np.minimum(left, right) >= 3 * np.maximum(left, right)


PAIR, ROW, OFTEN = 0, 1, 2


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, class, n) in order of key and class: pairs (a, b, how often they must occur) and the rows of large
    tiles (key, class, n). A tile of any size is passed through: only a few of its rows are held. Rows of frequent keys
    (negative n) come back as they are, n positive."""
    held = [np.zeros(0, dtype=np.int64)] * 3  # rows of the last key, which may go on
    centre = None  # class and n of the first row, if the held row is the last of a large tile that was passed on
    for rows, more in _chunks(batches, 3):
        often = rows[2] < 0
        if often.any():
            found = [np.full(int(often.sum()), OFTEN), *(c[often] for c in rows[:2]), -rows[2][often].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["kind", "x", "y", "z"])
            rows = [c[~often] for c in rows]
        key, own, n = (np.concatenate(c) for c in zip(held, rows))
        if not len(key):
            continue
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        key, own, n = key[new], own[new], n[new]
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.concatenate([begins, [len(key)]]))
        big, centre_own, centre_n = sizes > SMALL_TILE, own[begins], n[begins]
        if centre is not None:
            big[0], centre_own[0], centre_n[0] = True, *centre
        small = np.repeat(~big, sizes)
        large = np.flatnonzero(~small)
        if centre is not None:
            large = large[1:]
        held, centre = [c[:0] for c in (key, own, n)], None
        if more and big[-1]:
            held, centre = [c[-1:] for c in (key, own, n)], (centre_own[-1], centre_n[-1])
        elif more:
            held = [c[begins[-1]:] for c in (key, own, n)]
            small[begins[-1]:] = False
        out: list[list[np.ndarray]] = []

        def pairs(x: np.ndarray, n_x: np.ndarray, y: np.ndarray, n_y: np.ndarray, strict: bool) -> None:
            keep = _close(n_x, n_y) & (x != y)
            x, n_x, y, n_y = x[keep], n_x[keep], y[keep], n_y[keep]
            need = np.where((n_x >= LARGE_SET) & (n_y >= LARGE_SET) & strict, LARGE_KEYS, 1)
            out.append([np.full(len(x), PAIR), np.minimum(x, y), np.maximum(x, y), need])

        for step in range(1, min(SMALL_TILE, len(key))):
            i = np.flatnonzero(small[:len(key) - step] & (key[:len(key) - step] == key[step:]))
            pairs(own[i], n[i], own[i + step], n[i + step], True)
        pairs(np.repeat(centre_own, sizes)[large], np.repeat(centre_n, sizes)[large], own[large], n[large], False)
        out.append([np.full(len(large), ROW), key[large], own[large], n[large]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["kind", "x", "y", "z"])


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) at a narrower width."""
    while words.shape[-1] * 64 > width:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


def _most(n_left, n_right, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap from bitmaps of one width."""
    return np.minimum(n_left - np.bitwise_count(left & ~right).sum(axis=-1, dtype=np.int64),
                      n_right - np.bitwise_count(right & ~left).sum(axis=-1, dtype=np.int64))


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs (a, b, n_a, n_b, bits_a, bits_b) whose bitmaps allow a link."""
    for batch in batches:
        keep = []
        for n_a, n_b, bits_a, bits_b in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
            left, right = np.frombuffer(bits_a, np.uint64), np.frombuffer(bits_b, np.uint64)
            width = 64 * min(len(left), len(right))
            share = int(_most(n_a, n_b, _folded(left, width), _folded(right, width))) / (n_a + n_b)
            keep.append(share if 7 * share >= 3 - 1e-9 else None)
        share = pa.array(keep, pa.float64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], share], ["a", "b", "share"]).filter(share.is_valid())


def _overlaps(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    if len(left) > len(right):
        left, right = right, left
    at = np.searchsorted(right, left)
    both = int((right[np.minimum(at, len(right) - 1)] == left).sum())
    return 7 * both >= 3 * (len(left) + len(right))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the pairs (a, b, set_a, set_b) that link."""
    for batch in batches:
        keep = [_overlaps(*(np.frombuffer(s.as_buffer(), np.uint64) for s in pair))
                for pair in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that bitmaps allow, with the share that bounds their overlap."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("class").alias(side), F.col("n").alias("n_" + side),
                                       F.col("bits").alias("bits_" + side)), side)
    return pairs.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(_bound, "a long, b long, share double")


def _arrays(docs: DataFrame, facts: DataFrame, wanted: DataFrame) -> DataFrame:
    """class, set (sorted shingles) of the wanted classes, from one document of each."""
    ids = facts.join(wanted, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("want"))
    ids = stored(ids.select("want").distinct(), "near-docs")
    texts = docs.join(small_side(ids, 16), docs["doc_id"].eqNullSafe(ids["want"]), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = [(_fingerprint(s), s.tobytes()) for s in shingle_sets(piece.column(1)) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f for f, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())],
                    ["class", "set"])

    arrays = stored(texts.mapInArrow(run, "class long, set binary"), "near-sets")
    if arrays.groupBy("class").count().where("count > 1").limit(1).count():
        arrays = arrays.dropDuplicates(["class"])  # rows that share an id
    return arrays


def _linked(near: DataFrame, docs: DataFrame, facts: DataFrame, known: DataFrame | None = None) -> DataFrame | None:
    """The components (node, label) that the pairs of ``near`` (a, b, share) make if they link; None if none does. With
    components ``known`` before, ``near`` has about one pair of each class: all are counted at once, and join these.

    Each class first tries its likeliest pair; then the pairs that still lie between components.
    """
    near = stored(near, "near")
    if near.isEmpty():
        return None
    ends = near.select(F.col("a").alias("class"), "a", "b", "share").union(near.select("b", "a", "b", "share"))
    arrays = _arrays(docs, facts, ends.select("class").distinct())

    def exact(pairs: DataFrame) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(arrays.select(F.col("class").alias(side), F.col("set").alias("set_" + side)), side)
        return stored(pairs.select("a", "b", "set_a", "set_b").mapInArrow(_exact, "a long, b long"), "links")

    if known is not None:
        every = exact(near.select("a", "b"))
        return None if every.isEmpty() else components(every, known)
    likely = ends.groupBy("class").agg(F.max(F.struct("share", "a", "b")).alias("best"))
    likely = likely.select("best.a", "best.b").distinct()
    first = exact(likely)
    labels = components(first)
    rest = near.select("a", "b")
    for side in "ab":
        rest = rest.join(labels.select(F.col("node").alias(side), F.col("label").alias("label_" + side)), side, "left")
    open_pairs = rest.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")
    open_pairs = stored(open_pairs.join(likely, ["a", "b"], "left_anti"), "open-pairs")
    more = None if open_pairs.isEmpty() else exact(open_pairs)
    if more is None or more.isEmpty():
        return None if first.isEmpty() else labels
    return components(more, labels)


def _by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of ``tile``, a tile at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1).tolist(), len(tile)]
        for start, end in zip(cuts, cuts[1:]):
            if held and held[-1].column(0)[0].as_py() != tile[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


ASKS, BOTH = 1, 2  # roles of a row in a tile; 0 is only asked


def _allowed(table: pa.Table, label: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per asking row of a tile: its index, the rows of other labels that bitmaps allow, and the shares that bound the
    overlaps. The caller may merge labels on the way."""
    role, n = (table[k].to_numpy() for k in ("role", "n"))
    bits = [np.frombuffer(b.as_buffer(), np.uint64) for b in table["bits"]]
    has = np.flatnonzero(role != ASKS)
    widths = np.array([len(bits[r]) * 64 for r in has])
    by_width = [(w, has[widths == w], np.stack([bits[r] for r in has[widths == w]])) for w in np.unique(widths).tolist()]
    for ask in np.flatnonzero(role).tolist():
        rows, shares = [], []
        for width, there, words in by_width:
            near = np.flatnonzero(_close(n[there], n[ask]) & (label[there] != label[ask]))
            if not len(near):
                continue
            narrow = min(width, len(bits[ask]) * 64)
            most = _most(n[ask], n[there[near]], _folded(bits[ask], narrow), _folded(words[near], narrow))
            share = most / (n[ask] + n[there[near]])
            hit = 7 * share >= 3 - 1e-9
            rows.append(there[near][hit])
            shares.append(share[hit])
        if rows and sum(map(len, rows)):
            yield ask, np.concatenate(rows), np.concatenate(shares)


def _ends(own: np.ndarray, left: list[int], right: list[int]) -> list[pa.Array]:
    x, y = own[np.array(left, dtype=np.int64)], own[np.array(right, dtype=np.int64)]
    return [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))]


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles (tile, key, role, class, n, label, bits): each asking row with its likeliest partner."""
    for table in _by_tile(batches):
        left, right, best = [], [], []
        for ask, rows, shares in _allowed(table, table["label"].to_numpy()):
            at = int(shares.argmax())
            left.append(ask)
            right.append(int(rows[at]))
            best.append(float(shares[at]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([table["key"][0].as_py()] * len(left), pa.int64()), *_ends(table["class"].to_numpy(), left, right),
             pa.array(best, pa.float64())], ["key", "a", "b", "share"])


def _clustered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles: pairs (a, b) that connect all rows which the allowed pairs connect, at most one a row."""
    for table in _by_tile(batches):
        cluster, left, right = np.arange(table.num_rows), [], []
        for ask, rows, _ in _allowed(table, table["label"].to_numpy()):
            others, at = np.unique(cluster[rows], return_index=True)
            new = others != cluster[ask]
            if new.any():
                left += [ask] * int(new.sum())
                right += rows[at[new]].tolist()
                cluster[np.isin(cluster, others)] = cluster[ask]
        yield pa.RecordBatch.from_arrays(_ends(table["class"].to_numpy(), left, right), ["a", "b"])


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles (tile, key, role, class, n, label, bits, set): links (a, b) that join all labels which links join."""
    for table in _by_tile(batches):
        label, left, right = table["label"].to_numpy().copy(), [], []
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table["set"]]
        for ask, rows, shares in _allowed(table, label):
            for row in rows[np.argsort(-shares, kind="stable")].tolist():
                if label[row] != label[ask] and _overlaps(sets[ask], sets[row]):
                    label[label == label[row]] = label[ask]
                    left.append(ask)
                    right.append(row)
        yield pa.RecordBatch.from_arrays(_ends(table["class"].to_numpy(), left, right), ["a", "b"])


def _open_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (key, class, n, label, outside) of large tiles with more than one component; outside its largest one."""
    labelled = stored(rows.select("key", "class", "n").join(labels, F.col("class") == labels["node"], "left").select(
        "key", "class", "n", F.coalesce("label", "class").alias("label")), "tile-labels")
    groups = labelled.groupBy("key", "label").agg(F.count("*").alias("rows"))
    tiles = groups.groupBy("key").agg(F.count("*").alias("labels"), F.max_by("label", "rows").alias("largest"))
    return stored(labelled.join(tiles.where("labels > 1").select("key", "largest"), "key").select(
        "key", "class", "n", "label", (F.col("label") != F.col("largest")).alias("outside")), "open-rows")


def _dealt(rows: DataFrame, facts: DataFrame, shingle_bytes: float) -> DataFrame:
    """``rows`` with what ``facts`` has of their classes, in tiles.

    A key with few rows is one tile and each of its rows is there once. Others have a tile for each band and block on
    either side; rows outside the largest component ask in their own band and its neighbours. ``shingle_bytes`` is
    what a row brings along for each shingle of its set; it bounds the blocks.
    """
    rows = rows.withColumn("band", F.floor(F.log(BAND, F.col("n").cast("double"))))
    counts = rows.groupBy("key", "band").agg(F.count("*").alias("rows"), F.count_if("outside").alias("asks"),
                                             (F.sum("n") * shingle_bytes).alias("bytes"))
    whole = counts.groupBy("key").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).select(
        "key", ((F.col("rows") > BLOCK) | (F.col("bytes") > BLOCK_BYTES)).alias("split"))
    whole = stored(whole.where("split").select("key"), "split-keys")
    single = rows.join(whole, "key", "left_anti").withColumn("tile", F.xxhash64("key")).withColumn(
        "role", F.when(F.col("outside"), BOTH).otherwise(0))
    columns = ["tile", "key", "role", "class", "n", "label"]
    dealt = single.select(*columns)
    if not whole.isEmpty():
        room = F.greatest(F.lit(1.0), F.least(
            F.lit(float(BLOCK)), BLOCK_BYTES / (shingle_bytes * F.pow(F.lit(BAND), F.col("band") + 1))))
        counts = counts.join(whole, "key", "left_semi")
        beside = F.explode(F.array(*(F.col("band") + step for step in (-1, 0, 1)))).alias("band")
        near = counts.select("key", beside, "asks").groupBy("key", "band").agg(F.sum("asks").alias("asks"))
        blocks = stored(counts.select("key", "band", "rows").join(near, ["key", "band"]).where("asks > 0").select(
            "key", "band", F.ceil(F.col("rows") / room).alias("blocks"), F.ceil(F.col("asks") / room).alias("parts")),
            "blocks")
        tile = F.xxhash64("key", "band", "block", "part").alias("tile")
        own = rows.join(blocks, ["key", "band"]).withColumn(
            "block", F.pmod(F.xxhash64("class"), "blocks")).withColumn(
            "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        asks = rows.where("outside").select("key", beside, "class", "n", "label").join(
            blocks, ["key", "band"]).withColumn("part", F.pmod(F.xxhash64("class"), "parts")).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        for side, role in ((own, 0), (asks, ASKS)):
            dealt = dealt.unionByName(side.select(tile, "key", F.lit(role).alias("role"), "class", "n", "label"))
    wanted = stored(facts.join(rows.select("class").distinct(), "class", "left_semi"), "open-sets")
    brought = [c for c in wanted.columns if c != "class"]
    size = wanted.agg(F.sum(sum((F.length(c) for c in brought), F.lit(48)))).first()[0] or 0
    if size <= BROADCAST_BYTES:  # then what a set brings need not travel with each of its rows
        dealt = dealt.repartition("tile").join(F.broadcast(wanted), "class")
    else:
        dealt = dealt.join(wanted, "class").repartition("tile")
    return dealt.select(*columns, *brought).sortWithinPartitions("tile")


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of all pairs of a class, that with the largest share."""
    ends = pairs.select(F.col("a").alias("class"), "a", "b", "share").union(pairs.select("b", "a", "b", "share"))
    return ends.groupBy("class").agg(F.max(F.struct("share", "a", "b")).alias("best")).select("best.*").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id it reaches by links, itself included).

    Documents with fewer than five words have their whole sequence as one shingle. Null, empty and blank texts have
    no shingles, link with nothing and are their own component. Equal texts link whatever their ids; a null id counts
    only where a component has no other. Repeated rows give repeated results, an empty table none; texts are used
    whole at any length; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    read = stored(_read(docs), "sets")
    facts = read.where("n IS NOT NULL").select("doc_id", "n", "class", "bits")
    total = facts.agg(F.sum("n")).first()[0] or 0
    slim = facts.where("class IS NOT NULL")
    sets = stored(slim.select("class", "n", "bits").dropDuplicates(["class"]), "classes")
    keys = _keys(docs, _frequent(read.where("n IS NULL").select("key", "times"), total))
    parts = min(TILE_TASKS, max(8, -(-total * 27 // (100 * TILE_ROWS))))
    # Rows of a frequent key go through the same shuffle, dealt over all tasks by class.
    salt = F.when(F.col("n") < 0, F.col("class")).otherwise(F.lit(0).cast("long"))
    found = stored(keys.repartition(parts, "key", salt).sortWithinPartitions("key", "class").mapInArrow(
        _tiles, "kind long, x long, y long, z long"), "tiles")
    often = stored(found.where(F.col("kind") == OFTEN).groupBy(F.col("x").alias("key"), F.col("y").alias("class")).agg(
        F.first("z").alias("n")), "frequent-keys")
    centre = stored(often.groupBy("key").agg(F.min(F.struct("class", "n")).alias("centre")), "frequent-centres")
    stars = often.join(small_side(centre, 32), "key").where(
        (F.col("class") != F.col("centre.class"))
        & (F.least("n", "centre.n") * 4 >= F.greatest("n", "centre.n") * 3)
    ).select(F.col("centre.class").alias("a"), F.col("class").alias("b"), F.lit(1).cast("long").alias("need"))
    pairs = found.where(F.col("kind") == PAIR).select(
        F.col("x").alias("a"), F.col("y").alias("b"), F.col("z").alias("need")).unionByName(stars)
    first = pairs.groupBy("a", "b").agg(F.count("*").alias("times"), F.min("need").alias("need")).where(
        "times >= need").select("a", "b")
    labels = _linked(_bounded(first, sets), docs, slim)
    if labels is None:
        labels = docs.sparkSession.createDataFrame([], "node long, label long")
    rows = found.where(F.col("kind") == ROW).select(
        F.col("x").alias("key"), F.col("y").alias("class"), F.col("z").alias("n")).unionByName(
        often.select("key", "class", "n"))
    bitmaps = sets.select("class", "bits")
    for number in range(ROUNDS + 1):
        rows = _open_rows(rows, labels)
        if rows.isEmpty():
            break
        if number < ROUNDS:
            tried = stored(_dealt(rows, bitmaps, 0.5).mapInArrow(
                _likely, "key long, a long, b long, share double"), "open-pairs")
            # A tile in which bitmaps allow no pair between components is settled.
            rows = rows.join(tried.select("key").distinct(), "key", "left_semi")
            more = _linked(_likeliest(tried), docs, slim, labels)
            if more is not None:
                labels = more
                continue
            rows = _open_rows(rows, labels)
        allowed = stored(_dealt(rows, bitmaps, 0.5).mapInArrow(_clustered, "a long, b long").distinct(), "allowed")
        if allowed.isEmpty():
            break
        clusters = components(allowed).select(F.col("label").alias("key"), F.col("node").alias("class"))
        last = _open_rows(clusters.join(sets.select("class", "n"), "class"), labels)
        arrays = _arrays(docs, slim, last.select("class").distinct())
        more = stored(_dealt(last, bitmaps.join(arrays, "class"), 8.5).mapInArrow(
            _joining, "a long, b long").distinct(), "links")
        if not more.isEmpty():
            labels = components(more, labels)
        break
    names = slim.join(labels, slim["class"] == labels["node"], "left").select(
        "class", "doc_id", F.coalesce("label", "class").alias("label"))
    smallest = names.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    own = names.groupBy("class", "label").agg(F.lit(None).alias("unused")).join(smallest, "label").select(
        F.col("class").alias("member"), "component_id")
    return facts.join(own, facts["class"] == own["member"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does: the one with the smallest id.

    Columns are unchanged. Of repeated ids all rows with that id stay together. Texts without words stay.
    """
    found = jaccard_components(docs, id_col, text_col)
    gone = stored(found.where("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return docs.join(small_side(gone, 16), docs[id_col] == F.col("__gone"), "left_anti")
