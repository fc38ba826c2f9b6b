"""Exact removal of long repeated strings: run-compressed Burrows-Wheeler indexes over the places that may repeat.

A byte goes if a string of ``LENGTH`` bytes around it also starts in a document with a smaller id. Every such string
has a *seed*: the 26-byte piece with the smallest hash among its 25 pieces. Equal strings have equal seeds at equal
places, so all questions about a string are settled among the occurrences of its seed.

1. A string of 50 bytes holds, besides its seed, the 12 bytes before it or the 12 after it. Seeds with each of these
   sides are dealt into buckets by hash, packed four bytes each; a bucket says which of them occur in two documents. The
   answer is a bitmap of bounded size, which lets a few others pass; those change nothing later.
2. Seeds with a shared side become occurrences with a hash of their *context*, the seed with up to 24 bytes on both sides: all
   strings of that seed lie inside. Where a context was seen in a smaller document, all of it goes.
3. What is left are the first documents of seeds with several contexts. These contexts meet by seed. Within a seed they
   are ranked by document; for each bit of the rank, contexts without the bit are indexed and those with it are the
   patterns, so that a pattern only ever meets smaller documents and each pair meets at exactly one bit. In the indexed
   text a seed is one symbol of its own. The index is the run-compressed Burrows-Wheeler transform with the text places
   of run ends; patterns stream through it from right to left, all in step, and keep matching statistics: a row, its
   place in the text, and the length of the match. On a mismatch the nearest run ends with the wanted symbol above and
   below are compared through their sampled places. Matches of a whole string that holds the seed mark it.
4. A seed with very many contexts is split into seeds with a side; where those still have very many, each string is
   reduced to the smallest document by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - as pa.compute
from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_BYTES, small_side, stored
from .words import mix, pieces, text_bytes

LENGTH, SEED = 50, 26
REACH = LENGTH - SEED  # bytes of a context on either side of its seed
WIDTH = 2 * REACH
SLAB = 1 << 19
CHUNK = 1_000_000  # seeds sorted at once
SEEDS_PER_BUCKET = 1_000_000
MOST_BUCKETS = 1 << 16
MOST_BITS = 29  # 64 MB of bitmap at most
CONTEXTS_PER_TASK = 100_000
INDEXED = 10_000  # contexts in one index, at about
ROWS = 50_000
#: A seed (or a seed with a side) that would fill an index alone is split; there are at most HOT_SHARE such seeds.
HOT, HOT_SHARE = INDEXED, 1 << 20

#: ``place`` is the seed's first byte, and how many bytes of context lie to its left and right, five bits each.
_OCCURRENCE = "key long, context long, doc long, print long, place long"


# --- seeds ----------------------------------------------------------------------------------

def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) of every run of ``width`` values."""
    have, out = 1, values
    while 2 * have <= width:
        out = choose(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return choose(out[:len(out) - rest], out[rest:]) if rest else out


def _seed_hash(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``SEED`` bytes from every place."""
    word = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(raw) - 7,), (1,)).copy()
    n = len(raw) - SEED + 1
    x = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    for at, odd in ((8, 0xBF58476D1CE4E5B9), (16, 0x94D049BB133111EB), (SEED - 8, 0xD6E8FEB86659FD93)):
        x ^= x >> np.uint64(32)
        x += word[at:at + n]
        x *= np.uint64(odd)
    x ^= x >> np.uint64(32)
    return x


def seeds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of every seed of texts that lie one after another."""
    places, hashes = [], []
    ends = offsets[1:]
    for begin in range(0, len(raw), SLAB):
        low, high = max(0, begin - LENGTH), min(len(raw), begin + SLAB + LENGTH)
        if high - low < LENGTH:
            continue
        x = _seed_hash(raw[low:high])
        order = (x >> np.uint64(32)).astype(np.uint32)
        least = _sliding(order, LENGTH - SEED + 1, np.minimum)  # one for each string of LENGTH bytes
        own = ends[(ends > low) & (ends < high + LENGTH)] - low
        crossing = (own[:, None] - np.arange(1, LENGTH)).ravel()
        least[crossing[(crossing >= 0) & (crossing < len(least))]] = 0
        padded = np.concatenate([np.zeros(REACH, dtype=np.uint32), least, np.zeros(REACH, dtype=np.uint32)])
        most = _sliding(padded, LENGTH - SEED + 1, np.maximum)
        chosen = np.flatnonzero((most == order) & (most > 0))
        chosen = chosen[(chosen + low >= begin) & (chosen + low < begin + SLAB)]
        places.append(chosen + low)
        hashes.append(mix(x[chosen]))
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at, key = np.concatenate(places), np.concatenate(hashes)
    return np.searchsorted(offsets, at, side="right") - 1, at, key


def contexts(raw: np.ndarray, offsets: np.ndarray, row: np.ndarray, at: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes before and after seeds (zero outside the text), and how many there are to the left and right."""
    left = np.minimum(at - offsets[row], REACH)
    right = np.minimum(offsets[row + 1] - at - SEED, REACH)
    edge = np.zeros(REACH, dtype=np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, raw, edge]), REACH)
    data = np.concatenate([view[at], view[at + REACH + SEED]], axis=1)
    place = np.arange(WIDTH, dtype=np.int8)
    data[(place < (REACH - left)[:, None]) | (place >= (REACH + right)[:, None])] = 0
    return data, left, right


def sides(raw: np.ndarray, offsets: np.ndarray, row: np.ndarray, at: np.ndarray, key: np.ndarray
          ) -> list[tuple[np.ndarray, np.ndarray]]:
    """For seeds with the 12 bytes before them, and with the 12 bytes after them: whether the text reaches so far, and
    a hash. Every string of LENGTH bytes holds one of the two."""
    edge = np.zeros(16, dtype=np.uint8)
    padded = np.concatenate([edge, raw, edge])
    word = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,))

    def joined(low: np.ndarray, high: np.ndarray, salt: int) -> np.ndarray:
        return mix(mix((key ^ word[low + 16]) + np.uint64(salt)) ^ word[high + 16])

    half = REACH // 2
    return [(at - offsets[row] >= half, joined(at - half, at - 8, 0x9E3779B97F4A7C15)),
            (offsets[row + 1] - at - SEED >= half, joined(at + SEED, at + SEED + half - 8, 0xC2B2AE3D27D4EB4F))]


def _hash_rows(data: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes and of further whole numbers."""
    width = -(-data.shape[1] // 8) * 8
    padded = np.zeros((len(data), width), dtype=np.uint8)
    padded[:, :data.shape[1]] = data
    words = padded.view("<u8")
    x = np.zeros(len(data), dtype=np.uint64)
    for part in [*words.T, *[m.astype(np.uint64) for m in more]]:
        x = mix((x ^ part) + np.uint64(0x9E3779B97F4A7C15))
    return x


class Bitmap:
    """A set of hashes by some of their bits; it may hold others too."""

    def __init__(self, bits: np.ndarray, width: int):
        self.bits, self.width = bits, width

    def holds(self, key: np.ndarray) -> np.ndarray:
        slot = key >> np.uint64(64 - self.width)
        return (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _width(count: int) -> int:
    return min(MOST_BITS, max(16, int(count).bit_length()))


# --- 1 which seeds are shared ---------------------------------------------------------------

def _planes(values: np.ndarray) -> bytes:
    """Sorted four-byte numbers, all their first bytes, then all second bytes and so on: the last quarter compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _dealt(buckets: int):
    """Rows (bucket, single, several): hashes of seeds with a side that a chunk of documents has in one document, or in
    several."""
    bits = buckets.bit_length() - 1

    def send(keys: list[np.ndarray], docs: list[np.ndarray]) -> pa.RecordBatch:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key)
        key, doc = key[order], doc[order]
        same = np.concatenate([[False], key[1:] == key[:-1]])
        other = same & np.concatenate([[False], doc[1:] != doc[:-1]])
        begin = np.flatnonzero(~same)
        several = np.logical_or.reduceat(other, begin)
        key = key[begin]
        small = ((key << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
        cuts = np.searchsorted(key, np.arange(buckets, dtype=np.uint64) << np.uint64(64 - bits) if bits else [0])
        cuts = np.append(cuts, len(key))
        out = [(b, _planes(small[lo:hi][~several[lo:hi]]), _planes(small[lo:hi][several[lo:hi]]))
               for b, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if hi > lo]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))],
            ["bucket", "single", "several"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, size = [], [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                raw, offsets = text_bytes(piece.column(1))
                row, at, key = seeds(raw, offsets)
                doc = piece.column(0).to_numpy()[row]
                for reaches, side in sides(raw, offsets, row, at, key):
                    if reaches.any():
                        keys.append(side[reaches])
                        docs.append(doc[reaches])
                        size += len(keys[-1])
                if size >= CHUNK:
                    yield send(keys, docs)
                    keys, docs, size = [], [], 0
        if size:
            yield send(keys, docs)

    return run


def _shared(buckets: int, width: int):
    """The part of the bitmap of each bucket."""
    bits = buckets.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, several = {}, {}
        for batch in batches:
            for bucket, one, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
                single.setdefault(bucket, []).append(_numbers(one))
                several.setdefault(bucket, []).append(_numbers(more))
        for bucket, parts in single.items():
            # A seed is shared if some chunk has it in several documents, or two chunks have it.
            often = np.unique(np.concatenate(several[bucket]))
            values = np.sort(np.concatenate([*parts, often]))
            shared = np.concatenate([values[1:][values[1:] == values[:-1]], often])
            slots = np.zeros(1 << (width - bits), dtype=bool)
            slots[(shared >> np.uint32(32 - (width - bits))).astype(np.int64)] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([np.packbits(slots, bitorder="little").tobytes()], pa.binary())],
                ["bucket", "bits"])

    return run


def _shared_seeds(docs: DataFrame, size: int) -> Bitmap:
    expected = size // 6 + 1  # seeds with a side: two for about every 13 bytes
    buckets = 1 << max(3, min(MOST_BUCKETS, expected // SEEDS_PER_BUCKET).bit_length())
    width = max(_width(2 * expected), buckets.bit_length() + 5)
    rows = docs.mapInArrow(_dealt(buckets), "bucket int, single binary, several binary").repartition(
        buckets, "bucket").mapInArrow(_shared(buckets, width), "bucket int, bits binary").toArrow()
    part = 1 << (width - buckets.bit_length() + 1 - 3)
    bits = np.zeros(1 << (width - 3), dtype=np.uint8)
    for bucket, own in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist()):
        bits[bucket * part:(bucket + 1) * part] = np.frombuffer(own, dtype=np.uint8)
    return Bitmap(bits, width)


# --- 2 occurrences --------------------------------------------------------------------------

def _shared_places(bitmap: Bitmap, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of seeds that another document may have together with one side."""
    row, at, key = seeds(raw, offsets)
    keep = np.zeros(len(at), dtype=bool)
    for reaches, side in sides(raw, offsets, row, at, key):
        keep |= reaches & bitmap.holds(side)
    return row[keep], at[keep], key[keep]


def _occurrences(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                raw, offsets = text_bytes(piece.column(1))
                row, at, key = _shared_places(sent.value, raw, offsets)
                for begin in range(0, len(at), ROWS):
                    own = slice(begin, begin + ROWS)
                    data, left, right = contexts(raw, offsets, row[own], at[own])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key[own].view(np.int64)), pa.array(_hash_rows(data, key[own], left, right).view(np.int64)),
                        piece.column(0).take(pa.array(row[own])), piece.column(2).take(pa.array(row[own])),
                        pa.array((at[own] - offsets[row[own]]) << 10 | left << 5 | right)],
                        ["key", "context", "doc", "print", "place"])

    return run


# --- 3 the index ----------------------------------------------------------------------------

class RunLengthIndex:
    """The Burrows-Wheeler transform of several strings as runs, with the text places of the first and last row of
    each run. Symbols of the strings are at least 0; every string ends in a stop of its own that sorts before them."""

    def __init__(self, symbols: np.ndarray, string: np.ndarray):
        """``symbols`` of all strings one after another, and the number of the string each belongs to."""
        count = int(string[-1]) + 1
        ends = np.flatnonzero(np.append(string[1:] != string[:-1], True))
        text = np.insert(symbols.astype(np.int64) + count, ends + 1, np.arange(count))
        self.text = np.append(text, -1)
        self.stops = count
        n = len(text)
        rows = _suffix_array(text)
        before = np.where(rows > 0, text[rows - 1], 0)
        before = np.where(before < count, -1, before - count)  # stops are never asked for
        self.start = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.symbol = before[self.start]
        last = np.append(self.start[1:], n) - 1
        self.last = last
        self.first_place, self.last_place = rows[self.start], rows[last]
        # Where the first row of a run goes when its symbol is put in front.
        size = last - self.start + 1
        smaller = np.bincount(text[text >= count] - count)
        first_row = count + np.concatenate([[0], np.cumsum(smaller)])
        order = np.argsort(self.symbol, kind="stable")
        of, sizes = self.symbol[order], size[order]
        total = np.cumsum(sizes) - sizes
        head = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        total -= np.repeat(total[head], np.diff(np.append(head, len(of))))
        self.goes = np.zeros(len(order), dtype=np.int64)
        self.goes[order] = total + np.where(of >= 0, first_row[np.maximum(of, 0)], 0)
        self.by_symbol = of * len(order) + order  # sorted by symbol, then by run
        self.run_of = order

    def _same(self, left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common part of the texts at two places, up to ``most``."""
        out = np.zeros(len(left), dtype=np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            equal = self.text[left[live] + out[live]] == self.text[right[live] + out[live]]
            live = live[equal]
            out[live] += 1
            live = live[out[live] < most[live]]
        return out

    def statistics(self, patterns: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """For every place of every pattern (rows of symbols) the length of the longest string from there on that
        occurs in the text. Invalid places lie at the ends only and count as no part of the pattern."""
        count, width = patterns.shape
        out = np.zeros((count, width), dtype=np.int64)
        row = np.zeros(count, dtype=np.int64)
        place = np.full(count, self.first_place[0])
        length = np.zeros(count, dtype=np.int64)
        runs = len(self.start)
        for col in range(width - 1, -1, -1):
            live = np.flatnonzero(valid[:, col])
            symbol = patterns[live, col]
            run = np.searchsorted(self.start, row[live], side="right") - 1
            fits = self.symbol[run] == symbol
            at = np.searchsorted(self.by_symbol, symbol * runs + run)
            above, below = np.maximum(at - 1, 0), np.minimum(at, runs - 1)
            up, down = self.run_of[above], self.run_of[below]
            has_up = (at > 0) & (self.symbol[up] == symbol)
            has_down = (at < runs) & (self.symbol[down] == symbol)
            none = np.zeros(len(live), dtype=np.int64)
            most, here = length[live], place[live]
            same_up = self._same(here, self.last_place[up], np.where(has_up & ~fits, most, none))
            same_down = self._same(here, self.first_place[down], np.where(has_down & ~fits, most, none))
            upward = has_up & (~has_down | (same_up >= same_down))
            new_run = np.where(fits, run, np.where(upward, up, down))
            new_row = np.where(fits, row[live], np.where(upward, self.last[up], self.start[down]))
            new_place = np.where(fits, here, np.where(upward, self.last_place[up], self.first_place[down]))
            new_length = np.where(fits, most, np.where(upward, same_up, same_down)) + 1
            found = fits | has_up | has_down
            step = live[found]
            row[step] = (self.goes[new_run] + new_row - self.start[new_run])[found]
            place[step] = new_place[found] - 1
            length[step] = new_length[found]
            length[live[~found]] = 0
            out[live, col] = length[live]
        return out


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the text in order of what follows them, by doubling; every string's stop is unique."""
    n, bits = len(text), max(1, int(text.max()).bit_length())
    reach = max(1, min(63 // bits, 8))
    key = np.zeros(n, dtype=np.uint64)
    for k in range(reach):
        part = np.zeros(n, dtype=np.uint64)
        if k < n:
            part[:n - k] = text[k:]
        key = (key << np.uint64(bits)) | part
    order = np.argsort(key)
    while True:
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1]))
        if rank[order[-1]] == n - 1 or reach >= n:
            return order
        second = np.zeros(n, dtype=np.int64)
        if reach < n:
            second[:n - reach] = rank[reach:] + 1
        key = (rank.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        # Only rows whose rank is not settled yet move.
        open_rows = np.append(False, ranked[1:] == ranked[:-1]) | np.append(ranked[1:] == ranked[:-1], False)
        loose = np.flatnonzero(open_rows)
        order[loose] = order[loose][np.argsort(key[order[loose]])]
        reach *= 2


def repeated_strings(key: np.ndarray, doc: np.ndarray, data: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each context a bit ``a`` for every string, starting ``a`` bytes before the seed, that a context of the same
    seed in a smaller document has too. Rows must be in order of key and doc."""
    n = len(key)
    found = np.zeros(n, dtype=np.int32)
    fresh_key = np.append(True, key[1:] != key[:-1])
    fresh_doc = fresh_key | np.append(True, doc[1:] != doc[:-1])
    group = np.cumsum(fresh_key) - 1
    rank = np.cumsum(fresh_doc)
    rank = rank - rank[np.flatnonzero(fresh_key)][group]
    place = np.arange(2 * REACH + 1)
    valid = (place >= REACH - left[:, None]) & (place <= REACH + right[:, None])
    bytes_around = np.concatenate([data[:, :REACH], np.zeros((n, 1), dtype=np.uint8), data[:, REACH:]], axis=1)
    for bit in range(int(rank.max(initial=0)).bit_length()):
        first = (rank >> bit) & 1 == 0
        part = group.astype(np.int64) << 32 | rank >> (bit + 1)
        _, part = np.unique(part, return_inverse=True)
        asks = np.bincount(part[~first], minlength=part.max() + 1) > 0
        indexed, asking = np.flatnonzero(first & asks[part]), np.flatnonzero(~first)
        symbols = bytes_around.astype(np.int64)
        symbols[:, REACH] = 256 + part
        used = valid[indexed]
        index = RunLengthIndex(symbols[indexed][used], np.repeat(np.arange(len(indexed)), used.sum(axis=1)))
        length = index.statistics(symbols[asking], valid[asking])
        whole = length[:, :REACH + 1] >= REACH + 1  # strings that start at or before the seed and reach over it
        found[asking] |= (whole << (REACH - np.arange(REACH + 1))).sum(axis=1).astype(np.int32)
    return found


_AROUND = "key long, context long, doc long, left byte, right byte, data binary, hot boolean"


def _contexts_of(sent_shared, sent, sent_hot):
    """The first of equal contexts of wanted seeds in each piece: key, context, doc, left, right, data, hot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                raw, offsets = text_bytes(piece.column(1))
                row, at, key = _shared_places(sent_shared.value, raw, offsets)
                keep = sent.value.holds(key)
                row, at, key = row[keep], at[keep], key[keep]
                if not len(at):
                    continue
                doc = piece.column(0).to_numpy()[row]
                data, left, right = contexts(raw, offsets, row, at)
                own = _hash_rows(data, key, left, right).view(np.int64)
                order = np.lexsort((doc, own))
                order = order[np.append(True, own[order][1:] != own[order][:-1])]
                hot = sent_hot.value
                near = np.minimum(np.searchsorted(hot, key[order]), max(len(hot) - 1, 0))
                is_hot = hot[near] == key[order] if len(hot) else np.zeros(len(order), dtype=bool)
                yield _sent(key[order], own[order], doc[order], left[order], right[order], data[order], is_hot)

    return run


def _sent(key: np.ndarray, own: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray, data: np.ndarray,
          hot: np.ndarray) -> pa.RecordBatch:
    blob = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(key), [None, pa.py_buffer(data.tobytes())])
    return pa.RecordBatch.from_arrays([
        pa.array(key.view(np.int64)), pa.array(own), pa.array(doc), pa.array(left.astype(np.int8)),
        pa.array(right.astype(np.int8)), blob.cast(pa.binary()), pa.array(hot)],
        ["key", "context", "doc", "left", "right", "data", "hot"])


def _loaded(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...] | None:
    got = [b for b in batches if b.num_rows]
    if not got:
        return None
    table = pa.Table.from_batches(got).combine_chunks()
    numbers = [table[name].to_numpy() for name in ("key", "context", "doc", "left", "right")]
    data = text_bytes(table["data"].combine_chunks())[0].reshape(-1, WIDTH)
    return *numbers[:3], numbers[3].astype(np.int64), numbers[4].astype(np.int64), data


_SETTLED = "context long, found int, key long, doc long, left byte, right byte, data binary, hot boolean"


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(context, found) of all contexts of the seeds of a partition; rows of hot seeds are passed on as they are."""
    few = []
    for batch in batches:
        hot = batch.column(batch.schema.get_field_index("hot"))
        few.append(batch.filter(pa.compute.invert(hot)))
        many = batch.filter(hot)
        if many.num_rows:
            yield pa.RecordBatch.from_arrays(
                [many.column(1), pa.nulls(many.num_rows, pa.int32()), many.column(0), *many.columns[2:]],
                ["context", "found", "key", "doc", "left", "right", "data", "hot"])
    got = _loaded(few)
    if got is None:
        return
    key, own, doc, left, right, data = got
    order = np.lexsort((doc, own, key))
    order = order[np.append(True, (own[order][1:] != own[order][:-1]) | (key[order][1:] != key[order][:-1]))]
    order = order[np.lexsort((doc[order], key[order]))]
    heads = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    begin = 0
    while begin < len(order):  # whole seeds, about INDEXED contexts at once
        more = heads[np.searchsorted(heads, begin + INDEXED):]
        end = int(more[0]) if len(more) else len(order)
        part = order[begin:end]
        found = repeated_strings(key[part], doc[part], data[part], left[part], right[part])
        some = found != 0
        n = int(some.sum())
        kinds = (pa.int64(), pa.int64(), pa.int8(), pa.int8(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[part][some]), pa.array(found[some]), *[pa.nulls(n, t) for t in kinds],
             pa.array(np.zeros(n, dtype=bool))], ["context", "found", "key", "doc", "left", "right", "data", "hot"])
        begin = end


def _sides_of(batch: pa.RecordBatch) -> Iterator[tuple[bool, np.ndarray, tuple[np.ndarray, ...]]]:
    """For contexts with 12 bytes before their seed, and for those with 12 after it: which it is, a hash of seed and
    side, and the columns."""
    got = _loaded([batch])
    if got is None:
        return
    key, left, right, data = got[0], *got[3:]
    for leftward, reach, near in ((True, left, data[:, REACH // 2:REACH]), (False, right, data[:, REACH:3 * REACH // 2])):
        rows = np.flatnonzero(reach >= REACH // 2)
        if len(rows):
            side = _hash_rows(near[rows], key[rows].view(np.uint64), np.full(len(rows), leftward))
            yield leftward, side, tuple(c[rows] for c in got)


def _side_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, side, _ in _sides_of(batch):
            yield pa.RecordBatch.from_arrays([pa.array(side.view(np.int64))], ["key"])


def _by_side(sent):
    """Contexts under two keys each, but for sides that very many contexts have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leftward, side, (_, own, doc, left, right, data) in _sides_of(batch):
                few = ~np.isin(side.view(np.int64), sent.value)
                yield _sent(side[few], own[few], doc[few], left[few], right[few], data[few], np.zeros(few.sum(), dtype=bool))

    return run


def _strings_of(sent):
    """(string, context, before, doc): a hash of every string of LENGTH bytes around a seed and side that very many
    contexts have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leftward, side, (key, own, doc, left, right, data) in _sides_of(batch):
                many = np.isin(side.view(np.int64), sent.value)
                for before in range(REACH // 2, REACH + 1) if leftward else range(REACH // 2 + 1):
                    rows = np.flatnonzero(many & (left >= before) & (right >= REACH - before))
                    if len(rows):
                        string = _hash_rows(
                            data[rows, REACH - before:WIDTH - before], key[rows].view(np.uint64), np.full(len(rows), before))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(string.view(np.int64)), pa.array(own[rows]),
                            pa.array(np.full(len(rows), before, dtype=np.int32)), pa.array(doc[rows])],
                            ["string", "context", "before", "doc"])

    return run


def _hot_found(rows: DataFrame, most: int) -> DataFrame:
    """(context, found) for seeds with very many contexts: by seed and side, and where even those are very many, string
    by string."""
    often = rows.mapInArrow(_side_keys, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(
        F.col("rows") > most)
    sent = rows.sparkSession.sparkContext.broadcast(
        np.sort(often.select("key").toArrow()["key"].to_numpy()))  # fewer than rows / most
    found = _indexed(rows.mapInArrow(_by_side(sent), _AROUND), 2 * rows.count()).select("context", "found")
    if not len(sent.value):
        return found
    strings = stored(rows.mapInArrow(_strings_of(sent), "string long, context long, before int, doc long").groupBy(
        "string", "context", "before").agg(F.min("doc").alias("doc")), "strings")
    # All strings repeat but those of the first document that has them; that may be in several contexts.
    bit = F.expr("shiftleft(1, before)")
    first = strings.groupBy("string", "doc").agg(F.collect_set(F.struct("context", "before")).alias("own")).groupBy(
        "string").agg(F.min_by("own", "doc").alias("own")).select(F.inline("own")).groupBy("context").agg(
        F.bit_or(bit).alias("first"))
    repeated = strings.groupBy("context").agg(F.bit_or(bit).alias("all")).join(first, "context", "left").select(
        "context", F.col("all").bitwiseAND(F.bitwise_not(F.coalesce("first", F.lit(0)))).alias("found"))
    return found.unionByName(repeated.where("found <> 0"))


def _indexed(around: DataFrame, rows: int) -> DataFrame:
    parts = max(around.sparkSession.sparkContext.defaultParallelism, rows // CONTEXTS_PER_TASK)
    dealt = F.when(F.col("hot"), F.col("context")).otherwise(F.col("key"))  # hot seeds are spread
    return around.repartition(parts, dealt).mapInArrow(_settled, _SETTLED)


# --- 4 spans --------------------------------------------------------------------------------

def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, print, spans) from marks (doc, print, place, found); found is null where the whole context goes."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got)
    doc, mark, place = (table[name].to_numpy() for name in ("doc", "print", "place"))
    at, left, right = place >> 10, place >> 5 & 31, place & 31
    found = table["found"].fill_null(-1).to_numpy()
    all_of = np.flatnonzero(found < 0)
    rows, begin, end = [all_of], [at[all_of] - left[all_of]], [at[all_of] + SEED + right[all_of]]
    for before in range(REACH + 1):
        own = np.flatnonzero((found >= 0) & (found >> before & 1 == 1))
        rows.append(own)
        begin.append(at[own] - before)
        end.append(at[own] - before + LENGTH)
    row, begin, end = np.concatenate(rows), np.concatenate(begin), np.concatenate(end)
    order = np.lexsort((begin, mark[row], doc[row]))
    row, begin, end = row[order], begin[order], end[order]
    new = np.append(True, (doc[row][1:] != doc[row][:-1]) | (mark[row][1:] != mark[row][:-1]))
    owner = np.cumsum(new) - 1
    far = np.maximum.accumulate(owner * (1 << 32) + end) - owner * (1 << 32)  # ends so far within the document
    opens = new | np.append(True, begin[1:] > far[:-1])
    first = np.flatnonzero(opens)
    spans = np.column_stack([begin[first], far[np.append(first[1:], len(far)) - 1]]).astype("<i8")
    owner_of = owner[first]
    heads = np.flatnonzero(np.append(True, owner_of[1:] != owner_of[:-1]))
    blobs = [spans[lo:hi].tobytes() for lo, hi in zip(heads.tolist(), np.append(heads[1:], len(spans)).tolist())]
    at_head = row[first[heads]]
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc[at_head]), pa.array(mark[at_head]), pa.array(blobs, pa.binary())], ["doc", "print", "spans"])


def _print(text: Column) -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc, print, spans (pairs of byte places as 64-bit numbers), whole, of the documents that lose something; ``whole``
    is true, and there are no spans, where all of it goes. ``print`` is ``xxhash64`` of the text, which tells rows of one
    doc_id apart."""
    spark = docs.sparkSession
    everything = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).select(
        F.col("doc_id").cast("long").alias("doc"), "text", _print(F.col("text")).alias("print"))
    # Whole texts that a smaller document has too are gone as they stand; nothing else need meet them.
    second = F.xxhash64(F.lit(1), "text")
    first = everything.groupBy("print", second.alias("second")).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    copies = stored(everything.select("doc", "print", F.octet_length("text").cast("long").alias("bytes"), second.alias(
        "second")).join(first.where("first < last"), ["print", "second"]).where("doc > first").select(
        "doc", "print", "bytes").distinct(), "copies")
    texts = everything.join(small_side(copies.select("doc", "print"), 64), ["doc", "print"], "left_anti").select(
        "doc", "text", "print")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(_shared_seeds(texts, size))
    places = stored(texts.mapInArrow(_occurrences(shared), _OCCURRENCE), "occurrences")
    known = stored(places.groupBy("context").agg(
        F.first("key").alias("key"), F.min("doc").alias("first"), F.max("doc").alias("last")), "contexts")
    mixed = stored(known.groupBy("key").agg(F.count(F.lit(1)).alias("contexts"), F.min("first").alias("low"),
                                            F.max("first").alias("high")).where("contexts > 1 AND low < high").select(
        "key", "contexts"), "mixed-seeds")
    counted = mixed.agg(F.count(F.lit(1)), F.sum("contexts")).first()
    full = known.where("first < last").select("context", "first", F.lit(None).cast("int").alias("found"))
    rules = full  # written first, so that the join sees its skewed side as it is
    if counted[0]:
        found = stored(_found(texts, shared, mixed, counted[0], counted[1]), "found")
        rules = known.join(found, "context", "left").where("first < last OR found IS NOT NULL").select(
            "context", "first", "found")
    marks = places.drop("key").join(stored(rules, "rules"), "context").where(
        (F.col("doc") > F.col("first")) | F.col("found").isNotNull()).select("doc", "print", "place", F.when(F.col("doc") == F.col("first"), F.col("found")).alias("found"))
    merged = marks.repartition("doc", "print").mapInArrow(_merged, "doc long, print long, spans binary")
    return merged.withColumn("whole", F.lit(False)).unionByName(
        copies.select("doc", "print", F.lit(None).cast("binary").alias("spans"), F.lit(True).alias("whole")))


def _found(texts: DataFrame, shared, mixed: DataFrame, seeds_: int, contexts_: int) -> DataFrame:
    """(context, found) of the contexts of seeds that have several."""
    spark = texts.sparkSession
    width = _width(16 * seeds_)
    slot = F.shiftrightunsigned("key", 64 - width)
    words = mixed.select(F.shiftright(slot, 5).alias("word"), F.expr(
        f"shiftleft(1L, CAST(shiftrightunsigned(key, {64 - width}) & 31 AS INT))").alias("bit")).groupBy("word").agg(
        F.bit_or("bit").alias("bits")).toArrow()  # at most 2**23 rows, whatever the corpus
    bits = np.zeros(1 << (width - 5), dtype="<u4")
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().astype("<u4")
    sent = spark.sparkContext.broadcast(Bitmap(bits.view(np.uint8), width))
    most = max(HOT, contexts_ // HOT_SHARE)
    hot = np.sort(mixed.where(F.col("contexts") > most).select("key").toArrow()["key"].to_numpy().view(np.uint64))
    sent_hot = spark.sparkContext.broadcast(hot)  # at most HOT_SHARE numbers
    around = texts.mapInArrow(_contexts_of(shared, sent, sent_hot), _AROUND)
    if not len(hot):
        return _indexed(around, contexts_).select("context", "found")
    done = stored(_indexed(around, contexts_), "settled")
    found = done.where("NOT hot").select("context", "found").unionByName(_hot_found(done.where("hot").select(
        *[name for name in done.columns if name != "found"]).select("key", "context", "doc", "left", "right", "data", "hot"),
        most))
    return found.groupBy("context").agg(F.bit_or("found").alias("found"))


def without_long_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: what is left of each document, as UTF-8 bytes.

    A byte goes if a string of 50 bytes that covers it also starts in a document with a smaller doc_id; strings are
    judged on the input, and never cross documents. Null texts are empty. Texts under 50 bytes stay whole, and so does a
    document without id, which no other document meets either. Rows that repeat a doc_id are no smaller than each
    other: each keeps what no smaller id has. Rows stay as often as they come. Other columns are ignored.
    """
    found = stored(repeated_spans(docs), "repeated-spans")
    size = found.agg(F.sum(F.coalesce(F.length("spans"), F.lit(0)) + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        found, (F.col("doc_id").cast("long") == F.col("doc")) & (_print(F.col("text")) == F.col("print")), "left").select(
        "doc_id", "text", "spans", "whole")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                raw, offsets = text_bytes(piece.column(1))
                out = []
                for begin, end, spans, whole in zip(offsets[:-1].tolist(), offsets[1:].tolist(), piece.column(2).to_pylist(),
                                                    piece.column(3).to_pylist()):
                    data = raw[begin:end].tobytes()
                    cut = np.array([[0, len(data)]]) if whole else np.frombuffer(spans or b"", dtype="<i8").reshape(-1, 2)
                    kept, at = [], 0
                    for low, high in cut.tolist():
                        kept.append(data[at:low])
                        at = high
                    kept = b"".join([*kept, data[at:]])
                    out.append((len(data), len(data) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
