"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte runs. For every merge rank there is a bucket of list positions whose pair has
that rank; a two-level bitmap over ranks marks the buckets in use, and find-first-set picks the lowest rank, leftmost
position first. Merging changes two neighbouring pairs, which are added to their buckets; entries whose pair has
changed meanwhile are skipped when they come up. The work for a pre-token of n bytes is O(n log n), also when it is
megabytes long. Short pre-tokens are kept per Python worker in two bounded tables: when the newer one is full it becomes
the older one, so pre-tokens in use stay and the others go.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: Pre-tokens in each of the two tables of a Python worker (some 200 bytes each), and the longest that is kept.
KEPT, KEPT_CHARS = 300_000, 64


def local_ranks(path: str) -> bytes:
    """The rank file from the driver's own disk; its size is that of a vocabulary."""
    with open(path, "rb") as file:
        return file.read()


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Encoder and decoder for a rank table and a splitting pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        self.rank = {}
        for line in ranks.split(b"\n"):
            if line:
                token, number = line.split()
                self.rank[base64.b64decode(token)] = int(number)
        self.size = max(self.rank.values()) + 1
        self.shift = max(8, (self.size.bit_length() + 1) // 2)  # two levels of at most 2**shift bits
        self.mask = (1 << self.shift) - 1
        self.token = [b""] * self.size
        for token, number in self.rank.items():
            self.token[number] = token
        self.byte = [self.rank[bytes([x])] for x in range(256)]
        #: The rank that two neighbouring ids have together.
        self.joined = {
            left << 32 | right: number for token, number in self.rank.items() for cut in range(1, len(token))
            if (left := self.rank.get(token[:cut])) is not None and (right := self.rank.get(token[cut:])) is not None}
        #: The same for two bytes x, y at x << 8 | y; -1 for none.
        self.first = [self.rank.get(bytes([x, y]), -1) for x in range(256) for y in range(256)]
        self.split = regex.compile(pattern).findall
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        byte, first = self.byte, self.first
        part = [byte[x] for x in piece]
        n = len(part)
        pair = [first[x << 8 | y] for x, y in zip(piece, piece[1:])]  # the rank of the pair that begins here, as it is now
        pair.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        buckets, words, top = {}, {}, 0  # positions by rank; the bitmap's lower level; its upper level
        get, shift, mask = self.joined.get, self.shift, self.mask
        # The queue is written out here, not in methods: most pre-tokens have a dozen bytes, and calls would cost more
        # than the work.
        for i, r in enumerate(pair):
            if r >= 0:
                if r in buckets:
                    buckets[r].append(i)  # ascending, so still a heap
                else:
                    buckets[r] = [i]
                    high = r >> shift
                    words[high] = words.get(high, 0) | 1 << (r & mask)
                    top |= 1 << high
        while top:
            high = (top & -top).bit_length() - 1
            word = words[high]
            low = word & -word
            r = high << shift | low.bit_length() - 1
            bucket = buckets[r]
            i = heappop(bucket)
            if not bucket:
                del buckets[r]
                words[high] = word = word ^ low
                if not word:
                    top ^= 1 << high
            if pair[i] != r:
                continue  # stale
            j = after[i]
            part[i] = r
            pair[i] = pair[j] = -1
            after[i] = k = after[j]
            h = before[i]
            if k < n:
                before[k] = i
                s = get(r << 32 | part[k])
                if s is not None:
                    pair[i] = s
                    if s in buckets:
                        heappush(buckets[s], i)
                    else:
                        buckets[s] = [i]
                        high = s >> shift
                        words[high] = words.get(high, 0) | 1 << (s & mask)
                        top |= 1 << high
            if h >= 0:
                s = get(part[h] << 32 | r)
                if s is None:
                    pair[h] = -1
                else:
                    pair[h] = s
                    if s in buckets:
                        heappush(buckets[s], h)
                    else:
                        buckets[s] = [h]
                        high = s >> shift
                        words[high] = words.get(high, 0) | 1 << (s & mask)
                        top |= 1 << high
        out, i = [], 0
        while i < n:
            out.append(part[i])
            i = after[i]
        return out

    def _packed(self, piece: str) -> bytes:
        ids = self.older.get(piece) or _pack(self.merge(piece.encode()))
        if len(piece) <= KEPT_CHARS:
            if len(self.kept) >= KEPT:
                self.kept, self.older = {}, self.kept
            self.kept[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out, packed = [], self._packed
        pieces = self.split(text)
        for begin in range(0, len(pieces), 4096):
            get = self.kept.get  # the table may have been replaced
            out += [get(piece) or packed(piece) for piece in pieces[begin:begin + 4096]]
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_codecs: dict[bytes, Codec] = {}


def _codec(ranks: bytes, pattern: str) -> Codec:
    """One codec for each worker and vocabulary."""
    key = hashlib.sha256(ranks + pattern.encode()).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


def encode_column(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  digests: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, and either the digests of ids and decoded bytes or the ids themselves.

    With ``digests``: ids_sha256 (of the ids as little-endian unsigned 32-bit integers) and decoded_sha256 (of the
    bytes that decoding these ids gives). Without: ids (array of int). Null text counts as empty and has no tokens.
    Each match of ``pattern`` is encoded by itself, without special tokens. Repeated rows give repeated results, an
    empty table none, other columns are ignored; texts are encoded whole at any length.
    """
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    kind = docs.schema[id_col].dataType.simpleString()
    columns = "n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*sent.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                ids = [codec.encode(text.as_py() or "") for text in part.column(1)]
                count = pa.array([len(i) // 4 for i in ids], pa.int64())
                if digests:
                    out = [pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                           pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for i in ids], pa.string())]
                    names = ["ids_sha256", "decoded_sha256"]
                else:
                    flat = np.frombuffer(b"".join(ids), dtype="<i4")
                    cuts = np.cumsum([0, *(len(i) // 4 for i in ids)])
                    out = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32()))]
                    names = ["ids"]
                yield pa.RecordBatch.from_arrays([part.column(0), count, *out], ["doc_id", "n_tokens", *names])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        encode, f"doc_id {kind}, {columns}")


def decode_column(encoded: DataFrame, ranks: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id and the bytes its ids stand for; null ids give empty bytes, an unknown id is an error."""
    sent = encoded.sparkSession.sparkContext.broadcast((ranks, ""))
    kind = encoded.schema[id_col].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*sent.value)
        for batch in batches:
            rows = [b"".join([codec.token[i] for i in ids or ()]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "bytes"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        decode, f"doc_id {kind}, bytes binary")
