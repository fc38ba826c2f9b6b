"""Words and five-word shingles of Arrow text columns as 64-bit hashes, computed with whole-array operations."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Texts are worked through in pieces of about so many bytes; a longer text is a piece of its own.
PIECE_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: An odd multiplier and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(64)], dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, PIECE_BYTES + 1), base, dtype=np.uint64)
        step[0] = 1
        have = np.cumprod(step)
        if n <= 2 * PIECE_BYTES:
            _powers[base] = have
    return have


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and where each row begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, starts, data = texts.buffers()
    offsets = np.frombuffer(starts, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    last = int(offsets[-1]) if len(offsets) else 0
    return raw[first:last], offsets.astype(np.int64) - first


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``PIECE_BYTES`` of text each."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + PIECE_BYTES, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


class Words:
    """The words of some texts: ``hash`` of each (A-Z lower-cased), the row it is in, its first byte and the byte
    after its last; ``first[r]:first[r + 1]`` are the words of row ``r``."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        raw, offsets = text_bytes(texts)
        self.raw, self.offsets, n = raw, offsets, len(raw)
        inside = ~_SPACE[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge[:n]))
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.inside, self._lower = inside, lower

    @cached_property
    def hash(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        n = len(self.raw)
        value = ((_LOWER[self.raw] if self._lower else self.raw).astype(np.uint64) + np.uint64(1)) * _power(_BASE, n)[:n]
        value[~self.inside] = 0
        return mix(np.add.reduceat(value, self.start) * _power(_INVERSE, n)[self.start])

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each row's words, A-Z lower-cased, one blank between words and a line feed at the end of the row
        (the only byte of a row without words); and where each row begins."""
        counts = np.diff(self.first)
        inside = np.flatnonzero(self.inside)
        letters = np.concatenate([[0], np.cumsum(self.end - self.start)])
        size = letters[self.first[1:]] - letters[self.first[:-1]] + np.maximum(counts, 1)
        begin = np.concatenate([[0], np.cumsum(size)])
        blanks = np.cumsum(counts == 0)  # rows without words so far take a place of their own
        out = np.full(int(begin[-1]), 10, dtype=np.uint8)
        word = np.repeat(np.arange(len(self.start)), self.end - self.start)
        out[np.arange(len(inside)) + word + blanks[self.row[word]]] = _LOWER[self.raw[inside]]
        stop = letters[1:] + np.arange(len(self.start)) + (blanks[self.row] if len(self.row) else 0)
        last = np.zeros(len(self.start), dtype=bool)
        last[self.first[1:][counts > 0] - 1] = True
        out[stop[~last]] = 32
        return out, begin

    def windows(self, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every run of ``size`` words within one row. ``short`` adds, for rows
        with fewer words, the whole row as one run."""
        count = len(self.hash)
        counts = np.diff(self.first)
        if not count:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        left = (self.first[1:][self.row] - np.arange(count)).astype(np.int64)  # words from here to the row's end
        keep = left >= size
        if short:
            begins = self.first[:-1][(counts > 0) & (counts < size)]
            keep[begins] = True
        at = np.flatnonzero(keep)
        padded = np.concatenate([self.hash, np.zeros(size, dtype=np.uint64)])
        total = np.zeros(len(at), dtype=np.uint64)
        for k in range(size):
            part = padded[at + k] * _PLACE[k]
            if short:
                part[left[at] <= k] = 0
            total += part
        if short:
            total += np.minimum(left[at], size).astype(np.uint64)
        return at, mix(total)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each row its distinct five-word shingles as sorted 64-bit hashes; a row with fewer words has its whole
    sequence as one, a row without words has none."""
    words = Words(texts)
    at, hashes = words.windows(SHINGLE, short=True)
    cut = np.searchsorted(at, words.first)
    for begin, end in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield np.unique(hashes[begin:end])
