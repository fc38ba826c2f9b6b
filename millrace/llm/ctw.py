"""Language-model scoring by context-tree weighting over bytes.

A text is read as its words, lower-cased, with one blank between them and a line feed at the end. Each byte is eight
binary decisions; for each of the 255 decisions there is a tree over the bytes before. Every context estimates with
Krichevsky and Trofimov, and a context's weighted probability is the even mixture of its own estimate and the product
over the contexts that lengthen it. From the counts of the whole training part these block probabilities follow
directly, and with them the weight that each depth has for each decision, so the code length of a byte is one lookup.

The tree has every context of up to ``DEPTH`` bytes that occurs, without a floor or limit. Tasks count the strings of
``DEPTH`` + 1 bytes; shards, one for each hash of a context's last three bytes, hold their sums and work out the depths
from there on. Contexts of two bytes and fewer, of which there are few by nature, are worked out on the driver from sums
over the shards. Strings of documents held out are in the tables too, with a count of 0.

In scoring, the strings seen most often (at most ``FREQUENT_GRAMS``) go to the tasks that read texts; all others are
joined with their probabilities by hash.

Beside it stands a plain unigram score over words. Counts of words stay in shards: the frequent words (at most 2**17)
go to the tasks that read texts, and the other words of a document are joined with the counts by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .words import Words, mix, pieces

DEPTH = 6
#: Depths up to this are worked out over all shards.
TOP = 2
FREQUENT_WORDS = 1 << 17
FREQUENT_GRAMS = 1 << 21
#: Bytes of stream that a task gathers before it passes its counts on, and bytes of text a shard.
GATHERED, SHARD_BYTES = 8_000_000, 12_000_000
SMOOTH = 0.1
END = 10


def _before(stream: np.ndarray, begin: np.ndarray, depth: int) -> np.ndarray:
    """The byte ``depth`` places before each byte of the stream; before a row's start everything is a line feed."""
    out = np.full(len(stream), END, dtype=np.uint8)
    out[depth:] = stream[:-depth]
    for k in range(depth):  # the first bytes of each row must not see the row before
        at = begin[:-1] + k
        out[at[at < begin[1:]]] = END
    return out


def _grams(stream: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Each byte with the ``DEPTH`` before it as one number: the nearest of them highest, the byte itself lowest."""
    code = stream.astype(np.int64)
    for depth in range(1, DEPTH + 1):
        code |= _before(stream, begin, depth).astype(np.int64) << 8 * (DEPTH + 1 - depth)
    return code


def _word_counts(docs: DataFrame) -> DataFrame:
    """key (hash), n."""

    def rows(parts: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                hashes.append(Words(piece.column("text")).hash)
                size += len(hashes[-1])
                if size >= GATHERED // 4:
                    yield rows(hashes)
                    hashes, size = [], 0
        if size:
            yield rows(hashes)

    return docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, and the sums of ``n``."""
    order = np.argsort(code)
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, dtype=np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _shards(docs: DataFrame, shards: int) -> DataFrame:
    """shard, grams, times: the different strings of all ``docs`` (text, held_out) in order, how often training has them."""

    def dealt(parts: list[np.ndarray]) -> pa.RecordBatch:
        both, times = np.unique(np.concatenate(parts), return_counts=True)
        code, times = _summed(both >> 1, np.where(both & 1, times, 0))
        shard = (mix((code >> 8 * (DEPTH - TOP)).view(np.uint64)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        code, times = code[order], times[order]
        have, first = np.unique(shard[order], return_index=True)
        ends = [*first[1:].tolist(), len(code)]
        cut = lambda c: pa.array([c[i:j].tobytes() for i, j in zip(first.tolist(), ends)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(have), cut(code), cut(times)], ["shard", "grams", "times"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                stream, begin = Words(piece.column("text")).stream()
                train = ~piece.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                parts.append(_grams(stream, begin) << 1 | np.repeat(train, np.diff(begin)))
                size += len(stream)
                if size >= GATHERED:
                    yield dealt(parts)
                    parts, size = [], 0
        if size:
            yield dealt(parts)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, codes, times = None, [], []

        def done() -> pa.RecordBatch:
            code, n = _summed(np.concatenate(codes), np.concatenate(times))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([code.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())],
                ["shard", "grams", "times"])

        for batch in batches:
            for own, *both in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if own != shard and codes:
                    yield done()
                    codes, times = [], []
                shard = own
                for parts, part in zip((codes, times), both):
                    parts.append(np.frombuffer(part.as_buffer(), np.int64).copy())
        if codes:
            yield done()

    kind = "shard long, grams binary, times binary"
    return docs.mapInArrow(read, kind).repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(merged, kind)


class ContextSet:
    """The contexts of a tree, 0 the root. ``letter`` numbers the bytes that occur in contexts, all others alike;
    ``child[context * width + letter]`` is the context one byte longer, or ``NONE``."""

    NONE = 65_535

    def __init__(self, depth: np.ndarray, code: np.ndarray):
        order = np.lexsort((code, depth))
        self.depth, code = np.concatenate([[0], depth[order]]), np.concatenate([[0], code[order]])
        self.parent = np.full(len(code), -1, dtype=np.int64)
        oldest = code >> 8 * np.maximum(self.depth - 1, 0)
        letters = np.unique(oldest[1:])
        self.width = len(letters) + 1
        self.letter = np.full(256, len(letters), dtype=np.int32)
        self.letter[letters] = np.arange(len(letters))
        self.child = np.full(len(code) * self.width, self.NONE, dtype=np.uint16)
        known = {(0, 0): 0}
        for at, (d, c) in enumerate(zip(self.depth.tolist(), code.tolist())):
            if d:
                up = known[d - 1, c & ((1 << 8 * (d - 1)) - 1)]
                self.parent[at] = up
                self.child[up * self.width + self.letter[c >> 8 * (d - 1)]] = at
                known[d, c] = at

    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        """What tasks need to find contexts."""
        return self.letter, self.child


def _deepest(steps: tuple[np.ndarray, np.ndarray], stream: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The longest known context before each byte."""
    letter, child = steps
    width = int(letter.max()) + 1
    context = np.zeros(len(stream), dtype=np.int32)
    active = np.arange(len(stream))
    for depth in range(1, DEPTH + 1):
        byte = letter[_before(stream, begin, depth)]
        longer = child[context[active] * width + byte[active]]
        found = longer != ContextSet.NONE
        active = active[found]
        if not len(active):
            break
        context[active] = longer[found]
    return context


def _log_gamma(z: np.ndarray) -> np.ndarray:
    """log of the gamma function for positive numbers, by Stirling's series from z + 8 on."""
    shift = np.zeros_like(z)
    for k in range(8):
        shift += np.log(z + k)
    z = z + 8
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - shift


_few = np.arange(4096, dtype=np.float64)
_FEW = _log_gamma(_few + 0.5), _log_gamma(_few + 1)


def _log_gammas(count: np.ndarray, half: bool) -> np.ndarray:
    """log of the gamma function at whole numbers and a half, or at whole numbers and one; small ones by a table."""
    whole = count.astype(np.int64)
    out = _FEW[not half][np.minimum(whole, len(_few) - 1)]
    many = np.flatnonzero(whole >= len(_few))
    out[many] = _log_gamma(count[many] + (0.5 if half else 1.0))
    return out


def _kt_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


def _decisions(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From counts of 256 bytes a row, how often each of the 255 decisions (1 is the first, its sons 2 and 3, ...) went
    0 and 1; column 0 is unused."""
    tree = np.zeros((len(count), 512))
    tree[:, 256:] = count
    for node in range(255, 0, -1):
        tree[:, node] = tree[:, 2 * node] + tree[:, 2 * node + 1]
    node = np.arange(256)
    return tree[:, 2 * node], tree[:, 2 * node + 1]


def weighted_tree(contexts: ContextSet, own: np.ndarray) -> np.ndarray:
    """log10 probability of each byte (columns) after each longest context (rows), from the bytes counted there."""
    n = len(contexts.depth)
    total = own.astype(np.float64)
    levels = [np.flatnonzero(contexts.depth == d) for d in range(int(contexts.depth.max()) + 1)]
    for level in levels[:0:-1]:
        np.add.at(total, contexts.parent[level], total[level])
    inner = np.zeros(n, dtype=bool)
    inner[contexts.parent[1:]] = True
    longer = np.zeros((n, 256))  # of the branches, then of the context as a whole: log weighted probability
    stay = np.ones((n, 256), dtype=np.float32)  # weight of the context's own estimate against its branches
    for level in levels[::-1]:
        for part in np.array_split(level, max(1, len(level) // 2048)):
            block = _kt_block(*_decisions(total[part]))
            mine = inner[part]
            split = longer[part[mine]] + _kt_block(*_decisions(own[part[mine]]))
            block_in = block[mine]
            stay[part[mine]] = 1 / (1 + np.exp(np.clip(split - block_in, -700, 700)))
            block[mine] = np.logaddexp(block_in, split) - np.log(2)
            longer[part] = block
        if level[0]:
            up = contexts.parent[level]
            inner_sum = np.zeros((0, 256))
            order = np.argsort(up, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(up[order]) != 0]))
            inner_sum = np.add.reduceat(longer[level[order]], first, axis=0)
            longer[up[order][first]] = inner_sum
    del longer

    def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
        return (ones + 0.5) / (zeros + ones + 1)

    one = np.zeros((n, 256), dtype=np.float32)  # probability of a 1 by this context and shorter ones
    left = np.ones((n, 256), dtype=np.float32)  # weight that remains for longer ones
    out = np.empty((n, 256), dtype=np.float32)
    path = np.arange(256)
    for level in levels:
        for part in np.array_split(level, max(1, len(level) // 2048)):
            up = contexts.parent[part]
            before, rest = (one[up], left[up]) if part[0] else (np.float32(0), np.float32(1))
            one[part] = before + rest * stay[part] * estimate(*_decisions(total[part]))
            left[part] = rest * (1 - stay[part])
            final = one[part] + left[part] * estimate(*_decisions(own[part]))
            final = np.clip(final.astype(np.float64), 1e-12, 1 - 1e-12)
            score = np.zeros((len(part), 256))
            for bit in range(8):
                node, goes = (256 | path) >> (8 - bit), path >> (7 - bit) & 1
                score += np.log10(np.where(goes == 1, final[:, node], 1 - final[:, node]))
            out[part] = score
    return out


class Tree:
    """A learnt tree: what finds contexts, and ``table[context * width + symbol]``, log10 probabilities. Bytes that never
    occur in training are one symbol; they share its probability evenly."""

    def __init__(self, contexts: ContextSet, own: np.ndarray):
        self.steps = contexts.steps()
        score = weighted_tree(contexts, own)
        seen = np.flatnonzero(own.sum(axis=0))
        unseen = np.setdiff1d(np.arange(256), seen)
        self.symbol = np.full(256, len(seen), dtype=np.int32)
        self.symbol[seen] = np.arange(len(seen))
        other = np.log10(np.mean(10.0 ** score[:, unseen].astype(np.float64), axis=1, keepdims=True)) if len(unseen) else \
            np.zeros((len(score), 1))
        self.width = len(seen) + 1
        self.table = np.concatenate([score[:, seen], other.astype(np.float32)], axis=1).reshape(-1)

    def score(self, stream: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """log10 probability of every byte."""
        at = _deepest(self.steps, stream, begin) * self.width + self.symbol[stream]
        return self.table[at].astype(np.float64)


def _weighed(code: np.ndarray, n: np.ndarray, depth: int, top: int, split=None, base=None) -> Iterator[tuple]:
    """The contexts of ``top`` to ``depth`` bytes above the strings ``code`` (context and byte, in order) seen ``n`` times.

    For each of the eight bits: keys (context and decision) at ``top`` with their log weighted probabilities, keys at
    ``depth``, and with ``base`` the probability of a 1 there by contexts so far, the weight that is left for longer ones,
    and of each string the probability of its bit. ``split``: from keys at ``depth`` the sums over the contexts that
    lengthen them (None: nothing does). ``base``: from keys above ``top`` what shorter contexts say and the weight left.
    """
    rows = [(code, n.astype(np.float64), None)]
    for _ in range(depth - top):
        shorter, at = np.unique(rows[-1][0] >> 16 << 8 | rows[-1][0] & 255, return_inverse=True)
        rows.append((shorter, np.bincount(at, weights=rows[-1][1]), at))
    for bit in range(8):
        levels = []  # from the longest: entry of each row, first rows, zeros and ones by entry, weight of the own estimate
        for code, n, at in rows:
            prefix = code >> 8 - bit
            first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
            entry = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(code)]])))
            ones = np.add.reduceat(n * (code >> 7 - bit & 1), first)
            total = np.add.reduceat(n, first)
            log = _log_gammas(total - ones, True) + _log_gammas(ones, True) - _log_gammas(total, False) - np.log(np.pi)
            own = prefix[first]
            key = own >> bit << 8 | 1 << bit | own & (1 << bit) - 1
            stay = np.ones(len(first))
            if levels or split is not None:
                below = split(key) if not levels else np.bincount(
                    entry[at[levels[-1][1]]], weights=weighted, minlength=len(first))  # noqa: F821
                stay = 1 / (1 + np.exp(np.clip(below - log, -700, 700)))
                log = np.logaddexp(log, below) - np.log(2)
            weighted = log
            levels.append((entry, first, (ones + 0.5) / (total + 1), stay, key))
        top_key, low_key = levels[-1][4], levels[0][4]
        if base is None:
            yield top_key, weighted, low_key, None, None, None
            continue
        one, left = base(top_key >> 16 << 8 | top_key & 255)
        for k in range(len(levels) - 1, -1, -1):
            _, _, estimate, stay, _ = levels[k]
            one, left = one + left * stay * estimate, left * (1 - stay)
            if k:
                parent = levels[k][0][rows[k][2][levels[k - 1][1]]]
                one, left = one[parent], left[parent]
        ends = one[levels[0][0]] + 0.5 * left[levels[0][0]]
        yield top_key, weighted, low_key, one, left, np.where(rows[0][0] >> 7 - bit & 1 == 1, ends, 1 - ends)


def _looked_up(keys: np.ndarray, *values: np.ndarray):
    """From keys, all of them among ``keys`` (in order), to their values."""
    def find(wanted: np.ndarray):
        at = np.searchsorted(keys, wanted)
        return values[0][at] if len(values) == 1 else tuple(v[at] for v in values)
    return find


STRING, DECISION = 0, 1


def string_scores(docs: DataFrame) -> DataFrame:
    """gram, n, score: every string of ``docs`` (text, held_out), how often training has it, and the log10 probability of
    its last byte after the others."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = stored(_shards(docs, min(20_000, max(8, size // SHARD_BYTES))), "lm-shards")

    def each(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for grams, times in zip(batch.column(1), batch.column(2)):
            yield np.frombuffer(grams.as_buffer(), np.int64), np.frombuffer(times.as_buffer(), np.int64)

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for code, n in each(batch):
                short = code >> 8 * (DEPTH + 1 - TOP) << 8 | code & 255
                parts = [(STRING, *_summed(short, n.astype(np.float64)))]
                for key, weighted, *_ in _weighed(code, n, DEPTH, TOP + 1):
                    parts.append((DECISION, *_summed(key >> 16 << 8 | key & 255, weighted)))
                kind = np.repeat([k for k, _, _ in parts], [len(c) for _, c, _ in parts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), *(pa.array(np.concatenate(c)) for c in list(zip(*parts))[1:])], ["kind", "key", "value"])

    sums = shards.mapInArrow(up, "kind long, key long, value double").groupBy("kind", "key").agg(
        F.sum("value").alias("value")).orderBy("kind", "key").toArrow()  # at most 256 rows a context of two bytes, twice
    kind, key, value = (sums[c].to_numpy() for c in ("kind", "key", "value"))
    split = _looked_up(key[kind == DECISION], value[kind == DECISION])
    root = lambda keys: (np.zeros(len(keys)), np.ones(len(keys)))
    found = [(low, one, left) for _, _, low, one, left, _ in _weighed(
        key[kind == STRING], value[kind == STRING], TOP, 0, split, root)] if len(key) else [(key, value, value)]
    low, one, left = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(low)
    sent = docs.sparkSession.sparkContext.broadcast((low[order], one[order], left[order]))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = _looked_up(*sent.value)
        for batch in batches:
            for code, n in each(batch):
                score = np.zeros(len(code))
                for *_, share in _weighed(code, n, DEPTH, TOP + 1, None, base):
                    score += np.log10(np.clip(share, 1e-12, 1 - 1e-12))
                for at in range(0, len(code), 200_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[at:at + 200_000]) for c in (code, n, score)], ["gram", "n", "score"])

    return stored(shards.mapInArrow(down, "gram long, n long, score double"), "lm-strings")


def _most_seen(strings: DataFrame) -> int:
    """A count that at most ``FREQUENT_GRAMS`` strings exceed."""
    size = F.floor(8 * F.log2(F.col("n").cast("double")))
    steps = strings.where("n > 0").groupBy(size.alias("size")).agg(F.count("*").alias("rows"), F.max("n").alias("n")).collect()
    have = 0
    for step in sorted(steps, key=lambda r: -r["n"]):
        have += step["rows"]
        if have > FREQUENT_GRAMS:
            return step["n"]
    return 0


def _scores(docs: DataFrame, strings: np.ndarray, values: np.ndarray, words: np.ndarray, weights: np.ndarray) -> DataFrame:
    """row, doc_id, held_out, n_tokens, score (of frequent strings), far (the other strings), known and base (of
    frequent words), rest (hashes of the other words)."""
    sent = docs.sparkSession.sparkContext.broadcast((strings, values, words, weights))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, values, words, weights = sent.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in pieces(batch, "text"):
                text = Words(piece.column("text"))
                stream, begin = text.stream()
                gram = _grams(stream, begin)
                order = np.argsort(gram)  # then the search reads its table once
                place = np.searchsorted(strings, gram[order])
                near = np.zeros(len(gram), dtype=bool)
                each = np.zeros(len(gram))
                if len(strings):
                    place = np.minimum(place, len(strings) - 1)
                    near[order] = strings[place] == gram[order]
                    each[order] = values[place]
                score = np.add.reduceat(np.where(near, each, 0.0), begin[:-1])
                far = np.concatenate([[0], np.cumsum(np.add.reduceat(~near, begin[:-1], dtype=np.int64))])
                at = np.minimum(np.searchsorted(words, text.hash), max(0, len(words) - 1))
                hit = words[at] == text.hash if len(words) else np.zeros(len(text.hash), dtype=bool)
                rows = piece.num_rows
                known = np.bincount(text.row[hit], minlength=rows)
                # Of nothing, bincount makes whole numbers.
                base = np.bincount(text.row[hit], weights=weights[at[hit]], minlength=rows).astype(np.float64)
                other = ~hit
                cuts = np.concatenate([[0], np.cumsum(np.bincount(text.row[other], minlength=rows))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + rows)), piece.column("doc_id"), piece.column("held_out"),
                     pa.array(np.diff(text.first) + 1), pa.array(score), pa.array(known.astype(np.int64)), pa.array(base),
                     pa.ListArray.from_arrays(pa.array(far, pa.int32()), pa.array(gram[~near])),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(text.hash[other].view(np.int64)))],
                    ["row", "doc_id", "held_out", "n_tokens", "score", "known", "base", "far", "rest"])
                row += rows

    return docs.mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, score double, known long, "
                                "base double, far array<long>, rest array<long>")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 when divided by 10; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    score: log10 probability of the words and the end by the tree; base_score: by word frequencies. Both learn from
    the documents that are not held out. Null and empty texts consist of the end alone. Repeated rows count as often
    as they occur; without training documents nothing is known and every byte has probability 1/256; an empty table
    gives no rows; texts are read whole at any length; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    train = docs.where("NOT held_out").select("text")
    words = stored(_word_counts(train), "lm-words")
    facts = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = train.count()
    n, v = facts[0] + ends, facts[1] + (1 if ends else 0)
    size = n + SMOOTH * (v + 1)
    share = lambda c: np.log10((c + SMOOTH) / size) if size else 0.0
    often = words.where(F.col("n") > n // FREQUENT_WORDS).select("key", "n").toArrow()
    key, count = often["key"].to_numpy().view(np.uint64), often["n"].to_numpy()
    order = np.argsort(key)
    strings = string_scores(docs.select("text", "held_out"))
    least = _most_seen(strings)
    top = strings.where(F.col("n") > least).select("gram", "score").toArrow()
    gram, value = top["gram"].to_numpy(), top["score"].to_numpy()
    place = np.argsort(gram)
    scored = stored(_scores(docs, gram[place], value[place], key[order], share(count[order].astype(np.float64))), "lm-scores")
    others = strings.where(F.col("n") <= least).select("gram", F.col("score").alias("value"))
    far = scored.select("row", F.explode("far").alias("gram")).join(others, "gram").groupBy("row").agg(
        F.sum("value").alias("more_score"))
    rest = scored.select("row", F.explode("rest").alias("key"))
    rare = words.where(F.col("n") <= n // FREQUENT_WORDS).select("key", "n")
    seen = F.coalesce("n", F.lit(0))
    joined = rest.join(rare, "key", "left").groupBy("row").agg(
        F.count("n").alias("more_known"),
        F.sum(F.log10(seen + F.lit(SMOOTH)) - F.lit(float(np.log10(size)))).alias("more_base"))
    ended = float(share(ends))
    return scored.drop("rest", "far").join(joined, "row", "left").join(far, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + F.lit(ended)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
