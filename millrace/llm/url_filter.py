"""URL filter: host rules first, else the ratio of two character language models.

Both models are variable-order Markov models over URL characters: contexts of up to three characters, each order
smoothed with the next shorter one (Witten-Bell). One learns from accepted, one from rejected URLs. A URL's score is
its log-likelihood under the rejecting model less that under the accepting one, per character; it is blocked above a
threshold that is calibrated on accepted URLs the models haven't seen.

Characters fall into 40 classes, so a model is a table of at most 40**4 numbers whatever the corpus; counting runs
over all URLs in Spark, with partial sums before the shuffle. Equal URL shapes (digits folded) count once, so that one
host with a third of all pages doesn't drown the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

CLASSES = 40
ORDER = 3
#: 38 named characters (one digit for all); everything else is class 38, the start is class 39.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_%=:~+,@"
OTHER, START, END = 38, 39, 37  # the last named character, @, does not occur in a host or path unquoted: it ends
#: Words in a host that make a URL an example of the rejected ones. Fixed values.
REJECTED_WORDS = (
    "adult", "bets", "betting", "bonus", "casino", "cheap", "crack", "dating", "escort", "gambling", "jackpot",
    "loan", "nude", "pharma", "pills", "poker", "porn", "replica", "sex", "slots", "spam", "torrent", "viagra",
    "warez", "xxx",
)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
FOLDS = 5
#: Share of unseen accepted URLs that may lie above the threshold.
FALSE_BLOCKS = 0.002

_CODE = np.full(256, OTHER, dtype=np.int64)
for _at, _letter in enumerate(ALPHABET[:-1]):
    _CODE[ord(_letter)] = _at
for _digit in "0123456789":
    _CODE[ord(_digit)] = ALPHABET.index("0")
for _upper in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _CODE[ord(_upper)] = ALPHABET.index(_upper.lower())


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (``host/path start``) that fits, and its verdict; null where none does.

    Of equally long rules the one listed first wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def shape(host: Column, path: Column) -> Column:
    """The text that models read: host and path, runs of digits folded."""
    return F.regexp_replace(F.concat(host, path), "[0-9]+", "0")


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every character of every text and one end sign: code of its four-gram; row; and the rows' lengths."""
    values = [t.encode() for t in texts.to_pylist()]
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    row = np.repeat(np.arange(len(values)), sizes + 1)
    chars = _CODE[np.frombuffer(b"@".join(values) + b"@", dtype=np.uint8)]
    chars[np.cumsum(sizes + 1) - 1] = END
    first = np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
    here, code = np.arange(len(chars)), chars.copy()
    for back in range(1, ORDER + 1):
        code += CLASSES ** back * np.where(here - back >= first, chars[np.maximum(here - back, 0)], START)
    return code, row, sizes + 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        code, row, _ = _coded(batch.column(0))
        rejected = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        key, n = np.unique(code * 2 + rejected[row], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])


def markov_table(code: np.ndarray, count: np.ndarray) -> np.ndarray:
    """log probability of every four-gram's last character after the three before it."""
    counts = np.zeros(CLASSES ** (ORDER + 1))
    counts[code] = count
    probability = np.full(CLASSES, 1.0 / CLASSES)
    for order in range(ORDER + 1):
        seen = counts.reshape(-1, CLASSES ** order, CLASSES).sum(axis=0)
        total, kinds = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
        lower = np.tile(probability.reshape(-1, CLASSES), (CLASSES if order else 1, 1))
        mixed = (seen + kinds * lower) / np.maximum(total + kinds, 1)
        probability = np.where(total > 0, mixed, lower)
    return np.log(probability.reshape(-1)).astype(np.float32)


@dataclass(frozen=True)
class UrlModel:
    """``ratio[code]``: log-likelihood under the rejecting model less that under the accepting one."""

    ratio: np.ndarray
    threshold: float


def _scorer(sent):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, row, sizes = _coded(batch.column(batch.num_columns - 1))
            total = np.bincount(row, weights=sent.value[code], minlength=len(sizes)).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(total / sizes)], [*batch.schema.names[:-1], "score"])

    return score


def fit(examples: DataFrame, false_blocks: float = FALSE_BLOCKS) -> UrlModel:
    """Learn from (shape string, rejected boolean); equal shapes count once.

    One shape in ``FOLDS``, by hash, stays out of counting; the threshold is the quantile of those that are accepted,
    and never below 0. Without rejected or without accepted examples nothing is blocked.
    """
    spark = examples.sparkSession
    kinds = stored(examples.groupBy("shape").agg(F.max(F.col("rejected").cast("int")).alias("rejected")), "url-shapes")
    held_out = F.pmod(F.crc32(F.col("shape").cast("binary")), F.lit(FOLDS)) == 0
    counted = kinds.where(~held_out).mapInArrow(_count, "key long, n long").groupBy("key").agg(
        F.sum("n").alias("n")).toArrow()  # at most 2 * 40**4 rows
    key, n = counted["key"].to_numpy(), counted["n"].to_numpy()
    tables = [markov_table(key[key % 2 == side] // 2, n[key % 2 == side]) for side in (0, 1)]
    ratio = tables[1] - tables[0]
    if not (key % 2 == 1).any() or not (key % 2 == 0).any():
        return UrlModel(ratio, float("inf"))
    unseen = kinds.where(held_out & (F.col("rejected") == 0)).select("shape").mapInArrow(
        _scorer(spark.sparkContext.broadcast(ratio)), "score double")
    limit = unseen.agg(F.percentile_approx("score", 1 - false_blocks, 10_000)).first()[0]
    return UrlModel(ratio, max(0.0, limit or 0.0))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
               rejected_words: Sequence[str] = REJECTED_WORDS, id_col: str = "page_id",
               url_col: str = "url", false_blocks: float = FALSE_BLOCKS) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict (allow or block), score (of the model; higher is worse).

    Null urls and urls without ``://`` have an empty host and path; they fit no rule, and the model judges the empty
    text. Very long urls are scored whole. Repeated rows are judged alike; an empty table gives no rows; other columns
    are ignored. A url is an example of the rejected ones if a word of ``rejected_words`` is in its host.
    """
    url = F.col(url_col)
    split = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    text = shape(F.col("host"), F.col("path"))
    listed = F.regexp_like("host", F.lit("|".join(rejected_words))) if rejected_words else F.lit(False)
    model = fit(split.where("host != ''").select(text.alias("shape"), listed.alias("rejected")), false_blocks)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    sent = pages.sparkSession.sparkContext.broadcast(model.ratio)
    kind = pages.schema[id_col].dataType.simpleString()
    scored = split.withColumn("shape", text).mapInArrow(
        _scorer(sent), f"page_id {kind}, host string, path string, score double")
    modelled = F.when(F.col("score") > model.threshold, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, modelled).alias("verdict"), "score")
