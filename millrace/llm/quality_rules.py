"""Quality rules under weak supervision: rules vote or abstain, expectation-maximisation weighs them.

DataFrame functions only. Every rule looks at counts of one document and says good, bad or nothing. The combinations
of votes (at most 3 ** rules) are counted over all documents; on that small table, expectation-maximisation estimates
how often good documents are and how often each rule is right for good and for bad ones. A document's posterior
probability of being good decides, not whether it passes every rule.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, small_side, stored

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
KEEP_FROM = 0.5
GOOD, BAD, NONE = "g", "b", "-"
#: Bounds of the estimates. Rules are written to call hardly any good document bad, and without that bound a kind of
#: bad document that only one rule sees would be taken for good. A rule may miss most bad documents, since each looks
#: for one kind of them.
RIGHT_FOR_GOOD, RIGHT_FOR_BAD = (0.995, 0.999), (0.05, 0.95)
PRIOR = (0.05, 0.98)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts that rules look at; nothing leaves its row.

    n_repeat_words: 64-bit hashes stand for windows. Only rows in which some hash occurs twice are sorted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    words = base.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).withColumn(
        "lines", F.filter(F.split("text", "\n", -1), lambda line: F.regexp_like(line, F.lit(WORD))))
    counted = words.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    starts = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")))
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]))
    hashed = counted.withColumn("windows", windows).drop("hashes")
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    ranked = hashed.withColumn("ranked", F.when(again, F.array_sort(F.transform(
        "windows", lambda h, i: F.struct(h.alias("hash"), i.alias("at")))))).drop("windows")
    twice = F.filter("ranked", lambda x, k: (
        (F.get("ranked", k + 1)["hash"] == x["hash"]) | ((k > 0) & (F.get("ranked", F.greatest(k - 1, F.lit(0)))["hash"] == x["hash"]))))
    placed = ranked.withColumn("twice", F.array_sort(F.transform(twice, lambda x: x["at"]))).drop("ranked")
    reach = F.transform("twice", lambda at, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get("twice", k + 1) - at, F.lit(WINDOW))).cast("long"))
    covered = F.aggregate(reach, F.lit(0).cast("long"), lambda total, x: total + x)
    return placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("twice")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE)


def default_rules() -> dict[str, Column]:
    """Name of each rule and its vote as a column over the counts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "length": _vote(F.col("n_words") >= 40, F.col("n_words") < MIN_WORDS),
        "word_length": _vote(mean.between(3.5, 9.0), (mean < 2.5) | (mean > 14.0)),
        "symbols": _vote(F.col("n_symbols") * 50 <= words, F.col("n_symbols") * 5 > words),
        "repeated_lines": _vote(
            (F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0), F.col("n_dup_lines") * 10 > F.col("n_lines") * 3),
        "repeated_words": _vote(
            F.col("n_repeat_words") * 20 <= words, F.col("n_repeat_words") * 100 > words * MAX_REPEATED_PERCENT),
        "capitals": _vote(
            F.col("n_upper") * 5 <= F.col("word_chars"), F.col("n_upper") * 2 > F.col("word_chars")),
    }


def estimate(patterns: Mapping[str, int], rules: int, rounds: int = 60) -> dict[str, float]:
    """Posterior probability of *good* for every combination of votes, by expectation-maximisation.

    Two hidden classes; given the class, rules that vote are independent. It starts from a share of 0.8 good and
    rules that are right for 995 in 1,000 good and for every second bad document.
    """
    total = sum(patterns.values())
    if not total:
        return {}
    prior = 0.8
    right = {GOOD: [0.995] * rules, BAD: [0.5] * rules}
    posterior: dict[str, float] = {}
    for _ in range(rounds):
        for pattern in patterns:
            odds = math.log(prior / (1 - prior))
            for k, vote in enumerate(pattern):
                if vote == GOOD:
                    odds += math.log(right[GOOD][k] / (1 - right[BAD][k]))
                elif vote == BAD:
                    odds += math.log((1 - right[GOOD][k]) / right[BAD][k])
            posterior[pattern] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
        good = sum(n * posterior[p] for p, n in patterns.items())
        prior = min(max(good / total, PRIOR[0]), PRIOR[1])
        for side, share in ((GOOD, lambda p: posterior[p]), (BAD, lambda p: 1 - posterior[p])):
            for k in range(rules):
                cast = sum(n * share(p) for p, n in patterns.items() if p[k] != NONE)
                hit = sum(n * share(p) for p, n in patterns.items() if p[k] == side)
                # Two imagined votes keep a rule that hardly votes from extremes.
                low, high = RIGHT_FOR_GOOD if side == GOOD else RIGHT_FOR_BAD
                right[side][k] = min(max((hit + 1.0) / (cast + 2.0), low), high)
    return posterior


def judge_quality(docs: DataFrame, rules: Mapping[str, Column] | None = None, keep_from: float = KEEP_FROM,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept, probability, votes (a letter for each rule: g, b or -).

    base_failed: fewer than 10 words, or more than a fifth of the words in repeated five-word windows. Null and empty
    texts have no words and fail. Very long texts are counted whole. Repeated rows are judged alike; an empty table
    gives no rows; other columns are ignored.
    """
    rules = default_rules() if rules is None else rules
    votes: Sequence[Column] = list(rules.values())
    counts = stored(word_counts(docs, id_col, text_col).withColumn("votes", F.concat(*votes)), "quality-counts")
    seen = counts.groupBy("votes").count().collect()  # at most 3 ** rules rows
    posterior = estimate({r["votes"]: r["count"] for r in seen}, len(votes))
    table = docs.sparkSession.createDataFrame(sorted(posterior.items()), "votes string, probability double")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)
    return counts.join(small_side(table, 64, len(posterior)), "votes").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("probability") >= keep_from)).alias("kept"), "probability", "votes")
