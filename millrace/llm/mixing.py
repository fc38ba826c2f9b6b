"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Built from DataFrame functions only. Sizes are words. A source with weight ``w`` gets ``level * w`` words, but at
most ``max_epochs`` times its own; ``level`` is the one at which all targets together equal all sizes. The level is
found in one pass over the sources in the order in which they reach their cap, which is where repeated clamping and
proportional redistribution ends.

Every document is taken ``floor(target / size)`` times, and once more if its seeded hash lies at or below the cut of
its source. The cut is the hash at which the words taken come nearest to the target. Finding it needs running sums by
hash; they are first taken over 4,096 hash ranges of each source, and only the range that holds the cut is opened, so
a source with a third of all rows puts 1/4096 of them into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, n_words, small_side, stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
RANGE_DIGITS = 3  # hexadecimal digits of the hash: 4,096 ranges
SOURCE_ROW_BYTES = 200


def _order(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source of ``sizes`` (source, source_size): source, source_size, target.

    Sources take the weights in turn by code point, null last.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    known = (
        capped.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("below", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("full", F.col("cap") * F.col("rest") <= (F.col("total") - F.col("below")) * F.col("weight"))
        .withColumn("open_below", F.min(F.when(~F.col("full"), F.col("below"))).over(everything))
        .withColumn("open_rest", F.max(F.when(~F.col("full"), F.col("rest"))).over(everything))
    )
    share = (F.col("total") - F.col("open_below")) * F.col("weight") / F.col("open_rest")
    return known.select(
        "source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mixing_table(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                 seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Sized documents (doc_id, source, size, place) and, per source, source, source_size, target, whole, cut."""
    sized = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        _order(F.col(id_col), seed).alias("place")), "mix-sizes")
    spans = stored(
        sized.groupBy("source", F.substring("place", 1, RANGE_DIGITS).alias("span")).agg(F.sum("size").alias("words")),
        "mix-spans")
    targets = source_targets(spans.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = stored(targets.withColumn("whole", F.least(F.floor(ratio), F.lit(max_epochs)).cast("long")).withColumn(
        "want", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    running = Window.partitionBy("source").orderBy("span")
    same = lambda left, right: left["source"].eqNullSafe(right["source"])
    before = spans.withColumn("upto", F.sum("words").over(running)).withColumn("before", F.col("upto") - F.col("words"))
    crossing = before.join(small_side(plan, SOURCE_ROW_BYTES), same(before, plan)).where(
        (F.col("before") <= F.col("want")) & (F.col("want") < F.col("upto"))
    ).select(before["source"], "span", "before", "want")
    crossing = stored(crossing, "mix-crossing")
    inside = sized.withColumn("span", F.substring("place", 1, RANGE_DIGITS))
    opened = inside.join(
        small_side(crossing, SOURCE_ROW_BYTES), same(inside, crossing) & (inside["span"] == crossing["span"])
    ).select(inside["source"], "place", "size", "before", "want")
    by_place = Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    steps = opened.select("source", "place", "want", (F.col("before") + F.sum("size").over(by_place)).alias("taken"))
    start = crossing.select("source", F.col("span").alias("place"), "want", F.col("before").alias("taken"))
    cut = steps.unionByName(start).groupBy("source").agg(
        F.min_by("place", F.struct(F.abs(F.col("taken") - F.col("want")), "place")).alias("cut"))
    table = plan.join(cut, same(plan, cut), "left").select(
        plan["source"], "source_size", "target", "whole", "cut")
    return sized, stored(table, "mix-plan")


def _copies(place: Column) -> Column:
    return F.col("whole") + F.when(place <= F.col("cut"), 1).otherwise(0)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's), taken (words, repeats counted).

    Null or empty text has size 0, null sources are one source, repeated rows are decided alike, an empty table
    gives no rows. Other columns are ignored.
    """
    sized, table = mixing_table(docs, **options)
    table = small_side(table, SOURCE_ROW_BYTES)
    return sized.join(table, sized["source"].eqNullSafe(table["source"])).select(
        "doc_id", "size", "source_size", "target", (_copies(F.col("place")) * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source",
                  **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, columns unchanged.

    Texts without words have no size; they are taken as often as the others of their source.
    """
    _, table = mixing_table(docs, seed=seed, id_col=id_col, source_col=source_col, **options)
    names = {n: fresh(docs, "__mix_" + n) for n in ("source", "whole", "cut", "copies", "copy")}
    table = small_side(table.select(*[F.col(n).alias(names[n]) for n in ("source", "whole", "cut")]), SOURCE_ROW_BYTES)
    copies = F.col(names["whole"]) + F.when(_order(F.col(id_col), seed) <= F.col(names["cut"]), 1).otherwise(0)
    joined = docs.join(table, docs[source_col].eqNullSafe(F.col(names["source"])))
    return (
        joined.withColumn(names["copies"], copies).where(F.col(names["copies"]) > 0)
        .withColumn(names["copy"], F.explode(F.sequence(F.lit(1), F.col(names["copies"]).cast("int"))))
        .select(*docs.columns)
    )
