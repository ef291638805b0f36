"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Each source has a target share of all words, at most ``max_repeat`` times its size; what a capped
source leaves is shared by weight among the others. A document is expected c times, c being its
source's target by size times the document's ``propensity`` relative to the source's mean. floor(c)
copies are certain; the rest p = c - floor(c) is an inclusion probability. Documents are ranked by
Pareto's variable, the random odds u/(1-u) over the inclusion odds p/(1-p), and taken from the
smallest on until the words still due are reached: a sample of fixed size in words, with unequal
probabilities where propensities or sources differ. u comes from a hash of the id, so reruns agree.

No window holds a whole source: documents are counted in ranges of the rank variable, a running
total over the ranges finds the one in which the target is met, and only that range is ordered.

Defined results: a null text has size 0, and size 0 is taken 0 times; null source is a source of its
own, the last; rows with a null id are ranked as one hash value and ordered by size; repeated rows
count and are ranked each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.sources.writers import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3
RANGE_ROWS = 5_000


def uniform(doc_id: Column, seed: str = "") -> Column:
    """A number in (0, 1) from 52 bits of a hash of the id."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(seed))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(2**52)


def sized(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source``, ``source_size``, ``target``: one row a source, by water filling.

    ``sizes`` is summed by source first; the windows below see one row a source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(max_repeat)
    by_need = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    filled = by_source.withColumn("weight", weight).withColumn("cap", cap).withColumn("level", level)
    open_ = filled.withColumn("open", F.col("cap") >= F.col("weight") * F.col("level"))
    first = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)
    return open_.withColumn("final", first["level"]).select(
        "source", "source_size", "rows",
        F.coalesce(
            F.least(F.col("cap").cast("double"), F.col("weight") * F.col("final")), F.lit(0.0)
        ).alias("target"),
    )


def pareto_mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT,
    propensity: Column | None = None, seed: str = "",
) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``propensity`` (positive, of the columns ``doc_id``, ``source``, ``size``) makes documents of a
    source unequal; without it they differ between sources only. No document is taken more than
    ``max_repeat`` times.
    """
    sizes = sized(docs)
    want = F.lit(1.0) if propensity is None else propensity.cast("double")
    sizes = staged(sizes.withColumn("want", want), "mix-sizes")
    goal = targets(sizes, weights, max_repeat)
    meant = sizes.groupBy("source").agg(F.sum(F.col("want") * F.col("size")).alias("wanted"))
    goal = staged(goal.join(meant, goal["source"].eqNullSafe(meant["source"])).drop(meant["source"]), "mix-targets")

    by = sizes.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    expected = F.least(F.coalesce(F.try_divide(F.col("target") * F.col("want"), F.col("wanted")), F.lit(0.0)), F.lit(float(max_repeat)))
    whole = F.floor(expected)
    p = expected - whole
    u = uniform(F.col("doc_id"), seed)
    odds = F.when((p > 0) & (F.col("size") > 0), (u / (1 - u)) * (1 - p) / p)
    drawn = by.select(
        "doc_id", "source", "size", "source_size", "target", whole.cast("long").alias("whole"), odds.alias("odds"),
        F.floor(F.col("rows") / RANGE_ROWS + 1).alias("ranges"),
    ).withColumn("range", F.floor(F.col("odds") / (1 + F.col("odds")) * F.col("ranges")))

    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))  # a key without nulls
    drawn = drawn.withColumn("key", source)
    ranges = drawn.groupBy("key", "range").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("whole")).alias("sure"), F.first("target").alias("goal"))
    all_of = W.partitionBy("key")
    due = F.col("goal") - F.sum("sure").over(all_of)
    ordered = all_of.orderBy(F.col("range").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(F.col("range").isNotNull(), F.col("words"))).over(ordered), F.lit(0))
    plan = ranges.where("key IS NOT NULL").select("key", F.col("range"), due.alias("due"), before.alias("before"), "words")
    plan = plan.where("range IS NOT NULL")
    met = F.col("before") + F.col("words") <= F.col("due")
    split = plan.where(~met & (F.col("before") < F.col("due"))).select("key", "range", (F.col("due") - F.col("before")).alias("left"))
    last = plan.where(met).groupBy("key").agg(F.max("range").alias("last"))
    cut = last.join(split, "key", "full").select("key", F.coalesce("last", F.lit(-1)).alias("last"), F.col("range").alias("at"), "left")
    cut = staged(cut, "mix-cut")

    placed = drawn.join(cut, "key", "left")
    inside = placed.where(F.col("range") == F.col("at"))
    upto = W.partitionBy("key", "range").orderBy("odds", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum("size").over(upto), F.lit(0))
    nearer = so_far + F.col("size") / 2 <= F.col("left")
    inside = inside.withColumn("drawn", nearer.cast("long"))
    outside = placed.where(~F.coalesce(F.col("range") == F.col("at"), F.lit(False))).withColumn(
        "drawn", F.coalesce(F.col("range") <= F.col("last"), F.lit(False)).cast("long"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("drawn")).otherwise(F.lit(0)).cast("long")
    return inside.unionByName(outside).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
