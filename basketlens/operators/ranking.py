"""Running totals over an ordered data set without a single-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.sources.writers import staged


def _range_sql(column: str, bounds: Sequence[float], first: int = 0) -> str:
    """Number of bounds below the column, as nested comparisons that halve the bounds."""
    if not bounds:
        return str(first)
    mid = len(bounds) // 2
    above = _range_sql(column, bounds[mid + 1:], first + mid + 1)
    below = _range_sql(column, bounds[:mid], first)
    return f"if({column} > {bounds[mid]!r}D, {above}, {below})"


def with_quantile_bucket(
    df: DataFrame, column: str, out: str, buckets: int = 256
) -> DataFrame:
    """Adds the number of the range ``column`` lies in; ranges hold about equally many rows.

    The bounds, ``buckets`` numbers at most, are looked up first. They are approximate, but the
    order of the buckets is exact, so totals built on them are exact too.
    """
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(column, shares)).first()[0] or []
    bounds = sorted({float(b) for b in found if math.isfinite(b)})
    return df.withColumn(out, F.expr(_range_sql(f"`{column}`", bounds)))


def running_totals(
    df: DataFrame,
    bucket: str,
    order: Sequence[str],
    measures: Sequence[str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Adds ``before_<m>``: the total of ``m`` over all rows that come earlier.

    ``bucket`` must grow with ``order``. Rows are ordered inside their bucket only; what the
    buckets before it hold is added from one row per bucket.
    """
    keys = [*within, bucket]
    totals = df.groupBy(*keys).agg(*[F.sum(m).alias(f"sum_{m}") for m in measures])
    past = W.partitionBy(*within).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"sum_{m}").over(past), F.lit(0)).alias(f"off_{m}") for m in measures]
    )
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = df.withColumns(
        {f"loc_{m}": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures}
    )
    summed = local.join(offsets, keys).withColumns(
        {f"before_{m}": F.col(f"loc_{m}") + F.col(f"off_{m}") for m in measures}
    )
    return summed.drop(*[f"{p}_{m}" for p in ("loc", "off") for m in measures])


def text_positions(values: DataFrame, column: str, out: str) -> DataFrame:
    """``column`` and ``out``, the number of smaller texts, of a table of distinct texts.

    The texts are dealt to ranges by splitters that Spark samples, and numbered inside their range on top
    of the totals of the ranges before it. The ranges are stored, so that a task that runs again finds
    the same ones; there are as many as the table fills, whatever letters it begins with.
    """
    dealt = values.select(column).repartitionByRange(column).select(
        column, F.spark_partition_id().alias("range"), F.lit(1).alias("one"))
    ranked = running_totals(staged(dealt, "text-ranges"), "range", [column], ["one"])
    return ranked.select(column, F.col("before_one").alias(out))
