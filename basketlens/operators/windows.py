"""Per-group sets and day neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MOST_LISTED = 10_000


def distinct_long(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The distinct values of each group as rows: the exact form for groups of any size."""
    return df.where(F.col(column).isNotNull()).select(*keys, column).distinct()


def distinct_sketch(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """A sketch of each group's distinct values; sketches of parts merge by ``merged_sketch``."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column).alias(out))


def merged_sketch(parts: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """``out``: the estimated number of distinct values over all parts of a group."""
    return parts.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(column)).alias(out))


def win_collect_distinct(
    df: DataFrame, keys: Sequence[str], column: str, out: str, most: int = MOST_LISTED
) -> DataFrame:
    """Adds the sorted distinct values of ``column`` in the row's group, and their number.

    Distinct pairs are rows first and move once, so that sets are made in tasks of their own and not in
    those that read the rows and join them. Only groups of at most ``most`` values are listed; a larger one
    has its exact number and a null list, and ``distinct_long`` has its values.
    """
    n = F.col(f"n_{out}")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = distinct_long(df, keys, column).repartition(parts, *keys)
    sizes = pairs.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias(f"n_{out}"))
    listed = F.array_sort(F.collect_list(F.when(n <= most, F.col(column))))  # nothing is collected for larger groups
    sets = pairs.join(sizes, list(keys)).groupBy(*keys, f"n_{out}").agg(listed.alias(out))
    found = df.join(sets.withColumn(out, F.when(n <= most, F.col(out))), list(keys), "left")
    none = F.array().cast(f"array<{df.schema[column].dataType.simpleString()}>")
    number = F.coalesce(n, F.lit(0))
    return found.withColumns({out: F.when(number == 0, none).otherwise(F.col(out)), f"n_{out}": number}).select(
        *df.columns, out, f"n_{out}")


def day_and_neighbours(df: DataFrame, day: str = "date_id") -> DataFrame:
    """Each row for its day, the day after and the day before, from one read of the input."""
    around = F.array(F.col(day), F.date_add(day, 1), F.date_sub(day, 1))
    rest = [c for c in df.columns if c != day]
    return df.select(*rest, F.explode(around).alias(day))
