"""Broadcast hints behind a check of the size."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 << 20
UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")
_SIZE = re.compile(r"== Optimized Logical Plan ==.*?Statistics\(sizeInBytes=([0-9.E+]+) (\w+)", re.DOTALL)


def estimated_bytes(df: DataFrame) -> int | None:
    """Size of the rows by the optimizer's statistics, as EXPLAIN COST gives it; None if it gives none."""
    text = df.sparkSession.sql("EXPLAIN COST SELECT * FROM {rows}", rows=df).first()[0]
    found = _SIZE.search(text)
    return round(float(found[1]) * 1024 ** UNITS.index(found[2])) if found else None


def broadcast_if_small(df: DataFrame, source: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if ``source`` bounds it and is small, else unchanged.

    ``source`` is the table that ``df`` is derived from by steps that add no rows. Estimates of
    joined plans multiply; that of one scan is the size of its files. Without the hint the join
    stays a shuffle join that adaptive execution may still convert at run time.
    """
    size = estimated_bytes(source)
    return F.broadcast(df) if size is not None and size <= limit else df


TASK_BYTES = 8 << 20  # of the files read, for each task of a join of whole tables
LONG_BYTES = 1 << 20  # the same where every row is repeated for each of some twenty dimensions
LEFT_ALONE = 64 << 20  # below that, adaptive execution gives every core a part smaller than this


def sized_parts(*sources: DataFrame, task_bytes: int | None = None) -> int | None:
    """Number of parts in which the rows of ``sources`` are joined, by the size of their files; None if they
    are small or their size is not known."""
    sizes = [estimated_bytes(source) for source in sources]
    if None in sizes or sum(sizes) <= LEFT_ALONE:
        return None
    return -(-sum(sizes) // (task_bytes or TASK_BYTES))


def join_parts(left: DataFrame, right: DataFrame, on: str, *sources: DataFrame) -> DataFrame:
    """Inner join of two large tables on a key without heavy values, in parts that do not grow with the tables.

    Adaptive execution merges parts by the bytes they move, which columns of one value make few; a task's
    sorting and summing takes many times that. An aggregation by the key and more uses the same parts.
    """
    n = sized_parts(*sources)
    if n is not None:
        left, right = left.repartition(n, on), right.repartition(n, on)
    return left.join(right, on)
