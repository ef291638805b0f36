"""KPIs kept as sums per stretch of days, extended by a run and added up over any window.

A stretch is an ISO week, cut where a month ends: whole weeks and whole months are both unions of
stretches, so one stored table serves recency, quarterly, monthly and weekly features. A run reads the
fact of the days it adds and nothing else; windows read the short sums.

Sums add up because a basket has one date: one that is dated over several stretches counts once in each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from basketlens.functions import columns as C
from basketlens.functions.sizing import sized_parts
from basketlens.operators.features import QUARTERS
from basketlens.operators.kpi import HOUSEHOLD, MEASURES, TOTAL, kpi_long

STRETCH = "stretch"  # first day of the stretch
RUN = "run"
SUMS, OWNERS = "sums", "owners"


def stretch_start(day: Column) -> Column:
    """Monday of the week or first of the month, whichever is later."""
    return F.greatest(F.trunc(day, "week"), F.trunc(day, "month")).cast("date")


def stretches(first: date, last: date) -> list[date]:
    """Stretches of ``first`` … ``last``. Both must lie at the ends of stretches: a sum cannot be cut."""
    after = last + timedelta(days=1)
    for day, what in ((first, "first"), (after, "day after the last")):
        if day.weekday() != 0 and day.day != 1:
            raise ValueError(f"the {what} day {day} begins neither a week nor a month")
    if first > last:
        raise ValueError(f"no days between {first} and {last}")
    days = (first + timedelta(days=n) for n in range((after - first).days))
    return [d for d in days if d.weekday() == 0 or d.day == 1]


def stretch_sums(
    txn: DataFrame, groups: Mapping[str, Column], day: str = "date_id", parts: int | None = None
) -> DataFrame:
    """``household_id, stretch, kpi_group, kpi_value, spend, visits, units``, worked out in ``parts`` tasks.

    Decimal money stays decimal, so that the sums of stretches are those of the rows. Rows without a
    date belong to no stretch.
    """
    dated = txn.where(F.col(day).isNotNull()).withColumn(STRETCH, stretch_start(F.col(day)))
    long = kpi_long(dated, groups, by=[STRETCH], parts=parts)
    money = txn.schema["net_spend_amt"].dataType
    if isinstance(money, DecimalType):
        long = long.withColumn("spend", F.col("spend").cast(DecimalType(28, money.scale)))
    return long


def extend(
    txn: DataFrame, path: str, groups: Mapping[str, Column], first: date, last: date, day: str = "date_id",
    parts: int | None = None,
) -> None:
    """Store the stretches of ``first`` … ``last``, also in place of what is stored for them.

    The sums go to a folder of their own run, which owns its stretches from the moment the list of owners
    names it, written last in one file; the run with the highest number owns a stretch. A run that dies
    before that has changed nothing, and the next one writes its folder anew. One run at a time.
    """
    spark = txn.sparkSession
    added = stretches(first, last)
    run = 1 + (owners(spark, path).agg(F.max(RUN)).first()[0] or 0)
    sums = stretch_sums(txn.where(F.col(day).between(first, last)), groups, day, parts)
    # In the order of the stretches, so that a window skips the row groups of others.
    sums.sortWithinPartitions(STRETCH).write.mode("overwrite").parquet(f"{path}/{SUMS}/{RUN}={run}")
    publish(spark, path, run, added)


def publish(spark: SparkSession, path: str, run: int, added: Sequence[date]) -> None:
    listed = spark.createDataFrame([(run, d) for d in added], f"{RUN} int, {STRETCH} date")
    listed.coalesce(1).write.mode("append").parquet(f"{path}/{OWNERS}")


def owners(spark: SparkSession, path: str) -> DataFrame:
    """``stretch, run``: one short row for each week of the history."""
    try:
        listed = spark.read.parquet(f"{path}/{OWNERS}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = spark.createDataFrame([], f"{RUN} int, {STRETCH} date")
    return listed.groupBy(STRETCH).agg(F.max(RUN).alias(RUN))


def stored(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """The sums of ``first`` … ``last``; a window with a stretch that no run owns is refused."""
    wanted = stretches(first, last)
    owned = owners(spark, path).where(F.col(STRETCH).between(first, last))
    gaps = sorted(set(wanted) - {r[STRETCH] for r in owned.collect()})
    if gaps:
        raise ValueError(f"{len(gaps)} stretches are not stored, the first from {gaps[0]}")
    sums = spark.read.parquet(f"{path}/{SUMS}").where(F.col(STRETCH).between(first, last))
    # At most one row a week on the broadcast side.
    return sums.join(F.broadcast(owned), [STRETCH, RUN], "left_semi").drop(RUN)


def recency_starts(end: date, months: tuple[int, ...] = (3, 6, 9)) -> dict[str, date]:
    """First day of each recency slice: that of the month ``n - 1`` months before the month of ``end``."""
    first = {f"L{n}": divmod(end.year * 12 + end.month - n, 12) for n in months}
    return {tag: date(year, month + 1, 1) for tag, (year, month) in first.items()}


def with_quarters(sums: DataFrame, end: date) -> DataFrame:
    """Adds the group ``QTR``: the totals of a stretch under the quarter it lies in, counted back from ``end``."""
    month = C.months_back(F.lit(end), F.col(STRETCH))
    label = F.lit(QUARTERS[-1])
    for n, name in reversed(list(enumerate(QUARTERS[:-1], 1))):
        label = F.when(month <= 3 * n, name).otherwise(label)
    marks = F.array(
        F.struct("kpi_group", "kpi_value"),
        F.struct(F.lit("QTR").alias("kpi_group"), label.alias("kpi_value")),
    )
    own = F.when(F.col("kpi_group") == TOTAL, marks).otherwise(F.slice(marks, 1, 1))
    rest = [c for c in sums.columns if c not in ("kpi_group", "kpi_value")]
    return sums.select(*rest, F.inline(own))


def window_long(sums: DataFrame, slices: Mapping[str, date] | None = None) -> DataFrame:
    """What ``kpi_long`` gives over the days of ``sums``; a slice is everything from its first day on."""
    def added(measure: str, rows: Column | None) -> Column:
        kept = F.col(measure) if rows is None else F.when(rows, F.col(measure))
        total = F.sum(kept)
        if measure != "visits":
            return total.cast("double")
        return total if rows is None else F.coalesce(total, F.lit(0))

    cells = [added(m, None).alias(m) for m in MEASURES]
    for tag, start in (slices or {}).items():
        cells += [added(m, F.col(STRETCH) >= F.lit(start)).alias(f"{m}_{tag}") for m in MEASURES]
    parts = sized_parts(sums)
    if parts is not None:  # combined where it is read, every task would hold the sums of all households
        sums = sums.repartition(parts, HOUSEHOLD)
    return sums.groupBy(HOUSEHOLD, "kpi_group", "kpi_value").agg(*cells)
