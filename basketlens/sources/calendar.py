"""Calendar dimension, one row per day, and the flags that depend on the date alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.functions import columns as C

# A century of days. It bounds what is broadcast and what the windows below see.
MAX_DAYS = 36_600


def date_dim(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Days ``start`` … ``end``. ISO weeks, Monday is weekday 1, periods are months."""
    days = (end - start).days + 1
    if not 0 < days <= MAX_DAYS:
        raise ValueError(f"calendar of {days} days is outside 1..{MAX_DAYS}")
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    base = spark.range(0, days, 1, 1).select(day.alias("date_id"))
    d = F.col("date_id")
    return base.select(
        d,
        C.iso_week_id(d).alias("week_id"),
        C.month_id(d).alias("month_id"),
        C.month_id(d).alias("period_id"),
        C.quarter_id(d).alias("quarter_id"),
        F.year(d).alias("year_id"),
        C.iso_weekday(d).alias("weekday_nbr"),
        F.dayofmonth(d).alias("day_in_month_nbr"),
        F.dayofyear(d).alias("day_in_year_nbr"),
        F.datediff(d, F.lit(date(1970, 1, 1))).alias("day_num_sequence"),
        F.floor(F.datediff(d, F.lit(date(1970, 1, 5))) / 7).cast("int").alias("week_num_sequence"),
        C.iso_week_id(d).alias("promoweek_id"),
    )


def bounded(calendar: DataFrame) -> DataFrame:
    """Broadcast hint for a calendar, whose row count ``date_dim`` has checked."""
    return F.broadcast(calendar)


def neighbour_weeks(calendar: DataFrame) -> DataFrame:
    """Each week with the week before and after it inside the calendar.

    The ordered window has no partition key; it sees one row per week of a bounded calendar.
    """
    order = W.orderBy("week_id")
    return calendar.select("week_id").distinct().select(
        "week_id",
        F.lag("week_id").over(order).alias("lag_week_id"),
        F.lead("week_id").over(order).alias("lead_week_id"),
    )


def festive_days(calendar: DataFrame) -> DataFrame:
    """``date_id, fest_flag``: the last week of December and its neighbours, else April."""
    in_december = (F.col("month_id") % 100 == 12) & (
        F.floor(F.col("week_id") / 100) == F.floor(F.col("month_id") / 100)
    )
    last_week = calendar.where(in_december).agg(F.max("week_id")).scalar()
    xmas = neighbour_weeks(calendar).select(
        "week_id",
        F.coalesce(
            (F.col("week_id") == last_week)
            | F.coalesce(F.col("lead_week_id") == last_week, F.lit(False))
            | F.coalesce(F.col("lag_week_id") == last_week, F.lit(False)),
            F.lit(False),
        ).alias("is_xmas"),
    )
    flag = (
        F.when(F.col("is_xmas"), "XMAS")
        .when(F.col("month_id") % 100 == 4, "APRIL")
        .otherwise("NONE")
    )
    return calendar.join(bounded(xmas), "week_id").select("date_id", flag.alias("fest_flag"))


def last_weekend_days(calendar: DataFrame) -> DataFrame:
    """Friday to Sunday around the last Saturday that each month has in the calendar."""
    saturday = F.max(F.when(F.col("weekday_nbr") == 6, F.col("date_id"))).alias("sat")
    around = F.explode(F.array(F.date_sub("sat", 1), F.col("sat"), F.date_add("sat", 1)))
    return (
        calendar.groupBy("month_id")
        .agg(saturday)
        .where(F.col("sat").isNotNull())
        .select(around.alias("date_id"))
        .distinct()
    )


def flagged_calendar(calendar: DataFrame) -> DataFrame:
    """Calendar with every date-only flag, so that the fact needs a single join."""
    weekend = last_weekend_days(calendar).withColumn("last_weekend_flag", F.lit("Y"))
    return (
        calendar.join(bounded(festive_days(calendar)), "date_id")
        .join(bounded(weekend), "date_id", "left")
        .fillna("N", subset=["last_weekend_flag"])
    )
