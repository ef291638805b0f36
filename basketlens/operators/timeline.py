"""Dates of a household around its first contact."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.sources.calendar import bounded


def agg_household_card_date(customers: DataFrame) -> DataFrame:
    return customers.groupBy("household_id").agg(
        F.max("card_issue_date").alias("last_card_issue_date")
    )


def days_since_registration(df: DataFrame, end: date) -> DataFrame:
    return df.withColumn("day_regis", F.datediff(F.lit(end), F.col("last_card_issue_date")))


def card_age_at_contact(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "card_aging_day", F.datediff("first_contact_date", "last_card_issue_date")
    )


def recency_start_dates(df: DataFrame, days: Iterable[int] = K.RECENCY_DAYS) -> DataFrame:
    return df.withColumns(
        {f"r{n}_start_date": F.date_sub("first_contact_date", n) for n in days}
    )


def recency_week_ids(
    df: DataFrame, calendar: DataFrame, days: Iterable[int] = K.RECENCY_DAYS, min_age: int = 0
) -> DataFrame:
    """Calendar week of each start date; cards younger than ``min_age`` at contact drop out."""
    out = df.where(F.col("card_aging_day") >= min_age)
    for n in days:
        weeks = calendar.select(
            F.col("date_id").alias(f"r{n}_start_date"), F.col("week_id").alias(f"r{n}_wk_id")
        )
        out = out.join(bounded(weeks), f"r{n}_start_date", "left")
    return out


def household_timeline(
    contacts: DataFrame, customers: DataFrame, calendar: DataFrame, end: date,
    days: Iterable[int] = K.RECENCY_DAYS,
) -> DataFrame:
    """Contact dates with card age, registration, recency starts and calendar periods."""
    periods = calendar.select(
        F.col("date_id").alias("first_contact_date"), "week_id", "quarter_id", "period_id"
    )
    dated = contacts.join(agg_household_card_date(customers), "household_id", "left").join(
        bounded(periods), "first_contact_date"
    )
    dated = recency_start_dates(card_age_at_contact(dated), days)
    return recency_week_ids(days_since_registration(dated, end), calendar, days)


def agg_scalar_bounds(df: DataFrame, column: str, back_days: int = K.BACK_DAYS) -> DataFrame:
    """One row: first and last value and where the data of a run has to begin."""
    return df.agg(
        F.date_sub(F.min(column), back_days).alias("min_data_date"),
        F.min(column).alias("min_contact_date"),
        F.max(column).alias("max_data_date"),
    )


def timeframe(days: DataFrame, column: str = "date_id", months: int = 12) -> DataFrame:
    """One row: window of ``months`` whole months that ends with the last complete month."""
    last = F.max(column)
    end = F.when(last == F.last_day(last), last).otherwise(F.date_sub(F.trunc(last, "month"), 1))
    bounds = days.agg(end.alias("timeframe_end")).withColumn(
        "timeframe_start", F.to_date(F.add_months(F.trunc("timeframe_end", "month"), 1 - months))
    )
    week = lambda c: F.extract(F.lit("YEAROFWEEK"), F.col(c)) * 100 + F.weekofyear(c)
    return bounds.select(
        "timeframe_start",
        "timeframe_end",
        week("timeframe_start").cast("int").alias("start_week"),
        week("timeframe_end").cast("int").alias("end_week"),
        F.datediff("timeframe_end", "timeframe_start").alias("gap_days"),
    )


def data_start(first_contact: date, back_days: int = K.BACK_DAYS) -> date:
    return first_contact - timedelta(days=back_days)
