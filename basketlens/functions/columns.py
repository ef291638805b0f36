"""Column expressions shared by the operators; all of them stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(top: Column, bottom: Column) -> Column:
    """Double division, 0 where the divisor is null or 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def percent_of(part: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(part * 100, total).cast("double"), F.lit(0.0))


def yes_no(condition: Column) -> Column:
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def bucket_label(value: Column, buckets: Mapping[str, Iterable], default: Column) -> Column:
    """Label of the first bucket that lists ``value``."""
    out = None
    for label, members in buckets.items():
        hit = value.isin(list(members))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return default if out is None else out.otherwise(default)


def time_of_day(hour: Column) -> Column:
    return (
        F.when(hour.between(5, 8), "prework")
        .when(hour.between(9, 11), "morning")
        .when(hour == 12, "lunch")
        .when(hour.between(13, 17), "afternoon")
        .when(hour.between(18, 20), "evening")
        .when(hour >= 21, "late")
        .when(hour <= 4, "night")
        .otherwise("def")
    )


def week_of_month(day: Column) -> Column:
    """Days 1-7 are week 1, the days after the 21st are week 4."""
    return F.least(F.lit(4), F.ceil(day / 7).cast("int"))


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def iso_week_id(day: Column) -> Column:
    return (F.extract(F.lit("YEAROFWEEK"), day) * 100 + F.weekofyear(day)).cast("int")


def month_id(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def quarter_id(day: Column) -> Column:
    return (F.year(day) * 100 + F.quarter(day)).cast("int")


def months_back(end: Column, day: Column) -> Column:
    """1 for the month that closes at ``end``, 2 for the month before, and so on."""
    return F.months_between(end, F.last_day(day)) + 1


def fine_day_part(hour: Column) -> Column:
    return (
        F.when(hour.between(0, 8), "early_morning")
        .when(hour.between(9, 10), "morning")
        .when(hour.between(11, 12), "lunch")
        .when(hour.between(13, 16), "afterlunch")
        .when(hour.between(17, 18), "evening")
        .when(hour.between(19, 20), "late_evening")
        .when(hour.between(21, 23), "night")
        .otherwise("missing")
    )


def posterior(probability: Column, offset: float) -> Column:
    """Probability moved back from a rebalanced training sample to the population."""
    return probability * offset / (F.lit(1.0) + probability * (offset - 1.0))


def points(probability: Column, base: float, double_odds: float) -> Column:
    """Score points; null where the odds are not finite (p outside ]0, 1[)."""
    inside = (probability > 0) & (probability < 1)
    odds = F.try_divide(F.lit(1.0) - probability, probability)
    return F.when(inside, F.lit(base) + F.lit(double_odds) / F.ln(F.lit(2.0)) * F.ln(odds))
