"""Filters, defaults and value maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.config import Window
from basketlens.functions.columns import bucket_label


def filter_between_dates(
    df: DataFrame, window: Window, day: str = "date_id", week: str | None = "week_id"
) -> DataFrame:
    """Rows of the window, both ends included; the week range lets a partitioned scan prune."""
    out = df.where(F.col(day).between(window.start, window.end))
    if week is None:
        return out
    return out.where(F.col(week).between(window.start_week, window.end_week))


def filter_in_list(
    df: DataFrame, column: str, keep: Iterable = (), drop: Iterable = ()
) -> DataFrame:
    """Inclusion and exclusion by value; an exclusion also drops null keys."""
    keep, drop = list(keep), list(drop)
    out = df.where(F.col(column).isin(keep)) if keep else df
    return out.where(~F.col(column).isin(drop)) if drop else out


def filter_like(
    df: DataFrame, column: str, like: str | None = None, not_like: str | None = None,
    ilike: str | None = None, rlike: str | None = None,
) -> DataFrame:
    text = F.col(column).cast("string")
    tests: list[Column] = []
    if like is not None:
        tests.append(text.like(like))
    if not_like is not None:
        tests.append(~text.like(not_like))
    if ilike is not None:
        tests.append(text.ilike(ilike))
    if rlike is not None:
        tests.append(text.rlike(rlike))
    for test in tests:
        df = df.where(test)
    return df


def filter_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def map_values(df: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    return df.replace(dict(values), subset=[column])


def case_bucket(
    df: DataFrame, column: str, buckets: Mapping[str, Iterable], out: str,
    default: str | None = None,
) -> DataFrame:
    """Label per value list; other values keep their own text unless a default is given."""
    other = F.col(column).cast("string") if default is None else F.lit(default)
    return df.withColumn(out, bucket_label(F.col(column), buckets, other))


def dedup(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def consent_filter(df: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Households of customers that are active, reachable and their own golden record.

    Flags arrive as the texts "true" and "false".
    """
    willing = accounts.where(
        (F.col("customer_id") == F.col("golden_id"))
        & (F.col("customer_status") == "Active")
        & (F.col("opted_in") == "true")
        & (F.col("do_not_call") == "false")
    ).select("golden_id")
    households = customers.join(willing, "golden_id", "left_semi").select("household_id")
    return df.join(households, "household_id", "left_semi")


def account_age_filter(
    df: DataFrame, years: int = K.ACCOUNT_YEARS, days: str = "day_regis"
) -> DataFrame:
    """Accounts registered within ``years`` years of 360 days."""
    return df.where(F.col(days) <= years * K.DAYS_PER_YEAR)


def contact_status_norm(
    df: DataFrame, date_format: str, day: str = "First_Call_Date"
) -> DataFrame:
    """One spelling of the status, only settled statuses, call date parsed; no date, no row."""
    status = F.when(F.col("Contact_Status") == "CONTACT", "Contactable").otherwise(
        F.col("Contact_Status")
    )
    parsed = F.try_to_timestamp(F.col(day), F.lit(date_format)).cast("date")
    return (
        df.withColumn("Contact_Status", status)
        .where(F.col("Contact_Status").isin("Contactable", "Uncontactable"))
        .withColumn(day, parsed)
        .where(F.col(day).isNotNull())
    )


def sample_rows(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """Bernoulli sample for a trial run."""
    return df.sample(fraction=fraction, seed=seed)


def scan_txn_window(
    df: DataFrame,
    window: Window,
    where: Column | None = None,
    region: str = "store_region",
    unknown_region: str = "Unidentified",
) -> DataFrame:
    """Fact rows of the window under further scan predicates, region never null."""
    out = filter_between_dates(df, window, week="week_id" if "week_id" in df.columns else None)
    if where is not None:
        out = out.where(where)
    if region in df.columns:
        out = out.fillna(unknown_region, subset=[region])
    return out


def scan_sql_filtered(
    df: DataFrame, start: date, end: date, formats: Iterable[int], not_like: str
) -> DataFrame:
    """The same kind of scan written as SQL text with bound parameters."""
    return df.sparkSession.sql(
        """
        SELECT * FROM {txn}
        WHERE date_id BETWEEN :start AND :end
          AND array_contains(:formats, format_id)
          AND net_spend_amt > 0 AND unit > 0
          AND CAST(store_id AS STRING) NOT LIKE :not_like
        """,
        args={"start": start, "end": end, "formats": list(formats), "not_like": not_like},
        txn=df,
    )
