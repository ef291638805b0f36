"""Row flags of the transaction fact. None of them changes the number of rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.functions import columns as C
from basketlens.operators.joins import join_sized
from basketlens.sources.calendar import bounded, festive_days, last_weekend_days


def flag_time_of_day(df: DataFrame, ts: str = "tran_datetime") -> DataFrame:
    hour = F.hour(ts)
    return df.withColumns({"tran_hour": hour, "time_of_day": C.time_of_day(hour)})


def flag_week_of_month(df: DataFrame, day: str = "date_id") -> DataFrame:
    return df.withColumn("week_of_month", C.week_of_month(F.dayofmonth(day)))


def flag_weekend(df: DataFrame, day: str = "date_id") -> DataFrame:
    """Saturday, Sunday, and Friday from the evening on. Needs ``time_of_day``."""
    weekday = C.iso_weekday(F.col(day))
    late_friday = (weekday == 5) & F.col("time_of_day").isin("evening", "late")
    return df.withColumn("weekend_flag", C.yes_no(weekday.isin(6, 7) | late_friday))


def flag_festive(df: DataFrame, calendar: DataFrame) -> DataFrame:
    return df.join(bounded(festive_days(calendar)), "date_id", "left").fillna(
        "NONE", subset=["fest_flag"]
    )


def flag_last_weekend(df: DataFrame, calendar: DataFrame) -> DataFrame:
    marked = last_weekend_days(calendar).withColumn("last_weekend_flag", F.lit("Y"))
    return df.join(bounded(marked), "date_id", "left").fillna("N", subset=["last_weekend_flag"])


def flag_recency(df: DataFrame, end: date, day: str = "date_id") -> DataFrame:
    """``last_3/6/9_flag``: months counted back from ``end``, the month of ``end`` being 1.

    Months are fractional where ``end`` does not close a month.
    """
    back = C.months_back(F.lit(end), F.col(day))
    flags = {f"last_{n}_flag": C.yes_no(F.col("months_from_end_date") <= n) for n in (3, 6, 9)}
    return df.withColumns(
        {"end_month_date": F.last_day(day), "months_from_end_date": back}
    ).withColumns(flags)


def flag_quarter(df: DataFrame) -> DataFrame:
    """Exclusive quarters counted back from the window end; needs ``flag_recency``."""
    m = F.col("months_from_end_date")
    label = F.when(m <= 3, "Q1").when(m <= 6, "Q2").when(m <= 9, "Q3").when(m > 9, "Q4")
    out = df.withColumn("app_year_qtr", label.otherwise("NA"))
    return out.withColumns(
        {f"q{n}_flag": C.yes_no(F.col("app_year_qtr") == f"Q{n}") for n in (1, 2, 3, 4)}
    )


def price_levels(
    products: DataFrame,
    premium: str = "%PREMIUM%",
    not_premium: str = "%COUPON%",
    budget: str = "(?i)(budget|basic|value)",
    name: str = "subclass_name",
) -> DataFrame:
    """One tier per product, premium first where both patterns hit."""
    text = F.col(name)
    is_premium = text.ilike(premium) & ~text.ilike(not_premium)
    tier = F.when(is_premium, "PREMIUM").when(text.rlike(budget), "BUDGET")
    rank = F.min(F.when(tier == "PREMIUM", 1).when(tier == "BUDGET", 2)).alias("tier")
    return (
        products.groupBy("upc_id")
        .agg(rank)
        .where(F.col("tier").isNotNull())
        .select("upc_id", F.when(F.col("tier") == 1, "PREMIUM").otherwise("BUDGET").alias("price_level"))
    )


def flag_price_level(df: DataFrame, products: DataFrame, **patterns: str) -> DataFrame:
    """Adds ``price_level``; rows without a household are dropped."""
    rows = df.dropna(subset=["household_id"])
    levels = price_levels(products, **patterns)
    return join_sized(rows, levels, "upc_id", "left").fillna("NONE", subset=["price_level"])


def flag_single_tender(
    tenders: DataFrame, keys: Iterable[str], tender: str = "tender_type_group"
) -> DataFrame:
    """One row per basket: its tender where there is only one kind, else ``MULTI``.

    Smallest and largest kind decide, so that nothing has to be collected per basket. A basket
    with no known tender is ``MULTI`` as well.
    """
    kind = F.trim(tender)
    low, high = F.min(kind), F.max(kind)
    single = F.when(low == high, low).otherwise("MULTI")
    return tenders.groupBy(*keys).agg(single.alias("sngl_tndr_type"))


def keep_single_tender(
    tenders: DataFrame,
    basket: str,
    keys: Iterable[str],
    tender: str = "tender_type_group",
) -> DataFrame:
    """Only baskets with one kind of tender, under an id joined from ``keys``.

    ``keys`` start with ``basket`` and may split it further, as store and day do.
    """
    keys = list(keys)
    one = (
        tenders.groupBy(basket)
        .agg(F.min(tender).alias(tender), F.max(tender).alias("other"))
        .where(F.col(tender) == F.col("other"))
        .drop("other")
    )
    uid = F.concat_ws("_", *[F.col(k).cast("string") for k in keys])
    return (
        tenders.select(*keys).dropDuplicates().join(one, basket)
        .select(uid.alias("transaction_uid"), tender)
    )


def flag_payment(df: DataFrame, till: DataFrame, online: DataFrame) -> DataFrame:
    """Payment of a row from the single tender at the till and online.

    ``till`` is unique per (basket, store, date) and ``online`` per basket, as
    ``flag_single_tender`` yields them.
    """
    till = till.withColumnRenamed("sngl_tndr_type", "till_payment_method")
    online = online.withColumnRenamed("sngl_tndr_type", "online_payment_method")
    t, o = F.col("till_payment_method"), F.col("online_payment_method")
    flag = (
        F.when((t == "CASH") | (o == "CASH"), "CASH")
        .when((t == "CCARD") | (o == "CreditCard"), "CARD")
        .when(t == "COUPON", "COUPON")
        .when(t == "VOUCH", "VOUCHER")
        .otherwise("OTHER")
    )
    # online first: lines that were joined by basket need not move for it, and the last join's parts stay short
    keys, methods = ["transaction_uid", "store_id", "date_id"], ["till_payment_method", "online_payment_method"]
    joined = df.join(online, "transaction_uid", "left").join(till, keys, "left")
    return (
        joined.select(*[c for c in joined.columns if c not in methods], *methods)
        .fillna("Unidentified", subset=["till_payment_method"])
        .withColumn("payment_flag", flag)
    )


def tenure(customers: DataFrame, first_txn: DataFrame) -> DataFrame:
    """One row per household: latest card issue, else the first transaction."""
    return (
        customers.join(first_txn, "golden_id", "left")
        .withColumn("issued", F.coalesce("card_issue_date", "first_txn_date"))
        .groupBy("household_id")
        .agg(F.max("issued").alias("card_issue_date"), F.min("first_txn_date").alias("first_txn_date"))
    )


def flag_tenure(df: DataFrame, customers: DataFrame, first_txn: DataFrame, end: date) -> DataFrame:
    """``CC_TENURE`` in years at the window end, and whether history reaches back to the row."""
    years = F.round(F.datediff(F.lit(end), F.col("card_issue_date")) / 365, 1)
    history = F.when(F.col("first_txn_date") <= F.col("date_id"), 1).otherwise(0)
    return join_sized(df, tenure(customers, first_txn), "household_id", "left").withColumns(
        {"CC_TENURE": years, "one_year_history": history}
    )


def group_hierarchy_codes(
    df: DataFrame,
    departments: Mapping[str, Iterable[str]] = K.DEPARTMENT_MERGE,
    sections: Mapping[str, Iterable[str]] = K.SECTION_MERGE,
) -> DataFrame:
    dep, sec = F.col("department_code"), F.col("section_code")
    return df.withColumns(
        {
            "grouped_department_code": C.bucket_label(dep, departments, dep),
            "grouped_section_code": C.bucket_label(sec, sections, sec),
        }
    )


def dummy_household(
    products: DataFrame,
    department_exclude: Iterable[str] = K.DEPARTMENT_EXCLUDE,
    section_exclude: Iterable[str] = K.SECTION_EXCLUDE,
    department_added: Iterable[str] = K.DEPARTMENT_ADDED,
    section_added: Iterable[str] = K.SECTION_ADDED,
) -> DataFrame:
    """Rows of household -1 that carry every division, department and section code once."""
    spark = products.sparkSession
    dep, sec = F.col("department_code"), F.col("section_code")
    parts = [
        products.select("division_id").distinct(),
        products.where(~dep.isin(list(department_exclude))).select(dep).distinct(),
        products.where(~sec.isin(list(section_exclude))).select(sec).distinct(),
    ]
    added = [("department_code", department_added), ("section_code", section_added)]
    parts += [
        spark.createDataFrame([(v,) for v in values], f"{column} string")
        for column, values in added
        if values
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.withColumn("household_id", F.lit(K.DUMMY_HOUSEHOLD))


SECTION_ENDS = (12, 16, 20, 23)  # last hour of each of K.DAY_SECTIONS


def day_part_fine(df: DataFrame, ts: str = "tran_datetime") -> DataFrame:
    """Second day-part scale, day section, weekday name, week part and their combined label."""
    hour, weekend = F.hour(ts), F.weekday(ts) >= 5
    section = F.lit("NA")
    for label, last in reversed(list(zip(K.DAY_SECTIONS, SECTION_ENDS, strict=True))):
        section = F.when(hour <= last, label).otherwise(section)
    part = F.when(weekend, K.WEEK_PARTS[1]).when(~weekend, K.WEEK_PARTS[0]).otherwise("NA")
    return df.withColumns({
        "part_of_day": C.fine_day_part(hour),
        "name_of_day": F.date_format(ts, "EEE"),
        "day_section": section,
        "wk_end_wk_day": part,
    }).withColumn("wken_day", F.concat("wk_end_wk_day", "day_section"))


def unit_choice(
    df: DataFrame, counted: str = "count_qty", pieces: str = "product_qty",
    measured: str = "measured_qty",
) -> DataFrame:
    """Pieces where the article is counted, else the measured quantity."""
    return df.withColumn(
        "unit", F.when(F.col(counted).isNotNull(), F.col(pieces)).otherwise(F.col(measured))
    )
