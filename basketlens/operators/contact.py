"""KPIs of the days before a household's first contact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.operators.kpi import (
    ALL, BASKET, HOUSEHOLD, TOTAL, kpi_long, pivot_long,
)

LAST = "360_days"


def agg_kpi_named(
    name: str | None, recency: str | None,
    flags: Sequence[str] = ("net_spend_amt", "unit", "transaction_uid"),
) -> list[Column]:
    """Aggregates called ``<name>_sales_<recency>`` and so on, for ``groupBy().agg(*…)``."""
    head = f"{name}_" if name else ""
    tail = f"_{recency}" if recency else ""
    known = {
        "net_spend_amt": F.sum("net_spend_amt").cast("double").alias(f"{head}sales{tail}"),
        "unit": F.sum("unit").alias(f"{head}units{tail}"),
        "transaction_uid": F.count_distinct("transaction_uid").alias(f"{head}visits{tail}"),
    }
    return [known[f] for f in known if f in flags]


def agg_all_kpi_360(txn: DataFrame) -> DataFrame:
    return txn.groupBy(HOUSEHOLD).agg(*agg_kpi_named("total", LAST))


def _cell(group: str, value: str, measure: str) -> Column:
    return F.coalesce(F.col(f"`{group}={value}_{measure}`"), F.lit(0))


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def agg_tender_share_360(
    txn: DataFrame, tenders: Sequence[str] = K.TILL_TENDERS
) -> DataFrame:
    """Totals, sales and visits per tender, and the cash and card shares."""
    long = kpi_long(txn, {"TENDER": F.col("tender_type_group")})
    keys = [f"{TOTAL}={ALL}", *[f"TENDER={t}" for t in tenders]]
    wide = pivot_long(long, keys, ("spend", "visits", "units"))
    sales, visits = _cell(TOTAL, ALL, "spend"), _cell(TOTAL, ALL, "visits")
    columns = [
        sales.alias(f"total_sales_{LAST}"),
        _cell(TOTAL, ALL, "units").alias(f"total_units_{LAST}"),
        visits.alias(f"total_visits_{LAST}"),
    ]
    for t in tenders:
        columns += [
            _cell("TENDER", t, "spend").alias(f"{t.lower()}_sales_{LAST}"),
            _cell("TENDER", t, "visits").alias(f"{t.lower()}_visits_{LAST}"),
        ]
    for tender, word in (("CASH", "cash"), ("CCARD", "card")):
        columns += [
            _share(_cell("TENDER", tender, "visits"), visits).alias(
                f"prop_visit_by_{word}_{LAST}"
            ),
            _share(_cell("TENDER", tender, "spend"), sales).alias(f"prop_sales_by_{word}_{LAST}"),
        ]
    return wide.select(HOUSEHOLD, *columns)


CHANNEL_FORMATS = (
    ("all", "all"), ("online", "all"), ("offline", "all"), ("offline", "hde"),
    ("offline", "gofresh"),
)
FORMAT_VALUES = {"hde": "HDE", "gofresh": "GoFresh"}


def _in_channel(channel: str, fmt: str) -> Column:
    """Online covers all formats, whatever format is asked for."""
    out = F.lit(True)
    if channel != "all":
        out = F.col("channel") == channel.upper()
    if channel == "offline" and fmt != "all":
        out = out & (F.col("store_format") == FORMAT_VALUES[fmt])
    return out


def agg_format_channel_kpi(
    txn: DataFrame,
    days: Sequence[int] = (360, 180, 90, 30),
    combos: Sequence[tuple[str, str]] = CHANNEL_FORMATS,
) -> DataFrame:
    """Sales, units and visits per channel, format and recency, in one pass.

    ``txn`` carries ``first_contact_date`` and the ``rN_start_date`` columns of its household. Every
    household of the widest recency has a row; combinations it did not buy in are 0.
    """
    day, contact = F.col("date_id"), F.col("first_contact_date")
    slices = {f"{n}_days": day.between(F.col(f"r{n}_start_date"), contact) for n in days}
    groups = {f"{c}_{f}": F.when(_in_channel(c, f), F.lit(ALL)) for c, f in combos}
    widest = f"r{max(days)}_start_date"
    # the total keeps households that bought in none of the combinations
    long = kpi_long(txn.where(day.between(F.col(widest), contact)), groups, slices)
    words = {"spend": "sales", "units": "units", "visits": "visits"}
    measures = [f"{m}_{tag}" for tag in slices for m in words]
    wide = pivot_long(long, [f"{TOTAL}={ALL}", *[f"{g}={ALL}" for g in groups]], measures)
    return wide.select(
        HOUSEHOLD,
        *[
            _cell(g, ALL, f"{m}_{tag}").alias(f"{g}_{word}_{tag}")
            for g in groups
            for tag in slices
            for m, word in words.items()
        ],
    )


def agg_cash_card_segment(
    txn: DataFrame, threshold: float = K.CARD_SHARE, large: str = "HDE"
) -> DataFrame:
    """``credit`` where cards make up ``threshold`` of a household's visits to large stores.

    Visits count where they were paid by cash or card. A household without such visits is
    ``cash``; every household of the fact is in the result.
    """
    tender, in_large = F.col("tender_type_group"), F.col("store_format") == large
    per_basket = txn.groupBy(HOUSEHOLD, BASKET).agg(
        F.max(in_large & (tender == "CASH")).alias("cash"),
        F.max(in_large & (tender == "CCARD")).alias("card"),
    )
    cash, card = F.count_if("cash"), F.count_if("card")
    return per_basket.groupBy(HOUSEHOLD).agg(
        F.when(F.try_divide(card, cash + card) >= threshold, "credit")
        .otherwise("cash")
        .alias("cash_card_customer_flag")
    )


def agg_promo_online_monthly(txn: DataFrame, period: str = "period_id") -> DataFrame:
    """Discount share, online sales, and sales per active period."""
    online = F.when(F.col("channel") == "ONLINE", F.col("net_spend_amt"))
    per_period = txn.groupBy(HOUSEHOLD, period).agg(
        F.sum("net_spend_amt").alias("sales"),
        F.sum("discount_amt").alias("discount"),
        F.sum(online).alias("online"),
    )
    sums = per_period.groupBy(HOUSEHOLD).agg(
        F.sum("sales").cast("double").alias("sales"),
        F.sum("discount").cast("double").alias("discount"),
        F.coalesce(F.sum("online").cast("double"), F.lit(0.0)).alias("sales_online"),
        F.count(period).alias("periods"),
    )
    return sums.select(
        HOUSEHOLD,
        F.try_divide("discount", "sales").alias("prop_promo_sales"),
        "sales_online",
        F.try_divide(F.col("sales"), F.col("periods").cast("double")).alias("avg_monthly_sales"),
        F.when(F.col("sales_online") > 0, "Y").otherwise("N").alias("ever_online"),
    )


def _share_columns(group: str, values: Sequence[str]) -> list[Column]:
    sales, visits = _cell(TOTAL, ALL, "spend"), _cell(TOTAL, ALL, "visits")
    out = []
    for v in values:
        s, n = _cell(group, v, "spend"), _cell(group, v, "visits")
        out += [
            s.alias(f"{v}_sales_{LAST}"),
            n.alias(f"{v}_visits_{LAST}"),
            F.coalesce(_share(n, visits), F.lit(0.0)).alias(f"{v}_prop_visits_{LAST}"),
            F.coalesce(_share(s, sales), F.lit(0.0)).alias(f"{v}_prop_sales_{LAST}"),
        ]
    return out


def agg_share_pivot(txn: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Sales, visits and their shares (fractions) per value of any column."""
    long = kpi_long(txn, {"S": F.col(column)})
    wide = pivot_long(long, [f"{TOTAL}={ALL}", *[f"S={v}" for v in values]], ("spend", "visits"))
    return wide.select(HOUSEHOLD, *_share_columns("S", values))


def agg_group_share(txn: DataFrame, column: str, groups: Sequence[str]) -> DataFrame:
    """Fractions of sales, units and visits per product group: ``<group>_prop_sales`` and so on."""
    long = kpi_long(txn, {"G": F.col(column)})
    wide = pivot_long(long, [f"{TOTAL}={ALL}", *[f"G={g}" for g in groups]], ("spend", "units", "visits"))
    words = {"spend": "sales", "units": "units", "visits": "visits"}
    return wide.select(HOUSEHOLD, *[
        F.coalesce(_share(_cell("G", g, m), _cell(TOTAL, ALL, m)), F.lit(0.0)).alias(f"{g}_prop_{word}")
        for g in groups for m, word in words.items()
    ])


def pick_favourite_slot(long: DataFrame, group: str, out: str = "shopping_time") -> DataFrame:
    """Value with most visits, then most sales, then the first by name."""
    best = F.max_by("kpi_value", F.struct("visits", "spend"))
    rows = long.where(F.col("kpi_group") == group)
    # Equal visits and sales: the smallest name wins, so ties are cut down to one name first.
    slots = rows.groupBy(HOUSEHOLD, "visits", "spend").agg(F.min("kpi_value").alias("kpi_value"))
    return slots.groupBy(HOUSEHOLD).agg(best.alias(out))


SLOT_VALUES = tuple(f"{w}{s}" for w in K.WEEK_PARTS for s in K.DAY_SECTIONS)
SHOPPING_TIME = {
    "part_of_day": K.FINE_DAY_PARTS,
    "day_section": K.DAY_SECTIONS,
    "wk_end_wk_day": K.WEEK_PARTS,
    "wken_day": SLOT_VALUES,
}


def agg_shopping_time(txn: DataFrame) -> DataFrame:
    """Shares by four time scales and the favourite slot; needs ``day_part_fine``."""
    long = kpi_long(txn, {c: F.col(c) for c in SHOPPING_TIME})
    keys = [f"{TOTAL}={ALL}", *[f"{c}={v}" for c, vs in SHOPPING_TIME.items() for v in vs]]
    wide = pivot_long(long, keys, ("spend", "visits")).select(
        HOUSEHOLD,
        _cell(TOTAL, ALL, "visits").alias(f"total_visits_{LAST}"),
        _cell(TOTAL, ALL, "spend").alias(f"total_sales_{LAST}"),
        *[c for column, vs in SHOPPING_TIME.items() for c in _share_columns(column, vs)],
    )
    return wide.join(pick_favourite_slot(long, "wken_day"), HOUSEHOLD, "left")


def agg_funnel(feedback: DataFrame, by: str = "insurer_nm") -> DataFrame:
    """Leads, contactable leads and sales with their rates."""
    contact = F.count_if(F.col("Contact_Status") == "Contactable")
    bought = F.count_if(F.col("Bought_Status") == "Bought")
    counts = feedback.groupBy(by).agg(
        F.count(F.lit(1)).alias("leads"), contact.alias("contactable"), bought.alias("bought")
    )
    return counts.withColumns(
        {
            "contact_rate": _share(F.col("contactable"), F.col("leads")),
            "bought_rate": _share(F.col("bought"), F.col("contactable")),
        }
    )
