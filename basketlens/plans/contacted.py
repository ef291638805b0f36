"""Contacted households: from call feedback to one row of features for each.

``ground_truth`` goes from raw feedback to the households that count, with their dates and segments;
``contact_features`` sums up what they bought in the 360 days before the contact, a table for each theme,
and joins the tables. Both results are what a run writes; the fact of the contacted households is written
once and read by every theme.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from basketlens import config as K
from basketlens.operators import contact as N
from basketlens.operators.assemble import assemble_contacted
from basketlens.operators.filters import account_age_filter, consent_filter, contact_status_norm
from basketlens.operators.flags import day_part_fine
from basketlens.operators.identity import join_ident_resolve, win_latest_call
from basketlens.operators.joins import join_anti_exclude, join_household_window, union_missing_cols
from basketlens.operators.kpi import HOUSEHOLD
from basketlens.operators.segments import join_segments
from basketlens.operators.timeline import household_timeline
from basketlens.sources.writers import staged


@dataclass(frozen=True)
class People:
    """Source tables of the ground truth: feedback of each insurer with its date format, crosswalk of
    customer numbers, households on file, card dates, consent, traders by quarter, calendar, and the tables
    of ``segments.SEGMENTS`` in that order."""

    feedback: Sequence[tuple[DataFrame, str]]
    numbers: DataFrame
    customers: DataFrame
    cards: DataFrame
    accounts: DataFrame
    traders: DataFrame
    calendar: DataFrame
    segments: Sequence[DataFrame]


def ground_truth(people: People, end: date, years: int = K.ACCOUNT_YEARS) -> DataFrame:
    """One row per household with a settled call: status of the latest call, dates around it, segments.

    Households without consent, with accounts older than ``years`` at ``end``, and traders of the quarter of
    the contact are left out.
    """
    calls = union_missing_cols([contact_status_norm(df, form) for df, form in people.feedback])
    latest = win_latest_call(join_ident_resolve(calls, people.numbers, people.customers))
    dated = household_timeline(latest, people.cards, people.calendar, end)
    willing = consent_filter(dated, people.accounts, people.customers)
    kept = join_anti_exclude(account_age_filter(willing, years), people.traders, [HOUSEHOLD, "quarter_id"])
    return join_segments(kept, *people.segments)


# Channels and formats of the contacted table.
CHANNELS = (("online", "all"), ("offline", "hde"), ("offline", "gofresh"))


def contacted_columns(
    groups: Sequence[str] = K.PRODUCT_GROUPS, missions: Sequence[str] = K.MISSIONS,
    days: Sequence[int] = (360, 180, 90, 30),
) -> dict[str, list[str]]:
    """What each table contributes, besides the household."""
    shares = lambda values: [f"{v}_prop_{m}_{N.LAST}" for v in values for m in ("visits", "sales")]
    columns = {
        "cust_details": [
            "Bought_Status", "Contact_Status", "card_aging_day", "truprice_seg_desc", "facts_seg_desc",
            "lifestage_seg_name", "lifecycle_name"],
        "cust_tender_kpi": [f"prop_{m}_by_{t}_{N.LAST}" for m in ("visit", "sales") for t in ("cash", "card")],
        "cust_promo_online_monthly": ["prop_promo_sales"],
        "cust_shp_time": shares((*sorted(K.FINE_DAY_PARTS), *K.WEEK_PARTS)),
        "cust_all_mt_kpi": [f"total_{m}_{N.LAST}" for m in ("sales", "units", "visits")],
        "cust_prd_gr_kpi": [f"{g}_prop_{m}" for g in groups for m in ("sales", "units", "visits")],
        "cust_shp_ms": shares(missions),
        "cust_each_fmt_kpi": [
            f"{c}_{f}_{m}_{n}_days" for c, f in CHANNELS for n in days for m in ("sales", "units", "visits")],
    }
    return {table: [HOUSEHOLD, *names] for table, names in columns.items()}


def contact_tables(near: DataFrame, groups: Sequence[str], missions: Sequence[str]) -> dict[str, DataFrame]:
    """The feature tables of ``contacted_columns`` by name."""
    return {
        "cust_tender_kpi": N.agg_tender_share_360(near),
        "cust_promo_online_monthly": N.agg_promo_online_monthly(near),
        "cust_shp_time": N.agg_shopping_time(day_part_fine(near)),
        "cust_all_mt_kpi": N.agg_all_kpi_360(near),
        "cust_prd_gr_kpi": N.agg_group_share(near, "product_group", groups),
        "cust_shp_ms": N.agg_share_pivot(near, "mission", missions),
        "cust_each_fmt_kpi": N.agg_format_channel_kpi(near, combos=CHANNELS),
    }


def contact_features(
    details: DataFrame, fact: DataFrame, groups: Sequence[str] = K.PRODUCT_GROUPS,
    missions: Sequence[str] = K.MISSIONS, columns: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All features of the contacted households of ``details`` (``ground_truth``, written).

    ``fact`` has the item lines with tender, channel, format, time, period, ``product_group`` and ``mission``;
    what is outside ``groups`` and ``missions`` counts in the totals alone.
    """
    windows = details.select(HOUSEHOLD, "first_contact_date", *[f"r{n}_start_date" for n in K.RECENCY_DAYS])
    near = staged(join_household_window(fact, windows, "r360_start_date", "first_contact_date"), "contacted")
    return assemble_contacted(
        details, N.agg_cash_card_segment(near), contact_tables(near, groups, missions),
        columns or contacted_columns(groups, missions))
