"""Filter, join, window and set queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.functions.columns import iso_week_id, quarter_id
from basketlens.functions.sizing import broadcast_if_small
from basketlens.operators import filters as L
from basketlens.operators import flags as G
from basketlens.operators import joins as J
from basketlens.operators import promo as P
from basketlens.operators import segments as E
from basketlens.operators import timeline as T
from basketlens.operators import windows as W
from basketlens.operators.identity import join_ident_resolve, win_latest_call
from basketlens.queries import sqlparts as Q
from basketlens.queries.flagging import YEAR_END, YEAR_START
from basketlens.queries.registry import query
from basketlens.sources import roles as R
from basketlens.sources.calendar import neighbour_weeks

SCAN_WEEKS = (200040, 200130)  # inside the year, so that the week range decides at both ends
LINE = ("transaction_uid", "upc_id", "store_id", "net_spend_amt", "unit")
LINE_SQL = "transaction_uid, upc_id, store_id, net_spend_amt, unit"

# --- filters ------------------------------------------------------------------------------


@query("filter_between_dates", Q.with_(
    f"SELECT * FROM (SELECT *, {Q.week_id('date_id')} AS week_id FROM baskets) WHERE date_id BETWEEN DATE "
    "'2000-09-01' AND DATE '2001-08-31' AND week_id BETWEEN 200040 AND 200130", "baskets"))
def filter_between_dates(spark, sf):
    weekly = R.baskets(spark, sf).withColumn("week_id", iso_week_id(F.col("date_id")))
    return L.filter_between_dates(weekly, replace(R.YEAR, weeks=SCAN_WEEKS))


@query("filter_in_list", Q.with_(
    "SELECT * FROM promos WHERE promo_offer_id IN (1, 2, 3, 4) AND state_desc NOT IN ('Cancelled')",
    "promos"))
def filter_in_list(spark, sf):
    kept = L.filter_in_list(R.promotions(spark, sf), "promo_offer_id", keep=(1, 2, 3, 4))
    return L.filter_in_list(kept, "state_desc", drop=("Cancelled",))


@query("filter_like", Q.with_(
    "SELECT * FROM products WHERE subclass_name ILIKE '%O%' AND CAST(upc_id AS VARCHAR) NOT LIKE '8%' "
    "AND regexp_matches(subclass_name, '(?i)(HOT|cold|old)')", "products"))
def filter_like(spark, sf):
    hit = L.filter_like(
        R.products(spark, sf), "subclass_name", ilike="%O%", rlike="(?i)(HOT|cold|old)"
    )
    return L.filter_like(hit, "upc_id", not_like="8%")


@query("filter_not_null", Q.with_(
    "SELECT * FROM feedback WHERE dib_cust_code IS NOT NULL AND Reason_code IS NOT NULL", "feedback"))
def filter_not_null(spark, sf):
    return L.filter_not_null(R.feedback(spark, sf), "dib_cust_code", "Reason_code")


@query("fill_defaults", Q.with_(
    "SELECT * REPLACE (coalesce(state_desc, 'NA') AS state_desc, coalesce(change_type, 'NONE') AS "
    "change_type, coalesce(store_id, 0) AS store_id) FROM promos", "promos"))
def fill_defaults(spark, sf):
    return L.fill_defaults(
        R.promotions(spark, sf), {"state_desc": "NA", "change_type": "NONE", "store_id": 0}
    )


@query("map_values", Q.with_(
    "SELECT * REPLACE (CASE store_format WHEN 'HDE' THEN 'Hypermarket' WHEN 'Talad' THEN 'Supermarket' "
    "WHEN 'GoFresh' THEN 'MiniSupermarket' END AS store_format) FROM stores", "stores"))
def map_values(spark, sf):
    return L.map_values(R.stores(spark, sf), "store_format", K.FORMAT_RENAME)


@query("case_bucket", Q.with_(
    "SELECT *, CASE WHEN format_id IN (1, 2, 3) THEN 'Hypermarket' WHEN format_id = 4 THEN 'Supermarket' "
    "WHEN format_id = 5 THEN 'Mini Supermarket' ELSE CAST(format_id AS VARCHAR) END AS format_name "
    "FROM stores", "stores"))
def case_bucket(spark, sf):
    buckets = {"Hypermarket": (1, 2, 3), "Supermarket": (4,), "Mini Supermarket": (5,)}
    return L.case_bucket(R.stores(spark, sf), "format_id", buckets, "format_name")


@query("dedup", Q.with_("SELECT DISTINCT household_id, channel, tender_type_group FROM baskets", "baskets"))
def dedup(spark, sf):
    return L.dedup(R.baskets(spark, sf).select("household_id", "channel", "tender_type_group"))


@query("consent_filter", Q.with_(
    "SELECT household_id, first_contact_date FROM contacts WHERE household_id IN (SELECT household_id "
    "FROM known WHERE golden_id IN (SELECT golden_id FROM accounts WHERE customer_id = golden_id AND "
    "customer_status = 'Active' AND opted_in = 'true' AND do_not_call = 'false'))",
    "contacts", "known", "accounts"))
def consent_filter(spark, sf):
    return L.consent_filter(
        R.contacts(spark, sf), R.accounts(spark, sf), R.known_customers(spark, sf)
    )


@query("account_age_filter", Q.with_(
    "SELECT household_id, day_regis FROM (SELECT household_id, date_diff('day', max(card_issue_date), "
    f"{Q.END}) AS day_regis FROM customers GROUP BY 1) WHERE day_regis <= 6 * 360", "customers"))
def account_age_filter(spark, sf):
    dated = T.days_since_registration(
        T.agg_household_card_date(R.customers(spark, sf)), R.HISTORY.end
    )
    return L.account_age_filter(dated, years=6).select("household_id", "day_regis")


CALL = ("CASE WHEN insurer_nm = 'AAC' THEN try_strptime(First_Call_Date, '%m/%d/%Y') "
        "ELSE try_strptime(First_Call_Date, '%Y-%m-%d') END")
SETTLED = f"""SELECT feedback_id, dib_cust_code, Bought_Status, CASE WHEN Contact_Status = 'CONTACT'
  THEN 'Contactable' ELSE Contact_Status END AS Contact_Status, Reason_code,
  CAST({CALL} AS DATE) AS First_Call_Date, insurer_nm, src_file FROM feedback
  WHERE Contact_Status IN ('CONTACT', 'Contactable', 'Uncontactable') AND {CALL} IS NOT NULL"""


def settled_feedback(spark, sf) -> DataFrame:
    """Feedback of all insurers, each parsed with its own date format."""
    raw = R.feedback(spark, sf)
    return J.union_missing_cols([
        L.contact_status_norm(raw.where(F.col("insurer_nm") == s.insurer_nm), s.date_format)
        for s in K.FEEDBACK_SOURCES.values()
    ])


@query("contact_status_norm", Q.with_(SETTLED, "feedback"))
def contact_status_norm(spark, sf):
    return settled_feedback(spark, sf)


# --- joins --------------------------------------------------------------------------------


@query("join_inner_dim", Q.with_(
    "SELECT * FROM baskets JOIN cal USING (date_id)", "baskets", "cal"))
def join_inner_dim(spark, sf):
    return J.join_inner_dim(R.baskets(spark, sf), R.calendar(spark))


@query("join_left_lookup", Q.with_(
    f"SELECT {LINE_SQL}, coalesce(lv, 'NONE') AS price_level FROM items LEFT JOIN (SELECT upc_id AS u, "
    "'PREMIUM' AS lv FROM products WHERE subclass_name ILIKE '%HOT%') ON u = upc_id", "items", "products"))
def join_left_lookup(spark, sf):
    lookup = R.products(spark, sf).where(F.col("subclass_name").ilike("%HOT%")).select(
        "upc_id", F.lit("PREMIUM").alias("price_level")
    )
    return J.join_left_lookup(
        R.items(spark, sf), lookup, "upc_id", {"price_level": "NONE"}
    ).select(*LINE, "price_level")


@query("join_multi_key", Q.with_(
    "SELECT transaction_uid, upc_id, store_id, date_id, tillone.sngl_tndr_type AS till, "
    "online.tender_type_group AS online FROM items JOIN baskets USING (transaction_uid) "
    "LEFT JOIN tillone USING (transaction_uid, store_id, date_id) LEFT JOIN online USING (transaction_uid)",
    "items", "baskets", "tillone", "online"))
def join_multi_key(spark, sf):
    keys = ["transaction_uid", "store_id", "date_id"]
    till = G.flag_single_tender(R.till_tenders(spark, sf), keys)
    online = R.online_tenders(spark, sf).withColumnRenamed("tender_type_group", "online")
    return J.join_multi_key(
        R.sales(spark, sf), till.withColumnRenamed("sngl_tndr_type", "till"), keys,
        online, "transaction_uid",
    ).select("transaction_uid", "upc_id", "store_id", "date_id", "till", "online")


@query("join_semi_exists", Q.with_(
    f"SELECT {LINE_SQL} FROM items WHERE EXISTS (SELECT 1 FROM promoranges r WHERE r.upc_id = items.upc_id "
    "AND r.store_id = items.store_id)", "items", "promoranges"))
def join_semi_exists(spark, sf):
    zones = R.promo_zones(spark, sf)
    members, class_zones, class_stores = P.class_tables(zones, R.stores(spark, sf))
    ranges = P.promo_store_ranges(R.promotions(spark, sf), class_zones, class_stores)
    keys = ranges.select("upc_id", F.col("store_id").alias("store_class")).distinct()
    lines = R.items(spark, sf).select(*LINE).join(broadcast_if_small(members, zones), "store_id")
    return J.join_semi_exists(lines, keys, ["upc_id", "store_class"]).select(*LINE)


@query("join_anti_exclude", Q.with_(
    f"SELECT transaction_uid, b.household_id, date_id FROM baskets b LEFT JOIN traders t ON t.household_id "
    f"= b.household_id AND t.quarter_id = {Q.quarter_id('date_id')} WHERE t.household_id IS NULL",
    "baskets", "traders"))
def join_anti_exclude(spark, sf):
    dated = R.baskets(spark, sf).withColumn("quarter_id", quarter_id(F.col("date_id")))
    return J.join_anti_exclude(
        dated, R.trader_snapshots(spark, sf), ["household_id", "quarter_id"]
    ).select("transaction_uid", "household_id", "date_id")


@query("join_range_promo_dates", Q.with_(
    "SELECT promo_id, upc_id, date_id FROM promos JOIN cal ON promo_start_date <= date_id AND "
    "promo_end_date >= date_id", "promos", "cal"))
def join_range_promo_dates(spark, sf):
    return P.promo_days(R.promotions(spark, sf), R.HISTORY).select("promo_id", "upc_id", "date_id")


@query("join_household_window", Q.with_(
    f"SELECT {LINE_SQL}, date_id FROM items JOIN baskets USING (transaction_uid) JOIN contacts USING "
    "(household_id) WHERE date_id BETWEEN first_contact_date - 180 AND first_contact_date",
    "items", "baskets", "contacts"))
def join_household_window(spark, sf):
    windows = T.recency_start_dates(R.contacts(spark, sf), (180,))
    return J.join_household_window(
        R.sales(spark, sf), windows, "r180_start_date", "first_contact_date"
    ).select(*LINE, "date_id")


WEEK_BASKETS = (f"SELECT {Q.week_id('date_id')} AS week_id, count(*) AS baskets FROM baskets GROUP BY 1")


def _week_baskets(spark, sf) -> DataFrame:
    dated = J.join_inner_dim(R.baskets(spark, sf), R.calendar(spark))
    return dated.groupBy("week_id").agg(F.count(F.lit(1)).alias("baskets"))


@query("join_self_offset", Q.with_(
    "SELECT week_id, next_week_id, baskets FROM w JOIN nextweek USING (week_id)",
    "baskets", "nextweek", w=WEEK_BASKETS))
def join_self_offset(spark, sf):
    following = J.join_self_offset(R.calendar(spark))
    return _week_baskets(spark, sf).join(F.broadcast(following), "week_id").select(
        "week_id", "next_week_id", "baskets"
    )


@query("win_lag_lead_week", Q.with_(
    "SELECT week_id, lag_week_id, lead_week_id, baskets FROM w JOIN weeks USING (week_id)",
    "baskets", "weeks", w=WEEK_BASKETS))
def win_lag_lead_week(spark, sf):
    near = neighbour_weeks(R.calendar(spark))
    return _week_baskets(spark, sf).join(F.broadcast(near), "week_id").select(
        "week_id", "lag_week_id", "lead_week_id", "baskets"
    )


def _channel_table(spark, sf, channel: str, name: str) -> DataFrame:
    return (
        R.baskets(spark, sf).where(F.col("channel") == channel).groupBy("household_id")
        .agg(F.count(F.lit(1)).alias(name))
    )


@query("join_outer_fold", Q.with_(
    "SELECT household_id, online_n, offline_n, card_n FROM (SELECT household_id, count(*) AS online_n "
    "FROM baskets WHERE channel = 'ONLINE' GROUP BY 1) FULL JOIN (SELECT household_id, count(*) AS "
    "offline_n FROM baskets WHERE channel = 'OFFLINE' GROUP BY 1) USING (household_id) FULL JOIN "
    "(SELECT household_id, count(*) AS card_n FROM baskets WHERE tender_type_group = 'CCARD' GROUP BY 1) "
    "USING (household_id)", "baskets"))
def join_outer_fold(spark, sf):
    cards = (
        R.baskets(spark, sf).where(F.col("tender_type_group") == "CCARD").groupBy("household_id")
        .agg(F.count(F.lit(1)).alias("card_n"))
    )
    return J.join_outer_fold([
        _channel_table(spark, sf, "ONLINE", "online_n"),
        _channel_table(spark, sf, "OFFLINE", "offline_n"),
        cards,
    ])


@query("join_left_chain", Q.with_(
    "SELECT household_id, first_contact_date, online_n, offline_n FROM contacts LEFT JOIN (SELECT "
    "household_id, count(*) AS online_n FROM baskets WHERE channel = 'ONLINE' GROUP BY 1) USING "
    "(household_id) LEFT JOIN (SELECT household_id, count(*) AS offline_n FROM baskets WHERE channel = "
    "'OFFLINE' GROUP BY 1) USING (household_id)", "contacts", "baskets"))
def join_left_chain(spark, sf):
    return J.join_left_chain(R.contacts(spark, sf), [
        _channel_table(spark, sf, "ONLINE", "online_n"),
        _channel_table(spark, sf, "OFFLINE", "offline_n"),
    ])


@query("join_snapshot_latest", Q.with_(
    "SELECT transaction_uid, household_id, date_id FROM baskets WHERE household_id NOT IN (SELECT "
    "household_id FROM traders WHERE quarter_id = (SELECT least(max(quarter_id), 200103) FROM traders))",
    "baskets", "traders"))
def join_snapshot_latest(spark, sf):
    return J.join_snapshot_latest(
        R.baskets(spark, sf), R.trader_snapshots(spark, sf), "quarter_id", 200103
    ).select("transaction_uid", "household_id", "date_id")


RESOLVED = """SELECT DISTINCT f.* EXCLUDE (dib_cust_code), f.dib_cust_code AS ngc_customer_id,
  coalesce(d.household_id, c.household_id) AS household_id, coalesce(d.golden_id, m.golden_id) AS golden_id
  FROM {source} f LEFT JOIN numbers m ON m.ngc_customer_id = f.dib_cust_code
  LEFT JOIN known c ON c.golden_id = m.golden_id
  LEFT JOIN known d ON CAST(d.household_id AS VARCHAR) = f.dib_cust_code"""


def resolved_feedback(spark, sf) -> DataFrame:
    return join_ident_resolve(
        settled_feedback(spark, sf), R.customer_numbers(spark, sf), R.known_customers(spark, sf)
    )


@query("join_ident_resolve", Q.with_(
    "SELECT * FROM res", "feedback", "numbers", "known", s=SETTLED, res=RESOLVED.format(source="s")))
def join_ident_resolve_q(spark, sf):
    return resolved_feedback(spark, sf)


LATEST = ("SELECT household_id, Bought_Status, Contact_Status, Reason_code, First_Call_Date AS "
          "first_contact_date FROM res WHERE household_id IS NOT NULL QUALIFY row_number() OVER "
          "(PARTITION BY household_id ORDER BY First_Call_Date DESC NULLS LAST, feedback_id) = 1")


@query("win_latest_call", Q.with_(
    LATEST, "feedback", "numbers", "known", s=SETTLED, res=RESOLVED.format(source="s")))
def win_latest_call_q(spark, sf):
    return win_latest_call(resolved_feedback(spark, sf))


@query("join_segments", Q.with_(
    "SELECT household_id, first_contact_date, coalesce(truprice_seg_desc, 'Unclassified') AS "
    "truprice_seg_desc, coalesce(facts_seg_desc, 'Unclassified') AS facts_seg_desc, "
    "coalesce(lifestage_seg_name, 'Unclassified') AS lifestage_seg_name, coalesce(lifecycle_name, "
    "'Unclassified') AS lifecycle_name, coalesce(pref_store_id, 'NA') AS pref_store_id, CASE WHEN "
    "coalesce(pref_store_format, 'NA') = 'missing' THEN 'NA' ELSE coalesce(pref_store_format, 'NA') END AS "
    "pref_store_format, coalesce(pref_store_region, 'NA') AS pref_store_region, CASE "
    "coalesce(pref_store_region, 'NA') WHEN 'BKK' THEN 'BKK' WHEN 'NA' THEN 'NA' ELSE 'UPC' END AS "
    "perf_store_area FROM timeline LEFT JOIN priceseg USING (household_id, period_id) LEFT JOIN factseg "
    "USING (household_id, week_id) LEFT JOIN stages USING (household_id, quarter_id) LEFT JOIN prefstore "
    "USING (household_id, period_id) LEFT JOIN cycle USING (household_id, week_id)",
    "timeline", "priceseg", "factseg", "stages", "prefstore", "cycle"))
def join_segments(spark, sf):
    return segmented(spark, sf).select(
        "household_id", "first_contact_date", "truprice_seg_desc", "facts_seg_desc",
        "lifestage_seg_name", "lifecycle_name", "pref_store_id", "pref_store_format",
        "pref_store_region", "perf_store_area",
    )


def timeline(spark, sf) -> DataFrame:
    return T.household_timeline(
        R.contacts(spark, sf), R.customers(spark, sf), R.calendar(spark), R.HISTORY.end
    )


def segmented(spark, sf) -> DataFrame:
    cycles = E.lifecycle_shift(
        R.lifecycle_history(spark, sf), R.lifecycle_names(spark), R.calendar(spark)
    )
    return E.join_segments(
        timeline(spark, sf), R.price_segments(spark, sf), R.fact_segments(spark, sf),
        R.life_stages(spark, sf), R.preferred_stores(spark, sf), cycles,
    )


@query("txn_base", Q.with_(
    f"SELECT {LINE_SQL}, household_id, date_id, division_id, week_id, golden_id FROM items JOIN baskets "
    "USING (transaction_uid) JOIN products USING (upc_id) JOIN cal USING (date_id) LEFT JOIN known USING "
    f"(household_id) WHERE date_id BETWEEN {YEAR_START} AND {YEAR_END} AND division_id IN ('PROMO', "
    "'SMALL', 'LARGE') AND household_id NOT IN (SELECT household_id FROM traders WHERE quarter_id = "
    "(SELECT least(max(quarter_id), 200103) FROM traders))",
    "items", "baskets", "products", "cal", "known", "traders"))
def txn_base(spark, sf):
    traders = J.latest_snapshot(R.trader_snapshots(spark, sf), "quarter_id", 200103)
    return J.txn_base(
        R.sales(spark, sf), R.products(spark, sf), R.calendar(spark), R.known_customers(spark, sf),
        traders, ("PROMO", "SMALL", "LARGE"), R.YEAR,
    ).select(*LINE, "household_id", "date_id", "division_id", "week_id", "golden_id")


@query("product_hierarchy_map", Q.with_(
    "SELECT DISTINCT division_id, department_code, section_code, class_code, subclass_name FROM products",
    "products"))
def product_hierarchy_map(spark, sf):
    return J.product_hierarchy_map(
        R.products(spark, sf),
        ("division_id", "department_code", "section_code", "class_code", "subclass_name"),
    )


@query("join_scope_households", Q.with_(
    f"SELECT {LINE_SQL}, household_id FROM items JOIN baskets USING (transaction_uid) WHERE household_id IN "
    "(SELECT household_id FROM res WHERE household_id IS NOT NULL)",
    "items", "baskets", "feedback", "numbers", "known", s=SETTLED, res=RESOLVED.format(source="s")))
def join_scope_households(spark, sf):
    households = resolved_feedback(spark, sf).select("household_id").distinct()
    return J.join_scope_households(R.sales(spark, sf), households).select(*LINE, "household_id")


# --- windows and sets ---------------------------------------------------------------------


@query("win_collect_distinct", Q.with_(
    "SELECT transaction_uid, store_id, tender_type_group, list_sort(coalesce(list(DISTINCT "
    "tender_type_group) FILTER (WHERE tender_type_group IS NOT NULL) OVER (PARTITION BY transaction_uid), "
    "[])) AS tenders, len(tenders) AS n_tenders FROM (SELECT transaction_uid, store_id, "
    "trim(tender_type_group) AS tender_type_group FROM till)", "till"))
def win_collect_distinct(spark, sf):
    tenders = R.till_tenders(spark, sf).select(
        "transaction_uid", "store_id", F.trim("tender_type_group").alias("tender_type_group")
    )
    return W.win_collect_distinct(tenders, ["transaction_uid"], "tender_type_group", "tenders")


ROW = "transaction_uid, household_id, date_id, channel"


@query("union_by_name", Q.with_(
    f"SELECT {ROW}, 'P' AS discount_reason_code FROM baskets WHERE channel = 'ONLINE' UNION ALL SELECT "
    f"{ROW}, 'NONE' FROM baskets WHERE channel = 'OFFLINE'", "baskets"))
def union_by_name(spark, sf):
    columns = ROW.split(", ")
    base = R.baskets(spark, sf).select(*columns)
    online = base.where(F.col("channel") == "ONLINE").withColumn("discount_reason_code", F.lit("P"))
    offline = base.where(F.col("channel") == "OFFLINE").select(
        F.lit("NONE").alias("discount_reason_code"), *columns
    )
    return online.unionByName(offline)


@query("union_missing_cols", Q.with_(
    "SELECT event_id AS id, event_type AS kind, value AS amount, NULL AS channel FROM events UNION ALL "
    "SELECT transaction_uid, NULL, NULL, channel FROM baskets", "baskets"))
def union_missing_cols(spark, sf):
    events = R.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"),
        F.col("value").alias("amount"),
    )
    orders = R.baskets(spark, sf).select(F.col("transaction_uid").alias("id"), "channel")
    return J.union_missing_cols([events, orders])


@query("union_all_position", Q.with_(
    "SELECT transaction_uid, date_id FROM baskets UNION ALL SELECT transaction_uid, CAST(date_id + 1 AS "
    "DATE) FROM baskets UNION ALL SELECT transaction_uid, CAST(date_id - 1 AS DATE) FROM baskets",
    "baskets"))
def union_all_position(spark, sf):
    return W.day_and_neighbours(R.baskets(spark, sf).select("transaction_uid", "date_id"))


# --- timeline and segments ----------------------------------------------------------------


@query("timeframe", Q.with_(
    f"SELECT s AS timeframe_start, e AS timeframe_end, {Q.week_id('s')} AS start_week, {Q.week_id('e')} AS "
    "end_week, date_diff('day', s, e) AS gap_days FROM (SELECT e, CAST(date_trunc('month', e) - INTERVAL "
    "11 MONTH AS DATE) AS s FROM (SELECT CAST(CASE WHEN m = last_day(m) THEN m ELSE date_trunc('month', m) "
    "- INTERVAL 1 DAY END AS DATE) AS e FROM (SELECT max(date_id) AS m FROM baskets)))", "baskets"))
def timeframe(spark, sf):
    return T.timeframe(R.baskets(spark, sf))


@query("agg_scalar_bounds", Q.with_(
    "SELECT CAST(min(first_contact_date) - 380 AS DATE) AS min_data_date, min(first_contact_date) AS "
    "min_contact_date, max(first_contact_date) AS max_data_date FROM contacts", "contacts"))
def agg_scalar_bounds(spark, sf):
    return T.agg_scalar_bounds(R.contacts(spark, sf), "first_contact_date")


@query("agg_household_card_date", Q.with_(
    "SELECT household_id, max(card_issue_date) AS last_card_issue_date FROM customers GROUP BY 1",
    "customers"))
def agg_household_card_date(spark, sf):
    return T.agg_household_card_date(R.customers(spark, sf))


@query("days_since_registration", Q.with_(
    f"SELECT household_id, date_diff('day', max(card_issue_date), {Q.END}) AS day_regis FROM customers "
    "GROUP BY 1", "customers"))
def days_since_registration(spark, sf):
    cards = T.agg_household_card_date(R.customers(spark, sf))
    return T.days_since_registration(cards, R.HISTORY.end).select("household_id", "day_regis")


def _carded(spark, sf) -> DataFrame:
    cards = T.agg_household_card_date(R.customers(spark, sf))
    return R.contacts(spark, sf).join(cards, "household_id", "left")


@query("card_age_at_contact", Q.with_(
    "SELECT household_id, date_diff('day', card_issue_date, first_contact_date) AS card_aging_day "
    "FROM contacts LEFT JOIN customers USING (household_id)", "contacts", "customers"))
def card_age_at_contact(spark, sf):
    return T.card_age_at_contact(_carded(spark, sf)).select("household_id", "card_aging_day")


STARTS = ", ".join(
    f"CAST(first_contact_date - {n} AS DATE) AS r{n}_start_date" for n in K.RECENCY_DAYS
)


@query("recency_start_dates", Q.with_(
    f"SELECT household_id, first_contact_date, {STARTS} FROM contacts", "contacts"))
def recency_start_dates(spark, sf):
    return T.recency_start_dates(R.contacts(spark, sf))


WEEK_COLUMNS = [f"r{n}_wk_id" for n in K.RECENCY_DAYS]


def _weeks_sql() -> str:
    cells = ", ".join(
        f"CASE WHEN r{n}_start_date >= {Q.START} THEN {Q.week_id(f'r{n}_start_date')} END AS r{n}_wk_id"
        for n in K.RECENCY_DAYS
    )
    return cells


@query("recency_week_ids", Q.with_(
    f"SELECT household_id, card_aging_day, {_weeks_sql()} FROM timeline", "timeline"))
def recency_week_ids(spark, sf):
    dated = T.recency_start_dates(T.card_age_at_contact(_carded(spark, sf)))
    return T.recency_week_ids(dated, R.calendar(spark)).select(
        "household_id", "card_aging_day", *WEEK_COLUMNS
    )


@query("household_timeline", Q.with_(
    f"SELECT *, {_weeks_sql()} FROM timeline", "timeline"))
def household_timeline(spark, sf):
    return timeline(spark, sf)


@query("segment_snapshot", Q.with_(
    "SELECT DISTINCT 'truprice' AS segment, household_id, truprice_seg_desc, NULL AS facts_seg_desc, NULL AS "
    "lifestage_seg_name, NULL AS pref_store_id, NULL AS pref_store_format, NULL AS pref_store_region, "
    "period_id, NULL AS week_id, NULL AS quarter_id FROM priceseg UNION ALL "
    "SELECT DISTINCT 'facts', household_id, NULL, facts_seg_desc, NULL, NULL, NULL, NULL, NULL, week_id, NULL "
    "FROM factseg UNION ALL SELECT DISTINCT 'lifestage', household_id, NULL, NULL, lifestage_seg_name, NULL, "
    "NULL, NULL, NULL, NULL, quarter_id FROM stages UNION ALL SELECT DISTINCT 'prefer_store', household_id, "
    "NULL, NULL, NULL, pref_store_id, pref_store_format, pref_store_region, period_id, NULL, NULL FROM prefstore",
    "priceseg", "factseg", "stages", "prefstore"))
def segment_snapshot(spark, sf):
    stages = R.life_stages(spark, sf).withColumnRenamed("quarter_id", "mapping_quarter_id")
    tables = E.segment_tables({
        "truprice": R.price_segments(spark, sf), "facts": R.fact_segments(spark, sf), "lifestage": stages,
        "prefer_store": R.preferred_stores(spark, sf).withColumn("household_id", F.col("household_id").cast("string")),
    })
    order = ("segment", "household_id", "truprice_seg_desc", "facts_seg_desc", "lifestage_seg_name", "pref_store_id",
             "pref_store_format", "pref_store_region", "period_id", "week_id", "quarter_id")
    return J.union_missing_cols([t.withColumn("segment", F.lit(name)) for name, t in tables.items()]).select(*order)


@query("lifecycle_shift", Q.with_("SELECT * FROM cycle", "cycle"))
def lifecycle_shift(spark, sf):
    return E.lifecycle_shift(
        R.lifecycle_history(spark, sf), R.lifecycle_names(spark), R.calendar(spark)
    )


@query("shopping_mission_scope", Q.with_(
    "SELECT * FROM missions WHERE week_id BETWEEN 199901 AND 200026", "missions"))
def shopping_mission_scope(spark, sf):
    return E.shopping_mission_scope(R.missions(spark, sf), 199901, 200026)


ONE_TENDER = ("SELECT DISTINCT concat_ws('_', transaction_uid, store_id, date_id) AS transaction_uid, k AS "
              "tender_type_group FROM till JOIN (SELECT transaction_uid, max(tender_type_group) AS k FROM "
              "till GROUP BY 1 HAVING count(DISTINCT tender_type_group) = 1) USING (transaction_uid)")


@query("txn_enrich_contacted", Q.with_(
    "SELECT s.*, tender_type_group, shopping_missions_id FROM storebask s JOIN one USING (transaction_uid) "
    "LEFT JOIN missions m ON m.transaction_concat = s.transaction_concat AND m.week_id = s.week_id "
    "WHERE household_id IN (SELECT household_id FROM known)",
    "storebask", "till", "missions", "known", one=ONE_TENDER))
def txn_enrich_contacted(spark, sf):
    one = G.keep_single_tender(
        R.till_tenders(spark, sf), "transaction_uid", ["transaction_uid", "store_id", "date_id"]
    )
    missions = E.shopping_mission_scope(
        R.missions(spark, sf), R.HISTORY.start_week, R.HISTORY.end_week
    )
    return E.txn_enrich_contacted(
        R.store_baskets(spark, sf), R.known_customers(spark, sf), one, missions
    )
