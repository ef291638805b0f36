"""Flag queries: every row of the whole fact with the flag in question."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.operators import flags as G
from basketlens.operators import promo as P
from basketlens.queries import sqlparts as Q
from basketlens.queries.aggregates import paid, priced, promoted, recent
from basketlens.queries.registry import query
from basketlens.sources import roles as R

KEY = ("transaction_uid", "upc_id", "store_id", "date_id")
KEYS = ", ".join(KEY)
YEAR_START, YEAR_END = f"DATE '{R.YEAR.start}'", f"DATE '{R.YEAR.end}'"


def flagged_sql(*columns: str) -> str:
    return Q.with_(f"SELECT {KEYS}, {', '.join(columns)} FROM flagged", "flagged")


@query("flag_time_of_day", Q.with_(
    f"SELECT transaction_uid, tran_datetime, hour(tran_datetime) AS tran_hour, "
    f"{Q.TIME_OF_DAY.replace('h ', 'hour(tran_datetime) ')} AS time_of_day FROM etxn", "etxn"))
def flag_time_of_day(spark, sf):
    return G.flag_time_of_day(R.event_txn(spark, sf)).select(
        "transaction_uid", "tran_datetime", "tran_hour", "time_of_day"
    )


@query("flag_week_of_month", flagged_sql("week_of_month"))
def flag_week_of_month(spark, sf):
    return G.flag_week_of_month(R.sales(spark, sf)).select(*KEY, "week_of_month")


@query("flag_weekend", Q.with_(
    "SELECT transaction_uid, tran_datetime, CASE WHEN isodow(date_id) >= 6 OR (isodow(date_id) = 5 "
    "AND hour(tran_datetime) >= 18) THEN 'Y' ELSE 'N' END AS weekend_flag FROM etxn", "etxn"))
def flag_weekend(spark, sf):
    return G.flag_weekend(G.flag_time_of_day(R.event_txn(spark, sf))).select(
        "transaction_uid", "tran_datetime", "weekend_flag"
    )


@query("flag_festive", flagged_sql("fest_flag"))
def flag_festive(spark, sf):
    return G.flag_festive(R.sales(spark, sf), R.calendar(spark)).select(*KEY, "fest_flag")


@query("flag_last_weekend", flagged_sql("last_weekend_flag"))
def flag_last_weekend(spark, sf):
    return G.flag_last_weekend(R.sales(spark, sf), R.calendar(spark)).select(
        *KEY, "last_weekend_flag"
    )


@query("flag_recency", flagged_sql(
    "end_month_date", "CAST(months_from_end_date AS DOUBLE) AS months_from_end_date",
    "last_3_flag", "last_6_flag", "last_9_flag"))
def flag_recency(spark, sf):
    return G.flag_recency(R.sales(spark, sf), R.HISTORY.end).select(
        *KEY, "end_month_date", "months_from_end_date", "last_3_flag", "last_6_flag", "last_9_flag"
    )


@query("flag_quarter", flagged_sql("app_year_qtr", *[
    f"CASE WHEN app_year_qtr = 'Q{n}' THEN 'Y' ELSE 'N' END AS q{n}_flag" for n in (1, 2, 3, 4)]))
def flag_quarter(spark, sf):
    return recent(R.sales)(spark, sf).select(
        *KEY, "app_year_qtr", "q1_flag", "q2_flag", "q3_flag", "q4_flag"
    )


@query("flag_price_level", flagged_sql("price_level"))
def flag_price_level(spark, sf):
    return priced(spark, sf).select(*KEY, "price_level")


@query("flag_single_tender", Q.with_("SELECT * FROM tillone", "tillone"))
def flag_single_tender(spark, sf):
    return G.flag_single_tender(
        R.till_tenders(spark, sf), ["transaction_uid", "store_id", "date_id"]
    )


@query("keep_single_tender", Q.with_(
    "SELECT DISTINCT concat_ws('_', transaction_uid, store_id, date_id) AS transaction_uid, "
    "k AS tender_type_group FROM till JOIN (SELECT transaction_uid, max(tender_type_group) AS k "
    "FROM till GROUP BY 1 HAVING count(DISTINCT tender_type_group) = 1) USING (transaction_uid)",
    "till"))
def keep_single_tender(spark, sf):
    return G.keep_single_tender(
        R.till_tenders(spark, sf), "transaction_uid", ["transaction_uid", "store_id", "date_id"]
    )


@query("flag_payment", flagged_sql(
    "till_payment_method", "online_payment_method", "payment_flag"))
def flag_payment(spark, sf):
    return paid(spark, sf).select(
        *KEY, "till_payment_method", "online_payment_method", "payment_flag"
    )


@query("flag_promo", flagged_sql("discount_amt", "discount_reason_code", "promo_flag"))
def flag_promo(spark, sf):
    return promoted(R.sales)(spark, sf).select(
        *KEY, "discount_amt", "discount_reason_code", "promo_flag"
    )


@query("promo_active_filter", Q.with_(
    "SELECT promo_id, 'type' AS rule FROM promos WHERE active_flag = 'Y' AND change_type IS NOT NULL "
    "UNION ALL SELECT promo_id, 'state' FROM promos WHERE active_flag = 'Y' "
    "AND coalesce(state_desc, 'NA') <> 'Cancelled' AND promo_start_date <= promo_end_date", "promos"))
def promo_active_filter(spark, sf):
    promos = R.promotions(spark, sf)
    return (
        P.active_by_type(promos).select("promo_id", F.lit("type").alias("rule"))
        .unionByName(P.active_by_state(promos).select("promo_id", F.lit("state").alias("rule")))
    )


@query("promo_week_scope", Q.with_(
    f"SELECT promoweek_id, count(*) AS baskets FROM baskets JOIN cal USING (date_id) WHERE promoweek_id "
    f"BETWEEN (SELECT min(promoweek_id) FROM cal WHERE date_id BETWEEN {YEAR_START} AND {YEAR_END}) "
    f"AND (SELECT max(promoweek_id) FROM cal WHERE date_id BETWEEN {YEAR_START} AND {YEAR_END}) "
    "GROUP BY 1", "baskets", "cal"))
def promo_week_scope(spark, sf):
    scope = P.promo_week_scope(R.calendar(spark), R.YEAR.start, R.YEAR.end)
    return (
        R.baskets(spark, sf).join(F.broadcast(scope), "date_id")
        .groupBy("promoweek_id").agg(F.count(F.lit(1)).alias("baskets"))
    )


@query("promo_expand_zone", Q.with_(
    "SELECT DISTINCT upc_id, r.store_id, date_id, store_format_name FROM promoranges r JOIN cal "
    "ON date_id BETWEEN s AND e", "promoranges", "cal"))
def promo_expand_zone(spark, sf):
    return P.promo_expand_zone(
        R.promotions(spark, sf), R.promo_zones(spark, sf), R.stores(spark, sf), R.HISTORY
    )


EXPANDED = """SELECT z.store_id, p.* EXCLUDE (store_id), 'zone_lvl' AS promozone_level, date_id
    FROM promos p JOIN zones z ON z.zone_id = promo_storegroup_id AND z.source = p.source
    JOIN cal ON date_id BETWEEN promo_start_date AND promo_end_date
    WHERE active_flag = 'Y' AND coalesce(state_desc, 'NA') <> 'Cancelled'
  UNION ALL
  SELECT p.store_id, p.* EXCLUDE (store_id), 'store_lvl', date_id
    FROM promos p JOIN cal ON date_id BETWEEN promo_start_date AND promo_end_date
    WHERE active_flag = 'Y' AND coalesce(state_desc, 'NA') <> 'Cancelled'
      AND promo_storegroup_id IS NULL AND p.store_id IS NOT NULL"""


@query("promo_expand_store_or_zone", Q.with_(
    "SELECT promo_id, upc_id, source, promozone_level, store_id, date_id FROM x",
    "promos", "zones", "cal", x=EXPANDED))
def promo_expand_store_or_zone(spark, sf):
    rows = P.promo_expand_store_or_zone(R.promotions(spark, sf), R.promo_zones(spark, sf), R.HISTORY)
    return rows.select(
        "promo_id", "upc_id", "source", "promozone_level", "store_id", "date_id"
    )


SIDE = """CASE WHEN promo_offer_id = 1 THEN 'reward' WHEN promo_offer_id IN (2, 3) THEN 'cond'
  WHEN source = 'rms12' AND promo_offer_id IN (4, 5) AND upc_id_cond IS NULL
    AND upc_id_reward IS NOT NULL THEN 'reward'
  WHEN source = 'rms12' AND promo_offer_id IN (4, 5) AND upc_id_cond IS NOT NULL
    AND upc_id_reward IS NULL THEN 'cond'
  WHEN source = 'rms19' AND promo_offer_id IN (4, 5) THEN 'reward' ELSE 'INVALID' END"""
SIDE_COLUMNS = ", ".join(k for k in P.SIDE_KEYS if k != "upc_id")


@query("promo_side", Q.with_(
    f"SELECT DISTINCT {SIDE_COLUMNS}, upc_id, {SIDE} AS upc_side FROM x UNION "
    f"SELECT DISTINCT {SIDE_COLUMNS}, upc_id_cond AS upc_id, 'cond' FROM x "
    "WHERE source = 'rms19' AND promo_offer_id IN (4, 5)", "promos", "zones", "cal", x=EXPANDED))
def promo_side(spark, sf):
    return P.promo_side(R.promotions(spark, sf), R.promo_zones(spark, sf), R.HISTORY)


@query("flag_tenure", Q.with_(
    "SELECT t.transaction_uid, t.upc_id, t.store_id, t.date_id, card_issue_date, first_txn_date, "
    + Q.rnd(f"date_diff('day', card_issue_date, {Q.END}) / 365.0::DOUBLE", 1) + " AS \"CC_TENURE\", "
    "CASE WHEN first_txn_date <= date_id THEN 1 ELSE 0 END AS one_year_history "
    "FROM txn t LEFT JOIN tenure USING (household_id)", "txn", "tenure"))
def flag_tenure(spark, sf):
    return G.flag_tenure(
        R.sales(spark, sf), R.customers(spark, sf), R.first_transactions(spark, sf), R.HISTORY.end
    ).select(*KEY, "card_issue_date", "first_txn_date", "CC_TENURE", "one_year_history")


@query("group_hierarchy_codes", flagged_sql("grouped_department_code", "grouped_section_code"))
def group_hierarchy_codes(spark, sf):
    return G.group_hierarchy_codes(
        R.product_sales(spark, sf), R.DEPARTMENT_MERGE, R.SECTION_MERGE
    ).select(*KEY, "grouped_department_code", "grouped_section_code")


@query("dummy_household", Q.with_(
    "SELECT DISTINCT division_id, NULL AS department_code, NULL AS section_code, -1 AS household_id "
    "FROM products UNION ALL SELECT DISTINCT NULL, department_code, NULL, -1 FROM products "
    "WHERE department_code NOT IN ('Brand#24', 'Brand#25') UNION ALL "
    "SELECT DISTINCT NULL, NULL, section_code, -1 FROM products WHERE section_code NOT IN ('49', '50') "
    "UNION ALL SELECT NULL, 'Brand#99', NULL, -1 UNION ALL SELECT NULL, NULL, '98', -1 "
    "UNION ALL SELECT NULL, NULL, '99', -1", "products"))
def dummy_household(spark, sf):
    return G.dummy_household(
        R.products(spark, sf), R.DEPARTMENT_EXCLUDE, R.SECTION_EXCLUDE, ("Brand#99",), ("98", "99")
    )


@query("day_part_fine", Q.with_(
    "SELECT transaction_uid, tran_datetime, part_of_day, name_of_day, day_section, wk_end_wk_day, "
    "wken_day FROM f", "etxn", f="""SELECT *, CASE WHEN h <= 8 THEN 'early_morning'
      WHEN h <= 10 THEN 'morning' WHEN h <= 12 THEN 'lunch' WHEN h <= 16 THEN 'afterlunch'
      WHEN h <= 18 THEN 'evening' WHEN h <= 20 THEN 'late_evening' ELSE 'night' END AS part_of_day,
      strftime(tran_datetime, '%a') AS name_of_day,
      CASE WHEN h <= 12 THEN 'Morning_6AM_12PM' WHEN h <= 16 THEN 'Afternoon_12PM_4PM'
      WHEN h <= 20 THEN 'Evening_4PM_8PM' ELSE 'Night_8PM_12AM' END AS day_section,
      CASE WHEN isodow(tran_datetime) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS wk_end_wk_day,
      wk_end_wk_day || day_section AS wken_day
      FROM (SELECT *, hour(tran_datetime) AS h FROM etxn)"""))
def day_part_fine(spark, sf):
    return G.day_part_fine(R.event_txn(spark, sf)).select(
        "transaction_uid", "tran_datetime", "part_of_day", "name_of_day", "day_section",
        "wk_end_wk_day", "wken_day",
    )


@query("unit_choice", "SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber % 2 = 1 THEN l_quantity "
       "ELSE l_quantity / 2 END AS unit FROM lineitem")
def unit_choice(spark, sf):
    quantity = F.col("l_quantity")
    lines = R.table(spark, sf, "lineitem").withColumns(
        {
            "count_qty": F.when(F.col("l_linenumber") % 2 == 1, F.lit(1)),
            "product_qty": quantity,
            "measured_qty": quantity / 2,
        }
    )
    return G.unit_choice(lines).select("l_orderkey", "l_partkey", "unit")
