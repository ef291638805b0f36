"""Aggregation queries: feature groups of the flagged fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.functions.naming import pivot_renames
from basketlens.functions.sizing import sized_parts
from basketlens.operators import contact as N
from basketlens.operators import features as S
from basketlens.operators import kpi
from basketlens.operators import partials as P
from basketlens.operators import flags
from basketlens.operators.flags import day_part_fine
from basketlens.operators.joins import join_household_window, join_inner_dim
from basketlens.operators.timeline import recency_start_dates
from basketlens.session import scratch_path
from basketlens.operators.promo import flag_zone_promo
from basketlens.plans.migration import Inputs, flagged_fact
from basketlens.queries import sqlparts as Q
from basketlens.queries.registry import query
from basketlens.sources import roles as R
from basketlens.sources.calendar import flagged_calendar

PATTERNS = {"premium": R.PREMIUM, "not_premium": R.NOT_PREMIUM, "budget": R.BUDGET}
DEPARTMENTS = ("Brand#1&Brand#2", *(f"Brand#{n}" for n in range(3, 24)))
SECTIONS = ("1&2", "10&20", *(str(n) for n in range(3, 49) if n not in (10, 20)))


def inputs(spark: SparkSession, sf: str) -> Inputs:
    return Inputs(
        txn=R.txn(spark, sf), calendar=R.calendar(spark), products=R.products(spark, sf),
        stores=R.stores(spark, sf), till=R.till_tenders(spark, sf),
        online=R.online_tenders(spark, sf), customers=R.customers(spark, sf),
        first_txn=R.first_transactions(spark, sf), promos=R.promotions(spark, sf),
        zones=R.promo_zones(spark, sf), price_patterns=PATTERNS,
        department_merge=R.DEPARTMENT_MERGE, section_merge=R.SECTION_MERGE,
    )


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return flagged_fact(inputs(spark, sf), R.HISTORY)


def recent(base):
    """Fact with recency and quarter flags, which need nothing but the date."""
    return lambda spark, sf: flags.flag_quarter(flags.flag_recency(base(spark, sf), R.HISTORY.end))


def grouped(spark: SparkSession, sf: str) -> DataFrame:
    products = recent(R.product_sales)(spark, sf)
    return flags.group_hierarchy_codes(products, R.DEPARTMENT_MERGE, R.SECTION_MERGE)


def timed(spark: SparkSession, sf: str) -> DataFrame:
    """Fact with the flags of the calendar and the clock."""
    dated = join_inner_dim(R.sales(spark, sf), flagged_calendar(R.calendar(spark)))
    return flags.flag_weekend(flags.flag_week_of_month(flags.flag_time_of_day(dated)))


def priced(spark: SparkSession, sf: str) -> DataFrame:
    return flags.flag_price_level(R.sales(spark, sf), R.products(spark, sf), **PATTERNS)


def paid(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["transaction_uid", "store_id", "date_id"]
    till = flags.flag_single_tender(R.till_tenders(spark, sf), keys)
    online = flags.flag_single_tender(R.online_tenders(spark, sf), keys[:1])
    return flags.flag_payment(R.sales(spark, sf), till, online)


def promoted(fact):
    """Adds the promotion flag to a fact."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return flag_zone_promo(
            fact(spark, sf), R.promotions(spark, sf), R.promo_zones(spark, sf), R.stores(spark, sf), R.HISTORY
        )

    return run


# Query -> the fact with just the flags it needs, and its feature groups. A production run
# reads all of them from the one flagged table that ``plans.migration`` writes.
FEATURE_QUERIES = {
    "agg_div": (R.product_sales, S.division(R.DIVISIONS)),
    "agg_div_recency": (recent(R.product_sales), S.division(R.DIVISIONS).retagged("L3", "L6", "L9")),
    "agg_dep": (grouped, S.department(DEPARTMENTS, R.DEPARTMENT_EXCLUDE)),
    "agg_dep_recency": (
        grouped, S.department(DEPARTMENTS, R.DEPARTMENT_EXCLUDE).retagged("L3", "L6", "L9"),
    ),
    "agg_sec": (grouped, S.section(SECTIONS, R.SECTION_EXCLUDE)),
    "agg_quarter": (recent(R.sales), S.quarter()),
    "agg_recency": (recent(R.sales), S.recency()),
    "agg_festive": (timed, S.festive()),
    "agg_time_of_day": (timed, S.day_part()),
    "agg_weekend": (timed, S.weekend("Y")),
    "agg_weekday": (timed, S.weekend("N")),
    "agg_last_weekend": (timed, S.last_weekend()),
    "agg_store_format": (R.store_sales, S.store_format()),
    "agg_store_region": (R.store_sales, S.store_region(R.REGIONS)),
    "agg_price_level": (priced, S.price_level()),
    "agg_tender": (paid, S.payment()),
    "agg_promo": (promoted(R.sales), S.promo()),
    "agg_promo_recency": (promoted(recent(R.sales)), S.promo().retagged("L3", "L6", "L9")),
    "agg_promo_items": (promoted(recent(R.sales)), S.promo_items()),
    "agg_promo_time_of_day": (promoted(timed), S.promo_day_part()),
    "agg_promo_last_weekend": (promoted(timed), S.promo_last_weekend()),
}


def product_codes(spark: SparkSession, sf: str, column: str, excluded=()) -> list[str]:
    """Values of a product column, after grouping, from the product table."""
    products = flags.group_hierarchy_codes(R.products(spark, sf), R.DEPARTMENT_MERGE, R.SECTION_MERGE)
    return [v for v in kpi.pivot_values(products, column) if v not in excluded]


def _departments(spark: SparkSession, sf: str) -> S.FeatureSet:
    codes = product_codes(spark, sf, "grouped_department_code", R.DEPARTMENT_EXCLUDE)
    return S.department(codes, R.DEPARTMENT_EXCLUDE)


def _divisions(spark: SparkSession, sf: str) -> S.FeatureSet:
    return S.division(product_codes(spark, sf, "division_id"))


# What the dimension tables hold decides on the columns; the check SQL above names them one by one.
LIVE = {
    "agg_div": _divisions,
    "agg_div_recency": lambda spark, sf: _divisions(spark, sf).retagged("L3", "L6", "L9"),
    "agg_dep": _departments,
    "agg_dep_recency": lambda spark, sf: _departments(spark, sf).retagged("L3", "L6", "L9"),
    "agg_sec": lambda spark, sf: S.section(
        product_codes(spark, sf, "grouped_section_code", R.SECTION_EXCLUDE), R.SECTION_EXCLUDE),
    "agg_store_region": lambda spark, sf: S.store_region(kpi.pivot_values(R.stores(spark, sf), "store_region")),
}


def _register(name: str, fact, *sets: S.FeatureSet) -> None:
    @query(name, Q.features_sql([f for s in sets for f in s.features()]))
    def run(spark: SparkSession, sf: str) -> DataFrame:
        found = [LIVE[name](spark, sf)] if name in LIVE else sets
        return S.agg_features(fact(spark, sf), *found)


for _name, (_fact, *_sets) in FEATURE_QUERIES.items():
    _register(_name, _fact, *_sets)


@query("agg_total", Q.with_(
    "SELECT household_id, CAST(sum(net_spend_amt) AS DOUBLE) AS \"Total_Spend\", "
    "count(DISTINCT transaction_uid) AS \"Total_Visits\", sum(unit) AS \"Total_Units\" "
    "FROM txn GROUP BY 1", "txn"))
def agg_total(spark, sf):
    return kpi.agg_total(R.sales(spark, sf))


RATIO_CELLS = f"""s AS "Spend", n AS "Visits", u AS "Units", {Q.ratio('s', 'n')} AS "SPV",
  {Q.ratio('u', 'n')} AS "UPV", {Q.ratio('s', 'u')} AS "SPU", {Q.pct('s', 'ts')} AS "PCT_Spend",
  {Q.pct('n', 'tv')} AS "PCT_Visits", {Q.pct('u', 'tu')} AS "PCT_Units" """
BY_TENDER = ("SELECT household_id, tender_type_group AS d, CAST(sum(net_spend_amt) AS DOUBLE) AS s, "
             "count(DISTINCT transaction_uid) AS n, sum(unit) AS u FROM txn GROUP BY ALL")
TXN_TOT = ("SELECT household_id, CAST(sum(net_spend_amt) AS DOUBLE) AS ts, "
           "count(DISTINCT transaction_uid) AS tv, sum(unit) AS tu FROM txn GROUP BY 1")


@query("agg_kpi_ratios", Q.with_(
    f"SELECT household_id, d AS tender_type_group, {RATIO_CELLS} FROM g JOIN tt USING (household_id)",
    "txn", g=BY_TENDER, tt=TXN_TOT))
def agg_kpi_ratios(spark, sf):
    return kpi.agg_kpi_ratios(R.sales(spark, sf), "tender_type_group")


PIVOT_KPIS = ("Spend", "Visits", "PCT_Spend")


def _pivot_sql(names: dict[str, str], kpis=PIVOT_KPIS) -> str:
    cells = ", ".join(
        f"coalesce(max(\"{k}\") FILTER (WHERE d = '{v}'), 0) AS \"{names.get(f'{v}_{k}', f'{v}_{k}')}\""
        for v in K.TILL_TENDERS for k in kpis
    )
    return Q.with_(
        f"SELECT household_id, {cells} FROM l GROUP BY 1", "txn", g=BY_TENDER, tt=TXN_TOT,
        l=f"SELECT household_id, d, {RATIO_CELLS} FROM g JOIN tt USING (household_id)",
    )


@query("pivot_kpi", _pivot_sql({}))
def pivot_kpi(spark, sf):
    long = kpi.agg_kpi_ratios(R.sales(spark, sf), "tender_type_group")
    return kpi.pivot_kpi(long, "tender_type_group", K.TILL_TENDERS, PIVOT_KPIS)


TENDER_RENAMES = pivot_renames(K.TILL_TENDERS, "sec", "L3")


@query("rename_kpi", _pivot_sql(TENDER_RENAMES))
def rename_kpi(spark, sf):
    return kpi.rename_kpi(pivot_kpi(spark, sf), TENDER_RENAMES)


@query("agg_distinct_counts", Q.with_(
    "SELECT household_id, " + ", ".join(
        f'count(DISTINCT {c}) AS "{n}"' for n, c in S.DISTINCT_COLUMNS.items()
    ) + " FROM txn GROUP BY 1", "txn"))
def agg_distinct_counts(spark, sf):
    of_store = {n: c for n, c in S.DISTINCT_COLUMNS.items() if c == "store_id"}
    of_product = {n: c for n, c in S.DISTINCT_COLUMNS.items() if c != "store_id"}
    return S.agg_distinct_counts(S.distinct_bits(
        R.sales(spark, sf), S.level_codes(R.products(spark, sf), "upc_id", of_product),
        S.level_codes(R.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("store_id")), "store_id", of_store)))


STAT_SQL = {"AVG": "avg", "SD": "stddev_samp", "MIN": "min", "MAX": "max"}


def _stats_sql(label: str, suffix: str, stats) -> str:
    def cell(m, s):
        value = f"coalesce({STAT_SQL[s]}({m}), 0)"
        if s == "AVG":
            # exact decimal average: the sum is exact, so is the division to 10 places
            value = f"CAST(sum(CAST({m} AS DECIMAL(28, 4))) AS DOUBLE) / count({m})"
        return f'{Q.rnd(value)} AS "{s}_{m.upper()}_{suffix}"'

    cells = ", ".join(cell(m, s) for m in ("spend", "visits", "units") for s in stats)
    return Q.with_(
        f"SELECT household_id, {cells} FROM p GROUP BY 1", "flagged",
        p=f"SELECT household_id, {label} AS v, CAST(sum(net_spend_amt) AS DOUBLE) AS spend, "
          "CAST(count(DISTINCT transaction_uid) AS DOUBLE) AS visits, sum(unit) AS units "
          "FROM flagged GROUP BY ALL",
    )


@query("agg_monthly_stats", _stats_sql("end_month_date", "MNTH", S.MONTHLY_STATS))
def agg_monthly_stats(spark, sf):
    return S.agg_monthly_stats(R.sales(spark, sf))


@query("agg_weekly_stats", _stats_sql("week_of_month", "WK", S.WEEKLY_STATS))
def agg_weekly_stats(spark, sf):
    return S.agg_weekly_stats(timed(spark, sf))


# --- the same from stored sums --------------------------------------------------------------


def from_sums(spark, sf, fact, groups) -> DataFrame:
    """Stored sums of the history after three runs: all but a quarter, that quarter, its last days again."""
    path = scratch_path(spark, "kpi-sums")
    last = R.HISTORY.end
    parts = sized_parts(R.table(spark, sf, "lineitem"), R.table(spark, sf, "orders"))
    for first, until in ((R.HISTORY.start, date(2001, 5, 31)), (date(2001, 6, 1), last), (date(2001, 8, 27), last)):
        P.extend(fact(spark, sf), path, groups, first, until, parts=parts)
    return P.stored(spark, path, R.HISTORY.start, last)


DIVISION_SLICES = S.division(R.DIVISIONS).retagged("L3", "L6", "L9")


@query("partials_recency", Q.features_sql(DIVISION_SLICES.features()))
def partials_recency(spark, sf):
    sets = _divisions(spark, sf).retagged("L3", "L6", "L9")
    sums = from_sums(spark, sf, R.product_sales, S.label_map([sets]))
    return kpi.pivot_features(P.window_long(sums, P.recency_starts(R.HISTORY.end)), sets.features())


@query("partials_quarter", Q.features_sql(S.quarter().features()))
def partials_quarter(spark, sf):
    sums = P.with_quarters(from_sums(spark, sf, R.sales, {}), R.HISTORY.end)
    return kpi.pivot_features(P.window_long(sums), S.quarter().features())


@query("partials_monthly_stats", _stats_sql("end_month_date", "MNTH", S.MONTHLY_STATS))
def partials_monthly_stats(spark, sf):
    sums = from_sums(spark, sf, R.sales, {"MONTH": F.last_day("date_id")})
    return S.period_stats(P.window_long(sums), "MONTH", "MNTH", S.MONTHLY_STATS)


@query("partials_weekly_stats", _stats_sql("week_of_month", "WK", S.WEEKLY_STATS))
def partials_weekly_stats(spark, sf):
    sums = from_sums(spark, sf, timed, {"WEEK": F.col("week_of_month")})
    return S.period_stats(P.window_long(sums), "WEEK", "WK", S.WEEKLY_STATS)


# --- contact-anchored KPIs ----------------------------------------------------------------


def recent_txn(spark, sf, base=R.sales) -> DataFrame:
    """Rows of the 360 days before a household's first contact, with all start dates."""
    windows = recency_start_dates(R.contacts(spark, sf))
    return join_household_window(base(spark, sf), windows, "r360_start_date", "first_contact_date")


RECENT = ("SELECT *, date_diff('day', date_id, first_contact_date) AS age FROM txn "
          "JOIN contacts USING (household_id) "
          "WHERE date_id BETWEEN first_contact_date - 360 AND first_contact_date")


def recent_sql(body: str, **extra) -> str:
    return Q.with_(body, "txn", "contacts", r=RECENT, **extra)


@query("agg_kpi_named", Q.with_(
    "SELECT store_region, CAST(sum(net_spend_amt) AS DOUBLE) AS region_sales_all, "
    "count(DISTINCT transaction_uid) AS region_visits_all FROM txn GROUP BY 1", "txn"))
def agg_kpi_named(spark, sf):
    columns = N.agg_kpi_named("region", "all", ("net_spend_amt", "transaction_uid"))
    return R.store_sales(spark, sf).groupBy("store_region").agg(*columns)


@query("agg_all_kpi_360", recent_sql(
    "SELECT household_id, CAST(sum(net_spend_amt) AS DOUBLE) AS total_sales_360_days, "
    "sum(unit) AS total_units_360_days, count(DISTINCT transaction_uid) AS total_visits_360_days "
    "FROM r GROUP BY 1"))
def agg_all_kpi_360(spark, sf):
    return N.agg_all_kpi_360(recent_txn(spark, sf))


def _share_sql(column: str, vals, source: str, tender: bool = False) -> list[str]:
    cells = []
    for v in vals:
        f = f"FILTER (WHERE {column} = '{v}')"
        s = f"coalesce(CAST(sum(net_spend_amt) {f} AS DOUBLE), 0)"
        n = f"count(DISTINCT transaction_uid) {f}"
        name = v.lower() if tender else v
        cells += [f'{s} AS "{name}_sales_360_days"', f'{n} AS "{name}_visits_360_days"']
        if not tender:
            cells += [
                f'CAST({n} AS DOUBLE) / count(DISTINCT transaction_uid) AS "{v}_prop_visits_360_days"',
                f'{s} / CAST(sum(net_spend_amt) AS DOUBLE) AS "{v}_prop_sales_360_days"',
            ]
    return cells


TOTALS_360 = ("CAST(sum(net_spend_amt) AS DOUBLE) AS total_sales_360_days, "
              "count(DISTINCT transaction_uid) AS total_visits_360_days")


@query("agg_tender_share_360", recent_sql(
    f"SELECT household_id, {TOTALS_360}, sum(unit) AS total_units_360_days, "
    + ", ".join(_share_sql("tender_type_group", K.TILL_TENDERS, "r", tender=True)) + ", "
    + ", ".join(
        f"CAST(count(DISTINCT transaction_uid) FILTER (WHERE tender_type_group = '{t}') AS DOUBLE) / "
        f"count(DISTINCT transaction_uid) AS prop_visit_by_{w}_360_days, "
        f"coalesce(CAST(sum(net_spend_amt) FILTER (WHERE tender_type_group = '{t}') AS DOUBLE), 0) / "
        f"CAST(sum(net_spend_amt) AS DOUBLE) AS prop_sales_by_{w}_360_days"
        for t, w in (("CASH", "cash"), ("CCARD", "card"))
    ) + " FROM r GROUP BY 1"))
def agg_tender_share_360(spark, sf):
    return N.agg_tender_share_360(recent_txn(spark, sf))


def _channel_sql() -> str:
    tests = {"all_all": "true", "online_all": "channel = 'ONLINE'",
             "offline_all": "channel = 'OFFLINE'",
             "offline_hde": "channel = 'OFFLINE' AND store_format = 'HDE'",
             "offline_gofresh": "channel = 'OFFLINE' AND store_format = 'GoFresh'"}
    cells = []
    for name, test in tests.items():
        for days in (360, 180, 90, 30):
            f = f"FILTER (WHERE {test} AND age <= {days})"
            cells += [
                f"coalesce(CAST(sum(net_spend_amt) {f} AS DOUBLE), 0) AS {name}_sales_{days}_days",
                f"coalesce(sum(unit) {f}, 0) AS {name}_units_{days}_days",
                f"count(DISTINCT transaction_uid) {f} AS {name}_visits_{days}_days",
            ]
    return recent_sql(f"SELECT household_id, {', '.join(cells)} FROM r GROUP BY 1")


@query("agg_format_channel_kpi", _channel_sql())
def agg_format_channel_kpi(spark, sf):
    return N.agg_format_channel_kpi(recent_txn(spark, sf, R.store_sales))


@query("agg_cash_card_segment", recent_sql(
    "SELECT household_id, CASE WHEN k > 0 AND k::DOUBLE / (c + k) >= 0.2 THEN 'credit' ELSE 'cash' "
    "END AS cash_card_customer_flag FROM (SELECT household_id, count(DISTINCT transaction_uid) "
    "FILTER (WHERE store_format = 'HDE' AND tender_type_group = 'CASH') AS c, "
    "count(DISTINCT transaction_uid) FILTER (WHERE store_format = 'HDE' AND "
    "tender_type_group = 'CCARD') AS k FROM r GROUP BY 1)"))
def agg_cash_card_segment(spark, sf):
    return N.agg_cash_card_segment(recent_txn(spark, sf, R.store_sales))


@query("agg_promo_online_monthly", recent_sql(
    "SELECT household_id, CAST(sum(discount_amt) AS DOUBLE) / CAST(sum(net_spend_amt) AS DOUBLE) "
    "AS prop_promo_sales, coalesce(CAST(sum(net_spend_amt) FILTER (WHERE channel = 'ONLINE') AS "
    f"DOUBLE), 0) AS sales_online, CAST(sum(net_spend_amt) AS DOUBLE) / count(DISTINCT {Q.month_id('date_id')}) "
    "AS avg_monthly_sales, CASE WHEN coalesce(sum(net_spend_amt) FILTER (WHERE channel = 'ONLINE'), 0) > 0 "
    "THEN 'Y' ELSE 'N' END AS ever_online FROM r GROUP BY 1"))
def agg_promo_online_monthly(spark, sf):
    return N.agg_promo_online_monthly(join_inner_dim(recent_txn(spark, sf), R.calendar(spark)))


@query("agg_share_pivot", recent_sql(
    "SELECT household_id, " + ", ".join(_share_sql("store_region", R.REGIONS, "r"))
    + " FROM r GROUP BY 1"))
def agg_share_pivot(spark, sf):
    return N.agg_share_pivot(recent_txn(spark, sf, R.store_sales), "store_region", R.REGIONS)


FINE_PARTS = """SELECT *, CASE WHEN h <= 8 THEN 'early_morning' WHEN h <= 10 THEN 'morning'
  WHEN h <= 12 THEN 'lunch' WHEN h <= 16 THEN 'afterlunch' WHEN h <= 18 THEN 'evening'
  WHEN h <= 20 THEN 'late_evening' ELSE 'night' END AS part_of_day,
  CASE WHEN h <= 12 THEN 'Morning_6AM_12PM' WHEN h <= 16 THEN 'Afternoon_12PM_4PM'
  WHEN h <= 20 THEN 'Evening_4PM_8PM' ELSE 'Night_8PM_12AM' END AS day_section,
  CASE WHEN isodow(tran_datetime) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS wk_end_wk_day,
  wk_end_wk_day || day_section AS wken_day, strftime(tran_datetime, '%a') AS name_of_day
  FROM (SELECT *, hour(tran_datetime) AS h FROM etxn)"""
SLOTS = ("SELECT household_id, wken_day, count(DISTINCT transaction_uid) AS n, "
         "sum(net_spend_amt) AS s FROM f GROUP BY ALL")
BEST = ("SELECT household_id, wken_day AS shopping_time FROM slots QUALIFY row_number() OVER "
        "(PARTITION BY household_id ORDER BY n DESC, s DESC, wken_day) = 1")


@query("agg_shopping_time", Q.with_(
    "SELECT household_id, t.* EXCLUDE (household_id), shopping_time FROM (SELECT household_id, "
    f"{TOTALS_360}, " + ", ".join(
        c for col, vs in N.SHOPPING_TIME.items() for c in _share_sql(col, vs, "f")
    ) + " FROM f GROUP BY 1) t LEFT JOIN best USING (household_id)",
    "etxn", f=FINE_PARTS, slots=SLOTS, best=BEST))
def agg_shopping_time(spark, sf):
    return N.agg_shopping_time(day_part_fine(R.event_txn(spark, sf)))


@query("pick_favourite_slot", Q.with_(
    "SELECT household_id, shopping_time FROM best", "etxn", f=FINE_PARTS, slots=SLOTS, best=BEST))
def pick_favourite_slot(spark, sf):
    long = kpi.kpi_long(
        day_part_fine(R.event_txn(spark, sf)), {"SLOT": F.col("wken_day")}, with_total=False
    )
    return N.pick_favourite_slot(long, "SLOT")


@query("agg_funnel", Q.with_(
    "SELECT *, CAST(contactable AS DOUBLE) / leads AS contact_rate, "
    "CAST(bought AS DOUBLE) / contactable AS bought_rate FROM (SELECT insurer_nm, count(*) AS leads, "
    "count(*) FILTER (WHERE Contact_Status = 'Contactable') AS contactable, "
    "count(*) FILTER (WHERE Bought_Status = 'Bought') AS bought FROM feedback GROUP BY 1)",
    "feedback"))
def agg_funnel(spark, sf):
    return N.agg_funnel(R.feedback(spark, sf))
