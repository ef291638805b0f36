"""Assembly and model-side queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.functions.sizing import LONG_BYTES, sized_parts
from basketlens.operators import assemble as A
from basketlens.operators import features as S
from basketlens.operators import kpi
from basketlens.operators import prep as D
from basketlens.operators import scoring as X
from basketlens.operators.joins import join_inner_dim, join_scope_households, join_semi_exists, latest_snapshot
from basketlens.operators.segments import lifecycle_shift, shopping_mission_scope
from basketlens.plans import contacted as H
from basketlens.plans import scoring as L
from basketlens.plans.migration import household_tenure, migrate
from basketlens.queries import sqlparts as Q
from basketlens.queries.aggregates import (
    BY_TENDER, DEPARTMENTS, RATIO_CELLS, SECTIONS, STAT_SQL, TXN_TOT, flagged, grouped, inputs,
    FINE_PARTS, product_codes, recent,
)
from basketlens.queries.registry import query
from basketlens.queries.relational import LATEST, RESOLVED, SETTLED
from basketlens.session import ensure_checkpoint_dir, scratch_path
from basketlens.sources import roles as R
from basketlens.sources.writers import staged

WIDE_SETS = A.default_sets(
    R.DIVISIONS, DEPARTMENTS, SECTIONS, R.REGIONS, R.DEPARTMENT_EXCLUDE, R.SECTION_EXCLUDE
)
SEGMENT_PERIOD = 200107


def live_sets(spark, sf) -> list[S.FeatureSet]:
    """The sets with a column for every value the dimension tables hold."""
    return A.default_sets(
        product_codes(spark, sf, "division_id"),
        product_codes(spark, sf, "grouped_department_code", R.DEPARTMENT_EXCLUDE),
        product_codes(spark, sf, "grouped_section_code", R.SECTION_EXCLUDE),
        kpi.pivot_values(R.stores(spark, sf), "store_region"), R.DEPARTMENT_EXCLUDE, R.SECTION_EXCLUDE)


def long_buckets(spark, sf) -> int:
    """Buckets of the long table: as many as Spark's shuffles have parts, more for large tables."""
    sized = sized_parts(R.table(spark, sf, "lineitem"), R.table(spark, sf, "orders"), task_bytes=LONG_BYTES)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), sized or 0)


def wide(spark, sf) -> DataFrame:
    segments = latest_snapshot(R.price_segments(spark, sf), "period_id", SEGMENT_PERIOD)
    sets = live_sets(spark, sf)
    path = scratch_path(spark, "kpi_long")
    buckets = long_buckets(spark, sf)
    heavy = A.heavy_households(R.baskets(spark, sf))
    long = A.write_long(
        A.wide_long(flagged(spark, sf), sets, buckets, heavy), path.rsplit("/", 1)[1].replace("-", "_"), path, buckets)
    return A.assemble_wide(
        long, sets,
        household_tenure(inputs(spark, sf), R.HISTORY), segments.drop("period_id"),
        copied_department="Brand#5",
    )


def _wide_sql() -> str:
    features = [f for s in WIDE_SETS for f in s.features()]
    long, pivot, cells, _ = Q.wide_parts(features)
    stats = {}
    for name, label, suffix, kinds in (
        ("mon", "end_month_date", "MNTH", S.MONTHLY_STATS), ("wk", "week_of_month", "WK", S.WEEKLY_STATS),
    ):
        out = []
        for m in ("spend", "visits", "units"):
            for k in kinds:
                value = f"coalesce({STAT_SQL[k]}({m}), 0)"
                if k == "AVG":
                    value = f"CAST(sum(CAST({m} AS DECIMAL(28, 4))) AS DOUBLE) / count({m})"
                out.append(f'{Q.rnd(value)} AS "{k}_{m.upper()}_{suffix}"')
        stats[name] = (
            f"SELECT household_id, {', '.join(out)} FROM (SELECT household_id, {label} AS v, "
            "CAST(sum(net_spend_amt) AS DOUBLE) AS spend, CAST(count(DISTINCT transaction_uid) AS "
            "DOUBLE) AS visits, sum(unit) AS units FROM flagged GROUP BY ALL) GROUP BY 1"
        )
    stats["cnt"] = "SELECT household_id, " + ", ".join(
        f'count(DISTINCT {c}) AS "{n}"' for n, c in S.DISTINCT_COLUMNS.items()
    ) + " FROM flagged GROUP BY 1"
    stats["seg"] = (
        "SELECT household_id, truprice_seg_desc FROM priceseg WHERE period_id = "
        f"(SELECT least(max(period_id), {SEGMENT_PERIOD}) FROM priceseg)"
    )
    stats["ten"] = ("SELECT household_id, "
                    + Q.rnd(f"date_diff('day', card_issue_date, {Q.END}) / 365.0::DOUBLE", 1)
                    + ' AS "CC_TENURE" FROM tenure')
    quarters = " AND ".join(f'"Q{n}_SPEND" > 0' for n in (1, 2, 3, 4))
    retired = ", ".join(f'0 AS "{n}"' for n in K.RETIRED_FEATURES)
    copies = ", ".join(
        f'"PCT_CAT_DEP_%Brand#5%_{k}" AS "PCT_CAT_L21_0140071_{k}"' for k in ("SPEND", "VISITS", "UNITS")
    )
    body = (
        f"SELECT k.*, mon.* EXCLUDE (household_id), wk.* EXCLUDE (household_id), cnt.* EXCLUDE "
        f"(household_id), ten.* EXCLUDE (household_id), CASE WHEN \"SPEND\" > 2000 AND \"VISITS\" >= 8 AND "
        f"\"UNITS\" >= 100 AND {quarters} THEN 1 ELSE 0 END AS \"THICK_FLAG\", CASE WHEN truprice_seg_desc IN "
        f"({Q.values(K.AFFLUENT_SEGMENTS)}) THEN 1 ELSE 0 END AS \"AFFLUENCE_UM\", 0 AS \"AFFLUENCE_LA\", "
        f"{retired}, {copies} FROM k JOIN mon USING (household_id) JOIN wk USING (household_id) JOIN cnt USING "
        "(household_id) LEFT JOIN seg USING (household_id) LEFT JOIN ten USING (household_id)"
    )
    return Q.with_(
        body, "flagged", "tot", "priceseg", "tenure", long=long, wide=pivot,
        k=f'SELECT household_id, ts AS "SPEND", tv AS "VISITS", tu AS "UNITS", {", ".join(cells)} '
          "FROM wide JOIN tot USING (household_id)", **stats,
    )


@query("assemble_wide", _wide_sql())
def assemble_wide(spark, sf):
    return wide(spark, sf)


@query("feature_migration", (
    "SELECT household_id, CAST(round(CAST(CAST(coalesce(COLUMNS(* EXCLUDE (household_id)), 0) AS VARCHAR) AS "
    f"DECIMAL(38, 18)), 2) AS DOUBLE) FROM ({_wide_sql()})"))
def feature_migration(spark, sf):
    segments = latest_snapshot(R.price_segments(spark, sf), "period_id", SEGMENT_PERIOD)
    path = scratch_path(spark, "migration")
    return migrate(
        inputs(spark, sf), R.HISTORY, live_sets(spark, sf), segments.drop("period_id"), path,
        path.rsplit("/", 1)[1].replace("-", "_"), long_buckets(spark, sf),
        copied_department="Brand#5",
    )


@query("round_all", Q.with_(
    "SELECT household_id, 0.0::DOUBLE AS tender_type_group, " + ", ".join(
        f'CAST(round(CAST(CAST("{c}" AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) AS "{c}"'
        for c in ("Spend", "Visits", "Units", "SPV", "UPV", "SPU", "PCT_Spend", "PCT_Visits", "PCT_Units")
    ) + f" FROM (SELECT household_id, {RATIO_CELLS} FROM g JOIN tt USING (household_id))",
    "txn", g=BY_TENDER, tt=TXN_TOT))
def round_all(spark, sf):
    return A.round_all(kpi.agg_kpi_ratios(R.sales(spark, sf), "tender_type_group"))


THICK = ('SELECT household_id, CAST(sum(net_spend_amt) AS DOUBLE) AS "Total_Spend", count(DISTINCT '
         'transaction_uid) AS "Total_Visits", sum(unit) AS "Total_Units", ' + ", ".join(
             f"count(*) FILTER (WHERE app_year_qtr = 'Q{n}') AS q{n}" for n in (1, 2, 3, 4))
         + " FROM flagged GROUP BY 1")


@query("thick_flag", Q.with_(
    'SELECT household_id, CASE WHEN "Total_Spend" > 2000 AND "Total_Visits" >= 8 AND "Total_Units" >= 100 '
    'AND q1 > 0 AND q2 > 0 AND q3 > 0 AND q4 > 0 THEN 1 ELSE 0 END AS "THICK_FLAG" FROM t',
    "flagged", t=THICK))
def thick_flag(spark, sf):
    fact = recent(R.sales)(spark, sf)
    return A.thick_flag(
        kpi.agg_total(fact).join(S.agg_features(fact, S.quarter()), "household_id", "left")
    ).select("household_id", "THICK_FLAG")


@query("affluence_flag", Q.with_(
    f"SELECT household_id, period_id, CASE WHEN truprice_seg_desc IN ({Q.values(K.AFFLUENT_SEGMENTS)}) THEN "
    '1 ELSE 0 END AS "AFFLUENCE_UM", 0 AS "AFFLUENCE_LA" FROM priceseg', "priceseg"))
def affluence_flag(spark, sf):
    return A.affluence_flag(R.price_segments(spark, sf))


OLD_TIMELINE = Q.PARTS["timeline"][1].replace("FROM contacts", "FROM l")
GROUND_TRUTH = ("SELECT t.*, Bought_Status, Contact_Status, Reason_code, coalesce(truprice_seg_desc, "
    "'Unclassified') AS truprice_seg_desc, coalesce(facts_seg_desc, 'Unclassified') AS facts_seg_desc, "
    "coalesce(lifestage_seg_name, 'Unclassified') AS lifestage_seg_name, coalesce(lifecycle_name, "
    "'Unclassified') AS lifecycle_name, coalesce(pref_store_id, 'NA') AS pref_store_id, CASE WHEN "
    "coalesce(pref_store_format, 'NA') = 'missing' THEN 'NA' ELSE coalesce(pref_store_format, 'NA') END AS "
    "pref_store_format, coalesce(pref_store_region, 'NA') AS pref_store_region, CASE "
    "coalesce(pref_store_region, 'NA') WHEN 'BKK' THEN 'BKK' WHEN 'NA' THEN 'NA' ELSE 'UPC' END AS "
    "perf_store_area FROM tl t JOIN l USING (household_id) LEFT JOIN priceseg USING (household_id, period_id) "
    "LEFT JOIN factseg USING (household_id, week_id) LEFT JOIN stages USING (household_id, quarter_id) LEFT JOIN "
    "prefstore USING (household_id, period_id) LEFT JOIN cycle USING (household_id, week_id) "
    "WHERE household_id IN (SELECT household_id FROM known{consent}) AND day_regis <= 6 * 360 AND NOT EXISTS (SELECT 1 FROM traders x WHERE x.household_id = "
    "t.household_id AND x.quarter_id = t.quarter_id)")
CONSENT = (" WHERE golden_id IN (SELECT golden_id FROM accounts WHERE customer_id = golden_id AND customer_status = "
    "'Active' AND opted_in = 'true' AND do_not_call = 'false')")
GROUND_TRUTH_PARTS = (
    "oldfeedback", "numbers", "known", "accounts", "traders", "timeline", "priceseg", "factseg", "stages",
    "prefstore", "cycle")
CALLS = {
    "s": SETTLED.replace("FROM feedback", "FROM oldfeedback"), "res": RESOLVED.format(source="s"), "l": LATEST,
    "tl": OLD_TIMELINE}


def people(spark, sf) -> H.People:
    """Calls of January 2001, within the history of the orders."""
    calls = R.feedback(spark, sf, years_back=23)
    return H.People(
        [(calls.where(F.col("insurer_nm") == s.insurer_nm), s.date_format) for s in K.FEEDBACK_SOURCES.values()],
        R.customer_numbers(spark, sf), R.known_customers(spark, sf), R.customers(spark, sf), R.accounts(spark, sf),
        R.trader_snapshots(spark, sf), R.calendar(spark),
        (R.price_segments(spark, sf), R.fact_segments(spark, sf), R.life_stages(spark, sf),
         R.preferred_stores(spark, sf),
         lifecycle_shift(R.lifecycle_history(spark, sf), R.lifecycle_names(spark), R.calendar(spark))))


GROUND_COLUMNS = (
    "household_id", "first_contact_date", "last_card_issue_date", "week_id", "quarter_id", "period_id",
    "card_aging_day", "day_regis", *[f"r{n}_start_date" for n in K.RECENCY_DAYS], "Bought_Status",
    "Contact_Status", "Reason_code", "truprice_seg_desc", "facts_seg_desc", "lifestage_seg_name",
    "lifecycle_name", "pref_store_id", "pref_store_format", "pref_store_region", "perf_store_area")


@query("ground_truth", Q.with_(GROUND_TRUTH.format(consent=CONSENT), *GROUND_TRUTH_PARTS, **CALLS))
def ground_truth(spark, sf):
    return H.ground_truth(people(spark, sf), R.HISTORY.end, years=6).select(*GROUND_COLUMNS)


def _contacted_sql() -> str:
    visits, sales, units = "count(DISTINCT transaction_uid){}", "CAST(sum(net_spend_amt){} AS DOUBLE)", "sum(unit){}"
    part = lambda m, test: m.format(f" FILTER (WHERE {test})")
    share = lambda m, test: f"coalesce(CAST({part(m, test)} AS DOUBLE), 0) / {m.format('')}"
    cells = [f"{m.format('')} AS total_{w}_360_days" for m, w in ((sales, "sales"), (units, "units"), (visits, "visits"))]
    cells += [
        "CAST(sum(discount_amt) AS DOUBLE) / CAST(sum(net_spend_amt) AS DOUBLE) AS prop_promo_sales"]
    for tender, word in (("CASH", "cash"), ("CCARD", "card")):
        test = f"tender_type_group = '{tender}'"
        cells += [f"{share(visits, test)} AS prop_visit_by_{word}_360_days",
                  f"{share(sales, test)} AS prop_sales_by_{word}_360_days"]
    slots = [("part_of_day", v) for v in ("early_morning", "morning", "lunch", "afterlunch", "evening", "late_evening", "night")]
    slots += [("wk_end_wk_day", v) for v in ("Weekday", "Weekend")]
    slots += [("mission", v) for v in (
        "ConsumptionforToday", "Emergency", "ImmediateConsumption", "Others", "StockUp", "TopUp", "Weekly", "trader")]
    for column, value in slots:
        test = f"{column} = '{value}'"
        cells += [f'{share(visits, test)} AS "{value}_prop_visits_360_days"', f'{share(sales, test)} AS "{value}_prop_sales_360_days"']
    for group in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"):
        test = f"division_id = '{group}'"
        cells += [f'{share(m, test)} AS "{group}_prop_{w}"' for m, w in ((sales, "sales"), (units, "units"), (visits, "visits"))]
    channels = {"online_all": "channel = 'ONLINE'", "offline_hde": "channel = 'OFFLINE' AND store_format = 'HDE'",
                "offline_gofresh": "channel = 'OFFLINE' AND store_format = 'GoFresh'"}
    for name, test in channels.items():
        for n in (360, 180, 90, 30):
            cells += [f"coalesce({part(m, f'{test} AND age <= {n}')}, 0) AS {name}_{w}_{n}_days"
                      for m, w in ((sales, "sales"), (units, "units"), (visits, "visits"))]
    card = [part(visits, f"store_format = 'HDE' AND tender_type_group = '{t}'") for t in ("CASH", "CCARD")]
    cells.append(f"CASE WHEN {card[1]} > 0 AND ({card[1]})::DOUBLE / ({card[0]} + {card[1]}) >= 0.2 THEN 'credit' "
                 "ELSE 'cash' END AS cash_card_customer_flag")
    near = ("SELECT txn.*, date_diff('day', date_id, first_contact_date) AS age, ['ConsumptionforToday', 'Emergency', "
            "'ImmediateConsumption', 'Others', 'StockUp', 'TopUp', 'Weekly', 'trader'][m.shopping_missions_id + 1] AS "
            "mission FROM txn JOIN d USING (household_id) LEFT JOIN missions m ON m.transaction_concat = "
            f"concat(txn.transaction_uid, store_id, date_id) AND m.week_id = {Q.week_id('date_id')} "
            "WHERE date_id BETWEEN first_contact_date - 360 AND first_contact_date")
    return Q.with_(
        "SELECT household_id, a.* EXCLUDE (household_id), Bought_Status, Contact_Status, card_aging_day, "
        "truprice_seg_desc, facts_seg_desc, lifestage_seg_name, lifecycle_name FROM (SELECT household_id, "
        + ", ".join(cells) + " FROM f GROUP BY 1) a JOIN d USING (household_id) "
        "WHERE coalesce(Reason_code, Bought_Status) <> 'U'",
        "txn", "missions", *GROUND_TRUTH_PARTS, **CALLS, d=GROUND_TRUTH.format(consent=""), r=near, f=FINE_PARTS.replace("FROM etxn", "FROM r"))


@query("assemble_contacted", _contacted_sql())
def assemble_contacted(spark, sf):
    # everyone agrees here: few of the test tables' callers are left otherwise
    agreed = {"customer_id": F.col("golden_id"), "customer_status": F.lit("Active"), "opted_in": F.lit("true"), "do_not_call": F.lit("false")}
    called = replace(people(spark, sf), accounts=R.accounts(spark, sf).withColumns(agreed))
    details = staged(H.ground_truth(called, R.HISTORY.end, years=6), "ground-truth")
    # the households called are few: their baskets and lines come first, so that the whole fact moves nowhere
    headers = staged(join_scope_households(R.baskets(spark, sf), details), "contacted-baskets")
    key = F.concat(*[F.col(c).cast("string") for c in ("transaction_uid", "store_id", "date_id")])
    lines = R.txn(spark, sf, headers).withColumns({"transaction_concat": key, "product_group": F.col("division_id")})
    lines = staged(join_inner_dim(lines, R.calendar(spark)), "contacted-lines")
    code = F.xxhash64("transaction_concat")
    wanted = join_semi_exists(
        R.missions(spark, sf).withColumn("code", code), lines.select(code.alias("code")).distinct(), "code")
    scope = shopping_mission_scope(wanted, R.HISTORY.start_week, R.HISTORY.end_week)
    names = F.array(*[F.lit(m) for m in K.MISSIONS])
    missions = scope.select("transaction_concat", "week_id", names[F.col("shopping_missions_id")].alias("mission"))
    fact = lines.join(missions, ["transaction_concat", "week_id"], "left")
    return H.contact_features(details, fact, R.DIVISIONS)


# --- model table --------------------------------------------------------------------------


def model_table(spark, sf) -> DataFrame:
    """Totals of each household with its segment, a probability and the known outcome."""
    spend = F.col("Total_Spend")
    return (
        kpi.agg_total(R.sales(spark, sf))
        .join(R.customers(spark, sf).select("household_id", "segment", "balance"), "household_id")
        .join(R.household_target(spark, sf), "household_id")
        .withColumn("probability", spend / (spend + 1000000))
    )


MODEL = ('SELECT household_id, ts AS "Total_Spend", tv AS "Total_Visits", tu AS "Total_Units", segment, balance, '
         "Bought_Status, ts / (ts + 1000000) AS probability, CASE WHEN Bought_Status = 'Bought' THEN 1 ELSE "
         "0 END AS target FROM tt JOIN customers USING (household_id) JOIN target USING (household_id)")


def model_sql(body: str, **extra: str) -> str:
    return Q.with_(body, "txn", "customers", "target", tt=TXN_TOT, m=MODEL, **extra)


@query("cast_decimals", Q.with_(
    "SELECT transaction_uid, upc_id, store_id, CAST(net_spend_amt AS DOUBLE) AS net_spend_amt, "
    "CAST(discount_amt AS DOUBLE) AS discount_amt, unit FROM items", "items"))
def cast_decimals(spark, sf):
    return D.cast_decimals(R.items(spark, sf))


@query("subset_by_segment", model_sql("SELECT * EXCLUDE (target) FROM m WHERE segment = 'BUILDING'"))
def subset_by_segment(spark, sf):
    return D.subset_by_segment(model_table(spark, sf), "BUILDING", "segment")


MODEL_NAMES = {
    "CAT_L21_03_SPEND": ("3", "Spend"), "PCT_CAT_L21_48_UNITS": ("48", "PCT_Units"),
    "CAT_L21_10&20_UPV": ("10&20", "UPV"), "PCT_CAT_L21_07_SPEND": ("7", "PCT_Spend"),
}


@query("map_feature_names", Q.with_(
    "SELECT household_id, " + ", ".join(
        f"coalesce(max(\"{k}\") FILTER (WHERE d = '{v}'), 0) AS \"{n}\"" for n, (v, k) in MODEL_NAMES.items()
    ) + f" FROM (SELECT household_id, d, {RATIO_CELLS} FROM g JOIN tot USING (household_id)) GROUP BY 1",
    "flagged", "tot", g="SELECT household_id, grouped_section_code AS d, CAST(sum(net_spend_amt) AS DOUBLE) AS "
    "s, count(DISTINCT transaction_uid) AS n, sum(unit) AS u FROM flagged WHERE grouped_section_code NOT IN "
    "('49', '50') GROUP BY ALL"))
def map_feature_names(spark, sf):
    wide_sections = S.agg_features(grouped(spark, sf), S.section(SECTIONS, R.SECTION_EXCLUDE))
    return D.map_feature_names(wide_sections, MODEL_NAMES)


REQUIRED = tuple(f"CAT_SEC_%{n}%_SPEND" for n in (7, 13, 48, 49, 50, 51, "10&20", 10))


@query("missing_features", Q.with_(
    f"SELECT unnest([{Q.values(REQUIRED)}]) AS feature EXCEPT SELECT 'CAT_SEC_%' || grouped_section_code || "
    "'%_SPEND' FROM flagged WHERE grouped_section_code NOT IN ('49', '50')", "flagged"))
def missing_features(spark, sf):
    label = S.section(SECTIONS, R.SECTION_EXCLUDE).label()
    long = kpi.kpi_long(grouped(spark, sf), {"SEC": label}, with_total=False)
    return D.missing_features(D.feature_names(long, {"SEC": "SEC"}), REQUIRED)


NULLABLE = ("change_type", "state_desc", "promo_storegroup_id", "store_id", "upc_id_cond", "upc_id_reward")


@query("missing_value_profile", Q.with_(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_values, "
        + Q.rnd(f"(count(*) - count({c})) * 100 / count(*)::DOUBLE") + " AS pct_missing FROM promos"
        for c in NULLABLE), "promos"))
def missing_value_profile(spark, sf):
    return D.missing_value_profile(R.promotions(spark, sf))


@query("fill_sentinel", Q.with_(
    "SELECT upc_id, coalesce(store_id, -999999) AS store_id, coalesce(upc_id_cond, -9999999) AS upc_id_cond, "
    "upc_id_reward FROM promos", "promos"))
def fill_sentinel(spark, sf):
    promos = R.promotions(spark, sf).select("upc_id", "store_id", "upc_id_cond", "upc_id_reward")
    credit = D.fill_sentinel(promos, K.CREDIT_SENTINEL, ["store_id"])
    return D.fill_sentinel(credit, K.INCOME_SENTINEL, ["upc_id_cond"])


TRAINED = ("Total_Units", "NEW_FEATURE", "Total_Spend", "CAT_L22_0101_SPEND")


@query("pad_columns", model_sql(
    'SELECT household_id, "Total_Units", 0 AS "NEW_FEATURE", "Total_Spend", 0 AS "CAT_L22_0101_SPEND" FROM m'))
def pad_columns(spark, sf):
    return D.pad_columns(model_table(spark, sf), TRAINED, ("household_id",))


@query("label_encode", Q.with_(
    "SELECT c_custkey, c_mktsegment, n_name, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS "
    "c_mktsegment_code, dense_rank() OVER (ORDER BY n_name) - 1 AS n_name_code FROM customer JOIN nation ON "
    "c_nationkey = n_nationkey"))
def label_encode(spark, sf):
    people = R.table(spark, sf, "customer").join(
        R.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_mktsegment", "n_name")
    people = staged(people, "people")  # a lookup of codes for each column reads it again
    return D.label_encode(people, ["c_mktsegment", "n_name"])


SEGMENT_VALUES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("one_hot", model_sql(
    "SELECT household_id, \"Total_Visits\", " + ", ".join(
        f"CASE WHEN segment = '{v}' THEN 1 ELSE 0 END AS seg_{v}" for v in SEGMENT_VALUES)
    + ", CASE WHEN Bought_Status = 'Not Bought' THEN 1 ELSE 0 END AS status_Not_Bought"
    + ", CASE WHEN Bought_Status = 'Bought' THEN 1 ELSE 0 END AS status_Bought FROM m"))
def one_hot(spark, sf):
    table = model_table(spark, sf).select(
        "household_id", "Total_Visits", "segment", "Bought_Status"
    )
    table = staged(table, "one-hot")
    return D.one_hot(table, {
        "segment": ("seg", kpi.pivot_values(table, "segment")),
        "Bought_Status": ("status", kpi.pivot_values(table, "Bought_Status")),
    })


@query("label_binary", model_sql("SELECT household_id, Bought_Status, target FROM m"))
def label_binary(spark, sf):
    return D.label_binary(R.household_target(spark, sf).join(
        kpi.agg_total(R.sales(spark, sf)).select("household_id"), "household_id"
    ))


def labelled(spark, sf) -> DataFrame:
    """The model table, computed once for all that read it in one plan."""
    return staged(D.label_binary(model_table(spark, sf)), "model-table")


@query("class_weights", model_sql(
    "SELECT household_id, target, CAST(n AS DOUBLE) / (2.0::DOUBLE * CASE WHEN target = 1 THEN p ELSE n - p "
    "END) AS weight FROM m, (SELECT count(*) AS n, count(*) FILTER (WHERE target = 1) AS p FROM m)"))
def class_weights(spark, sf):
    return D.class_weights(labelled(spark, sf)).select("household_id", "target", "weight")


@query("split_stratified")
def split_stratified(spark, sf):
    return D.split_stratified(
        labelled(spark, sf).select("household_id", "target"), "target", "household_id"
    )


EDGES = (500000.0, 900000.0, 1300000.0, 1700000.0)
BIN = "(" + " + ".join(f"CASE WHEN \"Total_Spend\" >= {e} THEN 1 ELSE 0 END" for e in EDGES) + ")"


@query("woe_apply", model_sql(
    f"SELECT household_id, {Q.rnd('woe', 6)} AS woe FROM m JOIN b ON b.bin = {BIN}",
    b=f"SELECT bin, ln((CASE WHEN p = 0 THEN 0.9 ELSE p END::DOUBLE / sum(p) OVER ()) / (CASE WHEN n = 0 "
      "THEN 0.9 ELSE n END::DOUBLE / sum(n) OVER ())) AS woe FROM (SELECT "
      f"{BIN} AS bin, count(*) FILTER (WHERE target = 1) AS p, count(*) FILTER (WHERE target = 0) AS n FROM m "
      "GROUP BY 1)"))
def woe_apply(spark, sf):
    table = labelled(spark, sf)
    bins = D.woe_bins(table, "Total_Spend", "target", EDGES)
    return D.woe_apply(table, bins, "Total_Spend", EDGES).select(
        "household_id", F.round("Total_Spend_woe", 6).alias("woe")
    )


ADJUSTED = "probability * 1.7889::DOUBLE / (1.0::DOUBLE + probability * (1.7889::DOUBLE - 1.0::DOUBLE))"


@query("posterior_adjust", model_sql(
    f"SELECT household_id, {Q.rnd(ADJUSTED, 8)} AS adjusted FROM m"))
def posterior_adjust(spark, sf):
    return X.posterior_adjust(model_table(spark, sf)).select(
        "household_id", F.round("adjusted", 8).alias("adjusted")
    )


@query("score_points", model_sql(
    f"SELECT household_id, {Q.rnd('497 + 46 / ln(2.0::DOUBLE) * ln((1 - probability) / probability)', 6)} "
    "AS score FROM m"))
def score_points(spark, sf):
    return X.score_points(model_table(spark, sf)).select(
        "household_id", F.round("score", 6).alias("score")
    )


@query("eval_metrics", model_sql(
    f"""SELECT {Q.rnd('(tp / p + 1 - fp / n) / 2', 6)} AS balanced_accuracy,
      {Q.rnd('auc', 6)} AS roc_auc, {Q.rnd('tp / p', 6)} AS recall,
      {Q.rnd('2 * tp / (tp + fp + p)', 6)} AS f1, {Q.rnd('ap', 6)} AS average_precision
    FROM (SELECT count(*) FILTER (WHERE target = 1 AND probability >= 0.5)::DOUBLE AS tp,
        count(*) FILTER (WHERE target = 0 AND probability >= 0.5)::DOUBLE AS fp,
        count(*) FILTER (WHERE target = 1)::DOUBLE AS p, count(*) FILTER (WHERE target = 0)::DOUBLE AS n
      FROM m),
    (SELECT (sum(r) FILTER (WHERE target = 1) - count(*) FILTER (WHERE target = 1)
        * (count(*) FILTER (WHERE target = 1) + 1) / 2.0) / (count(*) FILTER (WHERE target = 1)::DOUBLE
        * count(*) FILTER (WHERE target = 0)) AS auc
      FROM (SELECT target, rank() OVER (ORDER BY probability)
        + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS r FROM m)),
    (SELECT sum(pos * cp / ca) / sum(pos) AS ap FROM (SELECT pos,
        sum(pos) OVER (ORDER BY probability DESC)::DOUBLE AS cp,
        sum(a) OVER (ORDER BY probability DESC)::DOUBLE AS ca
      FROM (SELECT probability, count(*) FILTER (WHERE target = 1) AS pos, count(*) AS a FROM m
        GROUP BY 1)))"""))
def eval_metrics(spark, sf):
    return X.eval_metrics(labelled(spark, sf))


CARD = "0.7 * SPEND_woe + 0.02 * VISITS + 0.0001 * balance - 0.5 * NEW_FEATURE"
LOGIT = "0.7::DOUBLE * woe + 0.02::DOUBLE * \"Total_Visits\" + 0.0001::DOUBLE * balance"


@query("score_pipeline", model_sql(
    f"SELECT household_id, {Q.rnd('pp', 8)} AS probability, "
    f"{Q.rnd('497 + 46 / ln(2.0::DOUBLE) * ln((1 - pp) / pp)', 6)} AS score FROM (SELECT household_id, "
    f"{ADJUSTED.replace('probability', 'q')} AS pp FROM (SELECT household_id, 1 / (1 + exp(-({LOGIT}))) AS q "
    f"FROM m JOIN b ON b.bin = {BIN} WHERE segment = 'BUILDING'))",
    b=f"SELECT bin, ln((CASE WHEN p = 0 THEN 0.9 ELSE p END::DOUBLE / sum(p) OVER ()) / (CASE WHEN n = 0 "
      "THEN 0.9 ELSE n END::DOUBLE / sum(n) OVER ())) AS woe FROM (SELECT "
      f"{BIN} AS bin, count(*) FILTER (WHERE target = 1) AS p, count(*) FILTER (WHERE target = 0) AS n FROM m "
      "GROUP BY 1)"))
def score_pipeline(spark, sf):
    """A scorecard on weights of evidence, saved, loaded and applied to one segment."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    table = labelled(spark, sf)
    spec = L.woe_spec(D.woe_bins(table, "Total_Spend", "target", EDGES), EDGES)
    path = scratch_path(spark, "scorecard")
    L.save_model(PipelineModel(stages=[
        *L.prepared(("SPEND", "VISITS", "balance", "NEW_FEATURE"), ("household_id",), absent=L.ZERO),
        L.WoeColumns(bins={"SPEND": spec}),
        SQLTransformer(statement=f"SELECT *, 1 / (1 + exp(-({CARD}))) AS p FROM __THIS__"),
        L.points_stage("p"),
    ]), path)
    scored = L.score(L.load_model(path), table.drop("probability"), "BUILDING", "segment")
    return scored.select(
        "household_id", F.round("Probability", 8).alias("probability"), F.round("Score", 6).alias("score"))


FEATURES = ("Total_Spend", "Total_Visits", "Total_Units", "balance")


def scored_split(spark, sf):
    """Fitted forest and the split table; the split is cut from its lineage, as both read it."""
    ensure_checkpoint_dir(spark)
    table = D.split_stratified(labelled(spark, sf), "target", "household_id")
    table = table.drop("probability").checkpoint()
    train = D.class_weights(table.where(F.col("split") == "train"))
    return X.train_classifier(train, FEATURES), table


@query("train_classifier")
def train_classifier(spark, sf):
    model, table = scored_split(spark, sf)
    held_out = table.where(F.col("split") != "train")
    scored = X.score_table(model, held_out, offset=None, keep=("target",))
    return X.eval_metrics(scored, probability="Probability")


@query("score_table")
def score_table(spark, sf):
    model, table = scored_split(spark, sf)
    return X.score_table(model, table)
