"""Common table expressions of the check SQL: the roles of ``sources.roles``, said in SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from basketlens.operators.kpi import ALL, TOTAL, Feature
from basketlens.sources.roles import HISTORY

START, END = f"DATE '{HISTORY.start}'", f"DATE '{HISTORY.end}'"
END_MONTH = HISTORY.end.year * 12 + HISTORY.end.month
RECENCY_SQL = {"L3": "last_3_flag = 'Y'", "L6": "last_6_flag = 'Y'", "L9": "last_9_flag = 'Y'"}


def week_id(d: str) -> str:
    return f"CAST(isoyear({d}) * 100 + week({d}) AS INTEGER)"


def month_id(d: str) -> str:
    return f"CAST(year({d}) * 100 + month({d}) AS INTEGER)"


def quarter_id(d: str) -> str:
    return f"CAST(year({d}) * 100 + quarter({d}) AS INTEGER)"


def rnd(x: str, digits: int = 2) -> str:
    """Round half away from zero on exact decimals, as a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, {digits + 8})), {digits}) AS DOUBLE)"


def ratio(top: str, bottom: str) -> str:
    return f"coalesce(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0), 0)"


def pct(part: str, total: str) -> str:
    return f"coalesce(CAST({part} * 100 AS DOUBLE) / nullif(CAST({total} AS DOUBLE), 0), 0)"


def values(items: Iterable[str]) -> str:
    return ", ".join(f"'{v}'" for v in items)


TIME_OF_DAY = """CASE WHEN h BETWEEN 5 AND 8 THEN 'prework' WHEN h BETWEEN 9 AND 11 THEN 'morning'
  WHEN h = 12 THEN 'lunch' WHEN h BETWEEN 13 AND 17 THEN 'afternoon'
  WHEN h BETWEEN 18 AND 20 THEN 'evening' WHEN h >= 21 THEN 'late' WHEN h <= 4 THEN 'night'
  ELSE 'def' END"""

TENDER = """CASE o_orderpriority WHEN '1-URGENT' THEN 'CASH' WHEN '2-HIGH' THEN 'CCARD'
  WHEN '3-MEDIUM' THEN 'COUPON' WHEN '4-NOT SPECIFIED' THEN 'VOUCH' ELSE 'OTHER' END"""

# name -> (names it builds on, body)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "cal": ((), f"""
        SELECT d AS date_id, {week_id('d')} AS week_id, {month_id('d')} AS month_id,
          {month_id('d')} AS period_id, {quarter_id('d')} AS quarter_id, year(d) AS year_id,
          isodow(d) AS weekday_nbr, day(d) AS day_in_month_nbr, dayofyear(d) AS day_in_year_nbr,
          date_diff('day', DATE '1970-01-01', d) AS day_num_sequence,
          CAST(floor(date_diff('day', DATE '1970-01-05', d) / 7.0) AS INTEGER) AS week_num_sequence,
          {week_id('d')} AS promoweek_id
        FROM (SELECT CAST(g AS DATE) AS d FROM
          generate_series({START}, {END}, INTERVAL 1 DAY) s(g))"""),
    "weeks": (("cal",), """
        SELECT week_id, lag(week_id) OVER (ORDER BY week_id) AS lag_week_id,
          lead(week_id) OVER (ORDER BY week_id) AS lead_week_id
        FROM (SELECT DISTINCT week_id FROM cal)"""),
    "xmas": (("cal", "weeks"), """
        SELECT x.w FROM (SELECT max(week_id) AS m FROM cal
          WHERE month_id % 100 = 12 AND week_id // 100 = month_id // 100) t
        JOIN weeks ON week_id = m, unnest([week_id, lag_week_id, lead_week_id]) AS x(w)"""),
    "lastsat": (("cal",), """
        SELECT max(date_id) AS s FROM cal WHERE weekday_nbr = 6 GROUP BY month_id"""),
    "lastwk": (("lastsat",), """
        SELECT DISTINCT CAST(s + o AS DATE) AS date_id FROM lastsat, (VALUES (-1), (0), (1)) v(o)"""),
    "products": ((), """
        SELECT p_partkey AS upc_id, p_type AS division_id, p_brand AS department_code,
          CAST(p_size AS VARCHAR) AS section_code, p_brand || '_' || p_size AS class_code,
          p_name AS subclass_code, p_name AS subclass_name FROM part"""),
    "stores": ((), """
        SELECT s_suppkey AS store_id, CAST(s_suppkey % 6 + 1 AS INTEGER) AS format_id,
          CASE s_suppkey % 3 WHEN 0 THEN 'HDE' WHEN 1 THEN 'Talad' ELSE 'GoFresh' END AS store_format,
          s_nationkey AS zone_id, r_name AS store_region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey"""),
    "baskets": ((), f"""
        SELECT o_orderkey AS transaction_uid, o_custkey AS household_id,
          CAST(o_orderdate AS DATE) AS date_id,
          o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS tran_datetime,
          CASE WHEN o_orderstatus = 'P' THEN 'ONLINE' ELSE 'OFFLINE' END AS channel,
          {TENDER} AS tender_type_group,
          CAST(o_totalprice AS DECIMAL(18, 4)) AS basket_amt FROM orders"""),
    "items": ((), """
        SELECT l_orderkey AS transaction_uid, l_partkey AS upc_id, l_suppkey AS store_id,
          CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)) AS net_spend_amt,
          CAST(l_extendedprice * l_discount AS DECIMAL(18, 4)) AS discount_amt,
          l_quantity AS unit FROM lineitem"""),
    "txn": (("items", "baskets", "products", "stores"), """
        SELECT * FROM items JOIN baskets USING (transaction_uid) JOIN products USING (upc_id)
        JOIN stores USING (store_id)"""),
    "etxn": ((), """
        SELECT user_id AS household_id, user_id || '-' || strftime(ts, '%Y%m%d%H') AS transaction_uid,
          CAST(ts AS DATE) AS date_id, ts AS tran_datetime,
          CAST(value AS DECIMAL(18, 4)) AS net_spend_amt, 1.0::DOUBLE AS unit, event_type
        FROM events"""),
    "till": ((), """
        SELECT l_orderkey AS transaction_uid, l_suppkey AS store_id,
          CAST(o_orderdate AS DATE) AS date_id,
          CASE WHEN l_returnflag = 'R' THEN ' CASH'
            WHEN l_returnflag = 'A' AND l_linenumber <= 4 THEN 'CCARD '
            WHEN l_returnflag = 'A' THEN 'COUPON' WHEN l_linenumber <= 4 THEN 'VOUCH' END
            AS tender_type_group
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "tillone": (("till",), """
        SELECT transaction_uid, store_id, date_id,
          CASE WHEN count(DISTINCT trim(tender_type_group)) = 1 THEN max(trim(tender_type_group))
            ELSE 'MULTI' END AS sngl_tndr_type
        FROM till GROUP BY ALL"""),
    "online": ((), """
        SELECT o_orderkey AS transaction_uid, CASE o_orderpriority WHEN '1-URGENT' THEN 'CASH'
          WHEN '2-HIGH' THEN 'CreditCard' ELSE 'Wallet' END AS tender_type_group
        FROM orders WHERE o_orderstatus = 'P'"""),
    "customers": ((), """
        SELECT c_custkey AS household_id, 'G' || c_custkey AS golden_id, c_mktsegment AS segment,
          c_acctbal AS balance, CASE WHEN c_custkey % 7 <> 0 THEN f END AS card_issue_date
        FROM customer LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS f
          FROM orders GROUP BY 1) ON o_custkey = c_custkey"""),
    "firsttxn": ((), """
        SELECT 'G' || o_custkey AS golden_id, min(CAST(o_orderdate AS DATE)) AS first_txn_date
        FROM orders GROUP BY 1"""),
    "tenure": (("customers", "firsttxn"), """
        SELECT household_id, max(coalesce(card_issue_date, first_txn_date)) AS card_issue_date,
          min(first_txn_date) AS first_txn_date
        FROM customers LEFT JOIN firsttxn USING (golden_id) GROUP BY 1"""),
    "traders": (("baskets",), f"""
        SELECT household_id, {quarter_id('date_id')} AS quarter_id FROM baskets
        GROUP BY ALL HAVING count(*) >= 4"""),
    "contacts": (("baskets",), """
        SELECT household_id,
          CAST(max(date_id) + CAST(household_id % 2 * 20 AS INTEGER) AS DATE) AS first_contact_date
        FROM baskets GROUP BY 1"""),
    "accounts": ((), """
        SELECT CASE WHEN c_custkey % 9 <> 0 THEN 'G' || c_custkey ELSE 'merged' END AS customer_id,
          'G' || c_custkey AS golden_id,
          CASE WHEN c_acctbal >= 0 THEN 'Active' ELSE 'Closed' END AS customer_status,
          CASE WHEN c_custkey % 4 <> 0 THEN 'true' ELSE 'false' END AS opted_in,
          CASE WHEN c_custkey % 6 = 0 THEN 'true' ELSE 'false' END AS do_not_call FROM customer"""),
    "numbers": ((), """
        SELECT CAST(c_custkey + 5 AS VARCHAR) AS ngc_customer_id, 'G' || c_custkey AS golden_id
        FROM customer WHERE c_custkey % 3 = 0"""),
    "known": ((), """
        SELECT c_custkey AS household_id, 'G' || c_custkey AS golden_id FROM customer
        WHERE c_custkey % 2 = 0"""),
    "priceseg": (("baskets",), f"""
        SELECT household_id, {month_id('date_id')} AS period_id,
          CASE WHEN sum(basket_amt) > 400000 THEN 'Most Price Insensitive'
            WHEN sum(basket_amt) > 250000 THEN 'Price Insensitive'
            WHEN sum(basket_amt) > 100000 THEN 'Price Neutral' ELSE 'Price Sensitive' END
            AS truprice_seg_desc FROM baskets GROUP BY ALL"""),
    "factseg": (("baskets",), f"""
        SELECT household_id, {week_id('date_id')} AS week_id,
          CASE WHEN count(*) > 1 THEN 'Frequent' ELSE 'Light' END AS facts_seg_desc
        FROM baskets GROUP BY ALL"""),
    "stages": (("baskets",), f"""
        SELECT household_id, {quarter_id('date_id')} AS quarter_id,
          CASE WHEN count(*) > 1 THEN 'Family' ELSE 'Single' END AS lifestage_seg_name
        FROM baskets GROUP BY ALL"""),
    "prefstore": (("baskets",), f"""
        SELECT household_id, {month_id('date_id')} AS period_id,
          CAST(max(transaction_uid) % 100 AS VARCHAR) AS pref_store_id,
          CASE WHEN max(transaction_uid) % 3 = 0 THEN 'missing' ELSE 'HDE' END AS pref_store_format,
          CASE max(transaction_uid) % 4 WHEN 0 THEN 'BKK' WHEN 1 THEN 'NORTH' END AS pref_store_region
        FROM baskets GROUP BY ALL"""),
    "cyclehist": (("baskets",), f"""
        SELECT household_id, {week_id('date_id')} AS week_id,
          CAST(max(transaction_uid) % 3 AS INTEGER) AS lifecycle_detailed_code
        FROM baskets GROUP BY ALL"""),
    "nextweek": (("cal",), """
        SELECT a.week_id, b.week_id AS next_week_id
        FROM (SELECT DISTINCT week_id, week_num_sequence AS n FROM cal) a
        JOIN (SELECT DISTINCT week_id, week_num_sequence AS n FROM cal) b ON b.n = a.n + 1"""),
    "cycle": (("cyclehist", "nextweek"), """
        SELECT household_id, name AS lifecycle_name, next_week_id AS week_id
        FROM cyclehist JOIN (VALUES (0, 'New'), (1, 'Growing')) m(code, name)
          ON lifecycle_detailed_code = code JOIN nextweek USING (week_id)"""),
    "timeline": (("contacts", "customers", "cal"), f"""
        SELECT household_id, first_contact_date, issued AS last_card_issue_date, week_id,
          quarter_id, period_id, date_diff('day', issued, first_contact_date) AS card_aging_day,
          date_diff('day', issued, {END}) AS day_regis,
          {", ".join(f"CAST(first_contact_date - {n} AS DATE) AS r{n}_start_date" for n in (30, 90, 180, 360))}
        FROM contacts LEFT JOIN (SELECT household_id, max(card_issue_date) AS issued FROM customers
          GROUP BY 1) USING (household_id) JOIN cal ON date_id = first_contact_date
        WHERE date_diff('day', issued, first_contact_date) >= 0"""),
    "storebask": (("items", "baskets"), f"""
        SELECT household_id, upc_id, net_spend_amt, unit,
          concat_ws('_', transaction_uid, store_id, date_id) AS transaction_uid,
          concat(transaction_uid, store_id, date_id) AS transaction_concat,
          {week_id('date_id')} AS week_id FROM items JOIN baskets USING (transaction_uid)"""),
    "missions": (("items", "baskets"), f"""
        SELECT DISTINCT concat(transaction_uid, store_id, date_id) AS transaction_concat,
          CAST(transaction_uid AS VARCHAR) AS transaction_uid,
          CAST(transaction_uid % 8 AS INTEGER) AS shopping_missions_id, {week_id('date_id')} AS week_id
        FROM items JOIN baskets USING (transaction_uid) WHERE store_id % 5 <> 0"""),
    "promos": ((), f"""
        SELECT p_partkey AS promo_id, CAST(p_size % 6 + 1 AS INTEGER) AS promo_offer_id,
          CASE WHEN p_size % 10 <> 0 THEN 'PRICE' END AS change_type,
          CASE WHEN p_size % 5 = 0 THEN 'Cancelled' WHEN p_size % 5 <> 1 THEN 'Live' END AS state_desc,
          CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'Y' ELSE 'N' END AS active_flag,
          CAST({START} + CAST(p_partkey * 37 % {HISTORY.days - 40} AS INTEGER) AS DATE) AS promo_start_date,
          CAST({START} + CAST(p_partkey * 37 % {HISTORY.days - 40} AS INTEGER)
            + CASE WHEN p_size % 13 = 0 THEN -1 ELSE 29 END AS DATE) AS promo_end_date,
          CASE WHEN p_size % 4 <> 0 THEN p_partkey % 25 END AS promo_storegroup_id,
          CASE WHEN p_size % 4 = 0 THEN p_partkey % 10 END AS store_id,
          p_partkey AS upc_id, CASE WHEN p_size % 3 = 0 THEN p_partkey + 1 END AS upc_id_cond,
          CASE WHEN p_size % 3 <> 0 THEN p_partkey END AS upc_id_reward,
          CASE WHEN p_partkey % 2 = 0 THEN 'rms12' ELSE 'rms19' END AS source
        FROM part"""),
    "zones": ((), """
        SELECT CAST(s_nationkey AS BIGINT) AS zone_id, s_suppkey AS store_id, source
        FROM supplier, (VALUES ('rms12'), ('rms19')) v(source)"""),
    "promoranges": (("promos", "zones", "stores"), """
        SELECT DISTINCT p.upc_id, z.store_id, p.promo_start_date AS s, p.promo_end_date AS e,
          CASE WHEN format_id = 5 THEN 'GOFRESH' WHEN format_id = 4 THEN 'TALAD' ELSE 'HDE' END
            AS store_format_name
        FROM promos p JOIN zones z ON z.zone_id = p.promo_storegroup_id
        JOIN stores st ON st.store_id = z.store_id
        WHERE active_flag = 'Y' AND change_type IS NOT NULL AND format_id IN (1, 2, 3, 4, 5)"""),
    "feedback": ((), """
        SELECT event_id AS feedback_id,
          CASE WHEN event_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS dib_cust_code,
          CASE WHEN event_type = 'purchase' THEN 'Bought' ELSE 'Not Bought' END AS Bought_Status,
          CASE WHEN event_type = 'click' THEN 'CONTACT' WHEN event_type IN ('view', 'purchase')
            THEN 'Contactable' WHEN event_type = 'error' THEN 'Uncontactable' ELSE 'Pending' END
            AS Contact_Status,
          CASE WHEN event_type = 'error' THEN 'U' WHEN event_type <> 'view' THEN event_type END
            AS Reason_code,
          CASE WHEN event_id % 13 = 0 THEN 'n/a' WHEN event_id % 2 = 0
            THEN strftime(ts, '%m/%-d/%Y') ELSE strftime(ts, '%Y-%m-%d') END AS First_Call_Date,
          CASE WHEN event_id % 2 = 0 THEN 'AAC' ELSE 'CIG' END AS insurer_nm,
          'lot_' || strftime(ts, '%Y%m%d') || '.txt' AS src_file
        FROM events"""),
    "oldfeedback": (("feedback",), """
        SELECT * REPLACE (CASE WHEN First_Call_Date <> 'n/a' THEN replace(First_Call_Date, '2024', '2001') ELSE
          'n/a' END AS First_Call_Date) FROM feedback"""),
    "target": ((), """
        SELECT c_custkey AS household_id, CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
          THEN 'Bought' ELSE 'Not Bought' END AS Bought_Status FROM customer"""),
    "flagged": (("txn", "cal", "xmas", "lastwk", "tillone", "online", "promoranges"), f"""
        SELECT t.*, {week_id('t.date_id')} AS week_id, {month_id('t.date_id')} AS month_id,
          {month_id('t.date_id')} AS period_id,
          {TIME_OF_DAY.replace('h ', 'hour(tran_datetime) ')} AS time_of_day,
          CASE WHEN day(t.date_id) <= 7 THEN 1 WHEN day(t.date_id) <= 14 THEN 2
            WHEN day(t.date_id) <= 21 THEN 3 ELSE 4 END AS week_of_month,
          CASE WHEN isodow(t.date_id) IN (6, 7) THEN 'Y' WHEN isodow(t.date_id) = 5
            AND hour(tran_datetime) >= 18 THEN 'Y' ELSE 'N' END AS weekend_flag,
          CASE WHEN {week_id('t.date_id')} IN (SELECT w FROM xmas) THEN 'XMAS'
            WHEN month(t.date_id) = 4 THEN 'APRIL' ELSE 'NONE' END AS fest_flag,
          CASE WHEN t.date_id IN (SELECT date_id FROM lastwk) THEN 'Y' ELSE 'N' END
            AS last_weekend_flag,
          last_day(t.date_id) AS end_month_date, mb AS months_from_end_date,
          CASE WHEN mb <= 3 THEN 'Y' ELSE 'N' END AS last_3_flag,
          CASE WHEN mb <= 6 THEN 'Y' ELSE 'N' END AS last_6_flag,
          CASE WHEN mb <= 9 THEN 'Y' ELSE 'N' END AS last_9_flag,
          CASE WHEN mb <= 3 THEN 'Q1' WHEN mb <= 6 THEN 'Q2' WHEN mb <= 9 THEN 'Q3' ELSE 'Q4' END
            AS app_year_qtr,
          CASE WHEN subclass_name ILIKE '%HOT%' AND subclass_name NOT ILIKE '%RING%' THEN 'PREMIUM'
            WHEN regexp_matches(subclass_name, '(?i)(small|old|bolt)') THEN 'BUDGET' ELSE 'NONE' END
            AS price_level,
          coalesce(tillone.sngl_tndr_type, 'Unidentified') AS till_payment_method,
          online.tender_type_group AS online_payment_method,
          CASE WHEN tillone.sngl_tndr_type = 'CASH' OR online.tender_type_group = 'CASH' THEN 'CASH'
            WHEN tillone.sngl_tndr_type = 'CCARD' OR online.tender_type_group = 'CreditCard' THEN 'CARD'
            WHEN tillone.sngl_tndr_type = 'COUPON' THEN 'COUPON'
            WHEN tillone.sngl_tndr_type = 'VOUCH' THEN 'VOUCHER' ELSE 'OTHER' END AS payment_flag,
          CASE WHEN department_code IN ('Brand#1', 'Brand#2') THEN 'Brand#1&Brand#2'
            ELSE department_code END AS grouped_department_code,
          CASE WHEN section_code IN ('1', '2') THEN '1&2' WHEN section_code IN ('10', '20')
            THEN '10&20' ELSE section_code END AS grouped_section_code,
          CASE WHEN on_promo THEN 'P' WHEN discount_amt > 0 THEN 'M' ELSE 'NONE' END
            AS discount_reason_code,
          CASE WHEN on_promo THEN 'PROMO' WHEN discount_amt > 0 THEN 'MARK_DOWN' ELSE 'NONE' END
            AS promo_flag
        FROM (SELECT *, {END_MONTH} - (year(date_id) * 12 + month(date_id)) + 1 AS mb,
            EXISTS (SELECT 1 FROM promoranges r WHERE r.upc_id = txn.upc_id
              AND r.store_id = txn.store_id AND txn.date_id BETWEEN r.s AND r.e) AS on_promo
          FROM txn) t
        LEFT JOIN tillone USING (transaction_uid, store_id, date_id)
        LEFT JOIN online USING (transaction_uid)"""),
    "tot": (("flagged",), """
        SELECT household_id, CAST(sum(net_spend_amt) AS DOUBLE) AS ts,
          count(DISTINCT transaction_uid) AS tv, sum(unit) AS tu FROM flagged GROUP BY 1"""),
}


def with_(body: str, *needs: str, **extra: tuple[Sequence[str], str] | str) -> str:
    """``WITH`` the needed parts, in order of what builds on what, around ``body``."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        for dep in PARTS[name][0]:
            add(dep)
        done[name] = PARTS[name][1]

    for name in needs:
        add(name)
    for name, sql in extra.items():
        done[name] = sql
    # The fact is worked out once, however many parts read it.
    ctes = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in ('flagged', 'long', 'wide') else ''}({sql})"
        for name, sql in done.items()
    )
    return f"WITH {ctes}\n{body}" if done else body


SECTION_EXCL = "grouped_section_code NOT IN ('49', '50')"
DEPARTMENT_EXCL = "grouped_department_code NOT IN ('Brand#24', 'Brand#25')"
LABELS: dict[str, str] = {
    TOTAL: f"'{ALL}'",
    "DIV": "division_id",
    "DEP": f"CASE WHEN {DEPARTMENT_EXCL} THEN grouped_department_code END",
    "SEC": f"CASE WHEN {SECTION_EXCL} THEN grouped_section_code END",
    "FEST": "fest_flag",
    "TIME": "time_of_day",
    "SF": "CASE store_format WHEN 'HDE' THEN 'Hypermarket' WHEN 'Talad' THEN 'Supermarket' "
          "ELSE 'MiniSupermarket' END",
    "SA": "store_region",
    "PRICE": "price_level",
    "PAY": "payment_flag",
    "PROMO": "promo_flag",
    "TIMEPROMO": "time_of_day || '_' || promo_flag",
    "LWPROMO": "CASE WHEN last_weekend_flag = 'Y' THEN promo_flag END",
    "QTR": "app_year_qtr",
    "WKND": "weekend_flag",
    "LW": "CASE WHEN last_weekend_flag = 'Y' THEN 'Y' END",
}


def long_sql(groups: Iterable[str], tags: Iterable[str], source: str = "flagged") -> str:
    """Long KPI table: each group a plain GROUP BY over the fact."""
    out = []
    for g in groups:
        cells = ["CAST(sum(net_spend_amt) AS DOUBLE) AS spend",
                 "count(DISTINCT transaction_uid) AS visits", "sum(unit) AS units"]
        for t in tags:
            f = f"FILTER (WHERE {RECENCY_SQL[t]})"
            cells += [f"CAST(sum(net_spend_amt) {f} AS DOUBLE) AS spend_{t}",
                      f"count(DISTINCT transaction_uid) {f} AS visits_{t}",
                      f"sum(unit) {f} AS units_{t}"]
        out.append(
            f"SELECT household_id, '{g}' AS g, {LABELS[g]} AS v, {', '.join(cells)} FROM {source} "
            f"WHERE ({LABELS[g]}) IS NOT NULL GROUP BY ALL"
        )
    return "\nUNION ALL\n".join(out)


def kpi_cells(feature: Feature, alias: str) -> list[str]:
    s, n, u = (f"{alias}_{m}" for m in ("s", "n", "u"))
    kpis: Mapping[str, str] = {
        "Spend": s, "Visits": n, "Units": u,
        "SPV": ratio(s, n), "UPV": ratio(u, n), "SPU": ratio(s, u),
        "PCT_Spend": pct(s, "ts"), "PCT_Visits": pct(n, "tv"), "PCT_Units": pct(u, "tu"),
        "PCT_PCT_Spend": ratio(s, "ts"), "PCT_PCT_Visits": ratio(n, "tv"),
        "PCT_PCT_Units": ratio(u, "tu"),
    }
    return [f'{kpis[k]} AS "{name}"' for k, name in feature.names.items()]


def wide_parts(features: Sequence[Feature]) -> tuple[str, str, list[str], list[str]]:
    """Long SQL, pivot SQL, output cells and presence tests of a list of features."""
    tags = list(dict.fromkeys(f.tag for f in features if f.tag))
    groups = list(dict.fromkeys(f.group for f in features))
    pivot: dict[str, list[str]] = {g: [] for g in groups}
    filled, cells, seen = [], [], []
    for i, f in enumerate(features):
        end = f"_{f.tag}" if f.tag else ""
        for m, a in (("spend", "s"), ("visits", "n"), ("units", "u")):
            pivot[f.group].append(f"max({m}{end}) FILTER (WHERE v = '{f.value}') AS c{i}_{a}")
            filled.append(f"coalesce(c{i}_{a}, 0) AS c{i}_{a}")
        cells += kpi_cells(f, f"c{i}")
        seen.append(f"c{i}_n > 0")
    joins = " ".join(
        f"LEFT JOIN (SELECT household_id, {', '.join(aggs)} FROM long WHERE g = '{g}' GROUP BY 1) "
        f"p{n} USING (household_id)"
        for n, (g, aggs) in enumerate(pivot.items())
    )
    wide = f"SELECT household_id, {', '.join(filled)} FROM (SELECT household_id FROM tot) {joins}"
    return long_sql(groups, tags), wide, cells, seen


def features_sql(features: Sequence[Feature]) -> str:
    long, wide, cells, seen = wide_parts(features)
    return with_(
        f"SELECT household_id, {', '.join(cells)} FROM wide JOIN tot USING (household_id) "
        f"WHERE {' OR '.join(seen)}",
        "flagged", "tot", long=long, wide=wide,
    )
