"""Flag boundaries on literal rows."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from basketlens.config import Window
from basketlens.operators import flags as G
from basketlens.operators import promo as P
from basketlens.sources.calendar import date_dim, festive_days, flagged_calendar, last_weekend_days


def _hours(spark):
    return spark.createDataFrame(
        [(h, datetime(2000, 9, 1, h)) for h in range(24)], "h int, tran_datetime timestamp_ntz"
    )


def test_time_of_day(spark):
    got = {r.h: r.time_of_day for r in G.flag_time_of_day(_hours(spark)).collect()}
    starts = {0: "night", 5: "prework", 9: "morning", 12: "lunch", 13: "afternoon", 18: "evening",
              21: "late"}
    label = None
    for h in range(24):
        label = starts.get(h, label)
        assert got[h] == label
    missing = spark.createDataFrame([(None,)], "tran_datetime timestamp_ntz")
    assert G.flag_time_of_day(missing).first().time_of_day == "def"


def test_week_of_month(spark):
    days = spark.createDataFrame([(date(2000, 8, d),) for d in range(1, 32)], "date_id date")
    got = {r.date_id.day: r.week_of_month for r in G.flag_week_of_month(days).collect()}
    assert [got[d] for d in (1, 7, 8, 14, 15, 21, 22, 28, 29, 31)] == [1, 1, 2, 2, 3, 3, 4, 4, 4, 4]


def test_weekend_starts_friday_evening(spark):
    # 2000-09-01 is a Friday.
    rows = [(date(2000, 9, 1), "afternoon"), (date(2000, 9, 1), "evening"), (date(2000, 9, 1), "late"),
            (date(2000, 9, 2), "night"), (date(2000, 9, 3), "lunch"), (date(2000, 9, 4), "late")]
    df = spark.createDataFrame(rows, "date_id date, time_of_day string")
    got = [r.weekend_flag for r in G.flag_weekend(df).collect()]
    assert got == ["N", "Y", "Y", "Y", "Y", "N"]


def test_calendar_weeks(spark):
    row = date_dim(spark, date(2000, 1, 1), date(2000, 1, 1)).first()
    assert (row.week_id, row.month_id, row.weekday_nbr, row.quarter_id) == (199952, 200001, 6, 200001)


def test_festive_weeks(spark):
    cal = date_dim(spark, date(2000, 4, 1), date(2001, 3, 31))
    flags = {r.date_id: r.fest_flag for r in festive_days(cal).collect()}
    # The last ISO week of 2000 is week 52, 25-31 December; its neighbours count as well.
    assert flags[date(2000, 12, 17)] == "NONE"
    assert flags[date(2000, 12, 18)] == flags[date(2001, 1, 7)] == "XMAS"
    assert flags[date(2001, 1, 8)] == "NONE"
    assert flags[date(2000, 4, 30)] == "APRIL"


def test_festive_without_december(spark):
    cal = date_dim(spark, date(2000, 3, 1), date(2000, 5, 31))
    got = {r.fest_flag for r in festive_days(cal).collect()}
    assert got == {"APRIL", "NONE"}


def test_last_weekend_stays_with_its_month(spark):
    cal = date_dim(spark, date(2000, 9, 1), date(2000, 10, 31))
    days = sorted(r.date_id for r in last_weekend_days(cal).collect())
    assert days == [date(2000, 9, 29), date(2000, 9, 30), date(2000, 10, 1), date(2000, 10, 27),
                    date(2000, 10, 28), date(2000, 10, 29)]
    assert flagged_calendar(cal).count() == cal.count()


def test_recency_is_fractional_inside_a_month(spark):
    df = spark.createDataFrame([(date(2023, 4, 3),), (date(2023, 7, 1),)], "date_id date")
    got = [r.months_from_end_date for r in G.flag_recency(df, date(2023, 7, 12)).collect()]
    assert abs(got[0] - 3.41935484) < 1e-6 and got[1] < 1


def test_quarters_partition_the_window(spark):
    days = date_dim(spark, date(2000, 8, 1), date(2001, 7, 31)).select("date_id")
    out = G.flag_quarter(G.flag_recency(days, date(2001, 7, 31)))
    per = {r.app_year_qtr: r["count"] for r in out.groupBy("app_year_qtr").count().collect()}
    assert sum(per.values()) == 365 and set(per) == {"Q1", "Q2", "Q3", "Q4"}
    nested = out.where("last_3_flag = 'Y' AND last_6_flag = 'N' OR last_6_flag = 'Y' AND last_9_flag = 'N'")
    assert nested.count() == 0
    ones = sum(F.when(F.col(f"q{n}_flag") == "Y", 1).otherwise(0) for n in (1, 2, 3, 4))
    assert out.where(ones != 1).count() == 0


def test_price_level_premium_first(spark):
    products = spark.createDataFrame(
        [(1, "premium value tea"), (2, "Basic rice"), (3, "PREMIUM COUPON"), (4, "milk"), (5, None)],
        "upc_id long, subclass_name string",
    )
    txn = spark.createDataFrame(
        [(u, 9) for u in (1, 2, 3, 4, 5, 6)] + [(1, None)], "upc_id long, household_id long"
    )
    got = {r.upc_id: r.price_level for r in G.flag_price_level(txn, products).collect()}
    assert got == {1: "PREMIUM", 2: "BUDGET", 3: "NONE", 4: "NONE", 5: "NONE", 6: "NONE"}


def test_single_tender(spark, rows):
    tenders = spark.createDataFrame(
        [(1, " CASH"), (1, "CASH "), (2, "CASH"), (2, "CCARD"), (3, None), (4, None), (4, "VOUCH")],
        "basket long, tender_type_group string",
    )
    assert rows(G.flag_single_tender(tenders, ["basket"])) == [
        (1, "CASH"), (2, "MULTI"), (3, "MULTI"), (4, "VOUCH")]


def test_keep_single_tender_looks_at_the_whole_basket(spark, rows):
    tenders = spark.createDataFrame(
        [(1, 7, "CASH"), (1, 8, "CCARD"), (2, 7, "CASH"), (2, 8, "CASH")],
        "basket long, store long, tender_type_group string",
    )
    got = rows(G.keep_single_tender(tenders, "basket", ["basket", "store"]))
    assert got == [("2_7", "CASH"), ("2_8", "CASH")]


def test_payment_precedence(spark):
    txn = spark.createDataFrame([(n, 1, date(2000, 1, 1)) for n in range(1, 8)],
                                "transaction_uid long, store_id long, date_id date")
    till = spark.createDataFrame(
        [(n, 1, date(2000, 1, 1), t) for n, t in
         [(1, "CASH"), (2, "CCARD"), (3, "COUPON"), (4, "VOUCH"), (5, "MULTI"), (6, "CCARD")]],
        "transaction_uid long, store_id long, date_id date, sngl_tndr_type string")
    online = spark.createDataFrame([(6, "CASH"), (7, "CreditCard")],
                                   "transaction_uid long, sngl_tndr_type string")
    got = {r.transaction_uid: (r.till_payment_method, r.payment_flag)
           for r in G.flag_payment(txn, till, online).collect()}
    assert [got[n][1] for n in range(1, 8)] == [
        "CASH", "CARD", "COUPON", "VOUCHER", "OTHER", "CASH", "CARD"]
    assert got[7][0] == "Unidentified"


def test_promo_flag_keeps_rows_and_merges_ranges(spark):
    window = Window(date(2000, 1, 1), date(2000, 12, 31))
    ranges = spark.createDataFrame(
        [(1, 1, date(1999, 1, 1), date(2000, 1, 5)), (1, 1, date(2000, 1, 3), date(2000, 1, 10)),
         (1, 1, date(2000, 1, 3), date(2000, 1, 4)), (1, 1, date(2000, 1, 11), date(2000, 1, 12)),
         (1, 1, date(2000, 2, 1), date(2002, 1, 1)), (2, 1, date(2000, 5, 2), date(2000, 5, 1))],
        "upc_id long, store_id long, promo_start_date date, promo_end_date date")
    days = {date(1970, 1, 1) + timedelta(days=64 * r.promo_bin + n) for r in P.promo_index(ranges, window).collect()
            for n in range(64) if r.on_days >> n & 1}
    assert days == {date(2000, 1, 1) + timedelta(days=n) for n in (*range(12), *range(31, 366))}
    txn = spark.createDataFrame(
        [(1, 1, 1, date(2000, 1, 4), 5.0), (2, 1, 1, date(2000, 1, 20), 5.0),
         (3, 1, 1, date(2000, 1, 20), 0.0), (4, 1, 2, date(2000, 1, 4), None),
         (5, 2, 1, date(2000, 5, 1), 0.0), (6, 1, 1, date(2000, 1, 12), 0.0)],
        "row long, upc_id long, store_id long, date_id date, discount_amt double")
    got = {r.row: r.promo_flag for r in P.flag_promo(txn, ranges, window).collect()}
    assert got == {1: "PROMO", 2: "MARK_DOWN", 3: "NONE", 4: "NONE", 5: "NONE", 6: "PROMO"}


def test_promo_index_matches_brute_force_and_joins_on_keys_alone(spark):
    window = Window(date(1969, 11, 1), date(1971, 3, 1))  # bins before and after day 0
    r = random.Random(4)
    day = lambda n: date(1969, 10, 1) + timedelta(days=n)
    ranges = [(r.randrange(3), 1, day(a), day(a + r.randrange(-2, 90))) for a in (r.randrange(560) for _ in range(60))]
    days = [(u, 1, day(n), 0.0) for u in range(4) for n in range(31, 516)]
    df = spark.createDataFrame(days, "upc_id long, store_id long, date_id date, discount_amt double")
    offers = spark.createDataFrame(ranges, "upc_id long, store_id long, promo_start_date date, promo_end_date date")
    flagged = P.flag_promo(df, offers, window)
    assert flagged.columns == [*df.columns, "discount_reason_code", "promo_flag"]
    got = {(x.upc_id, x.date_id) for x in flagged.where("promo_flag = 'PROMO'").collect()}
    assert got == {(u, d) for u, _, d, _ in days if any(v == u and a <= d <= b for v, _, a, b in ranges)}
    index = P.promo_index(offers, window)
    assert index.groupBy("upc_id", "store_id", "promo_bin").count().where("count > 1").count() == 0
    assert index.agg({"promo_bin": "max"}).first()[0] > 0 > index.agg({"promo_bin": "min"}).first()[0]
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert "promo_bin" in join and "date_id" not in join and "on_from" not in join


def test_promo_states(spark):
    promos = spark.createDataFrame(
        [(1, "Y", None, date(2000, 1, 1), date(2000, 1, 1)), (2, "Y", "Cancelled", date(2000, 1, 1), date(2000, 1, 2)),
         (3, "Y", "Live", date(2000, 1, 2), date(2000, 1, 1)), (4, "N", "Live", date(2000, 1, 1), date(2000, 1, 2))],
        "promo_id long, active_flag string, state_desc string, promo_start_date date, promo_end_date date")
    assert [r.promo_id for r in P.active_by_state(promos).collect()] == [1]


def test_tenure_has_one_row_per_household(spark):
    customers = spark.createDataFrame(
        [(1, "a", date(1999, 1, 1)), (1, "b", date(2000, 1, 1)), (2, "c", None)],
        "household_id long, golden_id string, card_issue_date date")
    first = spark.createDataFrame([("c", date(1998, 1, 1))], "golden_id string, first_txn_date date")
    got = {r.household_id: r.card_issue_date for r in G.tenure(customers, first).collect()}
    assert got == {1: date(2000, 1, 1), 2: date(1998, 1, 1)}


def test_hierarchy_codes(spark, rows):
    df = spark.createDataFrame([("13_77", "1_2_86"), ("1_1", "9_9_9"), (None, None)],
                               "department_code string, section_code string")
    got = rows(G.group_hierarchy_codes(df).select("grouped_department_code", "grouped_section_code"))
    assert ("13_77&13_78&13_79", "1_2_187&1_2_86") in got and ("1_1", "9_9_9") in got


def test_day_parts_cover_the_day(spark):
    got = [r.part_of_day for r in G.day_part_fine(_hours(spark)).collect()]
    assert got == (["early_morning"] * 9 + ["morning"] * 2 + ["lunch"] * 2 + ["afterlunch"] * 4
                   + ["evening"] * 2 + ["late_evening"] * 2 + ["night"] * 3)
