"""Contacted households: exclusions of the ground truth and the columns of the joined table."""

from datetime import date, datetime
from decimal import Decimal

from basketlens.operators.contact import agg_format_channel_kpi
from basketlens.plans import contacted as H
from basketlens.sources.calendar import date_dim

KEY = "household_id long, "
DAY = date(2000, 6, 1)


def people(spark):
    calls = "dib_cust_code string, Bought_Status string, Contact_Status string, Reason_code string, First_Call_Date string, feedback_id long"
    first = [(str(h), "Bought", "CONTACT", None, "6/1/2000", h) for h in range(1, 9)]
    first += [("1", "Not Bought", "Contactable", "late", "6/3/2000", 20), ("9", "Bought", "Pending", None, "6/1/2000", 21)]
    second = [("2", "Not Bought", "Uncontactable", "U", "2000-06-02", 30), ("7", "Bought", "Contactable", None, "never", 31)]
    households = range(1, 10)
    return H.People(
        [(spark.createDataFrame(first, calls), "L/d/yyyy"), (spark.createDataFrame(second, calls), "yyyy-MM-dd")],
        spark.createDataFrame([], "ngc_customer_id string, golden_id string"),
        spark.createDataFrame([(h, f"g{h}") for h in households], KEY + "golden_id string"),
        spark.createDataFrame(
            [(h, date(1980, 1, 1) if h == 3 else date(2000, 7, 1) if h == 4 else date(1999, 1, 1)) for h in households],
            KEY + "card_issue_date date"),
        spark.createDataFrame(
            [(f"g{h}", f"g{h}", "Active", "true", "true" if h == 5 else "false") for h in households],
            "customer_id string, golden_id string, customer_status string, opted_in string, do_not_call string"),
        spark.createDataFrame([(6, 200002), (7, 200001)], KEY + "quarter_id int"),
        date_dim(spark, date(1999, 1, 1), date(2001, 12, 31)),
        (spark.createDataFrame([(1, 200006, "Neutral")], KEY + "period_id int, truprice_seg_desc string"),
         spark.createDataFrame([], KEY + "week_id int, facts_seg_desc string"),
         spark.createDataFrame([], KEY + "quarter_id int, lifestage_seg_name string"),
         spark.createDataFrame([], KEY + "period_id int, pref_store_id string, pref_store_format string, pref_store_region string"),
         spark.createDataFrame([], KEY + "week_id int, lifecycle_name string")))


def test_ground_truth_leaves_out_who_does_not_count(spark):
    found = {r.household_id: r for r in H.ground_truth(people(spark), date(2001, 12, 31)).collect()}
    # 3 is too old, 4 younger than the call, 5 without consent, 6 a trader then, 9 without a settled call
    assert set(found) == {1, 2, 7, 8}
    assert (found[1].Bought_Status, found[1].first_contact_date) == ("Not Bought", date(2000, 6, 3))
    assert found[1].truprice_seg_desc == "Neutral" and found[8].truprice_seg_desc == "Unclassified"
    assert (found[2].Reason_code, found[7].first_contact_date) == ("U", DAY)


def test_columns_of_the_contacted_table():
    columns = H.contacted_columns()
    assert {k: len(v) for k, v in columns.items()} == {
        "cust_details": 8, "cust_tender_kpi": 5, "cust_promo_online_monthly": 2, "cust_shp_time": 19,
        "cust_all_mt_kpi": 4, "cust_prd_gr_kpi": 154, "cust_shp_ms": 17, "cust_each_fmt_kpi": 37}
    names = [c for v in columns.values() for c in v[1:]]
    assert len(set(names)) == len(names)
    assert {"rtd_prop_units", "trader_prop_sales_360_days", "offline_gofresh_visits_30_days",
            "late_evening_prop_sales_360_days", "prop_visit_by_card_360_days"} <= set(names)


def test_contact_features(spark):
    details = H.ground_truth(people(spark), date(2001, 12, 31))
    line = ("household_id long, transaction_uid long, date_id date, tran_datetime timestamp, net_spend_amt decimal(18,4), discount_amt "
            "decimal(18,4), unit double, tender_type_group string, channel string, store_format string, period_id int, "
            "product_group string, mission string")
    row = lambda h, uid, day, amount, tender, group, mission, fmt="HDE": (
        h, uid, day, datetime(day.year, day.month, day.day, 9), Decimal(amount), Decimal(0), 1.0, tender, "OFFLINE", fmt, 200005, group, mission)
    may, old = date(2000, 5, 20), date(1999, 1, 5)
    fact = spark.createDataFrame([
        row(1, 1, may, 30, "CASH", "rtd", "TopUp"), row(1, 1, may, 10, "CASH", "new", "TopUp"),
        row(1, 2, may, 60, "CCARD", "rtd", None, "GoFresh"), row(1, 3, old, 500, "CASH", "rtd", "TopUp"),
        row(2, 4, may, 5, "CASH", "rtd", "TopUp"), row(6, 5, may, 5, "CASH", "rtd", "TopUp"),
    ], line)
    (got,) = H.contact_features(details, fact).collect()  # 2 was not reached, 6 is excluded, 7 and 8 bought nothing
    assert got.household_id == 1 and got.total_sales_360_days == 100 and got.total_visits_360_days == 2
    assert (got.rtd_prop_sales, got.rtd_prop_visits, got.kid_prop_sales) == (0.9, 1.0, 0.0)
    assert (got.TopUp_prop_sales_360_days, got.TopUp_prop_visits_360_days) == (0.4, 0.5)
    assert (got.offline_hde_sales_30_days, got.offline_gofresh_visits_360_days, got.online_all_units_90_days) == (40, 1, 0)
    assert (got.morning_prop_visits_360_days, got.cash_card_customer_flag, got.Bought_Status) == (1.0, "cash", "Not Bought")
    assert len(got) == 1 + 1 + sum(len(v) - 1 for v in H.contacted_columns().values())


def test_household_that_bought_in_no_channel_of_the_table_has_zeros(spark):
    day = date(2000, 5, 20)
    starts = ", ".join(f"r{n}_start_date date" for n in (360, 180, 90, 30))
    fact = spark.createDataFrame(
        [(1, 1, day, Decimal(7), 2.0, "OFFLINE", "Talad", DAY, *[date(2000, 1, 1)] * 4)],
        "household_id long, transaction_uid long, date_id date, net_spend_amt decimal(18,4), unit double, channel string, "
        f"store_format string, first_contact_date date, {starts}")
    (got,) = agg_format_channel_kpi(fact, combos=H.CHANNELS).collect()
    assert got.household_id == 1 and len(got) == 37 and set(got[1:]) == {0}
