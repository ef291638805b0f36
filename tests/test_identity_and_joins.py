from datetime import date

from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.operators import filters as L
from basketlens.operators import joins as J
from basketlens.operators import windows as W
from basketlens.operators.identity import join_ident_resolve, win_latest_call
from basketlens.operators.segments import join_segments
from basketlens.operators.timeline import household_timeline
from basketlens.sources.calendar import date_dim


def test_identity(spark):
    feedback = spark.createDataFrame([(1, "n1"), (2, "20"), (3, "n2"), (4, None), (5, "n9"), (1, "n1")],
                                     "id long, dib_cust_code string")
    numbers = spark.createDataFrame([("n1", "g1"), ("n2", "gx"), ("20", "g1")],
                                    "ngc_customer_id string, golden_id string")
    customers = spark.createDataFrame([(10, "g1"), (20, "g2")], "household_id long, golden_id string")
    got = {r.id: (r.household_id, r.golden_id)
           for r in join_ident_resolve(feedback, numbers, customers).collect()}
    assert got == {1: (10, "g1"), 2: (20, "g2"), 3: (None, "gx"), 4: (None, None), 5: (None, None)}
    assert join_ident_resolve(feedback, numbers, customers).count() == 5


def test_latest_call(spark):
    rows = [(1, 5, date(2000, 1, 1), "x"), (1, 6, date(2000, 1, 2), "y"), (1, 7, date(2000, 1, 2), "z"),
            (2, 8, None, "n"), (None, 9, date(2000, 1, 1), "q"), (3, 4, None, "a"), (3, 3, date(1990, 1, 1), "b")]
    df = spark.createDataFrame(rows, "household_id long, feedback_id long, First_Call_Date date, Reason_code string")
    df = df.withColumns({"Bought_Status": F.lit("B"), "Contact_Status": F.lit("C")})
    got = {r.household_id: (r.Reason_code, r.first_contact_date) for r in win_latest_call(df).collect()}
    assert got == {1: ("y", date(2000, 1, 2)), 2: ("n", None), 3: ("b", date(1990, 1, 1))}


def test_outer_fold_equals_chained_outer_joins(spark, rows):
    a = spark.createDataFrame([(1, 1), (2, 2)], "household_id long, a int")
    b = spark.createDataFrame([(2, 3), (3, 4)], "household_id long, b int")
    c = spark.createDataFrame([(4, 5), (1, 6)], "household_id long, c int")
    chained = a.join(b, "household_id", "outer").join(c, "household_id", "outer")
    assert rows(J.join_outer_fold([a, b, c])) == rows(chained)


def test_left_chain_moves_the_base_once(spark):
    base = spark.range(100).withColumnRenamed("id", "household_id")
    with_conf = [base.withColumn(f"c{i}", F.lit(i)) for i in range(4)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = J.join_left_chain(base, with_conf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 5


def test_latest_snapshot(spark):
    snaps = spark.createDataFrame([(1, 202301), (2, 202302), (3, 202304)], "household_id long, q int")
    pick = lambda limit: [r.household_id for r in J.latest_snapshot(snaps, "q", limit).collect()]
    assert (pick(202302), pick(209901)) == ([2], [3])


def test_exclusion_drops_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r.k for r in L.filter_in_list(df, "k", drop=("a",)).collect()] == ["b"]


def test_contact_status_formats(spark):
    df = spark.createDataFrame(
        [("CONTACT", "01/5/2023"), ("Contactable", "12/31/2022"), ("Uncontactable", "bad"), ("Other", "01/5/2023"),
         (None, "01/5/2023")], "Contact_Status string, First_Call_Date string")
    got = L.contact_status_norm(df, K.FEEDBACK_SOURCES["AZAY"].date_format).collect()
    assert [(r.Contact_Status, r.First_Call_Date) for r in got] == [
        ("Contactable", date(2023, 1, 5)), ("Contactable", date(2022, 12, 31))]


def test_consent_needs_every_flag(spark):
    accounts = spark.createDataFrame(
        [("g1", "g1", "Active", "true", "false"), ("gx", "g2", "Active", "true", "false"),
         ("g3", "g3", "Closed", "true", "false"), ("g4", "g4", "Active", "false", "false"),
         ("g5", "g5", "Active", "true", "true")],
        "customer_id string, golden_id string, customer_status string, opted_in string, do_not_call string")
    customers = spark.createDataFrame([(n, f"g{n}") for n in range(1, 6)], "household_id long, golden_id string")
    got = L.consent_filter(customers.select("household_id"), accounts, customers).collect()
    assert [r.household_id for r in got] == [1]


def test_collect_distinct(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None), (None, "c")], "k long, v string")
    got = rows(W.win_collect_distinct(df, ["k"], "v", "vs").select("k", "vs"))
    assert (1, ["a", "b"]) in got and (2, []) in got and len(got) == 5


def test_timeline_drops_negative_card_age(spark):
    cal = date_dim(spark, date(1999, 1, 1), date(2001, 12, 31))
    contacts = spark.createDataFrame([(1, date(2000, 6, 1)), (2, date(2000, 6, 1)), (3, date(2000, 6, 1))],
                                     "household_id long, first_contact_date date")
    cards = spark.createDataFrame([(1, date(2000, 1, 1)), (1, date(1999, 1, 1)), (2, date(2000, 7, 1))],
                                  "household_id long, card_issue_date date")
    got = household_timeline(contacts, cards, cal, date(2001, 12, 31)).collect()
    assert [(r.household_id, r.card_aging_day, r.r360_start_date) for r in got] == [
        (1, 152, date(1999, 6, 7))]


def test_segment_defaults(spark):
    base = spark.createDataFrame([(1, 1, 1, 1)], "household_id long, period_id int, week_id int, quarter_id int")
    empty = lambda cols: spark.createDataFrame([], cols)
    store = spark.createDataFrame([(1, 1, "5", "missing", "NORTH")],
                                  "household_id long, period_id int, pref_store_id string, pref_store_format string, "
                                  "pref_store_region string")
    row = join_segments(
        base, empty("household_id long, period_id int, truprice_seg_desc string"),
        empty("household_id long, week_id int, facts_seg_desc string"),
        empty("household_id long, quarter_id int, lifestage_seg_name string"), store,
        empty("household_id long, week_id int, lifecycle_name string")).first()
    assert row.truprice_seg_desc == row.lifecycle_name == "Unclassified"
    assert (row.pref_store_format, row.perf_store_area) == ("NA", "UPC")
