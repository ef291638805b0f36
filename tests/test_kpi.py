"""KPI kernel against brute force, with a hot household, null labels and the dummy household."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlens.operators import assemble as A
from basketlens.operators import contact as N
from basketlens.operators import features as S
from basketlens.operators import kpi

SCHEMA = ("household_id long, transaction_uid long, dim string, last_3_flag string, "
          "net_spend_amt decimal(18,4), unit double, store_format string, tender_type_group string")


@pytest.fixture(scope="module")
def fact():
    rng = random.Random(3)
    out = []
    for _ in range(900):
        household = rng.choice([1, 1, 1, 2, 3, 4, -1])  # household 1 holds close to half of the rows
        out.append((household, rng.choice([None, *range(60)]), rng.choice(["a", "b", None]),
                    rng.choice("YN"), Decimal(rng.randint(-500, 99999)) / 10000, float(rng.randint(0, 4)),
                    rng.choice(["HDE", "GoFresh"]), rng.choice(["CASH", "CCARD", "OTHER"])))
    return out


@pytest.fixture(scope="module")
def txn(spark, fact):
    return spark.createDataFrame(fact, SCHEMA)


def _brute(fact, label, keep=lambda r: True):
    spend, units, baskets = defaultdict(Decimal), defaultdict(float), defaultdict(set)
    for r in fact:
        value = label(r)
        if r[0] == -1 or value is None or not keep(r):
            continue
        key = (r[0], value)
        spend[key] += r[4]
        units[key] += r[5]
        baskets[key] |= {r[1]} - {None}
    return {k: (float(spend[k]), len(baskets[k]), units[k]) for k in spend}


def test_long_matches_brute_force(txn, fact):
    long = kpi.kpi_long(txn, {"D": F.col("dim")}, {"L3": F.col("last_3_flag") == "Y"})
    got = {(r.household_id, r.kpi_value): (r.spend, r.visits, r.units)
           for r in long.where("kpi_group = 'D'").collect()}
    assert got == _brute(fact, lambda r: r[2])
    sliced = {(r.household_id, r.kpi_value): (r.spend_L3, r.visits_L3, r.units_L3)
              for r in long.where("kpi_group = 'D'").collect()}
    assert sliced == _brute(fact, lambda r: r[2], lambda r: r[3] == "Y")
    totals = {(r.household_id, "ALL"): (r.spend, r.visits, r.units)
              for r in long.where("kpi_group = 'TOTAL'").collect()}
    assert totals == _brute(fact, lambda r: "ALL")


def test_pivot_sums_to_total(txn):
    sets = S.FeatureSet("D", lambda: F.coalesce("dim", F.lit("none")), ("a", "b", "none"), lambda v, _: f"D_{v}")
    wide = S.agg_features(txn, sets)
    both = wide.join(kpi.agg_total(txn), "household_id")
    assert both.count() == 4
    gap = F.abs(F.col("D_a_SPEND") + F.col("D_b_SPEND") + F.col("D_none_SPEND") - F.col("Total_Spend"))
    assert both.where(gap > 1e-9).count() == 0
    share = F.col("PCT_D_a_UNITS") + F.col("PCT_D_b_UNITS") + F.col("PCT_D_none_UNITS")
    assert both.where(F.abs(share - 100) > 1e-9).count() == 0


def test_household_without_the_value_gets_zero(spark):
    df = spark.createDataFrame([(1, 1, "a", "Y", Decimal("2"), 0.0, "HDE", "CASH"),
                                (2, 1, "b", "Y", Decimal("0"), 0.0, "HDE", "CASH")], SCHEMA)
    sets = S.FeatureSet("D", lambda: F.col("dim"), ("a", "b"), lambda v, _: f"D_{v}")
    got = {r.household_id: r for r in S.agg_features(df, sets).collect()}
    assert got[1].D_b_SPEND == 0 and got[1].D_a_SPU == 0 and got[1].D_a_SPV == 2
    assert got[2].PCT_D_b_SPEND == 0 and got[2].PCT_D_b_VISITS == 100


def test_cash_card_segment_keeps_every_household(txn, fact):
    got = {r.household_id: r.cash_card_customer_flag for r in N.agg_cash_card_segment(txn).collect()}
    assert set(got) == {r[0] for r in fact}


def test_favourite_slot_tie_takes_the_first_name(spark):
    long = spark.createDataFrame(
        [(1, "S", "b", 5.0, 3), (1, "S", "a", 5.0, 3), (1, "S", "c", 9.0, 2), (1, "X", "z", 99.0, 99)],
        "household_id long, kpi_group string, kpi_value string, spend double, visits long")
    assert N.pick_favourite_slot(long, "S").first().shopping_time == "a"


def test_stats_of_a_single_month(spark):
    long = spark.createDataFrame(
        [(1, "MONTH", "2000-01-31", 0.125, 2, 3.0)],
        "household_id long, kpi_group string, kpi_value string, spend double, visits long, units double")
    row = S.period_stats(long, "MONTH", "MNTH", S.MONTHLY_STATS).first()
    assert row.SD_SPEND_MNTH == 0 and row.AVG_SPEND_MNTH == 0.13 and row.MAX_UNITS_MNTH == 3


def test_distinct_counts_ignore_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (1, "a"), (1, "b"), (1, "d"), (2, None), (2, "e"), (-1, "a")],
                               "household_id long, article string")
    codes = S.level_codes(
        spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z"), ("d", "x"), ("e", None)], "article string, code string"), "article", {"n": "code"})
    got = {r.household_id: r.n for r in S.agg_distinct_counts(S.distinct_bits(df, codes), ["n"]).collect()}
    assert got == {1: 2, 2: 0}


def test_distinct_bits_of_runs_merge(spark):
    r = random.Random(8)
    rows = [(r.randrange(5), f"a{r.randrange(300)}", r.randrange(4)) for _ in range(1_500)]
    df = spark.createDataFrame(rows, "household_id long, article string, store_id int")
    articles = spark.createDataFrame([(f"a{n}", n % 200, None if n % 9 == 0 else "ab"[n % 2]) for n in range(300)], "article string, cls int, kind_of string")
    levels = [S.level_codes(articles, "article", {"CLS": "cls", "KIND": "kind_of"}),
              S.level_codes(spark.range(4).select(F.col("id").cast("int").alias("store_id")), "store_id", {"STORES": "store_id"})]
    whole = S.distinct_bits(df, *levels)
    assert whole.where("kind = 'CLS'").groupBy("household_id").count().agg({"count": "max"}).first()[0] == 4  # 200 numbers in 4 words
    parts = [S.distinct_bits(df.where(f"store_id % 2 = {k}"), *levels) for k in (0, 1)]
    want = {h: (len({int(a[1:]) % 200 for x, a, _ in rows if x == h}),
                len({int(a[1:]) % 2 for x, a, _ in rows if x == h and int(a[1:]) % 9}), len({s for x, _, s in rows if x == h}))
            for h in {x for x, _, _ in rows}}
    for bits in (whole, S.merge_bits(*parts)):
        assert {x.household_id: (x.CLS, x.KIND, x.STORES) for x in S.agg_distinct_counts(bits, ["CLS", "KIND", "STORES"]).collect()} == want


def test_round_all_takes_text_as_zero(spark):
    df = spark.createDataFrame([(1, "x", None, 2.675, Decimal("1.005"))],
                               "household_id long, a string, b int, c double, d decimal(10,3)")
    row = A.round_all(df).first()
    assert (row.a, row.b, row.c, row.d) == (0.0, 0.0, 2.68, 1.01)


def test_pivot_values(spark):
    assert kpi.pivot_values(spark.range(30), "id") == sorted(str(i) for i in range(30))


def test_a_value_without_a_column_stops_the_run(spark):
    from basketlens.operators import features as S

    txn = spark.sql(
        "SELECT 1L household_id, 1L transaction_uid, d division_id, 2.0BD net_spend_amt, 1.0D unit "
        "FROM VALUES ('OLD'), ('NEW'), (NULL) AS t(d)")
    assert "PCT_CAT_DIV_%NEW%_SPEND" in S.agg_features(txn, S.division(["OLD", "NEW"])).columns
    with pytest.raises(Exception, match="no column for the value NEW"):
        S.agg_features(txn, S.division(["OLD"])).collect()


def test_promotion_names_the_models_ask_for():
    from basketlens.operators import features as S

    names = {n for f in S.promo().features() for n in f.names.values()}
    assert {"PCT_PROMO_SPEND", "PCT_PROMO_UNITS", "PCT_MARK_DOWN_SPEND", "PCT_MARK_DOWN_UNITS", "DISCOUNT_NONE_SPEND"} <= names
