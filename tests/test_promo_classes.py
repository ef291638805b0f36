"""Promotions by zone: classes of stores against brute force, and nothing moved after an expansion."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from basketlens.config import Window
from basketlens.operators import promo as P

WINDOW = Window(date(2000, 1, 1), date(2000, 12, 31))
ZONES = [(1, s) for s in range(1, 8)] + [(2, s) for s in range(5, 10)] + [(2, 5), (3, 11), (None, 12)]  # 5-7 in two zones, 10 in none
PROMO = ("promo_id long, upc_id long, promo_storegroup_id long, store_id long, promo_offer_id int, source string, upc_id_cond long, "
         "upc_id_reward long, promo_start_date date, promo_end_date date, change_type string, active_flag string, state_desc string")


def day(n):
    return date(2000, 1, 1) + timedelta(days=n)


def tables(spark):
    offers = [  # promo, product, zone, store, offer, condition, first and last day
        (1, 1, 1, None, 1, None, 0, 4), (1, 1, 2, None, 1, None, 3, 8), (2, 1, 1, None, 4, 9, 60, 70),
        (2, 2, 1, None, 4, 9, 65, 75), (3, 3, None, 4, 2, None, -5, 2), (3, 3, None, 4, 2, None, 1, 3), (4, 4, 3, None, 6, 1, 5, 4)]
    promos = spark.createDataFrame(
        [(p, u, z, s, o, "rms19", c, None, day(a), day(b), "PRICE", "Y", None) for p, u, z, s, o, c, a, b in offers], PROMO)
    zones = spark.createDataFrame(ZONES, "zone_id long, store_id long").withColumn("source", F.lit("rms19"))
    stores = spark.createDataFrame([(s, 6 if s == 9 else s % 5 + 1) for s in range(1, 13)], "store_id long, format_id int")
    return offers, promos, zones, stores


def on_days(a, b):
    return [day(n) for n in range(max(a, 0), min(b, 365) + 1)]


def stores_of(zone, store):
    return {s for z, s in ZONES if z == zone and z is not None} if zone else {store}


def test_flag_and_expansion_by_zone(spark):
    offers, promos, zones, stores = tables(spark)
    want = {(u, s, d) for _, u, z, t, _, _, a, b in offers if z for s in stores_of(z, t) - {9} for d in on_days(a, b)}
    got = [(r.upc_id, r.store_id, r.date_id) for r in P.promo_expand_zone(promos, zones, stores, WINDOW).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    rows = [(u, s, day(n), 0.0) for u in range(1, 5) for s in range(1, 13) for n in range(80)]
    df = spark.createDataFrame(rows, "upc_id long, store_id long, date_id date, discount_amt double")
    flagged = P.flag_zone_promo(df, promos, zones, stores, WINDOW)
    assert flagged.columns == [*df.columns, "discount_reason_code", "promo_flag"] and flagged.count() == len(rows)
    assert {tuple(r)[:3] for r in flagged.where("promo_flag = 'PROMO'").collect()} == want


def test_sides_and_rows_by_zone_or_store(spark):
    offers, promos, zones, _ = tables(spark)
    rows = [(p, u, s, d, o, c) for p, u, z, t, o, c, a, b in offers for s in stores_of(z, t) for d in on_days(a, b)]
    got = P.promo_expand_store_or_zone(promos, zones, WINDOW).select("promo_id", "upc_id", "store_id", "date_id").collect()
    assert sorted(map(tuple, got)) == sorted(r[:4] for r in rows)
    side = {1: "reward", 2: "cond", 4: "reward", 6: "INVALID"}
    want = {(p, u, s, d, side[o]) for p, u, s, d, o, _ in rows} | {(p, c, s, d, "cond") for p, _, s, d, o, c in rows if o == 4}
    sides = P.promo_side(promos, zones, WINDOW).select("promo_id", "upc_id", "store_id", "date_id", "upc_side").collect()
    assert len(sides) == len(set(map(tuple, sides))) and set(map(tuple, sides)) == want


def test_promotions_are_not_repeated_for_the_stores_of_a_zone(spark):
    _, promos, _, _ = tables(spark)
    sizes = []
    for n in (50, 500):
        zones = spark.range(n).select(F.lit(1).cast("long").alias("zone_id"), F.col("id").alias("store_id"), F.lit("rms19").alias("source"))
        stores = spark.range(n).select(F.col("id").alias("store_id"), F.lit(1).alias("format_id"))
        sizes.append(P.promo_class_ranges(promos, zones, stores)[1].count())
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize("name", ["promo_expand_zone", "promo_side"])
def test_expanded_rows_do_not_move(spark, name):
    from __spark_entry__ import queries

    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    days = next(n for n, line in enumerate(plan) if "Generate explode" in line and "date_id" in line)
    assert not any(word in line for line in plan[:days] for word in ("Aggregate", "Repartition", "Deduplicate", "Distinct"))
