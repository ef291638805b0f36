"""A household with most of the rows: right results, and no plan that leaves it to one task."""

import os
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlens.functions.sizing import estimated_bytes
from basketlens.operators import joins as J
from basketlens.operators import kpi
from basketlens.operators.flags import flag_price_level


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _fact(spark):
    start = date(2000, 1, 1)
    rows = [(1 if n % 3 else n, n // 2, start + timedelta(days=n % 50), Decimal(n), 1.0, "a")
            for n in range(1, 600)]
    return spark.createDataFrame(
        rows, "household_id long, transaction_uid long, date_id date, net_spend_amt decimal(18,4), "
        "unit double, dim string")


def _windows(spark):
    day = date(2000, 2, 1)
    return spark.range(1, 600).select(
        F.col("id").alias("household_id"), F.lit(day - timedelta(days=20)).alias("r20_start_date"),
        F.lit(day).alias("first_contact_date"))


@pytest.fixture()
def all_hot(monkeypatch):
    """No table counts as small, and a key of ten rows as heavy."""
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(J.heavy_keys, "__defaults__", (0.02, 10))


def _heavy(df, on):
    return J.heavy_keys(J.key_sketch(df, key=on), "key")


def test_sketch_finds_the_heavy_keys_alone(spark, all_hot):
    fact = _fact(spark)  # household 1: two thirds of the rows
    found = _heavy(fact, "household_id").collect()
    key = spark.range(1, 2).select(F.xxhash64("id")).first()[0]
    assert [r["__key"] for r in found] == [key] and found[0]["__salts"] > 10
    assert _heavy(fact.where("household_id <> 1"), "household_id").count() == 0
    assert _heavy(fact.limit(0), "household_id").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_join_equals_plain_join(spark, rows, all_hot, how):
    fact = _fact(spark).unionByName(_fact(spark).withColumn("household_id", F.lit(None).cast("long")).limit(40))
    windows = _windows(spark).where("household_id % 2 = 1")
    assert rows(J.join_hot(fact, windows, "household_id", how)) == rows(fact.join(windows, "household_id", how))
    two = windows.withColumn("dim", F.lit("a"))
    on = ["household_id", "dim"]
    assert rows(J.join_sized(fact, two, on, how)) == rows(fact.join(two, on, how))


def test_other_joins_cannot_be_salted(spark):
    with pytest.raises(ValueError):
        J.join_hot(_fact(spark), _windows(spark), "household_id", "right")


def test_only_heavy_keys_are_repeated(spark, all_hot):
    """Rows of the table: one for each cold key, and one for each salt of a heavy one."""
    fact, windows = _fact(spark), _windows(spark)
    salts = _heavy(fact, "household_id").first()["__salts"]
    seen = J.join_hot(fact, windows, "household_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in seen
    copies = windows.withColumn("__key", F.xxhash64("household_id")).join(_heavy(fact, "household_id"), "__key", "left")
    copies = copies.select("household_id", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts") - 1, F.lit(0)))))
    assert copies.count() == windows.count() - 1 + salts


def _largest_task(df, spark):
    """Rows of the fullest and of all partitions of a join, as hashed to 64 partitions."""
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return max(sizes), sum(sizes)


BASE = date(2000, 1, 1)


def _operators(spark):
    """Each operator with a fact of which one key holds two thirds of the rows."""
    n = 30_000
    key = F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id"))
    fact = spark.range(n).select(
        key.alias("household_id"), key.alias("upc_id"), F.lit(7).alias("store_id"), F.col("id").alias("transaction_uid"),
        F.lit(BASE).alias("date_id"), F.lit(200001).alias("quarter_id"), F.lit(1.0).alias("unit"))
    dim = spark.range(n)
    goods = dim.select(F.col("id").alias("upc_id"), F.lit("ECONOMY").alias("division_id"), F.lit("premium").alias("subclass_name"))
    homes = dim.select(F.col("id").alias("household_id"))
    cal = spark.createDataFrame([(BASE, 200001)], "date_id date, week_id int")
    from basketlens.config import Window

    return {
        "left_lookup": lambda: J.join_left_lookup(fact, goods.select("upc_id", "division_id"), "upc_id", {"division_id": "NA"}),
        "semi_exists": lambda: J.join_semi_exists(fact, goods.select("upc_id", F.lit(7).alias("store_id")), ["upc_id", "store_id"]),
        "anti_exclude": lambda: J.join_anti_exclude(
            fact, homes.where("household_id = 3").withColumn("quarter_id", F.lit(200001)), ["household_id", "quarter_id"]),
        "snapshot_latest": lambda: J.join_snapshot_latest(
            fact, homes.where("household_id = 3").withColumn("quarter_id", F.lit(200001)), "quarter_id", 200003),
        "scope": lambda: J.join_scope_households(fact, homes),
        "price_level": lambda: flag_price_level(fact, goods, premium="%prem%"),
        "txn_base": lambda: J.txn_base(
            fact, goods, cal, homes.withColumn("golden_id", F.lit("G")), homes.where("household_id = 3"), ("ECONOMY",),
            Window(BASE, BASE + timedelta(days=9))),
    }


@pytest.mark.parametrize(
    "name", ["left_lookup", "semi_exists", "anti_exclude", "snapshot_latest", "scope", "price_level", "txn_base"])
def test_no_task_has_the_hot_key_alone(spark, no_broadcast, monkeypatch, name):
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(J.heavy_keys, "__defaults__", (0.01, 100))
    largest, total = _largest_task(_operators(spark)[name](), spark)
    assert total > 28_000 and largest < total / 10


def test_small_tables_are_broadcast_and_need_no_sketch(spark):
    plan = J.join_semi_exists(_fact(spark), _windows(spark).limit(5), "household_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_top_k" not in plan and "strategy=broadcast" in plan


def test_sizes_are_those_of_the_optimizer(spark):
    assert abs(estimated_bytes(spark.range(599)) - 599 * 8) < 64
    part = "/root/testdata/sf0.01/part.parquet"
    assert 0.9 < estimated_bytes(spark.read.parquet(part)) / os.path.getsize(part) < 1.1


def test_aggregation_after_the_join_is_not_hashed_by_household_alone(spark, no_broadcast, all_hot):
    near = J.join_household_window(_fact(spark), _windows(spark), "r20_start_date", "first_contact_date")
    long = kpi.kpi_long(near, {"D": F.col("dim")})
    plan = long._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    # join (both sides), per basket, per label
    assert len(exchanges) == 4
    for line in exchanges:
        keys = line.split("hashpartitioning(")[1]
        assert "household_id" in keys and ("__salt" in keys or "group_no" in keys)


def test_hot_household_totals(spark):
    fact = _fact(spark)
    got = kpi.agg_total(fact).where("household_id = 1").first()
    expected = fact.where("household_id = 1").agg(
        F.sum("net_spend_amt").cast("double"), F.count_distinct("transaction_uid"), F.sum("unit")).first()
    assert tuple(got)[1:] == tuple(expected)
