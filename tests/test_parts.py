"""Numbers of parts that follow the tables, not the bytes moved."""

from pyspark.sql import functions as F

from basketlens.functions import sizing
from basketlens.operators import joins as J
from basketlens.operators import kpi
from basketlens.operators import windows as W
from basketlens.queries.aggregates import paid
from basketlens.sources import roles as R

SF = "/root/testdata/sf0.01"


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_large_tables_join_in_parts_by_their_size(spark, rows, monkeypatch):
    plain = R.sales(spark, SF)
    assert "Repartition" not in logical(plain)
    size = sizing.estimated_bytes(R.table(spark, SF, "lineitem")) + sizing.estimated_bytes(R.table(spark, SF, "orders"))
    monkeypatch.setattr(sizing, "LEFT_ALONE", 0)
    monkeypatch.setattr(sizing, "TASK_BYTES", size // 3)
    total = lambda df: df.agg(F.count(F.lit(1)), F.sum("net_spend_amt"), F.sum(F.xxhash64(*df.columns) % 1000)).first()
    for role in (R.sales, lambda s, sf: R.till_tenders(s, sf).withColumn("net_spend_amt", F.lit(1))):
        assert logical(role(spark, SF)).count("RepartitionByExpression [transaction_uid") == 2
    parted = R.sales(spark, SF)
    assert parted.rdd.getNumPartitions() == 4 and total(parted) == total(plain)


def test_pivot_keeps_its_number_of_parts(spark):
    long = spark.range(8).select(
        F.col("id").alias("household_id"), F.lit("A").alias("kpi_group"), F.lit("x").alias("kpi_value"), F.lit(1.0).alias("spend"))
    wide = kpi.pivot_long(long, ["A=x"], ["spend"])
    assert wide.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert wide.agg(F.sum("A=x_spend")).first()[0] == 8


def test_salted_joins_keep_their_number_of_parts(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    joined = J.join_hot(df, df.select("k", F.lit(2).alias("w")), "k", parts=3)
    assert logical(joined).count("RepartitionByExpression [k") == 2 and joined.count() == 100


def test_online_payment_is_joined_before_lines_leave_their_basket(spark):
    plan = logical(paid(spark, SF)).splitlines()
    joins = [line for line in plan if "Join LeftOuter" in line]
    assert "store_id" in joins[0] and "store_id" not in joins[1]  # the outer one, which comes last, is by store as well
    assert paid(spark, SF).columns[-3:] == ["till_payment_method", "online_payment_method", "payment_flag"]


def test_sets_are_made_apart_from_the_rows_they_join(spark):
    df = spark.range(40).select((F.col("id") % 4).alias("k"), (F.col("id") % 12).alias("v"), "id")
    found = W.win_collect_distinct(df, ["k"], "v", "vs", most=2)
    assert logical(found).count("RepartitionByExpression [k") == 2  # the same rows for number and list
    assert found.columns == ["k", "v", "id", "vs", "n_vs"]
    assert {tuple(r) for r in found.select("k", "vs", "n_vs").collect()} == {(k, None, 3) for k in range(4)}
    listed = W.win_collect_distinct(df, ["k"], "v", "vs", most=3).select("k", "vs", "n_vs").collect()
    assert {(r["k"], tuple(r["vs"]), r["n_vs"]) for r in listed} == {(k, (k, k + 4, k + 8), 3) for k in range(4)}
