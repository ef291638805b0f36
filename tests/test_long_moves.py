"""The long table: rows of the fact move once, not what they are repeated to."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlens.operators import assemble as A
from basketlens.operators import features as S
from basketlens.operators import joins as J
from basketlens.sources.writers import write_bucketed

SETS = [S.quarter(), S.weekend("Y"), S.recency()]


def flagged(spark):
    """Lines of which household 1 has two thirds; baskets of several lines, some on two days, nulls."""
    start = date(2000, 1, 1)
    rows = [
        (None if n % 97 == 0 else 1 if n % 3 else n % 40, None if n % 89 == 0 else n // 3, start + timedelta(days=n % 90),
         Decimal(n % 50), 1.0, n % 7, "Y" if n % 4 else "N", "Y" if n % 5 else "N", "Y" if n % 6 else "N",
         f"Q{n % 4 + 1}", "Y" if n % 7 > 4 else "N", n % 5, n % 11, f"s{n % 13}")
        for n in range(1, 900)]
    return spark.createDataFrame(
        rows, "household_id long, transaction_uid long, date_id date, net_spend_amt decimal(18,4), unit double, "
        "store_id long, last_3_flag string, last_6_flag string, last_9_flag string, app_year_qtr string, weekend_flag string, "
        "week_of_month int, upc_id long, subclass_code string").withColumns(
            {c: F.col("subclass_code") for c in S.DISTINCT_COLUMNS.values() if c not in ("store_id", "upc_id", "subclass_code")})


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [n for n, line in enumerate(plan) if "Exchange" in line and "Broadcast" not in line], plan


@pytest.mark.parametrize("salted", [False, True])
def test_long_rows_do_not_move(spark, rows, salted):
    fact = flagged(spark)
    heavy = J.heavy_keys(J.key_sketch(fact, key="household_id"), "key", 0.02, 10) if salted else None
    long = A.wide_long(fact, SETS, 5, heavy)
    assert rows(long) == rows(A.wide_long(fact, SETS))
    found, plan = exchanges(long)
    repeated = next(n for n, line in enumerate(plan) if "Generate" in line)
    assert sum(n < repeated for n in found) == salted  # the sums of heavy households alone
    assert long.rdd.getNumPartitions() == 5


def test_heavy_households_are_dealt_to_several_tasks(spark, monkeypatch):
    fact = flagged(spark)
    assert A.heavy_households(fact) is None
    monkeypatch.setattr(J.heavy_keys, "__defaults__", (0.02, 10))
    heavy = A.heavy_households(fact)
    salts = J.salted(fact.where("household_id = 1"), "household_id", heavy, J.spread_over(["transaction_uid"]))
    assert heavy.count() == 1 and salts.select("__salt").distinct().count() > 10


def test_each_task_writes_one_bucket(spark, tmp_path):
    long = A.wide_long(flagged(spark), SETS, 5)
    table = A.write_long(long, "moved_long", f"{tmp_path}/long", 5)
    assert len(spark.read.parquet(f"{tmp_path}/long").inputFiles()) <= 5
    assert table.count() == long.count()
    assert not exchanges(table.groupBy("household_id").count())[0]
    write_bucketed(long, "moved_long", 5, "household_id", f"{tmp_path}/long")  # a rerun overwrites
