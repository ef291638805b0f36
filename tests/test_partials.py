"""Stored sums against the full pass: windows, slices, late rows, gaps and a run that died."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlens.functions import sizing
from basketlens.operators import flags
from basketlens.operators import kpi
from basketlens.operators import partials as P

FIRST, LAST = date(2000, 11, 1), date(2001, 8, 31)
SCHEMA = "household_id long, transaction_uid long, date_id date, dim string, net_spend_amt decimal(18,4), unit double"


def _fact(seed: int, first: date, last: date, n: int = 1_500):
    """Baskets with one date each; household 1 holds close to half of the rows."""
    rng = random.Random(seed)
    day = lambda b: first + timedelta(days=b * 7919 % ((last - first).days + 1))
    baskets = [rng.randrange(400) for _ in range(n)]
    return [(rng.choice([1, 1, 1, 2, 3, None, -1]), seed * 1000 + b, day(b), rng.choice(["a", "b", None]),
             Decimal(rng.randint(-500, 99999)) / 10000, float(rng.randint(0, 4))) for b in baskets]


@pytest.fixture(scope="module")
def fact(spark):
    rows = _fact(1, FIRST, LAST) + [(2, 9, None, "a", Decimal(1), 1.0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def groups(spark):
    return {"D": F.col("dim"), "MONTH": F.last_day("date_id")}


def _sorted(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


def _full(txn, groups, first, last):
    flagged = flags.flag_quarter(flags.flag_recency(txn.where(F.col("date_id").between(first, last)), last))
    slices = {f"L{n}": F.col(f"last_{n}_flag") == "Y" for n in (3, 6, 9)}
    return kpi.kpi_long(flagged, {**groups, "QTR": F.col("app_year_qtr")}, slices)


def _from_sums(spark, path, first, last):
    return P.window_long(P.with_quarters(P.stored(spark, path, first, last), last), P.recency_starts(last))


def test_stretches_cover_weeks_and_months():
    assert P.stretches(date(2001, 6, 25), date(2001, 7, 8)) == [date(2001, 6, 25), date(2001, 7, 1), date(2001, 7, 2)]
    for first, last in ((date(2001, 6, 26), date(2001, 7, 8)), (date(2001, 6, 25), date(2001, 7, 7))):
        with pytest.raises(ValueError, match="neither a week nor a month"):
            P.stretches(first, last)
    assert P.recency_starts(date(2001, 2, 28)) == {
        "L3": date(2000, 12, 1), "L6": date(2000, 9, 1), "L9": date(2000, 6, 1)}


def test_sums_equal_the_full_pass(spark, fact, groups, tmp_path):
    path = str(tmp_path / "sums")
    for first, last in ((FIRST, date(2001, 7, 31)), (date(2001, 8, 1), date(2001, 8, 26)), (date(2001, 8, 27), LAST)):
        P.extend(fact, path, groups, first, last)
    for first, last in ((FIRST, LAST), (date(2001, 1, 1), date(2001, 8, 26)), (date(2001, 4, 2), date(2001, 7, 31))):
        assert _sorted(_from_sums(spark, path, first, last)) == _sorted(_full(fact, groups, first, last))


def test_stretches_emptied_by_a_later_run(spark, fact, groups, tmp_path):
    path = str(tmp_path / "sums")
    P.extend(fact, path, groups, FIRST, LAST)
    left = fact.where("date_id < '2001-08-06' OR date_id > '2001-08-12'")
    P.extend(left, path, groups, date(2001, 8, 6), date(2001, 8, 12))
    assert _sorted(_from_sums(spark, path, FIRST, LAST)) == _sorted(_full(left, groups, FIRST, LAST))


def test_late_rows_replace_their_stretches(spark, fact, groups, tmp_path):
    path = str(tmp_path / "sums")
    P.extend(fact, path, groups, FIRST, LAST)
    late = fact.unionByName(spark.createDataFrame(_fact(2, date(2001, 8, 20), date(2001, 8, 31), 50), SCHEMA))
    P.extend(late, path, groups, date(2001, 8, 20), LAST)
    P.extend(late, path, groups, date(2001, 8, 20), LAST)
    assert _sorted(_from_sums(spark, path, FIRST, LAST)) == _sorted(_full(late, groups, FIRST, LAST))


def test_gaps_and_dead_runs_are_refused(spark, fact, groups, tmp_path, monkeypatch):
    path = str(tmp_path / "sums")
    with pytest.raises(ValueError, match="not stored"):
        P.stored(spark, path, FIRST, LAST)
    P.extend(fact, path, groups, FIRST, date(2001, 7, 31))
    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:  # dies after the sums are written, before they count
        patch.setattr(P, "publish", lost)
        with pytest.raises(OSError, match="lost"):
            P.extend(fact.limit(9), path, groups, FIRST, LAST)
    assert _sorted(_from_sums(spark, path, FIRST, date(2001, 7, 31))) == _sorted(_full(fact, groups, FIRST, date(2001, 7, 31)))
    with pytest.raises(ValueError, match="the first from 2001-08-01"):
        P.stored(spark, path, FIRST, LAST)
    P.extend(fact, path, groups, date(2001, 8, 1), LAST)
    assert _sorted(_from_sums(spark, path, FIRST, LAST)) == _sorted(_full(fact, groups, FIRST, LAST))


def test_an_empty_fact(spark, fact, groups, tmp_path):
    path = str(tmp_path / "sums")
    P.extend(fact.where("false"), path, groups, FIRST, LAST)
    P.extend(fact, path, groups, date(2001, 8, 1), LAST)
    assert _sorted(_from_sums(spark, path, FIRST, LAST)) == _sorted(_full(fact.where("date_id >= '2001-08-01'"), groups, FIRST, LAST))


def test_households_are_dealt_to_parts_before_stored_sums_add_up(fact, groups, spark, tmp_path, monkeypatch):
    P.extend(fact, f"{tmp_path}/plain", groups, FIRST, LAST)
    plain = _sorted(_from_sums(spark, f"{tmp_path}/plain", FIRST, LAST))
    P.extend(fact, f"{tmp_path}/parted", groups, FIRST, LAST, parts=5)
    rows = fact.where("household_id <> -1").withColumn("stretch", P.stretch_start(F.col("date_id"))).where("stretch IS NOT NULL")
    dealt = rows.repartition(5, "household_id", "stretch").select(F.spark_partition_id()).distinct().count()
    assert len(spark.read.parquet(f"{tmp_path}/parted/{P.SUMS}").inputFiles()) == dealt > 1
    monkeypatch.setattr(sizing, "LEFT_ALONE", 0)
    monkeypatch.setattr(sizing, "TASK_BYTES", 1 << 9)
    added = _from_sums(spark, f"{tmp_path}/parted", FIRST, LAST)
    steps = added._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert "Aggregate" in steps[0] and any("RepartitionByExpression [household_id" in step for step in steps)
    assert added.rdd.getNumPartitions() == sizing.sized_parts(P.with_quarters(P.stored(spark, f"{tmp_path}/parted", FIRST, LAST), LAST)) > 1
    assert _sorted(added) == plain
