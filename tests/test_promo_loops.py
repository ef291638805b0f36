"""Expansion of promotions: days and stores as nested loops over lists."""

from datetime import date

import pytest

from basketlens.config import Window
from basketlens.operators import promo as P

WINDOW = Window(date(2000, 1, 1), date(2000, 12, 31))


def test_large_zones_and_stores_without_a_number(spark):
    """Zone 1 has more stores than a chunk, one of them without a number."""
    n = 2 * P.CHUNK + 40
    columns = "promo_id long, upc_id long, promo_storegroup_id long, store_id long, promo_offer_id int, source string, "
    columns += "upc_id_cond long, upc_id_reward long, promo_start_date date, promo_end_date date, change_type string, active_flag string, state_desc string"
    day = lambda k: date(2000, 3, k)
    promos = spark.createDataFrame([
        (1, 1, 1, None, 1, "a", None, None, day(1), day(3), "P", "Y", None),
        (2, 2, None, 9, 2, "a", None, None, day(2), day(2), "P", "Y", None)], columns)
    zones = spark.createDataFrame([(1, s, "a") for s in [None, 1, *range(1, n)]], "zone_id long, store_id long, source string")
    got = P.promo_expand_store_or_zone(promos, zones, WINDOW)
    want = {(1, s, day(k)) for s in [None, *range(1, n)] for k in (1, 2, 3)} | {(2, 9, day(2))}
    found = [(r.promo_id, r.store_id, r.date_id) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want


@pytest.mark.parametrize("name", ["promo_expand_zone", "promo_expand_store_or_zone"])
def test_days_and_stores_are_loops_without_a_join(spark, name):
    """A row finds its list of stores once; no join gives a row per store, which the days would repeat."""
    from __spark_entry__ import queries

    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    days = next(n for n, line in enumerate(plan) if "Generate explode" in line and "date_id" in line)
    assert any("Generate inline(stores" in line for line in plan[:days])
    assert not any("Join" in line for line in plan[:days])
