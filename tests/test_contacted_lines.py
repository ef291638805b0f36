"""Only the lines of contacted households are joined with their missions."""

from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq

from basketlens.queries import modelling as M
from basketlens.sources import roles as R


def write_tables(path, n_stores):
    """Products on promotion in the one zone of ``n_stores`` stores, and a line of each in a store of the zone."""
    n = 60
    write = lambda name, **columns: pq.write_table(pa.table(columns), f"{path}/{name}.parquet")
    write("part", p_partkey=[25 * k + 3 for k in range(n)], p_size=[k % 9 + 1 for k in range(n)], p_type=["PROMO"] * n)
    write("supplier", s_suppkey=list(range(n_stores)), s_nationkey=[3] * n_stores)
    write("nation", n_nationkey=[3], n_regionkey=[0])
    write("region", r_regionkey=[0], r_name=["ASIA"])
    write("lineitem", l_orderkey=[1] * n, l_partkey=[25 * k + 3 for k in range(n)], l_suppkey=[k % 50 for k in range(n)],
          l_extendedprice=[1.0] * n, l_discount=[0.0] * n, l_quantity=[1.0] * n)


def test_lines_of_given_baskets(spark, tmp_path):
    write_tables(tmp_path, 50)
    pq.write_table(pa.table({
        "o_orderkey": [1, 2], "o_custkey": [7, 8], "o_orderdate": [date(2000, 1, 1)] * 2, "o_orderstatus": ["P", "O"],
        "o_orderpriority": ["1-URGENT", None], "o_totalprice": [1.0, 2.0]}), f"{tmp_path}/orders.parquet")
    headers = R.baskets(spark, str(tmp_path))
    assert R.sales(spark, str(tmp_path), headers.where("household_id = 8")).count() == 0
    assert sorted(R.sales(spark, str(tmp_path), headers).collect()) == sorted(R.sales(spark, str(tmp_path)).collect())


def test_only_lines_of_contacted_households_meet_their_missions(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M.H, "contact_features", lambda details, fact, groups: seen.append((details, fact)))
    M.assemble_contacted(spark, "/root/testdata/sf0.01")
    details, fact = seen[0]
    assert fact.count() > 0 and fact.join(details, "household_id", "left_anti").count() == 0
