"""The semi join with promotions by store: as many rows to look up as promotions, not times stores."""

import pyarrow as pa
import pyarrow.parquet as pq

from basketlens.operators import joins as J
from basketlens.operators import promo as P
from basketlens.queries import relational as Q
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


def test_semi_join_does_not_repeat_promotions_for_stores(spark, tmp_path, monkeypatch):
    sizes, join = [], J.join_semi_exists
    monkeypatch.setattr(J, "join_semi_exists", lambda df, other, on: sizes.append(other.count()) or join(df, other, on))
    for n_stores in (50, 500):
        folder = tmp_path / str(n_stores)
        folder.mkdir()
        write_tables(folder, n_stores)
        got = Q.join_semi_exists(spark, str(folder))
        ranges = P.promo_store_ranges(R.promotions(spark, folder), R.promo_zones(spark, folder), R.stores(spark, folder))
        want = R.items(spark, folder).select(*Q.LINE).join(ranges, ["upc_id", "store_id"], "left_semi").select(*Q.LINE)
        assert sorted(got.collect()) == sorted(want.collect()) and 0 < got.count() < 60
    assert sizes[0] == sizes[1] <= 60
