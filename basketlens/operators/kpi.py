"""The KPI kernel: spend, visits and units of a household along any set of dimensions.

One pass serves any number of dimensions and overlapping recency slices:

1. every fact row is labelled once per dimension and summed per (household, basket, label),
   with map-side combining, so that a household with very many baskets spreads over the tasks;
2. baskets are counted and summed per (household, label). A basket is one row by then, which
   makes the distinct count a plain count;
3. the short result is hashed by household once, and pivots need no further exchange.

The pseudo dimension ``TOTAL`` yields the divisors of all shares from the same pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from basketlens.config import DUMMY_HOUSEHOLD
from basketlens.functions.columns import percent_of, safe_ratio
from basketlens.operators.joins import salted, spread_over

HOUSEHOLD = "household_id"
BASKET = "transaction_uid"
TOTAL = "TOTAL"
ALL = "ALL"
MEASURES = ("spend", "visits", "units")


def _measure(name: str, tag: str) -> str:
    return f"{name}_{tag}" if tag else name


def kpi_long(
    txn: DataFrame,
    groups: Mapping[str, Column],
    slices: Mapping[str, Column] | None = None,
    with_total: bool = True,
    by: Sequence[str] = (),
    parts: int | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """``household_id, kpi_group, kpi_value`` with spend, visits and units, also per slice.

    ``groups`` names each dimension; a row whose expression is null is left out of it.
    ``slices`` are conditions on the row; they may overlap. The dummy household is dropped.
    ``by`` names further columns that split the result, such as a period. With ``parts`` the rows move once,
    to so many tasks by household and ``by``, before they are repeated per dimension, and the result stays there.
    That suits households of few rows; the baskets of those in ``heavy`` (``heavy_keys`` of the household) are dealt
    to several tasks, and the sums, which are few for a household then, move as well.
    """
    slices = dict(slices or {})
    labels = dict(groups)
    if with_total:
        labels = {TOTAL: F.lit(ALL), **labels}
    marks = [
        F.struct(F.lit(i).alias("group_no"), expr.cast("string").alias("kpi_value"))
        for i, expr in enumerate(labels.values())
    ]
    amount, scale = _whole_amount(txn, "net_spend_amt")
    rows = txn.where(F.col(HOUSEHOLD) != DUMMY_HOUSEHOLD)
    own = [HOUSEHOLD, *by]
    if heavy is not None:
        rows = salted(rows, HOUSEHOLD, F.broadcast(heavy), spread_over([BASKET]))
        own.append("__salt")
    if parts is not None:
        rows = rows.repartition(parts, *own)
    # Flags are worked out once per row, before the row is repeated per dimension.
    rows = rows.select(
        *own,
        BASKET,
        amount.alias("spend"),
        F.col("unit").alias("units"),
        *[F.coalesce(cond, F.lit(False)).alias(f"in_{tag}") for tag, cond in slices.items()],
        F.array(*marks).alias("marks"),
    )
    labelled = rows.select(
        *own, BASKET, "spend", "units", *[f"in_{t}" for t in slices], F.inline("marks")
    ).where(F.col("kpi_value").isNotNull())

    def shown(measure: str) -> Column:
        total = F.col(measure)
        if measure.startswith("spend") and scale is not None:
            return (total / F.lit(scale)).alias(measure)
        return total if measure.startswith("visits") else total.cast("double").alias(measure)

    by_basket = [F.sum("spend").alias("spend"), F.sum("units").alias("units")]
    by_value = [
        F.sum("spend").alias("spend"),
        F.count(BASKET).alias("visits"),
        F.sum("units").alias("units"),
    ]
    for tag in slices:
        hit = F.col(f"in_{tag}")
        by_basket += [
            F.sum(F.when(hit, F.col("spend"))).alias(f"spend_{tag}"),
            F.sum(F.when(hit, F.col("units"))).alias(f"units_{tag}"),
            F.max(hit).alias(f"in_{tag}"),
        ]
        by_value += [
            F.sum(f"spend_{tag}").alias(f"spend_{tag}"),
            F.count(F.when(F.col(f"in_{tag}"), F.col(BASKET))).alias(f"visits_{tag}"),
            F.sum(f"units_{tag}").alias(f"units_{tag}"),
        ]
    names = F.array(*[F.lit(g) for g in labels])
    measures = [_measure(m, t) for t in ("", *slices) for m in MEASURES]
    summed = (
        labelled.groupBy(*own, BASKET, "group_no", "kpi_value")
        .agg(*by_basket)
        .groupBy(*own, "group_no", "kpi_value")
        .agg(*by_value)
    )
    if heavy is not None:
        moved = summed.drop("__salt") if parts is None else summed.drop("__salt").repartition(parts, HOUSEHOLD, *by)
        summed = moved.groupBy(HOUSEHOLD, *by, "group_no", "kpi_value").agg(*[F.sum(m).alias(m) for m in measures])
    return summed.select(
        HOUSEHOLD, *by, F.get(names, F.col("group_no")).alias("kpi_group"), "kpi_value", *map(shown, measures)
    )


def _whole_amount(df: DataFrame, column: str) -> tuple[Column, float | None]:
    """Exact decimals as whole numbers of their last digit, and what to divide sums by.

    Long sums are exact like decimal ones, and several times faster and shorter in a shuffle.
    A sum that does not fit raises an error. Other types stay as they are.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, DecimalType) and kind.precision <= 18:
        scale = 10**kind.scale
        return (F.col(column) * F.lit(scale)).cast("bigint"), float(scale)
    return F.col(column), None


@dataclass(frozen=True)
class Feature:
    """KPIs of one pivot value: where they come from and how their columns are called."""

    group: str
    value: str
    names: Mapping[str, str]
    tag: str = ""

    @property
    def key(self) -> str:
        return f"{self.group}={self.value}"


def pivot_long(long: DataFrame, keys: Sequence[str], measures: Iterable[str]) -> DataFrame:
    """One row per household, columns ``<group>=<value>_<measure>``, null where absent.

    The values are given, so that no job has to look for them. Rows are hashed by household
    while they are still narrow; the wide aggregation then runs without an exchange.
    """
    key = F.concat_ws("=", "kpi_group", "kpi_value")
    keyed = long.withColumn("kpi_key", key)
    return _first_pivot(keyed, "kpi_key", keys, list(measures))


def _first_pivot(df: DataFrame, dim: str, values: Sequence[str], cells: list[str]) -> DataFrame:
    # a household moves as a few short rows and becomes a wide one: with the number given, adaptive execution
    # does not merge parts by the bytes moved
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = (
        df.where(F.col(dim).isin(list(values)))
        .select(HOUSEHOLD, dim, *cells)
        .repartition(parts, HOUSEHOLD)
        .groupBy(HOUSEHOLD)
        .pivot(dim, list(values))
        .agg(*[F.first(c).alias(c) for c in cells])
    )
    if len(cells) > 1:
        return wide
    # A pivot of one aggregate names its columns by the value alone.
    return wide.withColumnsRenamed({v: f"{v}_{cells[0]}" for v in values})


def _ratio_sql(top: str, bottom: str) -> str:
    return f"coalesce(try_divide(cast({top} AS double), cast({bottom} AS double)), 0D)"


def _percent_sql(part: str, total: str) -> str:
    return f"coalesce(cast(try_divide({part} * 100, {total}) AS double), 0D)"


def kpi_columns(feature: Feature) -> list[str]:
    """Named KPI expressions of one feature over a pivoted table that holds ``TOTAL=ALL``.

    SQL text: a wide table has thousands of them, and text is built much faster than columns.
    """
    spend, visits, units = (
        f"coalesce(`{feature.key}_{_measure(m, feature.tag)}`, 0)" for m in MEASURES
    )
    all_spend, all_visits, all_units = (f"`{TOTAL}={ALL}_{m}`" for m in MEASURES)
    kpis = {
        "Spend": spend,
        "Visits": visits,
        "Units": units,
        "SPV": _ratio_sql(spend, visits),
        "UPV": _ratio_sql(units, visits),
        "SPU": _ratio_sql(spend, units),
        "PCT_Spend": _percent_sql(spend, all_spend),
        "PCT_Visits": _percent_sql(visits, all_visits),
        "PCT_Units": _percent_sql(units, all_units),
        "PCT_PCT_Spend": _ratio_sql(spend, all_spend),
        "PCT_PCT_Visits": _ratio_sql(visits, all_visits),
        "PCT_PCT_Units": _ratio_sql(units, all_units),
    }
    return [f"{kpis[kpi]} AS `{name}`" for kpi, name in feature.names.items()]


def pivot_features(long: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """Wide table of the given features, only households that have at least one of them."""
    keys = list(dict.fromkeys([f"{TOTAL}={ALL}", *(f.key for f in features)]))
    tags = list(dict.fromkeys(["", *(f.tag for f in features)]))
    measures = [_measure(m, t) for t in tags for m in MEASURES]
    wide = pivot_long(long, keys, measures)
    seen = " OR ".join(f"`{f.key}_{_measure('visits', f.tag)}` > 0" for f in features)
    return wide.where(seen).selectExpr(HOUSEHOLD, *[c for f in features for c in kpi_columns(f)])


def agg_total(txn: DataFrame) -> DataFrame:
    """Spend, visits and units of each household over the whole period."""
    return kpi_long(txn, {}).select(
        HOUSEHOLD,
        F.col("spend").alias("Total_Spend"),
        F.col("visits").alias("Total_Visits"),
        F.col("units").alias("Total_Units"),
    )


def agg_kpi_ratios(txn: DataFrame, dim: str, totals: DataFrame | None = None) -> DataFrame:
    """Long form: one row per household and value of ``dim`` with ratios and shares."""
    long = kpi_long(txn, {"DIM": F.col(dim)}, with_total=False)
    totals = agg_total(txn) if totals is None else totals
    spend, visits, units = (F.col(m) for m in MEASURES)
    return long.join(totals, HOUSEHOLD).select(
        HOUSEHOLD,
        F.col("kpi_value").alias(dim),
        spend.alias("Spend"),
        visits.alias("Visits"),
        units.alias("Units"),
        safe_ratio(spend, visits).alias("SPV"),
        safe_ratio(units, visits).alias("UPV"),
        safe_ratio(spend, units).alias("SPU"),
        percent_of(spend, F.col("Total_Spend")).alias("PCT_Spend"),
        percent_of(visits, F.col("Total_Visits")).alias("PCT_Visits"),
        percent_of(units, F.col("Total_Units")).alias("PCT_Units"),
    )


def pivot_kpi(
    long: DataFrame, dim: str, values: Sequence[str], kpis: Sequence[str]
) -> DataFrame:
    """Pivot of long KPIs: columns ``<value>_<KPI>``, 0 where a household lacks the value."""
    return _first_pivot(long, dim, values, list(kpis)).fillna(0)


def rename_kpi(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """All renames in one projection."""
    return df.withColumnsRenamed(dict(names))


def pivot_values(dim_table: DataFrame, column: str) -> list[str]:
    """All values of a column of a dimension table for a pivot, sorted."""
    values = dim_table.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("v"))
    return sorted(row.v for row in values.distinct().collect())
