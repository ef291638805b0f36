"""Declarative table of the feature groups: label expression, values and column names.

``FeatureSet`` holds what differs between the groups; the kernel in ``kpi`` does the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.functions.naming import category_stem, kpi_names, label_stem, payment_stem
from basketlens.operators.joins import join_sized
from basketlens.operators.kpi import HOUSEHOLD, TOTAL, ALL, Feature, kpi_long, pivot_features
from basketlens.operators.ranking import text_positions

RECENCY = {"L3": "last_3_flag", "L6": "last_6_flag", "L9": "last_9_flag"}
QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def recency_slices(tags: Sequence[str] = ("L3", "L6", "L9")) -> dict[str, Column]:
    return {tag: F.col(RECENCY[tag]) == "Y" for tag in tags}


def with_fractions(stem: str) -> dict[str, str]:
    """KPI names plus the shares that are fractions, ``PCT_PCT_*``."""
    names = kpi_names(stem)
    names.update({f"PCT_PCT_{k}": f"PCT_PCT_{stem}_{k.upper()}" for k in ("Spend", "Visits", "Units")})
    return names


def price_names(level: str) -> dict[str, str]:
    """Price tiers keep the mixed case of the plain KPIs."""
    names = {k: f"{level}_{k}" for k in ("Spend", "Visits", "Units", "SPV", "UPV", "SPU")}
    names.update({n: v for n, v in with_fractions(level).items() if n.startswith("PCT_")})
    return names


@dataclass(frozen=True)
class FeatureSet:
    """One feature group: ``label`` gives the value of a row, null leaves the row out."""

    group: str
    label: Callable[[], Column]
    values: tuple[str, ...]
    stem: Callable[[str, str], str]
    tags: tuple[str, ...] = ("",)
    names: Callable[[str], Mapping[str, str]] = field(default=kpi_names)

    def features(self) -> list[Feature]:
        return [
            Feature(self.group, value, self.names(self.stem(value, tag)), tag)
            for tag in self.tags
            for value in self.values
        ]

    def retagged(self, *tags: str) -> FeatureSet:
        return FeatureSet(self.group, self.label, self.values, self.stem, tags, self.names)


def _except(column: str, excluded: Sequence[str]) -> Callable[[], Column]:
    if not excluded:
        return lambda: F.col(column)
    return lambda: F.when(~F.col(column).isin(list(excluded)), F.col(column))


def _only(flag: str, value: str, label: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.when(F.col(flag) == value, label())


def _all_of(group: str, label: Callable[[], Column], values: Sequence[str]) -> Callable[[], Column]:
    """The label; a value without a column stops the run instead of getting lost in the pivot."""
    known = list(map(str, values))

    def checked() -> Column:
        text = label().cast("string")
        unknown = F.raise_error(F.concat(F.lit(f"{group} has no column for the value "), text))
        return F.when(text.isNull() | text.isin(known), text).otherwise(unknown)

    return checked


def division(values: Sequence[str]) -> FeatureSet:
    return FeatureSet(
        "DIV", _all_of("DIV", lambda: F.col("division_id"), values), tuple(map(str, values)),
        lambda v, tag: category_stem("DIV", v, tag),
    )


def department(
    values: Sequence[str], excluded: Sequence[str] = K.DEPARTMENT_EXCLUDE
) -> FeatureSet:
    return FeatureSet(
        "DEP", _all_of("DEP", _except("grouped_department_code", excluded), values), tuple(values),
        lambda v, tag: category_stem("DEP", v, tag),
    )


def section(values: Sequence[str], excluded: Sequence[str] = K.SECTION_EXCLUDE) -> FeatureSet:
    return FeatureSet(
        "SEC", _all_of("SEC", _except("grouped_section_code", excluded), values), tuple(values),
        lambda v, tag: category_stem("SEC", v, tag),
    )


def festive(values: Sequence[str] = K.FESTIVE) -> FeatureSet:
    return FeatureSet("FEST", lambda: F.col("fest_flag"), tuple(values), lambda v, _: f"FEST_{v}")


def day_part(values: Sequence[str] = K.DAY_PARTS) -> FeatureSet:
    return FeatureSet(
        "TIME", lambda: F.col("time_of_day"), tuple(values), lambda v, _: f"TIME_{v.upper()}"
    )


def store_format(renames: Mapping[str, str] = K.FORMAT_RENAME) -> FeatureSet:
    def label() -> Column:
        column, out = F.col("store_format"), F.col("store_format")
        for old, new in renames.items():
            out = F.when(column == old, F.lit(new)).otherwise(out)
        return out

    return FeatureSet(
        "SF", _all_of("SF", label, tuple(renames.values())), tuple(renames.values()), lambda v, _: f"SF_{label_stem(v)}"
    )


def store_region(values: Sequence[str]) -> FeatureSet:
    return FeatureSet(
        "SA", _all_of("SA", lambda: F.col("store_region"), values), tuple(values), lambda v, _: f"SA_{label_stem(v)}"
    )


def price_level(values: Sequence[str] = K.PRICE_LEVELS) -> FeatureSet:
    return FeatureSet(
        "PRICE", lambda: F.col("price_level"), tuple(values), lambda v, _: v, names=price_names
    )


def payment(values: Sequence[str] = K.PAYMENTS) -> FeatureSet:
    return FeatureSet(
        "PAY", lambda: F.col("payment_flag"), tuple(values), lambda v, _: payment_stem(v)
    )


OWN_STEM = ("PROMO", "MARK_DOWN")  # fixed names: the other flags have DISCOUNT_ in front


def promo(values: Sequence[str] = K.PROMO_FLAGS) -> FeatureSet:
    return FeatureSet(
        "PROMO", lambda: F.col("promo_flag"), tuple(values),
        lambda v, tag: f"{tag}_{v}" if tag else v if v in OWN_STEM else f"DISCOUNT_{v}",
    )


def promo_items(tags: Sequence[str] = tuple(RECENCY)) -> FeatureSet:
    """Units by promotion flag, one column per value and slice."""
    return FeatureSet(
        "PROMO", lambda: F.col("promo_flag"), K.PROMO_FLAGS, lambda v, tag: f"{tag}_{v}",
        tuple(tags), lambda stem: {"Units": f"{stem}_ITEMS"},
    )


def promo_day_part(
    parts: Sequence[str] = K.DAY_PARTS, flags: Sequence[str] = K.PROMO_FLAGS
) -> FeatureSet:
    return FeatureSet(
        "TIMEPROMO", lambda: F.concat_ws("_", "time_of_day", "promo_flag"),
        tuple(f"{p}_{f}" for p in parts for f in flags), lambda v, _: f"TIME_{v.upper()}",
    )


def promo_last_weekend(values: Sequence[str] = K.PROMO_FLAGS) -> FeatureSet:
    return FeatureSet(
        "LWPROMO", _only("last_weekend_flag", "Y", lambda: F.col("promo_flag")), tuple(values),
        lambda v, _: f"LAST_WKND_{v}",
    )


def quarter(values: Sequence[str] = QUARTERS) -> FeatureSet:
    return FeatureSet("QTR", lambda: F.col("app_year_qtr"), tuple(values), lambda v, _: v)


def recency(tags: Sequence[str] = tuple(RECENCY)) -> FeatureSet:
    return FeatureSet(TOTAL, lambda: F.lit(ALL), (ALL,), lambda _, tag: tag, tuple(tags))


def weekend(flag: str = "Y") -> FeatureSet:
    return FeatureSet(
        "WKND", lambda: F.col("weekend_flag"), (flag,), lambda v, _: f"WKND_FLAG_{v}"
    )


def last_weekend() -> FeatureSet:
    return FeatureSet(
        "LW", _only("last_weekend_flag", "Y", lambda: F.lit("Y")), ("Y",),
        lambda *_: "LAST_WKND", names=with_fractions,
    )


def label_map(sets: Sequence[FeatureSet]) -> dict[str, Column]:
    return {s.group: s.label() for s in sets if s.group != TOTAL}


def slices_of(sets: Sequence[FeatureSet]) -> dict[str, Column]:
    tags = [t for s in sets for t in s.tags if t]
    return recency_slices(tuple(dict.fromkeys(tags)))


def agg_features(txn: DataFrame, *sets: FeatureSet) -> DataFrame:
    """Feature groups as one wide table, from a single pass over the flagged fact."""
    long = kpi_long(txn, label_map(sets), slices_of(sets))
    return pivot_features(long, [f for s in sets for f in s.features()])


# --- statistics over a household's months and weeks ---------------------------------------

MONTHLY_STATS = ("AVG", "SD", "MIN", "MAX")
WEEKLY_STATS = ("AVG", "SD")


def _exact_avg(measure: str) -> Column:
    """Decimal average: independent of the order of the rows, and exact where it is a tie."""
    total = F.sum(F.col(measure).cast("decimal(24,4)")).cast("decimal(28,4)")
    return total / F.count(measure)


_STATS = {"AVG": _exact_avg, "SD": F.stddev_samp, "MIN": F.min, "MAX": F.max}


def stat_columns(suffix: str, stats: Sequence[str], group: str = "") -> list[Column]:
    """Aggregates of spend, visits and units; with ``group`` of their columns ``<measure>__<group>``."""
    return [
        F.coalesce(F.round(_STATS[s](f"{m}__{group}" if group else m), 2).cast("double"), F.lit(0.0)).alias(
            f"{s}_{m.upper()}_{suffix}"
        )
        for m in ("spend", "visits", "units")
        for s in stats
    ]


def period_stats(
    long: DataFrame, group: str, suffix: str, stats: Sequence[str]
) -> DataFrame:
    """Spread of the KPIs over the values of ``group``; a period without a purchase is absent."""
    return long.where(F.col("kpi_group") == group).groupBy(HOUSEHOLD).agg(*stat_columns(suffix, stats))


def agg_monthly_stats(txn: DataFrame) -> DataFrame:
    long = kpi_long(txn, {"MONTH": F.last_day("date_id")}, with_total=False)
    return period_stats(long, "MONTH", "MNTH", MONTHLY_STATS)


def agg_weekly_stats(txn: DataFrame) -> DataFrame:
    long = kpi_long(txn, {"WEEK": F.col("week_of_month")}, with_total=False)
    return period_stats(long, "WEEK", "WK", WEEKLY_STATS)


DISTINCT_COLUMNS = {
    "N_DISTINCT_DEP": "department_code",
    "N_DISTINCT_DIV": "division_id",
    "N_DISTINCT_SEC": "section_code",
    "N_DISTINCT_CLASS": "class_code",
    "N_DISTINCT_SUBCLASS": "subclass_code",
    "N_STORES": "store_id",
}


WORD_BITS = 64


def level_codes(dim: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """``key`` and for each name the number of its column's value, dense from 0; null where the value is.

    ``dim`` has one row per key. Numbers follow the sort order; a level is numbered from its distinct values.
    """
    out = dim.select(key, *[F.col(c).cast("string").alias(name) for name, c in columns.items()])
    for name in columns:
        values = out.where(F.col(name).isNotNull()).select(name).distinct()
        out = out.join(text_positions(values, name, "code"), name, "left").drop(name).withColumnRenamed("code", name)
    return out


def distinct_bits(txn: DataFrame, *levels: DataFrame) -> DataFrame:
    """``household_id, kind, word, bits``: the values a household bought, one bit each, in words of 64 numbers.

    ``levels`` come from ``level_codes``; the first column of each is a column of the fact. The fact is cut to
    the distinct keys of a household before the levels are joined, once a level table, so that no line is
    repeated per level. Words of two runs merge (``merge_bits``). A household without any value has words
    without bits.
    """
    parts, n = [], int(txn.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for codes in levels:
        key, *names = codes.columns
        seen = txn.where(F.col(HOUSEHOLD) != K.DUMMY_HOUSEHOLD).select(HOUSEHOLD, key).distinct()
        marks = F.array(*[F.struct(F.lit(n).alias("kind"), F.col(n).alias("code")) for n in names])
        parts.append(join_sized(seen, codes, key, "left", parts=n).select(HOUSEHOLD, F.inline(marks)))
    word = F.floor(F.col("code") / WORD_BITS).cast("int")
    bit = F.coalesce(F.expr(f"shiftleft(1L, cast(code % {WORD_BITS} AS int))"), F.lit(0).cast("bigint"))
    rows = reduce(DataFrame.unionAll, parts).select(HOUSEHOLD, "kind", word.alias("word"), bit.alias("bits"))
    return merge_bits(rows)


def merge_bits(*parts: DataFrame) -> DataFrame:
    """The words of several runs or regions as one table."""
    return reduce(DataFrame.unionByName, parts).groupBy(HOUSEHOLD, "kind", "word").agg(F.bit_or("bits").alias("bits"))


def agg_distinct_counts(bits: DataFrame, kinds: Sequence[str] = tuple(DISTINCT_COLUMNS)) -> DataFrame:
    """Breadth of a household's shopping from ``distinct_bits``."""
    ones = F.bit_count("bits").cast("bigint")
    return bits.groupBy(HOUSEHOLD).agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, ones)), F.lit(0)).alias(k) for k in kinds])
