"""Slowly changing customer segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.operators.joins import join_self_offset, join_sized
from basketlens.sources.calendar import bounded


def segment_snapshot(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of a segment history; household ids become bigint."""
    return table.select(
        *[F.col(c).cast("bigint").alias(c) if c == "household_id" else F.col(c) for c in columns]
    ).dropDuplicates()


#: Columns of the segment histories, and the new name of a column where it has one.
SNAPSHOTS = {
    "truprice": ("household_id", "truprice_seg_desc", "period_id"),
    "facts": ("household_id", "facts_seg_desc", "week_id"),
    "prefer_store": ("household_id", "pref_store_id", "pref_store_format", "pref_store_region", "period_id"),
    "lifestage": ("household_id", "lifestage_seg_name", "mapping_quarter_id"),
}
RENAMED = {"mapping_quarter_id": "quarter_id"}


def segment_tables(histories: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The snapshots of all given histories by the name of the segment."""
    return {name: segment_snapshot(table, SNAPSHOTS[name]).withColumnsRenamed(RENAMED) for name, table in histories.items()}


def lifecycle_shift(history: DataFrame, names: DataFrame, calendar: DataFrame) -> DataFrame:
    """Life-cycle name of a household, valid for the week after the one it was computed for."""
    following = bounded(join_self_offset(calendar))
    return (
        history.join(names, "lifecycle_detailed_code")
        .join(following, "week_id")
        .select(
            F.col("household_id").cast("bigint").alias("household_id"),
            "lifecycle_name",
            F.col("next_week_id").alias("week_id"),
        )
    )


def scoped(table: DataFrame, weeks: tuple[int, int], columns: Sequence[str], **fixed: str) -> DataFrame:
    """Distinct ``columns`` of the rows of some weeks whose other columns have given values."""
    wanted = F.col("week_id").between(*weeks)
    for column, value in fixed.items():
        wanted &= F.col(column) == value
    return table.where(wanted).select(*columns).distinct()


MISSION_COLUMNS = ("transaction_concat", "transaction_uid", "shopping_missions_id", "week_id")


def shopping_mission_scope(missions: DataFrame, start_week: int, end_week: int, country: str = "th") -> DataFrame:
    return scoped(missions, (start_week, end_week), MISSION_COLUMNS, country=country)


# Period key of each segment table, its columns and what a household without a row gets.
UNKNOWN, NONE = "Unclassified", "NA"
SEGMENTS: dict[str, tuple[str, dict[str, str]]] = {
    "price": ("period_id", {"truprice_seg_desc": UNKNOWN}),
    "facts": ("week_id", {"facts_seg_desc": UNKNOWN}),
    "life_stage": ("quarter_id", {"lifestage_seg_name": UNKNOWN}),
    "store": ("period_id", dict.fromkeys(("pref_store_id", "pref_store_format", "pref_store_region"), NONE)),
    "life_cycle": ("week_id", {"lifecycle_name": UNKNOWN}),
}
STORE_FORMATS = {"missing": NONE}
STORE_AREAS = {"BKK": "BKK", NONE: NONE}


def _translated(column: str, names: dict[str, str], other: Column) -> Column:
    found = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(found[F.col(column)], other)


def with_segment(df: DataFrame, table: DataFrame, period: str, defaults: dict[str, str]) -> DataFrame:
    """``df`` with one segment's columns, looked up by household and period."""
    found = df.join(table, ["household_id", period], "left")
    return found.withColumns({c: F.coalesce(c, F.lit(value)) for c, value in defaults.items()})


def join_segments(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """The segments of ``SEGMENTS``, one table each in that order, and the preferred store's area."""
    for table, (period, defaults) in zip(tables, SEGMENTS.values(), strict=True):
        df = with_segment(df, table, period, defaults)
    return df.withColumns({
        "pref_store_format": _translated("pref_store_format", STORE_FORMATS, F.col("pref_store_format")),
        "perf_store_area": _translated("pref_store_region", STORE_AREAS, F.lit("UPC")),
    })


def txn_enrich_contacted(
    txn: DataFrame, contacted: DataFrame, single_tender: DataFrame, missions: DataFrame
) -> DataFrame:
    """Rows of contacted households, paid by one kind of tender, with their shopping mission."""
    mission = missions.select(*[c for c in missions.columns if c != "transaction_uid"])
    of_known = join_sized(txn, contacted.select("household_id"), "household_id", "left_semi")
    with_mission = of_known.join(mission, ["transaction_concat", "week_id"], "left")
    return with_mission.join(single_tender, "transaction_uid")
