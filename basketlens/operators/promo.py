"""Promotion dimension: scope, expansion, and the promotion flag of the fact."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.config import Window
from basketlens.functions.columns import bucket_label
from basketlens.functions.sizing import broadcast_if_small

PROMO_COLUMNS = (
    "promo_id", "promo_offer_id", "change_type", "promo_start_date", "promo_end_date",
    "promo_storegroup_id", "upc_id", "source",
)


def active_by_type(promos: DataFrame) -> DataFrame:
    """Active promotions that change a price."""
    return promos.where((F.col("active_flag") == "Y") & F.col("change_type").isNotNull())


def active_by_state(promos: DataFrame) -> DataFrame:
    """Active promotions that are not cancelled (no state counts as live) and end after they start."""
    state = F.coalesce("state_desc", F.lit("NA"))
    return promos.where(
        (F.col("active_flag") == "Y")
        & (state != "Cancelled")
        & (F.col("promo_start_date") <= F.col("promo_end_date"))
    ).withColumn("state_desc", state)


def promo_week_scope(calendar: DataFrame, start: date, end: date) -> DataFrame:
    """Calendar widened to the whole promotion weeks that the window touches."""
    inside = calendar.where(F.col("date_id").between(start, end))
    week = F.col("promoweek_id")
    return calendar.where(
        week.between(
            inside.agg(F.min("promoweek_id")).scalar(), inside.agg(F.max("promoweek_id")).scalar()
        )
    )


def clipped(promos: DataFrame, window: Window) -> DataFrame:
    """Promotions cut to the window. The cut comes before any expansion, so that a promotion
    of years never turns into rows outside the window."""
    return (
        promos.withColumns(
            {
                "promo_start_date": F.greatest("promo_start_date", F.lit(window.start)),
                "promo_end_date": F.least("promo_end_date", F.lit(window.end)),
            }
        )
        .where(F.col("promo_start_date") <= F.col("promo_end_date"))
    )


def promo_days(promos: DataFrame, window: Window) -> DataFrame:
    """One row per promotion and active day: the range join as an explosion."""
    days = F.sequence("promo_start_date", "promo_end_date", F.expr("interval 1 day"))
    return clipped(promos, window).withColumn("date_id", F.explode(days))


def store_formats(stores: DataFrame, formats: Iterable[int] = K.STORE_FORMATS) -> DataFrame:
    fmt = F.col("format_id")
    name = bucket_label(fmt, {"GOFRESH": (5,), "TALAD": (4,), "HDE": (1, 2, 3)}, F.lit(None))
    return (
        stores.where(fmt.isin(list(formats)))
        .select("store_id", name.alias("store_format_name"))
        .dropDuplicates()
    )


def promo_store_ranges(promos: DataFrame, zones: DataFrame, stores: DataFrame) -> DataFrame:
    """Promotion × store of its zone, still as date ranges."""
    zone_stores = zones.select(
        F.col("zone_id").alias("promo_storegroup_id"), "store_id"
    ).dropDuplicates()
    return (
        active_by_type(promos)
        .select(*PROMO_COLUMNS)
        .dropDuplicates()
        .join(zone_stores, "promo_storegroup_id")
        .join(store_formats(stores), "store_id")
    )


def store_classes(zones: DataFrame, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``store_id, store_class`` and ``zone_id, store_class``, each with ``by``: stores that are in the same zones
    are one class, named by its smallest store. Promotions times classes are few, promotions times stores not."""
    of_store = zones.groupBy(*by, "store_id").agg(F.sort_array(F.collect_set("zone_id")).alias("zones"))
    named = of_store.groupBy(*by, "zones").agg(F.min("store_id").alias("store_class"))
    members = of_store.join(named, [*by, "zones"]).select(*by, "store_id", "store_class")
    return members, named.select(*by, "store_class", F.explode("zones").alias("zone_id"))


def class_tables(zones: DataFrame, stores: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``store_id, store_class`` of the stores of all formats wanted, and both tables with a class for its stores:
    ``promo_store_ranges`` of these has a row per promotion and class, which grows with the products alone."""
    wanted = store_formats(stores).select("store_id").distinct()
    members, classes = store_classes(zones.join(wanted, "store_id", "left_semi"))
    firsts = classes.select("store_class").distinct().withColumnRenamed("store_class", "store_id")
    return members, classes.withColumnRenamed("store_class", "store_id"), stores.join(firsts, "store_id", "left_semi")


def promo_class_ranges(promos: DataFrame, zones: DataFrame, stores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of the store classes, and promotion × class of its zone as date ranges. Stores of other
    formats are in no class."""
    wanted = store_formats(stores).select("store_id").distinct()
    members, classes = store_classes(zones.join(wanted, "store_id", "left_semi"))
    ranges = active_by_type(promos).select(
        "upc_id", "promo_start_date", "promo_end_date", F.col("promo_storegroup_id").alias("zone_id"))
    return members, ranges.join(classes, "zone_id").drop("zone_id")


EXPANDED_ROWS = 8_000_000  # that one task writes
CHUNK = 512  # stores that a row becomes, some


def dealt(df: DataFrame, n_rows: Column) -> DataFrame:
    """``df`` in as many even parts as ``n_rows``, the rows that each row will become, ask for.

    The tables before an expansion are small and would be read by one task; what they become is not."""
    total = df.agg(F.sum(n_rows.cast("double"))).first()[0] or 0
    return df.repartition(int(total // EXPANDED_ROWS) + 1)


def dealt_chunks(
    rows: DataFrame, members: DataFrame, on: Sequence[str], n_days: Column,
) -> tuple[DataFrame, DataFrame]:
    """``rows`` per chunk of the distinct stores of ``members`` with the same ``on``, and the stores with their chunk.

    The rows are dealt per chunk, while they are few: neither a zone of many stores nor a product in all of them
    makes a long task, and no expanded row moves."""
    members = members.distinct()
    sizes = members.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    of = members.join(sizes, list(on)).withColumn("chunk", F.pmod(F.xxhash64("store_id"), F.col("chunks"))).drop("chunks")
    chunks = of.groupBy(*on, "chunk").agg(F.count(F.lit(1)).alias("n_stores"))
    return dealt(rows.join(chunks, list(on)), n_days * F.col("n_stores")).drop("n_stores"), of


def each_store(rows: DataFrame, members: DataFrame, on: Sequence[str], days: Column) -> DataFrame:
    """``rows`` times their ``days``, as ``date_id``, times the distinct stores of ``members`` with the same ``on``.

    A chunk of stores is one list that a row finds once; days and stores are then two nested loops of the task, the
    longer one inside, without a join."""
    wide, of = dealt_chunks(rows, members, on, F.size(days))
    store = F.struct(*[c for c in members.columns if c not in on])  # not null, so that no store is left out of its list
    listed = of.groupBy(*on, "chunk").agg(F.collect_list(store).alias("stores"))
    dated = wide.join(broadcast_if_small(listed, members.distinct()), [*on, "chunk"]).drop("chunk").withColumn("date_id", F.explode(days))
    return dated.select(*[c for c in dated.columns if c != "stores"], F.inline("stores"))


def promo_expand_zone(
    promos: DataFrame, zones: DataFrame, stores: DataFrame, window: Window
) -> DataFrame:
    """``upc_id, store_id, date_id``: every product on promotion, per store and day.

    Ranges meet as bits of (product, store class, bin), so nothing is left to be told apart among the
    expanded rows: they are written by the tasks that expand them and move nowhere.
    """
    members, ranges = promo_class_ranges(promos, zones, stores)
    index = with_days(promo_index(ranges, window, ["upc_id", "store_class"]))
    rows = each_store(index, members.join(store_formats(stores), "store_id"), ["store_class"], F.col("days"))
    return rows.select("upc_id", "store_id", "date_id", "store_format_name")


def promo_expand_store_or_zone(promos: DataFrame, zones: DataFrame, window: Window) -> DataFrame:
    """Newer promotions, set for a zone or for a store, as one row per store and day."""
    by_zone, by_store = _levels(promos, window)
    days = F.sequence("promo_start_date", "promo_end_date", F.expr("interval 1 day"))
    of_zone = zones.select(F.col("zone_id").alias("promo_storegroup_id"), "source", "store_id")
    by_zone = each_store(by_zone, of_zone, ["promo_storegroup_id", "source"], days)
    return by_zone.unionByName(dealt(by_store, F.size(days)).withColumn("date_id", F.explode(days)))


def _levels(promos: DataFrame, window: Window) -> tuple[DataFrame, DataFrame]:
    """Promotions set for a zone, without a store, and those set for a store; ranges cut to the window."""
    level = (
        F.when(F.col("promo_storegroup_id").isNotNull(), "zone_lvl")
        .when(F.col("store_id").isNotNull(), "store_lvl")
        .otherwise("NA")
    )
    scoped = clipped(active_by_state(promos).withColumn("promozone_level", level), window)
    return scoped.where("promozone_level = 'zone_lvl'").drop("store_id"), scoped.where("promozone_level = 'store_lvl'")


SIDE_KEYS = ("store_id", "upc_id", "date_id", "promo_id", "promozone_level", "source",
             "promo_offer_id", "change_type")


def promo_side(promos: DataFrame, zones: DataFrame, window: Window) -> DataFrame:
    """Side of the offer each (store, product, day) of a promotion stands on: distinct ``SIDE_KEYS`` and ``upc_side``.

    Linked offers of the newer source list their condition products in a column of their own; these get
    rows too. The side follows from the promotion alone, so equal rows meet as bits of days per store class
    before the expansion, and the expanded rows are distinct as they are written.
    """
    by_zone, by_store = (_sides(rows) for rows in _levels(promos, window))
    keys = [k for k in (*SIDE_KEYS, "upc_side") if k not in ("store_id", "date_id")]
    members, classes = store_classes(zones, ["source"])
    ranges = by_zone.join(classes.withColumnRenamed("zone_id", "promo_storegroup_id"), ["promo_storegroup_id", "source"])
    index = with_days(promo_index(ranges, window, [*keys, "store_class"]))
    wide, of = dealt_chunks(index, members, ["source", "store_class"], F.size("days"))
    # rows of this width are written faster store by store than from lists of stores (measured, see README)
    of_zone = wide.join(broadcast_if_small(of, members.distinct()), ["source", "store_class", "chunk"]).drop("chunk", "store_class")
    of_store = dealt(with_days(promo_index(by_store, window, [*keys, "store_id"])), F.size("days"))
    return of_zone.unionByName(of_store).withColumn("date_id", F.explode("days")).select(*SIDE_KEYS, "upc_side")


def _sides(promos: DataFrame) -> DataFrame:
    offer, source = F.col("promo_offer_id"), F.col("source")
    cond, reward = F.col("upc_id_cond"), F.col("upc_id_reward")
    linked = offer.isin(4, 5)
    old_linked = linked & (source == "rms12")
    new_linked = linked & (source == "rms19")
    side = (
        F.when((offer == 1) | new_linked, "reward")
        .when(offer.isin(2, 3), "cond")
        .when(old_linked & cond.isNull() & reward.isNotNull(), "reward")
        .when(old_linked & cond.isNotNull() & reward.isNull(), "cond")
        .otherwise("INVALID")
    )
    # A linked row stands for itself and for its condition product: one pass instead of a union.
    own = F.struct(F.col("upc_id"), side.alias("upc_side"))
    other = F.struct(cond.alias("upc_id"), F.lit("cond").alias("upc_side"))
    both = F.when(new_linked, F.array(own, other)).otherwise(F.array(own))
    return promos.select(*[c for c in promos.columns if c != "upc_id"], F.inline(both))


BIN_DAYS = 64  # a day of a bin is a bit of a long


def _day(column: str) -> Column:
    return F.datediff(F.col(column), F.lit("1970-01-01"))


def with_days(index: DataFrame) -> DataFrame:
    """A ``promo_index`` with the list of its ``days`` in place of bin and bits."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(BIN_DAYS - 1)), lambda n: F.getbit(F.col("on_days"), n) == 1)
    days = F.transform(bits, lambda n: F.date_add(F.lit("1970-01-01").cast("date"), F.col("promo_bin") * BIN_DAYS + n))
    return index.withColumn("days", days).drop("promo_bin", "on_days")


def promo_index(ranges: DataFrame, window: Window, keys: Sequence[str] = ("upc_id", "store_id")) -> DataFrame:
    """``upc_id, store_id, promo_bin, on_days``: the days of each bin that ``keys`` are on promotion,
    as bits. Overlapping ranges fall together on the map side; nothing is ordered or listed."""
    start, end = _day("promo_start_date"), _day("promo_end_date")
    bins = F.sequence(F.floor(start / BIN_DAYS).cast("int"), F.floor(end / BIN_DAYS).cast("int"))
    binned = clipped(ranges, window).select(
        *keys, start.alias("start"), end.alias("end"), F.explode(bins).alias("promo_bin"))
    first = F.greatest(F.col("start") - F.col("promo_bin") * BIN_DAYS, F.lit(0))
    last = F.least(F.col("end") - F.col("promo_bin") * BIN_DAYS, F.lit(BIN_DAYS - 1))
    ones = F.lit(-1).cast("bigint")
    days = F.call_function("shiftleft", ones, first).bitwiseAND(
        F.call_function("shiftrightunsigned", ones, F.lit(BIN_DAYS - 1) - last))
    return binned.withColumn("days", days).groupBy(*keys, "promo_bin").agg(
        F.bit_or("days").alias("on_days"))


def flag_promo(df: DataFrame, ranges: DataFrame, window: Window) -> DataFrame:
    """PROMO where the product is on promotion in the store that day, else MARK_DOWN or NONE.

    Ranges are not expanded to days: the fact joins ``promo_index`` by product, store and bin of its day, a key
    that splits a product which one store sells all the time, and looks its day up in that bin's bits. A row
    matches one entry at most, so the row count stays.
    """
    return _flagged(df, promo_index(ranges, window), ["upc_id", "store_id"], df.columns)


def flag_zone_promo(df: DataFrame, promos: DataFrame, zones: DataFrame, stores: DataFrame, window: Window) -> DataFrame:
    """``flag_promo`` for promotions by zone: each row gets the class of its store and looks up the class, so
    that promotions are never repeated for each store of their zone."""
    members, ranges = promo_class_ranges(promos, zones, stores)
    classed = df.join(broadcast_if_small(members, zones), "store_id", "left")
    keys = ["upc_id", "store_class"]
    return _flagged(classed, promo_index(ranges, window, keys), keys, df.columns)


def _flagged(df: DataFrame, index: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    on = F.getbit("on_days", F.pmod(_day("date_id"), F.lit(BIN_DAYS))) == 1
    reason = F.when(on, "P").when(F.col("discount_amt") > 0, "M").otherwise("NONE")
    flag = (
        F.when(F.col("discount_reason_code") == "P", "PROMO")
        .when(F.col("discount_reason_code") == "M", "MARK_DOWN")
        .otherwise("NONE")
    )
    return (
        df.withColumn("promo_bin", F.floor(_day("date_id") / BIN_DAYS).cast("int"))
        .join(index, [*keys, "promo_bin"], "left")
        .select(*[F.col(c) for c in columns], reason.alias("discount_reason_code"))
        .withColumn("promo_flag", flag)
    )
