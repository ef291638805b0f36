"""Joins of the fact with its dimensions, and folds of household tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.config import Window
from basketlens.functions.sizing import BROADCAST_BYTES, estimated_bytes
from basketlens.sources.calendar import bounded

HOUSEHOLD = "household_id"
HOT_SHARE = 0.002  # of all rows; a key with more of them is dealt to several tasks
HOT_ROWS = 100_000  # that one task copes with in any case
TRACKED = 8_192  # keys the sketch follows: it errs by 3.5 / TRACKED of the rows, a quarter of HOT_SHARE


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def key_sketch(df: DataFrame, **keys: str | Sequence[str]) -> DataFrame:
    """One row: the number of rows, and for each name the most frequent values of its key columns.

    Frequent-item sketches of the hashed keys, merged on the map side, from one pass over the key
    columns. Null keys are counted like others, as an outer join piles them up too.
    """
    hashed = df.select(*[F.xxhash64(*_keys(on)).alias(name) for name, on in keys.items()])
    most = round(1 / HOT_SHARE)
    tops = [F.expr(f"approx_top_k(`{name}`, {most}, {TRACKED})").alias(name) for name in keys]
    return hashed.agg(F.count(F.lit(1)).alias("n"), *tops)


def heavy_keys(sketch: DataFrame, name: str, share: float = HOT_SHARE, least: int = HOT_ROWS) -> DataFrame:
    """``__key`` (hash) and ``__salts`` of the keys of a sketch that have more than ``share`` of the rows
    and more than ``least``: ``1 / HOT_SHARE`` rows at most."""
    rows = sketch.select("n", F.inline(name).alias("item", "count"))
    fair = F.greatest(F.col("n") * share, F.lit(float(least)))
    return rows.where(F.col("count") > fair).select(
        F.col("item").alias("__key"), F.ceil(F.col("count") / fair).cast("int").alias("__salts"))


def salted(df: DataFrame, on: str | Sequence[str], heavy: DataFrame, salt: Column) -> DataFrame:
    """``df`` with the column ``__salt``, which may refer to ``__salts``, null for a key that is not in ``heavy``."""
    marked = df.withColumn("__key", F.xxhash64(*_keys(on))).join(heavy, "__key", "left")
    return marked.withColumn("__salt", salt).drop("__key", "__salts")


def spread_over(columns: Sequence[str]) -> Column:
    """The salt of a row by the hash of ``columns``; 0 where its key is not heavy."""
    return F.coalesce(F.pmod(F.xxhash64(*columns), F.col("__salts")).cast("int"), F.lit(0))


def join_hot(
    df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner",
    heavy: DataFrame | None = None, spread_by: Sequence[str] = (), parts: int | None = None,
) -> DataFrame:
    """Shuffle join whose left side may have any number of rows of one key.

    Rows of a heavy key are dealt to several salts by the hash of ``spread_by`` (default: all other
    columns), and only the table's rows with that key are repeated for each; all other keys have salt 0
    and move once. The salt is part of the join key, so a later aggregation cannot reuse a partitioning
    by the key alone. ``heavy`` comes from ``heavy_keys``; its size is bounded, so it is broadcast.
    With ``parts`` adaptive execution does not merge the parts by the bytes they move.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} joins cannot repeat rows of the right side")
    keys = _keys(on)
    heavy = F.broadcast(heavy_keys(key_sketch(df, key=keys), "key") if heavy is None else heavy)
    rest = list(spread_by) or [c for c in df.columns if c not in keys] or keys
    every = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts") - 1, F.lit(0))))

    def marked(side: DataFrame, salt: Column) -> DataFrame:
        side = salted(side, keys, heavy, salt)
        return side.repartition(parts, *keys, "__salt") if parts else side

    return marked(df, spread_over(rest)).join(marked(dim, every), [*keys, "__salt"], how).drop("__salt")


def join_sized(
    df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner",
    heavy: DataFrame | None = None, spread_by: Sequence[str] = (), limit: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Broadcast join where ``dim`` is known to be small, else ``join_hot``."""
    size = estimated_bytes(dim)
    if size is not None and size <= (BROADCAST_BYTES if limit is None else limit):
        return df.join(F.broadcast(dim), _keys(on), how)
    return join_hot(df, dim, on, how, heavy, spread_by, parts)


def join_inner_dim(df: DataFrame, calendar: DataFrame, on: str = "date_id") -> DataFrame:
    """Inner join with the calendar; columns both sides have come from the fact."""
    extra = [c for c in calendar.columns if c == on or c not in df.columns]
    return df.join(bounded(calendar.select(*extra)), on)


def join_left_lookup(
    df: DataFrame, lookup: DataFrame, on: str | Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left join with a lookup that is unique on the key; misses get their default."""
    return join_sized(df, lookup, on, "left").fillna(dict(defaults))


def join_multi_key(
    df: DataFrame, first: DataFrame, first_on: Sequence[str], second: DataFrame, second_on: str
) -> DataFrame:
    return df.join(first, list(first_on), "left").join(second, second_on, "left")


def join_semi_exists(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return join_sized(df, other, on, "left_semi")


def join_anti_exclude(df: DataFrame, excluded: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return join_sized(df, excluded, on, "left_anti")


def join_household_window(
    df: DataFrame, windows: DataFrame, start: str, end: str, day: str = "date_id"
) -> DataFrame:
    """Fact rows inside their own household's date range, both ends included."""
    return join_sized(df, windows, HOUSEHOLD).where(F.col(day).between(F.col(start), F.col(end)))


def join_self_offset(calendar: DataFrame) -> DataFrame:
    """``week_id, next_week_id`` by the running week number."""
    weeks = calendar.select("week_id", "week_num_sequence").distinct()
    after = weeks.select(
        (F.col("week_num_sequence") - 1).alias("week_num_sequence"),
        F.col("week_id").alias("next_week_id"),
    )
    return weeks.join(after, "week_num_sequence").select("week_id", "next_week_id")


def join_left_chain(
    base: DataFrame, tables: Iterable[DataFrame], on: str = HOUSEHOLD
) -> DataFrame:
    """Left joins on one key. The base keeps its partitioning, so it moves once at most."""
    return reduce(lambda left, right: left.join(right, on, "left"), tables, base)


def join_outer_fold(tables: Sequence[DataFrame], on: str = HOUSEHOLD) -> DataFrame:
    """Full outer join of many tables on one key.

    Chained outer joins coalesce the key and so reshuffle the growing result at every step.
    Here the distinct keys of all tables form a spine and every table is left-joined to it.
    """
    keys = reduce(DataFrame.unionByName, [t.select(on) for t in tables]).distinct()
    return join_left_chain(keys.where(F.col(on).isNotNull()), tables, on)


def latest_snapshot(table: DataFrame, period: str, limit: int | Column) -> DataFrame:
    """Rows of the latest snapshot that is not later than ``limit``.

    This is the snapshot at ``min(latest available, limit)``; the choice is a scalar subquery,
    so that no job runs ahead of the query.
    """
    limit = F.lit(limit) if isinstance(limit, int) else limit
    chosen = table.agg(F.least(F.max(period), limit)).scalar()
    return table.where(F.col(period) == chosen)


def join_snapshot_latest(
    df: DataFrame, snapshots: DataFrame, period: str, limit: int | Column,
    on: str = HOUSEHOLD, how: str = "left_anti",
) -> DataFrame:
    return join_sized(df, latest_snapshot(snapshots, period, limit).drop(period), on, how)


def join_scope_households(df: DataFrame, households: DataFrame) -> DataFrame:
    return join_sized(df, households.select(HOUSEHOLD), HOUSEHOLD, "left_semi")


def txn_base(
    items: DataFrame,
    products: DataFrame,
    calendar: DataFrame,
    customers: DataFrame,
    traders: DataFrame,
    divisions: Iterable,
    window: Window,
) -> DataFrame:
    """Base fact: window, products of the divisions, calendar, customer data, no traders.

    One sketch of the window's rows serves the joins on household and product.
    """
    rows = filter_window(items, window)
    sketch = key_sketch(rows, household=HOUSEHOLD, product="upc_id")
    homes, goods = heavy_keys(sketch, "household"), heavy_keys(sketch, "product")
    kept = join_sized(rows, traders.select(HOUSEHOLD), HOUSEHOLD, "left_anti", homes)
    in_scope = products.where(F.col("division_id").isin(list(divisions)))
    dated = join_inner_dim(join_sized(kept, in_scope, "upc_id", heavy=goods), calendar)
    return join_sized(dated, customers, HOUSEHOLD, "left", homes)


def filter_window(df: DataFrame, window: Window) -> DataFrame:
    return df.where(F.col("date_id").between(window.start, window.end))


def product_hierarchy_map(products: DataFrame, columns: Sequence[str]) -> DataFrame:
    return products.select(*columns).dropDuplicates()


def union_missing_cols(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
