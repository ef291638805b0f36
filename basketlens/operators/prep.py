"""Model table preparation: types, names, gaps, encodings, splits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens import config as K
from basketlens.functions.naming import clean_name, model_name
from basketlens.operators.ranking import running_totals, text_positions


def cast_decimals(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def subset_by_segment(
    df: DataFrame, segment: str | None, column: str = "cash_card_customer_flag"
) -> DataFrame:
    return df if segment is None else df.where(F.col(column) == segment)


def map_feature_names(
    df: DataFrame,
    selected: Iterable[str] | None = None,
    tokens: Mapping[str, str] = K.FEATURE_TOKENS,
    keep: Sequence[str] = ("household_id",),
) -> DataFrame:
    """Wide table under the names a model knows, cut to ``selected`` where given."""
    wanted = None if selected is None else set(selected)
    columns = [F.col(k) for k in keep]
    for old in df.columns:
        new = model_name(old, tokens)
        if old not in keep and (wanted is None or new in wanted):
            columns.append(F.col(f"`{old}`").alias(new))
    return df.select(*columns)


def missing_features(features: DataFrame, required: Iterable[str]) -> DataFrame:
    """Required names that ``features`` (one column ``feature``) does not list."""
    spark = features.sparkSession
    names = spark.createDataFrame([(n,) for n in sorted(set(required))], "feature string")
    return names.join(features.select("feature").distinct(), "feature", "left_anti")


def feature_names(long: DataFrame, level: Mapping[str, str], kpi: str = "SPEND") -> DataFrame:
    """Feature names that the data itself supports: one per (group, value) present in ``long``."""
    word = F.col("kpi_group")
    for group, text in level.items():
        word = F.when(F.col("kpi_group") == group, F.lit(text)).otherwise(word)
    return (
        long.where(F.col("kpi_group").isin(list(level)))
        .select("kpi_group", "kpi_value")
        .distinct()
        .select(F.concat(F.lit("CAT_"), word, F.lit("_%"), "kpi_value", F.lit(f"%_{kpi}")).alias("feature"))
    )


def missing_value_profile(df: DataFrame) -> DataFrame:
    """Columns with nulls: count and percent, most first. One pass over the table."""
    columns = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("missing_values"))
        for i, c in enumerate(columns)
    ]
    return (
        counts.select("n", F.inline(F.array(*pairs)))
        .where(F.col("missing_values") > 0)
        .select(
            "column_name",
            "missing_values",
            F.round(F.col("missing_values") * 100 / F.col("n"), 2).alias("pct_missing"),
        )
        .orderBy(F.desc("missing_values"), "column_name")
    )


def fill_sentinel(
    df: DataFrame, sentinel: float = K.CREDIT_SENTINEL, columns: Sequence[str] | None = None
) -> DataFrame:
    return df.fillna(sentinel, subset=None if columns is None else list(columns))


def pad_columns(df: DataFrame, trained: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns as trained and in that order, absent ones as 0."""
    present = set(df.columns)
    return df.select(
        *keep, *[F.col(f"`{c}`") if c in present else F.lit(0).alias(c) for c in trained]
    )


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """``column, code``: 0-based position of each distinct text in sorted order."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("None"))
    codes = text_positions(df.select(text.alias(column)).distinct(), column, f"{column}_code")
    return codes.withColumn(f"{column}_code", F.col(f"{column}_code").cast("int"))


def label_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``<column>_code`` for text columns; a missing text counts as the text "None"."""
    for c in columns:
        df = df.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("None"))).join(
            label_codes(df, c), c, "left"
        )
    return df


def one_hot(df: DataFrame, columns: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Dummy columns ``<prefix>_<value>`` instead of each text column."""
    kept = [F.col(c) for c in df.columns if c not in columns]
    dummies = [
        F.when(F.col(c) == v, 1).otherwise(0).alias(clean_name(f"{prefix}_{v}"))
        for c, (prefix, values) in columns.items()
        for v in values
    ]
    return df.select(*kept, *dummies)


def label_binary(
    df: DataFrame, column: str = "Bought_Status", positive: str = "Bought", out: str = "target"
) -> DataFrame:
    return df.withColumn(out, F.when(F.col(column) == positive, 1).otherwise(0))


def split_stratified(
    df: DataFrame, label: str, key: str, train: float = 0.8, seed: int = 0
) -> DataFrame:
    """Adds ``split``: exact shares of train, validation and test in every class.

    Rows are ordered by a seeded hash, which repeats for the same keys. The order is built in
    hash ranges, so a class is never sorted as a whole.
    """
    hashed = df.withColumn("h", F.xxhash64(key, F.lit(seed))).withColumns(
        {"hash_range": F.shiftrightunsigned("h", 54), "one": F.lit(1)}
    )
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_size"))
    ranked = running_totals(hashed, "hash_range", ["h", key], ["one"], within=[label])
    n, rank = F.col("class_size"), F.col("before_one")
    first = F.floor(n * train)
    second = first + F.floor((n - first) / 2)
    split = F.when(rank < first, "train").when(rank < second, "validation").otherwise("test")
    return (
        ranked.join(sizes, label)
        .withColumn("split", split)
        .drop("h", "hash_range", "one", "before_one", "class_size")
    )


def class_weights(
    df: DataFrame, label: str = "target", classes: Sequence = (0, 1), out: str = "weight"
) -> DataFrame:
    """Balanced weights ``n / (k * n_class)``. All counts are one scalar subquery: no join."""
    counts = [F.count(F.lit(1)).alias("n")]
    counts += [F.count_if(F.col(label) == c).alias(f"n{i}") for i, c in enumerate(classes)]
    sizes = df.agg(F.struct(*counts)).scalar()
    weight: Column = F.lit(None).cast("double")
    for i, c in enumerate(classes):
        balanced = sizes["n"].cast("double") / (F.lit(float(len(classes))) * sizes[f"n{i}"])
        weight = F.when(F.col(label) == c, balanced).otherwise(weight)
    return df.withColumn(out, weight)


# --- weight of evidence -------------------------------------------------------------------


def bin_index(column: str, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value; -1 for a missing value."""
    value = F.col(column)
    below = sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(0))
    return F.when(value.isNull(), -1).otherwise(below).cast("int")


def woe_bins(df: DataFrame, column: str, label: str, edges: Sequence[float]) -> DataFrame:
    """``bin, woe``: log of the share of positives over the share of negatives per bin.

    An empty count enters as 0.9, so that the log stays finite.
    """
    binned = df.select(bin_index(column, edges).alias("bin"), F.col(label).alias("y"))
    counted = binned.groupBy("bin").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    floor = lambda c: F.when(F.col(c) == 0, 0.9).otherwise(F.col(c))
    # At most one row per bin, so the totals are a window over a handful of rows.
    every = W.partitionBy()
    share = lambda c: floor(c) / F.sum(c).over(every)
    return counted.select("bin", F.ln(share("pos") / share("neg")).alias("woe"))


def woe_apply(
    df: DataFrame, bins: DataFrame, column: str, edges: Sequence[float]
) -> DataFrame:
    """Adds ``<column>_woe``. ``bins`` has one row per bin: at most ``len(edges) + 2``."""
    looked_up = bins.withColumnRenamed("woe", f"{column}_woe")
    return (
        df.withColumn("bin", bin_index(column, edges))
        .join(F.broadcast(looked_up), "bin", "left")
        .drop("bin")
    )
