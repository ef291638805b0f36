"""Training, scoring and evaluation on DataFrames; no row leaves the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.functions import columns as C
from basketlens.operators.ranking import running_totals, with_quantile_bucket
from basketlens.sources.writers import staged


def posterior_adjust(
    df: DataFrame, probability: str = "probability", offset: float = K.POSTERIOR_OFFSET,
    out: str = "adjusted",
) -> DataFrame:
    return df.withColumn(out, C.posterior(F.col(probability), offset))


def score_points(
    df: DataFrame, probability: str = "probability", out: str = "score",
    base: float = K.SCORE_BASE, double_odds: float = K.SCORE_DOUBLE,
) -> DataFrame:
    return df.withColumn(out, C.points(F.col(probability), base, double_odds))


def train_classifier(
    train: DataFrame, features: Sequence[str], label: str = "target", weight: str = "weight",
    trees: int = 20, depth: int = 5, seed: int = 0,
):
    """Random forest on class-weighted rows; returns the fitted pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol=weight, numTrees=trees,
        maxDepth=depth, seed=seed,
    )
    return Pipeline(stages=[assembler, forest]).fit(train)


def score_table(
    model, df: DataFrame, key: str = "household_id", offset: float | None = K.POSTERIOR_OFFSET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Probability and score points per household."""
    from pyspark.ml.functions import vector_to_array

    raw = vector_to_array(F.col("probability"))[1]
    p = raw if offset is None else C.posterior(raw, offset)
    return score_points(
        model.transform(df).select(key, *keep, p.alias("Probability")), "Probability", "Score"
    )


def eval_metrics(
    df: DataFrame, label: str = "target", probability: str = "probability",
    threshold: float = 0.5,
) -> DataFrame:
    """One row: balanced accuracy, ROC AUC, recall, F1, average precision.

    Rows with the same probability collapse first and are written, as the steps below read them
    several times and scoring is dear. Ranks come from running totals over ranges
    of the probability, so that no task orders all rows.
    """
    p, y = F.col(probability), F.col(label)
    by_score = staged(
        df.groupBy(p.alias("p")).agg(
            F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
        ),
        "scores",
    )
    ranked = running_totals(
        with_quantile_bucket(by_score, "p", "range"), "range", ["p"], ["pos", "neg"]
    )
    hit = F.col("p") >= threshold
    pos, neg = F.col("pos"), F.col("neg")
    # Rows that score at least as high as this one.
    total = by_score.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    reach = ranked.withColumns(
        {
            "pos_from": total["pos"] - F.col("before_pos"),
            "neg_from": total["neg"] - F.col("before_neg"),
        }
    ).withColumn("precision", F.col("pos_from") / (F.col("pos_from") + F.col("neg_from")))
    sums = reach.agg(
        F.sum(F.when(hit, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
        F.sum(pos).alias("p"),
        F.sum(neg).alias("n"),
        F.sum(pos * (F.col("before_neg") + neg / 2)).alias("pairs"),
        F.sum(pos * F.col("precision")).alias("precisions"),
    )
    tp, fp, p_all, n_all = (F.col(c).cast("double") for c in ("tp", "fp", "p", "n"))
    recall = F.try_divide(tp, p_all)
    specificity = F.lit(1.0) - F.try_divide(fp, n_all)
    f1 = F.coalesce(F.try_divide(tp * 2, tp + fp + p_all), F.lit(0.0))
    named = {
        "balanced_accuracy": (recall + specificity) / 2,
        "roc_auc": F.try_divide(F.col("pairs"), p_all * n_all),
        "recall": recall,
        "f1": f1,
        "average_precision": F.try_divide(F.col("precisions"), p_all),
    }
    return sums.select(*[F.round(c, 6).alias(n) for n, c in named.items()])
