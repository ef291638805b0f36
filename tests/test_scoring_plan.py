"""Scoring as one saved pipeline: fitted in one process, applied in another, and its column contract."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketlens.operators import prep as D
from basketlens.plans import scoring as L

ROOT = Path(__file__).resolve().parent.parent

FIT = """
import sys
from basketlens.plans import scoring as L
from basketlens.session import build_session
from tests.test_scoring_plan import TRAINED, table, weighted
spark = build_session("fit", cpus=2, **{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "2g",
                                        "spark.sql.warehouse.dir": sys.argv[1] + "/warehouse"})
model = L.fit_forest(weighted(table(spark)), TRAINED, trees=5, depth=3)
L.save_model(model, sys.argv[1] + "/model")
L.score(model, table(spark)).write.parquet(sys.argv[1] + "/scored")
"""

TRAINED = ("SPEND", "CAT_L21_01_UNITS", "balance")


def table(spark):
    """A wide table under its own names, with a gap and a decimal; the target follows the spend."""
    n = F.col("id")
    return spark.range(400).select(
        n.alias("household_id"), (n * 37 % 400).cast("decimal(18,4)").alias("Total_Spend"),
        (n % 5).alias("CAT_SEC_%1%_UNITS"), F.when(n % 7 != 0, n % 11).alias("balance"),
        F.when(n % 2 == 0, "CARD").otherwise("CASH").alias("cash_card_customer_flag"),
        (n * 37 % 400 > 200).cast("int").alias("target"))


def weighted(df):
    return D.class_weights(df)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fitted_here_and_scored_elsewhere(spark, tmp_path):
    done = subprocess.run([sys.executable, "-c", FIT, str(tmp_path)], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    there = _rows(spark.read.parquet(f"{tmp_path}/scored"))
    model = L.load_model(f"{tmp_path}/model")
    assert _rows(L.score(model, table(spark))) == there and len(there) == 400
    L.score_to(f"{tmp_path}/model", table(spark), f"{tmp_path}/cards", segment="CARD")
    assert _rows(spark.read.parquet(f"{tmp_path}/cards")) == [r for r in there if r[0] % 2 == 0]
    # The target follows the spend: the forest tells the classes apart.
    chance = {r[0]: r[1] for r in there}
    assert min(chance[n] for n in range(400) if n * 37 % 400 > 220) > max(chance[n] for n in range(400) if n * 37 % 400 < 180)


def test_column_contract(spark):
    strict, padded = (L.prepared(("SPEND", "new"), ("household_id",), absent=a) for a in (L.REFUSE, L.ZERO))

    def through(stages, df):
        for stage in stages:
            df = stage.transform(df)
        return df

    wide = table(spark)
    with pytest.raises(ValueError, match="lacks: new"):
        through(strict, wide)
    out = through(padded, wide)
    assert out.dtypes == [("household_id", "bigint"), ("SPEND", "double"), ("new", "double")]
    assert out.where("new <> 0").count() == 0
    gaps = through(L.prepared(("balance",), ("household_id",)), wide)
    assert {r[0] for r in gaps.where("household_id % 7 = 0").select("balance").collect()} == {-999999.0}


def test_bins_and_points_of_the_edges(spark, tmp_path):
    from pyspark.ml import PipelineModel

    stages = [L.WoeColumns(bins={"x": {"edges": [0.0, 1.0], "woe": [[-1, 9.0], [0, -0.5], [2, 0.25]]}}), L.points_stage("p", 1.0)]
    L.save_model(PipelineModel(stages=stages), f"{tmp_path}/m")
    L.save_model(PipelineModel(stages=stages), f"{tmp_path}/m")  # in place of the first
    df = spark.createDataFrame([(-1.0, 0.5), (0.0, 0.0), (1.0, 1.0), (None, None)], "x double, p double")
    got = [(r.x, r.x_woe, r.Probability, r.Score) for r in L.load_model(f"{tmp_path}/m").transform(df).collect()]
    assert got == [(-1.0, -0.5, 0.5, 497.0), (0.0, None, 0.0, None), (1.0, 0.25, 1.0, None), (None, 9.0, None, None)]


def test_an_empty_table(spark, tmp_path):
    model = L.fit_forest(weighted(table(spark)), TRAINED, trees=2, depth=2)
    assert L.score(model, table(spark).where("false")).count() == 0


def test_samples_repeat_and_keep_their_share(spark):
    from basketlens.operators.filters import sample_rows

    rows = spark.range(0, 20_000, 1, 4)
    one, again, other = (sorted(r.id for r in sample_rows(rows, 0.1, seed).collect()) for seed in (1, 1, 2))
    assert one == again and one != other and len(set(one)) == len(one)
    assert abs(len(one) / 2_000 - 1) < 0.15
    assert sample_rows(rows, 1.0).count() == 20_000 and sample_rows(rows, 0.0).count() == 0


def test_scores_of_the_plain_forest(spark):
    """Rows and keys stay, probabilities lie in 0 to 1 and order the classes, points fall as they rise."""
    from basketlens.operators import scoring as X

    df = weighted(table(spark).withColumn("Total_Spend", F.col("Total_Spend").cast("double")))
    model = X.train_classifier(df, ("Total_Spend",), trees=5, depth=3)
    scored = X.score_table(model, df, offset=None, keep=("target",))
    rows = scored.collect()
    assert sorted(r.household_id for r in rows) == list(range(400))
    assert all(0 <= r.Probability <= 1 and (r.Score is None) == (r.Probability in (0.0, 1.0)) for r in rows)
    inside = sorted((r.Probability, -r.Score) for r in rows if r.Score is not None)
    assert inside == sorted(inside, key=lambda pair: (pair[1], pair[0]))
    assert X.eval_metrics(scored, probability="Probability").first().roc_auc > 0.98
