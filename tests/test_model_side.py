"""Rankings, splits, encodings and metrics against brute force."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from basketlens.operators import prep as D
from basketlens.operators import scoring as X
from basketlens.operators.ranking import running_totals, with_quantile_bucket


def test_running_totals_match_a_loop(spark):
    rng = random.Random(1)
    data = [(i, rng.random() ** 4, rng.randint(0, 5)) for i in range(500)]
    df = with_quantile_bucket(spark.createDataFrame(data, "id int, p double, m int"), "p", "range", 16)
    assert df.select("range").distinct().count() > 8
    got = {r.id: r.before_m for r in running_totals(df, "range", ["p", "id"], ["m"]).collect()}
    total = 0
    for i, _, m in sorted(data, key=lambda r: (r[1], r[0])):
        assert got[i] == total
        total += m


def test_split_has_exact_shares_and_repeats(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    first = D.split_stratified(df, "y", "id")
    got = Counter((r.y, r.split) for r in first.collect())
    for y, n in ((1, 101), (0, 902)):
        train = math.floor(n * 0.8)
        validation = (n - train) // 2
        assert (got[y, "train"], got[y, "validation"]) == (train, validation)
        assert got[y, "test"] == n - train - validation
    again = D.split_stratified(df.repartition(7), "y", "id")
    assert first.exceptAll(again).count() == 0
    assert first.exceptAll(D.split_stratified(df, "y", "id", seed=1)).count() > 0


def test_label_codes_follow_the_sort_order(spark):
    words = ["b", "a", "ab", "B", "", "zz", "é", "a", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.w_code for r in D.label_encode(df, ["w"]).collect()}
    order = sorted({w if w is not None else "None" for w in words})
    assert got == {w: i for i, w in enumerate(order)}
    assert D.label_encode(df, ["w"]).count() == len(words)


def _auc(rows):
    pairs = [(p, q) for p, y in rows if y for q, z in rows if not z]
    return sum((p > q) + (p == q) / 2 for p, q in pairs) / len(pairs)


def test_metrics_match_brute_force(spark):
    rng = random.Random(2)
    rows = [(round(rng.random(), 1), int(rng.random() < 0.4)) for _ in range(200)]
    row = X.eval_metrics(spark.createDataFrame(rows, "probability double, target int")).first()
    pos, neg = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    tp = sum(y for p, y in rows if p >= 0.5)
    fp = sum(1 - y for p, y in rows if p >= 0.5)
    ap, before = 0.0, 0.0
    for t in sorted({p for p, _ in rows}, reverse=True):
        hits = [y for p, y in rows if p >= t]
        ap += (sum(hits) / pos - before) * sum(hits) / len(hits)
        before = sum(hits) / pos
    expected = ((tp / pos + 1 - fp / neg) / 2, _auc(rows), tp / pos, 2 * tp / (tp + fp + pos), ap)
    got = (row.balanced_accuracy, row.roc_auc, row.recall, row.f1, row.average_precision)
    assert all(abs(a - b) < 1e-6 for a, b in zip(got, expected))


def test_score_points_and_posterior(spark):
    df = spark.createDataFrame([(0.5,), (0.2,), (0.0,), (1.0,), (None,)], "probability double")
    got = [r.score for r in X.score_points(df).collect()]
    assert got[0] == 497 and abs(got[1] - (497 + 46 * 2)) < 1e-9 and got[2:] == [None, None, None]
    adjusted = X.posterior_adjust(df).first().adjusted
    assert abs(adjusted - 1.7889 * 0.5 / (1 + 0.7889 * 0.5)) < 1e-12


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1,)] + [(0,)] * 3, "target int")
    got = {r.target: r.weight for r in D.class_weights(df).collect()}
    assert got == {1: 2.0, 0: 4 / 6}


def test_woe_with_missing_and_empty(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (5.0, 0), (None, 1)], "x double, y int")
    edges = (3.0, 9.0)
    bins = D.woe_bins(df, "x", "y", edges)
    got = [r.x_woe for r in D.woe_apply(df, bins, "x", edges).orderBy(F.col("x").asc_nulls_last()).collect()]
    assert abs(got[0]) < 1e-12 and abs(got[2] - math.log((0.9 / 2) / (1 / 2))) < 1e-12
    assert abs(got[3] - math.log((1 / 2) / (0.9 / 2))) < 1e-12


def test_missing_profile(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "b", "c")], "a int, `b.x` string, c string")
    got = [tuple(r) for r in D.missing_value_profile(df).collect()]
    assert got == [("c", 2, 66.67), ("b.x", 1, 33.33)]


def test_pad_one_hot_and_sentinel(spark):
    df = spark.createDataFrame([(1, None, "Price Low"), (2, 4, None)], "household_id int, x int, s string")
    assert D.pad_columns(df, ("x", "new"), ("household_id",)).columns == ["household_id", "x", "new"]
    hot = D.one_hot(df, {"s": ("trprce", ("Price Low", "High"))})
    assert [tuple(r) for r in hot.collect()] == [(1, None, 1, 0), (2, 4, 0, 0)]
    assert hot.columns == ["household_id", "x", "trprce_Price_Low", "trprce_High"]
    assert D.fill_sentinel(df).first().x == -999999


def test_missing_features(spark):
    have = spark.createDataFrame([("a",), ("b",)], "feature string")
    assert [r.feature for r in D.missing_features(have, ["b", "c"]).collect()] == ["c"]


def test_codes_of_labels_with_one_first_letter(spark):
    from basketlens.operators import prep
    from basketlens.operators.ranking import text_positions

    names = [f"a{n * 7919 % 5003:05d}" for n in range(5_000)] + ["é", "", "B", None]
    df = spark.createDataFrame([(n,) for n in names], "label string").repartition(4)
    found = {r["label"]: r["label_code"] for r in prep.label_codes(df, "label").collect()}
    texts = sorted({n if n is not None else "None" for n in names}, key=lambda t: t.encode())
    assert found == {t: k for k, t in enumerate(texts)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:  # splitters lie between the labels, whatever they begin with
        dealt = df.where("label LIKE 'a%'").distinct().repartitionByRange("label")
        sizes = [len(part) for part in dealt.rdd.glom().collect()]
        positions = text_positions(df.where("label LIKE 'a%'").distinct(), "label", "n")
        assert sorted(r["n"] for r in positions.collect()) == list(range(len(set(names) - {"é", "", "B", None})))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / 4


def test_distinct_sets_are_bounded(spark):
    from basketlens.operators import windows as W

    rows = [(1, v) for v in "cabac"] + [(2, None), (2, None)] + [(3, str(n)) for n in range(40)] + [(3, "7")]
    df = spark.createDataFrame(rows, "k int, v string").repartition(3)
    found = {(r["k"], tuple(r["vs"]) if r["vs"] is not None else None, r["n_vs"]) for r in W.win_collect_distinct(df, ["k"], "v", "vs", most=10).collect()}
    assert found == {(1, ("a", "b", "c"), 3), (2, (), 0), (3, None, 40)}
    assert W.distinct_long(df, ["k"], "v").where("k = 3").count() == 40
    many = spark.range(300_000).selectExpr("1 AS k", "CAST(id % 200000 AS STRING) AS v", "id % 5 AS part")
    assert W.win_collect_distinct(many, ["k"], "v", "vs").agg({"n_vs": "max"}).first()[0] == 200_000
    parts = W.distinct_sketch(many, ["k", "part"], "v", "s")
    assert abs(W.merged_sketch(parts, ["k"], "s", "n").first()["n"] / 200_000 - 1) < 0.05
