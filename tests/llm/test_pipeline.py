"""The pipeline as a whole: every stage's decisions take effect on all its predecessor kept."""

import corpus_pipeline as cp
from basketlens.llm import quality
from basketlens.sources.writers import staged
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good, lined, near, clean = {}, {}, {}, {}
    for kept, (_, stage) in zip((good, lined, near, clean), cp.STAGES[:4], strict=True):
        docs = staged(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        kept.update({r["doc_id"]: r["text"] for r in docs.collect()})
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(raw, spark.read.parquet(f"{SF}/labels.parquet"))
    assert set(good) == {r["doc_id"] for r in quality.classify(raw, model).where("accepted").collect()}
    cut = brute.cut_lines(list(good.items()), 2)
    assert lined == {i: t for i, (t, n) in cut.items() if not n or brute.WORD.search(t)}
    groups = brute.near(list(lined.items()))
    assert near == {i: t for i, t in lined.items() if groups[i][1] == i}
    assert set(clean) < set(near)
    mix = cp.STAGES[4][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in mix} == set(clean) and sum(r["taken"] for r in mix) > 0


def test_run_and_shape(spark):
    assert [len(cp.STAGES), cp.ORACLE_SQL] == [5, None]
    found = cp.run(spark, SF.replace("0.01", "0.001"))
    assert found.count() > 0 and {"doc_id", "taken", "target"} <= set(found.columns)
