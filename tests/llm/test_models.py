"""Language, quality and personal data: accuracy on rows nothing was learned from, and rules."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens.llm import language, pii, quality
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_of_held_out_documents(documents):
    found = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == documents.count()
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_rows(docs, odd):
    rows = [*odd, *[(20 + i, "der die das und nicht " * 3, "de") for i in range(9)], *[(40 + i, "the and of that with " * 3, "en") for i in range(9)]]
    found = {r["doc_id"]: r for r in language.identify(docs(rows)).collect()}
    assert all(found[i]["lang_pred"] == "und" for i in (1, 2, 3))
    assert found[20]["lang_pred"] == "de" and found[41]["lang_pred"] == "en"
    assert not found[None]["held_out"]
    assert {r["lang_pred"] for r in language.identify(docs([(1, "abc")])).collect()} == {"und"}
    assert language.identify(docs([])).count() == 0


def test_language_of_long_texts(documents, docs):
    model = language.fit(documents)
    rows = documents.where("text IS NOT NULL AND lang IS NOT NULL").groupBy("lang").agg(F.concat_ws(" ", F.collect_list("text")).alias("text")).collect()
    long = [(100 * i + k, (r["text"] * (size // len(r["text"]) + 1))[:size], r["lang"])
            for i, r in enumerate(rows) for k, size in enumerate((50_000, 200_000, 1_000_000, 3_000_000))]
    numbers = " ".join(str(n) for n in range(10_000, 60_000))
    long += [(1_000 + i, f"{numbers} {r['text'][:3_000]} {numbers}", r["lang"]) for i, r in enumerate(rows)]
    found = {r["doc_id"]: r for r in language.predict(docs(long), model).collect()}
    assert len(rows) > 3 and {i: found[i]["lang_pred"] for i, *_ in long} == {i: lang for i, _, lang in long}
    assert language.predict(docs([(1, numbers)]), model).first()["lang_pred"] == "und"


def test_every_gram_is_in_a_piece():
    text = prose(4, 3_000)
    found = language.pieces(text)
    assert len(found) > 3 and sum(n for _, n in found) == len(text.replace(" ", ""))
    assert (language.presence_of([p for p, _ in found]).max(0) == language.presence([text])[0]).all()


def test_kernel_is_the_normalised_overlap():
    x = language.presence(["abc abd", "abc", ""])
    k = language.kernel(x, x)
    assert k[0, 0] == pytest.approx(1) and k[0, 1] == k[1, 0] == pytest.approx((x[0] @ x[1]) / np.sqrt(x[0].sum() * x[1].sum()))
    assert k[2].sum() == 0
    long = "ab" * language.words.BLOCK_BYTES
    assert (language.presence([long]) == language.presence(["abababab"])).all()


def test_quality_keeps_good_documents(spark):
    larger = SF.replace("0.01", "0.1")
    documents, labels = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.where("doc_id % 2 = 0")
    rated = quality.classify(documents, quality.fit(documents, learn)).join(quality.graded(labels.where("doc_id % 2 = 1")), "doc_id")
    rows = rated.select("grade", "accepted", "expected_grade", "tail_probability").collect()
    share = lambda g: np.mean([r["accepted"] for r in rows if r["grade"] == g])
    assert share(2) > 0.97 and share(1) < 0.25
    assert share(0) < 0.6  # two of five toxic labels are on texts without a toxic word
    assert all(0 <= r["tail_probability"] <= r["expected_grade"] <= 2 for r in rows)


def test_ordinal_fit_recovers_order():
    r = np.random.default_rng(0)
    rows = [np.flatnonzero(r.random(20) < 0.5) for _ in range(1_500)]
    score = np.array([2.0 * (0 in x) - 2.0 * (1 in x) for x in rows]) + r.logistic(size=1_500)
    model = quality.fit_numpy(rows, (score > -1).astype(int) + (score > 1), bits=5, ridge=0.1)
    assert model.thresholds[0] < model.thresholds[1]
    assert model.weights[0] == pytest.approx(2, abs=0.4) and model.weights[1] == pytest.approx(-2, abs=0.4)
    assert np.abs(model.weights[2:20]).max() < 0.4


def test_quality_of_odd_rows(spark, docs, odd):
    labels = spark.createDataFrame([(1, 1, None), (4, 0, 0), (4, 1, 1), (None, 1, 0), (6, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")
    assert dict(quality.graded(labels).collect()) == {1: 2, 4: 0, 99: 2}
    clash = docs(odd).withColumn("accepted", F.lit("mine"))
    kept = quality.select_quality(clash, labels)
    assert kept.columns == clash.columns
    rated = quality.classify(docs(odd), quality.fit(docs(odd), labels.where("false")))
    assert rated.count() == len(odd) and rated.agg(F.max("expected_grade")).first()[0] == pytest.approx(1.0)
    assert [len(x) > 0 for x in quality.features(pa.array([None, "", "a"]))] == [True] * 3


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
CASES = [
    ("mail a.b+c@d-e.co.uk now", [("email", 5, 20)]), ("x@y z@", []), ("a@b.c_d@e.f", [("email", 0, 5), ("email", 5, 11)]),
    ("10.0.0.255 and 10.0.0.256 and 1.2.3", [("ip", 0, 10)]), ("1.2.3.4.5.6.7.8", [("ip", 0, 7), ("ip", 8, 15)]),
    ("4111 1111 1111 1111", [("card", 0, 19)]), ("4111 1111 1111 1112", []), ("é 4111-1111-1111-1111.", [("card", 2, 21)]),
    ("+1 (743) 555-3824 x", [("phone", 0, 17)]), ("+123 4", []), ("", []),
]


@pytest.mark.parametrize("text, spans", CASES)
def test_base_spans(text, spans):
    assert pii.base_spans(text) == spans


def test_emails_match_the_pattern():
    r = np.random.default_rng(2)
    for _ in range(3_000):
        text = "".join(r.choice(list("ab1.@@_-. "), r.integers(0, 20)))
        assert list(pii._emails(text)) == [m.span() for m in EMAIL.finditer(text)]


def test_gradient_of_the_network():
    r = np.random.default_rng(1)
    parts = [p.astype(float) for p in pii.Model.fresh(3).parts()]
    x, y = r.integers(0, 128, (2, 5)), r.integers(0, len(pii.TAGS), (2, 5))
    _, grad = pii.Model.of(parts).gradient(x, y)
    for k, p in enumerate(parts):
        at = (int(x[0, 0]), 1) if k == 0 else tuple(int(r.integers(0, s)) for s in p.shape)
        value = p[at]
        p[at] = value + 1e-2
        up = pii.Model.of(parts).gradient(x, y)[0]
        p[at] = value - 1e-2
        down = pii.Model.of(parts).gradient(x, y)[0]
        p[at] = value
        assert grad[k][at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=1e-3)


def test_windows_cover_every_hint():
    text = prose(1, 300) + " 12 " + prose(2, 300) + " a@b"
    found = pii.windows(text)
    for m in pii.HINT.finditer(text):
        assert any(a <= m.start() < b for a, b in found)
    assert not pii.windows("no hint at all " * 100)


def test_model_adds_to_the_base(spark):
    rows = pii.sample(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), limit=800)
    model = pii.train(rows[: len(rows) * 3 // 4], epochs=8)
    held = rows[len(rows) * 3 // 4:]
    got = pii.model_spans(model, [t for t, _ in held])
    want = [{(pii.KINDS[k], a, b) for k, a, b in s if b <= pii.SPAN} for _, s in held]
    hit = sum(len(set(g) & w) for g, w in zip(got, want, strict=True))
    assert hit > 0.6 * sum(map(len, want))
    text = "é write a@b.co or 10.1.2.3"
    base = pii.base_spans(text)
    assert set(base) <= set(pii.merged(text, base, [("phone", 0, 26), ("card", 3, 5)])) and len(base) == 2


def test_personal_data_of_odd_rows(docs, odd):
    found = pii.find_personal_data(docs([*odd, (9, "4111 1111 1111 1111")])).collect()
    assert len(found) == len(odd) + 1
    by = {r["doc_id"]: r for r in found}
    assert (by[8]["n_ip"], by[8]["n_email"]) == (50, 50) and by[9]["n_card"] == 1
    assert by[1]["spans"] == "" and by[1]["base_sha256"].startswith("e3b0c442")
    assert pii.find_personal_data(docs([(1, "none")])).first()["spans"] == ""
    assert pii.find_personal_data(docs([])).count() == 0
