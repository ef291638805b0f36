"""Periodic runs against a brute-force search of all periods."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import runs
from basketlens.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import prose

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def described(doc_id, text, plant=True):
    w = brute.with_tail(doc_id, text) if plant else brute.WORD.findall(text or "")
    found = brute.runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(found), *best, found and 1000 * best[1] // best[2] or None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(brute.collapse(w, found))))


@pytest.mark.parametrize("min_length, copies", [(24, 3), (6, 2), (10, 4)])
def test_runs_of_small_alphabets(min_length, copies):
    r = random.Random(min_length)
    for _ in range(80):
        texts = []
        for _ in range(r.randint(0, 4)):
            x = [r.randrange(r.choice([1, 2, 3, 20])) for _ in range(r.randint(0, 60))]
            for _ in range(r.randint(0, 3)):
                phrase = [r.randrange(3) for _ in range(r.randint(1, 12))]
                x[len(x) // 2:len(x) // 2] = (phrase * 30)[:r.randint(10, 80)]
            texts.append(x)
        base = np.cumsum([0, *map(len, texts)])
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
        got = runs.maximal_runs(np.array([w for x in texts for w in x], np.int64), owner, min_length, copies)
        split = [[] for _ in texts]
        for start, end, period in zip(*(x.tolist() for x in got), strict=True):
            split[owner[start]].append((start - base[owner[start]], end - start, period))
        assert split == [brute.runs(x, min_length, copies) for x in texts]


def test_screen_is_the_least_shared_stretch():
    assert runs.screen(24, 3) == 16
    assert all(max(24, 3 * q) - q >= 16 for q in range(1, 200))


def test_long_runs_of_one_text():
    x = np.resize(np.random.default_rng(0).integers(0, 500, 7_000), 100_000)
    assert [v.tolist() for v in runs.maximal_runs(x, np.zeros(len(x), np.int64))] == [[0], [100_000], [7_000]]


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = {tuple(r) for r in QUERIES["op11_branching_tandem_runs"](spark, SMALL).collect()}
    assert found == {described(*r) for r in rows}
    assert sum(r[1] > 0 for r in found) > 5


def test_odd_rows(docs, odd):
    rows = [*odd, (20, "a b c " * 40), (21, "a b\n" * 30 + "c " * 30), (22, "w " * 23), (23, "w " * 24), (24, "é ü " * 20)]
    frame = docs(rows).withColumn("runs", F.lit(1)).withColumn("best", F.lit("x"))
    found = runs.described(runs.find_runs(frame)).collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted((described(r[0], r[1], False) for r in rows), key=key)
    assert runs.described(runs.find_runs(docs([]))).count() == 0


def test_planted_tails(docs):
    rows = [(i, prose(i, i % 90)) for i in range(200)] + [(None, "a b"), (300, None)]
    made = {r["doc_id"]: r["text"] for r in runs.repeat_tails(docs(rows)).collect()}
    for i, text in rows:
        if i is not None:
            assert brute.WORD.findall(made[i] or "") == brute.with_tail(i, text)
    assert made[None] == "a b" and made[300] is None


def test_equal_words_have_equal_numbers():
    from basketlens.llm import words

    data = np.frombuffer("b a  b é\na".encode(), np.uint8)
    assert words.identities(data, *words.bounds(data))[[0, 1]].tolist() != [0, 0]
    n = words.identities(data, *words.bounds(data))
    assert n[0] == n[2] and n[1] == n[4] and len(set(n.tolist())) == 3
    assert words.identities(data[:0], *words.bounds(data[:0])).tolist() == []
