"""Spelling variants against a brute-force search through all deletions."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import spelling
from basketlens.llm.queries import QUERIES
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def table(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def edit(r, word, letters):
    k = r.randrange(len(word))
    return r.choice([word[:k] + word[k + 1:], word[:k] + r.choice(letters) + word[k:], word[:k] + r.choice(letters) + word[k + 1:]])


def test_pivots_are_the_cheapest_disjoint_pair():
    r = random.Random(3)
    for _ in range(500):
        places = sorted(r.sample(range(9), r.randint(3, 6)))
        cost = [r.randint(1, 9) for _ in places]
        a, b = spelling.pivots(places, cost)
        by = dict(zip(places, cost, strict=True))
        assert b - a >= 2 and by[a] + by[b] == min(by[x] + by[y] for x, y in itertools.combinations(places, 2) if y - x >= 2)


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnop"])
def test_pairs_match_brute_force(spark, letters):
    r = random.Random(len(letters))
    known = {"".join(r.choice(letters) for _ in range(r.randint(5, 9))) for _ in range(150)}
    for w in list(known):
        known |= {edit(r, w, letters) for _ in range(3)}
    known = sorted(w for w in known if len(w) >= 5)
    vocabulary = spark.createDataFrame([(w, 3 + k) for k, w in enumerate(known)], "word string, n long")
    found = [(x["a"], x["b"]) for x in spelling.near_pairs(vocabulary).collect()]
    want = brute.variants([(None, " ".join(known))], least=1)
    assert len(found) == len(set(found))
    degree = {w: 0 for w in known}
    for a, b in found:
        assert a < b
        degree[a] += 1
        degree[b] += 1
    assert degree == {w: v[3] for w, v in want.items()}


def test_query_matches_brute_force(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found, want = table(QUERIES["op12_pivotal_gram_variants"](spark, SMALL)), brute.variants(rows)
    assert found == want and sum(v[0] is not None for v in want.values()) > 100


def test_forms_ties_and_chains(docs):
    rows = [(None, "mothers " * 3 + "mother " * 6 + "bother " * 12 + "brother " * 24 + "Brother " + "ÀÉÎÕÜ " * 3 + "x" * 70 + " ")]
    rows += [(None, "cover " * 5 + "hover " * 10 + "lover " * 10 + "abcd " * 9 + "abcde " * 2)]
    found = table(spelling.group_variants(docs(rows)))
    assert found == brute.variants(rows)
    assert found["mothers"] == ("mother", "brother", 3, 1, 6) and found["cover"][0] == "hover"
    assert found["ÀÉÎÕÜ"] == (None, "ÀÉÎÕÜ", 3, 0, None) and "abcde" not in found


def test_odd_rows(docs, odd):
    frame = docs(odd).withColumn("word", F.lit("w")).withColumn("n", F.lit(1))
    assert table(spelling.group_variants(frame)) == brute.variants([r[:2] for r in odd])
    assert spelling.group_variants(docs([])).count() == 0


def test_letters():
    data = np.frombuffer("aÀÿ×b ñ1ẞcĀd".encode(), np.uint8)
    runs = [data[a:b].tobytes().decode() for a, b in zip(*spelling.letter_runs(data, np.array([0, 3])), strict=True)]
    assert runs == ["aÀ", "ÿ×b", "ñ", "c", "d"]
