"""Byte-string deduplication against a brute-force count of all windows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import bytedup
from basketlens.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import prose

SMALL = "/root/testdata/sf0.001"
KEY = lambda r: tuple(str(v) for v in r)


def result(found):
    found = found.withColumn("s", F.coalesce("sha", F.sha2("kept", 256)))
    return sorted(map(tuple, found.select("doc_id", "n_bytes", "n_removed", "n_spans", "s").collect()), key=KEY)


def corpus():
    r = random.Random(13)
    passage, base = prose("bytes", 90), prose("base", 400)
    rows = [(i, f"{prose(i, 30)} {passage}{prose(-i - 1, 20)}") for i in range(40)]
    rows += [(50 + i, base[r.randrange(900):][:r.randrange(300, 900)]) for i in range(30)]
    rows += [(100, base), (100, base), (100, passage * 3), (None, base), (None, None), (101, ""), (102, None)]
    rows += [(110, "x" * 405), (111, "y" * 400), (112, "ab" * 300), (113, "é" * 250 + prose(4, 90)), (114, prose(7, 80) * 6)]
    return rows + [(120, prose("edge", 100)[:400]), (121, prose("edge", 100)[:399])]


@pytest.mark.parametrize("limit", [4 << 20, 1_500])
def test_bytes_match_brute_force(docs, monkeypatch, limit):
    monkeypatch.setattr(bytedup, "BUCKET_BYTES", limit)
    monkeypatch.setattr(bytedup, "BATCH_BYTES", 5_000)
    rows = corpus()
    frame = docs(rows).withColumn("count", F.lit(1)).withColumn("mark", F.lit("m"))
    assert result(bytedup.remove_repeated_bytes(frame)) == sorted(brute.cut_bytes(rows), key=KEY)


def test_short_windows_match_brute_force(docs):
    r = random.Random(5)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 300)))) for i in range(30)]
    assert result(bytedup.remove_repeated_bytes(docs(rows), window=13, gram=4)) == sorted(brute.cut_bytes(rows, 13), key=KEY)


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(map(tuple, QUERIES["op13_bucket_pointer_bytes"](spark, SMALL).collect()), key=KEY)
    assert found == sorted(brute.cut_bytes([tuple(x) for x in rows]), key=KEY)
    assert sum(x[2] > 0 for x in found) > 5


def test_odd_rows(docs, odd):
    assert result(bytedup.remove_repeated_bytes(docs(odd))) == sorted(brute.cut_bytes([x[:2] for x in odd]), key=KEY)
    assert bytedup.remove_repeated_bytes(docs([])).count() == 0


def test_refinement_finds_equal_windows():
    r = random.Random(2)
    for window in (8, 9, 16, 40):
        texts = [bytes(r.choice(b"ab") for _ in range(r.randint(window, 90))) for _ in range(12)]
        bucket = np.repeat([0, 0, 0, 1, 1, 1, 1, 2, 3, 3, 3, 3], [len(t) for t in texts])
        stop = np.cumsum([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        tied = set(bytedup.shared_windows(data, np.repeat(stop, [len(t) for t in texts]), bucket, window).tolist())
        seen = {}
        for end, text in zip(stop, texts, strict=True):
            for k in range(len(text) - window + 1):
                at = int(end) - len(text) + k
                seen.setdefault((bucket[at], text[k:k + window]), []).append(at)
        assert tied == {x for v in seen.values() if len(v) > 1 for x in v}


def test_byte_hashes_depend_on_the_bytes_alone():
    data = np.random.default_rng(0).integers(0, 3, 500).astype(np.uint8)
    for n in (1, 2, 5, 64, 100, 400):
        h = bytedup.byte_hashes(data, n)
        assert len(h) == len(data) - n + 1
        assert len(set(h.tolist())) == len({data[i:i + n].tobytes() for i in range(len(h))})
