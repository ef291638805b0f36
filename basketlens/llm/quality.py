"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's grade is 0 (toxic), 1 (low quality) or 2 (good). One weight per hashed text feature,
shared by all grades, gives a score s = w.x; ordered thresholds cut it:
P(grade <= k) = sigmoid(t_k - s). From them come the expected grade and the tail probability
P(grade >= 2), by which documents are kept.

Features are the distinct words of the whole text (runs of letters, A-Z lower-cased), its distinct runs of
marks, and coarse measures of shape, each hashed to ``2**bits`` places.

Defined results: a null or empty text has the shape features alone; null labels are unlabelled;
of several ratings of a document the lowest counts; with no labelled document every weight is 0 and
each grade as likely as the others; null ids are scored like others; repeated rows are scored each;
other columns pass through, except that columns named like an output are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlens.llm import words

GRADES = 3
BITS = 18
SAMPLE_ROWS = 10_000
SAMPLE_FEATURES = 20_000_000
MIN_ROWS = 4


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


def _other_than(inside: bytes, above: bool) -> np.ndarray:
    """The bytes between runs of ``inside``; ``above`` adds all bytes of longer characters to it."""
    white = np.ones(256, bool)
    white[list(inside)] = False
    white[128:] = not above
    return white


LETTERS = _other_than(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", above=True)
MARKS = _other_than(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", above=False)


def features(column: pa.Array, bits: int = BITS) -> Iterator[np.ndarray]:
    """Of each whole text, the sorted distinct places of its features."""
    size = np.uint64((1 << bits) - 1)
    for (_, data, starts, ends, h), (*_, marks) in zip(
        words.word_rows(column, white=LETTERS, lower=True), words.word_rows(column, white=MARKS), strict=True
    ):
        distinct = np.unique(h & size)
        marks = np.unique(words.mix(marks) & size)
        yield np.unique(np.concatenate([distinct, marks, _shape(data, starts, ends, distinct) & size]))


def _shape(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    n, letters = len(starts), int((ends - starts).sum())
    values = [
        8 * len(distinct) // n if n else 9,
        min(4 * letters // n, 80) if n else 81,
        8 * letters // max(len(data), 1),
        n.bit_length(),
    ]
    return words.mix(np.array([1000 * i + v for i, v in enumerate(values, 1)], np.uint64))


def fit_numpy(
    rows: list[np.ndarray], grades: np.ndarray, bits: int = BITS, ridge: float = 3.0,
    steps: int = 300, rate: float = 0.05, min_rows: int = MIN_ROWS,
) -> Model:
    """Penalised maximum likelihood by full-batch adaptive gradient steps.

    A feature of fewer than ``min_rows`` sampled documents has no weight.
    """
    w = np.zeros(1 << bits)
    free = np.array([-1.0, math.log(2.0)])  # first threshold, log of the gap
    if not rows:
        return Model(w.astype(np.float32), np.array([math.log(0.5), math.log(2.0)]))
    every = np.concatenate(rows)
    common = np.bincount(every, minlength=1 << bits)[every] >= min_rows
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[common]
    used, place = np.unique(every[common], return_inverse=True)
    x = np.concatenate([np.zeros(len(used)), free])
    m, v = np.zeros_like(x), np.zeros_like(x)
    low = np.array([grades == k for k in range(GRADES)])
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, steps + 1):
        beta, t0, t1 = x[:-2], x[-2], x[-2] + math.exp(x[-1])
        s = np.bincount(owner, beta[place], len(rows))
        p0, p1 = sigmoid(t0 - s), sigmoid(t1 - s)
        d0, d1 = p0 * (1 - p0), p1 * (1 - p1)
        mid = np.maximum(p1 - p0, 1e-12)
        by_t0 = np.where(low[0], 1 - p0, np.where(low[1], -d0 / mid, 0))
        by_t1 = np.where(low[2], -p1, np.where(low[1], d1 / mid, 0))
        by_s = -(by_t0 + by_t1)
        grad = np.concatenate([
            np.bincount(place, by_s[owner], len(used)) - ridge * beta,
            [(by_t0 + by_t1).sum(), by_t1.sum() * math.exp(x[-1])],
        ])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        x = x + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w[used] = x[:-2]
    return Model(w.astype(np.float32), np.array([x[-2], x[-2] + math.exp(x[-1])]))


def graded(labels: DataFrame) -> DataFrame:
    """One grade for each rated document: its lowest rating."""
    grade = (
        F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    )
    rated = labels.select("doc_id", grade.cast("int").alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")
    return rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """Fits on at most ``sample_rows`` rated documents, those with the smallest hashed ids.

    The driver reads their feature numbers only, ``SAMPLE_FEATURES`` at most: a sample of very long
    texts ends there.
    """
    order = F.xxhash64("doc_id")
    sample = graded(labels).orderBy(order, "doc_id").limit(sample_rows)
    rated = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [x.astype(np.int32).tobytes() for x in features(batch.column(0), bits)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column(1), batch.column(2)], ["ids", "grade", "at"])

    found = rated.select("text", "grade", order.alias("at")).mapInArrow(read, "ids binary, grade int, at long")
    rows, grades, total = [], [], 0
    for r in found.orderBy("at", "ids").toLocalIterator():
        ids = np.frombuffer(r["ids"], np.int32).astype(np.int64)
        total += len(ids)
        if rows and total > SAMPLE_FEATURES:
            break
        rows.append(ids)
        grades.append(r["grade"])
    return fit_numpy(rows, np.array(grades), bits)


OUTPUTS = ("expected_grade", "tail_probability", "accepted")


def classify(docs: DataFrame, model: Model, tail: float = 0.5, outputs: tuple[str, str, str] = OUTPUTS) -> DataFrame:
    """Adds ``expected_grade``, ``tail_probability`` (of grade 2) and ``accepted`` to every row."""
    bits = int(len(model.weights)).bit_length() - 1
    docs = docs.drop(*outputs)
    kept = docs.columns
    kinds = (T.DoubleType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, outputs, kinds)])
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cuts = shared.value
        for batch in batches:
            found = features(batch.column(kept.index("text")), bits)
            s = np.array([weights[x].sum(dtype=np.float64) for x in found], np.float64)
            above = 1 / (1 + np.exp(np.clip(cuts[None, :] - s[:, None], -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(above.sum(1)), pa.array(above[:, 1]), pa.array(above[:, 1] >= tail)],
                [*kept, *outputs])

    return docs.mapInArrow(rate, schema)


def select_quality(docs: DataFrame, labels: DataFrame, tail: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that the classifier fitted on ``labels`` accepts, with their own columns."""
    own = tuple(f"__{name}" for name in OUTPUTS)
    return classify(docs, fit(docs, labels), tail, own).where(own[2]).select(*docs.columns)
