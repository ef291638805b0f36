"""Language identification by string kernels.

A text is cut into pieces of one length, at most ``PIECE_CHARS`` characters: sets of n-grams fill up as
texts grow, and full ones have no language. A piece is the set of its distinct character 1- to 4-grams,
lower-cased, hashed to ``DIM`` places: a blended spectrum with presence instead of counts. The kernel of
two pieces is the size of their common set, divided by the geometric mean of both sizes. Nystroem: pieces
are described by their kernel values with ``LANDMARKS`` learned ones, whitened by the landmarks' own
kernel matrix. On that, one ridge regression for each language against the rest is solved in closed form.
Scoring is two matrix products a batch: presence by landmarks, kernel values by dual weights. A text has
the mean scores of all its pieces, weighted by their letters. Each text learned from gives one piece.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every text when
nothing can be learned from. Null ids count as not held out; repeated rows are each scored; other
columns are ignored. Of languages with equal scores the first by name wins.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm import words

DIM = 4096
MAX_GRAM = 4
LANDMARKS = 128
SAMPLE_ROWS = 2_000
BATCH_TEXTS = 256
PIECE_CHARS = 4096
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    langs: list[str]
    landmarks: np.ndarray  # presence, landmarks x DIM
    dual: np.ndarray  # landmarks x languages


@cache
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    out = np.zeros(sys.maxunicode + 1, bool)
    out[code_points("".join(LETTER.findall("".join(map(chr, range(sys.maxunicode + 1))))))] = True
    return out


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)


def pieces(text: str | None) -> list[tuple[np.ndarray, int]]:
    """Lower-cased code points and number of letters of each piece of the text that has a letter.

    A piece reads on to the end of the n-grams that begin in it, so none is lost at a border.
    """
    points = code_points((text or "").lower())
    count = -(-len(points) // PIECE_CHARS)
    out = []
    for i in range(count):
        begin, end = len(points) * i // count, len(points) * (i + 1) // count
        n = int(np.count_nonzero(letters()[points[begin:end]]))
        if n:
            out.append((points[begin:end + MAX_GRAM - 1], n))
    return out


def presence(texts: list[str | None]) -> np.ndarray:
    """0/1 matrix, a row for each whole text and a column for each hashed n-gram."""
    return presence_of([code_points((text or "").lower()) for text in texts])


def presence_of(rows: list[np.ndarray]) -> np.ndarray:
    """``presence`` of lower-cased code points."""
    out = np.zeros((len(rows), DIM), np.float32)
    for row, points in zip(out, rows, strict=True):
        for begin in range(0, len(points), words.BLOCK_BYTES):
            part = points[begin:begin + words.BLOCK_BYTES + MAX_GRAM - 1]
            gram = np.zeros(len(part), np.uint32)
            for n in range(1, min(MAX_GRAM, len(part)) + 1):
                gram = gram[:len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1:] + np.uint32(1)
                row[(gram * np.uint32(0x9E3779B1)) >> np.uint32(20)] = 1
    return out


def kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.outer(np.maximum(x.sum(1), 1), np.maximum(y.sum(1), 1)))
    return (x @ y.T) / size


def fit_numpy(x: np.ndarray, langs: list[str], ridge: float = 1e-2) -> Model | None:
    """``x``: presence rows in the order in which landmarks are taken, the languages in turn."""
    if not len(langs):
        return None
    names = sorted(set(langs))
    lang = np.array([names.index(v) for v in langs])
    turn = np.array([int((lang[:i] == v).sum()) for i, v in enumerate(lang)])
    marks = x[np.lexsort((lang, turn))[:LANDMARKS]]
    own = kernel(marks, marks).astype(np.float64)
    values, vectors = np.linalg.eigh(own)
    good = values > 1e-6 * values[-1]
    white = vectors[:, good] / np.sqrt(values[good])
    phi = np.hstack([kernel(x, marks) @ white, np.ones((len(x), 1))])
    target = np.where(lang[:, None] == np.arange(len(names)), 1.0, -1.0)
    gram = phi.T @ phi + ridge * len(x) * np.eye(phi.shape[1]) * 1e-2
    w = np.linalg.solve(gram, phi.T @ target)
    return Model(names, marks, np.vstack([white @ w[:-1], w[-1:]]).astype(np.float32))


def predict_numpy(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    total, weight = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))
    all_pieces = ((i, points, n) for i, text in enumerate(texts) for points, n in pieces(text))
    while part := list(islice(all_pieces, BATCH_TEXTS)):
        at, points, n = zip(*part, strict=True)
        f = kernel(presence_of(points), model.landmarks) @ model.dual[:-1] + model.dual[-1]
        np.add.at(total, list(at), f * np.array(n)[:, None])
        np.add.at(weight, list(at), n)
    f = total / np.maximum(weight, 1)[:, None]
    best, known = f.argmax(1), weight > 0
    score = np.clip((f.max(1) + 1) / 2, 0, 1)
    return [model.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fits on ``text`` and ``lang`` of at most ``sample_rows`` rows, the first by hashed text.

    The driver gets the n-gram bits of one piece of each, by hash as well: a fixed size a row.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(i, BATCH_TEXTS)
                found = zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True)
                rows = [p[at % len(p)][0] if (p := pieces(text)) else code_points("") for text, at in found]
                bits = np.packbits(presence_of(rows) > 0, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.tobytes() for b in bits], pa.binary()), part.column(1), part.column(2)],
                    ["bits", "lang", "at"])

    usable = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    cut = usable.select(F.xxhash64("text", "lang").alias("at")).orderBy("at").limit(sample_rows)
    last = cut.agg(F.max("at")).first()[0]
    if last is None:
        return None
    chosen = usable.select("text", "lang", F.xxhash64("text", "lang").alias("at")).where(F.col("at") <= last)
    one = chosen.dropDuplicates(["at"])
    found = sorted(one.mapInArrow(read, "bits binary, lang string, at long").collect(), key=lambda r: r["at"])
    x = np.array([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in found], np.float32)
    return fit_numpy(x, [r["lang"] for r in found])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, by its text alone."""
    if model is None:
        return docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.landmarks, model.dual))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(i, BATCH_TEXTS)
                lang, score = predict_numpy(Model(*shared.value), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from; a null id is outside it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learns on the rows that are not held out and predicts all."""
    model = fit(docs.where(~held_out(F.col("doc_id"))), sample_rows)
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
