"""Personal data: rules, and a character-level bidirectional LSTM with CRF transitions.

The base finds e-mail addresses, IP addresses, card and phone numbers by fixed patterns and checks.
The model learns from labelled spans, here those of the base, and adds spans of the same kinds that
the patterns miss: broken or unusual spellings. Each character gets a tag (outside, or begin / inside of
a kind); forward and backward LSTM states are turned into tag scores, and CRF transitions decide on
the best sequence of tags. All of it is numpy, trained on a bounded sample of windows.

Long texts are cut into windows of ``SPAN`` characters with an overlap of ``OVERLAP``. In an overlap the
window whose edge is farther away decides. Spans are then merged over the text: base spans stay, and
a span of the model is added if it touches no other span and holds a digit or an ``@``, without which
nothing of the four kinds can be said. As any other window ends without a span, only windows with such
a character are decoded; all others are known to add nothing.

Defined results: a null or empty text has no spans; null ids and repeated rows are processed like any
other row; other columns are ignored. With nothing to learn from there is no model and the base stays.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")
SPAN, OVERLAP = 192, 64
HIDDEN, EMBED = 24, 12
SAMPLE_ROWS = 4_000
SAMPLE_WINDOWS = 1_200
BATCH = 128


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each ``@`` outwards,
    so that a long run of letters is read once."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind and start."""
    found = [("email", a, b) for a, b in _emails(text)]
    if not HINT.search(text):
        return found
    found += [("ip", *m.span()) for m in IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = _digits(m.group())
        if 16 <= len(d) <= 19 and _luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return found


def classes(text: str) -> np.ndarray:
    """One of 128 classes for each character: ASCII as it is, other letters 1, anything else 2."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(points < 128, points, 2).astype(np.int64)
    for i in np.flatnonzero(points >= 128):
        out[i] = 1 if text[i].isalpha() else 2
    return out


def windows(text: str) -> list[tuple[int, int]]:
    """Overlapping stretches of the whole text that hold a digit or ``@``."""
    step = SPAN - OVERLAP
    numbers: list[int] = []
    for m in HINT.finditer(text):
        at = m.start()
        for k in range(max(0, (at - SPAN) // step + 1), at // step + 1):
            if not numbers or numbers[-1] < k:
                numbers.append(k)
    return [(k * step, min(k * step + SPAN, len(text))) for k in numbers if k == 0 or k * step + OVERLAP < len(text)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Parameters of both directions (0 forward, 1 backward), the tag scores and the transitions."""

    embed: np.ndarray
    wx: list[np.ndarray]
    wh: list[np.ndarray]
    b: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    move: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embed, *self.wx, *self.wh, *self.b, self.out, self.bias, self.move]

    @staticmethod
    def of(p: list[np.ndarray]) -> Model:
        return Model(p[0], p[1:3], p[3:5], p[5:7], p[7], p[8], p[9])

    @staticmethod
    def fresh(seed: int = 0) -> Model:
        r = np.random.default_rng(seed)
        n = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        b = [np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32) for _ in "fb"]
        t = len(TAGS)
        return Model(n(128, EMBED) * 3, [n(EMBED, 4 * HIDDEN) for _ in "fb"], [n(HIDDEN, 4 * HIDDEN) for _ in "fb"], b,
                     n(2 * HIDDEN, t), np.zeros(t, np.float32), np.zeros((t, t), np.float32))

    def run(self, x: np.ndarray, way: int) -> tuple[np.ndarray, list]:
        """States (time, batch, hidden) in the order of time, and what the gradient needs."""
        table = self.embed @ self.wx[way] + self.b[way]
        n, length = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, kept = np.empty((length, n, HIDDEN), np.float32), []
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            z = table[x[:, t]] + h @ self.wh[way]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            before_h, before_c = h, c
            c = f * c + i * g
            th = np.tanh(c)
            h = o * th
            out[t] = h
            kept.append((t, i, f, o, g, th, before_c, before_h))
        return out, kept

    def scores(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Tag scores (time, batch, tags)."""
        forward, kf = self.run(x, 0)
        backward, kb = self.run(x, 1)
        both = np.concatenate([forward, backward], 2)
        return both @ self.out + self.bias, (both, kf, kb)

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tags of each row, by Viterbi."""
        s, _ = self.scores(x)
        best = s[0]
        back = np.zeros(s.shape, np.int64)
        for t in range(1, len(s)):
            ways = best[:, :, None] + self.move
            back[t] = ways.argmax(1)
            best = ways.max(1) + s[t]
        tags = np.empty((len(s), x.shape[0]), np.int64)
        tags[-1] = best.argmax(1)
        for t in range(len(s) - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(x.shape[0]), tags[t]]
        return tags.T

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of the tag sequences and its gradient, part by part."""
        s, (both, kf, kb) = self.scores(x)
        length, n, tags = s.shape
        row = np.arange(n)
        lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        alpha, beta = np.empty_like(s), np.zeros_like(s)
        alpha[0] = s[0]
        for t in range(1, length):
            alpha[t] = lse(alpha[t - 1][:, :, None] + self.move, 1) + s[t]
        for t in range(length - 2, -1, -1):
            beta[t] = lse(self.move + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        ds = np.exp(alpha + beta - z[None, :, None])
        gold = s[0][row, y[:, 0]].copy()
        dmove = np.zeros_like(self.move)
        for t in range(1, length):
            joint = np.exp(alpha[t - 1][:, :, None] + self.move + (s[t] + beta[t])[:, None, :] - z[:, None, None])
            dmove += joint.sum(0)
            np.subtract.at(dmove, (y[:, t - 1], y[:, t]), 1)
            gold += s[t][row, y[:, t]] + self.move[y[:, t - 1], y[:, t]]
        for t in range(length):
            ds[t][row, y[:, t]] -= 1
        ds /= n
        dout = np.tensordot(both, ds, ([0, 1], [0, 1]))
        dboth = ds @ self.out.T
        dembed = np.zeros_like(self.embed)
        dwx, dwh, db = [], [], []
        for way, kept in ((0, kf), (1, kb)):
            dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            dtable, gh = np.zeros((128, 4 * HIDDEN), np.float32), np.zeros_like(self.wh[way])
            for t, i, f, o, g, th, before_c, before_h in reversed(kept):
                dh = dh + dboth[t][:, way * HIDDEN:(way + 1) * HIDDEN]
                dc = dc + dh * o * (1 - th * th)
                dz = np.hstack([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)])
                np.add.at(dtable, x[:, t], dz)
                gh += before_h.T @ dz
                dh, dc = dz @ self.wh[way].T, dc * f
            dembed += dtable @ self.wx[way].T
            dwx.append(self.embed.T @ dtable)
            dwh.append(gh)
            db.append(dtable.sum(0))
        return float((z - gold).mean()), [dembed, *dwx, *dwh, *db, dout, ds.sum((0, 1)), dmove / n]


def train(rows: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = 5, rate: float = 0.01, seed: int = 0) -> Model | None:
    """Fits windows of text with labelled spans (kind number, start, end) by Adam."""
    if not rows:
        return None
    r = np.random.default_rng(seed)
    x = np.full((len(rows), SPAN), 32)
    y = np.zeros((len(rows), SPAN), np.int64)
    for k, (text, spans) in enumerate(rows):
        codes = classes(text[:SPAN])
        x[k, :len(codes)] = codes
        for kind, a, b in spans:
            y[k, a:min(b, SPAN)] = 2 * kind + 2
            y[k, a:a + 1] = 2 * kind + 1
    parts = Model.fresh(seed).parts()
    m, v, step = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(epochs):
        order = r.permutation(len(rows))
        for at in range(0, len(rows), 32):
            pick = order[at:at + 32]
            step += 1
            _, grad = Model.of(parts).gradient(x[pick], y[pick])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad))
            for p, g, a, b in zip(parts, grad, m, v, strict=True):
                g = g * min(1, 5 / (norm + 1e-9))
                a *= 0.9
                a += 0.1 * g
                b *= 0.99
                b += 0.01 * g * g
                p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(p.dtype)
    return Model.of(parts)


def model_spans(model: Model, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans of every whole text by the model, reconciled over its windows."""
    places = [(i, a, b) for i, t in enumerate(texts) for a, b in windows(t)]
    kept: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    coded: dict[int, np.ndarray] = {}
    for at in range(0, len(places), BATCH):
        group = places[at:at + BATCH]
        x = np.full((len(group), SPAN), 32)
        for row, (i, a, b) in zip(x, group, strict=True):
            row[:b - a] = classes(texts[i][a:b])
        for (i, a, b), tags in zip(group, model.decode(x), strict=True):
            low = a + OVERLAP // 2 if a else 0
            high = b - OVERLAP // 2 if b < len(texts[i]) else b
            whole = coded.setdefault(i, np.zeros(0, np.int64))
            if len(whole) < b:
                coded[i] = whole = np.r_[whole, np.zeros(b - len(whole), np.int64)]
            whole[low:high] = tags[low - a:high - a]
    for i, tags in coded.items():
        edge = np.flatnonzero(np.r_[True, tags[1:] != tags[:-1], True]) if len(tags) else []
        runs = [(int(tags[a]), int(a), int(b)) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        for tag, a, b in runs:
            if not tag:
                continue
            kind = (tag - 1) // 2
            last = kept[i][-1] if kept[i] else None
            if tag % 2 == 0 and last and last[0] == KINDS[kind] and last[2] == a:
                kept[i][-1] = (last[0], last[1], b)
            else:
                kept[i].append((KINDS[kind], a, b))
    return kept


def merged(text: str, base: list[tuple[str, int, int]], more: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans, and the model's that touch none and hold what a span of their kind must."""
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for kind, a, b in more:
        while a < b and text[a].isspace():
            a += 1
        while a < b and text[b - 1].isspace():
            b -= 1
        part = text[a:b]
        enough = "@" in part and len(part) >= 5 if kind == "email" else len(_digits(part)) >= (4 if kind == "ip" else 8)
        if enough and all(b <= x or y <= a for x, y in taken):
            added.append((kind, a, b))
            taken.append((a, b))
    return sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, limit: int = SAMPLE_WINDOWS) -> list[tuple[str, list]]:
    """Labelled windows for training: at most ``limit`` of at most ``rows`` texts with a hint, those
    with the smallest hashed text; a text gives 64 windows at most, each of bounded length."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for text, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spans = base_spans(text)
                for a, b in windows(text)[:64]:
                    inside = [f"{KINDS.index(k)}:{max(s, a) - a}:{min(e, b) - a}" for k, s, e in spans if s < b and e > a]
                    for column, value in zip(out, (at, text[a:b], ",".join(inside)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], ["at", "part", "spans"])

    hinted = docs.where(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("at"))
    last = hinted.select("at").distinct().orderBy("at").limit(rows).agg(F.max("at")).first()[0]
    if last is None:
        return []
    found = hinted.where(F.col("at") <= last).mapInArrow(read, "at long, part string, spans string")
    chosen = found.distinct().orderBy("at", "part", "spans").limit(limit).collect()
    return [(r["part"], [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]) for r in chosen]


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, the base counts, ``base_sha256`` and ``spans`` of every row."""
    parts = docs.sparkSession.sparkContext.broadcast(model.parts() if model else None)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    line = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.of(parts.value) if parts.value else None
        for batch in batches:
            out: list[list] = [[] for _ in names]
            ids = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, BATCH):
                texts = [t or "" for t in batch.column(1).slice(at, BATCH).to_pylist()]
                base = [base_spans(t) for t in texts]
                more = model_spans(own, texts) if own else [[] for _ in texts]
                for i, (text, b, m) in enumerate(zip(texts, base, more, strict=True)):
                    counts = [sum(k == kind for k, _, _ in b) for kind in KINDS]
                    values = [ids[at + i], *counts, hashlib.sha256(line(b).encode()).hexdigest(), line(merged(text, b, m))]
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        read, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Trains on the labelled spans of a sample and applies base and model to every whole text."""
    return find(docs, train(sample(docs)))
