"""Exact deduplication of byte strings by bucket-pointer refinement.

A window is ``window`` consecutive bytes of one text. Which windows start anywhere else is decided on
suffixes in buckets. Buckets for the tasks come from minimisers, the ``gram`` bytes of the smallest hash
in a window: equal windows have equal minimisers, so consecutive windows with one minimiser travel as one
string to its bucket, and minimisers that occur once in the corpus are left out. Equal strings are
grouped by their bytes before that, with their number, so copies meet in an aggregation.

Inside a bucket all suffixes are first sorted by their first eight bytes; the place where a suffix's
sub-bucket begins is its pointer. A sub-bucket of several suffixes is refined by sorting them on the
pointers of the suffixes ``depth`` bytes on; the finer pointers serve the next refinement, which sees
twice as far. Sub-buckets that are still shared at ``window`` bytes hold the repeated windows.

A bucket of more than ``BUCKET_BYTES`` is not gathered: its windows become 128-bit hashes, dealt by hash
to as many parts as it takes, and each part sorts its own. All rows of the result come this or that way.

Rows are told apart by id and text. Defined results: a null or empty text has no bytes and nothing to
remove; rows with a null id and repeated rows are documents like others, and several texts of one id are
several documents; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm import words
from basketlens.sources.writers import staged

WINDOW = 400
GRAM = 64
HEAD = 8  # bytes of the first buckets
BUCKET_BYTES = 4 << 20
BATCH_BYTES = 1 << 20
FLUSH_ROWS = 20_000
LETTERS = np.random.default_rng(400).integers(0, 2**64, (2, 256), dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)


def byte_hashes(data: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``n`` consecutive bytes, put together from hashes of 1, 2, 4, … bytes."""
    level, width, out, done = LETTERS[seed][data], 1, None, 0
    while True:
        if n & width:
            if out is None:
                out = level
            else:
                size = len(data) - done - width + 1
                out = words.mix(out[:size] * STEP + level[done:done + size])
            done += width
        if done == n:
            return out
        level = words.mix(level[:-width] * STEP + level[width:])
        width *= 2


def super_kmers(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, first byte, number of windows, minimiser, and whether the minimiser occurs again in it, of
    each run of windows with one minimiser, in texts laid side by side."""
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none, none, none, none, none
    g = byte_hashes(data, gram)
    span = window - gram + 1
    low, width = g, 1  # smallest of `width` hashes, doubled until the span is covered
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    n = len(data) - window + 1
    low = np.minimum(low[:n], low[span - width:span - width + n])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]
    inside = np.arange(n) + window <= offsets[text + 1]
    fresh = inside & np.r_[True, ~inside[:-1] | (low[1:] != low[:-1])]
    first = np.flatnonzero(fresh)
    stop = np.flatnonzero(inside & np.r_[fresh[1:] | ~inside[1:], True]) + 1
    minimiser = low[first]
    again = np.zeros(len(first), bool)
    view = np.lib.stride_tricks.sliding_window_view(g, span)
    for a in range(0, len(first), 1_000):
        part = slice(a, a + 1_000)
        value = minimiser[part, None]
        leftmost = first[part] + (view[first[part]] == value).argmax(1)
        rightmost = stop[part] - 1 + span - 1 - (view[stop[part] - 1][:, ::-1] == value).argmax(1)
        again[part] = leftmost != rightmost
    return text[first], first - offsets[text[first]], stop - first, minimiser.view(np.int64), again


def survey(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """A row for each run of windows (``doc``, ``mark``, ``first``, ``count``, ``minimiser``, ``again``,
    ``whole``), and one for each text with ``doc_id``, ``n_bytes`` and ``sha``."""
    names = ["doc", "mark", "doc_id", "n_bytes", "sha", "first", "count", "minimiser", "again", "whole"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark, ids = (batch.column(i).to_pylist() for i in range(3))
            for row, data, offsets in words.blocks(batch.column(3)):
                raw, size = memoryview(np.ascontiguousarray(data)), np.diff(offsets).tolist()
                k = len(size)
                sha = [hashlib.sha256(raw[a:a + n]).hexdigest() for a, n in zip(offsets.tolist(), size, strict=False)]
                rows = slice(row, row + k)
                yield words.record(names, [doc[rows], mark[rows], ids[rows], size, sha, *[[None] * k] * 5], kinds)
                text, first, count, minimiser, again = super_kmers(data, offsets, window, gram)
                begin = offsets[text] + first
                whole = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(begin.tolist(), (begin + count + window - 1).tolist(), strict=True)]
                k = len(first)
                yield words.record(names, [
                    [doc[row + i] for i in text.tolist()], [mark[row + i] for i in text.tolist()], *[[None] * k] * 3,
                    first.astype(np.int32), count.astype(np.int32), minimiser, again.astype(bool), whole], kinds)

    return docs.select("doc", "mark", "doc_id", "text").mapInArrow(
        read, "doc long, mark long, doc_id long, n_bytes long, sha string, first int, count int, minimiser long, "
              "again boolean, whole binary")


def packed(candidates: DataFrame, window: int) -> DataFrame:
    """``minimiser``, ``whole`` and ``bytes`` of the runs listed in ``spans`` of every text."""
    names = ["minimiser", "whole", "bytes"]
    kinds = [pa.int64(), pa.binary(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, out, held = batch.column(1), [[], [], []], 0
            for row, data, offsets in words.blocks(batch.column(0)):
                raw = data.tobytes()
                for i, base in enumerate(offsets[:-1].tolist()):
                    for s in spans[row + i].as_py():
                        a = base + s["first"]
                        text = raw[a:a + s["count"] + window - 1]
                        held += len(text)
                        for column, value in zip(out, (s["minimiser"], s["whole"], text), strict=True):
                            column.append(value)
                if held > 8 << 20:
                    yield words.record(names, out, kinds)
                    out, held = [[], [], []], 0
            yield words.record(names, out, kinds)

    return candidates.select("text", "spans").mapInArrow(read, "minimiser long, whole binary, bytes binary")


def refined(rank: np.ndarray, tied: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Splits the sub-buckets of ``tied`` by ``second``; sets their pointers and returns who still shares."""
    key = rank[tied] * (len(rank) + 1) + second
    order = np.argsort(key)
    key, place = key[order], tied[order]
    fresh = np.r_[True, key[1:] != key[:-1]][:len(key)]
    outer = np.r_[True, rank[place[1:]] != rank[place[:-1]]][:len(key)]
    at = np.arange(len(place))
    rank[place] += np.maximum.accumulate(np.where(fresh, at, 0)) - np.maximum.accumulate(np.where(outer, at, 0))
    return place[~(fresh & np.r_[fresh[1:], True][:len(key)])]


def shared_windows(data: np.ndarray, ends: np.ndarray, bucket: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that occur more than once in a bucket.

    ``ends`` is the end of each byte's string, ``bucket`` its bucket in rising order.
    """
    n = len(data)
    room = ends - np.arange(n)
    padded, code = np.r_[data, np.zeros(HEAD, np.uint8)].astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(HEAD):
        code = (code << np.uint64(8)) | padded[k:k + n]
    order = np.argsort(code)
    dense = np.empty(n, np.int64)
    dense[order] = np.cumsum(np.r_[0, code[order][1:] != code[order][:-1]])
    rank = np.searchsorted(bucket, bucket, "left").astype(np.int64)
    tied = refined(rank, np.flatnonzero(room >= HEAD), dense[room >= HEAD])
    depth = HEAD
    while depth < window and len(tied):
        ahead = min(depth, window - depth)
        tied = tied[room[tied] >= depth + ahead]
        tied = refined(rank, tied, rank[tied + ahead])
        depth += ahead
    return tied


def stretches(places: np.ndarray) -> list[dict]:
    """Sorted places as runs of consecutive ones."""
    cut = np.flatnonzero(np.r_[True, places[1:] != places[:-1] + 1])
    size = np.diff(np.r_[cut, len(places)])
    return [{"base": b, "count": c} for b, c in zip(places[cut].tolist(), size.tolist(), strict=True)]


SPANS = "array<struct<base:int,count:int>>"
SPAN_KIND = pa.list_(pa.struct([("base", pa.int32()), ("count", pa.int32())]))


def settle(strings: DataFrame, window: int) -> DataFrame:
    """``whole`` and ``spans``, the repeated windows of each string, for the buckets that are gathered."""
    names, kinds = ["whole", "spans"], [pa.binary(), SPAN_KIND]

    def judge(bucket: list, whole: list, text: list, members: list) -> pa.RecordBatch:
        size = np.array([len(t) for t in text], np.int64)
        stop = np.cumsum(size)
        begin = stop - size
        number = np.cumsum(np.r_[0, np.array([b != a for a, b in zip(bucket, bucket[1:], strict=False)], np.int64)])
        tied = shared_windows(np.frombuffer(b"".join(text), np.uint8), np.repeat(stop, size), np.repeat(number, size), window)
        tied = np.sort(tied)
        edge = np.searchsorted(tied, np.r_[begin, stop[-1]])
        out: list[list] = [[], []]
        for i, m in enumerate(members):
            mine = tied[edge[i]:edge[i + 1]] - begin[i]
            found = [{"base": 0, "count": int(size[i]) - window + 1}] if m > 1 else stretches(mine) if len(mine) else []
            if found:
                out[0].append(whole[i])
                out[1].append(found)
        return words.record(names, out, kinds)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if size > BATCH_BYTES and row[0] != held[0][-1]:
                    yield judge(*held)
                    held, size = [[], [], [], []], 0
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                size += len(row[2])
        if held[0]:
            yield judge(*held)

    dealt = strings.select("minimiser", "whole", "bytes", "members").repartition("minimiser").sortWithinPartitions("minimiser")
    return dealt.mapInArrow(read, f"whole binary, spans {SPANS}")


def settle_large(strings: DataFrame, window: int) -> DataFrame:
    """``settle`` for the buckets that are dealt to ``parts`` by the hash of the windows."""
    names = ["minimiser", "part", "whole", "members", "hashes", "bases"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for minimiser, whole, text, members, parts in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                data = np.frombuffer(text, np.uint8)
                pair = np.stack([byte_hashes(data, window, 0), byte_hashes(data, window, 1)], 1)
                part = (pair[:, 0] % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cut = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]])
                groups = np.split(order, cut[1:])
                k = len(groups)
                yield words.record(names, [
                    [minimiser] * k, [int(part[x[0]]) for x in groups], [whole] * k, [members] * k,
                    [pair[x].tobytes() for x in groups], [x.astype(np.int32).tobytes() for x in groups]], kinds)

    def judge(rows: list[tuple]) -> pa.RecordBatch:
        pair = np.concatenate([np.frombuffer(r[4], np.uint64).reshape(-1, 2) for r in rows])
        base = np.concatenate([np.frombuffer(r[5], np.int32) for r in rows])
        own = np.repeat(np.arange(len(rows)), [len(r[5]) // 4 for r in rows])
        order = np.lexsort((pair[:, 1], pair[:, 0]))
        fresh = np.r_[True, (pair[order][1:] != pair[order][:-1]).any(1)]
        start = np.flatnonzero(fresh)
        total = np.add.reduceat(np.array([r[3] for r in rows], np.int64)[own[order]], start)
        repeated = np.empty(len(order), bool)
        repeated[order] = np.repeat(total > 1, np.diff(np.r_[start, len(order)]))
        out: list[list] = [[], []]
        edge = np.searchsorted(own, np.arange(len(rows) + 1))
        for i, r in enumerate(rows):
            mine = base[edge[i]:edge[i + 1]][repeated[edge[i]:edge[i + 1]]]
            if len(mine):
                out[0].append(r[2])
                out[1].append(stretches(mine))
        return words.record(["whole", "spans"], out, [pa.binary(), SPAN_KIND])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(6)], strict=True):
                if held and row[:2] != held[0][:2]:
                    yield judge(held)
                    held = []
                held.append(row)
        if held:
            yield judge(held)

    hashed = strings.select("minimiser", "whole", "bytes", "members", "parts").mapInArrow(
        deal, "minimiser long, part int, whole binary, members long, hashes binary, bases binary")
    return hashed.repartition("minimiser", "part").sortWithinPartitions("minimiser", "part").mapInArrow(
        read, f"whole binary, spans {SPANS}")


def cut_bytes(rows: DataFrame, window: int) -> DataFrame:
    """``doc``, ``mark``, ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` of texts without
    the bytes of the windows listed in ``gone``."""
    names = ["doc", "mark", "doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    kinds = [pa.int64()] * 6 + [pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, gone = [batch.column(i).to_pylist() for i in range(3)], batch.column(4)
            out, held = [[] for _ in names], 0
            for row, data, offsets in words.blocks(batch.column(3)):
                for i in range(len(offsets) - 1):
                    own = data[offsets[i]:offsets[i + 1]]
                    spans = gone[row + i].values
                    base, count = (spans.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                    edge = np.bincount(base, minlength=len(own) + 1) - np.bincount(base + count + window - 1, minlength=len(own) + 1)
                    off = np.cumsum(edge)[:-1] > 0
                    kept = own[~off].tobytes()
                    held += len(kept)
                    values = (*[k[row + i] for k in keys], len(own), int(off.sum()), int((off & ~np.r_[False, off[:-1]]).sum()), kept)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                if held > 8 << 20:
                    yield words.record(names, out, kinds)
                    out, held = [[] for _ in names], 0
            yield words.record(names, out, kinds)

    return rows.select("doc", "mark", "doc_id", "text", "gone").mapInArrow(
        read, "doc long, mark long, doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` and ``sha`` of every row; ``kept`` is
    null, and ``sha`` that of the text, where nothing is removed; ``sha`` is null elsewhere."""
    key = F.col("doc_id").cast("long")
    docs = docs.select(F.coalesce(key, F.lit(0)).alias("doc"), F.xxhash64(key, "text").alias("mark"), key.alias("doc_id"), "text")
    found = staged(survey(docs, window, gram), "byte-survey")
    runs = found.where("minimiser IS NOT NULL").select("doc", "mark", "first", "count", "minimiser", "again", "whole")
    shared = runs.groupBy("minimiser").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"))
    shared = staged(shared.where("n > 1 OR again").select("minimiser"), "byte-shared")
    hits = staged(runs.drop("again").join(shared, "minimiser"), "byte-hits")
    spans = hits.groupBy("doc", "mark").agg(F.collect_set(F.struct("first", "count", "minimiser", "whole")).alias("spans"))
    candidates = staged(docs.join(spans, ["doc", "mark"]), "byte-candidates")
    strings = packed(candidates, window).groupBy("minimiser", "whole", "bytes").agg(F.count(F.lit(1)).alias("members"))
    strings = staged(strings, "byte-strings")
    sizes = strings.groupBy("minimiser").agg(F.sum(F.length("bytes")).alias("total"))
    large = staged(sizes.where(F.col("total") > BUCKET_BYTES).select(
        "minimiser", F.ceil(F.col("total") / BUCKET_BYTES).alias("parts")), "byte-large")
    repeated = settle(strings.join(large, "minimiser", "left_anti"), window).unionByName(
        settle_large(strings.join(large, "minimiser"), window))
    repeated = staged(repeated, "byte-repeated")
    placed = hits.select("doc", "mark", "first", "whole").join(repeated, "whole")
    placed = placed.select("doc", "mark", F.transform("spans", lambda s: F.struct(
        (s["base"] + F.col("first")).alias("base"), s["count"].alias("count"))).alias("spans"))
    gone = placed.groupBy("doc", "mark").agg(F.flatten(F.collect_list("spans")).alias("gone"))
    cut = staged(cut_bytes(candidates.drop("spans").join(gone, ["doc", "mark"]), window), "byte-cut")
    whole = found.where("n_bytes IS NOT NULL").join(cut.select("doc", "mark").distinct(), ["doc", "mark"], "left_anti")
    none = F.lit(0).cast("long")
    return whole.select(
        "doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.lit(None).cast("binary").alias("kept"), "sha",
    ).unionByName(cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", F.lit(None).cast("string").alias("sha")))
