"""Substring deduplication by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the ``gram``-word run of
the smallest hash in it; consecutive windows with the same minimiser are a super-k-mer. Windows with
equal words have equal minimisers, so only minimisers that two documents share can hold a repeated
window: these are found first, from 8-byte hashes. Each super-k-mer of a shared minimiser travels as one
packed string. Equal strings are grouped by their words, with the smallest document among them, before
they go to the minimiser's bucket. A bucket sorts its windows by their words and notes for each the
smallest document it starts in; the members of a string look their windows up there, by minimiser and a
128-bit hash of the string. Buckets of more than ``BUCKET_BYTES`` are not gathered: their windows travel
one by one as digests and are reduced by an aggregation.

Words covered by a window that also starts in a document with a smaller id are removed; windows are
judged on the input, not on what is left.

Defined results: rows are told apart by id and text, so that several texts of one id are judged each by
its own windows, and share the id; a null or empty text has no words; rows with a null id take no part in
the comparison and keep their text; repeated rows of an id have no smaller document in each other; other
columns are ignored.
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

WINDOW = 50
GRAM = 4
BUCKET_BYTES = 1 << 20  # of a bucket that one task sorts
FLUSH_ROWS = 20_000
STEPS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def super_kmers(
    h: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, minimiser and two hashes of all words of each super-k-mer."""
    g = words.run_hashes(h, gram)
    span = window - gram + 1
    if len(g) < span:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    low, width = g, 1  # smallest of `width` runs, doubled until the span is covered
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    n = len(g) - span + 1
    low = np.minimum(low[:n], low[span - width:span - width + n])
    first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    count = np.diff(np.r_[first, n])
    return first, count, low[first].view(np.int64), *(_whole(h, step, first, count + window - 1).view(np.int64) for step in STEPS)


def _whole(h: np.ndarray, step: int, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of the ``size`` words from ``first`` on: sums of h[i] * step**i, taken back to the beginning."""
    back = pow(step, -1, 1 << 64)
    up, down = (np.cumprod(np.r_[np.uint64(1), np.full(len(h) - 1, x, np.uint64)]) for x in (step, back))
    sums = np.r_[np.uint64(0), np.cumsum(words.mix(h ^ np.uint64(step)) * up)]
    return words.mix((sums[first + size] - sums[first]) * down[first] + size.astype(np.uint64))


def survey(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """A row for each super-k-mer (``doc_id``, ``mark``, ``first``, ``count``, ``minimiser``, ``whole``), and
    one for each document with ``n_words`` and ``sha`` of its unchanged words."""
    names = ["doc_id", "mark", "n_words", "sha", "first", "count", "minimiser", "whole"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def batch_of(docs_: list, kmers: list) -> pa.RecordBatch:
        heads = [list(x) for x in zip(*docs_, strict=True)] or [[]] * 4
        k = len(heads[0])
        long = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*kmers, strict=True)] or [np.zeros(0, np.int64)] * 7
        doc, mark, first, count, minimiser, one, two = long
        pair, none = np.stack([one, two], 1).tobytes(), [None] * len(doc)
        whole = [pair[i:i + 16] for i in range(0, len(pair), 16)]
        head = [[*heads[0], *doc.tolist()], [*heads[1], *mark.tolist()], [*heads[2], *none], [*heads[3], *none]]
        tail = [[*[None] * k, *x.tolist()] for x in (first, count, minimiser)]
        return words.record(names, [*head, *tail, [*[None] * k, *whole]], kinds)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            docs_, kmers, held = [], [], 0
            for row, data, starts, ends, h in words.word_rows(batch.column(2)):
                docs_.append((ids[row], marks[row], len(h), hashlib.sha256(words.joined(data, starts, ends)).hexdigest()))
                if ids[row] is not None:
                    found = super_kmers(h, window, gram)
                    n = len(found[0])
                    kmers.append((np.full(n, ids[row]), np.full(n, marks[row]), *found))
                    held += n
                if held + len(docs_) > FLUSH_ROWS:
                    yield batch_of(docs_, kmers)
                    docs_, kmers, held = [], [], 0
            yield batch_of(docs_, kmers)

    return docs.select("doc_id", "mark", "text").mapInArrow(
        read, "doc_id long, mark long, n_words long, sha string, first int, count int, minimiser long, whole binary")


def packed(candidates: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``minimiser``, ``whole`` and ``packed`` of the super-k-mers listed in ``spans``."""
    names = ["doc_id", "minimiser", "whole", "packed"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans = batch.column(0).to_pylist(), batch.column(2)
            out: list[list] = [[] for _ in names]
            held = 0
            for row, data, starts, ends, _ in words.word_rows(batch.column(1)):
                for s in spans[row].as_py():
                    a, last = s["first"], s["first"] + s["count"] + window - 1
                    text = words.joined(data, starts[a:last], ends[a:last])
                    held += len(text)
                    for column, value in zip(out, (ids[row], s["minimiser"], s["whole"], text), strict=True):
                        column.append(value)
                if held > 8 << 20:
                    yield words.record(names, out, kinds)
                    out, held = [[] for _ in names], 0
            yield words.record(names, out, kinds)

    return candidates.select("doc_id", "text", "spans").mapInArrow(
        read, "doc_id long, minimiser long, whole binary, packed binary")


def single_windows(strings: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``minimiser``, ``whole``, ``base`` and ``digest`` of every window of packed strings."""
    names = ["doc_id", "minimiser", "whole", "base", "digest"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, minimiser, whole, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                starts, ends = word_edges(text)
                for at in range(0, len(ends) - window + 1, FLUSH_ROWS):
                    bases = range(at, min(at + FLUSH_ROWS, len(ends) - window + 1))
                    k = len(bases)
                    digests = [hashlib.blake2b(text[starts[i]:ends[i + window - 1]], digest_size=16).digest() for i in bases]
                    yield words.record(names, [[doc] * k, [minimiser] * k, [whole] * k, list(bases), digests], kinds)

    return strings.select("doc_id", "minimiser", "whole", "packed").mapInArrow(
        read, "doc_id long, minimiser long, whole binary, base int, digest binary")


def word_edges(text: bytes) -> tuple[list[int], list[int]]:
    """First byte and end of the words of a packed string."""
    ends = np.flatnonzero(np.frombuffer(text + b" ", np.uint8) == 32).tolist()
    return [0, *[e + 1 for e in ends[:-1]]], ends


def settle(strings: DataFrame, window: int) -> DataFrame:
    """``minimiser``, ``whole``, ``base`` and ``least``: of each window of a packed string, from
    window ``base`` on, the smallest document it starts in. Buckets with ``large`` are not gathered."""
    def count(packs: list[bytes], docs: list[int]) -> list[list[int]]:
        cut, keys = [], []
        for text in packs:
            starts, ends = word_edges(text)
            cut.append(len(ends) - window + 1)
            keys += [text[starts[i]:ends[i + window - 1]] for i in range(cut[-1])]
        owner = np.repeat(np.array(docs, np.int64), cut)
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        fresh = np.array([i == 0 or keys[order[i]] != keys[order[i - 1]] for i in range(len(keys))])
        runs = np.flatnonzero(fresh)
        least = np.empty(len(keys), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(owner[order], runs), np.diff(np.r_[runs, len(keys)]))
        return [x.tolist() for x in np.split(least, np.cumsum(cut)[:-1])]

    names = ["minimiser", "whole", "base", "least"]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, packs, docs, marks = None, [], [], []
        out: list[list] = [[] for _ in names]

        def close() -> None:
            if packs:
                out[0].extend([bucket] * len(marks))
                out[1].extend(marks)
                out[2].extend([0] * len(marks))
                out[3].extend(count(packs, docs))

        for batch in batches:
            for m, mark, text, doc in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if m != bucket:
                    close()
                    bucket, packs, docs, marks = m, [], [], []
                    if len(out[0]) > FLUSH_ROWS:
                        yield words.record(names, out, kinds)
                        out = [[] for _ in names]
                packs.append(text)
                docs.append(doc)
                marks.append(mark)
        close()
        yield words.record(names, out, kinds)

    schema = "minimiser long, whole binary, base int, least array<long>"
    sorted_ = strings.where("NOT large").repartition("minimiser").sortWithinPartitions("minimiser")
    gathered = sorted_.select("minimiser", "whole", "packed", "doc_id").mapInArrow(read, schema)
    single = staged(single_windows(strings.where("large"), window), "sub-single")
    owners = staged(single.groupBy("digest").agg(F.min("doc_id").alias("owner")), "sub-owners")
    return gathered.unionByName(
        single.join(owners, "digest").select("minimiser", "whole", "base", F.array("owner").alias("least")))


def cut_words(rows: DataFrame, window: int) -> DataFrame:
    """``doc_id``, ``mark``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` of texts without the
    words of the windows that begin at ``gone``."""
    names = ["doc_id", "mark", "n_words", "n_removed", "kept_sha256", "kept_text"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, gone = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for row, data, starts, ends, h in words.word_rows(batch.column(2)):
                first = gone[row].values.to_numpy().astype(np.int64)
                edge = np.bincount(first, minlength=len(h) + 1) - np.bincount(first + window, minlength=len(h) + 1)
                keep = np.cumsum(edge)[:-1] == 0
                text = words.joined(data, starts[keep], ends[keep])
                yield words.record(names, [
                    [ids[row]], [marks[row]], [len(h)], [int((~keep).sum())], [hashlib.sha256(text).hexdigest()],
                    [text.decode("utf-8", "replace")]], kinds)

    return rows.select("doc_id", "mark", "text", "gone").mapInArrow(
        read, "doc_id long, mark long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` of every row;
    ``kept_text`` is null where nothing is removed."""
    key = ["doc_id", "mark"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    found = staged(survey(docs, window, gram), "sub-survey")
    kmers = found.where("minimiser IS NOT NULL").drop("n_words", "sha")
    ends = kmers.groupBy("minimiser").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    shared = staged(ends.where("lo < hi").select("minimiser"), "sub-shared")
    hits = staged(kmers.join(shared, "minimiser"), "sub-hits")
    spans = hits.groupBy(*key).agg(F.collect_set(F.struct("first", "count", "minimiser", "whole")).alias("spans"))
    candidates = staged(docs.join(spans, key), "sub-candidates")
    strings = staged(packed(candidates, window).groupBy("minimiser", "whole", "packed").agg(F.min("doc_id").alias("doc_id")), "sub-strings")
    sizes = strings.groupBy("minimiser").agg(F.sum(F.length("packed")).alias("total"))
    large = staged(sizes.where(F.col("total") > BUCKET_BYTES).select("minimiser", F.lit(True).alias("large")), "sub-large")
    judged = strings.join(large, "minimiser", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    least = staged(settle(judged, window), "sub-least")

    placed = hits.select(*key, "first", "minimiser", "whole").join(least, ["minimiser", "whole"])
    offset = F.col("first") + F.col("base")
    later = F.filter(
        F.transform("least", lambda owner, i: F.when(owner < F.col("doc_id"), offset + i)), lambda i: i.isNotNull())
    placed = placed.select(*key, later.alias("windows")).where(F.size("windows") > 0)
    gone = placed.groupBy(*key).agg(F.array_distinct(F.flatten(F.collect_list("windows"))).alias("gone"))
    cut = staged(cut_words(candidates.drop("spans").join(staged(gone, "sub-gone"), key), window), "sub-cut")

    mended = cut.select(F.col("doc_id").alias("id"), F.col("mark").alias("of")).distinct()
    same = found.where("n_words IS NOT NULL").join(mended, (F.col("doc_id") == F.col("id")) & (F.col("mark") == F.col("of")), "left_anti")
    return same.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"),
                       F.lit(None).cast("string").alias("kept_text")).unionByName(cut.drop("mark"))
