"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

Every task lays the words of some documents side by side, each document its own alphabet, and ranks
their suffixes by prefix doubling. Two suffixes a period apart inside a long run share many words, so a
document whose suffixes are told apart by ``screen`` words has no run that counts and leaves there. For
the others the ranks of every step stay: they give the longest common prefixes of neighbours in the
suffix array, and later the rotations. For each interval of the LCP array, of depth l, every suffix i of
its children but the largest asks whether suffix i+l or i-l lies in another child of the interval: then a
square of period l begins at i (or i-l) and cannot be moved right. Each square is rotated left as far as
it goes; what it sweeps is a run. Runs of one stretch are merged to the smallest period. No tree is built:
intervals are pairs of places in the array.

Defined results: a null or empty text has no words, no run and an empty collapsed text; rows with a null
id are treated like others; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm import words

MIN_LENGTH = 24
MIN_COPIES = 3
SUFFIXES = 1 << 21  # that are tested at once
FLUSH_BYTES = 4 << 20
SPACE = r"[\x20\x09-\x0D]+"
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def screen(min_length: int, min_copies: int) -> int:
    """Words that two suffixes a period apart share at least, at the beginning of a run that counts."""
    return min(max(min_length - q, (min_copies - 1) * q) for q in range(1, min_length + 1))


def ranks(symbols: np.ndarray, room: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Depth, rank of every suffix by that many symbols, and the suffixes that still share theirs.

    A rank is the number of smaller suffixes. ``room`` counts the symbols up to the end of the sequence,
    which is smaller than every symbol. Depths double up to ``least``, and on while ranks are shared.
    """
    n, depth = len(symbols), 0
    rank, tied, second = np.zeros(n, np.int64), np.arange(n), symbols.astype(np.int64)
    while True:
        key = rank[tied] * (n + 2) + second if depth else second
        order = np.argsort(key, kind="stable")
        key, place = key[order], tied[order]
        fresh = np.r_[True, key[1:] != key[:-1]]
        outer = np.r_[True, rank[place[1:]] != rank[place[:-1]]]
        at = np.arange(len(place))
        start = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[place] += start - np.maximum.accumulate(np.where(outer, at, 0))
        single = fresh & np.r_[fresh[1:], True]
        tied = place[~single]
        depth = depth * 2 or 1
        yield depth, rank, tied
        if not len(tied):
            return
        second = np.where(room[tied] > depth, rank[np.minimum(tied + depth, n - 1)] + 1, 0)
        if depth >= n and depth >= least:
            raise AssertionError("equal suffixes")


def shared(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` have in common."""
    out = np.zeros(len(a), np.int64)
    top = len(room) - 1
    for k in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + out, top), np.minimum(b + out, top)
        same = (levels[k][x] == levels[k][y]) & (room[a] > out) & (room[b] > out)
        out += same.astype(np.int64) << k
    return out


def rotations(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Symbols before ``a`` that equal those before ``b``; ``before`` counts what precedes each place."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        fits = before[a] >= out + step
        x, y = np.where(fits, a - out - step, 0), np.where(fits, b - out - step, 0)
        out += np.where(fits & (levels[k][x] == levels[k][y]), step, 0)
    return out


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the LCP interval that each place cuts: its first suffix, and the one after its last."""
    values = lcp.tolist()
    left, right, open_ = [0] * len(values), [len(values)] * len(values), []
    for k, depth in enumerate(values):
        while open_ and values[open_[-1]] > depth:
            right[open_.pop()] = k
        if open_:
            top = open_[-1]
            left[k] = left[top] if values[top] == depth else top
        open_.append(k)
    return np.array(left, np.int64), np.array(right, np.int64)


def smaller_children(lcp: np.ndarray) -> tuple[np.ndarray, ...]:
    """All children but a largest one of every LCP interval: first suffix, end, and the interval's
    depth, first suffix and end."""
    left, right = intervals(lcp)
    cut = np.flatnonzero(lcp > 0)
    cut = cut[np.lexsort((cut, right[cut], left[cut]))]
    lo, hi = left[cut], right[cut]
    fresh = np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
    group = np.cumsum(fresh) - 1
    following = np.where(np.r_[fresh[1:], True], hi, np.r_[cut[1:], 0])
    begin, end = np.r_[cut, lo[fresh]], np.r_[following, cut[fresh]]
    owner = np.r_[group, np.arange(group[-1] + 1)]
    order = np.lexsort((end - begin, owner))
    largest = np.r_[owner[order][1:] != owner[order][:-1], True]
    kept = order[~largest]
    head = np.flatnonzero(fresh)[owner[kept]]
    return begin[kept], end[kept], lcp[cut[head]], lo[head], hi[head]


def squares(suffix: np.ndarray, place: np.ndarray, lcp: np.ndarray, before: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of every square that does not go on to the right.

    ``suffix`` is the suffix array, ``place`` its inverse (-1 for suffixes that are not in it).
    """
    if not (lcp > 0).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    children = smaller_children(lcp)
    total = np.cumsum(children[1] - children[0])
    found, at = [], 0
    while at < len(total):
        done = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, done + SUFFIXES, "right")))
        begin, end, depth, lo, hi = (x[at:stop] for x in children)
        size = end - begin
        own = np.repeat(np.arange(len(size)), size)
        i = suffix[np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size) + begin[own]]
        for step, fits in ((1, room[i] > depth[own]), (-1, before[i] >= depth[own])):
            x, mine = i[fits], own[fits]
            other = place[x + step * depth[mine]]
            hit = (other >= lo[mine]) & (other < hi[mine]) & ((other < begin[mine]) | (other >= end[mine]))
            found.append((x[hit] + min(step, 0) * depth[mine][hit], depth[mine][hit]))
        at = stop
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def maximal_runs(
    symbols: np.ndarray, owner: np.ndarray, min_length: int = MIN_LENGTH, min_copies: int = MIN_COPIES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of the runs in sequences laid side by side.

    ``owner`` numbers the sequence of each symbol in rising order.
    """
    none = np.zeros(0, np.int64)
    n = len(symbols)
    if n < min_length:
        return none, none, none
    first = np.searchsorted(owner, owner, "left")
    room = np.searchsorted(owner, owner, "right") - np.arange(n)
    before = np.arange(n) - first
    apart = owner.astype(np.int64) * (int(symbols.max()) + 1) + symbols
    least, levels, chosen = screen(min_length, min_copies), [], None
    for depth, rank, tied in ranks(apart, room, least):
        if chosen is None and 2 * depth > least:
            chosen = np.unique(owner[tied])
        levels.append(rank.astype(np.int32))
    if chosen is None:
        chosen = np.zeros(0, np.int64)
    if not len(chosen):
        return none, none, none
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    suffix = order[np.isin(owner[order], chosen)]
    place = np.full(n, -1, np.int64)
    place[suffix] = np.arange(len(suffix))
    lcp = np.r_[0, shared(levels, suffix[:-1], suffix[1:], room)]
    start, period = squares(suffix, place, lcp, before, room)
    end = start + 2 * period
    start = start - rotations(levels, start, start + period, before)
    length = end - start
    long = (length >= min_length) & (length >= min_copies * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    fresh = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][:len(start)]
    return start[fresh], end[fresh], period[fresh]


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_copies: int = MIN_COPIES) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed``, the words that no
    run covers after its first period, joined by single spaces."""
    names = ["doc_id", "n_words", "runs", "collapsed"]
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), run, pa.large_binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, held = batch.column(0).to_pylist(), [[] for _ in names], 0
            for first, data, offsets in words.blocks(batch.column(1)):
                starts, ends = words.bounds(data, offsets[:-1])
                edges = np.searchsorted(starts, offsets)
                owner = np.repeat(np.arange(len(offsets) - 1), np.diff(edges))
                symbols = words.identities(data, starts, ends)
                begin, end, period = maximal_runs(symbols, owner, min_length, min_copies)
                delta = np.bincount(begin + period, minlength=len(starts) + 1) - np.bincount(end, minlength=len(starts) + 1)
                keep = np.cumsum(delta)[:-1] == 0
                which = np.searchsorted(begin, edges)
                for i in range(len(offsets) - 1):
                    a, b = edges[i], edges[i + 1]
                    mine = slice(which[i], which[i + 1])
                    found = [
                        {"start": s, "length": e, "period": p} for s, e, p in zip(
                            (begin[mine] - a).tolist(), (end - begin)[mine].tolist(), period[mine].tolist(), strict=True)]
                    left = keep[a:b]
                    text = words.joined(data, starts[a:b][left], ends[a:b][left])
                    held += len(text)
                    for column, value in zip(out, (ids[first + i], int(b - a), found, text), strict=True):
                        column.append(value)
                if held > FLUSH_BYTES:
                    yield words.record(names, out, kinds)
                    out, held = [[] for _ in names], 0
            yield words.record(names, out, kinds)

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        read, f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run of the greatest length by period; of equal ones the first."""
    return F.aggregate(
        runs, F.lit(None).cast(RUN),
        lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best))


def described(found: DataFrame) -> DataFrame:
    """``find_runs`` with the strongest run, and digests for the list of runs and the collapsed text."""
    best = strongest(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def repeat_tails(docs: DataFrame) -> DataFrame:
    """``docs`` in which every tenth document, by the checksum of its id, ends in a repeated phrase.

    With h the CRC-32 of the decimal id, g = h div 10, h divisible by 10 and n > 0 words: word i from
    a = g % n on becomes word a + (i - a) % p, where p = 1 + (n - a) div (3 + g % 8).
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    split = F.filter(F.split("text", SPACE), lambda w: w != "")
    chosen = docs.withColumn("__h", h).withColumn("__w", F.when((F.col("__h") % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), split))
    n, g = F.size("__w"), F.floor(F.col("__h") / 10)
    a = (g % n).cast("int")
    p = F.lit(1) + F.floor((n - F.col("__a")) / (3 + g % 8)).cast("int")
    made = chosen.withColumn("__a", a).withColumn("__p", p)
    tail = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get("__w", F.when(i < F.col("__a"), i).otherwise(F.col("__a") + (i - F.col("__a")) % F.col("__p"))))
    text = F.when(F.col("__w").isNull(), F.col("text")).otherwise(F.array_join(tail, " "))
    return made.withColumn("text", text).select(*docs.columns)
