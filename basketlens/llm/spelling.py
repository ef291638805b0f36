"""Spelling variants: words at an edit distance of one, found by pivotal grams.

Bigrams are ordered by frequency, rarest first. The prefix of a word is its three rarest bigrams (with
all that are as rare as the third); its pivots are two disjoint bigrams of the prefix with the least
total frequency, chosen by dynamic programming over their positions. One edit spoils one pivot at most,
so of two words one edit apart, the one whose prefix ends with the rarer bigram has a pivot that stands
in the other's prefix. Prefixes are indexed and pivots look them up; every pair found is verified.

The position limit of a surviving pivot is used to the full: an edit to the right of it leaves the text
up to it in place, an edit to the left leaves the text from it on. The side with the edit is halved once
more, and the edit spares one half of it. So an index entry stands under four keys, the lengths of both
words and the spared text; a pivot asks under the same keys for partners shorter by one, as long, or
longer by one. Hot keys are inner joins that adaptive execution splits.

The bigram table has at most 90 * 90 rows, as letters are a-z and U+00C0 to U+00FF; the driver holds it.

Defined results: a null or empty text has no words; the runs of rows with a null id are all kept as they
are; repeated rows count each; other columns are ignored; an empty table gives no words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm import words
from basketlens.sources.writers import staged

MIN_LETTERS = 5
MIN_COUNT = 3
FACTOR = 2
ODD = 97
FLUSH_WORDS = 100_000
LATIN = np.zeros(256, bool)
LATIN[65:91] = LATIN[97:123] = True
LEAD = 0xC3  # first byte of U+00C0 to U+00FF


def letter_runs(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of the maximal runs of a-z, A-Z and U+00C0 to U+00FF."""
    inside = LATIN[data]
    lead = data == LEAD
    inside |= lead
    inside[1:] |= lead[:-1]
    return words.edges(inside, cuts)


def word_counts(docs: DataFrame, odd: int = ODD, least: int = MIN_LETTERS) -> DataFrame:
    """``word`` and ``n``: how often each lower-cased run of letters occurs in all texts.

    With h the CRC-32 of ``<doc_id>:<run>``, a run loses its code point h % length where ``odd`` divides h.
    Words of fewer than ``least`` code points are left out.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def flushed() -> pa.RecordBatch:
            return words.record(["word", "n"], [list(total), list(total.values())], [pa.binary(), pa.int64()])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, data, offsets in words.blocks(batch.column(1)):
                data = words.LOWER[data]
                starts, ends = letter_runs(data, offsets[:-1])
                long = ends - starts >= least
                starts, ends = starts[long], ends[long]
                owner = np.searchsorted(offsets, starts, "right") - 1
                code, known = words.coded(data, starts, ends)
                known = known.to_pylist()
                pair, count = np.unique(owner * len(known) + code, return_counts=True)
                owner, code = np.divmod(pair, max(len(known), 1))
                seeds = [None if i is None else zlib.crc32(b"%d:" % i) for i in ids[first:first + len(offsets) - 1]]
                for i, k, n in zip(owner.tolist(), code.tolist(), count.tolist(), strict=True):
                    word, seed = known[k], seeds[i]
                    if seed is not None:
                        h = zlib.crc32(word, seed)
                        if h % odd == 0:
                            text = word.decode()
                            at = h % len(text)
                            word = (text[:at] + text[at + 1:]).encode()
                    total[word] = total.get(word, 0) + n
                if len(total) > FLUSH_WORDS:
                    yield flushed()
                    total.clear()
        yield flushed()

    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "word binary, n long")
    parts = parts.select(F.col("word").cast("string"), "n").where(F.length("word") >= least)
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def pivots(places: list[int], cost: list[int]) -> tuple[int, int]:
    """The two of the rising ``places``, two or more apart, with the least total cost."""
    far, near, best, k = None, None, None, 0  # cheapest single place up to p - 2, up to p - 1; cheapest pair
    for p in range(places[0], places[-1] + 1):
        here = None
        if places[k] == p:
            here = (cost[k], p)
            k += 1
            if far and (best is None or far[0] + here[0] < best[0]):
                best = (far[0] + here[0], far[1], p)
        far, near = (min(x for x in (far, near) if x) if far or near else None), here
    return best[1], best[2]


def index_keys(w: str, p: int) -> list[str]:
    """Keys of the bigram at ``p`` in an indexed word: what an edit elsewhere may spare."""
    n = len(w)
    right, left = (p + 2 + n) // 2, p // 2
    return [
        f"a{p} {n} {w[:right]}",  # edit behind the middle of the right side
        f"b{n} {w[:p + 2]} {w[right:]}",  # edit between the bigram and that middle
        f"c{n - p} {n} {w[left:]}",  # edit before the middle of the left side
        f"d{n} {w[:left]} {w[p:]}",  # edit between that middle and the bigram
    ]


def probe_keys(w: str, p: int) -> list[str]:
    """The keys under which words of one edit more, less or elsewhere hold the pivot at ``p``."""
    n, out = len(w), []
    for more in (-1, 0, 1):
        other = n + more
        right, i = (p + 2 + other) // 2, p + more
        left = i // 2
        if right <= n:
            out.append(f"a{p} {other} {w[:right]}")
        if right - more >= p + 2:
            out.append(f"b{other} {w[:p + 2]} {w[right - more:]}")
        if i >= 0:
            if left >= more:
                out.append(f"c{n - p} {other} {w[left - more:]}")
            if left <= p:
                out.append(f"d{other} {w[:left]} {w[p:]}")
    return out


def with_keys(vocabulary: DataFrame, order: dict[str, tuple[int, int]]) -> DataFrame:
    """``word``, ``n``, ``last`` (place of the rarest prefix's end in the order of bigrams), ``index``
    and ``probes``. ``order`` gives place and frequency of every bigram."""
    names = ["word", "n", "last", "index", "probes"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string())]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams = [order[w[i:i + 2]] for i in range(len(w) - 1)]
                last = sorted(g[0] for g in grams)[2]
                prefix = [i for i, g in enumerate(grams) if g[0] <= last]
                chosen = pivots(prefix, [grams[i][1] for i in prefix])
                index = [k for p in prefix for k in index_keys(w, p)]
                probes = [k for p in chosen for k in probe_keys(w, p)]
                for column, value in zip(out, (w, n, last, index, probes), strict=True):
                    column.append(value)
            yield words.record(names, out, kinds)

    return vocabulary.select("word", "n").mapInArrow(
        read, "word string, n long, last int, index array<string>, probes array<string>")


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: every two words that one inserted, deleted or replaced code point
    tells apart, once, with a < b. Words have four code points at least."""
    gram = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, 2)))
    counts = vocabulary.select(gram.alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()
    order = {r["gram"]: (k, r["n"]) for k, r in enumerate(sorted(counts, key=lambda r: (r["n"], r["gram"])))}
    keyed = staged(with_keys(vocabulary, order), "spelling-keys")
    index = keyed.select(F.explode(F.transform("index", lambda k: F.xxhash64(k))).alias("key"), F.col("word").alias("r"), F.col("n").alias("n_r"), F.col("last").alias("last_r"))
    probes = keyed.select(F.explode(F.transform("probes", lambda k: F.xxhash64(k))).alias("key"), F.col("word").alias("s"), F.col("n").alias("n_s"), F.col("last").alias("last_s"))
    met = index.join(probes.hint("merge"), "key").where("last_r >= last_s AND r <> s")
    met = met.where(F.levenshtein("r", "s", 1) == 1)
    first = F.col("r") < F.col("s")
    return met.select(
        F.when(first, F.col("r")).otherwise(F.col("s")).alias("a"), F.when(first, F.col("n_r")).otherwise(F.col("n_s")).alias("n_a"),
        F.when(first, F.col("s")).otherwise(F.col("r")).alias("b"), F.when(first, F.col("n_s")).otherwise(F.col("n_r")).alias("n_b"),
    ).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the end of the chain of ``form``s. A form is twice as frequent as its word
    at least, so a chain has fewer than 64 links and six doublings reach its end."""
    now = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(6):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return now


def group_variants(docs: DataFrame, min_count: int = MIN_COUNT, factor: int = FACTOR, odd: int = ODD) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word with ``min_count``
    occurrences: the form is the most frequent near word if it is ``factor`` times as frequent."""
    vocabulary = staged(word_counts(docs, odd).where(F.col("n") >= min_count), "spelling-words")
    pairs = near_pairs(vocabulary)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("own_n"), F.col("b").alias("other"), F.col("n_b").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("own_n"), F.col("a").alias("other"), F.col("n_a").alias("other_n")),
    )).alias("x")).select("x.*")
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.first("own_n").alias("own_n"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("top"))
    likely = -F.col("top.minus") >= factor * F.col("own_n")
    near = staged(near.select(
        "word", "n_near", F.when(likely, F.col("top.other")).alias("form"), F.when(likely, -F.col("top.minus")).alias("form_n")), "spelling-near")
    ends = roots(near.where("form IS NOT NULL"))
    return vocabulary.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
