"""Near duplicates by bottom-k sketches from one hash function.

A text's set is that of its distinct word shingles. Equal sets are one class, and one member of each,
the smallest id, goes on. Its sketch is the ``SKETCH`` smallest shingle hashes. Inverted lists are
kept for runs of ``RUN`` neighbouring values of a sketch: at a similarity of 0.8 two sketches lack a
common run with a probability below 1e-9, while texts that merely share a passage or a frequent
shingle seldom have one, so no list grows with a value's frequency. Small sets, where the sketch is
the whole set, use shorter runs, for which a common run is certain.

Within a list nothing is paired with everything. First all members are compared with the list's
leader, the member that shares most of its values with others; this joins large groups of copies to
one component in rows linear in their number. Lists that still hold several components do the same
with a leader among the rest. What then remains in different components is compared in full where the
list has at most ``SMALL_LIST`` members. The members of longer lists are listed anew. Those with the same leader meet over the values in
which they differ from it, those with different leaders over values of their full sets; texts of 0.8
share a known number of either, so each text may leave out one less than that, the most
frequent ones, and still meets its partners.
Compared means: the overlap of both sketches among the smallest values of their union estimates the
similarity and drops what is far below; the rest is verified on the full sets.

Defined results: null or empty texts and rows with a null id have an empty set, their own component
(null for a null id) and are kept; repeated rows of an id are one document and stay or go together;
other columns pass through in ``deduplicate`` and are ignored in ``near_duplicates``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.llm import words
from basketlens.llm.graph import components
from basketlens.sources.writers import staged

SKETCH = 96
RUN = 4
SMALL_LIST = 8
MAX_LONG = (1 << 63) - 1


def shingle_set(h: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle."""
    return np.unique(words.run_hashes(h, min(size, len(h))).view(np.int64)) if len(h) else h.view(np.int64)


def _id(column: pa.Array) -> pa.Array:
    return column.cast(pa.int64())


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``fp`` (of the set; null if empty), ``n`` (set size) and ``sketch``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, n, low = [], [], []
            for *_, h in words.word_rows(batch.column(1), lower=True):
                s = shingle_set(h, size)
                n.append(len(s))
                fp.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                low.append(s[:SKETCH])
            yield pa.RecordBatch.from_arrays(
                [_id(batch.column(0)), pa.array(fp, pa.binary()), pa.array(n, pa.int64()), pa.array(low, pa.list_(pa.int64()))],
                ["doc_id", "fp", "n", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        read, "doc_id long, fp binary, n long, sketch array<long>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``rep`` and ``items``, the whole set, of every row."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, held = batch.column(0), [], 0
            begin = 0
            for row, *_, h in words.word_rows(batch.column(1), lower=True):
                found.append(shingle_set(h, size))
                held += len(found[-1])
                if held > 1 << 20 or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(begin, len(found)), pa.array(found, pa.list_(pa.int64()))], ["rep", "items"])
                    begin, found, held = row + 1, [], 0

    return docs.select("rep", "text").mapInArrow(read, "rep long, items array<long>")


def _runs(sketch: Column, length: int) -> Column:
    last = F.size(sketch) - length
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(length), *[F.get(sketch, i + j) for j in range(length)]))


def run_keys(n: Column, sketch: Column) -> Column:
    """Keys of the inverted lists. At 0.8, sets of at most 15 values in their union share a run of 3
    if the union has 6 or more, and one of 2 below; larger ones whose sketch is whole one of 4."""
    none = F.array().cast("array<long>")
    return F.concat(
        F.when(n <= 5, _runs(sketch, 2)).otherwise(none),
        F.when((n >= 5) & (n <= 15), _runs(sketch, 3)).otherwise(none),
        F.when(n >= 13, _runs(sketch, RUN)).otherwise(none),
    )


def _compared(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are not far below ``percent``, with both sizes, the exact number ``c`` of
    common shingles and ``linked``."""
    ratio = percent / 100
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").where(F.size("sa") > 0).join(side("b"), "b")
    both = both.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    end = lambda x: F.when(F.size(f"s{x}") < SKETCH, F.lit(MAX_LONG)).otherwise(F.element_at(f"s{x}", -1))
    both = both.withColumn("end", F.least(end("a"), end("b"))).withColumn("common", F.size(F.array_intersect("sa", "sb")))
    below = lambda x: F.size(F.filter(f"s{x}", lambda v: v <= F.col("end")))
    union = below("a") + below("b") - F.col("common")
    # a sample of SKETCH values deviates by 0.04 at 0.8; one that misses by 0.25 has odds below 1e-9
    likely = staged(both.where(F.col("common") >= (ratio - 0.25) * union).select("a", "b", "na", "nb"), "near-likely")
    exact = likely.join(sets.select(F.col("rep").alias("a"), F.col("items").alias("ia")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("items").alias("ib")), "b")
    shared = F.size(F.array_intersect("ia", "ib"))
    linked = 100 * F.col("c") >= percent * (F.col("na") + F.col("nb") - F.col("c"))
    return staged(exact.withColumn("c", shared).select("a", "b", "na", "nb", "c", linked.alias("linked")), "near-compared")


def _leader_pairs(lists: DataFrame, labels: DataFrame, outside: bool) -> DataFrame:
    """Each member (a) of an unresolved list with the list's leader (b), if their components differ.

    ``outside``: the leader is taken among those that are not in the first leader's component.
    """
    rows = _labelled(lists, labels)
    best = F.max_by(F.struct("rep", "component"), F.struct("weight", -F.col("rep")))
    lead = staged(rows.groupBy("key").agg(best.alias("lead"), F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .where("lo <> hi").select("key", "lead"), "near-lead")
    open_ = rows.join(lead, "key")
    if outside:
        rest = open_.where(F.col("component") != F.col("lead.component"))
        second = staged(rest.groupBy("key").agg(best.alias("second")), "near-lead")
        open_ = open_.drop("lead").join(second.withColumnRenamed("second", "lead"), "key")
    apart = open_.where(F.col("component") != F.col("lead.component"))
    return apart.select(F.col("rep").alias("a"), F.col("lead.rep").alias("b")).distinct()


def _stars(labels: DataFrame) -> DataFrame:
    """Components as edges (a, b): new links join them without the links they were found by."""
    return labels.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.select(F.col("node").alias("rep"), "component")
    return lists.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def rare_values(sets: DataFrame, percent: int) -> DataFrame:
    """``rep``, ``n``, ``key``, ``place``: the least frequent values of each set, as many as cannot all be missing
    from a set linked to it, with their place in the set's order by frequency.

    A linked set holds at least ``percent`` of these values, so all but one of that many, the most
    frequent ones, can be left out.
    """
    rows = sets.select("rep", "n", F.explode_outer("items").alias("key")).where("key IS NOT NULL")
    shared = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-full-keys")
    of = W.partitionBy("rep")
    # values that no other set has come first in the order; they meet nothing and only count
    place = F.col("n") - F.count(F.lit(1)).over(of) + F.row_number().over(of.orderBy("size", "key"))
    spare = F.ceil(F.col("n") * percent / 100) - 1
    return rows.join(shared, "key").withColumn("place", place).where(F.col("place") <= F.col("n") - spare).select("rep", "n", "key", "place")


def _still_open(lists: DataFrame, labels: DataFrame, also: Column | None = None) -> DataFrame:
    """Rows of the lists that hold more than one component, and for which ``also`` holds, with their component."""
    rows = _labelled(lists, labels)
    many = F.min("component") != F.max("component")
    open_ = rows.groupBy("key").agg((many if also is None else many & also).alias("open")).where("open")
    rows = rows.join(staged(open_.select("key"), "near-open"), "key")
    return staged(rows.select(*lists.columns, "component"), "near-open")


def _met(rows: DataFrame, percent: int, *more: Column) -> DataFrame:
    """The pairs of list members in different components, of fitting sizes, for which ``more`` holds, once for
    each list; the columns of the second member end in ``_b``."""
    fits = (F.col("rep") < F.col("rep_b")) & (F.col("component") != F.col("component_b")) & (
        100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b"))
    for holds in more:
        fits &= holds
    other = rows.withColumnsRenamed({c: f"{c}_b" for c in rows.columns if c != "key"})
    return rows.join(other, "key").where(fits).select(F.col("rep").alias("a"), F.col("rep_b").alias("b"))


def _open_pairs(lists: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All pairs of list members in different components and of fitting sizes."""
    return _met(_still_open(lists.select("key", "rep", "n"), labels), percent)


def _rare_pairs(values: DataFrame, labels: DataFrame, percent: int, home: DataFrame) -> DataFrame:
    """Pairs with different leaders in different components that may reach ``percent``, over ``rare_values``.

    The first value that two sets share in their common order is followed by at most as many shared ones
    as there are values after it in either set. A linked pair passes this test there; most of the others
    share no value early enough, or few, so a pair is seldom met over more than a few lists.
    """
    leaders = (F.min("lead") != F.max("lead")) | F.bool_or(F.col("lead").isNull())
    rows = _still_open(values.join(home.select("rep", "lead"), "rep", "left"), labels, leaders)
    after = F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b"))
    enough = (100 + percent) * (after + 1) >= percent * (F.col("n") + F.col("n_b"))
    return _met(rows, percent, F.coalesce(F.col("lead") != F.col("lead_b"), F.lit(True)), enough)


def _diff_pairs(sized: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs with the same leader L in different components that may reach ``percent``, by what sets L apart.

    D(x) is the symmetric difference of x and L, d its size. x and m differ in d(x) + d(m) - 2 o values,
    o being the overlap of D(x) and D(m), and at 0.8 in at most (n(x) + n(m)) / 9. So for an x that is not
    linked to L, o is more than 4/9 d(m), and at least d(x) - n(x) / 4, as n(m) is at most 5/4 n(x). If
    neither is linked to L, d(m) is more than (n(m) + n(L)) / 9 too, which raises the bound. Each side
    lists its least frequent values of D, as many as cannot all miss such an overlap. Common values are
    listed by both, or left out by the side whose list ends first, so the values found in both lists and
    those a side leaves out must make up o. Two texts that are both linked to L are in one component.
    """
    lead = sets.select(F.col("rep").alias("lead"), F.col("items").alias("of"), F.size("items").alias("nl"))
    rows = sized.join(lead, "lead").withColumn(
        "diff", F.concat(F.array_except("items", "of"), F.array_except("of", "items")))
    least = F.when(F.col("ball"), F.floor(F.col("d") * 4 / 9) + 1).otherwise(F.greatest(F.ceil(F.col("d") - F.col("n") / 4), F.lit(1)))
    free = F.greatest(F.col("d") - F.col("n") / 4, (F.col("n") * 0.8 + F.col("nl")) / 9)
    outer = F.greatest(F.ceil((F.col("d") + free - F.col("n") / 4) / 2), F.lit(1))
    rows = rows.select("rep", "n", "lead", "d", "ball", (F.col("d") - least + 1).alias("first"),
                       (F.col("d") - outer + 1).alias("first_outer"), F.explode_outer("diff").alias("item"))
    rows = staged(rows.where("item IS NOT NULL"), "near-diff")
    shared = rows.groupBy("lead", "item").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    both = rows.join(staged(shared, "near-diff-keys"), ["lead", "item"])
    of = W.partitionBy("rep")
    place = F.col("d") - F.count(F.lit(1)).over(of) + F.row_number().over(of.orderBy("size", "item"))
    both = both.withColumn("place", place).where(F.col("place") <= F.col("first"))
    both = both.withColumn("rare", F.col("place") <= F.col("first_outer"))
    both = both.withColumn("out", F.col("d") - F.col("first")).withColumn("out_outer", F.col("d") - F.col("first_outer"))
    both = staged(_labelled(both.select("rep", "n", "lead", "d", "ball", "rare", "out", "out_outer", "item"), labels), "near-diff")
    other = both.select("lead", "item", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("d").alias("db"),
                        F.col("component").alias("cb"), F.col("ball").alias("bb"), F.col("rare").alias("rb"),
                        F.col("out").alias("ob"), F.col("out_outer").alias("oob"))
    fits = (
        (F.col("rep") < F.col("b")) & (F.col("component") != F.col("cb"))
        & (100 * F.least("n", "nb") >= percent * F.greatest("n", "nb"))
        & (9 * F.abs(F.col("d") - F.col("db")) <= F.col("n") + F.col("nb"))
        & (F.col("ball") | F.col("bb") | (F.col("rare") & F.col("rb")))
    )
    out = F.when(F.col("ball") | F.col("bb"), F.greatest("out", "ob")).otherwise(F.greatest("out_outer", "oob"))
    missing = 9 * (F.col("d") + F.col("db")) - (F.col("n") + F.col("nb")) - 18 * out  # 18 times what the lists must show
    met = both.join(other, ["lead", "item"]).where(fits).groupBy(F.col("rep").alias("a"), "b").agg(
        F.count(F.lit(1)).alias("found"), F.min(missing).alias("missing"))
    return met.where(18 * F.col("found") >= F.col("missing")).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 2, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Documents are linked if ``100 * |A & B| >= percent * |A | B|``; the component is the smallest id
    reachable over links.
    """
    if percent < 80:
        raise ValueError("the runs of the sketch are laid out for similarities of 0.8 and more")
    found = staged(sketches(docs, shingle), "near-sketch")
    usable = found.where("fp IS NOT NULL AND doc_id IS NOT NULL")
    classes = staged(usable.groupBy("fp").agg(F.min("doc_id").alias("rep")), "near-classes")
    reps = usable.join(classes.select(F.col("rep").alias("doc_id"), F.col("fp").alias("own")), "doc_id").where(
        "fp = own").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("rep"), "n", "sketch")
    reps = staged(reps, "near-reps")

    keyed = reps.select("rep", "n", F.explode_outer(run_keys(F.col("n"), F.col("sketch"))).alias("key")).where("key IS NOT NULL")
    shared = staged(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-keys")
    lists = staged(keyed.join(shared, "key"), "near-lists")
    weight = staged(lists.groupBy("rep").agg(F.sum("size").alias("weight")), "near-weight")
    lists = lists.join(weight, "rep")

    text = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(weight.select("rep"), "rep", "left_semi")
    sets = staged(full_sets(text, shingle).dropDuplicates(["rep"]), "near-sets")

    links = lambda x: x.where("linked").select("a", "b")
    first = _compared(_leader_pairs(lists, _no_labels(reps), False), reps, sets, percent)
    labels = components(links(first))
    second = _compared(_leader_pairs(lists, labels, True), reps, sets, percent)
    tested = first.union(second)
    labels = components(_stars(labels).union(links(second)))

    small = _open_pairs(lists.where(F.col("size") <= SMALL_LIST), labels, percent)
    long = staged(_still_open(lists.where(F.col("size") > SMALL_LIST), labels).select("rep").distinct(), "near-long")
    followers = tested.groupBy("b").agg(F.count_if("linked").alias("many"))
    toward = F.struct((F.col("na") + F.col("nb") - 2 * F.col("c")).alias("d"), "b", "linked")
    home = tested.join(followers, "b").groupBy("a").agg(F.max_by(toward, F.struct("many", "b")).alias("h"))
    home = home.select(F.col("a").alias("rep"), F.col("h.b").alias("lead"), F.col("h.d").alias("d"), F.col("h.linked").alias("ball"))
    home = staged(home, "near-home")
    sized = sets.join(long, "rep").withColumn("n", F.size("items")).join(home, "rep", "left")
    sized = staged(sized, "near-sized")
    apart = _rare_pairs(staged(rare_values(sized, percent), "near-full"), labels, percent, home)
    along = _diff_pairs(sized.where("lead IS NOT NULL"), sets, labels, percent)
    last = _compared(small.union(apart).union(along).distinct(), reps, sets, percent)
    labels = components(_stars(labels).union(links(last)))

    of = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component"))
    of = staged(of, "near-of")
    id_ = F.col("doc_id")
    whole = found.select("doc_id", "n", F.when(id_.isNotNull(), F.col("fp")).alias("fp")).join(of, "fp", "left")
    component = F.coalesce("component", "doc_id")
    return whole.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == id_, F.lit(True)).alias("kept"))


def _no_labels(reps: DataFrame) -> DataFrame:
    return reps.where("false").select(F.col("rep").alias("node"), F.col("rep").alias("component"))


def deduplicate(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` without those whose component has a smaller id."""
    gone = near_duplicates(docs, shingle, percent).where("NOT kept").select("doc_id").distinct()
    gone = staged(gone, "near-gone")
    return docs.join(gone.hint("merge"), docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")
