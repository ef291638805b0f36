"""Line deduplication by a suffix array over line-ID sequences.

Each document is the sequence of its lines that hold a word. The suffixes of all sequences are put in order
by prefix doubling, three doublings to a step: the rank of a suffix by its first line, then by eight, by 64,
each step ranking the eight ranks of the step before that lie side by side. A document ends with a mark of
its own, below all lines; marks follow the ids. Ranks are places in the order of all keys, from running
totals over ordered ranges, so no task sorts everything. A suffix that nothing shares its lines with is at its
place and leaves the sorting; steps go on until none is left.

Two neighbours in that order are told apart by one step. The ranks they share there, times the lines a rank
stands for, and what the steps before find behind them, are their longest common prefix (LCP), exactly.
Stretches of the array with an LCP of ``min_lines`` and more are the LCP intervals of the repeated runs; runs
that overlap or touch make up the maximal ones. A single line is a run as well if it has ``min_words`` words;
those are the intervals of one line. The first occurrence of a run, by (doc_id, line), stays; the lines of
all later ones are deleted.

Defined results: lines without a word are no part of a sequence and stay; a null or empty text has
no lines and is returned as it is; rows with a null id take no part and keep their text; repeated
rows of an id are one document; other columns pass through, ``n_chars`` follows the new text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.sources.writers import staged

MIN_LINES = 2
MIN_WORDS = 10
HAS_WORD = r"[^\x20\x09-\x0D]"
BLANKS = " \t\n\v\f\r"
FAN = 8  # ranks side by side that make up a key of the next step
KEYS = [f"k{i}" for i in range(FAN)]


def words_pattern(n: int) -> str:
    """Matches a line of ``n`` words and more; it reads no further and never goes back."""
    return rf"^[\x20\x09-\x0D]*+(?:{HAS_WORD}++[\x20\x09-\x0D]++){{{max(n, 1) - 1}}}{HAS_WORD}"


def sequences(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``seq`` (place among the lines with words), ``size`` (their number), ``line`` (its number),
    ``id``, ``alone``: whether it has ``min_words`` words."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("text")))
    full = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long"), F.filter(lines, lambda x: F.ltrim(x["text"], F.lit(BLANKS)) != "").alias("full"))
    rows = full.select("doc_id", F.size("full").alias("size"), F.posexplode_outer("full").alias("seq", "l")).where("seq IS NOT NULL")
    return rows.select("doc_id", "seq", "size", F.col("l.line").alias("line"), F.unhex(F.md5("l.text")).alias("id"),
                       F.col("l.text").rlike(words_pattern(min_words)).alias("alone"))


def ordered(groups: DataFrame, keys: list[str], *carried: str) -> DataFrame:
    """``groups``, a row for each value of ``keys``, with ``before``: the sum of ``n`` of those with smaller
    keys, and ``prior``: ``carried`` and the keys of the group before, null if nothing is carried."""
    row = F.struct(*keys, *carried) if carried else F.lit(None).cast("int")
    ranges = staged(groups.repartitionByRange(*keys).withColumn("range", F.spark_partition_id()), "line-ranges")
    edges = ranges.groupBy("range").agg(F.sum("n").alias("total"), F.max(row).alias("end_row"))  # a row for each partition
    by_range = W.orderBy("range")
    edges = edges.select(
        "range", F.coalesce(F.sum("total").over(by_range.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.lag("end_row").over(by_range).alias("edge"))
    inside = W.partitionBy("range").orderBy(*keys)
    here = F.coalesce(F.sum("n").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    places = ranges.withColumns({"here": here, "prior": F.lag(row).over(inside)}).join(edges, "range")
    return places.select(*groups.columns, (F.col("here") + F.col("offset")).alias("before"), F.coalesce("prior", "edge").alias("prior"))


def line_ranks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranks by the first line. Suffixes that share it (``rank``, ``size``, ``line``, ``alone``), and the places
    of those that do not; repeated rows of an id leave gaps between the ranks."""
    ends = [f(c).alias(f"{name}_{c}") for c in ("doc_id", "seq") for name, f in (("low", F.min), ("high", F.max))]
    counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *ends)
    one = (F.col("low_doc_id") == F.col("high_doc_id")) & (F.col("low_seq") == F.col("high_seq"))
    places = staged(ordered(counts, ["id"]).withColumn("one", one).drop("prior"), "line-places")
    tied = rows.join(places.where("NOT one").select("id", F.col("before").alias("rank")), "id").groupBy("doc_id", "seq").agg(
        *[f(c).alias(c) for c, f in (("rank", F.min), ("size", F.max), ("line", F.min), ("alone", F.max))])
    single = places.where("one").select(F.col("low_doc_id").alias("doc_id"), F.col("low_seq").alias("seq"), F.col("before").alias("place"))
    return staged(tied, "line-tied"), single


def closed() -> dict[str, Column]:
    return {"size": F.lit(None).cast("int"), "open": F.lit(False)}


def shared_ranks(left: list[Column], right: list[Column]) -> Column:
    """How many ranks, from the first on, are equal and not null."""
    n = F.lit(0)
    for a, b in reversed(list(zip(left, right, strict=True))):
        n = F.when(a == b, n + 1).otherwise(0)
    return n


def keys_ahead(now: DataFrame, h: int) -> DataFrame:
    """Suffixes that are ``open``, with their rank and those of the suffixes ``h``, 2 ``h``, … lines on.

    A rank is missing after the end, which is what ``end`` tells apart, or after one that nobody shares."""
    ahead = W.partitionBy("doc_id").orderBy("seq")
    ranks = {k: F.first("rank").over(ahead.rangeBetween(i * h, i * h)) for i, k in enumerate(KEYS) if i}
    rows = now.withColumns({"k0": F.col("rank"), **ranks}).where("open")
    over = F.col("seq") + (FAN - 1) * h >= F.col("size")
    return rows.select("doc_id", "seq", "size", *KEYS, F.when(over, F.struct("doc_id", "seq")).alias("end"))


def lengths(cuts: DataFrame, levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """``place`` and ``lcp``: adds what the steps before the last one, ``levels``, find behind the shared ranks."""
    for h, keyed in reversed(levels):
        for side in "ab":
            ranks = [F.col(k).alias(f"{side}_{k}") for k in KEYS]
            cuts = cuts.join(keyed.select(F.col("doc_id").alias(f"{side}_doc"), F.col("seq").alias(f"{side}_seq"), *ranks),
                             [f"{side}_doc", f"{side}_seq"], "left")
        more = shared_ranks(*([F.col(f"{side}_{k}") for k in KEYS] for side in "ab")) * h
        cuts = cuts.select("place", "a_doc", "b_doc", *[(F.col(c) + more).alias(c) for c in ("lcp", "a_seq", "b_seq")])
    return cuts.select("place", "lcp")


def suffix_array(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``seq``, ``place`` and ``lcp`` (with the suffix before) of all suffixes of ``sequences``: first those
    that share a line, with its number ``line`` and ``alone``, then the others."""
    tied, single = line_ranks(rows)
    after = tied.select("doc_id", (F.col("seq") + 1).alias("seq"))  # ranks behind a line that nobody shares are not asked for
    edge = single.join(after, ["doc_id", "seq"], "left_semi").withColumnRenamed("place", "rank")
    state = ["doc_id", "seq", "rank", "size", "open"]
    now = tied.withColumn("open", F.lit(True)).select(*state).unionByName(edge.withColumns(closed()))
    now, h, levels, found = staged(now, "line-ranks"), 1, [], []
    while not now.where("open").isEmpty():
        keyed = staged(keys_ahead(now, h), "line-keys")
        # one suffix stands for its group; sums of plain numbers need no sort
        groups = keyed.groupBy(*KEYS, "end").agg(
            F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low_doc"), F.min_by("seq", "doc_id").alias("low_seq"))
        order = staged(ordered(groups, [*KEYS, "end"], "low_doc", "low_seq"), "line-order")
        # a group of the step before keeps its places and shares them out
        first = order.groupBy("k0").agg(F.min("before").alias("start"))
        places = staged(order.join(first, "k0").withColumn("rank", F.col("k0") + F.col("before") - F.col("start")), "line-places")
        same = shared_ranks([F.col(k) for k in KEYS], [F.col(f"prior.{k}") for k in KEYS]) * h
        sides = {"a": "low", "b": "prior.low"}  # of the group and of the one before
        cuts = places.where("k0 = prior.k0").select(
            F.col("rank").alias("place"), same.alias("lcp"), *[F.col(f"{c}_doc").alias(f"{s}_doc") for s, c in sides.items()],
            *[(F.col(f"{c}_seq") + same).alias(f"{s}_seq") for s, c in sides.items()])
        found.append(staged(lengths(cuts, levels), "line-lcp"))
        levels.append((h, keyed))
        several = places.where("n > 1").select(*KEYS, "rank")
        still = keyed.where("end IS NULL").join(several, KEYS).withColumn("open", F.lit(True))
        settled = places.where("n = 1").select(F.col("low_doc").alias("doc_id"), F.col("low_seq").alias("seq"), "rank").withColumns(closed())
        now = still.select(*state).unionByName(settled).unionByName(now.where("NOT open"))
        now, h = staged(now, "line-ranks"), h * FAN
    lcp = F.coalesce("lcp", F.lit(0)).alias("lcp")
    shared = tied.drop("rank", "size").join(now.select("doc_id", "seq", F.col("rank").alias("place")), ["doc_id", "seq"])
    if found:
        shared = shared.join(reduce(DataFrame.unionByName, found), "place", "left").select(*shared.columns, lcp)
    else:
        shared = shared.withColumn("lcp", F.lit(0))
    return shared, single.withColumn("lcp", F.lit(0))


def intervals(array: DataFrame, *depths: int) -> DataFrame:
    """``array`` with ``next_lcp``, that of the suffix after, and ``rank_<depth>``: the first place of the LCP interval
    of that depth a suffix lies in; it lies in one if either prefix has that length."""
    ranges = staged(array.repartitionByRange("place").withColumn("range", F.spark_partition_id()), "line-array")
    begins = {f"rank_{d}": F.when(F.col("lcp") < d, F.col("place")) for d in depths}
    edges = ranges.groupBy("range").agg(  # a row for each partition
        F.min_by("lcp", "place").alias("first_lcp"), *[F.max(b).alias(c) for c, b in begins.items()])
    by_range = W.orderBy("range")
    before = by_range.rowsBetween(W.unboundedPreceding, -1)
    edges = edges.select("range", F.lead("first_lcp").over(by_range).alias("edge_lcp"), *[F.max(c).over(before).alias(f"edge_{c}") for c in begins])
    inside = W.partitionBy("range").orderBy("place")
    here = inside.rowsBetween(W.unboundedPreceding, 0)
    places = ranges.withColumns({c: F.max(b).over(here) for c, b in begins.items()}).withColumn("next_lcp", F.lead("lcp").over(inside)).join(edges, "range")
    return places.select(*array.columns, F.coalesce("next_lcp", "edge_lcp", F.lit(0)).alias("next_lcp"),
                         *[F.coalesce(c, f"edge_{c}").alias(c) for c in begins])


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``seq``, ``lines`` (numbers of the run's lines), ``depth`` (their count) and ``rank`` of every
    suffix that shares its first ``min_lines`` lines, or one of ``min_words`` words, with another."""
    shared, _ = suffix_array(staged(sequences(docs, min_words), "line-ids"))
    found = staged(intervals(shared, *sorted({1, min_lines})), "line-intervals")
    lines = F.collect_list("line").over(W.partitionBy("doc_id").orderBy("seq").rangeBetween(0, min_lines - 1))
    runs = found.withColumn("lines", lines).withColumn("depth", F.lit(min_lines)).withColumnRenamed(f"rank_{min_lines}", "rank")
    if min_lines > 1:
        alone = found.where("alone").withColumn("lines", F.array("line")).withColumn("depth", F.lit(1)).withColumnRenamed("rank_1", "rank")
        runs = runs.drop("rank_1").unionByName(alone.drop(f"rank_{min_lines}"))
    return staged(runs.where("greatest(lcp, next_lcp) >= depth").select("doc_id", "seq", "lines", "depth", "rank"), "line-runs")


def deleted_lines(runs: DataFrame) -> DataFrame:
    """``doc_id`` and ``gone``, the sorted numbers of the lines of later occurrences."""
    place = F.struct("doc_id", "seq")
    first = staged(runs.groupBy("depth", "rank").agg(F.min(place).alias("first")), "line-first")
    later = runs.join(first, ["depth", "rank"]).where(place > F.col("first"))
    lines = later.select("doc_id", F.explode("lines").alias("line")).distinct()
    return lines.groupBy("doc_id").agg(F.sort_array(F.collect_list("line")).alias("gone"))


OUTPUTS = ("n_lines", "n_removed")


def remove_repeated_lines(
    docs: DataFrame, min_lines: int = MIN_LINES, outputs: tuple[str, str] = OUTPUTS, min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with the shortened ``text``, and ``n_lines`` and ``n_removed`` beside it."""
    gone = staged(deleted_lines(repeated_runs(docs, min_lines, min_words)), "line-gone").select(
        F.col("doc_id").alias("__gone_from"), F.col("gone").alias("__gone_lines"))
    docs = docs.drop(*outputs)
    # a hash join at every size: the plan shall not change with the number of repeated lines, and no text is sorted
    joined = docs.join(gone.hint("shuffle_hash"), docs["doc_id"].cast("long") == gone["__gone_from"], "left")
    # only texts that lose lines are split, once: what a lambda refers to is worked out each time it is called
    cut = F.col("__gone_lines").isNotNull()
    joined = joined.withColumn("__lines", F.when(cut, F.split("text", "\n", -1)))
    # deleted lines cut the text into stretches that stay: (end of the last cut, next cut)
    cuts = F.concat(F.array(F.lit(-1)), "__gone_lines", F.array(F.size("__lines")))
    joined = joined.withColumn("__cuts", F.when(cut, cuts))
    at = lambda i: F.element_at("__cuts", i)
    stretch = F.transform(
        F.sequence(F.lit(1), F.size("__cuts") - 1), lambda i: F.slice("__lines", at(i) + 2, at(i + 1) - at(i) - 1))
    breaks = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    fresh = {
        "text": F.when(cut, F.array_join(F.flatten(stretch), "\n")).otherwise(F.col("text")),
        outputs[0]: F.when(F.col("text").isNull(), 0).otherwise(breaks + 1),
        outputs[1]: F.coalesce(F.size("__gone_lines"), F.lit(0)),
    }
    out = joined.withColumns(fresh).drop("__gone_from", "__gone_lines", "__lines", "__cuts")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def shorten_documents(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with shortened texts, without the documents of which no word is left."""
    own = tuple(f"__{name}" for name in OUTPUTS)
    cut = remove_repeated_lines(docs, min_lines, own)
    left = (F.col(own[1]) == 0) | F.col("text").rlike(HAS_WORD)
    return cut.where(left).select(*docs.columns)


CHECK_SQL = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(range(len(a))) AS i, unnest(a) AS x FROM split),
nb AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS s
       FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, s, i, x, lead(i) OVER d AS i2, lead(x) OVER d AS x2
      FROM nb WINDOW d AS (PARTITION BY doc_id ORDER BY s)),
f AS (SELECT *, row_number() OVER (PARTITION BY x, x2 ORDER BY doc_id, s) AS n FROM w WHERE x2 IS NOT NULL),
g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS n FROM nb
      WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 10),
gone AS (SELECT doc_id, unnest([i, i2]) AS i FROM f WHERE n > 1 UNION SELECT doc_id, i FROM g WHERE n > 1),
kept AS (SELECT l.doc_id, string_agg(l.x, chr(10) ORDER BY l.i) AS t, count(*) AS n
         FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i WHERE g.i IS NULL GROUP BY l.doc_id)
SELECT s.doc_id, CAST(coalesce(len(s.a), 0) AS INT) AS n_lines,
       CAST(coalesce(len(s.a), 0) - coalesce(k.n, 0) AS INT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id
"""
