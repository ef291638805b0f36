"""Benchmark decontamination by templates, in DataFrame operations only.

A text becomes a template: numbers, names and units (after a number) turn into typed placeholders, other
words are lower-cased, marks and the kind of white space go. Case alone does not tell a name from the
first word of a sentence, and is often lost, so a text has three templates (``STREAMS``): with no names,
with capitalised words inside a sentence as names, and with all capitalised words as names. Every
``WINDOW`` consecutive template words are a window. The windows of the benchmark, those with at least
``MIN_LITERALS`` words that are no placeholders, are joined to the windows of all documents by hash,
of whichever template. A benchmark item is found in a document if for one of its templates the document
has at least ``MIN_COVERAGE`` of the windows, or ``MIN_STRETCH`` words of it in one unbroken stretch, and the
slots are consistent: over the whole match, at the same offset, each value of an item's slot goes with one
value of the document. So an item with other numbers or names is caught, and text that only shares its
shape with an item is not.

An item without such a window, short or made of slots, is found where all its words, numbers and names
included, follow one another in a document; an item of fewer than ``LEAD`` words where it is the whole text.

The benchmark's windows are broadcast, in blocks of ``BLOCK_WINDOWS``; a larger benchmark makes more
passes over the documents, not a larger broadcast.

Defined results: null or empty texts, null ids of documents and items, and items without a word match
nothing; documents are told apart by id and text, so that several texts of one id are judged each on its
own; repeated rows of a document or an item count once; the marks that templates use are taken as white
space in texts; other columns are ignored, and pass through in ``remove_contaminated``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.sources.writers import staged

WINDOW = 8
MIN_LITERALS = 4
MIN_COVERAGE = 0.5
MIN_STRETCH = 13
LEAD = 3  # words by which items without a window are looked up
BLOCK_WINDOWS = 1_000_000
NAME, JOINT, NUMBER, UNIT, FIRST = "\ue001", "\ue002", "\ue003", "\ue004", "\ue005"
MARKS = NAME + JOINT + NUMBER + UNIT + FIRST
STREAMS = LITERAL, INSIDE, CAPITAL = range(3)
#: Words that are units when they follow a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t oz lb lbs ml cl dl l gal ms s sec min h hr hrs hz khz mhz ghz "
    "b kb mb gb tb w kw mw kwh v a j kj cal kcal k c f pa kpa bar n nm mol percent degrees inch inches foot "
    "feet yard yards mile miles meter meters metre metres gram grams liter liters litre litres second "
    "seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent "
    "cents euro euros pound pounds kilometers kilometres kilograms usd eur gbp"
).split()


def tokens(text: Column) -> Column:
    """Words of the text, lower-cased; a capitalised word keeps a mark in front, ``NAME`` inside a sentence
    and ``FIRST`` elsewhere, a number its inner marks as one."""
    text = F.when(text.rlike(f"[{MARKS}]"), F.translate(text, MARKS, " " * len(MARKS))).otherwise(text)
    joined = F.regexp_replace(text, r"[.,:](?=[0-9])(?<=[0-9].)", JOINT)
    named = F.regexp_replace(joined, r"([\p{Ll},;][\s\p{Z}]+)(?=\p{Lu}\p{Ll})", f"$1{NAME}")
    marked = F.regexp_replace(named, rf"(?<![\p{{L}}\p{{M}}\p{{N}}{NAME}])(?=\p{{Lu}}\p{{Ll}})", FIRST)
    return F.array_remove(F.split(F.lower(marked), rf"[^\p{{L}}\p{{M}}\p{{N}}{NAME}{FIRST}{JOINT}]+", -1), "")


def _is_number(token: Column) -> Column:
    return (token >= "0") & (token < ":")


def _bare(token: Column, *marks: str) -> Column:
    """The token without a mark of ``marks`` in front."""
    return F.when(token.substr(1, 1).isin(*marks), token.substr(F.lit(2), F.length(token))).otherwise(token)


def template(words: Column, stream: int) -> Column:
    """Marked words with placeholders for the slots of the stream."""
    def place(x: Column) -> Column:
        placed = F.when(_is_number(x), NUMBER)
        if stream != LITERAL:
            placed = placed.when(x.startswith(NAME), NAME).when(x.startswith(UNIT), UNIT)
        if stream == CAPITAL:
            placed = placed.when(x.startswith(FIRST), NAME)
        return placed.otherwise(_bare(x, NAME, FIRST, UNIT))

    return F.transform(words, place)


def _tokenised(rows: DataFrame, key: str) -> DataFrame:
    """``mark`` of the text, ``words``, and ``marked``: the same with marks, also ``UNIT`` before a unit."""
    named = rows.where(F.col(key).isNotNull() & F.col("text").isNotNull())
    named = named.select(F.col(key).cast("long"), F.xxhash64("text").alias("mark"), tokens(F.col("text")).alias("words"))

    def unit(x: Column, i: Column) -> Column:
        follows = F.coalesce(_is_number(F.get("words", i - 1)), F.lit(False))
        return F.when(follows & _bare(x, FIRST).isin(*UNITS), F.concat(F.lit(UNIT), _bare(x, FIRST))).otherwise(x)

    marked = named.withColumn("marked", F.transform("words", unit))
    return marked.withColumn("words", F.transform("words", lambda x: _bare(x, NAME, FIRST)))


def _places(words: str) -> Column:
    """A row for each place where a window begins."""
    return F.explode(F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """``item_id``, ``item_at``, ``window``, ``item_slots``, ``streams``: windows that can identify an item."""
    rows = _tokenised(items.dropDuplicates(["item_id", "text"]), "item_id")
    rows = rows.select("item_id", "words", *(template(F.col("marked"), k).alias(f"placed_{k}") for k in STREAMS))
    rows = rows.select("*", _places("words").alias("item_at"))
    parts = F.array(*(
        F.struct(F.lit(k).alias("stream"), F.slice(f"placed_{k}", F.col("item_at") + 1, WINDOW).alias("part")) for k in STREAMS))
    rows = rows.select("item_id", "words", "item_at", F.inline(parts))
    literal = F.size(F.filter("part", lambda x: ~x.isin(NAME, NUMBER, UNIT)))
    slots = F.transform("part", lambda x, i: F.when(x.isin(NAME, NUMBER, UNIT), F.get("words", F.col("item_at") + i)))
    window = F.xxhash64(*(F.xxhash64(F.get("part", F.lit(j))) for j in range(WINDOW)))
    usable = rows.where(literal >= MIN_LITERALS).select(
        "item_id", "item_at", window.alias("window"), "stream", F.when(literal < WINDOW, slots).alias("item_slots")
    ).dropDuplicates(["item_id", "item_at", "stream"])
    # templates that are the same at a place meet a document once
    return usable.groupBy("item_id", "item_at", "window").agg(
        F.first("item_slots").alias("item_slots"), F.collect_set("stream").alias("streams"))


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows of documents that are windows of items, with the values of both in the slots.

    Only the words are hashed by array functions. Windows are hashed from them once a place is a row,
    in generated code, which does not copy the arrays from row to row.
    """
    rows = _tokenised(docs, "doc_id")
    rows = rows.select("doc_id", "mark", "words", *(
        F.transform(template(F.col("marked"), k), lambda x: F.xxhash64(x)).alias(f"h_{k}") for k in STREAMS))
    rows = rows.select("*", _places("words").alias("doc_at"))
    at_place = (F.xxhash64(*(F.get(f"h_{k}", F.col("doc_at") + j) for j in range(WINDOW))) for k in STREAMS)
    rows = rows.select("doc_id", "mark", "words", "doc_at", F.explode(F.array_distinct(F.array(*at_place))).alias("window"))
    n = windows.count()
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    part = F.pmod(F.xxhash64("item_id", "item_at"), F.lit(blocks))
    joined = [rows.join(F.broadcast(windows.where(part == b)), "window") for b in range(blocks)]
    values = F.when(F.col("item_slots").isNotNull(), F.slice("words", F.col("doc_at") + 1, WINDOW))
    return reduce(DataFrame.unionAll, [
        j.select("doc_id", "mark", "item_id", "item_at", "streams", (F.col("doc_at") - F.col("item_at")).alias("offset"), "item_slots", values.alias("doc_slots"))
        for j in joined])


def verbatim(docs: DataFrame, items: DataFrame, windows: DataFrame) -> DataFrame | None:
    """``doc_id``, ``mark``, ``item_id`` and ``n`` (words) of the items without a window that stand in a
    document word for word; None if every item has a window."""
    rows = _tokenised(items.dropDuplicates(["item_id", "text"]), "item_id").where(F.size("words") > 0)
    short = rows.join(windows.select("item_id").distinct(), "item_id", "left_anti")
    short = staged(short.select("item_id", F.col("words").alias("item_words")).distinct(), "bench-short")
    if short.isEmpty():
        return None
    texts = _tokenised(docs, "doc_id").select("doc_id", "mark", "words")
    lead = lambda c, at: F.xxhash64(*(F.get(c, at + j) for j in range(LEAD)))
    n = F.size("item_words")
    places = texts.select("*", F.explode(F.when(F.size("words") >= LEAD, F.sequence(F.lit(0), F.size("words") - LEAD))).alias("at"))
    places = places.withColumn("lead", lead("words", F.col("at")))
    longer = short.where(n >= LEAD).withColumn("lead", lead("item_words", F.lit(0)))
    inside = places.join(longer, "lead").where(F.slice("words", F.col("at") + 1, n) == F.col("item_words"))
    whole = texts.where(F.size("words") < LEAD).join(short, F.col("words") == F.col("item_words"))
    return inside.select("doc_id", "mark", "item_id", n.alias("n")).unionAll(
        whole.select("doc_id", "mark", "item_id", n.alias("n"))).distinct()


RESULT = ("matched", "item_windows", "coverage", "reparameterised")


def _leaks(docs: DataFrame, items: DataFrame, min_coverage: float) -> DataFrame:
    """``contaminated`` for every text of an id, with its ``mark``."""
    windows = staged(benchmark_windows(items), "bench-windows")
    sizes = windows.select("item_id", F.explode("streams").alias("stream")).groupBy("item_id", "stream").agg(
        F.count(F.lit(1)).alias("item_windows"))
    found = staged(hits(docs, windows), "bench-hits").withColumn("stream", F.explode("streams"))
    match = ["doc_id", "mark", "item_id", "stream", "offset"]

    pairs = found.where("item_slots IS NOT NULL").select(*match, F.explode(F.arrays_zip("item_slots", "doc_slots")).alias("s"))
    slots = pairs.where("s.item_slots IS NOT NULL").groupBy(*match, F.col("s.item_slots").alias("value")).agg(
        F.min("s.doc_slots").alias("lo"), F.max("s.doc_slots").alias("hi"))
    slots = slots.groupBy(*match).agg(
        F.bool_and(F.col("lo") == F.col("hi")).alias("consistent"),
        F.bool_or((F.col("lo") != F.col("value")) | (F.col("hi") != F.col("value"))).alias("changed"))
    one = found.select(*match, "item_at").distinct()
    judged = one.join(slots, match, "left").where(F.coalesce("consistent", F.lit(True)))
    # places in a row have one difference between the place and its number: an unbroken stretch
    number = F.row_number().over(W.partitionBy(*match).orderBy("item_at"))
    stretch = F.count(F.lit(1)).over(W.partitionBy(*match, "island")) + WINDOW - 1
    judged = judged.withColumn("island", F.col("item_at") - number).withColumn("stretch", stretch)
    whole = judged.groupBy("doc_id", "mark", "item_id", "stream").agg(
        F.count_distinct("item_at").alias("matched"), F.max("stretch").alias("stretch"),
        F.bool_or(F.coalesce("changed", F.lit(False))).alias("reparameterised"))
    whole = whole.join(sizes, ["item_id", "stream"])
    whole = whole.withColumn("coverage", F.col("matched") / F.col("item_windows"))
    enough = whole.where((F.col("coverage") >= min_coverage) | (F.col("stretch") >= MIN_STRETCH))
    leaks = enough.select("doc_id", "mark", "item_id", *RESULT)
    exact = verbatim(docs, items, windows)
    if exact is None:
        return leaks
    return leaks.unionByName(exact.select(
        "doc_id", "mark", "item_id", F.lit(1).cast("long").alias("matched"), F.lit(1).cast("long").alias("item_windows"),
        F.lit(1.0).alias("coverage"), F.lit(False).alias("reparameterised")))


def contaminated(docs: DataFrame, items: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id``, ``item_id``, ``matched``, ``item_windows``, ``coverage`` and ``reparameterised`` (some
    slot has another value) of every item found in a document, by the template with the best coverage.

    An item without a window counts as one window."""
    best = _leaks(docs, items, min_coverage).groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct(*RESULT), F.struct("coverage", ~F.col("reparameterised"), "matched")).alias("best"))
    return best.select("doc_id", "item_id", *(f"best.{name}" for name in RESULT))


def remove_contaminated(docs: DataFrame, items: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Rows of ``docs`` in which no item is found."""
    leaks = _leaks(docs, items, min_coverage).select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark"))
    gone = staged(leaks.distinct(), "bench-gone")
    same = (docs["doc_id"].cast("long") == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_mark"])
    return docs.join(gone.hint("merge"), same, "left_anti")
