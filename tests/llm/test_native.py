"""Decontamination and mixing."""

import collections

import pytest
from pyspark.sql import functions as F

from basketlens.llm import decontaminate, mixing
from tests.llm import brute
from tests.llm.conftest import prose

ITEM = (
    "A train leaves the old station with Anna on board at 80 km an hour, and 3 hours later it has passed "
    "two bridges, a long tunnel and the house where Anna lived. How far did the train go in 3 hours?"
)


@pytest.fixture
def items(spark):
    rows = [(1, ITEM), (2, prose("item", 40)), (3, "too short"), (4, None), (None, ITEM), (1, ITEM)]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_leaks_are_found_and_others_left(docs, items, odd):
    other = ITEM.replace("Anna", "Berta").replace("80", "95").replace("3", "7")
    mixed = other.replace("7 hours?", "9 hours?")  # a slot with two values
    item2 = prose("item", 40)
    rows = [
        *odd, (11, f"{prose(11)} {ITEM} {prose(12)}"), (12, ITEM.upper()), (13, f"{prose(13)}. {other} {prose(14)}"),
        (14, mixed), (15, " ".join(item2.split()[:30])), (16, " ".join(item2.split()[:12])), (17, item2.replace(" ", ",\n")),
    ]
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs(rows), items).collect()}
    assert {(11, 1), (13, 1), (15, 2), (17, 2)} <= set(found)
    assert {k for k, _ in found} <= {11, 12, 13, 15, 17}
    assert found[13, 1]["reparameterised"] and not found[11, 1]["reparameterised"]
    assert found[11, 1]["coverage"] == 1.0
    left = {r["doc_id"] for r in decontaminate.remove_contaminated(docs(rows), items).collect()}
    assert not left & {11, 13, 15, 17} and {14, 16, 1, 2, 3, 4, None} <= left


QUESTION = "Tom has 12 apples and buys 5 more. Tom gives 3 to Mary. How many apples does Tom have left?"
STARTS = "Tom has 12 red apples in the kitchen and buys 5 more. Tom gives 3 of them to the neighbour. How many are left?"
NAMED = (
    "On Monday Anna, Bert, Carla and David met Emil in Rome, while on Friday Fritz, Gerda and Hans wrote to "
    "Ida from Paris about the long trip"
)


def test_leaks_by_names_at_any_place_and_in_any_case(spark, docs):
    items = spark.createDataFrame([(1, QUESTION), (2, STARTS), (3, NAMED)], "item_id long, text string")
    again = {
        (10, 1): QUESTION.replace("Tom", "Anna"), (11, 1): f"so {QUESTION.replace('Tom', 'Anna')}", (12, 2): STARTS.replace("Tom", "Anna").replace("12", "14"),
        (13, 3): NAMED.lower(), (14, 3): NAMED.upper(), (15, 3): NAMED.replace(" ", "  "), (16, 3): NAMED.replace(" ", "\n"),
        (17, 3): NAMED.replace(" ", "\u00a0"), (18, 1): QUESTION.lower(), (19, 1): QUESTION.replace("Tom", "Anna").replace(" ", "\r\n"),
    }
    mixed = STARTS.replace("Tom has", "Anna has").replace("Tom gives", "Berta gives")
    rows = [(i, text) for (i, _), text in again.items()] + [(30, mixed), (31, "Tom has a dog. How many apples does Tom have left?")]
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs(rows), items).collect()}
    assert set(found) - {(30, 2)} == set(again) and (30, 2) not in found
    assert {k[0] for k, r in found.items() if r["reparameterised"]} == {10, 11, 12, 19}
    assert all(found[k]["coverage"] == 1.0 for k in ((10, 1), (12, 2), (13, 3), (14, 3), (15, 3), (16, 3), (17, 3), (18, 1)))


def test_blocks_of_the_benchmark_give_the_same(docs, items, monkeypatch):
    rows = docs([(1, ITEM), (2, prose("item", 40)), (3, prose(3))])
    want = sorted(map(tuple, decontaminate.contaminated(rows, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 10)
    assert sorted(map(tuple, decontaminate.contaminated(rows, items).collect())) == want and len(want) == 2


def test_no_benchmark_and_no_documents(docs, items):
    assert decontaminate.contaminated(docs([(1, ITEM)]), items.where("false")).count() == 0
    assert decontaminate.contaminated(docs([]), items).count() == 0


def level(sizes):
    """Targets by repeated capping, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: 3 * sizes[s] for s in over})


def test_mix_meets_its_targets(docs, odd):
    rows = [(i, prose(i, 5 + i % 40), "en", f"s{i % 7 if i % 3 else 0}", 0) for i in range(100, 900)]
    rows += [(i, prose(i, 10), "en", "tiny", 0) for i in range(1000, 1003)] + odd
    found = mixing.pareto_mix(docs(rows)).collect()
    assert len(found) == len(rows)
    sizes, taken, target, largest = (collections.Counter() for _ in range(4))
    text = collections.Counter((r[0], len(brute.WORD.findall(r[1] or ""))) for r in rows)
    assert text == collections.Counter((r["doc_id"], r["size"]) for r in found)
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    want = level(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and all(r["source_size"] == sizes[s] for r in found if r["source"] == s)
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    again = mixing.pareto_mix(docs(rows)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_pareto_prefers_larger_odds(docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    rows = [(i, "w", "en", "a" if i % 4 else "b", 0) for i in range(4_000)]
    found = mixing.pareto_mix(docs(rows), (1.0, 9.0), propensity=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    a = [r for r in found.collect() if r["source"] == "a"]
    even, uneven = ([r["copies"] for r in a if r["doc_id"] % 2 == k] for k in (0, 1))
    assert sum(even) / len(even) > 2 * sum(uneven) / len(uneven)
    assert abs(sum(r["taken"] for r in a) - a[0]["target"]) <= 1


def test_mix_of_nothing(docs):
    assert mixing.pareto_mix(docs([])).count() == 0
    assert [r["taken"] for r in mixing.pareto_mix(docs([(1, None), (2, " ")])).collect()] == [0, 0]


SHORT = [(1, "What is 12 + 7?"), (2, "Who wrote the long poem Beowulf?"), (3, "1 2 3 4 5 6 7 8 9 10 11 12"), (4, "Yes"), (5, "Say no")]


def test_items_without_a_window_are_found_verbatim(spark, docs):
    items = spark.createDataFrame(SHORT, "item_id long, text string")
    rows = [(1, f"{prose(1)} what is 12 + 7? {prose(2)}"), (2, "Q: WHO wrote the\nlong poem Beowulf"), (3, "So 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12."),
            (4, "What is 12 + 8?"), (5, "yes!"), (6, f"yes {prose(3)}"), (7, "Who wrote the long poem"), (8, "say no"), (9, None), (10, "")]
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(rows), items).collect()}
    assert found == {(1, 1), (2, 2), (3, 3), (5, 4), (8, 5)}
    left = {r["doc_id"] for r in decontaminate.remove_contaminated(docs(rows), items).collect()}
    assert left == {4, 6, 7, 9, 10}


def test_an_unbroken_stretch_is_enough(spark, docs):
    text = prose("stretch", 60)
    w, items = text.split(), spark.createDataFrame([(1, text)], "item_id long, text string")
    rows = [(1, f"{prose(1)} {' '.join(w[20:45])} {prose(2)}"), (2, " ".join(w[5:18])), (3, " ".join(w[5:17])),
            (4, f"{' '.join(w[:10])} {prose(4)} {' '.join(w[30:40])}")]
    assert {r["doc_id"] for r in decontaminate.contaminated(docs(rows), items).collect()} == {1, 2}


def test_texts_of_one_id_are_judged_apart(spark, docs):
    text = prose("apart", 40)
    w, items = text.split(), spark.createDataFrame([(1, text)], "item_id long, text string")
    half = [(1, " ".join(w[k:k + 10]) + f" {prose(k)} " + " ".join(w[k + 10:k + 20])) for k in (0, 20)]
    rows = [*half, (2, text), (2, prose("clean"))]
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(rows), items).collect()] == [(2, 1)]
    left = decontaminate.remove_contaminated(docs(rows), items).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == sorted([*half, (2, prose("clean"))])


def test_marks_in_texts_are_white_space(spark, docs):
    text = prose("marks", 30)
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    rows = [(1, text.replace(" ", " \ue001", 5)), (2, "\ue004\ue003 \ue005")]
    assert {r["doc_id"] for r in decontaminate.contaminated(docs(rows), items).collect()} == {1}
