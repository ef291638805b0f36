"""Near duplicates, substrings, lines and top-k against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import graph, lines, neardup, substring, topk, words
from basketlens.llm.queries import QUERIES
from basketlens.sources.writers import staged
from tests.llm import brute
from tests.llm.conftest import prose


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(prose(r.random(), 1) if r.random() < share else w for w in text.split(" "))


def corpus():
    base, passage = prose("base", 150), prose("passage", 60)
    rows = [(0, base), (1, base), (2, base.upper())]
    rows += [(10 + i, edited(base, i, 0.02 + 0.01 * (i % 8))) for i in range(90)]  # around 0.8
    rows += [(200 + i, f"{prose(i, 30)} {passage} {prose(-i - 1, 30)}") for i in range(80)]  # one passage
    rows += [(400 + i, " ".join(prose("short", 12).split()[: 2 + i % 10])) for i in range(20)]
    rows += [(500 + i, prose(f"u{i}", 40)) for i in range(20)]
    return rows


def near(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_words_are_bytes_between_white_space():
    import pyarrow as pa

    texts = ["a b", None, "", " \n", "x" * 200 + " y", "é\x0bü\xa0z", prose(1)]
    for row, data, starts, ends, h in words.word_rows(pa.array(texts)):
        got = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
        assert got == brute.WORD.findall(texts[row] or "")
        assert len(set(h.tolist())) == len(set(got))


def test_near_duplicates_match_brute_force(docs, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL_LIST", 2)  # every longer list takes the exact way
    rows = corpus()
    assert near(neardup.near_duplicates(docs(rows))) == brute.near(rows)


def test_texts_with_different_leaders_meet_over_their_rare_values(docs, monkeypatch):
    """Families with a common half: members of one meet those of the others in few lists, and none is missed."""
    monkeypatch.setattr(neardup, "SMALL_LIST", 2)
    half = prose("half", 90)
    bases = [f"{half} {edited(prose('other', 60), f, 0.1 + 0.05 * f)}" for f in range(3)]
    rows = [(100 * f + i, edited(base, (f, i).__hash__(), 0.02 + 0.01 * (i % 6))) for f, base in enumerate(bases) for i in range(40)]
    kept, listed = neardup.staged, {}
    monkeypatch.setattr(neardup, "staged", lambda df, label: listed.setdefault(label, kept(df, label)) if label == "near-full" else kept(df, label))
    want = brute.near(rows)
    assert near(neardup.near_duplicates(docs(rows))) == want and 3 < len({c for _, c in want.values()}) < 120
    per_text = {r["rep"]: r["count"] for r in listed["near-full"].groupBy("rep").count().collect()}
    assert per_text and all(k <= 0.2 * want[i][0] + 1 for i, k in per_text.items())


def test_near_duplicates_of_odd_rows(docs, odd):
    found = neardup.near_duplicates(docs(odd)).collect()
    assert len(found) == len(odd)
    by = {r["doc_id"]: r for r in found}
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert all(by[i]["component_id"] == i and by[i]["n_shingles"] == 0 for i in (1, 2, 3))
    assert sorted(r["doc_id"] for r in neardup.deduplicate(docs([(1, "a b"), (2, "a b"), (3, None)])).collect()) == [1, 3]


def test_near_duplicates_of_nothing(docs):
    assert neardup.near_duplicates(docs([])).count() == 0


def test_runs_that_sets_at_the_threshold_share():
    """Odds that two sketches at 0.8 have no common run: runs of four in 96 draws."""
    odds = np.zeros(neardup.RUN)
    odds[0] = 1
    for _ in range(neardup.SKETCH):
        odds = np.r_[0.2 * odds.sum(), 0.8 * odds[:-1]]
    assert odds.sum() < 1e-9


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


@pytest.mark.parametrize("bucket", [1 << 20, 1])
def test_substrings_match_brute_force(docs, monkeypatch, bucket):
    monkeypatch.setattr(substring, "BUCKET_BYTES", bucket)
    passage = prose("p", 70)
    rows = [(i, f"{prose(i, 20)} {passage}  {prose(-i - 1, 40)}") for i in range(12)]
    rows += [(20, rows[3][1]), (21, rows[3][1].replace(" ", "\n")), (22, passage), (23, prose(23, 49)), (24, None), (25, ("w " * 200))]
    rows += [(26, "w " * 120)]
    found = substring.remove_repeats(docs(rows), window=50).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == brute.cut(rows)


def test_substrings_of_one_id_with_several_texts(docs):
    p, q, words_ = prose("P", 60), prose("Q", 60), lambda t: len(brute.WORD.findall(t))
    found = substring.remove_repeats(docs([(1, p), (2, p), (2, q), (2, q), (3, q)])).collect()
    sha = lambda t: __import__("hashlib").sha256(t.encode()).hexdigest()
    assert sorted((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in found) == sorted([
        (1, 0, sha(p)), (2, words_(p), sha("")), (2, 0, sha(q)), (2, 0, sha(q)), (3, words_(q), sha(""))])


def test_substring_query_matches_brute_force(spark):
    small = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op6_super_k_mer_substrings"](spark, small).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == brute.cut(rows)


def test_near_duplicate_query_matches_brute_force(spark):
    small = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert near(QUERIES["op9_bottom_k_near_duplicates"](spark, small)) == brute.near(rows)


def test_substrings_of_odd_rows(docs, odd):
    found = substring.remove_repeats(docs(odd)).collect()
    assert len(found) == len(odd) and all(r["n_removed"] == 0 for r in found if r["doc_id"] not in (8,))
    assert substring.remove_repeats(docs([])).count() == 0


@pytest.mark.parametrize("run", [1, 2, 5])
def test_lines_match_brute_force(docs, run):
    r = random.Random(run)
    rows = [(i, "\n".join(r.choice(["a", "b", "c", "", " ", "d e"]) for _ in range(r.randint(0, 30)))) for i in range(25)]
    long, nine = prose("long", 12), prose("nine", 9)
    rows += [(30, rows[3][1]), (31, None), (32, f"u\n{long}\nv\n{nine}\nw"), (33, f"{long}\nx\n{long}"), (34, f"y\n{nine}"), (35, long)]
    found = lines.remove_repeated_lines(docs(rows), run)
    assert {x["doc_id"]: (x["text"], x["n_removed"]) for x in found.collect()} == brute.cut_lines(rows, run)


def test_lines_of_odd_rows(docs, odd):
    cut = lines.remove_repeated_lines(docs([*odd, *[(40, "p\nq"), (41, "p\nq")]]))
    assert cut.count() == len(odd) + 2
    assert {r["doc_id"] for r in cut.where("n_removed > 0").collect()} == {41}
    left = lines.shorten_documents(docs([(1, "p\nq"), (2, "p\nq"), (3, "")]).withColumn("n_lines", F.lit(9)))
    assert sorted((r["doc_id"], r["n_lines"]) for r in left.collect()) == [(1, 9), (3, 9)]
    assert lines.remove_repeated_lines(docs([])).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


@pytest.mark.parametrize("shard_rows, block", [(20_000, 1_024), (70, 3)])
def test_top_k_matches_brute_force(spark, shard_rows, block):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(0, 0.2, 6).round(2).tolist()) for i in range(500)]
    rows += [(500 + i, rows[0][1]) for i in range(30)]  # ties
    rows += [(900, None), (950, [1.0, float("nan")] + [0.0] * 4), (901, [None] * 6), (902, [float("inf")] * 6), (None, [0.1] * 6), (904, [])]
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, shard_rows, block)
    whole = {i: np.floor(256 * np.array(v)) for i, v in rows if i is not None and i < 900}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_top_k_of_large_components(spark):
    r = np.random.default_rng(6)
    rows = [(i, r.normal(0, 2.0**k, 4).tolist()) for i, k in enumerate(r.integers(0, 20, 300).tolist())]
    rows += [(300, [50_000.0, 1.0, 1.0, 1.0]), (301, [50_000.0, 1.0, 1.0, 1.0 + 1 / 256]), (302, [1e9] * 4)]
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, 90, 2)
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if i < 302}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_top_k_of_few_and_none(spark):
    found = topk.top_k(vectors(spark, [(0, [1.0]), (1, [2.0])]), F.col("vec_id") % 50 == 0, 5)
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_tree_boxes_are_tight():
    r = np.random.default_rng(1)
    points = r.integers(-50, 50, (1_000, 4)).astype(float)
    tree = topk.Tree(np.arange(1_000), points, leaf=16)
    def under(node):
        below = tree.children[node]
        return tree.rows[node] if below is None else np.concatenate([under(n) for n in below])

    assert sorted(under(0)) == list(range(1_000))
    assert all(rows is None or len(rows) <= 16 for rows in tree.rows)
    for node, (low, high) in enumerate(zip(tree.low, tree.high, strict=True)):
        assert (tree.points[under(node)].min(0) == low).all() and (tree.points[under(node)].max(0) == high).all()


def test_search_opens_the_best_nodes_only(monkeypatch):
    r = np.random.default_rng(2)
    points = np.repeat(r.integers(-500, 500, (40, 4)) * 10, 50, 0).astype(float) + r.integers(0, 9, (2_000, 4))
    tree, seen = topk.Tree(np.arange(2_000), points, leaf=50), []
    score = topk.Tree._score
    monkeypatch.setattr(topk.Tree, "_score", lambda self, leaf, mine, *rest: (seen.extend([leaf] * len(mine)), score(self, leaf, mine, *rest)))
    ids, queries = np.arange(100), points[:100]
    found = dict(tree.search(ids, queries, 5, np.full(100, topk.NONE)))
    want = {q: sorted(((int(queries[q] @ points[i]), -i) for i in range(2_000) if i != q), reverse=True)[:5] for q in range(100)}
    assert {q: [(s, -i) for s, i in best] for q, best in found.items()} == want
    assert len(seen) < 100 * sum(rows is not None for rows in tree.rows) / 3


def test_cells_that_cannot_reach_the_kth_score_get_no_query(spark):
    r = np.random.default_rng(3)
    middle = r.normal(0, 1, (8, 6)) * 5
    rows = [(i, (middle[i % 8] + r.normal(0, 0.05, 6)).tolist()) for i in range(800)]
    kept, sent = topk.staged, {}
    topk.staged = lambda df, label: sent.setdefault(label, kept(df, label))
    try:
        found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5, 50, 4).collect()
    finally:
        topk.staged = kept
    whole = np.floor(256 * np.array([v for _, v in rows]))
    want = [(q, n, i, -s) for q in range(0, 800, 50) for n, (s, i) in enumerate(sorted((-int(whole[q] @ v), i) for i, v in enumerate(whole) if i != q)[:5], 1)]
    assert sorted(map(tuple, found)) == sorted(want)
    pairs = 16 * sent["top-cells"].select("cell").distinct().count()
    assert 0 < sent["top-sent"].count() < pairs / 2


def test_long_single_lines_are_runs(docs):
    line, short = prose("line", 10), prose("short", 9)
    rows = [(1, f"a\n{line}\nb\n{short}"), (2, f"c\n{line}\nd\n{short}"), (3, line), (4, f"{line} ")]
    found = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.remove_repeated_lines(docs(rows)).collect()}
    assert found == {1: (rows[0][1], 0), 2: (f"c\nd\n{short}", 1), 3: ("", 1), 4: (rows[3][1], 0)}
    assert found == brute.cut_lines(rows, 2)
    assert sorted(r["doc_id"] for r in lines.shorten_documents(docs(rows)).collect()) == [1, 2, 4]


def test_line_query_matches_brute_force(spark):
    import hashlib

    small = "/root/testdata/sf0.001"
    rows = [tuple(x) for x in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, hashlib.sha256((t or "").encode()).hexdigest()) for i, (t, n) in brute.cut_lines(rows, 2).items()}
    found = QUERIES["op10_suffix_array_lines"](spark, small).collect()
    assert {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in found} == want


def test_suffix_array_and_common_prefixes_are_whole(docs):
    r = random.Random(10)
    rows = [(i, "\n".join(r.choice("abc") for _ in range(r.randint(0, 40)))) for i in range(15)]
    long = "\n".join(r.choice("abcd") + str(r.randint(0, 9)) for _ in range(150))  # three steps
    rows += [(20, long), (21, f"z\n{long}"), (22, f"{long}\nq"), (23, rows[1][1]), (24, "a\n" * 70), (25, None), (26, "own\nlines")]
    rows += [(27, "\n".join("efghijklmnop"[:8])), (28, "\n".join("efghijklmnop")), (29, "\n".join("efghijklmnop"[:8]))]
    shared, others = lines.suffix_array(staged(lines.sequences(docs([*rows, rows[4]])), "lines"))
    found = sorted((x["place"], x["doc_id"], x["seq"], x["lcp"]) for x in shared.drop("line", "alone").unionByName(others).collect())
    assert len({x[0] for x in found}) == len(found)
    assert [x[1:] for x in found] == brute.suffixes(rows)
    assert max(x[3] for x in found) == 150


def test_only_texts_that_lose_lines_are_split_and_none_is_sorted(docs):
    rows = [(1, "p\nq\nr\ns"), (2, "x\np\nq\ny\n\nr\ns\n"), (3, "ä\n"), (4, "\n\n"), (5, ""), (6, None), (7, "p\nq")]
    cut = lines.remove_repeated_lines(docs(rows))
    found = {r["doc_id"]: (r["text"], r["n_removed"], r["n_lines"]) for r in cut.collect()}
    assert {i: x[:2] for i, x in found.items()} == brute.cut_lines(rows, 2)
    assert {i: x[2] for i, x in found.items()} == {i: 0 if t is None else len(t.split("\n")) for i, t in rows}
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1
    assert "SortMergeJoin" not in cut._jdf.queryExecution().executedPlan().toString()


def test_components_take_few_small_tables(spark, monkeypatch):
    written = []
    monkeypatch.setattr(graph, "staged", lambda df, label: written.append(staged(df, label)) or written[-1])
    edges = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(6)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {i: 0 for i in range(300)} | {i: 1000 for i in range(1000, 1007)}
    assert all(len(t.inputFiles()) == 1 for t in written[1:])  # the first has as many as the session shuffles into
    written.clear()
    stars = spark.createDataFrame([(0, 1), (0, 2), (5, 9)], "a long, b long")
    assert dict(graph.components(stars).collect()) == {0: 0, 1: 0, 2: 0, 5: 5, 9: 5}
    assert len(written) == 2
