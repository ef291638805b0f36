"""Exact top-k search: KD-trees per shard, searched best first, and shards left out by their boxes.

Vectors are dealt to cells by median splits, learned from a bounded sample, along the widest side; a cell
of more rows than a shard holds is dealt to several shards by a hash of the id. Every cell has a tight box
over all its rows. The bound of a box is the largest inner product that any of its points can have with the
query. A query visits one shard of the cell with the best bound first; the kth score found there goes along,
and a cell whose bound does not reach it is not visited: neither the query nor the cell's rows are sent for
it. Queries come in blocks, so that a shard meets a block at a time and scores are matrix products.

A shard builds a KD-tree by median splits along the widest side of its tight bounding box. Each query keeps
the bounds of the nodes it has reached and has not opened; it opens the best of them, and ends when that does
not reach its kth score so far.

Components are floor(256 * x) in exact integers; scores are exact: products are doubles where these hold
every sum, and longs in blocks whose components are larger.

Bounds: the sample has at most ``SAMPLE_ROWS`` rows and ``SAMPLE_NUMBERS`` components; there are at most
``CELLS`` cells, and one for each length of more vectors than a shard holds that the sample missed. Their
boxes are what each task gets. Splits decide only where a row goes; every row is searched or excluded by a box
that holds it.

Defined results: vectors that are null, empty, hold null or non-finite components, or whose product with
themselves could not fit into a long, take no part, nor do null ids; of repeated rows of an id every one is
a candidate of other queries, the smallest vector is the query; vectors of different lengths are compared
within their length only; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.sources.writers import staged

LEAF = 256
SHARD_ROWS = 20_000
BLOCK = 8_192
SEARCHED = 1_024  # queries that descend a tree together
CELLS = 512
SAMPLE_ROWS, SAMPLE_NUMBERS = 8_192, 4_000_000
EXACT = 2.0**53  # whole numbers that doubles hold
LIMIT = 2.0**63
NONE = -(2**63)  # no score to beat


def _halves(points: np.ndarray, rows: np.ndarray) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Widest side of the rows' box, and the rows below and above the median there; none if all are equal."""
    box = points[rows]
    spread = box.max(0) - box.min(0)
    side = int(spread.argmax())
    if spread[side] == 0:
        return None
    order = np.argpartition(box[:, side], len(rows) // 2)
    return side, rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]


def _largest(queries: np.ndarray, points: np.ndarray) -> float:
    """No product of a query and a point is larger, nor is any sum of its parts."""
    return float(np.abs(queries).max() * np.abs(points).max() * points.shape[-1])


def bounds_of(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and box at least the largest product of the query and a point of the box."""
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    largest = max(_largest(queries, low), _largest(queries, high))
    # above what rounding of the sums and of the score compared with took
    return bounds if largest < EXACT else bounds + largest * (queries.shape[1] + 2) * 2.0**-51


class Tree:
    """KD-tree over the rows of an integer matrix held as exact doubles. Node 0 is the root; ``low`` and ``high``
    are the nodes' boxes, ``children`` the two nodes below one or none, ``rows`` the points of a leaf."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        lows, highs = [], []

        def node(rows: np.ndarray) -> int:
            lows.append(self.points[rows].min(0))
            highs.append(self.points[rows].max(0))
            self.children.append(None)
            self.rows.append(rows)
            return len(lows) - 1

        stack = [node(np.arange(len(ids)))]
        while stack:
            at = stack.pop()
            rows = self.rows[at]
            if len(rows) <= leaf:
                self.rows[at] = np.sort(rows)
                continue
            split = _halves(self.points, rows)
            below, above = split[1:] if split else (rows[:len(rows) // 2], rows[len(rows) // 2:])  # equal points
            self.children[at], self.rows[at] = (node(below), node(above)), None
            stack += self.children[at]
        self.low, self.high = np.array(lows), np.array(highs)

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, beat: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Of each query, up to ``k`` (score, id) of other ids, the best first, that reach ``beat``."""
        points, asked = self.points, queries
        if _largest(queries, points) >= EXACT:
            points, asked = points.astype(np.int64), queries.astype(np.int64)
        best: list[list[tuple[int, int]]] = [[] for _ in ids]
        bar = beat.copy()
        reached = np.full((len(ids), len(self.rows)), -np.inf)  # bounds of the nodes to open
        reached[:, 0] = bounds_of(queries, self.low[:1], self.high[:1])[:, 0]
        alive = np.arange(len(ids))
        while True:
            node = reached[alive].argmax(1)
            going = reached[alive, node] >= bar[alive]
            alive, node = alive[going], node[going]
            if not len(alive):
                break
            for number in np.unique(node):
                mine = alive[node == number]
                reached[mine, number] = -np.inf
                if self.children[number]:
                    below = list(self.children[number])
                    reached[np.ix_(mine, below)] = bounds_of(queries[mine], self.low[below], self.high[below])
                else:
                    self._score(number, mine, ids, asked, points, k, bar, best)
        for q, found in enumerate(best):
            yield q, [(s, -i) for s, i in sorted(found, reverse=True)]

    def _score(self, leaf: int, mine: np.ndarray, ids: np.ndarray, queries: np.ndarray, points: np.ndarray, k: int, bar: np.ndarray, best: list) -> None:
        """The points of a leaf enter the best of the queries ``mine``."""
        rows = self.rows[leaf]
        scores = (queries[mine] @ points[rows].T).astype(np.int64)
        for q, line in zip(mine.tolist(), scores, strict=True):
            for at in np.flatnonzero(line >= bar[q]).tolist():
                other = int(self.ids[rows[at]])
                if other == ids[q]:
                    continue
                item = (int(line[at]), -other)
                if len(best[q]) < k:
                    heapq.heappush(best[q], item)
                else:
                    heapq.heappushpop(best[q], item)
                if len(best[q]) == k:
                    bar[q] = max(bar[q], best[q][0][0])


class Splits:
    """Cells of space by median splits of a sample; every point has one."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.nodes: list[tuple[int, float, int, int]] = []  # side, value, then node or -1 - cell below and above
        self.cells = 0
        self.root = self._grow(sample, np.arange(len(sample)), cells)

    def _grow(self, sample: np.ndarray, rows: np.ndarray, cells: int) -> int:
        split = _halves(sample, rows) if cells > 1 and len(rows) > 1 else None
        if split is None:
            self.cells += 1
            return -self.cells
        along = sample[rows, split[0]]
        value = min(np.median(along), along[along < along.max()].max())
        at = len(self.nodes)
        self.nodes.append((split[0], value, 0, 0))
        below = self._grow(sample, rows[along <= value], cells // 2)
        above = self._grow(sample, rows[along > value], cells - cells // 2)
        self.nodes[at] = (split[0], value, below, above)
        return at

    def place(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            at, rows = stack.pop()
            if at < 0:
                out[rows] = -1 - at
                continue
            side, value, below, above = self.nodes[at]
            low = points[rows, side] <= value
            stack += [(below, rows[low]), (above, rows[~low])]
        return out


def whole_components(embedding: Column) -> Column:
    """floor(256 * x) of each component, as doubles that hold the integers exactly."""
    return F.transform(embedding, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``point`` and ``dim`` of the rows that take part."""
    x = F.col("embedding")
    inf = float("inf")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < inf))
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & good & (F.size(x) > 0))
    rows = rows.select(F.col("vec_id").cast("long"), whole_components(x).alias("point"), F.size(x).alias("dim"))
    largest = F.array_max(F.transform("point", lambda v: F.abs(v)))
    return rows.where(largest * largest * F.col("dim") < LIMIT)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each length in the batch, the places of its rows and their points as a matrix."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, batch.column("point").take(pa.array(at)).flatten().to_numpy().reshape(-1, dim)


def _split_lengths(rows: DataFrame, large: dict[int, int], shard_rows: int) -> dict[int, Splits]:
    """Splits of each length of more vectors than a shard holds, from the sample of the smallest hashes."""
    if not large:
        return {}
    size = max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // max(large)))
    drawn = rows.where(F.col("dim").isin(list(large))).orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(size)
    sample = drawn.select("point", "dim").toPandas()
    every = sum(large.values())
    return {
        int(dim): Splits(np.stack(part["point"].to_numpy()), max(1, min(CELLS * large[dim] // every, large[dim] // shard_rows)))
        for dim, part in sample.groupby("dim")
    }


def _in_cells(rows: DataFrame, splits: dict[int, Splits]) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            for dim, at, points in _by_length(batch):
                if dim in splits:
                    cell[at] = splits[dim].place(points)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return rows.mapInArrow(place, "vec_id long, point array<double>, dim int, query boolean, cell int")


@dataclass(frozen=True)
class Cells:
    """Boxes of one length's cells and the number of shards of each."""

    number: np.ndarray
    low: np.ndarray
    high: np.ndarray
    shards: np.ndarray


def _cells(placed: DataFrame, large: dict[int, int], shard_rows: int) -> dict[int, Cells]:
    """The cells of the lengths in ``large``: a task folds its rows to one box a cell."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes: dict[tuple[int, int], list] = {}
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            for dim, at, points in _by_length(batch):
                for cell in np.unique(cells[at]).tolist():
                    part = points[cells[at] == cell]
                    low, high, n = part.min(0), part.max(0), len(part)
                    old = boxes.get((dim, cell))
                    boxes[dim, cell] = [np.minimum(low, old[0]), np.maximum(high, old[1]), n + old[2]] if old else [low, high, n]
        for (dim, cell), (low, high, n) in boxes.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "cell": pa.array([cell], pa.int32()), "low": [low.tolist()], "high": [high.tolist()], "n": [n]})

    if not large:
        return {}
    parts = placed.where(F.col("dim").isin(list(large))).mapInArrow(fold, "dim int, cell int, low array<double>, high array<double>, n long")
    sides = parts.select("dim", "cell", "n", F.posexplode(F.arrays_zip("low", "high")).alias("side", "box"))
    sides = sides.groupBy("dim", "cell", "side").agg(F.min("box.low").alias("low"), F.max("box.high").alias("high"), F.sum("n").alias("n"))
    side = F.array_sort(F.collect_list(F.struct("side", "low", "high")))
    found = sides.groupBy("dim", "cell").agg(F.max("n").alias("n"), side.alias("b")).select(
        "dim", "cell", "n", F.col("b.low").alias("low"), F.col("b.high").alias("high")).toPandas()
    return {
        int(dim): Cells(c["cell"].to_numpy(np.int32), np.stack(c["low"].to_numpy()), np.stack(c["high"].to_numpy()),
                        -(-c["n"].to_numpy(np.int64) // shard_rows))
        for dim, c in found.groupby("dim")
    }


PLACED = "query_id long, point array<double>, dim int, block int, beat long, cell int, salt int"


def _sent(asked: DataFrame, cells: dict[int, Cells], first: bool) -> DataFrame:
    """The queries of ``asked`` for each shard they go to: at ``first`` one shard of the cell with the best
    bound, then all other shards of the cells whose bound reaches the score to beat."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, points in _by_length(batch):
                rows = batch.take(pa.array(at))
                to = lambda mine, cell, salt: pa.RecordBatch.from_arrays(
                    [*rows.take(pa.array(mine)).columns, pa.array(np.full(len(mine), cell, np.int32)), pa.array(salt[mine].astype(np.int32))],
                    [*rows.schema.names, "cell", "salt"])
                if dim not in cells:
                    if first:  # one shard holds all vectors of this length
                        yield to(np.arange(len(at)), 0, np.zeros(len(at), np.int32))
                    continue
                c = cells[dim]
                bounds = bounds_of(points, c.low, c.high)
                best = bounds.argmax(1)
                home = rows.column("block").to_numpy() % c.shards[best]
                beat = rows.column("beat").to_numpy()
                for k, cell in enumerate(c.number.tolist()):
                    if first:
                        mine = np.flatnonzero(best == k)
                        if len(mine):
                            yield to(mine, cell, home)
                        continue
                    for salt in range(int(c.shards[k])):
                        mine = np.flatnonzero((bounds[:, k] >= beat) & ~((best == k) & (home == salt)))
                        if len(mine):
                            yield to(mine, cell, np.full(len(at), salt))

    return asked.select("query_id", "point", "dim", "block", "beat").mapInArrow(send, PLACED)


def _pack(rows: pd.DataFrame) -> np.ndarray:
    return np.stack([np.asarray(p, np.float64) for p in rows["point"]])


SCHEMA = "query_id long, vec_id long, score long"


def _visit(shard: pd.DataFrame, block: pd.DataFrame, k: int) -> pd.DataFrame:
    """One block of queries in one shard."""
    out: list[tuple[int, int, int]] = []
    if len(shard) and len(block):
        tree = Tree(shard["vec_id"].to_numpy(np.int64), _pack(shard))
        for at in range(0, len(block), SEARCHED):
            part = block.iloc[at:at + SEARCHED]
            ids = part["query_id"].to_numpy(np.int64)
            for q, found in tree.search(ids, _pack(part), k, part["beat"].to_numpy(np.int64)):
                out += [(int(ids[q]), i, s) for s, i in found]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def _hashed(column: str, n: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(column, F.lit(seed)), n).cast("int")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` largest inner products of every
    query row with all other rows; ties go to the smaller ``vec_id``.

    A task holds one shard and one block of queries, both of bounded size. The rows of a shard are sent once
    for each block that has queries for it.
    """
    rows = staged(usable(vectors).withColumn("query", F.coalesce(is_query, F.lit(False))), "top-rows")
    # lengths of more vectors than a shard holds: fewer than there are shards
    large = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows).collect()}
    placed = staged(_in_cells(rows, _split_lengths(rows, large, shard_rows)), "top-cells")
    cells = _cells(placed, large, shard_rows)
    shards = [(dim, cell, n) for dim, c in cells.items() for cell, n in zip(c.number.tolist(), c.shards.tolist(), strict=True)]
    sizes = F.broadcast(rows.sparkSession.createDataFrame(shards, "dim int, cell int, shards long"))
    dealt = placed.join(sizes, ["dim", "cell"], "left").select(
        "vec_id", "point", "dim", "cell", _hashed("vec_id", F.coalesce("shards", F.lit(1)), 1).alias("salt"))

    asked = rows.where("query").groupBy("vec_id").agg(F.min(F.struct("dim", "point")).alias("least"))
    asked = staged(asked.select(F.col("vec_id").alias("query_id"), "least.point", "least.dim"), "top-asked")
    blocks = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", _hashed("query_id", F.lit(blocks), 2))
    shard = ["dim", "cell", "salt"]

    def visit(queries: DataFrame) -> DataFrame:
        keys = [*shard, "block"]
        sent = dealt.join(queries.select(*[F.col(c).alias(c) for c in keys]).distinct(), shard)
        return sent.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(lambda a, b: _visit(a, b, k), SCHEMA)

    every = staged(visit(_sent(asked.withColumn("beat", F.lit(NONE)), cells, True)), "top-first")
    if cells:
        kth = every.groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
        kth = kth.select("query_id", F.when(F.col("n") == k, F.col("low")).alias("beat"))
        others = asked.join(kth, "query_id", "left").withColumn("beat", F.coalesce("beat", F.lit(NONE)))
        every = every.unionAll(visit(staged(_sent(others, cells, False), "top-sent")))

    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")))
    ranked = every.groupBy("query_id").agg(F.slice(best, 1, k).alias("b"))  # at most k a shard
    ranked = ranked.select("query_id", F.posexplode("b").alias("i", "b"))
    return ranked.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))


CHECK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS p
           FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.p, c.p) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
