"""Nearest neighbours by inner product through low-dimensional stable projections and a kd-tree.

Vectors are lifted so that the largest inner product is the smallest Euclidean distance, and projected on a few
Gaussian directions. The squared projected distance over the squared true distance then follows a chi-square law, so
once the nearest unvisited box of the kd-tree lies far enough from the query, better neighbours are improbable
and the search stops. The tree's upper levels deal the vectors out as cells; its lower levels are built inside the
tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickmart.llm.grouped import sorted_groups
from tickmart.llm.scratch import stored

NEIGHBOURS = 20
DIRECTIONS = 8
#: The search stops when a box is so far that a true neighbour would be projected there with a probability below this.
MISS = 0.02
#: Rows from which the tree's upper levels are fitted, wanted rows of a cell, most cells, rows of a leaf.
SAMPLE_ROWS, CELL_ROWS, MOST_CELLS, LEAF_ROWS = 20_000, 8192, 4096, 512
#: Vectors and queries of a cell that one task holds; fuller cells are dealt out in blocks.
BLOCK_ROWS, BLOCK_QUERIES = 50_000, 20_000


def chi_square_cut(degrees: int, miss: float) -> float:
    """The value that a chi-square variable of an even number of degrees exceeds with probability ``miss``."""
    tail = lambda x: math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if tail(mid) > miss else (low, mid)
    return high


class Projection:
    """Lift and projection of vectors: ``|lifted(q) - lifted(x)|**2 = 2 * most**2 - 2 * most * <q, x> / |q|``."""

    def __init__(self, width: int, most: float, directions: int = DIRECTIONS, seed: int = 4):
        self.most = most
        self.directions = np.random.default_rng(seed).standard_normal((width + 1, directions))

    def points(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.most**2 - (x**2).sum(axis=1), 0))
        return x @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return (q * (self.most / np.sqrt((q**2).sum(axis=1)))[:, None]) @ self.directions[:-1]

    def distance(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared lifted distance at an inner product."""
        return np.maximum(2 * self.most**2 - 2 * self.most * score / np.sqrt((q**2).sum(axis=1)), 0)


class Tree:
    """A kd-tree over points: median splits along the widest direction until leaves have ``leaf`` rows or cannot split."""

    def __init__(self, points: np.ndarray, leaf: int, most_leaves: int = 1 << 30):
        self.splits: list[tuple[int, float, int, int]] = []  # direction, value, left and right node; leaves are ~number
        self.leaves: list[np.ndarray] = []
        depth = max(0, math.ceil(math.log2(max(1, len(points) / leaf))))
        self.depth = min(depth, int(math.log2(most_leaves)))
        self.root = self._grow(points, np.arange(len(points)), 0)

    def _grow(self, points: np.ndarray, rows: np.ndarray, level: int) -> int:
        if level < self.depth and len(rows) > 1:
            part = points[rows]
            spread = part.max(axis=0) - part.min(axis=0)
            d = int(spread.argmax())
            value = float(np.median(part[:, d]))
            left = part[:, d] <= value
            if spread[d] > 0 and not left.all():
                node = len(self.splits)
                self.splits.append((d, value, 0, 0))
                below = self._grow(points, rows[left], level + 1), self._grow(points, rows[~left], level + 1)
                self.splits[node] = (d, value, *below)
                return node
        self.leaves.append(rows)
        return ~(len(self.leaves) - 1)

    def cell(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point falls into."""
        out = np.zeros(len(points), np.int64)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                out[rows] = ~node
            else:
                d, value, left, right = self.splits[node]
                low = points[rows, d] <= value
                stack += [(left, rows[low]), (right, rows[~low])]
        return out


    def regions(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ends of each leaf's part of space; the outer ones are infinite."""
        low, high = np.full((len(self.leaves), width), -np.inf), np.full((len(self.leaves), width), np.inf)

        def walk(node: int, lo: np.ndarray, hi: np.ndarray) -> None:
            if node < 0:
                low[~node], high[~node] = lo, hi
                return
            d, value, left, right = self.splits[node]
            up, down = hi.copy(), lo.copy()
            up[d] = down[d] = value
            walk(left, lo, up)
            walk(right, down, hi)

        walk(self.root, low[0].copy(), high[0].copy())
        return low, high


def box_distances(goals: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each goal to each box."""
    out = np.zeros((len(goals), len(low)))
    for d in range(goals.shape[1]):
        out += np.maximum(np.maximum(low[None, :, d] - goals[:, None, d], goals[:, None, d] - high[None, :, d]), 0) ** 2
    return out


class Best:
    """The best ``k`` (score, place) of each query so far; ties go to the smaller place."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.place = np.full((queries, k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, scores: np.ndarray, places: np.ndarray) -> None:
        score = np.concatenate([self.score[rows], scores], axis=1)
        place = np.concatenate([self.place[rows], places], axis=1)
        order = np.lexsort((place, -score), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.place[rows] = np.take_along_axis(place, order, 1)


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed alike wherever they are computed."""
    return (x * q).sum(axis=1)


def fewest_copies(ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows by id, and of equal vectors only the ``k + 1`` smallest ids: others can't be among the ``k`` nearest."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], np.ascontiguousarray(x[order])
    same = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    by = np.argsort(same, kind="stable")
    group = same[by]
    nth = np.arange(len(by)) - np.searchsorted(group, group)
    keep = np.sort(by[nth <= k])
    return ids[keep], x[keep]


def _ranked(row: np.ndarray, col: np.ndarray, x: np.ndarray, q: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact scores and places of the ``k`` best of each query's offered ``(row, col)`` pairs, ties to the smaller place."""
    exact = np.concatenate([exact_scores(x[col[a:a + 65536]], q[row[a:a + 65536]]) for a in range(0, len(row), 65536)] or [np.zeros(0)])
    order = np.lexsort((places[col], -exact, row))
    row, col, exact = row[order], col[order], exact[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    score, place = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
    top = nth < k
    score[row[top], nth[top]], place[row[top], nth[top]] = exact[top], places[col[top]]
    return score, place


def search_block(projection: Projection, ids: np.ndarray, x: np.ndarray, names: np.ndarray, q: np.ndarray, known: np.ndarray,
                 k: int, cut: float, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best neighbours of the queries ``(names, q)`` among the rows ``(ids, x)``: names, ids and scores.

    ``known`` is each query's k-th score so far. Leaves are visited in order of their boxes' projected distance, all
    rows of a leaf are verified, and a query leaves when the next box fails the chi-square test at its k-th score.
    """
    ids, x = fewest_copies(ids, x, k)
    points, goals = projection.points(x), projection.queries(q)
    tree = Tree(points, leaf)
    away = box_distances(goals, np.array([points[r].min(axis=0) for r in tree.leaves]), np.array([points[r].max(axis=0) for r in tree.leaves]))
    order = away.argsort(axis=1, kind="stable")
    best = Best(len(q), k)
    live = np.arange(len(q))
    for nth in range(order.shape[1]):
        bound = np.maximum(best.score[live, -1], known[live])
        live = live[away[live, order[live, nth]] <= cut * projection.distance(q[live], bound)]
        if not len(live):
            break
        at = order[live, nth]
        for leaf_no in np.unique(at):
            rows, asking = tree.leaves[leaf_no], live[at == leaf_no]
            scores = q[asking] @ x[rows].T
            scores[names[asking][:, None] == ids[rows][None, :]] = -np.inf
            # A matrix product may differ in its last bits from the sum that counts; both are far below this share of the norms.
            slack = 1e-12 * projection.most * np.sqrt((q[asking] ** 2).sum(axis=1))
            bound = np.maximum(best.score[asking, -1], known[asking]) - slack
            better = scores.max(axis=1) >= bound
            asking, scores, bound, slack = asking[better], scores[better], bound[better], slack[better]
            if len(asking):
                if len(rows) > k:
                    bound = np.maximum(bound, np.partition(scores, -k, axis=1)[:, -k] - slack)
                best.offer(asking, *_ranked(*np.nonzero((scores >= bound[:, None]) & (scores > -np.inf)), x[rows], q[asking], rows, k))
    row, col = np.nonzero(np.isfinite(best.score))
    place = best.place[row, col]
    return names[row], ids[place], exact_scores(x[place], q[row])


def usable(column: str, width: int):
    """Vectors that take part: of the common width, without null or non-finite components, not zero."""
    return F.expr(f"size({column}) = {width} AND forall({column}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
                  f" AND exists({column}, x -> x <> 0)")


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _search(projection: Projection, width: int, k: int, cut: float, leaf: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in sorted_groups(batches, 3):
            asks = group.column("asks").to_numpy()
            ids, x = group.column("id").to_numpy(), as_matrix(group.column("v").combine_chunks(), width)
            known = group.column("known").to_numpy()
            if asks.all() or not asks.any():
                continue
            q = asks.astype(bool)
            names, found, scores = search_block(projection, ids[~q], x[~q], ids[q], x[q], known[q], k, cut, leaf)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(found), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return rows


def nearest(base: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, directions: int = DIRECTIONS, miss: float = MISS,
            cell_rows: int = CELL_ROWS, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS,
            block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query the ``k`` vectors of largest inner product that were found.

    Both tables have ``vec_id`` and ``embedding``. A candidate with the query's own vec_id is left out; ties go to the
    smaller vec_id; fewer candidates give fewer rows. Scores are inner products of the given vectors in double
    precision. Vectors that are null, zero, of another width than most, or hold null or non-finite components take no
    part, nor do rows without vec_id. Of queries with the same vec_id one is answered; candidates that repeat a vec_id
    are all returned. Other columns are ignored. Empty tables give an empty result.

    Every query first searches the cell of the tree it falls into, then every other cell that the chi-square test
    does not rule out at the score reached so far. A true neighbour is missed with probability below ``miss``. Cells
    and the queries that visit them are dealt out in blocks; the driver holds the tree's upper levels (at most 4096
    cells, fitted on at most 20,000 rows) and one count per cell.
    """
    spark = base.sparkSession
    widths = base.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").first()
    width = widths["w"] if widths else 0
    pick = [F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v")]
    rows = base.where("vec_id IS NOT NULL").where(usable("embedding", width)).select(*pick)
    asking = queries.where("vec_id IS NOT NULL").where(usable("embedding", width)).select(*pick).groupBy("id").agg(F.min("v").alias("v"))
    stats = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("m")).first()
    if not stats["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    projection = Projection(width, math.sqrt(stats["m"]), directions)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").toArrow().column("v").combine_chunks()
    points = projection.points(as_matrix(sample, width))
    cells = min(MOST_CELLS, -(-stats["n"] // cell_rows))
    tree = Tree(points, max(1, math.ceil(len(points) / cells)), MOST_CELLS)
    tree.leaves = [r[:0] for r in tree.leaves]
    low, high = tree.regions(directions)
    cut = chi_square_cut(directions, miss)
    kind = rows.schema["v"].dataType.simpleString()

    def celled(goal: bool):
        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = as_matrix(batch.column(1), width)
                at = tree.cell(projection.queries(x) if goal else projection.points(x)) if len(x) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), batch.column(0), batch.column(1)], names=["cell", "id", "v"])
        return go

    shape = f"cell int, id bigint, v {kind}"
    held = rows.mapInArrow(celled(False), shape)
    home = stored(asking.mapInArrow(celled(True), shape).withColumn("known", F.lit(-np.inf)), "queries")
    filled = {r["cell"]: r["count"] for r in held.groupBy("cell").count().collect()}

    def searched(asks: DataFrame) -> DataFrame:
        visits = {r["cell"]: r["count"] for r in asks.groupBy("cell").count().collect()}
        deal = [(c, -(-n // block_rows), -(-visits[c] // block_queries)) for c, n in filled.items() if c in visits]
        plan = F.broadcast(spark.createDataFrame(deal, "cell int, blocks int, chunks int"))
        part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = held.join(plan, "cell").select("cell", part("blocks").alias("block"), every("chunks").alias("chunk"), F.lit(0).alias("asks"),
                                              "id", "v", F.lit(-np.inf).alias("known"))
        right = asks.join(plan, "cell").select("cell", every("blocks").alias("block"), part("chunks").alias("chunk"), F.lit(1).alias("asks"),
                                               "id", "v", "known")
        met = left.union(right).repartition("cell", "block", "chunk").sortWithinPartitions("cell", "block", "chunk")
        return met.mapInArrow(_search(projection, width, k, cut, leaf_rows), "query_id bigint, vec_id bigint, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    first = stored(searched(home), "near")
    reached = ranked(first).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    bounded = home.drop("known").join(reached.withColumnRenamed("query_id", "id"), "id", "left").select(
        "cell", "id", "v", F.when(F.col("n") >= k, F.col("score")).otherwise(F.lit(-np.inf)).alias("known"))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                q, known, own = as_matrix(part.column(2), width), part.column(3).to_numpy(), part.column(0).to_numpy()
                open_ = box_distances(projection.queries(q), low, high) <= cut * projection.distance(q, known)[:, None]
                open_[np.arange(len(q)), own] = False
                row, cell = np.nonzero(open_)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *taken.columns[1:]], names=["cell", "id", "v", "known"])

    others = stored(bounded.mapInArrow(visits, shape + ", known double"), "visits")
    found = first.unionByName(searched(others))
    return ranked(found).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
