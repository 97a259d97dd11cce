"""Operator 9: exact top-k inner products, by a dual-tree search over cover trees.

Vectors become integers, floor(scale * x). Rows are dealt into blocks of bounded size; each block is built into a cover
tree, one for data and one for queries, and stored as one row. A task takes a cell: some query trees, whose k best rows so
far it keeps, and a stream of data trees. Nodes of both trees are compared by groups: a pair is dropped if the largest inner
product that their covering radii allow is below the worst kth score of the query node so far. What is left is multiplied
at once, and a row is looked at only where a score reaches its query's kth. A ranking of the cells' best rows is exact.

A cover tree node here has a centre (one of its points) and a radius that covers its points; its children halve the scale.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.llm.common import Scratch
from panelkit.operators.joins import join_small

SCALE = 256
#: Rows of a block at most about; a task holds one data block at a time.
DATA_BLOCK, QUERY_BLOCK = 4096, 1024
LEAF = 48
#: Points of the nodes that are compared first.
QUERY_NODE, DATA_NODE = 64, 256
#: Components of a cell's queries, which a task holds at once; products of a cell; products made at once; partitions at most.
QUERY_VALUES, CELL_PRODUCTS, PRODUCTS, MOST_PARTITIONS = 1 << 23, 1 << 35, 1 << 21, 4096
#: Whole numbers below these are multiplied and added without any rounding.
_EXACT32, _EXACT = 2**24, 2**53
_NONE = np.iinfo(np.int64).min


@dataclass
class CoverTree:
    """Points in tree order: a node is the range ``start`` to ``end``; ``kids`` of node i are ``first[i]`` to ``last[i]``."""

    ids: np.ndarray
    points: np.ndarray
    centre: np.ndarray  # index of a point
    radius: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> CoverTree:
        """Top down: a node's points go to the nearest of a few far-apart centres, until they lie within half the radius."""
        order = np.argsort(ids, kind="stable")
        nodes: list[list] = [[0, len(ids), 0, 0]]  # start, end, first, last
        centres, radii = [], []
        i = 0
        while i < len(nodes):
            start, end, _, _ = nodes[i]
            own = order[start:end]
            x = points[own].astype(float)
            middle = x.mean(axis=0)
            c = int(np.argmin(((x - middle) ** 2).sum(axis=1)))
            gap = np.sqrt(((x - x[c]) ** 2).sum(axis=1))
            centres.append(int(own[c]))
            radii.append(float(gap.max()))
            if len(own) > leaf and gap.max() > 0:
                near, home, picked = gap.copy(), np.zeros(len(own), np.int64), 1
                while picked < 16 and near.max() > gap.max() / 2:
                    far = int(np.argmax(near))
                    new = np.sqrt(((x - x[far]) ** 2).sum(axis=1))
                    home[new < near] = picked
                    near = np.minimum(near, new)
                    picked += 1
                if picked == 1:
                    i += 1
                    continue
                by = np.argsort(home, kind="stable")
                order[start:end] = own[by]
                sizes = np.bincount(home, minlength=picked)
                nodes[i][2] = len(nodes)
                at = start
                for size in sizes[sizes > 0]:
                    nodes.append([at, at + int(size), 0, 0])
                    at += int(size)
                nodes[i][3] = len(nodes)
            i += 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        start, end, first, last = (np.array(c, np.int64) for c in zip(*nodes, strict=True))
        return cls(ids[order], points[order], place[centres], np.array(radii), start, end, first, last)

    def nodes(self, most: int) -> np.ndarray:
        """The topmost nodes of at most ``most`` points, or leaves, by their start: each point is in one of them."""
        small = (self.end - self.start <= most) | (self.first == self.last)
        above = np.zeros(len(small), np.int64)
        inner = np.flatnonzero(self.first < self.last)
        kids = self.last[inner] - self.first[inner]
        above[_ranges(self.first[inner], self.last[inner])] = np.repeat(inner, kids)
        top = small & ~small[above]
        top[0] = small[0]
        found = np.flatnonzero(top)
        return found[np.argsort(self.start[found])]

    def dump(self) -> bytes:
        out = io.BytesIO()
        ends = self.points.min(initial=0), self.points.max(initial=0)
        kind = np.result_type(*(np.min_scalar_type(min(int(x), -1 - int(x))) for x in ends))  # the smallest signed type
        np.savez(out, **{k: getattr(self, k) for k in self.__dataclass_fields__} | {"points": self.points.astype(kind)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            return cls(**{k: z[k] for k in z.files})


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    sizes = end - start
    return np.arange(sizes.sum()) + np.repeat(start - np.cumsum(sizes) + sizes, sizes)


class Side:
    """A tree as the search needs it: its points in the types that were asked for, the sizes of centres, its nodes."""

    def __init__(self, tree: CoverTree, node: int) -> None:
        self.tree = tree
        self.size = float(np.sqrt((tree.points.astype(float) ** 2).sum(axis=1)).max(initial=1.0)) * (1 + 1e-9)
        self.middle = tree.points[tree.centre].astype(float)
        self.length = np.sqrt((self.middle**2).sum(axis=1))
        self.nodes, self.leaves = tree.nodes(node), tree.nodes(0)
        self.copies = int(np.unique(tree.ids, return_counts=True)[1].max(initial=1))  # rows that share an id
        self._values: dict = {}

    def values(self, kind: type) -> np.ndarray:
        if kind not in self._values:
            self._values[kind] = self.tree.points.astype(kind)
        return self._values[kind]

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """The leaves of ``nodes``."""
        t, starts = self.tree, self.tree.start[self.leaves]
        return self.leaves[_ranges(np.searchsorted(starts, t.start[nodes]), np.searchsorted(starts, t.end[nodes]))]


class Best:
    """The ``k`` best (score, id) of some queries; unused places hold the least long as their score."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores, self.ids = np.full((queries, k), _NONE), np.zeros((queries, k), np.int64)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of the queries ``at``; the same score of the same id counts once."""
        rows = np.unique(at)
        have = self.scores[rows] > _NONE
        at = np.concatenate([at, np.repeat(rows, have.sum(axis=1))])
        scores = np.concatenate([scores, self.scores[rows][have]])
        ids = np.concatenate([ids, self.ids[rows][have]])
        order = np.lexsort((ids, ~scores, at))  # ~x falls as x grows, without overflow
        at, scores, ids = at[order], scores[order], ids[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
        at, scores, ids = at[new], scores[new], ids[new]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        kept = place < self.k
        self.scores[rows] = _NONE
        self.scores[at[kept], place[kept]] = scores[kept]
        self.ids[at[kept], place[kept]] = ids[kept]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; those of Python's numbers as long, held at its ends."""
    if a.dtype != object:
        return a @ b.T
    ends = np.iinfo(np.int64)
    exact = a @ b.T if a.shape[1] else np.zeros((len(a), len(b)), object)
    return np.clip(exact, ends.min + 1, ends.max).astype(np.int64)  # the least long marks an unused place


def _bounds(queries: Side, i: np.ndarray, data: Side, j: np.ndarray) -> np.ndarray:
    """The largest inner product that points of the nodes ``i`` and ``j`` can have."""
    # |<q', d'>| <= <q, d> + |q| r_d + |d| r_q + r_q r_d; the slack covers rounding.
    q, d, q_r, d_r = queries.length[i], data.length[j], queries.tree.radius[i], data.tree.radius[j]
    most = queries.middle[i] @ data.middle[j].T + np.outer(q, d_r) + np.outer(q_r, d) + np.outer(q_r, d_r)
    return most + 1e-6 * np.abs(most) + 1e-9 * np.outer(q + q_r, d + d_r) + 1


def _offer(queries: Side, first: int, last: int, data: Side, columns: slice | np.ndarray, best: Best) -> None:
    """Multiply a range of queries with the points ``columns`` and keep what reaches a query's kth score."""
    # No sum of components' products, in whatever order, passes the product of the largest sizes.
    most = queries.size * data.size
    kind = np.float32 if most < _EXACT32 else np.float64 if most < _EXACT else object
    points, names = data.values(kind)[columns], data.tree.ids[columns]
    step = max(1, PRODUCTS // len(names))
    for a in range(first, last, step):
        b = min(a + step, last)
        scores, worst = _products(queries.values(kind)[a:b], points), best.scores[a:b, -1]
        hit = np.flatnonzero(scores.max(axis=1).astype(np.int64) >= worst)
        if not len(hit):
            continue
        scores, level = scores[hit], worst[hit]
        enough = (best.k + 1) * data.copies  # so many hold k other ids than the query's at least
        if enough < len(names):
            level = np.maximum(level, np.partition(scores, -enough, axis=1)[:, -enough].astype(np.int64))
        at, column = np.nonzero(scores >= level.astype(scores.dtype)[:, None])
        rows = a + hit[at]
        other = names[column] != queries.tree.ids[rows]
        best.add(rows[other], scores[at, column][other].astype(np.int64), names[column][other])


def dual_search(queries: Side, data: Side, best: Best) -> None:
    """Bring the k best rows of each query (in tree order) up to date with the points of ``data``."""
    q, d, groups, nodes = queries.tree, data.tree, queries.nodes, data.nodes
    worst = np.minimum.reduceat(best.scores[:, -1], q.start[groups])
    near = _bounds(queries, groups, data, nodes) >= worst[:, None]
    left = (q.end - q.start)[groups] @ near @ (d.end - d.start)[nodes]
    if 2 * left > len(q.ids) * len(d.ids):  # the bounds hardly separate these trees: one product is cheaper than many
        _offer(queries, 0, len(q.ids), data, slice(None), best)
        return
    for g in np.flatnonzero(near.any(axis=1)):
        leaves = data.below(nodes[near[g]])
        leaves = leaves[_bounds(queries, groups[g : g + 1], data, leaves)[0] >= worst[g]]
        if len(leaves):
            _offer(queries, q.start[groups[g]], q.end[groups[g]], data, _ranges(d.start[leaves], d.end[leaves]), best)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trees = []
        for ids, flat, n in zip(batch.column("ids"), batch.column("flat"), batch.column("n").to_pylist(), strict=True):
            points = flat.values.to_numpy().reshape(len(ids.values), n)
            trees.append(CoverTree.build(ids.values.to_numpy(), points).dump())
        kept = ["n", "block"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(trees, pa.binary())], names=[*kept, "tree"])


def _search(k: int):
    """Rows come by cell, a cell's query trees before its data trees."""

    def found(asked: list[tuple[Side, Best]]) -> Iterator[pa.RecordBatch]:
        for queries, best in asked:
            full = best.scores > _NONE
            names = np.repeat(queries.tree.ids, full.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(best.ids[full]), pa.array(best.scores[full])], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked = None, []
        for batch in batches:
            cells = zip(*(batch.column(c).to_pylist() for c in ("n", "cell")), strict=True)
            for cell, asks, tree in zip(cells, batch.column("asks").to_pylist(), batch.column("tree"), strict=True):
                if cell != now:
                    yield from found(asked)
                    now, asked = cell, []
                side = Side(CoverTree.load(tree.as_py()), QUERY_NODE if asks else DATA_NODE)
                if asks:
                    asked.append((side, Best(len(side.tree.ids), k)))
                    continue
                for queries, best in asked:
                    dual_search(queries, side, best)
        yield from found(asked)

    return run


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null, NaN or infinite."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(odd, F.lit(True)), F.transform(as_double, lambda x: F.floor(x * F.lit(float(scale))).cast("long")))


def _blocks(rows: DataFrame, count: str) -> DataFrame:
    """(n, block, tree): rows of one dimension n in ``count`` blocks, by a hash of id and vector; equal rows become one."""
    block = F.pmod(F.xxhash64("id", "v"), F.col(count)).cast("int").alias("block")
    grouped = rows.select("n", block, "id", "v").groupBy("n", "block").agg(F.collect_set(F.struct("id", "v")).alias("rows"))
    flat = grouped.select("n", "block", F.expr("transform(rows, r -> r.id)").alias("ids"), F.expr("flatten(transform(rows, r -> r.v))").alias("flat"))
    return flat.mapInArrow(_build, "n int, block int, tree binary")


def _grid(rows: DataFrame, data_block: int, query_block: int) -> DataFrame:
    """A row per dimension with queries: its blocks, and a grid of ``across`` parts of the queries by ``along`` parts of the data.

    A part of the queries is what a task can hold; there are some four cells per core, more where their products are many.
    """
    sizes = rows.groupBy("n").agg(F.count(F.lit(1)).alias("_all"), F.count_if("asks").alias("_asks")).where("_asks > 0")
    held = F.greatest(F.floor(F.lit(QUERY_VALUES) / F.greatest("n", F.lit(1))), F.lit(query_block))
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    across, blocks = F.ceil(F.col("_asks") / held), F.ceil(F.col("_all") / data_block)
    many = F.ceil(F.least(held, F.col("_asks")).cast("double") * F.col("_all") / CELL_PRODUCTS)
    along = F.least(blocks, F.greatest(F.ceil(F.lit(tasks) / across), many))
    found = {"data_blocks": blocks, "query_blocks": F.ceil(F.col("_asks") / query_block), "across": across, "along": along}
    return sizes.select("n", *[c.cast("int").alias(name) for name, c in found.items()])


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    scale: int = SCALE,
    data_block: int = DATA_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k highest integer inner products with all other rows.

    Ties go to the smaller id; with fewer rows than k all are returned. Rows with a null id, a null vector, or null or
    non-finite components take no part; only vectors of one length are compared; of rows that share an id, one with each
    distinct vector is a candidate, and none of them for the query of that id. Empty tables give no rows. Other columns
    are ignored. Scores beyond a long are held at its ends.
    """
    scratch = Scratch(vectors.sparkSession, "top-k")
    rows = vectors.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), whole_numbers(F.col(vector_col), scale).alias("v"), is_query.alias("asks")
    )
    rows = rows.filter("v is not null").withColumn("n", F.size("v"))
    grid = scratch.table(_grid(rows, data_block, query_block))
    cells = grid.agg(F.sum(F.col("across").cast("long") * F.col("along"))).first()[0] or 1
    placed = join_small(rows, grid, "n", "inner")
    data = join_small(scratch.table(_blocks(placed, "data_blocks")), grid, "n", "inner")
    queries = join_small(scratch.table(_blocks(placed.filter("asks"), "query_blocks")), grid, "n", "inner")
    # Each query tree goes to all parts of the data, each data tree to all parts of the queries; a cell is one of each.
    part, along = F.explode(F.sequence(F.lit(0), F.col("across") - 1)), F.explode(F.sequence(F.lit(0), F.col("along") - 1))
    sent = data.select("*", part.alias("_part")).select("n", F.expr("_part * along + block % along").alias("cell"), F.lit(False).alias("asks"), "tree")
    asked = queries.select("*", along.alias("_part")).select("n", F.expr("block % across * along + _part").alias("cell"), F.lit(True).alias("asks"), "tree")
    parts = min(cells, MOST_PARTITIONS)
    dealt = asked.unionByName(sent).repartitionById(parts, F.pmod(F.col("n") + F.col("cell"), F.lit(parts)).cast("int"))
    ordered = dealt.sortWithinPartitions("n", "cell", F.desc("asks"))
    # Dealt by query once, for both steps behind.
    found = ordered.mapInArrow(_search(k), "query_id long, vec_id long, score long").repartition("query_id").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
