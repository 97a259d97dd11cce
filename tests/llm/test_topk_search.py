"""The dual-tree search by cells: exact in every type of numbers, with and without pruning, spread over many tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import topk_search as S


def _plain(ids, points, queries, k):
    """The k best distinct (score, id) of each query id, by Python's whole numbers."""
    ends = np.iinfo(np.int64)
    want = {}
    for q in queries:
        asked = [p for i, p in zip(ids, points, strict=True) if i == q]
        made = {(-min(max(sum(int(a) * int(b) for a, b in zip(p, v, strict=True)), ends.min + 1), ends.max), i) for p in asked for i, v in zip(ids, points, strict=True) if i != q}
        want[q] = [(-s, i) for s, i in sorted(made)[:k]]
    return want


@pytest.mark.parametrize("scale", [100, 10**5, 10**10])
@pytest.mark.parametrize("spread", [0.01, 3.0])
def test_dual_search_is_exact(scale, spread, monkeypatch):
    """Small, large and very large numbers; clusters that bounds separate and points that they do not; ids that come twice."""
    monkeypatch.setattr(S, "PRODUCTS", 1 << 9)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 6))
    points = np.floor(scale * (centres[rng.integers(0, 9, 260)] + spread * rng.normal(size=(260, 6)))).astype(np.int64)
    points[40:60] = points[:20]  # equal vectors of other ids: ties
    ids = np.arange(260) * 3
    ids[70:80], ids[100:103] = ids[:10], ids[60]  # ids of several vectors
    queries = S.Side(S.CoverTree.load(S.CoverTree.build(ids[:64], points[:64], 4).dump()), 8)
    best = S.Best(64, 5)
    for a in range(0, 260, 65):
        tree = S.CoverTree.build(ids[a : a + 65], points[a : a + 65], 4)
        S.dual_search(queries, S.Side(S.CoverTree.load(tree.dump()), 16), best)
    at = {int(q): i for i, q in enumerate(queries.tree.ids)}
    for q, found in _plain(ids[:260], points, [int(i) for i in ids[:64] if (ids == i).sum() == 1], 5).items():
        assert list(zip(best.scores[at[q]].tolist(), best.ids[at[q]].tolist(), strict=True)) == found


def test_nodes_hold_each_point_once():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(-50, 50, (300, 4)), np.ones((90, 4), np.int64)])  # equal points make a large leaf
    tree = S.CoverTree.build(np.arange(390), points, 4)
    for most in (0, 16, 1000):
        found = tree.nodes(most)
        assert S._ranges(tree.start[found], tree.end[found]).tolist() == list(range(390))
        assert all(tree.end[i] - tree.start[i] <= most or tree.first[i] == tree.last[i] for i in found)
    assert S.Side(tree, 16).tree.nodes(1000).tolist() == [0]


def test_search_is_dealt_to_many_tasks(spark, monkeypatch):
    """Query and data parts make cells of their own, also of several dimensions; rows that come twice count once."""
    monkeypatch.setattr(S, "QUERY_VALUES", 6 * 20)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=6 if i % 4 else 3)]) for i in range(900)]
    vectors = spark.createDataFrame(rows + rows[:30], "vec_id long, embedding array<double>").repartition(3)
    got = S.top_k(vectors, F.col("vec_id") % 6 == 0, data_block=30, query_block=8)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    parts = spark.sparkContext.defaultParallelism
    assert "RepartitionById" in plan or "RepartitionByExpression" in plan
    assert got.count() == 150 * 5
    sizes = spark.createDataFrame([(6, i % 6 == 0) for i in range(675)] + [(3, i < 40) for i in range(225)] + [(2, False)], "n int, asks boolean")
    grid = {r.n: r for r in S._grid(sizes, 30, 8).collect()}
    assert sorted(grid) == [3, 6] and grid[6].across == 6 and grid[6].along == max(1, -(-4 * parts // 6))
    assert (grid[6].data_blocks, grid[6].query_blocks, grid[3].data_blocks, grid[3].query_blocks, grid[3].across) == (23, 15, 8, 5, 1)
    whole = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v in rows}
    want = set()
    for n in (3, 6):
        ids = [i for i, v in whole.items() if len(v) == n]
        best = _plain(ids, [whole[i] for i in ids], [i for i in ids if i % 6 == 0], 5)
        want |= {(q, k + 1, i, s) for q, found in best.items() for k, (s, i) in enumerate(found)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()} == want
