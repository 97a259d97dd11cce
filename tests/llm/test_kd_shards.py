"""k-d tree shards against a plain tree, and their law on awkward tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import kd_shards as kd


def plain_tree(rows, sizes, n_dims, leaves, wide=None):
    """Shard of each (dims, text hash) row, cut by sorting; ``rows`` are unlike in their hashes."""
    out = {}

    def cut(own, leaves, first, wide):
        if leaves == 1 or not own:
            out.update(dict.fromkeys(own, first))
            return
        spread = [max(rows[i][k] for i in own) - min(rows[i][k] for i in own) for k in range(n_dims)]
        wide = wide or spread
        dim = max(range(n_dims), key=lambda k: (spread[k] / max(wide[k], 1), -k))
        own = sorted(own, key=lambda i: (rows[i][dim], rows[i][-1]))
        need = max(1, sum(sizes[i] for i in own) * (leaves // 2) // leaves)
        at = done = 0
        while done + sizes[own[at]] < need:
            done += sizes[own[at]]
            at += 1
        at += 2 * (need - done) >= sizes[own[at]]
        cut(own[:at], leaves // 2, first, wide)
        cut(own[at:], leaves - leaves // 2, first + leaves // 2, wide)

    cut(list(range(len(rows))), leaves, 0, wide)
    return [out[i] for i in range(len(rows))]


@pytest.mark.parametrize("leaves", [1, 5, 16])
def test_the_tree_is_the_plain_one(spark, leaves):
    rng = np.random.default_rng(leaves)
    rows = [(k, "é" * int(rng.integers(0, 60)) + f" {k}", f"src{rng.integers(0, 9)}", str(rng.choice(["de", "en", "fr"])), int(rng.integers(0, 5000))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, weight int")
    dims = ("weight", "source", "lang")
    got = {r.doc_id: r.shard for r in kd.kd_shards(docs, dims, shards=leaves, slack=0).collect()}
    kinds = {f.name: f.dataType for f in docs.schema}
    numbers = docs.select("doc_id", *[kd.as_number(F.col(d), kinds[d]).alias(d) for d in dims], F.shiftrightunsigned(F.xxhash64("text"), 16).alias("h"))
    keys = [tuple(r)[1:] for r in numbers.orderBy("doc_id").collect()]
    want = plain_tree(keys, [len(t.encode()) + 1 for _, t, *_ in rows], 3, leaves)
    assert [got[k] for k in range(300)] == want


def check_law(rows, leaves, most=0.01):
    sizes = np.zeros(leaves, np.int64)
    slots = [[] for _ in range(leaves)]
    for r in rows:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    largest = max(r["size"] for r in rows)
    assert abs(sizes - sizes.mean()).max() <= most * sizes.mean() + largest


def test_a_hot_group_is_cut_and_others_stay_whole(spark):
    """A third of all rows are one row; copies from several sources stand together but where a cut falls."""
    rows = [(7, "hot text", "src0", "en", 8)] * 1000
    rows += [(k, f"text number {k // 4} with some words", f"src{k % 5}", "en", 30) for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars int")
    got = kd.kd_shards(docs, shards=16, keep=["text", "size"]).collect()
    assert len(got) == 3000
    check_law(got, 16)
    shards_of = {}
    for r in got:
        shards_of.setdefault(r.text, set()).add(r.shard)
    assert sum(len(s) > 1 for t, s in shards_of.items() if t != "hot text") <= 15


def test_awkward_and_empty_tables(spark, awkward):
    named = awkward.selectExpr("doc_id", "text", "spans", "score", "n_words", "1 as shard", "'x' as slot", "cast(null as string) as lang")
    got = kd.kd_shards(named, ("n_words", "lang", "score"), shards=4, keep=["spans", "shard", "text"]).collect()
    assert len(got) == awkward.count() and got[0].asDict().keys() == {"doc_id", "spans", "text", "size", "text_crc32", "shard", "slot"}
    check_law(got, 4)
    assert all(r["size"] == len((r.text or "").encode()) + 1 for r in got)
    assert all(r.text_crc32 == 0 for r in got if not r.text)
    assert kd.kd_shards(named.filter("false"), ("lang",), shards=4).count() == 0
    one = kd.kd_shards(named.limit(1), ("lang",), shards=16).collect()
    assert [(r.shard in range(16), r.slot) for r in one] == [(True, 0)]


def test_leaves_reach_the_target_bytes(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    placed = kd.kd_shards(docs, target_bytes=50_000, keep=["text"])
    rows = placed.collect()
    total = sum(r["size"] for r in rows)
    leaves = -(-total // 50_000)
    check_law(rows, leaves)
    kd.write_shards(placed, str(tmp_path / "shards"))
    again = spark.read.parquet(str(tmp_path / "shards"))
    assert {(r.doc_id, r.shard, r.slot) for r in again.collect()} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_the_query_over_a_whole_table(spark, sf):
    got = kd.op13_kd_shards(spark, sf)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    check_law(rows, 16)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
