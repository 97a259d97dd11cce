"""Every ordered operator gives the same values when groups are cut into small blocks."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from panelkit.operators import features as A
from panelkit.operators import ordered as O
from panelkit.operators import panel as P
from panelkit.operators import segments as G
from panelkit.operators import series as Q
from panelkit.workload import inputs as I

BLOCK = 9


def rows(df, key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def same(a, b, key):
    left, right = rows(a, key), rows(b, key)
    assert left.keys() == right.keys() and left
    for k, row in left.items():
        assert row.keys() == right[k].keys()
        for c, v in row.items():
            w = right[k][c]
            ok = v == w or (isinstance(v, float) and isinstance(w, float) and math.isclose(v, w, rel_tol=1e-9, abs_tol=1e-9))
            assert ok, (k, c, v, w)


@pytest.fixture(scope="module")
def cut(spark, sf):
    """The series numbered in both ways, each with its layout."""
    raw = I.raw_series(spark, sf)
    plain, layout = I.series(spark, sf)
    small = replace(layout, block=BLOCK, order=("ts", "event_id"))
    assert small.hot
    logs = Q.log_series(raw)
    hot = O.number_rows(logs, small)
    return plain.cache(), layout, O.durable(hot), small.by("pos")


def test_numbering(cut):
    plain, _, hot, _ = cut
    same(plain.select("file_name", "event_id", "pos", "n_rows"), hot.select("file_name", "event_id", "pos", "n_rows"), ["file_name", "event_id"])


def test_blocks_bound_every_task(cut):
    """No (key, block) pair of the numbering holds more than a few blocks' worth of rows."""
    hot = cut[2].withColumn("b", F.floor(F.col("pos") / BLOCK)).groupBy("file_name", "b").count()
    assert hot.agg(F.max("count")).first()[0] <= BLOCK


def test_running(cut):
    plain, layout, hot, small = cut
    for kw in ({}, {"exclusive": True}, {"reverse": True}, {"reverse": True, "exclusive": True}):
        values = {"s": ("sum", F.col("D")), "lo": ("min", F.col("D")), "hi": ("max", F.col("D"))}
        a, b = (O.running(d.select("file_name", "pos", "D"), l, values, **kw) for d, l in ((plain, layout), (hot, small)))
        same(a, b, ["file_name", "pos"])


def test_quantiles(cut):
    plain, layout, hot, small = cut
    probs = {"q0": 0.0, "q06": 0.06, "q5": 0.5, "q9": 0.9, "q1": 1.0}
    same(O.exact_quantiles(plain, layout, "D", probs), O.exact_quantiles(hot, small, "D", probs), ["file_name"])


def test_quantiles_have_the_same_bits(spark, cut):
    """Counted values and the percentile aggregate agree without tolerance, a group of one value included."""
    plain, layout, hot, small = cut
    wanted = {c: {f"{c}_{i}": p for i, p in enumerate((0.0, 0.06, 0.15, 1 / 3, 0.5, 0.66, 0.9, 1.0))} for c in ("D", "Pder", "time")}
    a, b = (rows(O.quantiles(d, l, wanted), ["file_name"]) for d, l in ((plain, layout), (hot, small)))
    assert a == b and len(a) > 10
    one = spark.createDataFrame([("a", 2.5, None)] * 60 + [("b", None, None), ("b", 1.0, None), ("b", 4.0, 3.0)], "file_name string, x double, y double")
    for block in (1_000_000, 5):
        found = rows(O.quantiles(one, O.measure(one, "file_name", "x", block), {"x": {"q": 0.25}, "y": {"m": 0.5}}), ["file_name"])
        assert {k: (r["q"], r["m"]) for k, r in found.items()} == {("a",): (2.5, None), ("b",): (1.75, 3.0)}
    counted = O.counted_values(one, O.measure(one, "file_name", "x", 5), ["x"])
    assert counted.where("file_name = 'a'").count() == 1


def test_summary_growth_bins(cut):
    plain, layout, hot, small = cut
    same(Q.summary(plain, layout, ["Pder", "D"]), Q.summary(hot, small, ["Pder", "D"]), ["file_name"])
    same(Q.growth(plain, layout, ["dP", "P"]), Q.growth(hot, small, ["dP", "P"]), ["file_name"])
    same(Q.bin_statistics(plain, layout, ["D"]), Q.bin_statistics(hot, small, ["D"]), ["file_name"])


def test_unit_slope_line(cut):
    plain, layout, hot, small = cut
    a, b = G.unit_slope_line(plain, layout), G.unit_slope_line(hot, small)
    assert a.where("wb_value is not null").count() > 0
    same(a, b, ["file_name"])


def test_slope_line(cut):
    plain, layout, hot, small = cut
    a, b = G.slope_line(plain, layout, -0.5), G.slope_line(hot, small, -0.5)
    assert a.where("value is not null").count() > 0
    same(a, b, ["file_name"])


def test_flat_parts(cut):
    def segments(d, layout):
        base = d.select("file_name", "pos", "n_rows", (F.floor(F.col("D") / 2000) * 0.002).alias("y"), F.col("time").alias("x"))
        base = Q.add_diffs(base, layout, ["y"]).withColumn("diff", F.coalesce("_d_y", F.lit(0.0)))
        flags = G.cancel_long_runs(G.flat_flags(base, layout), layout)
        return G.merge_segments(G.flag_segments(flags, layout), layout)

    plain, layout, hot, small = cut
    same(segments(plain, layout), segments(hot, small), ["file_name", "start"])


def test_features(cut):
    plain, layout, hot, small = cut
    same(A.long_features(plain, layout, ["D"], "pos"), A.long_features(hot, small, ["D"], "pos"), ["file_name", "kind"])


def test_panel_features(spark, sf):
    p = I.panel(spark, sf).select("inn_id", "week", "target", "trns_count_inp", "trn_ce_A")
    small = replace(I.PANEL_LAYOUT, block=60)
    for delta in (0, 1):
        a = P.panel_features(p, I.PANEL_LAYOUT, delta=delta)
        b = P.panel_features(p, small, delta=delta)
        same(a, b, ["inn_id", "week"])


def test_global_running(spark, sf):
    names = I.table(spark, sf, "customer").select("c_name", "c_nationkey").dropDuplicates(["c_name"])
    got = O.global_running(names, ["c_name"], {"place": F.lit(1), "sums": F.col("c_nationkey")}).toPandas().sort_values("c_name")
    assert got["place"].tolist() == list(range(len(got)))
    assert got["sums"].tolist() == [0, *got["c_nationkey"].cumsum().tolist()[:-1]]
    empty = O.global_running(names.where("false"), ["c_name"], {"place": F.lit(1)})
    assert empty.count() == 0
