"""Steps that grew faster than their input: files per series, rounding, the panel's exchanges, wide selects, wide stored tables."""

import datetime
import math

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelkit.operators import panel as P
from panelkit.operators import schema as H
from panelkit.plans import panel_pipeline as L
from panelkit.session import WIDE_RESULTS
from panelkit.sources import series_files as SF
from panelkit.sources import tables as D
from panelkit.workload import inputs as I


def test_small_files_share_tasks(tmp_path):
    """A file is cut at ``task_bytes``; the pieces go into about as many tasks as asked for, each piece once."""
    for i in range(300):
        (tmp_path / f"s{i:03d}").write_text("1\t2\t3\n" * 20)
    parts = SF.SeriesReader(str(tmp_path), 100, 10).partitions()
    pieces = [p for part in parts for p in part.pieces]
    assert len(parts) <= 11 and len(pieces) == len(set(pieces)) == 600
    assert max(end - start for _, _, start, end in pieces) == 100


def test_series_writer_round_trip(spark, tmp_path):
    """One folder per key, rows in order, awkward numbers as Spark's own CSV reader takes them; nothing hidden is left."""
    odd = [(1, 0, 0.1, -0.0, 1e-300), (1, 1, math.inf, math.nan, None), (None, 0, 1.0, 2.0, 3.0), (-7, 0, -math.inf, 1e22, 5e-324)]
    long = [(2, i, float(i), i / 3, -float(i)) for i in range(3000)]
    df = spark.createDataFrame(odd + long, "k long, i int, time double, dP double, Pder double")
    rows = df.repartition(3, "k").sortWithinPartitions("k", "i").drop("i")
    folder = SF.write_series_files(rows, "k", str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"k=1", "k=2", "k=-7", f"k={SF.NO_KEY}"}
    assert all(p.name.startswith("part-") for p in (tmp_path / "out").glob("*/*"))
    assert [p.stat().st_size for p in (tmp_path / "out").glob("*/*") if not p.stat().st_size] == []
    want = sorted((str(k), str(a), str(b), str(c)) for k, _, a, b, c in odd + long)
    plain = spark.read.schema("time double, dP double, Pder double, k string").option("sep", "\t").csv(folder)
    assert sorted((str(r.k), str(r.time), str(r.dP), str(r.Pder)) for r in plain.collect()) == want
    own = SF.read_series_files(spark, folder, 1 << 10).where("file_name like 'k=2/%'").orderBy("start", "line").collect()
    assert [(r.time, r.dP, r.Pder) for r in own] == [t[2:] for t in long]


def test_rounding_is_that_of_round(spark):
    """Halves, whole numbers, large, small and special values: the same doubles as ``round``."""
    odd = [0.5e-6, -0.5e-6, 2.5e-6, 1.0000005, 1.0000015, -1e-9, -0.0, 1e308, math.inf, -math.inf, math.nan, None, 123456789012.5, 4503599627370497.5]
    made = spark.range(20000).select(((F.rand(1) - 0.5) * F.pow(F.lit(10.0), F.rand(2) * 24 - 9)).alias("x"))
    df = made.union(made.select(F.floor("x") / 2e6)).union(spark.createDataFrame([(v,) for v in odd], "x double"))
    other = df.where(f"NOT (({I.rounded('x', 6)} + 0D) <=> (round(x, 6) + 0D) AND ({I.rounded('x', 3)} + 0D) <=> (round(x, 3) + 0D))")
    assert other.count() == 0


def test_the_panel_sends_its_rows_once(spark, sf):
    plan = I.panel(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_wide_selects_are_compiled(spark, sf):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    P.class_shift_features(I.panel(spark, sf), I.PANEL_LAYOUT)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_stored_ranges_by_groups(spark, tmp_path):
    """Groups of columns give the ranges of one aggregate; empty columns, NaN, infinities and whole numbers included."""
    x = F.col("id").cast("double")
    odd = {"nan": F.when(x == 3, math.nan).otherwise(x), "none": F.lit(None).cast("double"), "inf": F.when(x == 5, math.inf).otherwise(-x)}
    many = {f"c{i}": F.col("id") * (i - 30) for i in range(60)}
    made = spark.range(50).select("id", *[e.alias(n) for n, e in (odd | many).items()])
    df = spark.read.parquet(D.write_parquet(made, str(tmp_path / "t")))
    whole = H.column_ranges(df, df.columns)
    assert H.column_ranges(df, df.columns, 7) == whole and whole["nan"] == (0.0, 49.0) and whole["none"] == (None, None)
    assert H.narrowed_types(df, stored=True) == H.narrowed_types(df)


def test_large_dictionaries_are_left_early(spark, tmp_path):
    """A column with many distinct values is written plainly, one with few keeps its dictionary; the rows stay."""
    made = spark.range(20000, numPartitions=1).select((F.col("id") % 5000 / 7).alias("many"), (F.col("id") % 10).alias("few"))
    path = D.write_parquet(made, str(tmp_path / "t"))
    group = pq.ParquetFile(next((tmp_path / "t").glob("*.parquet"))).metadata.row_group(0)
    uses = {c.path_in_schema: any("DICT" in e for e in c.encodings) for c in (group.column(0), group.column(1))}
    assert uses == {"many": False, "few": True}
    assert spark.read.parquet(path).exceptAll(made).count() == 0 and spark.read.parquet(path).count() == 20000


def _panel_data(spark):
    """Two entities of 30 weeks; the second has no profile, and its last weeks are not in the calendar."""
    rows = [(e, w, 100.0 * e + w, 10.0 * w, w % 7, w % 3) for e in (1, 2) for w in range(25 + 5 * e)]
    panel = spark.createDataFrame(rows, "inn_id long, week int, target double, trns_amount_inp double, trns_count_inp long, cnt_inn_inp long")
    days = spark.range(30 * 7).select(F.expr("date_add(DATE'2021-01-04', cast(id as int))").alias("date"), F.floor(F.col("id") / 7).cast("int").alias("week"))
    day = datetime.date(2021, 1, 1)
    schema = "inn_id long, ipul string, id_region string, main_okved_group string, diff_datopen_report_date_flg string, report_date date"
    profiles = spark.createDataFrame([(1, "ip", "A", None, "2_4y", day)], schema)
    template = spark.createDataFrame([(1, 29, 0.0), (2, 29, 0.0)], "inn_id long, week int, predict double")
    holidays = spark.createDataFrame([(day,)], "date date")
    return L.load_panel(days, holidays, panel, profiles, template, incoming=True)


def test_training_rows_are_joined_before_they_are_wide(spark):
    train, test = L.panel_train_test(_panel_data(spark), P.Layout(("inn_id",), ("week",), 40), narrow=False)
    plan = train._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") and plan.index("Window [") < plan.index("Join")
    got = {(r.inn_id, r.week): r for r in train.collect()}
    assert sorted(got) == [(1, w) for w in range(24, 30)] + [(2, w) for w in range(24, 35)]
    assert [got[k].main_okved_group for k in ((1, 24), (2, 24))] == ["-", None] and got[1, 24].diff_datopen_report_date_flg == 48
    assert (got[2, 29].workdays, got[2, 29].weekends, got[2, 30].workdays) == (7, 0, None)
    assert math.isclose(got[2, 30].target_shift24, math.log1p(206.0)) and not any("workdays_" in c or "ipul_" in c for c in train.columns)
    assert train.columns[:3] == ["inn_id", "week", "target"] and train.columns[-4:] == test.columns[-4:]


def test_wide_results_are_packed(spark, sf, tmp_path):
    """The session's files of wide results are written with zstd and small dictionaries, unless the session says otherwise."""
    panel = I.panel(spark, sf)
    before = {k: spark.conf.get(k, None) for k in WIDE_RESULTS if k in spark.conf.getAll}
    try:
        for k in WIDE_RESULTS:
            spark.conf.unset(k)
        panel.write.parquet(str(tmp_path / "plain"))
        spark.conf.set("parquet.dictionary.page.size", "4096")
        P.panel_features(panel, I.PANEL_LAYOUT)
        assert spark.conf.get("parquet.dictionary.page.size") == "4096"
        panel.write.parquet(str(tmp_path / "packed"))
        used = {n: {pq.ParquetFile(f).metadata.row_group(0).column(2).compression for f in (tmp_path / n).glob("*.parquet")} for n in ("plain", "packed")}
        assert used == {"plain": {"SNAPPY"}, "packed": {"ZSTD"}}
    finally:
        for k in WIDE_RESULTS:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_panel_sends_short_rows(spark, tmp_path):
    """Missing and other flags, missing prices and discounts: the sums of the rows as they are; no text is sent."""
    day = datetime.date(1995, 1, 2)
    rows = [(1, 5, "A", "F", 10.0, 0.05), (1, 5, "N", "O", 20.5, 0.1), (1, 6, None, None, 1.0, None), (1, None, "X", "F", None, 0.1), (2, 7, "R", "O", 3.33, 0.07)]
    schema = "l_suppkey long, l_partkey long, l_returnflag string, l_linestatus string, l_extendedprice double, l_discount double, l_shipdate date"
    spark.createDataFrame([(*r, day) for r in rows] + [(1, 5, "A", "F", 1.0, 0.0, day + datetime.timedelta(7))], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    panel = I.panel(spark, str(tmp_path))
    got = {(r.inn_id, r.week): tuple(r)[2:] for r in panel.collect()}
    assert panel.columns[2:] == ["target", "trns_amount_inp", "trns_count_inp", "cnt_inn_inp", "trn_ce_A", "trn_ce_N", "trn_ce_R", "tvect_F", "tvect_O"]
    assert got == {
        (1, 0): (3150.0, 950.0 + 1845.0, 4, 2, 1000.0, 2050.0, 0.0, 2, 1),
        (1, 1): (100.0, 100.0, 1, 1, 100.0, 0.0, 0.0, 1, 0),
        (2, 0): (333.0, 310.0, 1, 1, 0.0, 0.0, 333.0, 0, 1),
    }
    plan = panel._jdf.queryExecution().executedPlan().toString()
    sent = plan[plan.index("Exchange hashpartitioning") :].splitlines()[1]
    assert "l_returnflag" not in sent.split("[")[1].split(" AS ")[0] and "_flags" in sent


@pytest.mark.parametrize("opts", [{}, {"leak_safe": True, "shift_start": 3, "shift_total": 8, "w_size": 5}])
def test_stored_training_table_holds_a_value_once(spark, tmp_path, opts):
    """The stored table has a value's window as one array; all columns that are laid out of it are those of the plan."""
    data, layout, folder = _panel_data(spark), P.Layout(("inn_id",), ("week",), 40), str(tmp_path / "store")
    plain, plain_test = L.panel_train_test(data, layout, narrow=False, **opts)
    train, test = L.panel_train_test(data, layout, narrow=False, store=folder, **opts)
    assert train.schema.simpleString() == plain.schema.simpleString() and test.dtypes == plain_test.dtypes
    assert plain.count() == train.count() > 0 and plain.exceptAll(train).count() == 0 == test.exceptAll(plain_test).count()
    kept = spark.read.parquet(f"{folder}/train/v1")
    assert len(kept.columns) < 50 < len(train.columns) and dict(kept.dtypes)["_lags_target"] == "array<double>"
    assert H.narrowed_types(train, stored=True) == H.narrowed_types(plain)


def test_stored_training_table_is_small(spark, tmp_path):
    """Rows that follow one another share nearly all of their windows; the file holds a value about once."""
    x = F.xxhash64("inn_id", "week").cast("double") / 7
    made = spark.range(6000, numPartitions=1).select((F.col("id") / 300).cast("long").alias("inn_id"), (F.col("id") % 300).cast("int").alias("week"))
    frames = P.panel_frames(made.withColumn("target", x), P.Layout(("inn_id",), ("week",), 300), full="target")
    sizes = [sum(p.stat().st_size for p in (tmp_path / n).glob("*.parquet")) for n, df in (("wide", frames.features()), ("packed", frames.packed())) if D.write_parquet(df, str(tmp_path / n))]
    assert 3 * sizes[1] < sizes[0]
