"""Edge rows worked out by hand, plan shapes, and readers on real files."""

import math
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import ensemble as E
from panelkit.operators import labels as B
from panelkit.operators import metrics as M
from panelkit.operators import panel as P
from panelkit.operators import profile as R
from panelkit.operators import ratios as X
from panelkit.operators import schema as H
from panelkit.operators import series as Q
from panelkit.operators.joins import join_small
from panelkit.operators.ordered import Layout, measure, number_rows
from panelkit.plans import panel_pipeline as L
from panelkit.plans import series_pipeline as T
from panelkit.sources import series_files as SF
from panelkit.sources import tables as D
from panelkit.workload import inputs as I

NAN, INF = float("nan"), float("inf")


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_logs_and_guards(spark):
    df = spark.createDataFrame([(100.0,), (0.0,), (-1.0,), (None,), (NAN,)], "x double")
    assert column(df.limit(4), S.log10(F.col("x"))) == [2.0, -INF, None, None]
    assert column(df, S.zero_if_missing(F.col("x"))) == [100.0, 0.0, -1.0, 0.0, 0.0]
    assert column(df, S.no_nan(F.col("x")))[4] is None
    assert column(df.limit(3), S.log1p(F.col("x")))[1:] == [0.0, -INF]


def test_age_edges(spark):
    df = spark.createDataFrame([(17.0,), (18.0,), (18.5,), (65.0,), (66.0,), (NAN,), (None,)], "x double")
    assert column(df, S.edges_below(F.col("x"))) == [0, 0, 1, 5, 6, 0, 0]


def test_recode(spark):
    df = spark.createDataFrame([("1m",), ("more_12y",), ("other",), (None,)], "x string")
    assert column(df, S.recode(F.col("x"), S.AGE_MONTHS, F.lit(0))) == [1, 192, 0, 0]
    assert column(df, S.recode(F.col("x"), {"1m": "0"})) == ["0", "more_12y", "other", None]


def test_lookalikes(spark):
    df = spark.createDataFrame([("МОСКВА x",), ("MOCKBA X",)], "t string")
    assert len(set(column(df, S.fold_lookalikes(F.col("t"))))) == 1
    assert column(df, S.lookalike_pattern(F.col("t")))[1].startswith("[МM][ОO][СC][КK][ВB][АA] [ХX]")


def test_week_quarter(spark):
    df = spark.createDataFrame([(date(2021, 3, 28),), (date(2021, 3, 29),), (date(2021, 12, 31),)], "d date")
    assert column(df, S.week_quarter(F.col("d"))) == [1, 2, 1]


def test_names():
    assert H.clean_name("Sum(A.1_2)") == "sum_a_12"
    assert H.clean_name("Sum(A.1_2)", join_digits=False) == "sum_a_1_2"
    assert H.clean_feature_name('dP__quantile__q_0.1') == "dP_quantile_q_0_1"
    assert H.clean_feature_name("x__r_0.30000000000000004") == "x_r_0_3"


def test_name_collision(spark):
    df = spark.range(1).selectExpr("id AS `a.b`", "id AS a_b")
    with pytest.raises(ValueError):
        H.rename_columns(df, H.clean_name)


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, None, 5.0, "a", NAN), (1, None, None, "b", 2.0)], "one int, none int, five double, s string, n double")
    assert H.constant_columns(df) == ["one", "five", "n"]


@pytest.mark.parametrize(
    "top,unsigned,signed",
    [(126, "tinyint", "tinyint"), (127, "tinyint", "smallint"), (128, "smallint", "smallint"), (255, "smallint", "smallint"),
     (256, "smallint", "smallint"), (32767, "smallint", "int"), (65535, "int", "int"), (2**31, "bigint", "bigint")],
)
def test_narrowing(spark, top, unsigned, signed):
    df = spark.createDataFrame([(0,), (top,)], "x bigint")
    assert H.narrowed_types(df, "unsigned")["x"] == unsigned
    assert H.narrowed_types(df, "signed")["x"] == signed
    assert [r.x for r in H.narrow_types(df).collect()] == [0, top]


def test_narrowing_leaves_the_rest(spark):
    df = spark.createDataFrame([(1e39, None, "a", date(2020, 1, 1), 1.5, 7)], "big double, none int, s string, d date, f double, keep bigint")
    got = dict(H.narrow_types(df, exclude=["keep"]).dtypes)
    assert got == {"big": "double", "none": "int", "s": "string", "d": "date", "f": "float", "keep": "bigint"}


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "c string")
    assert sorted((r.c or "", r.c_code) for r in H.category_codes(df, ["c"]).collect()) == [("", -1), ("a", 0), ("b", 1), ("b", 1)]


def panel(spark, rows):
    return spark.createDataFrame(rows, "inn_id bigint, week int, target double")


def test_panel_gap_and_single_week(spark):
    p = panel(spark, [(1, 1, 10.0), (1, 2, 20.0), (1, 9, 40.0), (2, 5, 7.0)])
    rows = {(r.inn_id, r.week): r for r in P.panel_features(p, shift_total=2, w_size=5).collect()}
    assert (rows[1, 9].target_shift01, rows[1, 9].target_shift02) == (20.0, 10.0)
    assert (rows[1, 9].target_rmen04, rows[1, 9].target_rmed12, rows[1, 9].target_diff02) == (15.0, 15.0, 30.0)
    assert rows[2, 5].target_shift01 is None and rows[2, 5].target_rmen04 is None


def test_scoring_shift_is_next_training_shift(spark, sf):
    """delta 0 at a row equals delta 1 at the next one, and the bounded scoring equals the full one."""
    p = I.panel(spark, sf).select("inn_id", "week", "target")
    lay = I.PANEL_LAYOUT
    zero = P.panel_features(p, lay, delta=0)
    names = [c for c in zero.columns if "shift" in c or "rmen" in c or "rmed" in c]
    one = P.panel_features(p, lay, delta=1)
    w = lay.window()
    ahead = one.select("inn_id", "week", *[F.lead(c).over(w).alias(c) for c in names], F.lead("week").over(w).alias("nxt"))
    a = zero.select("inn_id", "week", *names).join(ahead.where("nxt is not null").select("inn_id", "week"), ["inn_id", "week"], "left_semi")
    b = ahead.where("nxt is not null").select("inn_id", "week", *names)
    assert a.count() > 0 and a.exceptAll(b).isEmpty()
    last = P.last_row(zero, "inn_id", ["week"])
    assert last.exceptAll(P.scoring_features(p, lay)).isEmpty()


def test_leak_safe(spark):
    p = panel(spark, [(1, w, float(w * w)) for w in range(1, 6)])
    got = {r.week: r.target_diff01 for r in P.panel_features(p, leak_safe=True).collect()}
    assert got == {1: None, 2: None, 3: 3.0, 4: 5.0, 5: 7.0}


def test_one_exchange_per_entity(spark):
    p = spark.range(100).selectExpr("id % 7 AS inn_id", "cast(id AS int) AS week", "cast(id AS double) AS target", "id AS trns_count")
    plan = P.panel_features(p, Layout(("inn_id",), ("week",), 15))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_profiles_on_the_same_day(spark):
    rows = [(1, "ip", None, "g", "1m", date(2020, 1, 1)), (1, "ul", "r", None, None, date(2020, 1, 1))]
    cols = "inn_id bigint, ipul string, id_region string, main_okved_group string, diff_datopen_report_date_flg string, report_date date"
    ids = spark.createDataFrame([(1,)], "inn_id bigint")
    got = [R.latest_profile(spark.createDataFrame(x, cols), ids).first() for x in (rows, rows[::-1])]
    assert got[0] == got[1] and got[0].ipul == "1" and got[0].main_okved_group == "-"


def test_small_join_has_another_way(spark):
    a, b = spark.range(10), spark.range(10).withColumn("x", F.lit(1))
    assert join_small(a, b, "id", limit=3).count() == join_small(a, b, "id").count() == 10
    assert "broadcast" in join_small(a, b, "id")._jdf.queryExecution().logical().toString()
    assert "broadcast" not in join_small(a, b, "id", limit=3)._jdf.queryExecution().logical().toString()


def points(spark, rows):
    df = spark.createDataFrame(rows, "file_name string, i int, time double, dP double, Pder double")
    return T.prepare_series(df, "i")


def test_series_edges(spark):
    rows = [("flat", i, float(i + 1), 5.0, 5.0) for i in range(6)]
    rows += [("rise", i, float(i + 1), float(i + 1) ** 2, 1.0) for i in range(6)]
    rows += [("fall", i, float(i + 1), float(40 - i * i), 0.0) for i in range(6)]
    rows += [("one", 0, 1.0, 2.0, -3.0), ("early", 0, -1.0, 1.0, 1.0)]
    s, layout = points(spark, rows)
    keys = spark.createDataFrame([(k,) for k in ("flat", "rise", "fall", "one", "early", "none")], "file_name string")
    got = {r.file_name: r for r in T.hand_features(s, layout, keys).collect()}
    assert {k: r.count_rows for k, r in got.items()} == {"flat": 6, "rise": 6, "fall": 6, "one": 1, "early": 0, "none": 0}
    assert (got["rise"].P_growth, got["fall"].P_growth, got["one"].P_growth) == (1, 0, 1)
    assert got["flat"].D_std == 0.0 and got["flat"].D_1_std == 0.0 and got["one"].D_std is None
    assert got["fall"].Pder_mean == -INF and got["fall"].Pder_std is None
    assert got["one"].Pder_mean is None and got["one"].D_mean == -3.0
    assert got["none"].time_std == 0.0 and got["none"].dP_std is None
    assert len(got["rise"]) == 261


def test_shuffled_input(spark, sf):
    raw = I.raw_series(spark, sf)
    a, la = T.prepare_series(raw, ("ts", "event_id"))
    b, lb = T.prepare_series(raw.orderBy(F.xxhash64("event_id")), ("ts", "event_id"))
    assert a.exceptAll(b).isEmpty()
    assert Q.growth(a, la, ["P"]).exceptAll(Q.growth(b, lb, ["P"])).isEmpty()


def test_backoff(spark):
    names = ["100000001", "100000001", "100000010", "11111", "11122", "01000", "01011", "222"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, labels string")
    got = {r.i: r.labels for r in B.back_off(df).collect()}
    assert got == {0: "100000001", 1: "100000001", 2: "1", 3: "111", 4: "111", 5: "010", 6: "010", 7: "2"}


def test_sample_is_repeatable(spark):
    df = spark.range(100)
    a, b = (B.sample_rows(x, 10, "id", 5).orderBy("id").collect() for x in (df, df.orderBy(F.desc("id"))))
    assert a == b and len(a) == 10


def test_auc_ties_and_single_class(spark):
    rows = [("a", 1, 0.5), ("a", 0, 0.5), ("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.3), ("b", 1, 0.4)]
    df = spark.createDataFrame(rows, "target string, y int, proba double")
    got = {r.target: r.auc for r in M.label_auc(df).collect()}
    assert got == {"a": 0.875, "b": None}
    row = M.auc_scores(df).first()
    assert row.auc_macro is None and math.isclose(row.auc_micro, (2 + 1.5 + 1 + 1) / 8)


def test_constant_target(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, pred double")
    assert (M.regression_scores(df).first().r2, M.regression_scores(df).first().explained_variance) == (1.0, 1.0)
    off = M.regression_scores(df.withColumn("pred", F.col("pred") + 1)).first()
    assert (off.r2, off.explained_variance) == (0.0, 1.0)


def test_back_transform(spark):
    df = spark.createDataFrame([(-1.0,), (math.log(3.0),), (1e6,), (NAN,)], "x double")
    a, b, c, d = column(df, M.back_transform(F.col("x")))
    assert (a, c, d) == (0.0, 0.0, None) and math.isclose(b, 2.0)


def test_hit_rate(spark):
    rows = [("p", 1, 1.0, 1.15 - 1e-9), ("p", 1, 1.0, None), ("q", 1, 10.0, 12.0), ("q", 1, 10.0, -1.0), ("q", 0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "target string, flag int, y double, pred double")
    assert M.hit_rate(df, ["p"]).first()[0] == 0.5
    assert M.hit_rate(df.where("flag = 9"), ["p"]).first()[0] == 0.0


def test_vote_tie(spark):
    df = spark.createDataFrame([("x", 1, 1), ("x", 2, 0), ("y", 1, 1), ("y", 2, 1)], "file_name string, fold int, bq int")
    assert {r.file_name: r.bq for r in E.ensemble_vote(df, ["bq"]).collect()} == {"x": 0, "y": 1}


def test_ratio_without_codes(spark):
    df = spark.createDataFrame([("h", "a", 3), ("h", "b", 1), ("g", "z", 5)], "url_host string, code string, rq_count bigint")
    got = {r.url_host: r for r in X.ratio_groups(df, "code", "rq", ["a", "b"]).collect()}
    assert (got["h"].rq_prs_a, got["h"].rq_avg_prs_b, got["g"].rq_prs_a, got["g"].rq_a_count) == (0.75, 0.25, 0.0, 0)


def test_series_files(spark, tmp_path):
    (tmp_path / "s1").write_text("0.5\t1\t2\n1.5\t3\t4\n-1\t9\t9\n")
    (tmp_path / "s2").write_text("2.5\t1\t1\nbroken\n")
    (tmp_path / "empty").write_text("")
    raw = D.read_series(spark, str(tmp_path))
    s, layout = T.prepare_series(raw, ("split_start", "row_id"))
    keys = spark.createDataFrame([("s1",), ("s2",), ("empty",)], "file_name string")
    assert sorted(map(tuple, Q.row_counts(s, keys).collect())) == [("empty", 0), ("s1", 2), ("s2", 1)]


def test_prediction_file_names(spark):
    names = [("cb_submit_062_local_reg.csv",), ("lg_submit_proba_1040_3_local.csv",), ("cb_submit_040_2.csv",), ("notes.csv",)]
    df = spark.createDataFrame(names, "p string")
    got = df.select(D.run_number(F.col("p")), D.fold_number(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(62, None), (1040, 3), (40, 2), (None, None)]


def test_materialize(spark, tmp_path):
    path = str(tmp_path / "t")
    assert D.materialize(spark, path, lambda: spark.range(3)).count() == 3
    assert D.materialize(spark, path, lambda: spark.range(5)).count() == 3
    assert D.materialize(spark, path, lambda: spark.range(5), remake=True).count() == 5


def test_a_failed_rebuild_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    D.materialize(spark, path, lambda: spark.range(3))
    opened = D.materialize(spark, path, lambda: spark.range(4), remake=True)
    with pytest.raises(Exception, match="lost"):
        D.materialize(spark, path, lambda: spark.range(9).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), remake=True)
    assert D.exists(spark, path) and D.materialize(spark, path, lambda: spark.range(9)).count() == 4
    assert D.materialize(spark, path, lambda: spark.range(6), remake=True).count() == 6
    assert opened.count() == 4  # a reader keeps the version before
    assert not D.exists(spark, str(tmp_path / "none"))


def test_sorted_and_bucketed_tables(spark, sf, tmp_path):
    p = I.panel(spark, sf).select("inn_id", "week", "target")
    got = D.read_sorted(spark, D.write_sorted(p, str(tmp_path / "s"), ["week", "inn_id"], descending=["week"])).toPandas()
    want = p.toPandas().sort_values(["week", "inn_id"], ascending=[False, True])
    got = got.sort_values("row")
    assert got.row.tolist() == list(range(len(want))) and got[["week", "inn_id"]].values.tolist() == want[["week", "inn_id"]].values.tolist()
    stored = D.write_bucketed(p, "bucketed_test", str(tmp_path / "b"), ["inn_id"], ["week"], buckets=8)
    framed = stored.withColumn("n", F.lag("target").over(Window.partitionBy("inn_id").orderBy("week")))
    assert "Exchange" not in framed._jdf.queryExecution().executedPlan().toString()
    assert framed.count() == len(want)
    spark.sql("DROP TABLE bucketed_test")


def test_only_the_submission_is_masked(spark):
    checked = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 4.0), ("b", 1.0, 1.0)], "target string, y double, pred double")
    submission = spark.createDataFrame([(1, 1, 0, 1, 7.0, 8.0)], "id int, f0 int, f1 int, f2 int, a double, b double")
    scores, masked = M.score_submission(checked, submission, ["a", "b"], ["f0", "f1", "f2"])
    assert scores.first().mae == pytest.approx(0.5)
    assert masked.select("a", "b").first() == (None, 8.0)


def test_panel_store_and_sample(spark, sf, tmp_path):
    data = L.load_panel(I.days(spark), I.holidays(spark), I.panel(spark, sf), I.profiles(spark, sf), I.template(spark, sf),
                        incoming=True, sample=3, sample_dir=str(tmp_path / "s"))
    train, test = L.panel_train_test(data, I.PANEL_LAYOUT, shift_total=4, store=str(tmp_path / "out"))
    assert train.select("inn_id").distinct().count() == 3
    assert dict(train.dtypes)["target_shift01"] == "float" and dict(test.dtypes)["workdays"] == "tinyint"
    assert D.read_template(spark, str(tmp_path / "s/sample_submit")).count() == test.count()


def test_numbering_is_one_window(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    layout = measure(df, "k", "v")
    assert layout.largest == 2 and not layout.hot
    assert sorted(map(tuple, number_rows(df, layout).collect())) == [("a", 1, 0, 2), ("a", 2, 1, 2), ("b", 5, 0, 1)]


def test_dictionary_reads_new_labels(spark, tmp_path):
    """A stored dictionary gives later rows the same codes; labels it lacks and NULL share the next one."""
    df = spark.createDataFrame([("b", 10, 0.0), ("a", 9, -0.0), (None, 100, 2.5), ("b", 9, None)], "s string, n int, x double")
    table = D.write_parquet(H.category_dictionary(df, ["s", "n", "x", "not_there"]), str(tmp_path / "codes"))
    codes = spark.read.parquet(table)
    assert {(r.column, r.value, r.code) for r in codes.collect()} == {
        ("s", "a", 0), ("s", "b", 1), ("n", "9", 0), ("n", "10", 1), ("n", "100", 2), ("x", "0.0", 0), ("x", "2.5", 1)
    }
    later = spark.createDataFrame([("b", 9), ("zz", 7), (None, 100)], "s string, n int")
    got = H.apply_categories(later, codes, ["s", "n"])
    assert sorted((str(r.s), r.n, r.s_code, r.n_code) for r in got.collect()) == [("None", 100, 2, 2), ("b", 9, 1, 0), ("zz", 7, 2, 3)]
    assert {r.s_code for r in H.apply_categories(later, codes, ["s"], unseen="none").collect()} == {1, -1}
    assert H.category_dictionary(df.where("false"), ["s"]).count() == 0


def test_samples_of_any_size(spark):
    """The histogram's cut takes the rows that a whole sort would take, and repeated keys up to the wanted number."""
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    by = df.orderBy(F.md5(F.concat("k", F.lit(":127"))), "k").select("k")
    for n in (0, 1, 70, 4999, 5000, 9000):
        got = {r.k for r in B.sample_rows(df, n, "k").collect()}
        assert got == {r.k for r in by.limit(n).collect()}
    same = df.select(F.lit("x").alias("k"), F.col("k").alias("v")).union(spark.createDataFrame([(None, "n")], "k string, v string"))
    assert B.sample_rows(same, 70, "k").count() == 70
    assert B.sample_keys(same, 9, "k").count() == 2


def test_pooled_auc_reads_ranges(spark):
    """The micro curve runs over ranges of scores: no window without a partition sees the scores."""
    rows = [(t, i % 3 == 0, (i * 37 % 101) / 100) for i in range(400) for t in ("a", "b")]
    df = spark.createDataFrame(rows, "target string, y boolean, proba double").withColumn("y", F.col("y").cast("int"))
    pos, neg = [p for _, y, p in rows if y], [p for _, y, p in rows if not y]
    want = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)
    assert abs(M.auc_scores(df).first()["auc_micro"] - want) < 1e-12


@pytest.mark.parametrize("task_bytes", [7, 64, 1 << 20])
def test_series_source_cuts_files_at_lines(spark, tmp_path, task_bytes):
    """Pieces of any size give every line once and in order; bad cells are NULL, empty and unreadable files give their key."""
    lines = [f"{i}.5\t{i}\t-{i}e-1" for i in range(40)]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.txt").write_text("\n".join(lines))
    (tmp_path / "b.txt").write_bytes(b"1\t2\t3\n\xff\xfe\tx\n\n4\tNaN\t6\t7\n")
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "_hidden").write_text("1\t2\t3")
    (tmp_path / "gone.txt").symlink_to(tmp_path / "nowhere")
    got = SF.read_series_files(spark, str(tmp_path), task_bytes).orderBy("file_name", "start", "line").collect()
    a = [(r.time, r.dP, r.Pder) for r in got if r.file_name == "sub/a.txt"]
    assert a == [(i + 0.5, float(i), float(f"-{i}e-1")) for i in range(40)]
    b = [(r.time, str(r.dP), r.Pder) for r in got if r.file_name == "b.txt"]
    assert b == [(1.0, "2.0", 3.0), (None, "None", None), (4.0, "nan", 6.0)]
    assert [(r.problem, r.start, r.time) for r in got if r.file_name == "empty.txt"] == [("empty", None, None)]
    assert {r.file_name for r in got} <= {"sub/a.txt", "b.txt", "empty.txt", "gone.txt"}


def test_an_unreadable_file_gives_its_key(tmp_path):
    reader = SF.SeriesReader(str(tmp_path), 1 << 20)
    gone = SF.Files([("gone.txt", str(tmp_path / "gone.txt"), 0, 10), ("none.txt", str(tmp_path / "none.txt"), 0, 0)])
    rows = [r for batch in reader.read(gone) for r in batch.to_pylist()]
    assert [(r["file_name"], r["problem"], r["line"]) for r in rows] == [("gone.txt", "FileNotFoundError", None), ("none.txt", "empty", None)]


def test_sketches_merge_like_sets(spark):
    """Sketches of overlapping parts estimate the union, within three standard errors; sets and rows of users give the same."""
    def part(a, b):
        return spark.range(a, b).select(F.lit("h").alias("url_host"), F.lit("x").alias("code"), F.col("id").alias("u"))

    stored = X.user_sketches(part(0, 30000), "code", "u").union(X.user_sketches(part(20000, 50000), "code", "u"))
    n = X.merge_sketches(stored, ["url_host"], "rq").first()["rq_user_estimate"]
    assert abs(n - 50000) < 50000 * 3 * 1.04 / 64
    sets = part(0, 300).groupBy("url_host", "code").agg(F.collect_list("u").alias("u"))
    assert X.merge_sketches(X.user_sketches(sets, "code", "u"), ["code"], "rq").first()["rq_user_estimate"] in range(297, 304)
    nobody = part(0, 3).withColumn("u", F.lit(None).cast("long"))
    assert X.user_sketches(nobody, "code", "u").count() == 0
