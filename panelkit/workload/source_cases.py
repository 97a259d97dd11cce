"""Checked queries over readers and sinks: a table is written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelkit.operators import ensemble as E
from panelkit.operators.labels import SHORT_FLAGS
from panelkit.operators.ordered import POS, measure, number_rows
from panelkit.session import shared_dir
from panelkit.sources import tables as R
from panelkit.sources.series_files import read_series_files, write_series_files
from panelkit.workload import inputs as I
from panelkit.workload.inputs import r, tidy, with_inputs


def _folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def calendar_csv(spark, sf):
    path = R.write_csv(I.order_days(spark, sf), _folder(spark, "calendar"))
    return R.read_calendar(spark, path)


def holidays_csv(spark, sf):
    """Shipping days written as dd.MM.yyyy behind a semicolon."""
    d = I.order_days(spark, sf).select(F.date_format("date", "dd.MM.yyyy").alias("HOLIDAY"), "week")
    path = R.write_csv(d, _folder(spark, "holidays"), sep=";")
    return R.read_holidays(spark, path)


def template_csv(spark, sf):
    path = R.write_csv(I.template(spark, sf), _folder(spark, "template"))
    return R.read_template(spark, path)


def panel_parquet(spark, sf):
    p = I.panel(spark, sf).select("inn_id", F.col("week").cast("bigint").alias("week"), "target")
    return tidy(R.read_panel(spark, R.write_parquet(p, _folder(spark, "panel"))))


def _write_series(spark, sf):
    """One folder of headerless tab-separated files per series."""
    rows = I.raw_series(spark, sf).repartition("file_name").sortWithinPartitions("file_name", "ts", "event_id")
    rows = rows.select(F.col("file_name").alias("series"), "time", "dP", "Pder")
    return write_series_files(rows, "series", _folder(spark, "series"))


def series_files(spark, sf):
    """One folder of headerless tab-separated files per series; key and place of each row come from the files."""
    folder = _write_series(spark, sf)
    got = R.read_series(spark, folder, below=folder)
    key = F.regexp_extract("file_name", "series=([^/]+)/", 1).cast("long").alias("file_name")
    got = got.select(key, "split_start", "row_id", "time", "dP", "Pder")
    got = spark.read.parquet(R.write_parquet(got, _folder(spark, "series-rows")))  # the files are opened once, their rows read twice
    layout = measure(got, "file_name", ("split_start", "row_id"))
    placed = number_rows(got, layout).select("file_name", F.col(POS).cast("long").alias("place"), "time", "dP", "Pder")
    return tidy(placed)


def series_files_problems(spark, sf):
    """The same files read with their keys, beside an empty one and one without numbers; small pieces cut files at lines."""
    folder = _write_series(spark, sf)
    I.table(spark, sf, "region").where("false").select("r_name").write.text(f"{folder}/series=-1")
    I.table(spark, sf, "region").where("r_regionkey = 0").select("r_name").coalesce(1).write.text(f"{folder}/series=-2")
    got = read_series_files(spark, folder, task_bytes=1 << 14)
    key = F.regexp_extract("file_name", "series=([^/]+)/", 1).cast("long").alias("file_name")
    got = got.select(key, F.coalesce("start", F.lit(0)).alias("start"), F.coalesce("line", F.lit(0)).alias("line"), "time", "dP", "Pder", "problem")
    got = spark.read.parquet(R.write_parquet(got, _folder(spark, "series-rows")))  # the files are opened once, their rows read twice
    numbered = number_rows(got, measure(got, "file_name", ("start", "line")))
    return tidy(numbered.select("file_name", F.col(POS).cast("long").alias("place"), "time", "dP", "Pder", "problem"))


def fold_files(spark, sf):
    """One file set per run and fold, told apart by name."""
    folder = _folder(spark, "folds")
    f = I.fold_labels(spark, sf)
    paths = []
    for run, fold in sorted(tuple(r) for r in f.select("run", "fold").distinct().collect()):
        part = f.where((F.col("run") == run) & (F.col("fold") == fold)).select("file_name", *SHORT_FLAGS)
        path = f"{folder}/cb_submit_{run:03d}_{fold}_local.csv"
        R.write_csv(part, path)
        paths.append(path)
    got = R.read_folds(spark, paths)
    return got.select(F.col("file_name").cast("bigint").alias("file_name"), "run", "fold", *SHORT_FLAGS)


def materialized(spark, sf):
    """The second call reads what the first one wrote: its builder would fail."""
    path = _folder(spark, "built")
    R.materialize(spark, path, lambda: I.panel(spark, sf).select("inn_id", "week", "target"))

    def fail():
        raise AssertionError("built twice")

    return tidy(R.materialize(spark, path, fail))


def rebuilt(spark, sf):
    """A rebuild that fails half-way leaves the table of the rebuild before it."""
    path = _folder(spark, "rebuilt")
    panel = I.panel(spark, sf).select("inn_id", "week", "target")
    R.materialize(spark, path, lambda: panel.where("week < 100"))
    R.materialize(spark, path, lambda: panel, remake=True)
    broken = panel.withColumn("target", F.when(F.col("week") > 50, F.raise_error(F.lit("lost"))).otherwise(F.col("target")))
    try:
        R.materialize(spark, path, lambda: broken, remake=True)
    except Exception as e:
        if "lost" not in str(e):
            raise
    return tidy(R.materialize(spark, path, lambda: broken))


def sorted_panel(spark, sf):
    """Rows in the order of entity, then latest week, with their place in the whole order."""
    p = I.panel(spark, sf).select("inn_id", F.col("week").cast("bigint").alias("week"), "target")
    path = R.write_sorted(p, _folder(spark, "sorted"), ["inn_id", "week"], descending=["week"])
    return tidy(R.read_sorted(spark, path))


def bucketed_panel(spark, sf):
    """A window over a table stored by its key: the previous row of each entity, without a shuffle."""
    p = I.panel(spark, sf).select("inn_id", F.col("week").cast("bigint").alias("week"), "target")
    name = f"bucketed_{uuid.uuid4().hex}"
    stored = R.write_bucketed(p, name, _folder(spark, "bucketed"), ["inn_id"], ["week"], buckets=16)
    w = Window.partitionBy("inn_id").orderBy("week")
    return tidy(stored.select("inn_id", "week", "target", F.lag("target").over(w).alias("before")))


def run_log(spark, sf):
    """Two appended sets of score rows, then those of the latest run."""
    path = _folder(spark, "log")
    for run in (7, 12):
        rows = I.folds(spark, sf).groupBy("fold").agg(F.lit(run).alias("num"), F.avg("bq").alias("mdl_score"))
        E.log_scores(rows.select("num", "fold", "mdl_score"), path)
    log = spark.read.parquet(path)
    return log.groupBy("num").agg(F.count(F.lit(1)).alias("n")).join(E.latest_run(log), "num")


def universe(spark, sf):
    keys = I.table(spark, sf, "labels").select(F.col("doc_id").alias("file_name"))
    return R.series_universe([keys, I.raw_series(spark, sf)])


CASES = {
    "calendar_csv": (calendar_csv, with_inputs("SELECT * FROM order_days", "order_days")),
    "holidays_csv": (holidays_csv, with_inputs("SELECT date FROM order_days", "order_days")),
    "template_csv": (template_csv, with_inputs("SELECT * FROM template", "template")),
    "panel_parquet": (panel_parquet, with_inputs("SELECT inn_id, week, target FROM panel", "panel")),
    "series_files_problems": (
        series_files_problems,
        with_inputs(
            f"""SELECT file_name, pos AS place, {r('T', 'time')}, {r('P', 'dP')}, {r('D', 'Pder')}, CAST(NULL AS VARCHAR) AS problem FROM raw_series
UNION ALL SELECT -1, 0, NULL, NULL, NULL, 'empty' UNION ALL SELECT -2, 0, NULL, NULL, NULL, NULL""",
            "raw_series",
        ),
    ),
    "series_files": (
        series_files,
        with_inputs(
            f"SELECT file_name, pos AS place, {r('T', 'time')}, {r('P', 'dP')}, {r('D', 'Pder')} FROM raw_series", "raw_series"
        ),
    ),
    "fold_files": (
        fold_files,
        with_inputs(
            "SELECT file_name, run, fold, " + ", ".join(SHORT_FLAGS) + " FROM fold_labels",
            "fold_labels",
        ),
    ),
    "materialized": (materialized, with_inputs("SELECT inn_id, week, target FROM panel", "panel")),
    "rebuilt": (rebuilt, with_inputs("SELECT inn_id, week, target FROM panel", "panel")),
    "sorted_panel": (
        sorted_panel,
        with_inputs("SELECT inn_id, week, target, row_number() OVER (ORDER BY inn_id, week DESC) - 1 AS row FROM panel", "panel"),
    ),
    "bucketed_panel": (
        bucketed_panel,
        with_inputs(f"SELECT inn_id, week, target, {r('lag(target) OVER (PARTITION BY inn_id ORDER BY week)', 'before')} FROM panel", "panel"),
    ),
    "run_log": (
        run_log,
        with_inputs(
            "SELECT 12 AS num, count(DISTINCT fold) AS n FROM folds",
            "folds",
        ),
    ),
    "series_universe": (universe, "SELECT doc_id AS file_name FROM labels UNION SELECT user_id FROM events"),
}
