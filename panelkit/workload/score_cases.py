"""Checked queries over prediction tables: metrics, clean-up and ensembles."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import ensemble as E
from panelkit.operators import metrics as M
from panelkit.operators.labels import SHORT_FLAGS
from panelkit.workload import inputs as I
from panelkit.workload.inputs import r, tidy, with_inputs

EXCLUDED = {40: [2], 41: [1, 5]}


# -------------------------------------------------------------------------------------------- queries


def _scaled(spark, sf):
    """Targets in units of ten thousand, so that squares keep all digits."""
    return I.predictions(spark, sf).select("inn_id", "week", (F.col("y") / 1e6).alias("y"), (F.col("pred") / 1e6).alias("pred"))


def regression_scores(spark, sf):
    return tidy(M.regression_scores(_scaled(spark, sf)))


def regression_by_entity(spark, sf):
    return tidy(M.regression_scores(_scaled(spark, sf), ["inn_id"]))


def score_regression(spark, sf):
    p = _scaled(spark, sf).select(F.log1p("y").alias("y"), (F.log1p("pred") - 0.05).alias("pred"))
    return tidy(M.score_regression(p))


def multi_output_scores(spark, sf):
    return tidy(M.score_multi_regression(I.multi_predictions(spark, sf)))


def label_auc(spark, sf):
    return tidy(M.label_auc(I.long_flags(spark, sf)))


def auc_scores(spark, sf):
    return tidy(M.auc_scores(I.long_flags(spark, sf)))


def label_f1(spark, sf):
    t = I.long_flags(spark, sf).withColumn("pred", M.to_label(F.col("proba")))
    return tidy(M.label_f1(t))


def f1_scores(spark, sf):
    t = I.long_flags(spark, sf).withColumn("pred", M.to_label(F.col("proba")))
    return tidy(M.f1_scores(t))


def score_multilabel(spark, sf):
    return tidy(M.score_multilabel(I.long_flags(spark, sf)))


def hit_rate(spark, sf):
    t = I.multi_predictions(spark, sf).withColumn("flag", (F.col("week") % 4 != 0).cast("int"))
    return tidy(M.hit_rate(t, ["trns_count_inp"]))


def back_transform(spark, sf):
    p = _scaled(spark, sf).select("inn_id", "week", ((F.col("pred") - 3) / 4).alias("pred"), (F.col("pred") * 150).alias("big"))
    return tidy(p.select("inn_id", "week", M.back_transform(F.col("pred")).alias("pred"), (M.back_transform(F.col("big")) > 0).cast("int").alias("kept")), 3)


def to_label(spark, sf):
    t = I.long_flags(spark, sf)
    p = F.when(F.col("y") == 1, F.col("proba"))
    return t.select("file_name", "target", M.to_label(p).alias("label"))


def clean_sentinel(spark, sf):
    t = I.multi_predictions(spark, sf)
    return tidy(t.select("inn_id", "week", "target", M.clean_sentinel(F.col("y")).alias("y"), M.clean_sentinel(F.col("pred")).alias("pred")))


def mask_by_flags(spark, sf):
    t = I.flag_table(spark, sf)
    nums = [F.col("size").cast("double").alias(f"{c}_d") for c in SHORT_FLAGS[1:]]
    t = t.select("file_name", *SHORT_FLAGS, *nums)
    return tidy(M.mask_by_flags(t, [f"{c}_d" for c in SHORT_FLAGS[1:]], SHORT_FLAGS).drop(*SHORT_FLAGS))


def masked_submission(spark, sf):
    """The masked table that goes with the scores of the same call."""
    t = I.flag_table(spark, sf)
    names = [f"{c}_d" for c in SHORT_FLAGS[1:]]
    t = t.select("file_name", *SHORT_FLAGS, *[F.col("size").cast("double").alias(n) for n in names])
    scores, masked = M.score_submission(I.multi_predictions(spark, sf), t, names, SHORT_FLAGS)
    scores = scores.select("rmse", "mae", F.lit(0).alias("_k"))
    return tidy(masked.drop(*SHORT_FLAGS).withColumn("_k", F.lit(0)).join(scores, "_k").drop("_k"))


def join_runs(spark, sf):
    j = E.join_runs(I.run_predictions(spark, sf))
    return tidy(j.withColumn("predict", E.row_mean(["predict_1", "predict_2", "predict_3"])))


def ensemble_mean(spark, sf):
    return tidy(E.ensemble_mean(I.run_predictions(spark, sf)))


def fold_exclusion(spark, sf):
    return E.exclude_folds(I.fold_labels(spark, sf), EXCLUDED).select("file_name", "run", "fold", "bq")


def vote_mode(spark, sf):
    """Fold 1 left out: four votes per run, so ties occur."""
    f = E.exclude_folds(I.fold_labels(spark, sf), {40: [1], 41: [1]})
    return E.ensemble_vote(f, SHORT_FLAGS, "mode")


def vote_mean(spark, sf):
    t = ["bq_d", "wb_d"]
    f = I.folds(spark, sf).select("file_name", "run", "fold", F.col("bq").alias("bq_d"), F.col("wb").alias("wb_d"))
    return tidy(E.ensemble_vote(f, t, "mean"))


def vote_proba(spark, sf):
    return E.ensemble_vote(I.folds(spark, sf), SHORT_FLAGS, "proba")


def vote_excluded(spark, sf):
    return E.ensemble_vote(I.fold_labels(spark, sf), SHORT_FLAGS, "mode", excluded=EXCLUDED)


def latest_run(spark, sf):
    return E.latest_run(I.folds(spark, sf).select(F.col("run").alias("num")))


def latest_run_empty(spark, sf):
    return E.latest_run(I.folds(spark, sf).where("run > 1000").select(F.col("run").alias("num")))


def by_importance(spark, sf):
    t = I.flag_table(spark, sf).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v")) for c in SHORT_FLAGS])).alias("f")
    )
    t = t.groupBy("f.feature").agg(F.avg("f.v").alias("importance"))
    ranked = E.by_importance(t)
    return tidy(ranked)


# -------------------------------------------------------------------------------------------- SQL

SCALED = {"scaled": "SELECT inn_id, week, y / 1e6::DOUBLE AS y, pred / 1e6::DOUBLE AS pred FROM predictions"}


def _scores(y="y", p="pred"):
    return [
        r(f"sqrt(avg(({y} - {p}) * ({y} - {p})))", "rmse"),
        r(f"avg(({y} - {p}) * ({y} - {p}))", "mse"),
        r(f"avg(abs({y} - {p}))", "mae"),
        r(f"1 - avg(({y} - {p}) * ({y} - {p})) / var_pop({y})", "r2"),
        r(f"avg(pow(ln(1 + {y}) - ln(1 + {p}), 2))", "msle"),
        r(f"1 - var_pop({y} - {p}) / var_pop({y})", "explained_variance"),
    ]


# Area under the curve by its definition: share of (positive, negative) pairs in the right order, ties at half.
PAIRS = {
    "sc": "SELECT target, proba, count(*) FILTER (y = 1) AS np, count(*) FILTER (y = 0) AS nn FROM long_flags GROUP BY 1, 2",
    "per": """SELECT p.target, sum(p.np * n.nn * CASE WHEN p.proba > n.proba THEN 1.0 WHEN p.proba = n.proba THEN 0.5 ELSE 0 END)
  ::DOUBLE / nullif(sum(p.np * n.nn), 0) AS auc FROM sc p JOIN sc n USING (target) GROUP BY 1""",
    "pos": "SELECT target, count(*) FILTER (y = 1) AS positives FROM long_flags GROUP BY 1",
    "al": "SELECT proba, sum(np) AS np, sum(nn) AS nn FROM sc GROUP BY 1",
    "micro": """SELECT sum(p.np * n.nn * CASE WHEN p.proba > n.proba THEN 1.0 WHEN p.proba = n.proba THEN 0.5 ELSE 0 END)
  ::DOUBLE / sum(p.np * n.nn) AS v FROM al p CROSS JOIN al n""",
    "macro": "SELECT avg(auc) AS a, sum(auc * positives) / sum(positives) AS w FROM per JOIN pos USING (target)",
}
F1 = {
    "cf": """SELECT target, count(*) FILTER (y = 1 AND proba > 0.5) AS tp, count(*) FILTER (y <> 1 AND proba > 0.5) AS fp,
  count(*) FILTER (y = 1 AND proba <= 0.5) AS fn FROM long_flags GROUP BY 1""",
    "f1": "SELECT *, coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM cf",
}
F1_COLS = ", ".join(
    [
        r("avg(f1)", "f1_macro"),
        r("2.0::DOUBLE * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn))", "f1_micro"),
        r("sum(f1 * (tp + fn)) / sum(tp + fn)", "f1_weighted"),
    ]
)
AUC_COLS = ", ".join([r("a", "auc_macro"), r("w", "auc_weighted"), r("v", "auc_micro")])

CLEAN = {"clean": "SELECT target, CASE WHEN y < -33 THEN 0 ELSE y END AS y, CASE WHEN pred < -33 THEN 0 ELSE pred END AS pred FROM multi"}
MULTI = CLEAN | {
    "per": """SELECT target, avg((y - pred) * (y - pred)) AS mse, avg(abs(y - pred)) AS mae,
  1 - avg((y - pred) * (y - pred)) / var_pop(y) AS r2,
  avg(pow(ln(1 + greatest(y, 0)) - ln(1 + greatest(pred, 0)), 2)) AS msle,
  1 - var_pop(y - pred) / var_pop(y) AS ev FROM clean GROUP BY 1"""
}


def _mode_sql(cond):
    parts = []
    for c in SHORT_FLAGS:
        parts.append(
            f"(SELECT file_name, {c} FROM (SELECT file_name, {c}, row_number() OVER (PARTITION BY file_name ORDER BY count(*) DESC, {c}) AS rn "
            f"FROM kept GROUP BY file_name, {c}) WHERE rn = 1)"
        )
    joined = f"SELECT * FROM {parts[0]} " + " ".join(f"JOIN {p} USING (file_name)" for p in parts[1:])
    return with_inputs(joined, "fold_labels", extra={"kept": f"SELECT * FROM fold_labels WHERE {cond}"})


NOT_EXCLUDED = "NOT (run = 40 AND fold = 2) AND NOT (run = 41 AND fold IN (1, 5))"

CASES = {
    "regression_scores": (
        regression_scores,
        with_inputs("SELECT " + ", ".join(_scores()) + " FROM scaled", "predictions", extra=SCALED),
    ),
    "regression_by_entity": (
        regression_by_entity,
        with_inputs("SELECT inn_id, " + ", ".join(_scores()) + " FROM scaled GROUP BY inn_id", "predictions", extra=SCALED),
    ),
    "score_regression": (
        score_regression,
        with_inputs(
            "SELECT " + ", ".join(_scores()) + " FROM (SELECT exp(ln(1 + y)) - 1 AS y, greatest(exp(ln(1 + pred) - 0.05) - 1, 0) AS pred FROM scaled)",
            "predictions",
            extra=SCALED,
        ),
    ),
    "multi_output_scores": (
        multi_output_scores,
        with_inputs(
            "SELECT "
            + ", ".join(
                [r("sqrt(avg(mse))", "rmse"), r("avg(mse)", "mse"), r("avg(mae)", "mae"), r("avg(r2)", "r2"),
                 r("avg(msle)", "msle"), r("avg(ev)", "explained_variance")]
            )
            + " FROM per",
            "multi",
            extra=MULTI,
        ),
    ),
    "label_auc": (
        label_auc,
        with_inputs(f"SELECT target, {r('auc', 'auc')}, positives FROM per JOIN pos USING (target)", "long_flags", extra=PAIRS),
    ),
    "auc_scores": (auc_scores, with_inputs(f"SELECT {AUC_COLS} FROM macro, micro", "long_flags", extra=PAIRS)),
    "label_f1": (label_f1, with_inputs(f"SELECT target, tp, fp, fn, {r('f1', 'f1')} FROM f1", "long_flags", extra=F1)),
    "f1_scores": (f1_scores, with_inputs(f"SELECT {F1_COLS} FROM f1", "long_flags", extra=F1)),
    "score_multilabel": (
        score_multilabel,
        with_inputs(
            f"SELECT {AUC_COLS}, f.* FROM macro, micro, (SELECT {F1_COLS} FROM f1) f", "long_flags", extra=PAIRS | F1
        ),
    ),
    "hit_rate": (
        hit_rate,
        with_inputs(
            f"""SELECT {r('avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END)', 'hit_rate')} FROM (
SELECT CASE WHEN target = 'trns_count_inp' THEN abs(pred - y) <= 0.15
  WHEN pred <= 0 OR y <= 0 THEN false ELSE abs(log10(pred) - log10(y)) <= 0.15 END AS hit FROM multi WHERE week % 4 <> 0)""",
            "multi",
        ),
    ),
    "back_transform": (
        back_transform,
        with_inputs(
            f"""SELECT inn_id, week, {r('exp(greatest((pred - 3) / 4, 0)) - 1', 'pred', 3)},
CAST(pred * 150 < 709.78 AND pred > 0 AS INTEGER) AS kept FROM scaled""",
            "predictions",
            extra=SCALED,
        ),
    ),
    "to_label": (
        to_label,
        with_inputs("SELECT file_name, target, CAST(y = 1 AND proba > 0.5 AS INTEGER) AS label FROM long_flags", "long_flags"),
    ),
    "clean_sentinel": (
        clean_sentinel,
        with_inputs(
            f"""SELECT inn_id, week, target, {r('CASE WHEN y < -33 THEN 0 ELSE y END', 'y')},
{r('CASE WHEN pred < -33 THEN 0 ELSE pred END', 'pred')} FROM multi""",
            "multi",
        ),
    ),
    "mask_by_flags": (
        mask_by_flags,
        with_inputs(
            "SELECT file_name, "
            + ", ".join(f"CASE WHEN {c} <> 0 THEN CAST(size AS DOUBLE) END AS {c}_d" for c in SHORT_FLAGS[1:])
            + " FROM flags",
            "flags",
        ),
    ),
    "masked_submission": (
        masked_submission,
        with_inputs(
            "SELECT file_name, "
            + ", ".join(f"CASE WHEN {c} <> 0 THEN CAST(size AS DOUBLE) END AS {c}_d" for c in SHORT_FLAGS[1:])
            + f", s.rmse, s.mae FROM flags, (SELECT {r('sqrt(avg(mse))', 'rmse')}, {r('avg(mae)', 'mae')} FROM per) s",
            "flags",
            "multi",
            extra=MULTI,
        ),
    ),
    "join_runs": (
        join_runs,
        with_inputs(
            f"""SELECT inn_id, week, p1 AS predict_1, p2 AS predict_2, p3 AS predict_3, {r('(p1 + p2 + p3) / 3', 'predict')} FROM (
SELECT inn_id, week, max(CASE WHEN run = 1 THEN predict END) AS p1, max(CASE WHEN run = 2 THEN predict END) AS p2,
  max(CASE WHEN run = 3 THEN predict END) AS p3 FROM runs GROUP BY inn_id, week HAVING count(*) = 3)""",
            "runs",
        ),
    ),
    "ensemble_mean": (
        ensemble_mean,
        with_inputs(
            f"SELECT inn_id, week, {r('avg(predict)', 'predict')} FROM runs GROUP BY 1, 2 HAVING count(*) = 3", "runs"
        ),
    ),
    "fold_exclusion": (
        fold_exclusion,
        with_inputs(f"SELECT file_name, run, fold, bq FROM fold_labels WHERE {NOT_EXCLUDED}", "fold_labels"),
    ),
    "vote_mode": (vote_mode, _mode_sql("fold <> 1")),
    "vote_mean": (
        vote_mean,
        with_inputs(f"SELECT file_name, {r('avg(bq)', 'bq_d')}, {r('avg(wb)', 'wb_d')} FROM folds GROUP BY 1", "folds"),
    ),
    "vote_proba": (
        vote_proba,
        with_inputs(
            "SELECT file_name, " + ", ".join(f"CAST(sum(CAST(round({c} * 100) AS BIGINT)) >= 50 * count(*) AS INTEGER) AS {c}" for c in SHORT_FLAGS)
            + " FROM folds GROUP BY 1",
            "folds",
        ),
    ),
    "vote_excluded": (vote_excluded, _mode_sql(NOT_EXCLUDED)),
    "latest_run": (latest_run, with_inputs("SELECT max(run) AS num FROM folds", "folds")),
    "latest_run_empty": (latest_run_empty, with_inputs("SELECT coalesce(max(run), 0) AS num FROM folds WHERE run > 1000", "folds")),
    "by_importance": (
        by_importance,
        with_inputs(
            " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'avg({c})', 'importance')} FROM flags" for c in SHORT_FLAGS), "flags"
        ),
    ),
}
