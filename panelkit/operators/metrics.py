"""Scores of prediction tables. Every metric is an aggregate that combines before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators.ordered import POS, global_running, measure, number_rows, running

SENTINEL = -33.0
TOLERANCE = 0.15
THRESHOLD = 0.5
MEAN_METRICS = ("mse", "mae", "r2", "msle", "explained_variance")


def stack_columns(df: DataFrame, key: Sequence[str], names: Sequence[str], sides: dict[str, str]) -> DataFrame:
    """Long form: one row per key and name; ``sides`` maps an output column to the suffix of its source column."""
    rows = [F.struct(F.lit(n).alias("target"), *[F.col(n + sfx).alias(o) for o, sfx in sides.items()]) for n in names]
    return df.select(*key, F.explode(F.array(*rows)).alias("_r")).select(*key, "_r.*")


def regression_aggregates(y: str = "y", p: str = "pred", clip_log: bool = False) -> dict[str, Column]:
    """MSE, MAE, R2, mean squared log error, explained variance.

    A constant ``y`` scores 1 when the error (or its variance) is 0 and 0 otherwise.
    """
    a, b = F.col(y), F.col(p)
    err = a - b
    la, lb = (clip_at_zero(a), clip_at_zero(b)) if clip_log else (a, b)
    spread, left = F.var_pop(a), F.var_pop(err)
    square = F.avg(err * err)

    def against_spread(rest):
        exact = F.when(rest == 0, 1.0).otherwise(0.0)
        return F.when(spread == 0, exact).otherwise(1 - F.try_divide(rest, spread))

    return {
        "mse": square,
        "mae": F.avg(F.abs(err)),
        "r2": against_spread(square),
        "msle": F.avg(F.pow(S.log1p(la) - S.log1p(lb), 2)),
        "explained_variance": against_spread(left),
    }


def regression_scores(df: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "pred", clip_log: bool = False) -> DataFrame:
    aggs = regression_aggregates(y, p, clip_log)
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(*by, F.sqrt("mse").alias("rmse"), *aggs)


def multi_output_scores(df: DataFrame, target: str = "target", y: str = "y", p: str = "pred", clip_log: bool = True) -> DataFrame:
    """Plain mean over targets of each metric; RMSE is the root of the mean MSE."""
    per = regression_scores(df, [target], y, p, clip_log)
    return per.agg(F.sqrt(F.avg("mse")).alias("rmse"), *[F.avg(m).alias(m) for m in MEAN_METRICS])


def clip_at_zero(c: Column) -> Column:
    """Negative values become 0; a missing one stays missing (``greatest`` alone would skip it)."""
    return F.when(S.no_nan(c).isNotNull(), F.greatest(c, F.lit(0.0)))


def back_transform(c: Column) -> Column:
    """Clip at 0, undo log1p, infinities to 0. NaN stays missing."""
    v = F.expm1(clip_at_zero(c))
    return F.when(F.abs(v) == F.lit(S.INF), 0.0).otherwise(v)


def to_label(proba: Column) -> Column:
    """1 above 0.5; a missing probability counts as 0."""
    return (S.zero_if_missing(proba) > THRESHOLD).cast("int")


def clean_sentinel(c: Column) -> Column:
    """Values below -33 mark a missing one and become 0, as do NULL and NaN."""
    c = S.zero_if_missing(c)
    return F.when(c < SENTINEL, 0.0).otherwise(c)


def mask_by_flags(df: DataFrame, targets: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Target i becomes NULL where flag i + 1 is 0 (the first flag has no target)."""
    masked = {t: F.when(F.col(f) == 0, None).otherwise(F.col(t)) for t, f in zip(targets, flags[1:])}
    return df.withColumns(masked)


def to_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns if c in df.columns})


def _auc(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact AUC from (by, proba, pos_n, neg_n) rows: positives times the negatives below, ties at half."""
    if by:
        numbered = number_rows(counts, layout := measure(counts, by, "proba"))
        ranked = running(numbered, layout.by(POS), {"_below": ("sum", F.col("neg_n"))}, exclusive=True)
    else:
        ranked = global_running(counts, ["proba"], {"_below": F.col("neg_n")})
    wins = F.col("pos_n") * (F.coalesce("_below", F.lit(0)) + F.col("neg_n") / 2)
    sums = ranked.groupBy(*by).agg(F.sum(wins).alias("w"), F.sum("pos_n").alias("np"), F.sum("neg_n").alias("nn"))
    pairs = F.col("np").cast("double") * F.col("nn")
    return sums.select(*by, F.try_divide(F.col("w"), pairs).alias("auc"), F.col("np").alias("positives"))


def label_auc(df: DataFrame, label: str = "target", y: str = "y", proba: str = "proba") -> DataFrame:
    """ROC AUC per label; NULL when a label has one class only."""
    return _auc(_score_counts(df, [label], y, proba), [label])


def _score_counts(df: DataFrame, by: Sequence[str], y: str, proba: str) -> DataFrame:
    """Positives and negatives per distinct score: the rows that need sorting shrink to the distinct scores."""
    p = S.zero_if_missing(F.col(proba)).alias("proba")
    rows = df.select(*by, p, F.col(y).alias("y"))
    return rows.groupBy(*by, "proba").agg(F.count_if(F.col("y") == 1).alias("pos_n"), F.count_if(F.col("y") == 0).alias("neg_n"))


def auc_scores(df: DataFrame, label: str = "target", y: str = "y", proba: str = "proba") -> DataFrame:
    """Macro, micro and weighted ROC AUC in one row. A label with one class makes macro and weighted NULL.

    The rows are counted once, per label and score; the pooled counts add those up.
    """
    counts = _score_counts(df, [label], y, proba)
    per = _auc(counts, [label])
    undefined = F.count_if(F.col("auc").isNull()) > 0
    weighted = F.try_divide(F.sum(F.col("auc") * F.col("positives")), F.sum("positives"))
    both = per.agg(
        F.when(~undefined, F.avg("auc")).alias("auc_macro"), F.when(~undefined, weighted).alias("auc_weighted")
    )
    pooled = counts.groupBy("proba").agg(F.sum("pos_n").alias("pos_n"), F.sum("neg_n").alias("neg_n"))
    micro = _auc(pooled, []).select(F.col("auc").alias("auc_micro"))
    return both.withColumn("_k", F.lit(0)).join(micro.withColumn("_k", F.lit(0)), "_k", "full").drop("_k")


def label_f1(df: DataFrame, label: str = "target", y: str = "y", pred: str = "pred") -> DataFrame:
    """TP, FP, FN and F1 per label; 0 when nothing is positive."""
    a, b = F.col(y) == 1, F.col(pred) == 1
    out = df.groupBy(label).agg(
        F.count_if(a & b).alias("tp"), F.count_if(~a & b).alias("fp"), F.count_if(a & ~b).alias("fn")
    )
    return out.withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("fn")))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))


def f1_scores(df: DataFrame, label: str = "target", y: str = "y", pred: str = "pred") -> DataFrame:
    """Macro, micro and weighted F1 in one row."""
    per = label_f1(df, label, y, pred)
    support = F.col("tp") + F.col("fn")
    return per.agg(
        F.avg("f1").alias("f1_macro"),
        _f1(F.sum("tp"), F.sum("fp"), F.sum("fn")).alias("f1_micro"),
        F.coalesce(F.try_divide(F.sum(F.col("f1") * support), F.sum(support)), F.lit(0.0)).alias("f1_weighted"),
    )


def hit_rate(
    df: DataFrame, plain: Sequence[str], target: str = "target", flag: str = "flag", y: str = "y", p: str = "pred"
) -> DataFrame:
    """Share of rows with a true flag whose error is at most 0.15, over all targets together; 0 without such rows.

    Targets in ``plain`` compare values, the others their base-10 logs. A missing prediction is a miss.
    """
    a, b = F.col(y), F.col(p)
    absolute = F.abs(b - a) <= TOLERANCE
    in_logs = F.abs(S.log10(b) - S.log10(a)) <= TOLERANCE
    hit = F.when(F.col(target).isin(*plain), absolute).otherwise(in_logs)
    rows = df.where(F.col(flag) == 1).select((F.coalesce(hit, F.lit(False)) & ~F.isnan(b) & ~F.isnan(a)).alias("_h"))
    rate = F.try_divide(F.count_if("_h").cast("double"), F.count(F.lit(1)))
    return rows.agg(F.coalesce(rate, F.lit(0.0)).alias("hit_rate"))


def score_regression(df: DataFrame, y: str = "y", p: str = "pred", log_target: bool = True) -> DataFrame:
    """Scores of clipped predictions, both sides taken back from logs when ``log_target``."""
    pred = clip_at_zero(F.col(p).cast("double"))
    actual = F.col(y).cast("double")
    if log_target:
        pred = back_transform(F.col(p))
        actual = F.expm1(actual)
        actual = F.when(F.abs(actual) == F.lit(S.INF), 0.0).otherwise(actual)
    return regression_scores(df.select(actual.alias("y"), pred.alias("pred")))


def score_multilabel(df: DataFrame, label: str = "target", y: str = "y", proba: str = "proba") -> DataFrame:
    """AUC and F1, each macro, micro and weighted; labels come from the probabilities."""
    rows = df.withColumn("_pred", to_label(F.col(proba)))
    auc = auc_scores(rows, label, y, proba).withColumn("_k", F.lit(0))
    return auc.join(f1_scores(rows, label, y, "_pred").withColumn("_k", F.lit(0)), "_k").drop("_k")


def score_multi_regression(df: DataFrame, target: str = "target", y: str = "y", p: str = "pred") -> DataFrame:
    """Sentinels cleaned on both sides, then the plain mean over targets; logs clip negatives at 0."""
    rows = df.select(target, clean_sentinel(F.col(y)).alias("y"), clean_sentinel(F.col(p)).alias("pred"))
    return multi_output_scores(rows, target)


def score_submission(
    checked: DataFrame, submission: DataFrame, targets: Sequence[str], flags: Sequence[str], target: str = "target"
) -> tuple[DataFrame, DataFrame]:
    """Scores of the checked rows, and the submission with the targets of false flags emptied.

    The scores see all predictions: only the table that is handed on is masked.
    """
    return score_multi_regression(checked, target), mask_by_flags(submission, targets, flags)
