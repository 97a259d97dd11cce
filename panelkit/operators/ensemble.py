"""Combining prediction tables by key. Rows are matched by key, never by position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.labels import FLAGS, SHORT_FLAGS
from panelkit.operators.metrics import to_int

PANEL_KEY = ("inn_id", "week")


def join_runs(runs: Sequence[DataFrame], keys: Sequence[str] = PANEL_KEY, value: str = "predict") -> DataFrame:
    """Keys that occur in every prediction frame, one column ``{value}_{i}`` per run.

    The runs are stacked and grouped once: one shuffle for any number of runs. A key must occur at most once per run; rows
    with a null key match nothing.
    """
    tagged = [r.select(*keys, F.col(value).alias(value), F.lit(i).alias("run")) for i, r in enumerate(runs, 1)]
    stacked = reduce(DataFrame.unionByName, tagged).dropna(subset=list(keys))
    columns = [F.max(F.when(F.col("run") == i, F.col(value))).alias(f"{value}_{i}") for i in range(1, len(runs) + 1)]
    return stacked.groupBy(*keys).agg(F.count("*").alias("_runs"), *columns).filter(F.col("_runs") == len(runs)).drop("_runs")


def row_mean(columns: Sequence[str]) -> Column:
    """Mean across columns of a row, NULL and NaN left out."""
    clean = [F.when(~F.isnan(c), F.col(c)) for c in columns]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in clean])
    return F.try_divide(total, reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in clean]))


def ensemble_mean(
    runs: Sequence[DataFrame], keys: Sequence[str] = PANEL_KEY, value: str = "predict"
) -> DataFrame:
    """Mean prediction of the keys that occur in every run.

    The runs are stacked and grouped once instead of joined one after another: one shuffle for any number of
    runs, with a map-side combine. A key must occur at most once per run.
    """
    tagged = [r.select(*keys, F.col(value).cast("double").alias(value), F.lit(i).alias("run")) for i, r in enumerate(runs)]
    return mean_of_runs(reduce(DataFrame.unionByName, tagged), len(runs), keys, value)


def mean_of_runs(long: DataFrame, n_runs: int, keys: Sequence[str] = PANEL_KEY, value: str = "predict") -> DataFrame:
    """The same for runs that are already in long form."""
    out = long.groupBy(*keys).agg(
        F.avg(F.when(~F.isnan(value), F.col(value))).alias(value), F.count(F.lit(1)).alias("_n")
    )
    return out.where(F.col("_n") == n_runs).drop("_n")


def exclude_folds(df: DataFrame, excluded: dict[int, Sequence[int]]) -> DataFrame:
    """Drop the listed folds of each run."""
    for run, folds in excluded.items():
        if folds:
            df = df.where(~((F.col("run") == run) & F.col("fold").isin(*folds)))
    return df


def vote_mode(c: str) -> Column:
    """Most frequent value; the smallest of equally frequent ones."""
    return F.mode(c, deterministic=True)


def vote_mean(c: str) -> Column:
    return F.avg(c)


def vote_proba(c: str) -> Column:
    """1 when the mean probability is at least 0.5."""
    return (F.avg(c) >= 0.5).cast("int")


VOTES = {"mode": vote_mode, "mean": vote_mean, "proba": vote_proba}


def ensemble_vote(
    folds: DataFrame,
    targets: Sequence[str],
    how: str = "mode",
    key: str = "file_name",
    excluded: dict[int, Sequence[int]] | None = None,
) -> DataFrame:
    """One row per key from the rows of all folds: ``mode``, ``mean`` or ``proba`` per target."""
    if excluded:
        folds = exclude_folds(folds, excluded)
    voted = folds.groupBy(key).agg(*[VOTES[how](t).alias(t) for t in targets])
    return to_int(voted, [t for t in targets if t in FLAGS + SHORT_FLAGS])


def log_scores(scores: DataFrame, path: str) -> None:
    """Append metric rows to the run log."""
    scores.write.mode("append").parquet(path)


def latest_run(log: DataFrame) -> DataFrame:
    """Highest run number, 0 for an empty log."""
    return log.agg(F.coalesce(F.max("num"), F.lit(0)).cast("int").alias("num"))


def by_importance(df: DataFrame, name: str = "feature", value: str = "importance") -> DataFrame:
    return df.orderBy(F.desc(value), name)
