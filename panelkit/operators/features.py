"""General feature matrix of series: one row per series, one column per value column and feature.

The value columns are first stacked, so a feature is written once and every column takes the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.ordered import (
    POS,
    SIZE,
    Layout,
    bounded_frames,
    exact_quantiles,
    number_rows,
    running,
    with_group_values,
)

MINIMAL = (
    "sum_values",
    "median",
    "mean",
    "length",
    "standard_deviation",
    "variance",
    "root_mean_square",
    "maximum",
    "absolute_maximum",
    "minimum",
)
ORDER_FREE = (
    "abs_energy",
    "count_above_mean",
    "count_below_mean",
    "skewness",
    "kurtosis",
    "variation_coefficient",
    "has_duplicate",
)
ORDERED = (
    "mean_abs_change",
    "mean_change",
    "absolute_sum_of_changes",
    "mean_second_derivative_central",
    "cid_ce",
    "longest_strike_above_mean",
    "longest_strike_below_mean",
    "first_location_of_maximum",
    "last_location_of_minimum",
    "linear_trend_slope",
    "linear_trend_intercept",
)
QUANTILES = (0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 0.9)
SIGMAS = (1.0, 2.0, 3.0)
LAGS = (1, 2, 3)
PEAK_SUPPORTS = (1, 3, 5)


def feature_names(
    quantiles: Sequence[float] = QUANTILES,
    sigmas: Sequence[float] = SIGMAS,
    lags: Sequence[int] = LAGS,
    supports: Sequence[int] = PEAK_SUPPORTS,
) -> list[str]:
    """All feature names; a parameter is part of the name."""
    return [
        *MINIMAL,
        *ORDER_FREE,
        *[f"quantile__q_{q}" for q in quantiles],
        *[f"ratio_beyond_r_sigma__r_{r:g}" for r in sigmas],
        *ORDERED,
        *[f"autocorrelation__lag_{n}" for n in lags],
        *[f"number_peaks__n_{n}" for n in supports],
    ]


def _stack(df: DataFrame, key: str, columns: Sequence[str], order: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(key, F.col(order).alias("_order"), F.explode(pairs).alias("_p")).select(key, "_order", "_p.*")
    return long.where(F.col("v").isNotNull() & ~F.isnan("v"))


def _strikes(long: DataFrame, layout: Layout, flag: Column, name: str) -> DataFrame:
    """Longest run of rows with a true flag."""
    df = long.withColumn("_f", F.coalesce(flag.cast("int"), F.lit(0)))
    df = running(df, layout, {"_gap": ("sum", 1 - F.col("_f"))})
    runs = df.groupBy(*layout.keys, "_gap").agg(F.sum("_f").alias("_n"))
    return runs.groupBy(*layout.keys).agg(F.max("_n").alias(name))


def _duplicates(long: DataFrame, layout: Layout) -> DataFrame:
    """1 when some value occurs twice: counted per value first, so no group gathers its values."""
    keys = list(layout.keys)
    per_value = long.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("_c"))
    return per_value.groupBy(*keys).agg((F.max("_c") > 1).cast("int").alias("has_duplicate"))


def long_features(
    df: DataFrame,
    layout: Layout,
    columns: Sequence[str],
    order: str = "time",
    features: Sequence[str] | None = None,
    quantiles: Sequence[float] = QUANTILES,
    sigmas: Sequence[float] = SIGMAS,
    lags: Sequence[int] = LAGS,
    supports: Sequence[int] = PEAK_SUPPORTS,
) -> DataFrame:
    """One row per (key, kind) with the features as columns. ``order`` must order a series totally."""
    wanted = set(features or feature_names(quantiles, sigmas, lags, supports))
    key = layout.keys[0]
    each = layout.within("kind").by("_order")
    keys = list(each.keys)
    long = number_rows(_stack(df, key, columns, order), each)
    each = each.by(POS)
    v, n = F.col("v"), F.col(SIZE)
    far = max([2, *lags, *supports])

    def near(w):
        made = [F.lag("v", i).over(w).alias(f"_b{i}") for i in range(1, far + 1)]
        return made + [F.lead("v", i).over(w).alias(f"_a{i}") for i in range(1, max(supports, default=0) + 1)]

    long = bounded_frames(long, each, near, far, far)
    long = with_group_values(long, each, {"_mean": F.avg("v"), "_std": F.stddev_pop("v")})
    mean, std, change = F.col("_mean"), F.col("_std"), F.col("v") - F.col("_b1")
    at = lambda c, p: F.max(F.when(F.col(POS) == p, F.col(c)))
    size = F.max(n)

    def peak(k):
        sides = [F.col(f"_{s}{i}") for s in "ab" for i in range(1, k + 1)]
        ok = v > sides[0]
        for s in sides[1:]:
            ok = ok & (v > s)
        return F.count_if(ok)

    pop_skew, pop_kurt = F.skewness("v"), F.kurtosis("v")
    constant = F.min("v") == F.max("v")
    n_d = size.cast("double")
    aggs = {
        "sum_values": F.sum("v"),
        "mean": F.avg("v"),
        "length": F.count("v"),
        "standard_deviation": F.stddev_pop("v"),
        "variance": F.var_pop("v"),
        "root_mean_square": F.sqrt(F.avg(v * v)),
        "maximum": F.max("v"),
        "absolute_maximum": F.max(F.abs("v")),
        "minimum": F.min("v"),
        "abs_energy": F.sum(v * v),
        "count_above_mean": F.count_if(v > mean),
        "count_below_mean": F.count_if(v < mean),
        "skewness": F.when(
            size >= 3, F.when(constant, 0.0).otherwise(F.sqrt(n_d * (n_d - 1)) / (n_d - 2) * pop_skew)
        ),
        "kurtosis": F.when(
            size >= 4,
            F.when(constant, 0.0).otherwise((n_d - 1) / ((n_d - 2) * (n_d - 3)) * ((n_d + 1) * pop_kurt + 6)),
        ),
        "variation_coefficient": F.try_divide(F.stddev_pop("v"), F.avg("v")),
        "mean_abs_change": F.avg(F.abs(change)),
        "mean_change": F.try_divide(at("v", n - 1) - at("v", 0), size - 1),
        "absolute_sum_of_changes": F.coalesce(F.sum(F.abs(change)), F.lit(0.0)),
        "mean_second_derivative_central": F.when(
            size > 2, F.try_divide(at("v", n - 1) - at("_b1", n - 1) - at("v", 1) + at("v", 0), 2 * (size - 2))
        ),
        "cid_ce": F.sqrt(F.coalesce(F.sum(change * change), F.lit(0.0))),
        "first_location_of_maximum": F.min_by(F.col(POS), F.struct((-v).alias("a"), F.col(POS).alias("b"))) / size,
        "last_location_of_minimum": (F.min_by(F.col(POS), F.struct(v.alias("a"), (-F.col(POS)).alias("b"))) + 1) / size,
        "linear_trend_slope": F.regr_slope("v", POS),
        "linear_trend_intercept": F.regr_intercept("v", POS),
    }
    for r in sigmas:
        aggs[f"ratio_beyond_r_sigma__r_{r:g}"] = F.count_if(F.abs(v - mean) > r * std) / size
    for i in lags:
        products = F.sum((v - mean) * (F.col(f"_b{i}") - mean))
        aggs[f"autocorrelation__lag_{i}"] = F.try_divide(F.try_divide(products, size - i), F.var_pop("v"))
    for k in supports:
        aggs[f"number_peaks__n_{k}"] = peak(k)
    probs = {f"quantile__q_{q}": q for q in quantiles if f"quantile__q_{q}" in wanted}
    probs |= {"median": 0.5} if "median" in wanted else {}
    chosen = [a.alias(name) for name, a in aggs.items() if name in wanted]
    if probs and not each.hot:
        found = F.percentile("v", F.array(*[F.lit(p) for p in probs.values()])).alias("_q")
        out = long.groupBy(*keys).agg(*chosen, found)
        out = out.select(*keys, *[c for c in aggs if c in wanted], *[F.col("_q")[i].alias(q) for i, q in enumerate(probs)])
    else:
        out = long.groupBy(*keys).agg(*chosen) if chosen else long.select(*keys).distinct()
        if probs:
            out = out.join(exact_quantiles(long.select(*keys, "v"), each, "v", probs), keys, "left")
    for name, flag in (("longest_strike_above_mean", v > mean), ("longest_strike_below_mean", v < mean)):
        if name in wanted:
            out = out.join(_strikes(long, each, flag, name), keys, "left")
    if "has_duplicate" in wanted:
        out = out.join(_duplicates(long, each), keys, "left")
    return out


def series_features(df: DataFrame, layout: Layout, columns: Sequence[str], order: str = "time", **kw) -> DataFrame:
    """``long_features`` turned wide: ``{column}__{feature}``, with one row per series."""
    long = long_features(df, layout, columns, order, **kw)
    key = layout.keys[0]
    names = [c for c in long.columns if c not in (key, "kind")]
    fields = F.struct(*[F.col(f"`{n}`") for n in names])
    wide = long.groupBy(key).pivot("kind", list(columns)).agg(F.first(fields))
    return wide.select(key, *[F.col(f"`{c}`").getField(n).alias(f"{c}__{n}") for c in columns for n in names])


def override_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which the right side replaces columns of the same name."""
    same = (set(left.columns) & set(right.columns)) - {key}
    return left.drop(*same).join(right, key, "left")


def add_predicted_flags(features: DataFrame, predicted: DataFrame | None, flags: Sequence[str], key: str) -> DataFrame:
    """Predicted flags with the features of their series; without predictions the features as they are."""
    if predicted is None:
        return features
    return predicted.select(key, *flags).join(features.drop(*flags), key, "left")


