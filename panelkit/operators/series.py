"""Summary statistics of many series: one row per series.

Input: a frame numbered by ``ordered.number_rows`` with one row per point, the key column, and any of
``time, dP, Pder`` (logs) and ``T, P, D`` (raw values). NaN counts as missing throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators.ordered import (
    POS,
    SIZE,
    Layout,
    bounded_frames,
    join_group_rows,
    number_rows,
    quantiles,
    with_group_values,
)

KEY = "file_name"
LOG_COLUMNS = ("time", "dP", "Pder")
RAW_COLUMNS = ("T", "P", "D")
GROWTH_COLUMNS = ("dP", "P")
BIN_COLUMNS = ("Pder", "D")
# Two sets of quantile edges, and the name of the bin that ends at each edge (last one open).
BIN_SETS = (
    ((0.06, 0.15, 0.3, 0.42, 0.54, 0.66, 0.78, 0.9), ("0_06", "0_15", "0_3", "0_42", "0_54", "0_66", "0_78", "0_9", "1_1")),
    ((0.2, 0.4, 0.6, 0.8), ("0_2", "0_4", "0_6", "0_8", "1_2")),
)
SIGMAS = (1, 2, 3)
# Columns of an empty series that are 0 rather than missing.
EMPTY_ZERO = [f"time_{s}" for s in ("std", "mean", "median", "diff_max", "diff_std", "diff_mean", "diff_median")] + [
    f"time_{k}_std" for k in SIGMAS
]


def log_series(df: DataFrame) -> DataFrame:
    """Drop negative times; keep the raw columns as ``T, P, D`` and take base-10 logs of the three columns."""
    kept = df.where((F.col("time") >= 0) & ~F.isnan("time"))
    raw = [F.col(c).alias(r) for c, r in zip(LOG_COLUMNS, RAW_COLUMNS)]
    rest = [c for c in df.columns if c not in LOG_COLUMNS]
    return kept.select(*rest, *[S.log10(F.col(c)).alias(c) for c in LOG_COLUMNS], *raw)


def add_diffs(df: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
    """``_d_{c}``: value minus the one before it, NULL on the first row."""
    return bounded_frames(
        df, layout, lambda w: [S.no_nan(F.col(c) - F.lag(c).over(w)).alias(f"_d_{c}") for c in columns], back=1
    )


def elapsed(df: DataFrame, layout: Layout, column: str = "time", name: str = "elapsed") -> DataFrame:
    """Time since the start of the series."""
    out = with_group_values(df, layout, {"_start": F.min(S.no_nan(F.col(column)))})
    return out.withColumn(name, S.no_nan(F.col(column) - F.col("_start"))).drop("_start")


def _std(c: Column) -> Column:
    return S.no_nan(F.stddev(c))


def _share(hits: Column, total: Column) -> Column:
    return hits / total * 100


def _medians(df: DataFrame, layout: Layout, wanted: dict[str, str]) -> DataFrame | list[Column]:
    """Exact medians: columns of the same aggregate for small groups, a separate frame for large ones."""
    if not layout.hot:
        return [S.no_nan(F.median(c)).alias(n) for n, c in wanted.items()]
    found = quantiles(df, layout, {c: {n: 0.5} for n, c in wanted.items()})
    return df.select(*layout.keys).distinct().join(found, list(layout.keys), "left")


def _aggregate(df: DataFrame, layout: Layout, aggs: Sequence[Column], medians: dict[str, str]) -> DataFrame:
    more = _medians(df, layout, medians)
    if isinstance(more, list):
        return df.groupBy(*layout.keys).agg(*aggs, *more)
    return df.groupBy(*layout.keys).agg(*aggs).join(more, list(layout.keys))


def summary(df: DataFrame, layout: Layout, columns: Sequence[str], growing: Sequence[str] = ()) -> DataFrame:
    """Per column: std, mean, median; of its differences max, std, mean, median; share of k-sigma outliers.

    ``growing`` columns also get their growth flag, in the same pass while groups are small.
    """
    layout = layout.by(POS)
    d = add_diffs(df, layout, columns)
    stats = {}
    for c in columns:
        stats[f"_m_{c}"] = F.avg(f"_d_{c}")
        stats[f"_s_{c}"] = F.stddev(f"_d_{c}")
    d = with_group_values(d, layout, stats)
    aggs, medians = [], {}
    if growing and not layout.hot:
        d = _steps(d, layout, growing)
        aggs += [_never_falls(F.col(f"_step_{c}")).alias(f"{c}_growth") for c in growing]
    for c in columns:
        diff = F.col(f"_d_{c}")
        aggs += [
            _std(F.col(c)).alias(f"{c}_std"),
            S.no_nan(F.avg(c)).alias(f"{c}_mean"),
            F.max(diff).alias(f"{c}_diff_max"),
            _std(diff).alias(f"{c}_diff_std"),
            S.no_nan(F.avg(diff)).alias(f"{c}_diff_mean"),
        ]
        medians |= {f"{c}_median": c, f"{c}_diff_median": f"_d_{c}"}
        for k in SIGMAS:
            out = F.abs(diff) > F.col(f"_m_{c}") + k * F.col(f"_s_{c}")
            aggs.append(_share(F.count_if(out), F.count(F.lit(1))).alias(f"{c}_{k}_std"))
    out = _aggregate(d, layout, aggs, medians)
    return out.join(growth(df, layout, growing), list(layout.keys)) if growing and layout.hot else out


def _steps(d: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
    """``_step_{c}``: change of the three-point trailing mean of the differences that exist."""
    w = f"PARTITION BY {', '.join(layout.keys)} ORDER BY {POS}"
    texts = [f"lag(`_d_{c}`, {n}) IGNORE NULLS OVER ({w}) AS `_d{n}_{c}`" for c in columns for n in (1, 2, 3)]
    d = d.selectExpr("*", *texts)
    return d.select("*", *[_step(c, *[f"_d{n}_{c}" for n in (1, 2, 3)]).alias(f"_step_{c}") for c in columns])


def _step(c: str, first: str, second: str, third: str) -> Column:
    parts = [S.finite_or_null(F.col(n)) for n in (f"_d_{c}", first, second, third)]
    change = _mean3(parts[:3]) - _mean3(parts[1:])
    return F.when(F.col(f"_d_{c}").isNotNull() & F.col(first).isNotNull(), change)


def _never_falls(step: Column) -> Column:
    return F.coalesce(F.min((step >= 0).cast("int")), F.lit(1))


def growth(df: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
    """``{c}_growth``: 1 when the three-point trailing mean of the differences never falls."""
    keys, layout = list(layout.keys), layout.by(POS)
    base = add_diffs(df, layout, columns)
    if not layout.hot:
        return _steps(base, layout, columns).groupBy(*keys).agg(
            *[_never_falls(F.col(f"_step_{c}")).alias(f"{c}_growth") for c in columns]
        )
    out = df.select(*keys).distinct()
    for c in columns:
        # The frame counts differences that exist, so they are numbered anew before they are cut into blocks.
        d = base.select(*keys, F.col(POS).alias("_row"), f"_d_{c}").where(F.col(f"_d_{c}").isNotNull())
        d = number_rows(d, layout.by("_row"))
        d = bounded_frames(d, layout, lambda w, c=c: [F.lag(f"_d_{c}", n).over(w).alias(f"_d{n}") for n in (1, 2, 3)], back=3)
        step = _step(c, "_d1", "_d2", "_d3")
        flag = d.select(*keys, step.alias("_step")).groupBy(*keys).agg(_never_falls(F.col("_step")).alias(f"{c}_growth"))
        out = out.join(flag, keys, "left").withColumn(f"{c}_growth", F.coalesce(f"{c}_growth", F.lit(1)))
    return out


def _mean3(parts: Sequence[Column]) -> Column:
    n = sum((p.isNotNull().cast("int") for p in parts[1:]), parts[0].isNotNull().cast("int"))
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    return F.try_divide(total, n)


def bin_statistics(df: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
    """Differences (first one 0) split at their own quantiles; max, std, mean, median and outlier shares per bin."""
    keys, layout = list(layout.keys), layout.by(POS)
    d = add_diffs(df, layout, columns).select(
        *keys, POS, SIZE, *[F.coalesce(f"_d_{c}", F.lit(0.0)).alias(f"_d_{c}") for c in columns]
    )
    d = _with_edges(d, layout, columns)
    rows = []
    for c in columns:
        v = F.col(f"_d_{c}")
        for i, (probs, names) in enumerate(BIN_SETS):
            edges = F.col(f"_e{i}_{c}")
            index = sum(((edges[k] < v).cast("int") for k in range(1, len(probs))), (edges[0] < v).cast("int"))
            label = F.element_at(F.array(*[F.lit(f"{c}_q_{n}") for n in names]), index + 1)
            rows.append(F.struct(label.alias("bin"), v.alias("v")))
    long = d.select(*keys, POS, SIZE, F.explode(F.array(*rows)).alias("_r")).select(*keys, POS, SIZE, "_r.*")
    long = long.where(F.col("bin").isNotNull() & (F.col("v") > F.lit(-S.INF)))
    part = layout.within("bin")
    long = with_group_values(long, part, {"_m": F.avg("v"), "_s": F.stddev("v")})
    aggs = [F.max("v").alias("max"), _std(F.col("v")).alias("std"), S.no_nan(F.avg("v")).alias("mean")]
    for k in SIGMAS:
        hits = F.count_if(F.abs("v") > F.col("_m") + k * F.col("_s"))
        aggs.append(_share(hits, F.count(F.lit(1))).alias(f"{k}_std"))
    per_bin = _aggregate(long, part, aggs, {"median": "v"})
    bins = [f"{c}_q_{n}" for c in columns for _, names in BIN_SETS for n in names]
    stats = ["max", "std", "mean", "median", *[f"{k}_std" for k in SIGMAS]]
    wide = per_bin.groupBy(*keys).pivot("bin", bins).agg(*[F.first(s).alias(s) for s in stats])
    shares = [f"{b}_{k}_std" for b in bins for k in SIGMAS]
    return wide.na.fill(0.0, subset=shares)


def _with_edges(d: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
    """``_e{i}_{c}``: the quantiles of ``_d_{c}`` for each set of bins, all from one pass."""
    sets = [(c, i, probs) for c in columns for i, (probs, _) in enumerate(BIN_SETS)]
    if not layout.hot:
        every = {f"_e{i}_{c}": F.percentile(f"_d_{c}", F.array(*[F.lit(p) for p in probs])) for c, i, probs in sets}
        return with_group_values(d, layout, every)
    wanted = {f"_d_{c}": {f"_e{i}_{c}_{k}": p for i, (probs, _) in enumerate(BIN_SETS) for k, p in enumerate(probs)} for c in columns}
    found = quantiles(d, layout, wanted)
    edges = [F.array(*[f"`_e{i}_{c}_{k}`" for k in range(len(probs))]).alias(f"_e{i}_{c}") for c, i, probs in sets]
    return join_group_rows(d, found.select(*layout.keys, *edges), layout)


def row_counts(df: DataFrame, universe: DataFrame, key: str = KEY) -> DataFrame:
    """Rows per series, 0 for a series of the universe without rows."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("count_rows"))
    return universe.select(key).distinct().join(n, key, "left").select(
        key, F.coalesce("count_rows", F.lit(0).cast("long")).alias("count_rows")
    )


def series_stats(
    df: DataFrame,
    layout: Layout,
    universe: DataFrame | None = None,
    line: DataFrame | None = None,
    fill_value: float = 0,
) -> DataFrame:
    """All hand-made features of each series of the universe, with ``count_rows``.

    ``line`` is the result of ``segments.unit_slope_line``; its ``wb_value`` is added when given.
    """
    key = layout.keys[0]
    columns = [c for c in LOG_COLUMNS + RAW_COLUMNS if c in df.columns]
    parts = [summary(df, layout, columns, [c for c in GROWTH_COLUMNS if c in columns])]
    parts.append(bin_statistics(df, layout, [c for c in BIN_COLUMNS if c in columns]))
    if line is not None:
        parts.append(line.select(key, "wb_value"))
    universe = df.select(key) if universe is None else universe
    out = row_counts(df, universe, key)
    for p in parts:
        out = out.join(p, key, "left")
    zero = [c for c in EMPTY_ZERO if c in out.columns]
    empty = F.col("count_rows") == 0
    return out.select(
        *[F.when(empty, F.lit(float(fill_value))).otherwise(F.col(c)).alias(c) if c in zero else F.col(c) for c in out.columns]
    )
