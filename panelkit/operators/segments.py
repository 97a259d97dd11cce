"""Straight segments and peaks of series in log-log scale.

Input: a frame numbered by ``ordered.number_rows`` (``pos``, ``n_rows``), key column, ``time`` and ``Pder`` in logs.
Point pairs at most 25 or 199 rows apart are formed block by block of as many rows; only pairs with a slope near the
wanted one leave that join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators.ordered import (
    POS,
    SIZE,
    Layout,
    bounded_frames,
    number_rows,
    running,
    with_group_values,
)
from panelkit.session import durable

KEY = "file_name"
DOUBLE_MAX = 1.7976931348623157e308

# Fixed values of the unit-slope search. Starts, shifts and candidates are only defaults of its arguments.
PEAK_POINTS = 3
MAX_LOG_TIME = 1.2
UNIT_STARTS = 3
UNIT_SHIFTS = 25
UNIT_BAND = (0.8, 1.2)
UNIT_MIN_LENGTH = 0.13
UNIT_CANDIDATES = 5
# Fixed values of the slope search. Shifts, last start, thinning and candidates are only defaults of its arguments.
SLOPES = {"ra_value": 0.0, "li_value": 0.5, "bl_value": 0.25, "sp_value": -0.5}
SLOPE_SHIFTS = (*range(1, 101), *range(102, 200, 2))
SLOPE_LAST_START = 500
# (beyond, step): starts beyond the first number are examined where they are multiples of the second.
SLOPE_THINNING = ((200, 2), (400, 3), (600, 4), (1000, 5))
SLOPE_TOLERANCE = 0.2
SLOPE_CLOSE = 0.05
SLOPE_MIN_LENGTH = 0.5
SLOPE_SIGMAS = 3.5
SLOPE_BAD_ROWS = (3, 100)
SLOPE_BAD_SIGMAS = 3
SLOPE_BAD_LIMIT = 3
SLOPE_CANDIDATES = 7
# Fixed values of the flat-part search.
FLAT_MEAN = 0.004
FLAT_SHARE = 0.2
RUN_LIMIT = 5
FLAT_GAP = 5
FLAT_LONG = 15
FLAT_MIN_TIME = 0.3
# Fixed values of the tail search.
TAIL_POINTS = 7
TAIL_LAST = 30
# Parts of a large series that are ranked apart.
TOP_SALTS = 64


def _xy(df: DataFrame, key: str, x: str, y: str, *more: str) -> DataFrame:
    return df.select(key, POS, SIZE, S.no_nan(F.col(x)).alias("x"), S.no_nan(F.col(y)).alias("y"), *more)


def peaks(df: DataFrame, layout: Layout, y: str = "y", points: int = PEAK_POINTS) -> DataFrame:
    """``peak``: y is above the previous ``points`` values (as many as exist) and not below the next ones."""
    v = F.col(y)

    def make(w):
        before, after = w.rowsBetween(-points, -1), w.rowsBetween(1, points)
        return [
            (
                (F.count(v).over(before) == F.least(F.col(POS), F.lit(points)))
                & (F.count(v).over(after) == points)
                & (v > F.max(v).over(before))
                & (v >= F.max(v).over(after))
            ).alias("_peak")
        ]

    framed = bounded_frames(df, layout.by(POS), make, points, points)
    return framed.withColumn("peak", F.coalesce("_peak", F.lit(False)) & (F.col(POS) >= 1)).drop("_peak")


def first_peak(df: DataFrame, layout: Layout, y: str = "y", points: int = PEAK_POINTS) -> DataFrame:
    """Position of the first peak per series (no row for a series without one)."""
    found = peaks(df, layout, y, points)
    return found.where("peak").groupBy(*layout.keys).agg(F.min(POS).alias("peak_pos"))


def near_pairs(df: DataFrame, layout: Layout, shifts: Sequence[int], low: float, high: float, slope: float) -> DataFrame:
    """Pairs of points ``s`` rows apart (s in ``shifts``) whose slope lies in [low, high].

    Gives ``s, err = |slope - k|, k, b`` (intercept at the first point) and ``d`` (length in x). ``pos`` must number the rows of
    a series without gaps. Points meet by blocks of as many rows as the longest shift, a block with itself and the next
    one: no task holds more than that of a series, whatever its size.
    """
    key, reach = layout.keys[0], max(shifts)
    thin = sorted(set(range(1, reach + 1)) - set(shifts))
    own = F.floor(F.col(POS) / reach)
    point = [F.col(POS).alias("_pos"), F.col("x").alias("_x"), F.col("y").alias("_y")]
    ahead = df.select(key, *point, F.explode(F.array(own - 1, own)).alias("_block"))
    s = (F.col("_pos") - F.col(POS)).cast("int")
    d = F.col("_x") - F.col("x")
    k = F.try_divide(F.col("_y") - F.col("y"), d)
    near = df.withColumn("_block", own).join(ahead, [key, "_block"]).where(s.between(1, reach) & ~s.isin(*thin) if thin else s.between(1, reach))
    near = near.where(k.between(low, high))
    b = F.col("y") - k * F.col("x")
    return near.select(*df.columns, s.alias("s"), F.abs(k - slope).alias("err"), k.alias("k"), b.alias("b"), d.alias("d"))


def _clamp(c: Column) -> Column:
    """Missing becomes 0, infinities the largest double."""
    c = F.coalesce(S.no_nan(c), F.lit(0.0))
    return F.greatest(F.least(c, F.lit(DOUBLE_MAX)), F.lit(-DOUBLE_MAX))


def _line_errors(points: DataFrame, found: DataFrame, key: str, slope: float) -> DataFrame:
    """Both lines of the given slope through the ends of each segment (f, e), with their mean absolute error.

    ``points`` holds ``pos, x, y``. A segment spans at most 200 points, so the join grows with the segments.
    """
    spans = found.select(key, "f", "e", F.explode(F.sequence("f", "e")).alias(POS))
    on = spans.join(points.select(key, POS, "x", "y"), [key, POS])
    seg = Window.partitionBy(key, "f", "e")
    at = [F.first(F.when(F.col(POS) == F.col(p), F.col("y") - slope * F.col("x")), ignorenulls=True) for p in ("f", "e")]
    on = on.select("*", at[0].over(seg).alias("b1"), at[1].over(seg).alias("b2"))
    real = _clamp(F.col("y"))

    def mae(b):
        return F.round(F.avg(F.abs(real - _clamp(slope * F.col("x") + F.col(b)))), 5)

    return on.groupBy(key, "f", "e").agg(
        mae("b1").alias("mae1"), mae("b2").alias("mae2"), F.first("b1").alias("b1"), F.first("b2").alias("b2")
    )


def unit_slope_line(
    df: DataFrame,
    layout: Layout,
    x: str = "time",
    y: str = "Pder",
    anchor: str = "first",
    *,
    starts: int = UNIT_STARTS,
    shifts: int = UNIT_SHIFTS,
    candidates: int = UNIT_CANDIDATES,
) -> DataFrame:
    """Best segment of slope 1 near the start of each series: intercept ``wb_value`` and ``wb_end``.

    The first ``starts`` points are tried with up to ``shifts`` rows each; the ``candidates`` nearest slopes are compared.
    ``anchor`` = "first" places a candidate at (start, start + shift) whatever point pair gave its slope, as earlier
    feature tables do; "pair" places it at that pair. A series without a segment keeps its row, with NULLs.
    """
    key = layout.keys[0]
    layout = layout.by(POS)
    base = _xy(df, key, x, y)
    marked = peaks(base, layout)
    marked = with_group_values(
        marked, layout, {"p": F.min(F.when(F.col("peak"), F.col(POS))), "_x0": F.min("x")}
    )
    span = S.no_nan(F.col("x") - F.col("_x0"))
    head = marked.where((span < MAX_LOG_TIME) & (F.col("p").isNull() | (F.col(POS) <= F.col("p") + 2)))
    head = head.select(key, POS, SIZE, "x", "y", "p")
    head = number_rows(head.withColumnRenamed(POS, "row").drop(SIZE), layout.by("row"))
    pairs = near_pairs(head, layout, range(1, shifts + 1), *UNIT_BAND, slope=1.0)
    best = F.struct("err", "row", "k", "b", "d")
    per_shift = pairs.groupBy(key, "s").agg(
        F.first("p").alias("p"), *[F.min(F.when(F.col("row") >= f, best)).alias(f"f{f}") for f in range(starts)]
    )
    tried = F.array(*[F.struct(F.lit(f).cast("long").alias("f"), F.col(f"f{f}").alias("c")) for f in range(starts)])
    cand = per_shift.select(key, "s", "p", F.explode(tried).alias("_c")).select(key, "s", "p", "_c.f", "_c.c.*")
    cand = cand.where((F.col("d") >= UNIT_MIN_LENGTH) & F.col("b").isNotNull() & F.col("k").isNotNull())
    if anchor == "pair":
        cand = cand.withColumn("f", F.col("row"))
    cand = cand.withColumn("e", F.col("f") + F.col("s"))
    top = _least(cand, layout, ["err", "f", "e", "k", "b", "d"], candidates)
    lines = _line_errors(base if anchor == "pair" else base.where(F.col(POS) < starts + shifts), top, key, 1.0)
    mean_error = (F.col("mae1") + F.col("mae2")) / 2
    mean_b = (F.col("b1") + F.col("b2")) / 2
    chosen = lines.groupBy(key).agg(
        F.min(F.struct(mean_error.alias("m"), F.col("f"), F.col("e"), mean_b.alias("b"))).alias("_best"),
        F.max("e").alias("_end"),
    )
    ends = top.groupBy(key).agg(F.first("p").alias("p"))
    out = chosen.join(ends, key).select(
        key, F.col("_best.b").alias("wb_value"), F.least("_end", "p").alias("wb_end")
    )
    return df.select(key).distinct().join(out, key, "left")


def tail_boundary(
    df: DataFrame, layout: Layout, x: str = "time", y: str = "Pder", points: int = TAIL_POINTS, last: int = TAIL_LAST
) -> DataFrame:
    """First point from the end that is not below the ``points`` values before it: ``pc_value`` and ``pc_pos``.

    Only the ``last`` points of a series are looked at.
    """
    key = layout.keys[0]
    base = _xy(df, key, x, y).withColumn("_r", F.col(SIZE) - 1 - F.col(POS))
    tail = base.where(F.col("_r") < last + points)
    w = Window.partitionBy(key).orderBy("_r")
    ahead, behind = w.rowsBetween(1, points), w.rowsBetween(-points, -1)
    hit = (
        (F.count("y").over(ahead) == points)
        & (F.count("y").over(behind) == points)
        & (F.col("y") >= F.max("y").over(ahead))
    )
    rows = tail.select("*", hit.alias("_hit")).where(
        F.col("_hit") & (F.col("_r") > points) & (F.col("_r") < F.least(F.lit(last), F.col(SIZE) - points))
    )
    found = rows.groupBy(key).agg(F.min_by(F.struct("x", POS), "_r").alias("_b"))
    found = found.select(key, F.col("_b.x").alias("pc_value"), F.col(f"_b.{POS}").alias("pc_pos"))
    return df.select(key).distinct().join(found, key, "left")


def centred(df: DataFrame, layout: Layout, column: str, fn: str = "avg", rows: int = 3) -> DataFrame:
    """Centred rolling ``avg`` or ``stddev`` as ``_c``; NULL unless the whole frame holds finite values."""
    v = S.finite_or_null(F.col(column).cast("double"))
    half = rows // 2

    def make(w):
        frame = w.rowsBetween(-half, half)
        return [F.when(F.count(v).over(frame) == rows, getattr(F, fn)(v).over(frame)).alias("_c")]

    return bounded_frames(df, layout, make, half, half)


def flat_flags(df: DataFrame, layout: Layout, diff: str = "diff") -> DataFrame:
    """``is_flat`` (small centred mean of differences) and ``smoothed`` (some of three neighbours is flat)."""
    out = centred(df, layout, diff).withColumn("is_flat", F.coalesce(F.abs("_c") < FLAT_MEAN, F.lit(False))).drop("_c")
    out = out.withColumn("_f", F.col("is_flat").cast("int"))
    out = centred(out, layout, "_f").withColumn("smoothed", F.coalesce(F.col("_c") > FLAT_SHARE, F.lit(False)))
    return out.drop("_c", "_f")


def islands(df: DataFrame, layout: Layout, value: Column, name: str) -> DataFrame:
    """Number the runs of equal ``value`` along a series, from 1."""
    df = df.withColumn("_v", value)
    df = bounded_frames(df, layout, lambda w: [F.lag("_v").over(w).alias("_pv")], back=1)
    change = (F.col("_pv").isNull() | (F.col("_v") != F.col("_pv"))).cast("long")
    return running(df, layout, {name: ("sum", change)}).drop("_v", "_pv")


def cancel_long_runs(df: DataFrame, layout: Layout, diff: str = "diff") -> DataFrame:
    """``smoothed`` is withdrawn on runs of one sign of ``diff`` that are longer than 5 and smoothed throughout."""
    df = islands(df, layout, F.signum(diff), "island")
    run = layout.within("island")
    df = with_group_values(df, run, {"_n": F.count(diff), "_all": F.min(F.col("smoothed").cast("int"))})
    keep = ~((F.col("_n") > RUN_LIMIT) & (F.col("_all") == 1))
    return df.withColumn("smoothed", F.col("smoothed") & keep).drop("_n", "_all")


def flag_segments(df: DataFrame, layout: Layout, flag: str = "smoothed") -> DataFrame:
    """Runs of a true flag as [start, end); a run still open at the end of the series is not a segment."""
    keys = list(layout.keys)
    runs = islands(df, layout, F.col(flag).cast("int"), "_run").where(F.col(flag))
    found = runs.groupBy(*keys, "_run").agg(
        F.min(POS).alias("start"), (F.max(POS) + 1).alias("end"), F.first(SIZE).alias(SIZE)
    )
    return found.where(F.col("end") < F.col(SIZE)).drop("_run")


def merge_segments(segments: DataFrame, layout: Layout, gap: int = FLAT_GAP, long: int = FLAT_LONG) -> DataFrame:
    """Join neighbours at most ``gap`` apart when the part so far or the next one is longer than ``long``.

    A chain of close neighbours stays apart up to the segment before its first long one; from there on it is one
    segment, since a merged part is long as well. So one minimum per chain replaces the left-to-right walk.
    """
    keys = list(layout.keys)
    seg = number_rows(segments.drop(SIZE), layout.by("start"))
    by_pos = layout.by(POS)
    seg = bounded_frames(seg, by_pos, lambda w: [F.lag("end").over(w).alias("_pe")], back=1)
    new_chain = (F.col("_pe").isNull() | (F.col("start") - F.col("_pe") > gap)).cast("long")
    seg = running(seg, by_pos, {"_chain": ("sum", new_chain)})
    is_long = F.col("end") - F.col("start") > long
    chain = layout.within("_chain")
    seg = with_group_values(seg, chain, {"_first": F.min(F.when(is_long, F.col(POS))), "_head": F.min(POS)})
    joint = F.col("_first").isNotNull() & (F.col(POS) >= F.greatest(F.col("_first") - 1, F.col("_head")))  # greatest() skips NULL
    part = F.when(F.coalesce(joint, F.lit(False)), F.lit(-1).cast("long")).otherwise(F.col(POS))
    return seg.groupBy(*keys, "_chain", part.alias("_part")).agg(F.min("start").alias("start"), F.max("end").alias("end")).drop(
        "_chain", "_part"
    )


def longest_segment(segments: DataFrame, points: DataFrame, key: str = KEY) -> DataFrame:
    """Per series the segment that lasts longest in x (the first of equal ones): ``start, end, d``."""
    at = points.select(key, F.col(POS).alias("start"), F.col("x").alias("_x1"))
    to = points.select(key, F.col(POS).alias("end"), F.col("x").alias("_x2"))
    timed = segments.join(at, [key, "start"]).join(to, [key, "end"])
    timed = timed.withColumn("d", S.no_nan(F.col("_x2") - F.col("_x1"))).where(F.col("d").isNotNull())
    best = timed.groupBy(key).agg(
        F.max_by(F.struct("start", "end", "d"), F.struct("d", (-F.col("start")).alias("s"))).alias("_b")
    )
    return best.select(key, "_b.*")


def flat_part(base: DataFrame, layout: Layout) -> DataFrame:
    """Longest flat part of each series that lasts at least 0.3; ``base`` holds ``pos, n_rows, x, diff``."""
    flags = cancel_long_runs(flat_flags(base, layout), layout)
    segments = merge_segments(flag_segments(flags, layout), layout)
    return longest_segment(segments, base, layout.keys[0]).where(F.col("d") >= FLAT_MIN_TIME)


def _examined(f: Column, thinning: Sequence[tuple[int, int]]) -> Column:
    """Starts that no rule of ``thinning`` leaves out."""
    ok = F.lit(True)
    for beyond, step in thinning:
        ok = ok & ((f <= beyond) | (f % step == 0))
    return ok


def _least(cand: DataFrame, layout: Layout, order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` rows of each series; a large one is first reduced to ``k`` per salt, so no task ranks all of its rows."""
    for keys in ([layout.keys[0], "_salt"], [layout.keys[0]]) if layout.hot else ([layout.keys[0]],):
        if "_salt" in keys:
            cand = cand.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(TOP_SALTS)))
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        cand = cand.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r", *set(keys[1:]))
    return cand


def _from_start(df: DataFrame, key: str, x: str, y: str, start) -> DataFrame:
    """Drop the rows before ``start`` (a number, or the name of a column; NULL means 1) and number the rest from 0."""
    first = F.lit(start) if isinstance(start, int) else F.coalesce(F.col(start), F.lit(1))
    cut = _xy(df, key, x, y, first.cast("long").alias("_first")).where(F.col(POS) >= F.col("_first"))
    return cut.select(key, (F.col(POS) - F.col("_first")).alias(POS), (F.col(SIZE) - F.col("_first")).alias(SIZE), "x", "y")


def slope_base(df: DataFrame, layout: Layout, x: str = "time", y: str = "Pder", start: int | str = 1) -> DataFrame:
    """Points from ``start`` on with ``diff`` (first one 0)."""
    base = _from_start(df, layout.keys[0], x, y, start)
    base = bounded_frames(base, layout.by(POS), lambda w: [(F.col("y") - F.lag("y").over(w)).alias("_d")], back=1)
    return base.withColumn("diff", F.coalesce(S.no_nan(F.col("_d")), F.lit(0.0))).drop("_d")


def calm_series(base: DataFrame, layout: Layout) -> DataFrame:
    """Series with at most 3 outliers among the differences 3 ... 100."""
    key = layout.keys[0]
    head = base.where(F.col(POS).between(*SLOPE_BAD_ROWS)).select(key, "diff")
    whole = Window.partitionBy(key)
    high = F.avg("diff").over(whole) + SLOPE_BAD_SIGMAS * F.stddev("diff").over(whole)
    bad = head.select(key, (F.abs("diff") > high).alias("_bad")).groupBy(key).agg(F.count_if("_bad").alias("_n"))
    return base.select(key).distinct().join(bad.where(F.col("_n") > SLOPE_BAD_LIMIT), key, "left_anti")


def slope_line(
    df: DataFrame,
    layout: Layout,
    slope: float,
    x: str = "time",
    y: str = "Pder",
    start: int | str = 1,
    name: str = "value",
    *,
    shifts: Sequence[int] = SLOPE_SHIFTS,
    last_start: int | None = SLOPE_LAST_START,
    thinning: Sequence[tuple[int, int]] = SLOPE_THINNING,
    candidates: int = SLOPE_CANDIDATES,
) -> DataFrame:
    """Best segment of the given slope after ``start``: intercept ``{name}`` and ``{name}_end`` (counted from start).

    ``shifts``, ``last_start`` and ``thinning`` choose the grid of segments, ``candidates`` how many are compared by their errors.
    ``last_start=None, thinning=()`` examines every start of a series of any length.

    Every start f and shift s takes the nearest slope among all point pairs from f on. The pairs behind the last
    start are reduced to one per shift before any sort, so the sorted part is bounded by the grid of starts.
    """
    key = layout.keys[0]
    layout = layout.by(POS)
    base = durable(slope_base(df, layout, x, y, start))  # five plans read the points
    flat = abs(slope) <= 0.01
    if flat:
        limits = flat_part(base, layout).select(key, F.col("start").alias("lo"), F.col("end").alias("hi"))
        limited = base.join(limits, key)
    else:
        last = F.lit(last_start).cast("long")  # no last start: least() skips NULL
        limited = base.withColumns({"lo": F.lit(2).cast("long"), "hi": F.least(F.col(SIZE), last)})
    limited = limited.join(calm_series(base, layout), key, "left_semi")
    pairs = near_pairs(limited, layout, shifts, slope - SLOPE_TOLERANCE, slope + SLOPE_TOLERANCE, slope)
    pairs = pairs.where(F.col(POS) >= F.col("lo"))
    best = F.struct("err", POS, "k", "b", "d")
    grid = F.least(F.col(POS), F.col("hi"))
    reduced = pairs.groupBy(key, "s", grid.alias("_g"), "lo", "hi").agg(F.min(best).alias("c"))
    reduced = reduced.withColumnRenamed("_g", POS)
    per_shift = (layout if flat or last_start is None else Layout(layout.keys, (POS,), 0)).within("s")
    nearest = running(reduced, per_shift, {"_c": ("min", F.col("c"))}, reverse=True)
    back = running(nearest.drop("c"), per_shift, {"_prev": ("max", F.col(POS))}, exclusive=True)
    back = back.where(F.col("_c.d") >= SLOPE_MIN_LENGTH)
    first = F.greatest(F.col("_prev") + 1, F.col("lo"))
    last = F.least(F.col(POS), F.col("hi") - 1)
    back = back.select(key, "s", F.coalesce(first, F.col("lo")).alias("_f1"), last.alias("_f2"), "_c.err", "_c.k", "_c.b", "_c.d")
    back = back.where((F.col("_f1") <= F.col("_f2")) & F.col("b").isNotNull() & F.col("k").isNotNull())
    cand = back.select(key, "s", F.explode(F.sequence("_f1", "_f2")).alias("f"), "err", "k", "b", "d")
    cand = cand.where(_examined(F.col("f"), thinning))
    cand = _smooth_only(cand, base, layout, max(shifts))
    scan = F.struct("f", "s")
    cand = with_group_values(
        cand, layout, {"_stop": F.min(F.when(F.col("err") <= SLOPE_CLOSE, scan))}
    ).where(F.col("_stop").isNull() | (scan <= F.col("_stop")))
    cand = cand.withColumn("e", F.col("f") + F.col("s"))
    top = _least(cand, layout, ["err", "f", "e", "k", "b", "d"], candidates)
    lines = _line_errors(base, top, key, slope)
    each = lines.select(
        key,
        "e",
        F.explode(
            F.array(
                *[F.struct(F.col(m).alias("m"), F.col("f").alias("f"), F.col("e").alias("e"), F.col(b).alias("b"))
                  for m, b in (("mae1", "b1"), ("mae2", "b2"))]
            )
        ).alias("_l"),
    )
    chosen = each.groupBy(key).agg(F.min("_l").alias("_best"), F.max("e").alias("_end"))
    out = chosen.select(key, F.col("_best.b").alias(name), F.col("_end").alias(f"{name}_end"))
    return df.select(key).distinct().join(out, key, "left")


def _smooth_only(cand: DataFrame, base: DataFrame, layout: Layout, reach: int) -> DataFrame:
    """Keep (f, s) when no difference in f ... f + s exceeds its mean by 3.5 deviations."""
    key, block = layout.keys[0], reach + 1
    starts = cand.groupBy(key, "f").agg(F.max("s").alias("_far")).withColumn("_block", F.floor(F.col("f") / block))
    own = F.floor(F.col(POS) / block)
    points = base.select(key, POS, F.col("diff").alias("_d"), F.explode(F.array(own - 1, own)).alias("_block"))
    s = F.col(POS) - F.col("f")
    ahead = starts.join(points, [key, "_block"]).where(s.between(0, F.col("_far"))).select(key, "f", s.cast("int").alias("s"), "_d")
    w = Window.partitionBy(key, "f").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    smooth = F.max(F.abs("_d")).over(w) <= F.avg("_d").over(w) + SLOPE_SIGMAS * F.stddev("_d").over(w)
    calm = ahead.select(key, "f", "s", smooth.alias("_ok")).where("_ok")
    return cand.join(calm, [key, "f", "s"], "left_semi")
