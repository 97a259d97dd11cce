"""Checked queries over collections of series."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import features as A
from panelkit.operators import segments as G
from panelkit.operators import series as Q
from panelkit.operators.ordered import POS, SIZE
from panelkit.plans import series_pipeline as L
from panelkit.workload import inputs as I
from panelkit.workload.inputs import r, tidy, with_inputs

K = "file_name"
COLUMNS = ["time", "dP", "Pder", "T", "P", "D"]
W = "(PARTITION BY file_name ORDER BY pos"
PLACES = {"variance": 3, "abs_energy": 1}


# -------------------------------------------------------------------------------------------- queries


def log_series(spark, sf):
    s, _ = I.series(spark, sf)
    return tidy(s.select(K, "event_id", POS, SIZE, *COLUMNS))


def series_diffs(spark, sf):
    s, layout = I.series(spark, sf)
    d = Q.add_diffs(s, layout, COLUMNS)
    return tidy(d.select(K, "event_id", *[F.col(f"_d_{c}").alias(f"{c}_d") for c in COLUMNS]))


def series_elapsed(spark, sf):
    s, layout = I.series(spark, sf)
    return tidy(Q.elapsed(s, layout).select(K, "event_id", "elapsed"))


def series_summary(spark, sf):
    s, layout = I.series(spark, sf)
    return tidy(Q.summary(s, layout, COLUMNS))


def series_growth(spark, sf):
    s, layout = I.series(spark, sf)
    return Q.growth(s, layout, ["dP", "P"])


def series_bins(spark, sf):
    s, layout = I.series(spark, sf)
    return tidy(Q.bin_statistics(s, layout, ["Pder", "D"]))


def _universe(spark, sf):
    """Customers as the universe: most of them have no events."""
    return I.table(spark, sf, "customer").select(F.col("c_custkey").alias(K))


def series_row_counts(spark, sf):
    s, _ = I.series(spark, sf)
    return Q.row_counts(s, _universe(spark, sf))


def series_stats(spark, sf):
    s, layout = I.series(spark, sf)
    return tidy(L.hand_features(s, layout, _universe(spark, sf)))


def _xy(spark, sf):
    s, layout = I.series(spark, sf)
    return G._xy(s, K, "time", "Pder"), layout


def first_peak(spark, sf):
    return G.first_peak(*_xy(spark, sf))


def near_pairs(spark, sf):
    s, layout = _xy(spark, sf)
    pairs = G.near_pairs(s, layout, range(1, 26), 0.8, 1.2, 1.0)
    return tidy(pairs.select(K, POS, "s", "k", "b", "d"))


def unit_slope_line(spark, sf):
    s, layout = I.series(spark, sf)
    return tidy(G.unit_slope_line(s, layout))


def tail_boundary(spark, sf):
    s, layout = I.series(spark, sf)
    return tidy(G.tail_boundary(s, layout))


def _flat_base(spark, sf):
    """Differences of the raw value: short flat stretches occur when the values are coarse."""
    s, layout = I.series(spark, sf)
    coarse = F.floor(F.col("D") / 2000) * 0.002
    base = s.select(K, POS, SIZE, coarse.alias("y"), F.col("time").alias("x"))
    return Q.add_diffs(base, layout, ["y"]).withColumn("diff", F.coalesce("_d_y", F.lit(0.0))).drop("_d_y"), layout


def flat_flags(spark, sf):
    return G.flat_flags(*_flat_base(spark, sf)).select(K, POS, "is_flat", "smoothed")


def sign_islands(spark, sf):
    base, layout = _flat_base(spark, sf)
    return G.islands(base, layout, F.signum("diff"), "island").select(K, POS, "island")


def cancelled_runs(spark, sf):
    base, layout = _flat_base(spark, sf)
    return G.cancel_long_runs(G.flat_flags(base, layout), layout).select(K, POS, "island", "smoothed")


def flag_segments(spark, sf):
    base, layout = _flat_base(spark, sf)
    return G.flag_segments(G.flat_flags(base, layout), layout).select(K, "start", "end")


def merged_segments(spark, sf):
    base, layout = _flat_base(spark, sf)
    return G.merge_segments(G.flag_segments(G.flat_flags(base, layout), layout), layout)


def longest_segment(spark, sf):
    base, layout = _flat_base(spark, sf)
    return tidy(G.longest_segment(G.flag_segments(G.flat_flags(base, layout), layout), base))


def _slope(slope, name):
    def query(spark, sf):
        s, layout = I.series(spark, sf)
        return tidy(G.slope_line(s, layout, slope, name=name))

    return query


def slope_flat(spark, sf):
    s, layout = I.series(spark, sf)
    return tidy(G.slope_line(s, layout, 0.0, name="ra_value"))


def _features(names):
    def query(spark, sf):
        s, layout = I.series(spark, sf)
        return tidy(A.long_features(s, layout, ["Pder", "D"], POS, features=names), coarse=PLACES)

    return query


def feature_matrix(spark, sf):
    s, layout = I.series(spark, sf)
    return tidy(A.series_features(s, layout, ["Pder", "D"], POS), coarse=PLACES)


# -------------------------------------------------------------------------------------------- SQL


def _guard(e):
    return f"CASE WHEN NOT isnan({e}) THEN {e} END"


DIFFS = {
    "d": "SELECT file_name, event_id, pos, n_rows, " + ", ".join(COLUMNS) + ", "
    + ", ".join(f"{_guard(f'({c} - lag({c}) OVER {W}))')} AS d_{c}" for c in COLUMNS)
    + " FROM series"
}
SUMMARY = DIFFS | {
    "m": "SELECT file_name, "
    + ", ".join(f"avg(d_{c}) AS m_{c}, stddev_samp(d_{c}) AS s_{c}" for c in COLUMNS)
    + " FROM d GROUP BY file_name",
    "summary": "SELECT file_name, "
    + ", ".join(
        ", ".join(
            [
                r(f"stddev_samp({c})", f"{c}_std"),
                r(f"avg({c})", f"{c}_mean"),
                r(f"quantile_cont({c}, 0.5)", f"{c}_median"),
                r(f"max(d_{c})", f"{c}_diff_max"),
                r(f"stddev_samp(d_{c})", f"{c}_diff_std"),
                r(f"avg(d_{c})", f"{c}_diff_mean"),
                r(f"quantile_cont(d_{c}, 0.5)", f"{c}_diff_median"),
                *[
                    r(f"count(*) FILTER (abs(d_{c}) > m_{c} + {k} * s_{c})::DOUBLE / count(*) * 100", f"{c}_{k}_std")
                    for k in (1, 2, 3)
                ],
            ]
        )
        for c in COLUMNS
    )
    + " FROM d JOIN m USING (file_name) GROUP BY file_name",
}


def _growth_part(c):
    g = f"(PARTITION BY file_name ORDER BY pos)"
    mean = f"avg(d_{c}) OVER (PARTITION BY file_name ORDER BY pos ROWS 2 PRECEDING)"
    return {
        f"g1_{c}": f"SELECT file_name, pos, {mean} AS v FROM d WHERE d_{c} IS NOT NULL",
        f"g2_{c}": f"SELECT file_name, v - lag(v) OVER {g} AS step FROM g1_{c}",
        f"g3_{c}": f"SELECT file_name, CAST(coalesce(bool_and(step >= 0), true) AS INTEGER) AS g FROM g2_{c} GROUP BY 1",
    }


GROWTH = DIFFS | _growth_part("dP") | _growth_part("P")
GROWTH["growth"] = """SELECT u.file_name, coalesce(a.g, 1) AS "dP_growth", coalesce(b.g, 1) AS "P_growth"
FROM (SELECT DISTINCT file_name FROM d) u LEFT JOIN g3_dP a USING (file_name) LEFT JOIN g3_P b USING (file_name)"""

BIN_SETS = (
    ((0.06, 0.15, 0.3, 0.42, 0.54, 0.66, 0.78, 0.9), ("0_06", "0_15", "0_3", "0_42", "0_54", "0_66", "0_78", "0_9", "1_1")),
    ((0.2, 0.4, 0.6, 0.8), ("0_2", "0_4", "0_6", "0_8", "1_2")),
)


def _bin_sql():
    parts = []
    for c in ("Pder", "D"):
        for probs, names in BIN_SETS:
            q = f"quantile_cont(coalesce(d_{c}, 0), [{', '.join(map(str, probs))}]) OVER (PARTITION BY file_name)"
            inner = f"SELECT file_name, coalesce(d_{c}, 0) AS v, {q} AS e FROM d"
            edges = ["'-inf'::DOUBLE", *[f"e[{i + 1}]" for i in range(len(probs))], "'inf'::DOUBLE"]
            for i, n in enumerate(names):
                parts.append(
                    f"SELECT file_name, '{c}_q_{n}' AS bin, v FROM ({inner}) WHERE {edges[i]} < v AND v <= {edges[i + 1]}"
                )
    stats = {
        "binned": " UNION ALL ".join(parts),
        "bm": "SELECT file_name, bin, avg(v) AS m, stddev_samp(v) AS s FROM binned GROUP BY 1, 2",
        "per_bin": "SELECT file_name, bin, max(v) AS mx, stddev_samp(v) AS sd, avg(v) AS mean, quantile_cont(v, 0.5) AS med, "
        + ", ".join(f"count(*) FILTER (abs(v) > m + {k} * s)::DOUBLE / count(*) * 100 AS k{k}" for k in (1, 2, 3))
        + " FROM binned JOIN bm USING (file_name, bin) GROUP BY 1, 2",
    }
    cols = []
    for c in ("Pder", "D"):
        for _, names in BIN_SETS:
            for n in names:
                b = f"{c}_q_{n}"
                for s, o in (("mx", "max"), ("sd", "std"), ("mean", "mean"), ("med", "median")):
                    cols.append(r(f"max({s}) FILTER (bin = '{b}')", f"{b}_{o}"))
                cols += [r(f"coalesce(max(k{k}) FILTER (bin = '{b}'), 0)", f"{b}_{k}_std") for k in (1, 2, 3)]
    return stats | {"bins": "SELECT file_name, " + ",\n".join(cols) + " FROM per_bin GROUP BY file_name"}


BINS = DIFFS | _bin_sql()

PEAKS = {
    "xy": "SELECT file_name, pos, n_rows, time AS x, Pder AS y FROM series",
    "pk": """SELECT *, y > max(y) OVER b AND y >= max(y) OVER a AND count(y) OVER a = 3
    AND count(y) OVER b = least(pos, 3) AND pos >= 1 AS peak FROM xy
  WINDOW b AS (PARTITION BY file_name ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
    a AS (PARTITION BY file_name ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)""",
}
UNIT = PEAKS | {
    "hd": """SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY pos) AS rk FROM (
  SELECT *, x - min(x) OVER g AS t, min(pos) FILTER (peak) OVER g AS p FROM pk WINDOW g AS (PARTITION BY file_name))
  WHERE t < 1.2 AND (p IS NULL OR pos <= p + 2)""",
    "pr": """SELECT *, abs(k - 1) AS err, y - k * x AS b FROM (SELECT a.file_name, a.pos, a.p, a.x, a.y, b.rk - a.rk AS s,
    b.x - a.x AS d, (b.y - a.y) / nullif(b.x - a.x, 0) AS k
  FROM hd a JOIN hd b ON a.file_name = b.file_name AND b.rk - a.rk BETWEEN 1 AND 25) WHERE k BETWEEN 0.8 AND 1.2""",
    "cd": """SELECT file_name, f, f + s AS e, p, c.err AS err, c.k AS k, c.b AS b, c.d AS d FROM (
    SELECT file_name, s, f, any_value(p) AS p, min(struct_pack(err := err, pos := pos, k := k, b := b, d := d)) AS c
    FROM pr JOIN (VALUES (0), (1), (2)) v(f) ON pos >= f GROUP BY file_name, s, f) WHERE c.d >= 0.13""",
    "tp": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY err, f, e, k, b, d) AS rn FROM cd)
  WHERE rn <= 5""",
    "ln": """SELECT file_name, f, e, p, round(avg(abs(y - (x + b1))), 5) AS m1, round(avg(abs(y - (x + b2))), 5) AS m2,
    any_value(b1) AS b1, any_value(b2) AS b2 FROM (
    SELECT t.file_name, t.f, t.e, t.p, s.x, s.y, u.y - u.x AS b1, v.y - v.x AS b2
    FROM tp t JOIN xy s ON s.file_name = t.file_name AND s.pos BETWEEN t.f AND t.e
    JOIN xy u ON u.file_name = t.file_name AND u.pos = t.f JOIN xy v ON v.file_name = t.file_name AND v.pos = t.e)
  GROUP BY file_name, f, e, p""",
    "bw": """SELECT file_name, (min(struct_pack(m := (m1 + m2) / 2, f := f, e := e, b := (b1 + b2) / 2))).b AS wb_value,
    least(max(e), any_value(p)) AS wb_end FROM ln GROUP BY file_name""",
    "unit": f"""SELECT u.file_name, {r('wb_value', 'wb_value')}, CAST(wb_end AS BIGINT) AS wb_end
  FROM (SELECT DISTINCT file_name FROM series) u LEFT JOIN bw USING (file_name)""",
}

COARSE = {
    "cb": f"""SELECT file_name, pos, n_rows, time AS x, floor(D / 2000) * 0.002::DOUBLE AS y FROM series""",
    "cs": f"SELECT *, coalesce(y - lag(y) OVER {W}), 0) AS diff FROM cb",
    "fl": f"""SELECT *, coalesce(count(*) OVER {W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 3
    AND abs(avg(diff) OVER {W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) < 0.004, false) AS is_flat FROM cs""",
    "sm": f"""SELECT *, count(*) OVER {W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 3
    AND avg(CAST(is_flat AS INTEGER)) OVER {W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) > 0.2 AS smoothed FROM fl""",
    "il": f"""SELECT *, CAST(sum(ch) OVER {W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM (
    SELECT *, CASE WHEN sign(diff) = lag(sign(diff)) OVER {W}) THEN 0 ELSE 1 END AS ch FROM sm)""",
    "cx": """SELECT file_name, pos, island, smoothed AND NOT (count(*) OVER g > 5 AND bool_and(smoothed) OVER g) AS smoothed
  FROM il WINDOW g AS (PARTITION BY file_name, island)""",
    "sg": f"""SELECT file_name, min(pos) AS start, max(pos) + 1 AS "end" FROM (
    SELECT *, pos - row_number() OVER {W}) AS grp FROM sm WHERE smoothed)
  GROUP BY file_name, grp HAVING max(pos) + 1 < any_value(n_rows)""",
    "sn": 'SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY start) AS i FROM sg',
}
# The merge of neighbours as it is defined: a walk over the segments from left to right.
WALK = """SELECT file_name, i, start AS s, "end" AS e, 1 AS part FROM sn WHERE i = 1
  UNION ALL
  SELECT n.file_name, n.i, CASE WHEN n.start - w.e <= 5 AND (w.e - w.s > 15 OR n."end" - n.start > 15) THEN w.s ELSE n.start END,
    n."end", CASE WHEN n.start - w.e <= 5 AND (w.e - w.s > 15 OR n."end" - n.start > 15) THEN w.part ELSE w.part + 1 END
  FROM walk w JOIN sn n ON n.file_name = w.file_name AND n.i = w.i + 1"""
MERGED_PARTS = 'SELECT file_name, min(s) AS start, max(e) AS "end" FROM walk GROUP BY file_name, part'
MERGE = "WITH RECURSIVE {ctes},\nwalk AS (" + WALK + ")\n" + MERGED_PARTS


def _recursive(body, *names, extra):
    plain = with_inputs("", *names, extra=extra).strip()
    return body.format(ctes=plain.removeprefix("WITH "))


def _flat_parts():
    """The longest flat part of each series: the steps of COARSE over the points from the second on."""
    return {
        "cs": "SELECT file_name, pos, n AS n_rows, x, diff FROM b1",
        **{name: COARSE[name] for name in ("fl", "sm", "il", "cx")},
        "sg": f"""SELECT file_name, min(pos) AS start, max(pos) + 1 AS "end" FROM (
    SELECT *, pos - row_number() OVER {W}) AS grp FROM cx JOIN cs USING (file_name, pos) WHERE smoothed)
  GROUP BY file_name, grp HAVING max(pos) + 1 < any_value(n_rows)""",
        "sn": COARSE["sn"],
        "walk": WALK,
        "mg": MERGED_PARTS,
        "lim": """SELECT file_name, start AS lo, "end" AS hi FROM (SELECT mg.*, b.x - a.x AS d,
    row_number() OVER (PARTITION BY mg.file_name ORDER BY b.x - a.x DESC, start) AS rn FROM mg
    JOIN b1 a ON a.file_name = mg.file_name AND a.pos = mg.start JOIN b1 b ON b.file_name = mg.file_name AND b.pos = mg."end")
  WHERE rn = 1 AND d >= 0.3""",
    }


def _slope_sql(c, name):
    flat = c == 0
    thin = "NOT ((f > 200 AND f % 2 <> 0) OR (f > 400 AND f % 3 <> 0) OR (f > 600 AND f % 4 <> 0) OR (f > 1000 AND f % 5 <> 0))"
    lim = "SELECT DISTINCT file_name, 2 AS lo, least(n, 500) AS hi FROM b1"
    extra = {
        "b0": f"SELECT file_name, pos - 1 AS pos, n_rows - 1 AS n, time AS x, Pder AS y FROM series WHERE pos >= 1",
        "b1": f"SELECT *, coalesce({_guard(f'(y - lag(y) OVER {W}))')}, 0) AS diff FROM b0",
        "bad": """SELECT file_name FROM (SELECT file_name, diff, avg(diff) OVER g + 3 * stddev_samp(diff) OVER g AS hi
  FROM b1 WHERE pos BETWEEN 3 AND 100 WINDOW g AS (PARTITION BY file_name)) WHERE abs(diff) > hi
  GROUP BY file_name HAVING count(*) > 3""",
        **(_flat_parts() if flat else {"lim": lim}),
        "pr": f"""SELECT *, abs(k - ({c})) AS err, y - k * x AS b FROM (SELECT a.file_name, a.n, a.pos, a.x, a.y, b.pos - a.pos AS s,
    b.x - a.x AS d, (b.y - a.y) / nullif(b.x - a.x, 0) AS k
  FROM b1 a JOIN b1 b ON a.file_name = b.file_name AND b.pos - a.pos BETWEEN 1 AND 199
  WHERE a.file_name NOT IN (SELECT file_name FROM bad)) WHERE k BETWEEN {c} - 0.2 AND {c} + 0.2 AND (s <= 100 OR s % 2 = 0)""",
        "cd": f"""SELECT file_name, f, s, f + s AS e, c.err AS err, c.k AS k, c.b AS b, c.d AS d FROM (
    SELECT file_name, s, f, min(struct_pack(err := err, pos := pos, k := k, b := b, d := d)) AS c
    FROM pr JOIN (SELECT file_name, unnest(range(lo, hi)) AS f FROM lim) v USING (file_name)
    WHERE pos >= f AND {thin} GROUP BY file_name, s, f) WHERE c.d >= 0.5""",
        "ok": """SELECT c.file_name, c.f, c.s FROM cd c JOIN b1 ON b1.file_name = c.file_name AND b1.pos BETWEEN c.f AND c.e
  GROUP BY 1, 2, 3 HAVING max(abs(diff)) <= avg(diff) + 3.5 * stddev_samp(diff)""",
        "ac": "SELECT * FROM cd JOIN ok USING (file_name, f, s)",
        "st": """SELECT * FROM ac JOIN (SELECT file_name, min(CASE WHEN err <= 0.05 THEN f * 1000 + s END) AS stop FROM ac GROUP BY 1)
  USING (file_name) WHERE stop IS NULL OR f * 1000 + s <= stop""",
        "tp": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY err, f, e, k, b, d) AS rn FROM st)
  WHERE rn <= 7""",
        "ln": f"""SELECT t.file_name, t.f, t.e, z.b AS b, round(avg(abs(s.y - ({c} * s.x + z.b))), 5) AS m
  FROM tp t JOIN (SELECT file_name, pos, y - {c} * x AS b FROM b1) z ON z.file_name = t.file_name AND z.pos IN (t.f, t.e)
  JOIN b1 s ON s.file_name = t.file_name AND s.pos BETWEEN t.f AND t.e GROUP BY t.file_name, t.f, t.e, z.pos, z.b""",
        "bw": """SELECT file_name, (min(struct_pack(m := m, f := f, e := e, b := b))).b AS v, max(e) AS last FROM ln GROUP BY 1""",
    }
    sql = with_inputs(
        f"""SELECT u.file_name, {r('v', name)}, CAST(last AS BIGINT) AS "{name}_end"
FROM (SELECT DISTINCT file_name FROM series) u LEFT JOIN bw USING (file_name)""",
        "series",
        extra=extra,
    ).strip()
    return "WITH RECURSIVE " + sql.removeprefix("WITH ") if flat else sql


def _stacked(kinds):
    return {"lg": " UNION ALL ".join(f"SELECT file_name, pos, '{c}' AS kind, {c} AS v FROM series WHERE {c} IS NOT NULL" for c in kinds)} | STACKED


STACKED = {
    "ln": """SELECT *, row_number() OVER w - 1 AS i, count(*) OVER g AS n, avg(v) OVER g AS mean, stddev_pop(v) OVER g AS sd, """
    + ", ".join(f"lag(v, {i}) OVER w AS b{i}, lead(v, {i}) OVER w AS a{i}" for i in range(1, 6))
    + " FROM lg WINDOW w AS (PARTITION BY file_name, kind ORDER BY pos), g AS (PARTITION BY file_name, kind)",
}
FEATURES = {
    "sum_values": "sum(v)",
    "median": "quantile_cont(v, 0.5)",
    "mean": "avg(v)",
    "length": None,
    "standard_deviation": "stddev_pop(v)",
    "variance": "var_pop(v)",
    "root_mean_square": "sqrt(avg(v * v))",
    "maximum": "max(v)",
    "absolute_maximum": "max(abs(v))",
    "minimum": "min(v)",
    "abs_energy": "sum(v * v)",
    "skewness": "skewness(v)",
    "kurtosis": "kurtosis(v)",
    "variation_coefficient": "stddev_pop(v) / avg(v)",
    "mean_abs_change": "avg(abs(v - b1))",
    "mean_change": "(max(v) FILTER (i = n - 1) - max(v) FILTER (i = 0)) / (max(n) - 1)",
    "absolute_sum_of_changes": "sum(abs(v - b1))",
    "mean_second_derivative_central": "(max(v - b1) FILTER (i = n - 1) - max(v - b1) FILTER (i = 1)) / (2 * (max(n) - 2))",
    "cid_ce": "sqrt(sum((v - b1) * (v - b1)))",
    "first_location_of_maximum": "min(i) FILTER (v = mx)::DOUBLE / max(n)",
    "last_location_of_minimum": "(max(i) FILTER (v = mn) + 1)::DOUBLE / max(n)",
    "linear_trend_slope": "regr_slope(v, i)",
    "linear_trend_intercept": "regr_intercept(v, i)",
}
WHOLE = {
    "length": "count(*)",
    "count_above_mean": "count(*) FILTER (v > mean)",
    "count_below_mean": "count(*) FILTER (v < mean)",
    "has_duplicate": "CAST(count(DISTINCT v) < count(*) AS INTEGER)",
}

def _feature_exprs():
    out = {n: r(e, n, PLACES.get(n, 6)) for n, e in FEATURES.items() if e}
    out |= {n: f"{e} AS {n}" for n, e in WHOLE.items()}
    for q in A.QUANTILES:
        out[f"quantile__q_{q}"] = r(f"quantile_cont(v, {q})", f"quantile__q_{q}")
    for k in A.SIGMAS:
        out[f"ratio_beyond_r_sigma__r_{k:g}"] = r(
            f"count(*) FILTER (abs(v - mean) > {k} * sd)::DOUBLE / max(n)", f"ratio_beyond_r_sigma__r_{k:g}"
        )
    for i in A.LAGS:
        out[f"autocorrelation__lag_{i}"] = r(
            f"sum((v - mean) * (b{i} - mean)) / (max(n) - {i}) / nullif(var_pop(v), 0)", f"autocorrelation__lag_{i}"
        )
    for k in A.PEAK_SUPPORTS:
        sides = " AND ".join(f"v > {s}{i}" for s in "ab" for i in range(1, k + 1))
        out[f"number_peaks__n_{k}"] = f'count(*) FILTER ({sides}) AS "number_peaks__n_{k}"'
    return out


STRIKES = {
    name: f"""SELECT file_name, kind, max(c) AS {name} FROM (SELECT file_name, kind, gap, count(*) FILTER ({flag}) AS c FROM (
    SELECT *, sum(CASE WHEN {flag} THEN 0 ELSE 1 END) OVER (PARTITION BY file_name, kind ORDER BY pos) AS gap FROM ln)
  GROUP BY 1, 2, 3) GROUP BY 1, 2"""
    for name, flag in (("longest_strike_above_mean", "v > mean"), ("longest_strike_below_mean", "v < mean"))
}


def _features_sql(names, kinds=("Pder", "D")):
    exprs = _feature_exprs()
    plain = [exprs[n] for n in names if n in exprs]
    strikes = [n for n in names if n in STRIKES]
    extra = _stacked(kinds) | {"fx": "SELECT *, max(v) OVER (PARTITION BY file_name, kind) AS mx, min(v) OVER (PARTITION BY file_name, kind) AS mn FROM ln"}
    extra |= {f"s_{n}": STRIKES[n] for n in strikes}
    body = "SELECT file_name, kind, " + ",\n".join(plain or ["count(*) AS _n"]) + " FROM fx GROUP BY file_name, kind"
    if strikes:
        joins = " ".join(f"JOIN s_{n} USING (file_name, kind)" for n in strikes)
        body = f"SELECT * FROM ({body}) {joins}"
    return with_inputs(body, "series", extra=extra)


ZERO = [*Q.EMPTY_ZERO]
STATS = SUMMARY | GROWTH | BINS | UNIT


def _stats_sql():
    zero = ", ".join(f'CASE WHEN count_rows = 0 THEN 0 ELSE "{c}" END AS "{c}"' for c in ZERO)
    return with_inputs(
        f"""SELECT * REPLACE ({zero}) FROM (
SELECT u.file_name, coalesce(n, 0) AS count_rows, summary.* EXCLUDE (file_name), growth.* EXCLUDE (file_name),
  bins.* EXCLUDE (file_name), wb_value
FROM (SELECT DISTINCT c_custkey AS file_name FROM customer) u
LEFT JOIN (SELECT file_name, count(*) AS n FROM series GROUP BY 1) c USING (file_name)
LEFT JOIN summary USING (file_name) LEFT JOIN growth USING (file_name) LEFT JOIN bins USING (file_name)
LEFT JOIN unit USING (file_name))""",
        "series",
        extra=STATS,
    )


CASES = {
    "log_series": (
        log_series,
        with_inputs(
            "SELECT file_name, event_id, pos, n_rows, " + ", ".join(r(c, c) for c in COLUMNS) + " FROM series", "series"
        ),
    ),
    "series_diffs": (
        series_diffs,
        with_inputs("SELECT file_name, event_id, " + ", ".join(r(f"d_{c}", f"{c}_d") for c in COLUMNS) + " FROM d", "series", extra=DIFFS),
    ),
    "series_elapsed": (
        series_elapsed,
        with_inputs(
            f"SELECT file_name, event_id, {r('time - min(time) OVER (PARTITION BY file_name)', 'elapsed')} FROM series", "series"
        ),
    ),
    "series_summary": (series_summary, with_inputs("SELECT * FROM summary", "series", extra=SUMMARY)),
    "series_growth": (series_growth, with_inputs("SELECT * FROM growth", "series", extra=GROWTH)),
    "series_bins": (series_bins, with_inputs("SELECT * FROM bins", "series", extra=BINS)),
    "series_row_counts": (
        series_row_counts,
        """SELECT c_custkey AS file_name, count(event_id) AS count_rows FROM customer LEFT JOIN events ON user_id = c_custkey
GROUP BY 1""",
    ),
    "series_stats": (series_stats, _stats_sql()),
    "first_peak": (
        first_peak,
        with_inputs("SELECT file_name, min(pos) AS peak_pos FROM pk WHERE peak GROUP BY 1", "series", extra=PEAKS),
    ),
    "near_pairs": (
        near_pairs,
        with_inputs(
            f"""SELECT file_name, pos, s, {r('k', 'k')}, {r('y - k * x', 'b')}, {r('d', 'd')} FROM (
SELECT a.file_name, a.pos, CAST(b.pos - a.pos AS INTEGER) AS s, a.x, a.y, b.x - a.x AS d, (b.y - a.y) / nullif(b.x - a.x, 0) AS k
FROM xy a JOIN xy b ON a.file_name = b.file_name AND b.pos - a.pos BETWEEN 1 AND 25) WHERE k BETWEEN 0.8 AND 1.2""",
            "series",
            extra=PEAKS,
        ),
    ),
    "unit_slope_line": (unit_slope_line, with_inputs("SELECT * FROM unit", "series", extra=UNIT)),
    "tail_boundary": (
        tail_boundary,
        with_inputs(
            f"""SELECT u.file_name, {r('v', 'pc_value')}, pc_pos FROM (SELECT DISTINCT file_name FROM series) u LEFT JOIN (
SELECT file_name, arg_min(x, rev) AS v, arg_min(pos, rev) AS pc_pos FROM (SELECT *, n_rows - 1 - pos AS rev,
  max(y) OVER {W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mx FROM xy)
WHERE rev > 7 AND rev < least(30, n_rows - 7) AND y >= mx GROUP BY 1) USING (file_name)""",
            "series",
            extra=PEAKS,
        ),
    ),
    "flat_flags": (flat_flags, with_inputs("SELECT file_name, pos, is_flat, smoothed FROM sm", "series", extra=COARSE)),
    "sign_islands": (sign_islands, with_inputs("SELECT file_name, pos, island FROM il", "series", extra=COARSE)),
    "cancelled_runs": (cancelled_runs, with_inputs("SELECT * FROM cx", "series", extra=COARSE)),
    "flag_segments": (flag_segments, with_inputs("SELECT * FROM sg", "series", extra=COARSE)),
    "merged_segments": (merged_segments, _recursive(MERGE, "series", extra=COARSE)),
    "longest_segment": (
        longest_segment,
        with_inputs(
            f"""SELECT file_name, start, "end", {r('d', 'd')} FROM (SELECT sg.*, b.x - a.x AS d,
  row_number() OVER (PARTITION BY sg.file_name ORDER BY b.x - a.x DESC, start) AS rn FROM sg
  JOIN cb a ON a.file_name = sg.file_name AND a.pos = sg.start JOIN cb b ON b.file_name = sg.file_name AND b.pos = sg."end")
WHERE rn = 1""",
            "series",
            extra=COARSE,
        ),
    ),
    "slope_line_half": (_slope(0.5, "li_value"), _slope_sql(0.5, "li_value")),
    "slope_line_quarter": (_slope(0.25, "bl_value"), _slope_sql(0.25, "bl_value")),
    "slope_line_falling": (_slope(-0.5, "sp_value"), _slope_sql(-0.5, "sp_value")),
    "slope_line_flat": (slope_flat, _slope_sql(0, "ra_value")),
    "features_minimal": (_features(A.MINIMAL), _features_sql(A.MINIMAL)),
    "features_order_free": (
        _features([*A.ORDER_FREE, *[n for n in A.feature_names() if n.startswith(("quantile", "ratio"))]]),
        _features_sql([*A.ORDER_FREE, *[n for n in A.feature_names() if n.startswith(("quantile", "ratio"))]]),
    ),
    "features_ordered": (
        _features([*A.ORDERED, *[n for n in A.feature_names() if n.startswith(("autoc", "number"))]]),
        _features_sql([*A.ORDERED, *[n for n in A.feature_names() if n.startswith(("autoc", "number"))]]),
    ),
}


def matrix_sql(kinds=("Pder", "D"), rename=None, more=""):
    """The features of several columns side by side; ``rename`` also fills what is missing with 0, as feature tables do."""
    names = A.feature_names()
    inner = _features_sql(names, kinds)
    ctes, inner = inner.split("\nSELECT", 1)
    cols = []
    for k in kinds:
        for n in names:
            value, name = f'any_value("{n}") FILTER (kind = \'{k}\')', f"{k}__{n}"
            cols.append(f'{value} AS "{name}"' if rename is None else f'coalesce({value}, 0) AS "{rename(name)}"')
    return f"{ctes}\nSELECT file_name, {more}" + ",\n".join(cols) + f" FROM (SELECT{inner}) GROUP BY file_name"


CASES["feature_matrix"] = (feature_matrix, matrix_sql())
