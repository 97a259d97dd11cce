"""The segment searches against a plain search over lists, on made series with lines, flats, peaks and bad values."""

import math
import random
from itertools import groupby

import pytest

from panelkit.operators import segments as G
from panelkit.operators.ordered import SIZE, measure, number_rows


def stdev(v):
    m = sum(v) / len(v)
    return math.sqrt(sum((a - m) ** 2 for a in v) / (len(v) - 1)) if len(v) > 1 else math.nan


def line_error(pts, f, e, slope, b):
    return round(sum(abs(y - (slope * x + b)) for x, y in pts[f : e + 1]) / (e - f + 1), 5)


def nearest(pts, positions, s, slope, tol):
    """(err, pos, k, b, d) of the nearest slope in the band among pairs s apart."""
    best = None
    for a, b in zip(positions, positions[s:]):
        (x1, y1), (x2, y2) = pts[a], pts[b]
        if x2 != x1:
            k = (y2 - y1) / (x2 - x1)
            if slope - tol <= k <= slope + tol:
                c = (abs(k - slope), a, k, y1 - k * x1, x2 - x1)
                best = c if best is None or c[:2] < best[:2] else best
    return best


def unit_line(pts):
    n = len(pts)
    y = [p[1] for p in pts]
    peak = next((i for i in range(1, n - 3) if y[i] > max(y[max(0, i - 3) : i]) and y[i] >= max(y[i + 1 : i + 4])), None)
    x0 = min(p[0] for p in pts)
    near = [i for i in range(n) if pts[i][0] - x0 < 1.2 and (peak is None or i <= peak + 2)]
    found = []
    for f in range(3):
        use = [i for i in near if i >= f]
        for s in range(1, 26):
            c = nearest(pts, use, s, 1.0, 0.2)
            if c and c[4] >= 0.13:
                found.append((c[0], f, f + s, c[2], c[3], c[4]))
    found = sorted(found)[:5]
    if not found:
        return None, None
    scored = []
    for _, f, e, *_ in found:
        bs = [pts[i][1] - pts[i][0] for i in (f, e)]
        scored.append((sum(line_error(pts, f, e, 1.0, b) for b in bs) / 2, f, e, sum(bs) / 2))
    end = max(e for _, _, e, _ in scored)
    return min(scored)[3], end if peak is None else min(end, peak)


def flat_limits(pts, diff):
    n = len(pts)
    flat = [0 < i < n - 1 and abs(sum(diff[i - 1 : i + 2]) / 3) < 0.004 for i in range(n)]
    smooth = [0 < i < n - 1 and any(flat[i - 1 : i + 2]) for i in range(n)]
    at = 0
    for _, run in groupby(diff, key=lambda d: (d > 0) - (d < 0)):
        size = len(list(run))
        if size > 5 and all(smooth[at : at + size]):
            smooth[at : at + size] = [False] * size
        at += size
    parts, at = [], 0
    for value, run in groupby(smooth):
        size = len(list(run))
        if value and at + size < n:
            parts.append([at, at + size])
        at += size
    joined = []
    for a, b in parts:
        if joined and a - joined[-1][1] <= 5 and max(joined[-1][1] - joined[-1][0], b - a) > 15:
            joined[-1][1] = b
        else:
            joined.append([a, b])
    timed = [(pts[b][0] - pts[a][0], -a, b) for a, b in joined]
    d, a, b = max(timed, default=(0, 0, 0))
    return (-a, b) if d >= 0.3 else None


def slope_search(pts, slope, last=500, thinning=((200, 2), (400, 3), (600, 4)), shifts=range(1, 200), kept=7):
    pts = pts[1:]
    n = len(pts)
    diff = [0.0] + [b[1] - a[1] for a, b in zip(pts, pts[1:])]
    head = diff[3:101]
    if len(head) > 1 and sum(abs(d) > sum(head) / len(head) + 3 * stdev(head) for d in head) > 3:
        return None, None
    limits = (2, min(n, last))
    if abs(slope) <= 0.01:
        limits = flat_limits(pts, diff)
        if limits is None:
            return None, None
    found, stop = [], False
    for f in range(*limits):
        if any(f > beyond and f % step for beyond, step in thinning):
            continue
        for s in shifts:
            if s > 100 and s % 2:
                continue
            c = nearest(pts, range(f, n), s, slope, 0.2)
            part = diff[f : f + s + 1]
            if c and c[4] >= 0.5 and max(map(abs, part)) <= sum(part) / len(part) + 3.5 * stdev(part):
                found.append((c[0], f, f + s, c[2], c[3], c[4]))
                if c[0] <= 0.05:
                    stop = True
                    break
        if stop:
            break
    found = sorted(found)[:kept]
    scored = [
        (line_error(pts, f, e, slope, b), f, e, b)
        for _, f, e, *_ in found
        for b in [pts[i][1] - slope * pts[i][0] for i in (f, e)]
    ]
    return (min(scored)[3], max(e for _, _, e, _ in scored)) if scored else (None, None)


def made_series():
    rnd = random.Random(7)
    out = {}
    for i in range(26):
        n = rnd.choice([4, 12, 40, 75, 110])
        x, y, pts = -2.0, rnd.uniform(-1, 1), []
        k = rnd.choice([1.0, 0.5, -0.5, 0.0])
        for j in range(n):
            if j % 25 == 24:
                k = rnd.choice([1.0, 0.5, 0.25, -0.5, 0.0, 0.0])
            step = rnd.uniform(0.01, 0.06)
            x += step
            y += k * step + rnd.uniform(-0.002, 0.002)
            pts.append((x, y))
        out[f"made{i}"] = pts
    # Long flat stretches with small wobble, so that the flat search finds and joins parts.
    for i in range(6):
        x, y, pts = 0.0, 0.0, []
        for j in range(140):
            x += 0.02
            y = (0.3 * x if j < 20 else 6.0 + rnd.uniform(-0.0015, 0.0015)) if i % 2 else math.sin(j / 30) * 0.02 + rnd.uniform(-0.003, 0.003)
            if i >= 3 and j % 37 == 36:
                y += 0.02
            pts.append((x, y))
        out[f"flat{i}"] = pts
    out["one"] = [(0.0, 1.0)]
    out["same_x"] = [(0.0, float(j)) for j in range(8)]
    out["rising"] = [(0.1 * j, 0.1 * j + 2.0) for j in range(10)]
    return out


@pytest.fixture(scope="module")
def series(spark):
    made = made_series()
    rows = [(k, i, x, y) for k, pts in made.items() for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "file_name string, i int, time double, Pder double")
    layout = measure(df, "file_name", "i")
    return made, number_rows(df, layout).cache(), layout.by("pos")


def close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_unit_slope(series):
    made, df, layout = series
    got = {r.file_name: (r.wb_value, r.wb_end) for r in G.unit_slope_line(df, layout).collect()}
    want = {k: unit_line(p) for k, p in made.items()}
    assert sum(v[0] is not None for v in want.values()) >= 5
    for k, (b, e) in want.items():
        assert close(b, got[k][0]) and e == got[k][1], (k, want[k], got[k])


@pytest.mark.parametrize("slope,least", [(0.5, 3), (0.0, 2)])
def test_slope(series, slope, least):
    made, df, layout = series
    got = {r.file_name: (r.v, r.v_end) for r in G.slope_line(df, layout, slope, name="v").collect()}
    want = {k: slope_search(p, slope) for k, p in made.items()}
    assert sum(v[0] is not None for v in want.values()) >= least
    for k, (b, e) in want.items():
        assert close(b, got[k][0]) and e == got[k][1], (k, want[k], got[k])


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_slope_limits_are_arguments(spark, block):
    """Without a last start and thinning every start of a long series counts, in one window or in blocks."""
    rnd = random.Random(3)
    made = {}
    for name, bend in (("late", 700), ("early", 30)):
        y, pts = 0.0, []
        for j in range(760):
            y += (0.5 if bend <= j < bend + 45 else 3.0) * 0.02 + rnd.uniform(-0.001, 0.001)
            pts.append((0.02 * j, y))
        made[name] = pts
    rows = [(k, i, x, y) for k, pts in made.items() for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame(rows, "file_name string, i int, time double, Pder double")
    layout = measure(df, "file_name", "i", block)
    numbered = number_rows(df, layout)
    limits = {"last_start": None, "thinning": (), "shifts": range(1, 60), "candidates": 12}
    got = {r.file_name: (r.v, r.v_end) for r in G.slope_line(numbered, layout.by("pos"), 0.5, name="v", **limits).collect()}
    want = {k: slope_search(p, 0.5, last=10**9, thinning=(), shifts=range(1, 60), kept=12) for k, p in made.items()}
    assert all(v[0] is not None for v in want.values())
    for k, (b, e) in want.items():
        assert close(b, got[k][0]) and e == got[k][1], (k, want[k], got[k])


def test_exact_unit_line(series):
    _, df, layout = series
    row = G.unit_slope_line(df.where("file_name = 'rising'"), layout).first()
    assert math.isclose(row.wb_value, 2.0, abs_tol=1e-9)


def test_bad_values_are_not_lines(spark):
    inf = float("inf")
    rows = [("a", 0, 0.0, None), ("a", 1, 0.1, -inf), ("a", 2, 0.2, float("nan")), ("b", 0, -inf, 1.0), ("b", 1, 0.5, 2.0)]
    df = spark.createDataFrame(rows, "file_name string, i int, time double, Pder double")
    layout = measure(df, "file_name", "i")
    got = G.unit_slope_line(number_rows(df, layout), layout.by("pos")).collect()
    assert sorted((r.file_name, r.wb_value, r.wb_end) for r in got) == [("a", None, None), ("b", None, None)]


def test_peak_needs_three_neighbours(spark):
    y = [0, 1, 2, 3, 4, 9, 4, 3, 2, 9]
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(y)], "file_name string, i int, y double")
    layout = measure(df, "file_name", "i")
    assert G.first_peak(number_rows(df, layout), layout).first().peak_pos == 5


def test_no_cross_joins(series):
    _, df, layout = series
    for out in (G.unit_slope_line(df, layout), G.slope_line(df, layout, 0.5), G.slope_line(df, layout, 0.0)):
        plan = out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_merged_parts_are_those_of_a_walk(spark):
    """Chains of short parts stay apart, however close; a long part draws in its neighbours."""
    rng = random.Random(5)
    rows, want = [], set()
    for key in range(60):
        at, parts = 0, []
        for _ in range(12):
            start = at + rng.randint(1, 8)
            at = start + rng.choice([2, 3, 6, 15, 16, 17])
            parts.append((start, at))
        rows += [(key, s, e, 1000) for s, e in parts]
        s, e = parts[0]
        for s2, e2 in parts[1:]:
            if s2 - e <= 5 and (e - s > 15 or e2 - s2 > 15):
                e = e2
            else:
                want.add((key, s, e))
                s, e = s2, e2
        want.add((key, s, e))
    df = spark.createDataFrame(rows, f"file_name long, start long, end long, {SIZE} long")
    for block in (4, 1000):
        got = G.merge_segments(df, measure(df, "file_name", "start", block=block))
        assert {tuple(r) for r in got.select("file_name", "start", "end").collect()} == want
