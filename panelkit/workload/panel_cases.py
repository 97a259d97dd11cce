"""Checked queries over the weekly panel, the calendar and the profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import calendar as C
from panelkit.operators import panel as P
from panelkit.operators import profile as R
from panelkit.operators import schema as H
from panelkit.operators.labels import sample_keys
from panelkit.plans import panel_pipeline as L
from panelkit.session import shared_dir
from panelkit.workload import inputs as I
from panelkit.workload.inputs import r, tidy, with_inputs

W = "(PARTITION BY inn_id ORDER BY week"
VALUES = ["target", "trns_amount_inp", "trns_count_inp", "cnt_inn_inp", "tvect_F", "tvect_O"]
MONEY = ["target", "trns_amount_inp"]
WIDTHS = (4, 8, 12, 16, 48)
BASE = "inn_id, week"
WHOLE = ("trns_count_inp", "cnt_inn_inp", "tvect_")


def keyed(df, *cols):
    """Key columns and the columns that an operator added."""
    return tidy(df.select("inn_id", "week", *cols))


def added(df, base):
    return [c for c in df.columns if c not in base.columns]


# -------------------------------------------------------------------------------------------- SQL parts


def lag_sql(c, n):
    return f"lag({c}, {n}) OVER {W})" if n > 0 else (c if n == 0 else f"lead({c}, {-n}) OVER {W})")


def shift_sql(c, delta=1, start=1, total=24):
    return [f'{lag_sql(c, i - start + delta)} AS "{c}_shift{i:02d}"' for i in range(start, start + total)]


def frame(rows, delta):
    return f"{W} ROWS BETWEEN {rows - 1 + delta} PRECEDING AND {f'{delta} PRECEDING' if delta else 'CURRENT ROW'})"


def rolling_sql(c, delta=1):
    out = []
    for n in WIDTHS:
        out.append(r(f"avg({c}) OVER {frame(n, delta)}", f"{c}_rmen{n:02d}"))
        out.append(r(f"quantile_cont({c}, 0.5) OVER {frame(4, delta)}", f"{c}_rmed{n:02d}"))
    return out


def diff_sql(c, delta=1, start=1):
    return [f'{c} - {lag_sql(c, i - start + delta)} AS "{c}_diff{i:02d}"' for i in range(1, 25)]


def class_sql(delta=1, start=1):
    return [f'{lag_sql(c, i - start + delta)} AS "shft{i:02d}_{c}"' for i in range(1, 25) for c in ("trn_ce_A", "trn_ce_N", "trn_ce_R")]


def rounded(cols):
    """Round what is a fraction; lags and differences of whole-number columns keep their type."""
    out = []
    for c in cols:
        expr, name = c.rsplit(" AS ", 1)
        whole = any(n in name for n in WHOLE) and "_rm" not in name
        out.append(c if whole or c.startswith("round(") else r(expr, name.strip('"')))
    return out


def select(cols, *names, base=BASE, tail=""):
    return with_inputs(f"SELECT {base}, " + ",\n".join(cols) + f" FROM {names[0]} {tail}", *names)


def feature_sql(columns, delta):
    out = []
    for c in columns:
        out += shift_sql(c, delta)
        if "count" not in c:
            out += rolling_sql(c, delta) + diff_sql(c, delta)
    return out


# -------------------------------------------------------------------------------------------- queries


def weekly_panel(spark, sf):
    return tidy(I.panel(spark, sf))


def shifts(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.shift_features(p, VALUES, I.PANEL_LAYOUT), p))


def shifts_scoring(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.shift_features(p, MONEY, I.PANEL_LAYOUT, delta=0, start=3, total=8), p))


def _of(df, base):
    return (df, *added(df, base))


def rolling(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.rolling_features(p, MONEY, I.PANEL_LAYOUT), p))


def rolling_scoring(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.rolling_features(p, MONEY, I.PANEL_LAYOUT, delta=0), p))


def diffs(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.diff_features(p, MONEY, I.PANEL_LAYOUT), p))


def diffs_leak_safe(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.diff_features(p, ["target"], I.PANEL_LAYOUT, leak_safe=True), p))


def rolling_quantiles(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.quantile_features(p, ["target"], I.PANEL_LAYOUT), p))


def lagged_means(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.lagged_mean_features(p, ["target"], I.PANEL_LAYOUT), p))


def class_shifts(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.class_shift_features(p, I.PANEL_LAYOUT), p))


def previous_row(spark, sf):
    return tidy(P.previous_row(I.panel(spark, sf), I.PANEL_LAYOUT))


def panel_features(spark, sf):
    p = I.panel(spark, sf)
    return keyed(*_of(P.panel_features(p, I.PANEL_LAYOUT), p))


def panel_features_scoring(spark, sf):
    p = I.panel(spark, sf).drop("tvect_F", "tvect_O")
    return keyed(*_of(P.panel_features(p, I.PANEL_LAYOUT, delta=0), p))


def full_history(spark, sf):
    """Flagship: the panel with its features, rows with a full history."""
    p = I.panel(spark, sf).select("inn_id", "week", "target", "trns_count_inp")
    return tidy(P.full_history(P.panel_features(p, I.PANEL_LAYOUT)))


def filled_weeks(spark, sf):
    p = I.panel(spark, sf).select("inn_id", "week", "target", "trns_count_inp")
    return tidy(P.fill_weeks(p, I.days(spark)))


def holiday_flags(spark, sf):
    return C.calendar_days(I.order_days(spark, sf), I.holidays(spark))


def calendar_days(spark, sf):
    return C.calendar_days(I.days(spark).join(_panel_weeks(spark, sf), "week", "left_semi"), I.holidays(spark))


def _panel_weeks(spark, sf):
    return I.order_days(spark, sf).select("week").distinct()


def week_dimension(spark, sf):
    return C.week_dimension(calendar_days(spark, sf))


def date_parts(spark, sf):
    d = F.col("date")
    doy, m, y = F.dayofyear(d), F.month(d), F.year(d)
    return I.order_days(spark, sf).select(
        "date",
        S.iso_weekday(d).alias("iso_day"),
        y.alias("year"),
        m.alias("month"),
        F.dayofmonth(d).alias("day"),
        doy.alias("day_of_year"),
        S.leap_adjusted_day(doy, m, y).alias("adjusted_day"),
        S.week_quarter(d).alias("q"),
        S.month_span(m, F.month(F.date_add(d, 6))).alias("m"),
        (y - 2021).alias("year_offset"),
    )


def panel_with_weeks(spark, sf):
    weeks = C.week_dimension(C.calendar_days(I.days(spark), I.holidays(spark)))
    p = I.panel(spark, sf).select("inn_id", "week", "target")
    return tidy(p.join(weeks, "week", "left").select("inn_id", "week", "target", "workdays", "weekends", "q", "dy1"))


def recoded_profiles(spark, sf):
    p = I.profiles(spark, sf)
    return R.recode_profiles(R.members_only(p, I.template(spark, sf)))


def latest_profile(spark, sf):
    return R.latest_profile(I.profiles(spark, sf), I.template(spark, sf))


def panel_with_profile(spark, sf):
    p = I.panel(spark, sf).select("inn_id", "week", "target")
    return tidy(p.join(latest_profile(spark, sf), "inn_id", "left"))


def template_with_last_row(spark, sf):
    last = P.last_row(I.panel(spark, sf), "inn_id", ["week"]).drop("week", "target")
    return tidy(I.template(spark, sf).join(last, "inn_id", "left"))


def entities(spark, sf):
    return I.panel(spark, sf).select("inn_id").distinct()


def test_entities_only(spark, sf):
    return tidy(R.members_only(I.panel(spark, sf), I.template(spark, sf)).select("inn_id", "week", "target"))


def log_amounts(spark, sf):
    return tidy(L.log_amounts(I.panel(spark, sf)).select("inn_id", "week", "target", "trns_amount_inp", "trns_count_inp"))


def extended_panel(spark, sf):
    p = I.panel(spark, sf).select("inn_id", "week", "target")
    early, late = p.where("week < 200"), p.where("week >= 200")
    data = L.load_panel(I.days(spark), I.holidays(spark), early, I.profiles(spark, sf), I.template(spark, sf), extension=late)
    return tidy(data.panel)


def load_panel(spark, sf):
    data = L.load_panel(
        I.days(spark), I.holidays(spark), I.panel(spark, sf), I.profiles(spark, sf), I.template(spark, sf), incoming=True
    )
    return tidy(data.panel)


def sampled_entities(spark, sf):
    """Ten entities by hash, with their rows."""
    data = L.load_panel(
        I.days(spark), I.holidays(spark), I.panel(spark, sf), I.profiles(spark, sf), I.template(spark, sf), sample=10
    )
    return data.panel.groupBy("inn_id").agg(F.count(F.lit(1)).alias("rows"))


def _data(spark, sf):
    return L.load_panel(
        I.days(spark), I.holidays(spark), I.panel(spark, sf), I.profiles(spark, sf), I.template(spark, sf), incoming=True
    )


def panel_train(spark, sf):
    return tidy(L.panel_train_test(_data(spark, sf), I.PANEL_LAYOUT, narrow=False)[0])


def panel_test(spark, sf):
    return tidy(L.panel_train_test(_data(spark, sf), I.PANEL_LAYOUT, narrow=False)[1])


def panel_train_plain(spark, sf):
    return tidy(L.panel_train_test(_data(spark, sf), I.PANEL_LAYOUT, add_features=False, log_target=False, narrow=False)[0])


def panel_test_plain(spark, sf):
    return tidy(L.panel_train_test(_data(spark, sf), I.PANEL_LAYOUT, add_features=False, log_target=False, narrow=False)[1])


def train_types(spark, sf):
    """Types of the stored training table after narrowing, one row per column."""
    store = f"{shared_dir(spark).rstrip('/')}/train-types-{uuid.uuid4().hex}"
    train, _ = L.panel_train_test(_data(spark, sf), I.PANEL_LAYOUT, store=store)
    rows = [(f.name, f.dataType.simpleString()) for f in train.schema]
    base = train.agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array(*[F.struct(F.lit(a).alias("name"), F.lit(b).alias("type")) for a, b in rows])
    return base.select("n", F.explode(pairs).alias("c")).select("c.name", "c.type", "n")


def group_columns(spark, sf):
    return tidy(H.drop_groups(I.panel(spark, sf), ["trn_ce_", "tvect_"], ["_inp"]))


def without_columns(spark, sf):
    return tidy(I.panel(spark, sf).drop("cnt_inn_inp", "trn_ce_A", "not_there"))


def numeric_only(spark, sf):
    s = I.table(spark, sf, "supplier")
    return tidy(s.select(*H.numeric_columns(s)))


# -------------------------------------------------------------------------------------------- SQL of pipelines

WEEK_COLS = "workdays, weekends, year1, month1, day1, dy1, year2, month2, day2, dy2, m, y, q"
PROFILE_COLS = "diff_datopen_report_date_flg, ipul, id_region, main_okved_group"
LOGGED = {
    "logged": """SELECT inn_id, week, ln(1 + target) AS target, ln(1 + trns_amount_inp) AS trns_amount_inp,
  trns_count_inp, cnt_inn_inp FROM panel"""
}
PIPE_VALUES = ["target", "trns_amount_inp", "trns_count_inp", "cnt_inn_inp"]


def _train_sql():
    feats = rounded(feature_sql(PIPE_VALUES, 1))
    body = f"""SELECT f.*, {WEEK_COLS}, {PROFILE_COLS} FROM f LEFT JOIN weeks USING (week) LEFT JOIN latest USING (inn_id)
WHERE target_shift24 IS NOT NULL"""
    f = f"SELECT inn_id, week, {r('target', 'target')}, " + ", ".join(feats) + " FROM logged"
    return with_inputs(body, "panel", "weeks", "latest", extra=LOGGED | {"f": f})


# The types that the columns of the training table have before narrowing; the others are doubles.
BIGINTS = ("inn_id", "workdays", "weekends")
INTS = ("week", "diff_datopen_report_date_flg", *[c for c in WEEK_COLS.split(", ") if c not in BIGINTS])
TEXTS = ("ipul", "id_region", "main_okved_group")


def _types_sql():
    feats = [x.rsplit(" AS ", 1)[1].strip('"') for x in rounded(feature_sql(PIPE_VALUES, 1))]
    whole = [c for c in feats if c.startswith("trns_count") or (c.startswith("cnt_") and "_rme" not in c)]
    own = dict.fromkeys(("target", *feats), "double") | dict.fromkeys((*BIGINTS, *whole), "bigint")
    own |= dict.fromkeys(INTS, "int") | dict.fromkeys(TEXTS, "string")
    limits = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c, t in own.items() if t != "string")

    def narrowed(c, t):
        lo, hi = f"lo_{c}", f"hi_{c}"
        if t == "string":
            return "'string'"
        if t == "double":
            return f"CASE WHEN {lo} > -3.4028234663852886e38 AND {hi} < 3.4028234663852886e38 THEN 'float' ELSE 'double' END"
        steps = "".join(
            f" WHEN ({lo} >= 0 AND {hi} < {2**b}) OR ({lo} > -{2**b} AND {hi} < {2**b - 1}) THEN '{n}'"
            for b, n in ((7, "tinyint"), (15, "smallint"), (31, "int"))
        )
        return f"CASE{steps} ELSE '{t}' END"

    rows = " UNION ALL ".join(f"SELECT '{c}' AS name, {narrowed(c, t)} AS type, n FROM limits" for c, t in own.items())
    return f"WITH train AS ({_train_sql()}), limits AS (SELECT count(*) AS n, {limits} FROM train) {rows}"


def _test_sql():
    feats = rounded(feature_sql(PIPE_VALUES, 0))
    f = "SELECT inn_id, row_number() OVER (PARTITION BY inn_id ORDER BY week DESC) AS rn, " + ", ".join(feats) + " FROM logged"
    body = f"""SELECT t.*, f.* EXCLUDE (inn_id, rn), {WEEK_COLS}, {PROFILE_COLS}
FROM template t LEFT JOIN (SELECT * FROM f WHERE rn = 1) f USING (inn_id) LEFT JOIN weeks USING (week)
LEFT JOIN latest USING (inn_id)"""
    return with_inputs(body, "template", "panel", "weeks", "latest", extra=LOGGED | {"f": f})


PREVIOUS = {
    "prev": "SELECT inn_id, week, target, "
    + ", ".join(f"coalesce(lag({c}) OVER {W}), 0) AS {c}" for c in VALUES[1:] + ["trn_ce_A", "trn_ce_N", "trn_ce_R"])
    + " FROM panel"
}
PREVIOUS_PIPE = {
    "prev": "SELECT inn_id, week, target, " + ", ".join(f"coalesce(lag({c}) OVER {W}), 0) AS {c}" for c in PIPE_VALUES[1:]) + " FROM panel"
}

CASES = {
    "weekly_panel": (weekly_panel, with_inputs("SELECT * FROM panel", "panel")),
    "lag_family": (shifts, select(rounded([x for c in VALUES for x in shift_sql(c)]), "panel")),
    "lag_family_scoring": (shifts_scoring, select(rounded([x for c in MONEY for x in shift_sql(c, 0, 3, 8)]), "panel")),
    "rolling_mean_median": (rolling, select([x for c in MONEY for x in rolling_sql(c)], "panel")),
    "rolling_scoring": (rolling_scoring, select([x for c in MONEY for x in rolling_sql(c, 0)], "panel")),
    "diff_family": (diffs, select(rounded([x for c in MONEY for x in diff_sql(c)]), "panel")),
    "diff_leak_safe": (
        diffs_leak_safe,
        select([r(f"{lag_sql('target', 1)} - {lag_sql('target', 1 + i)}", f"target_diff{i:02d}") for i in range(1, 25)], "panel"),
    ),
    "rolling_quantile_bank": (
        rolling_quantiles,
        select(
            [r(f"quantile_cont(target, {i / 100}) OVER {frame(48, 1)}", f"target_iq{i:02d}") for i in range(5, 100, 5)], "panel"
        ),
    ),
    "rolling_mean_of_lags": (
        lagged_means,
        with_inputs(
            "SELECT inn_id, week, "
            + ", ".join(r(f"avg(target) OVER {frame(i, 1 + i)}", f"target__srmen{i:02d}") for i in (4, 8, 12, 16))
            + " FROM panel",
            "panel",
        ),
    ),
    "class_sum_lags": (class_shifts, select(rounded(class_sql()), "panel")),
    "previous_row": (previous_row, with_inputs("SELECT * FROM prev", "panel", extra=PREVIOUS)),
    "panel_features": (panel_features, select(rounded(feature_sql(VALUES, 1) + class_sql()), "panel")),
    "panel_features_scoring": (panel_features_scoring, select(rounded(feature_sql(VALUES[:4], 0) + class_sql(0)), "panel")),
    "full_history": (
        full_history,
        with_inputs(
            "SELECT * FROM (SELECT inn_id, week, target, trns_count_inp, "
            + ", ".join(rounded(feature_sql(["target", "trns_count_inp"], 1)))
            + " FROM panel) WHERE target_shift24 IS NOT NULL",
            "panel",
        ),
    ),
    "filled_weeks": (
        filled_weeks,
        with_inputs(
            """SELECT g.inn_id, g.week, p.target, p.trns_count_inp FROM (SELECT inn_id, CAST(unnest(range(a, b + 1)) AS INTEGER) AS week
FROM (SELECT inn_id, min(week) AS a, max(week) AS b FROM panel GROUP BY 1)) g LEFT JOIN panel p USING (inn_id, week)""",
            "panel",
        ),
    ),
    "holiday_flags": (
        holiday_flags,
        with_inputs(
            """SELECT date, week, CAST(isodow(date) AS INTEGER) AS day_of_week,
date NOT IN (SELECT date FROM holidays) AS is_workday FROM order_days""",
            "holidays",
            "order_days",
        ),
    ),
    "calendar_days": (
        calendar_days,
        with_inputs("SELECT * FROM calendar WHERE week IN (SELECT week FROM order_days)", "calendar", "order_days"),
    ),
    "week_dimension": (
        week_dimension,
        with_inputs("SELECT * FROM weeks WHERE week IN (SELECT week FROM order_days)", "weeks", "order_days"),
    ),
    "date_parts": (
        date_parts,
        with_inputs(
            """SELECT date, CAST(isodow(date) AS INTEGER) AS iso_day, CAST(year(date) AS INTEGER) AS year,
CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
CAST(dayofyear(date) - CASE WHEN month(date) > 2 AND year(date) % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS adjusted_day,
(SELECT CAST(quarter(x) AS INTEGER) FROM (SELECT unnest(range(date, date + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS x)
  GROUP BY quarter(x) ORDER BY count(*) DESC, quarter(x) LIMIT 1) AS q,
CAST((month(date + INTERVAL 6 DAY) - month(date) + 12) % 12 AS INTEGER) AS m,
CAST(year(date) - 2021 AS INTEGER) AS year_offset FROM order_days""",
            "order_days",
        ),
    ),
    "panel_with_weeks": (
        panel_with_weeks,
        with_inputs("SELECT inn_id, week, target, workdays, weekends, q, dy1 FROM panel LEFT JOIN weeks USING (week)", "panel", "weeks"),
    ),
    "recoded_profiles": (recoded_profiles, with_inputs("SELECT * FROM recoded", "recoded")),
    "latest_profile": (latest_profile, with_inputs("SELECT * FROM latest", "latest")),
    "panel_with_profile": (
        panel_with_profile,
        with_inputs("SELECT p.inn_id, week, target, latest.* EXCLUDE (inn_id) FROM panel p LEFT JOIN latest USING (inn_id)", "panel", "latest"),
    ),
    "template_with_last_row": (
        template_with_last_row,
        with_inputs(
            """SELECT t.*, l.* EXCLUDE (inn_id, week, target, rn) FROM template t LEFT JOIN (SELECT *,
row_number() OVER (PARTITION BY inn_id ORDER BY week DESC) AS rn FROM panel) l ON t.inn_id = l.inn_id AND l.rn = 1""",
            "template",
            "panel",
        ),
    ),
    "distinct_entities": (entities, "SELECT DISTINCT l_suppkey AS inn_id FROM lineitem"),
    "members_only": (
        test_entities_only,
        with_inputs("SELECT inn_id, week, target FROM panel WHERE inn_id IN (SELECT inn_id FROM template)", "panel", "template"),
    ),
    "log_amounts": (
        log_amounts,
        with_inputs(
            f"SELECT inn_id, week, {r('ln(1 + target)', 'target')}, {r('ln(1 + trns_amount_inp)', 'trns_amount_inp')}, trns_count_inp FROM panel",
            "panel",
        ),
    ),
    "extended_panel": (extended_panel, with_inputs("SELECT inn_id, week, target FROM panel", "panel")),
    "load_panel": (
        load_panel,
        with_inputs("SELECT inn_id, week, target, trns_amount_inp, trns_count_inp, cnt_inn_inp FROM panel", "panel"),
    ),
    "sampled_entities": (
        sampled_entities,
        with_inputs(
            """SELECT inn_id, count(*) AS rows FROM panel WHERE inn_id IN (
SELECT inn_id FROM (SELECT DISTINCT inn_id FROM panel) ORDER BY md5(CAST(inn_id AS VARCHAR)), inn_id LIMIT 10) GROUP BY 1""",
            "panel",
        ),
    ),
    "panel_train": (panel_train, _train_sql()),
    "panel_test": (panel_test, _test_sql()),
    "panel_train_plain": (
        panel_train_plain,
        with_inputs(
            f"""SELECT p.*, d1, d2, {WEEK_COLS}, report_date, {PROFILE_COLS} FROM prev p LEFT JOIN weeks USING (week)
LEFT JOIN latest USING (inn_id)""",
            "panel",
            "weeks",
            "latest",
            extra=PREVIOUS_PIPE,
        ),
    ),
    "panel_test_plain": (
        panel_test_plain,
        with_inputs(
            f"""SELECT t.*, l.* EXCLUDE (inn_id, week, target, rn), d1, d2, {WEEK_COLS}, report_date, {PROFILE_COLS}
FROM template t LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY inn_id ORDER BY week DESC) AS rn FROM prev) l
  ON t.inn_id = l.inn_id AND l.rn = 1
LEFT JOIN weeks ON t.week = weeks.week LEFT JOIN latest ON t.inn_id = latest.inn_id""",
            "template",
            "panel",
            "weeks",
            "latest",
            extra=PREVIOUS_PIPE,
        ),
    ),
    "train_types": (train_types, _types_sql()),
    "group_columns": (group_columns, with_inputs("SELECT inn_id, week, target FROM panel", "panel")),
    "without_columns": (without_columns, with_inputs("SELECT * EXCLUDE (cnt_inn_inp, trn_ce_A) FROM panel", "panel")),
    "numeric_only": (numeric_only, "SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier"),
}
