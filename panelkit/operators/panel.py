"""Lags, rolling statistics and differences of a panel keyed by entity and ordered by time.

``delta`` = 1 describes a row by the rows before it (training); ``delta`` = 0 includes the row itself (scoring
the next period). Lags count rows, not weeks: a gap in the weeks is not filled.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.ordered import Layout, bounded_exprs, measure
from panelkit.session import pack_wide_results

ENTITY, WEEK, TARGET = "inn_id", "week", "target"
CLASS_SUMS = "trn_ce_"
MEAN_WIDTHS = (4, 8, 12, 16)
MEDIAN_ROWS = 4
DIFFS = range(1, 25)
CLASS_SHIFTS = range(1, 25)
QUANTILES = [round(0.05 * i, 2) for i in range(1, 20)]


def panel_layout(df: DataFrame, entity: str = ENTITY, week: str = WEEK, **kw) -> Layout:
    return measure(df, entity, week, **kw)


def value_columns(df: DataFrame, entity: str = ENTITY, week: str = WEEK) -> list[str]:
    return [c for c in df.columns if not c.startswith(CLASS_SUMS) and c not in (entity, week)]


# A panel has hundreds of derived columns, so the families below are SQL texts: one call per select, not per column.


def _lag_name(c: str, n: int) -> str:
    return f"_lag{n}_{c}"


def _lags(c: str, offsets: Iterable[int], window: str) -> list[str]:
    return [f"lag(`{c}`, {n}) OVER ({window}) AS `{_lag_name(c, n)}`" for n in sorted(set(offsets)) if n]


def _lag(c: str, n: int) -> str:
    """A lag made by ``_lags``; offset 0 is the value itself."""
    return f"`{_lag_name(c, n)}`" if n else f"`{c}`"


def shift_offsets(start: int, total: int, delta: int) -> dict[int, int]:
    """Shift number in the column name -> row offset."""
    return {i: i - (start - delta) for i in range(start, start + total)}


def _trailing(window: str, rows: int, delta: int) -> str:
    """The ``rows`` rows that end ``delta`` rows before the current one."""
    end = f"{delta} PRECEDING" if delta else "CURRENT ROW"
    start = rows - 1 + delta
    return f"({window} ROWS BETWEEN {start} PRECEDING AND {end})"


def _mean(c: str, rows: int, delta: int, window: str) -> str:
    return f"avg(`{c}`) OVER {_trailing(window, rows, delta)}"


def _median_of(values: Sequence[str]) -> str:
    """Median of a few columns of one row, NULLs left out."""
    ordered = f"sort_array(array_compact(array({', '.join(values)})))"
    middle = f"get({ordered}, cast(floor((size({ordered}) - 1) / 2) as int)) + get({ordered}, cast(floor(size({ordered}) / 2) as int))"
    return f"({middle}) / 2"


def _widths(w_size: int) -> list[int]:
    return list(dict.fromkeys([*MEAN_WIDTHS, w_size]))


def _shift_columns(c: str, offsets: dict[int, int]) -> list[str]:
    return [f"{_lag(c, n)} AS `{c}_shift{i:02d}`" for i, n in offsets.items()]


def _rolling_columns(c: str, w_size: int) -> list[str]:
    return [x for n in _widths(w_size) for x in (f"`{c}_rmen{n:02d}`", f"`_med_{c}` AS `{c}_rmed{n:02d}`")]


def _diff_columns(c: str, offsets: dict[int, int], delta: int, leak_safe: bool) -> list[str]:
    if leak_safe:
        return [f"{_lag(c, delta)} - {_lag(c, delta + i)} AS `{c}_diff{i:02d}`" for i in offsets]
    return [f"`{c}` - {_lag(c, n)} AS `{c}_diff{i:02d}`" for i, n in offsets.items()]


def _class_columns(columns: Sequence[str], offsets: dict[int, int]) -> list[str]:
    return [f"{_lag(c, n)} AS `shft{i:02d}_{c}`" for i, n in offsets.items() for c in columns]


def _names(columns: Iterable[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def _reach(offsets: Iterable[int]) -> tuple[int, int]:
    offsets = list(offsets)
    return max([0, *offsets]), max([0, *[-n for n in offsets]])


def shift_features(df, columns, layout, delta=1, start=1, total=24) -> DataFrame:
    """``{c}_shift{i}`` for i = start ... start + total - 1."""
    offsets = shift_offsets(start, total, delta)
    out = bounded_exprs(df, layout, lambda w: [x for c in columns for x in _lags(c, offsets.values(), w)], *_reach(offsets.values()))
    return out.selectExpr(*_names(df.columns), *[x for c in columns for x in _shift_columns(c, offsets)])


def rolling_features(df, columns, layout, delta=1, w_size=48) -> DataFrame:
    """``{c}_rmen{w}`` over w rows, and ``{c}_rmed{w}``, whose window is four rows whatever w says."""
    back = range(delta, delta + MEDIAN_ROWS)

    def make(w):
        means = [f"{_mean(c, n, delta, w)} AS `{c}_rmen{n:02d}`" for c in columns for n in _widths(w_size)]
        return means + [x for c in columns for x in _lags(c, back, w)]

    out = bounded_exprs(df, layout, make, max(_widths(w_size)) + delta)
    out = out.selectExpr("*", *[f"{_median_of([_lag(c, n) for n in back])} AS `_med_{c}`" for c in columns])
    return out.selectExpr(*_names(df.columns), *[x for c in columns for x in _rolling_columns(c, w_size)])


def diff_features(df, columns, layout, delta=1, start=1, leak_safe=False) -> DataFrame:
    """``{c}_diff{i}``: value minus its lag. ``leak_safe`` keeps the current value out of training rows."""
    offsets = {i: i - (start - delta) for i in DIFFS}
    lags = {*offsets.values(), *(_safe_lags(delta) if leak_safe else [])}
    out = bounded_exprs(df, layout, lambda w: [x for c in columns for x in _lags(c, lags, w)], *_reach(lags))
    return out.selectExpr(*_names(df.columns), *[x for c in columns for x in _diff_columns(c, offsets, delta, leak_safe)])


def _safe_lags(delta: int) -> list[int]:
    return [delta, *[delta + i for i in DIFFS]]


def quantile_features(df, columns, layout, delta=1, w_size=48) -> DataFrame:
    """``{c}_iq{q}``: 19 exact rolling quantiles from 0.05 to 0.95 (re-aggregates the frame for each row)."""
    probs = ", ".join(f"{q}D" for q in QUANTILES)

    def make(w):
        return [f"percentile(`{c}`, array({probs})) OVER {_trailing(w, w_size, delta)} AS `_iq_{c}`" for c in columns]

    out = bounded_exprs(df, layout, make, w_size + delta)
    names = [(k, f"iq{round(q * 100):02d}") for k, q in enumerate(QUANTILES)]
    return out.selectExpr(*_names(df.columns), *[f"`_iq_{c}`[{k}] AS `{c}_{n}`" for c in columns for k, n in names])


def lagged_mean_features(df, columns, layout, delta=1, start=1, total=24) -> DataFrame:
    """``{c}__srmen{i}``: mean over the last i values of the lag column i, itself shifted by delta."""
    offsets = {i: n for i, n in shift_offsets(start, total, delta).items() if i in MEAN_WIDTHS}

    def make(w):
        return [f"{_mean(c, i, delta + n, w)} AS `{c}__srmen{i:02d}`" for c in columns for i, n in offsets.items()]

    return bounded_exprs(df, layout, make, max([0, *[i + delta + n for i, n in offsets.items()]]))


def class_shift_features(df, layout, delta=1, start=1, columns=None) -> DataFrame:
    """``shft{i}_{c}`` of the class-sum columns, always for i = 1 ... 24."""
    columns = [c for c in df.columns if c.startswith(CLASS_SUMS)] if columns is None else columns
    offsets = {i: i - (start - delta) for i in CLASS_SHIFTS}
    out = bounded_exprs(df, layout, lambda w: [x for c in columns for x in _lags(c, offsets.values(), w)], *_reach(offsets.values()))
    return out.selectExpr(*_names(df.columns), *_class_columns(columns, offsets))


def previous_row(df, layout, keep=(ENTITY, WEEK, TARGET)) -> DataFrame:
    """Every numeric column, except ``keep``, replaced by its value one row earlier; missing numbers become 0."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keep]
    out = bounded_exprs(df, layout, lambda w: [x for c in numeric for x in _lags(c, [1], w)], 1)
    return out.selectExpr(*[f"{_lag(c, 1)} AS `{c}`" if c in numeric else f"`{c}`" for c in df.columns]).na.fill(0)


@dataclass(frozen=True)
class Frames:
    """What the window pass over a panel gives, and the texts that lay out its features."""

    framed: DataFrame
    columns: list[str]
    lags: dict[str, list[int]]
    made: list[str]
    out: list[str]

    def features(self) -> DataFrame:
        return self.framed.selectExpr(*self.out)

    def packed(self) -> DataFrame:
        """The same values for a stored table: each value column with its lags as one array.

        Of two rows that follow one another nearly the whole array is the same bytes, so a file holds a value about once
        instead of once per lag; the differences, and medians under several names, are not written at all.
        """
        own = _names(c for c in self.columns if c not in self.lags)
        arrays = [f"array({', '.join(_lag(c, n) for n in offsets)}) AS `_lags_{c}`" for c, offsets in self.lags.items()]
        return self.framed.selectExpr(*own, *arrays, *_names(self.made))

    def unpacked(self, stored: DataFrame) -> DataFrame:
        """All features of a stored ``packed`` table."""
        own = _names(c for c in self.columns if c not in self.lags)
        spread = [f"`_lags_{c}`[{i}] AS `{_lag_name(c, n) if n else c}`" for c, offsets in self.lags.items() for i, n in enumerate(offsets)]
        return stored.selectExpr(*own, *spread, *_names(self.made)).selectExpr(*self.out)


def panel_frames(
    df: DataFrame,
    layout: Layout | None = None,
    delta: int = 1,
    shift_start: int = 1,
    shift_total: int = 24,
    w_size: int = 48,
    entity: str = ENTITY,
    week: str = WEEK,
    leak_safe: bool = False,
    last_only: bool = False,
    carry: Sequence[str] = (),
    full: str | None = None,
) -> Frames:
    """All panel features in one window pass, so one shuffle and one sort by entity; arguments as in ``panel_features``.

    ``full`` names a value column: only rows whose deepest lag of it exists are kept.
    """
    pack_wide_results(df.sparkSession)
    layout = layout or panel_layout(df, entity, week)
    values = [c for c in value_columns(df, entity, week) if c not in carry]
    classes = [c for c in df.columns if c.startswith(CLASS_SUMS) and c not in carry]
    rich = [c for c in values if "count" not in c]
    shifts = shift_offsets(shift_start, shift_total, delta)
    diffs = {i: i - (shift_start - delta) for i in DIFFS}
    median_lags = range(delta, delta + MEDIAN_ROWS)
    class_shifts = {i: i - (shift_start - delta) for i in CLASS_SHIFTS}

    lags = {c: set(shifts.values()) for c in values}
    for c in rich:
        lags[c] |= {*diffs.values(), *median_lags, *(_safe_lags(delta) if leak_safe else [])}
    for c in classes:
        lags[c] = set(class_shifts.values())
    back, ahead = _reach({n for s in lags.values() for n in s})
    means = {f"{c}_rmen{n:02d}": (c, n) for c in rich for n in _widths(w_size)}

    def make(w):
        made = [x for c, s in lags.items() for x in _lags(c, s, w)]
        made += [f"lead(true, 1) OVER ({w}) IS NULL AS _last"] if last_only else []
        return made + [f"{_mean(c, n, delta, w)} AS `{name}`" for name, (c, n) in means.items()]

    framed = bounded_exprs(df, layout, make, max(back, max(_widths(w_size)) + delta), max(ahead, 1 if last_only else 0))
    framed = framed.where("_last") if last_only else framed
    framed = framed.where(f"{_lag(full, max(shifts.values()))} IS NOT NULL") if full is not None else framed
    framed = framed.selectExpr("*", *[f"{_median_of([_lag(c, n) for n in median_lags])} AS `_med_{c}`" for c in rich])
    out = []
    for c in values:
        out += _shift_columns(c, shifts)
        if c in rich:
            out += _rolling_columns(c, w_size) + _diff_columns(c, diffs, delta, leak_safe)
    return Frames(
        framed,
        df.columns,
        {c: sorted({0, *s}) for c, s in lags.items()},
        [*means, *[f"_med_{c}" for c in rich]],
        [*_names(df.columns), *out, *_class_columns(classes, class_shifts)],
    )


def panel_features(
    df: DataFrame,
    layout: Layout | None = None,
    delta: int = 1,
    shift_start: int = 1,
    shift_total: int = 24,
    w_size: int = 48,
    entity: str = ENTITY,
    week: str = WEEK,
    leak_safe: bool = False,
    last_only: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """All panel features in one window pass, so one shuffle and one sort by entity.

    Columns with ``count`` in their name get shifts only; class sums get their own shift family. ``last_only`` keeps
    the last row of each entity, before its features are laid out. ``carry`` names columns that get no features.
    """
    return panel_frames(df, layout, delta, shift_start, shift_total, w_size, entity, week, leak_safe, last_only, carry).features()


def scoring_features(
    df: DataFrame,
    layout: Layout,
    shift_start: int = 1,
    shift_total: int = 24,
    w_size: int = 48,
    entity: str = ENTITY,
    week: str = WEEK,
) -> DataFrame:
    """Features of the last row of each entity, that row included (``delta`` = 0).

    Only the newest rows that a frame can reach are kept. Spark applies such a rank limit before the shuffle, so an
    entity sends a bounded number of rows however long its history is.
    """
    need = max(w_size, *MEAN_WIDTHS, shift_start + shift_total, max(DIFFS), max(CLASS_SHIFTS)) + 1
    newest = Window.partitionBy(*layout.keys).orderBy(*[F.desc(o) for o in layout.order])
    recent = df.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= need).drop("_age")
    return panel_features(
        recent, replace(layout, largest=need), 0, shift_start, shift_total, w_size, entity, week, last_only=True
    )


def full_history(df: DataFrame, column: str = TARGET, start: int = 1, total: int = 24) -> DataFrame:
    """Rows whose deepest lag exists."""
    return df.where(F.col(f"{column}_shift{start + total - 1:02d}").isNotNull())


def fill_weeks(df: DataFrame, weeks: DataFrame, entity: str = ENTITY, week: str = WEEK) -> DataFrame:
    """Opt-in: one row per entity and week between its first and last, so that lags count weeks.

    The weeks come from ``sequence`` per entity, so no cross join is planned.
    """
    span = df.groupBy(entity).agg(F.min(week).alias("_a"), F.max(week).alias("_b"))
    grid = span.select(entity, F.explode(F.sequence("_a", "_b")).alias(week))
    grid = grid.join(weeks.select(week).distinct(), week, "left_semi")
    return grid.join(df, [entity, week], "left").select(*df.columns)


def last_row(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Newest row per key; later ``order`` columns break ties. An aggregate, so it combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*").select(*df.columns)
