"""From series files and label tables to labelled feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.features import add_predicted_flags, override_join, series_features
from panelkit.operators.ordered import Layout, measure, number_rows
from panelkit.operators.schema import clean_feature_name, rename_columns
from panelkit.operators.segments import unit_slope_line
from panelkit.operators.series import KEY, LOG_COLUMNS, RAW_COLUMNS, log_series, series_stats


def prepare_series(
    raw: DataFrame, order: str | Sequence[str], key: str = KEY, logs: bool = True, layout: Layout | None = None
) -> tuple[DataFrame, Layout]:
    """Filter, take logs, number the rows of each series."""
    rows = log_series(raw) if logs else raw.where((F.col("time") >= 0) & ~F.isnan("time"))
    layout = layout or measure(rows, key, order)
    return number_rows(rows, layout), layout.by("pos")


def hand_features(series: DataFrame, layout: Layout, universe: DataFrame | None = None, logs: bool = True) -> DataFrame:
    """Summary and bin statistics with the value of the unit-slope line."""
    points = series if logs else log_series(series)
    return series_stats(series, layout, universe, line=unit_slope_line(points, layout))


def labelled_series_features(
    labels: DataFrame, series: DataFrame, layout: Layout, fill_value: float | None = 0, key: str = KEY
) -> DataFrame:
    """Label rows with the features of their series; a label without a series has empty features."""
    features = hand_features(series, layout, universe=labels)
    out = labels.join(features, key, "left")
    return out if fill_value is None else out.na.fill(fill_value)


def scoring_features(
    series: DataFrame,
    layout: Layout,
    universe: DataFrame,
    predicted: DataFrame | None = None,
    flags: Sequence[str] = (),
    fill_value: float | None = 0,
    key: str = KEY,
) -> DataFrame:
    """Features of every series of the universe, with predicted flags in front when given."""
    out = hand_features(series, layout, universe)
    out = out if fill_value is None else out.na.fill(fill_value)
    return add_predicted_flags(out, predicted, flags, key)


def series_feature_matrix(
    table: DataFrame,
    series: DataFrame,
    layout: Layout,
    columns: Sequence[str] = LOG_COLUMNS + RAW_COLUMNS,
    order: str = "pos",
    fill_value: float = 0,
    key: str = KEY,
    **options,
) -> DataFrame:
    """Add the general feature matrix to a feature table; general features replace columns of the same name."""
    columns = [c for c in columns if c in series.columns]
    matrix = series_features(series, layout, columns, order, **options)
    matrix = rename_columns(matrix, lambda c: c if c == key else clean_feature_name(c))
    return override_join(table, matrix, key).na.fill(fill_value)
