"""Column names, column groups, type narrowing, categories."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.joins import join_small
from panelkit.operators.ordered import global_running
from panelkit.session import durable

FLOAT32_MAX = 3.4028234663852886e38
# Columns of a stored table per range pass: Spark generates loops up to 100 fields only, and short loops are compiled better (184 ns
# a value with 12 columns, 274 with 48).
RANGE_COLUMNS = 12


def drop_groups(df: DataFrame, prefixes: Iterable[str] = (), infixes: Iterable[str] = ()) -> DataFrame:
    """Drop columns by the start of their name or by a part of it."""
    prefixes, infixes = tuple(prefixes), tuple(infixes)
    return df.drop(*[c for c in df.columns if c.startswith(prefixes) or any(x in c for x in infixes)])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def clean_name(name: str, join_digits: bool = True) -> str:
    """Lower case, brackets and dots to underscores; optionally no underscore between digits."""
    name = name.lower().replace("(", "_").replace(")", "").replace(".", "_")
    return re.sub(r"(?<=\d)_(?=\d)", "", name) if join_digits else name


def clean_feature_name(name: str) -> str:
    """Cut runs of zeros behind a digit, turn other characters into single underscores."""
    # Fixed patterns: the cleaned names must equal those of earlier feature tables.
    name = re.sub(r"(\d+\.\d*?[1-9])0{2,}\d*", r"\1", name)
    name = re.sub(r"([1-9]+)0{2,}\d*", r"\1", name)
    name = re.sub(r"[^\w-]", "_", name)
    return re.sub(r"_+", "_", name).strip("_")


def rename_columns(df: DataFrame, cleaner) -> DataFrame:
    names = [cleaner(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns become {twice}")
    return df.toDF(*names)


def _clean(df: DataFrame, c: str) -> Column:
    return F.when(~F.isnan(c), F.col(c)) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)


def column_ranges(df: DataFrame, columns: Sequence[str], at_once: int | None = None) -> dict[str, tuple]:
    """Minimum and maximum of every column, NaN left out, in one aggregate.

    ``at_once`` makes an aggregate per that many columns: for a stored table, of which each then reads its own columns
    only, in a generated loop. A plan that is not stored would run once for each.
    """
    if at_once is not None and len(columns) > at_once:
        parts = [column_ranges(df, columns[i : i + at_once]) for i in range(0, len(columns), at_once)]
        return {c: r for part in parts for c, r in part.items()}
    if not columns:
        return {}
    aggs = [f(_clean(df, c)).alias(f"{i}_{n}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    row = df.agg(*aggs).first()
    return {c: (row[f"{i}_lo"], row[f"{i}_hi"]) for i, c in enumerate(columns)}


def _orderable(t: T.DataType) -> bool:
    return isinstance(t, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with exactly one distinct value besides NULL; an empty column is not one of them."""
    ranges = column_ranges(df, [f.name for f in df.schema if _orderable(f.dataType)])
    return [c for c, (lo, hi) in ranges.items() if lo is not None and lo == hi]


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


# Largest magnitude of each signed type, smallest type first.
_WHOLE = ((2**7, "tinyint"), (2**15, "smallint"), (2**31, "int"))


def _narrow_int(lo: int, hi: int, profile: str, own: str) -> str:
    """Non-negative values of the unsigned profile may fill the type; otherwise its end values are left free."""
    spare = 0 if profile == "unsigned" and lo >= 0 else 1
    for bound, name in _WHOLE:
        if lo > -bound and hi < bound - spare:
            return name
    return own


def narrowed_types(
    df: DataFrame, profile: str = "unsigned", use_float: bool = True, exclude: Sequence[str] = (), stored: bool = False
) -> dict[str, str]:
    """Smallest Spark type per numeric column that holds all its values, from one min/max pass over each column.

    ``stored`` says that ``df`` is a stored table as it is read: its columns are then taken in groups.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    ints = [f.name for f in df.schema if isinstance(f.dataType, whole) and f.name not in exclude]
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exclude]
    floats = floats if use_float else []
    ranges = column_ranges(df, [*ints, *floats], RANGE_COLUMNS if stored else None)
    types = {}
    for c, (lo, hi) in ranges.items():
        if lo is None:
            continue
        own = df.schema[c].dataType.simpleString()
        if c in ints:
            types[c] = _narrow_int(lo, hi, profile, own)
        else:
            types[c] = "float" if lo > -FLOAT32_MAX and hi < FLOAT32_MAX else own
    return types


def narrow_types(
    df: DataFrame, profile: str = "unsigned", use_float: bool = True, exclude: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """Cast numeric columns down. ``profile`` is ``unsigned`` or ``signed``; dates and texts stay as they are."""
    types = narrowed_types(df, profile, use_float, exclude, stored)
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def _sort_keys(df: DataFrame, c: str) -> list[Column]:
    """A value as (whole number, fraction, text), so that columns of all types sort in one table by their own order."""
    kind = df.schema[c].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    real = isinstance(kind, T.NumericType) and not whole
    value = F.col(c) + F.lit(0.0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(c)  # one zero
    return [
        F.col(c).cast("long") if whole else F.lit(None).cast("long"),
        value.cast("double") if real else F.lit(None).cast("double"),
        value.cast("string"),
    ]


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of all ``columns`` as one table (``column, value, code, n``): ``code`` is the rank in the column from 0.

    One pass makes the values distinct before the shuffle, one exchange by ranges ranks them all; a column may have any
    number of values. ``n`` is the number of values of the column. Numbers, dates and texts sort by their own order.
    Write the table with ``write_parquet`` to use it on later data. Columns that ``df`` lacks are passed over.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, code long, n long")
    names = ("_whole", "_real", "value")
    each = [F.struct(F.lit(c).alias("column"), *[k.alias(n) for n, k in zip(names, _sort_keys(df, c))]) for c in columns]
    values = df.select(F.explode(F.array(*each)).alias("_v")).select("_v.*").where(F.col("value").isNotNull()).distinct()
    placed = global_running(values, ["column", "_whole", "_real", "value"], {"_place": F.lit(1)})
    sizes = placed.groupBy("column").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("n"))
    code = (F.col("_place") - F.col("_first")).cast("long").alias("code")
    return placed.join(F.broadcast(sizes), "column").select("column", "value", code, "n")  # sizes: a row per column


def apply_categories(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], suffix: str = "_code", unseen: str = "last") -> DataFrame:
    """Add the codes of a stored dictionary. NULL and values that it lacks get the next code after the last one, or -1 (``unseen="none"``)."""
    columns = [c for c in columns if c in df.columns]
    sizes = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.max("n").alias("n")).collect()}  # a row per column
    for c in columns:
        own = dictionary.where(F.col("column") == c).select(F.col("value").alias("_text"), F.col("code").alias(c + suffix))
        other = F.lit(sizes.get(c, 0) if unseen == "last" else -1).cast("long")
        keyed = df.withColumn("_text", _sort_keys(df, c)[2])
        df = join_small(keyed, own, "_text").drop("_text").withColumn(c + suffix, F.coalesce(c + suffix, other))
    return df


def category_codes(df: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Add the rank of each value among the distinct values of its column, from 0; NULL is -1."""
    return apply_categories(df, durable(category_dictionary(df, columns)), columns, suffix, unseen="none")


def split_columns(
    df: DataFrame, numeric: Sequence[str] = (), category: Sequence[str] = (), dropped: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """Fill in the missing one of the two lists as the complement of the other."""
    numeric, category = list(numeric), list(category)
    if category and not numeric:
        numeric = [c for c in df.columns if c not in category and c not in dropped]
    if numeric and not category:
        category = [c for c in df.columns if c not in numeric and c not in dropped]
    return numeric, category


def fit_transform(df: DataFrame, numeric=(), category=(), dropped=()) -> tuple[DataFrame, DataFrame]:
    """Infer the column lists, index the categories, narrow the types; gives the dictionary and the table."""
    _, category = split_columns(df, numeric, category, dropped)
    dictionary = durable(category_dictionary(df, category))
    return dictionary, narrow_types(apply_categories(df, dictionary, category), profile="signed")
