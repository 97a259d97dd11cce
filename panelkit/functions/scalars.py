"""Scalar expressions: guards against NaN and infinity, logs, dates, recodes, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")

# Age of a company in months by age band.
AGE_MONTHS = {
    "1m": 1,
    "2_3m": 3,
    "3_6m": 6,
    "6_12m": 12,
    "1_2y": 24,
    "2_4y": 48,
    "4_8y": 96,
    "8_12y": 144,
    "more_12y": 192,
}
# Legal form codes.
LEGAL_FORM = {"ip": "0", "ul": "1"}
# Lower bounds of age groups.
AGE_EDGES = (18, 25, 35, 45, 55, 65)
# Cyrillic capitals and the Latin capitals that look the same.
CYRILLIC = "АЕКМНОРСТУХВ"
LATIN = "AEKMHOPCTYXB"


def no_nan(c: Column) -> Column:
    """NaN becomes NULL."""
    return F.when(~F.isnan(c), c)


def zero_if_missing(c: Column) -> Column:
    return F.coalesce(no_nan(c), F.lit(0.0))


def finite_or_null(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(INF)), c)


def log10(c: Column) -> Column:
    """Base-10 log: -infinity at zero, NULL below it."""
    return F.when(c > 0, F.log10(c)).when(c == 0, F.lit(-INF))


def log1p(c: Column) -> Column:
    """Natural log of 1 + x: -infinity at -1, NULL below it."""
    return F.when(c > -1, F.log1p(c)).when(c == -1, F.lit(-INF))


def iso_weekday(d: Column) -> Column:
    return F.weekday(d) + 1


def month_span(m1: Column, m2: Column) -> Column:
    return F.pmod(m2 - m1 + 12, F.lit(12))


def leap_adjusted_day(day_of_year: Column, month: Column, year: Column) -> Column:
    """Day of the year as in a common year, for dates after February."""
    return F.when((month > 2) & (year % 4 == 0), day_of_year - 1).otherwise(day_of_year)


def week_quarter(first_day: Column) -> Column:
    """Quarter that holds most of the seven days from ``first_day``: that of the middle day."""
    return F.quarter(F.date_add(first_day, 3))


def recode(c: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Look ``c`` up in ``mapping``; the rest becomes ``default``, or stays as it is when there is none."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), c if default is None else default)


def edges_below(c: Column, edges: Sequence[float] = AGE_EDGES) -> Column:
    """Number of edges strictly below ``c``; 0 for NaN and NULL."""
    hits = [(c > e).cast("int") for e in edges]
    return F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(0)).otherwise(sum(hits[1:], hits[0]))


def fold_lookalikes(c: Column) -> Column:
    """Upper case with Cyrillic look-alikes written in Latin, so that equal-looking texts compare equal."""
    return F.translate(F.upper(c), CYRILLIC, LATIN)


def lookalike_pattern(c: Column) -> Column:
    """Replace each look-alike letter, in either case, by a class of both capitals such as ``[АA]``."""
    for ru, en in zip(CYRILLIC, LATIN):
        c = F.regexp_replace(c, f"[{ru}{ru.lower()}{en}{en.lower()}]", f"[{ru}{en}]")
    return c


def flags_label(names: Sequence[str]) -> Column:
    """Flags of a row written one after another; a missing one as ``nan``."""
    return F.concat(*[F.coalesce(F.col(n).cast("string"), F.lit("nan")) for n in names])


def fill(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL and NaN by ``value`` in the columns of its type."""
    return df.na.fill(value, subset=list(subset) if subset is not None else None)
