"""Joins with a small side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 50_000


def join_small(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left", limit: int = SMALL_ROWS) -> DataFrame:
    """Equi join that broadcasts ``right`` when a count shows at most ``limit`` rows, and shuffles otherwise.

    For a wide left side the difference is one shuffle of all its columns. The count reads at most ``limit`` + 1 rows.
    """
    fits = right.limit(limit + 1).count() <= limit
    return left.join(F.broadcast(right) if fits else right, on, how)
