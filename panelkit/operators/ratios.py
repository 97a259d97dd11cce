"""Counts per group from part tables, and their shares per code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from panelkit.operators.ensemble import row_mean

HOST = "url_host"
# Log2 of the registers of a user sketch.
SKETCH_PRECISION = 12


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def merge_counts(parts: DataFrame, code: str, prefix: str, host: str = HOST, users: str | None = None) -> DataFrame:
    """Sum ``{prefix}_count`` per host and code; with ``users`` also count distinct users.

    ``users`` names a column of one user per row, or of a set of users. The long form is the one for large hosts: no row
    grows with a host. Sums and users are grouped apart, so exploding sets does not multiply the counts; users are made
    distinct per (host, code, user) first, so a hot host is spread over its users.
    """
    rows = parts.where(F.col(host).isNotNull() & F.col(code).isNotNull())
    sums = rows.groupBy(host, code).agg(F.sum(f"{prefix}_count").alias(f"{prefix}_count"))
    if users is None:
        return sums
    sets = isinstance(parts.schema[users].dataType, ArrayType)
    people = rows.select(host, code, (F.explode(users) if sets else F.col(users)).alias("_u")).distinct()
    n = people.where(F.col("_u").isNotNull()).groupBy(host, code).agg(F.count(F.lit(1)).alias(f"{prefix}_user_count"))
    out = sums.join(n, [host, code], "left")
    return out.withColumn(f"{prefix}_user_count", F.coalesce(f"{prefix}_user_count", F.lit(0).cast("long")))


def user_sketches(part: DataFrame, code: str, users: str, host: str = HOST, precision: int = SKETCH_PRECISION) -> DataFrame:
    """A mergeable sketch (HyperLogLog) of the users per host and code of one part, to be stored beside its counts.

    A sketch takes some 2 ** precision bytes at most, whatever the number of users, and is merged before the shuffle.
    """
    rows = part.where(F.col(host).isNotNull() & F.col(code).isNotNull())
    if isinstance(part.schema[users].dataType, ArrayType):
        rows = rows.select(host, code, F.explode(users).alias(users))
    rows = rows.where(F.col(users).isNotNull())  # a group without users has no sketch: its estimate is 0 after a left join
    return rows.groupBy(host, code).agg(F.hll_sketch_agg(F.col(users).cast("string"), F.lit(precision)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Estimated distinct users per ``keys`` from stored sketches of any number of parts; a new part rescans none of the old.

    The standard error is 1.04 / sqrt(2 ** precision), 1.6 % at the default; ``merge_counts`` gives exact numbers.
    """
    estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*keys).agg(estimate.alias(f"{prefix}_user_estimate"))


def ratio_groups(
    df: DataFrame,
    code: str,
    prefix: str,
    codes: Sequence[str],
    host: str = HOST,
    hosts: DataFrame | None = None,
) -> DataFrame:
    """Per host: count per code, share of the code in the host's total, and the mean of request and user share.

    ``hosts`` is the universe of hosts; without it the hosts of ``df``. A host without counts has shares of 0.
    """
    prefixes = [prefix] + ([f"{prefix}_user"] if f"{prefix}_user_count" in df.columns else [])
    sums = [F.sum(f"{p}_count").alias(p) for p in prefixes]
    wide = df.where(F.col(code).isin(*codes)).groupBy(host).pivot(code, list(codes)).agg(*sums)
    if len(prefixes) == 1:
        wide = wide.select(host, *[F.col(f"`{c}`").alias(f"{c}_{prefix}") for c in codes])
    universe = (df if hosts is None else hosts).select(host).distinct()
    wide = universe.join(wide, host, "left").na.fill(0)
    out = [F.col(host)]
    for p in prefixes:
        counts = [F.col(f"`{c}_{p}`") for c in codes]
        total = reduce(lambda a, b: a + b, counts)
        out += [n.cast("long").alias(f"{p}_{c}_count") for n, c in zip(counts, codes)]
        out += [F.coalesce(F.try_divide(n, total), F.lit(0.0)).alias(f"{p}_prs_{c}") for n, c in zip(counts, codes)]
    wide = wide.select(*out)
    return wide.select("*", *[row_mean([f"{p}_prs_{c}" for p in prefixes]).alias(f"{prefix}_avg_prs_{c}") for c in codes])


def merge_counts_and_ratio(
    parts: Sequence[DataFrame], code: str, prefix: str, codes: Sequence[str], host: str = HOST, users: str | None = None
) -> DataFrame:
    return ratio_groups(merge_counts(union_parts(parts), code, prefix, host, users), code, prefix, codes, host)
