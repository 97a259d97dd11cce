"""Label tables: precedence union, label strings, rare-label backoff, deterministic samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators.joins import join_small
from panelkit.operators.ordered import global_running

KEY = "file_name"
BACKOFF = (5, 3, 1)
# Leading digits of a digest that make the histogram of a sample: 65,536 buckets.
HASH_DIGITS = 4
# Names of the eight flags of a series, in their order, long and short.
FLAGS = (
    "Некачественное ГДИС",
    "Влияние ствола скважины",
    "Радиальный режим",
    "Линейный режим",
    "Билинейный режим",
    "Сферический режим",
    "Граница постоянного давления",
    "Граница непроницаемый разлом",
)
SHORT_FLAGS = ("bq", "wb", "ra", "li", "bi", "sp", "pc", "im")


def not_in(df: DataFrame, other: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key does not occur in ``other``; a NULL key is kept."""
    return df.join(other.select(key).distinct(), key, "left_anti")


def prefer(base: DataFrame, better: DataFrame, key: str = KEY, flag: str = "hq") -> DataFrame:
    """Rows of ``base`` whose key is not in ``better``, then all of ``better``; ``flag`` tells them apart."""
    kept = not_in(base, better, key).withColumn(flag, F.lit(0))
    return kept.unionByName(better.withColumn(flag, F.lit(1)), allowMissingColumns=True)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def seen_once(df: DataFrame, column: str) -> DataFrame:
    """Values that occur exactly once."""
    return value_counts(df, column).where(F.col("n") == 1).select(column)


def back_off(df: DataFrame, column: str = "labels", lengths: Sequence[int] = BACKOFF) -> DataFrame:
    """Shorten labels that occur once to 5 characters, count again, then to 3, then to 1.

    A label is decided by counts over distinct labels alone, so the chain runs on the label table and the rows
    are joined to its result once; a label held by a third of all rows is counted map-side first.
    """
    names = value_counts(df, column).select(F.col(column).alias("_from"), F.col(column).alias("_to"), F.col("n"))
    for length in lengths:
        total = names.groupBy("_to").agg(F.sum("n").alias("_n"))
        names = names.join(total, "_to").select(
            "_from", F.when(F.col("_n") == 1, F.substring("_to", 1, length)).otherwise(F.col("_to")).alias("_to"), "n"
        )
    names = names.select(F.col("_from").alias(column), "_to")
    return join_small(df, names, column).select(*[F.col("_to").alias(c) if c == column else F.col(c) for c in df.columns])


def label_table(
    base: DataFrame, better: DataFrame, flags: Sequence[str], key: str = KEY, sample: int | None = None, seed: int = 127
) -> DataFrame:
    """Union with precedence, label string of ``hq`` and the flags, rare labels backed off."""
    rows = prefer(base, better, key)
    if sample is not None:
        rows = sample_rows(rows, sample, key, seed)
    return back_off(rows.withColumn("labels", S.flags_label(["hq", *flags])))


def first_by_hash(df: DataFrame, n: int, digest: Column, key: str) -> DataFrame:
    """The ``n`` rows with the least hexadecimal ``digest`` (ties by ``key``), or all, in any order.

    A histogram over the first four digits finds the cut: rows before it stay as they are, and only the rows of the
    bucket at the cut are ranked, over ranges. No task takes n rows, and the driver takes two numbers.
    """
    rows = df.withColumn("_digest", digest)
    bucket = F.substring("_digest", 1, HASH_DIGITS)
    counts = rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))  # at most 16 ** HASH_DIGITS rows
    upto = counts.select("_bucket", "_n", F.sum("_n").over(Window.orderBy("_bucket")).alias("_upto"))
    cut = upto.where(F.col("_upto") >= n).orderBy("_bucket").select("_bucket", n - (F.col("_upto") - F.col("_n"))).first()
    if cut is None:
        return df
    last = global_running(rows.where(bucket == cut[0]), ["_digest", key], {"_rank": F.lit(1)})
    kept = rows.where(bucket < cut[0]).unionByName(last.where(F.col("_rank") < cut[1]).drop("_rank"))
    return kept.drop("_digest")


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 127) -> DataFrame:
    """Exactly n rows, the same ones for the same seed. Of rows with one key any may be taken at the cut; a NULL key counts as ''."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return first_by_hash(df, n, F.md5(F.concat(text, F.lit(f":{seed}"))), key)


def sample_keys(df: DataFrame, n: int, key: str) -> DataFrame:
    """n distinct keys, chosen by their MD5."""
    keys = df.select(key).distinct()
    return first_by_hash(keys, n, F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), key)
