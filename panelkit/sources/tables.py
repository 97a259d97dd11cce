"""Readers with explicit schemas, and sinks."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.labels import SHORT_FLAGS
from panelkit.session import DICTIONARY_BYTES

CALENDAR = "date date, week int"
TEMPLATE = "inn_id bigint, week int, predict double"
SERIES = "time double, dP double, Pder double"
RUN_LOG = (
    "num int, mdl string, fold int, mdl_score double, auc_macro double, auc_micro double, auc_wght double, "
    "f1_macro double, f1_micro double, f1_wght double, tst_score double, model_columns string, "
    "exclude_columns string, cat_columns string, comment string"
)


def read_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType, sep: str = ",", header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CALENDAR)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """``HOLIDAY`` as dd.MM.yyyy, separated by semicolons."""
    raw = read_csv(spark, path, "HOLIDAY string", sep=";")
    return raw.select(F.to_date("HOLIDAY", "dd.MM.yyyy").alias("date"))


def read_template(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TEMPLATE)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn("week", F.col("week").cast("int"))


def read_series(spark: SparkSession, path: str | list[str], *, below: str | None = None) -> DataFrame:
    """All series files of a folder as one frame: ``file_name``, ``split_start``, ``row_id`` and the three values.

    (``split_start``, ``row_id``) orders the rows of a file: its splits start at growing offsets, and row ids grow
    within a split. Lines that do not parse give NULLs and are dropped by the time filter later. ``file_name`` is the bare
    name, or the path below the folder ``below``, which tells equal names in two folders apart.
    """
    name = F.col("_metadata.file_name")
    if below is not None:
        name = F.substring_index(F.col("_metadata.file_path"), below.rstrip("/") + "/", -1)
    raw = spark.read.schema(SERIES).option("sep", "\t").option("mode", "PERMISSIVE").csv(path)
    return raw.select(
        name.alias("file_name"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row_id"),
        "time",
        "dP",
        "Pder",
    )


def series_universe(keys: Sequence[DataFrame], key: str = "file_name") -> DataFrame:
    """Distinct keys of all given frames: an empty file has no rows, so its key must come from a table."""
    out = keys[0].select(key)
    for k in keys[1:]:
        out = out.unionByName(k.select(key))
    return out.distinct()


# Fixed patterns: run number (three digits or more) and one-digit fold in the name of a prediction file.
RUN_PATTERN = r"submit(?:_proba)?_(\d{3,})"
FOLD_PATTERN = r"submit(?:_proba)?_\d{3,}_(\d)(?=_local|\.csv)"


def _from_name(path: Column, pattern: str) -> Column:
    """The number in the file's own name, else in its folder's (Spark writes a folder per table); no folder above counts."""
    own, above = F.substring_index(path, "/", -1), F.regexp_extract(path, "([^/]+)/[^/]*$", 1)
    return F.coalesce(*(F.regexp_extract(x, pattern, 1).try_cast("int") for x in (own, above)))


def run_number(path: Column) -> Column:
    return _from_name(path, RUN_PATTERN)


def fold_number(path: Column) -> Column:
    """NULL for a file that holds no single fold."""
    return _from_name(path, FOLD_PATTERN)


def read_folds(spark: SparkSession, paths: str | list[str], columns: Sequence[str] = SHORT_FLAGS, kind: str = "int") -> DataFrame:
    """Prediction files as one frame with ``run`` and ``fold`` from their names."""
    schema = "file_name string, " + ", ".join(f"`{c}` {kind}" for c in columns)
    raw = read_csv(spark, paths, schema)
    path = F.col("_metadata.file_path")
    return raw.select("*", run_number(path).alias("run"), fold_number(path).alias("fold"))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("parquet.dictionary.page.size", DICTIONARY_BYTES).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", header: bool = True) -> str:
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)
    return path


def write_sorted(df: DataFrame, path: str, order: Sequence[str], descending: Sequence[str] = ()) -> str:
    """Write ``df`` in the total order of its columns: one file per range, each sorted; no task sorts more than its range."""
    by = [F.col(c).desc() if c in descending else F.col(c).asc() for c in order]
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return path


def read_sorted(spark: SparkSession, path: str, name: str = "row") -> DataFrame:
    """A table of ``write_sorted`` with each row's place in the whole order, from 0: the rows of earlier files are counted first."""
    df = spark.read.parquet(path)
    at = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    files = at.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")
    return at.join(files.select("_file", before.alias("_before")), "_file").select(*df.columns, (F.col("_before") + F.col("_at")).alias(name))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 64) -> DataFrame:
    """Store ``df`` as an external table in ``buckets`` files by ``keys``, sorted within; windows and joins by ``keys`` on the result
    need no shuffle."""
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys)
    writer.sortBy(*keys, *order).saveAsTable(table)
    return df.sparkSession.table(table)


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """The versions of a materialized table and whether each was finished (Spark's own mark of a committed job)."""
    fs, folder = _files(spark, path)
    if not fs.exists(folder):
        return {}
    names = [re.fullmatch(r"v(\d+)", f.getPath().getName()) for f in fs.listStatus(folder)]
    made = {int(m[1]): m[0] for m in names if m}
    return {n: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS")) for n, name in made.items()}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished version of the table lies at ``path``."""
    return any(versions(spark, path).values())


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], remake: bool = False, keep: int = 2) -> DataFrame:
    """The table at ``path``; built and written first when it is missing or ``remake`` is set.

    A rebuild writes a version beside the finished ones, and readers take the latest finished one: a rebuild that fails leaves the
    old table as it is. The ``keep`` latest finished versions stay, for readers that opened one before.
    """
    made = versions(spark, path)
    if remake or not any(made.values()):
        new = max(made, default=0) + 1
        write_parquet(build(), f"{path}/v{new}", mode="errorifexists")
        made = versions(spark, path)
        fs, _ = _files(spark, path)
        for old in sorted(n for n, done in made.items() if done)[:-keep]:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v{old}"), True)
    return spark.read.parquet(f"{path}/v{max(n for n, done in made.items() if done)}")
