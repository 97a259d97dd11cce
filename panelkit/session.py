"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitted settings are used instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("panelkit")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Small inputs with much work per row: merging partitions by size would leave cores idle here.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or a fresh one in local mode."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
        return folder
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="panelkit-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so that later plans read the same rows after a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def compile_wide_rows(spark: SparkSession) -> None:
    """Plan steps with many columns outside the generated loop when that loop has a method above 8,000 bytes.

    HotSpot never compiles such a method, and Spark's default limit is 65,535: a select of some 70 expressions was interpreted.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


# Fixed value: a column leaves its dictionary at 2,048 distinct doubles. Parquet's default of 1 MB hashes every value of the first
# page of each row group, and a table of some 200 columns has many row groups.
DICTIONARY_BYTES = 16_384
# Spark's settings of the Parquet files of results of hundreds of columns of numbers.
WIDE_RESULTS = {"spark.sql.parquet.compression.codec": "zstd", "parquet.dictionary.page.size": str(DICTIONARY_BYTES)}


def pack_wide_results(spark: SparkSession) -> None:
    """Have this session's Parquet files written smaller (a fifth to a third less than with Spark's defaults); set values are kept."""
    given = spark.conf.getAll
    for key, value in WIDE_RESULTS.items():
        if key not in given:
            spark.conf.set(key, value)
