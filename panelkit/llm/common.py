"""Shared helpers: text buffers of Arrow batches, durable tables, range hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import shared_dir

#: Bytes of text handled at once inside a task.
SHARD_BYTES = 1 << 18

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block Spark deletes a finished query's shuffle files at once instead of at the next driver GC.

    For jobs of several written steps: a step's shuffle is of no use once its table stands. Frames are not run twice.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per context, as ``--py-files`` would.

    Texts are long rows: Spark's defaults of 10,000 rows and 64 MB per Arrow batch are lowered for the session, set values
    are kept.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "2048")
    if spark.conf.get(_BATCH_BYTES) == "67108864b":
        spark.conf.set(_BATCH_BYTES, "8m")
    if getattr(sc, "_panelkit_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="panelkit-py-")), "panelkit.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(target)
    sc._panelkit_shipped = True


class Scratch:
    """Tables of one run, in a folder of its own below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        ship(spark)
        self.spark = spark
        self.path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def write(self, df: DataFrame, *, sort: list[str] | None = None) -> str:
        self._n += 1
        path = f"{self.path}/{self._n}"
        if sort:
            df = df.sortWithinPartitions(*sort)
        df.write.option("compression", "zstd").parquet(path)
        return path

    def table(self, df: DataFrame, *, sort: list[str] | None = None) -> DataFrame:
        """Write ``df`` and read it back: later plans start from files that outlive any executor."""
        schema = df.schema
        return self.spark.read.schema(schema).parquet(self.write(df, sort=sort))

    def drop(self, path: str) -> None:
        """Delete one written table that a merge has replaced."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def set_aside(docs: DataFrame, text_col: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` as its text and one struct of all other columns, and the way back.

    What an operator adds in between cannot clash with a column of the caller.
    """
    others = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]
    kept = F.struct(*[c for c, name in zip(others, docs.columns, strict=True) if name != text_col] or [F.lit(0)])

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") if c == text_col else F.col(f"__kept.c{k}").alias(c) for k, c in enumerate(docs.columns)])

    return docs.select(F.col(f"`{text_col}`"), kept.alias("__kept")), back


def row_keys(id_col: str, text_col: str) -> list[Column]:
    """``id`` as given, and the pair (``doc``, ``rid``) that names a row by content, never null, the same in every rerun.

    ``doc`` is the id (null: 0), ``rid`` 64 bits of id and text with their nulls. Equal rows share the pair.
    """
    key, text = F.col(id_col).cast("long"), F.col(text_col)
    return [key.alias("id"), F.coalesce(key, F.lit(0)).alias("doc"), F.xxhash64(key, key.isNull(), text, text.isNull()).alias("rid")]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (null: empty) and the ``len + 1`` offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, ends, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def shards(offsets: np.ndarray, limit: int = SHARD_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (an invertible multiply-xorshift)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(32)
    return x


class RangeHash:
    """Hashes of any range of a sequence from prefix sums: sum of t[v_j] * base^(j - start), modulo 2^64."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
        self.base = int(rng.integers(0, 1 << 62)) * 8 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.pow = np.ones(1, np.uint64)
        self.inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        have = len(self.pow)
        if have >= n:
            return
        size = max(n, 2 * have, 4096)
        self.pow = _powers(self.base, size)
        self.inv = _powers(self.inverse, size)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums over bytes, or over 64-bit values that are hashes already."""
        n = len(values)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        codes = self.values[values] if values.dtype == np.uint8 else values
        np.cumsum(codes * self.pow[:n], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        self._grow(len(prefix))
        return (prefix[end] - prefix[start]) * self.inv[start]

    def windows(self, prefix: np.ndarray, width: int) -> np.ndarray:
        """The hash of every window of ``width`` values."""
        n = len(prefix) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (prefix[width:] - prefix[:n]) * self.inv[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        step = step * step % (1 << 64)
        done += more
    return out


def long_list(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
