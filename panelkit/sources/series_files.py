"""Series files with the key and place of every row, for empty and unreadable files too.

Spark's own readers leave empty files out and stop at one that cannot be opened. This source gives such a file one row with
its key and the reason, so that the universe of series needs no other table.
"""

from __future__ import annotations

import io
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv as pc
import pyarrow.fs as fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

VALUES = ("time", "dP", "Pder")
SCHEMA = "file_name string, start bigint, line bigint, time double, dP double, Pder double, problem string"
# Bytes of one read, and of the files of one task; larger files are read in several tasks.
BLOCK_BYTES = 8 << 20
TASK_BYTES = 64 << 20
# What opening a file costs, in bytes read.
OPEN_BYTES = 4096
# Tasks per core when many small pieces are packed.
TASKS_PER_CORE = 4
# The folder of rows without a key, named as Spark's own writers name it.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


class Files(InputPartition):
    def __init__(self, pieces: list[tuple[str, str, int, int]]):
        self.pieces = pieces  # (key, path, start, end)


def _open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _number(text: str) -> float | None:
    try:
        return None if "_" in text else float(text)
    except ValueError:
        return None


def parse_lines(data: bytes) -> list[pa.Array]:
    """Three columns of numbers; cells that are none become NULL, blank lines are passed over, further cells ignored."""
    kinds = {c: pa.float64() for c in VALUES}
    try:
        table = pc.read_csv(
            io.BytesIO(data),
            read_options=pc.ReadOptions(column_names=list(VALUES), use_threads=False),
            parse_options=pc.ParseOptions(delimiter="\t", quote_char=False),
            convert_options=pc.ConvertOptions(column_types=kinds, null_values=[""]),
        )
        return [table[c].combine_chunks() for c in VALUES]
    except pa.ArrowInvalid:  # some line is not three numbers: cell by cell
        lines = [x.split("\t") for x in data.decode("utf-8", "replace").splitlines() if x.strip()]
        return [pa.array([_number(x[i]) if i < len(x) else None for x in lines], pa.float64()) for i in range(len(VALUES))]


def _blocks(stream, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Whole lines that begin in [start, end), in blocks; a piece in the middle of a file leaves its first part line to the one before."""
    stream.seek(max(start - 1, 0))
    at = start
    if start:
        skipped = _to_line_end(stream)
        at = start - 1 + len(skipped)
    while at < end:
        data = stream.read(min(BLOCK_BYTES, end - at))
        if not data:
            return
        if not data.endswith(b"\n"):
            data += _to_line_end(stream)
        yield at, data
        at += len(data)


def _to_line_end(stream) -> bytes:
    out = b""
    while part := stream.read(4096):
        cut = part.find(b"\n") + 1
        if cut:
            stream.seek(stream.tell() - len(part) + cut)
            return out + part[:cut]
        out += part
    return out


class SeriesReader(DataSourceReader):
    def __init__(self, path: str, task_bytes: int, tasks: int = 1):
        self.path, self.task_bytes, self.tasks = path, task_bytes, tasks

    def partitions(self) -> list[Files]:
        """Pieces of ``task_bytes`` at most, packed by bytes. The driver lists names and sizes, as Spark's own file readers do.

        Many small pieces go into about ``tasks`` tasks, so that the number of tasks does not grow with the number of files
        before each has ``TASK_BYTES`` to read.
        """
        files, folder = _open_folder(self.path)
        found = files.get_file_info(fs.FileSelector(folder, recursive=True))
        pieces = []
        for f in sorted(found, key=lambda f: f.path):
            hidden = any(p.startswith((".", "_")) for p in f.path[len(folder.rstrip("/")) :].split("/"))
            if f.type != fs.FileType.File or hidden:
                continue
            key = f.path[len(folder.rstrip("/")) + 1 :]
            for start in range(0, max(f.size, 1), self.task_bytes):
                pieces.append((key, f.path, start, min(start + self.task_bytes, f.size)))
        cost = [end - start + OPEN_BYTES for _, _, start, end in pieces]
        most = max(self.task_bytes, min(TASK_BYTES, sum(cost) // self.tasks))
        out, packed, size = [], [], 0
        for piece, c in zip(pieces, cost):
            packed.append(piece)
            size += c
            if size >= most:
                out.append(Files(packed))
                packed, size = [], 0
        return [*out, Files(packed)] if packed or not out else out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        files, _ = _open_folder(self.path)
        for key, path, start, end in partition.pieces:
            if start == end:
                yield self._batch(key, None, [pa.nulls(1, pa.float64())] * 3, "empty")
                continue
            line = 0
            try:
                with files.open_input_file(path) as stream:
                    for _, data in _blocks(stream, start, end):
                        values = parse_lines(data)
                        if len(values[0]):
                            yield self._batch(key, (start, line), values, None)
                        line += len(values[0])
            except OSError as e:  # the rows read before stay, and the reason is a row of its own
                yield self._batch(key, None, [pa.nulls(1, pa.float64())] * 3, type(e).__name__)

    @staticmethod
    def _batch(key: str, place: tuple[int, int] | None, values: list[pa.Array], problem: str | None) -> pa.RecordBatch:
        n = len(values[0])
        starts = pa.array([place[0] if place else None] * n, pa.int64())
        lines = pa.array(range(place[1], place[1] + n) if place else [None] * n, pa.int64())
        names = ["file_name", "start", "line", *VALUES, "problem"]
        return pa.RecordBatch.from_arrays([pa.array([key] * n, pa.string()), starts, lines, *values, pa.array([problem] * n, pa.string())], names=names)


class Written(WriterCommitMessage):
    pass


def _cell(x: float | None) -> str:
    """A number as Spark's CSV writer puts it: the shortest text that reads back as the same double."""
    if x is None:
        return ""
    text = repr(float(x))
    return {"inf": "Infinity", "-inf": "-Infinity", "nan": "NaN"}.get(text, text)


class SeriesWriter(DataSourceArrowWriter):
    """A file ``{key}={value}/part-...`` per run of rows with one key; the first column is the key, the others go into the lines.

    A file is written under a hidden name and moved when it is whole, and its name comes from the task's place: a task that
    runs again replaces what it wrote before. Spark's own writers start a process per file to set its rights on a local disk.
    """

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, folder = _open_folder(self.path)
        part, run, out, own, hidden = TaskContext.get().partitionId(), 0, None, None, None

        def close():
            out.close()
            files.move(hidden, own)

        last = None
        for batch in iterator:
            name, keys = batch.schema.names[0], batch.column(0).to_pylist()
            lines = ["\t".join(map(_cell, x)) for x in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            begins = [i for i, k in enumerate(keys) if (k != keys[i - 1] if i else out is None or k != last)]
            cuts = begins if begins[:1] == [0] else [0, *begins]  # a batch may go on with the key of the one before
            fresh = {*begins}
            for a, b in zip(cuts, [*cuts[1:], len(keys)]):
                if a in fresh:
                    if out is not None:
                        close()
                    below = f"{folder.rstrip('/')}/{name}={NO_KEY if keys[a] is None else keys[a]}"
                    own, hidden = f"{below}/part-{part:05d}-{run}.csv", f"{below}/_{uuid.uuid4().hex}"
                    files.create_dir(below, recursive=True)
                    out, run = files.open_output_stream(hidden), run + 1
                if b > a:
                    out.write(("\n".join(lines[a:b]) + "\n").encode())
            last = keys[-1] if keys else last
        if out is not None:
            close()
        return Written()


class SeriesFiles(DataSource):
    """``spark.read.format("series_files").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "series_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> SeriesReader:
        return SeriesReader(self.options["path"], int(self.options.get("taskBytes", TASK_BYTES)), int(self.options.get("tasks", 1)))

    def writer(self, schema, overwrite: bool) -> SeriesWriter:
        return SeriesWriter(self.options["path"])


def _register(spark: SparkSession) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package
    spark.dataSource.register(SeriesFiles)


def write_series_files(df: DataFrame, key: str, path: str) -> str:
    """Write a folder ``{key}={value}`` of headerless tab-separated lines per series below the new folder ``path``.

    Rows of one series must lie together and in order in their partition (``repartition`` and ``sortWithinPartitions`` by the key).
    """
    _register(df.sparkSession)
    df.select(key, *[c for c in df.columns if c != key]).write.format("series_files").mode("append").save(path)
    return path


def read_series_files(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows of all files below ``path`` with ``file_name`` (path below the folder), ``start`` and ``line`` (their order).

    An empty or unreadable file gives one row with ``problem`` and no place; lines that are not numbers give NULLs. Files
    above ``task_bytes`` are read in pieces that begin at lines, so one large file is spread over tasks; small pieces share a task.
    """
    _register(spark)
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return spark.read.format("series_files").option("taskBytes", task_bytes).option("tasks", tasks).load(path)
