"""Operator 8: substrings repeated across texts, by content-defined chunks.

A gear hash rolls over the bytes: ``h = (h << 2) + gear[byte]`` in 32 bits, so it depends on the last 16 bytes only. A chunk
ends where the hash is the least within ``reach`` bytes to either side. That depends on nearby content alone, without a
state carried along the text: an insertion moves the cuts around it and no others. Chunks are compared by 128-bit digests.

A chunk is *shared* if its digest stands anywhere else, in the same text too. Single short chunks may be equal by chance,
so shared chunks count only in unbroken stretches of at least ``min_run`` bytes. Of each digest one copy stays: the first
one in the row with the least (id, content hash).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import SHARD_BYTES, Scratch, long_list, row_keys, text_buffer, tidy_shuffles

#: Cuts agree from 31 bytes after the start of a passage to 16 before its end, 33 bytes apart on average: passages of just
#: over 50 words (some 250 bytes) keep a shared stretch of ``MIN_RUN`` bytes.
REACH = 16
MAX_CHUNK = 1024
MIN_RUN = 64

_GEAR_BYTES, _GEAR_SHIFT = 16, 2
_GEAR = np.random.default_rng(8).integers(0, 1 << 32, 256, dtype=np.uint32)
_CHUNKS = "doc long, rid long, one array<long>, two array<long>, places array<long>"


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte; the first 15 values see fewer bytes."""
    h = _GEAR[data]
    step = 1
    while step < _GEAR_BYTES:
        older = h[:-step] << np.uint32(step * _GEAR_SHIFT)
        h[step:] += older
        step *= 2
    return h


def _minima(data: np.ndarray, reach: int) -> np.ndarray:
    """Positions whose hash is below all ``reach`` before and not above any ``reach`` after."""
    if len(data) < 2 * reach + 1:
        return np.zeros(0, np.int64)
    h = gear(data)
    low, have = h, 1
    while 2 * have <= reach:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    n = len(h) - reach + 1
    low = np.minimum(low[:n], low[reach - have : reach - have + n])
    inner = h[reach : len(h) - reach]
    return np.flatnonzero((inner < low[: len(inner)]) & (inner <= low[reach + 1 :])) + reach


def boundaries(data: np.ndarray, offsets: np.ndarray, reach: int = REACH, most: int = MAX_CHUNK) -> np.ndarray:
    """Chunk boundaries of concatenated texts: all offsets, the cuts inside, and steps of ``most`` in what is longer."""
    margin = _GEAR_BYTES - 1 + reach
    found = []
    for at in range(0, len(data), SHARD_BYTES):
        a, b = max(0, at - margin), min(len(data), at + SHARD_BYTES + reach)
        cut = _minima(data[a:b], reach) + a
        found.append(cut[(cut >= at) & (cut < at + SHARD_BYTES)])
    cuts = np.concatenate(found) if found else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, cuts, side="right") - 1
    cuts = cuts[(cuts - margin >= offsets[row]) & (cuts + reach < offsets[row + 1])] + 1
    bounds = np.union1d(offsets, cuts)
    wide = np.flatnonzero(np.diff(bounds) > most)
    extra = [np.arange(bounds[k] + most, bounds[k + 1], most) for k in wide]
    return np.union1d(bounds, np.concatenate(extra)) if extra else bounds


def _find_chunks(reach: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            bounds = boundaries(data, offsets, reach, most)
            view, digest = memoryview(np.ascontiguousarray(data)), hashlib.blake2b
            edges = bounds.tolist()
            raw = b"".join([digest(view[a:b], digest_size=16).digest() for a, b in zip(edges[:-1], edges[1:], strict=True)])
            pairs = np.frombuffer(raw, np.int64).reshape(-1, 2)
            rows = np.searchsorted(bounds, offsets)
            counts = np.diff(rows)
            own = np.repeat(np.arange(len(batch)), counts)
            # Whether the row had this digest before: order by (row, digest, place) and look at the neighbour.
            order = np.lexsort((bounds[:-1], pairs[:, 1], pairs[:, 0], own))
            again = np.zeros(len(own), bool)
            if len(own):
                one, two, r = pairs[order, 0], pairs[order, 1], own[order]
                again[order[1:]] = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & (r[1:] == r[:-1])
            places = (bounds[:-1] - offsets[own]) << 22 | np.diff(bounds) << 1 | again
            lists = (pa.int64(), pairs[:, 0]), (pa.int64(), pairs[:, 1]), (pa.int64(), places)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("rid"), *(long_list(v, rows, k) for k, v in lists)],
                names=["doc", "rid", "one", "two", "places"],
            )

    return run


_DIGEST = (
    "id long, n_bytes long, n_shared long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<lo:int,end:int>>"
)


def _digest(min_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            found = batch.column("marks").fill_null([])
            marks, rows = found.flatten().to_numpy(), np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy())])
            shared, removed, counts, shas, los, ends = [], [], [], [], [], []
            for row in range(len(batch)):
                text = data[offsets[row] : offsets[row + 1]]
                lo, end, n = removals(marks[rows[row] : rows[row + 1]], min_run)
                sha, at = hashlib.sha256(), 0
                for x, y in zip(lo.tolist(), end.tolist(), strict=True):
                    sha.update(text[at:x])
                    at = y
                sha.update(text[at:])
                shared.append(n)
                removed.append(int((end - lo).sum()))
                counts.append(len(lo))
                shas.append(sha.hexdigest())
                los.append(lo)
                ends.append(end)
            pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int32()) for x in (los, ends)], names=["lo", "end"])
            spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pairs)
            numbers = (pa.array(x, pa.int64()) for x in (shared, removed, counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(offsets)), *numbers, pa.array(shas), spans],
                names=["id", "n_bytes", "n_shared", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return run


def removals(marks: np.ndarray, min_run: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Removed (starts, ends) of a text and its shared bytes, from marks start << 22 | length << 1 | stays of shared chunks."""
    marks = np.sort(marks)
    lo, stays = marks >> 22, (marks & 1) > 0
    end = lo + (marks >> 1 & (1 << 21) - 1)
    if not len(lo):
        return lo, lo, 0
    run = np.concatenate([[0], np.cumsum(lo[1:] != end[:-1])])
    size = np.bincount(run, weights=(end - lo).astype(float)).astype(np.int64)[run]
    counted = size >= min_run
    gone = counted & ~stays
    total = int((end - lo)[counted].sum())
    lo, end = lo[gone], end[gone]
    if not len(lo):
        return lo, lo, total
    new = np.concatenate([[True], lo[1:] != end[:-1]])
    return lo[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])], total


def chunk_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    reach: int = REACH,
    most: int = MAX_CHUNK,
    min_run: int = MIN_RUN,
) -> DataFrame:
    """Per row: id, n_bytes, n_shared (bytes in counted shared stretches), n_removed (without the copy that stays),
    n_spans and spans (removed runs), kept_sha256 of the remaining bytes.

    Null and empty texts have no chunks. Ids may be null or repeated; rows equal in id and text are copies of one row:
    each keeps what that row keeps. Other columns are ignored. An empty table gives an empty result.
    """
    if not reach < most < 1 << 20:
        raise ValueError("most must lie above reach and below 2^20")
    scratch = Scratch(docs.sparkSession, "chunk-dedup")
    rows = docs.select(*row_keys(id_col, text_col), F.col(text_col).alias("text"))
    with tidy_shuffles(docs.sparkSession):
        chunks = scratch.table(rows.mapInArrow(_find_chunks(reach, most), _CHUNKS))
        each = chunks.select("doc", "rid", F.explode(F.arrays_zip("one", "two", "places")).alias("x")).select("doc", "rid", "x.*")
        holder = F.min(F.struct("doc", "rid")).alias("first")
        shared = each.groupBy("one", "two").agg(F.count("*").alias("n"), holder).filter("n > 1")
        shared = scratch.table(shared.select("one", "two", F.col("first.doc").alias("doc0"), F.col("first.rid").alias("rid0")))
        stays = F.expr("doc = doc0 and rid = rid0 and places % 2 = 0").cast("long")
        mark = (F.expr("places - places % 2") + stays).alias("mark")
        marks = each.join(shared, ["one", "two"]).select("doc", "rid", mark).groupBy("doc", "rid").agg(F.collect_set("mark").alias("marks"))
        marks = scratch.table(marks)
    return rows.join(marks, ["doc", "rid"], "left").select("id", "text", "marks").mapInArrow(_digest(min_run), _DIGEST).withColumnRenamed("id", id_col)


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return chunk_dedup(docs).drop("spans")
