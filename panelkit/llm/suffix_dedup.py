"""Operator 2: long repeated strings, found with a logarithmic family of sparse suffix arrays.

A full suffix array of the corpus would be many times its size. Here a suffix is indexed only at *anchors*: in each
window of ``width`` bytes, the position whose next ``gram`` bytes hash lowest (the first such). Equal windows choose the
same anchor, so two equal strings of ``width`` bytes always meet at an indexed suffix; nothing is lost, and there is one
entry for about ``(width - gram) / 2`` bytes. Consecutive windows with one anchor form a *run*. An index entry is (hash of
the anchored suffix's first ``gram`` bytes, hash of the run's whole text, number of such runs): entries ordered by it are
the suffix array, in an order of hashes instead of letters, which a merge scan for equality may use as well.

The corpus comes in batches. A batch gets its own sorted array, is merge-scanned against every existing level, and joins
the family; two levels of equal size merge into one of twice the size, so a row is rewritten log2(batches) times.

The scan says of each run that (a) the same whole run stands elsewhere: all its bytes go; (b) its suffix stands
elsewhere with other surroundings: its windows are hashed one by one and compared; (c) neither: nothing of it repeats.
Every comparison is by counts per hash, so a passage shared by a third of all rows is added up before the shuffle.
Equality is by 128 bits (suffix and run, or suffix and window).

Shorter passages, of some fifty words, are reported beside this and not removed: a second, denser set of anchors (every window of
``PASSAGE`` bytes has one) gives the ``gram`` bytes behind each anchor, and ``n_repeated`` counts the bytes of those that stand in two
places at least, with all removed ones. Of every repeated string of ``PASSAGE`` bytes it has ``gram`` bytes or more; no byte outside a
repeated string of ``gram`` bytes is counted. Equality is by 64 bits here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import SHARD_BYTES, RangeHash, Scratch, long_list, mix, row_keys, shards, text_buffer, tidy_shuffles

WIDTH = 400
GRAM = 128
#: Width of the passages that are counted, not removed.
PASSAGE = 240
BATCHES = 4
#: Windows of a run are first compared in blocks of so many neighbours, by the text that all of a block share.
BLOCK = 32

_LOW = np.uint64(SHARD_BYTES * 2 - 1)
_KEY, _WHOLE = RangeHash(11), RangeHash(12)
_RUNS = "doc long, rid long, keys array<long>, wholes array<long>, los array<int>, his array<int>, ats array<int>"


def _anchors(data: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start the position of its anchor; the hash of the ``gram`` bytes at each position."""
    hashes = mix(_KEY.windows(_KEY.prefix(data), gram))
    order = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    span, reach, n = width - gram + 1, 1, len(data) - width + 1
    while 2 * reach <= span:
        order = np.minimum(order[:-reach], order[reach:])
        reach *= 2
    lowest = np.minimum(order[:n], order[span - reach : span - reach + n])
    return (lowest & _LOW).astype(np.int64), hashes


def _runs(data: np.ndarray, starts: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs (key, whole, first and last window start, anchor) of concatenated texts that begin at ``starts`` (with the end)."""
    empty = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(data) < width:
        return empty
    anchor, hashes = _anchors(data, width, gram)
    edges = np.zeros(len(anchor) + 1, np.int32)
    fits = np.diff(starts) >= width
    np.add.at(edges, starts[:-1][fits], 1)
    np.add.at(edges, starts[1:][fits] - width + 1, -1)
    valid = np.cumsum(edges[:-1]) > 0
    change = np.ones(len(anchor) + 1, bool)
    change[1:-1] = anchor[1:] != anchor[:-1]
    before = np.concatenate([[False], valid[:-1]])
    after = np.concatenate([valid[1:], [False]])
    lo = np.flatnonzero(valid & (change[:-1] | ~before))
    hi = np.flatnonzero(valid & (change[1:] | ~after))
    whole = mix(_WHOLE.ranges(_WHOLE.prefix(data), lo, hi + width) ^ (hi - lo).astype(np.uint64))
    return hashes[anchor[lo]], whole, lo, hi, anchor[lo]


def _places(data: np.ndarray, starts: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, anchor) of all windows inside the concatenated texts that begin at ``starts``, each anchor once."""
    if len(data) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    anchor, hashes = _anchors(data, width, gram)
    edges = np.zeros(len(anchor) + 1, np.int32)
    fits = np.diff(starts) >= width
    np.add.at(edges, starts[:-1][fits], 1)
    np.add.at(edges, starts[1:][fits] - width + 1, -1)
    own = anchor[np.cumsum(edges[:-1]) > 0]
    own = own[np.append(True, own[1:] != own[:-1])[: len(own)]]
    return hashes[own], own


def _find_places(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for i, j in shards(offsets):
                first, last = int(offsets[i]), int(offsets[j])
                long = last - first > SHARD_BYTES
                parts = []
                for at in range(first, last if long else first + 1, SHARD_BYTES):
                    end = min(last, at + SHARD_BYTES + width - 1) if long else last
                    key, place = _places(data[at:end], np.array([0, end - at]) if long else offsets[i : j + 1] - first, width, gram)
                    parts.append((key, place + at))
                key, place = (np.concatenate(x) for x in zip(*parts, strict=True))
                rows = np.searchsorted(place, offsets[i : j + 1])
                local = place - np.repeat(offsets[i:j], np.diff(rows))
                lists = [long_list(key.view(np.int64), rows, pa.int64()), long_list(local.astype(np.int32), rows, pa.int32())]
                yield pa.RecordBatch.from_arrays([batch.column("doc")[i:j], batch.column("rid")[i:j], *lists], names=["doc", "rid", "keys", "ats"])

    return run


def _find_runs(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for i, j in shards(offsets):
                first, last = int(offsets[i]), int(offsets[j])
                parts = []
                # A text beyond the shard size is cut into overlapping pieces: every window lies in one of them.
                for at in range(first, last if last - first > SHARD_BYTES else first + 1, SHARD_BYTES):
                    end = min(last, at + SHARD_BYTES + width - 1) if last - first > SHARD_BYTES else last
                    starts = np.array([0, end - at]) if last - first > SHARD_BYTES else offsets[i : j + 1] - first
                    key, whole, lo, hi, anchor = _runs(data[at:end], starts, width, gram)
                    parts.append((key, whole, lo + at, hi + at, anchor + at))
                key, whole, lo, hi, anchor = (np.concatenate(x) for x in zip(*parts, strict=True))
                rows = np.searchsorted(lo, offsets[i : j + 1])
                base = np.repeat(offsets[i:j], np.diff(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc")[i:j],
                        batch.column("rid")[i:j],
                        long_list(key.view(np.int64), rows, pa.int64()),
                        long_list(whole.view(np.int64), rows, pa.int64()),
                        long_list((lo - base).astype(np.int32), rows, pa.int32()),
                        long_list((hi - base).astype(np.int32), rows, pa.int32()),
                        long_list((anchor - base).astype(np.int32), rows, pa.int32()),
                    ],
                    names=["doc", "rid", "keys", "wholes", "los", "his", "ats"],
                )

    return run


class SuffixLevels:
    """Levels of entries (key, whole, n). ``add`` scans a batch against all levels, keeps it, and merges equal sizes."""

    def __init__(self, scratch: Scratch) -> None:
        self.scratch = scratch
        self.levels: list[tuple[int, str]] = []
        self.full: list[str] = []
        self.mixed: list[str] = []

    def _read(self, path: str) -> DataFrame:
        return self.scratch.spark.read.schema("key long, whole long, n long").parquet(path)

    def add(self, entries: DataFrame) -> None:
        """``entries``: (key, whole) of each run of the batch."""
        counted = entries.groupBy("key", "whole").agg(F.count("*").alias("n"))
        path = self.scratch.write(counted, sort=["key", "whole"])
        seen = self._read(path).withColumn("new", F.lit(True))
        for _, level in self.levels:
            seen = seen.unionByName(self._read(level).withColumn("new", F.lit(False)))
        full = seen.groupBy("key", "whole").agg(F.sum("n").alias("n"), F.max("new").alias("new")).filter("n > 1 and new")
        self.full.append(self.scratch.write(full.select("key", "whole")))
        mixed = seen.groupBy("key").agg(F.min("whole").alias("a"), F.max("whole").alias("b"), F.max("new").alias("new"))
        self.mixed.append(self.scratch.write(mixed.filter("a < b and new").select("key")))
        self.levels.append((1, path))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, one), (_, two) = self.levels.pop(), self.levels.pop()
            both = self._read(one).unionByName(self._read(two)).groupBy("key", "whole").agg(F.sum("n").alias("n"))
            self.levels.append((2 * size, self.scratch.write(both, sort=["key", "whole"])))
            self.scratch.drop(one)
            self.scratch.drop(two)

    def drop(self) -> None:
        """Delete the levels' files, where the family is not kept for later batches."""
        for _, path in self.levels:
            self.scratch.drop(path)

    def matches(self) -> tuple[DataFrame, DataFrame]:
        """(key, whole) of runs that repeat whole; keys of suffixes that stand in different surroundings."""
        read = self.scratch.spark.read
        full = read.schema("key long, whole long").parquet(*self.full).distinct()
        mixed = read.schema("key long").parquet(*self.mixed).distinct()
        # Written, not joined as aggregates: Spark splits skewed partitions of a join only between plain exchanges.
        return self.scratch.table(full), self.scratch.table(mixed)


_BLOCKS = "doc long, rid long, key long, core long, start int, hashes array<long>"


def _window_blocks(width: int, most: int = 1 << 19):
    """The windows of open runs in blocks: block j of a run has those that begin j * BLOCK bytes before the anchor, or up
    to BLOCK - 1 more. All of them contain the same ``width - BLOCK + 1`` bytes, the core."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            docs, rids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "rid"))
            parts: list[tuple[np.ndarray, ...]] = []
            held = 0
            for row, runs in enumerate(batch.column("found").to_pylist()):
                text = data[offsets[row] : offsets[row + 1]]
                for x in runs:
                    lo, hi, at = x["lo"], x["hi"], x["at"]
                    prefix = _WHOLE.prefix(text[lo : hi + width])
                    hashes = mix(_WHOLE.windows(prefix, width)).view(np.int64)
                    j = np.arange((at - lo) // BLOCK, (at - hi) // BLOCK - 1, -1)
                    first = np.maximum(at - BLOCK * j - BLOCK + 1, lo)
                    core = at - BLOCK * j - lo
                    cores = mix(_WHOLE.ranges(prefix, core, core + width - BLOCK + 1) + j.astype(np.uint64)).view(np.int64)
                    n = len(j)
                    own = np.full(n, docs[row]), np.full(n, rids[row]), np.full(n, x["key"], np.int64)
                    parts.append((*own, cores, first.astype(np.int32), np.diff(first, append=hi + 1), hashes))
                    held += len(hashes)
                    if held >= most:
                        yield _blocks_batch(parts)
                        parts, held = [], 0
            if parts:
                yield _blocks_batch(parts)

    return run


def _blocks_batch(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    *columns, counts, hashes = (np.concatenate(c) for c in zip(*parts, strict=True))
    lists = long_list(hashes, np.concatenate([[0], np.cumsum(counts)]), pa.int64())
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), lists], names=["doc", "rid", "key", "core", "start", "hashes"])


_DIGEST = (
    "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_repeated long, spans array<struct<lo:int,end:int>>"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        found = batch.column("covers").fill_null([])
        covers, rows = found.flatten().to_numpy(), np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy())])
        marked = batch.column("marks").fill_null([])
        marks, mark_rows = marked.flatten().to_numpy(), np.concatenate([[0], np.cumsum(marked.value_lengths().to_numpy())])
        removed, counts, shas, los, ends, repeated = [], [], [], [], [], []
        for row in range(len(batch)):
            text = data[offsets[row] : offsets[row + 1]]
            own = covers[rows[row] : rows[row + 1]]
            lo, end = merge_covers(own)
            both = merge_covers(np.append(own, marks[mark_rows[row] : mark_rows[row + 1]]))
            repeated.append(int((both[1] - both[0]).sum()))
            sha, at = hashlib.sha256(), 0
            for x, y in zip(lo.tolist(), end.tolist(), strict=True):
                sha.update(text[at:x])
                at = y
            sha.update(text[at:])
            removed.append(int((end - lo).sum()))
            counts.append(len(lo))
            shas.append(sha.hexdigest())
            los.append(lo)
            ends.append(end)
        pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(x), pa.int32()) for x in (los, ends)], names=["lo", "end"])
        spans = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pairs)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(shas, pa.string()),
                pa.array(repeated, pa.int64()),
                spans,
            ],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated", "spans"],
        )


def merge_covers(covers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs covered by (start << 32 | end) pairs; touching pairs are one run."""
    if not len(covers):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    covers = np.sort(covers)
    lo, end = covers >> 32, np.maximum.accumulate(covers & 0xFFFFFFFF)
    new = np.concatenate([[True], lo[1:] > end[:-1]])
    return lo[new], end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])]


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = WIDTH, gram: int = GRAM, batches: int = BATCHES
) -> DataFrame:
    """Per row: id, text, covers array<long>: pairs (start << 32 | end) that cover together every byte inside a string of
    ``width`` bytes that also starts anywhere else (same text included, overlaps count); null where there is none.

    Ids may be null or repeated: equal rows are copies of each other and get the same pairs. Null and empty texts, and
    texts shorter than ``width``, have none. Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(*row_keys(id_col, text_col), F.col(text_col).alias("text"))
    covers = _covers(Scratch(docs.sparkSession, "suffix-dedup"), rows, width, gram, batches)
    return rows.join(covers, ["doc", "rid"], "left").select("id", "text", "covers")


def _cover(lo: str, end: str) -> Column:
    return (F.shiftleft(F.expr(lo).cast("long"), 32) + F.expr(end)).alias("cover")


def _covers(scratch: Scratch, rows: DataFrame, width: int, gram: int, batches: int) -> DataFrame:
    """A stored table (doc, rid, covers) of the rows with repeated strings of ``width`` bytes."""
    if not 1 <= gram <= width:
        raise ValueError("gram must lie between 1 and width")
    spark: SparkSession = scratch.spark
    with tidy_shuffles(spark):
        runs_at = scratch.write(rows.mapInArrow(_find_runs(width, gram), _RUNS).filter(F.size("keys") > 0))
        runs = spark.read.schema(_RUNS).parquet(runs_at)
        levels = SuffixLevels(scratch)
        for b in range(batches):
            part = runs.filter(F.pmod(F.xxhash64("rid"), F.lit(batches)) == b)
            levels.add(part.select(F.explode(F.arrays_zip("keys", "wholes")).alias("x")).select("x.keys", "x.wholes").toDF("key", "whole"))
        full, mixed = levels.matches()
        each = runs.select("doc", "rid", F.explode(F.arrays_zip("keys", "wholes", "los", "his", "ats")).alias("x"))
        each = each.select("doc", "rid", "x.*").toDF("doc", "rid", "key", "whole", "lo", "hi", "at")
        judged = scratch.table(
            each.join(full.withColumn("full", F.lit(True)), ["key", "whole"], "left")
            .join(mixed.withColumn("mixed", F.lit(True)), "key", "left")
            .filter("full or mixed")
        )
        levels.drop()
        scratch.drop(runs_at)
        one = F.min(F.struct("doc", "rid", "lo", "hi", "at")).alias("x")  # equal runs have equal windows: hash those of one
        open_runs = judged.filter("mixed").groupBy("key", "whole").agg(one).select("key", "x.*")
        per_row = scratch.table(open_runs.groupBy("doc", "rid").agg(F.collect_list(F.struct("key", "lo", "hi", "at")).alias("found")))
        found = rows.join(per_row, ["doc", "rid"]).select("doc", "rid", "text", "found")
        blocks = scratch.table(found.mapInArrow(_window_blocks(width), _BLOCKS))
        met = scratch.table(_in_two_places(blocks, "core"))
        each_window = F.posexplode("hashes").alias("i", "hash")
        windows = scratch.table(
            blocks.join(met, ["key", "core"])
            .select("doc", "rid", "key", "start", each_window)
            .select("doc", "rid", "key", "hash", (F.col("start") + F.col("i")).alias("start"))
        )
        twice = scratch.table(_in_two_places(windows, "hash"))
        whole_covers = judged.filter("full").select("doc", "rid", _cover("lo", f"hi + {width}"))
        window_covers = windows.join(twice, ["key", "hash"]).select("doc", "rid", _cover("start", f"start + {width}"))
        covers = whole_covers.unionByName(window_covers).groupBy("doc", "rid").agg(F.collect_set("cover").alias("covers"))
        return scratch.table(covers)


def _marks(scratch: Scratch, rows: DataFrame, width: int, gram: int) -> DataFrame:
    """A stored table (doc, rid, marks): the anchored strings of ``gram`` bytes that stand in two places at least."""
    with tidy_shuffles(scratch.spark):
        schema = "doc long, rid long, keys array<long>, ats array<int>"
        found_at = scratch.write(rows.mapInArrow(_find_places(width, gram), schema).filter(F.size("keys") > 0))
        found = scratch.spark.read.schema(schema).parquet(found_at)
        each = found.select("doc", "rid", F.explode(F.arrays_zip("keys", "ats")).alias("x")).select("doc", "rid", "x.*")
        each = each.toDF("doc", "rid", "key", "at")
        place = F.xxhash64("doc", "rid", "at")
        twice = each.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a < b").select("key")
        marked = each.join(scratch.table(twice), "key").groupBy("doc", "rid")
        marks = scratch.table(marked.agg(F.collect_set(_cover("at", f"at + {gram}")).alias("marks")))
        scratch.drop(found_at)
        return marks


def _in_two_places(found: DataFrame, hashed: str) -> DataFrame:
    """The (key, hash) pairs met at two places at least. Repeated rows give one place several times: places count, not rows."""
    place = F.xxhash64("doc", "rid", "start")
    both = found.groupBy("key", hashed).agg(F.min(place).alias("a"), F.max(place).alias("b"))
    return both.filter("a < b").select("key", hashed)


def dedup_digest(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    width: int = WIDTH,
    gram: int = GRAM,
    batches: int = BATCHES,
    passage: int = PASSAGE,
) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes, n_repeated, spans (the maximal removed runs).

    Rows as in ``repeated_spans``. ``n_repeated`` counts removed bytes and those of shorter repeated passages, which stay.
    """
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    rows = docs.select(*row_keys(id_col, text_col), F.col(text_col).alias("text"))
    covers, marks = _covers(scratch, rows, width, gram, batches), _marks(scratch, rows, passage, gram)
    both = covers.join(marks, ["doc", "rid"], "full")
    found = rows.join(both, ["doc", "rid"], "left").select("id", "text", "covers", "marks")
    return found.mapInArrow(_digest, _DIGEST).withColumnRenamed("id", id_col)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_digest(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated")
