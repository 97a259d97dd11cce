"""Operator 6: verbatim benchmark passages in training texts, by suffix arrays of the training shards.

Each task cuts its texts into shards and builds a suffix array of words per shard: positions ordered by the codes of the
next four words. Every suffix of every benchmark item is looked up by binary search; each position in the interval
found is extended word by word (a vectorised search for the longest equal range, by 64-bit range hashes) to its longest
match. A match as long as the item's window (13 words, or the whole item if it has fewer) marks its words as hit.

The benchmark goes to all tasks in blocks of bounded size; a text passes the blocks one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from panelkit.llm.common import RangeHash, Scratch, mix, set_aside, shards, ship, text_buffer

WINDOW = 13
#: Bytes of benchmark text sent to the tasks at once.
BLOCK_BYTES = 16 << 20
#: Pairs of a training position and a test suffix extended at once.
PAIRS = 1 << 20

_SHARD = 1 << 19
_PIECE = 1 << 18
_DEPTH = 4
_BYTES, _WORDS = RangeHash(61), RangeHash(62)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word of UTF-8 bytes; a word is a run of 0-9, a-z (A-Z lower-cased) and non-ASCII."""
    starts, hashes = [], []
    at = 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        if end < len(data):  # cut where no word is
            while end < len(data) and _IN_WORD[_LOWER[data[end]]]:
                end += 1
        low = _LOWER[data[at:end]]
        inside = np.concatenate([[False], _IN_WORD[low], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        s, e = edge[::2], edge[1::2]
        hashes.append(mix(_BYTES.ranges(_BYTES.prefix(low), s, e) + (e - s).astype(np.uint64)))
        starts.append(s + at)
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def _codes(words: np.ndarray) -> np.ndarray:
    return words >> np.uint64(48) | np.uint64(1)


def _prefix_codes(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The codes of the next four words in one number; 0 stands past a text's end (``left``: words up to it)."""
    codes = _codes(words)
    out = np.zeros(len(words), np.uint64)
    for k in range(_DEPTH):
        part = np.zeros(len(words), np.uint64)
        if k < len(words):
            part[: len(words) - k] = codes[k:]
        part[left <= k] = 0
        out |= part << np.uint64(16 * (_DEPTH - 1 - k))
    return out


@dataclass
class Suffixes:
    """All suffixes of a block of benchmark items."""

    ids: list[int | None]  # of the items
    item: np.ndarray  # of each suffix, an index into ids
    left: np.ndarray  # words to the item's end
    need: np.ndarray  # window length of the item
    low: np.ndarray  # least and greatest packed codes with the suffix's prefix
    high: np.ndarray
    prefix: np.ndarray  # range-hash prefix over all words

    @classmethod
    def build(cls, ids: list[int | None], texts: list[str | None], window: int) -> Suffixes:
        words = [word_hashes(np.frombuffer((t or "").encode(), np.uint8))[1] for t in texts]
        counts = np.array([len(w) for w in words], np.int64)
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(ids)), counts)
        left = np.repeat(np.cumsum(counts), counts) - np.arange(len(flat))
        need = np.repeat(np.minimum(counts, window), counts)
        low = _prefix_codes(flat, left)
        free = np.uint64(16) * np.maximum(_DEPTH - left, 0).astype(np.uint64)
        high = low | (np.uint64(1) << free) - np.uint64(1)
        return cls(ids, item, left, need, low, high, _WORDS.prefix(flat))


def find_matches(words: np.ndarray, left: np.ndarray, tests: Suffixes, most: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(training position, test suffix, longest common length in words) of every pair that shares the looked-up prefix.

    The pairs come in parts of at most ``most``: a prefix that is frequent on both sides costs time, not memory.
    """
    packed = _prefix_codes(words, left)
    array = np.argsort(packed)
    ordered = packed[array]
    lo = np.searchsorted(ordered, tests.low)
    counts = np.searchsorted(ordered, tests.high, side="right") - lo
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    prefix = _WORDS.prefix(words)
    for at in range(0, total, most):
        pair = np.arange(at, min(at + most, total))
        test = np.searchsorted(ends, pair, side="right")
        place = array[lo[test] + pair - (ends[test] - counts[test])]
        good = np.zeros(len(test), np.int64)
        bad = np.minimum(left[place], tests.left[test]) + 1
        while (bad - good > 1).any():
            mid = (good + bad) // 2
            same = _WORDS.ranges(prefix, place, place + mid) == _WORDS.ranges(tests.prefix, test, test + mid)
            good, bad = np.where(same, mid, good), np.where(same, bad, mid)
        yield place, test, good


_SPAN = T.StructType().add("lo", "integer").add("end", "integer")
_FOUND = (
    T.StructType()
    .add("n_words", "long")
    .add("hits", T.ArrayType(_SPAN))
    .add("items", T.ArrayType(T.LongType()))
    .add("longest", "integer")
    .add("longest_item", "long")
    .add("longest_at", "integer")
)


def _scan(tests: Suffixes, text_col: str, first: bool):
    """Add the block's findings to those of the blocks before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(text_col))
            rows: list[dict] = []
            for i, j in shards(offsets, _SHARD):
                rows += _scan_shard(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tests)
            if not first:
                for row, old in zip(rows, batch.column("__found").to_pylist(), strict=True):
                    row["hits"] = _union([(x["lo"], x["end"]) for x in old["hits"]] + [(x["lo"], x["end"]) for x in row["hits"]])
                    row["items"] = sorted({*old["items"], *row["items"]})
                    if old["longest"] >= row["longest"]:
                        row |= {k: old[k] for k in ("longest", "longest_item", "longest_at")}
            kept = [c for c in batch.schema.names if c != "__found"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(rows, to_arrow_type(_FOUND))], names=[*kept, "__found"])

    return run


def _union(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for lo, end in sorted(spans):
        if out and lo <= out[-1]["end"]:
            out[-1]["end"] = max(end, out[-1]["end"])
        else:
            out.append({"lo": lo, "end": end})
    return out


def _scan_shard(data: np.ndarray, offsets: np.ndarray, tests: Suffixes) -> list[dict]:
    starts, words = word_hashes_of_texts(data, offsets)
    rows = np.searchsorted(starts, offsets)
    left = np.repeat(rows[1:], np.diff(rows)) - np.arange(len(words))
    out = [
        {"n_words": int(n), "hits": [], "items": [], "longest": 0, "longest_item": None, "longest_at": None} for n in np.diff(rows)
    ]
    # Kept between parts: distinct (place, length) of hits, distinct (text, item), and the longest match of each text.
    step, many = int(tests.need.max(initial=0)) + 1, max(len(tests.ids), 1)
    spans, named = np.zeros(0, np.int64), np.zeros(0, np.int64)
    longest: dict[int, tuple[int, int, int]] = {}
    for place, test, length in find_matches(words, left, tests):
        text = np.searchsorted(rows, place, side="right") - 1
        hit = length >= tests.need[test]
        spans = np.union1d(spans, place[hit] * step + tests.need[test[hit]])
        named = np.union1d(named, text[hit] * many + tests.item[test[hit]])
        # Ties go to the earlier place, then to the earlier suffix.
        some = np.flatnonzero(length > 0)
        best = some[np.lexsort((test[some], place[some], -length[some], text[some]))]
        head = np.concatenate([[True], text[best][1:] != text[best][:-1]]) if len(best) else np.zeros(0, bool)
        for k in best[head]:
            own = -int(length[k]), int(place[k]), int(test[k])
            longest[int(text[k])] = min(longest.get(int(text[k]), own), own)
    at = spans // step
    cuts = np.searchsorted(at, rows)
    for r in np.flatnonzero(np.diff(cuts)):
        own = slice(cuts[r], cuts[r + 1])
        lo = at[own] - rows[r]
        out[r]["hits"] = _union(list(zip(lo.tolist(), (lo + spans[own] % step).tolist(), strict=True)))
    for r, item in zip((named // many).tolist(), (named % many).tolist(), strict=True):
        if tests.ids[item] is not None:
            out[r]["items"].append(tests.ids[item])
    for row in out:
        row["items"] = sorted(set(row["items"]))
    for r, (size, place, test) in longest.items():
        out[r] |= {"longest": -size, "longest_item": tests.ids[tests.item[test]], "longest_at": place - int(rows[r])}
    return out


def word_hashes_of_texts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of concatenated texts; no word crosses a text's end."""
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    touching = inner[_IN_WORD[_LOWER[data[inner - 1]]] & _IN_WORD[_LOWER[data[inner]]]] if len(inner) else inner
    if not len(touching):
        return word_hashes(data)
    parts = [word_hashes(data[a:b]) for a, b in zip([0, *touching], [*touching, len(data)], strict=True)]
    return np.concatenate([s + a for (s, _), a in zip(parts, [0, *touching], strict=True)]), np.concatenate([h for _, h in parts])


def benchmark_blocks(items: DataFrame, id_col: str, text_col: str, window: int, limit: int) -> Iterator[Suffixes]:
    """The benchmark's suffixes in blocks of about ``limit`` bytes of text, each fetched only when its turn comes."""
    items = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // limit) or 1
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        rows = sorted(((r.id, r.text or "") for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        yield Suffixes.build([r[0] for r in rows], [r[1] for r in rows], window)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    *,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with n_words, hits (runs of hit words, as word positions), items (ids with occurring windows), the longest
    verbatim match (longest words, longest_item, longest_at), n_hit and contaminated (20 * n_hit >= n_words, n_hit > 0).

    Columns of ``docs`` with these names are replaced. Null and empty texts have no words and no hits; items without
    words match nothing, those without an id hit words and are not named; repeated items count once. Any number of rows may share an id.
    """
    ship(docs.sparkSession)
    taken = {*_FOUND.names, "n_hit", "contaminated", "__found"}
    own = [c for c in docs.columns if c.lower() not in taken]
    if text_col not in own:
        raise ValueError(f"the text column may not be called {text_col}")
    out = docs.select(*own)
    schema = T.StructType([*out.schema, T.StructField("__found", _FOUND)])
    scratch, before = Scratch(docs.sparkSession, "decontamination"), None
    for k, tests in enumerate(benchmark_blocks(items, item_id_col, item_text_col, window, block_bytes)):
        if k:
            # The plan keeps a block's arrays on the driver until it has run, so the blocks before are written first.
            path = scratch.write(out)
            out = docs.sparkSession.read.schema(schema).parquet(path)
            if before:
                scratch.drop(before)
            before = path
        out = out.mapInArrow(_scan(tests, text_col, k == 0), schema)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["lo"]).cast("long"))
    out = out.select(*own, "__found.*").withColumn("n_hit", n_hit)
    return out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs`` as they were, whatever their names."""
    packed, back = set_aside(docs, text_col)
    return back(find_contamination(packed, items, text_col, **options).filter("not contaminated"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP6_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
