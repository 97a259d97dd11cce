"""Operator 11: which tokens of two tokenizers cover the same bytes, document by document and over the corpus.

Every text is cut whole by a byte-level BPE (A, behind one space) and by a piece BPE (B, which adds the space itself). No token of
either crosses a single space between other characters, so a worker remembers the ids of such stretches. Where an A token and
a B token end at the same byte and the next token of each begins with a space, the document is split: a window is the
ids between two such anchors. The texts of a language repeat few windows, so a task remembers each window's alignment by its
id tuples. Inside a window the shared ends cut groups; all A and B tokens of a group are linked.

How many documents hold a pair linked is counted over the corpus without moving the links: documents are written in blocks of
bounded size with a dictionary of the block's pairs, the dictionaries are added up, and each block gets its pairs' totals back.

A row without tokens (null or empty text, or one that a tokenizer does not give back byte by byte) has zeros and an empty
``groups``. Repeated rows count as documents of their own; of the caller's columns only the id is kept.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import Scratch, shards, ship, text_buffer, tidy_shuffles
from panelkit.llm.vocab import BYTE, FOLDER, MARK, NORMAL, PIECES, USER, read_pieces

BYTE_BPE = f"{FOLDER}/byte_bpe_50k.json"
#: Bytes of text whose pairs share a dictionary; a longer text makes a block of its own.
BLOCK_BYTES = 8 << 20
#: Groups of more links than this are counted by distinct ids before they are linked.
LARGE = 4096
#: New words that are cut as one text.
TOGETHER = 4096
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Words and windows, and letters of words, remembered by a worker before it starts afresh.
REMEMBERED, REMEMBERED_LETTERS = 300_000, 1 << 24

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_CODED = T.StructType([T.StructField("block", T.LongType()), T.StructField("id", T.LongType())])
for _name in _COUNTS:
    _CODED = _CODED.add(_name, "long")
_CODED = _CODED.add("groups", "string").add("links", "binary").add("times", "binary")
_CODED = _CODED.add("pairs", T.ArrayType(T.LongType())).add("n_docs", T.ArrayType(T.IntegerType()))


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_tokens(tokenizer_json: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE."""
    spec = json.loads(tokenizer_json)
    letters = byte_letters()
    entries = spec["model"]["vocab"] | {x["content"]: x["id"] for x in spec["added_tokens"]}
    out = [b""] * (max(entries.values()) + 1)
    for text, k in entries.items():
        out[k] = bytes(letters[c] for c in text) if all(c in letters for c in text) else text.encode()
    return out


def piece_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a piece model; control pieces have none."""
    plain = lambda p: p.text.replace(MARK, " ").encode()
    return [bytes([int(p.text[3:5], 16)]) if p.kind == BYTE else plain(p) if p.kind in (NORMAL, USER) else b"" for p in read_pieces(path)]


class _Ranges:
    """Growing rows of numbers, one row behind the other."""

    def __init__(self, kind: str, columns: int = 1) -> None:
        self.flat = [array(kind) for _ in range(columns)]
        self.ends = array("q", [0])

    def __len__(self) -> int:
        return len(self.ends) - 1

    def extend(self, lengths: np.ndarray, *values: np.ndarray) -> None:
        self.ends.frombytes((self.ends[-1] + np.cumsum(lengths)).astype(np.int64).tobytes())
        for own, new in zip(self.flat, values, strict=True):
            own.frombytes(new.astype(own.typecode).tobytes())

    def rows(self, numbers: np.ndarray) -> tuple[np.ndarray, ...]:
        """The lengths of some rows and their values."""
        ends = np.array(self.ends)
        lengths = ends[numbers + 1] - ends[numbers]
        places = _expand(ends[numbers], lengths)
        return lengths, *(np.array(own)[places] for own in self.flat)


def align(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token: groups end where both have a token's end. Sizes are by id."""
    a_end, b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    at = np.searchsorted(b_end, a_end)
    shared = b_end[at] == a_end
    b_shared = np.zeros(len(b), bool)
    b_shared[at[shared]] = True
    return np.cumsum(shared) - shared, np.cumsum(b_shared) - b_shared


def _links(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, wide: int) -> tuple[np.ndarray, ...]:
    """(group, pair, times) of all A-B pairs of each group. Large groups are counted by distinct ids first."""
    n = int(a_group[-1]) + 1
    n_a, n_b = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
    b_start = np.cumsum(n_b) - n_b
    large = n_a * n_b > LARGE
    own = np.flatnonzero(~large[a_group])
    reach = n_b[a_group[own]]
    pairs = np.repeat(a[own], reach) * wide + b[_expand(b_start[a_group[own]], reach)]
    groups, times = np.repeat(a_group[own], reach), np.ones(len(pairs), np.int64)
    for g in np.flatnonzero(large):
        x, m = np.unique(a[a_group == g], return_counts=True)
        y, k = np.unique(b[b_group == g], return_counts=True)
        pairs = np.append(pairs, np.add.outer(x * wide, y).ravel())
        times = np.append(times, np.outer(m, k).ravel())
        groups = np.append(groups, np.full(len(x) * len(y), g))
    return groups, pairs, times


class Aligner:
    """Both tokenizers, and the words and windows remembered by one Python worker."""

    def __init__(self, byte_json: str, piece_model: bytes, a_tokens: list[bytes], b_tokens: list[bytes]) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a_cut = Tokenizer.from_str(byte_json)
        self.a_cut.encode_special_tokens = True  # their strings are ordinary text
        self.b_cut = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.tokens = (a_tokens, b_tokens)
        self.size = tuple(np.array([len(t) for t in tokens], np.int64) for tokens in self.tokens)
        self.spaced = tuple(np.array([t[:1] == b" " for t in tokens]) for tokens in self.tokens)
        self.wide = len(b_tokens)
        # Without a piece that has a space behind another character, words can be cut one by one.
        self.by_word = not any(b" " in t.lstrip(b" ") for t in b_tokens)
        most = max(map(len, self.tokens))
        self.written = [f"{k}{mark}" for mark in (",", "|", ";", "") for k in range(most)]
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.letters = 0
        self.of_words = _Ranges("I")  # each word's windows
        self.tokens_of = (array("q"), array("q"))  # each word's A and B tokens; -1 if its bytes are not given back
        self.windows: dict[tuple[bytes, bytes], int] = {}
        self.texts: list[str] = []
        self.counts = _Ranges("q", 2)  # groups and links of each window
        self.pairs = _Ranges("q", 2)  # its pairs and how often each is linked

    def full(self) -> bool:
        return len(self.texts) > REMEMBERED or len(self.words) > REMEMBERED or self.letters > REMEMBERED_LETTERS

    def _cut_each(self, words: list[str]) -> tuple[list[list[np.ndarray]], np.ndarray]:
        """Both sides' ids of each word, and whether both give its bytes back."""
        a_ids = [e.ids for e in self.a_cut.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
        b_ids = self.b_cut.encode(words, num_threads=1)
        given = lambda k, ids, w: b"".join(map(self.tokens[k].__getitem__, ids)) == b" " + w.encode()
        good = [given(0, a, w) and given(1, b, w) for a, b, w in zip(a_ids, b_ids, words, strict=True)]
        return [[np.array(x, np.int64) for x in ids] for ids in (a_ids, b_ids)], np.array(good)

    def _cut(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Both sides' ids of words without outer white space: flat, their numbers by word, and whether they give the bytes back.

        The words are cut as one text. Should its bytes not come back, or a word's end not be a token's end, each is cut alone.
        """
        text = " ".join(words)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        sides = (self.a_cut.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b_cut.encode(text))
        flat, numbers = [np.array(x, np.int64) for x in sides], []
        for ids, tokens, size in zip(flat, self.tokens, self.size, strict=True):
            stops = np.cumsum(size[ids])
            at = np.searchsorted(stops, ends)
            if b"".join(map(tokens.__getitem__, ids.tolist())) != b" " + text.encode() or (stops[at] != ends).any():
                each, good = self._cut_each(words)
                return [np.concatenate(x) for x in each], [np.array([len(y) for y in x]) for x in each], good
            numbers.append(np.diff(at + 1, prepend=0))
        return flat, numbers, np.ones(len(words), bool)

    def _learn_words(self, words: list[str]) -> None:
        """Cut new stretches by both tokenizers and align their windows."""
        plain = [w for w in words if w and not (w[0].isspace() or w[-1].isspace())] if self.by_word else []
        odd = list(set(words).difference(plain))
        words, found = plain + odd, []
        for i in range(0, len(plain), TOGETHER):
            found.append(self._cut(plain[i : i + TOGETHER]))
        if odd:
            each, good = self._cut_each(odd)
            found.append(([np.concatenate(x) for x in each], [np.array([len(y) for y in x]) for x in each], good))
        flat, size = ([np.concatenate([f[part][k] for f in found]) for k in (0, 1)] for part in (0, 1))
        good = np.concatenate([f[2] for f in found])
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words)), strict=True))
        self.letters += sum(map(len, words))
        for own, n in zip(self.tokens_of, size, strict=True):
            own.frombytes(np.where(good, n, -1).tobytes())
        a, b = (x[np.repeat(good, n)].astype(np.uint32) for x, n in zip(flat, size, strict=True))
        n_windows = np.zeros(len(words), np.int64)
        if not len(a):
            return self.of_words.extend(n_windows, np.zeros(0, np.int64))
        # The good stretches stand in one row: both sides have the same bytes, and every stretch's end is a shared end.
        last = np.cumsum(size[0][good]) - 1
        a_end, b_end = np.cumsum(self.size[0][a]), np.cumsum(self.size[1][b])
        at = np.searchsorted(b_end, a_end)
        anchor = b_end[at] == a_end
        anchor[:-1] &= self.spaced[0][a[1:]] & self.spaced[1][b[np.minimum(at[:-1] + 1, len(b) - 1)]]
        anchor[last] = True
        cuts = np.flatnonzero(anchor)
        sides = []
        for ids, ends in ((a, cuts + 1), (b, at[cuts] + 1)):
            data, ends = ids.tobytes(), (4 * ends).tolist()
            sides.append([data[i:j] for i, j in zip([0, *ends], ends, strict=False)])
        keys = list(zip(*sides, strict=True))
        if new := list(set(keys).difference(self.windows)):
            self._learn_windows(new)
        n_windows[good] = np.diff(np.searchsorted(cuts, last, side="right"), prepend=0)
        self.of_words.extend(n_windows, np.fromiter(map(self.windows.__getitem__, keys), np.int64, len(keys)))

    def _learn_windows(self, keys: list[tuple[bytes, bytes]]) -> None:
        """Align new windows, all in one row."""
        a, b = (np.frombuffer(b"".join([k[side] for k in keys]), np.uint32).astype(np.int64) for side in (0, 1))
        n_a, n_b = (np.array([len(k[side]) >> 2 for k in keys]) for side in (0, 1))
        a_group, b_group = align(a, b, *self.size)
        window = np.zeros(int(a_group[-1]) + 1, np.int64)  # of each group
        window[a_group] = np.repeat(np.arange(len(keys)), n_a)
        groups, pairs, times = _links(a, b, a_group, b_group, self.wide)
        links = np.bincount(window[groups], times, len(keys))
        distinct, place = np.unique(pairs, return_inverse=True)
        joint, first = _sorted_sums(window[groups] << 32 | place, times)
        self.pairs.extend(np.bincount(joint >> 32, minlength=len(keys)), distinct[joint & 0xFFFFFFFF], first)
        counts = np.stack([np.bincount(window, minlength=len(keys)), links.astype(np.int64)])
        self.counts.extend(np.ones(len(keys), np.int64), *counts)
        # Texts: the tokens by group, A before B, each with the mark that follows it.
        of_a, of_b = np.bincount(a_group), np.bincount(b_group)
        order = np.zeros(len(a) + len(b), np.int64)
        a_mark = np.where(np.append(a_group[1:] != a_group[:-1], True), self.most, 0)
        last = np.append(b_group[1:] != b_group[:-1], True)
        end = np.append(window[b_group[1:]] != window[b_group[:-1]], True)
        order[np.arange(len(a)) + (np.cumsum(of_b) - of_b)[a_group]] = a + a_mark
        order[np.arange(len(b)) + np.cumsum(of_a)[b_group]] = b + np.where(end, 3 * self.most, np.where(last, 2 * self.most, 0))
        flat = list(map(self.written.__getitem__, order.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        self.windows.update(zip(keys, range(len(self.texts), len(self.texts) + len(keys)), strict=True))
        self.texts += ["".join(flat[i:j]) for i, j in zip([0, *ends], ends, strict=False)]

    def documents(self, texts: list[str]) -> list[tuple[int, int, np.ndarray]]:
        """(A tokens, B tokens, window numbers) of each text."""
        parts = [_SINGLE_SPACE.split(t) if self.by_word else [t] for t in texts]
        flat = list(chain.from_iterable(parts))
        if new := list(set(flat).difference(self.words)):
            self._learn_words(new)
        numbers = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        starts = np.cumsum([0, *map(len, parts)])[:-1]
        n_a, n_b = (np.array(own)[numbers] for own in self.tokens_of)
        good = (np.minimum.reduceat(n_a, starts) >= 0) & [bool(t) for t in texts]
        totals = [np.where(good, np.add.reduceat(n, starts), 0).tolist() for n in (n_a, n_b)]
        n_windows, windows = self.of_words.rows(numbers)
        own = np.split(windows, np.cumsum(np.add.reduceat(n_windows, starts))[:-1])
        return [(x, y, w if g else w[:0]) for x, y, w, g in zip(*totals, own, good.tolist(), strict=True)]


def _sorted_sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def _expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of ranges, one behind the other."""
    total = int(counts.sum())
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(total)


class _Block:
    """Documents of up to ``BLOCK_BYTES`` of text on their way to the coded table."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.docs: list[tuple[int, int, np.ndarray]] = []
        self.bytes = 0

    def rows(self, block: int, aligner: Aligner, digest: bool) -> pa.RecordBatch:
        """One row per document, then one row with the dictionary of the block's pairs."""
        n = len(self.docs)
        windows = np.concatenate([w for _, _, w in self.docs])
        of = np.repeat(np.arange(n), [len(w) for _, _, w in self.docs])
        _, *both = aligner.counts.rows(windows)
        n_groups, n_links = (np.bincount(of, c, n).astype(np.int64) for c in both)
        # The block's windows once each give the dictionary of its pairs; then each document's windows and their pairs.
        distinct, windows = np.unique(windows, return_inverse=True)
        sizes, flat, times = aligner.pairs.rows(distinct)
        pairs, place = np.unique(flat, return_inverse=True)
        own, seen = np.unique(of << 32 | windows, return_counts=True)
        of, windows = own >> 32, own & 0xFFFFFFFF
        n_pairs = sizes[windows]
        at = _expand((np.cumsum(sizes) - sizes)[windows], n_pairs)
        keys, weights = _sorted_sums(np.repeat(of, n_pairs) << 32 | place[at], times[at] * np.repeat(seen, n_pairs))
        local = (keys & 0xFFFFFFFF).astype(np.uint32)
        n_docs = np.bincount(local, minlength=len(pairs))
        parts = np.searchsorted(keys, np.arange(n + 1) << 32)
        links = [local[s:e].tobytes() for s, e in zip(parts[:-1], parts[1:], strict=True)]
        weights = weights.astype(np.uint64 if len(weights) and weights.max() >> 32 else np.uint32)
        times_ = [weights[s:e].tobytes() for s, e in zip(parts[:-1], parts[1:], strict=True)]
        groups = [";".join(map(aligner.texts.__getitem__, w.tolist())) for _, _, w in self.docs]
        if digest:
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        lists = [None] * n
        columns = [
            [block] * (n + 1),
            [*self.ids, None],
            [*(d[0] for d in self.docs), None],
            [*(d[1] for d in self.docs), None],
            [*n_groups.tolist(), None],
            [*n_links.tolist(), None],
            [*groups, None],
            [*links, None],
            [*times_, None],
            [*lists, pairs],
            [*lists, n_docs.astype(np.int32)],
        ]
        kinds = [*[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_CODED.names)


_ALIGNERS: dict[int, Aligner] = {}


def _code(byte_json: str, piece_model: bytes, a_tokens: list[bytes], b_tokens: list[bytes], block_bytes: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash((byte_json, piece_model))
        if key not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[key] = Aligner(byte_json, piece_model, a_tokens, b_tokens)
        aligner = _ALIGNERS[key]
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        block = _Block()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            _, offsets = text_buffer(texts)
            for i, j in shards(offsets):
                own = [t or "" for t in texts.slice(i, j - i).to_pylist()]
                block.docs += aligner.documents(own)
                block.ids += ids[i:j]
                block.bytes += int(offsets[j] - offsets[i])
                if block.bytes >= block_bytes or aligner.full():
                    yield block.rows(number, aligner, digest)
                    number, block = number + 1, _Block()
                    if aligner.full():
                        aligner.forget()
        if block.docs:
            yield block.rows(number, aligner, digest)

    return run


def _score(docs: pa.Table, totals: pa.Table) -> pa.Table:
    """Totals of a block's pairs summed over its documents' links."""
    total, best = (np.zeros(len(totals), np.int64) for _ in range(2))
    place = totals.column("place").to_numpy()
    total[place] = totals.column("total").to_numpy()
    best[place] = totals.column("best").to_numpy()
    links, times = docs.column("links").to_pylist(), docs.column("times").to_pylist()
    sums = np.zeros((2, len(links)), np.int64)
    for row, (x, y) in enumerate(zip(links, times, strict=True)):
        at = np.frombuffer(x, np.uint32)
        n = np.frombuffer(y, np.uint32 if len(y) == len(x) else np.uint64).astype(np.int64)
        sums[:, row] = n @ best[at], n @ total[at]
    kept = docs.select(["id", *_COUNTS, "groups"])
    return kept.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))


@dataclass
class Alignment:
    """``documents``: a row for each input row; ``pairs``: (a, b, n_docs, best) of every pair linked anywhere."""

    documents: DataFrame
    pairs: DataFrame


def align_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    byte_bpe: str = BYTE_BPE,
    pieces: str = PIECES,
    digest: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> Alignment:
    """Align both tokenizers' tokens on every text.

    ``documents`` has the id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair is held by as many documents as any
    pair of their A token), count_sum (those numbers over all links) and groups: ``a1,a2|b1;a3|b2``, or its SHA-256 with
    ``digest``. The tokenizer files are read on the driver and sent to the tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(byte_bpe, encoding="utf-8") as f:
        byte_json = f.read()
    with open(pieces, "rb") as f:
        piece_model = f.read()
    a_tokens, b_tokens = byte_tokens(byte_json), piece_tokens(pieces)
    wide = len(b_tokens)
    scratch = Scratch(spark, "token-alignment")
    with tidy_shuffles(spark):
        own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        coded = scratch.table(own.mapInArrow(_code(byte_json, piece_model, a_tokens, b_tokens, block_bytes, digest), _CODED))
        held = coded.filter("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("place", "x"))
        held = held.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.n_docs").alias("n"))
        totals = scratch.table(held.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("a", F.expr(f"pair div {wide}")))
    most = totals.groupBy("a").agg(F.max("total").alias("most"))
    totals = totals.join(most, "a").withColumn("best", (F.col("total") == F.col("most")).cast("int"))
    of_blocks = held.join(totals.select("pair", "total", "best"), "pair").select(F.col("block").alias("of"), "place", "total", "best")
    fields = [T.StructField(c, T.LongType()) for c in ("id", *_COUNTS)]
    result = T.StructType([*fields, T.StructField("groups", T.StringType())]).add("n_best", "long").add("count_sum", "long")
    rows = coded.filter("links is not null").select("block", "id", *_COUNTS, "groups", "links", "times")
    scored = rows.groupBy("block").cogroup(of_blocks.groupBy("of")).applyInArrow(_score, result)
    pairs = totals.select(F.col("a").alias("a_id"), (F.col("pair") % wide).alias("b_id"), F.col("total").alias("n_docs"), F.col("best").cast("boolean").alias("best"))
    return Alignment(scored.withColumnRenamed("id", id_col), pairs)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = align_tokens(docs, digest=True).documents
    return found.select("doc_id", *_COUNTS, "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
