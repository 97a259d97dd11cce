"""Operator 3: unigram segmentation into pieces with log scores, and back.

Encoding puts one space before the text, as a mark of the first word; a piece's ``▁`` stands for a space. A Viterbi search
walks a double-array trie of the pieces' UTF-8 bytes and keeps the best score at each byte. A character without a piece of
its own may be taken by an unknown edge (the least score minus 10) and comes out as its bytes' pieces. If no piece has a
space after another character (checked), no piece crosses the start of a run of spaces, so texts are cut there and the
paths of frequent stretches are remembered.

Decoding joins the pieces' bytes, takes the first space off, and reads UTF-8. ``decode(encode(text)) == text`` for every
text: a literal ``▁`` goes through its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import shards, ship, text_buffer
from panelkit.llm.vocab import BYTE, MARK, NORMAL, PIECES, USER, log_scores, read_pieces

#: Stretches remembered by a task, none longer than so many bytes; then it starts afresh.
REMEMBERED, REMEMBERED_BYTES = 100_000, 64
#: Bytes of text whose stretches are looked up at once, and stretches searched in step.
_AT_ONCE, _TOGETHER = 1 << 21, 8192
_STRETCH = re.compile(rb" +[^ ]*")
_UNKNOWN_PENALTY = 10.0
_CHAR_SIZE = np.repeat(np.array([1, 2, 3, 4]), [0xC0, 0x20, 0x10, 0x10])


class DoubleArray:
    """A byte trie in two arrays: the child of node v by byte c is ``base[v] + c`` if ``check`` there is v."""

    def __init__(self, keys: dict[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        ids = [-1]
        for key, value in keys.items():
            at = 0
            for c in key:
                to = children[at].get(c)
                if to is None:
                    to = len(children)
                    children[at][c] = to
                    children.append({})
                    ids.append(-1)
                at = to
            ids[at] = value
        # Bases first, those of many children in front: a base needs no more than free slots. Then every node's place.
        taken = bytearray(2 * len(children) + 1024)
        taken[0] = 1
        bases = [0] * len(children)
        seek: dict[int, int] = {}  # by number of children: where the last search ended
        for v in sorted(range(len(children)), key=lambda v: -len(children[v])):
            own = sorted(children[v])
            if not own:
                break
            slot = seek.get(len(own), 256)
            while True:
                slot = taken.find(0, slot)
                if slot < 0 or slot + 512 > len(taken):
                    slot = len(taken) - 512 if slot < 0 else slot
                    taken.extend(bytes(len(taken)))
                at = slot - own[0]
                if not any(taken[at + c] for c in own):
                    break
                slot += 1
            seek[len(own)] = slot
            bases[v] = at
            for c in own:
                taken[at + c] = 1
        place = [0] * len(children)
        base, check, value = [0] * len(taken), [-1] * len(taken), [-1] * len(taken)
        for v, own in enumerate(children):  # a parent comes before its children
            base[place[v]] = bases[v]
            for c, to in own.items():
                place[to] = bases[v] + c
                check[place[to]] = place[v]
                value[place[to]] = ids[to]
        self.base, self.check, self.value = base, check, value

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, np.int32) for x in (self.base, self.check, self.value))


class Segmenter:
    """Viterbi over the arrays of a ``DoubleArray``; ``bytes_`` are the ids of the 256 byte pieces.

    ``path`` searches one text; ``paths`` searches many short ones in step, with the same choices.
    """

    def __init__(self, arrays: tuple[np.ndarray, ...], scores: np.ndarray, bytes_: np.ndarray, least: float) -> None:
        self.arrays = tuple(np.append(a, np.full(256, -1, np.int32)) for a in arrays)  # a child may lie past the end
        self.score_of = scores
        self.base, self.check, self.value = (a.tolist() for a in arrays)
        self.scores = scores.tolist()
        self.bytes = bytes_.tolist()
        self.unknown = least - _UNKNOWN_PENALTY
        self.memo: dict[bytes, bytes] = {}

    def path(self, text: bytes) -> list[int]:
        base, check, value, scores = self.base, self.check, self.value, self.scores
        n, limit = len(text), len(check)
        none = float("-inf")
        best = [none] * (n + 1)
        best[0] = 0.0
        start = [0] * (n + 1)
        piece = [-1] * (n + 1)
        for i in range(n):
            here = best[i]
            if here == none:
                continue
            lead = text[i]
            size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            single = False
            v = 0
            for j in range(i, n):
                to = base[v] + text[j]
                if to >= limit or check[to] != v or to == 0:
                    break
                v = to
                p = value[v]
                if p >= 0:
                    s = here + scores[p]
                    if s > best[j + 1]:
                        best[j + 1], start[j + 1], piece[j + 1] = s, i, p
                    single = single or j + 1 - i == size
            if not single:
                s, j = here + self.unknown, min(i + size, n)
                if s > best[j]:
                    best[j], start[j], piece[j] = s, i, -1
        out: list[int] = []
        at = n
        while at:
            i = start[at]
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out += [self.bytes[b] for b in reversed(text[i:at])]
            at = i
        return out[::-1]

    def paths(self, texts: list[bytes]) -> list[bytes]:
        """``path`` of each text, as 32-bit numbers, for texts of like length."""
        base, check, value = self.arrays
        n = len(texts)
        length = np.array([len(t) for t in texts])
        most = int(length.max())
        data = np.frombuffer(b"".join(t.ljust(most, b"\0") for t in texts), np.uint8).reshape(n, most)
        size = _CHAR_SIZE[data]
        best = np.full((n, most + 1), -np.inf)
        best[:, 0] = 0
        start, piece = np.zeros((n, most + 1), np.int32), np.full((n, most + 1), -1, np.int32)
        byte_ids = np.array(self.bytes, np.int32)

        def offer(rows: np.ndarray, i: int, j: np.ndarray | int, scores: np.ndarray, pieces: np.ndarray) -> None:
            better = scores > best[rows, j]
            rows = rows[better]
            j = j if isinstance(j, int) else j[better]
            best[rows, j], start[rows, j] = scores[better], i
            piece[rows, j] = pieces[better]

        for i in range(most):
            live = np.flatnonzero((length > i) & (best[:, i] > -np.inf))
            single = np.zeros(n, bool)
            rows, v = live, np.zeros(len(live), np.int32)
            for j in range(i, most):
                to = base[v] + data[rows, j]
                on = (check[to] == v) & (to != 0) & (length[rows] > j)
                rows, v = rows[on], to[on]
                if not len(rows):
                    break
                p = value[v]
                ends = p >= 0
                own = rows[ends]
                offer(own, i, j + 1, best[own, i] + self.score_of[p[ends]], p[ends])
                single[own[size[own, i] == j + 1 - i]] = True
            rows = live[~single[live]]
            if len(rows):
                ends = np.minimum(i + size[rows, i], length[rows])
                # An unknown single byte is its byte's piece at once.
                offer(rows, i, ends, best[rows, i] + self.unknown, np.where(size[rows, i] == 1, byte_ids[data[rows, i]], -1))
        out = np.zeros((n, most), np.int32)
        at, count, plain = length.copy(), np.zeros(n, np.int64), np.ones(n, bool)
        rows = np.flatnonzero(at > 0)
        while len(rows):
            p = piece[rows, at[rows]]
            plain[rows[p < 0]] = False
            count[rows] += 1
            out[rows, most - count[rows]] = p
            at[rows] = start[rows, at[rows]]
            rows = rows[at[rows] > 0]
        raw = out.tobytes()
        ends = np.arange(1, n + 1) * (4 * most)
        return [
            raw[e - 4 * c : e] if ok else np.array(self.path(t), np.int32).tobytes()
            for t, c, e, ok in zip(texts, count.tolist(), ends.tolist(), plain.tolist(), strict=True)
        ]

    def learn(self, stretches: set[bytes]) -> None:
        """Remember the paths of stretches not seen before."""
        new = sorted((s for s in stretches - self.memo.keys() if len(s) <= REMEMBERED_BYTES), key=len)
        if len(self.memo) + len(new) > REMEMBERED:
            self.memo.clear()
            new = sorted((s for s in stretches if len(s) <= REMEMBERED_BYTES), key=len)
        for at in range(0, len(new), _TOGETHER):
            some = new[at : at + _TOGETHER]
            self.memo.update(zip(some, self.paths(some), strict=True))

    def encode(self, texts: list[bytes], whole: bool) -> list[bytes]:
        """The ids of each text as 32-bit numbers; ``whole``: pieces may cross spaces."""
        if whole:
            return [np.array(self.path(b" " + t) if t else [], np.int32).tobytes() for t in texts]
        found = [_STRETCH.findall(b" " + t) if t else [] for t in texts]
        self.learn(set().union(*found))
        return [b"".join(map(self._ids, stretches)) for stretches in found]

    def _ids(self, stretch: bytes) -> bytes:
        ids = self.memo.get(stretch)
        return np.array(self.path(stretch), np.int32).tobytes() if ids is None else ids


class PieceModel:
    """What the tasks need of a vocabulary: the trie's arrays, log scores, byte pieces and the bytes of each piece."""

    def __init__(self, path: str = PIECES) -> None:
        pieces = read_pieces(path)
        keys = {p.text.replace(MARK, " ").encode(): k for k, p in enumerate(pieces) if p.kind in (NORMAL, USER) and p.text}
        self.arrays = DoubleArray(keys).arrays()
        self.scores = np.array(log_scores(path))
        self.least = float(min(self.scores[list(keys.values())]))
        byte_ids = {int(p.text[3:5], 16): k for k, p in enumerate(pieces) if p.kind == BYTE}
        if len(byte_ids) != 256:
            raise ValueError("the vocabulary must have a piece for every byte")
        self.bytes = np.array([byte_ids[b] for b in range(256)], np.int32)
        self.texts = [b""] * len(pieces)
        for text, k in keys.items():
            self.texts[k] = text
        for b, k in byte_ids.items():
            self.texts[k] = bytes([b])
        self.whole = any(b" " in text.lstrip(b" ") for text in keys)

    def segmenter(self) -> Segmenter:
        return Segmenter(self.arrays, self.scores, self.bytes, self.least)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes of each row of ids; ``ends`` are the rows' offsets."""
        if not hasattr(self, "flat"):
            sizes = np.array([*map(len, self.texts), 0])  # the last one stands for ids of no piece
            self.flat, self.sizes, self.begin = np.frombuffer(b"".join(self.texts), np.uint8), sizes, np.cumsum(sizes) - sizes
        ids = np.where((ids >= 0) & (ids < len(self.texts)), ids, len(self.texts))
        sizes = self.sizes[ids]
        after = np.concatenate([[0], np.cumsum(sizes)])
        joined = self.flat[np.repeat(self.begin[ids] - after[:-1], sizes) + np.arange(after[-1])].tobytes()
        cuts = after[ends].tolist()
        return [joined[a + (joined[a : a + 1] == b" ") : b] if a < b else b"" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_MODELS: dict[str, PieceModel] = {}
_SEGMENTERS: dict[int, Segmenter] = {}


def _model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _encode(shared, text_col: str, ids_col: str, decoded_col: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: PieceModel = shared.value
        key = hash((model.arrays[0].tobytes(), model.scores.tobytes()))
        if key not in _SEGMENTERS:
            _SEGMENTERS.clear()
            _SEGMENTERS[key] = model.segmenter()
        segmenter = _SEGMENTERS[key]
        for batch in batches:
            texts = batch.column(text_col).cast(pa.large_binary())
            _, offsets = text_buffer(texts)
            rows = []
            for i, j in shards(offsets, _AT_ONCE):
                rows += segmenter.encode([t or b"" for t in texts[i:j].to_pylist()], model.whole)
            ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(rows), np.int32))
            missing = texts.is_null()
            ids = pa.ListArray.from_arrays(pa.array(ends), values, mask=missing)
            columns = [*(batch.column(c) for c in batch.schema.names), ids]
            names = [*batch.schema.names, ids_col]
            if decoded_col is not None:
                columns, names = [*columns, _decoded(model, ids)], [*names, decoded_col]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(
    docs: DataFrame, text_col: str = "text", ids_col: str = "piece_ids", *, decoded_col: str | None = None, vocabulary: str = PIECES
) -> DataFrame:
    """``docs`` with the ids of each text's pieces; a column called ``ids_col`` is replaced.

    A null text has null ids, an empty one none. The vocabulary's arrays (a few MB, by the file's size) are broadcast.
    ``decoded_col`` adds what ``decode`` makes of the ids, in the same pass: one worker per task holds the model, not two.
    """
    ship(docs.sparkSession)
    added = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if decoded_col is not None:
        added.append(T.StructField(decoded_col, T.StringType()))
    taken = {f.name.lower() for f in added}
    own = docs.select(*[c for c in docs.columns if c.lower() not in taken])
    shared = docs.sparkSession.sparkContext.broadcast(_model(vocabulary))
    return own.mapInArrow(_encode(shared, text_col, ids_col, decoded_col), T.StructType([*own.schema, *added]))


def _decoded(model: PieceModel, ids: pa.Array) -> pa.Array:
    """The texts of a column of ids."""
    texts: list[str | None] = []
    for at in range(0, len(ids), 512):
        rows = ids.slice(at, 512)
        filled = rows.fill_null([])
        ends = np.concatenate([[0], np.cumsum(filled.value_lengths().to_numpy())])
        found = model.decode(filled.flatten().fill_null(-1).to_numpy(), ends)
        texts += [t.decode("utf-8", "replace") if ok else None for t, ok in zip(found, rows.is_valid().to_pylist(), strict=True)]
    return pa.array(texts, pa.string())


def _decode(shared, ids_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: PieceModel = shared.value
        for batch in batches:
            columns = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, _decoded(model, batch.column(ids_col))], names=[*batch.schema.names, text_col])

    return run


def decode(encoded: DataFrame, ids_col: str = "piece_ids", text_col: str = "decoded", *, vocabulary: str = PIECES) -> DataFrame:
    """``encoded`` with the text of each row's ids; a column called ``text_col`` is replaced.

    Null ids give a null text. Ids outside the vocabulary, null ids in a list and control pieces stand for nothing; bytes
    that are no UTF-8 become U+FFFD.
    """
    ship(encoded.sparkSession)
    own = encoded.select(*[c for c in encoded.columns if c.lower() != text_col.lower()])
    shared = encoded.sparkSession.sparkContext.broadcast(_model(vocabulary))
    schema = T.StructType([*own.schema, T.StructField(text_col, T.StringType())])
    return own.mapInArrow(_decode(shared, ids_col, text_col), schema)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, their number, how many are byte pieces, and whether decoding gives the text back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bytes_ = _model(PIECES).bytes
    low, high = int(bytes_.min()), int(bytes_.max())
    return encode(docs, decoded_col="decoded").select(
        "doc_id",
        F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.expr(f"cast(coalesce(size(filter(piece_ids, x -> x between {low} and {high})), 0) as long)").alias("n_bytes"),
        F.expr("decoded <=> text").alias("same"),
        "piece_ids",
    )
