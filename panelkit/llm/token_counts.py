"""Operator 10: greedy longest-match piece counts in one pass over the characters.

Words are the texts' runs without white space. A word with its start marked is cut greedily: the longest piece of the
vocabulary, then the longest piece of the rest, and so on; a word that cannot be cut counts as one unknown token.
Instead of retrying, an automaton walks the trie of pieces. Where no edge leads on, a node's failure link goes to the node
of what remains after the pieces certain by then are popped, and the node holds how many those are. Lengths add up
without any piece being built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import ship
from panelkit.llm.vocab import MARK, NORMAL, PIECES, read_pieces

#: Counts of so many words are remembered by a task; then it starts afresh.
REMEMBERED = 300_000
_UNKNOWN = 1 << 32


class Automaton:
    """Trie with failure links; node 0 is the root."""

    def __init__(self, pieces: list[str]) -> None:
        self.goto: list[dict[str, int]] = [{}]
        depth_order: list[tuple[int, str, int]] = []  # parent, character, node
        ends = {0}
        for piece in sorted(set(pieces) - {""}, key=lambda p: (len(p), p)):
            at = 0
            for c in piece:
                to = self.goto[at].get(c)
                if to is None:
                    to = len(self.goto)
                    self.goto[at][c] = to
                    self.goto.append({})
                at = to
            ends.add(at)
        level = [0]
        while level:
            level = [depth_order.append((v, c, to)) or to for v in level for c, to in self.goto[v].items()]
        self.fail = [-1] * len(self.goto)
        self.popped = [0] * len(self.goto)
        for parent, c, v in depth_order:
            if v in ends:
                self.fail[v], self.popped[v] = 0, 1
                continue
            z, n = self.fail[parent], self.popped[parent]
            while z >= 0 and c not in self.goto[z]:
                n += self.popped[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.popped[v] = self.goto[z][c], n

    def count(self, word: str) -> int:
        """The number of pieces of a marked word, or -1 if it cannot be cut."""
        goto, fail, popped = self.goto, self.fail, self.popped
        v = n = 0
        for c in word:
            to = goto[v].get(c)
            while to is None:
                n += popped[v]
                v = fail[v]
                if v < 0:
                    return -1
                to = goto[v].get(c)
                if to is None and v == 0:
                    return -1
            v = to
        while v > 0:
            n += popped[v]
            v = fail[v]
        return n if v == 0 else -1


class _Memo(dict):
    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(MARK + word)
        n = 1 + _UNKNOWN if n < 0 else n
        if len(word) <= 64:
            self[word] = n
        return n


_MEMOS: dict[int, _Memo] = {}


def _memo(pieces: list[str]) -> _Memo:
    key = hash(tuple(pieces))
    if key not in _MEMOS:
        _MEMOS.clear()
        _MEMOS[key] = _Memo(Automaton(pieces))
    return _MEMOS[key]


_COUNTS = T.StructType().add("n_words", "long").add("n_tokens", "long").add("n_unknown", "long")


def _count(pieces: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(pieces)
        for batch in batches:
            texts = batch.column(text_col)
            out = np.zeros((3, len(texts)), np.int64)
            for row in range(len(texts)):
                words = (texts[row].as_py() or "").split()
                total = sum(map(memo.__getitem__, words))
                out[:, row] = len(words), total % _UNKNOWN, total // _UNKNOWN
                if len(memo) > REMEMBERED:
                    memo.clear()
            kept = [c for c in batch.schema.names if c not in _COUNTS.names]
            columns = [*(batch.column(c) for c in kept), *map(pa.array, out)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *_COUNTS.names])

    return run


def token_counts(docs: DataFrame, text_col: str = "text", *, pieces: list[str] | None = None, vocabulary: str = PIECES) -> DataFrame:
    """``docs`` with n_words, n_tokens and n_unknown; columns of these names are replaced.

    Null, empty and blank texts have no words. All rows are counted, repeated ones too. ``pieces`` are given as texts
    with ``▁`` at a word's start, or read from the file ``vocabulary`` on the driver.
    """
    ship(docs.sparkSession)
    if pieces is None:
        pieces = [p.text for p in read_pieces(vocabulary) if p.kind == NORMAL]
    own = docs.select(*[c for c in docs.columns if c.lower() not in _COUNTS.names])
    return own.mapInArrow(_count(pieces, text_col), T.StructType([*own.schema, *_COUNTS]))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text"))
    return token_counts(docs).drop("text")
