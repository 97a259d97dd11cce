"""Operator 7: a quality classifier from overlapping heuristic labellers.

Each labeller votes good, bad or nothing on a text's statistics. Expectation-maximisation over the counts of all vote
patterns (at most 3^labellers rows, added up by Spark over all documents) estimates the share of good texts and how each
labeller votes on good and on bad ones; that gives each pattern a posterior. Posterior labels of a bounded sample train a
hashed linear scorer, which sees what the labellers do not: the frequencies of character-class trigrams. It scores all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import RangeHash, mix, set_aside, ship, text_buffer
from panelkit.llm.decontaminate import word_hashes

#: Texts at most on which the scorer is trained, drawn by a hash of their content.
SAMPLE_ROWS = 6_000
SLOTS = 1 << 12
THRESHOLD = 0.5

# Frequent words of four languages.
STOP_WORDS = (
    "the of and to in is that for it with as was on be by at or an are this from "
    "de la le les et des en un une du que qui dans est pour pas sur au "
    "der die und den von zu das mit sich nicht ein eine auf dem im ist es "
    "el los las y del se por con para una su al lo como"
).split()

GOOD, BAD, NOTHING = 1, 2, 0

# Character classes: lower, upper, digit, space, line break, full stop, comma, other signs by kind, beyond ASCII.
_CLASSES = 12
_CLASS = np.full(256, 8, np.int64)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[9, 32]] = 3
_CLASS[[10, 13]] = 4
_CLASS[ord(".")] = 5
_CLASS[ord(",")] = 6
_CLASS[[ord(c) for c in "!?"]] = 7
_CLASS[[ord(c) for c in "#$%&*+=<>@^~|\\/_{}[]"]] = 9
_CLASS[[ord(c) for c in "\"'()-:;"]] = 10
_CLASS[128:] = 11
_HASH = RangeHash(7)
_STOPS = np.sort(np.concatenate([word_hashes(np.frombuffer(w.encode(), np.uint8))[1] for w in STOP_WORDS]))

STATS = ("words", "top", "distinct", "stops", "upper", "symbols", "shouts", "digits", "marks", "length", "doubled", "lone", "echo")


def statistics(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Statistics (as ``STATS``) of one text's bytes, and its counts of character-class trigrams."""
    classes = _CLASS[data]
    counts = np.bincount(classes, minlength=_CLASSES)
    _, words = word_hashes(data)
    n, size = len(words), max(len(data), 1)
    letters = max(counts[0] + counts[1], 1)
    if n:
        _, each = np.unique(words, return_counts=True)
        at = np.searchsorted(_STOPS, words)
        stops = (_STOPS[np.minimum(at, len(_STOPS) - 1)] == words).mean()
        top, distinct, echo = each.max() / n, len(each) / n, (words[1:] == words[:-1]).sum() / n
    else:
        stops = top = distinct = echo = 0.0
    per_word = max(n, 1)
    signs = (classes == 7) | (classes == 9)
    doubled = (signs[1:] & (data[1:] == data[:-1])).sum()
    apart = classes == 3
    lone = (signs[1:-1] & apart[:-2] & apart[2:]).sum()
    stats = (
        n, top, distinct, stops, counts[1] / letters, counts[9] / per_word, counts[7] / per_word,
        counts[2] / size, (counts[5] + counts[6]) / per_word, (counts[0] + counts[1] + counts[11]) / per_word,
        doubled / per_word, lone / per_word, echo,
    )
    trigrams = classes[:-2] * _CLASSES**2 + classes[1:-1] * _CLASSES + classes[2:] if len(data) > 2 else np.zeros(0, np.int64)
    return np.array(stats, float), np.bincount(trigrams, minlength=_CLASSES**3)


def votes(s: np.ndarray) -> np.ndarray:
    """The labellers' votes on statistics (rows x ``STATS``)."""
    words, top, distinct, stops, upper, symbols, shouts, digits, marks, length, doubled, lone, echo = s.T
    few = words < 12

    def vote(good: np.ndarray, bad: np.ndarray, silent: np.ndarray) -> np.ndarray:
        return np.where(silent, NOTHING, np.where(bad, BAD, np.where(good, GOOD, NOTHING)))

    return np.stack(
        [
            vote(top < 0.15, top > 0.3, few),
            vote(distinct > 0.35, distinct < 0.15, few | (words > 1500)),
            vote(stops > 0.12, stops < 0.04, few),
            vote(upper < 0.15, upper > 0.5, words < 4),
            vote(symbols < 0.02, symbols > 0.1, words < 4),
            vote(shouts < 0.02, shouts > 0.2, words < 4),
            vote((marks > 0.04) & (marks < 0.5), (marks < 0.01) | (marks > 1), few),
            vote((length > 2.5) & (length < 9), (length < 1.5) | (length > 14), few),
            vote(digits < 0.03, digits > 0.25, few),
            vote(doubled < 0.02, doubled > 0.1, words < 4),
            vote(lone < 0.02, lone > 0.1, words < 4),
            vote(echo < 0.03, echo > 0.1, few),
        ],
        axis=1,
    )


LABELLERS = ("top word", "distinct words", "stop words", "upper case", "symbols", "shouts", "sentence marks", "word length", "digits", "doubled signs", "lone signs", "echoes")


@dataclass
class LabelModel:
    """Share of good texts, and each labeller's chance to vote bad, given that it votes, on bad and on good texts."""

    good: float
    bad_vote: np.ndarray  # labellers x class (bad, good)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The chance that a text with these votes is good; a missing vote says nothing. Without any it is the prior share."""
        gap = np.full(len(patterns), np.log(self.good) - np.log(1 - self.good))
        for k, (bad, good) in enumerate(self.bad_vote):
            gap += np.where(patterns[:, k] == BAD, np.log(good) - np.log(bad), 0)
            gap += np.where(patterns[:, k] == GOOD, np.log(1 - good) - np.log(1 - bad), 0)
        return 1 / (1 + np.exp(-np.clip(gap, -50, 50)))

    def accuracies(self) -> dict[str, float]:
        """The chance that a labeller's vote names the hidden class."""
        right = (1 - self.good) * self.bad_vote[:, 0] + self.good * (1 - self.bad_vote[:, 1])
        return dict(zip(LABELLERS, right.tolist(), strict=True))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Fit a ``LabelModel`` to vote patterns and how often each occurs.

    It begins with texts as bad that have a bad vote: kinds of bad texts differ, and few labellers see each. A prior count
    holds a labeller to be right more often than not and keeps every chance positive, so tables of any size, also empty
    ones, have a model.
    """
    m = patterns.shape[1] if patterns.size else len(LABELLERS)
    model = LabelModel(0.8, np.tile([0.6, 0.05], (m, 1)))
    if not len(counts):
        return model
    chance = np.where((patterns == BAD).any(axis=1), 0.02, 0.98)
    for _ in range(rounds):
        rates = []
        for weight, prior in (((1 - chance) * counts, 0.6), (chance * counts, 0.01)):
            bad, all_ = weight @ (patterns == BAD) + 5 * prior, weight @ (patterns != NOTHING) + 5
            rates.append(bad / all_)
        share = float((chance @ counts + 4) / (counts.sum() + 5))
        new = LabelModel(share, np.stack(rates, axis=1))
        done = np.abs(new.bad_vote - model.bad_vote).max() < 1e-7
        model, chance = new, new.posterior(patterns)
        if done:
            break
    return model


_EDGES = {
    "words": (4, 12, 30, 100, 300, 1000), "top": (0.05, 0.1, 0.15, 0.2, 0.3, 0.5), "distinct": (0.1, 0.2, 0.35, 0.5, 0.7),
    "stops": (0.02, 0.05, 0.1, 0.2, 0.3), "upper": (0.02, 0.05, 0.1, 0.3, 0.6), "symbols": (0.005, 0.02, 0.1, 0.3, 1),
    "shouts": (0.005, 0.02, 0.1, 0.3, 1), "digits": (0.005, 0.02, 0.1, 0.25), "marks": (0.01, 0.04, 0.1, 0.2, 0.5, 1),
    "length": (1.5, 2.5, 4, 6, 9, 14), "doubled": (0.005, 0.02, 0.1, 0.3, 1), "lone": (0.005, 0.02, 0.1, 0.3, 1),
    "echo": (0.01, 0.03, 0.1, 0.3),
}
_BINS = np.cumsum([0] + [len(e) + 1 for e in _EDGES.values()])


def _slots() -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of the trigrams and of the statistics' bins."""
    names = np.arange(_CLASSES**3 + _BINS[-1], dtype=np.uint64)
    slots = (mix(names + np.uint64(1)) % np.uint64(SLOTS)).astype(np.int64)
    return slots[: _CLASSES**3], slots[_CLASSES**3 :]


_TRIGRAM_SLOTS, _BIN_SLOTS = _slots()


_ORDER = np.argsort(_TRIGRAM_SLOTS, kind="stable")
_FIRST = np.flatnonzero(np.concatenate([[True], np.diff(_TRIGRAM_SLOTS[_ORDER]) > 0]))


def _features(stats: np.ndarray, trigrams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Root of each trigram's share, less for short texts, and the slots of the statistics' bins."""
    shares = np.sqrt(trigrams / (trigrams.sum(axis=1, keepdims=True) + 200.0)).astype(np.float32)
    bins = [_BIN_SLOTS[_BINS[k] + np.searchsorted(edges, stats[:, k])] for k, edges in enumerate(_EDGES.values())]
    return shares, np.stack(bins, axis=1)


_USED = np.unique(np.concatenate([_TRIGRAM_SLOTS, _BIN_SLOTS]))


def vectors(stats: np.ndarray, trigrams: np.ndarray) -> np.ndarray:
    """Hashed feature rows; the columns are the slots in use."""
    shares, bins = _features(stats, trigrams)
    out = np.zeros((len(stats), len(_USED)), np.float32)
    out[:, np.searchsorted(_USED, _TRIGRAM_SLOTS[_ORDER[_FIRST]])] = np.add.reduceat(shares[:, _ORDER], _FIRST, axis=1)
    rows = np.arange(len(stats))
    for column in np.searchsorted(_USED, bins).T:
        out[rows, column] += 0.5
    return out


def scores(stats: np.ndarray, trigrams: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The logistic score of each row: ``vectors`` times weights, without building the rows."""
    shares, bins = _features(stats, trigrams)
    gap = shares @ weights[_TRIGRAM_SLOTS] + 0.5 * weights[bins].sum(axis=1) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(gap, -30, 30)))


@dataclass
class SparseRows:
    """Feature rows without their zeros: ``slots`` and ``values`` of row k lie from ``starts[k]`` on; no row is empty."""

    starts: np.ndarray
    slots: np.ndarray
    values: np.ndarray

    @classmethod
    def unpack(cls, slots: list[bytes], values: list[bytes]) -> SparseRows:
        sizes = np.array([len(v) // 4 for v in values], np.int64)
        starts = np.cumsum(sizes) - sizes
        return cls(starts, np.frombuffer(b"".join(slots), np.uint16), np.frombuffer(b"".join(values), np.float32))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * w[self.slots], self.starts)

    def transposed_times(self, v: np.ndarray) -> np.ndarray:
        sizes = np.diff(np.append(self.starts, len(self.slots)))
        return np.bincount(self.slots, weights=self.values * np.repeat(v, sizes), minlength=len(_USED))


def sparse(x: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """The slots and the values of each row's non-zero features, packed."""
    slots = [np.flatnonzero(row).astype(np.uint16) for row in x]
    return [at.tobytes() for at in slots], [row[at].tobytes() for row, at in zip(x, slots, strict=True)]


def fit_scorer(x: SparseRows, target: np.ndarray, rounds: int = 150, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels by Adam steps over all rows; the last weight is the constant."""
    w, first, second = (np.zeros(len(_USED) + 1) for _ in range(3))
    for step in range(1, rounds + 1):
        gap = x.times(w[:-1].astype(np.float32)) + w[-1]
        wrong = 1 / (1 + np.exp(-np.clip(gap, -30, 30))) - target
        g = np.append(x.transposed_times(wrong.astype(np.float32)), wrong.sum()) / len(target) + decay * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    out = np.zeros(SLOTS + 1)
    out[_USED], out[-1] = w[:-1], w[-1]
    return out


def _describe(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_buffer(column)
    n = len(column)
    stats, trigrams = np.zeros((n, len(STATS))), np.zeros((n, _CLASSES**3), np.int32)
    for row in range(n):
        stats[row], trigrams[row] = statistics(data[offsets[row] : offsets[row + 1]])
    return stats, trigrams


_PARTS = 256


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), _PARTS):
            stats, _ = _describe(batch.column("text").slice(at, _PARTS))
            pattern = votes(stats) @ 3 ** np.arange(len(LABELLERS))
            yield pa.RecordBatch.from_arrays([pa.array(pattern.astype(np.int32))], names=["pattern"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), _PARTS):
            stats, trigrams = _describe(batch.column("text").slice(at, _PARTS))
            pattern = votes(stats) @ 3 ** np.arange(len(LABELLERS))
            columns = [pa.array(pattern.astype(np.int32)), *(pa.array(v, pa.binary()) for v in sparse(vectors(stats, trigrams)))]
            yield pa.RecordBatch.from_arrays([batch.column("h").slice(at, _PARTS), *columns], names=["h", "pattern", "slots", "values"])


def _unpack(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(score, votes) of each text."""
        stats, trigrams = _describe(column)
        return scores(stats, trigrams, self.weights), votes(stats)


def train(docs: DataFrame, text_col: str = "text", *, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Label model over all texts of ``docs``, scorer from at most ``sample_rows`` of them with their posterior labels."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"))
    counted = texts.mapInArrow(_patterns, "pattern int").groupBy("pattern").count().orderBy("pattern").collect()
    patterns = _unpack(np.array([r["pattern"] for r in counted], np.int64))
    counts = np.array([r["count"] for r in counted], float)
    labels = expectation_maximisation(patterns, counts)
    total = counts.sum()
    # Equal texts hash alike and are drawn once; a share above the bound leaves room for chance, the limit holds the bound.
    # The least hashes stay, in their order: the model of a table is the same in every run.
    share = min(1.0, 1.3 * sample_rows / total) if total else 1.0
    picked = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20))
    hashed = texts.filter(picked).dropDuplicates(["text"]).select("text", F.xxhash64("text").alias("h"))
    sample = hashed.mapInArrow(_sampled, "h long, pattern int, slots binary, values binary")
    rows = sample.orderBy("h").limit(sample_rows).toArrow() if total else None
    if rows is None or not rows.num_rows:
        return QualityModel(labels, np.append(np.zeros(SLOTS), np.log(labels.good / (1 - labels.good))))
    target = labels.posterior(_unpack(rows.column("pattern").to_numpy().astype(np.int64)))
    found = SparseRows.unpack(rows.column("slots").to_pylist(), rows.column("values").to_pylist())
    return QualityModel(labels, fit_scorer(found, target))


def _score(shared, text_col: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), _PARTS):
                part = batch.slice(at, _PARTS)
                score, cast = shared.value.score(part.column(text_col))
                score = np.round(score, 6)
                columns = [pa.array(score), pa.array((cast == GOOD).sum(axis=1), pa.int32()), pa.array((cast == BAD).sum(axis=1), pa.int32())]
                names = [*part.schema.names, *_JUDGED.names]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns, pa.array(score >= threshold)], names=names)

    return run


_JUDGED = T.StructType().add("score", "double").add("good_votes", "integer").add("bad_votes", "integer").add("keep", "boolean")


def judge(docs: DataFrame, text_col: str = "text", *, model: QualityModel | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (the chance to be good), good_votes, bad_votes and keep; columns so called are replaced.

    Without a ``model`` one is trained on ``docs``. Null and empty texts are scored by their empty statistics. Rows are
    judged one by one: repeated rows get equal scores. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    model = model or train(docs, text_col)
    own = docs.select(*[c for c in docs.columns if c.lower() not in _JUDGED.names])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return own.mapInArrow(_score(shared, text_col, threshold), T.StructType([*own.schema, *_JUDGED]))


def drop_bad(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows that ``judge`` keeps, with the columns of ``docs`` as they were, whatever their names."""
    packed, back = set_aside(docs, text_col)
    return back(judge(packed, text_col, **options).filter("keep"))


def op7_quality_em(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
