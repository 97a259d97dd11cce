"""Operator 5: near duplicates by improved consistent weighted sampling.

A text is the weighted set of its five-word shingles, weight = count * idf. Texts with equal words are one *node* from the
start. Each node gets ``SAMPLES`` samples by Ioffe's scheme: two nodes agree on a sample with a chance equal to their
weighted Jaccard similarity. Samples are banded; nodes of one band bucket are candidates, and a candidate pair counts as
a link only after the weighted Jaccard similarity of both whole sets is computed and is at least 0.8. Classes are the
connected components of links.

Document frequencies are counted over all documents. Only shingles in at least ``COMMON`` of the documents have a lower
idf than the rest, at most (shingles per document / COMMON) of them however large the table: they are found by counting
hash buckets first and then the shingles of heavy buckets alone. Weights fall by a quarter at most, so that a large group
of copies, whose shared shingles are common for that very reason, stays similar.

First every member of a bucket is paired with its hub, the node with the most bucket neighbours overall. Buckets whose
members are then still in different classes go on until every pair across classes is judged: small ones pair by pair,
large ones block against block, where one task computes the similarities of two blocks of whole sets at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import RangeHash, Scratch, long_list, mix, row_keys, text_buffer, tidy_shuffles
from panelkit.llm.decontaminate import word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
SAMPLES = BANDS * ROWS
#: Shingles in at least this share of the documents are common.
COMMON = 0.005
#: The most that a shingle's weight can fall.
DAMPING = 0.25
#: Buckets up to this size have all pairs across classes compared.
SMALL_BUCKET = 32
#: Larger buckets are dealt to blocks of about so many nodes and shingles; every two blocks meet in one task.
BLOCK_NODES, BLOCK_SHINGLES = 256, 1 << 19
#: Samples that must agree before a pair is verified: half; at a similarity of 0.8 fewer than 1 pair in 100,000 has less.
AGREE = SAMPLES // 2

_SKETCH_BITS = 18
_WORDS = RangeHash(51)
_LEVELS = 1 << 16
_SALTS = (np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]


def _gamma_quantiles() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of ``_LEVELS`` equal parts."""
    x = np.concatenate([np.linspace(0, 1, 20_000), np.linspace(1, 40, 200_000)[1:]])
    return np.interp((np.arange(_LEVELS) + 0.5) / _LEVELS, 1 - (1 + x) * np.exp(-x), x)


_GAMMA = _gamma_quantiles().astype(np.float32)
_LOG_GAMMA = np.log(_GAMMA)
_UNIFORM = ((np.arange(_LEVELS) + 0.5) / _LEVELS).astype(np.float32)


@dataclass
class Weights:
    """idf of common shingles (sorted); all others weigh 1."""

    shingles: np.ndarray
    idf: np.ndarray

    def of(self, shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = counts.astype(float)
        if len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
            weights *= np.where(self.shingles[at] == shingles, self.idf[at], 1.0)
        return weights


def shingle_counts(text: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Distinct shingle hashes of a text's bytes (sorted), their counts, and a digest of its words (empty without words).

    A text of fewer words than ``size`` is one shingle.
    """
    _, words = word_hashes(text)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), b""
    hashes = mix(_WORDS.windows(_WORDS.prefix(words), min(size, len(words))))
    digest = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
    return *np.unique(hashes, return_counts=True), digest


def weighted_samples(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The consistent weighted samples (hash of element and level) of one weighted set."""
    best = np.full(SAMPLES, np.inf, np.float32)
    out = np.zeros(SAMPLES, np.uint64)
    columns = np.arange(SAMPLES)
    log_w = np.log(weights).astype(np.float32)
    for at in range(0, len(shingles), 1024):
        own = shingles[at : at + 1024, None]
        draws = mix(own ^ _SALTS)
        r_at = (draws & np.uint64(0xFFFF)).astype(np.int32)
        c_at = (draws >> np.uint64(16) & np.uint64(0xFFFF)).astype(np.int32)
        b_at = (draws >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.int32)
        r, beta = _GAMMA[r_at], _UNIFORM[b_at]
        level = np.floor(log_w[at : at + 1024, None] / r + beta)
        log_a = _LOG_GAMMA[c_at] - r * (level - beta + 1)
        least = log_a.argmin(axis=0)
        value = log_a[least, columns]
        better = value < best
        chosen = mix(own[least, 0] + level[least, columns].astype(np.int64).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        out = np.where(better, chosen, out)
        best = np.where(better, value, best)
    return out


def weighted_jaccard(a: np.ndarray, a_weights: np.ndarray, b: np.ndarray, b_weights: np.ndarray) -> float:
    """Sum of lesser weights over sum of greater ones; elements are sorted and distinct."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = np.minimum(a_weights[i], b_weights[j]).sum()
    return float(both / (a_weights.sum() + b_weights.sum() - both)) if len(a) or len(b) else 1.0


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = text_buffer(batch.column("text"))
    for row in range(len(batch)):
        yield row, data[offsets[row] : offsets[row + 1]]


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents with a shingle in each hash bucket; the documents themselves in bucket -1."""
    counts, n = np.zeros(1 << _SKETCH_BITS, np.int64), 0
    for batch in batches:
        n += len(batch)
        for _, text in _texts(batch):
            buckets = (shingle_counts(text)[0] >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)
            np.add.at(counts, np.unique(buckets), 1)
    used = np.flatnonzero(counts)
    columns = [pa.array(np.append(used, -1)), pa.array(np.append(counts[used], n))]
    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n"])


def _heavy_shingles(heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(heavy).astype(bool)
        for batch in batches:
            found = []
            for _, text in _texts(batch):
                own = shingle_counts(text)[0]
                found.append(own[marked[(own >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)]])
            shingles, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shingles.view(np.int64)), pa.array(counts)], names=["shingle", "n"])

    return run


def learn_weights(texts: DataFrame, scratch: Scratch) -> Weights:
    """Common shingles and their idf from all rows of ``texts`` (column text)."""
    # A hash table of fixed size, kept as a table of its own: it is read twice.
    buckets = scratch.table(texts.mapInArrow(_bucket_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")))
    total = buckets.filter("bucket < 0").agg(F.sum("n")).first()[0] or 0
    least = max(2, int(np.ceil(COMMON * total)))
    heavy = np.zeros(1 << _SKETCH_BITS, bool)
    heavy[[r["bucket"] for r in buckets.filter((F.col("bucket") >= 0) & (F.col("n") >= least)).collect()]] = True
    if not heavy.any() or total < 1 / COMMON:
        return Weights(np.zeros(0, np.uint64), np.zeros(0))
    counted = texts.mapInArrow(_heavy_shingles(np.packbits(heavy)), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    common = counted.filter(F.col("n") >= least).toArrow()
    shingles = common.column("shingle").to_numpy().view(np.uint64)
    share = common.column("n").to_numpy() / total
    idf = np.log(1 / np.minimum(share, 1)) / np.log(1 / COMMON)
    order = np.argsort(shingles)
    return Weights(shingles[order], (1 - DAMPING * (1 - np.clip(idf, 0, 1)))[order])


_SIGNED = "doc long, rid long, node binary, bands array<long>, samples array<short>"


def _sign(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: Weights = shared.value
        step = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            docs, rids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "rid"))
            nodes, bands, samples = [], [], []
            known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
            for row, text in _texts(batch):
                shingles, counts, node = shingle_counts(text)
                if not node:  # without words: alone
                    node = hashlib.blake2b(np.array([docs[row], rids[row]]).tobytes(), digest_size=16, person=b"no words").digest()
                    own = np.zeros(0, np.int64), np.zeros(0, np.int16)
                elif (own := known.get(node)) is None:
                    drawn = weighted_samples(shingles, weights.of(shingles, counts))
                    parts = drawn.reshape(BANDS, ROWS)
                    keys = mix(mix(mix(parts[:, 0] + step) + parts[:, 1]) + parts[:, 2])
                    own = known[node] = keys.view(np.int64), (drawn & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
                nodes.append(node)
                bands.append(own[0])
                samples.append(own[1])
            ends = [np.concatenate([[0], np.cumsum([len(x) for x in c])]) for c in (bands, samples)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("rid"),
                    pa.array(nodes, pa.binary()),
                    long_list(np.concatenate(bands), ends[0], pa.int64()),
                    long_list(np.concatenate(samples), ends[1], pa.int16()),
                ],
                names=["doc", "rid", "node", "bands", "samples"],
            )

    return run


def _vectors(shared):
    """node, its shingles (32 bits of each hash) and weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                keys, values = [], []
                for _, text in _texts(part):
                    shingles, counts, _ = shingle_counts(text)
                    keys.append((shingles >> np.uint64(32)).astype(np.uint32).view(np.int32))
                    values.append(shared.value.of(shingles, counts).astype(np.float32))
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                lists = long_list(np.concatenate(keys), ends, pa.int32()), long_list(np.concatenate(values), ends, pa.float32())
                yield pa.RecordBatch.from_arrays([part.column("node"), *lists], names=["node", "shingles", "weights"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = []
        for name in ("sa", "wa", "sb", "wb"):
            column = batch.column(name)
            values = column.flatten().to_numpy()
            lists.append((values, np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])))
        similarity = np.zeros(len(batch))
        for row in range(len(batch)):
            sa, wa, sb, wb = (v[e[row] : e[row + 1]] for v, e in lists)
            similarity[row] = weighted_jaccard(*_merged(sa, wa), *_merged(sb, wb))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similarity)], names=["a", "b", "similarity"])


def _merged(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys; weights of keys that met in 32 bits are added."""
    own, place = np.unique(keys, return_inverse=True)
    return own, np.bincount(place, weights=weights, minlength=len(own))


def block_similarity(shingles: list[np.ndarray], weights: list[np.ndarray], left: np.ndarray, right: np.ndarray, wide: int = 2048) -> np.ndarray:
    """Weighted Jaccard similarities (in 32 bits) of the sets ``left`` with the sets ``right``.

    The lesser of two weights is a sum of steps that both reach, so the common weight is a matrix product over the steps.
    """
    own = np.repeat(np.arange(len(shingles)), [len(s) for s in shingles])
    token, weight = np.concatenate(shingles), np.concatenate(weights)
    total = np.bincount(own, weights=weight, minlength=len(shingles))
    order = np.lexsort((weight, token))
    own, token, weight = own[order], token[order], weight[order]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    start = np.flatnonzero(new)
    held = np.diff(np.append(start, len(token)))
    several = np.repeat(held > 1, held)
    own, token, weight, new = own[several], token[several], weight[several], new[several]
    common = np.zeros((len(left), len(right)), np.float32)
    if len(own):
        step = new.copy()
        step[1:] |= weight[1:] != weight[:-1]
        level = np.cumsum(step) - 1
        lowest = level[np.flatnonzero(new)][np.cumsum(new) - 1]
        height = weight[step].astype(np.float32)
        above = np.flatnonzero(~new[step])
        height[above] -= weight[step][above - 1].astype(np.float32)
        for at in range(0, len(height), wide):
            # Entries whose levels lowest..level meet this stretch of columns.
            here = np.flatnonzero((lowest < at + wide) & (level >= at))
            a, b = np.maximum(lowest[here], at) - at, np.minimum(level[here], at + wide - 1) - at
            n = b - a + 1
            column = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            dense = np.zeros((len(shingles), min(wide, len(height) - at)), np.float32)
            dense[np.repeat(own[here], n), column] = 1
            common += (dense[left] * height[at : at + wide]) @ dense[right].T
    return common / (total[left][:, None] + total[right] - common)


def _block_links(group: pa.Table) -> pa.Table:
    """Links between classes of two blocks (or of one): enough of them to join all classes that any pair joins."""
    group = group.sort_by("node").combine_chunks()
    nodes, block = group.column("node").to_pylist(), group.column("block").to_numpy()
    lists = []
    for name in ("shingles", "weights"):
        column = group.column(name).combine_chunks()
        lists.append((column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])))
    sets = [_merged(*(v[e[k] : e[k + 1]] for v, e in lists)) for k in range(len(nodes))]
    _, label = np.unique(np.array(group.column("label").to_pylist(), object), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    one = block[0] == block
    left, right = (np.flatnonzero(one), np.flatnonzero(~one)) if not one.all() else (np.arange(len(nodes)),) * 2
    similar = block_similarity([k for k, _ in sets], [w for _, w in sets], left, right)
    # A little below the limit, as these are sums in 32 bits; what is taken is computed anew.
    x, y = np.nonzero(similar >= SIMILARITY - 1e-3)
    order = np.argsort(-similar[x, y], kind="stable")
    x, y = left[x[order]], right[y[order]]
    apart = (label[x] != label[y]) & ((x < y) | (not one.all()))
    found = []
    for i, j in zip(x[apart].tolist(), y[apart].tolist(), strict=True):
        a, b = root(label[i]), root(label[j])
        if a != b and (exact := weighted_jaccard(*sets[i], *sets[j])) >= SIMILARITY:
            parent[a] = b
            found.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j]), exact))
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    kinds = (pa.binary(), pa.binary(), pa.float64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "similarity"])


def _large_links(members: DataFrame, vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """Links across classes in buckets of any size. ``members``: (key, node, label).

    The largest class of a bucket does not meet itself, so at most one and a half times the pairs across classes are compared.
    """
    sized = scratch.table(members.join(vectors.select("node", F.size("shingles").alias("m")), "node"))
    classes = sized.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("m").alias("m"))
    buckets = classes.groupBy("key").agg(F.max(F.struct("n", "label", "m")).alias("top"), F.sum("n").alias("n"), F.sum("m").alias("m"))
    blocks = lambda n, m: F.expr(f"greatest(ceil(({n}) / {BLOCK_NODES}), ceil(({m}) / {BLOCK_SHINGLES}))")
    buckets = scratch.table(
        buckets.select("key", F.col("top.label").alias("most"), blocks("top.n", "top.m").alias("inner"), blocks("n - top.n", "m - top.m").alias("outer"))
    )
    dealt = sized.join(buckets, "key").withColumn("h", F.xxhash64("node", "key"))
    dealt = dealt.withColumn("block", F.expr("if(label = most, outer + pmod(h, inner), pmod(h, outer))"))
    met = F.explode(F.expr("sequence(0L, if(label = most, outer, outer + inner) - 1)")).alias("other")
    dealt = dealt.select("key", "node", "label", "block", met).select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    whole = dealt.drop("other").join(vectors.hint("merge"), "node")
    return whole.groupBy("key", "i", "j").applyInArrow(_block_links, "a binary, b binary, similarity double")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the least node of each connected component, for all nodes of the links (a, b).

    Each round takes the least label of the neighbours and then the label's own label; rounds grow with the logarithm of the
    longest path in practice. Every round is a written table.
    """
    both = scratch.table(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct())
    labels = scratch.table(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("seen")), "other")
        near = near.groupBy("node").agg(F.min("seen").alias("seen"))
        moved = labels.join(near, "node").select("node", "label", F.least("label", "seen").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved = scratch.table(moved.join(jump, "next").select("node", "label", F.least("next", "further").alias("next")))
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.filter("label <> next").isEmpty():
            return labels


def _hub_pairs(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): every bucket member with the bucket's best connected one. ``members``: (key, node, size)."""
    degree = scratch.table(members.groupBy("node").agg(F.sum("size").alias("degree")))
    ranked = members.join(degree, "node")
    hubs = scratch.table(ranked.groupBy("key").agg(F.max(F.struct("degree", "node")).alias("x")).select("key", F.col("x.node").alias("hub")))
    return _ordered(members.join(hubs, "key").select(F.col("hub").alias("a"), F.col("node").alias("b")))


def _ordered(pairs: DataFrame) -> DataFrame:
    pairs = pairs.filter("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _small_pairs(members: DataFrame) -> DataFrame:
    """All pairs across classes in buckets of at most ``SMALL_BUCKET`` nodes. ``members``: (key, node, label, size)."""
    rows = members.filter(F.col("size") <= SMALL_BUCKET).groupBy("key").agg(F.collect_set(F.struct("label", "node")).alias("own"))
    first = rows.select("own", F.explode("own").alias("x"))
    pair = first.select(F.col("x").alias("x"), F.explode("own").alias("y")).filter("x.label < y.label")
    return _ordered(pair.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def _sized(members: DataFrame, scratch: Scratch, *, mixed: bool) -> DataFrame:
    """Members of buckets with two nodes at least (``mixed``: of two classes at least), with the bucket's size."""
    counts = [F.count("*").alias("size")] + ([F.min("label").alias("l0"), F.max("label").alias("l1")] if mixed else [])
    sizes = members.groupBy("key").agg(*counts).filter("size > 1" + (" and l0 < l1" if mixed else "")).select("key", "size")
    return scratch.table(members.join(scratch.table(sizes), "key"))


class _Verifier:
    """Links among candidate pairs, by samples first and then by whole sets."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, shared, scratch: Scratch) -> None:
        self.texts, self.nodes, self.shared, self.scratch = texts, nodes, shared, scratch

    def __call__(self, pairs: DataFrame) -> DataFrame:
        samples = self.nodes.select("node", "samples")
        joined = pairs.join(samples.toDF("a", "x"), "a").join(samples.toDF("b", "y"), "b")
        agree = F.aggregate(F.zip_with("x", "y", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, z: n + z)
        pairs = self.scratch.table(joined.filter(agree >= AGREE).select("a", "b"))
        vectors = self.vectors(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        both = pairs.join(vectors.toDF("a", "sa", "wa"), "a").join(vectors.toDF("b", "sb", "wb"), "b")
        judged = both.select("a", "b", "sa", "wa", "sb", "wb").mapInArrow(_verify, "a binary, b binary, similarity double")
        return self.scratch.table(judged.filter(F.col("similarity") >= SIMILARITY))

    def vectors(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles, weights) of the nodes ``wanted``."""
        holders = self.scratch.table(self.nodes.join(wanted, "node").select("node", "doc", "rid"))
        # By sorting at any size: a plan that changes with the number of candidates would hide what the step costs.
        texts = self.texts.join(holders.hint("merge"), ["doc", "rid"]).dropDuplicates(["doc", "rid"]).select("node", "text")
        return self.scratch.table(texts.mapInArrow(_vectors(self.shared), "node binary, shingles array<int>, weights array<float>"))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, doc, rid, class_id (least id in the class), class_size (rows), n_links (verified links of its text),
    stays (the row of the class with the least (id, content hash); all rows equal to it in id and text).

    Texts without words (null and empty ones too) are classes of their own, one per (id, text). Null ids count as 0 in the
    order, and class_id is null if no row of the class has an id. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    rows = docs.select(*row_keys(id_col, text_col), F.col(text_col).alias("text"))
    with tidy_shuffles(spark):
        shared = spark.sparkContext.broadcast(learn_weights(rows.select("text"), scratch))
        signed = scratch.table(rows.select("doc", "rid", "text").mapInArrow(_sign(shared), _SIGNED))
        holder = F.min(F.struct("doc", "rid", "bands", "samples")).alias("x")
        nodes = scratch.table(signed.groupBy("node").agg(holder).select("node", "x.*"))
        verify = _Verifier(rows, nodes, shared, scratch)
        buckets = _sized(nodes.select(F.explode("bands").alias("key"), "node"), scratch, mixed=False)
        links = verify(scratch.table(_hub_pairs(buckets, scratch)))
        labels = components(links, scratch)
        named = buckets.drop("size").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        open_ = _sized(named.select("key", "node", "label"), scratch, mixed=True)
        more = scratch.table(_small_pairs(open_).join(links.select("a", "b"), ["a", "b"], "left_anti"))
        links = links.unionByName(verify(more))
        crowded = scratch.table(open_.filter(F.col("size") > SMALL_BUCKET).select("key", "node", "label"))
        if not crowded.isEmpty():
            found = _large_links(crowded, verify.vectors(crowded.select("node").distinct()), scratch)
            links = links.unionByName(found).dropDuplicates(["a", "b"])
        links = scratch.table(links)
        labels = components(links, scratch)
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
        degree = scratch.table(labels.join(degree, "node"))
        ids = rows.select("id", "doc", "rid")
        placed = signed.select("doc", "rid", "node").distinct().join(degree, "node", "left")
        placed = scratch.table(placed.select("doc", "rid", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
        each = scratch.table(ids.join(placed, ["doc", "rid"]))
        first = F.min(F.struct("doc", "rid")).alias("first")
        classes = scratch.table(each.groupBy("label").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"), first))
    stays = F.expr("doc = first.doc and rid = first.rid").alias("stays")
    return each.join(classes, "label").select("id", "doc", "rid", "class_id", "class_size", "n_links", stays)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with the columns of ``docs``. Of rows equal in id and text any one stays."""
    stays = near_duplicate_classes(docs, id_col, text_col).filter("stays").select("doc", "rid").distinct()
    _, doc, rid = row_keys(id_col, text_col)
    keyed = docs.select("*", doc.alias("__doc"), rid.alias("__rid"))
    kept = keyed.join(stays.toDF("__doc", "__rid"), ["__doc", "__rid"]).dropDuplicates(["__doc", "__rid"])
    return kept.select(*docs.columns)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "class_size", "n_links", "stays")
