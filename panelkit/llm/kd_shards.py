"""Operator 13: shards of near-equal bytes by a k-d tree over metadata.

All documents are the root's. A node of more than one leaf is cut where the bytes left of the cut reach its left leaves' share, along
the metadata dimension that is widest in the node, measured against the whole table. Behind a dimension's value rows are ordered by a
hash of their text and then by a hash of the row, so a cut is exact whatever the table repeats, and equal texts, which take the
least metadata of their group, part only where a cut falls inside a group.

A weighted median is found by histograms: each job adds up the bytes of a few thousand intervals per node, keeps the interval in
which the share is reached and divides it again. The driver holds one row per open node. No sort of the table, no group in one task.

Null texts have size 1, null metadata comes first, repeated rows are placed one by one, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import Scratch, tidy_shuffles

#: Intervals per node and job; values have 48 bits, so their products have 60.
INTERVALS = 4096
_MOST = (1 << 48) - 1
#: A cut is close enough when this part of a leaf's bytes is left undivided.
SLACK = 1 / 512
#: Rows numbered together; every shard has at least so many slices.
SLICE_ROWS, LEAST_SLICES = 50_000, 64


def as_number(column: Column, kind: T.DataType) -> Column:
    """A column as whole numbers from 0 to 2^48 - 1 in its order; null is 0. Texts count by their first six bytes."""
    if isinstance(kind, T.StringType):
        head = F.substring(F.hex(F.encode(F.substring(column, 1, 6), "utf-8")), 1, 12)
        return F.coalesce(F.conv(F.rpad(head, 12, "0"), 16, 10).cast("long") + (F.length(column) > 0).cast("long"), F.lit(0))
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        column = F.unix_timestamp(column.cast("timestamp"))
    half = 1 << 47
    whole = F.least(F.greatest(F.floor(column.cast("double")), F.lit(-half + 1)), F.lit(half - 1)).cast("long")
    return F.coalesce(whole + half, F.lit(0))


@dataclass
class _Node:
    """A node of the tree with the search for its cut: left go rows of (value, text hash, row hash) up to ``cut``."""

    node: int
    leaves: int
    first: int  # shard
    dim: int = 0
    need: int = 0  # bytes still to be found left of the cut
    part: int = 0  # 0 value, 1 text hash, 2 row hash
    lo: int = 0
    hi: int = _MOST
    cut: tuple[int, ...] = ()
    done: bool = False

    def narrow(self, interval: int, weight: int, before: int, slack: float) -> None:
        """Go on with one interval, whose rows have ``weight`` bytes behind ``before`` bytes of the searched range."""
        width = self.hi - self.lo + 1
        start, end = (self.lo - (-k * width // INTERVALS) for k in (interval, interval + 1))
        self.need -= before
        self.lo, self.hi = start, end - 1
        last = self.part == 2 and self.lo == self.hi
        if self.need == weight or weight <= slack or last:
            bound = self.hi if 2 * self.need >= weight else self.lo - 1
            self.cut, self.done = (*self.cut, bound, _MOST, _MOST)[:3], True
        elif self.lo == self.hi:
            self.cut, self.part, self.lo, self.hi = (*self.cut, self.lo), self.part + 1, 0, _MOST

    def row(self) -> tuple[int, ...]:
        return (self.node, self.dim, self.part, self.lo, self.hi, self.need, *(*self.cut, 0, 0)[:2])


_SEARCH = "node long, dim int, part int, lo long, hi long, need long, v long, h long"
_CUTS = "node long, dim int, v long, h long, r long"


def _search(rows: DataFrame, open_: list[_Node], slack: float) -> None:
    """Find the cuts of the open nodes, all nodes in the same jobs."""
    spark, left = rows.sparkSession, open_
    while left := [n for n in left if not n.done]:
        state = spark.createDataFrame([n.row() for n in left], _SEARCH)
        own = rows.join(F.broadcast(state), "node")
        value = F.element_at("dims", F.col("dim") + 1)
        looked = F.when(F.col("part") == 0, value).when(F.col("part") == 1, F.col("text_hash")).otherwise(F.col("row_hash"))
        fits = ((F.col("part") < 1) | (value == F.col("v"))) & ((F.col("part") < 2) | (F.col("text_hash") == F.col("h")))
        own = own.withColumn("x", looked).filter(fits & F.col("x").between(F.col("lo"), F.col("hi")))
        interval = F.expr(f"((x - lo) * {INTERVALS}L) div (hi - lo + 1)")
        sums = own.groupBy("node", "need", interval.alias("interval")).agg(F.sum("size").alias("weight"))
        upto = F.sum("weight").over(Window.partitionBy("node").orderBy("interval"))
        found = sums.withColumn("upto", upto).filter("upto >= need and upto - weight < need")
        by_node = {r.node: r for r in found.collect()}
        for n in left:
            r = by_node[n.node]
            n.narrow(r.interval, r.weight, r.upto - r.weight, slack)


def _descend(rows: DataFrame, cuts: list[_Node]) -> DataFrame:
    """Rows of cut nodes move to the node's children; the others stay."""
    if not cuts:
        return rows
    table = rows.sparkSession.createDataFrame([(n.node, n.dim, *n.cut) for n in cuts], _CUTS)
    own = rows.join(F.broadcast(table), "node", "left")
    value = F.element_at("dims", F.col("dim") + 1)
    behind = (F.col("text_hash") > F.col("h")) | ((F.col("text_hash") == F.col("h")) & (F.col("row_hash") > F.col("r")))
    right = (value > F.col("v")) | ((value == F.col("v")) & behind)
    node = F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + right.cast("long"))
    return own.select(node.alias("node"), *[c for c in rows.columns if c != "node"])


def _measured(docs: DataFrame, dims: Sequence[str], id_col: str, text_col: str, keep: Sequence[str]) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    fields = {f.name.lower(): f.dataType for f in docs.schema}
    numbers = [as_number(F.col(d), fields[d.lower()]) for d in dims]
    return docs.select(
        F.col(id_col).alias("id"),
        F.struct(*[F.col(c) for c in keep]).alias("kept") if keep else F.lit(None).cast("int").alias("kept"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("crc"),
        F.shiftrightunsigned(F.xxhash64(text), 16).alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),
        F.array(*numbers, F.lit(0).cast("long")).alias("dims"),
    )


def kd_shards(
    docs: DataFrame,
    dims: Sequence[str] = ("n_chars", "source", "lang"),
    *,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] = (),
    slack: float = SLACK,
) -> DataFrame:
    """Every row with its ``shard`` (0 .. leaves - 1) and its ``slot`` in the shard (gapless from 0).

    Returns ``id_col``, the columns ``keep``, ``size`` (bytes of the text plus 1), ``text_crc32``, ``shard`` and ``slot``. The tree has
    ``shards`` leaves, or as many as have ``target_bytes`` each. Shards differ by some ``slack`` of a leaf, or by a document that is
    larger than this. Names of ``keep`` that clash with a result are left out.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    spark = docs.sparkSession
    keep = [c for c in keep if c.lower() not in (id_col.lower(), "size", "text_crc32", "shard", "slot")]
    scratch = Scratch(spark, "kd-shards")
    with tidy_shuffles(spark):
        rows = scratch.table(_measured(docs, dims, id_col, text_col, keep))
        n_dims = len(dims) + 1
        # Equal texts with unlike metadata take the least of each dimension.
        same = ["text_hash", "size", "crc"]
        least, most = ([f(F.element_at("dims", k + 1)).alias(f"{f.__name__}{k}") for k in range(n_dims)] for f in (F.min, F.max))
        groups = rows.groupBy(*same).agg(F.count("*").alias("n"), *least, *most)
        unlike = groups.filter("n > 1 and (" + " or ".join(f"min{k} < max{k}" for k in range(n_dims)) + ")")
        unlike = scratch.table(unlike.select(*same, F.array(*[F.col(f"min{k}") for k in range(n_dims)]).alias("least")))
        rows = rows.join(unlike, same, "left").withColumn("dims", F.coalesce("least", "dims")).drop("least")
        row_hash = F.shiftrightunsigned(F.xxhash64("row"), 16)
        placed = scratch.table(rows.select(F.lit(1).cast("long").alias("node"), row_hash.alias("row_hash"), *rows.columns))
    total = placed.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).first()
    leaves = shards or max(1, -(-(total.bytes or 0) // target_bytes))
    level, ends = [_Node(1, leaves, 0)] if total.n else [], []
    wide: list[int] = []
    tree = placed.select("node", "size", "dims", "text_hash", "row_hash")
    cuts: list[list[_Node]] = []
    while level:
        open_ = [n for n in level if n.leaves > 1]
        ends += [n for n in level if n.leaves == 1]
        spreads = [(F.max(x) - F.min(x)).alias(f"d{k}") for k in range(n_dims) for x in [F.element_at("dims", k + 1)]]
        found = {r.node: r for r in tree.groupBy("node").agg(F.sum("size").alias("bytes"), *spreads).collect()} if open_ else {}
        ends += [n for n in open_ if n.node not in found]  # no rows: the shards behind the first stay empty
        open_ = [n for n in open_ if n.node in found]
        for n in open_:
            own = [found[n.node][f"d{k}"] for k in range(n_dims)]
            wide = wide or own
            n.dim = max(range(n_dims), key=lambda k: (own[k] / max(wide[k], 1), -k))  # noqa: B023
            n.need = max(1, found[n.node].bytes * (n.leaves // 2) // n.leaves)
        _search(tree, open_, slack * (total.bytes or 0) / leaves)
        tree = _descend(tree, open_)
        cuts.append(open_)
        halves = [(n, n.leaves // 2) for n in open_]
        level = [x for n, k in halves for x in (_Node(2 * n.node, k, n.first), _Node(2 * n.node + 1, n.leaves - k, n.first + k))]
    for cut in cuts:
        placed = _descend(placed, cut)
    shard_of = spark.createDataFrame([(n.node, n.first) for n in ends], "node long, shard int")
    return _slots(placed.join(F.broadcast(shard_of), "node"), total.n, leaves, id_col, keep)


def _slots(placed: DataFrame, n_rows: int, leaves: int, id_col: str, keep: Sequence[str]) -> DataFrame:
    """Number each shard's rows: slices of a shard are numbered apart and start behind each other."""
    slices = max(LEAST_SLICES, -(-n_rows // (leaves * SLICE_ROWS)))
    rows = placed.withColumn("slice", F.pmod("row_hash", F.lit(slices)).cast("int"))
    counts = rows.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")
    counts = counts.select(F.col("shard").alias("s"), F.col("slice").alias("k"), before.alias("before"))
    numbered = rows.withColumn("at", F.row_number().over(Window.partitionBy("shard", "slice").orderBy("row_hash", "row")))
    joined = numbered.join(counts, (F.col("shard") == F.col("s")) & (F.col("slice") == F.col("k")))
    slot = (F.col("before") + F.col("at") - 1).alias("slot")
    kept = [F.col("kept")[c].alias(c) for c in keep]
    return joined.select(F.col("id").alias(id_col), *kept, "size", F.col("crc").alias("text_crc32"), "shard", slot)


def write_shards(placed: DataFrame, path: str) -> None:
    """Write placed rows as one Parquet folder per shard, in the order of their slots."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op13_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = kd_shards(docs, shards=16)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)
