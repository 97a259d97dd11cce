"""Ordered groups of any size: numbering, bounded frames, running values, exact quantiles.

A window over ``partitionBy(key)`` puts a whole group into one task. That is the cheapest plan while every
group is small, and it fails once one key holds a large share of the rows. Each helper here therefore takes a
``Layout`` that carries the measured (or proven) size of the largest group. Up to ``block`` rows per group it
plans the plain window; beyond that it cuts groups into blocks of rows and

* repeats the few rows next to a block border (``bounded_frames``),
* carries block totals forward (``running``, ``number_rows``),
* or counts values and picks the wanted ranks (``quantiles``).

Both ways give the same values. Keys must not be NULL, and the order columns must order a group totally.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from panelkit.operators.joins import join_small
from panelkit.session import compile_wide_rows, durable

BLOCK_ROWS = 1_000_000
# Most block borders (8 bytes each) that are broadcast together.
EDGE_VALUES = 4_000_000
POS, SIZE = "pos", "n_rows"


@dataclass(frozen=True)
class Layout:
    """How the rows of a frame fall into ordered groups."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    largest: int
    block: int = BLOCK_ROWS

    @property
    def hot(self) -> bool:
        return self.largest > self.block

    def by(self, *order: str) -> Layout:
        return replace(self, order=order)

    def within(self, *keys: str) -> Layout:
        """The same groups split further by ``keys`` (never larger than before)."""
        return replace(self, keys=self.keys + keys)

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)


def measure(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], block: int = BLOCK_ROWS) -> Layout:
    """Count the largest group (one aggregate with map-side combine, key columns only)."""
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    order = (order,) if isinstance(order, str) else tuple(order)
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return Layout(keys, order, largest or 0, block)


def _slot(edges: Column, x: Column, steps: Sequence[int]) -> Column:
    """Number of ``edges`` (sorted, 2^m - 1 of them) below ``x``, by halving."""
    return F.coalesce(
        F.aggregate(
            F.array(*[F.lit(s) for s in steps]),
            F.lit(0),
            lambda at, step: at + F.when(F.element_at(edges, at + step) < x, step).otherwise(F.lit(0)),
        ),
        F.lit(0),
    )


def number_rows(df: DataFrame, layout: Layout) -> DataFrame:
    """Add ``pos`` (0-based rank in the group) and ``n_rows`` (group size)."""
    keys, order = list(layout.keys), list(layout.order)
    if not layout.hot:
        whole = Window.partitionBy(*keys)
        return df.select(
            "*",
            (F.row_number().over(layout.window()) - 1).cast("long").alias(POS),
            F.count(F.lit(1)).over(whole).alias(SIZE),
        )
    parts = 2
    while parts * layout.block < layout.largest:
        parts *= 2
    steps = [parts >> i for i in range(1, parts.bit_length())]
    big = df.groupBy(*keys).count().where(F.col("count") > layout.block).select(*keys)
    # Approximate quantiles depend on merge order, so the edges are stored before two plans use them.
    edges = durable(
        df.select(*keys, order[0])
        .join(big, keys)
        .groupBy(*keys)
        .agg(F.percentile_approx(order[0], [i / parts for i in range(1, parts)], max(10_000, 8 * parts)).alias("_edges"))
    )
    cut = join_small(df, edges, keys, limit=EDGE_VALUES // parts).withColumn("_slot", _slot(F.col("_edges"), F.col(order[0]), steps)).drop("_edges")
    slots = cut.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_c"))
    before = slots.select(
        *keys,
        "_slot",
        F.coalesce(
            F.sum("_c").over(Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
        F.sum("_c").over(Window.partitionBy(*keys)).alias(SIZE),
    )
    inner = Window.partitionBy(*keys, "_slot").orderBy(*order)
    return cut.join(before, [*keys, "_slot"]).select(
        *df.columns, (F.col("_before") + F.row_number().over(inner) - 1).cast("long").alias(POS), SIZE
    )


def bounded_frames(
    df: DataFrame,
    layout: Layout,
    columns: Callable[[WindowSpec], list[Column]],
    back: int = 0,
    ahead: int = 0,
) -> DataFrame:
    """``select(*, columns(window))`` for frames that reach ``back`` rows back and ``ahead`` rows ahead at most."""
    if not layout.hot:
        return df.select("*", *columns(layout.window()))
    spread = _spread_blocks(df, layout, back, ahead)
    w = Window.partitionBy(*layout.keys, "_block").orderBy(POS)
    return _own_rows(spread.select("*", *columns(w)), df)


def bounded_exprs(
    df: DataFrame, layout: Layout, columns: Callable[[str], list[str]], back: int = 0, ahead: int = 0
) -> DataFrame:
    """``bounded_frames`` for many columns at once: SQL texts, built from the text of the window."""
    compile_wide_rows(df.sparkSession)
    if not layout.hot:
        return df.selectExpr("*", *columns(_window_text(layout.keys, layout.order)))
    spread = _spread_blocks(df, layout, back, ahead)
    text = _window_text([*layout.keys, "_block"], [POS])
    return _own_rows(spread.selectExpr("*", *columns(text)), df)


def _window_text(keys: Sequence[str], order: Sequence[str]) -> str:
    return f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY {', '.join(f'`{o}`' for o in order)}"


def _spread_blocks(df: DataFrame, layout: Layout, back: int, ahead: int) -> DataFrame:
    """Give each row to its own block of positions and to the blocks whose frames reach it."""
    numbered = df if POS in df.columns else number_rows(df, layout)
    block = max(layout.block, back, ahead, 1)
    last = F.floor((F.col(SIZE) - 1) / block)
    first_user = F.greatest(F.floor((F.col(POS) - ahead) / block), F.lit(0))
    last_user = F.least(F.floor((F.col(POS) + back) / block), last)
    return numbered.select(
        "*", F.floor(F.col(POS) / block).alias("_home"), F.explode(F.sequence(first_user, last_user)).alias("_block")
    )


def _own_rows(framed: DataFrame, df: DataFrame) -> DataFrame:
    out = framed.where(F.col("_block") == F.col("_home")).drop("_block", "_home")
    return out if POS in df.columns else out.drop(POS, SIZE)


_MERGE = {
    "sum": lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b),
    "min": lambda a, b: F.least(a, b),
    "max": lambda a, b: F.greatest(a, b),
}


def running(
    df: DataFrame,
    layout: Layout,
    values: dict[str, tuple[str, Column]],
    reverse: bool = False,
    exclusive: bool = False,
) -> DataFrame:
    """Add running ``sum`` / ``min`` / ``max`` per group along ``pos``.

    ``values`` maps an output name to (function, expression). ``reverse`` runs from the end;
    ``exclusive`` leaves out the current row.
    """
    stop = -1 if exclusive else 0
    direction = F.desc if reverse else F.asc
    keys = list(layout.keys)

    def over(expr: Column, fn: str, *cols: str, by: str, stop: int) -> Column:
        w = Window.partitionBy(*cols).orderBy(direction(by)).rowsBetween(Window.unboundedPreceding, stop)
        return getattr(F, fn)(expr).over(w)

    if not layout.hot:
        return df.select("*", *[over(e, fn, *keys, by=POS, stop=stop).alias(n) for n, (fn, e) in values.items()])
    cut = df.withColumn("_block", F.floor(F.col(POS) / layout.block))
    totals = cut.groupBy(*keys, "_block").agg(*[getattr(F, fn)(e).alias(f"_t_{n}") for n, (fn, e) in values.items()])
    carried = totals.select(
        *keys,
        "_block",
        *[over(F.col(f"_t_{n}"), fn, *keys, by="_block", stop=-1).alias(f"_c_{n}") for n, (fn, _) in values.items()],
    )
    joined = cut.join(carried, [*keys, "_block"])
    return joined.select(
        *df.columns,
        *[
            _MERGE[fn](F.col(f"_c_{n}"), over(e, fn, *keys, "_block", by=POS, stop=stop)).alias(n)
            for n, (fn, e) in values.items()
        ],
    )


def with_group_values(df: DataFrame, layout: Layout, values: dict[str, Column]) -> DataFrame:
    """Add aggregates of the whole group to each of its rows."""
    if not layout.hot:
        whole = Window.partitionBy(*layout.keys)
        return df.select("*", *[v.over(whole).alias(n) for n, v in values.items()])
    return join_group_rows(df, df.groupBy(*layout.keys).agg(*[v.alias(n) for n, v in values.items()]), layout)


def join_group_rows(df: DataFrame, stats: DataFrame, layout: Layout) -> DataFrame:
    """Join one row per group of ``stats`` to the rows of the groups of ``df``.

    Where ``df`` carries the series size, the rows of a large series are spread by a hash over as many parts as it
    has blocks, and its group rows are repeated for each part; otherwise one task would take the whole group.
    """
    keys = list(layout.keys)
    if SIZE not in df.columns:
        return df.join(stats, keys)
    parts = layout.largest // layout.block + 1
    large = F.col(SIZE) > layout.block
    salt = F.when(large, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(parts))).otherwise(F.lit(0))
    sizes = df.groupBy(*keys).agg(F.max(SIZE).alias("_size"))
    salts = F.when(F.col("_size") > layout.block, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    repeated = stats.join(sizes, keys).withColumn("_salt", F.explode(salts)).drop("_size")
    return df.withColumn("_salt", salt.cast("int")).join(repeated, [*keys, "_salt"]).drop("_salt")


def counted_values(df: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
    """One row per group, column (``which``, its place in ``columns``) and distinct value ``v``, with two running counts.

    ``upto`` counts the group's rows up to this value, ``n_values`` all its rows with a value. Equal values are added up
    before the shuffle, so a group of one value is one row; groups of many values are cut into blocks of values like
    any ordered group. Counts are whole numbers: every plan gives the same.
    """
    keys = list(layout.keys)
    each = F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    long = df.select(*keys, F.explode(each).alias("_x")).select(*keys, "_x.*").where(F.col("v").isNotNull())
    part = layout.within("which").by("v")
    counted = long.groupBy(*part.keys, "v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running(number_rows(counted, part), part.by(POS), {"upto": ("sum", F.col("_n"))})
    ranked = with_group_values(ranked, part.by(POS), {"n_values": F.sum("_n")})
    return ranked.select(*part.keys, "v", "upto", "n_values")


def quantiles(df: DataFrame, layout: Layout, wanted: dict[str, dict[str, float]]) -> DataFrame:
    """Exact, linearly interpolated quantiles of the non-NULL values of several columns in one pass: one row per group.

    ``wanted`` maps a column to {output name: probability}. A group without any value may lack a row; a column without a
    value in a group gives NULL. Small groups use the ``percentile`` aggregate, whose buffer holds a group's counted values;
    larger ones the same counts as a table. Ranks and interpolation are the same, so both give the same bits.
    """
    keys = list(layout.keys)
    names = [(c, n, float(p)) for c, probs in wanted.items() for n, p in probs.items()]
    if not layout.hot:
        every = [F.percentile(c, F.array(*[F.lit(float(p)) for p in probs.values()])).alias(f"_q{i}") for i, (c, probs) in enumerate(wanted.items())]
        at = {n: F.col(f"_q{i}")[k] for i, probs in enumerate(wanted.values()) for k, n in enumerate(probs)}
        return df.groupBy(*keys).agg(*every).select(*keys, *[at[n].alias(n) for _, n, _ in names])
    which, picks, out = {c: i for i, c in enumerate(wanted)}, [], []
    for c, name, p in names:
        own, at = F.col("which") == which[c], (F.col("n_values") - 1).cast("double") * F.lit(p)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.min(F.when(own & (F.col("upto") > rank), F.col("v"))).alias(f"_{side}_{name}"))
        picks.append(F.max(F.when(own, at)).alias(f"_at_{name}"))
        lo, hi, at = (F.col(f"`_{part}_{name}`") for part in ("lo", "hi", "at"))
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi).alias(name))
    return counted_values(df, layout, list(wanted)).groupBy(*keys).agg(*picks).select(*keys, *out)


def exact_quantiles(df: DataFrame, layout: Layout, column: str, probs: dict[str, float]) -> DataFrame:
    """``quantiles`` of one column; groups without a value have no row."""
    rows = df.select(*layout.keys, F.col(column).alias("_v")).where(F.col("_v").isNotNull())
    return quantiles(rows, layout, {"_v": probs})


def join_all(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left join of the later frames onto the first."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), frames)


def global_running(df: DataFrame, order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Add running sums of ``values`` along ``order`` over the whole frame, current row left out (0 at the first).

    One exchange by ranges; the ranges are stored, their totals added up (a row per range), and each task adds the sum
    before its range. Rows with equal order values fall into one range: make them distinct, or name more columns.
    """
    at = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    stored = durable(ranged).withColumn("_range", F.shiftright("_at", 33))
    totals = stored.groupBy("_range").agg(*[F.sum(e).alias(f"_t_{n}") for n, e in values.items()])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_range", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in values])
    own = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = [(F.col(f"_b_{n}") + F.coalesce(F.sum(e).over(own), F.lit(0))).alias(n) for n, e in values.items()]
    return stored.join(before, "_range").select(*df.columns, *sums)
