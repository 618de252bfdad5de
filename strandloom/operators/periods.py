"""Continuous stretches and gaps of integer intervals, by canonical dyadic blocks (problem 3).

The axis is cut into regions of ``2 ** region_bits``.  Within the region of an entity every
interval is decomposed into canonical dyadic blocks (block ``k`` of level ``l`` covers
``[k * 2**l, (k + 1) * 2**l)``), blocks that lie under another block are removed, sibling pairs
are merged upward level by level, and what is left is coalesced where it adjoins.  An entity's
region holds at most ``2 ** (region_bits + 1)`` different blocks however many intervals it has, so
no task holds an unbounded group; stretches that reach over a region's border are joined in a last
step that sees two stretches per region.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.session import stage

REGION_BITS = 20


def decompose(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Canonical dyadic blocks of the half-open intervals: (interval number, level, block start)."""
    lo, hi, who = start.copy(), stop.copy(), np.arange(len(start))
    rows, levels, starts = [], [], []
    level = 0
    while len(lo):
        step = np.int64(1) << level
        left = (lo >> level) & 1 == 1  # lo ends a pair: its block stands alone
        left &= lo < hi
        rows.append(who[left])
        starts.append(lo[left])
        levels.append(np.full(left.sum(), level))
        lo = np.where(left, lo + step, lo)
        right = ((hi >> level) & 1 == 1) & (lo < hi)
        hi = np.where(right, hi - step, hi)
        rows.append(who[right])
        starts.append(hi[right])
        levels.append(np.full(right.sum(), level))
        go = lo < hi
        lo, hi, who = lo[go], hi[go], who[go]
        level += 1
    if not rows:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(rows), np.concatenate(levels), np.concatenate(starts)


def stretches(group: np.ndarray, start: np.ndarray, stop: np.ndarray, facts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of the half-open intervals of each group, which come sorted by group.

    ``facts`` has four rows: over the intervals that a piece comes from, the least and greatest
    first base and the least and greatest last base.  Gives group, start, stop and facts of each
    stretch; the intervals of a stretch are all equal only if both pairs of facts are.
    """
    which, level, at = decompose(start, stop)
    g, end = group[which], at + (np.int64(1) << level)
    facts = facts[:, which]
    order = np.lexsort((-end, at, g))
    g, at, end, level, facts = g[order], at[order], end[order], level[order], facts[:, order]
    # blocks nest or are apart: in this order a block lies under an earlier one if that reaches its end
    first = np.r_[True, g[1:] != g[:-1]]
    base = np.cumsum(first) * (np.int64(1) << 40)
    reach = np.maximum.accumulate(base + end - _low(at, first))
    top = np.r_[True, (base + end - _low(at, first))[1:] > reach[:-1]]
    kept = np.flatnonzero(top)
    facts = _fold(facts, kept)
    g, at, end, level = g[kept], at[kept], end[kept], level[kept]
    for current in range(int(level.max(initial=0)) + 1):  # sibling pairs, upward
        if len(g) < 2:
            break
        pair = (level[:-1] == current) & (level[1:] == current) & (g[1:] == g[:-1]) & ((at[:-1] >> current) & 1 == 0) & (at[1:] == end[:-1])
        if pair.any():
            i = np.flatnonzero(pair)
            end[i], level[i] = end[i + 1], current + 1
            stay = np.ones(len(g), bool)
            stay[i + 1] = False
            kept = np.flatnonzero(stay)
            facts = _fold(facts, kept)
            g, at, end, level = g[kept], at[kept], end[kept], level[kept]
    heads = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (at[1:] != end[:-1])]) if len(g) else np.zeros(0, np.int64)
    tails = np.r_[heads[1:] - 1, len(g) - 1] if len(g) else heads
    return g[heads], at[heads], end[tails], _fold(facts, heads)


def _low(at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The first start of each row's group, so that positions within a group are small."""
    heads = np.flatnonzero(first)
    return np.repeat(at[heads], np.diff(np.r_[heads, len(at)]))


def _fold(facts: np.ndarray, heads: np.ndarray) -> np.ndarray:
    if not len(heads):
        return facts[:, :0]
    return np.stack([ufunc.reduceat(row, heads) for ufunc, row in zip((np.minimum, np.maximum) * 2, facts, strict=True)])


FACTS = ["s_min", "s_max", "e_min", "e_max"]


def _regions(entity: Sequence[str]):
    """Gaps and inner stretches of every region of an entity, and its two outer stretches.

    Rows come sorted by entity and region; the open region is held as its stretches only.
    """
    names = [*entity, "region"]

    def numbered(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        for name in names:
            codes = t.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        return np.cumsum(new)

    def shrunk(t: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """The stretches of ``t`` as rows of the same kind, and the group of each."""
        g = numbered(t)
        col = lambda c: t.column(c).to_numpy()
        got, at, end, facts = stretches(g, col("s"), col("e") + 1, np.stack([col(f) for f in FACTS]))
        heads = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        out = t.select(names).take(pa.array(heads[got]))
        for name, value in zip(["s", "e", *FACTS], [at, end - 1, *facts], strict=True):
            out = out.append_column(name, pa.array(value))
        return out, got

    def closed(t: pa.Table, g: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not t.num_rows:
            return
        first, last = np.r_[True, g[1:] != g[:-1]], np.r_[g[1:] != g[:-1], True]
        col = lambda c: t.column(c).to_numpy()
        several = (col("s_min") != col("s_max")) | (col("e_min") != col("e_max"))
        outer = first | last
        kept = t.filter(pa.array(outer | several))
        kinds = np.where(outer, "outer", "merged")[outer | several]
        before = np.flatnonzero(~last)  # a gap follows each stretch but the last
        gaps = t.take(pa.array(before))
        gaps = gaps.set_column(gaps.column_names.index("s"), "s", pa.array(col("e")[before] + 1))
        gaps = gaps.set_column(gaps.column_names.index("e"), "e", pa.array(col("s")[before + 1] - 1))
        for part, kind in ((kept, pa.array(kinds, pa.string())), (gaps, pa.array(["gap"] * len(before), pa.string()))):
            yield from part.append_column("kind", kind).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t.cast(pa.schema([f.with_nullable(True) for f in t.schema]))
            t, g = shrunk(pa.concat_tables([held, t]) if held is not None else t)
            done = int(np.searchsorted(g, g[-1]))
            yield from closed(t.slice(0, done), g[:done])
            held = t.slice(done)
        if held is not None:
            yield from closed(held, np.zeros(held.num_rows, np.int64))

    return run


def periods(df: DataFrame, entity: Sequence[str], start: str, end: str, region_bits: int = REGION_BITS) -> DataFrame:
    """``merged`` stretches and ``gap``s of each entity: entity columns, ``kind``, ``start``, ``end_``.

    Bounds are inclusive; turned bounds are turned back; rows with a null bound are left out;
    equal intervals count once; overlapping and adjoining ones form a stretch.  A stretch of two
    or more different intervals is ``merged``; uncovered positions between two neighbouring
    stretches are a ``gap``.  Null entity columns count as values of their own.  Other columns of
    ``df`` are not read, and clashing names do no harm; an empty table gives no rows.
    """
    s, e = F.least(F.col(start), F.col(end)).cast("long"), F.greatest(F.col(start), F.col(end)).cast("long")
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(entity)], s.alias("own_s"), e.alias("own_e"))
    keys = [f"k{i}" for i in range(len(entity))]
    at = rows.select(*keys, "own_s", "own_e", F.explode(F.sequence(F.shiftright("own_s", region_bits), F.shiftright("own_e", region_bits))).alias("region")).distinct()
    width = 1 << region_bits
    pieces = at.select(
        *keys,
        "region",
        F.greatest("own_s", F.col("region") * width).alias("s"),
        F.least("own_e", F.col("region") * width + (width - 1)).alias("e"),
        *[F.col(c).alias(f) for f, c in zip(FACTS, ("own_s", "own_s", "own_e", "own_e"), strict=True)],
    )
    placed = pieces.repartition(*keys, "region").sortWithinPartitions(*keys, "region")
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    made = placed.mapInArrow(_regions(keys), ", ".join(f"{k} {t}" for k, t in kinds.items()) + ", kind string")

    made = stage(made)  # read twice below: the outer stretches take one more step

    # two rows per region at most: the outer stretches, joined where regions meet
    w = Window.partitionBy(*keys).orderBy("s")
    outer = made.where("kind = 'outer'").withColumn("before", F.lag(F.struct("e", "region")).over(w))
    outer = outer.withColumn("island", F.sum(F.when(F.col("before.e") + 1 == F.col("s"), 0).otherwise(1)).over(w))
    islands = outer.groupBy(*keys, "island").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.min_by(F.struct("before", "region"), "s").alias("head"),
        ((F.min("s_min") != F.max("s_max")) | (F.min("e_min") != F.max("e_max"))).alias("several"),
    )
    crossed = F.col("head.before.region") != F.col("head.region")  # gaps within a region are there already
    cases = F.array(
        F.struct(F.when(F.col("several"), "merged").alias("kind"), F.col("s").alias("start"), F.col("e").alias("end_")),
        F.struct(F.when(crossed, "gap").alias("kind"), (F.col("head.before.e") + 1).alias("start"), (F.col("s") - 1).alias("end_")),
    )
    joined = islands.select(*keys, F.inline(cases)).where("kind is not null")
    inner = made.where("kind <> 'outer'").select(*keys, "kind", F.col("s").alias("start"), F.col("e").alias("end_"))
    out = inner.unionByName(joined)
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, entity, strict=True)], "kind", "start", "end_")
