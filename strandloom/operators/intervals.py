"""Strand-aware interval algebra: overlap joins by bins, nearest match, clustering.

Intervals are inclusive rows with ``chrom``, ``strand``, ``s``, ``e``; a strand of its own never
meets another.  A plain range condition next to an equi-join on (chrom, strand) lets one hot
chromosome make one task of pairs; here both sides are spread over bins of ``bin_width`` and a
pair is kept in the first bin both sides share, so work follows the overlaps and not the square
of a chromosome.  Rows with a null key or bound meet nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = 1 << 14
REGION = 1 << 20
PLACE = ("chrom", "strand")


def overlap_bp(a: str, b: str) -> Column:
    """Shared bases of the intervals with the prefixes ``a`` and ``b``; 0 when apart."""
    return F.greatest(F.lit(0).cast("long"), F.least(f"{a}e", f"{b}e") - F.greatest(f"{a}s", f"{b}s") + 1)


def _binned(df: DataFrame, width: int) -> DataFrame:
    return df.where("s is not null and e is not null and s <= e").withColumn("bin", F.explode(F.sequence(F.floor(F.col("s") / width), F.floor(F.col("e") / width))))


def overlap_join(a: DataFrame, b: DataFrame, on: Sequence[str] = PLACE, bin_width: int = BIN) -> DataFrame:
    """All overlapping pairs: the columns of both sides prefixed ``a_`` and ``b_``, and ``bp``."""
    left = _binned(a, bin_width).select([F.col(c).alias(f"a_{c}") for c in [*a.columns, "bin"]])
    right = _binned(b, bin_width).select([F.col(c).alias(f"b_{c}") for c in [*b.columns, "bin"]])
    same = F.col("a_bin") == F.col("b_bin")
    for c in on:
        same = same & (F.col(f"a_{c}") == F.col(f"b_{c}"))
    first = F.floor(F.greatest("a_s", "b_s") / bin_width) == F.col("a_bin")
    pairs = left.join(right, same & (F.col("a_s") <= F.col("b_e")) & (F.col("b_s") <= F.col("a_e")) & first)
    return pairs.drop("a_bin", "b_bin").withColumn("bp", overlap_bp("a_", "b_"))


def overlap_semi(a: DataFrame, b: DataFrame, on: Sequence[str] = PLACE, keep: bool = True, bin_width: int = BIN) -> DataFrame:
    """Rows of ``a`` that overlap something in ``b`` (``keep``), or nothing; ``a`` needs ``id``."""
    known = b.select(*on, "s", "e")
    hit = overlap_join(a.select("id", *on, "s", "e"), known, on, bin_width).select(F.col("a_id").alias("id")).distinct()
    return a.join(hit, "id", "left_semi" if keep else "left_anti")


def best_overlap(pairs: DataFrame, key: Sequence[str] = ("a_id",)) -> DataFrame:
    """For each key of ``pairs`` the partner with most shared bases; ties: first start, then id."""
    w = Window.partitionBy(*key).orderBy(F.col("bp").desc(), "b_s", "b_id")
    return pairs.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def scan_max(df: DataFrame, by: Sequence[str], at: str, order: Sequence[str], value: Column, out: str, inclusive: bool, width: int = REGION) -> DataFrame:
    """Add ``out``: the running maximum of ``value`` along ``order`` (which begins with ``at``).

    A scan in two levels: within regions of ``width`` of the axis, and over the maxima of the
    regions, of which there are few.  So one hot chromosome is many groups, not one task.
    """
    place = df.withColumn("_v", value).withColumn("_region", F.floor(F.col(at) / width))
    within = Window.partitionBy(*by, "_region").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    before = Window.partitionBy(*by).orderBy("_region").rowsBetween(Window.unboundedPreceding, -1)
    carry = place.groupBy(*by, "_region").agg(F.max("_v").alias("_m")).withColumn("_carry", F.max("_m").over(before)).drop("_m")
    local = place.withColumn("_local", F.max("_v").over(within))
    names = [F.col(c).alias(f"_k{i}") for i, c in enumerate([*by, "_region"])]
    carry = carry.select(*names, "_carry")
    same = F.lit(True)
    for i, c in enumerate([*by, "_region"]):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return local.join(carry, same, "left").withColumn(out, F.greatest("_local", "_carry")).select(*df.columns, out)


def prefix_max_end(df: DataFrame, by: Sequence[str] = PLACE) -> DataFrame:
    """``max_e``: the furthest end of the intervals up to each one, in order of start."""
    return scan_max(df, by, "s", ["s", "e", "id"], F.col("e"), "max_e", True)


def islands(df: DataFrame, by: Sequence[str], start: str, end: str, order: Sequence[str], gap: int = 0) -> DataFrame:
    """Add ``island``, the start of the run of rows each at most ``gap`` beyond all ends before it."""
    reached = scan_max(df, by, start, order, F.col(end), "_reach", False)
    fresh = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach") + gap), F.col(start))
    return scan_max(reached, by, start, order, fresh, "island", True).drop("_reach")


def clusters(df: DataFrame, by: Sequence[str] = PLACE, least: int = 2, gap: int = 0) -> DataFrame:
    """Overlap clusters: ``island`` names a cluster by its first base, ``n`` counts its members.

    A new cluster begins where the start lies more than ``gap`` beyond all ends before it.
    Clusters of fewer than ``least`` members are left out.
    """
    marked = islands(df, by, "s", "e", ["s", "e", "id"], gap)
    sizes = marked.groupBy(*by, "island").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return marked.join(sizes, [*by, "island"])


def cluster_heads(df: DataFrame, by: Sequence[str] = PLACE) -> DataFrame:
    """Of every overlap cluster, the first member by start stands for all: ``id``, ``head_id``."""
    marked = islands(df, by, "s", "e", ["s", "e", "id"])
    heads = marked.groupBy(*by, "island").agg(F.min(F.struct("s", "e", "id")).alias("head"))
    return marked.join(heads, [*by, "island"]).select("id", F.col("head.id").alias("head_id"))


def distance_clusters(df: DataFrame, by: Sequence[str], pos: str, support: str, gap: int) -> DataFrame:
    """Positions chained by steps of at most ``gap``: the best supported stands for its chain.

    Gives the columns ``by``, ``pos`` (of the best; ties: the lowest), ``support`` (summed) and
    ``members``.
    """
    chained = islands(df, by, pos, pos, [pos], gap)
    best = F.max_by(F.col(pos), F.struct(F.col(support), -F.col(pos)))
    return chained.groupBy(*by, "island").agg(best.alias(pos), F.sum(support).cast("long").alias(support), F.count("*").alias("members")).drop("island")


def containment(points: DataFrame, spans: DataFrame, on: Sequence[str] = ("chrom",), bin_width: int = BIN) -> DataFrame:
    """Points (``s``) inside spans: a point is an interval of one base."""
    return overlap_join(points.withColumn("e", F.col("s")), spans, on, bin_width)
