"""Models that hold several proteins: cut between hits, pieces with strands, and an audit of the cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators.hits import apart, fusion_cuts


def pieces(length: Column, kept: Column, least: int = 25) -> Column:
    """Pieces (``k``, ``s``, ``e``, ``sign``) of a model of ``length`` bases, cut between its kept hits.

    ``kept`` are hits (``s``, ``e``, ``sign``) apart from each other.  A piece takes the sign of the hit
    that shares most bases with it (ties: the first by place), none where no hit lies.  Pieces under ``least`` bases are
    dropped before numbering; fewer than two left is null: the model stays as it is.
    """
    inner = F.filter(fusion_cuts(kept).cast("array<bigint>"), lambda c: (c > 0) & (c < length))
    cuts = F.concat(F.array(F.lit(0).cast("long")), inner, F.array(length.cast("long")))
    ends = F.zip_with(F.slice(cuts, 1, F.size(cuts) - 1), F.slice(cuts, 2, F.size(cuts) - 1), lambda a, b: F.struct((a + 1).alias("s"), b.alias("e")))
    good = F.filter(ends, lambda p: p["e"] - p["s"] + 1 >= least)

    def sign(p: Column) -> Column:
        shared = F.transform(kept, lambda h: F.struct((F.greatest(F.lit(0), F.least(h["e"], p["e"]) - F.greatest(h["s"], p["s"]) + 1)).alias("bp"), (-h["s"]).alias("first"), h["sign"].alias("sign")))
        best = F.array_max(shared)
        return F.when(best["bp"] > 0, best["sign"])

    out = F.transform(good, lambda p, i: F.struct((i + 1).alias("k"), p["s"].alias("s"), p["e"].alias("e"), sign(p).alias("sign")))
    return F.when((F.size(kept) >= 2) & (F.size(good) >= 2), out)


def defused(models: DataFrame, hits: str = "hits", least: int = 25) -> DataFrame:
    """Every model (``tid``, ``length``) in its pieces: ``tid`` with ``.d<k>``, ``s``, ``e``, ``sign``; others as they are.

    ``hits`` are a model's hits, best first (``s``, ``e``, ``sign``).
    """
    told = models.withColumn("kept", apart(F.col(hits))).withColumn("cut", pieces(F.col("length"), F.col("kept"), least))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("k"), F.lit(1).cast("long").alias("s"), F.col("length").cast("long").alias("e"), F.lit(None).cast("int").alias("sign")))
    rows = told.select("tid", F.explode(F.coalesce("cut", whole)).alias("p"))
    return rows.select(F.concat_ws(".d", "tid", F.col("p.k").cast("string")).alias("tid"), "p.s", "p.e", "p.sign")


def audit(models: DataFrame, hits: str = "hits", least: int = 25) -> DataFrame:
    """One row per model that is cut: ``tid``, ``n_pieces``, ``seams``."""
    told = models.withColumn("kept", apart(F.col(hits))).withColumn("cut", pieces(F.col("length"), F.col("kept"), least)).where("cut is not null")
    return told.select("tid", F.size("cut").cast("long").alias("n_pieces"), F.array_join(F.transform(fusion_cuts(F.col("kept")), lambda c: c.cast("string")), ",").alias("seams"))
