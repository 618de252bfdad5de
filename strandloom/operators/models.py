"""Transcript models as exon rows: projection, splitting, phases and mapping of reading frames.

A model is its exon rows (``tid``, ``chrom``, ``strand``, ``s``, ``e``); exons of a model do not
overlap.  Windows run over one model; sums of lengths give positions on the spliced transcript.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ("tid", "chrom", "strand")


def _len() -> Column:
    return F.col("e") - F.col("s") + 1


def numbered(exons: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Add ``k`` (from 1, by start), ``n``, ``off`` (spliced bases before, by start) and ``gap`` (to the next)."""
    w = Window.partitionBy(*key).orderBy("s", "e")
    return exons.withColumns(
        {
            "k": F.row_number().over(w).cast("long"),
            "n": F.count("*").over(Window.partitionBy(*key)),
            "off": F.coalesce(F.sum(_len()).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"),
            "gap": F.lead("s").over(w) - F.col("e") - 1,
        }
    )


def flattened(exons: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Exons merged where they overlap or adjoin, so that models are well formed."""
    before = Window.partitionBy(*key).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*key).orderBy("s", "e")
    marked = exons.withColumn("_g", F.when(F.col("s") <= F.max("e").over(before) + 1, 0).otherwise(1))
    return marked.withColumn("_g", F.sum("_g").over(upto)).groupBy(*key, "_g").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_g")


def project(exons: DataFrame, points: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Genomic ``pos`` of ``points`` on the spliced model, by start; points outside exons give no row."""
    placed = numbered(exons, key).select(*key, "s", "e", "off")
    return points.join(placed, list(key)).where("pos between s and e").select(*points.columns, (F.col("off") + F.col("pos") - F.col("s") + 1).alias("spliced"))


def long_gaps(exons: DataFrame, longest: int, key: Sequence[str] = KEY) -> DataFrame:
    """Introns longer than ``longest`` and the spliced offset a cut there has."""
    return numbered(exons, key).where(F.col("gap") > longest).select(*key, (F.col("off") + _len()).alias("cut"), "gap")


def split(exons: DataFrame, longest: int, least: int, key: Sequence[str] = KEY) -> DataFrame:
    """Models cut at introns longer than ``longest``; pieces under ``least`` bases are dropped.

    Pieces are named ``<tid>.j<k>``, counted over those kept in the direction of the strand (a
    strand that is not ``-`` counts as forward); a model in one piece keeps its name.
    """
    placed = numbered(exons, key)
    w = Window.partitionBy(*key).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    pieces = placed.withColumn("piece", F.coalesce(F.sum(F.when(F.col("gap") > longest, 1).otherwise(0)).over(w), F.lit(0)))
    own = Window.partitionBy(*key, "piece")
    sized = pieces.withColumns({"bases": F.sum(_len()).over(own), "pieces": F.max("piece").over(Window.partitionBy(*key)) + 1}).where((F.col("bases") >= least) | (F.col("pieces") == 1))
    way = F.when(F.col("strand") == "-", -F.col("piece")).otherwise(F.col("piece"))
    rank = F.dense_rank().over(Window.partitionBy(*key).orderBy(way))
    name = F.when(F.col("pieces") == 1, F.col("tid")).otherwise(F.concat("tid", F.lit(".j"), rank.cast("string")))
    return sized.select(*[c for c in key if c != "tid"], name.alias("tid"), "s", "e")


def match_chain(exons: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Exons as blocks of a match with their place on the spliced target: ``t_start``, ``t_end``."""
    return numbered(exons, key).select(*key, "s", "e", (F.col("off") + 1).alias("t_start"), (F.col("off") + _len()).alias("t_end"))


def phases(parts: DataFrame, key: Sequence[str] = ("label", "pid")) -> DataFrame:
    """Coding phase of every part: the bases of the parts before it, from the 5' end, modulo 3."""
    way = F.when(F.col("strand") == "-", -F.col("e")).otherwise(F.col("s"))
    w = Window.partitionBy(*key).orderBy(way, "s", "e", "id").rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.sum(_len()).over(w), F.lit(0))
    return parts.withColumn("phase", F.pmod(3 - done % 3, F.lit(3)).cast("long"))


def orf_to_genome(exons: DataFrame, orfs: DataFrame, key: Sequence[str] = KEY, short_minus: bool = False) -> DataFrame:
    """Coding parts on the genome of frames given on the spliced transcript (``start``, ``stop``).

    Both strands cover ``stop - start + 1`` bases; ``short_minus`` drops the last base of minus
    strand frames, as some tools do.  Frames run from the transcript's 5' end.
    """
    total = Window.partitionBy(*key)
    placed = numbered(exons, key).withColumn("all", F.sum(_len()).over(total))
    forward = F.col("strand") != "-"
    off = F.when(forward, F.col("off")).otherwise(F.col("all") - F.col("off") - _len())
    placed = placed.withColumn("off5", off).select(*key, "s", "e", "off5")
    last = F.col("stop") - (F.when(F.col("strand") == "-", 1).otherwise(0) if short_minus else F.lit(0))
    both = orfs.join(placed, [c for c in key if c in orfs.columns])
    lo = F.greatest(F.col("start") - 1, F.col("off5")) - F.col("off5")
    hi = F.least(last, F.col("off5") + _len()) - F.col("off5")
    hit = both.withColumns({"lo": lo, "hi": hi}).where("lo < hi")
    return hit.select(
        *key, "orf_no",
        F.when(forward, F.col("s") + F.col("lo")).otherwise(F.col("e") - F.col("hi") + 1).alias("cds_s"),
        F.when(forward, F.col("s") + F.col("hi") - 1).otherwise(F.col("e") - F.col("lo")).alias("cds_e"),
    )


def longest_orf(orfs: DataFrame, least: int = 90, share: float = 0.5) -> DataFrame:
    """Per transcript and strand the longest frame above ``least`` and ``share`` of the length."""
    w = Window.partitionBy("id", "strand").orderBy(F.col("orflen").desc(), "frame", "start", "orf_no")
    good = orfs.where((F.col("orflen") > least) & (F.col("seqlen") > 0) & (F.col("orflen") / F.col("seqlen") > share))
    return good.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def gff_lines(exons: DataFrame, source: str = "model", key: Sequence[str] = KEY) -> DataFrame:
    """Gene, mRNA and exon lines of every model with the sort keys ``o1``..``o4`` of their file order."""
    span = exons.groupBy(*key).agg(F.min("s").alias("ms"), F.max("e").alias("me"))
    rows = exons.join(span, list(key)).withColumn("k", F.row_number().over(Window.partitionBy(*key).orderBy("s", "e")))

    def line(kind: str, s: str, e: str, attrs: Column) -> Column:
        return F.concat_ws("\t", "chrom", F.lit(source), F.lit(kind), F.col(s).cast("string"), F.col(e).cast("string"), F.lit("."), "strand", F.lit("."), attrs)

    gene = F.concat(F.lit("ID="), "tid", F.lit(".gene"))
    mrna = F.concat(F.lit("ID="), "tid", F.lit(";Parent="), "tid", F.lit(".gene"))
    exon = F.concat(F.lit("ID="), "tid", F.lit(":exon:"), F.col("k").cast("string"), F.lit(";Parent="), "tid")
    order = [F.col("chrom").alias("o1"), F.col("ms").alias("o2"), F.col("tid").alias("o3")]
    top = span.select(*order, F.lit(0).cast("long").alias("o4"), line("gene", "ms", "me", gene).alias("line"))
    mid = span.select(*order, F.lit(1).cast("long").alias("o4"), line("mRNA", "ms", "me", mrna).alias("line"))
    low = rows.select(*order, (F.col("k") + 1).cast("long").alias("o4"), line("exon", "s", "e", exon).alias("line"))
    return top.unionByName(mid).unionByName(low)


def cut_at(exons: DataFrame, points: DataFrame, least: int, key: Sequence[str] = KEY) -> DataFrame:
    """Models cut behind given bases (``cut``, from the 5' end) of the spliced transcript.

    Pieces under ``least`` bases are dropped, the others named ``<tid>.j<k>`` from the 5' end on;
    cuts off the transcript and repeated ones count for nothing.  A model without a cut, or of which
    no piece is left, stays as it is.
    """
    total = F.sum(_len()).over(Window.partitionBy(*key))
    placed = numbered(exons, key).withColumn("all", total)
    placed = placed.withColumn("off5", F.when(F.col("strand") == "-", F.col("all") - F.col("off") - _len()).otherwise(F.col("off")))
    cuts = points.select(*key, "cut").groupBy(*key).agg(F.array_sort(F.collect_set("cut")).alias("cuts"))  # a model's few cuts
    inner = F.filter("cuts", lambda c: (c > 0) & (c < F.col("all")))
    told = placed.join(cuts, list(key), "left").withColumn("cuts", F.coalesce(inner, F.array().cast("array<bigint>")))
    ends = F.concat(F.array(F.lit(0).cast("long")), F.col("cuts"), F.array(F.col("all").cast("long")))
    pieces = F.transform(F.sequence(F.lit(1), F.size(ends) - 1), lambda i: F.struct(i.alias("p"), F.element_at(ends, i).alias("from"), F.element_at(ends, i + 1).alias("to")))
    spread = told.select(*key, "s", "e", "off5", F.size("cuts").alias("n_cuts"), F.explode(pieces).alias("c"))
    lo, hi = F.greatest("c.from", "off5") - F.col("off5"), F.least(F.col("c.to"), F.col("off5") + _len()) - F.col("off5")
    own = Window.partitionBy(*key, "p")
    parts = spread.select(*key, "s", "e", "n_cuts", F.col("c.p").alias("p"), lo.alias("lo"), hi.alias("hi")).where("lo < hi").withColumn("bases", F.sum(F.col("hi") - F.col("lo")).over(own))
    kept = parts.where((F.col("n_cuts") > 0) & (F.col("bases") >= least)).withColumn("j", F.dense_rank().over(Window.partitionBy(*key).orderBy("p")))
    back = F.col("strand") == "-"
    s, e = F.when(back, F.col("e") - F.col("hi") + 1).otherwise(F.col("s") + F.col("lo")), F.when(back, F.col("e") - F.col("lo")).otherwise(F.col("s") + F.col("hi") - 1)
    rest = [c for c in key if c != "tid"]
    cut = kept.select(*rest, F.concat("tid", F.lit(".j"), F.col("j").cast("string")).alias("tid"), s.alias("s"), e.alias("e"))
    whole = exons.join(kept.select(*key).distinct(), list(key), "left_anti").select(*rest, "tid", "s", "e")
    return cut.unionByName(whole)
