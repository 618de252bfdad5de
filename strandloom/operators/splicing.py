"""Splice pairs, strands and loci: what reads say about donor, acceptor and clip sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.sequence import hamming, reverse_complement
from strandloom.operators.contigs import parts_at
from strandloom.operators.reads import REVERSE, operations, picked, reference_length

CANONICAL = ["GT-AG", "CT-AC"]
#: Tracked keys of a locus, tolerated differences of a key, share that has to agree.
TRACKED, TOLERATED, AGREE = 5, 2, 0.95


def splice_pairs(introns: DataFrame, contigs: DataFrame) -> DataFrame:
    """Add ``pair``, the first and last two bases of each intron; null off the contig or without one.

    ``introns`` has ``contig``, ``start0``, ``end0x``; ``contigs`` has ``contig`` and ``seq``.  Different introns are
    looked up once, in windows of the contigs, so no task holds a contig whole.
    """
    place = ["contig", "start0", "end0x"]
    known = introns.where("start0 >= 0 and end0x - start0 >= 4 and contig is not null").select(*place).distinct()
    ends = F.array(F.struct(F.lit(0).alias("side"), (F.col("start0") + 1).alias("s"), (F.col("start0") + 2).alias("e")), F.struct(F.lit(1).alias("side"), (F.col("end0x") - 1).alias("s"), F.col("end0x").alias("e")))
    parts = parts_at(known.select(*place, F.inline(ends)), contigs).where("part <> ''")
    text = F.upper(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("side", "w", "part"))), lambda x: x["part"]), ""))  # two bases a side
    read = parts.groupBy(*place).agg(text.alias("t")).where("length(t) = 4")
    return introns.join(read.select(*place, F.concat_ws("-", F.left("t", F.lit(2)), F.right("t", F.lit(2))).alias("pair")), place, "left")


def pair_histogram(pairs: DataFrame) -> DataFrame:
    """Introns by pair, with their share; introns without a pair stay in the denominator."""
    every = pairs.agg(F.count("*").alias("all"))
    return pairs.groupBy("pair").agg(F.count("*").alias("n")).crossJoin(F.broadcast(every)).withColumn("share", F.col("n") / F.col("all")).drop("all")


def flipped(pair: Column) -> Column:
    """A pair as the other strand reads it."""
    return F.concat_ws("-", reverse_complement(F.substring_index(pair, "-", -1)), reverse_complement(F.substring_index(pair, "-", 1)))


def calibrated_pair(pairs: DataFrame, least: int = 50) -> DataFrame:
    """The commonest coding-strand pair if ``least`` introns have it, else GT-AG: one row, ``consensus``."""
    coding = F.when(F.col("strand") == "-", flipped(F.col("pair"))).otherwise(F.col("pair"))
    counts = pairs.where("pair is not null").groupBy(coding.alias("p")).agg(F.count("*").alias("n"))
    best = counts.agg(F.max(F.struct("n", F.col("p"))).alias("b"))
    return best.select(F.when(F.col("b.n") >= least, F.col("b.p")).otherwise("GT-AG").alias("consensus"))


def strand_votes(pairs: DataFrame, by: str, consensus: str = "GT-AG") -> DataFrame:
    """Per transcript the strand its introns speak for: ``+``, ``-``, or ``ambiguous`` on a tie."""
    other = consensus.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    votes = pairs.groupBy(by).agg(F.count_if(F.col("pair") == consensus).alias("plus"), F.count_if(F.col("pair") == other).alias("minus"))
    return votes.withColumn("strand", F.when(F.col("plus") > F.col("minus"), "+").when(F.col("minus") > F.col("plus"), "-").otherwise("ambiguous"))


def acceptor_ops(reads: DataFrame, min_clip: int, min_insertion: int) -> DataFrame:
    """Acceptor candidates: ``qname``, ``chrom``, ``pos`` (1-based), ``strand``, ``bases`` of the reference strand.

    Leading clips speak for ``+`` at the first aligned base, trailing ones for ``-`` at the last;
    insertions within a read by its own strand.
    """
    w = reads.where("seq is not null").withColumns({"ops": operations(F.col("cigar")), "end0x": F.col("pos0") + reference_length(F.col("cigar"))}).where("size(ops) > 0")
    first, last = F.element_at("ops", 1), F.element_at("ops", -1)
    end = F.col("end0x")
    cell = lambda pos, strand, bases: F.struct(pos.cast("long").alias("pos"), strand.alias("strand"), bases.alias("bases"))
    lead = F.when((first["op"] == "S") & (first["len"] >= min_clip), cell(F.col("pos0") + 1, F.lit("+"), F.left("seq", first["len"].cast("int"))))
    trail = F.when((last["op"] == "S") & (last["len"] >= min_clip), cell(end, F.lit("-"), F.right("seq", last["len"].cast("int"))))
    rev = F.col("flag").bitwiseAND(REVERSE) != 0
    held = picked(F.col("cigar"), F.col("pos0"), lambda o: (o["op"] == "I") & (o["len"] >= min_insertion))
    length = F.aggregate("ops", F.lit(0).cast("long"), lambda n, o: n + F.when(o["op"].isin("M", "I", "S", "=", "X"), o["len"]).otherwise(0))
    first_i = (first["op"] == "I") & (first["len"] >= min_insertion)
    inner = F.filter(held, lambda o: ~(((o["q"] == 0) & first_i) | ((last["op"] == "I") & (o["q"] + o["len"] == length))))  # within the read
    inserted = F.transform(inner, lambda o: cell(F.when(rev, o["at"]).otherwise(o["at"] + 1), F.when(rev, "-").otherwise("+"), F.substr("seq", (o["q"] + 1).cast("int"), o["len"].cast("int"))))
    return w.select("qname", "chrom", F.explode(F.concat(F.array_compact(F.array(lead, trail)), inserted)).alias("o")).select("qname", "chrom", "o.pos", "o.strand", "o.bases")


def locus_status(clips: DataFrame, locus: list[str], k: int = 12, cap: int | None = TRACKED) -> DataFrame:
    """Status of each locus from its clips (``clip``, ``side``, ``ord``): ``status``, ``motif_key``, ``n_clips``.

    A locus of one clip is a *singleton*.  Of the anchored keys of ``k`` letters the first ``cap``
    different ones by ``ord`` are tracked, with None all; the commonest (ties: the first) rules.  *consistent*: the
    shorter clips fit it, and keys within two letters of it hold 95 % of the tracked clips; else
    *inconsistent*.  Without any key: *short_only* if the shorter clips fit the longest of them.
    Counts per key come first, so what a locus gathers is its different keys, not its clips.
    """
    rows = clips.where("clip is not null and side is not null").withColumn("key", F.when(F.length("clip") >= k, F.when(F.col("side") == "5p", F.right(F.upper("clip"), F.lit(k))).otherwise(F.left(F.upper("clip"), F.lit(k)))).otherwise(F.upper("clip")))
    keys = rows.groupBy(*locus, "side", "key").agg(F.count("*").alias("n"), F.min("ord").alias("ord"))
    rank = F.row_number().over(Window.partitionBy(*locus, "side", F.length("key") >= k).orderBy("ord", "key"))
    long = F.length("key") >= k
    kept = keys.withColumn("rank", rank).where(~long | (F.col("rank") <= cap) if cap is not None else F.lit(True))
    total = keys.groupBy(*locus, "side").agg(F.sum("n").alias("n_clips"))
    rule = kept.groupBy(*locus, "side").agg(
        F.max_by(F.when(long, F.col("key")), F.when(long, F.struct("n", -F.col("rank")))).alias("rule"),
        F.max_by(F.when(~long, F.col("key")), F.when(~long, F.struct(F.length("key"), -F.col("rank")))).alias("longest"),
    )
    told = kept.join(rule, [*locus, "side"])
    against = F.coalesce("rule", "longest")
    fits = F.when(F.col("side") == "5p", F.endswith(against, F.col("key"))).otherwise(F.startswith(against, F.col("key")))
    near = long & (hamming(F.col("key"), F.col("rule")) <= TOLERATED)
    facts = told.groupBy(*locus, "side", "rule").agg(
        F.sum(F.when(long, F.col("n"))).alias("tracked"), F.sum(F.when(near, F.col("n"))).alias("near"), F.count_if(~long & ~fits).alias("misfits")
    )
    status = (
        F.when(F.col("n_clips") == 1, "singleton")
        .when(F.col("misfits") > 0, "inconsistent")
        .when(F.col("rule").isNull(), "short_only")
        .when(F.coalesce("near", F.lit(0)) < AGREE * F.col("tracked"), "inconsistent")
        .otherwise("consistent")
    )
    return facts.join(total, [*locus, "side"]).withColumn("status", status).select(*locus, "side", "n_clips", "status", F.when(F.col("status") == "consistent", F.col("rule")).otherwise("").alias("motif_key"))


def fragment_spans(mates: DataFrame, shortest: int = 100, longest: int = 500) -> DataFrame:
    """Spans of mates paired in order within reference and name: ``ref``, ``qname``, ``lend``, ``rend`` (1-based).

    ``mates`` has ``ref``, ``qname``, ``pos0``, ``end0x``, ``ord``; the first and second, third and fourth mate of a
    name are pairs, one left over is dropped.  Where ``flag`` is given only proper pairs count.
    """
    mates = mates.where(F.col("flag").bitwiseAND(0x2) != 0) if "flag" in mates.columns else mates
    pair = F.floor((F.row_number().over(Window.partitionBy("ref", "qname").orderBy("ord")) - 1) / 2)
    spans = mates.withColumn("pair", pair).groupBy("ref", "qname", "pair").agg(F.count("*").alias("n"), (F.min("pos0") + 1).alias("lend"), F.max("end0x").alias("rend"))
    return spans.where((F.col("n") == 2) & (F.col("rend") - F.col("lend") + 1).between(shortest, longest)).select("ref", "qname", "lend", "rend")
