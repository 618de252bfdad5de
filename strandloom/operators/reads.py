"""Aligned reads: walks over CIGAR operations, junction tables, clips and splitting.

Reads have ``qname``, ``flag``, ``chrom``, ``pos0`` (0-based), ``cigar`` (text) and ``seq``.  Introns are
0-based half-open (``start0``, ``end0x``), blocks 1-based inclusive (``s``, ``e``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.sequence import reverse_complement

UNMAPPED, REVERSE, SECONDARY, SUPPLEMENTARY = 0x4, 0x10, 0x100, 0x800
#: Flags of pairing that a piece of a read loses.
PAIRING = 0x1 | 0x2 | 0x8 | 0x20 | 0x40 | 0x80
#: Junction codes by donor-acceptor pair.
MOTIF_CODES = {"GT-AG": 1, "CT-AC": 2, "GC-AG": 3, "CT-GC": 4, "AT-AC": 5, "GT-AT": 6}


def primary(df: DataFrame, min_mapq: int = 0) -> DataFrame:
    """Mapped primary alignments of quality ``min_mapq`` or more, with a CIGAR and a sequence."""
    return df.where((F.col("flag").bitwiseAND(UNMAPPED | SECONDARY | SUPPLEMENTARY) == 0) & (F.col("mapq") >= min_mapq) & F.col("cigar").isNotNull() & F.col("seq").isNotNull())


def operations(cigar: Column) -> Column:
    """A CIGAR text as a list of (``len``, ``op``); null and ``*`` give an empty list."""
    texts = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"(\d+[MIDNSHP=X])"), 1)
    return F.transform(texts, lambda t: F.struct(F.regexp_extract(t, r"\d+", 0).cast("long").alias("len"), F.right(t, F.lit(1)).alias("op")))


REFERENCE_OPS, READ_OPS = ["M", "D", "N", "=", "X"], ["M", "I", "S", "=", "X"]


def _eaten(o: Column, which: list[str]) -> Column:
    return F.when(o["op"].isin(*which), o["len"]).otherwise(F.lit(0).cast("long"))


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that a read spans."""
    return F.aggregate(operations(cigar), F.lit(0).cast("long"), lambda n, o: n + _eaten(o, REFERENCE_OPS))


def picked(cigar: Column, pos0: Column, want: Callable[[Column], Column]) -> Column:
    """The operations that ``want`` keeps, each with the place on the reference (``at``) and on the read (``q``) where it begins.

    One pass that carries both places along and gathers only what is kept: work in proportion to the
    list's length as long as few operations are kept, as skips, clips and long insertions are.
    """
    kind = "array<struct<op:string,len:bigint,at:bigint,q:bigint>>"
    none = F.struct(pos0.cast("long").alias("at"), F.lit(0).cast("long").alias("q"), F.array().cast(kind).alias("out"))

    def step(acc: Column, o: Column) -> Column:
        cell = F.struct(o["op"].alias("op"), o["len"].alias("len"), acc["at"].alias("at"), acc["q"].alias("q"))
        out = F.when(want(o), F.concat(acc["out"], F.array(cell)).cast(kind)).otherwise(acc["out"])
        return F.struct((acc["at"] + _eaten(o, REFERENCE_OPS)).alias("at"), (acc["q"] + _eaten(o, READ_OPS)).alias("q"), out.alias("out"))

    return F.aggregate(operations(cigar), none, step, lambda acc: acc["out"])


def with_read(df: DataFrame) -> DataFrame:
    """Reads with ``read``, a number of their own: mates and places of one name are reads of their own."""
    return df if "read" in df.columns else df.withColumn("read", F.monotonically_increasing_id())


def introns(df: DataFrame, *keep: str) -> DataFrame:
    """Skipped stretches of every read, with the columns ``keep``."""
    skips = df.where(F.contains("cigar", F.lit("N"))).select("qname", "chrom", "flag", *keep, F.explode(picked(F.col("cigar"), F.col("pos0"), lambda o: o["op"] == "N")).alias("o"))
    return skips.select("qname", "chrom", "flag", *keep, F.col("o.at").alias("start0"), (F.col("o.at") + F.col("o.len")).alias("end0x"))


def blocks(df: DataFrame) -> DataFrame:
    """Exon blocks of every read, cut where it skips; blocks without aligned bases are left out.

    A read's blocks are found in one pass over its operations, so nothing is shuffled and reads of
    one name stay apart.
    """
    kind = "array<struct<s:bigint,e:bigint>>"
    unset = F.lit(None).cast("long")
    none = F.struct(F.col("pos0").cast("long").alias("at"), unset.alias("s"), unset.alias("e"), F.array().cast(kind).alias("out"))
    closed = lambda acc: F.when(acc["s"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct((acc["s"] + 1).alias("s"), acc["e"].alias("e")))).cast(kind))

    def step(acc: Column, o: Column) -> Column:
        skip, aligned, end = o["op"] == "N", o["op"].isin("M", "=", "X", "D"), acc["at"] + _eaten(o, REFERENCE_OPS)
        s = F.when(skip, unset).when(aligned, F.coalesce(acc["s"], acc["at"])).otherwise(acc["s"])
        e = F.when(skip, unset).when(aligned, end).otherwise(acc["e"])
        return F.struct(end.alias("at"), s.alias("s"), e.alias("e"), F.when(skip, closed(acc)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(operations(F.col("cigar")), none, step, closed)
    return df.select("qname", "chrom", F.explode(found).alias("b")).select("qname", "chrom", "b.s", "b.e")


def junctions(df: DataFrame, shortest: int, longest: int) -> DataFrame:
    """Junction table: ``chrom``, ``start`` (1-based), ``end``, ``n_unique``, ``n_multi``; ``nh`` counts a read's places.

    A read without ``nh`` counts as unique; each read counts for itself, also mates of one name.
    ``longest`` of 0 or less sets no bound.
    """
    i = introns(df if "nh" in df.columns else df.withColumn("nh", F.lit(1)), "nh")
    length = F.col("end0x") - F.col("start0")
    good = i.where((length >= shortest) & ((length <= longest) if longest > 0 else F.lit(True)))
    return good.groupBy("chrom", (F.col("start0") + 1).alias("start"), F.col("end0x").alias("end")).agg(F.count_if(F.coalesce("nh", F.lit(1)) <= 1).alias("n_unique"), F.count_if(F.col("nh") > 1).alias("n_multi"))


def motif_code(pair: Column) -> Column:
    """Code of a junction's donor-acceptor pair, 0 for any other or none."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in MOTIF_CODES.items() for x in kv]), pair), F.lit(0))


def motif_strand(code: Column) -> Column:
    """Strand code of a motif code: 1 for the odd ones, forward, 2 for the even ones, 0 without."""
    return F.when(code == 0, 0).when(code % 2 == 1, 1).otherwise(2)


def clips(df: DataFrame, least: int) -> DataFrame:
    """Soft clips of ``least`` bases or more, in the direction of the transcript.

    A leading clip of a forward read is ``5p`` at the first aligned base; of a reverse read it is
    ``3p`` and the other strand is given; trailing clips the other way round, at the last base.
    """
    w = df.withColumns({"ops": operations(F.col("cigar")), "end0x": F.col("pos0") + reference_length(F.col("cigar"))}).where("size(ops) > 0")
    reverse = F.col("flag").bitwiseAND(REVERSE) != 0
    first, last = F.element_at("ops", 1), F.element_at("ops", -1)
    lead = F.when((first["op"] == "S") & (first["len"] >= least), F.struct(F.when(reverse, "3p").otherwise("5p").alias("side"), F.left("seq", first["len"].cast("int")).alias("clip"), F.col("pos0").alias("anchor")))
    trail = F.when((last["op"] == "S") & (last["len"] >= least), F.struct(F.when(reverse, "5p").otherwise("3p").alias("side"), F.right("seq", last["len"].cast("int")).alias("clip"), (F.col("end0x") - 1).alias("anchor")))
    rows = w.select("qname", "chrom", reverse.alias("rev"), F.explode(F.array_compact(F.array(lead, trail))).alias("c"))
    return rows.select("qname", "chrom", "c.side", "c.anchor", F.when(F.col("rev"), reverse_complement(F.col("c.clip"))).otherwise(F.col("c.clip")).alias("clip"))


def split_long(df: DataFrame, longest: int) -> DataFrame:
    """Reads with a skip over ``longest`` as pieces of their own, the rest of each clipped.

    Pieces without aligned bases are dropped before numbering; secondary, supplementary and hard
    clipped reads, and reads without such a skip, give no rows here.
    """
    cut = lambda o: (o["op"] == "N") & (o["len"] > longest)
    w = df.withColumn("ops", operations(F.col("cigar"))).where((F.col("flag").bitwiseAND(SECONDARY | SUPPLEMENTARY) == 0) & ~F.exists("ops", lambda o: o["op"] == "H") & F.exists("ops", cut))
    w = with_read(w).select("read", "qname", "flag", "chrom", F.col("pos0").cast("long").alias("from0"), F.length("seq").cast("long").alias("total"), F.posexplode("ops").alias("i", "o"))
    upto = Window.partitionBy("read").orderBy("i")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    sums = {"at": F.sum(_eaten(F.col("o"), REFERENCE_OPS)).over(before), "q": F.sum(_eaten(F.col("o"), READ_OPS)).over(before), "piece": F.sum(F.when(cut(F.col("o")), 1).otherwise(0)).over(upto)}
    rows = w.withColumns(sums).withColumns({"at": F.col("from0") + F.coalesce("at", F.lit(0)), "q": F.coalesce("q", F.lit(0))}).where(~cut(F.col("o")))
    eats = F.when(F.col("o.op").isin("M", "I", "S", "=", "X"), F.col("o.len")).otherwise(0)
    parts = rows.groupBy("read", "qname", "flag", "chrom", "total", "piece").agg(
        F.min("at").alias("pos0"), F.min("q").alias("before"), F.sum(eats).alias("inside"), F.max(F.col("o.op").isin("M", "=", "X")).alias("aligned"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "o.len", "o.op"))), lambda x: F.concat(x["len"].cast("string"), x["op"])), "").alias("mid"),
    ).where("aligned")
    after = F.col("total") - F.col("before") - F.col("inside")
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise("")
    k = F.row_number().over(Window.partitionBy("read").orderBy("piece")) - 1
    return parts.select(F.concat("qname", F.lit("."), k.cast("string")).alias("qname"), F.col("flag").bitwiseAND(~PAIRING).alias("flag"), "chrom", "pos0", F.concat(clip(F.col("before")), "mid", clip(after)).alias("cigar"))
