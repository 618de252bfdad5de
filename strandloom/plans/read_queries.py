"""Queries on reads and text formats, with their SQL.

Reads are made of line items, one per order line: a clip, a match, a skip, a match, a clip.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import reads as R
from strandloom.sources import formats
from strandloom.sources.tables import table

READ_SQL = """SELECT concat(l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) AS qname, CASE WHEN l_suppkey % 2 = 0 THEN 0 ELSE 16 END AS flag, concat('chr', l_suppkey % 7) AS chrom,
  (l_partkey % 500) * 100 AS pos0, CAST(l_quantity AS BIGINT) AS q, l_linenumber * 4 AS c, (l_partkey % 13) * 50 + 20 AS n, CAST(l_discount * 100 AS BIGINT) % 3 AS nh FROM lineitem"""


def reads(spark, folder):
    """Reads of line items, as alignment rows; repeated ones once.

    Numbers are grouped and texts made afterwards, so that the grouping hashes rows of fixed width.
    """
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    nh = (F.round(F.col("l_discount") * 100).cast("long") % 3).cast("int")
    t = table(spark, folder, "lineitem").groupBy(*key).agg(F.min(F.col("l_quantity").cast("long")).alias("q"), F.min(nh).alias("nh"))
    q, c, n = F.col("q"), F.col("l_linenumber") * 4, (F.col("l_partkey") % 13) * 50 + 20
    txt = lambda x, op: F.concat(x.cast("string"), F.lit(op))
    return t.select(
        F.concat_ws("_", *key).alias("qname"), F.when(F.col("l_suppkey") % 2 == 0, 0).otherwise(16).alias("flag"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 7).cast("string")).alias("chrom"),
        ((F.col("l_partkey") % 500) * 100).alias("pos0"), F.lit(60).alias("mapq"), F.concat(txt(c, "S"), txt(q, "M"), txt(n, "N"), txt(q + 5, "M")).alias("cigar"), "nh", F.left(F.repeat(F.lit("ACGTN"), F.lit(60)), (c + 2 * q + 5).cast("int")).alias("seq"),
    )


def w21_introns(spark, folder):
    """Skipped stretches of all reads."""
    return R.introns(R.primary(reads(spark, folder))).select("qname", "chrom", "start0", "end0x")


def w22_blocks(spark, folder):
    """Exon blocks of all reads."""
    return R.blocks(R.primary(reads(spark, folder))).select("qname", "chrom", "s", "e")


def w24_clips(spark, folder):
    """Clips of eight bases or more."""
    return R.clips(R.primary(reads(spark, folder)), 8)


def w20_split_reads(spark, folder):
    """Reads with a skip over 400 bases, in pieces."""
    return R.split_long(reads(spark, folder), 400)


def a9_junctions(spark, folder):
    """Junctions of 100 to 600 bases with their unique and repeated reads."""
    return R.junctions(R.primary(reads(spark, folder)), 100, 600)


def pr11_intron_hints(spark, folder):
    """Junctions as hint lines."""
    j = R.junctions(R.primary(reads(spark, folder)), 100, 600)
    return j.select(F.concat_ws("\t", "chrom", F.lit("b2h"), F.lit("intron"), F.col("start").cast("string"), F.col("end").cast("string"), F.lit("0"), F.lit("."), F.lit("."), F.format_string("mult=%d;pri=4;src=E", F.col("n_unique") + F.col("n_multi"))).alias("line"))


def s8_sam_lines(spark, folder):
    """Reads written as alignment lines and read back: reads and bases by chromosome."""
    r = reads(spark, folder)
    out = r.select(F.concat_ws("\t", "qname", F.col("flag").cast("string"), "chrom", (F.col("pos0") + 1).cast("string"), F.lit("60"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", F.lit("*"), F.format_string("NH:i:%d", "nh")).alias("line"))
    return R.primary(formats.sam(out)).groupBy("chrom").agg(F.count("*").alias("n"), F.sum(F.length("seq")).cast("long").alias("bases"), F.sum("pos0").alias("pos0"), F.sum("nh").alias("nh"))


def s2_gff_lines(spark, folder):
    """Feature rows written as lines and read back: rows, ids and coordinates by type."""
    t = table(spark, folder, "intervals")
    clean = F.regexp_replace(F.coalesce("feat_id", F.lit("")), "[;=,\t]", "_")
    attrs = F.concat(F.lit("ID="), clean, F.lit(";Name="), clean)
    out = t.select(formats.gff_line("chrom", "source", "featuretype", "start", "end_", "strand", attrs).alias("line"))
    g = formats.gff(out)
    name = F.element_at(F.element_at("attributes", F.lit("ID")), 1)
    return g.groupBy("featuretype").agg(F.count("*").alias("n"), F.count_distinct(name).alias("n_ids"), F.sum("start").alias("starts"), F.sum("end_").alias("ends"))


_R = f"WITH r0 AS ({READ_SQL}), r AS (SELECT qname, min(flag) AS flag, min(chrom) AS chrom, min(pos0) AS pos0, min(q) AS q, min(c) AS c, min(n) AS n FROM r0 GROUP BY 1)"
QUERIES = {f.__name__: f for f in (w20_split_reads, w21_introns, w22_blocks, w24_clips, a9_junctions, pr11_intron_hints, s8_sam_lines, s2_gff_lines)}
_SEQ = "left(repeat('ACGTN', 60), c + 2 * q + 5)"
ORACLES = {
    "w21_introns": _R + " SELECT qname, chrom, pos0 + q AS start0, pos0 + q + n AS end0x FROM r",
    "w22_blocks": _R + " SELECT qname, chrom, pos0 + 1 AS s, pos0 + q AS e FROM r UNION ALL SELECT qname, chrom, pos0 + q + n + 1, pos0 + 2 * q + n + 5 FROM r",
    "w24_clips": _R + f" SELECT qname, chrom, CASE WHEN flag = 16 THEN '3p' ELSE '5p' END AS side, pos0 AS anchor, CASE WHEN flag = 16 THEN reverse(translate(left({_SEQ}, c), 'ACGTN', 'TGCAN')) ELSE left({_SEQ}, c) END AS clip FROM r WHERE c >= 8",
    "w20_split_reads": _R + """ SELECT qname || '.0' AS qname, flag, chrom, pos0, concat(c, 'S', q, 'M', q + 5, 'S') AS cigar FROM r WHERE n > 400
      UNION ALL SELECT qname || '.1', flag, chrom, pos0 + q + n, concat(c + q, 'S', q + 5, 'M') FROM r WHERE n > 400""",
    "s2_gff_lines": """WITH g AS (SELECT featuretype, start, end_, regexp_replace(coalesce(feat_id, ''), '[;=,\t]', '_', 'g') AS id FROM intervals WHERE start IS NOT NULL AND end_ IS NOT NULL)
      SELECT featuretype, count(*) AS n, count(DISTINCT trim(id)) AS n_ids, CAST(sum(start) AS BIGINT) AS starts, CAST(sum(end_) AS BIGINT) AS ends FROM g GROUP BY 1""",
}
_NH = f"WITH r AS (SELECT qname, min(chrom) AS chrom, min(flag) AS flag, min(pos0) AS pos0, min(q) AS q, min(c) AS c, min(n) AS n, min(nh) AS nh FROM ({READ_SQL.replace('CAST(l_discount * 100 AS BIGINT) % 3', 'CAST(round(l_discount * 100) AS BIGINT) % 3')}) GROUP BY 1)"
ORACLES["a9_junctions"] = _NH + ' SELECT chrom, pos0 + q + 1 AS start, pos0 + q + n AS "end", count(*) FILTER (nh <= 1) AS n_unique, count(*) FILTER (nh > 1) AS n_multi FROM r WHERE n BETWEEN 100 AND 600 GROUP BY 1, 2, 3'
ORACLES["pr11_intron_hints"] = _NH + " SELECT concat_ws(chr(9), chrom, 'b2h', 'intron', pos0 + q + 1, pos0 + q + n, '0', '.', '.', 'mult=' || count(*) || ';pri=4;src=E') AS line FROM r WHERE n BETWEEN 100 AND 600 GROUP BY chrom, pos0, q, n"
ORACLES["s8_sam_lines"] = _NH + " SELECT chrom, count(*) AS n, CAST(sum(c + 2 * q + 5) AS BIGINT) AS bases, CAST(sum(pos0) AS BIGINT) AS pos0, CAST(sum(nh) AS BIGINT) AS nh FROM r GROUP BY 1"
