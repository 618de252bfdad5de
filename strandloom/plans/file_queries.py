"""Queries that write text files and read them back as files, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.plans import annotation_queries as A
from strandloom.plans.read_queries import _NH, reads
from strandloom.operators import reads as R
from strandloom.session import shared_folder
from strandloom.sources import formats
from strandloom.sources.tables import table


def _written(df: DataFrame, line: Column, sep: str = "\n") -> str:
    """Lines in files of the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/lines-{uuid.uuid4().hex}"
    df.select(line.alias("value")).write.option("lineSep", sep).text(path)
    return path


def s10_fasta_file(spark, folder):
    """Documents as sequences in lines of 60 bases, read back by record."""
    c = A.contigs(spark, folder)
    body = F.regexp_replace("seq", "(.{60})", "$1\n")
    path = _written(c, F.concat(F.lit(">"), F.col("contig").cast("string"), F.lit(" from a document\n"), body))
    return formats.fasta_records(spark, path).select("id", "len", F.md5("seq").alias("md5"))


def s22_fasta_probe(spark, folder):
    """Whether a sequence file holds a record at all, and its first length by id."""
    path = _written(A.contigs(spark, folder), F.concat(F.lit(">"), F.col("contig").cast("string"), F.lit("\n"), F.col("seq")))
    return formats.fasta_records(spark, path).agg((F.count("*") > 0).alias("valid"))


def s1_gff_file(spark, folder):
    """Gene, mRNA and coding rows of a feature file, nothing from behind its sequence section."""
    t = table(spark, folder, "intervals")
    clean = F.regexp_replace(F.coalesce("feat_id", F.lit("")), "[;=,\t]", "_")
    out = t.select(formats.gff_line("chrom", "source", "featuretype", "start", "end_", "strand", F.concat(F.lit("ID="), clean)).alias("line"))
    more = spark.range(1).select(F.lit("##FASTA\n>c\nACGT\nchr\ts\tgene\t1\t2\t.\t+\t.\tID=lost").alias("line"))
    path = _written(out.repartition(1).unionByName(more).coalesce(1), F.col("line"))  # one file, so that the section has an end
    g = formats.gff(formats.lines(spark, path)).where("featuretype in ('gene', 'mRNA', 'CDS')")
    return g.groupBy("featuretype").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end_").alias("ends"))


def s12_junction_file(spark, folder):
    """A junction table written in nine columns and read as a file."""
    j = R.junctions(R.primary(reads(spark, folder)), 100, 600)
    path = _written(j, F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("0"), F.lit("0"), F.lit("0"), F.col("n_unique").cast("string"), F.col("n_multi").cast("string"), F.lit("0")))
    return formats.junction_table(spark, path).select("chrom", "start", "end", "n_unique", "n_multi")


def s15_threshold_file(spark, folder):
    """A list of thresholds with twelve columns, some short rows and some without a threshold."""
    t = table(spark, folder, "part")
    k, cell = F.col("p_partkey").cast("string"), F.lit("x")
    threshold = F.when(F.col("p_partkey") % 7 == 0, "-").otherwise(F.col("p_size").cast("string"))
    full = F.concat_ws("\t", k, threshold, F.lit("full"), *[cell] * 8, "p_name")
    row = F.when(F.col("p_partkey") % 11 == 0, F.concat_ws("\t", k, threshold)).otherwise(full)
    head = spark.range(1).select(F.lit("knum\tthreshold\tscore_type\ta\tb\tc\td\te\tf\tg\th\tdefinition").alias("line"))
    path = _written(head.unionByName(t.select(row.alias("line"))).coalesce(1), F.col("line"))
    return formats.ko_list(formats.lines(spark, path))


def s16_name_file(spark, folder):
    """A list of names with comments and blank lines."""
    t = table(spark, folder, "part")
    line = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("# "), "p_name")).when(F.col("p_partkey") % 7 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name"))
    return formats.named_lines(spark, _written(t, line)).groupBy("name").agg(F.count("*").alias("n"))


def s17_site_file(spark, folder):
    """Acceptor sites as feature lines; a support that is no number counts 0."""
    t = table(spark, folder, "locus_rows").where("pos is not null and chrom is not null")
    support = F.when(F.col("n_clips") % 9 == 0, "many").otherwise(F.coalesce(F.col("n_clips").cast("string"), F.lit(".")))
    strand = F.when(F.col("side") == "5p", "+").otherwise("-")
    path = _written(t, F.concat_ws("\t", "chrom", F.lit("sites"), F.lit("acceptor"), F.col("pos").cast("string"), F.col("pos").cast("string"), support, strand, F.lit("."), F.concat(F.lit("ID=sl"), F.col("locus_id").cast("string"))))
    g = formats.gff(formats.lines(spark, path))
    return g.select(F.col("seqid").alias("chrom"), F.col("start").alias("pos"), "strand", F.coalesce(F.expr("try_cast(score as bigint)"), F.lit(0)).alias("support"))


QUERIES = {f.__name__: f for f in (s1_gff_file, s10_fasta_file, s12_junction_file, s15_threshold_file, s16_name_file, s17_site_file, s22_fasta_probe)}
ORACLES = {
    "s10_fasta_file": f"WITH {A._CT} SELECT CAST(contig AS VARCHAR) AS id, length(seq) AS len, md5(seq) AS md5 FROM ct",
    "s22_fasta_probe": f"WITH {A._CT} SELECT count(*) > 0 AS valid FROM ct",
    "s1_gff_file": "SELECT featuretype, count(*) AS n, CAST(sum(start) AS BIGINT) AS starts, CAST(sum(end_) AS BIGINT) AS ends FROM intervals WHERE start IS NOT NULL AND end_ IS NOT NULL AND featuretype IN ('gene', 'mRNA', 'CDS') GROUP BY 1",
    "s12_junction_file": _NH + ' SELECT chrom, pos0 + q + 1 AS start, pos0 + q + n AS "end", count(*) FILTER (nh <= 1) AS n_unique, count(*) FILTER (nh > 1) AS n_multi FROM r WHERE n BETWEEN 100 AND 600 GROUP BY 1, 2, 3',
    "s15_threshold_file": "SELECT CAST(p_partkey AS VARCHAR) AS k, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS threshold, 'full' AS score_type, p_name AS definition FROM part WHERE p_partkey % 11 <> 0",
    "s16_name_file": "SELECT trim(p_name) AS name, count(*) AS n FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 GROUP BY 1",
    "s17_site_file": "SELECT chrom, pos, CASE WHEN side = '5p' THEN '+' ELSE '-' END AS strand, CASE WHEN n_clips % 9 = 0 THEN 0 ELSE coalesce(n_clips, 0) END AS support FROM locus_rows WHERE pos IS NOT NULL AND chrom IS NOT NULL",
}
