"""Text formats of features, sequences, alignments and junctions, read as tables.

Every reader takes a frame of lines (``line``, and ``line_no`` where the order counts), so that the same
code serves files, through :func:`lines`, and tables of lines.  Malformed rows are left out, never fatal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.text import attributes


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their ``file`` and their order in it, ``line_no``.

    Files are split as Spark splits them.  ``line_no`` is a pair, where the line's block begins and a
    running number within it: it compares as line numbers do, without reading a file in one task.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("k"))
    return text.select("file", F.struct("block", "k").alias("line_no"), F.regexp_replace("value", r"\r$", "").alias("line"))


def gff(df: DataFrame) -> DataFrame:
    """Feature lines as columns; comments, short lines and lines without whole numbers are left out.

    What follows ``##FASTA`` is no feature; where a file name is given it is asked per file.
    """
    if "line_no" in df.columns:
        keys = ["file"] if "file" in df.columns else []
        stops = df.where(F.col("line").startswith("##FASTA")).groupBy(*keys).agg(F.min("line_no").alias("_stop"))  # one row per file
        df = (df.join(stops, keys, "left") if keys else df.join(stops, how="cross")).where("_stop is null or line_no < _stop").drop("_stop")
    part = lambda i: F.element_at("f", i)
    cells = df.withColumn("f", F.split("line", "\t")).where(~F.col("line").startswith("#") & (F.size("f") >= 9))
    keep = [c for c in df.columns if c != "line"]
    out = cells.select(
        *keep, part(1).alias("seqid"), part(2).alias("source"), part(3).alias("featuretype"), F.expr("try_cast(element_at(f, 4) as bigint)").alias("start"), F.expr("try_cast(element_at(f, 5) as bigint)").alias("end_"),
        part(6).alias("score"), part(7).alias("strand"), part(8).alias("frame"), attributes(part(9)).alias("attributes"),
    )
    return out.where("start is not null and end_ is not null")


def gff_line(seqid: str, source: str, kind: str, start: str, end: str, strand: str, attrs: Column) -> Column:
    """One feature as a line."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    return F.concat_ws("\t", dot(seqid), dot(source), dot(kind), dot(start), dot(end), F.lit("."), dot(strand), F.lit("."), attrs)


def fasta_records(spark: SparkSession, path: str) -> DataFrame:
    """Sequences of files by id (the header's first word): ``id``, ``seq``, ``len``.

    Files are split at ``>`` at the start of a line, so each record is a row wherever it lies.
    """
    records = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"^>", "").alias("r")).where("r <> ''")
    seq = F.regexp_replace(F.regexp_replace("r", r"^[^\n]*\n?", ""), r"\s", "")
    return records.select(F.regexp_extract("r", r"^(\S+)", 1).alias("id"), seq.alias("seq"), F.length(seq).cast("long").alias("len"))


def named_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lists of names: lines that are neither blank nor comments."""
    return spark.read.text(path).select(F.btrim("value").alias("name")).where("name <> '' and not startswith(name, '#')")


def sam(df: DataFrame) -> DataFrame:
    """Alignment lines as reads; ``pos0`` is 0-based, ``*`` becomes null, ``nh`` comes from its tag."""
    part = lambda i: F.element_at("f", i)
    cells = df.withColumn("f", F.split("line", "\t")).where(~F.col("line").startswith("@") & (F.size("f") >= 11))
    star = lambda i: F.nullif(part(i), F.lit("*"))
    return cells.select(
        part(1).alias("qname"), F.expr("try_cast(element_at(f, 2) as int)").alias("flag"), star(3).alias("chrom"), (F.expr("try_cast(element_at(f, 4) as bigint)") - 1).alias("pos0"), F.expr("try_cast(element_at(f, 5) as int)").alias("mapq"),
        star(6).alias("cigar"), star(10).alias("seq"), F.expr(r"try_cast(nullif(regexp_extract(line, '\tNH:i:([0-9]+)', 1), '') as int)").alias("nh"),
    ).where("flag is not null and pos0 is not null")


SJ = "chrom string, start long, end long, strand int, motif int, annotated int, n_unique long, n_multi long, max_overhang int"


def junction_table(spark: SparkSession, path: str) -> DataFrame:
    """A nine-column junction table; rows that do not fit come as nulls and are left out."""
    return spark.read.csv(path, sep="\t", schema=SJ, mode="PERMISSIVE").where("start is not null and end is not null")


def ko_list(df: DataFrame) -> DataFrame:
    """Thresholds of protein families: rows with twelve columns, ``-`` or nothing as no threshold; the last of repeated ids wins."""
    part = lambda i: F.element_at("f", i)
    first = df.agg(F.min("line_no").alias("_first"))  # the header: one row
    cells = df.crossJoin(F.broadcast(first)).where("line_no > _first").withColumn("f", F.split("line", "\t")).where(F.size("f") >= 12)
    rows = cells.select("line_no", part(1).alias("k"), F.expr("try_cast(nullif(element_at(f, 2), '-') as double)").alias("threshold"), part(3).alias("score_type"), part(12).alias("definition"))
    return rows.groupBy("k").agg(*[F.max_by(c, "line_no").alias(c) for c in ("threshold", "score_type", "definition")])
