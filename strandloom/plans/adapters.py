"""The feature tables that the comparison queries start from, in DataFrames and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions.ids import feature_id
from strandloom.plans.problem1 import ID_SQL
from strandloom.sources.tables import table

REFERENCE = "gawenka_ref"


def rows(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows with usable ids, bounds and strands: label, id, pid, chrom, strand, s, e, kind."""
    t = table(spark, folder, "intervals").where("start is not null and end_ is not null and strand in ('+', '-', '.') and chrom is not null")
    return t.select(
        F.col("annot_id").alias("label"), feature_id(F.col("feat_id")).alias("id"), feature_id(F.col("parent_id")).alias("pid"), "chrom", "strand",
        F.least("start", "end_").alias("s"), F.greatest("start", "end_").alias("e"), F.col("featuretype").alias("kind"), "loaded_at", "row_id",
    ).where("id is not null")


def whole(spark: SparkSession, folder: str, *kinds: str) -> DataFrame:
    """One row per label and id: the latest one delivered."""
    w = Window.partitionBy("label", "id").orderBy(F.col("loaded_at").desc_nulls_last(), F.col("row_id").desc())
    return rows(spark, folder).where(F.col("kind").isin(*kinds)).withColumn("k", F.row_number().over(w)).where("k = 1").drop("k", "loaded_at", "row_id")


def parts(spark: SparkSession, folder: str, *kinds: str) -> DataFrame:
    """Different rows of features that may take several: exons or coding parts of a parent."""
    return rows(spark, folder).where(F.col("kind").isin(*kinds) & F.col("pid").isNotNull()).select("label", "pid", "id", "chrom", "strand", "s", "e", "kind").distinct()


FEATURES_SQL = """
fr AS (
  SELECT annot_id AS label, {feat} AS id, {parent} AS pid, chrom, strand, least(start, end_) AS s, greatest(start, end_) AS e, featuretype AS kind, loaded_at, row_id
  FROM intervals WHERE start IS NOT NULL AND end_ IS NOT NULL AND strand IN ('+', '-', '.') AND chrom IS NOT NULL AND {feat} IS NOT NULL),
fw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label, id, kind ORDER BY loaded_at DESC NULLS LAST, row_id DESC) AS k FROM fr) WHERE k = 1),
fp AS (SELECT DISTINCT label, pid, id, chrom, strand, s, e, kind FROM fr WHERE pid IS NOT NULL)
""".replace("{feat}", ID_SQL.replace("(x)", "(feat_id)")).replace("{parent}", ID_SQL.replace("(x)", "(parent_id)"))


def sql(body: str) -> str:
    """``body`` with the feature tables in front: fr (rows), fw (one kind's whole features), fp (parts)."""
    return f"WITH {FEATURES_SQL}, {body}" if " AS (" in body.split("SELECT")[0] else f"WITH {FEATURES_SQL} {body}"
