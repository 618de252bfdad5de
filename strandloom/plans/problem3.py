"""Problem 3: continuous stretches and gaps of exons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.ids import feature_id
from strandloom.operators.periods import periods
from strandloom.plans.problem1 import ID_SQL
from strandloom.sources.tables import table

ENTITY = ["entity_table", "annot_id", "entity_id", "chrom", "strand"]


def exons(spark: SparkSession, folder: str) -> DataFrame:
    """Exons of both tables by entity, null bounds included; a row without an entity is none."""
    a = table(spark, folder, "intervals").where("featuretype = 'exon'").select(
        F.lit("intervals").alias("entity_table"), "annot_id", feature_id(F.col("parent_id")).alias("entity_id"), "chrom", "strand", "start", "end_"
    )
    b = table(spark, folder, "transcripts").select(
        F.lit("transcripts").alias("entity_table"), F.lit("").alias("annot_id"), F.col("tid").alias("entity_id"), "chrom", "strand", F.explode("exons").alias("x")
    ).withColumns({"start": F.col("x.start"), "end_": F.col("x.end_")}).drop("x")
    return a.unionByName(b).where(F.col("strand").isin("+", "-") & F.col("entity_id").isNotNull())


def found(spark: SparkSession, folder: str) -> DataFrame:
    """p3_found: merged stretches and gaps of the exons of every transcript and parent."""
    return periods(exons(spark, folder), ENTITY, "start", "end_")


FOUND_SQL = """
WITH x AS (
  SELECT 'intervals' AS entity_table, annot_id, {fid} AS entity_id, chrom, strand, start AS a, end_ AS b FROM (SELECT *, parent_id AS x FROM intervals WHERE featuretype = 'exon')
  UNION ALL
  SELECT 'transcripts', '', tid, chrom, strand, u.start, u.end_ FROM (SELECT tid, chrom, strand, unnest(exons) AS u FROM transcripts)),
i AS (
  SELECT DISTINCT entity_table, annot_id, entity_id, chrom, strand, least(a, b) AS s, greatest(a, b) AS e FROM x
  WHERE strand IN ('+', '-') AND a IS NOT NULL AND b IS NOT NULL AND entity_id IS NOT NULL),
m AS (SELECT *, max(e) OVER (PARTITION BY entity_table, annot_id, entity_id, chrom, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM i),
n AS (SELECT *, sum(CASE WHEN s <= r + 1 THEN 0 ELSE 1 END) OVER (PARTITION BY entity_table, annot_id, entity_id, chrom, strand ORDER BY s, e) AS k FROM m),
t AS (SELECT entity_table, annot_id, entity_id, chrom, strand, k, min(s) AS s, max(e) AS e, count(*) AS c FROM n GROUP BY 1, 2, 3, 4, 5, 6),
g AS (SELECT *, lead(s) OVER (PARTITION BY entity_table, annot_id, entity_id, chrom, strand ORDER BY s) AS nx FROM t)
SELECT entity_table, annot_id, entity_id, chrom, strand, 'merged' AS kind, s AS start, e AS end_ FROM t WHERE c > 1
UNION ALL
SELECT entity_table, annot_id, entity_id, chrom, strand, 'gap', e + 1, nx - 1 FROM g WHERE nx IS NOT NULL
""".replace("{fid}", ID_SQL)
QUERIES = {"p3_found": found}
ORACLES = {"p3_found": FOUND_SQL}
