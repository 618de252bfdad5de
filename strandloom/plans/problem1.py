"""Problem 1: orphan references over the annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.ids import feature_id, month
from strandloom.operators.references import orphans
from strandloom.sources.tables import table


def _refs(df: DataFrame, name: str, field: str, key: str, time: str, annot: Column, ref: Column) -> DataFrame:
    out = df.select(
        F.lit(name).alias("ref_table"),
        F.lit(field).alias("ref_field"),
        F.col(key).cast("long").alias("row_key"),
        F.col(time).alias("own_time"),
        annot.alias("annot"),
        ref.alias("ref"),
    )
    return out.where(F.col("ref").isNotNull())


def unlisted_counts(reports: DataFrame, drops: DataFrame) -> DataFrame:
    """Reports whose count is above the number of different listed ids; one row per report and field.

    A report delivered twice counts once, with its largest count and earliest time; null counts
    and reports without an id are left out.
    """
    once = reports.where(F.col("report_id").isNotNull()).groupBy("report_id").agg(
        F.min("run_at").alias("own_time"), F.max("genes_dropped").alias("gene"), F.max("mrnas_dropped").alias("mRNA")
    )
    listed = (
        drops.where(F.col("featuretype").isin("gene", "mRNA") & F.col("report_id").isNotNull())
        .groupBy("report_id", "featuretype")
        .agg(F.count_distinct(feature_id(F.col("feat_id"))).alias("n"))
        .groupBy("report_id")
        .agg(F.sum(F.when(F.col("featuretype") == "gene", F.col("n"))).alias("n_gene"), F.sum(F.when(F.col("featuretype") == "mRNA", F.col("n"))).alias("n_mrna"))
    )
    both = once.join(listed, "report_id", "left")
    claims = F.array(
        F.struct(F.lit("genes_dropped").alias("ref_field"), F.col("gene").alias("claimed"), F.coalesce("n_gene", F.lit(0)).alias("listed")),
        F.struct(F.lit("mrnas_dropped").alias("ref_field"), F.col("mRNA").alias("claimed"), F.coalesce("n_mrna", F.lit(0)).alias("listed")),
    )
    return (
        both.select("report_id", "own_time", F.inline(claims))
        .where(F.col("claimed") > F.col("listed"))
        .select(F.lit("cleanup_reports").alias("ref_table"), "ref_field", F.col("report_id").cast("long").alias("row_key"), "own_time", F.lit("unlisted").alias("kind"))
    )


def found(spark: SparkSession, folder: str) -> DataFrame:
    """p1_found: every reference without its record, by table and month."""
    intervals, records = table(spark, folder, "intervals"), table(spark, folder, "feature_records")
    drops, reports = table(spark, folder, "cleanup_drops"), table(spark, folder, "cleanup_reports")
    fid = lambda c: feature_id(F.col(c))
    refs = (
        _refs(intervals, "intervals", "parent_id", "row_id", "loaded_at", F.col("annot_id"), fid("parent_id"))
        .unionByName(_refs(records, "feature_records", "ref_id", "record_id", "compared_at", F.col("ref_annot_id"), fid("ref_id")))
        .unionByName(_refs(records, "feature_records", "pred_id", "record_id", "compared_at", F.col("pred_annot_id"), fid("pred_id")))
    )
    features = intervals.select(F.col("annot_id").alias("annot"), fid("feat_id").alias("ref"), F.col("loaded_at").alias("at"), F.lit(False).alias("listed")).unionByName(
        drops.select(F.col("annot_id").alias("annot"), fid("feat_id").alias("ref"), F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(True).alias("listed"))
    )
    lost = orphans(refs, features, ["annot", "ref"], "own_time", "at", F.col("listed"), match="full")  # an unknown annotation has no features
    report_refs = drops.where(F.col("report_id").isNotNull()).select(
        F.lit("cleanup_drops").alias("ref_table"), F.lit("report_id").alias("ref_field"), F.col("drop_id").cast("long").alias("row_key"), F.col("dropped_at").alias("own_time"), F.col("report_id").alias("ref")
    )
    no_report = orphans(report_refs, reports.select(F.col("report_id").alias("ref"), F.col("run_at").alias("at")), ["ref"], "own_time", "at")
    cols = ["ref_table", "ref_field", "row_key", "own_time", "kind"]
    every = lost.select(*cols).unionByName(no_report.select(*cols)).unionByName(unlisted_counts(reports, drops).select(*cols))
    return every.select("ref_table", "ref_field", "row_key", month(F.col("own_time")).alias("period"), "kind")


def by_table_and_month(spark: SparkSession, folder: str) -> DataFrame:
    """p1_report: number of orphan references by table, field, month and kind."""
    return found(spark, folder).groupBy("ref_table", "ref_field", "period", "kind").agg(F.count("*").alias("n"))


_FOUND_SQL = r"""
WITH f AS (SELECT annot_id, {fid} AS id, min(loaded_at) AS tm FROM (SELECT annot_id, feat_id AS x, loaded_at FROM intervals) WHERE {fid} IS NOT NULL GROUP BY 1, 2),
d AS (SELECT DISTINCT annot_id, {fid} AS id FROM (SELECT annot_id, feat_id AS x FROM cleanup_drops) WHERE {fid} IS NOT NULL),
r AS (
  SELECT t, fld, k, tm, a, {fid} AS id FROM (
    SELECT 'intervals' AS t, 'parent_id' AS fld, row_id AS k, loaded_at AS tm, annot_id AS a, parent_id AS x FROM intervals
    UNION ALL SELECT 'feature_records', 'ref_id', record_id, compared_at, ref_annot_id, ref_id FROM feature_records
    UNION ALL SELECT 'feature_records', 'pred_id', record_id, compared_at, pred_annot_id, pred_id FROM feature_records) WHERE {fid} IS NOT NULL),
s AS (
  SELECT r.t, r.fld, r.k, r.tm,
    CASE WHEN d.id IS NOT NULL THEN 'dropped' WHEN f.id IS NULL THEN 'missing' WHEN f.tm > r.tm THEN 'late' END AS kind
  FROM r LEFT JOIN d ON d.annot_id = r.a AND d.id = r.id LEFT JOIN f ON f.annot_id = r.a AND f.id = r.id
  UNION ALL
  SELECT 'cleanup_drops', 'report_id', x.drop_id, x.dropped_at,
    CASE WHEN p.report_id IS NULL THEN 'missing' WHEN p.tm > x.dropped_at THEN 'late' END
  FROM cleanup_drops x LEFT JOIN (SELECT report_id, min(run_at) AS tm FROM cleanup_reports GROUP BY 1) p ON p.report_id = x.report_id
  WHERE x.report_id IS NOT NULL
  UNION ALL
  SELECT 'cleanup_reports', q.fld, q.report_id, q.tm, CASE WHEN q.n > coalesce(l.n, 0) THEN 'unlisted' END
  FROM (SELECT report_id, 'genes_dropped' AS fld, 'gene' AS ft, max(genes_dropped) AS n, min(run_at) AS tm FROM cleanup_reports WHERE report_id IS NOT NULL GROUP BY 1
        UNION ALL SELECT report_id, 'mrnas_dropped', 'mRNA', max(mrnas_dropped), min(run_at) FROM cleanup_reports WHERE report_id IS NOT NULL GROUP BY 1) q
  LEFT JOIN (SELECT report_id, featuretype AS ft, count(DISTINCT {fid}) AS n FROM (SELECT report_id, featuretype, feat_id AS x FROM cleanup_drops) GROUP BY 1, 2) l
    ON l.report_id = q.report_id AND l.ft = q.ft)
SELECT t AS ref_table, fld AS ref_field, k AS row_key, coalesce(strftime(tm, '%Y-%m'), 'unknown') AS period, kind FROM s WHERE kind IS NOT NULL
"""
#: The id rule in DuckDB's words, over a column x.
ID_SQL = "CASE WHEN trim(url_decode(x), E' \\t\\r\\n') IN ('', '.') THEN NULL ELSE trim(url_decode(x), E' \\t\\r\\n') END"
FOUND_SQL = _FOUND_SQL.replace("{fid}", ID_SQL)
QUERIES = {"p1_found": found, "p1_report": by_table_and_month}
ORACLES = {
    "p1_found": FOUND_SQL,
    "p1_report": f"SELECT ref_table, ref_field, period, kind, count(*) AS n FROM ({FOUND_SQL}) GROUP BY 1, 2, 3, 4",
}
