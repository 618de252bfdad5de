"""Problem 6: the trees and rings that features form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.ids import BLANKS, feature_id
from strandloom.operators.hierarchy import descendant_lists, hierarchy
from strandloom.plans.problem1 import ID_SQL
from strandloom.sources.tables import table

SEP = "\x1f"  # parts annotation and id in a node's name; sorts below every printable letter
RANKS = {"gene": 0, "mrna": 1, "cds": 2}


def _node(annot: Column, feature: Column) -> Column:
    return F.concat(F.coalesce(annot, F.lit("\0")), F.lit(SEP), feature)


def features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per feature: ``node`` and the ``parent`` of its latest row."""
    rows = table(spark, folder, "intervals").select(
        _node(F.col("annot_id"), feature_id(F.col("feat_id"))).alias("node"), _node(F.col("annot_id"), feature_id(F.col("parent_id"))).alias("parent"), F.struct("loaded_at", "row_id").alias("when")
    )
    return rows.where("node is not null").groupBy("node").agg(F.max_by("parent", "when").alias("parent"))


def claimed_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Which ranks the feature records claim for a node, on either side: ``r0``, ``r1``, ``r2``."""
    level = F.lower(F.btrim("level", F.lit(BLANKS)))
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in RANKS.items() for x in kv]), level)
    records = table(spark, folder, "feature_records").withColumn("rank", F.when(level.isin(*RANKS), rank))
    sides = [records.select(_node(F.col(f"{s}_annot_id"), feature_id(F.col(f"{s}_id"))).alias("node"), "rank") for s in ("ref", "pred")]
    both = sides[0].unionByName(sides[1]).where("node is not null and rank is not null")
    return both.groupBy("node").agg(*[F.max(F.col("rank") == r).alias(f"r{r}") for r in RANKS.values()])


def _named(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.substring_index(F.col(c), SEP, -1))
    return df


def _annot(c: str) -> Column:
    return F.nullif(F.substring_index(F.col(c), SEP, 1), F.lit("\0")).alias("annot_id")


def found(spark: SparkSession, folder: str) -> DataFrame:
    """p6_found: every feature with its root, depth, descendants and level conflict."""
    trees = hierarchy(features(spark, folder), "node", "parent").join(claimed_levels(spark, folder), "node", "left")
    conflict = F.lit(False)
    for r in RANKS.values():
        conflict = conflict | (F.coalesce(f"r{r}", F.lit(False)) & (F.col("depth") != r))
    return trees.select(
        _annot("node"), F.substring_index("node", SEP, -1).alias("feat_id"), F.substring_index("root", SEP, -1).alias("root_id"), "depth", "n_desc", conflict.cast("long").alias("level_conflict")
    )


def paths(spark: SparkSession, folder: str) -> DataFrame:
    """p6_paths: every feature of a tree with its path of ids from the root down."""
    trees = hierarchy(features(spark, folder), "node", "parent", paths=True).where("path is not null")
    ids = F.transform("path", lambda x: F.substring_index(x, SEP, -1))
    return trees.select(_annot("node"), F.substring_index("node", SEP, -1).alias("feat_id"), F.array_join(ids, " > ").alias("path"))


def descendants(spark: SparkSession, folder: str) -> DataFrame:
    """p6_descendants: every pair of a feature and a descendant, with their distance."""
    pairs = descendant_lists(features(spark, folder), "node", "parent")
    return pairs.select(_annot("ancestor"), F.substring_index("ancestor", SEP, -1).alias("feat_id"), F.substring_index("descendant", SEP, -1).alias("desc_id"), "distance")


_TREES = """
WITH RECURSIVE n AS (
  SELECT a, f, p FROM (
    SELECT a, f, p, row_number() OVER (PARTITION BY a, f ORDER BY t DESC NULLS LAST, r DESC) AS k
    FROM (SELECT annot_id AS a, {feat} AS f, {parent} AS p, loaded_at AS t, row_id AS r FROM intervals) WHERE f IS NOT NULL) WHERE k = 1),
e AS (SELECT n.a, n.f, q.f AS p FROM n LEFT JOIN n q ON q.a = n.a AND q.f = n.p),
u AS (SELECT a, f, f AS root, CAST(0 AS BIGINT) AS d, f AS path FROM e WHERE p IS NULL
  UNION ALL SELECT e.a, e.f, u.root, u.d + 1, u.path || ' > ' || e.f FROM u JOIN e ON e.a = u.a AND e.p = u.f)
""".replace("{feat}", ID_SQL.replace("(x)", "(feat_id)")).replace("{parent}", ID_SQL.replace("(x)", "(parent_id)"))
_REST = """,
c AS (SELECT e.a, e.f, e.p AS anc, CAST(1 AS BIGINT) AS dist FROM e JOIN u ON u.a = e.a AND u.f = e.f WHERE e.p IS NOT NULL
  UNION ALL SELECT c.a, c.f, e.p, c.dist + 1 FROM c JOIN e ON e.a = c.a AND e.f = c.anc WHERE e.p IS NOT NULL),
l AS (SELECT a, f, p FROM e WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.a = e.a AND u.f = e.f)),
w AS (SELECT a, f, p AS anc FROM l UNION SELECT w.a, w.f, l.p FROM w JOIN l ON l.a = w.a AND l.f = w.anc),
g AS (SELECT a, f FROM w WHERE f = anc),
t AS (SELECT u.a, u.f, u.root, u.d, coalesce(k.n, 0) AS n FROM u LEFT JOIN (SELECT a, anc, count(*) AS n FROM c GROUP BY 1, 2) k ON k.a = u.a AND k.anc = u.f
  UNION ALL SELECT w.a, w.f, min(w.anc), -1, -1 FROM w JOIN g ON g.a = w.a AND g.f = w.anc GROUP BY 1, 2),
v AS (SELECT DISTINCT a, {fid} AS f, r FROM (
  SELECT ref_annot_id AS a, ref_id AS x, CASE lower(trim(level, E' \\t\\r\\n')) WHEN 'gene' THEN 0 WHEN 'mrna' THEN 1 WHEN 'cds' THEN 2 END AS r FROM feature_records
  UNION ALL SELECT pred_annot_id, pred_id, CASE lower(trim(level, E' \\t\\r\\n')) WHEN 'gene' THEN 0 WHEN 'mrna' THEN 1 WHEN 'cds' THEN 2 END FROM feature_records) WHERE r IS NOT NULL)
SELECT t.a AS annot_id, t.f AS feat_id, t.root AS root_id, t.d AS depth, t.n AS n_desc,
  CAST(EXISTS (SELECT 1 FROM v WHERE v.a = t.a AND v.f = t.f AND v.r <> t.d) AS BIGINT) AS level_conflict
FROM t
""".replace("{fid}", ID_SQL)
QUERIES = {"p6_found": found, "p6_paths": paths, "p6_descendants": descendants}
ORACLES = {
    "p6_found": _TREES + _REST,
    "p6_paths": _TREES + "SELECT a AS annot_id, f AS feat_id, path FROM u",
    "p6_descendants": _TREES + _REST.split("l AS (SELECT")[0].rstrip().rstrip(",") + " SELECT a AS annot_id, anc AS feat_id, f AS desc_id, dist AS distance FROM c",
}
