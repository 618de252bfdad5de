"""Queries on interval algebra and on the comparison of annotations, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators import compare, intervals, matching
from strandloom.plans.adapters import REFERENCE, parts, sql, whole
from strandloom.session import cut
from strandloom.sources.tables import table

REF, PRED = f"label = '{REFERENCE}'", f"label <> '{REFERENCE}'"
KEEP = ["label", "id", "chrom", "strand", "s", "e"]


def _genes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    g = cut(whole(spark, folder, "gene").select(*KEEP))
    return g.where(REF), g.where(PRED)


def j1_overlap_join(spark, folder):
    """Overlaps of reference genes with predicted genes."""
    ref, pred = _genes(spark, folder)
    return intervals.overlap_join(ref, pred).select(F.col("b_label").alias("label"), F.col("a_id").alias("ref_id"), F.col("b_id").alias("pred_id"), "bp")


def j2_overlap_semi(spark, folder):
    """Reference genes that some prediction overlaps."""
    ref, pred = _genes(spark, folder)
    return intervals.overlap_semi(ref, pred).select("id", "chrom", "s", "e")


def j3_overlap_anti(spark, folder):
    """Reference genes with coding parts, at depth 1 or 2, that no prediction overlaps."""
    ref, pred = _genes(spark, folder)
    free = intervals.overlap_semi(ref, pred, keep=False)
    cds = parts(spark, folder, "CDS").where(REF).select(F.col("pid").alias("id"))
    mrna = whole(spark, folder, "mRNA").where(REF).select("id", F.col("pid").alias("gene"))
    coding = cds.unionByName(cds.join(mrna, "id").select(F.col("gene").alias("id"))).distinct()
    return free.join(coding, "id", "left_semi").select("id", "chrom", "s", "e")


def j10_best_overlap(spark, folder):
    """For every reference gene and label, the prediction with most shared bases."""
    ref, pred = _genes(spark, folder)
    best = intervals.best_overlap(intervals.overlap_join(ref, pred), ("a_id", "b_label"))
    return best.select(F.col("b_label").alias("label"), F.col("a_id").alias("ref_id"), F.col("b_id").alias("pred_id"), "bp")


def j13_loci_in_genes(spark, folder):
    """Soft-clip loci inside reference genes: loci and clips of every gene."""
    ref, _ = _genes(spark, folder)
    loci = table(spark, folder, "locus_rows").where("pos is not null").select(F.col("locus_id").alias("id"), "chrom", F.col("pos").alias("s"), "n_clips")
    return intervals.containment(loci, ref).groupBy(F.col("b_id").alias("gene_id")).agg(F.count("*").alias("n_loci"), F.sum("a_n_clips").alias("n_clips"))


def a1_gene_classes(spark, folder):
    """Every reference gene's class against every label, and the novel predictions."""
    return compare.classify(*_genes(spark, folder))


def a4_gene_stats(spark, folder):
    """Counts and ratios of every label."""
    return compare.gene_stats(a1_gene_classes(spark, folder))


def a6_boundary_stats(spark, folder):
    """Boundary differences of the inexact matches."""
    return compare.boundary_stats(a1_gene_classes(spark, folder))


def a7_agreement(spark, folder):
    """How many reference genes each set of labels agrees on, by class."""
    classes = spark.createDataFrame([("match",), ("missing",), ("merged",), ("fragmented",)], "class string")
    return compare.agreement(a1_gene_classes(spark, folder), classes)


def w1_introns(spark, folder):
    """Introns between the coding parts of every parent."""
    return compare.introns(parts(spark, folder, "CDS"))


def w2_prefix_max_end(spark, folder):
    """Furthest end so far of the genes of an annotation, by place."""
    return intervals.prefix_max_end(whole(spark, folder, "gene").select(*KEEP), ("label", *intervals.PLACE)).select("label", "id", "max_e")


def w3_clusters(spark, folder):
    """Clusters of overlapping genes of all annotations together."""
    return intervals.clusters(whole(spark, folder, "gene").select("label", F.concat_ws("|", "label", "id").alias("id"), "chrom", "strand", "s", "e")).select("id", "island", "n")


def w4_merge_heads(spark, folder):
    """mRNAs of overlapping genes of all annotations, moved under the first gene of their cluster."""
    genes = whole(spark, folder, "gene").select(F.concat_ws("|", "label", "id").alias("id"), "chrom", "strand", "s", "e")
    heads = intervals.cluster_heads(genes).select(F.col("id").alias("gene"), "head_id")
    mrna = whole(spark, folder, "mRNA").select("label", "id", F.concat_ws("|", "label", F.coalesce("pid", F.lit(""))).alias("gene"))
    return mrna.join(heads, "gene").select("label", "id", "head_id")


def w5_distance_clusters(spark, folder):
    """Clip sites of a chromosome and side, chained within five bases."""
    sites = table(spark, folder, "locus_rows").where("pos is not null and chrom is not null and side is not null").groupBy("chrom", "side", "pos").agg(F.sum("n_clips").alias("support"))
    return intervals.distance_clusters(sites.where("support is not null"), ("chrom", "side"), "pos", "support", 5)


def j5_concordant(spark, folder):
    """Genes with a model that another annotation agrees with in structure."""
    m = cut(whole(spark, folder, "mRNA").select(*KEEP, "pid"))
    cds = parts(spark, folder, "CDS")
    shape = cds.groupBy("label", F.col("pid").alias("id")).agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("cds"))
    models = m.join(shape, ["label", "id"])
    pairs = matching.concordant(models, models).where("a_label <> b_label and a_pid is not null")
    return pairs.select(F.col("a_label").alias("label"), F.col("a_pid").alias("gene_id"), F.col("b_label").alias("by_label")).distinct()


def j11_subfeatures(spark, folder):
    """mRNAs of matched genes, coding parts and introns of matched mRNAs, matched one to one: class of each."""
    ref, pred = _genes(spark, folder)
    genes = compare.classify(ref, pred).where("pred_id is not null and classification <> 'novel'").select("label", F.col("ref_id").alias("a"), F.col("pred_id").alias("b"))
    cds = cut(parts(spark, folder, "CDS"))
    every = {"mrna": cut(whole(spark, folder, "mRNA").where("pid is not null").select(*KEEP, "pid")), "cds": cds, "intron": cut(compare.introns(cds))}
    return matching.levels(genes, {k: v.where(REF) for k, v in every.items()}, {k: v.where(PRED) for k, v in every.items()})


def a5_level_stats(spark, folder):
    """Counts and ratios of every level and label."""
    return matching.level_stats(j11_subfeatures(spark, folder))


def r1_levels(spark, folder):
    """F1 of every level, one column for each label; genes by their own classes, the rest by one-to-one matches."""
    genes = a4_gene_stats(spark, folder).select(F.lit("gene").alias("level"), "label", "f1_score")
    both = genes.unionByName(a5_level_stats(spark, folder).select("level", "label", "f1_score"))
    return both.groupBy("level").pivot("label").agg(F.first("f1_score"))  # one column per label: few by nature


def r1_gene_f1(spark, folder, labels=("sokboxe_augelin", "ziwenul_snapper")):
    """F1 of genes, one column for each of ``labels``; missing, merged and fragmented references are false negatives."""
    s = a4_gene_stats(spark, folder)
    return s.groupBy(F.lit("gene").alias("level")).pivot("label", list(labels)).agg(F.first("f1_score"))


def r2_condensed(spark, folder):
    """Agreement of all labels, condensed as more than six labels are."""
    labels = [r[0] for r in whole(spark, folder, "gene").where(PRED).select("label").distinct().collect()]  # one row per annotation
    return compare.condensed(a7_agreement(spark, folder), labels)


_G = "r AS (SELECT * FROM fw WHERE kind = 'gene' AND label = 'gawenka_ref'), p AS (SELECT * FROM fw WHERE kind = 'gene' AND label <> 'gawenka_ref')"
_PAIRS = _G + """,
o AS (SELECT p.label, r.id AS a, r.s AS a_s, r.e AS a_e, p.id AS b, p.s AS b_s, p.e AS b_e, least(r.e, p.e) - greatest(r.s, p.s) + 1 AS bp
  FROM r JOIN p ON r.chrom = p.chrom AND r.strand = p.strand AND r.s <= p.e AND p.s <= r.e)"""
_CLASSES = _PAIRS + """,
mg AS (SELECT label, a, b FROM (SELECT *, count(*) OVER (PARTITION BY label, b) AS n FROM o WHERE bp > 0.5 * (a_e - a_s + 1)) WHERE n >= 2),
fg AS (SELECT label, a, b FROM (SELECT *, count(*) OVER (PARTITION BY label, a) AS n FROM o
  WHERE bp >= 0.5 * (b_e - b_s + 1) AND (label, a) NOT IN (SELECT (label, a) FROM mg)) WHERE n >= 2),
ex AS (SELECT label, b FROM mg UNION SELECT label, b FROM fg),
bst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label, a ORDER BY bp DESC, b_s, b) AS k FROM o WHERE (label, b) NOT IN (SELECT (label, b) FROM ex)) WHERE k = 1),
cl AS (
  SELECT l.label, CASE WHEN (l.label, r.id) IN (SELECT (label, a) FROM mg) THEN 'merged' WHEN (l.label, r.id) IN (SELECT (label, a) FROM fg) THEN 'fragmented'
    WHEN t.b IS NULL THEN 'missing' WHEN r.s = t.b_s AND r.e = t.b_e THEN 'exact' ELSE 'inexact' END AS c,
    r.id, r.chrom, r.strand, r.s, r.e, t.b, t.b_s, t.b_e, t.bp, t.bp / (r.e - r.s + 1) AS sn, t.bp / (t.b_e - t.b_s + 1) AS sp
  FROM r CROSS JOIN (SELECT DISTINCT label FROM p) l LEFT JOIN bst t ON t.label = l.label AND t.a = r.id),
rec AS (
  SELECT label, c AS classification, id AS ref_id, CASE WHEN m THEN b END AS pred_id, chrom, strand, s AS ref_start, e AS ref_end,
    CASE WHEN m THEN b_s END AS pred_start, CASE WHEN m THEN b_e END AS pred_end, CASE WHEN m THEN bp END AS overlap_bp,
    CASE WHEN m THEN sn END AS sn, CASE WHEN m THEN sp END AS sp, CASE WHEN m THEN 2 * sn * sp / (sn + sp) END AS f1,
    CASE WHEN c = 'inexact' THEN CASE WHEN strand = '+' THEN b_s - s ELSE e - b_e END END AS boundary_5p,
    CASE WHEN c = 'inexact' THEN CASE WHEN strand = '+' THEN b_e - e ELSE s - b_s END END AS boundary_3p
  FROM (SELECT *, c IN ('exact', 'inexact') AS m FROM cl)
  UNION ALL
  SELECT label, 'novel', NULL, id, chrom, strand, NULL, NULL, s, e, NULL, NULL, NULL, NULL, NULL, NULL FROM p WHERE (label, id) NOT IN (SELECT (label, b) FROM o))"""
_AGREE = """ SELECT class, labels, count(*) AS n FROM (
      SELECT k.class, ref_id, coalesce(string_agg(label, ',' ORDER BY label) FILTER (CASE WHEN classification IN ('exact', 'inexact') THEN 'match' ELSE classification END = k.class), '') AS labels
      FROM rec CROSS JOIN (VALUES ('match'), ('missing'), ('merged'), ('fragmented')) k(class) WHERE ref_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1, 2"""
QUERIES = {f.__name__: f for f in (
    j1_overlap_join, j2_overlap_semi, j3_overlap_anti, j5_concordant, j10_best_overlap, j11_subfeatures, a5_level_stats, r1_levels, r1_gene_f1, r2_condensed, j13_loci_in_genes, a1_gene_classes, a4_gene_stats, a6_boundary_stats,
    a7_agreement, w1_introns, w2_prefix_max_end, w3_clusters, w4_merge_heads, w5_distance_clusters,
)}
_CLUSTER = """
x AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY label, chrom, strand ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM fw WHERE kind = 'gene'),
y AS (SELECT *, sum(f) OVER (PARTITION BY label, chrom, strand ORDER BY s, e, id) AS g FROM x)"""
ORACLES = {
    "j1_overlap_join": sql(_PAIRS + " SELECT label, a AS ref_id, b AS pred_id, bp FROM o"),
    "j2_overlap_semi": sql(_PAIRS + " SELECT DISTINCT a AS id, r.chrom, r.s, r.e FROM o JOIN r ON r.id = o.a"),
    "j3_overlap_anti": sql(_PAIRS + """, c AS (SELECT pid AS id FROM fp WHERE kind = 'CDS' AND label = 'gawenka_ref'),
      m AS (SELECT id, pid FROM fw WHERE kind = 'mRNA' AND label = 'gawenka_ref'), k AS (SELECT id FROM c UNION SELECT m.pid FROM m JOIN c ON c.id = m.id)
      SELECT id, chrom, s, e FROM r WHERE id NOT IN (SELECT a FROM o) AND id IN (SELECT id FROM k WHERE id IS NOT NULL)"""),
    "j5_concordant": sql("""cd AS (SELECT label, pid AS id, list({'s': s, 'e': e} ORDER BY s, e) AS c FROM fp WHERE kind = 'CDS' GROUP BY 1, 2),
      m AS (SELECT f.label, f.id, f.pid, f.chrom, f.strand, f.s, f.e, cd.c, len(cd.c) AS n FROM fw f JOIN cd ON cd.label = f.label AND cd.id = f.id WHERE kind = 'mRNA')
      SELECT DISTINCT a.label, a.pid AS gene_id, b.label AS by_label FROM m a JOIN m b ON a.label <> b.label AND a.chrom = b.chrom AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e
      WHERE a.pid IS NOT NULL AND a.n = b.n AND abs(a.s - b.s) <= 0.05 * greatest(a.e - a.s, b.e - b.s, 1) AND abs(a.e - b.e) <= 0.05 * greatest(a.e - a.s, b.e - b.s, 1)
      AND (a.n = 1 OR len(list_filter(range(1, a.n + 1), lambda i: (i > 1 AND abs(a.c[i].s - b.c[i].s) > 3) OR (i < a.n AND abs(a.c[i].e - b.c[i].e) > 3))) = 0)"""),
    "j10_best_overlap": sql(_PAIRS + " SELECT label, a AS ref_id, b AS pred_id, bp FROM (SELECT *, row_number() OVER (PARTITION BY label, a ORDER BY bp DESC, b_s, b) AS k FROM o) WHERE k = 1"),
    "j13_loci_in_genes": sql(_G + " SELECT r.id AS gene_id, count(*) AS n_loci, CAST(sum(l.n_clips) AS BIGINT) AS n_clips FROM r JOIN locus_rows l ON l.chrom = r.chrom AND l.pos BETWEEN r.s AND r.e GROUP BY 1"),
    "a1_gene_classes": sql(_CLASSES + " SELECT * FROM rec"),
    "a4_gene_stats": sql(_CLASSES + """, n AS (SELECT label, """ + ", ".join(f"count(*) FILTER (classification = '{c}') AS n_{c}" for c in compare.CLASSES) + """,
      count(*) FILTER (classification IN ('exact', 'inexact') AND f1 >= 0.99) AS n_perfect, coalesce(avg(sn), 0) AS mean_sn, coalesce(avg(sp), 0) AS mean_sp, coalesce(avg(f1), 0) AS mean_f1 FROM rec GROUP BY 1)
      SELECT *, coalesce((n_exact + n_inexact) / nullif(n_exact + n_inexact + n_missing + n_fragmented + n_merged, 0), 0) AS sensitivity,
      coalesce((n_exact + n_inexact) / nullif(n_exact + n_inexact + n_novel, 0), 0) AS "precision",
      coalesce(2 * (n_exact + n_inexact) / nullif(2 * (n_exact + n_inexact) + n_missing + n_fragmented + n_merged + n_novel, 0), 0) AS f1_score FROM n"""),
    "a6_boundary_stats": sql(_CLASSES + """ SELECT label, median(abs(boundary_5p)) AS median_boundary_5p, avg(abs(boundary_5p)) AS mean_boundary_5p,
      median(abs(boundary_3p)) AS median_boundary_3p, avg(abs(boundary_3p)) AS mean_boundary_3p FROM rec WHERE classification = 'inexact' GROUP BY 1"""),
    "a7_agreement": sql(_CLASSES + _AGREE),
    "r2_condensed": sql(_CLASSES + """, ag AS (SELECT * FROM (""" + _AGREE + """)), z AS (SELECT *, CASE WHEN labels = '' THEN 0 ELSE len(string_split(labels, ',')) END AS sz FROM ag), nl AS (SELECT count(DISTINCT label) AS k FROM p)
      SELECT class, CASE WHEN k <= 6 OR sz <= 1 OR sz = k THEN labels ELSE 'other' END AS labels, CAST(sum(n) AS BIGINT) AS n, max(sz) AS size FROM z, nl GROUP BY 1, 2"""),
    "r1_gene_f1": sql(_CLASSES + """, n AS (SELECT label, count(*) FILTER (classification IN ('exact', 'inexact')) AS tp, count(*) FILTER (classification IN ('missing', 'merged', 'fragmented')) AS fn, count(*) FILTER (classification = 'novel') AS fp FROM rec GROUP BY 1)
      SELECT 'gene' AS level, max(2 * tp / (2 * tp + fn + fp)) FILTER (label = 'sokboxe_augelin') AS sokboxe_augelin, max(2 * tp / (2 * tp + fn + fp)) FILTER (label = 'ziwenul_snapper') AS ziwenul_snapper FROM n"""),
    "w1_introns": sql("""x AS (SELECT *, lead(s) OVER w AS nx, row_number() OVER w AS k FROM fp WHERE kind = 'CDS' WINDOW w AS (PARTITION BY label, pid ORDER BY s, e, id))
      SELECT label, pid, pid || ':intron:' || k AS id, chrom, strand, e + 1 AS s, nx - 1 AS e FROM x WHERE nx IS NOT NULL"""),
    "w2_prefix_max_end": sql("""x AS (SELECT label, id, max(e) OVER (PARTITION BY label, chrom, strand ORDER BY s, e, id ROWS UNBOUNDED PRECEDING) AS max_e FROM fw WHERE kind = 'gene') SELECT * FROM x"""),
    "w3_clusters": sql(_CLUSTER.replace("PARTITION BY label, chrom", "PARTITION BY chrom").replace("s, e, id", "s, e, label, id") + """ SELECT id, island, n FROM (SELECT label || '|' || id AS id, min(s) OVER w AS island, count(*) OVER w AS n FROM y WINDOW w AS (PARTITION BY chrom, strand, g)) WHERE n >= 2"""),
    "w4_merge_heads": sql(_CLUSTER.replace("PARTITION BY label, chrom", "PARTITION BY chrom").replace("s, e, id", "s, e, label, id") + """, h AS (SELECT label, id, first_value(label || '|' || id) OVER (PARTITION BY chrom, strand, g ORDER BY s, e, label, id) AS head_id FROM y)
      SELECT m.label, m.id, h.head_id FROM fw m JOIN h ON h.label = m.label AND h.id = m.pid WHERE m.kind = 'mRNA'"""),
    "w5_distance_clusters": """WITH x AS (SELECT chrom, side, pos, sum(n_clips) AS support FROM locus_rows WHERE pos IS NOT NULL AND chrom IS NOT NULL AND side IS NOT NULL GROUP BY 1, 2, 3 HAVING sum(n_clips) IS NOT NULL),
      y AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom, side ORDER BY pos) <= 5 THEN 0 ELSE 1 END AS f FROM x),
      z AS (SELECT *, sum(f) OVER (PARTITION BY chrom, side ORDER BY pos) AS g FROM y)
      SELECT chrom, side, (list(pos ORDER BY support DESC, pos))[1] AS pos, CAST(sum(support) AS BIGINT) AS support, count(*) AS members FROM z GROUP BY chrom, side, g""",
}
