"""Queries on feature tables, clean-up, records and hits, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandloom.functions import text as X
from strandloom.functions.ids import BLANKS
from strandloom.operators import features, hits
from strandloom.plans.adapters import parts, rows, sql, whole
from strandloom.sources.tables import table


def _level(c="level"):
    return F.lower(F.btrim(c, F.lit(BLANKS)))


def a8_type_counts(spark, folder):
    """Feature rows by annotation and type."""
    return rows(spark, folder).groupBy("label", "kind").agg(F.count("*").alias("n"))


def a27_drop_set(spark, folder):
    """mRNAs without coding parts and genes left without any."""
    return features.without_coding(whole(spark, folder, "gene"), whole(spark, folder, "mRNA"), parts(spark, folder, "CDS"))


def a30_gene_lengths(spark, folder):
    """Mean and spread of gene lengths of an annotation and the longest usual length."""
    n = F.col("e") - F.col("s")
    spread = F.coalesce(F.stddev_samp(n), F.lit(0.0))
    return whole(spark, folder, "gene").groupBy("label").agg(F.count("*").alias("n"), (F.floor(F.avg(n)) + 2 * F.floor(spread)).alias("maxlen"), F.floor(F.avg(n) / 2).alias("flank"), F.greatest(F.floor(F.count("*") / 4), F.lit(1)).alias("n_training"))


def a31_introns_per_gene(spark, folder):
    """Introns of a gene's coding parts over genes, and whether they pass the gate."""
    mrna = whole(spark, folder, "mRNA").where("pid is not null").select("label", F.col("id").alias("pid"), F.col("pid").alias("gene"))
    per_gene = parts(spark, folder, "CDS").join(mrna, ["label", "pid"]).groupBy("label", "gene").agg(F.count("*").alias("n_cds"))
    introns = per_gene.groupBy("label").agg(F.sum(F.greatest(F.col("n_cds") - 1, F.lit(0))).alias("introns"))
    genes = whole(spark, folder, "gene").groupBy("label").agg(F.count("*").alias("genes"))
    both = genes.join(introns, "label", "left").withColumn("introns", F.coalesce("introns", F.lit(0)))
    return both.withColumn("passes", F.col("introns") / F.col("genes") > 0.25)


def a37_coverage(spark, folder):
    """Genes, mRNAs and mRNAs with a real product of every annotation."""
    t = table(spark, folder, "intervals").where("featuretype in ('gene', 'mRNA')")
    product = F.coalesce(F.try_element_at("attributes", F.lit("product")), F.array().cast("array<string>"))
    named = F.exists(product, lambda p: X.clean_product(p) != X.NO_PRODUCT)
    return t.groupBy(F.col("annot_id").alias("label")).agg(F.count_if(F.col("featuretype") == "gene").alias("n_genes"), F.count_if(F.col("featuretype") == "mRNA").alias("n_mrnas"), F.count_if((F.col("featuretype") == "mRNA") & named).alias("n_named"))


def f15_products(spark, folder):
    """Products of mRNA rows as delivered and cleaned."""
    t = table(spark, folder, "intervals").where("featuretype = 'mRNA'").select("row_id", F.explode(F.try_element_at("attributes", F.lit("product"))).alias("product"))
    return t.select("row_id", "product", X.clean_product(F.col("product")).alias("cleaned"))


def f16_notes(spark, folder):
    """Cross references of gene rows with those to one database moved to the notes."""
    t = table(spark, folder, "intervals").where(F.try_element_at("attributes", F.lit("Dbxref")).isNotNull())
    prefix = F.substring_index(F.element_at(F.col("refs"), 1), ":", 1)
    moved = t.select("row_id", F.try_element_at("attributes", F.lit("Dbxref")).alias("refs"), F.try_element_at("attributes", F.lit("Note")).alias("notes")).withColumn("x", X.moved_notes(F.col("refs"), F.col("notes")))
    return moved.select("row_id", F.array_join("x.dbxref", ",").alias("dbxref"), F.array_join("x.note", ",").alias("note"), prefix.alias("first_db"))


def a28_clean_counts(spark, folder):
    """What a clean-up changes in every annotation: products, fragments, moved references."""
    t = table(spark, folder, "intervals")
    product = F.coalesce(F.try_element_at("attributes", F.lit("product")), F.array().cast("array<string>"))
    refs = F.coalesce(F.try_element_at("attributes", F.lit("Dbxref")), F.array().cast("array<string>"))
    n = lambda arr, f: F.sum(F.size(F.filter(arr, f))).cast("long")
    return t.groupBy(F.col("annot_id").alias("label")).agg(
        n(product, lambda p: p.contains(" OS=")).alias("products_cleaned"), n(product, lambda p: F.substring_index(p, " OS=", 1).contains("(Fragment)")).alias("fragments_stripped"), n(refs, lambda r: r.startswith("KEGG:")).alias("kegg_moved")
    )


def w7_locus_tags(spark, folder):
    """Running tags of genes, their mRNAs and the parts below."""
    keep = ["label", "id", "pid", "chrom", "strand", "s", "e", "kind"]
    genes = features.locus_tags(whole(spark, folder, "gene").select(*keep), "LT")
    mrna = features.child_tags(genes, whole(spark, folder, "mRNA").select(*keep), "mRNA")
    below = features.child_tags(mrna, parts(spark, folder, "CDS", "exon").select(*keep), "part")
    every = genes.select(*keep, "tag").unionByName(mrna.select(*keep, "tag")).unionByName(below.select(*keep, "tag"))
    return every.select("label", "kind", "id", "s", "e", "tag")


def x1_combined(spark, folder, rank=("gawenka_ref", "sokboxe_augelin")):
    """Genes of all annotations, ids taken from the annotation that ranks first."""
    return features.combined(whole(spark, folder, "gene").select("label", "id", "chrom", "s", "e"), {k: i for i, k in enumerate(rank)}).select("id", "label", "chrom", "s", "e")


def x4_completed(spark, folder):
    """Rows by annotation and type once missing levels are derived; exons only come from elsewhere for one annotation."""
    f = rows(spark, folder).where("kind in ('gene', 'mRNA', 'exon', 'CDS')").select("label", "id", "pid", "chrom", "strand", "s", "e", "kind")
    bare = f.where("not (label = 'gawenka_ref' and kind = 'CDS') and not (label = 'sokboxe_augelin' and kind = 'mRNA') and not (label = 'fenpydu_ref' and kind = 'exon')")
    return features.completed(bare).groupBy("label", "kind").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


def a5_record_stats(spark, folder):
    """Matches, misses and false hits of the delivered records of sub-features by level."""
    t = table(spark, folder, "feature_records").withColumn("level", _level()).where("level in ('mrna', 'cds', 'intron')")
    n = {c: F.count_if(F.col("classification") == c) for c in ("match", "missing", "fp")}
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return t.groupBy("level").agg(*[v.alias(f"n_{k}") for k, v in n.items()], safe(n["match"], n["match"] + n["missing"]).alias("sensitivity"), safe(n["match"], n["match"] + n["fp"]).alias("precision"))


def r4_ref_classes(spark, folder):
    """The last gene-level class of every reference gene."""
    t = table(spark, folder, "feature_records").where((_level() == "gene") & F.col("ref_id").isNotNull())
    return t.groupBy("ref_annot_id", "ref_id").agg(F.max_by("classification", F.struct("compared_at", "record_id")).alias("classification"))


def k4_record_lines(spark, folder):
    """Comparison records as lines: empty for null, six decimals."""
    t = table(spark, folder, "feature_records")
    num = lambda c: F.coalesce(F.format_string("%.6f", F.col(c)), F.lit(""))
    txt = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return t.select("record_id", F.concat_ws("\t", txt("level"), txt("classification"), txt("ref_id"), txt("pred_id"), txt("ref_start"), txt("ref_end"), txt("overlap_bp"), F.when(F.col("sn").isNull(), "").otherwise(num("sn")), F.when(F.col("f1").isNull(), "").otherwise(num("f1"))).alias("line"))


def a29_severities(spark, folder):
    """Lines of documents that report an error or a warning, by its name."""
    lines = table(spark, folder, "documents").where("text is not null").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.select(F.regexp_extract("line", r"^\W*([A-Za-z]+(?:Error|Warning|Exception)):", 1).alias("severity")).where("severity <> ''").groupBy("severity").agg(F.count("*").alias("n"))


def s13_best_hits(spark, folder):
    """Every order's dearest line as its best hit."""
    t = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("subject"), F.col("l_extendedprice").alias("score"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("o"))
    return hits.best_hits(t, "query", "score", "o").select("query", "subject", "score")


def _ranked(spark, folder):
    t = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("query"), F.col("l_extendedprice").alias("score"), F.col("l_partkey").alias("subject"), F.col("l_suppkey").alias("sup"), (F.col("l_partkey") % 300 + 1).alias("s"), (F.col("l_partkey") % 300 + 1 + F.col("l_quantity").cast("long")).alias("e"))
    one = t.groupBy("query", "subject").agg(F.max(F.struct("score", "sup", "s", "e")).alias("b")).select("query", "subject", F.col("b.score").alias("score"), F.col("b.s").alias("s"), F.col("b.e").alias("e"))
    return one.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("neg"), "subject", "s", "e"))).alias("hits"))  # an order's few parts


def f23_forward_hits(spark, folder):
    """Hits of an order by score that each begin behind the last one kept."""
    kept = hits.forward_only(F.col("hits"))
    return _ranked(spark, folder).select("query", F.size(kept).cast("long").alias("n_kept"), F.array_join(F.transform(kept, lambda h: h["subject"].cast("string")), ",").alias("subjects"))


def f25_fusions(spark, folder):
    """Orders with two or more hits apart from each other, and where to cut between them."""
    kept = hits.apart(F.col("hits"))
    t = _ranked(spark, folder).withColumn("kept", kept).where("size(kept) >= 2")
    return t.select("query", F.size("kept").cast("long").alias("n_kept"), F.array_join(F.transform(hits.fusion_cuts(F.col("kept")), lambda c: c.cast("string")), ",").alias("cuts"))


def j15_products_by_hit(spark, folder):
    """Coding parts with the product of their mRNA, or the product of none."""
    t = table(spark, folder, "intervals")
    named = t.where("featuretype = 'mRNA'").select("annot_id", "feat_id", "row_id", F.element_at(F.try_element_at("attributes", F.lit("product")), 1).alias("product")).where("product is not null")
    best = named.groupBy("annot_id", "feat_id").agg(F.max_by("product", "row_id").alias("product"))
    cds = t.where("featuretype = 'CDS'").select("row_id", "annot_id", F.col("parent_id").alias("feat_id"))
    return cds.join(best, ["annot_id", "feat_id"], "left").select("row_id", F.coalesce("product", F.lit(X.NO_PRODUCT)).alias("product"))


def a11_accepted_types(spark, folder):
    """Donor-acceptor pairs of clips (first and last two letters) common enough to accept."""
    t = table(spark, folder, "locus_rows").where("length(longest_clip) >= 4").select(F.concat_ws("-", F.left(F.upper("longest_clip"), F.lit(2)), F.right(F.upper("longest_clip"), F.lit(2))).alias("pair"), "n_clips")
    g = t.groupBy("pair").agg(F.count("*").alias("n"), F.sum("n_clips").alias("reads")).withColumn("all", F.sum("n").over(Window.partitionBy(F.lit(1))))
    return g.where("n >= 10 and reads >= 50 and n >= 0.004 * all and pair not in ('GT-AG', 'GC-AG')").select("pair", "n", "reads")


_PROD = "coalesce(attributes['product'], [])"
_H = """h AS (SELECT l_orderkey AS query, l_partkey AS subject, l_extendedprice AS score, l_suppkey AS sup, l_partkey % 300 + 1 AS s, l_partkey % 300 + 1 + CAST(l_quantity AS BIGINT) AS e FROM lineitem),
  o AS (SELECT query, subject, score, s, e FROM (SELECT *, row_number() OVER (PARTITION BY query, subject ORDER BY score DESC, sup DESC, s DESC, e DESC) AS k FROM h) WHERE k = 1),
  r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, subject) AS k FROM o)"""
_CLEAN = "CASE WHEN trim(replace(replace(split_part({p}, ' OS=', 1), ' (Fragment)', ''), '(Fragment)', '')) = '' THEN 'hypothetical protein' ELSE trim(replace(replace(split_part({p}, ' OS=', 1), ' (Fragment)', ''), '(Fragment)', '')) END"
_LV = r"lower(trim(level, E' \t\r\n'))"
QUERIES = {f.__name__: f for f in (
    a5_record_stats, a8_type_counts, a11_accepted_types, a27_drop_set, a28_clean_counts, a29_severities, a30_gene_lengths, a31_introns_per_gene, a37_coverage, f15_products, f16_notes, f23_forward_hits, f25_fusions,
    j15_products_by_hit, k4_record_lines, r4_ref_classes, s13_best_hits, w7_locus_tags, x1_combined, x4_completed,
)}
ORACLES = {
    "a5_record_stats": f"""WITH n AS (SELECT {_LV} AS level, count(*) FILTER (classification = 'match') AS n_match, count(*) FILTER (classification = 'missing') AS n_missing, count(*) FILTER (classification = 'fp') AS n_fp
      FROM feature_records WHERE {_LV} IN ('mrna', 'cds', 'intron') GROUP BY 1) SELECT *, coalesce(n_match / nullif(n_match + n_missing, 0), 0) AS sensitivity, coalesce(n_match / nullif(n_match + n_fp, 0), 0) AS "precision" FROM n""",
    "a8_type_counts": sql("SELECT label, kind, count(*) AS n FROM fr GROUP BY 1, 2"),
    "a11_accepted_types": """WITH t AS (SELECT left(upper(longest_clip), 2) || '-' || right(upper(longest_clip), 2) AS pair, n_clips FROM locus_rows WHERE length(longest_clip) >= 4),
      g AS (SELECT pair, count(*) AS n, CAST(sum(n_clips) AS BIGINT) AS reads FROM t GROUP BY 1) SELECT * FROM g WHERE n >= 10 AND reads >= 50 AND n >= 0.004 * (SELECT sum(n) FROM g) AND pair NOT IN ('GT-AG', 'GC-AG')""",
    "a27_drop_set": sql("""c AS (SELECT DISTINCT label, pid AS id FROM fp WHERE kind = 'CDS'), m AS (SELECT f.label, f.id, f.pid, c.id IS NOT NULL AS ok FROM fw f LEFT JOIN c ON c.label = f.label AND c.id = f.id WHERE kind = 'mRNA')
      SELECT label, 'mRNA' AS kind, id FROM m WHERE NOT ok UNION ALL SELECT g.label, 'gene', g.id FROM fw g WHERE kind = 'gene' AND NOT EXISTS (SELECT 1 FROM m WHERE ok AND m.label = g.label AND m.pid = g.id)"""),
    "a28_clean_counts": f"""SELECT annot_id AS label, CAST(sum(len(list_filter({_PROD}, lambda p: contains(p, ' OS=')))) AS BIGINT) AS products_cleaned,
      CAST(sum(len(list_filter({_PROD}, lambda p: contains(split_part(p, ' OS=', 1), '(Fragment)')))) AS BIGINT) AS fragments_stripped,
      CAST(sum(len(list_filter(coalesce(attributes['Dbxref'], []), lambda p: starts_with(p, 'KEGG:')))) AS BIGINT) AS kegg_moved FROM intervals GROUP BY 1""",
    "a29_severities": r"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL), s AS (SELECT regexp_extract(line, '^[^0-9A-Za-z_]*([A-Za-z]+(?:Error|Warning|Exception)):', 1) AS severity FROM l)
      SELECT severity, count(*) AS n FROM s WHERE severity <> '' GROUP BY 1""",
    "a30_gene_lengths": sql("""SELECT label, count(*) AS n, CAST(floor(avg(e - s)) + 2 * floor(coalesce(stddev_samp(e - s), 0)) AS BIGINT) AS maxlen, CAST(floor(avg(e - s) / 2) AS BIGINT) AS flank, greatest(count(*) // 4, 1) AS n_training FROM fw WHERE kind = 'gene' GROUP BY 1"""),
    "a31_introns_per_gene": sql("""g AS (SELECT m.label, m.pid AS gene, count(*) AS n FROM fp p JOIN fw m ON m.kind = 'mRNA' AND m.label = p.label AND m.id = p.pid WHERE p.kind = 'CDS' AND m.pid IS NOT NULL GROUP BY 1, 2),
      i AS (SELECT label, CAST(sum(greatest(n - 1, 0)) AS BIGINT) AS introns FROM g GROUP BY 1) SELECT a.label, genes, coalesce(introns, 0) AS introns, coalesce(introns, 0) / genes > 0.25 AS passes FROM (SELECT label, count(*) AS genes FROM fw WHERE kind = 'gene' GROUP BY 1) a LEFT JOIN i ON i.label = a.label"""),
    "a37_coverage": f"""SELECT annot_id AS label, count(*) FILTER (featuretype = 'gene') AS n_genes, count(*) FILTER (featuretype = 'mRNA') AS n_mrnas,
      count(*) FILTER (featuretype = 'mRNA' AND len(list_filter({_PROD}, lambda p: {_CLEAN.format(p="p")} <> 'hypothetical protein')) > 0) AS n_named FROM intervals WHERE featuretype IN ('gene', 'mRNA') GROUP BY 1""",
    "f15_products": f"WITH x AS (SELECT row_id, unnest(attributes['product']) AS p FROM intervals WHERE featuretype = 'mRNA') SELECT row_id, p AS product, {_CLEAN.format(p='p')} AS cleaned FROM x",
    "f16_notes": """WITH x AS (SELECT row_id, attributes['Dbxref'] AS d, coalesce(attributes['Note'], []) AS n FROM intervals WHERE attributes['Dbxref'] IS NOT NULL)
      SELECT row_id, nullif(array_to_string(list_filter(d, lambda v: NOT starts_with(v, 'KEGG:')), ','), '') AS dbxref, nullif(array_to_string(list_concat(n, list_filter(d, lambda v: starts_with(v, 'KEGG:'))), ','), '') AS note, split_part(d[1], ':', 1) AS first_db FROM x""",
    "f23_forward_hits": f"""WITH RECURSIVE {_H}, w AS (SELECT query, k, e AS last, CAST(1 AS BIGINT) AS n, CAST(subject AS VARCHAR) AS t FROM r WHERE k = 1
      UNION ALL SELECT r.query, r.k, CASE WHEN r.s > w.last THEN r.e ELSE w.last END, w.n + CASE WHEN r.s > w.last THEN 1 ELSE 0 END, CASE WHEN r.s > w.last THEN w.t || ',' || r.subject ELSE w.t END FROM w JOIN r ON r.query = w.query AND r.k = w.k + 1)
      SELECT query, n AS n_kept, t AS subjects FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY k DESC) AS z FROM w) WHERE z = 1""",
    "f25_fusions": f"""WITH RECURSIVE {_H}, w AS (SELECT query, k, [{{'s': s, 'e': e}}] AS kept FROM r WHERE k = 1
      UNION ALL SELECT r.query, r.k, CASE WHEN len(list_filter(w.kept, lambda x: greatest(0, least(x.e, r.e) - greatest(x.s, r.s) + 1) > 0.1 * least(x.e - x.s + 1, r.e - r.s + 1))) > 0 THEN w.kept ELSE list_append(w.kept, {{'s': r.s, 'e': r.e}}) END
      FROM w JOIN r ON r.query = w.query AND r.k = w.k + 1),
      z AS (SELECT query, list_sort(kept) AS kept FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY k DESC) AS q FROM w) WHERE q = 1 AND len(kept) >= 2)
      SELECT query, len(kept) AS n_kept, array_to_string(list_transform(range(1, len(kept)), lambda i: (kept[i].e + kept[i + 1].s) // 2), ',') AS cuts FROM z""",
    "j15_products_by_hit": """WITH m AS (SELECT annot_id, feat_id, arg_max(attributes['product'][1], row_id) AS product FROM intervals WHERE featuretype = 'mRNA' AND attributes['product'][1] IS NOT NULL GROUP BY 1, 2)
      SELECT c.row_id, coalesce(m.product, 'hypothetical protein') AS product FROM intervals c LEFT JOIN m ON m.annot_id = c.annot_id AND m.feat_id = c.parent_id WHERE c.featuretype = 'CDS'""",
    "k4_record_lines": """SELECT record_id, array_to_string([coalesce(level, ''), coalesce(classification, ''), coalesce(ref_id, ''), coalesce(pred_id, ''), coalesce(CAST(ref_start AS VARCHAR), ''), coalesce(CAST(ref_end AS VARCHAR), ''), coalesce(CAST(overlap_bp AS VARCHAR), ''),
      coalesce(printf('%.6f', sn), ''), coalesce(printf('%.6f', f1), '')], chr(9)) AS line FROM feature_records""",
    "r4_ref_classes": f"""SELECT ref_annot_id, ref_id, classification FROM (SELECT *, row_number() OVER (PARTITION BY ref_annot_id, ref_id ORDER BY compared_at DESC NULLS LAST, record_id DESC) AS k FROM feature_records WHERE {_LV} = 'gene' AND ref_id IS NOT NULL) WHERE k = 1""",
    "s13_best_hits": "SELECT query, subject, score FROM (SELECT l_orderkey AS query, l_partkey AS subject, l_extendedprice AS score, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey, l_quantity) AS k FROM lineitem) WHERE k = 1",
    "w7_locus_tags": sql("""g AS (SELECT *, format('LT_{:05d}', row_number() OVER (PARTITION BY label ORDER BY chrom, s // 1048576, s, e, id)) AS tag FROM fw WHERE kind = 'gene'),
      m AS (SELECT f.*, g.tag || '.mRNA.' || row_number() OVER (PARTITION BY f.label, f.pid ORDER BY f.s, f.e, f.id) AS tag FROM fw f JOIN g ON g.label = f.label AND g.id = f.pid WHERE f.kind = 'mRNA'),
      p AS (SELECT f.*, m.tag || ':' || f.kind || ':' || row_number() OVER (PARTITION BY f.label, f.pid, f.kind ORDER BY f.s, f.e, f.id) AS tag FROM fp f JOIN m ON m.label = f.label AND m.id = f.pid WHERE f.kind IN ('CDS', 'exon'))
      SELECT label, kind, id, s, e, tag FROM g UNION ALL SELECT label, kind, id, s, e, tag FROM m UNION ALL SELECT label, kind, id, s, e, tag FROM p"""),
    "x1_combined": sql("SELECT id, label, chrom, s, e FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE label WHEN 'gawenka_ref' THEN 0 WHEN 'sokboxe_augelin' THEN 1 ELSE 2 END, label) AS r FROM fw WHERE kind = 'gene') WHERE r = 1"),
    "x4_completed": sql("""b AS (SELECT * FROM fr WHERE kind IN ('gene', 'mRNA', 'exon', 'CDS') AND NOT (label = 'gawenka_ref' AND kind = 'CDS') AND NOT (label = 'sokboxe_augelin' AND kind = 'mRNA') AND NOT (label = 'fenpydu_ref' AND kind = 'exon')),
      h AS (SELECT label, bool_or(kind = 'mRNA') AS m, bool_or(kind = 'exon') AS x, bool_or(kind = 'CDS') AS c FROM b GROUP BY 1),
      u AS (SELECT label, kind, id FROM b UNION ALL SELECT b.label, 'mRNA', id || '_mRNA' FROM b JOIN h ON h.label = b.label WHERE kind = 'gene' AND NOT m
        UNION ALL SELECT b.label, 'CDS', CASE WHEN regexp_replace(id, '(?i)exon', 'CDS', 'g') = id THEN id || ':CDS' ELSE regexp_replace(id, '(?i)exon', 'CDS', 'g') END FROM b JOIN h ON h.label = b.label WHERE kind = 'exon' AND NOT c
        UNION ALL SELECT b.label, 'exon', CASE WHEN regexp_replace(id, '(?i)cds', 'exon', 'g') = id THEN id || ':exon' ELSE regexp_replace(id, '(?i)cds', 'exon', 'g') END FROM b JOIN h ON h.label = b.label WHERE kind = 'CDS' AND NOT x)
      SELECT label, kind, count(*) AS n, count(DISTINCT id) AS n_ids FROM u GROUP BY 1, 2"""),
}
