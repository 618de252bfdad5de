"""Writers with all rows and columns, whole-gene joins, strand adoption, clean-up counters, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.functions import text as X
from strandloom.functions.ids import BLANKS
from strandloom.operators import features, intervals, models, splicing
from strandloom.plans import annotation_queries as A
from strandloom.plans import sequence_queries as Q
from strandloom.plans.adapters import REFERENCE, parts, rows, sql, whole
from strandloom.plans.compare_queries import _PAIRS, j3_overlap_anti
from strandloom.plans.model_queries import _E, exons
from strandloom.sources.tables import table

_LINE = lambda kind, s, e, attrs: F.concat_ws("\t", "chrom", F.lit("merged"), kind, F.col(s).cast("string"), F.col(e).cast("string"), F.lit("."), "strand", F.lit("."), attrs)


def k1_lines(spark, folder):
    """Genes, their mRNAs, exons before coding parts, as feature lines with the keys of their file order."""
    g = whole(spark, folder, "gene").select("label", F.col("id").alias("g"), F.col("chrom").alias("gc"), F.col("s").alias("gs"), "chrom", "strand", "s", "e")
    gene = g.select("label", F.col("gc").alias("o1"), F.col("gs").alias("o2"), F.col("g").alias("o3"), F.lit(-1).cast("long").alias("o4"), F.lit("").alias("o5"), F.lit(-2).cast("long").alias("o6"), F.col("gs").alias("o7"), _LINE(F.lit("gene"), "s", "e", F.concat(F.lit("ID="), "g")).alias("line"))
    key = g.select("label", "g", "gc", "gs")
    m = whole(spark, folder, "mRNA").where("pid is not null").select("label", F.col("pid").alias("g"), F.col("id").alias("m"), "chrom", "strand", "s", "e").join(key, ["label", "g"])
    order = [F.col("gc").alias("o1"), F.col("gs").alias("o2"), F.col("g").alias("o3")]
    mrna = m.select("label", *order, F.col("s").alias("o4"), F.col("m").alias("o5"), F.lit(-1).cast("long").alias("o6"), F.col("s").alias("o7"), _LINE(F.lit("mRNA"), "s", "e", F.concat(F.lit("ID="), "m", F.lit(";Parent="), "g")).alias("line"))
    x = parts(spark, folder, "exon", "CDS").select("label", F.col("pid").alias("m"), "kind", "id", "chrom", "strand", "s", "e").join(m.select("label", "m", "g", "gc", "gs", F.col("s").alias("ms")), ["label", "m"])
    rank = F.when(F.col("kind") == "exon", 0).otherwise(1).cast("long")
    part = x.select("label", *order, F.col("ms").alias("o4"), F.col("m").alias("o5"), rank.alias("o6"), F.col("s").alias("o7"), _LINE(F.col("kind"), "s", "e", F.concat(F.lit("ID="), "id", F.lit(";Parent="), "m")).alias("line"))
    return gene.unionByName(mrna).unionByName(part)


RECORD = ["level", "classification", "ref_id", "pred_id", "chrom", "strand", "ref_start", "ref_end", "pred_start", "pred_end", "overlap_bp", "sn", "sp", "f1", "boundary_5p", "boundary_3p"]


def k4_full_records(spark, folder):
    """Comparison records as lines with the prediction first and all columns: empty for null, six decimals."""
    t = table(spark, folder, "feature_records")
    cell = lambda c: F.coalesce(F.format_string("%.6f", F.col(c)) if c in ("sn", "sp", "f1") else F.col(c).cast("string"), F.lit(""))
    shown = lambda c: F.when(F.col(c).isNull(), "").otherwise(cell(c))
    return t.select("record_id", F.concat_ws("\t", shown("pred_annot_id"), *[shown(c) for c in RECORD]).alias("line"))


def a28_all_counts(spark, folder):
    """What a clean-up changes in every annotation: products, fragments, references over three, dropped mRNAs and genes, moved references."""
    t = table(spark, folder, "intervals")
    lists = {k: F.coalesce(F.try_element_at("attributes", F.lit(k)), F.array().cast("array<string>")) for k in ("product", "Dbxref")}
    n = lambda arr, f: F.sum(F.size(F.filter(arr, f))).cast("long")
    changed = t.groupBy(F.col("annot_id").alias("label")).agg(
        n(lists["product"], lambda p: X.clean_product(p) != p).alias("products_cleaned"), n(lists["product"], lambda p: F.substring_index(p, " OS=", 1).contains("(Fragment)")).alias("fragments_stripped"),
        F.count_if(F.size(lists["Dbxref"]) > 3).alias("lists_capped"), n(lists["Dbxref"], lambda r: r.startswith("KEGG:")).alias("kegg_moved"),
    )
    drop = features.without_coding(whole(spark, folder, "gene"), whole(spark, folder, "mRNA"), parts(spark, folder, "CDS"))
    gone = drop.groupBy("label").agg(F.count_if(F.col("kind") == "mRNA").alias("mrnas_dropped"), F.count_if(F.col("kind") == "gene").alias("genes_dropped"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return changed.join(gone, "label", "left").select("label", "products_cleaned", "fragments_stripped", "lists_capped", "kegg_moved", zero("mrnas_dropped"), zero("genes_dropped"))


def a29_report_severities(spark, folder):
    """Lines of reports by their severity; reports are made of events, one line each."""
    kind = F.element_at(F.array(*[F.lit(x) for x in ("INFO", "WARNING", "ERROR", "FATAL", "note")]), (F.col("event_id") % 5 + 1).cast("int"))
    lines = table(spark, folder, "events").select(F.concat(kind, F.lit(": "), "event_type").alias("line"))
    return lines.select(F.regexp_extract("line", r"^(FATAL|ERROR|WARNING|INFO):", 1).alias("severity")).where("severity <> ''").groupBy("severity").agg(F.count("*").alias("n"))


def j3_with_descendants(spark, folder):
    """Reference genes that no prediction overlaps, with all that hangs below them."""
    free = j3_overlap_anti(spark, folder).select(F.col("id").alias("gene"))
    ref = F.col("label") == REFERENCE
    g = whole(spark, folder, "gene").where(ref).select(F.col("id").alias("gene"), F.lit("gene").alias("kind"), "id", "s", "e").join(free, "gene", "left_semi")
    m = whole(spark, folder, "mRNA").where(ref & F.col("pid").isNotNull()).select(F.col("pid").alias("gene"), F.lit("mRNA").alias("kind"), "id", "s", "e").join(free, "gene", "left_semi")
    up = m.select("gene", F.col("id").alias("pid")).unionByName(free.select("gene", F.col("gene").alias("pid")))
    x = parts(spark, folder, "exon", "CDS").where(ref).join(up, "pid").select("gene", "kind", "id", "s", "e")
    return g.unionByName(m).unionByName(x).distinct()


def j13_adopted_strands(spark, folder):
    """Transcripts with the strand their sites speak for: kept, adopted where it was open and all sites agree, or in conflict."""
    e = exons(spark, folder)
    spans = e.groupBy("tid", "chrom", "strand").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n_exons"))
    spans = spans.withColumn("id", F.concat_ws("|", "tid", "chrom", "strand"))
    sites = table(spark, folder, "locus_rows").where("pos is not null and side is not null and chrom is not null").select(F.col("locus_id").cast("string").alias("id"), "chrom", F.col("pos").alias("s"), F.when(F.col("side") == "5p", "+").otherwise("-").alias("site"))
    hits = intervals.containment(sites, spans).groupBy(F.col("b_id").alias("id")).agg(F.count_if(F.col("a_site") == "+").alias("plus"), F.count_if(F.col("a_site") == "-").alias("minus"))
    told = spans.join(hits, "id")
    own, other = F.when(F.col("strand") == "+", F.col("plus")).otherwise(F.col("minus")), F.when(F.col("strand") == "+", F.col("minus")).otherwise(F.col("plus"))
    open_ = F.col("strand") == "."
    call = F.when(open_ & ((F.col("plus") == 0) | (F.col("minus") == 0)), "adopted").when(open_, "open").when((own == 0) & (other > 0) & (F.col("n_exons") > 1), "conflict").otherwise("kept")
    new = F.when(call == "adopted", F.when(F.col("plus") > 0, "+").otherwise("-")).otherwise(F.col("strand"))
    return told.select("tid", "chrom", "strand", "plus", "minus", call.alias("call"), new.alias("new_strand"))


def a26_called_strands(spark, folder):
    """The strand of every order as a transcript: by its best hit if it has one, else by its introns' votes; without introns mono-exon."""
    votes = A.a26_strand_votes(spark, folder).select("tid", "plus", "minus", F.col("strand").alias("voted"))
    t = table(spark, folder, "orders").select(F.col("o_orderkey").alias("tid"), F.when(F.col("o_totalprice") > 200000, F.when(F.col("o_custkey") % 2 == 0, "+").otherwise("-")).alias("hit"))
    both = t.join(votes, "tid", "left")
    return both.select("tid", F.coalesce("hit", "voted", F.lit("mono-exon")).alias("strand"), F.when(F.col("hit").isNotNull(), "hit").when(F.col("voted").isNotNull(), "introns").otherwise("none").alias("by"))


def pr1_rewritten_ids(spark, folder):
    """Rows of the transcript dialect with ids and parents of the other: genes by their own id, transcripts below genes, parts below transcripts."""
    t = rows(spark, folder).where("kind in ('gene', 'mRNA', 'transcript', 'exon', 'CDS')")
    kind = F.when(F.col("kind") == "transcript", "mRNA").otherwise(F.col("kind"))
    attrs = F.when(F.col("kind") == "gene", F.concat(F.lit("ID="), "id")).when(F.col("kind").isin("mRNA", "transcript"), F.concat_ws(";", F.concat(F.lit("ID="), "id"), F.concat(F.lit("Parent="), "pid"))).otherwise(F.concat(F.lit("Parent="), F.coalesce("pid", "id")))
    return t.select("row_id", kind.alias("kind"), attrs.alias("attributes"))


def x1_with_descendants(spark, folder, rank=("gawenka_ref", "sokboxe_augelin")):
    """Genes of all annotations, an id from the annotation that ranks first, with the mRNAs of the annotation taken."""
    genes = features.combined(whole(spark, folder, "gene").select("label", "id", "chrom", "s", "e"), {k: i for i, k in enumerate(rank)})
    m = whole(spark, folder, "mRNA").where("pid is not null").select("label", F.col("pid").alias("gene"), "id", "chrom", "s", "e")
    below = m.join(genes.select("label", F.col("id").alias("gene")), ["label", "gene"], "left_semi")
    return genes.select("label", F.col("id").alias("gene"), F.lit("gene").alias("kind"), "id", "s", "e").unionByName(below.select("label", "gene", F.lit("mRNA").alias("kind"), "id", "s", "e"))


def f7_enumerated(spark, folder):
    """Every key with each of its one-letter neighbours that is a key too, neighbours made letter by letter."""
    k = table(spark, folder, "locus_rows").select(F.upper(F.btrim("motif_key", F.lit(BLANKS))).alias("key")).where("key rlike '^[ACGT]+$'").distinct()
    made = k.select("key", F.explode(S.neighbours(F.col("key"))).alias("neighbour"))
    return made.join(k.withColumnRenamed("key", "neighbour"), "neighbour", "left_semi").select("key", "neighbour")


def r11_prettified(spark, folder):
    """Coding parts with their phase and the running tag of their gene."""
    keep = ["label", "id", "pid", "chrom", "strand", "s", "e", "kind"]
    tags = features.locus_tags(whole(spark, folder, "gene").select(*keep), "LT").select("label", F.col("id").alias("gene"), "tag")
    mrna = whole(spark, folder, "mRNA").where("pid is not null").select("label", F.col("id").alias("pid"), F.col("pid").alias("gene"))
    return models.phases(parts(spark, folder, "CDS")).join(mrna, ["label", "pid"]).join(tags, ["label", "gene"]).select("label", "tag", "pid", "id", "s", "e", "phase")


def r15_joint_leader(spark, folder):
    """The leader that clips agree on: the commonest end motif of three clips or more that no adapter explains, ties by the motif."""
    m = Q.a23_end_motifs(spark, folder).agg(F.min(F.struct((-F.col("n")).alias("n"), "motif")).alias("b"))
    return m.select(F.col("b.motif").alias("leader"), (-F.col("b.n")).alias("n"))


def r16_acceptors(spark, folder):
    """Sites whose clip ends (5p) or begins, read backwards (3p), within a letter of the last eight of a leader: support and libraries."""
    t = table(spark, folder, "locus_rows").where("longest_clip is not null and pos is not null and chrom is not null and side is not null")
    clip = F.upper("longest_clip")
    facing = F.when(F.col("side") == "5p", clip).otherwise(S.reverse_complement(clip))
    hit = S.near_positions(facing, "TTTGATCA", 1)
    return t.where(F.size(hit) > 0).groupBy("chrom", F.when(F.col("side") == "5p", "+").otherwise("-").alias("strand"), "pos").agg(F.count("*").alias("support"), F.count_distinct("library_id").alias("n_libraries"))


def r27_transcript_report(spark, folder):
    """Transcripts by source: how many, how many without a strand, and the share of them."""
    t = table(spark, folder, "transcripts").where("tid is not null").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("strand").isNull() | ~F.col("strand").isin("+", "-")).alias("n_open"))
    return t.select("source", "n", "n_open", (F.col("n_open") / F.col("n")).alias("share"))


def s6_consecutive_models(spark, folder):
    """Runs of exon lines with one parent in the order of a transcript's lines; a parent met again later is a run of its own."""
    x = table(spark, folder, "intervals").where("featuretype = 'exon' and line_no is not null").select("annot_id", "line_no", "row_id", "parent_id")
    region = F.floor(F.col("line_no") / LINES)
    inner = Window.partitionBy("annot_id", "region").orderBy("line_no", "row_id")
    local = x.withColumn("region", region).withColumns({"before": F.lag(F.struct("parent_id")).over(inner), "k": F.row_number().over(inner)})
    ends = local.groupBy("annot_id", "region").agg(F.max_by(F.struct("parent_id"), F.struct("line_no", "row_id")).alias("end"))
    carry = ends.withColumn("carry", F.lag("end").over(Window.partitionBy("annot_id").orderBy("region"))).drop("end")  # one row per region
    told = local.join(carry, ["annot_id", "region"]).withColumn("before", F.when(F.col("k") == 1, F.col("carry")).otherwise(F.col("before")))
    return told.where(F.col("before").isNull() | ~F.col("before.parent_id").eqNullSafe(F.col("parent_id"))).groupBy("annot_id", "parent_id").agg(F.count("*").alias("n_runs"))


LINES = 1 << 16  # lines of a region

QUERIES = {f.__name__: f for f in (
    k1_lines, k4_full_records, a28_all_counts, a29_report_severities, j3_with_descendants, j13_adopted_strands, a26_called_strands, pr1_rewritten_ids, x1_with_descendants, f7_enumerated, r11_prettified, r15_joint_leader, r16_acceptors,
    r27_transcript_report, s6_consecutive_models,
)}
_CL = "CASE WHEN trim(replace(replace(split_part({p}, ' OS=', 1), ' (Fragment)', ''), '(Fragment)', '')) = '' THEN 'hypothetical protein' ELSE trim(replace(replace(split_part({p}, ' OS=', 1), ' (Fragment)', ''), '(Fragment)', '')) END"
_REC = ", ".join(f"coalesce(printf('%.6f', {c}), '')" if c in ("sn", "sp", "f1") else f"coalesce(CAST({c} AS VARCHAR), '')" for c in ["pred_annot_id", *RECORD])
ORACLES = {
    "k1_lines": sql("""j AS (SELECT g.label, g.chrom AS o1, g.s AS o2, g.id AS o3, m.s AS o4, m.id AS o5, m.chrom, m.strand, m.s, m.e FROM fw g JOIN fw m ON g.kind = 'gene' AND m.kind = 'mRNA' AND m.label = g.label AND m.pid = g.id)
      SELECT label, chrom AS o1, s AS o2, id AS o3, -1 AS o4, '' AS o5, -2 AS o6, s AS o7, concat_ws(chr(9), chrom, 'merged', 'gene', s, e, '.', strand, '.', 'ID=' || id) AS line FROM fw WHERE kind = 'gene'
      UNION ALL SELECT label, o1, o2, o3, o4, o5, -1, s, concat_ws(chr(9), chrom, 'merged', 'mRNA', s, e, '.', strand, '.', 'ID=' || o5 || ';Parent=' || o3) FROM j
      UNION ALL SELECT j.label, o1, o2, o3, o4, o5, CASE WHEN p.kind = 'exon' THEN 0 ELSE 1 END, p.s, concat_ws(chr(9), p.chrom, 'merged', p.kind, p.s, p.e, '.', p.strand, '.', 'ID=' || p.id || ';Parent=' || o5) FROM j JOIN fp p ON p.label = j.label AND p.pid = j.o5 AND p.kind IN ('exon', 'CDS')"""),
    "k4_full_records": f"SELECT record_id, array_to_string([{_REC}], chr(9)) AS line FROM feature_records",
    "a28_all_counts": sql(f"""c AS (SELECT DISTINCT label, pid AS id FROM fp WHERE kind = 'CDS'), m AS (SELECT f.label, f.id, f.pid, c.id IS NOT NULL AS ok FROM fw f LEFT JOIN c ON c.label = f.label AND c.id = f.id WHERE kind = 'mRNA'),
      d AS (SELECT label, 'mRNA' AS kind FROM m WHERE NOT ok UNION ALL SELECT g.label, 'gene' FROM fw g WHERE kind = 'gene' AND NOT EXISTS (SELECT 1 FROM m WHERE ok AND m.label = g.label AND m.pid = g.id)),
      n AS (SELECT annot_id AS label, CAST(sum(len(list_filter(coalesce(attributes['product'], []), lambda p: {_CL.format(p='p')} <> p))) AS BIGINT) AS products_cleaned, CAST(sum(len(list_filter(coalesce(attributes['product'], []), lambda p: contains(split_part(p, ' OS=', 1), '(Fragment)')))) AS BIGINT) AS fragments_stripped,
        count(*) FILTER (len(coalesce(attributes['Dbxref'], [])) > 3) AS lists_capped, CAST(sum(len(list_filter(coalesce(attributes['Dbxref'], []), lambda p: starts_with(p, 'KEGG:')))) AS BIGINT) AS kegg_moved FROM intervals GROUP BY 1)
      SELECT n.*, (SELECT count(*) FROM d WHERE d.label = n.label AND kind = 'mRNA') AS mrnas_dropped, (SELECT count(*) FROM d WHERE d.label = n.label AND kind = 'gene') AS genes_dropped FROM n"""),
    "a29_report_severities": "SELECT ['INFO', 'WARNING', 'ERROR', 'FATAL'][event_id % 5 + 1] AS severity, count(*) AS n FROM events WHERE event_id % 5 < 4 GROUP BY 1",
    "j3_with_descendants": sql(_PAIRS + """, c AS (SELECT pid AS id FROM fp WHERE kind = 'CDS' AND label = 'gawenka_ref'), m AS (SELECT id, pid, s, e FROM fw WHERE kind = 'mRNA' AND label = 'gawenka_ref' AND pid IS NOT NULL),
      k AS (SELECT id FROM c UNION SELECT m.pid FROM m JOIN c ON c.id = m.id), fr2 AS (SELECT id FROM r WHERE id NOT IN (SELECT a FROM o) AND id IN (SELECT id FROM k WHERE id IS NOT NULL)),
      u AS (SELECT pid AS gene, id AS pid FROM m WHERE pid IN (SELECT id FROM fr2) UNION SELECT id, id FROM fr2)
      SELECT id AS gene, 'gene' AS kind, id, s, e FROM r WHERE id IN (SELECT id FROM fr2) UNION SELECT pid, 'mRNA', id, s, e FROM m WHERE pid IN (SELECT id FROM fr2)
      UNION SELECT u.gene, x.kind, x.id, x.s, x.e FROM fp x JOIN u ON u.pid = x.pid WHERE x.label = 'gawenka_ref' AND x.kind IN ('exon', 'CDS')"""),
    "j13_adopted_strands": f"""WITH {_E}, sp AS (SELECT tid, chrom, strand, min(s) AS s, max(e) AS e, count(*) AS n FROM ex GROUP BY 1, 2, 3),
      h AS (SELECT sp.tid, sp.chrom, sp.strand, n, count(*) FILTER (side = '5p') AS plus, count(*) FILTER (side <> '5p') AS minus FROM sp JOIN locus_rows l ON l.chrom = sp.chrom AND l.pos BETWEEN sp.s AND sp.e WHERE side IS NOT NULL GROUP BY 1, 2, 3, 4),
      c AS (SELECT *, CASE WHEN strand = '.' AND (plus = 0 OR minus = 0) THEN 'adopted' WHEN strand = '.' THEN 'open' WHEN CASE WHEN strand = '+' THEN plus ELSE minus END = 0 AND n > 1 THEN 'conflict' ELSE 'kept' END AS call FROM h)
      SELECT tid, chrom, strand, plus, minus, call, CASE WHEN call = 'adopted' THEN CASE WHEN plus > 0 THEN '+' ELSE '-' END ELSE strand END AS new_strand FROM c""",
    "a26_called_strands": f"""WITH {A._PR}, v AS (SELECT tid, count(*) FILTER (pair = 'AA-CC') AS plus, count(*) FILTER (pair = 'GG-TT') AS minus FROM pr GROUP BY 1), w AS (SELECT tid, CASE WHEN plus > minus THEN '+' WHEN minus > plus THEN '-' ELSE 'ambiguous' END AS voted FROM v),
      t AS (SELECT o_orderkey AS tid, CASE WHEN o_totalprice > 200000 THEN CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END END AS hit FROM orders)
      SELECT t.tid, coalesce(hit, voted, 'mono-exon') AS strand, CASE WHEN hit IS NOT NULL THEN 'hit' WHEN voted IS NOT NULL THEN 'introns' ELSE 'none' END AS by FROM t LEFT JOIN w ON w.tid = t.tid""",
    "pr1_rewritten_ids": sql("""SELECT row_id, CASE kind WHEN 'transcript' THEN 'mRNA' ELSE kind END AS kind, CASE WHEN kind = 'gene' THEN 'ID=' || id WHEN kind IN ('mRNA', 'transcript') THEN concat_ws(';', 'ID=' || id, 'Parent=' || pid) ELSE 'Parent=' || coalesce(pid, id) END AS attributes
      FROM fr WHERE kind IN ('gene', 'mRNA', 'transcript', 'exon', 'CDS')"""),
    "x1_with_descendants": sql("""g AS (SELECT label, id, s, e FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE label WHEN 'gawenka_ref' THEN 0 WHEN 'sokboxe_augelin' THEN 1 ELSE 2 END, label) AS r FROM fw WHERE kind = 'gene') WHERE r = 1)
      SELECT label, id AS gene, 'gene' AS kind, id, s, e FROM g UNION ALL SELECT m.label, m.pid, 'mRNA', m.id, m.s, m.e FROM fw m JOIN g ON g.label = m.label AND g.id = m.pid WHERE m.kind = 'mRNA'"""),
    "f7_enumerated": r"""WITH k AS (SELECT DISTINCT upper(trim(motif_key, E' \t\r\n')) AS key FROM locus_rows WHERE regexp_full_match(upper(trim(motif_key, E' \t\r\n')), '[ACGT]+')),
      h AS (SELECT key, i, left(key, i - 1) || '_' || substr(key, i + 1) AS hole FROM (SELECT key, unnest(range(1, length(key) + 1)) AS i FROM k)) SELECT a.key, b.key AS neighbour FROM h a JOIN h b ON a.i = b.i AND a.hole = b.hole AND a.key <> b.key""",
    "r11_prettified": sql("""g AS (SELECT label, id, format('LT_{:05d}', row_number() OVER (PARTITION BY label ORDER BY chrom, s // 1048576, s, e, id)) AS tag FROM fw WHERE kind = 'gene'),
      x AS (SELECT *, coalesce(sum(e - s + 1) OVER (PARTITION BY label, pid ORDER BY CASE WHEN strand = '-' THEN -e ELSE s END, s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS d FROM fp WHERE kind = 'CDS')
      SELECT x.label, g.tag, x.pid, x.id, x.s, x.e, CAST((3 - d % 3) % 3 AS BIGINT) AS phase FROM x JOIN fw m ON m.kind = 'mRNA' AND m.label = x.label AND m.id = x.pid JOIN g ON g.label = m.label AND g.id = m.pid"""),
    "r15_joint_leader": "SELECT motif AS leader, n FROM (" + Q.ORACLES["a23_end_motifs"] + ") ORDER BY n DESC, motif LIMIT 1",
    "r16_acceptors": """WITH t AS (SELECT *, CASE WHEN side = '5p' THEN upper(longest_clip) ELSE reverse(translate(upper(longest_clip), 'ACGTN', 'TGCAN')) END AS f FROM locus_rows WHERE longest_clip IS NOT NULL AND pos IS NOT NULL AND chrom IS NOT NULL AND side IS NOT NULL)
      SELECT chrom, CASE WHEN side = '5p' THEN '+' ELSE '-' END AS strand, pos, count(*) AS support, count(DISTINCT library_id) AS n_libraries FROM t WHERE length(f) >= 8 AND len(list_filter(range(1, length(f) - 6), lambda i: hamming(f[i : i + 7], 'TTTGATCA') <= 1)) > 0 GROUP BY 1, 2, 3""",
    "r27_transcript_report": "SELECT source, count(*) AS n, count(*) FILTER (strand IS NULL OR strand NOT IN ('+', '-')) AS n_open, count(*) FILTER (strand IS NULL OR strand NOT IN ('+', '-')) / count(*) AS share FROM transcripts WHERE tid IS NOT NULL GROUP BY 1",
    "s6_consecutive_models": """WITH x AS (SELECT annot_id, parent_id, line_no, row_id, lag(parent_id) OVER w AS b, row_number() OVER w AS k FROM intervals WHERE featuretype = 'exon' AND line_no IS NOT NULL WINDOW w AS (PARTITION BY annot_id ORDER BY line_no, row_id))
      SELECT annot_id, parent_id, count(*) AS n_runs FROM x WHERE k = 1 OR b IS DISTINCT FROM parent_id GROUP BY 1, 2""",
}
