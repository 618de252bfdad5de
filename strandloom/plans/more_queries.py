"""Smaller operators: probes, hints, numbering, projections of hits and models, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.functions import text as X
from strandloom.functions.ids import BLANKS
from strandloom.operators import features, intervals, models
from strandloom.plans import annotation_queries as A
from strandloom.plans.adapters import parts, rows, sql, whole
from strandloom.plans.compare_queries import j5_concordant
from strandloom.plans.model_queries import _E, exons
from strandloom.sources.tables import table


def a10_splice_tally(spark, folder):
    """Introns and the orders they come from by pair; introns without one are ``unknown``."""
    t = A._pairs(spark, folder).withColumn("pair", F.coalesce("pair", F.lit("unknown")))
    return t.groupBy("pair").agg(F.count("*").alias("n"), F.count_distinct("tid").alias("n_reads"))


def pr10_repeat_hints(spark, folder):
    """Exons as hints against coding parts."""
    return parts(spark, folder, "exon").select("label", "id", F.concat_ws("\t", "chrom", F.lit("rm"), F.lit("nonexonpart"), F.col("s").cast("string"), F.col("e").cast("string"), F.lit("0"), F.lit("."), F.lit("."), F.lit("src=RM")).alias("line"))


def pr12_intron_gate(spark, folder):
    """Introns of an annotation and whether there are enough to train on."""
    w = Window.partitionBy("label", "pid").orderBy("s", "e", "id")
    i = parts(spark, folder, "CDS").withColumn("nx", F.lead("s").over(w)).where("nx is not null")
    return i.groupBy("label").agg(F.count("*").alias("n")).withColumn("enough", F.col("n") >= 150)


def pr13_headers(spark, folder):
    """First word of every document."""
    return table(spark, folder, "documents").where("text is not null").select("doc_id", F.regexp_extract("text", r"^(\S+)", 1).alias("header"))


def s2_unique_ids(spark, folder):
    """Ids made unique within an annotation: the first keeps its id, later rows get a number."""
    w = Window.partitionBy("label", "id").orderBy("row_id")
    t = rows(spark, folder).withColumn("k", F.row_number().over(w) - 1)
    return t.select("row_id", "label", F.when(F.col("k") == 0, F.col("id")).otherwise(F.concat("id", F.lit("_"), F.col("k").cast("string"))).alias("id"))


def s14_positional_hits(spark, folder):
    """Frames as hits: ends in order, the sign of the strand."""
    t = table(spark, folder, "orfs").where("id is not null and start is not null and stop is not null")
    return t.select("orf_no", F.least("start", "stop").alias("qlo"), F.greatest("start", "stop").alias("qhi"), F.when(F.col("strand") == "-", -(F.col("frame") + 1)).otherwise(F.col("frame") + 1).alias("qframe"))


def s20_first_source(spark, folder):
    """The source of the first line of every annotation."""
    return table(spark, folder, "intervals").where("line_no is not null").groupBy("annot_id").agg(F.min_by("source", F.struct("line_no", "row_id")).alias("source"))


def s21_probe(spark, folder):
    """Of the first ten rows of every annotation, how many have coordinates and an id; empty ones do not appear."""
    w = Window.partitionBy("annot_id").orderBy("line_no", "row_id")
    t = table(spark, folder, "intervals").withColumn("k", F.row_number().over(w)).where("k <= 10")
    ok = F.col("start").isNotNull() & F.col("end_").isNotNull() & F.col("feat_id").isNotNull()
    return t.groupBy("annot_id").agg(F.count("*").alias("n"), F.count_if(ok).alias("n_ok"))


def k5_site_lines(spark, folder):
    """Clustered sites numbered by place, as feature lines."""
    sites = table(spark, folder, "locus_rows").where("pos is not null and chrom is not null and n_clips is not null").groupBy("chrom", "pos").agg(F.sum("n_clips").alias("support"))
    c = intervals.distance_clusters(sites, ("chrom",), "pos", "support", 5).select(F.lit("sl").alias("label"), F.col("pos").cast("string").alias("id"), "chrom", F.col("pos").alias("s"), F.col("pos").alias("e"), "support")
    tagged = features.locus_tags(c, "sl")
    return tagged.select("tag", F.concat_ws("\t", "chrom", F.lit("sites"), F.lit("acceptor"), F.col("s").cast("string"), F.col("s").cast("string"), F.col("support").cast("string"), F.lit("."), F.lit("."), F.concat(F.lit("ID="), "tag")).alias("line"))


def k13_cleaned(spark, folder):
    """mRNAs that keep their place after clean-up, with cleaned products."""
    drop = features.without_coding(whole(spark, folder, "gene"), whole(spark, folder, "mRNA"), parts(spark, folder, "CDS")).where("kind = 'mRNA'").select("label", "id")
    t = table(spark, folder, "intervals").where("featuretype = 'mRNA'").select("row_id", F.col("annot_id").alias("label"), F.btrim("feat_id", F.lit(BLANKS)).alias("id"), F.try_element_at(F.try_element_at("attributes", F.lit("product")), F.lit(1)).alias("product"))
    return t.join(drop, ["label", "id"], "left_anti").select("row_id", "label", F.coalesce(X.clean_product(F.col("product")), F.lit(X.NO_PRODUCT)).alias("product"))


def f9_short_clips(spark, folder):
    """Clips shorter than a key that fit the key their locus was given, at the alignment's side."""
    t = table(spark, folder, "locus_rows").where("longest_clip is not null and motif_key is not null and side is not null")
    key, clip = F.upper(F.btrim("motif_key", F.lit(BLANKS))), F.upper("longest_clip")
    fits = F.when(F.col("side") == "5p", F.endswith(key, clip)).otherwise(F.startswith(key, clip))
    return t.where((F.length("longest_clip") < 12) & (F.length("longest_clip") > 0)).select("locus_id", fits.alias("fits"))


def f24_hit_overlap(spark, folder):
    """Share of the shorter frame that each frame of a transcript has in common with the next longest."""
    w = Window.partitionBy("id").orderBy(F.col("orflen").desc(), "orf_no")
    t = table(spark, folder, "orfs").where("id is not null and orflen > 0 and start is not null and stop > start").withColumns({"ns": F.lead("start").over(w), "ne": F.lead("stop").over(w)}).where("ns is not null")
    shared = F.greatest(F.lit(0), F.least("stop", "ne") - F.greatest("start", "ns") + 1)
    return t.select("orf_no", (shared / F.least(F.col("stop") - F.col("start") + 1, F.col("ne") - F.col("ns") + 1)).alias("share"))


def f27_coding_strand(spark, folder):
    """Strand of a frame on the genome: its own sign on that of its transcript, an unknown one counting as forward."""
    m = exons(spark, folder).select(F.col("tid").alias("id"), F.col("strand").alias("label")).distinct()
    o = table(spark, folder, "orfs").where("id is not null and strand is not null").select("orf_no", "id", "strand")
    return o.join(m, "id").select("orf_no", "label", F.when((F.col("strand") == "-") == (F.col("label") == "-"), "+").otherwise("-").alias("coding"))


def f30_splice_codes(spark, folder):
    """Pairs as four small letters; what is no pair is left out."""
    return A._pairs(spark, folder).where(F.col("pair").rlike("^[ACGT]{2}-[ACGT]{2}$")).groupBy(F.lower(F.replace(F.col("pair"), F.lit("-"), F.lit(""))).alias("code")).agg(F.count("*").alias("n"))


def f31_pieces(spark, folder):
    """Clips cut after every 30 bases, pieces under 10 dropped, numbered over those kept."""
    t = table(spark, folder, "locus_rows").where("length(longest_clip) > 0")
    n = F.ceil(F.length("longest_clip") / 30).cast("int")
    cut = t.select("locus_id", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr("longest_clip", i * 30 + 1, F.lit(30)))).alias("k", "piece"))
    return cut.where("length(piece) >= 10").select("locus_id", (F.col("k") + 1).cast("long").alias("k"), "piece")


def f35_durations(spark, folder):
    """Seconds from a clean-up run to the last drop listed under it."""
    r = table(spark, folder, "cleanup_reports").where("report_id is not null and run_at is not null").groupBy("report_id").agg(F.min("run_at").alias("a"))
    d = table(spark, folder, "cleanup_drops").where("dropped_at is not null").groupBy("report_id").agg(F.max("dropped_at").alias("b"))
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return r.join(d, "report_id").select("report_id", F.floor((us("b") - us("a")) / 1000000).cast("long").alias("seconds"))


def j6_concordant_features(spark, folder):
    """Models and parts below every gene that another annotation agrees with."""
    g = j5_concordant(spark, folder).select("label", F.col("gene_id").alias("g")).distinct()
    m = whole(spark, folder, "mRNA").where("pid is not null").select("label", F.col("pid").alias("g"), F.col("id").alias("m")).join(g, ["label", "g"])
    x = parts(spark, folder, "exon", "CDS").select("label", F.col("pid").alias("m"), "kind", "id", "s", "e").join(m, ["label", "m"])
    return x.select("label", "g", "kind", "id", "s", "e")


def j19_best_source(spark, folder):
    """For every transcript the first of its sources by rank, and when it was made."""
    order = F.array_position(F.array(*[F.lit(s) for s in ("longread", "guided", "denovo", "combrix-assembly")]), F.col("source"))
    t = table(spark, folder, "transcripts").where("tid is not null and source is not null").withColumn("rank", order)
    return t.groupBy("tid").agg(F.min_by("source", F.struct("rank", "assembled_at")).alias("source"), F.count("*").alias("n"))


def w27_seams(spark, folder):
    """The middle of every gap between the exons of a model."""
    return models.numbered(exons(spark, folder)).where("gap is not null").select("tid", "chrom", "strand", "k", F.floor((2 * F.col("e") + F.col("gap") + 1) / 2).alias("seam"))


def x8_distinct_sources(spark, folder):
    """Sources of a transcript, each once, in order of time."""
    t = table(spark, folder, "transcripts").where("tid is not null and source is not null and assembled_at is not null")
    first = t.groupBy("tid", "source").agg(F.min("assembled_at").alias("assembled_at"))  # a transcript has few sources, however many rows
    return first.groupBy("tid").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("assembled_at", "source"))), lambda x: x["source"]), ",").alias("sources"))


QUERIES = {f.__name__: f for f in (
    a10_splice_tally, pr10_repeat_hints, pr12_intron_gate, pr13_headers, s2_unique_ids, s14_positional_hits, s20_first_source, s21_probe, k5_site_lines, k13_cleaned, f9_short_clips, f24_hit_overlap, f27_coding_strand, f30_splice_codes, f31_pieces, f35_durations,
    j6_concordant_features, j19_best_source, w27_seams, x8_distinct_sources,
)}
_KEY = r"upper(trim(motif_key, E' \t\r\n'))"
_CLEAN = "CASE WHEN trim(replace(replace(split_part(p, ' OS=', 1), ' (Fragment)', ''), '(Fragment)', '')) = '' THEN 'hypothetical protein' ELSE trim(replace(replace(split_part(p, ' OS=', 1), ' (Fragment)', ''), '(Fragment)', '')) END"
_J6 = """cd AS (SELECT label, pid AS id, list({'s': s, 'e': e} ORDER BY s, e) AS c FROM fp WHERE kind = 'CDS' GROUP BY 1, 2),
  m AS (SELECT f.label, f.id, f.pid, f.chrom, f.strand, f.s, f.e, cd.c, len(cd.c) AS n FROM fw f JOIN cd ON cd.label = f.label AND cd.id = f.id WHERE kind = 'mRNA'),
  g AS (SELECT DISTINCT a.label, a.pid AS g FROM m a JOIN m b ON a.label <> b.label AND a.chrom = b.chrom AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e
  WHERE a.pid IS NOT NULL AND a.n = b.n AND abs(a.s - b.s) <= 0.05 * greatest(a.e - a.s, b.e - b.s, 1) AND abs(a.e - b.e) <= 0.05 * greatest(a.e - a.s, b.e - b.s, 1)
  AND (a.n = 1 OR len(list_filter(range(1, a.n + 1), lambda i: (i > 1 AND abs(a.c[i].s - b.c[i].s) > 3) OR (i < a.n AND abs(a.c[i].e - b.c[i].e) > 3))) = 0))"""
ORACLES = {
    "a10_splice_tally": f"WITH {A._PR} SELECT coalesce(pair, 'unknown') AS pair, count(*) AS n, count(DISTINCT tid) AS n_reads FROM pr GROUP BY 1",
    "pr10_repeat_hints": sql("SELECT label, id, concat_ws(chr(9), chrom, 'rm', 'nonexonpart', s, e, '0', '.', '.', 'src=RM') AS line FROM fp WHERE kind = 'exon'"),
    "pr12_intron_gate": sql("x AS (SELECT label, lead(s) OVER (PARTITION BY label, pid ORDER BY s, e, id) AS nx FROM fp WHERE kind = 'CDS') SELECT label, count(*) AS n, count(*) >= 150 AS enough FROM x WHERE nx IS NOT NULL GROUP BY 1"),
    "pr13_headers": r"SELECT doc_id, regexp_extract(text, '^(\S+)', 1) AS header FROM documents WHERE text IS NOT NULL",
    "s2_unique_ids": sql("x AS (SELECT *, row_number() OVER (PARTITION BY label, id ORDER BY row_id) - 1 AS k FROM fr) SELECT row_id, label, CASE WHEN k = 0 THEN id ELSE id || '_' || k END AS id FROM x"),
    "s14_positional_hits": "SELECT orf_no, least(start, stop) AS qlo, greatest(start, stop) AS qhi, CASE WHEN strand = '-' THEN -(frame + 1) ELSE frame + 1 END AS qframe FROM orfs WHERE id IS NOT NULL AND start IS NOT NULL AND stop IS NOT NULL",
    "s20_first_source": "SELECT annot_id, source FROM (SELECT annot_id, source, row_number() OVER (PARTITION BY annot_id ORDER BY line_no, row_id) AS k FROM intervals WHERE line_no IS NOT NULL) WHERE k = 1",
    "s21_probe": "WITH x AS (SELECT *, row_number() OVER (PARTITION BY annot_id ORDER BY line_no NULLS FIRST, row_id) AS k FROM intervals) SELECT annot_id, count(*) AS n, count(*) FILTER (start IS NOT NULL AND end_ IS NOT NULL AND feat_id IS NOT NULL) AS n_ok FROM x WHERE k <= 10 GROUP BY 1",
    "k5_site_lines": """WITH x AS (SELECT chrom, pos, sum(n_clips) AS support FROM locus_rows WHERE pos IS NOT NULL AND chrom IS NOT NULL AND n_clips IS NOT NULL GROUP BY 1, 2),
      y AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom ORDER BY pos) <= 5 THEN 0 ELSE 1 END AS f FROM x), z AS (SELECT *, sum(f) OVER (PARTITION BY chrom ORDER BY pos) AS g FROM y),
      c AS (SELECT chrom, (list(pos ORDER BY support DESC, pos))[1] AS pos, CAST(sum(support) AS BIGINT) AS support FROM z GROUP BY chrom, g), t AS (SELECT *, format('sl_{:05d}', row_number() OVER (ORDER BY chrom, pos)) AS tag FROM c)
      SELECT tag, concat_ws(chr(9), chrom, 'sites', 'acceptor', pos, pos, support, '.', '.', 'ID=' || tag) AS line FROM t""",
    "k13_cleaned": sql(r"""c AS (SELECT DISTINCT label, pid AS id FROM fp WHERE kind = 'CDS'), dr AS (SELECT f.label, f.id FROM fw f LEFT JOIN c ON c.label = f.label AND c.id = f.id WHERE kind = 'mRNA' AND c.id IS NULL),
      t AS (SELECT row_id, annot_id AS label, trim(feat_id, E' \t\r\n') AS id, attributes['product'][1] AS p FROM intervals WHERE featuretype = 'mRNA')
      SELECT row_id, label, coalesce(""" + _CLEAN + ", 'hypothetical protein') AS product FROM t WHERE NOT EXISTS (SELECT 1 FROM dr WHERE dr.label = t.label AND dr.id = t.id)"),
    "f9_short_clips": f"SELECT locus_id, CASE WHEN side = '5p' THEN ends_with({_KEY}, upper(longest_clip)) ELSE starts_with({_KEY}, upper(longest_clip)) END AS fits FROM locus_rows WHERE motif_key IS NOT NULL AND side IS NOT NULL AND length(longest_clip) BETWEEN 1 AND 11",
    "f24_hit_overlap": """WITH x AS (SELECT *, lead(start) OVER w AS ns, lead(stop) OVER w AS ne FROM orfs WHERE id IS NOT NULL AND orflen > 0 AND start IS NOT NULL AND stop > start WINDOW w AS (PARTITION BY id ORDER BY orflen DESC, orf_no))
      SELECT orf_no, greatest(0, least(stop, ne) - greatest(start, ns) + 1) / least(stop - start + 1, ne - ns + 1) AS share FROM x WHERE ns IS NOT NULL""",
    "f27_coding_strand": f"WITH {_E}, m AS (SELECT DISTINCT tid AS id, strand AS label FROM ex) SELECT o.orf_no, m.label, CASE WHEN (o.strand = '-') = (m.label = '-') THEN '+' ELSE '-' END AS coding FROM orfs o JOIN m ON m.id = o.id WHERE o.strand IS NOT NULL",
    "f30_splice_codes": f"WITH {A._PR} SELECT lower(replace(pair, '-', '')) AS code, count(*) AS n FROM pr WHERE regexp_full_match(pair, '[ACGT]{{2}}-[ACGT]{{2}}') GROUP BY 1",
    "f31_pieces": "WITH x AS (SELECT locus_id, longest_clip AS c, unnest(range(0, CAST(ceil(length(longest_clip) / 30) AS BIGINT))) AS k FROM locus_rows WHERE length(longest_clip) > 0), y AS (SELECT locus_id, k + 1 AS k, substr(c, k * 30 + 1, 30) AS piece FROM x) SELECT * FROM y WHERE length(piece) >= 10",
    "f35_durations": "WITH r AS (SELECT report_id, min(run_at) AS a FROM cleanup_reports WHERE report_id IS NOT NULL AND run_at IS NOT NULL GROUP BY 1), d AS (SELECT report_id, max(dropped_at) AS b FROM cleanup_drops WHERE dropped_at IS NOT NULL GROUP BY 1) SELECT r.report_id, CAST(floor((epoch_us(b) - epoch_us(a)) / 1000000) AS BIGINT) AS seconds FROM r JOIN d ON d.report_id = r.report_id",
    "j6_concordant_features": sql(_J6 + " SELECT f.label, g.g, p.kind, p.id, p.s, p.e FROM g JOIN fw f ON f.kind = 'mRNA' AND f.label = g.label AND f.pid = g.g JOIN fp p ON p.label = f.label AND p.pid = f.id WHERE p.kind IN ('exon', 'CDS')"),
    "j19_best_source": "WITH t AS (SELECT tid, source, row_number() OVER (PARTITION BY tid ORDER BY coalesce(list_position(['longread', 'guided', 'denovo', 'combrix-assembly'], source), 0), assembled_at NULLS FIRST) AS k, count(*) OVER (PARTITION BY tid) AS n FROM transcripts WHERE tid IS NOT NULL AND source IS NOT NULL) SELECT tid, source, n FROM t WHERE k = 1",
    "w27_seams": f"WITH {_E} SELECT tid, chrom, strand, k, (2 * e + gap + 1) // 2 AS seam FROM nx WHERE gap IS NOT NULL",
    "x8_distinct_sources": """WITH f AS (SELECT tid, source, min((assembled_at, source)) AS t FROM transcripts WHERE tid IS NOT NULL AND source IS NOT NULL AND assembled_at IS NOT NULL GROUP BY 1, 2) SELECT tid, string_agg(source, ',' ORDER BY t) AS sources FROM f GROUP BY 1""",
}
