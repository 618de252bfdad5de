"""Queries on spliced models, dialects, de-fusing, evidence, tallies and splice calls, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.functions import text as X
from strandloom.functions.ids import BLANKS
from strandloom.operators import contigs as C
from strandloom.operators import defuse, features, models
from strandloom.operators import reads as R
from strandloom.operators import splicing
from strandloom.plans import annotation_queries as A
from strandloom.plans import sequence_queries as Q
from strandloom.plans.adapters import parts, rows, sql, whole
from strandloom.plans.feature_queries import _H, _ranked
from strandloom.plans.read_queries import _NH, reads
from strandloom.sources.tables import table


def model_exons(spark, folder):
    """Models of two exons on documents as contigs, one for each different line item."""
    t = table(spark, folder, "lineitem")
    a, q = F.col("l_suppkey") % 700, F.col("l_quantity").cast("long")
    tid = F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    m = t.select(tid.alias("tid"), F.col("l_partkey").alias("contig"), F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise("+").alias("strand"), a.alias("a"), q.alias("q")).distinct()
    exons = F.array(F.struct((F.col("a") + 1).alias("s"), (F.col("a") + 20 + F.col("q")).alias("e")), F.struct((F.col("a") + 90).alias("s"), (F.col("a") + 120 + F.col("q")).alias("e")))
    return m.select("tid", "contig", "strand", F.inline(exons))


def _spliced(spark, folder):
    return C.spliced(model_exons(spark, folder), A.contigs(spark, folder)).withColumn("seq", F.upper("seq"))


def r8_spliced_models(spark, folder):
    """Every model's exons joined, in upper case, on its strand."""
    return _spliced(spark, folder).select("tid", "contig", "strand", "seq")


def k7_fasta_lines(spark, folder):
    """Spliced models as records with the keys of their file order."""
    first = model_exons(spark, folder).groupBy("tid", "contig").agg(F.min("s").alias("o2"))
    return _spliced(spark, folder).join(first, ["tid", "contig"]).select(F.col("contig").alias("o1"), "o2", F.concat(F.lit(">"), "tid", F.lit("\n"), "seq").alias("record"))


def r9_model_orfs(spark, folder):
    """The longest frame of every spliced model, each start with the next stop behind it, back on its contig."""
    t = _spliced(spark, folder).where("seq <> ''")
    both = [t.select("tid", F.lit(kind).alias("codon"), F.explode(S.codon_positions(F.col("seq"), codons)).alias("pos")) for kind, codons in (("start", S.STARTS[10]), ("stop", S.stop_codons(10)))]
    c = both[0].unionByName(both[1]).withColumn("frame", (F.col("pos") - 1) % 3)
    ahead = Window.partitionBy("tid", "frame").orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    starts = c.withColumn("stop", F.min(F.when(F.col("codon") == "stop", F.col("pos"))).over(ahead)).where("codon = 'start' and stop is not null")
    best = starts.groupBy("tid").agg(F.max(F.struct((F.col("stop") - F.col("pos")).alias("n"), (-F.col("frame")).alias("f"), (-F.col("pos")).alias("p"))).alias("b"))
    orfs = best.select("tid", F.lit(0).alias("orf_no"), (-F.col("b.p")).cast("long").alias("start"), (F.col("b.n") - F.col("b.p") + 2).cast("long").alias("stop"))
    exons = model_exons(spark, folder).withColumn("chrom", F.col("contig").cast("string"))
    return models.orf_to_genome(exons.select("tid", "chrom", "strand", "s", "e"), orfs).select("tid", "chrom", "strand", "cds_s", "cds_e")


def s7_ordered_exons(spark, folder):
    """Exons whose mRNA has a line before theirs in the same annotation."""
    r = table(spark, folder, "intervals").where("line_no is not null").select("annot_id", "row_id", "line_no", "featuretype", F.btrim("feat_id", F.lit(BLANKS)).alias("id"), F.btrim("parent_id", F.lit(BLANKS)).alias("pid"))
    mrna = r.where("featuretype = 'mRNA' and id is not null").groupBy("annot_id", F.col("id").alias("pid")).agg(F.min("line_no").alias("m_line"))
    return r.where("featuretype = 'exon'").join(mrna, ["annot_id", "pid"]).where("m_line < line_no").select("row_id", "annot_id", "pid")


def k6_numbered_exons(spark, folder):
    """Exons of all annotations together with one running number by place, as match lines."""
    x = parts(spark, folder, "exon").select(F.lit("all").alias("label"), F.concat_ws("|", "label", "pid", "id").alias("id"), "chrom", "strand", "s", "e").distinct()
    return features.locus_tags(x, "exon").select("tag", F.concat_ws("\t", "chrom", F.lit("nr"), F.lit("exon"), F.col("s").cast("string"), F.col("e").cast("string"), F.lit("."), "strand", F.lit("."), F.concat(F.lit("ID="), "tag")).alias("line"))


def k8_clipped_records(spark, folder):
    """Clips cut behind bases 30 and 60: pieces of ten bases or more numbered as .j, or the clip itself if none is left."""
    t = table(spark, folder, "locus_rows").where("longest_clip is not null").select("locus_id", "longest_clip")
    cuts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(n).alias("n")) for a, n in ((1, 30), (31, 30), (61, 1 << 30))])
    good = F.filter(F.transform(cuts, lambda c: F.substring(F.col("longest_clip"), c["a"], c["n"])), lambda p: F.length(p) >= 10)
    named = F.transform(good, lambda p, k: F.struct(F.concat(F.col("locus_id").cast("string"), F.lit(".j"), (k + 1).cast("string")).alias("id"), p.alias("seq")))
    whole_ = F.array(F.struct(F.col("locus_id").cast("string").alias("id"), F.col("longest_clip").alias("seq")))
    return t.select(F.inline(F.when((F.size(good) == 0) | (F.length("longest_clip") <= 30), whole_).otherwise(named)))


def _flagged(spark, folder):
    return reads(spark, folder).withColumn("flag", F.when(F.col("pos0") % 1100 == 0, 4).when(F.col("pos0") % 1300 == 0, 260).otherwise(F.col("flag")))


def k10_unmapped_records(spark, folder):
    """Unmapped primary reads as sequence records."""
    f = F.col("flag")
    return _flagged(spark, folder).where((f.bitwiseAND(R.UNMAPPED) != 0) & (f.bitwiseAND(R.SECONDARY | R.SUPPLEMENTARY) == 0) & F.col("qname").isNotNull() & F.col("seq").isNotNull()).select(F.concat(F.lit(">"), "qname", F.lit("\n"), "seq").alias("record"))


def a35_mapping_rate(spark, folder):
    """Mapped and unmapped primary reads, the rate, and whether it is low."""
    f = F.col("flag")
    t = _flagged(spark, folder).where(f.bitwiseAND(R.SECONDARY | R.SUPPLEMENTARY) == 0)
    n = t.agg(F.count_if(f.bitwiseAND(R.UNMAPPED) == 0).alias("n_mapped"), F.count_if(f.bitwiseAND(R.UNMAPPED) != 0).alias("n_unmapped"))
    rate = F.try_divide("n_mapped", F.col("n_mapped") + F.col("n_unmapped"))
    return n.select("n_mapped", "n_unmapped", rate.alias("rate"), (rate < 0.75).alias("low"))


def l9_coordinate_sorted(spark, folder):
    """Mapped reads with the keys of their order by place."""
    return _flagged(spark, folder).where(F.col("flag").bitwiseAND(R.UNMAPPED) == 0).select(F.col("chrom").alias("o1"), F.col("pos0").alias("o2"), "qname")


def k11_training_lines(spark, folder):
    """Exons as training lines: role, ends in the order of the strand, model."""
    x = A.pr9_exon_roles(spark, folder)
    s = parts(spark, folder, "exon").select("label", "pid", "id", "s", "e", "strand", "chrom")
    back = F.col("strand") == "-"
    both = x.join(s, ["label", "pid", "id", "s", "e"])
    return both.select(F.concat(F.lit(">"), "chrom").alias("contig"), "label", F.concat_ws("\t", "role", F.when(back, F.col("e")).otherwise(F.col("s")).cast("string"), F.when(back, F.col("s")).otherwise(F.col("e")).cast("string"), "pid").alias("line"))


def _fused(spark, folder):
    h = _ranked(spark, folder)
    signed = F.transform("hits", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(x["subject"] % 2 == 0, 1).otherwise(-1).alias("sign")))
    return h.select(F.col("query").cast("string").alias("tid"), F.lit(360).alias("length"), signed.alias("hits"))


def f26_defused(spark, folder):
    """Orders as models, cut between hits apart from each other, each piece with the sign of its hit."""
    return defuse.defused(_fused(spark, folder))


def k15_defuse_audit(spark, folder):
    """The models that were cut, into how many pieces and where."""
    return defuse.audit(_fused(spark, folder))


def r18_seam_depth(spark, folder):
    """How many frames of a transcript cover the middle of its length."""
    o = table(spark, folder, "orfs").where("id is not null and start is not null and stop is not null and seqlen > 0")
    seam = F.floor(F.col("seqlen") / 2)
    return o.groupBy("id", "seqlen").agg(F.count_if(seam.between(F.least("start", "stop"), F.greatest("start", "stop"))).alias("depth"))


def pr2_reparented(spark, folder):
    """Rows as a gene-mRNA dialect wants them: transcripts become mRNAs named after their parent, parts hang below those."""
    t = rows(spark, folder).where("kind in ('gene', 'mRNA', 'transcript', 'exon', 'CDS')")
    under = F.concat(F.coalesce("pid", "id"), F.lit("_mRNA"))
    kind = F.when(F.col("kind") == "transcript", "mRNA").otherwise(F.col("kind"))
    new_id = F.when(F.col("kind") == "gene", F.coalesce("pid", "id")).when(F.col("kind").isin("mRNA", "transcript"), under).otherwise(F.col("id"))
    new_parent = F.when(F.col("kind") == "gene", None).when(F.col("kind").isin("mRNA", "transcript"), F.col("pid")).otherwise(under)
    return t.select("row_id", "label", kind.alias("kind"), new_id.alias("id"), new_parent.alias("pid"))


def pr7_relabelled(spark, folder):
    """Exons named after their parent with a counter in line order, source set to the predictor's."""
    w = Window.partitionBy("annot_id", "parent_id").orderBy(F.col("line_no").asc_nulls_last(), "row_id")
    t = table(spark, folder, "intervals").where("featuretype = 'exon' and parent_id is not null")
    return t.select("row_id", F.lit("predictor").alias("source"), F.lit("CDS").alias("kind"), F.concat("parent_id", F.lit(":CDS:"), F.row_number().over(w).cast("string")).alias("id"))


def pr8_typed_ids(spark, folder):
    """Ids by type: genes by gene, mRNAs by transcript, parts by parent, type and place."""
    t = rows(spark, folder)
    return t.select("row_id", F.when(F.col("kind") == "gene", F.concat(F.lit("gene:"), "id")).when(F.col("kind").isin("mRNA", "transcript"), F.concat(F.lit("transcript:"), "id")).otherwise(F.concat_ws(":", F.coalesce("pid", F.lit("none")), "kind", F.col("s").cast("string"))).alias("id"))


def pr6_normalised(spark, folder):
    """Rows by annotation and type after renaming, completing missing levels and cutting contig names."""
    t = rows(spark, folder).withColumn("kind", F.when(F.col("kind") == "transcript", "mRNA").otherwise(F.col("kind"))).where("kind in ('gene', 'mRNA', 'exon', 'CDS')")
    done = features.completed(t.select("label", "id", "pid", F.substring_index("chrom", " ", 1).alias("chrom"), "strand", "s", "e", "kind"))
    return done.groupBy("label", "kind").agg(F.count("*").alias("n"), F.count_distinct("chrom").alias("n_chroms"))


def pr16_evidence(spark, folder):
    """Transcripts and predicted genes staged as evidence with the weight of their source; repeats stay, unknown sources have none."""
    weights = spark.createDataFrame([("longread", 10.0), ("guided", 5.0), ("gene", 1.0)], "name string, weight double")
    tx = table(spark, folder, "transcripts").where("tid is not null").select(F.lit("TRANSCRIPT").alias("role"), F.col("source").alias("name"), F.col("tid").alias("id"))
    ab = whole(spark, folder, "gene").select(F.lit("ABINITIO").alias("role"), F.lit("gene").alias("name"), F.concat_ws("|", "label", "id").alias("id"))
    return tx.unionByName(ab).join(F.broadcast(weights), "name", "left").groupBy("role", "name", "weight").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


def l4_deepest_loci(spark, folder):
    """The ten loci with most clips, ties by place, side and id."""
    t = table(spark, folder, "locus_rows").where("n_clips is not null")
    return t.orderBy(F.col("n_clips").desc(), F.col("chrom").asc_nulls_last(), F.col("pos").asc_nulls_last(), F.col("side").asc_nulls_last(), "locus_id").limit(10).select("locus_id", "n_clips")


def l5_common_motifs(spark, folder):
    """Heads and tails of clips by how common they are: the hundred commonest with their rank, ties by the motif."""
    first = Q.a23_end_motifs(spark, folder).orderBy(F.col("n").desc(), "motif").limit(100)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), "motif")).cast("long"))  # a hundred rows


def l6_capped_notes(spark, folder):
    """The first cross reference of every row that has some."""
    refs = F.try_element_at("attributes", F.lit("Dbxref"))
    return table(spark, folder, "intervals").where(refs.isNotNull()).select("row_id", F.size(refs).cast("long").alias("n"), F.array_join(F.slice(refs, 1, 1), ",").alias("dbxref"))


def x3_patched(spark, folder):
    """Genes of the reference and, where the others have any, theirs too; an id in both stays twice, numbered."""
    g = whole(spark, folder, "gene").select("label", "id", "chrom", "s", "e")
    w = Window.partitionBy("id").orderBy("label")
    n = F.row_number().over(w) - 1
    return g.select("label", F.when(n == 0, F.col("id")).otherwise(F.concat("id", F.lit("_"), n.cast("string"))).alias("id"), "chrom", "s", "e")


def f18_families(spark, folder):
    """Accessions without their version, the name where there is none."""
    t = table(spark, folder, "part").select("p_partkey", F.when(F.col("p_partkey") % 6 == 0, "").otherwise(F.concat(F.lit("PF"), F.lpad(F.col("p_partkey").cast("string"), 5, "0"), F.lit("."), F.col("p_size").cast("string"))).alias("accession"), "p_name")
    return t.select("p_partkey", X.without_version(F.col("accession"), F.col("p_name")).alias("family"))


def f29_coding_motifs(spark, folder):
    """Introns by their pair as their strand reads it."""
    p = A._pairs(spark, folder).where("pair is not null")
    return p.groupBy(F.when(F.col("strand") == "-", splicing.flipped(F.col("pair"))).otherwise(F.col("pair")).alias("motif")).agg(F.count("*").alias("n"))


def f34_digest(spark, folder):
    """One digest of each annotation's genes in sorted order."""
    t = whole(spark, folder, "gene").select("label", F.concat(F.concat_ws("|", "label", "id"), F.lit("="), F.md5(F.concat_ws("|", "chrom", "strand", F.col("s").cast("string"), F.col("e").cast("string")))).alias("line"))
    small = t.withColumn("part", F.substring(F.md5("line"), 1, 2)).groupBy("label", "part").agg(F.md5(F.array_join(F.sort_array(F.collect_list("line")), "\n")).alias("h"))
    return small.groupBy("label").agg(F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "h"))), lambda x: x["h"]), "\n")).alias("digest"))  # 256 parts


def r10_rebuilt(spark, folder):
    """Genes and mRNAs rebuilt from groups of exons: a span for every parent."""
    x = parts(spark, folder, "exon").groupBy("label", "pid").agg(F.min("chrom").alias("chrom"), F.min("strand").alias("strand"), F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"))
    return x.select("label", F.explode(F.array(F.struct(F.lit("gene").alias("kind"), F.concat("pid", F.lit(".gene")).alias("id")), F.struct(F.lit("mRNA").alias("kind"), F.col("pid").alias("id")))).alias("k"), "chrom", "strand", "s", "e", "n").select("label", "k.kind", "k.id", "chrom", "strand", "s", "e", "n")


def r14_adapter_calls(spark, folder):
    """Whether the commonest end motif of clips is an adapter, to be warned of, or a leader."""
    e = Q.loci(spark, folder).where("length(clip) >= 16").select(F.explode(F.array(F.left(F.upper("clip"), F.lit(16)), F.right(F.upper("clip"), F.lit(16)))).alias("motif"))
    best = e.groupBy("motif").agg(F.count("*").alias("n")).agg(F.min(F.struct((-F.col("n")).alias("n"), "motif")).alias("b"))
    return best.select(F.col("b.motif").alias("motif"), F.when(S.shares_run(F.col("b.motif"), S.ADAPTERS, 11), "adapter").otherwise("leader").alias("call"))


def r26_noncanonical(spark, folder):
    """Whether introns are so often not canonical that splicing should be mapped without that rule."""
    h = splicing.pair_histogram(A._pairs(spark, folder))
    share = h.agg(F.coalesce(F.sum(F.when(F.col("pair").isin(*splicing.CANONICAL), F.col("share"))), F.lit(0.0)).alias("share"))
    return share.select("share", F.when(F.col("share") < 0.8, "EXTENSIVE").when(F.col("share") < 0.95, "MODERATE").otherwise("NONE").alias("call"), (F.col("share") < 0.8).alias("off"))


def r28_tail_summary(spark, folder):
    """Tails among all clips: share, mean length and chromosomes of each kind."""
    t = Q.loci(spark, folder).withColumn("kind", S.poly_tail(F.col("clip"), F.col("side")))
    every = t.agg(F.count("*").alias("all"))
    g = t.where("kind is not null").groupBy("kind").agg(F.count("*").alias("n"), F.avg(F.length("clip")).alias("mean_length"), F.count_distinct("chrom").alias("n_chroms"))
    return g.crossJoin(F.broadcast(every)).select("kind", "n", (F.col("n") / F.col("all")).alias("share"), "mean_length", "n_chroms")


def r29_enriched(spark, folder):
    """mRNAs with the product of their best hit at a value of 0.01 or better, others with none."""
    h = table(spark, folder, "orfs").where("id is not null and orflen > 0").select(F.col("id").alias("tid"), (1.0 / F.col("orflen")).alias("evalue"), F.concat(F.lit("frame "), F.col("frame").cast("string")).alias("product"), "orf_no")
    best = h.where("evalue <= 0.01").groupBy("tid").agg(F.min(F.struct("evalue", "orf_no", "product")).alias("b"))
    t = table(spark, folder, "transcripts").where("tid is not null").select("tid").distinct()
    return t.join(best, "tid", "left").select("tid", F.coalesce("b.product", F.lit(X.NO_PRODUCT)).alias("product"))


def w18_cut_models(spark, folder):
    """Models cut behind given bases of the spliced transcript (40 and 90 here), pieces under 25 dropped."""
    e = model_exons(spark, folder).withColumnRenamed("contig", "chrom")
    points = e.select("tid", "chrom", "strand").distinct().withColumn("cut", F.explode(F.array(F.lit(40).cast("long"), F.lit(90).cast("long"))))
    return models.cut_at(e, points, 25)


def k3_typed_junctions(spark, folder):
    """Junctions on documents as contigs with strand and motif codes, in nine columns."""
    j = A._introns(spark, folder).groupBy("contig", "start0", "end0x").agg(F.count("*").alias("n"))
    code = R.motif_code(F.col("pair"))
    typed = splicing.splice_pairs(j, A.contigs(spark, folder)).withColumns({"motif": code, "code": R.motif_strand(code)})
    return typed.select(F.concat_ws("\t", F.col("contig").cast("string"), (F.col("start0") + 1).cast("string"), F.col("end0x").cast("string"), F.col("code").cast("string"), F.col("motif").cast("string"), F.lit("0"), F.col("n").cast("string"), F.lit("0"), F.lit("0")).alias("line"), F.when(F.col("code") == 1, "+").when(F.col("code") == 2, "-").otherwise(".").alias("strand"))


def f11_near_leader(spark, folder):
    """Clips that hold a run one letter at most from a given leader, and where the first such run begins."""
    hit = S.near_positions(F.upper("clip"), "TTTGATCA", 1)
    return Q.loci(spark, folder).where(F.size(hit) > 0).select("locus_id", F.element_at(hit, 1).cast("long").alias("first"), F.size(hit).cast("long").alias("n"))


QUERIES = {f.__name__: f for f in (
    r8_spliced_models, k7_fasta_lines, r9_model_orfs, s7_ordered_exons, k6_numbered_exons, k8_clipped_records, k10_unmapped_records, a35_mapping_rate, l9_coordinate_sorted, k11_training_lines, f26_defused, k15_defuse_audit, r18_seam_depth,
    pr2_reparented, pr7_relabelled, pr8_typed_ids, pr6_normalised, pr16_evidence, l4_deepest_loci, l5_common_motifs, l6_capped_notes, x3_patched, f18_families, f29_coding_motifs, f34_digest, r10_rebuilt, r14_adapter_calls, r26_noncanonical,
    r28_tail_summary, r29_enriched, w18_cut_models, k3_typed_junctions, f11_near_leader,
)}
_MX = """mx AS (SELECT DISTINCT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tid, l_partkey AS contig, CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand, l_suppkey % 700 AS a, CAST(l_quantity AS BIGINT) AS q FROM lineitem)"""
_SP = A._CT + ", " + _MX + """, sp AS (SELECT tid, mx.contig, strand, upper(coalesce(substr(seq, a + 1, 20 + q), '') || coalesce(substr(seq, a + 90, 31 + q), '')) AS j, a FROM mx LEFT JOIN ct ON ct.contig = mx.contig),
  sq AS (SELECT tid, contig, strand, a, CASE WHEN strand = '-' THEN reverse(translate(j, 'ACGTN', 'TGCAN')) ELSE j END AS seq FROM sp)"""
_RF = _NH + ", rf AS (SELECT *, CASE WHEN pos0 % 1100 = 0 THEN 4 WHEN pos0 % 1300 = 0 THEN 260 ELSE flag END AS fl FROM r)"
_CUTS = f"""WITH RECURSIVE {_H}, w AS (SELECT query, k, [{{'s': s, 'e': e, 'g': CASE WHEN subject % 2 = 0 THEN 1 ELSE -1 END}}] AS kept FROM r WHERE k = 1
  UNION ALL SELECT r.query, r.k, CASE WHEN len(list_filter(w.kept, lambda x: greatest(0, least(x.e, r.e) - greatest(x.s, r.s) + 1) > 0.1 * least(x.e - x.s + 1, r.e - r.s + 1))) > 0 THEN w.kept
    ELSE list_append(w.kept, {{'s': r.s, 'e': r.e, 'g': CASE WHEN subject % 2 = 0 THEN 1 ELSE -1 END}}) END FROM w JOIN r ON r.query = w.query AND r.k = w.k + 1),
  z AS (SELECT query, list_sort(kept) AS kept FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY k DESC) AS v FROM w) WHERE v = 1),
  c AS (SELECT query, kept, CASE WHEN len(kept) < 2 THEN [] ELSE list_filter(list_transform(range(1, len(kept)), lambda i: (kept[i].e + kept[i + 1].s) // 2), lambda x: x > 0 AND x < 360) END AS cuts,
    CASE WHEN len(kept) < 2 THEN [] ELSE list_transform(range(1, len(kept)), lambda i: (kept[i].e + kept[i + 1].s) // 2) END AS seams FROM z),
  b AS (SELECT query, kept, seams, list_concat(list_concat([CAST(0 AS BIGINT)], cuts), [CAST(360 AS BIGINT)]) AS ends FROM c),
  p AS (SELECT query, kept, seams, list_filter(list_transform(range(1, len(ends)), lambda i: {{'s': ends[i] + 1, 'e': ends[i + 1]}}), lambda x: x.e - x.s + 1 >= 25) AS good FROM b)"""
ORACLES = {
    "r8_spliced_models": f"WITH {_SP} SELECT tid, contig, strand, seq FROM sq",
    "k7_fasta_lines": f"WITH {_SP} SELECT contig AS o1, a + 1 AS o2, '>' || tid || chr(10) || seq AS record FROM sq",
    "r9_model_orfs": f"""WITH {_SP}, cd AS (SELECT tid, 'start' AS codon, unnest(list_filter(range(1, length(seq) - 1), lambda i: seq[i : i + 2] = 'ATG')) AS pos FROM sq WHERE length(seq) >= 3
        UNION ALL SELECT tid, 'stop', unnest(list_filter(range(1, length(seq) - 1), lambda i: seq[i : i + 2] IN ('TAA', 'TAG'))) FROM sq WHERE length(seq) >= 3),
      y AS (SELECT *, (pos - 1) % 3 AS frame, min(CASE WHEN codon = 'stop' THEN pos END) OVER (PARTITION BY tid, (pos - 1) % 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop FROM cd),
      o AS (SELECT tid, pos AS st, stop + 2 AS en FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY stop - pos DESC, frame, pos) AS k FROM y WHERE codon = 'start' AND stop IS NOT NULL) WHERE k = 1),
      x AS (SELECT tid, contig, strand, a + 1 AS s, a + 20 + q AS e, CASE WHEN strand = '-' THEN 31 + q ELSE 0 END AS o5 FROM mx UNION ALL SELECT tid, contig, strand, a + 90, a + 120 + q, CASE WHEN strand = '-' THEN 0 ELSE 20 + q END FROM mx),
      h AS (SELECT x.*, greatest(st - 1, o5) - o5 AS lo, least(en, o5 + e - s + 1) - o5 AS hi FROM x JOIN o ON o.tid = x.tid)
      SELECT tid, CAST(contig AS VARCHAR) AS chrom, strand, CASE WHEN strand <> '-' THEN s + lo ELSE e - hi + 1 END AS cds_s, CASE WHEN strand <> '-' THEN s + hi - 1 ELSE e - lo END AS cds_e FROM h WHERE lo < hi""",
    "s7_ordered_exons": r"""WITH r AS (SELECT annot_id, row_id, line_no, featuretype, trim(feat_id, E' \t\r\n') AS id, trim(parent_id, E' \t\r\n') AS pid FROM intervals WHERE line_no IS NOT NULL), m AS (SELECT annot_id, id, min(line_no) AS ml FROM r WHERE featuretype = 'mRNA' AND id IS NOT NULL GROUP BY 1, 2)
      SELECT r.row_id, r.annot_id, r.pid FROM r JOIN m ON m.annot_id = r.annot_id AND m.id = r.pid WHERE r.featuretype = 'exon' AND ml < r.line_no""",
    "k6_numbered_exons": sql("""x AS (SELECT DISTINCT concat_ws('|', label, pid, id) AS id, chrom, strand, s, e FROM fp WHERE kind = 'exon'), t AS (SELECT *, format('exon_{:05d}', row_number() OVER (ORDER BY chrom, s // 1048576, s, e, id)) AS tag FROM x)
      SELECT tag, concat_ws(chr(9), chrom, 'nr', 'exon', s, e, '.', strand, '.', 'ID=' || tag) AS line FROM t"""),
    "k8_clipped_records": """WITH p AS (SELECT locus_id, longest_clip AS c, list_filter([substr(longest_clip, 1, 30), substr(longest_clip, 31, 30), substr(longest_clip, 61)], lambda x: length(x) >= 10) AS g FROM locus_rows WHERE longest_clip IS NOT NULL),
      u AS (SELECT locus_id, c, g, unnest(range(1, len(g) + 1)) AS k FROM p WHERE len(g) > 0 AND length(c) > 30) SELECT locus_id || '.j' || k AS id, g[k] AS seq FROM u UNION ALL SELECT CAST(locus_id AS VARCHAR), c FROM p WHERE len(g) = 0 OR length(c) <= 30""",
    "k10_unmapped_records": _RF + " SELECT '>' || qname || chr(10) || left(repeat('ACGTN', 60), c + 2 * q + 5) AS record FROM rf WHERE fl = 4",
    "a35_mapping_rate": _RF + ", n AS (SELECT count(*) FILTER (fl & 4 = 0) AS n_mapped, count(*) FILTER (fl & 4 <> 0) AS n_unmapped FROM rf WHERE fl & 2304 = 0) SELECT *, n_mapped / (n_mapped + n_unmapped) AS rate, n_mapped / (n_mapped + n_unmapped) < 0.75 AS low FROM n",
    "l9_coordinate_sorted": _RF + " SELECT chrom AS o1, pos0 AS o2, qname FROM rf WHERE fl & 4 = 0",
    "k11_training_lines": sql("""x AS (SELECT *, row_number() OVER (PARTITION BY label, pid ORDER BY s, e, id) AS k, count(*) OVER (PARTITION BY label, pid) AS n FROM fp WHERE kind = 'exon'),
      r AS (SELECT label, pid, id, s, e, CASE WHEN n = 1 THEN 'Esngl' WHEN k = 1 THEN CASE WHEN strand = '-' THEN 'Eterm' ELSE 'Einit' END WHEN k = n THEN CASE WHEN strand = '-' THEN 'Einit' ELSE 'Eterm' END ELSE 'Exon' END AS role FROM x)
      SELECT '>' || p.chrom AS contig, r.label, concat_ws(chr(9), role, CASE WHEN p.strand = '-' THEN p.e ELSE p.s END, CASE WHEN p.strand = '-' THEN p.s ELSE p.e END, r.pid) AS line FROM r JOIN fp p ON p.kind = 'exon' AND p.label = r.label AND p.pid = r.pid AND p.id = r.id AND p.s = r.s AND p.e = r.e"""),
    "f26_defused": _CUTS + """, u AS (SELECT query, kept, good, unnest(range(1, len(good) + 1)) AS k FROM p WHERE len(kept) >= 2 AND len(good) >= 2),
      v AS (SELECT query, k, good[k].s AS s, good[k].e AS e, list_sort(list_transform(kept, lambda h: {'bp': greatest(0, least(h.e, good[k].e) - greatest(h.s, good[k].s) + 1), 'f': -h.s, 'g': h.g}))[-1] AS b FROM u)
      SELECT query || '.d' || k AS tid, s, e, CASE WHEN b.bp > 0 THEN b.g END AS sign FROM v UNION ALL SELECT CAST(query AS VARCHAR), 1, 360, NULL FROM p WHERE NOT (len(kept) >= 2 AND len(good) >= 2)""",
    "k15_defuse_audit": _CUTS + " SELECT CAST(query AS VARCHAR) AS tid, len(good) AS n_pieces, array_to_string(seams, ',') AS seams FROM p WHERE len(kept) >= 2 AND len(good) >= 2",
    "r18_seam_depth": "SELECT id, seqlen, count(*) FILTER (seqlen // 2 BETWEEN least(start, stop) AND greatest(start, stop)) AS depth FROM orfs WHERE id IS NOT NULL AND start IS NOT NULL AND stop IS NOT NULL AND seqlen > 0 GROUP BY 1, 2",
    "pr2_reparented": sql("""SELECT row_id, label, CASE kind WHEN 'transcript' THEN 'mRNA' ELSE kind END AS kind, CASE WHEN kind = 'gene' THEN coalesce(pid, id) WHEN kind IN ('mRNA', 'transcript') THEN coalesce(pid, id) || '_mRNA' ELSE id END AS id,
      CASE WHEN kind = 'gene' THEN NULL WHEN kind IN ('mRNA', 'transcript') THEN pid ELSE coalesce(pid, id) || '_mRNA' END AS pid FROM fr WHERE kind IN ('gene', 'mRNA', 'transcript', 'exon', 'CDS')"""),
    "pr7_relabelled": "SELECT row_id, 'predictor' AS source, 'CDS' AS kind, parent_id || ':CDS:' || row_number() OVER (PARTITION BY annot_id, parent_id ORDER BY line_no NULLS LAST, row_id) AS id FROM intervals WHERE featuretype = 'exon' AND parent_id IS NOT NULL",
    "pr8_typed_ids": sql("SELECT row_id, CASE WHEN kind = 'gene' THEN 'gene:' || id WHEN kind IN ('mRNA', 'transcript') THEN 'transcript:' || id ELSE concat_ws(':', coalesce(pid, 'none'), kind, s) END AS id FROM fr"),
    "pr6_normalised": sql("""b AS (SELECT label, split_part(chrom, ' ', 1) AS chrom, CASE kind WHEN 'transcript' THEN 'mRNA' ELSE kind END AS kind FROM fr WHERE kind IN ('gene', 'mRNA', 'transcript', 'exon', 'CDS')),
      h AS (SELECT label, bool_or(kind = 'mRNA') AS m, bool_or(kind = 'exon') AS x, bool_or(kind = 'CDS') AS c FROM b GROUP BY 1),
      u AS (SELECT label, kind, chrom FROM b UNION ALL SELECT b.label, 'mRNA', chrom FROM b JOIN h ON h.label = b.label WHERE kind = 'gene' AND NOT m UNION ALL SELECT b.label, 'CDS', chrom FROM b JOIN h ON h.label = b.label WHERE kind = 'exon' AND NOT c
        UNION ALL SELECT b.label, 'exon', chrom FROM b JOIN h ON h.label = b.label WHERE kind = 'CDS' AND NOT x) SELECT label, kind, count(*) AS n, count(DISTINCT chrom) AS n_chroms FROM u GROUP BY 1, 2"""),
    "pr16_evidence": sql("""e AS (SELECT 'TRANSCRIPT' AS role, source AS name, tid AS id FROM transcripts WHERE tid IS NOT NULL UNION ALL SELECT 'ABINITIO', 'gene', concat_ws('|', label, id) FROM fw WHERE kind = 'gene')
      SELECT role, name, CASE name WHEN 'longread' THEN 10.0::DOUBLE WHEN 'guided' THEN 5.0::DOUBLE WHEN 'gene' THEN 1.0::DOUBLE END AS weight, count(*) AS n, count(DISTINCT id) AS n_ids FROM e GROUP BY 1, 2, 3"""),
    "l4_deepest_loci": "SELECT locus_id, n_clips FROM locus_rows WHERE n_clips IS NOT NULL ORDER BY n_clips DESC, chrom NULLS LAST, pos NULLS LAST, side NULLS LAST, locus_id LIMIT 10",
    "l5_common_motifs": "SELECT *, row_number() OVER (ORDER BY n DESC, motif) AS rank FROM (" + Q.ORACLES["a23_end_motifs"] + ") QUALIFY rank <= 100",
    "l6_capped_notes": "SELECT row_id, len(attributes['Dbxref']) AS n, coalesce(array_to_string(attributes['Dbxref'][1:1], ','), '') AS dbxref FROM intervals WHERE attributes['Dbxref'] IS NOT NULL",
    "x3_patched": sql("x AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY label) - 1 AS n FROM fw WHERE kind = 'gene') SELECT label, CASE WHEN n = 0 THEN id ELSE id || '_' || n END AS id, chrom, s, e FROM x"),
    "f18_families": "SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN p_name ELSE 'PF' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') END AS family FROM part",
    "f29_coding_motifs": f"WITH {A._PR} SELECT CASE WHEN strand = '-' THEN {A._FL} ELSE pair END AS motif, count(*) AS n FROM pr WHERE pair IS NOT NULL GROUP BY 1",
    "f34_digest": sql("""l AS (SELECT label, concat_ws('|', label, id) || '=' || md5(concat_ws('|', chrom, strand, s, e)) AS line FROM fw WHERE kind = 'gene'),
      q AS (SELECT label, left(md5(line), 2) AS part, md5(string_agg(line, chr(10) ORDER BY line)) AS h FROM l GROUP BY 1, 2) SELECT label, md5(string_agg(h, chr(10) ORDER BY part)) AS digest FROM q GROUP BY 1"""),
    "r10_rebuilt": sql("""x AS (SELECT label, pid, min(chrom) AS chrom, min(strand) AS strand, min(s) AS s, max(e) AS e, count(*) AS n FROM fp WHERE kind = 'exon' GROUP BY 1, 2)
      SELECT label, 'gene' AS kind, pid || '.gene' AS id, chrom, strand, s, e, n FROM x UNION ALL SELECT label, 'mRNA', pid, chrom, strand, s, e, n FROM x"""),
    "r14_adapter_calls": f"""WITH {Q._LOCI}, e AS (SELECT left(upper(clip), 16) AS motif FROM lc WHERE length(clip) >= 16 UNION ALL SELECT right(upper(clip), 16) FROM lc WHERE length(clip) >= 16), b AS (SELECT motif FROM e GROUP BY 1 ORDER BY count(*) DESC, motif LIMIT 1)
      SELECT motif, CASE WHEN {Q._HAS('motif', 11)} THEN 'adapter' ELSE 'leader' END AS call FROM b""",
    "r26_noncanonical": f"WITH {A._PR}, s AS (SELECT count(*) FILTER (pair IN ('GT-AG', 'CT-AC')) / count(*) AS share FROM pr) SELECT share, CASE WHEN share < 0.8 THEN 'EXTENSIVE' WHEN share < 0.95 THEN 'MODERATE' ELSE 'NONE' END AS call, share < 0.8 AS off FROM s",
    "r28_tail_summary": f"""WITH {Q._LOCI}, x AS (SELECT *, CASE WHEN length(clip) >= 8 AND side = '3p' AND {Q._CNT('A')} / length(clip) >= 0.8 THEN 'polyA' WHEN length(clip) >= 8 AND side = '5p' AND {Q._CNT('T')} / length(clip) >= 0.8 THEN 'polyT' END AS kind FROM lc)
      SELECT kind, count(*) AS n, count(*) / (SELECT count(*) FROM x) AS share, avg(length(clip)) AS mean_length, count(DISTINCT chrom) AS n_chroms FROM x WHERE kind IS NOT NULL GROUP BY 1""",
    "r29_enriched": """WITH h AS (SELECT id AS tid, 1.0::DOUBLE / orflen AS ev, 'frame ' || frame AS product, orf_no FROM orfs WHERE id IS NOT NULL AND orflen > 0), b AS (SELECT tid, product FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY ev, orf_no) AS k FROM h WHERE ev <= 0.01) WHERE k = 1)
      SELECT t.tid, coalesce(product, 'hypothetical protein') AS product FROM (SELECT DISTINCT tid FROM transcripts WHERE tid IS NOT NULL) t LEFT JOIN b ON b.tid = t.tid""",
    "w18_cut_models": f"""WITH {_MX}, x AS (SELECT tid, contig AS chrom, strand, a + 1 AS s, a + 20 + q AS e, CASE WHEN strand = '-' THEN 31 + q ELSE 0 END AS o5, 51 + 2 * q AS tot FROM mx UNION ALL SELECT tid, contig, strand, a + 90, a + 120 + q, CASE WHEN strand = '-' THEN 0 ELSE 20 + q END, 51 + 2 * q FROM mx),
      g AS (SELECT *, unnest([{{'p': 1, 'lo': 0, 'hi': 40}}, {{'p': 2, 'lo': 40, 'hi': 90}}, {{'p': 3, 'lo': 90, 'hi': 1000000}}]) AS c FROM x),
      k AS (SELECT tid, chrom, strand, c.p AS p, greatest(c.lo, o5) - o5 AS lo, least(c.hi, o5 + e - s + 1) - o5 AS hi, s, e FROM g), l AS (SELECT *, sum(hi - lo) OVER (PARTITION BY tid, p) AS bases FROM k WHERE lo < hi),
      d AS (SELECT *, dense_rank() OVER (PARTITION BY tid ORDER BY p) AS j FROM l WHERE bases >= 25)
      SELECT chrom, strand, tid || '.j' || j AS tid, CASE WHEN strand = '-' THEN e - hi + 1 ELSE s + lo END AS s, CASE WHEN strand = '-' THEN e - lo ELSE s + hi - 1 END AS e FROM d""",
    "k3_typed_junctions": f"""WITH {A._CT}, it AS (SELECT l_partkey AS contig, l_suppkey % 700 AS a, l_suppkey % 700 + 20 + CAST(l_quantity AS BIGINT) AS b, count(*) AS n FROM lineitem GROUP BY 1, 2, 3), pr AS (SELECT it.*, CASE WHEN b <= length(seq) THEN upper(substr(seq, a + 1, 2)) || '-' || upper(substr(seq, b - 1, 2)) END AS pair FROM it LEFT JOIN ct ON ct.contig = it.contig),
      m AS (SELECT *, CASE pair WHEN 'GT-AG' THEN 1 WHEN 'CT-AC' THEN 2 WHEN 'GC-AG' THEN 3 WHEN 'CT-GC' THEN 4 WHEN 'AT-AC' THEN 5 WHEN 'GT-AT' THEN 6 ELSE 0 END AS mo FROM pr), d AS (SELECT *, CASE WHEN mo = 0 THEN 0 WHEN mo % 2 = 1 THEN 1 ELSE 2 END AS sc FROM m)
      SELECT concat_ws(chr(9), contig, a + 1, b, sc, mo, '0', n, '0', '0') AS line, CASE sc WHEN 1 THEN '+' WHEN 2 THEN '-' ELSE '.' END AS strand FROM d""",
    "f11_near_leader": f"""WITH {Q._LOCI}, h AS (SELECT locus_id, list_filter(range(1, length(clip) - 6), lambda i: hamming(upper(clip[i : i + 7]), 'TTTGATCA') <= 1) AS p FROM lc WHERE length(clip) >= 8) SELECT locus_id, p[1] AS first, len(p) AS n FROM h WHERE len(p) > 0""",
}
