"""Queries on splice pairs, loci, functional hits and the writers, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.functions import text as X
from strandloom.functions.ids import BLANKS
from strandloom.operators import reads as R
from strandloom.operators import splicing
from strandloom.plans.adapters import parts, sql, whole
from strandloom.plans.compare_queries import j5_concordant
from strandloom.plans.read_queries import READ_SQL, reads
from strandloom.sources.tables import table

LETTERS = "abcdefghijklmnopqrstuvwxyz"
TO_BASES = ("acgt" * 7)[:26]


def contigs(spark, folder):
    """Documents as sequences: their ASCII letters mapped onto four bases."""
    t = table(spark, folder, "documents").where("doc_id is not null and text is not null")
    return t.select(F.col("doc_id").alias("contig"), F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), LETTERS, TO_BASES).alias("seq"))


def _introns(spark, folder):
    """Introns of line items on those sequences."""
    t = table(spark, folder, "lineitem")
    start = F.col("l_suppkey") % 700
    return t.select(F.col("l_partkey").alias("contig"), F.col("l_orderkey").alias("tid"), start.alias("start0"), (start + 20 + F.col("l_quantity").cast("long")).alias("end0x"), F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise("+").alias("strand"))


def _pairs(spark, folder):
    return splicing.splice_pairs(_introns(spark, folder), contigs(spark, folder))


def j12_splice_pairs(spark, folder):
    """Introns per contig with a pair, and without."""
    return _pairs(spark, folder).groupBy("contig").agg(F.count("pair").alias("n_pairs"), F.count("*").alias("n"), F.max("pair").alias("last_pair"))


def a18_pair_histogram(spark, folder):
    """Introns by pair with their share."""
    return splicing.pair_histogram(_pairs(spark, folder))


def a25_calibrated_pair(spark, folder):
    """The pair that the introns speak for."""
    return splicing.calibrated_pair(_pairs(spark, folder))


def a26_strand_votes(spark, folder):
    """The strand each order's introns vote for, by the pair AA-CC."""
    return splicing.strand_votes(_pairs(spark, folder), "tid", "AA-CC")


def f28_flipped_pairs(spark, folder):
    """Pairs as the other strand reads them."""
    return _pairs(spark, folder).where("pair is not null").groupBy("pair").agg(F.count("*").alias("n")).withColumn("flipped", splicing.flipped(F.col("pair")))


def a16_locus_status(spark, folder):
    """Status of every locus, a place and side, from the clips that all libraries have there."""
    t = table(spark, folder, "locus_rows").where("chrom is not null and pos is not null").select("chrom", "pos", "side", F.col("longest_clip").alias("clip"), F.col("locus_id").alias("ord"))
    return splicing.locus_status(t, ["chrom", "pos"])


def w23_acceptor_ops(spark, folder):
    """Acceptor candidates of the reads: clips of eight bases or more."""
    return splicing.acceptor_ops(R.primary(reads(spark, folder)), 8, 6)


def w25_read_numbers(spark, folder):
    """Reads of an order numbered by occurrence."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return table(spark, folder, "lineitem").select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".m"), F.row_number().over(w).cast("string")).alias("read_id"), "l_partkey")


def w26_labels(spark, folder):
    """Part names made unique: repeated ones numbered, single ones kept."""
    w = Window.partitionBy("p_name")
    n, k = F.count("*").over(w), F.row_number().over(w.orderBy("p_partkey"))
    return table(spark, folder, "part").select("p_partkey", F.when(n > 1, F.concat("p_name", F.lit("_"), k.cast("string"))).otherwise(F.col("p_name")).alias("label"))


def s9_fragment_spans(spark, folder):
    """Spans of line items of an order as mates on a chromosome."""
    t = table(spark, folder, "lineitem")
    pos = (F.col("l_partkey") % 60) * 10
    m = t.select((F.col("l_suppkey") % 3).alias("ref"), F.col("l_orderkey").alias("qname"), pos.alias("pos0"), (pos + F.col("l_quantity").cast("long")).alias("end0x"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("ord"))
    return splicing.fragment_spans(m)


def s11_sequence_stats(spark, folder):
    """Number and length of all sequences, and how many hold a tail of one base."""
    c = contigs(spark, folder)
    tail = F.try_divide(S.base_count(F.right("seq", F.lit(8)), "A"), F.lit(8)) >= 0.8
    head = F.try_divide(S.base_count(F.left("seq", F.lit(8)), "T"), F.lit(8)) >= 0.8
    return c.agg(F.count("*").alias("n"), F.sum(F.length("seq")).alias("bases"), F.count_if((F.length("seq") >= 8) & (tail | head)).alias("n_tails"))


def pr14_by_length(spark, folder):
    """Sequences in upper case with their sort keys: falling length, then id."""
    t = table(spark, folder, "documents").where("text is not null").select("doc_id", F.upper(F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), LETTERS, TO_BASES)).alias("seq"))
    return t.select("doc_id", (-F.length("seq")).cast("long").alias("o1"), F.md5("seq").alias("md5"))


def s19_json_props(spark, folder):
    """Event properties read from JSON: count, sum and span by type."""
    t = table(spark, folder, "events").select("event_type", F.from_json("props", "k bigint").alias("p"))
    return t.groupBy("event_type").agg(F.count("p.k").alias("n"), F.sum("p.k").alias("k_sum"), F.min("p.k").alias("k_min"), F.max("p.k").alias("k_max"))


def k9_json_summary(spark, folder):
    """A summary of each annotation as one JSON object."""
    t = whole(spark, folder, "gene").groupBy("label").agg(F.count("*").alias("n"), F.min("s").alias("first"), F.max("e").alias("last"))
    return t.select("label", F.to_json(F.struct("n", F.struct("first", "last").alias("span"))).alias("json"))


def k3_junction_lines(spark, folder):
    """Junctions in nine columns."""
    j = R.junctions(R.primary(reads(spark, folder)), 100, 600)
    return j.select("chrom", "start", F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("0"), F.lit("0"), F.lit("0"), F.col("n_unique").cast("string"), F.col("n_multi").cast("string"), F.lit("0")).alias("line"))


def k1_file_order(spark, folder):
    """Features of coding genes with their sort keys: genes, their mRNAs, exons before coding parts."""
    g = whole(spark, folder, "gene").select("label", F.col("id").alias("g"), F.col("chrom").alias("gc"), F.col("s").alias("gs"))
    m = whole(spark, folder, "mRNA").where("pid is not null").select("label", F.col("pid").alias("g"), F.col("id").alias("m"), F.col("s").alias("ms"))
    x = parts(spark, folder, "exon", "CDS").select("label", F.col("pid").alias("m"), "kind", "id", "s", "e")
    rank = F.when(F.col("kind") == "exon", 0).otherwise(1).cast("long")
    key = [F.col("gc").alias("o1"), F.col("gs").alias("o2"), F.col("g").alias("o3")]
    low = g.join(m, ["label", "g"]).join(x, ["label", "m"]).select("label", *key, F.col("ms").alias("o4"), F.col("m").alias("o5"), rank.alias("o6"), F.col("s").alias("o7"), "kind", "id")
    mid = g.join(m, ["label", "g"]).select("label", *key, F.col("ms").alias("o4"), F.col("m").alias("o5"), F.lit(-1).cast("long").alias("o6"), F.col("ms").alias("o7"), F.lit("mRNA").alias("kind"), F.col("m").alias("id"))
    return low.unionByName(mid)


def pr1_renamed_types(spark, folder):
    """Rows as the other dialect names them: transcripts become mRNAs, contigs lose what follows a blank."""
    t = table(spark, folder, "intervals").where("featuretype in ('gene', 'mRNA', 'transcript', 'exon', 'CDS')")
    return t.select("row_id", F.when(F.col("featuretype") == "transcript", "mRNA").otherwise(F.col("featuretype")).alias("kind"), F.substring_index(F.btrim("chrom"), " ", 1).alias("seqid"))


def pr4_protein_hints(spark, folder):
    """Coding parts as hint lines."""
    return parts(spark, folder, "CDS").select("label", "id", F.concat_ws("\t", "chrom", F.lit("prot"), F.lit("CDSpart"), F.col("s").cast("string"), F.col("e").cast("string"), F.lit("."), "strand", F.lit("."), F.concat(F.lit("pri=1;src=P;group="), "pid")).alias("line"))


def pr9_exon_roles(spark, folder):
    """The role of every exon in its model: single, first, inner, last, by strand."""
    by = Window.partitionBy("label", "pid")
    x = parts(spark, folder, "exon").withColumns({"k": F.row_number().over(by.orderBy("s", "e", "id")), "n": F.count("*").over(by)})
    first, last = F.col("k") == 1, F.col("k") == F.col("n")
    back = F.col("strand") == "-"
    role = F.when(F.col("n") == 1, "Esngl").when(first, F.when(back, "Eterm").otherwise("Einit")).when(last, F.when(back, "Einit").otherwise("Eterm")).otherwise("Exon")
    return x.select("label", "pid", "id", "s", "e", role.alias("role"))


def x2_supported(spark, folder, labels=None):
    """Genes of a list of annotations (all unless given) that another one of it agrees with, pair by pair."""
    j = j5_concordant(spark, folder)
    named = j if labels is None else j.where(F.col("label").isin(*labels) & F.col("by_label").isin(*labels))
    return named.select("label", "gene_id").distinct()


def x7_all_ids(spark, folder):
    """Every reference id named on either side of the records."""
    t = table(spark, folder, "feature_records")
    return t.select(F.col("ref_annot_id").alias("annot_id"), F.col("ref_id").alias("id")).union(t.select("pred_annot_id", "pred_id")).where("id is not null").distinct()


def f7_neighbours(spark, folder):
    """How many of a key's one-letter neighbours are keys too."""
    k = table(spark, folder, "locus_rows").select(F.upper(F.btrim("motif_key", F.lit(BLANKS))).alias("key")).where("key rlike '^[ACGT]+$'").distinct()
    holes = k.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("i")).select("key", "i", F.concat(F.expr("left(key, i - 1)"), F.lit("_"), F.expr("substring(key, i + 1)")).alias("hole"))
    sizes = holes.groupBy("i", "hole").agg((F.count("*") - 1).alias("n"))
    return holes.join(sizes, ["i", "hole"]).groupBy("key").agg(F.sum("n").alias("n_neighbours"))


def f17_enzymes(spark, folder):
    """Enzyme numbers out of descriptions made of line items."""
    ec = F.concat(F.lit("part [EC:"), (F.col("l_partkey") % 9).cast("string"), F.lit("."), F.col("l_linenumber").cast("string"), F.lit("."), (F.col("l_suppkey") % 5).cast("string"), F.lit(".- 1.1.1.n2]"))
    t = table(spark, folder, "lineitem").select(ec.alias("d")).distinct()
    return t.select("d", F.array_join(X.enzyme_numbers(F.col("d")), ",").alias("ec"))


def j14_thresholds(spark, folder):
    """Line items against the price of their part as its threshold: hits above it, by part type."""
    part = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", F.expr("try_cast(p_retailprice as double)").alias("threshold"))
    t = table(spark, folder, "lineitem").join(part, "l_partkey")
    return t.groupBy("p_type").agg(F.count("*").alias("n"), F.count_if(F.col("l_extendedprice") >= F.col("threshold") * 10).alias("n_above"))


def j16_header_hits(spark, folder):
    """Customers with their orders as hits in one line, weak ones marked."""
    o = table(spark, folder, "orders").where("o_totalprice > 0")
    text = F.concat(F.lit("O"), F.col("o_orderkey").cast("string"), F.lit(": "), "o_orderpriority", F.when(F.col("o_totalprice") < 20000, " [marginal hit]").otherwise(""))
    hits = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", text.alias("t")))), lambda x: x["t"]), " ;; ").alias("hits"))  # a customer's orders
    return table(spark, folder, "customer").select("c_custkey", "c_name").join(hits, "c_custkey", "left")


def f34_fingerprints(spark, folder):
    """A fingerprint of every annotation's features that does not depend on their order."""
    t = whole(spark, folder, "gene").select("label", "id", F.md5(F.concat_ws("|", "id", "chrom", "strand", F.col("s").cast("string"), F.col("e").cast("string"))).alias("h"))
    num = F.conv(F.substring("h", 1, 10), 16, 10).cast("long")
    return t.groupBy("label").agg(F.count("*").alias("n"), F.sum(num % 1000003).alias("total"), F.bit_xor(num).alias("mixed"))


_CT = f"ct AS (SELECT doc_id AS contig, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{TO_BASES}') AS seq FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)"
_PR = _CT + """, it AS (SELECT l_partkey AS contig, l_orderkey AS tid, l_suppkey % 700 AS a, l_suppkey % 700 + 20 + CAST(l_quantity AS BIGINT) AS b, CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand FROM lineitem),
  pr AS (SELECT it.*, CASE WHEN b <= length(seq) THEN upper(substr(seq, a + 1, 2)) || '-' || upper(substr(seq, b - 1, 2)) END AS pair FROM it LEFT JOIN ct ON ct.contig = it.contig)"""
_FL = "reverse(translate(split_part(pair, '-', 2), 'ACGT', 'TGCA')) || '-' || reverse(translate(split_part(pair, '-', 1), 'ACGT', 'TGCA'))"
_J5 = """cd AS (SELECT label, pid AS id, list({'s': s, 'e': e} ORDER BY s, e) AS c FROM fp WHERE kind = 'CDS' GROUP BY 1, 2),
      m AS (SELECT f.label, f.id, f.pid, f.chrom, f.strand, f.s, f.e, cd.c, len(cd.c) AS n FROM fw f JOIN cd ON cd.label = f.label AND cd.id = f.id WHERE kind = 'mRNA')
      SELECT DISTINCT a.label, a.pid AS gene_id FROM m a JOIN m b ON a.label <> b.label AND a.chrom = b.chrom AND a.strand = b.strand AND a.s <= b.e AND b.s <= a.e
      WHERE a.pid IS NOT NULL AND a.n = b.n AND abs(a.s - b.s) <= 0.05 * greatest(a.e - a.s, b.e - b.s, 1) AND abs(a.e - b.e) <= 0.05 * greatest(a.e - a.s, b.e - b.s, 1)
      AND (a.n = 1 OR len(list_filter(range(1, a.n + 1), lambda i: (i > 1 AND abs(a.c[i].s - b.c[i].s) > 3) OR (i < a.n AND abs(a.c[i].e - b.c[i].e) > 3))) = 0)"""
_NH = f"r AS (SELECT qname, min(chrom) AS chrom, min(flag) AS flag, min(pos0) AS pos0, min(q) AS q, min(c) AS c, min(n) AS n, min(nh) AS nh FROM ({READ_SQL.replace('CAST(l_discount * 100 AS BIGINT) % 3', 'CAST(round(l_discount * 100) AS BIGINT) % 3')}) GROUP BY 1)"
# names of the form p<digit>_ belong to the nine problems; projections are pr<digit>_ here
QUERIES = {f.__name__: f for f in (
    j12_splice_pairs, a18_pair_histogram, a25_calibrated_pair, a26_strand_votes, f28_flipped_pairs, a16_locus_status, w23_acceptor_ops, w25_read_numbers, w26_labels, s9_fragment_spans, s11_sequence_stats, pr14_by_length, s19_json_props, k9_json_summary,
    k3_junction_lines, k1_file_order, pr4_protein_hints, pr9_exon_roles, x2_supported, x7_all_ids, f7_neighbours, f17_enzymes, j14_thresholds, j16_header_hits, f34_fingerprints, pr1_renamed_types,
)}
ORACLES = {
    "j12_splice_pairs": f"WITH {_PR} SELECT contig, count(pair) AS n_pairs, count(*) AS n, max(pair) AS last_pair FROM pr GROUP BY 1",
    "a18_pair_histogram": f"WITH {_PR} SELECT pair, count(*) AS n, count(*) / (SELECT count(*) FROM pr) AS share FROM pr GROUP BY 1",
    "a25_calibrated_pair": f"WITH {_PR}, k AS (SELECT CASE WHEN strand = '-' THEN {_FL} ELSE pair END AS p, count(*) AS n FROM pr WHERE pair IS NOT NULL GROUP BY 1), b AS (SELECT * FROM k ORDER BY n DESC, p DESC LIMIT 1) SELECT coalesce(CASE WHEN n >= 50 THEN p END, 'GT-AG') AS consensus FROM (SELECT 1) LEFT JOIN b ON true",
    "a26_strand_votes": f"WITH {_PR}, v AS (SELECT tid, count(*) FILTER (pair = 'AA-CC') AS plus, count(*) FILTER (pair = 'GG-TT') AS minus FROM pr GROUP BY 1) SELECT *, CASE WHEN plus > minus THEN '+' WHEN minus > plus THEN '-' ELSE 'ambiguous' END AS strand FROM v",
    "f28_flipped_pairs": f"WITH {_PR} SELECT pair, count(*) AS n, {_FL} AS flipped FROM pr WHERE pair IS NOT NULL GROUP BY pair",
    "a16_locus_status": """WITH c AS (SELECT chrom, pos, side, locus_id AS o, CASE WHEN length(longest_clip) >= 12 THEN CASE WHEN side = '5p' THEN right(upper(longest_clip), 12) ELSE left(upper(longest_clip), 12) END ELSE upper(longest_clip) END AS key
        FROM locus_rows WHERE chrom IS NOT NULL AND pos IS NOT NULL AND longest_clip IS NOT NULL AND side IS NOT NULL),
      k AS (SELECT chrom, pos, side, key, length(key) >= 12 AS lg, count(*) AS n, min(o) AS o FROM c GROUP BY 1, 2, 3, 4),
      t AS (SELECT *, row_number() OVER (PARTITION BY chrom, pos, side, lg ORDER BY o, key) AS rk FROM k),
      u AS (SELECT * FROM t WHERE NOT lg OR rk <= 5),
      d AS (SELECT chrom, pos, side, (list(key ORDER BY n DESC, rk) FILTER (lg))[1] AS ru, (list(key ORDER BY length(key) DESC, rk) FILTER (NOT lg))[1] AS lo FROM u GROUP BY 1, 2, 3),
      f AS (SELECT u.chrom, u.pos, u.side, ru, sum(n) FILTER (lg) AS tr, coalesce(sum(n) FILTER (lg AND CASE WHEN ru IS NULL THEN false ELSE hamming(CASE WHEN lg THEN key ELSE ru END, ru) <= 2 END), 0) AS nr,
        count(*) FILTER (NOT lg AND NOT CASE WHEN u.side = '5p' THEN ends_with(coalesce(ru, lo), key) ELSE starts_with(coalesce(ru, lo), key) END) AS mf FROM u JOIN d ON d.chrom = u.chrom AND d.pos = u.pos AND d.side = u.side GROUP BY 1, 2, 3, 4),
      n AS (SELECT chrom, pos, side, CAST(sum(n) AS BIGINT) AS n_clips FROM k GROUP BY 1, 2, 3),
      s AS (SELECT n.chrom, n.pos, n.side, n_clips, ru, CASE WHEN n_clips = 1 THEN 'singleton' WHEN mf > 0 THEN 'inconsistent' WHEN ru IS NULL THEN 'short_only' WHEN nr < 0.95 * tr THEN 'inconsistent' ELSE 'consistent' END AS status
        FROM f JOIN n ON n.chrom = f.chrom AND n.pos = f.pos AND n.side = f.side)
      SELECT chrom, pos, side, n_clips, status, CASE WHEN status = 'consistent' THEN ru ELSE '' END AS motif_key FROM s""",
    "w23_acceptor_ops": f"WITH {_NH} SELECT qname, chrom, pos0 + 1 AS pos, '+' AS strand, left(repeat('ACGTN', 60), c) AS bases FROM r WHERE c >= 8",
    "w25_read_numbers": "SELECT l_orderkey || '.m' || row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS read_id, l_partkey FROM lineitem",
    "w26_labels": "SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN p_name || '_' || row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) ELSE p_name END AS label FROM part",
    "s9_fragment_spans": """WITH m AS (SELECT l_suppkey % 3 AS ref, l_orderkey AS qname, (l_partkey % 60) * 10 AS a, (l_partkey % 60) * 10 + CAST(l_quantity AS BIGINT) AS b,
        (row_number() OVER (PARTITION BY l_suppkey % 3, l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1) // 2 AS k FROM lineitem),
      g AS (SELECT ref, qname, k, count(*) AS n, min(a) + 1 AS lend, max(b) AS rend FROM m GROUP BY 1, 2, 3) SELECT ref, qname, lend, rend FROM g WHERE n = 2 AND rend - lend + 1 BETWEEN 100 AND 500""",
    "s11_sequence_stats": f"""WITH {_CT} SELECT count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS bases, count(*) FILTER (length(seq) >= 8 AND ((8 - length(replace(right(seq, 8), 'a', ''))) / 8 >= 0.8 OR (8 - length(replace(left(seq, 8), 't', ''))) / 8 >= 0.8)) AS n_tails FROM ct""",
    "pr14_by_length": f"""WITH t AS (SELECT doc_id, upper(translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{TO_BASES}')) AS seq FROM documents WHERE text IS NOT NULL) SELECT doc_id, -length(seq) AS o1, md5(seq) AS md5 FROM t""",
    "s19_json_props": "WITH t AS (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS k_sum, min(k) AS k_min, max(k) AS k_max FROM t GROUP BY 1",
    "k9_json_summary": sql("""SELECT label, '{"n":' || count(*) || ',"span":{"first":' || min(s) || ',"last":' || max(e) || '}}' AS json FROM fw WHERE kind = 'gene' GROUP BY 1"""),
    "k3_junction_lines": f"WITH {_NH} SELECT chrom, pos0 + q + 1 AS start, concat_ws(chr(9), chrom, pos0 + q + 1, pos0 + q + n, '0', '0', '0', count(*) FILTER (nh <= 1), count(*) FILTER (nh > 1), '0') AS line FROM r WHERE n BETWEEN 100 AND 600 GROUP BY chrom, pos0, q, n",
    "k1_file_order": sql("""j AS (SELECT g.label, g.chrom AS o1, g.s AS o2, g.id AS o3, m.s AS o4, m.id AS o5 FROM fw g JOIN fw m ON g.kind = 'gene' AND m.kind = 'mRNA' AND m.label = g.label AND m.pid = g.id)
      SELECT j.*, CASE WHEN p.kind = 'exon' THEN 0 ELSE 1 END AS o6, p.s AS o7, p.kind, p.id FROM j JOIN fp p ON p.label = j.label AND p.pid = j.o5 AND p.kind IN ('exon', 'CDS') UNION ALL SELECT j.*, -1, o4, 'mRNA', o5 FROM j"""),
    "pr1_renamed_types": "SELECT row_id, CASE featuretype WHEN 'transcript' THEN 'mRNA' ELSE featuretype END AS kind, split_part(trim(chrom), ' ', 1) AS seqid FROM intervals WHERE featuretype IN ('gene', 'mRNA', 'transcript', 'exon', 'CDS')",
    "pr4_protein_hints": sql("SELECT label, id, concat_ws(chr(9), chrom, 'prot', 'CDSpart', s, e, '.', strand, '.', 'pri=1;src=P;group=' || pid) AS line FROM fp WHERE kind = 'CDS'"),
    "pr9_exon_roles": sql("""x AS (SELECT *, row_number() OVER (PARTITION BY label, pid ORDER BY s, e, id) AS k, count(*) OVER (PARTITION BY label, pid) AS n FROM fp WHERE kind = 'exon')
      SELECT label, pid, id, s, e, CASE WHEN n = 1 THEN 'Esngl' WHEN k = 1 THEN CASE WHEN strand = '-' THEN 'Eterm' ELSE 'Einit' END WHEN k = n THEN CASE WHEN strand = '-' THEN 'Einit' ELSE 'Eterm' END ELSE 'Exon' END AS role FROM x"""),
    "x2_supported": sql(_J5),
    "x7_all_ids": "SELECT ref_annot_id AS annot_id, ref_id AS id FROM feature_records WHERE ref_id IS NOT NULL UNION SELECT pred_annot_id, pred_id FROM feature_records WHERE pred_id IS NOT NULL",
    "f7_neighbours": r"""WITH k AS (SELECT DISTINCT upper(trim(motif_key, E' \t\r\n')) AS key FROM locus_rows WHERE regexp_full_match(upper(trim(motif_key, E' \t\r\n')), '[ACGT]+')),
      h AS (SELECT key, i, left(key, i - 1) || '_' || substr(key, i + 1) AS hole FROM (SELECT key, unnest(range(1, length(key) + 1)) AS i FROM k)), z AS (SELECT i, hole, count(*) - 1 AS n FROM h GROUP BY 1, 2)
      SELECT h.key, CAST(sum(z.n) AS BIGINT) AS n_neighbours FROM h JOIN z ON z.i = h.i AND z.hole = h.hole GROUP BY 1""",
    "f17_enzymes": r"""WITH t AS (SELECT DISTINCT 'part [EC:' || l_partkey % 9 || '.' || l_linenumber || '.' || l_suppkey % 5 || '.- 1.1.1.n2]' AS d FROM lineitem)
      SELECT d, array_to_string(list_filter(string_split(regexp_extract(d, '\[EC:([^\]]*)\]', 1), ' '), lambda x: regexp_full_match(x, '[1-7](\.([0-9]+|-|n[0-9]+)){3}')), ',') AS ec FROM t""",
    "j14_thresholds": "SELECT p_type, count(*) AS n, count(*) FILTER (l_extendedprice >= p_retailprice * 10) AS n_above FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1",
    "j16_header_hits": """WITH h AS (SELECT o_custkey, string_agg('O' || o_orderkey || ': ' || o_orderpriority || CASE WHEN o_totalprice < 20000 THEN ' [marginal hit]' ELSE '' END, ' ;; ' ORDER BY o_orderkey) AS hits FROM orders WHERE o_totalprice > 0 GROUP BY 1)
      SELECT c_custkey, c_name, hits FROM customer LEFT JOIN h ON o_custkey = c_custkey""",
    "f34_fingerprints": sql("""x AS (SELECT label, CAST('0x' || substr(md5(concat_ws('|', id, chrom, strand, s, e)), 1, 10) AS BIGINT) AS v FROM fw WHERE kind = 'gene') SELECT label, count(*) AS n, CAST(sum(v % 1000003) AS BIGINT) AS total, bit_xor(v) AS mixed FROM x GROUP BY 1"""),
}
