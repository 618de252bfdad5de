"""Queries on sequences and soft-clip loci, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.functions.ids import BLANKS
from strandloom.operators import softclips
from strandloom.sources.tables import table

K = 12


def loci(spark, folder):
    """Loci with the anchored key of their clip."""
    t = table(spark, folder, "locus_rows").where("longest_clip is not null and side is not null")
    return t.select("locus_id", "chrom", "pos", "side", "n_clips", "status", "motif_share", F.col("longest_clip").alias("clip"), S.anchored(F.col("longest_clip"), F.col("side"), K).alias("key"))


def f1_reverse_complement(spark, folder):
    """The other strand of every clip."""
    return loci(spark, folder).select("locus_id", S.reverse_complement(F.col("clip")).alias("rc"))


def f3_spliced(spark, folder):
    """First and last third of every clip joined, on the strand its side gives."""
    third = F.floor(F.length("clip") / 3).cast("int")
    joined = F.concat(F.left("clip", third), F.right("clip", third))
    return loci(spark, folder).select("locus_id", F.when(F.col("side") == "5p", S.reverse_complement(joined)).otherwise(joined).alias("spliced"))


def f4_translated(spark, folder):
    """Every clip as amino acids, by the standard code and by one with fewer stops."""
    return loci(spark, folder).select("locus_id", S.translate(F.col("clip"), 1).alias("aa1"), S.translate(F.col("clip"), 6).alias("aa6"))


def codon_rows(spark, folder, code=11):
    """Start and stop codons of every clip by place and frame."""
    t = loci(spark, folder)
    both = [t.select("locus_id", F.length("clip").alias("seqlen"), F.lit(kind).alias("codon"), F.explode(S.codon_positions(F.col("clip"), codons)).alias("pos")) for kind, codons in (("start", S.STARTS[code]), ("stop", S.stop_codons(code)))]
    return both[0].unionByName(both[1]).withColumn("frame", (F.col("pos") - 1) % 3)


def f5_codons(spark, folder):
    """Start codons ATG and the standard stops, by place and frame."""
    return codon_rows(spark, folder, 10)


def r9_orfs(spark, folder):
    """The longest frame of every clip: each start with the next stop behind it in its frame."""
    c = codon_rows(spark, folder, 10)
    ahead = Window.partitionBy("locus_id", "frame").orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    starts = c.withColumn("stop", F.min(F.when(F.col("codon") == "stop", F.col("pos"))).over(ahead)).where("codon = 'start' and stop is not null")
    w = Window.partitionBy("locus_id").orderBy((F.col("stop") - F.col("pos")).desc(), "frame", "pos")
    best = starts.withColumn("k", F.row_number().over(w)).where("k = 1")
    return best.select("locus_id", F.col("pos").alias("start"), (F.col("stop") + 2).alias("stop"), "frame", (F.col("stop") - F.col("pos")).alias("orflen"))


def f6_key_distance(spark, folder):
    """How far the delivered key lies from the anchored one."""
    t = table(spark, folder, "locus_rows").where("motif_key is not null and longest_clip is not null and side is not null")
    key, own = F.upper(F.btrim("motif_key", F.lit(BLANKS))), S.anchored(F.col("longest_clip"), F.col("side"), K)
    return t.select("locus_id", S.hamming(key, own).cast("long").alias("distance")).where("distance is not null")


def f10_adapters(spark, folder):
    """Clips that hold a run of a sequencing adapter of either strand, shortest run seven."""
    return loci(spark, folder).where(S.shares_run(F.col("clip"), S.ADAPTERS, 7)).select("locus_id", S.shares_run(F.col("clip"), S.ADAPTERS, 11).alias("sure"))


def f12_composition(spark, folder):
    """Base counts of every clip and whether one base rules it."""
    return loci(spark, folder).where("length(clip) > 0").select("locus_id", *[S.base_count(F.col("clip"), b).cast("long").alias(f"n_{b.lower()}") for b in "ACGT"], (S.top_share(F.col("clip")) > softclips.TRIVIAL).alias("trivial"))


def a20_poly_tails(spark, folder):
    """Clips that are tails: number, lengths and chromosomes of each kind."""
    t = loci(spark, folder).withColumn("kind", S.poly_tail(F.col("clip"), F.col("side"))).where("kind is not null")
    return t.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("clip")).alias("bases"), F.max(F.length("clip")).cast("long").alias("longest"), F.count_distinct("chrom").alias("n_chroms"))


def a12_key_clusters(spark, folder):
    """Loci, reads and an example of every anchored key."""
    return softclips.key_clusters(loci(spark, folder))


def a13_merged_keys(spark, folder):
    """Anchored keys joined to the commonest one up to two letters away."""
    return softclips.merge_keys(loci(spark, folder).where("key is not null").groupBy("key").agg(F.count("*").alias("n")), reach=2)


def a14_top_clusters(spark, folder):
    """The fifteen largest clusters, keys a letter apart merged."""
    return softclips.top_clusters(softclips.merged_clusters(loci(spark, folder))).drop("example")


def a15_consensus(spark, folder):
    """What the clips of a key agree on."""
    return softclips.consensus(loci(spark, folder))


def a17_share_histogram(spark, folder):
    """Consistent loci by motif share."""
    return softclips.share_histogram(table(spark, folder, "locus_rows"))


def a19_verdict(spark, folder):
    """The trans-splicing call over all loci."""
    return softclips.verdict(softclips.top_clusters(softclips.merged_clusters(loci(spark, folder))))


def a23_end_motifs(spark, folder):
    """Heads and tails of 16 letters that three clips or more share and no adapter explains."""
    ends = loci(spark, folder).where("length(clip) >= 16").select(F.explode(F.array(F.left(F.upper("clip"), F.lit(16)), F.right(F.upper("clip"), F.lit(16)))).alias("motif"))
    return ends.groupBy("motif").agg(F.count("*").alias("n")).where("n >= 3").where(~S.shares_run(F.col("motif"), S.ADAPTERS, 11))


def a24_site_support(spark, folder):
    """Support of every site and the libraries it comes from."""
    t = table(spark, folder, "locus_rows").where("pos is not null and chrom is not null and side is not null")
    return t.groupBy("chrom", "side", "pos").agg(F.count("*").alias("support"), F.array_join(F.sort_array(F.collect_set("library_id")), ",").alias("sources"))


_LOCI = "lc AS (SELECT locus_id, chrom, pos, side, n_clips, status, motif_share, longest_clip AS clip, CASE WHEN length(longest_clip) >= 12 THEN CASE WHEN side = '5p' THEN right(upper(longest_clip), 12) ELSE left(upper(longest_clip), 12) END END AS key FROM locus_rows WHERE longest_clip IS NOT NULL AND side IS NOT NULL)"
_RC = "reverse(translate({}, 'ACGTNacgtn', 'TGCANtgcan'))"
_AA = """CASE WHEN length(clip) < 3 THEN '' ELSE array_to_string(list_transform(range(0, length(clip) // 3), lambda i: CASE WHEN instr('TCAG', upper(clip[i * 3 + 1])) > 0 AND instr('TCAG', upper(clip[i * 3 + 2])) > 0
  AND instr('TCAG', upper(clip[i * 3 + 3])) > 0 THEN '{code}'[CAST((instr('TCAG', upper(clip[i * 3 + 1])) - 1) * 16 + (instr('TCAG', upper(clip[i * 3 + 2])) - 1) * 4 + instr('TCAG', upper(clip[i * 3 + 3])) AS INT)] ELSE 'X' END), '') END"""
_CODON = """cd AS (SELECT locus_id, length(clip) AS seqlen, 'start' AS codon, unnest(list_filter(range(1, length(clip) - 1), lambda i: upper(clip[i : i + 2]) = 'ATG')) AS pos FROM lc
  UNION ALL SELECT locus_id, length(clip), 'stop', unnest(list_filter(range(1, length(clip) - 1), lambda i: upper(clip[i : i + 2]) IN ('TAA', 'TAG'))) FROM lc)"""
_RUNS = {run: sorted({t[i : i + run] for s in S.ADAPTERS for t in (s, s.translate(str.maketrans("ACGT", "TGCA"))[::-1]) for i in range(len(t) - run + 1)}) for run in (7, 11)}
_HAS = lambda c, run: "(" + " OR ".join(f"contains(upper({c}), '{r}')" for r in _RUNS[run]) + ")"
_CNT = lambda b: f"(length(clip) - length(replace(upper(clip), '{b}', '')))"
_KC = "kc AS (SELECT key, count(DISTINCT (chrom, pos, side)) AS n_loci, CAST(sum(n_clips) AS BIGINT) AS n_reads, arg_min(clip, locus_id) AS example FROM lc WHERE key IS NOT NULL GROUP BY 1)"
QUERIES = {f.__name__: f for f in (
    f1_reverse_complement, f3_spliced, f4_translated, f5_codons, r9_orfs, f6_key_distance, f10_adapters, f12_composition, a20_poly_tails, a12_key_clusters, a13_merged_keys,
    a14_top_clusters, a15_consensus, a17_share_histogram, a19_verdict, a23_end_motifs, a24_site_support,
)}
ORACLES = {
    "f1_reverse_complement": f"WITH {_LOCI} SELECT locus_id, {_RC.format('clip')} AS rc FROM lc",
    "f3_spliced": f"WITH {_LOCI}, j AS (SELECT locus_id, side, left(clip, length(clip) // 3) || right(clip, length(clip) // 3) AS t FROM lc) SELECT locus_id, CASE WHEN side = '5p' THEN {_RC.format('t')} ELSE t END AS spliced FROM j",
    "f4_translated": f"WITH {_LOCI} SELECT locus_id, {_AA.replace('{code}', S.CODES[1])} AS aa1, {_AA.replace('{code}', S.CODES[6])} AS aa6 FROM lc",
    "f5_codons": f"WITH {_LOCI}, {_CODON} SELECT locus_id, seqlen, codon, pos, (pos - 1) % 3 AS frame FROM cd",
    "r9_orfs": f"""WITH {_LOCI}, {_CODON}, x AS (SELECT *, (pos - 1) % 3 AS frame FROM cd),
      y AS (SELECT *, min(CASE WHEN codon = 'stop' THEN pos END) OVER (PARTITION BY locus_id, frame ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop FROM x)
      SELECT locus_id, pos AS start, stop + 2 AS stop, frame, stop - pos AS orflen FROM (SELECT *, row_number() OVER (PARTITION BY locus_id ORDER BY stop - pos DESC, frame, pos) AS k FROM y WHERE codon = 'start' AND stop IS NOT NULL) WHERE k = 1""",
    "f6_key_distance": r"""WITH x AS (SELECT locus_id, upper(trim(motif_key, E' \t\r\n')) AS a, CASE WHEN length(longest_clip) >= 12 THEN CASE WHEN side = '5p' THEN right(upper(longest_clip), 12) ELSE left(upper(longest_clip), 12) END END AS b
      FROM locus_rows WHERE motif_key IS NOT NULL AND longest_clip IS NOT NULL AND side IS NOT NULL)
      SELECT locus_id, CAST(CASE WHEN length(a) <> length(b) THEN greatest(length(a), length(b)) WHEN length(a) = 0 THEN 0 ELSE len(list_filter(range(1, length(a) + 1), lambda i: a[i] <> b[i])) END AS BIGINT) AS distance FROM x WHERE b IS NOT NULL""",
    "f10_adapters": f"WITH {_LOCI} SELECT locus_id, {_HAS('clip', 11)} AS sure FROM lc WHERE {_HAS('clip', 7)}",
    "f12_composition": f"WITH {_LOCI} SELECT locus_id, {_CNT('A')} AS n_a, {_CNT('C')} AS n_c, {_CNT('G')} AS n_g, {_CNT('T')} AS n_t, greatest({_CNT('A')}, {_CNT('C')}, {_CNT('G')}, {_CNT('T')}) / length(clip) > 0.7 AS trivial FROM lc WHERE length(clip) > 0",
    "a20_poly_tails": f"""WITH {_LOCI}, x AS (SELECT *, CASE WHEN length(clip) >= 8 AND side = '3p' AND {_CNT('A')} / length(clip) >= 0.8 THEN 'polyA' WHEN length(clip) >= 8 AND side = '5p' AND {_CNT('T')} / length(clip) >= 0.8 THEN 'polyT' END AS kind FROM lc)
      SELECT kind, count(*) AS n, CAST(sum(length(clip)) AS BIGINT) AS bases, CAST(max(length(clip)) AS BIGINT) AS longest, count(DISTINCT chrom) AS n_chroms FROM x WHERE kind IS NOT NULL GROUP BY 1""",
    "a12_key_clusters": f"WITH {_LOCI}, {_KC} SELECT * FROM kc",
    "a15_consensus": f"""WITH {_LOCI}, o AS (SELECT key, side, left(CASE WHEN side = '5p' THEN reverse(upper(clip)) ELSE upper(clip) END, 60) AS t FROM lc WHERE key IS NOT NULL),
      c AS (SELECT key, side, unnest(range(0, length(t))) AS col, unnest(string_split(t, '')) AS base FROM o),
      n AS (SELECT key, side, col, base, count(*) AS n FROM c WHERE base IN ('A', 'C', 'G', 'T') GROUP BY 1, 2, 3, 4),
      b AS (SELECT key, side, col, sum(n) AS cover, (list(base ORDER BY n DESC, base))[1] AS base, max(n) AS n FROM n GROUP BY 1, 2, 3),
      g AS (SELECT *, row_number() OVER (PARTITION BY key, side ORDER BY col) AS k FROM b WHERE cover >= 5 AND n >= 0.6 * cover),
      s AS (SELECT key, side, string_agg(base, '' ORDER BY col) AS t FROM g WHERE k = col + 1 GROUP BY 1, 2)
      SELECT key, side, CASE WHEN side = '5p' THEN reverse(t) ELSE t END AS consensus FROM s""",
    "a17_share_histogram": """SELECT CASE WHEN motif_share <= 1 THEN '1' WHEN motif_share <= 10 THEN '2-10' WHEN motif_share <= 100 THEN '11-100' WHEN motif_share <= 1000 THEN '101-1000' ELSE '>1000' END AS bucket, count(*) AS n
      FROM locus_rows WHERE status = 'consistent' AND motif_share IS NOT NULL GROUP BY 1""",
    "a23_end_motifs": f"""WITH {_LOCI}, e AS (SELECT left(upper(clip), 16) AS motif FROM lc WHERE length(clip) >= 16 UNION ALL SELECT right(upper(clip), 16) FROM lc WHERE length(clip) >= 16)
      SELECT motif, count(*) AS n FROM e GROUP BY 1 HAVING count(*) >= 3 AND NOT {_HAS('motif', 11)}""",
    "a24_site_support": "SELECT chrom, side, pos, count(*) AS support, array_to_string(list_sort(list(DISTINCT library_id) FILTER (library_id IS NOT NULL)), ',') AS sources FROM locus_rows WHERE pos IS NOT NULL AND chrom IS NOT NULL AND side IS NOT NULL GROUP BY 1, 2, 3",
}
