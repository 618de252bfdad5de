"""Queries on transcript models, reading frames and signals, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.operators import models, signal
from strandloom.plans.adapters import parts, sql, whole
from strandloom.sources.tables import table


def exons(spark, folder):
    """Well-formed models: the exons of all rows of a transcript, merged where they touch."""
    t = table(spark, folder, "transcripts").where("strand in ('+', '-', '.') and chrom is not null and tid is not null").select("tid", "chrom", "strand", F.inline("exons").alias("s", "e"))
    t = t.where("s is not null and e is not null").select("tid", "chrom", "strand", F.least("s", "e").alias("s"), F.greatest("s", "e").alias("e")).distinct()
    return models.flattened(t)


def frames(spark, folder):
    """Reading frames with all they need."""
    return table(spark, folder, "orfs").where("id is not null and orflen > 0 and start is not null and stop is not null and strand is not null")


def s5_models(spark, folder):
    """Models in one row each: exons, span and spliced length."""
    e = exons(spark, folder)
    return e.groupBy("tid", "chrom", "strand").agg(F.count("*").alias("n_exons"), F.min("s").alias("start"), F.max("e").alias("end_"), F.sum(F.col("e") - F.col("s") + 1).alias("spliced_len"))


def k2_model_lines(spark, folder):
    """Models as gene, mRNA and exon lines with their place in the file."""
    return models.gff_lines(exons(spark, folder))


def pr15_match_chains(spark, folder):
    """Exons as blocks of a match with target places."""
    return models.match_chain(exons(spark, folder))


def w6_phases(spark, folder):
    """Coding phases of the coding parts of every parent."""
    return models.phases(parts(spark, folder, "CDS")).select("label", "pid", "id", "s", "e", "strand", "phase")


def w14_longest_orf(spark, folder):
    """The longest frame of every transcript and strand that is long enough."""
    return models.longest_orf(frames(spark, folder)).select("id", "strand", "orf_no", "orflen")


def w15_orf_to_genome(spark, folder):
    """The longest forward frame of every transcript as coding parts on the genome."""
    best = models.longest_orf(frames(spark, folder)).where("strand = '+'").select(F.col("id").alias("tid"), "orf_no", "start", "stop")
    return models.orf_to_genome(exons(spark, folder), best, ("tid", "chrom", "strand"))


def w16_projection(spark, folder):
    """The middle of every model's span on its spliced transcript, where an exon covers it."""
    e = exons(spark, folder)
    mid = e.groupBy("tid", "chrom", "strand").agg(F.floor((F.min("s") + F.max("e")) / 2).alias("pos"))
    return models.project(e, mid)


def w17_long_introns(spark, folder):
    """Introns over 300 bases and where a cut there falls on the transcript."""
    return models.long_gaps(exons(spark, folder), 300)


def w19_split_models(spark, folder):
    """Models cut at introns over 300 bases, pieces under 25 bases dropped."""
    return models.split(exons(spark, folder), 300, 25)


def a22_depth(spark, folder):
    """How many genes of all annotations cover a stretch."""
    return signal.depth(whole(spark, folder, "gene"), ("chrom", "strand"))


def a32_intron_lengths(spark, folder):
    """How often each intron length occurs."""
    return models.numbered(exons(spark, folder)).where("gap is not null").groupBy(F.col("gap").alias("intron_len")).agg(F.count("*").alias("n"))


def a34_long_intron_models(spark, folder):
    """Per model, its number of introns over 200 bases."""
    return models.long_gaps(exons(spark, folder), 200).groupBy("tid", "chrom", "strand").agg(F.count("*").alias("n_long"))


def _fragments(spark, folder):
    return frames(spark, folder).where("seqlen > 0").select(F.col("id").alias("ref"), F.col("seqlen").alias("length"), F.least("start", "stop").alias("lend"), F.greatest("start", "stop").alias("rend"))


def w8_window_agreement(spark, folder):
    """Agreement of the frames of a transcript over windows of 100 bases, as segments."""
    return signal.window_agreement(_fragments(spark, folder), 100)


def w10_troughs(spark, folder):
    """Places where few frames run through between places where many do."""
    return signal.troughs(signal.window_agreement(_fragments(spark, folder), 100), 0.3, 0.15, 400)


def w13_clip_points(spark, folder):
    """Cuts of transcripts between stretches that many frames cover, at the lowest coverage nearby."""
    return signal.clip_points(_fragments(spark, folder), hill=0.15, reach=400)


_E = """
xs AS (SELECT tid, chrom, strand, unnest(exons) AS u FROM transcripts WHERE strand IN ('+', '-', '.') AND chrom IS NOT NULL AND tid IS NOT NULL),
xd AS (SELECT DISTINCT tid, chrom, strand, least(u.start, u.end_) AS s, greatest(u.start, u.end_) AS e FROM xs WHERE u.start IS NOT NULL AND u.end_ IS NOT NULL),
xf AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY tid, chrom, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS f FROM xd),
xg AS (SELECT *, sum(f) OVER (PARTITION BY tid, chrom, strand ORDER BY s, e) AS g FROM xf),
ex AS (SELECT tid, chrom, strand, min(s) AS s, max(e) AS e FROM xg GROUP BY tid, chrom, strand, g),
nx AS (SELECT *, row_number() OVER w AS k, CAST(coalesce(sum(e - s + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off, lead(s) OVER w - e - 1 AS gap,
  CAST(sum(e - s + 1) OVER (PARTITION BY tid, chrom, strand) AS BIGINT) AS tot FROM ex WINDOW w AS (PARTITION BY tid, chrom, strand ORDER BY s, e))"""
_L = """, lo AS (SELECT id, strand, orf_no, orflen, start, stop FROM (SELECT *, row_number() OVER (PARTITION BY id, strand ORDER BY orflen DESC, frame, start, orf_no) AS k FROM orfs
  WHERE id IS NOT NULL AND orflen > 90 AND start IS NOT NULL AND stop IS NOT NULL AND strand IS NOT NULL AND seqlen > 0 AND orflen / seqlen > 0.5) WHERE k = 1)"""
_W8 = """WITH f AS (SELECT id AS ref, seqlen AS length, greatest(least(start, stop), 1) AS a, least(greatest(start, stop), seqlen) AS b FROM orfs
  WHERE id IS NOT NULL AND orflen > 0 AND start IS NOT NULL AND stop IS NOT NULL AND strand IS NOT NULL AND seqlen > 0),
m AS (SELECT ref, length, a AS s, 1 AS l, 0 AS r, CASE WHEN b - 99 >= a THEN 1 ELSE 0 END AS w FROM f WHERE a <= b UNION ALL SELECT ref, length, b + 1, -1, 0, 0 FROM f WHERE a <= b
  UNION ALL SELECT ref, length, greatest(a - 99, 1), 0, 1, 0 FROM f WHERE a <= b UNION ALL SELECT ref, length, greatest(b - 98, 1), 0, -1, CASE WHEN b - 99 >= a THEN -1 ELSE 0 END FROM f WHERE a <= b),
g AS (SELECT ref, length, s, sum(l) AS l, sum(r) AS r, sum(w) AS w FROM m GROUP BY 1, 2, 3),
h AS (SELECT ref, length, s, coalesce(lead(s) OVER v - 1, length) AS e, CAST(sum(w) OVER v AS BIGINT) AS "both", CAST(sum(l) OVER v AS BIGINT) AS touch_left, CAST(sum(r) OVER v AS BIGINT) AS touch_right
  FROM g WINDOW v AS (PARTITION BY ref, length ORDER BY s)),
sg AS (SELECT ref, s, least(e, length) AS e, "both", touch_left, touch_right FROM h WHERE s <= length)"""
QUERIES = {f.__name__: f for f in (
    s5_models, k2_model_lines, pr15_match_chains, w6_phases, w8_window_agreement, w10_troughs, w13_clip_points, w14_longest_orf, w15_orf_to_genome, w16_projection, w17_long_introns, w19_split_models, a22_depth, a32_intron_lengths, a34_long_intron_models,
)}
ORACLES = {
    "s5_models": f"WITH {_E} SELECT tid, chrom, strand, count(*) AS n_exons, min(s) AS start, max(e) AS end_, CAST(sum(e - s + 1) AS BIGINT) AS spliced_len FROM ex GROUP BY 1, 2, 3",
    "k2_model_lines": f"""WITH {_E}, sp AS (SELECT tid, chrom, strand, min(s) AS ms, max(e) AS me FROM ex GROUP BY 1, 2, 3)
      SELECT chrom AS o1, ms AS o2, tid AS o3, 0 AS o4, concat_ws(chr(9), chrom, 'model', 'gene', ms, me, '.', strand, '.', 'ID=' || tid || '.gene') AS line FROM sp
      UNION ALL SELECT chrom, ms, tid, 1, concat_ws(chr(9), chrom, 'model', 'mRNA', ms, me, '.', strand, '.', 'ID=' || tid || ';Parent=' || tid || '.gene') FROM sp
      UNION ALL SELECT n.chrom, ms, n.tid, k + 1, concat_ws(chr(9), n.chrom, 'model', 'exon', s, e, '.', n.strand, '.', 'ID=' || n.tid || ':exon:' || k || ';Parent=' || n.tid)
      FROM nx n JOIN sp ON sp.tid = n.tid AND sp.chrom = n.chrom AND sp.strand = n.strand""",
    "pr15_match_chains": f"WITH {_E} SELECT tid, chrom, strand, s, e, off + 1 AS t_start, off + e - s + 1 AS t_end FROM nx",
    "w6_phases": sql("""x AS (SELECT *, coalesce(sum(e - s + 1) OVER (PARTITION BY label, pid ORDER BY CASE WHEN strand = '-' THEN -e ELSE s END, s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS d
      FROM fp WHERE kind = 'CDS') SELECT label, pid, id, s, e, strand, CAST((3 - d % 3) % 3 AS BIGINT) AS phase FROM x"""),
    "w8_window_agreement": _W8 + " SELECT * FROM sg",
    "w14_longest_orf": "WITH " + _L.lstrip(", ") + " SELECT id, strand, orf_no, orflen FROM lo",
    "w15_orf_to_genome": f"""WITH {_E}{_L}, j AS (SELECT n.*, l.orf_no, l.start, l.stop, CASE WHEN n.strand <> '-' THEN off ELSE tot - off - (e - s + 1) END AS o5 FROM lo l JOIN nx n ON n.tid = l.id WHERE l.strand = '+'),
      q AS (SELECT *, greatest(start - 1, o5) - o5 AS lo, least(stop, o5 + e - s + 1) - o5 AS hi FROM j)
      SELECT tid, chrom, strand, orf_no, CASE WHEN strand <> '-' THEN s + lo ELSE e - hi + 1 END AS cds_s, CASE WHEN strand <> '-' THEN s + hi - 1 ELSE e - lo END AS cds_e FROM q WHERE lo < hi""",
    "w16_projection": f"""WITH {_E}, p AS (SELECT tid, chrom, strand, (min(s) + max(e)) // 2 AS pos FROM ex GROUP BY 1, 2, 3)
      SELECT p.tid, p.chrom, p.strand, p.pos, n.off + p.pos - n.s + 1 AS spliced FROM p JOIN nx n ON n.tid = p.tid AND n.chrom = p.chrom AND n.strand = p.strand AND p.pos BETWEEN n.s AND n.e""",
    "w17_long_introns": f"WITH {_E} SELECT tid, chrom, strand, off + e - s + 1 AS cut, gap FROM nx WHERE gap > 300",
    "w19_split_models": f"""WITH {_E}, p AS (SELECT *, coalesce(sum(CASE WHEN gap > 300 THEN 1 ELSE 0 END) OVER (PARTITION BY tid, chrom, strand ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pc FROM nx),
      q AS (SELECT *, sum(e - s + 1) OVER (PARTITION BY tid, chrom, strand, pc) AS b, max(pc) OVER (PARTITION BY tid, chrom, strand) + 1 AS m FROM p),
      d AS (SELECT *, dense_rank() OVER (PARTITION BY tid, chrom, strand ORDER BY CASE WHEN strand = '-' THEN -pc ELSE pc END) AS r FROM q WHERE b >= 25 OR m = 1)
      SELECT chrom, strand, CASE WHEN m = 1 THEN tid ELSE tid || '.j' || r END AS tid, s, e FROM d""",
    "a22_depth": sql("""d AS (SELECT chrom, strand, s, sum(x) AS x FROM (SELECT chrom, strand, s, 1 AS x FROM fw WHERE kind = 'gene' UNION ALL SELECT chrom, strand, e + 1, -1 FROM fw WHERE kind = 'gene') GROUP BY 1, 2, 3 HAVING sum(x) <> 0),
      y AS (SELECT chrom, strand, s, lead(s) OVER w - 1 AS e, CAST(sum(x) OVER w AS BIGINT) AS depth FROM d WINDOW w AS (PARTITION BY chrom, strand ORDER BY s)) SELECT * FROM y WHERE depth > 0"""),
    "a32_intron_lengths": f"WITH {_E} SELECT gap AS intron_len, count(*) AS n FROM nx WHERE gap IS NOT NULL GROUP BY 1",
    "a34_long_intron_models": f"WITH {_E} SELECT tid, chrom, strand, count(*) AS n_long FROM nx WHERE gap > 200 GROUP BY 1, 2, 3",
}
