"""Models, signals, reads, formats and sequences on literal cases."""

from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.functions import text as X
from strandloom.operators import features, models, reads, signal, softclips
from strandloom.sources import formats

from conftest import rows


def model(spark, *exons, strand="+", tid="t"):
    return spark.createDataFrame([(tid, "c", strand, *x) for x in exons], "tid string, chrom string, strand string, s long, e long")


def test_projection_and_chain(spark):
    e = model(spark, (1, 40), (51, 90))
    pts = spark.createDataFrame([("t", "c", "+", 60), ("t", "c", "+", 45)], "tid string, chrom string, strand string, pos long")
    assert rows(models.project(e, pts), "pos", "spliced") == [(60, 50)]
    assert rows(models.match_chain(model(spark, (100, 200), (300, 400))), "t_start", "t_end") == [(1, 101), (102, 202)]


def test_split_at_long_introns(spark):
    assert rows(models.split(model(spark, (1, 40), (5100, 5140)), 5000, 25), "tid", "s", "e") == [("t.j1", 1, 40), ("t.j2", 5100, 5140)]
    assert rows(models.split(model(spark, (1, 40), (6000, 6010)), 5000, 25), "tid", "s", "e") == [("t.j1", 1, 40)]
    assert rows(models.split(model(spark, (1, 40), (50, 90)), 5000, 25), "tid") == [("t",), ("t",)]
    assert rows(models.split(model(spark, (1, 40), (5100, 5140), strand="-"), 5000, 25), "tid", "s") == [("t.j1", 5100), ("t.j2", 1)]


def test_phases_match_the_loop(spark):
    for strand in "+-":
        parts = [(10, 21), (30, 35), (50, 58), (70, 90)]
        df = spark.createDataFrame([("l", "p", f"x{k}", strand, s, e) for k, (s, e) in enumerate(parts)], "label string, pid string, id string, strand string, s long, e long")
        want, phase = {}, 0
        for s, e in parts if strand == "+" else parts[::-1]:
            want[s] = phase
            phase = (3 - ((e - s + 1 - phase) % 3)) % 3
        assert dict(rows(models.phases(df), "s", "phase")) == want


def test_orf_on_both_strands(spark):
    orf = spark.createDataFrame([("t", 1, 1, 9)], "tid string, orf_no long, start long, stop long")
    assert rows(models.orf_to_genome(model(spark, (100, 108)), orf), "cds_s", "cds_e") == [(100, 108)]
    assert rows(models.orf_to_genome(model(spark, (100, 108), strand="-"), orf), "cds_s", "cds_e") == [(100, 108)]
    assert rows(models.orf_to_genome(model(spark, (100, 108), strand="-"), orf, short_minus=True), "cds_s", "cds_e") == [(101, 108)]
    assert rows(models.orf_to_genome(model(spark, (100, 103), (200, 210)), orf), "cds_s", "cds_e") == [(100, 103), (200, 204)]


def test_depth_and_window_agreement(spark):
    df = spark.createDataFrame([("r", 1, 3), ("r", 2, 5)], "ref string, s long, e long")
    assert rows(signal.depth(df, ["ref"]), "s", "e", "depth") == [(1, 1, 1), (2, 3, 2), (4, 5, 1)]
    frags = spark.createDataFrame([("r", 300, 1, 50), ("r", 300, 110, 160)], "ref string, length long, lend long, rend long")
    seg = [r for r in signal.window_agreement(frags, 100).withColumn("q", signal.agreement_ratio()).collect() if r["s"] <= 11 <= r["e"]]
    assert [round(r["q"], 4) for r in seg] == [0.3333]  # the window of 11 to 110 touches both and spans none


def _trough_places(frags, length, ceiling, hill, reach, floor=0.05, greed=1.5, width=100):
    """Base by base; places are left edges of windows."""
    half, off, cov, both = reach // 2, (width - 1) // 2, [0] * (length + width + 2), [0] * (length + width + 2)
    for a, b in frags:
        for i in range(max(1, a), min(b, length) + 1):
            cov[i] += 1
            both[i] += i + width - 1 <= min(b, length)
    jac = [0.0] * (length + 1)
    for j in range(1, length - off + 1):
        jac[j + off] = (both[j] + 1) / (cov[j] + cov[j + width - 1] - 2 * both[j] + both[j] + 1)
    groups, last = [], None
    for i in range(reach, length + 1):
        c = jac[i - half]
        if c <= max(floor, min(greed * (1 / (cov[max(1, i - reach)] + cov[i] + 1)), ceiling)):
            if last is None or i - half - last > reach:
                groups.append([])
            last = i - half
            groups[-1].append((c, -(((jac[i - reach] - c) + (jac[i] - c)) / 2), last))
    best = [min(g) for g in groups]
    return [p - off for c, _, p in best if max(jac[max(1, p - reach) : p], default=0) >= c + hill and max(jac[p + 1 : p + reach + 1], default=0) >= c + hill]


def test_troughs_match_base_by_base(spark):
    import random

    rng = random.Random(7)
    cases = {f"r{k}": (n, [(x := rng.randint(1, n), x + rng.randint(20, 500)) for _ in range(m)]) for k, (n, m) in enumerate([(900, 6), (1500, 12), (2500, 40), (4000, 60), (4000, 300), (700, 3), (3000, 15), (60, 2), (2000, 8)])}
    # a deep valley: by cover the gate is the floor, so the fixed ceiling would let it through
    cases["deep"] = (1200, [(300, 560)] * 20 + [(620, 900)] * 20 + [(520, 650)] * 4)
    # a valley of 500 bases with hills on both sides
    cases["wide"] = (1500, [(1, 420)] * 30 + [(980, 1500)] * 30 + [(k, k + 60) for k in range(380, 980, 10) for _ in range(12)])
    df = spark.createDataFrame([(r, n, a, b) for r, (n, f) in cases.items() for a, b in f], "ref string, length long, lend long, rend long")
    for ceiling, hill, reach in ((0.3, 0.15, 400), (0.3, 0.35, 200)):
        got = rows(signal.troughs(signal.window_agreement(df, 100), ceiling, hill, reach), "ref", "s")
        want = sorted(((r, p) for r, (n, f) in cases.items() for p in _trough_places(f, n, ceiling, hill, reach)), key=repr)
        assert got == want and len(got) > 3


def test_reads(spark):
    df = spark.createDataFrame(
        [("a", 0, "c", 100, 60, "10M50N10M", "A" * 20), ("b", 16, "c", 150, 60, "20S10M", "ACGT" * 7 + "AC"), ("d", 0, "c", 100, 60, "10M6000N10M", "C" * 20), ("u", 4, None, 0, 0, None, "A"), ("s", 0x100, "c", 1, 60, "5M", "AAAAA")],
        "qname string, flag int, chrom string, pos0 long, mapq int, cigar string, seq string",
    )
    good = reads.primary(df, 1)
    assert rows(good, "qname") == [("a",), ("b",), ("d",)]
    assert rows(reads.introns(good.where("qname = 'a'")), "start0", "end0x") == [(110, 160)]
    assert rows(reads.blocks(good.where("qname = 'a'")), "s", "e") == [(101, 110), (161, 170)]
    clip = reads.clips(good, 8).first()
    assert (clip["side"], clip["anchor"], clip["clip"]) == ("3p", 150, ("ACGT" * 5)[::-1].translate(str.maketrans("ACGT", "TGCA")))
    assert rows(reads.split_long(df, 5000), "qname", "pos0", "cigar") == [("d.0", 100, "10M10S"), ("d.1", 6110, "10S10M")]
    assert rows(reads.junctions(good, 20, 100), "start", "end", "n_unique", "n_multi") == [(111, 160, 1, 0)]


def test_sequences(spark):
    one = lambda c, *x: spark.createDataFrame([x], ", ".join(f"c{i} string" for i in range(len(x)))).select(c).first()[0]
    a, b = F.col("c0"), F.col("c1")
    assert one(S.reverse_complement(a), "ACGTN") == "NACGT"
    assert one(S.translate(a), "ATGAAAAAATAAG") == "MKK*"
    assert one(S.translate(a), "AT") == "" and one(S.translate(a), "ANG") == "X" and one(S.translate(a), None) is None
    assert one(S.codon_positions(a, S.stop_codons(1)), "AAATGCCCCTAAGGG") == [10]
    assert one(S.codon_positions(a, S.stop_codons(6)), "AAATGCCCCTAAGGG") == []
    assert one(S.codon_positions(a, S.STARTS[11]), "ATATGATTG") == [1, 6]
    assert one(S.codon_positions(a, S.STARTS[11], True), "ATATGATTG") == [1, 3, 6, 7]
    assert one(S.hamming(a, b), "ACG", "AGG") == 1 and one(S.hamming(a, b), "ACG", "A") == 3 and one(S.hamming(a, b), "A", None) is None
    assert one(S.poly_tail(a, b), "AAAAAAAAAC", "3p") == "polyA" and one(S.poly_tail(a, b), "AAAA", "3p") is None
    assert one(S.shares_run(a, S.ADAPTERS), "ttAGATCGGAAGAGCtt") is True and one(S.shares_run(a, S.ADAPTERS), None) is False


def test_attribute_texts(spark):
    df = spark.createDataFrame([("ID=a;Parent=g1,g2;ID=b;flag",), ('gene_id "g;1"; transcript_id "t";',), (None,), ("",)], "x string")
    got = [r[0] for r in df.select(X.attributes(F.col("x"))).collect()]
    assert got == [{"Parent": ["g1", "g2"], "ID": ["b"]}, {"gene_id": ["g;1"], "transcript_id": ["t"]}, {}, {}]
    names = spark.createDataFrame([("X OS=a SV=1",), ("X (Fragment)",), (" OS=org OX=1",)], "x string")
    assert [r[0] for r in names.select(X.clean_product(F.col("x"))).collect()] == ["X", "X", "hypothetical protein"]
    ec = spark.createDataFrame([("a [EC:1.1.1.1 2.7.1.1 1.1.1.1]",), ("b [EC:1.1.1.-]",), ("c",)], "x string")
    assert [r[0] for r in ec.select(X.enzyme_numbers(F.col("x"))).collect()] == [["1.1.1.1", "2.7.1.1"], ["1.1.1.-"], []]


def test_formats(spark, tmp_path):
    (tmp_path / "a.gff").write_text("##gff-version 3\nc\tx\tgene\t1\t9\t.\t+\t.\tID=g1\nbad\nc\tx\tgene\tone\t9\t.\t+\t.\tID=g2\n##FASTA\nc\tx\tgene\t1\t9\t.\t+\t.\tID=g3\n")
    got = formats.gff(formats.lines(spark, str(tmp_path / "a.gff")))
    assert [r["attributes"] for r in got.collect()] == [{"ID": ["g1"]}]
    (tmp_path / "a.fa").write_text(">s1 x\nAC\nGT\n>s2\n\nA A\n")
    assert rows(formats.fasta_records(spark, str(tmp_path / "a.fa")), "id", "seq", "len") == [("s1", "ACGT", 4), ("s2", "AA", 2)]
    (tmp_path / "ko").write_text("knum\n" + "\t".join(["K1", "443.33", "full"] + ["-"] * 8 + ["def"]) + "\nK2\tshort\n" + "\t".join(["K3", "-", "-"] + ["-"] * 8 + ["d"]))
    assert rows(formats.ko_list(formats.lines(spark, str(tmp_path / "ko"))), "k", "threshold") == [("K1", 443.33), ("K3", None)]
    (tmp_path / "sj").write_text("chr1\t101\t160\t1\t1\t0\t5\t2\t0\nbad\tx\ty\n")
    assert rows(formats.junction_table(spark, str(tmp_path / "sj")), "start", "n_unique") == [(101, 5)]


def test_key_merge_follows_rank_order(spark):
    counts = {"AAAA": 9, "AAAT": 5, "AATT": 4, "CCCC": 3, "ACCC": 3, "GGGG": 1}
    df = spark.createDataFrame(list(counts.items()), "key string, n long")
    got = {r["key"]: r["seed"] for r in softclips.merge_keys(df).collect()}
    assert got == {"AAAA": "AAAA", "AAAT": "AAAA", "AATT": "AATT", "ACCC": "ACCC", "CCCC": "ACCC", "GGGG": "GGGG"}


def test_long_chains_of_keys_are_decided(spark):
    n = 53  # every key waits for the one before it
    df = spark.createDataFrame([("C" * k + "A" * (n - k), 100 - k) for k in range(n)], "key string, n long").coalesce(1)
    got = {r["key"].count("C"): r["seed"].count("C") for r in softclips.merge_keys(df).where("seed is not null").collect()}
    assert got == {k: k - k % 2 for k in range(n)}


def test_clusters_are_merged_before_ranking(spark):
    cols = "locus_id long, chrom string, pos long, side string, n_clips long, clip string, key string"
    data = [(1, "c", 10, "3p", 9, "AAAAx", "AAAA"), (2, "c", 20, "3p", 8, "AAATx", "AAAT"), (3, "c", 10, "3p", 1, "AAATy", "AAAT"), (4, "c", 30, "3p", None, "AACAx", "AACA"), (5, "c", 40, "3p", 3, "NGGGx", "NGGG"), (6, "c", 50, "3p", 2, "CGGGx", "CGGG"), (7, "c", 60, "3p", 1, "GCGCx", "GCGC"), (8, "c", 70, "3p", 1, "GCGCx", "GCGC")]
    got = softclips.merged_clusters(spark.createDataFrame(data, cols))
    # AAAA and AAAT have nine reads each; the place they share counts once; no seed with N is looked for
    assert rows(got, "key", "n_loci", "n_reads", "example") == [("AAAA", 3, 18, "AAAAx"), ("CGGG", 1, 2, "CGGGx"), ("GCGC", 2, 2, "GCGCx"), ("NGGG", 1, 3, "NGGGx")]
    many = [(i, "c", i, "3p", 11, k + "x", k) for i, k in ((j, "ACGTACGTACG" + "TA"[j % 2]) for j in range(120))]
    from strandloom.plans import sequence_queries as q

    top = softclips.top_clusters(softclips.merged_clusters(spark.createDataFrame(many, cols)))
    assert rows(softclips.verdict(top), "call", "n_loci", "n_reads") == [("MODERATE", 120, 1320)]
    was, q.loci = q.loci, lambda *_: spark.createDataFrame(many, cols)
    try:
        assert rows(q.a14_top_clusters(spark, ""), "key", "n_loci", "n_reads", "rank") == [("ACGTACGTACGA", 120, 1320, 1)]
        assert rows(q.a19_verdict(spark, ""), "call") == [("MODERATE",)]
    finally:
        q.loci = was


def test_distinct_sources_combine_before_they_are_collected(spark, tmp_path):
    from strandloom.plans import more_queries as q

    data = [("t", "b", 2), ("t", "a", 3), ("t", "b", 9), ("t", "a", 1), ("u", "b", 1), ("u", "a", 1), ("u", None, 0), ("v", "a", None)]
    df = spark.createDataFrame(data, "tid string, source string, at long").withColumn("assembled_at", F.timestamp_seconds("at"))
    df.write.parquet(str(tmp_path / "transcripts.parquet"))
    out = q.x8_distinct_sources(spark, str(tmp_path))
    assert rows(out) == [("t", "a,b"), ("u", "a,b")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2  # by source first


def test_drop_set_and_tags(spark):
    cols = "label string, id string, pid string, chrom string, strand string, s long, e long, kind string"
    make = lambda *r: spark.createDataFrame(list(r), cols)
    genes, mrna = make(("l", "g1", None, "c", "+", 1, 9, "gene"), ("l", "g2", None, "c", "+", 5, 9, "gene"), ("l", "g3", None, "b", "+", 5, 9, "gene")), make(("l", "m1", "g1", "c", "+", 1, 9, "mRNA"), ("l", "m2", "g2", "c", "+", 5, 9, "mRNA"))
    cds = make(("l", "c1", "m2", "c", "+", 5, 7, "CDS"))
    assert rows(features.without_coding(genes, mrna, cds), "kind", "id") == [("gene", "g1"), ("gene", "g3"), ("mRNA", "m1")]
    assert rows(features.locus_tags(genes, "T"), "id", "tag") == [("g1", "T_00002"), ("g2", "T_00003"), ("g3", "T_00001")]
