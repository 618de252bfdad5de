"""Spliced models, cuts at given bases, de-fusing, near runs, condensed sets, files: literal cases."""

from pyspark.sql import functions as F

from strandloom.functions import sequence as S
from strandloom.operators import compare, contigs, defuse, models, signal, splicing
from strandloom.session import clear_staged, stage
from strandloom.sources import formats


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def exons(spark, *parts):
    return spark.createDataFrame([(t, "c", st, s, e) for t, st, s, e in parts], "tid string, chrom string, strand string, s long, e long")


def test_models_cut_at_given_bases(spark):
    e = exons(spark, ("a", "+", 1, 20), ("a", "+", 31, 50), ("b", "-", 1, 20), ("b", "-", 31, 50), ("n", "+", 1, 9))
    at = spark.createDataFrame([("a", "c", "+", 25), ("b", "c", "-", 25), ("a", "c", "+", 25), ("a", "c", "+", 900), ("a", "c", "+", 0)], "tid string, chrom string, strand string, cut long")
    got = rows(models.cut_at(e, at, 5), "tid", "s", "e")
    assert got == [("a.j1", 1, 20), ("a.j1", 31, 35), ("a.j2", 36, 50), ("b.j1", 16, 20), ("b.j1", 31, 50), ("b.j2", 1, 15), ("n", 1, 9)]
    assert rows(models.cut_at(e.where("tid = 'a'"), at, 18), "tid", "s", "e") == [("a.j1", 1, 20), ("a.j1", 31, 35)]
    assert rows(models.cut_at(e.where("tid = 'a'"), at, 99), "tid", "s", "e") == [("a", 1, 20), ("a", 31, 50)]
    assert models.cut_at(e.limit(0), at, 5).count() == 0


def test_spliced_over_window_borders(spark):
    c = spark.createDataFrame([("k", "AAAACCCCGGGGTTTTACGT"), ("e", ""), ("z", None)], "contig string, seq string")
    e = spark.createDataFrame([("p", "k", "+", 1, 4), ("p", "k", "+", 9, 12), ("m", "k", "-", 1, 4), ("m", "k", "-", 9, 12), ("off", "k", "+", 19, 40), ("no", "x", "+", 1, 4), ("em", "e", ".", 1, 4)], "tid string, contig string, strand string, s long, e long")
    want = [("em", ""), ("m", "CCCCTTTT"), ("no", ""), ("off", "GT"), ("p", "AAAAGGGG")]
    for width in (3, 5, 100):
        assert rows(contigs.spliced(e, c, width), "tid", "seq") == want


def test_splice_pairs_off_the_contig_and_repeated(spark):
    c = spark.createDataFrame([("k", "aaGTccccAGtt")], "contig string, seq string")
    i = spark.createDataFrame([("k", 2, 10), ("k", 2, 10), ("k", 2, 13), ("k", 2, 5), ("x", 2, 10), (None, 2, 10), ("k", -1, 10)], "contig string, start0 long, end0x long")
    assert rows(splicing.splice_pairs(i, c), "pair") == [("GT-AG",)] * 2 + [(None,)] * 5


def test_defused_models(spark):
    hit = "struct<s:bigint,e:bigint,sign:int>"
    df = spark.createDataFrame([("two", 300, [(1, 100, 1), (201, 300, -1)]), ("one", 300, [(1, 100, 1)]), ("over", 300, [(1, 100, 1), (50, 150, 1)]), ("tiny", 300, [(1, 10, 1), (25, 290, 1)]), ("none", 300, [])], f"tid string, length long, hits array<{hit}>")
    got = rows(defuse.defused(df), "tid", "s", "e", "sign")
    assert got == [("none", 1, 300, None), ("one", 1, 300, None), ("over", 1, 300, None), ("tiny", 1, 300, None), ("two.d1", 1, 150, 1), ("two.d2", 151, 300, -1)]
    assert rows(defuse.audit(df), "tid", "n_pieces", "seams") == [("two", 2, "150")]


def test_near_runs_and_neighbours(spark):
    df = spark.createDataFrame([("AAGATTACAGATCACA",), ("GAT",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(S.near_positions(F.col("t"), "GATTACA", 1)).collect()] == [[3, 10], [], [], []]
    assert df.select(S.neighbours(F.lit("AC")).alias("n")).first()["n"] == ["CC", "GC", "TC", "AA", "AG", "AT"]


def test_codons_of_long_and_odd_sequences(spark):
    df = spark.createDataFrame([("ATATGATTG",), ("at",), (None,), ("AAATGCCCCTAAGGG",), ("ACG" * 40000 + "TAA",)], "t string")
    got = [r[0] for r in df.select(S.codon_positions(F.col("t"), S.STARTS[11])).collect()]
    assert got[:3] == [[1, 6], [], None]
    assert [r[0] for r in df.select(S.codon_positions(F.col("t"), ["TAA"])).collect()][3:] == [[10], [120001]]
    assert [r[0] for r in df.select(S.translate(F.col("t"))).collect()] == ["I*L", "", None, "KCP*G", "T" * 40000 + "*"]


def test_condensed_sets(spark):
    agreed = spark.createDataFrame([("match", "a,b,c", 3), ("match", "a", 1), ("match", "", 2), ("match", "a,b", 5), ("match", "b,c", 7)], "class string, labels string, n long")
    assert rows(compare.condensed(agreed, ["a", "b", "c"], most=2), "labels", "n") == [("", 2), ("a", 1), ("a,b,c", 3), ("other", 12)]
    assert compare.condensed(agreed, ["a", "b", "c"]).count() == 5


def test_lines_of_split_files_keep_their_order(spark, tmp_path):
    (tmp_path / "a.gff").write_text("c\ts\tgene\t1\t2\t.\t+\t.\tID=a\r\n##FASTA\n>x\nAC\nc\ts\tgene\t1\t2\t.\t+\t.\tID=lost\n")
    (tmp_path / "b.gff").write_text("c\ts\tgene\t5\t6\t.\t+\t.\tID=b\n")
    assert rows(formats.gff(formats.lines(spark, str(tmp_path))), "start") == [(1,), (5,)]
    (tmp_path / "n.txt").write_text("# no\n\n one \nx > y\n")
    assert rows(formats.named_lines(spark, str(tmp_path / "n.txt")), "name") == [("one",), ("x > y",)]
    (tmp_path / "s.fa").write_text(">a > b\nAC\nGT\n>c\n\n>d\nA")
    assert rows(formats.fasta_records(spark, str(tmp_path / "s.fa")), "id", "seq") == [("a", "ACGT"), ("c", ""), ("d", "A")]


def test_staged_tables_are_cleared(spark):
    df = stage(spark.range(3))
    assert df.count() == 3 and clear_staged(spark) >= 1 and clear_staged(spark) == 0


def test_points_move_to_the_lowest_coverage(spark):
    frags = [("a", 60, 5, 20), ("a", 60, 10, 30), ("a", 60, 33, 50), ("a", 60, 40, 58)]
    seg = signal.window_agreement(spark.createDataFrame(frags, "ref string, length long, lend long, rend long"), 10)
    cover = [sum(x <= p <= y for _, _, x, y in frags) for p in range(1, 61)]
    for r in (3, 12):
        got = {x["pos"]: x["moved"] for x in signal.repositioned(spark.createDataFrame([("a", p) for p in range(1, 61)], "ref string, pos long"), seg, r).collect()}
        for p in range(1, 61):
            around = range(max(1, p - r), min(60, p + r) + 1)
            low = min(cover[q - 1] for q in around)
            assert got[p] == (p if cover[p - 1] == low else next(q for q in around if cover[q - 1] == low)), (p, r)


def test_clip_points_between_two_dense_stretches(spark):
    rows_ = [("t", 700, i, i + 150) for i in range(1, 80)] + [("t", 700, i, i + 150) for i in range(400, 480)] + [("d", 350, i, i + 150) for i in range(1, 200)]
    got = signal.clip_points(spark.createDataFrame(rows_, "ref string, length long, lend long, rend long")).collect()
    assert [r["ref"] for r in got] == ["t"] and 230 < got[0]["cut"] < 400
