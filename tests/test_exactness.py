"""No caps, exact assignment, reads of one name: small cases against brute force."""

import pathlib
import random
from itertools import permutations, product
from urllib.parse import urlsplit

import numpy as np
from pyspark.sql import functions as F

from strandloom.operators import matching, reads, softclips, splicing
from strandloom.session import shared_folder


def test_assign_is_exact_for_every_size():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, m = rng.integers(1, 6, 2)
        bp = rng.integers(0, 9, (n, m)) * rng.integers(0, 2, (n, m))
        got = matching.assign(bp)
        small = bp if n <= m else bp.T
        best = max(sum(small[i, c] for i, c in enumerate(cols)) for cols in permutations(range(small.shape[1]), small.shape[0]))
        assert sum(bp[i, j] for i, j in got) == best and all(bp[i, j] > 0 for i, j in got)
        assert len({i for i, _ in got}) == len({j for _, j in got}) == len(got)
    assert matching.assign(np.zeros((0, 4), np.int64)) == [] and matching.assign(np.zeros((9, 9), np.int64)) == []
    greedy_fails = np.array([[10, 9] + [0] * 8, [9, 0] + [0] * 8] + [[0] * 10] * 8)  # beyond eight a side
    assert matching.assign(greedy_fails) == [(0, 1), (1, 0)]


def by_rank(counts, reach):
    order, seeds, out = sorted(counts, key=lambda k: (-counts[k], k)), [], {}
    for key in order:
        found = []
        for s in seeds:
            diff = [i + 1 for i, (x, y) in enumerate(zip(key, s, strict=True)) if x != y] if len(s) == len(key) else range(9)
            if 1 <= len(diff) <= reach and all(s[i - 1] in "ACGT" for i in diff):
                found.append((len(diff), diff[0], diff[1] if len(diff) > 1 else 0, s))
        out[key] = min(found)[3] if found else key
        if not found:
            seeds.append(key)
    return out


def test_merge_keys_up_to_two_letters(spark):
    rng = random.Random(5)
    for reach in (1, 2):
        counts = {"".join(rng.choice("ACGN" if k % 9 == 0 else "AC") for _ in range(6)): rng.randint(1, 5) for k in range(60)}
        df = spark.createDataFrame(list(counts.items()), "key string, n long")
        assert {r["key"]: r["seed"] for r in softclips.merge_keys(df, reach).collect()} == by_rank(counts, reach)


def test_merge_keys_among_all_keys_writes_no_pairs(spark):
    rng = random.Random(6)
    counts = {"".join(k): rng.randint(1, 50) for k in product("ACGT", repeat=6)}  # 153 neighbours each
    df = spark.createDataFrame(list(counts.items()), "key string, n long")
    folder = pathlib.Path(urlsplit(shared_folder(spark)).path)
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    was = size()
    got = softclips.merge_keys(df, 2)
    assert 0 < size() - was < 2_000_000
    assert {r["key"]: r["seed"] for r in got.collect()} == by_rank(counts, 2)


def test_merge_keys_of_other_letters_and_lengths(spark):
    rng = random.Random(7)
    few = {"NNNA": 5, "NNNC": 2, "A": 3, "C": 1, "N": 1, "": 4, "ACG\n": 2, "ACGT": 3, "acgt": 9}
    many = {"".join(rng.choice("ACGTacN_") for _ in range(rng.choice((1, 2, 3, 12, 13)))): rng.randint(1, 5) for _ in range(150)}
    for counts in (few, many):
        df = spark.createDataFrame(list(counts.items()), "key string, n long")
        for reach in (1, 2):
            assert {r["key"]: r["seed"] for r in softclips.merge_keys(df, reach).collect()} == by_rank(counts, reach)


def test_a_chain_of_any_length_settles(spark):
    keys = ["C" * i + "A" * (64 - i) for i in range(64)]
    df = spark.createDataFrame([(k, 100 - i) for i, k in enumerate(keys)] + [(None, 1)], "key string, n long")
    got = softclips.merge_keys(df).collect()
    assert len(got) == 64 and all(r["seed"] is not None for r in got)


def test_mates_of_one_name_are_reads_of_their_own(spark):
    rows = [("m", 99, "c", 100, 60, "30M50N30M", "A" * 60, 1), ("m", 147, "c", 400, 60, "20M", "A" * 20, 1), ("x", 0, "c", 100, 60, "30M50N30M", "A" * 60, 4)]
    df = spark.createDataFrame(rows, "qname string, flag int, chrom string, pos0 long, mapq int, cigar string, seq string, nh int")
    assert [tuple(r) for r in reads.junctions(df, 10, 100).collect()] == [("c", 131, 180, 1, 1)]
    assert sorted((r["s"], r["e"]) for r in reads.blocks(df.where("qname = 'm'")).collect()) == [(101, 130), (181, 210), (401, 420)]
    twice = df.unionByName(df).where("qname = 'm'")
    assert sorted(r["qname"] for r in reads.split_long(twice, 40).collect()) == ["m.0", "m.0", "m.1", "m.1"]


def test_long_cigars(spark):
    n = 10000
    cigar = "".join("3M1I" if i % 2 else "2M1D" for i in range(n // 2)) + "5M100N5M"
    df = spark.createDataFrame([("q", 0, "c", 7, 60, cigar, "A")], "qname string, flag int, chrom string, pos0 long, mapq int, cigar string, seq string")
    before = sum(3 for _ in range(n // 2)) + 5
    assert [(r["start0"], r["end0x"]) for r in reads.introns(df).collect()] == [(7 + before, 107 + before)]
    assert [(r["s"], r["e"]) for r in reads.blocks(df).collect()] == [(8, 7 + before), (108 + before, 112 + before)]


def test_motif_codes(spark):
    df = spark.createDataFrame([("GT-AG",), ("CT-AC",), ("CT-GC",), ("AA-AA",), (None,)], "pair string")
    code = reads.motif_code(F.col("pair"))
    assert [tuple(r) for r in df.select(code, reads.motif_strand(code)).collect()] == [(1, 1), (2, 2), (4, 2), (0, 0), (0, 0)]


def test_locus_status_without_a_cap(spark):
    keys = ["".join(x) for x in product("AC", repeat=3)]
    rows = [("l", "3p", k + "G" * 9, i) for i, k in enumerate(keys[:6])] + [("l", "3p", keys[6] + "G" * 9, 10 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "lib string, side string, clip string, ord long")
    capped, free = splicing.locus_status(df, ["lib"]).first(), splicing.locus_status(df, ["lib"], cap=None).first()
    assert capped["status"] == "consistent" or capped["motif_key"] != keys[6] + "G" * 9
    assert (free["status"], free["motif_key"], free["n_clips"]) == ("consistent", keys[6] + "G" * 9, 406)
