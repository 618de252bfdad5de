"""Interval algebra and comparison on the smallest cases and against brute force."""

import numpy as np
import pytest

from strandloom.operators import compare, intervals, matching

from conftest import rows

COLS = "id string, chrom string, strand string, s long, e long"


def some(spark, *items, label=None):
    df = spark.createDataFrame([(f"i{k}", *x) for k, x in enumerate(items)], COLS)
    return df.selectExpr(f"'{label}' as label", "*") if label else df


@pytest.mark.parametrize(
    ("a", "b", "bp"),
    [
        (("chr1", "+", 100, 500), ("chr1", "+", 400, 800), 101),
        (("chr1", "+", 100, 300), ("chr1", "+", 400, 800), None),
        (("chr1", "+", 100, 500), ("chr1", "-", 100, 500), None),
        (("chr1", "+", 100, 500), ("chr2", "+", 100, 500), None),
        (("chr1", "+", 100, 200), ("chr1", "+", 201, 300), None),
        (("chr1", "+", 100, 200), ("chr1", "+", 200, 300), 1),
        (("chr1", None, 100, 200), ("chr1", None, 100, 200), None),
    ],
)
def test_overlap_cases(spark, a, b, bp):
    got = [r["bp"] for r in intervals.overlap_join(some(spark, a), some(spark, b), bin_width=50).collect()]
    assert got == ([] if bp is None else [bp])


def test_overlap_join_against_brute_force(spark):
    rng = np.random.default_rng(3)
    make = lambda n: [(str(c), "+-"[t], int(s), int(s + w)) for c, t, s, w in zip(rng.choice(["x", "y"], n), rng.integers(0, 2, n), rng.integers(-200, 2000, n), rng.integers(0, 300, n))]
    a, b = make(60), make(80)
    want = {(f"i{i}", f"i{j}", min(x[3], y[3]) - max(x[2], y[2]) + 1) for i, x in enumerate(a) for j, y in enumerate(b) if x[:2] == y[:2] and x[2] <= y[3] and y[2] <= x[3]}
    got = rows(intervals.overlap_join(some(spark, *a), some(spark, *b), bin_width=64), "a_id", "b_id", "bp")
    assert set(got) == want and len(got) == len(want)
    hit = {w[0] for w in want}
    assert {r["id"] for r in intervals.overlap_semi(some(spark, *a), some(spark, *b)).collect()} == hit
    assert {r["id"] for r in intervals.overlap_semi(some(spark, *a), some(spark, *b), keep=False).collect()} == {f"i{k}" for k in range(60)} - hit


def test_scans_in_two_levels(spark):
    rng = np.random.default_rng(4)
    data = [("x", "+", int(s), int(s + w)) for s, w in zip(rng.integers(0, 5000, 200), rng.integers(0, 40, 200))]
    df = some(spark, *data)
    got = {r["id"]: r["m"] for r in intervals.scan_max(df, intervals.PLACE, "s", ["s", "e", "id"], df["e"], "m", True, 64).collect()}
    best, want = 0, {}
    for s, e, k in sorted((d[2], d[3], f"i{k}") for k, d in enumerate(data)):
        best = max(best, e)
        want[k] = best
    assert got == want
    assert rows(intervals.clusters(some(spark, ("x", "+", 100, 500), ("x", "+", 300, 700))), "island", "n") == [(100, 2), (100, 2)]
    assert intervals.clusters(some(spark, ("x", "+", 100, 200), ("x", "+", 500, 700))).count() == 0


def test_distance_clusters(spark):
    df = spark.createDataFrame([("c", 10, 1), ("c", 14, 5), ("c", 19, 5), ("c", 25, 9), ("d", 1, 1)], "chrom string, pos long, support long")
    assert rows(intervals.distance_clusters(df, ["chrom"], "pos", "support", 5), "chrom", "pos", "support", "members") == [("c", 14, 11, 3), ("c", 25, 9, 1), ("d", 1, 1, 1)]


def test_gene_classes(spark):
    ref = some(spark, ("c", "+", 100, 500), ("c", "+", 1000, 1400), ("c", "+", 1500, 1900), ("c", "-", 3000, 4000), ("c", "+", 6000, 6100), ("c", "-", 8000, 8500))
    pred = some(spark, ("c", "+", 100, 500), ("c", "+", 1000, 1900), ("c", "-", 3000, 3300), ("c", "-", 3600, 4000), ("c", "+", 9000, 9100), ("c", "-", 7990, 8510), label="p")
    got = compare.classify(ref, pred)
    assert {(r["ref_id"], r["pred_id"], r["classification"]) for r in got.collect()} == {
        ("i0", "i0", "exact"), ("i1", None, "merged"), ("i2", None, "merged"), ("i3", None, "fragmented"), ("i4", None, "missing"), ("i5", "i5", "inexact"), (None, "i4", "novel"),
    }
    near = got.where("ref_id = 'i5'").first()
    assert (near["boundary_5p"], near["boundary_3p"]) == (-10, 10)
    stats = compare.gene_stats(got).first()
    assert (stats["n_exact"], stats["n_novel"], stats["precision"]) == (1, 1, 2 / 3)
    assert compare.classify(ref, pred.limit(0)).count() == 0


def test_assignment():
    assert matching.assign(np.array([[10, 9], [9, 0]])) == [(0, 1), (1, 0)]
    assert matching.assign(np.array([[5, 5]])) == [(0, 0)]
    assert matching.assign(np.zeros((0, 3), int)) == []
    big = np.zeros((9, 9), int)
    big[0, 0], big[0, 1], big[1, 0] = 10, 9, 9
    assert matching.assign_greedily(big) == [(0, 0)]  # the largest first
    assert matching.assign(big) == [(0, 1), (1, 0)]  # the best sum, however many parts
