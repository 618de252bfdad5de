"""Stretches and gaps against a plain sweep; dyadic blocks on their own."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandloom.operators.periods import decompose, periods

from conftest import rows


def sweep(items):
    out = []
    for s, e in sorted(set(items)):
        if out and s <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], e)
            out[-1][2] += 1
        else:
            out.append([s, e, 1])
    merged = {("merged", s, e) for s, e, n in out if n > 1}
    return merged | {("gap", a[1] + 1, b[0] - 1) for a, b in zip(out, out[1:])}


@given(st.lists(st.tuples(st.integers(-300, 300), st.integers(1, 90)), min_size=1, max_size=20))
def test_blocks_cover_exactly(items):
    start, stop = np.array([s for s, _ in items]), np.array([s + n for s, n in items])
    who, level, at = decompose(start, stop)
    for i, (s, n) in enumerate(items):
        covered = sorted(x for k in np.flatnonzero(who == i) for x in range(at[k], at[k] + (1 << level[k])))
        assert covered == list(range(s, s + n))
        assert all(at[k] % (1 << level[k]) == 0 for k in np.flatnonzero(who == i))


@pytest.mark.parametrize("bits", [3, 6, 20])
def test_against_sweep(spark, bits):
    rng = np.random.default_rng(bits)
    data = [(k, q, int(s), int(s + n)) for k, q, s, n in zip(rng.choice(list("abc"), 150), rng.choice([None, "x"], 150), rng.integers(-90, 400, 150), rng.integers(0, 14, 150))]
    data += data[:40] + [(k, q, e, s) for k, q, s, e in data[:20]]  # repeated and turned ones
    df = spark.createDataFrame([(*d, 1, "z") for d in data], "k string, q string, a long, b long, kind int, s string")
    want = {(k, q, *c) for k, q in {(d[0], d[1]) for d in data} for c in sweep([(min(d[2:]), max(d[2:])) for d in data if d[:2] == (k, q)])}
    got = rows(periods(df, ["k", "q"], "a", "b", bits))
    assert set(got) == want and len(got) == len(want)


def test_null_bounds_and_empty(spark):
    df = spark.createDataFrame([("a", None, 5), ("a", 1, None), ("a", 3, 4)], "k string, a long, b long")
    assert periods(df, ["k"], "a", "b").count() == 0
    assert periods(df.limit(0), ["k"], "a", "b").count() == 0


def test_one_hot_entity_over_many_regions(spark):
    df = spark.range(4000).selectExpr("'hot' as k", "id * 3 as a", "id * 3 + id % 3 as b")
    want = sweep([(i * 3, i * 3 + i % 3) for i in range(4000)])
    assert {tuple(r)[1:] for r in periods(df, ["k"], "a", "b", 6).collect()} == want
