"""Frequent values: bounds of the summaries, exact second pass, odd inputs."""

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from strandloom.llm import heavy


def frame(c):
    return pd.DataFrame({"count": list(c.values()), "error": 0}, index=pd.Index(list(c), name="value"))


def test_summary_bounds_hold_through_merges():
    rng = np.random.default_rng(0)
    truth, parts = Counter(), []
    for _ in range(8):
        s = heavy.Summary(20)
        for _ in range(5):
            c = Counter(map(str, rng.zipf(1.3, 300) % 500))
            truth += c
            s.add(frame(c))
        parts.append(s)
    merged = heavy.Summary(20)
    for s in parts:
        merged.add(s.table, s.floor)
    assert len(merged.table) <= 20
    for value, row in merged.table.iterrows():
        assert row["count"] - row["error"] <= truth[value] <= row["count"]
    assert all(n <= merged.floor for v, n in truth.items() if v not in merged.table.index)


def test_frequent_is_exact(spark):
    rng = np.random.default_rng(2)
    values = ["top"] * 500 + ["mid"] * 120 + [f"rare{i}" for i in rng.integers(0, 10**6, 5000)] + [None] * 50
    rng.shuffle(values)
    df = spark.createDataFrame([(v, 1, "x") for v in values], "k string, n long, value string").repartition(6)
    got = {r["value"]: r["n"] for r in heavy.frequent(df, F.col("k"), 50, capacity=128).collect()}
    assert got == {k: n for k, n in Counter(v for v in values if v).items() if n * 50 >= 5620}


def test_weights_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", 5), ("a", None), ("b", -7), ("b", 0), (None, 9), ("c", 5)], "k string, w long")
    got = {r["value"]: r["n"] for r in heavy.frequent(df, F.col("k"), 2, F.col("w"), capacity=8).collect()}
    assert got == {"a": 5, "c": 5}  # ties both stay
    assert heavy.frequent(df.limit(0), F.col("k"), 2, capacity=8).count() == 0


def test_motif(spark):
    df = spark.createDataFrame([(" acgt ",), ("",), ("  ",), (None,)], "k string")
    assert [r[0] for r in df.select(heavy.motif(F.col("k"))).collect()] == ["ACGT", None, None, None]
