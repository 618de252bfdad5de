"""Mixtures: budgets, the dual, caps, rounding, odd inputs."""

import math

import pytest

from strandloom.llm import mixture as m


def test_budgets_fill_up():
    got = m.budgets({"a": 100, "b": 10, "c": 50}, {"a": (1.0, 1), "b": (1.0, 2), "c": (2.0, 1), "d": (5.0, 3), "e": (None, 1)}, 120)
    assert got == {"a": 50.0, "b": 20.0, "c": 50.0, "d": 0.0, "e": 0.0}
    assert sum(m.budgets({"a": 100, "b": 900}, {"a": (1.0, 5), "b": (1.0, 1)}).values()) == 1000


def docs(spark):
    words = lambda k: " ".join(["word"] * k)
    rows = [(i, words(1 + i % 40), "big") for i in range(400)] + [(1000 + i, words(5), "small") for i in range(12)] + [(2000, None, "big"), (2001, "", "small"), (2002, words(9), None), (2003, words(9), "other")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_shares_and_caps(spark):
    targets = spark.createDataFrame([("big", 3.0, 1), ("small", 1.0, 4), ("absent", 1.0, 2)], "source string, weight double, max_repeats int")
    copies, shares = m.mixture(docs(spark), targets, total=1000)
    by = {r["source"]: r for r in shares.collect()}
    assert by["small"]["tokens"] == 12 * 5 * 4 == by["small"]["budget"]
    assert abs(by["big"]["tokens"] - 760) <= 2 and by["absent"]["tokens"] == 0
    assert math.isclose(sum(r["actual_share"] for r in by.values()), 1)
    got = copies.collect()
    assert {r["source"] for r in got} == {"big", "small"} and len(got) == 414
    assert all(0 <= r["copies"] <= {"big": 1, "small": 4}[r["source"]] for r in got)
    for s in ("big", "small"):
        assert sum(r["copies"] * r["n_tokens"] for r in got if r["source"] == s) == by[s]["tokens"]
        assert sum(r["copies"] for r in got if r["source"] == s) == by[s]["n_copies"]


def sized(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


def test_one_record_of_a_third_of_its_source(spark):
    rows = [(0, "a", 5000), *((i, "a", 10) for i in range(1, 1001)), *((2000 + i, "b", 40) for i in range(100))]
    targets = spark.createDataFrame([("a", 1.0, 3), ("b", 1.0, 3)], "source string, weight double, max_repeats int")
    for total in (3000, 8000, 14000, 17000):
        copies, shares = m.balanced(sized(spark, rows), targets, total)
        for r in shares.collect():
            assert abs(r["tokens"] - r["budget"]) <= 20 and r["met"], (total, r)
        assert max(r["copies"] for r in copies.collect()) <= 3


def test_large_classes_are_dealt_evenly_over_groups(spark):
    rows = [(i, "a", 7) for i in range(20000)] + [(5, "a", 7)] * 3  # records under one id are records
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, weight double, max_repeats int")
    copies, shares = m.balanced(sized(spark, rows), targets, 7 * 26000)
    n = [r["copies"] for r in copies.collect()]
    assert len(n) == 20003 and sum(n) == 26000 and set(n) == {1, 2}


def test_sources_of_empty_texts_and_unknown_sizes(spark):
    rows = [(i, "a", 0) for i in range(9000)] + [(9001, "b", 5), (9002, None, 5), (9003, "c", 5)]
    targets = spark.createDataFrame([("a", 1.0, 2), ("b", 1.0, 0)], "source string, weight double, max_repeats int")
    copies, shares = m.balanced(sized(spark, rows), targets)
    got = copies.groupBy("source", "copies").count().collect()
    assert {tuple(r) for r in got} == {("a", 1, 9000), ("b", 0, 1)}
    assert {r["source"]: (r["tokens"], r["n_records"]) for r in shares.collect()} == {"a": (0, 9000), "b": (0, 1)}


def test_budgets_of_the_test_tables_are_met(spark):
    folder = "/root/testdata/sf0.01"
    copies, shares = m.copies(spark, folder), m.shares(spark, folder)
    rows = shares.collect()
    assert len(rows) == 10 and all(r["met"] for r in rows)
    used = {r["source"]: r["t"] for r in copies.selectExpr("source", "n_tokens * copies as t").groupBy("source").agg({"t": "sum"}).withColumnRenamed("sum(t)", "t").collect()}
    assert used == {r["source"]: r["tokens"] for r in rows if r["n_records"]}


def test_rates_are_exponential_in_size(spark):
    targets = spark.createDataFrame([("big", 1.0, 1)], "source string, weight double, max_repeats int")
    copies, _ = m.mixture(docs(spark), targets, total=3000)
    logs = {r["n_tokens"]: math.log(r["rate"]) / r["n_tokens"] for r in copies.where("n_tokens > 0").collect()}
    assert max(logs.values()) - min(logs.values()) < 1e-9


def test_empty(spark):
    targets = spark.createDataFrame([("big", 1.0, 1)], "source string, weight double, max_repeats int")
    copies, shares = m.mixture(docs(spark).limit(0), targets)
    assert copies.count() == 0 and [r["tokens"] for r in shares.collect()] == [0]
    copies, shares = m.mixture(docs(spark), targets.limit(0))
    assert copies.count() == 0 and shares.count() == 0
