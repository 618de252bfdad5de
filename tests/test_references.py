"""Orphan references: null masks, match rules, kinds, empty tables."""

from datetime import datetime as T

import pytest
from pyspark.sql import functions as F

from strandloom.functions.ids import feature_id, month
from strandloom.operators.references import mark_references, orphans

from conftest import rows

REFS = "k long, a string, b string, own timestamp_ntz, found_ string"
TARGETS = "a string, b string, at timestamp_ntz, listed boolean, extra int"


def refs(spark):
    day = lambda d: T(2024, 1, d)
    return spark.createDataFrame(
        [(1, "x", "1", day(5), ""), (2, "x", "2", day(5), ""), (3, "x", "9", day(5), ""), (4, None, "1", day(5), ""), (5, None, "9", None, ""), (6, None, None, day(5), ""), (7, "x", None, day(5), ""), (8, "x", "3", day(5), ""), (8, "x", "3", day(5), "")], REFS
    )


def targets(spark):
    day = lambda d: T(2024, 1, d)
    return spark.createDataFrame([("x", "1", day(1), False, 1), ("x", "1", day(9), False, 1), ("x", "2", day(9), False, None), ("x", "3", None, True, 1), ("x", "3", day(1), False, 1), (None, None, None, None, None)], TARGETS)


@pytest.mark.parametrize(
    ("match", "want"),
    [
        ("partial", {2: "late", 3: "missing", 5: "missing", 7: "dropped", 8: "dropped"}),
        ("simple", {2: "late", 3: "missing", 8: "dropped"}),
        ("full", {2: "late", 3: "missing", 4: "missing", 5: "missing", 7: "missing", 8: "dropped"}),
    ],
)
def test_kinds_by_match_rule(spark, match, want):
    got = orphans(refs(spark), targets(spark), ["a", "b"], "own", "at", F.col("listed"), match)
    assert {r["k"]: r["kind"] for r in got.collect()} == want
    assert got.where("k = 8").count() == 2  # repeated references stay
    assert "found_" in got.columns


def test_null_mask_without_any_column_is_no_reference(spark):
    marked = mark_references(refs(spark), targets(spark), ["a", "b"], {"n": F.count("*")})
    assert {r["k"]: r["found"] for r in marked.collect()}[6] is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], TARGETS)
    assert orphans(refs(spark).where("k < 4"), none, ["a", "b"], "own", "at").where("kind = 'missing'").count() == 3
    assert orphans(spark.createDataFrame([], REFS), targets(spark), ["a", "b"], "own", "at").count() == 0


def test_id_rule_and_month(spark):
    df = spark.createDataFrame([(" a%3Ab ",), ("a+b",), ("50%",), (".",), ("",), (None,), ("%20.%20",), ("x%zz",)], "x string")
    assert [r[0] for r in df.select(feature_id(F.col("x"))).collect()] == ["a:b", "a+b", "50%", None, None, None, None, "x%zz"]
    assert [r[0] for r in spark.sql("select timestamp_ntz'2024-03-09 01:00:00' t union all select null").select(month(F.col("t"))).collect()] == ["2024-03", "unknown"]


def test_found_over_tables(spark, tmp_path):
    from strandloom.plans import problem1

    d = "/root/testdata/sf0.001"
    got = problem1.found(spark, d)
    assert got.columns == ["ref_table", "ref_field", "row_key", "period", "kind"]
    assert {r["kind"] for r in got.collect()} <= {"dropped", "missing", "late", "unlisted"}
    for name in ("intervals", "feature_records", "cleanup_drops", "cleanup_reports"):
        spark.read.parquet(f"{d}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert problem1.found(spark, str(tmp_path)).count() == 0
