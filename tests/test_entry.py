"""The driver's contract."""

import pytest

import __spark_entry__ as entry
from strandloom.plans import registry


def test_names_agree():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert {"p1_found", "p3_found", "p6_found"} <= set(registry.QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["a8_type_counts", "a14_top_clusters", "w22_blocks", "k4_record_lines", "w8_window_agreement", "r9_orfs"])
def test_core_queries_run_on_smallest_tables(spark, name):
    df = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    df.write.format("noop").mode("overwrite").save()


def test_columns_of_core_queries_differ(spark):
    for name in ("f1_reverse_complement", "f5_codons", "s2_gff_lines", "w7_locus_tags", "x4_completed", "st_tiles", "f25_fusions", "a31_introns_per_gene"):
        columns = registry.QUERIES[name](spark, "/root/testdata/sf0.001").columns
        assert len(set(columns)) == len(columns)


def test_stream_gives_the_batch_result(spark, tmp_path):
    from strandloom.streaming import sessions as s

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = s.tiles(s.event_stream(spark, str(tmp_path / "in"), 10), late="10000 days")
    q = stream.writeStream.format("memory").queryName("tiles_out").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("tiles_out").collect()} == {tuple(r) for r in s.tiles(events).collect()}
