"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import heavy, mixture, neardup, residue, tokens, topn
from strandloom.sources.tables import table


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every document."""
    return tokens.encode_column(table(spark, folder, "documents"), ["doc_id"])


def p7_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The digest of every document's text once it is encoded and decoded."""
    back = tokens.decoded_column(table(spark, folder, "documents"), ["doc_id"])
    return back.select("doc_id", F.md5("decoded").alias("md5"))


QUERIES = {
    "p2_found": heavy.found,
    "p2_counts": heavy.counts,
    "p2_bounds": heavy.bounds,
    "p4_found": topn.found,
    "p5_found": neardup.found,
    "p5_links": neardup.links,
    "p7_ids": p7_ids,
    "p7_round_trip": p7_round_trip,
    "p8_copies": mixture.copies,
    "p8_shares": mixture.shares,
    "p8_char_budgets": mixture.char_shares,
    "p9_found": residue.found,
    "p9_coverage": residue.coverage,
    "p9_kept": residue.kept,
}
ORACLES = {
    "p2_found": f"SELECT field, motif_key FROM ({heavy.COUNTS_SQL})",
    "p2_counts": heavy.COUNTS_SQL,
    "p4_found": topn.FOUND_SQL,
    "p7_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS md5 FROM documents",
    "p8_char_budgets": mixture.CHAR_SQL,
}
