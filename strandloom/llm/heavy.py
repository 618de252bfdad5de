"""The most frequent values of a column in bounded memory (problem 2).

First pass: every task keeps a Space-Saving summary of at most ``capacity`` counters; summaries
are merged in a tree.  A counter's count is never too low and at most its error too high, and a
value without a counter has at most the summary's floor.  Second pass: the values whose count may
reach the threshold, at most ``capacity`` of them, are counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.ids import BLANKS
from strandloom.sources.tables import table

CAPACITY = 4096  # counters of a summary
FAN_IN = 64  # summaries merged by one task of the tree

SUMMARY = "value string, count long, error long, floor long"


class Summary:
    """Space-Saving counters: ``table`` has value -> (count, error), ``floor`` bounds the rest."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.table = pd.DataFrame({"count": np.zeros(0, np.int64), "error": np.zeros(0, np.int64)})
        self.floor = 0

    def add(self, other: pd.DataFrame, floor: int = 0) -> None:
        """Merge ``other`` (value -> count, error); values it lacks may have up to ``floor`` there."""
        both = self.table.join(other, how="outer", rsuffix="_2")
        mine, yours = both["count"].isna().to_numpy(), both["count_2"].isna().to_numpy()
        both = both.fillna(0).astype(np.int64)
        extra = np.where(mine, self.floor, 0) + np.where(yours, floor, 0)
        merged = pd.DataFrame({"count": both["count"] + both["count_2"] + extra, "error": both["error"] + both["error_2"] + extra})
        self.floor += floor
        if len(merged) > self.capacity:
            merged = merged.nlargest(self.capacity + 1, "count", keep="first")
            self.floor = max(self.floor, int(merged["count"].iloc[-1]))
            merged = merged.iloc[: self.capacity]
        self.table = merged

    def frame(self) -> pd.DataFrame:
        out = self.table.rename_axis("value").reset_index()
        return out.assign(floor=self.floor)


def _summarise(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Summary(capacity)
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by("value").aggregate([("weight", "sum")])
            one = pd.DataFrame({"count": sums.column("weight_sum").to_numpy(), "error": 0}, index=pd.Index(sums.column("value").to_pandas(), name="value"))
            s.add(one)
        out = s.frame()
        if len(out):
            yield pa.RecordBatch.from_pandas(out[["value", "count", "error", "floor"]], preserve_index=False)

    return run


def _merge(capacity: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        s = Summary(capacity)
        for _, part in rows.groupby("part"):
            s.add(part.set_index("value")[["count", "error"]], int(part["floor"].iloc[0]))
        return s.frame().assign(part=key[0])

    return run


def summary(df: DataFrame, value: Column, weight: Column | None = None, capacity: int = CAPACITY, fan_in: int = FAN_IN) -> DataFrame:
    """The merged summary of ``value`` over ``df``: value, count (upper bound), error, floor.

    Null values and weights that are null or not positive add nothing.  An empty table gives no
    rows.  A tree of three levels merges the summaries of the tasks: a node takes ``fan_in`` of
    them for up to ``fan_in ** 3`` tasks.
    """
    rows = df.select(value.alias("value"), F.coalesce(weight if weight is not None else F.lit(1), F.lit(0)).cast("long").alias("weight"))
    parts = rows.where("value is not null and weight > 0").mapInArrow(_summarise(capacity), SUMMARY).withColumn("part", F.spark_partition_id())
    for width in (fan_in * fan_in, fan_in, 1):
        nodes = parts.withColumn("node", F.pmod(F.col("part"), F.lit(width)))
        parts = nodes.groupBy("node").applyInPandas(_merge(capacity), f"{SUMMARY}, part int")
    return parts.drop("part")


def frequent(df: DataFrame, value: Column, one_in: int, weight: Column | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Values that hold at least one ``one_in``-th of the total weight, with exact ``n`` and the bounds.

    ``capacity`` has to be well above ``one_in``: then every such value has a counter.
    """
    if capacity < 2 * one_in:
        raise ValueError("capacity must be at least twice one_in")
    counted = F.coalesce(weight if weight is not None else F.lit(1), F.lit(0)).cast("long")
    rows = df.select(value.alias("value"), counted.alias("weight")).where("value is not null and weight > 0")
    total = rows.agg(F.sum("weight").alias("total"))
    # at most capacity rows, so this broadcast is bounded whatever the data
    near = summary(df, value, weight, capacity).crossJoin(F.broadcast(total)).where(F.col("count") * one_in >= F.col("total"))
    near = near.select("value", "total", F.col("count").alias("at_most"), (F.col("count") - F.col("error")).alias("at_least"))
    exact = rows.join(F.broadcast(near.select("value")), "value", "left_semi").groupBy("value").agg(F.sum("weight").alias("n"))
    return exact.join(F.broadcast(near), "value").where(F.col("n") * one_in >= F.col("total"))


def motif(c: Column) -> Column:
    """A key for counting: upper-cased, cut of blanks; empty becomes null."""
    return F.nullif(F.btrim(F.upper(c), F.lit(BLANKS)), F.lit(""))


def found(spark: SparkSession, folder: str) -> DataFrame:
    """p2_found: the keys that make up a notable share of either field."""
    return counts(spark, folder).select("field", "motif_key")


def counts(spark: SparkSession, folder: str) -> DataFrame:
    """p2_counts: those keys with their exact counts."""
    loci = table(spark, folder, "locus_rows").select(motif(F.col("motif_key")).alias("k"))
    entries = table(spark, folder, "softclip_stats").select(F.inline("top_clusters")).select(motif(F.col("motif_key")).alias("k"), "n_reads")
    a = frequent(loci, F.col("k"), 200).withColumn("field", F.lit("motif_key"))
    b = frequent(entries, F.col("k"), 100, F.col("n_reads")).withColumn("field", F.lit("top_clusters"))
    return a.unionByName(b).select("field", F.col("value").alias("motif_key"), "n")


def bounds(spark: SparkSession, folder: str) -> DataFrame:
    """p2_bounds: of the keys of locus rows, the exact count between the bounds that the summaries alone give."""
    loci = table(spark, folder, "locus_rows").select(motif(F.col("motif_key")).alias("k"))
    f = frequent(loci, F.col("k"), 200)
    return f.select(F.col("value").alias("motif_key"), "at_least", "n", "at_most")


COUNTS_SQL = """
WITH a AS (SELECT nullif(trim(upper(motif_key), E' \\t\\r\\n'), '') AS k FROM locus_rows),
e AS (SELECT unnest(top_clusters) AS u FROM softclip_stats),
b AS (SELECT nullif(trim(upper(u.motif_key), E' \\t\\r\\n'), '') AS k, u.n_reads AS w FROM e WHERE u.n_reads > 0)
SELECT 'motif_key' AS field, k AS motif_key, count(*) AS n FROM a WHERE k IS NOT NULL GROUP BY k
HAVING count(*) * 200 >= (SELECT count(k) FROM a)
UNION ALL
SELECT 'top_clusters', k, CAST(sum(w) AS BIGINT) FROM b WHERE k IS NOT NULL GROUP BY k
HAVING sum(w) * 100 >= (SELECT sum(w) FROM b WHERE k IS NOT NULL)
"""
