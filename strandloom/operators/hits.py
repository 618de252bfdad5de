"""Search hits: best hit, thresholds, folds over a query's ranked hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_hits(hits: DataFrame, query: str, score: str, order: str) -> DataFrame:
    """The best hit of every query; ties: the first by ``order``."""
    w = Window.partitionBy(query).orderBy(F.col(score).desc_nulls_last(), order)
    return hits.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def forward_only(hits: Column) -> Column:
    """Of ranked hits (``s``, ``e``), those that begin after the end of the last one kept."""
    empty = F.filter(hits, lambda h: F.lit(False))
    return F.aggregate(hits, empty, lambda kept, h: F.when((F.size(kept) == 0) | (h["s"] > F.element_at(kept, -1)["e"]), F.concat(kept, F.array(h))).otherwise(kept))


def apart(hits: Column, share: float = 0.1) -> Column:
    """Of ranked hits, those that overlap each one kept by at most ``share`` of the shorter."""
    empty = F.filter(hits, lambda h: F.lit(False))

    def clash(a: Column, b: Column) -> Column:
        shared = F.greatest(F.lit(0), F.least(a["e"], b["e"]) - F.greatest(a["s"], b["s"]) + 1)
        return shared > share * F.least(a["e"] - a["s"] + 1, b["e"] - b["s"] + 1)

    return F.aggregate(hits, empty, lambda kept, h: F.when(F.exists(kept, lambda k: clash(k, h)), kept).otherwise(F.concat(kept, F.array(h))))


def fusion_cuts(kept: Column) -> Column:
    """Where to cut between neighbouring kept hits: the middle between one's end and the next one's start."""
    by_place = F.array_sort(F.transform(kept, lambda h: F.struct(h["s"].alias("s"), h["e"].alias("e"))))
    nxt = F.slice(by_place, 2, F.greatest(F.size(by_place) - 1, F.lit(0)))
    prev = F.slice(by_place, 1, F.greatest(F.size(by_place) - 1, F.lit(0)))
    return F.zip_with(prev, nxt, lambda a, b: F.floor((a["e"] + b["s"]) / 2))
