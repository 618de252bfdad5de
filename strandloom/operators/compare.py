"""Comparison of predicted annotations with a reference annotation.

All predictions are compared in one job: every frame of predictions has a ``label``, and the
reference is matched with each label on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.intervals import best_overlap, overlap_join
from strandloom.session import cut

#: Share of a reference that a merging prediction covers, and of its own length
#: that a fragment lies inside one reference.
MERGE, FRAGMENT = 0.5, 0.5
CLASSES = ["exact", "inexact", "missing", "merged", "fragmented", "novel"]


def _length(p: str) -> Column:
    return F.col(f"{p}e") - F.col(f"{p}s") + 1


def ratios(bp: Column, ref_len: Column, pred_len: Column) -> dict[str, Column]:
    """Sensitivity, specificity and F1 of an overlap, 0 where undefined."""
    sn, sp = F.coalesce(F.try_divide(bp, ref_len), F.lit(0.0)), F.coalesce(F.try_divide(bp, pred_len), F.lit(0.0))
    return {"sn": sn, "sp": sp, "f1": F.coalesce(F.try_divide(2 * sn * sp, sn + sp), F.lit(0.0))}


def classify(ref: DataFrame, pred: DataFrame) -> DataFrame:
    """One row per label and reference gene, and one per novel prediction.

    ``ref`` and ``pred`` have one row per ``id`` (and ``label`` in ``pred``) with ``chrom``,
    ``strand``, ``s``, ``e``.  *merged*: a prediction covers more than half of this and another
    reference.  Else *fragmented*: two or more predictions lie by half or more inside it.
    Predictions used that way are out; of the rest the one with most shared bases makes it
    *exact* or *inexact*, or it is *missing*.  A prediction that is not used and overlaps no
    reference is *novel*.
    """
    labels = pred.select("label").distinct()
    pairs = cut(overlap_join(ref, pred).select("b_label", "a_id", "a_s", "a_e", "b_id", "b_s", "b_e", "bp"))

    covering = pairs.where(F.col("bp") > MERGE * _length("a_"))
    many = Window.partitionBy("b_label", "b_id")
    merging = covering.withColumn("n", F.count("*").over(many)).where("n >= 2")
    merged = merging.select("b_label", "a_id").distinct().withColumn("merged", F.lit(True))

    inside = pairs.join(merged, ["b_label", "a_id"], "left_anti").where(F.col("bp") >= FRAGMENT * _length("b_"))
    pieces = Window.partitionBy("b_label", "a_id")
    breaking = inside.withColumn("n", F.count("*").over(pieces)).where("n >= 2")
    broken = breaking.select("b_label", "a_id").distinct().withColumn("broken", F.lit(True))
    out = merging.select("b_label", "b_id").unionByName(breaking.select("b_label", "b_id")).distinct()

    best = best_overlap(pairs.join(out, ["b_label", "b_id"], "left_anti"), ("b_label", "a_id"))
    best = best.select("b_label", "a_id", "b_id", "b_s", "b_e", "bp")
    every = ref.select(F.col("id").alias("a_id"), "chrom", "strand", F.col("s").alias("a_s"), F.col("e").alias("a_e")).crossJoin(F.broadcast(labels.withColumnRenamed("label", "b_label")))
    told = every.join(merged, ["b_label", "a_id"], "left").join(broken, ["b_label", "a_id"], "left").join(best, ["b_label", "a_id"], "left")
    same = (F.col("a_s") == F.col("b_s")) & (F.col("a_e") == F.col("b_e"))
    told = told.withColumn("classification", F.when(F.col("merged"), "merged").when(F.col("broken"), "fragmented").when(F.col("b_id").isNull(), "missing").when(same, "exact").otherwise("inexact"))
    matched = F.col("classification").isin("exact", "inexact")
    forward = F.col("strand") == "+"
    inexact = F.col("classification") == "inexact"
    kept = {c: F.when(matched, F.col(c)) for c in ("b_id", "b_s", "b_e", "bp")}
    rows = told.select(
        F.col("b_label").alias("label"), "classification", F.col("a_id").alias("ref_id"), kept["b_id"].alias("pred_id"), "chrom", "strand",
        F.col("a_s").alias("ref_start"), F.col("a_e").alias("ref_end"), kept["b_s"].alias("pred_start"), kept["b_e"].alias("pred_end"), kept["bp"].alias("overlap_bp"),
        *[F.when(matched, v).alias(k) for k, v in ratios(F.col("bp"), _length("a_"), _length("b_")).items()],
        F.when(inexact, F.when(forward, F.col("b_s") - F.col("a_s")).otherwise(F.col("a_e") - F.col("b_e"))).alias("boundary_5p"),
        F.when(inexact, F.when(forward, F.col("b_e") - F.col("a_e")).otherwise(F.col("a_s") - F.col("b_s"))).alias("boundary_3p"),
    )
    touching = pairs.select(F.col("b_label").alias("label"), F.col("b_id").alias("id")).distinct()
    novel = pred.join(touching, ["label", "id"], "left_anti").select(
        "label", F.lit("novel").alias("classification"), F.col("id").alias("pred_id"), "chrom", "strand", F.col("s").alias("pred_start"), F.col("e").alias("pred_end")
    )
    return rows.unionByName(novel, allowMissingColumns=True)


def gene_stats(records: DataFrame) -> DataFrame:
    """Counts per class, sensitivity, precision and F1 of each label, and mean ratios of matches.

    Matches are true positives; missing, fragmented and merged references are false negatives;
    only novel predictions are false positives.  A ratio without a denominator is 0.
    """
    n = {c: F.count_if(F.col("classification") == c) for c in CLASSES}
    tp, fn, fp = n["exact"] + n["inexact"], n["missing"] + n["fragmented"] + n["merged"], n["novel"]
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    matched = F.col("classification").isin("exact", "inexact")
    return records.groupBy("label").agg(
        *[v.alias(f"n_{c}") for c, v in n.items()],
        safe(tp, tp + fn).alias("sensitivity"),
        safe(tp, tp + fp).alias("precision"),
        safe(2 * tp, 2 * tp + fn + fp).alias("f1_score"),
        F.count_if(matched & (F.col("f1") >= 0.99)).alias("n_perfect"),
        *[F.coalesce(F.avg(F.when(matched, F.col(c))), F.lit(0.0)).alias(f"mean_{c}") for c in ("sn", "sp", "f1")],
    )


def boundary_stats(records: DataFrame) -> DataFrame:
    """Median and mean absolute boundary difference of the inexact matches of each label."""
    d = records.where("classification = 'inexact'")
    cols = [f(F.abs(c)).alias(f"{n}_{c}") for c in ("boundary_5p", "boundary_3p") for n, f in (("median", F.median), ("mean", F.avg))]
    return d.groupBy("label").agg(*cols)


def agreement(records: DataFrame, classes: DataFrame) -> DataFrame:
    """For every class, how many references each set of labels agrees on: ``class``, ``labels``, ``n``.

    exact and inexact both mean ``match``; the empty set counts references no label puts there.
    ``classes`` has one row per ``class``; it is crossed with the references, not with pairs.
    """
    told = records.where("ref_id is not null").select("ref_id", "label", F.when(F.col("classification").isin("exact", "inexact"), "match").otherwise(F.col("classification")).alias("found"))
    by_ref = told.groupBy("ref_id").agg(F.collect_list(F.struct("label", "found")).alias("told"))  # one entry per label
    subset = F.array_join(F.array_sort(F.transform(F.filter("told", lambda x: x["found"] == F.col("class")), lambda x: x["label"])), ",")
    return by_ref.crossJoin(F.broadcast(classes)).withColumn("labels", subset).groupBy("class", "labels").agg(F.count("*").alias("n"))


def condensed(agreed: DataFrame, labels: Sequence[str], most: int = 6) -> DataFrame:
    """Of :func:`agreement`: all sets for up to ``most`` labels; for more, the full set, the empty one, those of one label, and ``other`` for the rest.
    ``size`` is that of the largest set in a row: sets sort by size falling, then by name.
    """
    size = F.when(F.col("labels") == "", 0).otherwise(F.size(F.split("labels", ",")))
    few = len(labels) <= most
    name = F.col("labels") if few else F.when((size <= 1) | (size == len(labels)), F.col("labels")).otherwise("other")
    return agreed.withColumns({"size": size, "labels": name}).groupBy("class", "labels").agg(F.sum("n").alias("n"), F.max("size").cast("long").alias("size"))


def introns(parts: DataFrame) -> DataFrame:
    """Introns between the neighbouring parts of a parent, numbered from 1; parents are ``pid``."""
    w = Window.partitionBy("label", "pid").orderBy("s", "e", "id")
    nxt = parts.withColumn("nx", F.lead("s").over(w)).withColumn("k", F.row_number().over(w)).where("nx is not null")
    return nxt.select("label", "pid", F.concat("pid", F.lit(":intron:"), F.col("k").cast("string")).alias("id"), "chrom", "strand", (F.col("e") + 1).alias("s"), (F.col("nx") - 1).alias("e"))
