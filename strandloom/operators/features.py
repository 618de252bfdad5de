"""Feature tables: completion, numbering, drop sets, combination of annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.intervals import REGION


def without_coding(genes: DataFrame, mrnas: DataFrame, cds: DataFrame) -> DataFrame:
    """mRNAs without coding parts, and genes without an mRNA that has some: ``label``, ``kind``, ``id``.

    A gene without any mRNA is dropped too.
    """
    coding = cds.select("label", F.col("pid").alias("id")).distinct()
    bare = mrnas.join(coding, ["label", "id"], "left_anti").select("label", F.lit("mRNA").alias("kind"), "id")
    kept = mrnas.join(coding, ["label", "id"], "left_semi").select("label", F.col("pid").alias("id")).where("id is not null").distinct()
    return bare.unionByName(genes.join(kept, ["label", "id"], "left_anti").select("label", F.lit("gene").alias("kind"), "id"))


def locus_tags(genes: DataFrame, prefix: str) -> DataFrame:
    """Add ``tag``, the running number of a gene within its label by place, as ``<prefix>_00001``.

    Numbers come in two levels, within regions and over the counts of regions before, so that no
    task sorts all genes.
    """
    place = genes.withColumn("_region", F.floor(F.col("s") / REGION))
    before = Window.partitionBy("label").orderBy("chrom", "_region").rowsBetween(Window.unboundedPreceding, -1)
    counts = place.groupBy("label", "chrom", "_region").agg(F.count("*").alias("_n")).withColumn("_carry", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy("label", "chrom", "_region").orderBy("s", "e", "id")
    numbered = place.withColumn("_k", F.row_number().over(own)).join(counts, ["label", "chrom", "_region"])
    return numbered.select(*genes.columns, F.format_string(f"{prefix}_%05d", F.col("_k") + F.col("_carry")).alias("tag"))


def child_tags(tagged: DataFrame, children: DataFrame, mark: str) -> DataFrame:
    """Tags of the children of tagged features, numbered by place within their parent and kind."""
    up = tagged.select("label", F.col("id").alias("pid"), F.col("tag").alias("_up"))
    w = Window.partitionBy("label", "pid", "kind").orderBy("s", "e", "id")
    both = children.join(up, ["label", "pid"]).withColumn("_k", F.row_number().over(w).cast("string"))
    tag = F.concat("_up", F.lit(".mRNA."), "_k") if mark == "mRNA" else F.concat("_up", F.lit(":"), "kind", F.lit(":"), "_k")
    return both.withColumn("tag", tag).drop("_up", "_k")


def completed(features: DataFrame) -> DataFrame:
    """Features plus those a label lacks altogether: mRNAs from genes, coding parts from exons, exons from coding parts.

    Which kinds a label has is asked per label.  Derived ids swap the kind in the id, or add it.
    """
    has = features.groupBy("label").agg(*[F.bool_or(F.col("kind") == k).alias(f"has_{k}") for k in ("mRNA", "exon", "CDS")])
    told = features.join(F.broadcast(has), "label")  # one row per annotation

    def swapped(old: str, new: str):
        moved = F.regexp_replace("id", f"(?i){old}", new)
        return F.when(moved == F.col("id"), F.concat("id", F.lit(f":{new}"))).otherwise(moved)

    cols = features.columns
    mrna = told.where("kind = 'gene' and not has_mRNA").withColumns({"pid": F.col("id"), "kind": F.lit("mRNA")}).withColumn("id", F.concat("id", F.lit("_mRNA")))
    cds = told.where("kind = 'exon' and not has_CDS").withColumns({"id": swapped("exon", "CDS"), "kind": F.lit("CDS")})
    exon = told.where("kind = 'CDS' and not has_exon").withColumns({"id": swapped("cds", "exon"), "kind": F.lit("exon")})
    return features.unionByName(mrna.select(*cols)).unionByName(cds.select(*cols)).unionByName(exon.select(*cols))


def combined(features: DataFrame, rank: dict[str, int]) -> DataFrame:
    """Genes of several annotations, each id from the annotation that ranks first."""
    order = F.coalesce(*[F.when(F.col("label") == k, v) for k, v in rank.items()], F.lit(len(rank)))
    w = Window.partitionBy("id").orderBy(order, "label")
    return features.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
