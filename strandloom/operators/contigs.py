"""Sequences of contigs: cut into windows, read at places, spliced into models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.sequence import reverse_complement

WINDOW = 1 << 16  # bases of a window


def windows(contigs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Contigs (``contig``, ``seq``) in windows: ``contig``, ``w`` (from 0), ``piece``; one pass over each sequence."""
    cut = F.regexp_extract_all(F.col("seq"), F.lit(f"(?s).{{1,{width}}}"), F.lit(0))
    return contigs.select("contig", F.posexplode(cut).alias("w", "piece"))


def parts_at(ranges: DataFrame, contigs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Add ``w`` and ``part`` to ``ranges`` (``contig``, ``s``, ``e``, 1-based): the bases in every window a range meets.

    A join on contig and window, so no task holds a contig whole and ranges on a hot contig spread
    over its windows.  What lies off the contig has no bases; a range wholly off it gives null.
    """
    low, high = F.greatest(F.col("s") - 1, F.lit(0)), F.greatest(F.col("e") - 1, F.lit(0))
    spread = ranges.withColumn("w", F.explode(F.sequence(F.floor(low / width).cast("int"), F.floor(high / width).cast("int"))))
    both = spread.join(windows(contigs, width), ["contig", "w"], "left")
    first = F.greatest(F.col("s") - 1, F.col("w").cast("long") * width)
    n = F.least(F.col("e"), (F.col("w").cast("long") + 1) * width) - first
    part = F.substring(F.col("piece"), (first - F.col("w").cast("long") * width + 1).cast("int"), F.greatest(n, F.lit(0)).cast("int"))
    return both.withColumn("part", part).drop("piece")


def spliced(exons: DataFrame, contigs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(``tid``, ``contig``, ``strand``, ``seq``) of models given as exons: by start, the other strand's for ``-``.

    A strand that is not ``-`` counts as forward; models without any base on the contig are empty.
    """
    found = parts_at(exons.select("tid", "contig", "strand", "s", "e"), contigs, width)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s", "w", "e", "part"))), lambda x: F.coalesce(x["part"], F.lit(""))), "")
    seq = found.groupBy("tid", "contig", "strand").agg(joined.alias("seq"))  # one model's exons
    return seq.withColumn("seq", F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
