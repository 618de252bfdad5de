"""Structural agreement of gene models and one-to-one matching of their parts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.intervals import overlap_join
from strandloom.session import cut

#: Tolerated share of the longer span, and tolerated bases at a boundary.
SPAN_SHARE, BOUNDARY = 0.05, 3


def concordant(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of overlapping models with similar spans and the same inner boundaries.

    Models have ``chrom``, ``strand``, ``s``, ``e`` and ``cds``, their coding parts by start.  The
    outer ends of the first and last part are free; a single part always agrees.
    """
    pairs = overlap_join(a, b).where(F.size("a_cds") == F.size("b_cds"))
    tolerated = SPAN_SHARE * F.greatest(F.col("a_e") - F.col("a_s"), F.col("b_e") - F.col("b_s"), F.lit(1))
    near = (F.abs(F.col("a_s") - F.col("b_s")) <= tolerated) & (F.abs(F.col("a_e") - F.col("b_e")) <= tolerated)

    def apart(i):
        x, y = F.element_at("a_cds", i), F.element_at("b_cds", i)
        return ((i > 1) & (F.abs(x["s"] - y["s"]) > BOUNDARY)) | ((i < F.size("a_cds")) & (F.abs(x["e"] - y["e"]) > BOUNDARY))

    wrong = (F.size("a_cds") > 1) & F.exists(F.sequence(F.lit(1), F.size("a_cds")), apart)
    return pairs.where(near & ~wrong)


def assign(bp: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one pairs of rows and columns with the greatest sum of shared bases, none with 0.

    Exact for every size: rows enter one by one, each along the cheapest path of exchanges, with
    prices on rows and columns (the Hungarian method, cubic in the smaller side).  Of several best
    assignments the one met first by falling price and rising index is kept.
    """
    n, m = bp.shape
    if min(n, m) == 0:
        return []
    if n > m:
        return sorted((i, j) for j, i in assign(bp.T))
    cost = np.zeros((n + 1, m + 1))
    cost[1:, 1:] = bp.max() - bp
    row_price, col_price = np.zeros(n + 1), np.zeros(m + 1)
    owner, via = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    for i in range(1, n + 1):
        owner[0], j = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while owner[j]:
            used[j] = True
            k = owner[j]
            reduced = cost[k] - row_price[k] - col_price
            better = ~used & (reduced < least)
            better[0] = False
            least[better], via[better] = reduced[better], j
            free = np.where(used, np.inf, least)
            free[0] = np.inf
            nxt = int(free.argmin())
            step = free[nxt]
            row_price[owner[used]] += step
            col_price[used] -= step
            least[~used] -= step
            j = nxt
        while j:
            owner[j] = owner[via[j]]
            j = via[j]
    return sorted((int(owner[j]) - 1, j - 1) for j in range(1, m + 1) if owner[j] and bp[owner[j] - 1, j - 1] > 0)


def assign_greedily(bp: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one pairs taken by falling overlap, ties by index: a named choice for those who want it, not the best sum."""
    i, j = np.nonzero(bp > 0)
    rows, cols, out = set(), set(), []
    for k in np.lexsort((j, i, -bp[i, j])):
        if i[k] not in rows and j[k] not in cols:
            rows.add(i[k])
            cols.add(j[k])
            out.append((int(i[k]), int(j[k])))
    return sorted(out)


def _match_group(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    a, b = a.sort_values(["s", "e", "id"]).reset_index(drop=True), b.sort_values(["s", "e", "id"]).reset_index(drop=True)
    shared = np.minimum.outer(a.e.to_numpy(), b.e.to_numpy()) - np.maximum.outer(a.s.to_numpy(), b.s.to_numpy()) + 1
    same = (a.chrom.to_numpy()[:, None] == b.chrom.to_numpy()[None, :]) & (a.strand.to_numpy()[:, None] == b.strand.to_numpy()[None, :])
    bp = np.where(same, np.maximum(shared, 0), 0) if len(a) and len(b) else np.zeros((len(a), len(b)), np.int64)
    pairs = assign(bp)
    left, right = {i for i, _ in pairs}, {j for _, j in pairs}
    out = [(key[0], "match", a.id[i], b.id[j], int(bp[i, j])) for i, j in pairs]
    out += [(key[0], "missing", a.id[i], None, None) for i in range(len(a)) if i not in left]
    out += [(key[0], "fp", None, b.id[j], None) for j in range(len(b)) if j not in right]
    return pd.DataFrame(out, columns=["label", "classification", "ref_id", "pred_id", "overlap_bp"]).astype({"overlap_bp": "Int64"})


def subfeatures(parents: DataFrame, ref: DataFrame, pred: DataFrame) -> DataFrame:
    """Match the parts of matched parents one to one; ``parents`` has ``label``, ``a``, ``b``.

    ``ref`` and ``pred`` have ``pid``, ``id``, ``chrom``, ``strand``, ``s``, ``e`` (and ``label`` in
    ``pred``).  Rows: *match* pairs, *missing* reference parts, *fp* predicted parts.  Groups are
    the parts of one pair of genes.
    """
    cols = ["id", "chrom", "strand", "s", "e"]
    left = parents.join(ref.select(F.col("pid").alias("a"), *cols), "a").select("label", "a", "b", *cols)
    right = parents.join(pred.select("label", F.col("pid").alias("b"), *cols), ["label", "b"]).select("label", "a", "b", *cols)
    keys = ("label", "a", "b")
    left, right = (side.select(*[F.col(c).alias(c) for c in side.columns]) for side in (left, right))  # sides of their own
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_match_group, "label string, classification string, ref_id string, pred_id string, overlap_bp long")


def levels(genes: DataFrame, ref: dict[str, DataFrame], pred: dict[str, DataFrame]) -> DataFrame:
    """:func:`subfeatures` level by level, with ``level``: mRNAs within matched genes, coding parts and introns within matched mRNAs.

    ``genes`` holds the matched genes (``label``, ``a``, ``b``); ``ref`` and ``pred`` hold the frames of
    ``mrna``, ``cds`` and ``intron``.
    """
    mrna = cut(subfeatures(genes, ref["mrna"], pred["mrna"]))
    matched = mrna.where("classification = 'match'").select("label", F.col("ref_id").alias("a"), F.col("pred_id").alias("b"))
    below = [subfeatures(matched, ref[k], pred[k]).withColumn("level", F.lit(k)) for k in ("cds", "intron")]
    return mrna.withColumn("level", F.lit("mrna")).unionByName(below[0]).unionByName(below[1])


def level_stats(records: DataFrame) -> DataFrame:
    """Of :func:`levels`, by level and label: matches, misses, false hits, sensitivity, precision and F1, 0 where undefined."""
    n = {c: F.count_if(F.col("classification") == c) for c in ("match", "missing", "fp")}
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return records.groupBy("level", "label").agg(
        *[v.alias(f"n_{k}") for k, v in n.items()],
        safe(n["match"], n["match"] + n["missing"]).alias("sensitivity"), safe(n["match"], n["match"] + n["fp"]).alias("precision"), safe(2 * n["match"], 2 * n["match"] + n["missing"] + n["fp"]).alias("f1_score"),
    )
