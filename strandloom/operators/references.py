"""Orphan references: records that point at keys which were never delivered, dropped or came late.

A reference is a composite key whose columns may be partly null.  References are grouped by their
null mask; the references of one mask are matched on that mask's non-null columns only, under a
declared match rule:

``simple``   a reference with any null column is no reference and is never reported;
``full``     all columns null is no reference; a mix of null and non-null is always an orphan;
``partial``  the non-null columns have to match some target row.

Repeated target rows count once (targets are aggregated per key before the join, combined on the
map side), so a hot key on the reference side meets exactly one target row and adaptive skew
handling may split it at will.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHES = ("simple", "full", "partial")


def _mask(keys: Sequence[str]) -> Column:
    return F.concat(*[F.when(F.col(k).isNull(), "0").otherwise("1") for k in keys])


def mark_references(
    refs: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    facts: dict[str, Column],
    match: str = "partial",
) -> DataFrame:
    """Add ``found`` (boolean, null where the row is no reference) and the ``facts`` to ``refs``.

    ``refs`` and ``targets`` both hold ``keys``; ``facts`` are aggregates over the target rows of
    a key (name -> aggregate column), null where nothing is found.  Which masks occur is asked
    first (at most ``2 ** len(keys)`` values), and each occurring mask gets one join.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    masked = refs.withColumn("_mask", _mask(keys))
    masks = sorted(r[0] for r in masked.select("_mask").distinct().collect())
    out = None
    for mask in masks:
        rows = masked.where(F.col("_mask") == mask).drop("_mask")
        present = [k for k, bit in zip(keys, mask, strict=True) if bit == "1"]
        nothing = [F.lit(None).cast(t).alias(n) for n, t in _types(targets, keys, facts)]
        if not present or (match == "simple" and len(present) < len(keys)):
            part = rows.select("*", F.lit(None).cast("boolean").alias("found"), *nothing)
        elif match == "full" and len(present) < len(keys):
            part = rows.select("*", F.lit(False).alias("found"), *nothing)
        else:
            known = targets.dropna(subset=present).groupBy(*present).agg(*[a.alias(n) for n, a in facts.items()]).withColumn("_hit", F.lit(True))
            part = rows.join(known, list(present), "left").withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")
        part = part.select(*refs.columns, "found", *facts)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = masked.drop("_mask").select("*", F.lit(None).cast("boolean").alias("found"), *[F.lit(None).cast(t).alias(n) for n, t in _types(targets, keys, facts)])
    return out


def _types(targets: DataFrame, keys: Sequence[str], facts: dict[str, Column]) -> list[tuple[str, str]]:
    return [(n, t) for n, t in targets.groupBy(*keys).agg(*[a.alias(n) for n, a in facts.items()]).dtypes if n in facts]


def orphans(
    refs: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    own_time: str,
    target_time: str,
    listed: Column | None = None,
    match: str = "partial",
) -> DataFrame:
    """The references of ``refs`` that lead nowhere, with their ``kind``.

    ``dropped`` if any target row of the key satisfies ``listed``; else ``missing`` if there is no
    target row besides listed ones; else ``late`` if the earliest non-null ``target_time`` lies
    after the row's ``own_time`` (never when either is null).
    """
    is_listed = F.coalesce(listed, F.lit(False)) if listed is not None else F.lit(False)
    facts = {
        "_listed": F.max(is_listed),
        "_delivered": F.max(~is_listed),
        "_earliest": F.min(F.when(~is_listed, F.col(target_time))),
    }
    marked = mark_references(refs, targets, keys, facts, match)
    kind = (
        F.when(F.coalesce("_listed", F.lit(False)), "dropped")
        .when(~F.coalesce("_delivered", F.lit(False)), "missing")
        .when(F.col("_earliest") > F.col(own_time), "late")
    )
    return marked.where(F.col("found").isNotNull()).withColumn("kind", kind).where(F.col("kind").isNotNull()).select(*refs.columns, "kind")
