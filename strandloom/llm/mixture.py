"""Mixing sources to target weights (problem 8).

Sizes are tokens of a public tokenizer.  Each source is to make up its share of the total, with
no record used more often than the source's ``max_repeats``.  What a source can give at most,
its tokens times its repeats, bounds its budget; what it cannot give goes to the others by their
weights, so that the total stays the chosen one as long as they have room.

The rates at which records are used come from entropy balancing: of all rates within the caps
that meet the token budgets, those closest to using every record once.  Their dual has one
multiplier per source, ``rate = min(max_repeats, exp(multiplier * tokens / scale))``, and is
convex; Newton steps solve it, each an aggregation over all record sizes that tries several
multipliers of every source at once, so that few are needed and the bracket always closes.

Rates are rounded to copies by size: all records of a source with equal size have the same rate,
so a size class has a number of copies, its records times their rate.  From the largest size down
it is rounded to whole copies and what is over or owed passes on to the next smaller size, as far
as caps allow, so that a source ends within half its smallest record of its budget wherever the
smaller records have room for that, also when one record is a third of its source.  Copies of a
class are dealt evenly over its records, by a rank in two levels.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.llm.tokens import RANKS, count_column
from strandloom.session import stage
from strandloom.sources.tables import table

TRIED, CLOSE = 16, 1e-9  # multipliers tried in one pass; relative gap that counts as none
RANKED = 4096  # records ranked together, about


def budgets(tokens: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """Token budget of every source in ``targets`` (weight, max_repeats), capped by what it has.

    ``total`` defaults to all tokens of these sources, each used once.  Weights that are null or
    not positive count as 0.
    """
    room = {s: tokens.get(s, 0) * max(r or 0, 0) for s, (_, r) in targets.items()}
    weight = {s: max(w or 0.0, 0.0) for s, (w, _) in targets.items()}
    left = float(total if total is not None else sum(tokens.get(s, 0) for s in targets))
    out = dict.fromkeys(targets, 0.0)
    free = {s for s in targets if weight[s] > 0 and room[s] > 0}
    while free:
        share = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * share >= room[s]}
        if not full:
            out.update({s: weight[s] * share for s in free})
            break
        for s in full:
            out[s] = float(room[s])
            left -= room[s]
        free -= full
    return out


def multipliers(sizes: DataFrame, have: dict[str, tuple[int, float]], wanted: dict[str, float], caps: dict[str, int]) -> dict[str, float]:
    """The dual's multiplier of each source, by Newton steps within a bracket over ``sizes``.

    ``sizes`` has ``source``, ``n_tokens`` and ``n`` (records of that size), ``have`` each source's
    tokens and mean size.  A pass is one aggregation with ``TRIED`` rows a source: the Newton point
    and points that part the bracket evenly.  It ends for a source when its gap is ``CLOSE`` or
    no number lies within its bracket.  Sources whose budget is all they have get infinity,
    those with none minus infinity.
    """
    spark = sizes.sparkSession
    out, low, high, newton = {}, {}, {}, {}
    for s, want in wanted.items():
        every, _ = have.get(s, (0, 0.0))
        if want <= 0 or not every:
            out[s] = -math.inf
        elif want >= every * caps[s] * (1 - CLOSE):
            out[s] = math.inf
        else:
            low[s], high[s], newton[s] = -math.inf, math.inf, 0.0
    spread = 4.0
    while newton:
        tries = []
        for s, x in newton.items():
            a = low[s] if math.isfinite(low[s]) else min(x, high[s]) - spread
            b = high[s] if math.isfinite(high[s]) else max(x, low[s]) + spread
            points = {x, *(a + (b - a) * k / TRIED for k in range(TRIED + 1))}
            tries += [(s, float(p), float(have[s][1]), float(caps[s])) for p in points if low[s] < p < high[s]]
        spread *= 8
        guess = spark.createDataFrame(tries, "source string, x double, scale double, cap double")
        reach = F.col("x") * F.col("n_tokens") / F.col("scale")
        rate = F.least(F.exp(F.least(reach, F.lit(700.0))), F.col("cap"))
        slope = F.when(reach < F.log("cap"), rate * F.col("n_tokens") / F.col("scale")).otherwise(0.0)
        # TRIED rows for each source of the targets: a broadcast bounded by the table of targets
        sums = sizes.join(F.broadcast(guess), "source").groupBy("source", "x").agg(F.sum(rate * F.col("n_tokens") * F.col("n")).alias("value"), F.sum(slope * F.col("n_tokens") * F.col("n")).alias("slope")).collect()
        best = {}
        for r in sums:
            s, gap = r["source"], r["value"] - wanted[r["source"]]
            if gap > 0:
                high[s] = min(high[s], r["x"])
            else:
                low[s] = max(low[s], r["x"])
            if s not in best or abs(gap) < abs(best[s][0]):
                best[s] = gap, r["x"], r["slope"]
        for s in list(newton):
            gap, x, slope = best[s]
            step = x - gap / slope if slope > 0 else math.nan
            inside = low[s] < step < high[s]
            if abs(gap) <= CLOSE * wanted[s] or (math.isfinite(low[s]) and not low[s] < (low[s] + high[s]) / 2 < high[s]):
                out[s] = x
                del newton[s]
            else:
                newton[s] = step if inside else x
    return out


def _whole_copies(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies ``k`` of every size class of one source, from the largest size down.

    A source has no more classes than its records have different sizes, however many records.
    """
    rows = rows.sort_values("n_tokens", ascending=False)
    size, target = rows["n_tokens"].to_numpy(np.float64), (rows["rate"] * rows["n"]).to_numpy(np.float64)
    most = (rows["n"] * rows["cap"]).to_numpy(np.float64)
    k, owed = np.empty(len(rows), np.int64), 0.0
    for i in range(len(rows)):
        owed += target[i] * size[i]
        k[i] = min(max(math.floor(owed / size[i] + 0.5), 0), most[i])
        owed -= k[i] * size[i]
    return rows.assign(k=k)[["source", "n_tokens", "n", "rate", "k"]]


def balanced(sized: DataFrame, targets: DataFrame, total: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(copies, shares) of a mixture of ``sized`` (``doc_id``, ``source``, ``n_tokens``) by ``targets``.

    copies: ``doc_id``, ``source``, ``n_tokens``, ``rate``, ``copies`` of every record whose source
    has a target; records without tokens are used once, or not at all where nothing may be used.
    shares: one row per source of ``targets``, also for sources without records:
    ``target_share``, ``available``, ``max_repeats``, ``budget``, ``tokens``, ``actual_share``,
    ``n_records``, ``n_copies`` and ``met``, whether tokens are within half a percent, or the
    source's smallest record, of the budget.
    A source named twice in ``targets`` has its weights added and the larger ``max_repeats``.
    Null sources, and sources without a target, take no part.  Repeated records count as records.
    """
    spark = sized.sparkSession
    named = targets.where("source is not null").groupBy("source").agg(F.sum("weight").alias("weight"), F.max("max_repeats").alias("max_repeats")).collect()
    goal = {r["source"]: (r["weight"], r["max_repeats"]) for r in named}  # one row per source: small by nature
    sized = sized.where(F.col("source").isin(*goal) if goal else F.lit(False))
    sizes = stage(sized.groupBy("source", "n_tokens").agg(F.count("*").alias("n")))
    some = F.col("n_tokens") > 0
    known = sizes.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n")).alias("tokens"), F.sum(F.when(some, F.col("n"))).alias("n")).collect()
    have = {r["source"]: (r["tokens"], r["tokens"] / r["n"]) for r in known if r["tokens"]}
    caps = {s: max(r or 0, 0) for s, (_, r) in goal.items()}
    wanted = budgets({s: t for s, (t, _) in have.items()}, goal, total)
    found = multipliers(sizes.where(some), have, wanted, caps)
    weights = sum(max(w or 0.0, 0.0) for w, _ in goal.values())
    plan = spark.createDataFrame(
        [(s, found[s], float(have.get(s, (0, 1.0))[1]), float(caps[s]), max(w or 0.0, 0.0) / weights if weights else 0.0, have.get(s, (0, 0))[0], wanted[s]) for s, (w, _) in goal.items()],
        "source string, x double, scale double, cap double, target_share double, available long, budget double",
    )
    reach = F.col("x") * F.col("n_tokens") / F.col("scale")
    rate = (
        F.when(~some, F.least(F.lit(1.0), "cap"))
        .when(F.col("x") == math.inf, F.col("cap"))
        .when(F.col("x") == -math.inf, 0.0)
        .otherwise(F.least(F.exp(F.least(reach, F.lit(700.0))), F.col("cap")))
    )
    rated = sizes.join(F.broadcast(plan.select("source", "x", "scale", "cap")), "source").select("source", "n_tokens", "n", rate.alias("rate"), "cap")
    whole = rated.where(some).groupBy("source").applyInPandas(_whole_copies, "source string, n_tokens long, n long, rate double, k long")
    classes = stage(whole.unionByName(rated.where(~some).select("source", "n_tokens", "n", "rate", (F.col("n") * F.col("rate")).cast("long").alias("k"))))

    group = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / RANKED))
    placed = sized.join(classes, ["source", "n_tokens"]).withColumn("group", group)
    key = ["source", "n_tokens", "group"]
    counts = placed.where(F.col("n") > RANKED).groupBy(*key).agg(F.count("*").alias("own"))  # only of classes in several groups
    upto = Window.partitionBy("source", "n_tokens").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*key, F.coalesce(F.sum("own").over(upto), F.lit(0)).alias("before"))
    rank = F.coalesce("before", F.lit(0)) + F.row_number().over(Window.partitionBy(*key).orderBy("doc_id")) - 1
    more = (rank < F.col("k") % F.col("n")).cast("long")
    copies = placed.join(before, key, "left").select("doc_id", "source", "n_tokens", "rate", (F.floor(F.col("k") / F.col("n")) + more).alias("copies"))

    used = classes.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("k")).alias("tokens"), F.sum("n").alias("n_records"), F.sum("k").alias("n_copies"), F.min(F.when(some, F.col("n_tokens"))).alias("smallest"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    both = plan.join(used, "source", "left").select("source", "target_share", "available", F.col("cap").cast("int").alias("max_repeats"), "budget", zero("tokens").alias("tokens"), zero("n_records").alias("n_records"), zero("n_copies").alias("n_copies"), zero("smallest").alias("smallest"))
    every = both.agg(F.sum("tokens").alias("every"))
    shares = both.crossJoin(F.broadcast(every)).withColumn("actual_share", F.coalesce(F.try_divide("tokens", "every"), F.lit(0.0))).drop("every")
    return copies, shares.withColumn("met", F.abs(F.col("tokens") - F.col("budget")) <= F.greatest(0.005 * F.col("budget"), "smallest")).drop("smallest")


def mixture(docs: DataFrame, targets: DataFrame, total: float | None = None, tokenizer_folder: str | None = None, name: str = RANKS) -> tuple[DataFrame, DataFrame]:
    """:func:`balanced` for ``docs`` (``doc_id``, ``text``, ``source``), sized in tokens; null and empty texts have none."""
    taking_part = docs.join(F.broadcast(targets.select("source").distinct()), "source", "left_semi")  # one row per source of the targets
    return balanced(stage(count_column(taking_part, ["doc_id", "source"], folder=tokenizer_folder, name=name)), targets, total)


def copies(spark: SparkSession, folder: str) -> DataFrame:
    """p8_copies: how often every record is used."""
    return mixture(table(spark, folder, "documents").select("doc_id", "text", "source"), table(spark, folder, "mix_targets"))[0]


def shares(spark: SparkSession, folder: str) -> DataFrame:
    """p8_shares: target and actual share of every source."""
    return mixture(table(spark, folder, "documents").select("doc_id", "text", "source"), table(spark, folder, "mix_targets"))[1]


def char_shares(spark: SparkSession, folder: str) -> DataFrame:
    """p8_char_budgets: what each source is to give when records are sized in characters."""
    sized = table(spark, folder, "documents").select("doc_id", "source", F.coalesce("n_chars", F.lit(0)).cast("long").alias("n_tokens"))
    return balanced(sized, table(spark, folder, "mix_targets"))[1].select("source", "max_repeats", "available", F.round("target_share", 9).alias("target_share"), F.round("budget", 3).alias("budget"), "n_records")


CHAR_SQL = """
WITH t AS (SELECT source, sum(weight) AS w, max(max_repeats) AS cap FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
d AS (SELECT source, count(*) AS n, CAST(sum(coalesce(n_chars, 0)) AS BIGINT) AS have FROM documents GROUP BY 1),
b AS (SELECT t.source, w, cap, coalesce(have, 0) AS have, coalesce(n, 0) AS n, coalesce(have, 0) * cap AS room FROM t LEFT JOIN d ON d.source = t.source),
o AS (SELECT *, (SELECT sum(have) FROM b) - coalesce(sum(room) OVER (ORDER BY room / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER (ORDER BY room / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM b),
f AS (SELECT arg_min(rest / ws, room / w) FILTER (rest / ws < room / w) AS level FROM o)
SELECT source, cap AS max_repeats, have AS available, round(w / (SELECT sum(w) FROM b), 9) AS target_share, round(least(room, coalesce(w * level, room)), 3) AS budget, n AS n_records FROM b, f
"""
