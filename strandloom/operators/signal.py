"""Per-position signals as change points: coverage, window agreement of fragments, troughs.

A signal that is constant between change points is kept as segments (``s``, ``e``, value), so the
work follows the fragments and not the length of the sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.intervals import REGION
from strandloom.session import cut


def scan_sum(df: DataFrame, by: Sequence[str], at: str, values: dict[str, Column], width: int = REGION) -> DataFrame:
    """Running sums of ``values`` by rising ``at`` (one row per place), in two levels like ``scan_max``."""
    place = df.select(*by, at, *[v.alias(n) for n, v in values.items()]).withColumn("_region", F.floor(F.col(at) / width))
    within = Window.partitionBy(*by, "_region").orderBy(at)
    before = Window.partitionBy(*by).orderBy("_region").rowsBetween(Window.unboundedPreceding, -1)
    carry = place.groupBy(*by, "_region").agg(*[F.sum(n).alias(f"_c_{n}") for n in values])
    carry = carry.select(*by, "_region", *[F.coalesce(F.sum(f"_c_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in values])
    local = place.select(*by, at, "_region", *[F.sum(n).over(within).alias(n) for n in values])
    return local.join(carry, [*by, "_region"]).select(*by, at, *[(F.col(n) + F.col(f"_c_{n}")).cast("long").alias(n) for n in values])


def with_next(df: DataFrame, by: Sequence[str], at: str, out: str, width: int = REGION) -> DataFrame:
    """Add ``out``, the next place after each one (one row per place), in two levels like ``scan_max``."""
    place = df.withColumn("_region", F.floor(F.col(at) / width))
    later = Window.partitionBy(*by).orderBy("_region").rowsBetween(1, 1)
    carry = place.groupBy(*by, "_region").agg(F.min(at).alias("_m")).withColumn("_carry", F.first("_m").over(later)).drop("_m")
    local = place.withColumn("_local", F.lead(at).over(Window.partitionBy(*by, "_region").orderBy(at)))
    return local.join(carry, [*by, "_region"]).withColumn(out, F.coalesce("_local", "_carry")).select(*df.columns, out)


def depth(df: DataFrame, by: Sequence[str], start: str = "s", end: str = "e") -> DataFrame:
    """Coverage segments: ``s``, ``e``, ``depth``; stretches without cover are left out."""
    ends = F.array(F.struct(F.col(start).alias("s"), F.lit(1).alias("d")), F.struct((F.col(end) + 1).alias("s"), F.lit(-1).alias("d")))
    steps = df.select(*by, F.inline(ends)).groupBy(*by, "s").agg(F.sum("d").alias("d")).where("d <> 0")
    level = scan_sum(steps, by, "s", {"depth": F.col("d")})
    return with_next(level, by, "s", "_next").withColumn("e", F.col("_next") - 1).where("depth > 0").select(*by, "s", "e", "depth")


def window_agreement(fragments: DataFrame, width: int) -> DataFrame:
    """Segments of the left edge of a window of ``width``: how many fragments span it, touch its ends.

    ``fragments`` has ``ref``, ``length``, ``lend``, ``rend``, cut to the sequence.  Rows: ``ref``, ``s``,
    ``e``, ``both``, ``touch_left``, ``touch_right``, over windows whose left edge lies on the sequence.
    The ratio is (both + 1) / (single + both + 1) with single = the two touches less twice both.
    """
    f = fragments.where("length > 0").select("ref", "length", F.greatest("lend", F.lit(1)).alias("a"), F.least("rend", "length").alias("b")).where("a <= b")
    one, zero = F.lit(1), F.lit(0)

    def step(at, l, r, w):
        return F.struct(at.alias("s"), l.alias("l"), r.alias("r"), w.alias("w"))

    a, b, long = F.col("a"), F.col("b"), F.col("b") - width + 1 >= F.col("a")
    w = F.when(long, one).otherwise(zero)
    steps = F.array(step(a, one, zero, w), step(b + 1, -one, zero, zero), step(a - width + 1, zero, one, zero), step(b - width + 2, zero, -one, -w))
    moves = f.select("ref", "length", F.inline(steps))
    # places before the sequence count from its first base on
    moves = moves.withColumn("s", F.greatest("s", F.lit(1))).groupBy("ref", "length", "s").agg(*[F.sum(c).alias(c) for c in "lrw"])
    level = scan_sum(moves, ("ref", "length"), "s", {"touch_left": F.col("l"), "touch_right": F.col("r"), "both": F.col("w")})
    level = with_next(level, ("ref", "length"), "s", "_next")
    end = F.coalesce(F.col("_next") - 1, F.col("length"))
    return level.where(F.col("s") <= F.col("length")).withColumn("e", F.least(end, F.col("length"))).select("ref", "s", "e", "both", "touch_left", "touch_right")


def agreement_ratio() -> Column:
    """The ratio of a segment of :func:`window_agreement`, not rounded."""
    single = F.col("touch_left") + F.col("touch_right") - 2 * F.col("both")
    return (F.col("both") + 1) / (single + F.col("both") + 1)


def troughs(segments: DataFrame, ceiling: float, hill: float, reach: int, floor: float = 0.05, greed: float = 1.5, width: int = 100) -> DataFrame:
    """Troughs of :func:`window_agreement` (windows of ``width``) by their left edge: ``ref``, ``s``, ``e``.

    A place is a candidate where the ratio is at most ``greed`` / (cover ``reach`` / 2 bases before +
    cover as far behind + 1), but no more than ``ceiling`` and no less than ``floor``; both sides have
    to lie on the sequence, cover being taken at the middle of the window.  Candidates no more than
    ``reach`` apart are one trough, whose best place has the lowest ratio (ties: the largest mean
    rise to both sides, then the first).  It stays if the ratio rises by ``hill`` within ``reach``
    bases on both sides of it.  Windows run over one sequence's change points, of which there are no
    more than it has bases, however many fragments lie on it.  ``s`` is that place; up to ``e`` ratio, rise and gate are the same.
    """
    half, off = reach // 2, (width - 1) // 2
    by = Window.partitionBy("ref")
    known = segments.withColumns({"first": F.min("s").over(by), "length": F.max("e").over(by), "ratio": agreement_ratio()})
    own = F.struct("s", F.col("touch_left").alias("cover"), "ratio")
    bare = F.struct(F.lit(1).cast("long").alias("s"), F.lit(0).cast("long").alias("cover"), F.lit(1.0).alias("ratio"))  # before the first fragment
    full = known.select("ref", "length", F.inline(F.when((F.col("s") == F.col("first")) & (F.col("s") > 1), F.array(bare, own)).otherwise(F.array(own))))
    signals, s = ("ratio", "before", "behind", "c_before", "c_behind"), F.col("s")

    def step(at, which, value):
        return F.struct(at.cast("long").alias("at"), *[(value if n == which else F.lit(None)).cast("double").alias(n) for n in signals])

    valued = F.when(s <= F.col("length") - off, F.col("ratio"))  # the window's middle lies on the sequence
    start = s == 1
    steps = F.array(
        step(s, "ratio", valued), step(s + half, "before", valued), step(s - half, "behind", valued),
        step(F.when(start, 1 - off - half).otherwise(s - off + half), "c_before", F.col("cover")), step(s - off - half, "c_behind", F.col("cover")),
        step(F.when(start, F.col("length") - off + 1), "ratio", F.lit(0.0)), step(F.when(start, reach - half - off), "", F.lit(0.0)),
    )
    places = full.select("ref", "length", F.inline(steps)).where("at is not null").groupBy("ref", "length", "at").agg(*[F.max(n).alias(n) for n in signals])
    w = by.orderBy("at")
    value = places.select("ref", "length", F.col("at").alias("s"), (F.lead("at").over(w) - 1).alias("e"), *[F.coalesce(F.last(n, True).over(w), F.lit(0.0)).alias(n) for n in signals])
    w = by.orderBy("s")
    value = value.withColumn("last", F.lag("ratio").over(w))  # of the stretch that ends just before
    value = value.withColumns({"left": F.max("last").over(w.rangeBetween(1 - reach, 0)), "right": F.max("ratio").over(w.rangeBetween(1, reach))})
    gate = F.greatest(F.lit(floor), F.least(greed * (1 / (F.col("c_before") + F.col("c_behind") + 1)), F.lit(ceiling)))
    end = F.col("length") - half - off
    low = value.where((s >= reach - half - off) & (s <= end) & (F.col("ratio") <= gate)).withColumn("e", F.least("e", end))
    chained = low.withColumn("g", F.sum(F.when(s - F.lag("e").over(w) <= reach, 0).otherwise(1)).over(w))
    rise = ((F.col("before") - F.col("ratio")) + (F.col("behind") - F.col("ratio"))) / 2
    best = chained.groupBy("ref", "g").agg(F.min(F.struct("ratio", (-rise).alias("rise"), "s", "e", "left", "right")).alias("x")).select("ref", "x.*")
    return best.where((F.col("left") >= F.col("ratio") + hill) & (F.col("right") >= F.col("ratio") + hill)).select("ref", "s", "e")


def repositioned(points: DataFrame, segments: DataFrame, reach: int = 100) -> DataFrame:
    """``points`` (``ref``, ``pos``) moved to the lowest coverage within ``reach`` bases: ``ref``, ``pos``, ``moved``.

    Coverage is the ``touch_left`` of :func:`window_agreement`'s ``segments``, nothing before the first.  A
    point stays where nothing lower lies; of several lowest places the leftmost is taken.
    """
    first = segments.groupBy("ref").agg(F.min("s").alias("e")).where("e > 1").select("ref", F.lit(1).cast("long").alias("s"), F.col("e") - 1, F.lit(0).cast("long").alias("cover"))
    cover = segments.select("ref", "s", "e", F.col("touch_left").alias("cover")).unionByName(first.toDF("ref", "s", "e", "cover"))
    near = points.select("ref", "pos").join(cover, "ref").where((F.col("s") <= F.col("pos") + reach) & (F.col("e") >= F.col("pos") - reach))
    own = F.max(F.when(F.col("pos").between(F.col("s"), F.col("e")), F.col("cover")))
    best = F.min(F.struct("cover", F.greatest("s", F.col("pos") - reach).alias("at")))
    found = near.groupBy("ref", "pos").agg(own.alias("own"), best.alias("b"))
    return found.select("ref", "pos", F.when(F.col("b.cover") < F.col("own"), F.col("b.at")).otherwise(F.col("pos")).alias("moved"))


def clip_points(fragments: DataFrame, width: int = 100, ceiling: float = 0.3, hill: float = 0.35, reach: int = 200) -> DataFrame:
    """Where to cut sequences that few fragments run through: :func:`troughs`' middles, moved to the lowest coverage within half the reach."""
    segments = cut(window_agreement(fragments, width))
    middles = troughs(segments, ceiling, hill, reach, width=width).select("ref", (F.col("s") + (width - 1) // 2).alias("pos"))
    return repositioned(middles, segments, reach // 2).select("ref", F.col("moved").alias("cut")).distinct()
