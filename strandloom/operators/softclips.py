"""Clusters, consensus and verdicts over soft-clip loci."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.sequence import top_share
from strandloom.session import cut

#: Loci and reads of a strong and a moderate call; share of one base in a trivial key.
STRONG, MODERATE, TRIVIAL = (1000, 10000), (100, 1000), 0.7
#: Letters of the longest keys that are ranked as numbers: 4 ** 12 numbers are 17 million, six bytes each.
PACKED = 12
_OPEN = np.iinfo(np.uint16).max
_CHUNK = 1 << 14


def key_clusters(loci: DataFrame) -> DataFrame:
    """Per key: ``n_loci`` different places, ``n_reads``, and the ``example`` clip of its first locus."""
    return loci.where("key is not null").groupBy("key").agg(
        F.count_distinct(F.struct("chrom", "pos", "side")).alias("n_loci"), F.sum("n_clips").alias("n_reads"), F.min_by("clip", "locus_id").alias("example")
    )


def merged_clusters(loci: DataFrame) -> DataFrame:
    """Key clusters with every key under its seed: ``key`` (the seed), ``n_loci``, ``n_reads``, ``example``.

    Keys are ranked by reads for :func:`merge_keys`; places that several keys of a seed share count
    once, and the example is that of the key with most reads (ties: the first key).
    """
    raw = cut(key_clusters(loci))
    reads = F.coalesce("n_reads", F.lit(0))
    seeds = merge_keys(raw.select("key", reads.alias("n")))
    named = raw.join(seeds, "key").groupBy("seed").agg(F.sum("n_reads").alias("n_reads"), F.min_by("example", F.struct(-reads, "key")).alias("example"))
    places = loci.where("key is not null").select("key", "chrom", "pos", "side").distinct().join(seeds, "key")
    united = places.groupBy("seed").agg(F.count_distinct(F.struct("chrom", "pos", "side")).alias("n_loci"))
    return united.join(named, "seed").select(F.col("seed").alias("key"), "n_loci", "n_reads", "example")


def top_clusters(clusters: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` largest clusters by loci, reads and key, with ``rank``."""
    first = clusters.orderBy(F.col("n_loci").desc(), F.col("n_reads").desc_nulls_last(), "key").limit(n)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n_loci").desc(), F.col("n_reads").desc_nulls_last(), "key")).cast("long"))


def verdict(top: DataFrame) -> DataFrame:
    """The call that the first cluster of a varied key supports; ``ABSENT`` without one."""
    varied = top.where(top_share(F.col("key")) <= TRIVIAL)
    best = varied.agg(F.min_by(F.struct("key", "n_loci", "n_reads"), "rank").alias("b"))
    meets = lambda t: (F.col("b.n_loci") >= t[0]) & (F.col("b.n_reads") >= t[1])
    return best.select(F.when(meets(STRONG), "STRONG").when(meets(MODERATE), "MODERATE").otherwise("ABSENT").alias("call"), F.col("b.key").alias("key"), F.col("b.n_loci").alias("n_loci"), F.col("b.n_reads").alias("n_reads"))


def consensus(loci: DataFrame, coverage: int = 5, majority: float = 0.6, longest: int | None = 60) -> DataFrame:
    """Per ``key`` and ``side`` the bases that most clips agree on, from the alignment outward.

    A column needs ``coverage`` clips and a base with a share of ``majority`` (ties: the first in
    the alphabet); the first column that lacks either ends it.
    Columns count up to ``longest`` from the alignment, as a leader is no longer; None asks for all.
    """
    outward = F.when(F.col("side") == "5p", F.reverse(F.upper("clip"))).otherwise(F.upper("clip"))
    text = outward if longest is None else F.left(outward, F.lit(longest))
    same = loci.where("key is not null and clip is not null and side is not null").groupBy("key", "side", text.alias("text")).agg(F.count("*").alias("times"))
    # no column of a key seen less often than ``coverage`` can be covered: only the others are taken apart
    often = same.groupBy("key", "side").agg(F.sum("times").alias("all")).where(F.col("all") >= coverage).drop("all")
    cols = same.join(often, ["key", "side"], "left_semi").select("key", "side", "times", F.posexplode(F.split("text", "")).alias("col", "base"))
    counts = cols.where(F.col("base").isin("A", "C", "G", "T")).groupBy("key", "side", "col", "base").agg(F.sum("times").alias("n"))
    best = counts.groupBy("key", "side", "col").agg(F.sum("n").alias("cover"), F.max_by("base", F.struct("n", -F.ascii("base"))).alias("base"), F.max("n").alias("n"))
    good = best.where((F.col("cover") >= coverage) & (F.col("n") >= majority * F.col("cover")))
    w = Window.partitionBy("key", "side").orderBy("col")
    kept = good.withColumn("k", F.row_number().over(w)).where("k = col + 1")  # no column before is missing
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col", "base"))), lambda x: x["base"]), "")
    return kept.groupBy("key", "side").agg(text.alias("outward")).select("key", "side", F.when(F.col("side") == "5p", F.reverse("outward")).otherwise(F.col("outward")).alias("consensus"))


def share_histogram(loci: DataFrame) -> DataFrame:
    """Consistent loci by how many loci of the library share their motif."""
    m = F.col("motif_share")
    bucket = F.when(m <= 1, "1").when(m <= 10, "2-10").when(m <= 100, "11-100").when(m <= 1000, "101-1000").otherwise(">1000")
    return loci.where("status = 'consistent' and motif_share is not null").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merge_keys(counts: DataFrame, reach: int = 1) -> DataFrame:
    """Keys up to ``reach`` letters apart (1 or 2) joined under their commonest: ``key``, ``seed``.

    Keys are ranked by ``n`` falling, then by ``key``.  In rank order a key is a seed unless a seed
    before it lies within reach; then it joins the nearest such seed, of several the first by place
    and letter, where the seed has A, C, G or T at each letter that differs.

    Keys of up to ``PACKED`` letters A, C, G and T, of which there are 4 ** PACKED at most however
    many rows there are, are followed in that order by one task (:func:`_packed`); no other key can
    be the seed of one of them.  The rest is decided in rounds over all keys at once
    (:func:`_in_rounds`).
    """
    keys = counts.where("key is not null and n is not null").select("key", "n")
    plain = F.col("key").rlike(rf"\A[ACGT]{{1,{PACKED}}}\z")
    columns = f"key string, n {keys.schema['n'].dataType.simpleString()}, seed string"
    ranked = keys.where(plain).repartition(1).sortWithinPartitions(F.desc("n"), "key")
    decided = cut(ranked.mapInArrow(lambda batches: _packed(batches, reach), columns))
    rest = cut(keys.where(~plain))
    if not rest.isEmpty():
        return decided.select("key", "seed").unionByName(_in_rounds(rest, decided.where("key = seed").select("key", "n"), reach))
    return decided.select("key", "seed")


def _packed(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """``key``, ``n`` and ``seed`` of ranked plain keys: two bits a letter, one length after the other."""
    lengths: dict[int, list[tuple[np.ndarray, pa.Array]]] = {}
    digit = np.zeros(128, np.uint32)
    digit[list(b"ACGT")] = range(4)
    for batch in batches:
        texts = np.array(batch.column(0).to_pylist(), "S")
        sizes = np.char.str_len(texts)
        for size in np.unique(sizes):
            here = texts[sizes == size].astype(f"S{size}").view(np.uint8).reshape(-1, size)
            code = np.zeros(len(here), np.uint32)
            for letter in here.T:
                code = code << 2 | digit[letter]
            lengths.setdefault(int(size), []).append((code, batch.column(1).filter(pa.array(sizes == size))))
    for size in sorted(lengths):
        parts = lengths.pop(size)
        seed = _seeds(np.concatenate([code for code, _ in parts]), size, reach)
        at = 0
        for code, n in parts:
            yield pa.record_batch([_text(code, size), n, _text(seed[at : at + len(code)], size)], names=["key", "n", "seed"])
            at += len(code)


def _text(code: np.ndarray, size: int) -> pa.Array:
    """The keys of ``size`` letters that the numbers stand for."""
    letters = np.frombuffer(b"ACGT", np.uint8)[code[:, None] >> np.arange(2 * size - 2, -1, -2, dtype=np.uint32) & 3]
    return pa.array(np.ascontiguousarray(letters).view(f"S{size}").ravel()).cast(pa.string())


def _seeds(ranked: np.ndarray, size: int, reach: int) -> np.ndarray:
    """The seed of each number, given in rank order.

    A seed marks the keys behind it that it reaches, at most 630 of 12 letters, so that the time
    goes with the seeds, of which few fit among 4 ** size numbers.  A mark is smaller the earlier its
    seed comes for that key: 16 for each choice of places, nearer and first ones before, and the
    seed's two letters there (one place counts as two that are the same).
    """
    spots = [(p, p) for p in range(size)] + (list(combinations(range(size), 2)) if reach == 2 else [])
    flips = [[x] for x in (1, 2, 3)], [[x, y] for x in (1, 2, 3) for y in (1, 2, 3)]
    left, right = (np.array([0] + [2 * (size - 1 - s[k]) for s in spots], np.uint32) for k in (0, 1))  # bits to the right of a place, by spot from 1
    table = [(spot, sum(x << 2 * (size - 1 - p) for x, p in zip(flip, dict.fromkeys(at)))) for spot, at in enumerate(spots, 1) for flip in flips[at[0] != at[1]]]
    spot, masks = np.array([s for s, _ in table], np.uint32), np.array([m for _, m in table], np.uint32)
    rank = np.full(4**size, -1, np.int32)
    rank[ranked] = np.arange(len(ranked), dtype=np.int32)
    mark = np.full(4**size, _OPEN, np.uint16)
    for at in range(0, len(ranked), _CHUNK):
        part = ranked[at : at + _CHUNK]
        for key in part[mark[part] == _OPEN]:
            if mark[key] != _OPEN:  # a seed of this chunk reached it
                continue
            mark[key] = 0
            near = key ^ masks
            behind = np.flatnonzero(rank[near] > rank[key])
            if len(behind):
                near, which = near[behind], spot[behind]
                mark[near] = np.minimum(mark[near], which * 16 + (key >> left[which] & 3) * 4 + (key >> right[which] & 3))
    seed = ranked.copy()
    for at in range(0, len(seed), _CHUNK):
        part, told = seed[at : at + _CHUNK], mark[seed[at : at + _CHUNK]].astype(np.uint32)
        joined = np.flatnonzero(told)
        which, first, second = told[joined] >> 4, told[joined] >> 2 & 3, told[joined] & 3
        kept = part[joined] & ~(np.uint32(3) << left[which]) & ~(np.uint32(3) << right[which])
        part[joined] = kept | first << left[which] | second << right[which]
    return seed


def _in_rounds(keys: DataFrame, seeds: DataFrame, reach: int) -> DataFrame:
    """Seeds of the keys that :func:`_packed` cannot take, given its ``seeds`` (``key``, ``n``).

    A key is decided as soon as all neighbours before it are; a round decides at least the first
    open key, so that none stays open, however long a chain is.  Neighbours among ``keys`` meet on
    the key with ``reach`` letters left out, which never pairs all keys: as many share what is left
    as there are letters for the holes.  The plain neighbours of a key, which has few letters to
    replace, are spelt out and looked up.
    """
    many = keys.where(F.length("key") > 0)
    place = lambda low: F.explode(F.sequence(low, F.length("key")))
    single = many.select("key", "n", place(F.lit(1)).alias("i")).withColumn("j", F.col("i"))
    holes = single
    if reach == 2:
        double = many.where(F.length("key") > 1).select("key", "n", F.explode(F.sequence(F.lit(1), F.length("key") - 1)).alias("i")).select("key", "n", "i", place(F.col("i") + 1).alias("j"))
        holes = double.unionByName(single.where(F.length("key") == 1))
    start, middle, end = F.expr("left(key, i - 1)"), F.expr("substring(key, i + 1, j - i - 1)"), F.expr("substring(key, j + 1)")
    fill = lambda x, y: F.concat(start, x, F.when(F.col("j") > F.col("i"), F.concat(middle, y)).otherwise(""), end)
    left = holes.select("key", "n", "i", "j", fill(F.lit("_"), F.lit("_")).alias("hole"))
    other = left.select(F.col("key").alias("before"), F.col("n").alias("before_n"), "hole", "i", "j")
    met = left.join(other, ["hole", "i", "j"]).select("key", "n", "before", "before_n", "i", "j")
    letters = F.explode(F.array(*[F.lit(b) for b in "ACGT"]))
    bare = holes.where((F.length("key") <= PACKED) & fill(F.lit(""), F.lit("")).rlike(r"\A[ACGT]*\z"))
    spelt = bare.select("*", letters.alias("x")).select("*", letters.alias("y")).select("key", "n", "i", "j", fill(F.col("x"), F.col("y")).alias("before"))
    met = met.unionByName(spelt.join(seeds.select(F.col("key").alias("before"), F.col("n").alias("before_n")), "before"))
    pairs = met.where("before_n > n or (before_n = n and before < key)")
    differ = lambda at: F.substring("key", F.col(at), F.lit(1)) != F.substring("before", F.col(at), F.lit(1))
    bases = lambda at: F.substring("before", F.col(at), F.lit(1)).isin("A", "C", "G", "T")
    pairs = pairs.where((~differ("i") | bases("i")) & (~differ("j") | bases("j")))
    apart = F.when(differ("i") & differ("j") & (F.col("i") != F.col("j")), 2).otherwise(1)
    first = F.when(apart == 2, F.col("i")).when(differ("i"), F.col("i")).otherwise(F.col("j"))
    second = F.when(apart == 2, F.col("j")).otherwise(F.lit(0))
    pairs = cut(pairs.select("key", "before", F.struct(apart.alias("apart"), first.alias("first"), second.alias("second"), "before").alias("at")).groupBy("key", "before").agg(F.min("at").alias("at")))
    found = pairs.select("before").distinct().join(seeds, F.col("before") == F.col("key"), "left_semi").select(F.col("before").alias("key"), F.col("before").alias("seed"))
    state = cut(keys.select("key", F.lit(None).cast("string").alias("seed")).unionByName(found))
    while not state.where("seed is null").isEmpty():
        known = state.select(F.col("key").alias("before"), F.col("seed").alias("b_seed"))
        waiting = state.where("seed is null").select("key")
        near = pairs.join(waiting, "key", "left_semi").join(known, "before")
        told = near.groupBy("key").agg(F.min(F.when(F.col("b_seed") == F.col("before"), F.col("at"))).alias("found"), F.bool_or(F.col("b_seed").isNull()).alias("open"))
        step = state.join(told, "key", "left")
        # a seed before decides only once nothing that could come first is open
        seed = F.when(F.col("seed").isNotNull(), F.col("seed")).when(F.coalesce("open", F.lit(False)), None).when(F.col("found").isNotNull(), F.col("found.before")).otherwise(F.col("key"))
        state = cut(step.select("key", seed.alias("seed")))
    return state.join(keys, "key", "left_semi")
