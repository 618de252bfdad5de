"""Near-duplicate records by meet-in-the-middle ball hashing (problem 5).

Two rows are alike when the runs of six letters in their texts (the *pieces*) agree in at least
half of the pieces found in either.  Comparing all rows is out of reach, so:

1. *Fingerprints.*  The windows of ``window`` letters of a row are dealt to ``tables`` tables by a
   hash.  In each, the row's fingerprint is the set of its first ``symbols`` windows by a random
   order that puts frequent windows late: a window's place is drawn with a rate that falls with
   the number of times its hash slot occurs in the whole table, counted before.  So a popular
   run, an adapter or a leader, brings nothing together while a row has words of its own, and
   there is no threshold at which that changes.
2. *Balls.*  The distance of two fingerprints is the number of symbols to delete and insert to
   turn one into the other.  Around each lies a ball of radius ``2 * deletions``; from both ends
   one meets in the middle: a row emits every variant of its fingerprint with ``deletions``
   symbols deleted, half the radius.  Two fingerprints share a variant exactly if they are no
   further apart than the radius, leave aside variants of neighbours.  A variant holds ``symbols - deletions`` windows, two or more,
   whatever their places, so meeting is not transitive and no plain MinHash value is equal to it.
   Windows of a variant begin ``apart`` letters or more from each other, as neighbours say little
   more than one of them: one short run in common is not to bring two rows together.
3. *Shuffle on variants.*  Equal variants come together; a variant's rows are cut into blocks of
   ``block`` rows, and blocks are paired, so that no task holds a hot variant whole.
4. *Deduplicate and verify.*  A pair met under several variants is checked once, exactly, on the
   whole texts.

Rows with equal texts are one representative in all of this and are expanded at the end, or kept
as representatives plus membership.  Every reported pair is right; a pair is missed only if its
rows share no variant.  Recall, measured against all pairs compared, is given by band of
similarity in the README; it is set by ``tables``, ``symbols`` and ``window``, which do not
depend on the size of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.ids import BLANKS
from strandloom.session import stage
from strandloom.sources.tables import table

PIECE = 6  # letters of a piece
LEAST = 30  # rows with fewer pieces are left out
WINDOW = 9  # letters of a fingerprint window
SYMBOLS, DELETIONS, TABLES, APART = 4, 2, 4, 4
SLOTS = 1 << 16  # counters of windows: a table of fixed size, whatever the number of rows
USUAL = 64.0  # a window met less often is not frequent
BLOCK = 512  # rows of one variant compared in one task
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters of a batch as numbers, and where each text starts (one more at the end).

    Texts of one byte a letter, nearly all, are read as they lie; others by code point.
    """
    data = texts.cast(pa.large_binary())
    size = pc.binary_length(data).to_numpy(zero_copy_only=False)
    if pc.sum(pc.utf8_length(texts)).as_py() == size.sum():
        offsets = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, data.offset * 8)
        raw = np.frombuffer(data.buffers()[2], np.uint8) if len(data) and data.buffers()[2] else np.zeros(0, np.uint8)
        return raw[offsets[0] : offsets[-1]].astype(np.uint32), offsets - offsets[0]
    rows = texts.to_pylist()
    return np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32), np.cumsum([0, *map(len, rows)])


def _rolling(letters: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` letters from each place on."""
    n = max(0, len(letters) - width + 1)
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = h * np.uint64(0x100000001B3) + letters[j : j + n]
    return _mix(h)


def _places(letters: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each whole window, and the window's place.

    Texts hold a clip and a key with a line feed (10) between them; no window runs over it.
    """
    n = max(0, len(letters) - width + 1)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    gaps = np.concatenate([[0], np.cumsum(letters == 10)])
    at = np.flatnonzero((row[:n] == row[width - 1 : width - 1 + n]) & (gaps[width : width + n] == gaps[:n]))
    return row[at], at


def _windows(letters: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each whole window, the text it belongs to, and its place."""
    row, at = _places(letters, starts, width)
    return _rolling(letters, width)[at], row, at


def _codes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's different windows, sorted by text: (window code, text number).

    Codes are equal for equal windows of the batch: the letters themselves, in as few bits as the
    batch's letters take, where they fit; else places in the sorted list of the window hashes.
    """
    letters, starts = _letters(texts)
    n = max(0, len(letters) - width + 1)
    used = np.bincount(letters, minlength=1) if letters.max(initial=0) < 256 else np.zeros(0)
    bits = max(1, int(np.count_nonzero(used) - 1).bit_length())
    row, at = _places(letters, starts, width)
    if len(used) and bits * width <= 40:
        short = np.cumsum(used > 0)[letters] - 1
        kind = np.uint32 if bits * width + len(texts).bit_length() <= 32 else np.uint64
        short, code = short.astype(kind), np.zeros(n, kind)
        for j in range(width):
            code = code << kind(bits) | short[j : j + n]
        code, shift = code[at], kind(bits * width)
    else:
        kind, shift = np.uint64, np.uint64(40)
        code = np.unique(_rolling(letters, width)[at], return_inverse=True)[1].astype(kind)
    both = np.sort(row.astype(kind) << shift | code)
    both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
    return both & ((kind(1) << shift) - kind(1)), (both >> shift).astype(np.int64)


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 1 << 13, letters: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Batches of few enough rows and letters; the last columns that are texts count."""
    for batch in batches:
        size = sum(np.asarray(pc.fill_null(pc.utf8_length(c), 0)).astype(np.int64) for c in batch.columns if pa.types.is_string(c.type))
        lo, upto = 0, np.cumsum(size)
        while lo < len(batch):
            hi = max(lo + 1, min(lo + rows, int(np.searchsorted(upto, upto[lo] - size[lo] + letters, "right"))))
            yield batch.slice(lo, hi - lo)
            lo = hi


def piece_counts(texts: pa.Array, width: int = PIECE) -> np.ndarray:
    """Number of different pieces of each text."""
    return np.bincount(_codes(texts, width)[1], minlength=len(texts))


def shared_pieces(a: pa.Array, b: pa.Array, width: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of texts: the different pieces that both have, and that either has."""
    n = len(a)
    code, row = _codes(pa.concat_arrays([a, b]), width)
    size = np.bincount(row, minlength=2 * n)
    both = np.sort((row % max(n, 1)).astype(np.uint64) << np.uint64(40) | code.astype(np.uint64))
    common = np.bincount((both[1:] >> np.uint64(40))[both[1:] == both[:-1]].astype(np.int64), minlength=n)
    return common, size[:n] + size[n:] - common


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64) & (SLOTS - 1)


def _count(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(SLOTS, np.int64)
        for batch in _sliced(batches):
            n += np.bincount(_slots(_windows(*_letters(batch.column(0)), window)[0]), minlength=SLOTS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["slot", "n"])

    return run


def lateness(texts: DataFrame, window: int = WINDOW) -> np.ndarray:
    """How much later than others the windows of each hash slot come: times over the mean, at least 1.

    The mean counts as ``USUAL`` at least, so that in a small table the windows of a few alike rows
    are not held for frequent.  Counted over all ``texts``; every task sends at most ``SLOTS`` sums, and so many numbers, half a
    megabyte, are all that is gathered and sent out again, however large the table.
    """
    rows = texts.select("text").mapInArrow(_count(window), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(SLOTS)
    for r in rows:
        n[r["slot"]] = r["n"]
    return np.maximum(n / max(n.mean(), USUAL), 1.0)


_PLACE, _AT = 36, 11  # bits of a symbol and, below them, of where its window begins
_LEAST_PLACE = np.float64(2.0**-60).view(np.uint64)


def fingerprints(texts: pa.Array, late: np.ndarray, window: int = WINDOW, symbols: int = SYMBOLS, tables: int = TABLES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group, symbols, begins, how many) of every fingerprint; group is text number times ``tables`` plus table.

    A symbol is a window's place in the random order, an exponential draw in 36 bits, which tells
    windows apart but for chance hits; ``begins`` is where its first window begins, modulo 2**11.
    """
    h, row, at = _windows(*_letters(texts), window)
    u = _mix(h * np.uint64(0x9E3779B97F4A7C15))
    place = -np.log(((u >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52) * late[_slots(h)]
    symbol = (place.view(np.uint64) - _LEAST_PLACE) >> np.uint64(23) & np.uint64((1 << _PLACE) - 1)
    group = row.astype(np.uint64) * np.uint64(tables) + (u & np.uint64(0xFFF)) % np.uint64(tables)
    both = np.sort(group << np.uint64(_PLACE + _AT) | symbol << np.uint64(_AT) | at.astype(np.uint64) & np.uint64((1 << _AT) - 1))
    known = both >> np.uint64(_AT)
    both = both[np.r_[True, known[1:] != known[:-1]]] if len(both) else both  # of equal windows the first
    group = both >> np.uint64(_PLACE + _AT)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(both) else np.zeros(0, np.int64)
    have = np.minimum(np.diff(np.r_[first, len(both)]), symbols)
    sets, begins = np.zeros((len(first), symbols), np.uint64), np.zeros((len(first), symbols), np.int64)
    for j in range(symbols):
        held = have > j
        cells = both[first[held] + j]
        sets[held, j] = cells >> np.uint64(_AT) & np.uint64((1 << _PLACE) - 1)
        begins[held, j] = cells & np.uint64((1 << _AT) - 1)
    return group[first].astype(np.int64), sets, begins, have


def variants(texts: pa.Array, late: np.ndarray, window: int = WINDOW, symbols: int = SYMBOLS, deletions: int = DELETIONS, tables: int = TABLES, apart: int = APART) -> tuple[np.ndarray, np.ndarray]:
    """Every variant of every text: (text number, variant).

    A fingerprint with fewer symbols, of a text with few windows, has the variants of those it has.
    """
    group, sets, begins, have = fingerprints(texts, late, window, symbols, tables)
    rows, out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for keep in combinations(range(symbols), symbols - deletions):
        good = have > keep[-1]
        for a, b in combinations(keep, 2):
            good &= np.abs(begins[:, a] - begins[:, b]) >= apart
        v = (group[good] % tables).astype(np.uint64) + np.uint64(1)
        for s in keep:  # symbols come sorted, so a set gives one value
            v = _mix(v * np.uint64(0x9E3779B97F4A7C15) + sets[good, s])
        rows.append(group[good] // tables)
        out.append((v >> np.uint64(16)).astype(np.int64))  # 48 bits shuffle smaller; a chance hit only costs one check
    return np.concatenate(rows), np.concatenate(out)


def _emit(late: np.ndarray, *ball: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            ids = batch.column(0).to_numpy()
            who, v = variants(batch.column(1), late, *ball)
            for lo in range(0, len(v), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(v[lo : lo + (1 << 16)]), pa.array(ids[who[lo : lo + (1 << 16)]])], ["variant", "id"])

    return run


def _long_enough(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            yield batch.filter(pa.array(piece_counts(batch.column(0)) >= least))

    return run


def _meetings(block: int):
    """Pairs of ids that share a variant, from rows sorted by variant.

    The rows of a variant with more than ``block`` of them give no pairs here: they leave one by
    one, as (id, -1, variant), to be paired block by block in a second step.
    """
    none = np.zeros(0, np.int64)

    def frames(a, b, variant):
        for lo in range(0, len(a), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + (1 << 16)]) for x in (a, b, variant)], ["a", "b", "variant"])

    def marks(ids, v):
        return frames(ids, np.full(len(ids), -1), v)

    def closed(v, ids):
        start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        size = np.diff(np.r_[start, len(v)])
        whole, place = np.repeat(size, size), np.arange(len(v)) - np.repeat(start, size)
        yield from marks(ids[whole > block], v[whole > block])
        small = (whole > 1) & (whole <= block)
        v, ids, whole, place = v[small], ids[small], whole[small], place[small]
        a, b = [none], [none]
        for d in range(1, int(whole.max(initial=1))):  # partners d places apart
            left = np.flatnonzero(place + d < whole)
            a.append(ids[left])
            b.append(ids[left + d])
        a, b = np.concatenate(a), np.concatenate(b)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        pairs = pairs[pairs[:, 0] < pairs[:, 1]]
        yield from frames(pairs[:, 0], pairs[:, 1], np.zeros(len(pairs), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, ids, hot = none, none, None
        for batch in batches:
            if not len(batch):
                continue
            new_v, new_ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if hot is not None:  # the open variant is known to be hot: its rows leave as they come
                more = new_v == hot
                yield from marks(new_ids[more], new_v[more])
                new_v, new_ids = new_v[~more], new_ids[~more]
                if not len(new_v):
                    continue
                hot = None
            v, ids = np.r_[v, new_v], np.r_[ids, new_ids]
            last = int(np.searchsorted(v, v[-1]))  # the last variant may go on
            if last:
                yield from closed(v[:last], ids[:last])
            v, ids = v[last:], ids[last:]
            if len(v) > block:
                hot = v[0]
                yield from marks(ids, v)
                v, ids = none, none
        if len(v):
            yield from closed(v, ids)

    return run


def _block_pairs(key, rows: pd.DataFrame) -> pd.DataFrame:
    """All pairs between two blocks of a hot variant, or within one block."""
    _, p, q = key
    x, y = rows.id[rows.mine == p].to_numpy(), rows.id[rows.mine == q].to_numpy()
    a, b = np.repeat(x, len(y)), np.tile(y, len(x))
    keep = a < b if p == q else a != b
    return pd.DataFrame({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep]})


def candidate_pairs(texts: DataFrame, window: int = WINDOW, symbols: int = SYMBOLS, deletions: int = DELETIONS, tables: int = TABLES, apart: int = APART, block: int = BLOCK) -> DataFrame:
    """Different pairs ``a < b`` of ids that share a variant; ``texts`` holds ``id`` and ``text``."""
    if not 2 <= symbols - deletions < symbols:
        raise ValueError("a variant keeps two symbols or more, and loses one or more")
    spread = texts.select("id", "text").mapInArrow(_emit(lateness(texts, window), window, symbols, deletions, tables, apart), "variant long, id long")
    met = stage(spread.repartition("variant").sortWithinPartitions("variant").mapInArrow(_meetings(block), "a long, b long, variant long"))
    cold = met.where("b >= 0").select("a", "b")
    hot = met.where("b < 0").select("variant", F.col("a").alias("id")).distinct()
    sizes = hot.groupBy("variant").agg(F.ceil(F.count("*") / block).alias("n"))
    placed = hot.join(sizes, "variant").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("n")))
    # a row goes to every pair of blocks that holds its own
    paired = placed.select("variant", "id", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"))
    paired = paired.select("variant", "id", "mine", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    warm = paired.groupBy("variant", "p", "q").applyInPandas(_block_pairs, "a long, b long")
    return cold.unionByName(warm).distinct()


def _jaccard(least: float):
    """Keeps the pairs whose pieces agree in at least ``least`` of those found in either, exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            common, either = shared_pieces(batch.column(2), batch.column(3))
            yield batch.filter(pa.array(common >= least * either)).select([0, 1])

    return run


def alike(texts: DataFrame, least: float = 0.5, **ball) -> DataFrame:
    """Pairs ``a < b`` of ids in ``texts`` (``id``, ``text``, all texts different) that are alike."""
    pairs = candidate_pairs(texts, **ball)
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_jaccard(least), "a long, b long")


def locus_text(clip: Column, key: Column) -> Column:
    """What the pieces of a row come from: clip and key, upper-cased, the key cut of blanks.

    Null counts as empty.  A line feed parts the two; other line feeds become blanks.
    """
    flat = lambda c: F.replace(F.upper(F.coalesce(c, F.lit(""))), F.lit("\n"), F.lit(" "))
    return F.concat(flat(clip), F.lit("\n"), flat(F.btrim(key, F.lit(BLANKS))))


def classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``rows`` (``id``, ``text``): one row per different text, and every id with its digest.

    The first holds ``id`` (the smallest with that text stands for all), ``text`` and ``copies``.
    Rows with a null id or too few pieces are left out; so many pieces take that many letters.
    """
    could = rows.where(F.col("id").isNotNull() & (F.length("text") >= LEAST + PIECE))
    different = could.groupBy("text").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    heads = stage(different.mapInArrow(_long_enough(LEAST), "text string, id long, copies long"))
    return heads, could.select("id", F.unhex(F.md5("text")).alias("digest"))


def members(heads: DataFrame, rows: DataFrame) -> DataFrame:
    """(``id``, ``member``) of the texts that more than one row has."""
    many = heads.where("copies > 1").select("id", F.unhex(F.md5("text")).alias("digest"))
    return many.join(rows.withColumnRenamed("id", "member"), "digest").select("id", "member")


def _locus_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "locus_rows").select(F.col("locus_id").alias("id"), locus_text(F.col("longest_clip"), F.col("motif_key")).alias("text"))


def found(spark: SparkSession, folder: str) -> DataFrame:
    """p5_found: all pairs of locus rows that are alike, repeated rows included."""
    heads, rows = classes(_locus_rows(spark, folder))
    pairs = alike(heads.select("id", "text"))
    many = members(heads, rows)
    for side in ("a", "b"):
        pairs = pairs.join(many.select(F.col("id").alias(side), "member"), side, "left").withColumn(side, F.coalesce("member", side)).drop("member")
    copies = many.select("id", F.col("member").alias("a")).join(many.select("id", F.col("member").alias("b")), "id").where("a < b").select("a", "b")
    return pairs.select(F.least("a", "b").alias("locus_a"), F.greatest("a", "b").alias("locus_b")).unionByName(copies.select(F.col("a").alias("locus_a"), F.col("b").alias("locus_b")))


def links(spark: SparkSession, folder: str) -> DataFrame:
    """p5_links: each locus row that takes part, its class of equal texts and its number of partners."""
    heads, rows = classes(_locus_rows(spark, folder))
    pairs = alike(heads.select("id", "text"))
    size = heads.select(F.col("id").alias("other"), "copies")
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
    outer = both.join(size, "other").groupBy("id").agg(F.sum("copies").alias("outside"))
    counted = heads.join(outer, "id", "left").select(F.unhex(F.md5("text")).alias("digest"), F.col("id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"))
    return rows.join(counted, "digest").select(F.col("id").alias("locus_id"), "class_id", "n_links")
