"""The N best items of every group by mergeable bounded heaps (problem 4).

Each task keeps, for every group it meets, a heap of at most N items, merged batch by batch and
cut back to N; only these heaps are shuffled, and what reaches the reducers for one group is at
most N items per task, however many items the group has.  The reducers merge them by the same
order: score first, then the tie columns, the last of which is unique.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.sources.tables import table


def _heaps(n: int, group: str, same: Sequence[str], order: Sequence[tuple[str, str]], batch_rows: int):
    """Keeps the first ``n`` different items of each group by ``order``; one heap per group and task."""

    score, unique = order[0], order[-1]

    def ordered(rows: pa.Table, keys: list[tuple[str, str]]) -> pa.Table:
        return rows.take(pc.sort_indices(rows, sort_keys=keys, null_placement="at_end")).combine_chunks()

    def starts(rows: pa.Table, names: Sequence[str]) -> np.ndarray:
        """Where a row differs from the one before in any of ``names``."""
        new = np.ones(rows.num_rows, bool)
        new[1:] = False
        for col in (rows.column(name).combine_chunks() for name in names):
            a, b = col.slice(1), col.slice(0, len(col) - 1)
            new[1:] |= pc.fill_null(pc.not_equal(a, b), pc.not_equal(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)
        return new

    def best(rows: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows
        once = ordered(rows, [(group, "ascending"), *((c, "ascending") for c in same), score, unique])
        once = once.filter(pa.array(starts(once, [group, *same, score[0]])))
        once = ordered(once, [(group, "ascending"), *order])
        first = np.flatnonzero(starts(once, [group]))
        place = np.arange(once.num_rows) - np.repeat(first, np.diff(np.r_[first, once.num_rows]))
        return once.filter(pa.array(place < n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap: list[pa.Table] = []
        rows = held = 0
        for batch in batches:
            heap.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows >= max(batch_rows, 2 * held):
                heap = [best(pa.concat_tables(heap))]
                rows = held = heap[0].num_rows
                if held > 8 * batch_rows:  # many small groups: pass the heaps on, the merge is the same
                    yield from heap[0].to_batches(max_chunksize=batch_rows)
                    heap, rows, held = [], 0, 0
        if heap:
            yield from best(pa.concat_tables(heap)).to_batches(max_chunksize=batch_rows)

    return run


def top_n(df: DataFrame, n: int, group: str, same: Sequence[str], order: Sequence[tuple[str, str]], rank: str, batch_rows: int = 1 << 16) -> DataFrame:
    """The first ``n`` different items of each ``group`` by ``order``, with their ``rank`` from 1.

    ``order`` lists (column, "ascending" or "descending"), the score first and a unique column
    last.  Items equal in ``group``, in ``same`` and in the score are one item, shown by its row
    with the smallest unique value.  Nulls come last; rows whose group is null are left out; an
    empty table stays empty; other columns of ``df`` are not read.
    """
    cols = list(dict.fromkeys([group, *same, *(c for c, _ in order)]))
    rows = df.select(*cols).where(F.col(group).isNotNull())
    heaps = rows.mapInArrow(_heaps(n, group, same, order, batch_rows), rows.schema).repartition(group)

    def by(c: str, way: str) -> Column:
        return F.col(c).asc_nulls_last() if way == "ascending" else F.col(c).desc_nulls_last()

    item = Window.partitionBy(group, *same, order[0][0]).orderBy(by(*order[-1]))
    ranked = Window.partitionBy(group).orderBy(*[by(*o) for o in order])
    once = heaps.withColumn(rank, F.row_number().over(item)).where(F.col(rank) == 1)
    return once.withColumn(rank, F.row_number().over(ranked).cast("long")).where(F.col(rank) <= n)


ORDER = [("orflen", "descending"), ("start", "ascending"), ("strand", "ascending"), ("stop", "ascending"), ("orf_no", "ascending")]


def found(spark: SparkSession, folder: str) -> DataFrame:
    """p4_found: the five longest ORFs of every transcript.

    A repeated call of one ORF has its length too; should lengths differ, both stay in the race.
    """
    orfs = table(spark, folder, "orfs").where("orflen > 0")
    return top_n(orfs, 5, "id", ["start", "stop", "strand", "frame"], ORDER, "orf_rank").select("id", "orf_rank", "orf_no")


FOUND_SQL = """
WITH o AS (SELECT id, start, stop, strand, frame, max(orflen) AS orflen, min(orf_no) AS orf_no FROM orfs WHERE id IS NOT NULL AND orflen > 0 GROUP BY 1, 2, 3, 4, 5)
SELECT id, orf_rank, orf_no FROM (
  SELECT id, orf_no, row_number() OVER (PARTITION BY id ORDER BY orflen DESC, start, strand, stop, orf_no) AS orf_rank FROM o) WHERE orf_rank <= 5
"""
