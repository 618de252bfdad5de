"""Top N against a plain sort; ties, repeats, nulls, a hot group over small batches."""

import random

from strandloom.llm import topn

SCHEMA = "orf_no long, id string, start long, stop long, strand string, frame long, orflen long, orf_rank string"


def plain(data, n):
    once = {}
    for r in data:
        if r[1] is not None and (r[6] or 0) > 0:
            key = r[1:7]
            once[key] = min(once.get(key, r), r)
    out = []
    for g in {r[1] for r in once.values()}:
        mine = sorted((r for r in once.values() if r[1] == g), key=lambda r: (-r[6], r[2], r[4], r[3], r[0]))
        out += [(g, k + 1, r[0]) for k, r in enumerate(mine[:n])]
    return sorted(out)


def test_against_a_sort(spark):
    rng = random.Random(1)
    data = []
    for k in range(3000):
        start, length = rng.randint(1, 30), rng.choice([None, -3, 0, 6, 9, 12, 15])
        data.append((k, rng.choice(["hot"] * 6 + ["a", "b", "c", None]), start, start + (length or 1), rng.choice("+-"), start % 3, length, "clash"))
    df = spark.createDataFrame(data, SCHEMA).repartition(7).where("orflen > 0")
    got = topn.top_n(df, 5, "id", ["start", "stop", "strand", "frame"], topn.ORDER, "rank", batch_rows=64)
    assert sorted((r["id"], r["rank"], r["orf_no"]) for r in got.collect()) == plain(data, 5)


def test_null_ties_and_empty(spark):
    data = [(3, "a", None, 5, None, 1, 9, ""), (1, "a", None, 5, None, 1, 9, ""), (2, "a", 1, 5, "+", 1, 9, ""), (4, "a", 1, 5, "-", 1, 9, "")]
    df = spark.createDataFrame(data, SCHEMA)
    got = topn.top_n(df, 5, "id", ["start", "stop", "strand", "frame"], topn.ORDER, "rank")
    assert sorted((r["rank"], r["orf_no"]) for r in got.collect()) == [(1, 2), (2, 4), (3, 1)]
    assert topn.top_n(df.limit(0), 5, "id", ["start", "stop", "strand", "frame"], topn.ORDER, "rank").count() == 0
