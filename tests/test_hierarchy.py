"""Trees, deep chains and rings against a plain walk."""

import random

import pytest

from strandloom.operators.hierarchy import closure, deep_hierarchy, descendant_lists, hierarchy


def walk(parent):
    nodes = set(parent)
    par = {n: p if p in nodes else None for n, p in parent.items()}
    out = {}
    for n in nodes:
        path, x = [n], par[n]
        while x is not None and x not in path:
            path.append(x)
            x = par[x]
        if x is None:
            out[n] = [path[-1], len(path) - 1, 0, path[::-1]]
        else:
            out[n] = [min(path[path.index(x) :]), -1, -1, None]
    for n, (_, d, _, path) in out.items():
        if d > 0:
            for a in path[:-1]:
                out[a][2] += 1
    return {n: tuple(v) for n, v in out.items()}


def check(spark, parent, rounds, deep=True):
    df = spark.createDataFrame([(n, p, "clash", 7) for n, p in parent.items()], "node string, parent string, depth string, below int")
    want = walk(parent)
    read = lambda out: {r["node"]: (r["root"], r["depth"], r["n_desc"], r["path"]) for r in out.collect()}
    if deep:
        assert read(deep_hierarchy(df, "node", "parent", rounds, paths=True)) == want
    else:
        assert read(hierarchy(df, "node", "parent", paths=True, tail=rounds)) == want
        pairs = {(a, n, len(path) - 1 - i) for n, (_, _, _, path) in want.items() if path for i, a in enumerate(path[:-1])}
        below = {(x["ancestor"], x["descendant"], x["distance"]) for x in descendant_lists(df, "node", "parent", tail=rounds).collect()}
        assert pairs == below


@pytest.mark.parametrize(("seed", "deep"), [(0, True), (1, True), (0, False), (2, False)])
def test_random_forests_with_rings(spark, seed, deep):
    rng = random.Random(seed)
    ids = [f"n{i:03d}" for i in range(120)]
    parent = {n: rng.choice([None, "nowhere", *ids[: i + 1 + 3 * seed]][-40:]) for i, n in enumerate(ids)}
    check(spark, parent, 1 + seed if deep else 40 * seed, deep)


def test_deep_chain_and_tail_below_ring(spark):
    parent = {f"c{i:03d}": f"c{i - 1:03d}" if i else None for i in range(70)}
    parent |= {"r1": "r3", "r2": "r1", "r3": "r2", "t0": "r2"} | {f"t{i}": f"t{i - 1}" for i in range(1, 40)} | {"self": "self", "under": "self"}
    check(spark, parent, 4)


def test_chain_and_ring_peeled_to_the_end(spark):
    parent = {f"c{i:02d}": f"c{i - 1:02d}" if i else "gone" for i in range(12)}
    parent |= {"r1": "r5", "r2": "r1", "r3": "r2", "r4": "r3", "r5": "r4", "t0": "r2", "t1": "t0", "self": "self", "under": "self"}
    check(spark, parent, 0, deep=False)


def test_star_with_hot_parent(spark):
    check(spark, {"hub": None} | {f"leaf{i}": "hub" for i in range(3000)}, 4, deep=False)


def test_empty_and_null_nodes(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "node string, parent string")
    assert [tuple(r) for r in hierarchy(df, "node", "parent").collect()] == [("a", "a", 0, 0)]
    assert hierarchy(df.limit(0), "node", "parent").count() == 0


def test_closure(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "node string, parent string")
    got = {tuple(r) for r in closure(hierarchy(df, "node", "parent", paths=True)).collect()}
    assert got == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}
