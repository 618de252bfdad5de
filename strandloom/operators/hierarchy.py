"""Parent-child rows to full hierarchies: path, depth, root, descendants, rings (problem 6).

Bottom-up leaf peeling: the nodes without unpeeled children are peeled and send their subtree
sizes, or where asked for their descendant lists, to their parents, until no leaf is left.  What no
peeling reaches are rings.  In reverse peel order the nodes then take root, depth and path from
their parents.

Only nodes that are still open take part in a round, so a round costs what is left of the forest,
and there are as many rounds as the longest chain has nodes.  Once no more than ``tail`` nodes are open,
a bound that does not grow with the data, one task peels them to the end in the same way, which
saves the many rounds of a few long chains; with a ``tail`` of 0 every round is a round.  Lists travel as rows (ancestor,
descendant, distance), never as one value, so that a root above a third of all rows is no hot
row.  Every step is a join or an aggregation on the node, combined on the map side.

For chains of many thousand nodes there is :func:`deep_hierarchy`, which peels a few rounds and
finishes the upper ends by pointer doubling, in log2 of the depth rounds.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.session import cut

ROWS = 50_000  # rows of a partition, at least: what is left after many rounds lies in few
TAIL = 50_000  # open nodes that one task peels to the end


def _forest(df: DataFrame, node: str, parent: str) -> DataFrame:
    """``node``, ``parent`` (also of no node), ``pending`` children and ``below`` 0: one exchange."""
    rows = df.where(F.col(node).isNotNull()).select(F.col(node).alias("node"), F.col(parent).alias("parent"))
    own = rows.select("node", "parent", F.lit(True).alias("own"), F.lit(0).alias("child"))
    named = rows.where("parent is not null").select(F.col("parent").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(False).alias("own"), F.lit(1).alias("child"))
    every = own.unionByName(named).groupBy("node").agg(F.max("parent").alias("parent"), F.bool_or("own").alias("own"), F.sum("child").alias("pending"))
    return cut(every.where("own").select("node", "parent", "pending", F.lit(0).cast("long").alias("below")))


def _leaves_left(open_: DataFrame, tail: int) -> tuple[bool, bool, DataFrame]:
    """Whether there are leaves to peel, whether one task can peel them, and the open nodes in as few partitions as they need."""
    n, leaves = open_.agg(F.count("*"), F.count_if(F.col("pending") == 0)).first()
    return leaves > 0 and n > tail, 0 < n <= tail, open_.coalesce(n // ROWS + 1)


def _peel(open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves of one round, and the nodes left open, with what their leaves sent."""
    leaves = open_.where("pending = 0")
    sent = leaves.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("gone"), F.sum(F.col("below") + 1).alias("more"))
    stay = open_.where("pending > 0").join(sent, "node", "left")
    return leaves, cut(stay.select("node", "parent", (F.col("pending") - F.coalesce("gone", F.lit(0))).alias("pending"), (F.col("below") + F.coalesce("more", F.lit(0))).alias("below")))


def _rings(residue: DataFrame) -> DataFrame:
    """Every node of a ring with the ring's smallest node, by doubling along the ring.

    Each node knows the smallest of the 2**k nodes ahead; when a step changes none, all of a ring agree.
    """
    state = cut(residue.select("node", F.col("parent").alias("ahead"), F.col("parent").alias("low")))
    while True:
        there = state.select(F.col("node").alias("ahead"), F.col("ahead").alias("next"), F.col("low").alias("next_low"))
        moved = cut(state.join(there, "ahead").select("node", F.col("next").alias("ahead"), F.least("low", "next_low").alias("low"), (F.col("next_low") < F.col("low")).alias("changed")))
        if moved.where("changed").isEmpty():
            return moved.select("node", "low")
        state = moved.drop("changed")


def _peeled_to_the_end(rows: pd.DataFrame) -> pd.DataFrame:
    """Root, depth, descendants and path of a bounded number of open nodes: leaves first, then back in reverse order."""
    nodes, parents = rows["node"].tolist(), rows["parent"].tolist()
    at = {n: i for i, n in enumerate(nodes)}
    up = [at.get(p, -1) for p in parents]
    pending, below = rows["pending"].tolist(), rows["below"].tolist()
    order = [i for i, n in enumerate(pending) if n == 0]
    for i in order:  # grows as parents become leaves
        if up[i] >= 0:
            below[up[i]] += below[i] + 1
            pending[up[i]] -= 1
            if pending[up[i]] == 0:
                order.append(up[i])
    root, depth, paths = list(nodes), [-1] * len(nodes), [None] * len(nodes)
    left = set(range(len(nodes))).difference(order)
    while left:  # rings
        ring = [left.pop()]
        while up[ring[-1]] != ring[0]:
            ring.append(up[ring[-1]])
            left.discard(ring[-1])
        for i in ring:
            root[i], below[i] = min(nodes[j] for j in ring), -1
    for i in reversed(order):
        p = up[i]
        if p < 0:
            depth[i], paths[i] = 0, [nodes[i]]
        elif depth[p] < 0:
            root[i], below[i] = root[p], -1
        else:
            root[i], depth[i], paths[i] = root[p], depth[p] + 1, [*paths[p], nodes[i]]
    return pd.DataFrame({"node": nodes, "root": root, "depth": depth, "n_desc": below, "path": paths})


def _tail(open_: DataFrame) -> DataFrame:
    return cut(open_.groupBy(F.lit("all")).applyInPandas(_peeled_to_the_end, "node string, root string, depth long, n_desc long, path array<string>"))


def _downward(done: DataFrame, peels: list[DataFrame], paths: bool) -> DataFrame:
    """Root, depth and path of peeled nodes, taken from their parents, the last peeled first."""
    for k, leaves in enumerate(reversed(peels)):
        above = done.select(F.col("node").alias("parent"), F.col("root").alias("p_root"), F.col("depth").alias("p_depth"), *([F.col("path").alias("p_path")] if paths else []))
        ring = F.coalesce(F.col("p_depth") == -1, F.lit(False))
        placed = leaves.join(above, "parent", "left").select(
            "node",
            F.coalesce("p_root", "node").alias("root"),
            F.when(ring, -1).otherwise(F.coalesce(F.col("p_depth") + 1, F.lit(0))).cast("long").alias("depth"),
            F.when(ring, -1).otherwise(F.col("below")).cast("long").alias("n_desc"),
            *([F.when(~ring, F.concat(F.coalesce("p_path", F.array().cast("array<string>")), F.array("node"))).alias("path")] if paths else []),
        )
        done = done.unionByName(placed if k == len(peels) - 1 else cut(placed))
    return done


def hierarchy(df: DataFrame, node: str, parent: str, paths: bool = False, tail: int = TAIL) -> DataFrame:
    """``node``, ``root``, ``depth``, ``n_desc`` (and ``path``) of every node of ``df``.

    ``df`` has one row per node; other columns are not read.  A parent that is null or no node
    makes a root: depth 0, its own root.  ``n_desc`` counts all descendants.  For a node on a ring
    or below one, ``root`` is the smallest node on the ring, ``depth`` and ``n_desc`` are -1.
    ``path`` lists the nodes from the root down to the node itself, null for rings.  Rows with a
    null node are left out; an empty table gives no rows.
    """
    (more, few, open_), peels = _leaves_left(_forest(df, node, parent), tail), []
    while more:
        leaves, open_ = _peel(open_)
        more, few, open_ = _leaves_left(open_, tail)
        peels.append(leaves)
    if few:
        done = _tail(open_)
    else:
        none = F.lit(-1).cast("long")
        done = _rings(open_).select("node", F.col("low").alias("root"), none.alias("depth"), none.alias("n_desc"), F.lit(None).cast("array<string>").alias("path"))
    return _downward(done if paths else done.drop("path"), peels, paths)


def descendant_lists(df: DataFrame, node: str, parent: str, tail: int = TAIL) -> DataFrame:
    """(``ancestor``, ``descendant``, ``distance``) of all pairs, by leaves that send their lists to their parents.

    A peeled node sends its parent itself and all it was sent; the lists of open nodes wait as rows, and
    go on to all ancestors once the last nodes are peeled.  Nodes of a ring are sent lists too but send
    none, and tell so what hangs below them: rings and all below have no place in a tree, and no rows here.
    """
    more, few, open_ = _leaves_left(_forest(df, node, parent), tail)
    known = open_.select(F.col("node").alias("ancestor"))
    waiting = sent = open_.select(F.col("node").alias("ancestor"), F.col("node").alias("descendant"), F.lit(0).cast("long").alias("distance")).where("false")
    parts = []
    while more:
        leaves, open_ = _peel(open_)
        more, few, open_ = _leaves_left(open_, tail)
        up = leaves.where("parent is not null").select(F.col("parent").alias("ancestor"), F.col("node").alias("descendant"), F.lit(1).cast("long").alias("distance"))
        ready = leaves.where("parent is not null").select(F.col("node").alias("ancestor"), "parent").join(waiting, "ancestor")
        up = cut(up.unionByName(ready.select(F.col("parent").alias("ancestor"), "descendant", (F.col("distance") + 1).alias("distance"))))
        parts.append(up)
        waiting = cut(waiting.unionByName(up).join(open_.select(F.col("node").alias("ancestor")), "ancestor", "left_semi"))
        waiting = waiting.coalesce(waiting.count() // ROWS + 1)
    every = reduce(DataFrame.unionByName, parts, sent)
    ringed = open_.select(F.col("node").alias("ancestor"))
    if few:
        last = _tail(open_)
        upper = cut(closure(last))
        ringed = last.where("path is null").select(F.col("node").alias("ancestor"))
        passed = waiting.withColumnRenamed("ancestor", "mid").join(upper.select("ancestor", F.col("descendant").alias("mid"), F.col("distance").alias("more")), "mid")
        every = every.unionByName(upper).unionByName(passed.select("ancestor", "descendant", (F.col("distance") + F.col("more")).alias("distance")))
    hung = every.join(ringed, "ancestor", "left_semi").select("descendant").distinct()
    own = every.join(known, "ancestor", "left_semi").join(ringed, "ancestor", "left_anti")
    return own.join(hung, "descendant", "left_anti").select("ancestor", "descendant", "distance")


def deep_hierarchy(df: DataFrame, node: str, parent: str, rounds: int = 4, paths: bool = False) -> DataFrame:
    """:func:`hierarchy` with ``rounds`` rounds of peeling and pointer doubling above, for very deep chains.

    In round k a node knows its ancestor 2**k above, the sum of the subtree sizes less than 2**k below,
    and the smallest node on the way; a node that is the smallest among its own ancestors lies on a ring.
    """
    open_, peels = _forest(df, node, parent), []
    known = open_.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    open_ = cut(open_.join(known, "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("parent"), "pending", "below"))
    for _ in range(rounds):
        leaves, open_ = _peel(open_)
        peels.append(leaves)
    return _downward(_doubled(open_, paths), peels, paths)


def _doubled(residue: DataFrame, paths: bool) -> DataFrame:
    """Root, depth and descendants of the residue, whose parents all lie in it, by pointer doubling."""
    at_top = F.col("parent").isNull()
    state = residue.select(
        "node",
        F.col("parent").alias("anc"),  # the ancestor 2**k above; null once the root is known
        F.when(at_top, F.col("node")).alias("top"),
        F.when(at_top, 0).otherwise(1).cast("long").alias("steps"),
        F.col("parent").alias("low"),  # the smallest of the 2**k ancestors
        (F.col("below") + 1).alias("size"),  # of all nodes less than 2**k below
        *([F.when(at_top, F.array("node")).otherwise(F.array("parent", "node")).alias("path")] if paths else []),
    )
    state = cut(state)
    while True:
        active = state.where("anc is not null")
        smallest = active.where("low = node").select(F.col("node").alias("a_low"), F.lit(True).alias("on_ring"))
        a_low = active.select(F.col("node").alias("anc"), F.col("low").alias("a_low"))
        rings = active.join(a_low, "anc", "left").join(smallest, "a_low", "left")  # anc itself may be done: then no ring
        if rings.where("on_ring is null").isEmpty():
            break
        up = state.select(F.col("node").alias("anc"), F.col("anc").alias("a_anc"), F.col("top").alias("a_top"), F.col("steps").alias("a_steps"), F.col("low").alias("a_low"), *([F.col("path").alias("a_path")] if paths else []))
        sent = active.groupBy(F.col("anc").alias("node")).agg(F.sum("size").alias("more"))
        moved = state.join(up, "anc", "left").join(sent, "node", "left")
        here = F.col("anc").isNotNull()
        state = cut(
            moved.select(
                "node",
                F.col("a_anc").alias("anc"),
                F.coalesce("top", "a_top").alias("top"),
                (F.col("steps") + F.coalesce("a_steps", F.lit(0))).alias("steps"),
                F.least("low", "a_low").alias("low"),
                (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"),
                *([F.when(here, F.concat("a_path", F.slice("path", 2, F.size("path")))).otherwise(F.col("path")).alias("path")] if paths else []),
            )
        )
    trees = state.where("anc is null").select("node", F.col("top").alias("root"), F.col("steps").alias("depth"), (F.col("size") - 1).alias("n_desc"), *(["path"] if paths else []))
    lost = rings.select("node", F.col("a_low").alias("root"), F.lit(-1).cast("long").alias("depth"), F.lit(-1).cast("long").alias("n_desc"), *([F.lit(None).cast("array<string>").alias("path")] if paths else []))
    return cut(trees.unionByName(lost))


def closure(paths: DataFrame) -> DataFrame:
    """(``ancestor``, ``descendant``, ``distance``) of all pairs, from nodes with their ``path``.

    Made from the descendants' side, so that no ancestor's list is ever held by one task.
    """
    return paths.where("path is not null").select(F.col("node").alias("descendant"), F.col("depth"), F.posexplode("path").alias("at", "ancestor")).where("at < depth").select("ancestor", "descendant", (F.col("depth") - F.col("at")).alias("distance"))
