"""Connected components of a graph given by its edges, in rounds that each shuffle the edges a few times."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetrisk.llm.common import lookup, staged

#: When no more edges than this are left, one task joins them all.
LAST = 100_000


def components(edges: DataFrame, rounds: int = 60, last: int = LAST) -> DataFrame:
    """(node, root) for each node of the edges (node, other): root is the smallest node it is connected to.

    Each round points a node at its smallest neighbour, or at itself if that is larger, follows the pointers three
    steps, and replaces the ends of each edge by what they point at. The image of a connected graph is connected and
    keeps its smallest node, so in the end each component is that node. Nodes are expected to be hashes: in random
    order, chains of falling neighbours are short, and each round leaves a fraction of the nodes.
    A hub is a hot key of its neighbours' pointers and is looked up by broadcast. Each round is written
    to the shared folder, so a lost executor costs one round at most. The last `last` edges are joined by one task.
    """
    e = staged(_ordered(edges.select("node", "other")), "edges")
    pointers = e.select("node", F.col("other").alias("root")).filter(F.lit(False))
    for n in range(rounds):
        left = e.count()
        if left <= last:
            if not left:
                return pointers
            to = staged(e.repartition(1).mapInPandas(_joined, "node long, to long"), "to_last")
            return to.withColumnRenamed("to", "root") if n == 0 else staged(_follow(pointers, "root", to), "pointers_last")
        both = e.unionByName(e.select(F.col("other").alias("node"), F.col("node").alias("other")))
        step = staged(both.groupBy("node").agg(F.least("node", F.min("other")).alias("to")), f"step_{n}")
        to = staged(_follow(_follow(step, "to", step), "to", step), f"to_{n}")
        pointers = to.withColumnRenamed("to", "root") if n == 0 else staged(_follow(pointers, "root", to), f"pointers_{n}")
        # Both ends are dealt out by the edge as it was: after the first step, a group's edges have one end in common.
        e = e.withColumn("_edge", F.xxhash64("node", "other"))
        e = staged(_ordered(_follow(_follow(e, "node", to, "_edge"), "other", to, "_edge")), f"edges_{n}")
    raise RuntimeError(f"the components are not found in {rounds} rounds")


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each node and the smallest one it is connected to."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for batch in batches:
        for a, b in zip(batch["node"].tolist(), batch["other"].tolist()):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pd.DataFrame({"node": nodes, "to": [top(x) for x in nodes]}, dtype="int64")


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger end first, no loops."""
    ends = edges.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    return ends.filter(F.col("node") != F.col("other")).distinct()


def _follow(rows: DataFrame, column: str, to: DataFrame, spread: str = "node") -> DataFrame:
    """rows with the nodes of a column replaced by what they point at, if anything; a hub may point at itself.

    Rows of a frequent node are dealt out by `spread`, whether the node is in `to` or, like a finished hub, no longer.
    """
    moved = to.select(F.col("node").alias(column), F.col("to").alias("_next"))
    copies = rows.groupBy(column).agg(F.count("*").alias("_copies"))
    found = lookup(rows, copies.join(moved, column, "left"), [column], "_copies", spread, ["_next"])
    return found.withColumn(column, F.coalesce("_next", column)).select(*rows.columns)
