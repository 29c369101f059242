"""Connected components of a graph given as edges between long ids.

Edges that fit a task (ONE_TASK) are solved by one union-find.  Beyond that
bound stars are made round by round, in all tasks; the result is the same."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


#: Edges (16 bytes each) that one task may hold.
ONE_TASK = 1 << 18


class UnionFind:
    """Disjoint sets whose root is the least member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while x != root:
            self.parent[x], x = root, self.parent.get(x, x)
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _contract(batches):
    """A partition's edges as stars: each node with its set's least member."""
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
    nodes = list(sets.parent)
    roots = [sets.find(n) for n in nodes]
    pairs = [(n, r) for n, r in zip(nodes, roots) if n != r]
    yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())],
                                     names=["u", "v"])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    onto = down.join(least, "u")
    return onto.select(F.col("v").alias("u"), F.col("m").alias("v")).union(onto.select("u", F.col("m").alias("v"))) \
        .filter("u != v").distinct()


def _nodes(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of an edge, with the least id it reaches.

    Union-find contracts each partition's edges, then those of all if they are
    at most ONE_TASK; else large and small stars
    alternate until the edges are stars (a logarithmic number of rounds in
    practice).  A hub of any degree is only ever aggregated with partial
    sums and joined back; each round is written to the shared folder."""
    a, b = edges.columns[:2]
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u != v")
    e = common.stage(e.mapInArrow(_contract, "u long, v long"), "edges")
    if e.count() <= ONE_TASK:
        e = common.stage(e.coalesce(1).mapInArrow(_contract, "u long, v long"), "edges")
        return _nodes(e)
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return _nodes(e)
        seen = state
        e = common.stage(_small_star(_large_star(e)), "edges")
