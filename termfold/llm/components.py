"""Connected components of links between numbers, on Spark."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.llm.shared import ship_package, tidy
from termfold.operators.staging import staged

@tidy
def _contracted(batches):
    """Links of one partition become stars: every node points to the least of its component there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p] if p in parent else p
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, c = root(u), root(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    nodes = list(parent)
    for i in range(0, len(nodes), 50_000):
        some = [(x, r) for x in nodes[i : i + 50_000] if (r := root(x)) != x]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in some], pa.int64()), pa.array([r for _, r in some], pa.int64())], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """node and root (the least number of its component) of every node of ``links`` (u, v) but the roots themselves.

    Each round turns links into stars within partitions, dealt by their larger end, and lets every node point to
    what its parent points to. It ends when each node has one parent and no parent has one. Only links travel; a
    hot root is a value, never a partition's key.
    """
    ship_package(links.sparkSession)
    edges = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    while True:                       # each round at least halves the longest chain
        # contracted where they are first, a node has one link a partition at most: none is a hot key
        local = edges.mapInArrow(_contracted, "u long, v long")
        stars = staged(local.repartition("u").mapInArrow(_contracted, "u long, v long"))
        parents = stars.groupBy("u").agg(F.min("v").alias("w"), F.count(F.lit(1)).alias("n"))
        several = parents.where("n > 1").limit(1).count()
        above = parents.select(F.col("u").alias("v"), "w")
        if not several and not stars.join(above, "v", "left_semi").limit(1).count():
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = stars.join(above, "v", "left").select("u", F.coalesce("w", "v").alias("v")).distinct()
