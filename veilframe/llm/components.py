"""Connected components of a table of links, without gathering a group or the table anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import join_hot, materialise, passing
from veilframe.llm.words import lean

#: Links up to which one task follows them all; beyond, they are contracted by rounds of joins, some dozens of stages of tasks that the driver keeps track of.
ONE_TASK = 500_000


@lean
def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and component of the links (a, b) of all batches."""
    links = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches]
    nodes, at = np.unique(np.concatenate(links, axis=1) if links else np.zeros((2, 0), np.int64), return_inverse=True)
    root = list(range(len(nodes)))
    for a, b in zip(*at.reshape(2, -1).tolist(), strict=True):
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        root[max(a, b)] = min(a, b)
    for x in range(len(root)):  # a root is less than what it is the root of
        root[x] = root[root[x]]
    for first in range(0, len(nodes), 10_000):
        own = slice(first, first + 10_000)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own], pa.int64()), pa.array(nodes[np.array(root[own])], pa.int64())], ["node", "component"])


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """Edges (a, b) with m, the least b of a. Sums are formed before rows move, and a hot a is not gathered."""
    return join_hot(edges, edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "a", "n", total).drop("n")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the least node reachable.

    Up to ONE_TASK links are followed by one task. More alternate large-star and small-star contraction: each node's greater neighbours, then its smaller
    ones, are linked to its least neighbour, until every component is a star around its least node.
    Every round is written to the shared folder, and deleted when its successor is there. Self-links
    count as nodes alone; rows with a null are left out; repeated links do no harm.
    """
    with passing() as keep:
        links = materialise(links.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b"), "given")
        if links.count() <= ONE_TASK:
            found = links.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct().repartition(1).mapInArrow(_followed, "node long, component long")
            return keep(found.select(*[F.col(x).cast(links.schema["a"].dataType).alias(x) for x in ("node", "component")]), "components")
        edges = _round(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        while True:
            table, state, total = edges
            both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
            large = _with_least(both, 2 * total).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
            small = _with_least(materialise(large, "large"), total)
            small = small.select("b", "m").unionByName(small.select(F.col("a").alias("b"), "m")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
            edges = _round(small)
            if edges[1] == state:
                break
        members = edges[0].select(F.col("a").alias("node"), F.col("b").alias("component"))
        alone = links.filter("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
        roots = edges[0].select(F.col("b").alias("node"), F.col("b").alias("component"))
        return keep(members.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component")), "components")


def _round(edges: DataFrame) -> tuple[DataFrame, tuple, int]:
    """The edges as a table, what tells it from others, and its length."""
    table = materialise(edges, "edges")
    state = table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return table, tuple(state), state[0]
