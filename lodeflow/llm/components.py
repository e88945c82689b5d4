"""Connected components by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeflow.llm.common import settle

#: Edges that one task finishes (16 bytes each, about 60 MB at work); more are contracted by rounds first.
LAST_EDGES = 1 << 19


def connected_components(edges: DataFrame, last: int = LAST_EDGES) -> DataFrame:
    """(node, root) for every endpoint of ``edges`` (a, b: long); root is the smallest node id reachable.

    Each round replaces the edges by stars: every node first hands its smallest neighbour to its
    larger neighbours, then to its smaller ones. The number of edges never grows, the number of
    rounds is logarithmic in the longest path, and no list of links is gathered in one place: a
    round is two grouped minima (combined before their shuffle) and two equi-joins, whose skewed
    keys adaptive execution splits. Rounds are cut off by reliable checkpoints. Once at most ``last`` edges are
    left, as counted, one task reads them from the checkpoint and gives their roots, which spares the last rounds.
    Empty input gives an empty result; self-loops and repeated edges don't matter.
    """
    now = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = _digest(now)
    while state[0] > last:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        fresh = settle(least.select("u", F.col("m").alias("v")).unionByName(rest).distinct())
        then = _digest(fresh)
        now, done, state = fresh, then == state, then
        if done:
            break
    if state[0] <= last:
        return now.coalesce(1).mapInArrow(_roots, "node bigint, root bigint")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, smallest node reachable) of all edges that come: roots are hooked below smaller ones until no edge joins two."""
    ends = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
    if not ends:
        return
    node, place = np.unique(np.concatenate(ends, axis=1), return_inverse=True)
    a, b = place.reshape(2, -1)
    root = np.arange(len(node))
    while (root[a] != root[b]).any():
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[root])], names=["node", "root"])


def _digest(edges: DataFrame) -> tuple:
    """Count and an order-free hash, to tell whether a round changed anything."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
