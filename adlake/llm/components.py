"""Connected components of an edge list on Spark.

A union-find inside each Arrow batch first turns its edges into stars, so that
what is shuffled is nearly a forest.  Then large-star and small-star steps
alternate until nothing changes: each is one aggregation and one join, and each
round is written to the shared folder, the one before it deleted.  No edge, node
or component reaches the driver.  The joins split hot nodes by Spark's adaptive
skew join.

The rounds grow with the logarithm of the longest path, squared at worst;
MAX_ROUNDS is far beyond that and only ends a fault.

Defined results: edges with a null end and loops link nothing, and a node that
has no other edge is not returned; repeated edges count once; an empty list gives
an empty result; columns beyond the first two are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import drop_stored, in_batches, stored

MAX_ROUNDS = 60


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over each batch's edges: (node, smallest node of its tree)."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        nodes = np.array(list(parent), np.int64)
        roots = np.array([find(x) for x in parent], np.int64)
        keep = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep])], ["u", "v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the two-column edge list; component is the smallest node reachable."""
    a, b = edges.columns[:2]
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u <> v")
    star = stored(in_batches(pairs, _forest, "u long, v long").distinct(), "star")
    for _ in range(MAX_ROUNDS):
        if _settled(star):
            roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        # large star: each node's larger neighbours move to its smallest neighbour
        both = star.union(star.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: each node and its smaller neighbours move to the smallest of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        last, star = star, stored(moved, "star")
        drop_stored(last)
    raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")


def _settled(star: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root on another node."""
    ends = star.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(star.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1").isEmpty()
