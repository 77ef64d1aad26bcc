"""Connected components of an edge table, as Spark jobs.

Each round runs a large-star and a small-star step (Kiveris et al., 2014):
every node links its larger, then its smaller neighbours to the smallest node
it sees. The edge table becomes a forest of stars in about log(n) rounds. It
is written to the shared folder after each step, so a lost executor costs one
step at most, and only two numbers per round reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, root)`` of each node in the edges, the root being the smallest of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], least)
        np.minimum.at(new, root[y], least)
        new = new[new]
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each batch of edges by the star forest of its components."""
    for batch in batches:
        a, b = (np.asarray(batch.column(i)) for i in (0, 1))
        node, root = forest(a, b)
        other = node != root
        yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(root[other])], names=["a", "b"])


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges (a long, b long)``.

    ``component`` is the smallest node reachable. Self links and repeated
    edges do no harm; nodes without a link to another node are left out; an
    empty table gives an empty table.
    """
    now = edges.where("a <> b").mapInArrow(_contract, "a long, b long")
    now, seen = stored(now, name), None
    while True:
        both = now.union(now.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), name)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large.where("a <> b"), name)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = stored(down.groupBy("a").agg(F.min("b").alias("m")), name)
        joined = down.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        now = stored(small.where("a <> b").distinct(), name)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b").distinct()
            )
        seen = state
