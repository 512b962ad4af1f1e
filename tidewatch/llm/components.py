"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, stored


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a partition's links with the smallest node it reaches by them."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = np.fromiter(parent, np.int64, len(parent))
    roots = np.fromiter((root(x) for x in parent), np.int64, len(parent))
    for start in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[start : start + 100_000]), pa.array(roots[start : start + 100_000])], ["node", "root"]
        )


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for all nodes of ``links`` (a, b); component is the smallest node.

    Every partition joins up its own links. Nodes that then have several roots
    make links between roots, a smaller graph that is treated the same way, until
    no node has two. The largest node of a component is never a root, so each
    level is smaller. No component is ever gathered in one place. Repeated
    links and links from a node to itself do no harm; no links give no rows.
    """
    levels = []
    current = links.select("a", "b")
    while True:
        stars = stored(map_arrow(current, _local_roots, "node long, root long"), "component-stars")
        labels = stored(stars.groupBy("node").agg(F.min("root").alias("component")), "component-labels")
        levels.append(labels)
        current = stored(
            stars.join(labels, "node")
            .where("root <> component")
            .select(F.col("root").alias("a"), F.col("component").alias("b"))
            .distinct(),
            "component-links",
        )
        if current.isEmpty():
            break
    final = levels.pop()
    while levels:
        further = final.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
        lower = levels.pop()
        final = lower.join(further, F.col("component") == F.col("_node"), "left").select(
            "node", F.coalesce("_component", "component").alias("component")
        )
    return final
