"""Connected components of a table of links, by Spark joins.

Links are first contracted inside each task (whatever links it happens to
hold), then large-star and small-star steps alternate until nothing changes,
about the logarithm of the longest path of them. Every round is written to the
scratch folder. A node of very many links is only ever reduced to a minimum
(partially aggregated) or split by the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.scratch import Scratch, ship_package


def local_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links and the smallest node that each one reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return nodes, nodes[root]
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while (root[root] != root).any():
            root = root[root]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links as links to the smallest node that they reach here; at most a million links are held."""
    u, v, held = [], [], 0
    for b in batches:
        u.append(b.column("u").to_numpy())
        v.append(b.column("v").to_numpy())
        held += len(u[-1])
        if held >= 1_000_000:
            yield _stars(u, v)
            u, v, held = [], [], 0
    if held:
        yield _stars(u, v)


def _stars(u: list, v: list) -> pa.RecordBatch:
    nodes, roots = local_roots(np.concatenate(u), np.concatenate(v))
    far = nodes != roots
    return pa.RecordBatch.from_arrays([pa.array(nodes[far], pa.int64()), pa.array(roots[far], pa.int64())], names=["u", "v"])


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Links (u, v: long) -> node and component, its smallest reachable node, of all nodes that have links."""
    ship_package(links.sparkSession)
    e = links.filter("u != v").mapInArrow(_contract, "u long, v long").distinct()
    e = scratch.write(e, f"{name}-0")
    before, i = None, 0
    while True:
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or not now[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .union(e.select("v", "v").distinct())
        before, i = now, i + 1
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        e = scratch.write(small, f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
