"""Connected components of links between numbered nodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written

#: Links that a task contracts at once.
LINKS = 1 << 19


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of each ``a`` and ``b`` in ``root``, where each node has the least one of its component, in place."""
    while True:
        a, b = root[a], root[b]
        far = a != b
        if not far.any():
            return
        a, b = a[far], b[far]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) as ties of each node to the least node of its component among about ``LINKS`` links."""

    def ties(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        nodes, at = np.unique(np.concatenate([t.column("a").to_numpy(), t.column("b").to_numpy()]), return_inverse=True)
        root = np.arange(len(nodes))
        join_roots(root, at[: t.num_rows], at[t.num_rows :])
        tied = np.flatnonzero(root != np.arange(len(nodes)))
        yield from pa.table({"a": nodes[tied], "b": nodes[root[tied]]}).to_batches()

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= LINKS:
            yield from ties(held)
            held, n = [], 0
    if n:
        yield from ties(held)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes of ``links`` (a, b: numbers).

    Stars: each node's larger neighbours, then its smaller ones, are tied to the least of them, until nothing changes, which takes few rounds even for long chains.  Each
    round is stored, so a lost executor costs a round's tasks at most.  Before the first, tasks contract the links that they have, so cycles and chains among these cost no rounds.
    """
    known = links.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = written(known.mapInArrow(_forest, "a long, b long").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.unionByName(edges.groupBy("a").agg(F.min("b").alias("b"))).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
