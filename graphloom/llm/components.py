"""Connected components: blocks of links are contracted in memory, then alternating large and small stars over written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import releasing, written


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as a star around the least node of each of its components."""
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not held:
        return
    ends = np.concatenate([np.concatenate(x) for x in zip(*held, strict=True)])
    del held
    nodes, at = np.unique(ends, return_inverse=True)
    a, b = at[: len(at) // 2], at[len(at) // 2 :]
    root = np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    own = np.flatnonzero(root != np.arange(len(nodes)))
    for i in range(0, len(own), 100_000):
        k = own[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(nodes[k]), pa.array(nodes[root[k]])], ["a", "b"])


def connected_components(links: DataFrame, block_links: int = 500_000) -> DataFrame:
    """node and root (the least node of its component) for every node of ``links`` (a, b: longs; loops and repeats are allowed).

    First the links are read in about one partition for each ``block_links``, and each contracts its own: what many short links hold
    together becomes stars, and if all links are in one such block that is the result. Between blocks each round hangs the
    neighbours of a node on the least of them; rounds are in the order of the logarithm of the diameter. Hubs are rows of a join that
    adaptive execution can split, never lists.
    """

    def hung(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
        seen = both if larger else both.filter("b < a")
        least = seen.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        if larger:  # neighbours above a node hang on the least around it
            out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:  # a node and its neighbours below hang on the least of these
            out = seen.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    own = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    blocks = max(1, -(-own.count() // block_links))
    edges = written(own.filter("a <> b").coalesce(blocks).mapInArrow(releasing(_contracted), "a long, b long"), "stars")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = mark(edges) if blocks > 1 else (0,)
    while before[0]:
        edges = written(hung(written(hung(edges, True), "stars"), False), "stars")
        after = mark(edges)
        if after == before:
            break
        before = after
    nodes = own.select(F.col("a").alias("node")).unionByName(own.select(F.col("b").alias("node"))).distinct()
    root = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return written(nodes.join(root, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "components")
