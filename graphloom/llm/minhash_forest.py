"""MinHash near-dedup over an LSH forest, with every link confirmed on full shingle sets.

Documents with one shingle set are one node. Each tree of the forest is an order of the nodes by its own ``depth`` minhashes. In an
order, neighbours whose longest common prefix is at least ``shallow`` values are candidates, however many share it: a crowded region
is one family, not read deeper. Candidates that hang together are a family. Families, not pairs, are what moves: each node's set is sent once to its family, or to one of the family's blocks, and the pairs inside are compared there,
all of them, through an index from shingle to nodes. Between the blocks of a large family hubs are compared first; then every node
outside the family's largest component is compared with all nodes of all blocks. So no pair of one family stays unseen, no list of
pairs is made, and a family of near copies moves in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import Words, fold, mix, release, releasing, text_slices, written
from graphloom.llm.components import connected_components

NULL_ID = 2**63 - 1
#: Sets that a block may hold whatever their size: fewer would let a level of hubs pass all of them on.
FEW = 4


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, shingle hash), sorted; a text of fewer than k words has its whole sequence as one, without words none."""
    words = Words(data, offsets, lower=True)
    n = np.diff(words.bounds)
    grams = words.grams(k)
    doc = np.repeat(np.arange(len(n)), n)[: len(grams)]
    inside = np.arange(len(grams)) + k <= words.bounds[doc + 1]
    doc, h = doc[inside], grams[inside]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.array([fold(words.hashes[words.bounds[d] : words.bounds[d + 1]]) for d in short.tolist()], np.uint64)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool)
    return doc[new], h[new]


def _node(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set, whatever its order."""
    with np.errstate(over="ignore"):
        return mix(np.add.reduceat(mix(h + np.uint64(0x51ED270B)), first)).view(np.int64)


def _signed(k: int, trees: int, depth: int):
    rng = np.random.default_rng(20)
    odd = rng.integers(0, 2**63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 2**63, trees * depth, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                doc, h = shingle_sets(data, offsets, k)
                size = np.bincount(doc, minlength=rows.num_rows)
                full = np.flatnonzero(size)
                node, signature = np.zeros(rows.num_rows, np.int64), np.zeros((len(full), trees * depth), ">u2")
                if len(full):
                    first = (np.cumsum(size) - size)[full]
                    node[full] = _node(h, first)
                    with np.errstate(over="ignore"):
                        for j in range(trees * depth):
                            x = h * odd[j] + plus[j]
                            x ^= x >> np.uint64(32)
                            signature[:, j] = (np.minimum.reduceat(x * np.uint64(0x9E3779B97F4A7C15), first) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)
                held = np.full(rows.num_rows, None, object)
                held[full] = [r.tobytes() for r in signature]
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("null_id"), rows.column("tie"), pa.array(node), pa.array(size.astype(np.int64)), pa.array(held.tolist(), pa.binary())], ["id", "null_id", "tie", "node", "n", "signature"])

    return releasing(run)


def _trees(trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * depth
        for batch in batches:
            nodes = batch.column("node")
            for i in range(0, batch.num_rows, 5000):
                own = nodes.slice(i, 5000)
                paths = [s[t * width : (t + 1) * width] for s in batch.column("signature").slice(i, 5000).to_pylist() for t in range(trees)]
                tree = np.tile(np.arange(trees, dtype=np.int32), len(own))
                yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(paths, pa.binary()), pa.array(np.repeat(own.to_numpy(), trees))], ["tree", "path", "node"])

    return releasing(run)


def _neighbours(shallow: int):
    """Over one range of the sorted orders: neighbours with a long common prefix, as links to the first node of their run; and the
    range's first and last row, for the links across its ends."""
    short = 2 * shallow

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        first = last = head = None
        part = TaskContext.get().partitionId()

        def emit() -> pa.RecordBatch:
            kind, p, a, b, tree, path = zip(*out, strict=True)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(p, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(tree, pa.int32()), pa.array(path, pa.binary())], ["kind", "part", "a", "b", "tree", "path"])

        for batch in batches:
            for row in zip(batch.column("tree").to_pylist(), batch.column("path").to_pylist(), batch.column("node").to_pylist(), strict=True):
                if head and head[0] == row[0] and head[1][:short] == row[1][:short]:
                    out.append((0, part, head[2], row[2], None, None))
                    if len(out) > 50_000:
                        yield emit()
                else:
                    head = row
                first, last = first or row, row
        if first:
            out += [(1, part, first[2], first[2], first[0], first[1]), (2, part, last[2], last[2], last[0], last[1])]
            yield emit()

    return releasing(run)


class _Sets:
    """An index from the shingles of several sets to the sets that hold them."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.n)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.owner, ranked = owner[order], flat[order]
        edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        self.keys, self.begin, self.size = ranked[edge], edge, np.diff(np.append(edge, len(ranked)))

    def similar(self, s: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the sets of which ``s`` has at least ``percent`` per cent of the union in common."""
        if not len(self.keys) or not len(s):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
        at = at[self.keys[at] == s]
        size = self.size[at]
        ends = np.cumsum(size)
        if not len(ends):
            return np.zeros(0, np.int64)
        common = np.bincount(self.owner[np.arange(int(ends[-1])) + np.repeat(self.begin[at] - (ends - size), size)], minlength=len(self.n))
        return np.flatnonzero((common > 0) & (100 * common >= percent * (len(s) + self.n - common)))


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = int(parent[i])
    return i


def _inside(percent: int, hubs: int):
    """All pairs of one block: each node with the least node it is connected with, and how many links it has; hubs are the block's
    nodes with most links in its largest component, a quarter of the nodes at most (one at least)."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("node", kind="stable")
        nodes, sets = g["node"].to_numpy(np.int64), [np.asarray(s, np.int64) for s in g["shingles"]]
        index = _Sets(sets)
        parent, degree = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        for i, s in enumerate(sets):
            near = index.similar(s, percent)
            degree[i] = len(near) - 1
            for j in near[near > i].tolist():
                a, b = _root(parent, i), _root(parent, j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        roots = np.array([_root(parent, i) for i in range(len(nodes))])
        largest = np.bincount(roots).argmax()
        best = np.argsort(np.where(roots == largest, -degree, 1), kind="stable")[: max(1, min(hubs, len(nodes) // FEW))]
        is_hub = np.zeros(len(nodes), bool)
        is_hub[best] = True
        if len(index.owner) > 200_000:
            del index, sets
            release()
        return pd.DataFrame({"family": g["family"].to_numpy(), "node": nodes, "root": nodes[roots], "links": degree, "hub": is_hub})

    return run


def _across(percent: int):
    """Strays of a family against one block of it: a link from each stray to one node of each other component that it is similar to."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        strays, block = g[g["stray"]], g[~g["stray"]]
        if not len(strays) or not len(block):
            return pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="int64"), "links": pd.Series([], dtype="int64")})
        index = _Sets([np.asarray(s, np.int64) for s in block["shingles"]])
        nodes, roots = block["node"].to_numpy(np.int64), block["root"].to_numpy(np.int64)
        out = []
        for node, root, s in zip(strays["node"].tolist(), strays["root"].tolist(), strays["shingles"], strict=True):
            near = index.similar(np.asarray(s, np.int64), percent)
            near = near[roots[near] != root]
            for r in np.unique(roots[near]).tolist():
                of = near[roots[near] == r]
                out.append((node, int(nodes[of[0]]), len(of)))
        return pd.DataFrame(out, columns=["a", "b", "links"]).astype("int64")

    return run


def _blocks(shingles, block_shingles: int, block_nodes: int):
    """Number of a family's blocks, by its members' summed shingles: never more than one for each few members."""
    n = F.count(F.lit(1))
    by_size = F.greatest(F.ceil(F.sum(shingles) / block_shingles), F.ceil(n / block_nodes))
    return F.least(by_size, F.ceil(n / FEW)).alias("blocks")


def _levels(sets: DataFrame, percent: int, hubs: int, block_shingles: int, block_nodes: int) -> DataFrame:
    """Spans (a, b) among the hubs of a family's blocks: compared in blocks of their own, then those blocks' hubs, until one block is left.

    Of n > 4 sets some block has 4 at least and passes a quarter of them on, others one: about half of n at most, so levels end."""
    spans = None
    while True:
        sizes = sets.groupBy("family").agg(_blocks(F.size("shingles"), block_shingles, block_nodes))
        sets = written(sets.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node", F.lit("hubs")), F.col("blocks"))), "hub-sets")
        found = written(sets.groupBy("family", "block").applyInPandas(_inside(percent, hubs), "family long, node long, root long, links long, hub boolean"), "hub-links")
        own = found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        spans = own if spans is None else spans.unionByName(own)
        several = sets.filter("blocks > 1")
        if several.isEmpty():
            return spans
        sets = several.select("family", "node", "shingles").join(found.filter("hub").select("node"), "node")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80, trees: int = 28, depth: int = 6, shallow: int = 4, block_shingles: int = 1_500_000, block_nodes: int = 2_000, hubs: int = 4, with_tie: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``documents``; ``with_tie`` adds tie, xxhash64 of the text,
    and chosen, which tells whether the row is its component's least by doc_id and tie: one text of each component, whatever ids repeat.

    Shingles are ``k`` words, A-Z lower-cased; links need ``percent`` per cent of two sets' union in common. component_id is the least
    doc_id that links lead to, kept tells whether it is the row's own. Null and empty texts and texts without words have no shingle, no link
    and themselves as component. Rows with one doc_id and different texts are documents of their own. A null doc_id counts as larger
    than all others and comes out as null. Sets are compared by 64-bit hashes of shingles.

    Two sets that share ``percent`` of 80 are neighbours in some order with probability 1 - (1 - 0.8^4)^28, whatever else the table holds;
    families made by other members add to that. A block of a family holds about ``block_shingles`` shingles and ``block_nodes`` sets at
    most, but four sets in any case.
    """
    docs = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("doc_id").isNull().alias("null_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    signed = written(docs.mapInArrow(_signed(k, trees, depth), "id long, null_id boolean, tie long, node long, n long, signature binary"), "signatures")
    nodes = written(signed.filter("n > 0").groupBy("node").agg(F.min(F.struct("id", "null_id", "tie")).alias("row"), F.first("n").alias("n"), F.first("signature").alias("signature")), "nodes")
    orders = nodes.select("node", "signature").mapInArrow(_trees(trees, depth), "tree int, path binary, node long")
    orders = orders.repartitionByRange("tree", "path", "node").sortWithinPartitions("tree", "path", "node")
    found = written(orders.mapInArrow(_neighbours(shallow), "kind int, part int, a long, b long, tree int, path binary"), "neighbours")
    ends = sorted(((r["part"], r["kind"], r["tree"], bytes(r["path"]), r["a"]) for r in found.filter("kind > 0").collect()))  # two rows per partition
    over = [(x[4], y[4]) for x, y in zip(ends[1::2], ends[2::2], strict=False) if x[2] == y[2] and x[3][: 2 * shallow] == y[3][: 2 * shallow]]
    links = found.filter("kind = 0").select("a", "b")
    if over:
        links = links.unionByName(documents.sparkSession.createDataFrame(over, "a long, b long"))
    families = connected_components(links).withColumnRenamed("root", "family")

    members = families.join(nodes.select("node", "row.*", "n"), "node")
    sizes = members.groupBy("family").agg(_blocks(F.col("n"), block_shingles, block_nodes))
    members = members.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    texts = docs.join(members.drop("n"), ["id", "null_id", "tie"]).select("text", "family", "block", "blocks", "node")
    sets = written(texts.mapInArrow(_member_sets(k), "family long, block long, blocks long, node long, shingles array<long>").dropDuplicates(["node"]), "sets")
    inside = written(sets.groupBy("family", "block").applyInPandas(_inside(percent, hubs), "family long, node long, root long, links long, hub boolean"), "inside")
    spans = inside.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))

    large = sets.filter("blocks > 1")
    roots = inside.select("node", "root")
    if not large.isEmpty():
        hub_spans = _levels(large.select("family", "node", "shingles").join(inside.filter("hub").select("node"), "node"), percent, hubs, block_shingles, block_nodes)
        of_large = large.select("node")
        spans_large = written(spans.join(of_large, spans["a"] == of_large["node"], "left_semi").unionByName(hub_spans), "spans")
        first = connected_components(spans_large)
        placed = large.join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
        counts = placed.groupBy("family", "root").agg(F.count(F.lit(1)).alias("c"))
        most = counts.groupBy("family").agg(F.max_by("root", F.struct("c", "root")).alias("largest"))
        placed = written(placed.join(most, "family").withColumn("stray", F.col("root") != F.col("largest")), "placed")
        columns = ["family", "block", "node", "root", "shingles", "stray"]
        everywhere = placed.filter("stray").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tried = placed.withColumn("stray", F.lit(False)).select(*columns).unionByName(everywhere.select(*columns))
        across = written(tried.groupBy("family", "block").applyInPandas(_across(percent), "a long, b long, links long"), "across")
        last = connected_components(spans_large.unionByName(across.select("a", "b"))).withColumnsRenamed({"node": "__node", "root": "__root"})
        roots = roots.join(last, F.col("node") == F.col("__node"), "left").select("node", F.coalesce("__root", "root").alias("root"))

    labelled = written(nodes.select("node", "row").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "labelled")
    least = labelled.groupBy("root").agg(F.min("row").alias("least"))
    components = written(labelled.join(least, "root").select(F.col("node").alias("__node"), "least"), "component-ids")
    out = signed.select("id", "null_id", "tie", "node", "n").join(components, (F.col("n") > 0) & (F.col("node") == F.col("__node")), "left")
    component = F.coalesce("least.id", "id")
    return out.select(
        F.when(~F.col("null_id"), F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when((component != NULL_ID) | ~F.col("null_id"), component).alias("component_id"),
        (component == F.col("id")).alias("kept"),
        *(["tie", F.coalesce(F.col("least") == F.struct("id", "null_id", "tie"), F.lit(True)).alias("chosen")] if with_tie else []),
    )


def _member_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                doc, h = shingle_sets(data, offsets, k)
                size = np.bincount(doc, minlength=rows.num_rows)
                full = np.flatnonzero(size)
                if not len(full):
                    continue
                ends = np.cumsum(size)
                node = np.zeros(rows.num_rows, np.int64)
                node[full] = _node(h, (ends - size)[full])
                own = np.flatnonzero((size > 0) & (node == rows.column("node").to_numpy()))  # not another text with the same doc_id
                if len(own):
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size[own])]), pa.int32()), pa.array(h[np.isin(doc, own)].view(np.int64)))
                    yield pa.RecordBatch.from_arrays([*(rows.column(c).take(pa.array(own)) for c in ("family", "block", "blocks", "node")), lists], ["family", "block", "blocks", "node", "shingles"])

    return releasing(run)
