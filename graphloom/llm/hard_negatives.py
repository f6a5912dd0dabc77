"""Hard negatives through a GNAT: a multiway hyperplane tree over all rows, searched by annuli.

Scores are inner products. With M the greatest length of a row, each row gets one more component, sqrt(M^2 - |x|^2), and an anchor a zero
there; then the squared distance of anchor and row is |a|^2 + M^2 - 2 score, so that a window of scores is an annulus around the anchor.

The tree's split points come from a bounded sample; every row goes down to the child with the nearest split point. For each split point
and each sibling subtree the tree holds the range of distances from the point to the subtree's rows, measured on all rows. A search
goes down with an anchor's annuli and leaves out each sibling of which some split point's range does not meet the annulus, as the
triangle inequality then rules out all its rows. What is left are leaves, where all scores are computed exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.llm.common import releasing, written
from graphloom.llm.vectors import kind_of, matrix, packed, unpacked

NULL_ID = 2**63 - 1
#: Distances are compared with this share of the lengths as slack, beyond what doubles lose in them.
SLACK = 1e-6


@dataclass
class Split:
    points: np.ndarray  # lifted
    children: list[int]  # numbers of splits, or -1 - leaf
    low: np.ndarray = field(default=None)  # split point by child: least and greatest distance
    high: np.ndarray = field(default=None)


class Gnat:
    """Split points of a sample of lifted rows; ranges are filled in from all rows."""

    def __init__(self, sample: np.ndarray, n: int, leaf_rows: int, arity: int = 8, deepest: int = 24):
        self.splits: list[Split] = []
        self.leaves = 0
        rng = np.random.default_rng(11)
        weight = n / max(1, len(sample))

        def grow(own: np.ndarray, depth: int) -> int:
            points = self._far_apart(sample, own, arity, rng) if len(own) * weight > leaf_rows and len(own) >= 2 * arity and depth < deepest else own[:0]
            if len(points) < 2:
                self.leaves += 1
                return -self.leaves
            number = len(self.splits)
            self.splits.append(split := Split(sample[points], []))
            child = self._distances(sample[own], split.points).argmin(axis=1)
            for k in range(len(points)):
                split.children.append(grow(own[child == k], depth + 1))
            return number

        self.root = grow(np.arange(len(sample)), 0)
        for s in self.splits:
            s.low, s.high = np.full((len(s.points),) * 2, np.inf), np.full((len(s.points),) * 2, -np.inf)

    @staticmethod
    def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
        square = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", points, points) - 2 * x @ points.T
        return np.sqrt(np.maximum(square, 0))

    def _far_apart(self, sample: np.ndarray, own: np.ndarray, arity: int, rng) -> np.ndarray:
        """Split points: of a few candidates those that are farthest from one another, none of them alike."""
        some = own[np.sort(rng.permutation(len(own))[: 4 * arity])]
        between = self._distances(sample[some], sample[some])
        chosen = [0]
        while len(chosen) < arity:
            gap = between[:, chosen].min(axis=1)
            if gap.max() <= SLACK * np.abs(sample[some]).max():
                break
            chosen.append(int(gap.argmax()))
        return some[chosen]

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each lifted row; the rows' distances go into the ranges."""
        leaf = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            number, own = todo.pop()
            if not len(own):
                continue
            if number < 0:
                leaf[own] = -1 - number
                continue
            s = self.splits[number]
            d = self._distances(x[own], s.points)
            child = d.argmin(axis=1)
            for k, below in enumerate(s.children):
                if (at := child == k).any():
                    s.low[:, k], s.high[:, k] = np.minimum(s.low[:, k], d[at].min(axis=0)), np.maximum(s.high[:, k], d[at].max(axis=0))
                    todo.append((below, own[at]))
        return leaf

    def search(self, x: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) for each leaf that may hold a row at a distance from ``near`` to ``far`` of the query's lifted point."""
        queries, leaves = [], []
        length = np.abs(x).max(axis=1, initial=0) * np.sqrt(x.shape[1])
        todo = [(self.root, np.flatnonzero(near <= far))]
        while todo:
            number, own = todo.pop()
            if not len(own):
                continue
            if number < 0:
                queries.append(own)
                leaves.append(np.full(len(own), -1 - number))
                continue
            s = self.splits[number]
            d = self._distances(x[own], s.points)
            slack = SLACK * (length[own] + np.abs(s.points).max() * np.sqrt(x.shape[1]))[:, None]
            most = d + far[own][:, None] + slack
            least = np.maximum(near[own][:, None] - d, d - far[own][:, None]) - slack
            for k, below in enumerate(s.children):
                todo.append((below, own[((s.low[:, k] <= most) & (s.high[:, k] >= least)).all(axis=1)]))
        return (np.concatenate(queries), np.concatenate(leaves)) if queries else (np.zeros(0, np.int64),) * 2


def _lifted(x: np.ndarray, most: float, anchors: bool = False) -> np.ndarray:
    rest = np.zeros(len(x)) if anchors else np.sqrt(np.maximum(0, most - np.einsum("ij,ij->i", x, x)))
    return np.column_stack([x, rest])


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers; Python integers where doubles would round."""
    if a.size and x.size and a.shape[1] * np.abs(a).max() * np.abs(x).max() >= 2.0**53:
        ints = lambda m: np.array([[int(v) for v in r] for r in m.tolist()], object)
        return ints(a) @ ints(x).T
    return (a @ x.T).astype(np.int64)


def best(s: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``own`` the first ``k`` by score, then by id."""
    if s.dtype == object:
        return np.array(sorted(own.tolist(), key=lambda i: (-s[i], ids[i]))[:k], np.int64)
    if len(own) > k:
        own = own[s[own] >= np.partition(s[own], len(own) - k)[len(own) - k]]
    return own[np.lexsort((ids[own], -s[own]))[:k]]


def _long(values) -> np.ndarray:
    return np.array([max(-(2**63), min(2**63 - 1, int(v))) for v in values], np.int64)


def _prepared(scale: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, lens, valid = matrix(batch.column("embedding"))
            with np.errstate(over="ignore"):
                x = np.floor(scale * x) + 0.0
                square = np.einsum("ij,ij->i", x, x)
            own = np.flatnonzero(valid & batch.column("label").is_valid().to_numpy(zero_copy_only=False) & np.isfinite(square))
            rows = batch.take(pa.array(own))
            raw = packed(x[own], lens[own], kind)
            key = [int.from_bytes(hashlib.blake2b(b"%d %d " % (i, k) + v, digest_size=8).digest(), "little", signed=True) for i, k, v in zip(rows.column("id").to_pylist(), rows.column("label").to_pylist(), raw.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("label"), rows.column("anchor"), pa.array(key, pa.int64()), pa.array(lens[own]), pa.array(square[own]), raw], ["id", "label", "anchor", "key", "dim", "square", "vector"])

    return releasing(run)


ROUTED = "kind int, leaf long, id long, label long, key long, vector binary, split int, point int, child int, low double, high double"


def _routed(tree, most: float, width: int, kind: str):
    """Rows with their leaf, and at the task's end the ranges that its rows make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree.value
        schema = pa.schema([("kind", pa.int32()), ("leaf", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("key", pa.int64()), ("vector", pa.binary()), *((c, pa.int32()) for c in ("split", "point", "child")), ("low", pa.float64()), ("high", pa.float64())])
        for s in own.splits:
            s.low[:], s.high[:] = np.inf, -np.inf
        for batch in batches:
            x = unpacked(batch.column("vector").to_pylist(), kind, width)
            n = batch.num_rows
            none = [pa.nulls(n, schema.field(c).type) for c in ("split", "point", "child", "low", "high")]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(own.route(_lifted(x, most))), *(batch.column(c) for c in ("id", "label", "key", "vector")), *none], schema=schema)
        found = [(k, i, j, s.low[i, j], s.high[i, j]) for k, s in enumerate(own.splits) for i, j in np.argwhere(np.isfinite(s.low)).tolist()]
        if found:
            k, i, j, low, high = zip(*found, strict=True)
            none = [pa.nulls(len(found), schema.field(c).type) for c in ("leaf", "id", "label", "key", "vector")]
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(found), np.int32)), *none, *(pa.array(v, pa.int32()) for v in (k, i, j)), pa.array(low), pa.array(high)], schema=schema)

    return releasing(run)


def _windows(low: int, high: int):
    """Which scores a window takes: all of the anchor's label if ``of`` is null, else those of other labels from low to high per cent of it."""

    def takes(s: np.ndarray, of, same: np.ndarray, itself: np.ndarray) -> np.ndarray:
        if of is None:
            return same & ~itself
        return ~same & (100 * s >= low * of) & (100 * s <= high * of)

    return takes


def _visits(tree, sample, takes, most: float, width: int, k: int, low: int, high: int, kind: str):
    """For each anchor the leaves to visit, with a least score for each of its windows: the ``k``-th best of the sample's rows that the
    window takes. Windows are None or the positive's score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, ids, labels = sample.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256)
                a = unpacked(rows.column("vector").to_pylist(), kind, width)
                s = scores(a, x)
                exact = s.dtype != object
                windows = rows.column("windows").to_pylist()
                whose, near, far, least = [], [], [], []
                for r, (own, label, id_) in enumerate(zip(windows, rows.column("label").to_pylist(), rows.column("id").to_pylist(), strict=True)):
                    square = float(a[r] @ a[r]) + most
                    for of in own:
                        taken = s[r][takes(s[r], of, labels == label, ids == id_).astype(bool)].astype(float)
                        bound = -np.inf if of is None else low * of / 100
                        if len(taken) >= k:
                            bound = max(bound, float(np.partition(taken, len(taken) - k)[len(taken) - k]))
                        bound -= 0 if exact or not np.isfinite(bound) else 1e-6 * abs(bound)
                        top = np.inf if of is None else high * of / 100
                        whose.append(r)
                        near.append(0.0 if of is None else np.sqrt(max(0.0, square - 2 * top)))
                        far.append(np.inf if bound == -np.inf else np.sqrt(max(0.0, square - 2 * bound)) if bound <= top else -1.0)
                        least.append(bound)
                whose, at = np.array(whose, np.int64), np.cumsum([0, *map(len, windows)])
                query, leaf = tree.value.search(_lifted(a[whose], most, True), np.array(near), np.array(far)) if len(whose) else (np.zeros(0, np.int64),) * 2
                pairs = np.unique(np.column_stack([whose[query], leaf]), axis=0) if len(query) else np.zeros((0, 2), np.int64)
                taken = rows.take(pa.array(pairs[:, 0]))
                leasts = [least[at[r] : at[r + 1]] for r in pairs[:, 0].tolist()]
                yield pa.RecordBatch.from_arrays([*(taken.column(c) for c in ("id", "label", "key", "vector", "windows")), pa.array(pairs[:, 1]), pa.array(leasts, pa.list_(pa.float64()))], ["id", "label", "key", "vector", "windows", "leaf", "least"])

    return releasing(run)


def _searched(takes, k: int, width: int, kind: str):
    """All scores of a leaf's rows with the anchors that visit it; per anchor and window the best ``k``."""

    def run(held: pd.DataFrame, visits: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(held) and len(visits):
            x, ids, labels = unpacked(held["vector"], kind, width), held["id"].to_numpy(np.int64), held["label"].to_numpy(np.int64)
            a = unpacked(visits["vector"], kind, width)
            columns = [visits[c].tolist() for c in ("key", "id", "label", "windows", "least")]
            for i in range(0, len(a), 64):
                s = scores(a[i : i + 64], x)
                for r, (key, id_, label, windows, least) in enumerate(zip(*(c[i : i + 64] for c in columns), strict=True)):
                    own, same, itself = s[r], labels == label, ids == id_
                    for w, (of, bound) in enumerate(zip(windows, least, strict=True)):
                        of = None if of is None or of != of else int(of)
                        at = best(own, ids, np.flatnonzero((own >= bound) & takes(own, of, same, itself)), k)
                        if len(at):
                            out.append((np.full(len(at), key), np.full(len(at), w), ids[at], _long(own[at])))
        key, window, other, score = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4
        return pd.DataFrame({"key": key, "window": window, "other": other, "score": score})

    return run


def hard_negatives(embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, leaf_rows: int = 4_000, part_mb: int = 32, block_anchors: int = 5_000, sample_mb: int = 16) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score from ``embeddings`` (vec_id, label, embedding).

    Components become floor(scale * x); a score is the inner product of two such rows, compared exactly; higher scores come first, then
    smaller vec_ids, a null one last. An anchor is a row for which ``is_anchor`` holds; its positives are its first ``positives`` rows with the
    same label and another vec_id; for each the first ``negatives`` rows of other labels are returned whose score is from ``low`` to
    ``high`` per cent of the positive's, ranked from 1. Fewer are returned where there are fewer, none for a positive without any.

    Rows with a null label or vector, or a component that is null or not finite (after scaling and squaring too), take no part. A
    shorter vector counts as filled up with zeros. Repeated rows are rows of their own, but a repeated anchor is searched once. A score that a
    long cannot hold comes out as the nearest one. Other columns are ignored.

    The tree's split points and the least scores that searches begin with come from a sample of at most 20,000 rows and ``sample_mb``, which
    is broadcast; every row is indexed, and the result is exact. Leaves are dealt in parts of ``part_mb`` against ``block_anchors`` anchors.
    """
    spark, kind = embeddings.sparkSession, kind_of(embeddings.schema["embedding"])
    own = embeddings.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("label").cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), "embedding")
    base = written(own.mapInArrow(_prepared(scale, kind), "id long, label long, anchor boolean, key long, dim long, square double, vector binary"), "negatives-rows")
    total = base.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("dim"), F.lit(0)).alias("dim"), F.coalesce(F.max("square"), F.lit(0.0)).alias("most"), F.count(F.when(F.col("anchor"), 1)).alias("anchors")).first()
    width, most = total["dim"], total["most"]
    bound = max(200, min(20_000, (sample_mb << 20) // (8 * max(1, width))))
    share = min(1.0, 0.9 * bound / max(1, total["n"]))
    picked = base.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("id", "label", "key", "vector").limit(bound).collect()
    picked.sort(key=lambda r: (r["key"], r["id"]))
    x = unpacked([bytes(r["vector"]) for r in picked], kind, width)
    tree = Gnat(_lifted(x, most), total["n"], leaf_rows)
    sample = spark.sparkContext.broadcast((x, np.array([r["id"] for r in picked], np.int64), np.array([r["label"] for r in picked], np.int64)))
    routed = written(base.drop("anchor", "dim", "square").mapInArrow(_routed(spark.sparkContext.broadcast(tree), most, width, kind), ROUTED), "negatives-routed")
    ranges = routed.filter("kind = 1").groupBy("split", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    for r in ranges.collect():  # at most the square of the arity for each split
        tree.splits[r["split"]].low[r["point"], r["child"]], tree.splits[r["split"]].high[r["point"], r["child"]] = r["low"], r["high"]
    shared = spark.sparkContext.broadcast(tree)

    rows = routed.filter("kind = 0").select("leaf", "id", "label", "key", "vector")
    part_rows = max(100, (part_mb << 20) // (8 * max(1, width)))
    parts = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / part_rows).alias("parts"))
    blocks = -(-total["anchors"] // block_anchors) or 1
    place = ["leaf", "part", "block"]
    # an anchor meets all parts of a leaf, and each part the anchors in their blocks
    dealt = rows.join(F.broadcast(parts), "leaf").withColumn("part", F.pmod(F.xxhash64("key", "id"), F.col("parts")))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(*place, "id", "label", "vector")
    takes = _windows(low, high)

    def searched(anchors: DataFrame, k: int, label: str) -> DataFrame:
        schema = "id long, label long, key long, vector binary, windows array<long>, leaf long, least array<double>"
        visits = anchors.mapInArrow(_visits(shared, sample, takes, most, width, k, low, high, kind), schema).join(F.broadcast(parts), "leaf")
        visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int"))
        found = dealt.groupBy(*place).cogroup(visits.groupBy(*place)).applyInPandas(_searched(takes, k, width, kind), "key long, window int, other long, score long")
        order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "other")
        return written(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), label)

    anchors = written(base.filter("anchor").dropDuplicates(["key"]).select("id", "label", "key", "vector"), "negatives-anchors")
    near = searched(anchors.withColumn("windows", F.array(F.lit(None).cast("long"))), positives, "negatives-positives")
    lists = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("place"), F.col("other").alias("positive"), F.col("score").alias("positive_score")))).alias("found"))
    with_windows = written(anchors.join(lists, "key"), "negatives-windows")
    hard = searched(with_windows.withColumn("windows", F.col("found.positive_score")).drop("found"), negatives, "negatives-found")
    null = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    pairs = with_windows.select("key", "id", F.posexplode("found").alias("window", "of"))
    return hard.join(pairs, ["key", "window"]).select(null("id").alias("anchor_id"), null("of.positive").alias("positive_id"), F.col("rank"), null("other").alias("negative_id"), F.col("of.positive_score").alias("positive_score"), F.col("score").alias("negative_score"))
