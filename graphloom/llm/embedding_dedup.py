"""Near-duplicate vectors by an exact metric range join.

Cosine at least ``least`` is a distance of unit vectors of at most r = sqrt(2 - 2 least). Pivots cut the vectors of each label into cells:
each vector is at home with its nearest pivot. The signed distance to the plane between two pivots changes by no more than two vectors are
apart (the triangle inequality), so a pair across two cells lies within r of the plane between them: of each two cells one, by a fixed
rule, takes such vectors of the other as guests, and finds every pair of the two. Cells are then joined independently of one another,
in blocks of bounded size, each a matrix product.

Equal vectors are one node with a count. Where many vectors lie within r / 2 of one of them, they are a ball: the triangle inequality
links all its pairs without a comparison, so that only the others around a ball are compared with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import releasing, written
from graphloom.llm.components import connected_components
from graphloom.llm.vectors import kind_of, matrix, packed, unpacked

NULL_ID = 2**63 - 1
#: Distances are compared with so much slack; cosines within it of the limit are computed anew from the vectors as given.
SLACK = 1e-9


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares neither overflow nor vanish; the angles stay as they are."""
    most = np.abs(x).max(axis=1, initial=0)
    return np.ldexp(x, -np.frexp(np.where(most > 0, most, 1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    n = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(n > 0, n, 1)[:, None]


def _nodes(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, lens, valid = matrix(batch.column("embedding"))
            label = batch.column("label")
            valid &= label.is_valid().to_numpy(zero_copy_only=False) & (x != 0).any(axis=1)
            labels = label.fill_null(0).to_numpy(zero_copy_only=False)
            raw = packed(x + 0.0, lens, kind)  # -0.0 becomes 0.0
            node = [int.from_bytes(hashlib.blake2b(b"%d " % k + v, digest_size=8).digest(), "little", signed=True) if ok else None for k, v, ok in zip(labels.tolist(), raw.to_pylist(), valid.tolist(), strict=True)]
            node = pa.array(node, pa.int64())
            vector = pa.array([v if ok else None for v, ok in zip(raw.to_pylist(), valid.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), label, pa.array(lens, pa.int64()), node, vector], ["id", "label", "dim", "node", "vector"])

    return releasing(run)


class Cells:
    """Pivots (unit vectors) and balls (label, dim and centre), which say where a vector is at home, where it is a guest and in which ball."""

    def __init__(self, pivots: np.ndarray, r: float, balls: list[tuple[int, int, np.ndarray]] = ()):
        self.pivots, self.r, self.balls = pivots, r, list(balls)
        apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
        np.fill_diagonal(apart, 1)
        self.apart = apart
        i, j = np.indices(apart.shape)
        self.takes = (i != j) & np.where((i + j) % 2 == 0, j < i, j > i)  # cell j takes guests of cell i

    def of(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home cell of each unit vector, and where it is a guest (rows by cells)."""
        near = u[:, : self.pivots.shape[1]] @ self.pivots[:, : u.shape[1]].T
        home = near.argmax(axis=1)
        behind = (near[np.arange(len(u)), home][:, None] - near) / self.apart[home]  # distance to the plane between home and each pivot
        return home, (behind <= self.r + SLACK) & self.takes[home]

    def ball(self, u: np.ndarray, labels: np.ndarray, dims: np.ndarray) -> np.ndarray:
        """The first ball that holds each vector, -1 for none."""
        out = np.full(len(u), -1)
        least = 1 - max(0.0, self.r / 2 - 1e-6) ** 2 / 2
        for k, (label, dim, centre) in enumerate(self.balls):
            own = np.flatnonzero((out < 0) & (labels == label) & (dims == dim))
            out[own[u[own, :dim] @ centre[:dim] >= least]] = k
        return out


def fit_cells(sample: list[tuple[int, int, bytes]], n: int, kind: str, least: float, cell_rows: int, max_pivots: int, max_balls: int, copies: float) -> Cells:
    """Cells from a bounded sample of (label, dim, vector) of ``n`` vectors. Pivots are more than r apart; there are as many, doubled each
    time, as leave a vector no more than ``copies`` guest places on average and cells of ``cell_rows`` or more."""
    r = float(np.sqrt(2 - 2 * least))
    u = _unit(unpacked([v for _, _, v in sample], kind))
    pivots: list[int] = []
    most = int(min(max_pivots, max(1, n // cell_rows)))
    for i in range(len(u)):
        if len(pivots) >= most:
            break
        if not pivots or float((u[pivots] @ u[i]).max()) < least:
            pivots.append(i)
    count = best = 1
    while count < len(pivots):
        count = min(2 * count, len(pivots))
        if Cells(u[pivots[:count]], r).of(u[:2000])[1].sum() > copies * min(len(u), 2000):
            break
        best = count
    keys = np.array([(a, b) for a, b, _ in sample], np.int64).reshape(-1, 2)
    centre_of = 1 - max(0.0, r / 2 - 1e-6) ** 2 / 2
    found: list[tuple[int, int, int, np.ndarray]] = []
    for label, dim in np.unique(keys, axis=0).tolist():
        own = np.flatnonzero((keys == (label, dim)).all(axis=1))
        x = u[own, :dim]
        near = np.concatenate([(x[k : k + 1000] @ x.T >= centre_of).sum(axis=1) for k in range(0, len(x), 1000)])
        free = near >= 16
        while free.any() and len(found) < 4 * max_balls:
            at = int(np.where(free, near, 0).argmax())
            inside = (x @ x[at] >= centre_of) & free
            free[at] = False
            if inside.sum() >= 16:
                found.append((int(inside.sum()), label, dim, x[at]))
                free &= ~inside
    found.sort(key=lambda b: -b[0])
    return Cells(u[pivots[:best]] if len(u) else np.zeros((1, 1)), r, [b[1:] for b in found[:max_balls]])


def _placed(cells, kind: str):
    """Each vector at home and in each cell that takes it as a guest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                rows = batch.slice(i, 2000)
                u = _unit(unpacked(rows.column("vector").to_pylist(), kind))
                home, guest = cells.value.of(u)
                ball = cells.value.ball(u, rows.column("label").to_numpy(), rows.column("dim").to_numpy())
                at, cell = np.nonzero(guest)
                at, cell = np.concatenate([np.arange(len(u)), at]), np.concatenate([home, cell])
                is_guest = (np.arange(len(at)) >= len(u)).astype(np.int32)
                columns = [*(rows.column(c).take(pa.array(at)) for c in ("label", "dim", "node", "n", "vector")), pa.array(cell.astype(np.int32)), pa.array(is_guest), pa.array(ball[at].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["label", "dim", "node", "n", "vector", "cell", "guest", "ball"])

    return releasing(run)


def _compared(least: float, kind: str):
    """One block against another, or against itself: for each vector how many it links with, and the first one of those it hangs together with."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("node", kind="stable")
        raw = _scaled(unpacked(g["vector"], kind))
        square = np.einsum("ij,ij->i", raw, raw)
        u = raw / np.sqrt(square)[:, None]
        node, n, guest, ball = (g[c].to_numpy(np.int64) for c in ("node", "n", "guest", "ball"))
        one, two = np.flatnonzero(g["first"].to_numpy(bool)), np.flatnonzero(~g["first"].to_numpy(bool))
        if g["alone"].iloc[0]:
            two = one
        linked, root = np.zeros(len(g), np.int64), np.arange(len(g))
        for k in range(0, len(one), 512):
            rows = one[k : k + 512]
            cosine = u[rows] @ u[two].T
            hit = cosine >= least - SLACK
            i, j = np.nonzero(hit & (cosine < least + SLACK))
            if len(i):
                a, b = rows[i], two[j]
                hit[i, j] = np.einsum("ij,ij->i", raw[a], raw[b]) / (np.sqrt(square[a]) * np.sqrt(square[b])) >= least
            hit &= (guest[rows][:, None] + guest[two] < 2) & ((ball[rows][:, None] != ball[two]) | (ball[two] < 0)) & (node[rows][:, None] != node[two])
            linked[rows] += hit @ n[two]
            if one is not two:
                linked[two] += n[rows] @ hit
            for i in np.flatnonzero(hit.any(axis=1)).tolist():
                met = np.unique(root[np.append(two[hit[i]], rows[i])])
                if len(met) > 1:
                    root[np.isin(root, met)] = met[0]
        own = np.flatnonzero(linked)
        return pd.DataFrame({"node": node[own], "root": node[root[own]], "links": linked[own]})

    return run


def near_vectors(embeddings: DataFrame, least: float = 0.98, block_rows: int = 3_000, cell_rows: int = 1_000, max_pivots: int = 1_024, max_balls: int = 256, copies: float = 3.0, sample_mb: int = 16) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``embeddings`` (vec_id, label, embedding).

    Two rows are linked if their labels are equal and not null and the cosine of their vectors, in double precision, is at least
    ``least`` (over 0, under 1). Vectors that are null, empty or zero or hold a null or a number that is not finite link with nothing, nor do
    vectors of unequal lengths. n_links counts the other rows linked directly, equal rows too; component_id is the smallest vec_id
    that links lead to; kept tells whether it is the row's own. A null vec_id counts as larger than all others and comes out as null.
    Other columns are ignored. Vectors are told apart by 64-bit hashes of label and vector.

    Pivots and balls come from a sample of at most 20,000 vectors and ``sample_mb`` and are broadcast; they decide only how vectors get
    together. Blocks of a cell hold ``block_rows`` vectors. Where vectors are far from any structure, few pivots are taken, as each
    would be close to most planes, and the join comes near to comparing all vectors of a label. A dense group that is wider
    than a ball costs its pairs' comparisons.
    """
    kind = kind_of(embeddings.schema["embedding"])
    own = embeddings.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = written(own.mapInArrow(_nodes(kind), "id long, label long, dim long, node long, vector binary"), "vectors")
    full = rows.filter("node is not null")
    total = full.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("dim"), F.lit(1)).alias("dim")).first()
    bound = max(200, min(20_000, (sample_mb << 20) // (8 * total["dim"])))
    share = min(1.0, 0.9 * bound / max(1, total["n"]))
    picked = full.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["node"])
    sample = [(r["label"], r["dim"], bytes(r["vector"])) for r in picked.select("label", "dim", "vector", "node").limit(bound).collect()]
    sample.sort(key=lambda r: hashlib.md5(r[2]).digest())
    cells = embeddings.sparkSession.sparkContext.broadcast(fit_cells(sample, total["n"], kind, least, cell_rows, max_pivots, max_balls, copies))

    distinct = full.groupBy("node").agg(*(F.first(c).alias(c) for c in ("label", "dim", "vector")), F.count(F.lit(1)).alias("n"))
    key, kinds = ["label", "dim", "cell"], ["guest", "ball"]
    placed = written(distinct.mapInArrow(_placed(cells, kind), "label long, dim long, node long, n long, vector binary, cell int, guest int, ball int"), "vectors-placed")
    counts = placed.groupBy(*key, *kinds).agg(F.count(F.lit(1)).alias("c"))
    counts = counts.groupBy(*key).agg(F.sum("c").alias("c"), F.collect_list(F.struct(*kinds, F.ceil(F.col("c") / block_rows).alias("blocks"))).alias("kinds"))
    # a small cell is one block; in a large one each kind has its own: no block of guests, or of one ball, is compared with itself
    joined = placed.join(counts, key)
    of_kind = F.filter("kinds", lambda k: (k["guest"] == F.col("guest")) & (k["ball"] == F.col("ball")))[0]["blocks"]
    me = F.struct(F.col("guest"), F.col("ball"), F.pmod(F.xxhash64("node"), of_kind).alias("part"))
    others = F.flatten(F.transform(
        F.filter("kinds", lambda k: (k["guest"] + F.col("guest") < 2) & ((k["ball"] != F.col("ball")) | (k["ball"] < 0))),
        lambda k: F.transform(F.sequence(F.lit(0).cast("long"), k["blocks"] - 1), lambda p: F.struct(k["guest"].alias("guest"), k["ball"].alias("ball"), p.alias("part"))),
    ))
    whole = F.struct(F.lit(-1).alias("guest"), F.lit(-1).alias("ball"), F.lit(-1).cast("long").alias("part"))
    small = F.col("c") <= block_rows
    dealt = joined.withColumn("me", F.when(small, whole).otherwise(me)).withColumn("other", F.explode(F.when(small, F.array(whole)).otherwise(others)))
    dealt = dealt.select(*key, F.least("me", "other").alias("one"), F.greatest("me", "other").alias("two"), (F.col("me") <= F.col("other")).alias("first"), (F.col("me") == F.col("other")).alias("alone"), "node", "n", "vector", *kinds)
    found = written(dealt.groupBy(*key, "one", "two").applyInPandas(_compared(least, kind), "node long, root long, links long"), "vector-links")

    home = placed.filter("guest = 0").select("label", "dim", "node", "n", "ball")
    balls = written(home.filter("ball >= 0").groupBy("label", "dim", "ball").agg(F.min("node").alias("root"), F.sum("n").alias("all")), "balls")
    in_ball = home.join(balls, ["label", "dim", "ball"], "left").select("node", F.coalesce("root", "node").alias("root"), (F.coalesce("all", "n") - 1).alias("links"))
    spans = found.select("node", "root").unionByName(in_ball.select("node", "root")).filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    components = connected_components(spans)
    links = found.select("node", "links").unionByName(in_ball.select("node", "links")).groupBy("node").agg(F.sum("links").alias("n_links"))
    ids = rows.filter("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    labelled = written(ids.join(links, "node").join(components, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least", "n_links"), "vector-nodes")
    least_ids = labelled.groupBy("root").agg(F.min("least").alias("component"))
    by_node = written(labelled.join(least_ids, "root").select("node", "n_links", "component"), "vector-components")
    out = rows.select("id", "node").join(by_node, "node", "left").withColumn("component", F.coalesce("component", "id"))
    null = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(null("id").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), null("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))
