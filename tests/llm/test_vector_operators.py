"""Operators on embeddings against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from graphloom.llm import embedding_dedup, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, n_links string, node int"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def near_brute(rows, least):
    top = 2**63 - 1
    n, parent, ids = [0] * len(rows), list(range(len(rows))), [top if r[0] is None else r[0] for r in rows]

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if a[2] is None or a[2] != b[2] or not usable(a[1]) or not usable(b[1]) or len(a[1]) != len(b[1]):
                continue
            dot, x, y = (sum(p * q for p, q in zip(u, v, strict=True)) for u, v in ((a[1], b[1]), (a[1], a[1]), (b[1], b[1])))
            if dot / (math.sqrt(x) * math.sqrt(y)) >= least:
                n[i] += 1
                n[j] += 1
                parent[root(i)] = root(j)
    best: dict = {}
    for i, k in enumerate(ids):
        best[root(i)] = min(best.get(root(i), top), k)
    null = lambda x: None if x == top else x
    return Counter((null(k), n[i], null(best[root(i)]), k == best[root(i)]) for i, k in enumerate(ids))


def vectors(seed=4, dim=12):
    """Random ones, dense groups inside and wider than a ball, chains, copies, multiples, cosines of exactly 0.98, and odd rows."""
    rng = np.random.default_rng(seed)
    out = []
    add = lambda v, label: out.append((len(out), None if v is None else [None if x is None else float(x) for x in v], label))
    for _ in range(150):
        add(rng.normal(size=dim), int(rng.integers(3)))
    for spread, count in ((0.01, 60), (0.06, 60), (0.12, 40)):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(count):
            add(centre + spread * rng.normal(size=dim) / math.sqrt(dim) * 2, 1)
    for k in range(40):  # each is linked with its neighbours only
        add([math.cos(0.15 * k), math.sin(0.15 * k)] + [0] * (dim - 2), 2)
    for k in (1, 5, 5, 7):
        add(out[k][1], out[k][2])
        add(np.array(out[k][1]) * 1e200, out[k][2])
    add([1, 0, 0, 0] + [0] * (dim - 4), 7)
    add([49, 9, 3, 3] + [0] * (dim - 4), 7)
    for v in (None, [], [0] * dim, [None] * dim, [float("nan")] * dim, [float("inf")] + [1] * (dim - 1), [1] * 3, [1] * 3):
        add(v, 1)
    add(out[3][1], None)
    out += [(None, out[8][1], out[8][2]), (None, [1.0] * dim, 5), (3, out[3][1], out[3][2]), (3, [2.0] * dim, 6), (-4, out[9][1], out[9][2])]
    return [(*r, "x", 1) for r in out]


@pytest.mark.parametrize("limits", [{}, {"cell_rows": 20, "block_rows": 15, "copies": 50.0}, {"cell_rows": 10**6, "block_rows": 25}, {"max_balls": 0, "cell_rows": 40, "block_rows": 10}])
def test_near_vectors(spark, limits):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    got = embedding_dedup.near_vectors(df, **limits)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    scaled = [(r[0], [x / 1e200 if x is not None and abs(x) > 1e100 and math.isfinite(x) else x for x in r[1]] if r[1] is not None else None, r[2]) for r in rows]
    assert Counter(map(tuple, got.collect())) == near_brute(scaled, 0.98)


def test_near_vectors_of_nothing(spark):
    df = spark.createDataFrame(vectors()[:3], SCHEMA)
    assert embedding_dedup.near_vectors(df.limit(0)).collect() == []
    assert embedding_dedup.near_vectors(df.selectExpr("vec_id", "cast(null as array<float>) embedding", "label")).count() == 3


def test_guests_meet_every_near_pair():
    """Of each pair within r across two cells one is a guest in the other's cell, and few others are."""
    rng = np.random.default_rng(1)
    u = embedding_dedup._unit(rng.normal(size=(400, 6)))
    v = embedding_dedup._unit(u + 0.03 * rng.normal(size=u.shape))
    r = math.sqrt(2 - 2 * 0.98)
    cells = embedding_dedup.Cells(u[:8], r)
    (a, ga), (b, gb) = cells.of(u), cells.of(v)
    near = np.linalg.norm(u - v, axis=1) <= r
    across = near & (a != b)
    assert across.sum() > 10
    for k in np.flatnonzero(across):
        assert ga[k, b[k]] != gb[k, a[k]]
    assert ga.sum() < 0.8 * ga.size / 2


def hard_brute(rows, positives=5, negatives=10, low=30, high=90, every=10):
    top, part = 2**63 - 1, []
    for vec_id, v, label, *_ in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(256 * x) for x in v]
            if math.isfinite(sum(float(x) * float(x) for x in q)):
                part.append((top if vec_id is None else vec_id, label, tuple(q)))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    null = lambda x: None if x == top else x
    out = Counter()
    for i, label, a in sorted({p for p in part if p[0] != top and p[0] % every == 0}):
        scored = sorted((-score(a, q), j, m) for j, m, q in part)
        near = [(-s, j) for s, j, m in scored if m == label and j != i][:positives]
        for p, j in near:
            hard = [(-s, k) for s, k, m in scored if m != label and low * p <= 100 * -s <= high * p][:negatives]
            out.update((i, null(j), r, null(k), p, s) for r, (s, k) in enumerate(hard, 1))
    return out


@pytest.mark.parametrize("limits", [{}, {"leaf_rows": 20, "block_anchors": 7, "part_mb": 0}, {"leaf_rows": 30, "sample_mb": 0}])
def test_hard_negatives(spark, limits):
    rows = [r for r in vectors() if r[1] is None or all(x is None or not 1e9 < abs(x) < math.inf for x in r[1])]
    rows += [(10, rows[10][1], rows[10][2], "x", 1), (11, rows[10][1], rows[10][2], "x", 1), (None, rows[10][1], rows[10][2], "x", 1), (20, [0.0] * 12, 1, "x", 1), (9999, [1e300] * 12, 1, "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **limits)
    want = hard_brute(rows)
    assert Counter(map(tuple, got.collect())) == want and len(want) > 500


def test_hard_negatives_beyond_doubles(spark):
    """Scores over 2^53 are exact, too."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(v) for v in rng.integers(-(2**22), 2**22, 6) + rng.integers(0, 256, 6) / 256], int(rng.integers(3)), "x", 1) for i in range(80)]
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, leaf_rows=10)
    assert Counter(map(tuple, got.collect())) == hard_brute(rows)


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame(vectors()[:3], SCHEMA)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives.hard_negatives(df, F.lit(None).cast("boolean")).collect() == []
    assert hard_negatives.hard_negatives(df.withColumn("label", F.lit(None).cast("int")), F.lit(True)).collect() == []


def test_tree_rules_subtrees_out_and_loses_none():
    """On rows in groups a search with narrow annuli visits few leaves, and all that hold a row in its annulus."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 8)) * 10
    x = np.concatenate([c + 0.1 * rng.normal(size=(60, 8)) for c in centres])
    tree = hard_negatives.Gnat(x[rng.permutation(len(x))[:600]], len(x), 80)
    leaf = tree.route(x)
    queries = x[::50] + 0.01
    far = np.full(len(queries), 1.0)
    query, found = tree.search(queries, np.zeros(len(queries)), far)
    visited = set(zip(query.tolist(), found.tolist(), strict=True))
    for k, q in enumerate(queries):
        for i in np.flatnonzero(np.linalg.norm(x - q, axis=1) <= 1.0):
            assert (k, int(leaf[i])) in visited
    assert len(visited) < 0.25 * len(queries) * tree.leaves


@pytest.mark.parametrize("block_links", [500_000, 40])
def test_components(spark, block_links):
    """Random links, chains, loops and repeats, in one block and in many, against plain union-find."""
    from graphloom.llm.components import connected_components

    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(-300, 300, (260, 2))] + [(k, k + 1) for k in range(1000, 1200)] + [(7, 7), (5000, 5000), (1003, 1001)]
    parent: dict = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links, "a long, b long").repartition(16)
    got = connected_components(df, block_links).collect()
    assert {r["node"]: r["root"] for r in got} == {i: root(i) for i in list(parent)} and len(got) == len(parent)
    assert connected_components(df.limit(0), block_links).collect() == []
