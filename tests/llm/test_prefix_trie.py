"""The trie of conversations against a plain one."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from graphloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n_leaves string, depth long"


def trie_brute(rows):
    own: dict = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5)), [])[:h] + turns[h:]
    members: dict = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children: dict = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=lambda p: -len(p)):
        below = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in below) or 1
        saved[p] = sum(saved[x] for x in below) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    ends = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(members[p]) if len(built[c]) == len(p)).encode()).hexdigest()
    return Counter((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children.get(p, [])), leaves[p], saved[p], ends(p)) for p in members)


def talks(seed=2):
    """Shared openings, copies, long talks, ties, nulls and empty texts."""
    rng = random.Random(seed)
    texts = ["", None, "é", "yes", "no", "a longer turn", "x" * 3000]
    rows = []
    for c in [*range(120), -1, -7, -10, 10**15, 10**15 + 3]:
        n = rng.choice([1, 1, 2, 4, 9, 12, 20])
        start = rng.randrange(3)
        for t in range(n):
            text = f"opening {start} {t}" if t < 7 and rng.random() < 0.9 else rng.choice(texts)
            rows.append((c, t, ["user", "assistant"][t % 2], text, "x", 5))
    for c in range(200, 260):  # copies
        rows += [(c, t, "user", f"copy {t}", "x", 5) for t in range(10)]
    rows += [(300, t, "user", f"long {t % 3}", "x", 5) for t in range(150)] + [(301, t, "user", f"long {t % 3}", "x", 5) for t in range(140)]
    rows += [(303, None, "user", "first", "x", 5), (303, 1, None, "b", "x", 5), (303, 1, "", "a", "x", 5), (303, 1, None, None, "x", 5), (303, 1, None, "b", "x", 5)]
    rows += [(None, 1, "user", "lost", "x", 5), (305, -3, None, None, "x", 5)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [{}, {"limit": 5, "stratum": 64, "shard_turns": 100}])
def test_trie(spark, limits):
    rows = talks()
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), **limits)
    assert Counter(map(tuple, got.collect())) == trie_brute(rows)


def test_trie_of_little(spark):
    df = spark.createDataFrame([(1, 0, "a", "b", "x", 5)], SCHEMA)
    assert prefix_trie.prefix_trie(df.limit(0)).collect() == []
    assert prefix_trie.prefix_trie(df.selectExpr("cast(null as long) conv_id", "turn", "role", "text")).collect() == []
    turnless = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9)  # one own turn, and no base to lend it others
    only = [(turnless, 0, "a", "b", "x", 5)]
    got = prefix_trie.prefix_trie(spark.createDataFrame(only, SCHEMA)).collect()
    assert Counter(map(tuple, got)) == trie_brute(only) and len(got) == 1


def test_places_across_partitions(spark):
    """One conversation over all partitions of the sorted turns."""
    rows = [(7, t, "user", f"t{t}", "x", 5) for t in range(3000)] + [(c, 0, "user", "t", "x", 5) for c in (6, 8)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    key = lambda t: hashlib.md5(f"4:usert{t}".encode()).hexdigest()
    assert {(r["pos"], r["key"]) for r in turns if r["conv_id"] == 7} == {(t, key(t)) for t in range(3000)} and len(turns) == 3002
