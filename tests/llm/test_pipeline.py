"""The pipeline's stages on small documents, and the registered queries against SQL."""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from graphloom.llm import queries
from graphloom.llm.common import new_path, written

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_sql(spark, sf_dir, name):
    got = queries.queries()[name](spark, sf_dir)
    columns = sorted(got.columns)
    con = duckdb.connect()
    for t in TABLES:
        at = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{at}{'/*.parquet' if os.path.isdir(at) else ''}'")
    want = con.execute(f"select {', '.join(columns)} from ({queries.oracle_sql()[name]})").fetchall()
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, sf_dir), "test-stage")
        assert out.columns == docs.columns
        assert out.join(docs, [F_eq(out, docs)], "left_anti").count() == 0  # whole rows of the input
        seen[name] = (docs.count(), out.count())
        docs = out
    assert seen["toxicity"][1] < seen["toxicity"][0] and seen["near_dedup"][1] < seen["near_dedup"][0]
    assert seen["decontamination"][1] <= seen["decontamination"][0] < 1.2 * seen["decontamination"][1]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert Counter(r["doc_id"] for r in last.collect()) == Counter(r["doc_id"] for r in docs.collect())


def test_near_copies_with_one_id(spark, sf_dir):
    words = [f"w{i}" for i in range(200)]
    near = [" ".join([*words, *(f"end{k}{j}" for j in range(3))]) for k in range(5)]
    rows = [(None, near[0]), (None, near[1]), (None, near[1]), (None, near[2])]
    other = [(t or "").replace("w", "v") for _, t in rows]
    rows += [(7, t) for t in other] + [(8, near[3].replace("w", "u")), (8, near[4].replace("w", "x")), (9, near[4].replace("w", "u")), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], (r["text"] or " ")[0]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect())
    assert got == {(None, "w"): 1, (7, "v"): 1, (8, "u"): 1, (8, "x"): 1, (None, " "): got[None, " "]} and got[None, " "] >= 1


def F_eq(a, b):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & a["text"].eqNullSafe(b["text"])


WORDS = [f"w{i}" for i in range(400)]
#: Names that the operators use for their own columns.
CLASHING = ["score", "predicted", "size", "target", "copies", "__text", "tie", "__id", "n_tokens", "kept"]


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Copies and near copies, passages of the benchmark, insults, nulls, empty texts, repeated rows and clashing columns."""
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    item = prose(40)
    rows = [(i, prose(60 + i % 7)) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " tail") for i in range(10)] + [(200 + i, rows[i][1]) for i in range(5)]
    cut = item.split()
    rows += [(300, f"{prose(20)} {item} {prose(20)}"), (301, " ".join([*cut[20:], *cut[:20]])), (302, " ".join(cut[:15])), (303, item.upper())]
    rows += [(400 + i, f"{prose(9)} you zorkish zork {prose(9)}, zork") for i in range(6)]
    rows += [(None, None), (None, ""), (1, None), (2, ""), (3, " \n "), (4, prose(50)), (4, prose(50)), (5, rows[5][1]), (5, rows[5][1]), (None, prose(30)), (500, prose(4000))]
    full = [(d, t, ["b", "a", None, "c"][i % 4], *(f"{c}{i}" for c in CLASHING)) for i, (d, t) in enumerate(rows)]
    full += full[3:5]
    at = new_path(spark, "odd-docs").removeprefix("file://")
    os.makedirs(at)
    spark.createDataFrame([(0, item), (1, None), (2, ""), (3, "too short")], "item_id long, text string").write.parquet(f"file://{at}/benchmark.parquet")
    train = [(i, 1) for i in range(400, 406)] + [(i, 0) for i in range(60)] + [(None, 1), (7, None)]
    spark.createDataFrame(train, "doc_id long, toxic int").write.parquet(f"file://{at}/labels.parquet")
    schema = ", ".join(["doc_id long", "text string", "source string", *(f"{c} string" for c in CLASHING)])
    return written(spark.createDataFrame(full, schema), "odd"), full, f"file://{at}"


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_toxic_stage(spark, odd_docs):
    from graphloom.llm import toxicity

    docs, rows, at = odd_docs
    model = toxicity.train(docs.select("doc_id", "text"), spark.read.parquet(f"{at}/labels.parquet"))
    bad = [float(model.scores(np.array([model.features(r[1])]))[0]) >= 0.3 for r in rows]
    assert rows_of(corpus_pipeline.drop_toxic(spark, docs, at)) == Counter(r for r, b in zip(rows, bad, strict=True) if not b)
    assert corpus_pipeline.drop_toxic(spark, docs.limit(0), at).collect() == []


def test_near_dedup_stage(spark, odd_docs):
    docs, rows, at = odd_docs
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for w in (low(r[1]) for r in rows)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    got = corpus_pipeline.drop_near_duplicates(spark, docs, at).collect()
    assert Counter(map(tuple, got)) <= Counter(rows) and got[0].__fields__ == docs.columns
    key = lambda d: 2**63 if d is None else d
    least: dict = {}
    for r, g, s in zip(rows, group, sets, strict=True):
        if s:
            least[g] = min(least.get(g, key(None)), key(r[0]))
    of = {}
    for r, g, s in zip(rows, group, sets, strict=True):
        of.setdefault((r[0], r[1]), (g, bool(s)))
    seen = Counter(of[r[0], r[1]][0] for r in got if of[r[0], r[1]][1])
    assert set(seen.values()) == {1} and set(seen) == set(least)  # one of each group
    assert all(key(r[0]) == least[of[r[0], r[1]][0]] for r in got if of[r[0], r[1]][1])  # with its least id
    assert {(r[0], r[1]) for r in got if not of[r[0], r[1]][1]} == {k for k, (_, s) in of.items() if not s}
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), at).collect() == []


def test_leak_stage(spark, odd_docs):
    from test_text_operators import naive_tiles

    docs, rows, at = odd_docs
    item = rows[78][1].lower().split()
    assert rows[78][0] == 303
    words = lambda t: (t or "").lower().replace(",", " ").split()
    near = [r for r in rows if set(words(r[1])) & set(item)]
    leaks = {r[1] for r in near if len(words(r[1])) < 500 and sum(naive_tiles(item, words(r[1]), 5)) >= 0.6 * len(item)}
    assert rows_of(corpus_pipeline.drop_benchmark_leaks(spark, docs, at)) == Counter(r for r in rows if r[1] not in leaks) and len(leaks) == 3
    assert corpus_pipeline.drop_benchmark_leaks(spark, docs.limit(0), at).collect() == []


def test_mixing_stage(spark, odd_docs):
    docs, rows, at = odd_docs
    size = lambda t: len((t or "").split())
    got = rows_of(corpus_pipeline.mix_sources(spark, docs, at))
    assert set(got) <= set(rows) and rows_of(corpus_pipeline.mix_sources(spark, docs, at)) == got
    have = Counter(rows)
    assert all(n <= 2 * have[r] for r, n in got.items()) and not any(size(r[1]) == 0 for r in got)
    weights, sources = dict(zip(["a", "b", "c", None], [3, 1, 2, 3], strict=True)), ["a", "b", "c", None]
    words = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in sources}
    target, open_, left = {}, set(sources), 1.5 * sum(words.values())
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * unit >= 2 * words[s]}
        for s in full or open_:
            target[s] = 2 * words[s] if full else weights[s] * unit
            left -= target[s]
        open_ -= full or set(open_)
    for s in sources:
        taken = sum(n * size(r[1]) for r, n in got.items() if r[2] == s)
        assert abs(taken - target[s]) <= 80, (s, taken, target[s])
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), at).collect() == []


def test_token_stage(spark, odd_docs):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    docs, rows, at = odd_docs
    encode = Tokenizer.from_file(public.path("byte_bpe_50k.json")).encode
    got = corpus_pipeline.write_token_ids(spark, docs, at).collect()
    crc = lambda t: zlib.crc32(np.array([*encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == Counter((r[0], crc(r[1])) for r in rows)
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False)) and starts[0][0] == 0
    assert corpus_pipeline.write_token_ids(spark, docs.limit(0), at).collect() == []
