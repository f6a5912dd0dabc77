from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.functions import cigar, gtf, ids, sequence


def column(spark, c, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
    return [r["x"] for r in df.select("i", c(F.col("v")).alias("x")).orderBy("i").collect()]


def test_ids(spark):
    assert column(spark, ids.gene_of, ["a.b.1", "a", "", ".1", None]) == ["a.b", "a", "", "", None]
    assert column(spark, ids.grouping_gene_of, ["a.b.1", "a"]) == ["a.b", ""]
    assert column(spark, ids.chrom_label, ["A1", "1A", "chr1A", " D7 ", "E1", "A10", ""]) == ["1A", "1A", "Ctg", "7D", "Ctg", "Ctg", "Ctg"]
    assert column(spark, ids.main_rank, ["A1", "D7", "B2", "x"]) == [0, 20, 8, None]
    v = lambda c: ids.variety_of(c, ["Q", "QR", "Refer"])
    assert column(spark, v, ["QR.g1", "Z", "Refer1"]) == ["Q", None, "Refer"]
    r = lambda c: ids.variety_of(c, ["Q", "Refer"], ["RefA"])
    assert column(spark, r, ["RefA.g1", "Q1", "Refer1"]) == ["Refer", "Q", None]


def test_pan_order(spark):
    names = ["PanCtg000002", "Pan2A000001", "Pan1B000001", "Pan1A000010", "Pan1A000002", "PanX", "other", "PanCtg000010"]
    df = spark.createDataFrame([(n,) for n in names], "g string")
    assert [r["g"] for r in df.orderBy(*ids.pan_order(F.col("g"))).collect()] == ["Pan1A000002", "Pan1A000010", "Pan1B000001", "Pan2A000001", "PanCtg000002", "PanCtg000010", "PanX", "other"]


OPS = st.lists(st.tuples(st.integers(0, 30), st.sampled_from("MIDNSHP=X")), max_size=8)


def walk(pos, ops):
    exons, splices, start = [], [], pos
    for n, op in ops:
        if op == "N":
            if pos > start:
                exons.append((start + 1, pos))
            splices.append((pos + 1, pos + n))
            pos += n
            start = pos
        elif op in "MD=X":
            pos += n
    return exons + ([(start + 1, pos)] if pos > start else []), splices


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), OPS), min_size=1, max_size=20))
def test_cigars(spark, cases):
    df = spark.createDataFrame([(i, p, "".join(f"{n}{o}" for n, o in ops) or "*") for i, (p, ops) in enumerate(cases)], "i long, p long, c string")
    ops = cigar.cigar_ops(F.col("c"))
    rows = df.select("i", cigar.exons_and_splices(F.col("p"), ops).alias("m"), cigar.matched(ops).alias("a"), cigar.aligned(ops).alias("b"), cigar.soft_clipped(ops).alias("s")).orderBy("i").collect()
    for r, (p, own) in zip(rows, cases, strict=True):
        exons, splices = walk(p, own)
        assert [tuple(x) for x in r["m"]["exons"]] == exons and [tuple(x) for x in r["m"]["splices"]] == splices
        total = lambda letters: sum(n for n, o in own if o in letters)  # noqa: E731, B023
        assert (r["a"], r["b"], r["s"]) == (total("M=XI"), total("M=XID"), total("S"))


def test_fixture_cigar(spark):
    df = spark.createDataFrame([("8M5N12M",)], "c string")
    m = df.select(cigar.exons_and_splices(F.lit(0), cigar.cigar_ops(F.col("c"))).alias("m")).first()["m"]
    assert [tuple(x) for x in m["exons"]] == [(1, 8), (14, 25)] and [tuple(x) for x in m["splices"]] == [(9, 13)]


def test_attributes(spark):
    text = 'transcript_id "a.1"; gene_id "a"; note "keep this"; gene_id "b";'
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(gtf.attribute(F.col("t"), "gene_id").alias("g"), gtf.attribute(F.col("t"), "none").alias("n"), gtf.attribute_map(F.col("t")).alias("m")).first()
    assert (r["g"], r["n"]) == ("b", None) and r["m"] == {"transcript_id": "a.1", "gene_id": "b", "note": "keep this"}
    new = df.select(gtf.replace_attributes(F.col("t"), {"transcript_id": F.lit("P.1")}).alias("x")).first()["x"]
    assert new == 'transcript_id "P.1"; gene_id "a"; note "keep this"; gene_id "b";'


def test_sequences(spark):
    assert column(spark, sequence.reverse_complement, ["ACGTUN", "acRYKMBVDH", ""]) == ["NAACGT", "DHBVKMRYgt", ""]
    texts = ["x" * n for n in (0, 1, 59, 60, 61, 120, 125)]
    assert column(spark, sequence.wrap, texts) == ["\n".join(re.findall(".{1,60}", t)) for t in texts]
    df = spark.createDataFrame([("ACGTACGT", [(2, 3), (6, 8)])], "s string, e array<struct<start:long,end:long>>")
    assert df.select(sequence.spliced(F.col("s"), F.col("e")).alias("x")).first()["x"] == "CGCGT"


def test_places_in_an_order(spark):
    """Ranks over ranges against a sorted list: all rows, groups, a null group, ties and an empty table."""
    from graphloom.operators.ranks import numbered

    rows = [(i, "big" if i % 3 else (None if i % 2 else "b"), (i * 7919) % 503) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, g string, k int").repartition(6)
    got = numbered(df, "place", [F.col("k").desc(), "i"]).collect()
    assert [r["i"] for r in sorted(got, key=lambda r: r["place"])] == [r[0] for r in sorted(rows, key=lambda r: (-r[2], r[0]))]
    assert sorted(r["place"] for r in got) == list(range(900))
    for r in numbered(df, "place", ["k", "i"], "g").collect():
        assert r["place"] == sum(x[1] == r["g"] and (x[2], x[0]) < (r["k"], r["i"]) for x in rows)
    assert numbered(df.limit(0), "place", ["k"], "g").collect() == []


def test_patterns_in_patterns(spark):
    """The splice indexes against text search over all pairs, with splices that are parts of others as text."""
    import random

    from graphloom.operators import transcripts

    rng = random.Random(6)
    points = [1, 11, 20, 120, 30, 300, 3000, 41, 410]
    rows, seen = [], set()
    for hub in "ab":
        for _ in range(150):
            k = rng.randrange(0, 6)
            pattern = ":".join(f"{rng.choice(points)}-{rng.choice(points)}" for _ in range(k)) or "mono"
            if k > 2 and rng.random() < 0.6:  # a piece of another one
                other = rng.choice([p for h, p, _ in rows if h == hub] or [pattern])
                cut = other.split(":")
                at = rng.randrange(len(cut))
                pattern = ":".join(cut[at : at + rng.randrange(1, 5)])
            if (hub, pattern) not in seen:
                seen.add((hub, pattern))
                rows.append((hub, pattern, len(rows)))
    df = spark.createDataFrame(rows, "hub string, pattern string, seen int")
    want = {}
    for hub, p, _ in rows:
        want[hub, p] = min(((-len(r), s, r) for h, r, s in rows if h == hub and p in r))[2]
    got = transcripts.containing_patterns(df).collect()
    assert {(r["hub"], r["pattern"]): r["rep_pattern"] for r in got} == want and len(got) == len(rows)
    # a hub of many patterns with exons in common gives few candidates
    many = [("h", ":".join(f"{100 * e + rng.randrange(40)}-{100 * e + 60 + rng.randrange(40)}" for e in range(rng.randrange(1, 4), rng.randrange(6, 9))), i) for i in range(4000)]
    patterns = spark.createDataFrame(many, "hub string, pattern string, seen int").dropDuplicates(["pattern"])
    assert transcripts.rare_joint_pairs(patterns).count() < 10 * patterns.count()


def test_scratch_tables_go_when_told(spark, monkeypatch):
    """In a folder of its own, so that tables of other tests stay."""
    from pyspark.errors import AnalysisException

    from graphloom.sources import shared

    own = shared.scratch_dir(spark) + "-some"
    monkeypatch.setattr(shared, "scratch_dir", lambda _: own)
    rows = shared.written(spark.range(5).toDF("i"), "some")
    assert rows.count() == 5
    shared.clear_scratch(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(own)
