from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from graphloom.functions.gtf import attribute
from graphloom.plans import append as appending
from graphloom.plans import construct as constructing
from graphloom.sources.sam import ALIGNMENT

BED = "gene_id string, gene_len long, chrom string, start long, end long, strand string, bed_ord long"


def record(n, query, target, cigar="20M", secondary=False, pos=0, nm=0):
    length = sum(int(x) for x in cigar.replace("M", " ").replace("N", " ").replace("S", " ").split())
    return (n, query, target, False, secondary, False, False, pos, cigar, length, "-", 20, None, nm)


def alignments(spark, rows):
    return spark.createDataFrame([record(i, *r) for i, r in enumerate(rows)], ALIGNMENT)


def sequences(spark, genes):
    return spark.createDataFrame([(g, "ACGTT" * 20) for g in genes], "record_id string, seq string")


def lengths(spark, n):
    return spark.createDataFrame(list(n.items()), "record_id string, seq_len long")


@pytest.fixture(scope="module")
def first(spark):
    aln = alignments(spark, [
        ("RefA.g1.1", "RefA.g1", "8M5N12M"), ("RefA.g1.1", "Q.g1", "8M5N12M"), ("Q.g1.1", "Q.g1"), ("Q.g1.1", "RefA.g1"),
        ("Q.g1.2", "RefA.g1", "8M5N12M"), ("RefA.g2.1", "RefA.g2"), ("Q.g9.1", "RefA.g1", "10M90S"),
    ])
    genes = spark.createDataFrame([("RefA.g1", 100, "A1", 1, 100, "+", 0), ("RefA.g2", 100, "B1", 1, 100, "-", 1), ("Q.g1", 100, "A1", 5, 100, "+", 2), ("Q.g7", 100, "Ctg1", 5, 100, "+", 3), ("X.g1", 100, "A1", 7, 9, "+", 4)], BED)
    n = {"RefA.g1.1": 20, "Q.g1.1": 25, "Q.g1.2": 22, "RefA.g2.1": 20}
    return aln, genes, constructing.construct(aln, genes, lengths(spark, n), sequences(spark, [r[0] for r in genes.collect()]), ["RefA", "Q"])


def test_construct(first):
    _, _, run = first
    assert {tuple(r) for r in run.edges.collect()} == {("RefA.g1", "RefA.g1"), ("RefA.g1", "Q.g1"), ("Q.g1", "Q.g1"), ("Q.g1", "RefA.g1"), ("RefA.g2", "RefA.g2")}
    lines = [r["line"] for r in constructing.cluster_lines(run.clusters.last).orderBy(*constructing.CLUSTER_ORDER).collect()]
    assert lines == ["RefA.g1\tQ.g1", "RefA.g2", "Q.g7"]
    assert {tuple(r) for r in run.names.collect()} == {("RefA.g1", "Pan1A000001"), ("RefA.g2", "Pan1B000001"), ("Q.g7", "PanCtg000001")}
    assert [r["hub"] for r in run.last.missing.collect()] == ["Q.g7"]
    gtf = constructing.official_gtf(run).orderBy("k1", "k2", "k3", "k4", "k5", "k6", "start").select("seqname", "feature", "start", "end", "strand", attribute(F.col("attributes"), "transcript_id").alias("t"))
    assert [tuple(r) for r in gtf.collect()] == [
        ("RefA.g1", "transcript", 1, 25, "+", "Pan1A000001.1"), ("RefA.g1", "exon", 1, 8, "+", "Pan1A000001.1"), ("RefA.g1", "exon", 14, 25, "+", "Pan1A000001.1"),
        ("RefA.g1", "transcript", 1, 20, "+", "Pan1A000001.2"), ("RefA.g1", "exon", 1, 20, "+", "Pan1A000001.2"),
        ("RefA.g2", "transcript", 1, 20, "-", "Pan1B000001.1"), ("RefA.g2", "exon", 1, 20, "-", "Pan1B000001.1"),
    ]
    cdna = {r["transcript_id"]: r["cdna"] for r in run.last.cdna.collect()}
    whole = "ACGTT" * 20
    assert cdna["RefA.g1.1"] == whole[:8] + whole[13:25] and cdna["RefA.g2.1"] == ("ACGTT" * 4)[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_append(spark, first):
    aln, genes, run = first
    history = genes.filter("not startswith(gene_id, 'X')")
    new = spark.createDataFrame([("NV22.g1", 100, "A1", 3, 90, "+", 0), ("NV22.g2", 100, "D1", 3, 90, "+", 1)], BED)
    to_all = alignments(spark, [("NV22.g1.1", "RefA.g1"), ("NV22.g1.1", "NV22.g1")])
    to_new = alignments(spark, [("RefA.g1.1", "NV22.g1")])
    seeds = spark.createDataFrame([("RefA.g1.1", "RefA.g1", 0, [(1, 10), (21, 30)], [(11, 20)]), ("Gone.g1.1", "Gone.g1", 1, [(1, 5)], [])], "transcript_id string, gene_id string, tx_ord long, exons array<struct<start:long,end:long>>, splices array<struct<start:long,end:long>>")
    n = {"RefA.g1.1": 40, "Q.g1.1": 25, "Q.g1.2": 22, "RefA.g2.1": 20, "NV22.g1.1": 20}
    names = [*(r[0] for r in genes.collect()), "NV22.g1", "NV22.g2"]
    args = (run.edges, history, run.filtered, seeds, new, to_all, to_new, lengths(spark, n), sequences(spark, names), ["RefA", "Q"])
    out = appending.append(*args, ["NV22"], "RefA")
    assert out.edges.count() == run.edges.count() + 3
    lines = {r["line"] for r in constructing.cluster_lines(out.clusters.last).collect()}
    assert lines == {"RefA.g1\tNV22.g1\tQ.g1", "RefA.g2", "Q.g7", "NV22.g2"}
    exons = {(r["start"], r["end"]) for r in out.last.gtf.filter("seqname = 'RefA.g1' and feature = 'exon'").collect()}
    assert {(1, 10), (21, 30)} <= exons and "Gone.g1" not in {r["seqname"] for r in out.last.gtf.collect()}
    for bad in (["Q"], ["JM"], ["NV22", "None"], ["RefAB"]):
        if bad != ["JM"]:
            with pytest.raises(ValueError):
                appending.append(*args, bad, "RefA")
    table = {(r["section"], r["metric"]): r["value"] for r in appending.compare(run.edges, out.edges, (run.clusters.pre, run.clusters.last), (out.clusters.pre, out.clusters.last)).collect()}
    assert table["directed_edges", "common"] == 5 and table["last_clusters", "exact"] == 2 and table["reciprocal_pairs", "jaccard"] == 0.5


def test_appended_clusters_are_those_of_all_edges(spark):
    """Random graphs in several blocks: new edges inside, between and outside of blocks, and some blocks untouched."""
    import random

    for seed in (1,):
        rng = random.Random(seed)
        block = lambda k: [f"RefA.b{k}g{i}" for i in range(6)] + [f"Q.b{k}g{i}" for i in range(4)]
        old = [(rng.choice(block(k)), rng.choice(block(k))) for k in range(8) for _ in range(25)]
        fresh = [f"NV22.g{i}" for i in range(6)]
        added = [(rng.choice(fresh), rng.choice(fresh + block(0) + block(1))) for _ in range(15)] + [(rng.choice(block(0) + block(2)), rng.choice(fresh)) for _ in range(10)]
        names = [g for k in range(9) for g in block(k)]
        row = lambda i, g: (g, 100 + i % 7, rng.choice(["A1", "B2", "Ctg1"]), i % 11, i % 11 + 50, "+", i)
        stored = spark.createDataFrame([row(i, g) for i, g in enumerate(names)], BED)
        all_ = stored.unionByName(spark.createDataFrame([row(500 + i, g) for i, g in enumerate(fresh)], BED))
        edges = lambda x: spark.createDataFrame(sorted(set(x)), "src string, dst string")
        history = constructing.derive_clusters(edges(old), stored, stored.select("gene_id"), ["RefA", "Q"], "RefA")
        new = edges(set(added) - set(old))
        rows = lambda c: [sorted(map(tuple, t.select(sorted(t.columns)).collect())) for t in (c.pre, c.last, c.blocks)]
        got = appending.grown_clusters(history, edges(old), new, all_, all_.select("gene_id"), ["RefA", "Q", "NV22"], "RefA")
        assert rows(got) == rows(constructing.derive_clusters(edges(old + added), all_, all_.select("gene_id"), ["RefA", "Q", "NV22"], "RefA"))


def test_two_appends_keep_record_order(spark):
    """Records of three runs, with equal and with very large numbers, follow one another as one construct would have them."""
    from graphloom.operators import alignment

    table = lambda tag, base, n=5: spark.createDataFrame([(base + i, *record(0, f"{tag}{i}.1", "RefA.g1")[1:]) for i in reversed(range(n))], ALIGNMENT)
    first = table("a", 2**60)
    for tags in ("bc", "de"):
        first = alignment.in_one_order([first, *(table(t, 7) for t in tags)])
    got = [(r["rec_ord"], r["query_id"]) for r in first.orderBy("rec_ord").collect()]
    assert got == [(5 * k + i, f"{t}{i}.1") for k, t in enumerate("abcde") for i in range(5)] and "part" not in first.columns


def test_many_alignment_inputs(spark):
    """129 tables with equal record numbers stay in the order given."""
    from graphloom.operators import alignment

    targets = spark.createDataFrame([("RefA.g1", 100)], "name string, length long")
    part = lambda k: spark.createDataFrame([record(i, f"t{k:03d}x{i}.1", "RefA.g1") for i in (1, 0)], ALIGNMENT)
    rows = alignment.in_one_order([alignment.merged([(part(k), targets) for k in range(129)], targets)])
    assert [r["query_id"] for r in rows.orderBy("rec_ord").collect()] == [f"t{k:03d}x{i}.1" for k in range(129) for i in range(2)]


def test_realigned_models_fill_missing_hubs(spark, first):
    _, genes, run = first
    clusters = run.clusters.last
    seen = []

    def realign(members):
        seen.extend(sorted(r["hub"] for r in members.select("hub").distinct().collect()))
        return alignments(spark, [("Q.g7.1", "Q.g7")]).withColumns({"mlen": F.lit(20), "aln_len": F.lit(20), "soft": F.lit(0)})

    models = constructing.transcript_models(run.filtered, clusters, genes, lengths(spark, {"Q.g7.1": 20, "RefA.g1.1": 20, "Q.g1.1": 25, "Q.g1.2": 22, "RefA.g2.1": 20}), sequences(spark, [r[0] for r in genes.collect()]), realign=realign)
    assert seen == ["Q.g7"] and models.missing.count() == 0 and models.gtf.filter("seqname = 'Q.g7'").count() == 2


def test_edges_grow_by_batches(spark, tmp_path):
    """Files of alignments that come one after the other, with edges in common; a second start finds only what is new."""
    from graphloom import streaming

    genes = spark.createDataFrame([("RefA.g1",), ("Q.g1",)], "gene_id string")
    inbox, table = str(tmp_path / "in"), str(tmp_path / "edges")
    put = lambda rows: alignments(spark, rows).coalesce(1).write.mode("append").parquet(inbox)
    put([("RefA.g1.1", "RefA.g1"), ("RefA.g1.2", "Q.g1"), ("RefA.g1.3", "Q.g1")])
    put([("Q.g1.1", "RefA.g1"), ("RefA.g1.2", "Q.g1"), ("X.g1.1", "Y.g1")])

    def grow():
        stream = spark.readStream.schema(ALIGNMENT).option("maxFilesPerTrigger", 1).parquet(inbox)
        query = streaming.grow_edges(stream, genes, table, str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        return sorted(map(tuple, spark.read.parquet(table).collect()))

    assert grow() == [("Q.g1", "RefA.g1"), ("RefA.g1", "Q.g1"), ("RefA.g1", "RefA.g1")]
    put([("Q.g1.9", "Q.g1"), ("Q.g1.1", "RefA.g1")])
    assert grow() == [("Q.g1", "Q.g1"), ("Q.g1", "RefA.g1"), ("RefA.g1", "Q.g1"), ("RefA.g1", "RefA.g1")]


def test_no_rows_without_length_or_strand(spark):
    from graphloom.operators import transcripts

    exon = "array<struct<start:long,end:long>>"
    reps = spark.createDataFrame([(h, 1, h + ".1", [(1, 900)]) for h in ("a", "b", "c")], f"hub string, group_no int, transcript_id string, exons {exon}")
    genes = spark.createDataFrame([("a", 100, "+"), ("b", None, "+"), ("c", 100, None)], "gene_id string, gene_len long, strand string")
    assert {(r["seqname"], r["feature"], r["end"]) for r in transcripts.gtf_rows(reps, genes).collect()} == {("a", "transcript", 100), ("a", "exon", 100)}


def test_genes_stay_in_bed_order(spark):
    history = spark.createDataFrame([("a", 1, "A1", 1, 2, "+", 0), ("b", 1, "A1", 1, 2, "+", 3)], BED)
    query = spark.createDataFrame([("c", 1, "A1", 1, 2, "+", 0), ("d", 1, "A1", 1, 2, "+", 1)], BED)
    assert [(r["gene_id"], r["bed_ord"]) for r in appending.all_genes(history, query).orderBy("bed_ord").collect()] == [("a", 0), ("b", 3), ("c", 4), ("d", 5)]


def test_stored_transcripts_are_checked(spark):
    models = spark.createDataFrame([("a.1",), ("b.1",)], "transcript_id string")
    genes = spark.createDataFrame([("a",), ("b",)], "gene_id string")
    records = lambda *ids: spark.createDataFrame([(i,) for i in ids], "record_id string")
    appending.check_history(models, records("a.1", "b.1"), genes)
    for other, known in ((records("a.1"), genes), (records("a.1", "b.1", "a.2"), genes), (records("a.1", "b.1"), genes.filter("gene_id = 'a'"))):
        with pytest.raises(ValueError, match="do not fit"):
            appending.check_history(models, other, known)
    with pytest.raises(ValueError, match="renamed"):
        pan = spark.createDataFrame([("Pan1A000001.1",)], "transcript_id string")
        appending.check_history(pan, records("Pan1A000001.1"), spark.createDataFrame([("Pan1A000001",)], "gene_id string"))
