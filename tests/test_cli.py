"""The command line over small files: construct, append with its checks, compare, export."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from graphloom import cli
from graphloom.operators import alignment, relations
from graphloom.sources import package, sam

RNG = random.Random(3)
PROGRAM = "@PG\tID:m\tPN:mapper\tVN:2.28\tCL:mapper -ax splice -t 8 --secondary=yes genes.fa reads.fa\n"


def letters(n):
    return "".join(RNG.choice("ACGT") for _ in range(n))


GENES = {g: letters(100) for g in ("RefA.g1", "RefA.g2", "Q.g1", "NV.g1")}
READS = {f"{g}.1": s[:40] for g, s in GENES.items()}


def fasta_text(records):
    return "".join(f">{k}\n{v}\n" for k, v in records.items())


def sam_text(targets, rows, program=PROGRAM, extra=""):
    head = "@HD\tVN:1.6\n" + "".join(f"@SQ\tSN:{t}\tLN:{len(GENES[t])}\n" for t in targets) + program + extra
    return head + "".join(f"{q}\t0\t{t}\t1\t60\t40M\t*\t0\t0\t{READS[q]}\t*\tAS:i:40\tNM:i:0\n" for q, t in rows)


def gtf_text(transcripts):
    attributes = lambda t: f'transcript_id "{t}"; gene_id "{t[:-2]}";'
    return "".join(f"{t[:-2]}\tx\t{kind}\t1\t40\t.\t+\t.\t{attributes(t)}\n" for t in transcripts for kind in ("transcript", "exon"))


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    at = tmp_path_factory.mktemp("cli")

    def put(name, text):
        (at / name).write_text(text)
        return str(at / name)

    history = ["RefA.g1", "RefA.g2", "Q.g1"]
    of = lambda genes: {f"{g}.1": READS[f"{g}.1"] for g in genes}
    bed_line = lambda n, g: f"A1\t{10 * n}\t{10 * n + 100}\t{g}\t0\t+\n"
    put("cdna.fa", fasta_text(of(history)))
    put("gdna.fa", fasta_text({g: GENES[g] for g in history}))
    put("all.bed", "".join(bed_line(n, g) for n, g in enumerate(history)))
    put("raw.sam", sam_text(history, [("RefA.g1.1", "RefA.g1"), ("RefA.g1.1", "Q.g1"), ("Q.g1.1", "RefA.g1"), ("Q.g1.1", "Q.g1"), ("RefA.g2.1", "RefA.g2")]))
    put("history.gtf", gtf_text(of(history)))
    put("new_cdna.fa", fasta_text(of(["NV.g1"])))
    put("new_gdna.fa", fasta_text({"NV.g1": GENES["NV.g1"]}))
    put("new.bed", bed_line(3, "NV.g1") + bed_line(4, "NV.g8"))
    put("to_all.sam", sam_text(list(GENES), [("NV.g1.1", "RefA.g1"), ("NV.g1.1", "NV.g1")]).replace("NV.g1.1\t0\tNV.g1", "NV.g1.1\t256\tNV.g1"))
    rows = [("RefA.g1.1", "NV.g1"), ("RefA.g2.1", "NV.g1"), ("Q.g1.1", "NV.g1")]
    put("to_new.sam", sam_text(["NV.g1"], rows).replace("Q.g1.1\t0\tNV.g1\t1\t60\t40M", "Q.g1.1\t4\t*\t0\t0\t*"))
    return at, put


def construct(at):
    cli.main(["construct", "-n", "RefA,Q", "-c", f"{at}/cdna.fa", "-g", f"{at}/gdna.fa", "-b", f"{at}/all.bed", "--bam", f"{at}/raw.sam", "-r", "RefA", "-p", "h", "-o", f"{at}/out", "--keep-records", f"{at}/kept"])


def append(at, prefix, **other):
    flags = {"history": f"{at}/out/h", "history-gtf": f"{at}/history.gtf", "history-cdna": f"{at}/cdna.fa", "history-gdna": f"{at}/gdna.fa", "history-names": "RefA,Q", "query-to-all-bam": f"{at}/to_all.sam", "history-to-query-bam": f"{at}/to_new.sam", "reference": "RefA"}
    flags |= {k.replace("_", "-"): v for k, v in other.items()}
    fixed = ["append", "-n", "NV", "-c", f"{at}/new_cdna.fa", "-g", f"{at}/new_gdna.fa", "-b", f"{at}/new.bed", "-p", prefix, "-o", f"{at}/out"]
    cli.main([*fixed, *(x for k, v in flags.items() for x in (f"--{k}", v))])


def test_runs(spark, files):
    at, put = files
    construct(at)
    _, _, manifest = package.load(spark, f"{at}/out/h_graph")
    (one,) = manifest["generations"]
    assert (one["aligner"], one["aligner_version"], one["aligner_options"], one["scope"]) == ("mapper", "2.28", "-ax splice --secondary=yes", "construct")
    assert alignment.is_marked_filtered(spark.read.parquet(f"{at}/out/h_filtered")) and not alignment.is_marked_filtered(sam.read_sam(spark, f"{at}/raw.sam"))

    assert sorted(r["query_id"] for r in sam.read_sam(spark, f"{at}/kept/0.sam").collect()) == sorted(r["query_id"] for r in spark.read.parquet(f"{at}/out/h_filtered").collect())
    assert alignment.FILTERED in {r["comment"] for r in sam.comments(sam.header_lines(spark, f"{at}/kept/0.sam")).collect()}

    with pytest.warns(UserWarning, match="1 BED genes"):
        append(at, "a")
    edges, nodes, manifest = package.load(spark, f"{at}/out/a_graph")
    assert {(r["src"], r["dst"]) for r in edges.collect()} >= {("NV.g1", "RefA.g1"), ("RefA.g1", "NV.g1"), ("RefA.g1", "Q.g1")} and nodes.count() == 4
    assert [g["scope"] for g in manifest["generations"]] == ["construct", "append"]

    sides = [x for side, p in (("left", "h"), ("right", "a")) for x in (f"--{side}-edges", f"{at}/out/{p}_graph/edges", f"--{side}-pre", f"{at}/out/{p}_pre_clusters", f"--{side}-last", f"{at}/out/{p}_last_clusters")]
    cli.main(["compare", *sides, "--output", f"{at}/out/compared"])
    left, right = (spark.read.parquet(f"{at}/out/{p}_last_clusters") for p in "ha")
    want = {(r["side"], r["hub"]) for r in relations.one_sided_representatives(left, right).collect()}
    assert {(side, r["value"]) for side in ("left", "right") for r in spark.read.text(f"{at}/out/compared/last_{side}_only").collect()} == want
    assert spark.read.json(f"{at}/out/compared/summary").filter("section = 'directed_edges' and metric = 'common'").first()["value"] == 5

    text = (at / "to_all.sam").read_text()
    bad = {
        "aligner_version": text.replace("VN:2.28", "VN:2.29"), "aligner_options": text.replace("-ax splice", "-ax map"), "filtered already": text.replace(PROGRAM, f"{PROGRAM}@CO\t{alignment.FILTERED}\n"),
        "targets other": text.replace("SN:Q.g1\tLN:100", "SN:Q.g1\tLN:99"), "changed": text.replace(READS["NV.g1.1"], "A" * 40), "not known": text.replace(PROGRAM, ""),
    }
    for n, (what, content) in enumerate(bad.items()):
        with pytest.raises(ValueError, match=what), pytest.warns(UserWarning):
            append(at, f"bad{n}", query_to_all_bam=put(f"bad{n}.sam", content))
    with pytest.raises(ValueError, match="sequences"):
        append(at, "bad", history_gdna=put("other.fa", fasta_text({g: letters(100) for g in ("RefA.g1", "RefA.g2", "Q.g1")})))

    flags = ["--bed", f"{at}/all.bed", "--gdna", f"{at}/gdna.fa", "--aligner", "mapper", "--aligner-version", "2.28", "--alignments", f"{at}/raw.sam"]
    cli.main(["export", *flags, "--aligner-options", "-ax splice --secondary=yes", "--coverage", "0.5", "--output", f"{at}/out/exported"])
    assert package.load(spark, f"{at}/out/exported")[2]["generations"][0]["filter_thresholds"] == {"coverage": 0.5, "identity": 0.9, "soft_clip": 0.1}
    with pytest.raises(ValueError, match="aligner_options"):
        cli.main(["export", *flags, "--aligner-options", "-ax map", "--output", f"{at}/out/exported2"])


def test_options():
    assert sam.aligner_options("/bin/mapper -ax splice -t 4 -t16 -N 5 'a b.fa' c.fa") == "-ax splice -N 5"
    assert sam.aligner_options("mapper a b") == "" and sam.aligner_options("mapper a") is None and sam.aligner_options(None) is None


def test_merged_alignments(spark, files):
    at, put = files
    paths = [put("m1.sam", sam_text(["RefA.g1"], [("RefA.g1.1", "RefA.g1")])), put("m2.sam", sam_text(["Q.g1"], [("Q.g1.1", "Q.g1"), ("RefA.g1.1", "Q.g1")]))]
    targets = spark.createDataFrame([(g, 100) for g in GENES], "name string, length long")
    got = cli._alignments(spark, ",".join(paths), targets)
    assert [r["query_id"] for r in alignment.in_one_order([got.records]).orderBy("rec_ord").collect()] == ["RefA.g1.1", "Q.g1.1", "RefA.g1.1"]
    for other, what in ((targets.filter("name <> 'Q.g1'"), "no gene"), (targets.withColumn("length", F.lit(7).cast("long")), "another length")):
        with pytest.raises(ValueError, match=what):
            cli._alignments(spark, ",".join(paths), other)


def test_header_of_bam(spark, tmp_path):
    from test_sources import bam_bytes

    (tmp_path / "a.bam").write_bytes(bam_bytes())
    lines = sam.header_lines(spark, str(tmp_path / "a.bam"))
    assert {tuple(r) for r in sam.targets(lines).collect()} == {("A", 100), ("B", 50)} and sam.last_aligner(lines) is None
