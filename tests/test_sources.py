from __future__ import annotations

import gzip
import random
import struct

import pytest
from pyspark.sql import functions as F

from graphloom.operators import relations, transcripts, validate
from graphloom.sources import bam, bed, fasta, gtf, package, sam
from graphloom.sources.shared import shared_dir


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_fasta(spark, tmp_path):
    path = put(tmp_path, "a.fa", ">g1.1 first\nAC gt\n\nNN\n>g2.1\nA\n>g1.1 again\nTTTT\n>G3|x y\nCC\n")
    rows = fasta.read(spark, path)
    assert [(r["record_id"], r["header"], r["seq"]) for r in rows.orderBy("record_ord").collect()] == [("g1.1", "g1.1 first", "AC gtNN"), ("g2.1", "g2.1", "A"), ("g1.1", "g1.1 again", "TTTT"), ("G3|x", "G3|x y", "CC")]
    assert {r["record_id"]: r["seq_len"] for r in fasta.lengths(rows).collect()} == {"g1.1": 4, "g2.1": 1, "G3|x": 2}
    names = spark.createDataFrame([(0, "G2.1"), (1, "none"), (2, "g1.1")], "pos int, name string")
    assert [(r["name"], r["seq"]) for r in fasta.subset(rows, names).orderBy("pos").collect()] == [("G2.1", "A"), ("g1.1", "TTTT")]
    assert fasta.subset(rows, names, case_sensitive=True).count() == 1
    token = spark.createDataFrame([(0, "g3")], "pos int, name string")
    assert fasta.subset(rows, token, match="token").first()["seq"] == "CC"
    assert [r["gene_pos"] for r in fasta.transcript_index(rows).filter("gene_id = 'g1'").orderBy("record_ord").collect()] == [1, 2]
    ids = rows.filter("record_id = 'g2.1'").select("record_id")
    assert fasta.by_ids(rows, ids).count() == 1 and fasta.by_genes(rows, spark.createDataFrame([("g1",)], "gene_id string")).count() == 2
    assert fasta.concatenate(rows, rows).count() == 8
    fasta.write(rows, str(tmp_path / "out"), width=3)
    assert "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).startswith(">g1.1\nAC \ngtN\nN\n>g2.1\nA\n")


def test_bed(spark, tmp_path):
    path = put(tmp_path, "a.bed", "chr1\t9\t4\tg1\t0\t+\nchr1\t1\t2\tg2\nchr1\t10\t13\tg2\t0\t-\nchr2\t1\t5\tg1\t0\t-\n")
    rows = bed.parse(bed.read(spark, path))
    assert [(r["gene_id"], r["start"], r["end"]) for r in rows.orderBy("bed_ord").collect()] == [("g1", 9, 4), ("g2", 10, 13), ("g1", 1, 5)]
    assert {(r["gene_id"], r["chrom"], r["start"], r["end"], r["strand"]) for r in bed.last_places(rows).collect()} == {("g1", "chr2", 1, 5, "-"), ("g2", "chr1", 10, 13, "-")}
    good = put(tmp_path, "b.bed", "\nchr1\t1\t2\tg1\nchr1\t1\t2\tg1\n")
    assert [tuple(r) for r in bed.package_rows(bed.read(spark, good)).select("gene_id", "start", "strand").collect()] == [("g1", 1, ".")]
    for bad in ("chr1\t1\t2\n", "chr1\t1\t2\tg\nchr1\t1\t3\tg\n"):
        with pytest.raises(Exception, match="BED row"):
            bed.package_rows(bed.read(spark, put(tmp_path, "bad.bed", bad))).collect()


ROW = "Ref.g1\tPan\t{}\t{}\t{}\t.\t{}\t.\ttranscript_id \"{}\"; gene_id \"Ref.g1\"; note \"keep\";"


def rows(*parts):
    return "#c\n" + "\n".join(ROW.format(*p) for p in parts) + "\n"


def test_gtf_models(spark, tmp_path):
    text = rows(("transcript", 1, 30, "+", "Ref.g1.1"), ("exon", 21, 30, "+", "Ref.g1.1"), ("exon", 1, 10, "+", "Ref.g1.1"))
    m = gtf.models(gtf.read(spark, put(tmp_path, "a.gtf", text))).first()
    assert [tuple(x) for x in m["exons"]] == [(1, 10), (21, 30)] and [tuple(x) for x in m["splices"]] == [(11, 20)]
    bad = {
        "sequence name": text.replace("Ref.g1\tPan", "Other\tPan"), "ids": text.replace("transcript_id", "tid"), "fields": text + "a\tb\n",
        "gaps": rows(("transcript", 1, 30, "+", "Ref.g1.1"), ("exon", 1, 10, "+", "Ref.g1.1"), ("exon", 11, 30, "+", "Ref.g1.1")),
        "place": rows(("transcript", 1, 30, "+", "Ref.g1.1"), ("exon", 1, 10, "-", "Ref.g1.1")), "transcript row": rows(("exon", 1, 10, "-", "Ref.g1.1")),
        "exons": rows(("transcript", 1, 10, "-", "Ref.g1.1")), "order": rows(("transcript", 1, 10, "+", "Ref.g1.1"), ("exon", 0, 10, "+", "Ref.g1.1")),
        "coordinates": rows(("transcript", "x", 10, "+", "Ref.g1.1"), ("exon", 1, 10, "+", "Ref.g1.1")), "gene of transcript": rows(("transcript", 1, 9, "+", "Other.1"), ("exon", 1, 9, "+", "Other.1")),
    }
    for rule, content in bad.items():
        found = {r["rule"] for r in validate.gtf_violations(gtf.read(spark, put(tmp_path, "bad.gtf", content))).collect()}
        assert rule in found, rule
    with pytest.raises(ValueError, match="gaps"):
        gtf.models(gtf.read(spark, put(tmp_path, "bad.gtf", bad["gaps"])))


def test_rename_and_write(spark, tmp_path):
    text = rows(("transcript", 1, 30, "+", "Ref.g1.1"), ("exon", 1, 30, "+", "Ref.g1.1"))
    parsed = gtf.parse(gtf.read(spark, put(tmp_path, "a.gtf", text)))
    names = spark.createDataFrame([("Ref.g1", "Pan1A000001")], "hub string, pan_id string")
    gtf.write(transcripts.rename_gtf(parsed, names), str(tmp_path / "out"), ["gtf_ord"])
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).splitlines()
    assert lines[0] == 'Ref.g1\tPan\ttranscript\t1\t30\t.\t+\t.\ttranscript_id "Pan1A000001.1"; gene_id "Pan1A000001"; note "keep";' and len(lines) == 2
    with pytest.raises(Exception, match="cannot be renamed"):
        transcripts.rename_gtf(parsed, names.limit(0)).collect()


def bam_record(name, flag, target, pos, ops, seq, tags):
    packed = bytes((bam.LETTERS.index(a) << 4) | bam.LETTERS.index(b) for a, b in zip(seq[::2], (seq + "=")[1::2], strict=False))
    body = struct.pack("<iiBBHHHiiii", target, pos, len(name) + 1, 0, 0, len(ops), flag, len(seq), -1, -1, 0)
    body += name.encode() + b"\0" + b"".join(struct.pack("<I", n << 4 | bam.CIGAR_OPS.index(o)) for n, o in ops) + packed + b"\xff" * len(seq) + tags
    return struct.pack("<i", len(body)) + body


def bam_bytes():
    text = b"@HD\tVN:1.6\n"
    head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", 2)
    for name, n in ((b"A", 100), (b"B", 50)):
        head += struct.pack("<i", len(name) + 1) + name + b"\0" + struct.pack("<i", n)
    body = bam_record("q.1", 16, 0, 0, [(4, "M")], "GACT", b"ASC\x04" + b"XZZabc\0" + b"NMc\x01" + b"ZBBc\x02\0\0\0\1\2" + b"msi\x07\0\0\0")
    body += bam_record("q.2", 4, -1, -1, [], "AACG", b"") + bam_record("q.1", 256, 1, 9, [(2, "S"), (8, "M"), (5, "N"), (12, "M")], "", b"")
    return gzip.compress(head) + gzip.compress(body)


def test_sam_and_bam(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(bam_bytes())
    text = "@HD\tVN:1.6\n@SQ\tSN:A\tLN:100\n@SQ\tSN:B\tLN:50\n"
    text += "q.1\t16\tA\t1\t9\t4M\t*\t0\t0\tGACT\t*\tAS:i:4\tXZ:Z:abc\tNM:i:1\tms:i:7\nq.2\t4\t*\t0\t0\t*\t*\t0\t0\tAACG\t*\nq.1\t256\tB\t10\t0\t2S8M5N12M\t*\t0\t0\t*\t*\n"
    a, b = sam.read_bam(spark, str(tmp_path / "a.bam")).orderBy("rec_ord").collect(), sam.read_sam(spark, put(tmp_path, "a.sam", text)).orderBy("rec_ord").collect()
    drop = lambda rows: [tuple(v for k, v in r.asDict().items() if k != "rec_ord") for r in rows]
    assert drop(a) == drop(b) and len(a) == 3
    assert (a[0]["as_score"], a[0]["ms_score"], a[0]["nm"], a[0]["is_reverse"]) == (4, 7, 1, True) and a[2]["seq_len"] is None
    forward = spark.createDataFrame([("AGTC",)], "s string").select(F.sha2("s", 256)).first()[0]
    assert a[0]["seq_sha256"] == forward
    assert {tuple(r) for r in sam.targets(sam.header_lines(spark, str(tmp_path / "a.sam"))).collect()} == {("A", 100), ("B", 50)}


def blocked(stream, rng, least=40, most=900):
    """A stream in blocks of odd sizes, so that records run across them, with the empty block at the end."""
    out, at = b"", 0
    while at < len(stream):
        n = rng.randrange(least, most)
        out, at = out + bam.block(stream[at : at + n]), at + n
    return out + bam.END_BLOCK


def random_bam(seed, records, long_at=()):
    rng = random.Random(seed)
    targets = [(f"chr{i}", 10_000 + i) for i in range(40)]
    body = []
    for i in range(records):
        n = 30_000 if i in long_at else rng.choice([0, 1, 7, 60, 150])
        seq = "".join(rng.choice("ACGTN") for _ in range(n))
        ops = [(rng.randrange(1, 200), rng.choice("MIDNS=X")) for _ in range(rng.randrange(0, 6))]
        tags = b"".join(rng.sample([b"ASc" + bytes([rng.randrange(100)]), b"NMi" + struct.pack("<i", rng.randrange(9)), b"XAZtext\0", b"msS" + struct.pack("<H", rng.randrange(500))], rng.randrange(5)))
        body.append(bam_record(f"read{i}.{rng.randrange(9)}", rng.choice([0, 4, 16, 256, 2048]), rng.randrange(-1, 40), rng.randrange(-1, 9000), ops, seq, tags))
    return bam.packed_header("@HD\tVN:1.6\n@PG\tID:a\tPN:a\n", targets) + b"".join(body)


@pytest.mark.parametrize("long_at", [(), (5, 6, 700)])
def test_bam_in_ranges(spark, tmp_path, long_at, monkeypatch):
    """Ranges of a few blocks give what one range and the plain stream give, with records that are longer than a range too."""
    rng = random.Random(len(long_at))
    stream = random_bam(3, 800, long_at)
    (tmp_path / "a.bam").write_bytes(blocked(stream, rng))
    (tmp_path / "plain.bam").write_bytes(gzip.compress(stream))
    read = lambda name, mb, **k: [tuple(r) for r in sam.read_bam(spark, str(tmp_path / name), range_mb=mb, **k).orderBy("rec_ord").collect()]
    whole, many, plain = read("a.bam", 1000), read("a.bam", 0.004), read("plain.bam", 1)
    assert sam.read_bam(spark, str(tmp_path / "a.bam"), range_mb=0.004).rdd.getNumPartitions() >= 8
    assert many == whole and len(many) == 800 and [r[1:] for r in whole] == [r[1:] for r in plain]
    some = ["query_id", "rec_ord", "is_secondary", "seq_len", "nm"]
    assert {tuple(r) for r in sam.read_bam(spark, str(tmp_path / "a.bam"), some, 0.01).collect()} == {(r[1], r[0], r[4], r[9], r[13]) for r in whole}
    # each range's first record is a true one, also where little is looked at
    monkeypatch.setattr(bam, "WINDOW", 2000)
    data, true = (tmp_path / "a.bam").read_bytes(), [r[0] for r in whole]
    import io

    for start in range(0, len(data), 3000):
        found = bam.first_record(io.BytesIO(data), len(data), start, start + 3000, [10_000 + i for i in range(40)])
        first = bam.Blocks(io.BytesIO(data), len(data)).first(start)
        assert found in (None, *true) and (found is None or found >> 16 >= first)
        assert found == next((v for v in true if start <= v >> 16 < start + 3000), None) or start == 0


def test_filtered_bam_and_sam(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(blocked(random_bam(4, 500), random.Random(1)))
    rows = sam.read_bam(spark, str(tmp_path / "a.bam"), range_mb=0.01)
    kept = rows.filter("rec_ord % 3 = 0 and not is_unmapped")
    out = str(tmp_path / "kept")
    sam.write_filtered_bam(kept, str(tmp_path / "a.bam"), out, "graphloom.filtered", per_file=60)
    back = sam.read_bam(spark, f"{out}/*.bam")
    plain = lambda df: [tuple(r)[1:] for r in df.collect()]
    assert sorted(map(repr, plain(back))) == sorted(map(repr, plain(kept))) and kept.count() > 60
    assert len(list((tmp_path / "kept").glob("part-*.bam"))) > 1 and not list((tmp_path / "kept").glob("_part*"))
    assert {r["comment"] for r in sam.comments(sam.header_lines(spark, f"{out}/*.bam")).collect()} == {"graphloom.filtered"}
    in_order = [x for p in sorted((tmp_path / "kept").glob("*.bam")) for x in plain(sam.read_bam(spark, str(p)).orderBy("rec_ord"))]
    assert in_order == plain(kept.orderBy("rec_ord"))
    sam.write_filtered_bam(kept.limit(0), str(tmp_path / "a.bam"), out, "m")
    assert sam.read_bam(spark, f"{out}/*.bam").count() == 0
    text = "@HD\tVN:1.6\n@SQ\tSN:A\tLN:100\n" + "".join(f"q.{i}\t0\tA\t{i + 1}\t9\t4M\t*\t0\t0\tGACT\t*\n" for i in range(50))
    path = put(tmp_path, "a.sam", text)
    some = sam.read_sam(spark, path).filter("pos0 % 7 = 1")
    sam.write_filtered_sam(some, path, str(tmp_path / "some"), "graphloom.filtered")
    again = sam.read_sam(spark, str(tmp_path / "some"))
    assert sorted(plain(again)) == sorted(plain(some)) and some.count() == 7
    lines = "".join(p.read_text() for p in sorted((tmp_path / "some").glob("part-*"))).splitlines()
    assert lines[:3] == ["@HD\tVN:1.6", "@SQ\tSN:A\tLN:100", "@CO\tgraphloom.filtered"] and [x.split("\t")[0] for x in lines[3:]] == [f"q.{i}" for i in range(50) if i % 7 == 1]


def test_fasta_index(spark, tmp_path):
    """Records by index against the whole files: odd line ends, records over ranges, ids in two files, little read for a few ids."""
    rng = random.Random(7)
    folder = tmp_path / "fa"
    folder.mkdir()
    for name in ("b.fa", "a.fa"):
        text = ""
        for i in range(300):
            seq = "".join(rng.choice("ACGTn") for _ in range(rng.choice([0, 1, 60, 500, 9000])))
            end = "\r\n" if i % 11 == 0 else "\n"
            text += f">{name[0]}{i // 2}.{i % 2}|x note > {i}{end}" + end.join(seq[k : k + 70] for k in range(0, len(seq), 70)) + "\n" * (1 + i % 2)
        put(folder, name, text + ">same.1\nACGT\n>\nAC")
    whole = fasta.read(spark, str(folder))
    for mb in (64, 0.003):
        fasta.write_index(spark, str(folder), str(tmp_path / "index"), mb)
        index = fasta.read_index(spark, str(tmp_path / "index"))
        plain = lambda df: sorted((r["record_id"], r["header"], r["seq"]) for r in df.collect())
        assert plain(fasta.fetch(index)) == plain(whole)
        assert index.agg(F.sum("size")).first()[0] == sum(p.stat().st_size for p in folder.iterdir()) - 2 * len(">\nAC")
        ids = spark.createDataFrame([("a3.1|x",), ("b17.0|x",), ("none",)], "record_id string")
        assert plain(fasta.fetch(fasta.by_ids(index, ids))) == plain(fasta.by_ids(whole, ids))
        assert fasta.by_ids(index, ids).agg(F.sum("size")).first()[0] < 20_000
        genes = spark.createDataFrame([("a3",)], "gene_id string")
        assert plain(fasta.fetch(fasta.by_genes(index, genes))) == plain(fasta.by_genes(whole, genes))
        names = spark.createDataFrame([(0, "A5.1"), (1, "SAME.1"), (2, "zzz")], "pos int, name string")
        got = fasta.fetch(fasta.subset(index, names, "token")).orderBy("pos")
        assert [(r["name"], r["record_id"]) for r in got.collect()] == [("A5.1", "a5.1|x"), ("SAME.1", "same.1")]
    assert [r["record_id"] for r in index.orderBy("record_ord").limit(2).collect()] == ["a0.0|x", "a0.1|x"]


def test_package(spark, tmp_path):
    edges = spark.createDataFrame([("g2", "g1"), ("g1", "g2"), ("g1", "g2")], "src string, dst string")
    genes = spark.createDataFrame([("g1", 10, "c", 1, 2, "+", 0), ("g2", 20, "c", 5, 9, "-", 1)], "gene_id string, gene_len long, chrom string, start long, end long, strand string, bed_ord long")
    one = package.generation("aligner", "2.28", "-x", "all", {"coverage": 0.8, "identity": 0.9, "soft_clip": 0.1})
    at = f"{shared_dir(spark)}/package"
    package.write(edges, genes, at, [one])
    e, n, manifest = package.load(spark, at)
    assert (e.count(), n.count(), manifest["generations"]) == (2, 2, [one])
    both = relations.appended_edges(e, spark.createDataFrame([("g1", "g1"), ("g1", "g2"), ("g1", "g1")], "src string, dst string"))
    assert sorted(map(tuple, both.collect())) == [("g1", "g1"), ("g1", "g2"), ("g2", "g1")]
    package.check_provenance(manifest["generations"], {**one, "scope": "new"})
    for other in ({**one, "aligner_version": "2.29"}, {**one, "filter_thresholds": {}}):
        with pytest.raises(ValueError):
            package.check_provenance([one], other)
    with pytest.raises(ValueError, match="assumed"):
        package.check_provenance([package.generation("aligner", "2.28", "-x", "all")], one)
    with pytest.raises(ValueError, match="g9"):
        package.write(relations.union_edges(edges, spark.createDataFrame([("g9", "g1")], "src string, dst string")), genes, at + "2", [one])
    with pytest.raises(ValueError, match="length"):
        package.write(edges, genes.withColumn("gene_len", F.lit(None).cast("long")), at + "3", [one])
    package.write_tsv(edges, genes, at + "-tsv")
    assert package.read_edges_tsv(spark, at + "-tsv/edges.tsv").count() == 2 and package.read_nodes_tsv(spark, at + "-tsv/nodes.tsv").count() == 2


def test_validations(spark):
    assert validate.prefix_clashes(["A", "B", "AB"]) == [("A", "AB")] and validate.prefix_clashes(["A", "A"]) == [("A", "A")] and validate.prefix_clashes(["A", "B"]) == []
    with pytest.raises(ValueError, match="bad: x1, x2"):
        validate.require(spark.createDataFrame([("x2",), ("x1",)], "g string"), "bad")
    validate.require(spark.createDataFrame([], "g string"), "bad")


def test_fasta_with_line_ends_of_two_characters(spark, tmp_path):
    path = tmp_path / "crlf.fa"
    path.write_bytes(b">a one\r\nACGT\r\nAC\t\r\n>b\r\n\r\nGG\r\n")
    rows = fasta.read(spark, str(path)).orderBy("record_ord").collect()
    assert [(r["record_id"], r["header"], r["seq"]) for r in rows] == [("a", "a one", "ACGTAC"), ("b", "b", "GG")]


def test_stored_edges_are_joined_in_their_buckets(spark, monkeypatch):
    """An append meets the history's edges without moving them: no exchange stands above their scan."""
    monkeypatch.setattr(package, "BUCKET_EDGES", 50)
    edges = spark.range(400).selectExpr("concat('g', id % 40) as src", "concat('g', id) as dst")
    genes = spark.range(400).selectExpr("concat('g', id) as gene_id", "10L as gene_len", "'c' as chrom", "id as start", "id + 9 as end", "'+' as strand", "id as bed_ord")
    at = f"{shared_dir(spark)}/bucketed"
    package.write(edges, genes, at, [package.generation("a", "1", "-x", "all", {"coverage": 0.8, "identity": 0.9, "soft_clip": 0.1})])
    history, _, manifest = package.load(spark, at)
    assert manifest["buckets"] == 8 and history.exceptAll(edges).count() == 0 and history.count() == 400
    new = spark.range(300, 900).selectExpr("concat('g', id % 40) as src", "concat('g', id) as dst")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = relations.appended_edges(history, new, new)
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert both.count() == 900 and both.distinct().count() == 900
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scans = [i for i, x in enumerate(lines) if "Scan parquet" in x and "graphloom_edges" in x]
    assert len(scans) == 2
    for i in scans:  # walk up by indentation
        depth = lines[i].index("FileScan")
        for x in reversed(lines[:i]):
            at_ = len(x) - len(x.lstrip(" :+-*()0123456789"))
            if at_ < depth:
                depth = at_
                assert "Exchange" not in x
