"""Command line: construct, append, export and compare over files that Spark can read."""

from __future__ import annotations

import argparse
import json
import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.ids import MAIN_CHROMS, gene_of
from graphloom.operators import alignment, relations, validate
from graphloom.plans import append as appending
from graphloom.plans import construct as constructing
from graphloom.sources import bed, fasta, gtf, package, sam
from graphloom.sources.shared import clear_scratch


def names(spark: SparkSession, text: str) -> list[str]:
    """Names from a list with ";" or "," (or spaces, if it is one item), or the lines of a file that Spark can read."""
    items = [x.strip() for x in text.replace(";", ",").split(",") if x.strip()]
    if len(items) == 1 and " " in items[0]:
        items = items[0].split()
    if len(items) == 1 and "/" in items[0]:
        items = [r["value"].strip() for r in spark.read.text(items[0]).collect() if r["value"].strip()]
    if not items:
        raise ValueError(f"no names in {text!r}")
    return items


THRESHOLDS = {"coverage": alignment.COVERAGE, "identity": alignment.IDENTITY, "soft_clip": alignment.SOFT_CLIP}


@dataclass(frozen=True)
class Alignments:
    """Records of one or more files, and the header lines of those that have a header (None if they are Parquet)."""

    records: DataFrame
    header: DataFrame | None
    paths: tuple[str, ...] = ()

    def write_kept(self, spark: SparkSession, genes: DataFrame, out: str) -> None:
        """The records that pass the filter, as they stand in each SAM or BAM file, in a folder of ``out`` for each; Parquet is left out."""
        for k, path in enumerate(self.paths):
            if path.rstrip("/").endswith((".sam", ".bam")):
                read, write = (sam.read_bam, sam.write_filtered_bam) if path.endswith(".bam") else (sam.read_sam, sam.write_filtered_sam)
                write(alignment.quality_filter(read(spark, path), genes), path, f"{out}/{k}.{path.rstrip('/')[-3:]}", alignment.FILTERED)

    @property
    def filtered(self) -> bool:
        noted = self.header is not None and not sam.comments(self.header).filter(F.col("comment") == alignment.FILTERED).isEmpty()
        return noted or alignment.is_marked_filtered(self.records)

    def generation(self, a: argparse.Namespace, scope: str, thresholds: dict) -> dict:
        """Provenance from the header, else from the command line; where both tell something, they must agree."""
        told = {k: getattr(a, k) for k in ("aligner", "aligner_version", "aligner_options") if getattr(a, k, None) is not None}
        found = sam.last_aligner(self.header, a.aligner) if self.header is not None else None
        for key, value in (found or {}).items():
            if key in told and told[key] != value:
                raise ValueError(f"{key} is {told[key]!r}, but {value!r} in the header")
        one = {"aligner": None, "aligner_version": None, "aligner_options": None, **told, **(found or {})}
        return package.generation(one["aligner"], one["aligner_version"], one["aligner_options"], scope, thresholds)


def _alignments(spark: SparkSession, text: str, targets: DataFrame) -> Alignments:
    """BAM, SAM or Parquet from a list of paths with ","; several files are put together if all their targets are among ``targets``."""
    parts, headers, paths = [], [], [x.strip() for x in text.split(",") if x.strip()]
    for path in paths:
        if path.rstrip("/").endswith((".sam", ".bam")):
            headers.append(sam.header_lines(spark, path))
            parts.append((sam.read_bam(spark, path) if path.endswith(".bam") else sam.read_sam(spark, path), sam.targets(headers[-1])))
        else:
            parts.append((spark.read.parquet(path), targets.limit(0)))
    records = parts[0][0] if len(parts) == 1 else alignment.merged(parts, targets)
    return Alignments(records, reduce(DataFrame.unionByName, headers) if len(headers) == len(parts) else None, tuple(paths))


def _sequence_genes(places: DataFrame, gdna: DataFrame) -> DataFrame:
    """Places of genes with a sequence; a sequence without a place is an error, places without a sequence are left out with a warning."""
    with_sequence = gdna.select(F.col("record_id").alias("gene_id")).distinct()
    validate.require(validate.missing_from(with_sequence, places), "sequences of genes outside the BED")
    without = validate.missing_from(places, with_sequence).count()
    if without:
        warnings.warn(f"{without} BED genes without a sequence are left out", stacklevel=2)
    return places.join(with_sequence, "gene_id", "left_semi")


def _targets(records: DataFrame) -> DataFrame:
    return fasta.lengths(records).select(F.col("record_id").alias("name"), F.col("seq_len").alias("length"))


def save(run: constructing.Construct, out: str, prefix: str, generations: list[dict], genes: DataFrame, gdna: DataFrame, settings: dict) -> None:
    """Tables and text files of a run, each a folder below ``out``."""
    at = lambda name: f"{out}/{prefix}_{name}"
    package.write(run.edges, genes, at("graph"), generations, settings, sequences=gdna.select("record_id", "seq"), filtered=run.filtered)
    alignment.marked_filtered(run.filtered).write.parquet(at("filtered"))
    for label, members in (("pre", run.clusters.pre), ("last", run.clusters.last)):
        members.write.parquet(at(f"{label}_clusters"))
        constructing.cluster_lines(members).orderBy(*constructing.CLUSTER_ORDER).select("line").write.text(at(f"{label}_cluster_lines"))
    run.clusters.blocks.write.parquet(at("blocks"))
    gtf.write(constructing.official_gtf(run), at("gtf"), ["k1", "k2", "k3", "k4", "k5", "k6", "start", "end"])
    gtf.write(run.last.gtf, at("unrenamed_gtf"), ["seqname", "gtf_ord"])
    gtf.write(run.pre.gtf, at("pre_gtf"), ["seqname", "gtf_ord"])
    run.last.gtf.write.parquet(at("models"))
    for label, models in (("cdna", run.last), ("pre_cdna", run.pre)):
        fasta.write(models.cdna.select(F.col("transcript_id").alias("record_id"), F.col("cdna").alias("seq"), "seq_ord"), at(label), ["seq_ord"])
    run.names.write.parquet(at("names"))
    run.last.missing.write.parquet(at("missing"))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="graphloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("construct", "append"):
        c = sub.add_parser(name)
        c.add_argument("-n", "--name", required=True, help="variety names, in order, or a file of them")
        c.add_argument("-c", "--cdna", required=True, help="transcript FASTA")
        c.add_argument("-g", "--gdna", required=True, help="gene FASTA")
        c.add_argument("-b", "--bed", required=True)
        c.add_argument("--main-chroms", help="chromosome names in order, or a file of them")
        c.add_argument("-p", "--prefix", default=name)
        c.add_argument("-o", "--output", required=True)
        c.add_argument("--keep-records", help="folder for the filtered records in the form of their SAM and BAM files")
        for flag in ("--aligner", "--aligner-version", "--aligner-options"):
            c.add_argument(flag, help="provenance of the alignments, where their header does not tell it")
    c = sub.choices["construct"]
    c.add_argument("--bam", required=True, help="alignments: BAM, SAM or Parquet, or a list of them with commas")
    c.add_argument("-r", "--reference")
    c = sub.choices["append"]
    for flag in ("--history", "--history-gtf", "--history-cdna", "--history-gdna", "--history-names", "--query-to-all-bam", "--history-to-query-bam", "--reference"):
        c.add_argument(flag, required=True)
    c = sub.add_parser("export", help="a graph package from filtered alignments")
    for flag in ("--alignments", "--bed", "--gdna", "--aligner", "--aligner-version", "--aligner-options", "--output"):
        c.add_argument(flag, required=True)
    for key, value in THRESHOLDS.items():
        c.add_argument("--" + key.replace("_", "-"), type=float, default=value, help="threshold the alignments were filtered by")
    c = sub.add_parser("compare", help="two runs: edges (Parquet) and clusters (Parquet)")
    for flag in ("--left-edges", "--right-edges", "--left-pre", "--right-pre", "--left-last", "--right-last", "--output"):
        c.add_argument(flag, required=True)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    own_session = SparkSession.getActiveSession() is None
    spark = SparkSession.builder.appName("graphloom").getOrCreate()
    chroms = tuple(names(spark, a.main_chroms)) if getattr(a, "main_chroms", None) else MAIN_CHROMS
    if a.command == "construct":
        gdna, cdna = fasta.read(spark, a.gdna), fasta.read(spark, a.cdna)
        genes = constructing.gene_table(bed.last_places(bed.parse(bed.read(spark, a.bed))), _targets(gdna))
        given = _alignments(spark, a.bam, _targets(gdna))
        listed = names(spark, a.name)
        run = constructing.construct(given.records, genes, fasta.lengths(cdna), gdna, listed, a.reference, chroms)
        settings = {"reference": a.reference or listed[0], "main_chroms": list(chroms)}
        save(run, a.output, a.prefix, [given.generation(a, "construct", THRESHOLDS)], genes, gdna, settings)
        if a.keep_records:
            given.write_kept(spark, genes, a.keep_records)
    elif a.command == "append":
        edges, nodes, manifest = package.load(spark, f"{a.history}_graph")
        gdna, cdna, history_gdna, history_cdna = (fasta.read(spark, path) for path in (a.gdna, a.cdna, a.history_gdna, a.history_cdna))
        filtered = spark.read.parquet(f"{a.history}_filtered")
        package.check_inputs(manifest, sequences=history_gdna.select("record_id", "seq"), filtered=filtered)
        query_genes = constructing.gene_table(_sequence_genes(bed.last_places(bed.parse(bed.read(spark, a.bed))), gdna), _targets(gdna))
        query_transcripts = cdna.select(gene_of(F.col("record_id")).alias("gene_id"))
        validate.require(validate.missing_from(query_transcripts, query_genes), "transcripts of genes without a sequence")
        sequences = fasta.concatenate(history_gdna, gdna)
        to_all, to_query = _alignments(spark, a.query_to_all_bam, _targets(sequences)), _alignments(spark, a.history_to_query_bam, _targets(gdna))
        for given, records, targets, label in ((to_all, cdna, sequences, "query to all"), (to_query, history_cdna, gdna, "history to query")):
            expected = fasta.identities(records).withColumnRenamed("record_id", "query_id")
            own_targets = None if given.header is None else (sam.targets(given.header), _targets(targets))
            validate.check_raw(given.records, expected, label, own_targets, given.filtered)
            package.check_provenance(manifest["generations"], given.generation(a, "append", THRESHOLDS))
        models = gtf.models(gtf.read(spark, a.history_gtf))
        appending.check_history(models, history_cdna, nodes)
        lengths = appending.transcript_lengths(history_cdna, cdna)
        settings = {"reference": a.reference, "main_chroms": list(chroms)}
        stored = None  # clusters for another reference or other chromosomes say nothing about these
        if manifest["settings"] == settings:
            stored = constructing.Clusters(*(spark.read.parquet(f"{a.history}_{name}") for name in ("pre_clusters", "last_clusters", "blocks")))
        run = appending.append(
            edges, nodes, filtered, models, query_genes, to_all.records, to_query.records, lengths, sequences, names(spark, a.history_names), names(spark, a.name),
            a.reference, chroms, history_clusters=stored,
        )
        genes = appending.all_genes(nodes, query_genes)
        if a.keep_records:
            for label, given in (("query-to-all", to_all), ("history-to-query", to_query)):
                given.write_kept(spark, genes, f"{a.keep_records}/{label}")
        save(run, a.output, a.prefix, [*manifest["generations"], to_all.generation(a, "append", THRESHOLDS)], genes, sequences, settings)
    elif a.command == "export":
        gdna = fasta.read(spark, a.gdna)
        genes = constructing.gene_table(bed.package_rows(bed.read(spark, a.bed)), _targets(gdna))
        given = _alignments(spark, a.alignments, _targets(gdna))
        one = given.generation(a, "export", {key: getattr(a, key) for key in THRESHOLDS})
        package.write(alignment.gene_edges(given.records), genes, a.output, [one], sequences=gdna.select("record_id", "seq"), filtered=given.records)
    else:
        read = spark.read.parquet
        out = appending.compare(read(a.left_edges), read(a.right_edges), (read(a.left_pre), read(a.left_last)), (read(a.right_pre), read(a.right_last)))
        out.write.json(f"{a.output}/summary")
        for label, left, right in (("pre", a.left_pre, a.right_pre), ("last", a.left_last, a.right_last)):
            sides = relations.one_sided_representatives(read(left), read(right))
            for side in ("left", "right"):
                sides.filter(F.col("side") == side).select("hub").orderBy("hub").write.text(f"{a.output}/{label}_{side}_only")
        print(json.dumps([r.asDict() for r in out.collect()], sort_keys=True))
    if own_session:
        clear_scratch(spark)  # all results are stored


if __name__ == "__main__":
    main()
