"""The append run: new varieties on top of a stored graph, and the comparison of two runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.ids import MAIN_CHROMS, gene_of
from graphloom.operators import alignment, relations, validate
from graphloom.plans.construct import Clusters, Construct, derive_clusters, finish
from graphloom.sources import fasta
from graphloom.sources.shared import written


def check_inputs(history_genes: DataFrame, history_varieties: list[str], query_genes: DataFrame, query_transcripts: DataFrame, new_varieties: list[str]) -> None:
    """Raises unless names are new and no prefix of one another, every gene belongs to exactly one variety and every variety has a gene,
    transcripts are of known genes, and no gene is in both parts. ``query_transcripts``: transcript_id."""
    both = sorted(set(history_varieties) & set(new_varieties))
    if both:
        raise ValueError("varieties that are in the graph already: " + ", ".join(both))
    clashes = validate.prefix_clashes(history_varieties + new_varieties)
    if clashes:
        raise ValueError("variety names that are prefixes: " + ", ".join(f"{a}/{b}" for a, b in clashes))
    for genes, varieties, what in ((history_genes, history_varieties, "history"), (query_genes, new_varieties, "query")):
        n = validate.variety_matches(genes, varieties)
        validate.require(n.filter("n_varieties <> 1").select("gene_id"), f"{what} genes of no variety or of several")
        found = genes.agg(*(F.max(F.startswith("gene_id", F.lit(v))).alias(f"v{i}") for i, v in enumerate(varieties))).first()
        empty = [v for i, v in enumerate(varieties) if not found[i]]
        if empty:
            raise ValueError(f"{what} varieties without a gene: " + ", ".join(empty))
    of_tx = query_transcripts.select(gene_of(F.col("transcript_id")).alias("gene_id"))
    validate.require(validate.missing_from(of_tx, query_genes), "transcripts of unknown genes")
    validate.require(history_genes.select("gene_id").intersect(query_genes.select("gene_id")), "genes in history and query")


def check_history(models: DataFrame, records: DataFrame, genes: DataFrame) -> None:
    """Raises unless the stored transcript models (transcript_id) and sequences (record_id) are of the same transcripts, none of a
    renamed gene, and all of genes of the graph."""
    found = validate.transcript_violations(models, records.select(F.col("record_id").alias("transcript_id")), genes)
    validate.require(found.select(F.concat_ws(": ", "rule", "detail")), "stored transcripts that do not fit the graph")


def all_genes(history_genes: DataFrame, query_genes: DataFrame) -> DataFrame:
    """The genes of both parts in BED order: those of the query after those of the history."""
    shift = history_genes.agg(F.coalesce(F.max("bed_ord"), F.lit(-1)).alias("m")).first()["m"] + 1
    columns = ["gene_id", "gene_len", "chrom", "start", "end", "strand", "bed_ord"]
    return history_genes.select(*columns).unionByName(query_genes.withColumn("bed_ord", F.col("bed_ord") + shift).select(*columns))


def append(
    history_edges: DataFrame, history_genes: DataFrame, history_filtered: DataFrame, history_models: DataFrame, query_genes: DataFrame,
    query_to_all: DataFrame, history_to_query: DataFrame, lengths: DataFrame, sequences: DataFrame, history_varieties: list[str], new_varieties: list[str],
    reference: str, main_chroms: tuple[str, ...] = MAIN_CHROMS, realign: Callable[[DataFrame], DataFrame] | None = None, history_clusters: Clusters | None = None,
) -> Construct:
    """All tables of an append run. Only alignments of new transcripts to all genes and of old transcripts to new genes are filtered
    anew; edges among old genes come from the stored graph, and old transcript models (seeds) stand before aligned ones.

    ``lengths`` (record_id, seq_len) and ``sequences`` (record_id, seq) cover old and new records. With ``history_clusters``, those of
    the stored graph for the same reference, only blocks that new edges touch are solved again.
    """
    check_inputs(history_genes, history_varieties, query_genes, query_to_all.select(F.col("query_id").alias("transcript_id")).distinct(), new_varieties)
    genes = written(all_genes(history_genes, query_genes), "genes")
    validate.require(validate.missing_from(lengths.select(gene_of(F.col("record_id")).alias("gene_id")), genes), "transcript sequences of unknown genes")
    new = [written(alignment.quality_filter(a, genes), "filtered") for a in (query_to_all, history_to_query)]
    edges = written(relations.appended_edges(history_edges, *map(alignment.gene_edges, new)), "edges")
    filtered = written(alignment.in_one_order([history_filtered, *new]), "merged")
    eligible, varieties = genes.select("gene_id"), history_varieties + new_varieties
    clusters = None
    if history_clusters is not None:
        added = written(relations.union_edges(*map(alignment.gene_edges, new)).join(history_edges.select("src", "dst"), ["src", "dst"], "left_anti"), "new-edges")
        clusters = grown_clusters(history_clusters, history_edges, added, genes, eligible, varieties, reference, main_chroms)
    return finish(filtered, edges, genes, lengths, sequences, varieties, reference, main_chroms, eligible, history_models, realign, clusters)


def grown_clusters(
    history: Clusters, history_edges: DataFrame, added: DataFrame, genes: DataFrame, eligible: DataFrame, varieties: list[str], reference: str,
    main_chroms: tuple[str, ...] = MAIN_CHROMS, prefixes: list[str] | None = None,
) -> Clusters:
    """Clusters of a stored graph with ``added`` edges: those of weakly connected blocks that no added edge touches stay as stored; the
    others are solved anew from their own edges. The result is that of all edges together, as components, hubs and splits depend on a
    block's edges and genes alone (stored genes keep their lengths, places and varieties)."""
    ends = added.select(F.col("src").alias("gene_id")).unionByName(added.select(F.col("dst").alias("gene_id"))).distinct()
    touched = written(history.blocks.join(ends, "gene_id", "left_semi").select("root").distinct(), "touched-blocks")
    old = written(history.blocks.join(touched, "root", "left_semi").select("gene_id"), "touched-genes")
    again = history_edges.select("src", "dst").join(old.withColumnRenamed("gene_id", "src"), "src", "left_semi")
    edges = written(again.select("src", "dst").unionByName(added.select("src", "dst")).distinct(), "touched-edges")
    stay = lambda c: c.filter("o1 = 0").join(old, "gene_id", "left_anti")
    kept = Clusters(stay(history.pre), stay(history.last), history.blocks.join(touched, "root", "left_anti"))
    return derive_clusters(edges, genes, eligible, varieties, reference, main_chroms, prefixes, kept)


def compare(left_edges: DataFrame, right_edges: DataFrame, left: tuple[DataFrame, DataFrame], right: tuple[DataFrame, DataFrame]) -> DataFrame:
    """section, metric and value of two runs: directed edges, reciprocal pairs, and first and last clusters (hub, gene_id)."""
    parts = {
        "directed_edges": relations.set_metrics(left_edges.select("src", "dst"), right_edges.select("src", "dst")),
        "reciprocal_pairs": relations.set_metrics(relations.reciprocal_pairs(left_edges), relations.reciprocal_pairs(right_edges)),
        "pre_clusters": relations.compare_clusters(left[0], right[0]),
        "last_clusters": relations.compare_clusters(left[1], right[1]),
    }
    out = None
    for section, row in parts.items():
        pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns))).alias("p")
        rows = row.select(F.lit(section).alias("section"), pairs).select("section", "p.metric", "p.value")
        out = rows if out is None else out.unionByName(rows)
    return out


def transcript_lengths(*records: DataFrame) -> DataFrame:
    """Lengths over several FASTA tables, of repeated ids the last."""
    return fasta.lengths(fasta.concatenate(*records).withColumn("record_ord", F.col("part") * F.lit(2**58) + F.col("record_ord")))
