"""Alignment records: quality filter, edges, the best record of a transcript."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions import cigar
from graphloom.functions.ids import gene_of, safe_ratio
from graphloom.operators import validate
from graphloom.operators.ranks import numbered

#: Least coverage and identity, most soft clipping.
COVERAGE, IDENTITY, SOFT_CLIP = 0.80, 0.90, 0.10
#: Names the rules of quality_filter(); to be changed with them, so that graphs of different rules are told apart.
FILTER_LOGIC = "own gene or thresholds on M=XI and D sums, 1"


def primary_lines(alignments: DataFrame) -> DataFrame:
    """Without unmapped and supplementary records; secondary ones stay."""
    return alignments.filter(~F.col("is_unmapped") & ~F.col("is_supplementary"))


def _sums() -> dict[str, Column]:
    return {name: cigar.lengths(F.col("cigar"), letters) for name, letters in (("mlen", "M=XI"), ("aln_len", "M=XID"), ("soft", "S"))}


def summarise_cigar(alignments: DataFrame) -> DataFrame:
    """Adds mlen (M, =, X, I), aln_len (with D) and soft (S)."""
    return alignments.withColumns(_sums())


def passes(t: Column) -> Column:
    """The thresholds over mlen, aln_len and soft of ``t``, seq_len and nm. A record without a sequence is as long as what it matches."""
    length = F.when(F.coalesce("seq_len", F.lit(0)) > 0, F.col("seq_len")).otherwise(t["mlen"])
    coverage, clipped = safe_ratio(t["mlen"], length), safe_ratio(t["soft"], length)
    identity = F.coalesce(F.lit(1.0) - F.try_divide(F.coalesce("nm", F.lit(0)).cast("double"), t["aln_len"].cast("double")), F.lit(1.0))
    return (coverage >= COVERAGE) & (identity >= IDENTITY) & (clipped <= SOFT_CLIP)


def passing(alignments: DataFrame) -> DataFrame:
    """Records that map a gene's transcript to the gene itself, or that pass the thresholds; targets are not looked at."""
    own = gene_of(F.col("query_id")) == F.col("target")
    sums = F.struct(*(c.alias(name) for name, c in _sums().items()))
    # exists() over one element: the sums are made once, and only where the gene is another
    return primary_lines(alignments).filter(own | F.exists(F.array(sums), passes))


def on_known_targets(rows: DataFrame, genes: DataFrame) -> DataFrame:
    """One semi-join on the target; Spark broadcasts the genes where they are small and shuffles otherwise."""
    return rows.join(genes.select(F.col("gene_id").alias("target")).distinct(), "target", "left_semi")


def quality_filter(alignments: DataFrame, genes: DataFrame) -> DataFrame:
    """Records on annotated targets that map a gene's transcript to the gene itself, or that pass the thresholds."""
    return summarise_cigar(on_known_targets(passing(alignments), genes))


#: What tells filtered alignments from raw ones: a comment in a header, a key in the metadata of a column.
FILTERED = "graphloom.filtered"


def marked_filtered(filtered: DataFrame) -> DataFrame:
    """The same rows, marked in the metadata of rec_ord, which Parquet files keep."""
    return filtered.withColumn("rec_ord", F.col("rec_ord").alias("rec_ord", metadata={FILTERED: True}))


def is_marked_filtered(alignments: DataFrame) -> bool:
    return any(f.metadata.get(FILTERED) for f in alignments.schema)


def merged(parts: list[tuple[DataFrame, DataFrame]], targets: DataFrame) -> DataFrame:
    """Records of several tables, from pairs of records and their own targets (name, length), all of which must be among ``targets`` with
    the same length. Adds part, the table's number: records follow one another by part and then rec_ord."""
    owns = reduce(DataFrame.unionByName, (own.select("name", "length") for _, own in parts)).distinct()
    both = owns.join(targets.select("name", F.col("length").alias("want")).distinct(), "name", "left")
    validate.require(both.filter("want is null").select("name"), "alignment targets that are no gene")
    validate.require(both.filter("want <> length").select("name"), "alignment targets of another length")
    return reduce(DataFrame.unionByName, (records.withColumn("part", F.lit(k)) for k, (records, _) in enumerate(parts)))


def in_one_order(tables: list[DataFrame]) -> DataFrame:
    """Filtered records of several tables, one after the other, numbered anew in rec_ord from 0; inside a table by part, where it has that
    column, and rec_ord. Any number of tables, and of runs on top of one another, keeps the order."""
    rows = None
    for k, t in enumerate(tables):
        t = t.withColumns({"__table": F.lit(k), "part": F.col("part") if "part" in t.columns else F.lit(0)})
        rows = t if rows is None else rows.unionByName(t, True)
    keys = ["__table", "part", "rec_ord", "query_id", "target", "pos0", "cigar"]
    return numbered(rows, "__place", keys).withColumn("rec_ord", F.col("__place")).drop("__table", "__place", "part")


def gene_edges(filtered: DataFrame) -> DataFrame:
    """Distinct (src, dst) from query genes to targets; loops stay."""
    return primary_lines(filtered).select(gene_of(F.col("query_id")).alias("src"), F.col("target").alias("dst")).distinct()


def best_of_targets(alignments: DataFrame) -> DataFrame:
    """For each query_id and target the best record that has an exon (best, null without any) and the first place of those (first_ord).

    Primary records first, then by AS (else ms, else 0), matched length, fewest mismatches; the first in record order among equals.
    """
    score, mlen = F.coalesce("as_score", "ms_score", F.lit(0)), cigar.lengths(F.col("cigar"), "M=XI")
    key = F.struct(F.col("is_secondary").alias("sec"), (-score).alias("score"), (-mlen).alias("mlen"), F.coalesce("nm", F.lit(0)).alias("nm"), "rec_ord", "pos0", "cigar")
    rows = primary_lines(alignments).select("query_id", "target", F.when(cigar.has_exon(F.col("cigar")), key).alias("__key"))
    # the hash first: rows are sorted by a number, as ids begin alike
    out = rows.groupBy(F.xxhash64("query_id", "target").alias("__h"), "query_id", "target").agg(F.min("__key").alias("best"), F.min("__key.rec_ord").alias("first_ord"))
    return out.drop("__h")


def best_of_members(records: DataFrame, members: DataFrame) -> DataFrame:
    """One record per transcript, of best_of_targets() and of those that map a cluster's member to its hub (``members``: hub, gene_id).
    tx_ord is the place of the transcript's first record."""
    rows = records.filter("best is not null").withColumn("gene_id", gene_of(F.col("query_id")))
    rows = rows.join(members.select(F.col("hub").alias("target"), "gene_id").distinct(), ["target", "gene_id"])
    key = F.struct(*(f"best.{c}" for c in ("sec", "score", "mlen", "nm", "rec_ord")), "target", "best.pos0", "best.cigar")
    rows = rows.groupBy("query_id").agg(F.min(key).alias("best"), F.min("first_ord").alias("tx_ord"))
    model = cigar.exons_and_splices(F.col("best.pos0"), cigar.cigar_ops(F.col("best.cigar")))
    rows = rows.select(F.col("query_id").alias("transcript_id"), gene_of(F.col("query_id")).alias("gene_id"), "best.target", "best.rec_ord", "tx_ord", model.alias("__model"))
    return rows.select("transcript_id", "gene_id", "target", "rec_ord", "tx_ord", "__model.exons", "__model.splices")


def best_alignments(alignments: DataFrame, members: DataFrame) -> DataFrame:
    """One record per transcript, of those that map a cluster's member to its hub (``members``: hub, gene_id) and have an exon. A transcript's
    records on one target are told apart before the join, which then meets few rows."""
    return best_of_members(best_of_targets(alignments), members)
