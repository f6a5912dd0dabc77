"""Identifiers of genes, transcripts and chromosomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The main chromosomes in their order.
MAIN_CHROMS = ("A1", "A2", "A3", "A4", "A5", "A6", "A7", "B1", "B2", "B3", "B4", "B5", "B6", "B7", "D1", "D2", "D3", "D4", "D5", "D6", "D7")


def gene_of(transcript: Column) -> Column:
    """A transcript id without its last dot and what follows; unchanged without a dot."""
    last = F.substring_index(transcript, ".", -1)
    return F.when(F.instr(transcript, ".") > 0, F.substring(transcript, F.lit(1), F.length(transcript) - F.length(last) - 1)).otherwise(transcript)


def grouping_gene_of(transcript: Column) -> Column:
    """As gene_of, but an id without a dot belongs to the gene "", as in transcript grouping."""
    return F.when(F.instr(transcript, ".") > 0, gene_of(transcript)).otherwise(F.lit(""))


def variety_of(gene: Column, varieties: list[str], reference_prefixes: list[str] | None = None) -> Column:
    """The first variety in list order that is a prefix of the gene id, else null; with reference prefixes these become "Refer"."""
    out = F.lit(None).cast("string")
    for v in reversed([v for v in varieties if v != "Refer"] if reference_prefixes else varieties):
        out = F.when(F.startswith(gene, F.lit(v)), F.lit(v)).otherwise(out)
    for p in reference_prefixes or ():
        out = F.when(F.startswith(gene, F.lit(p)), F.lit("Refer")).otherwise(out)
    return out


def has_prefix(gene: Column, prefixes: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, prefixes)), lambda p: F.startswith(gene, p)) if prefixes else F.lit(False)


def chrom_label(chrom: Column) -> Column:
    """A1 and 1A become 1A, for the letters A, B and D; all else is Ctg."""
    c = F.trim(chrom)
    return F.when(c.rlike("^[ABD][0-9]$"), F.concat(F.substring(c, 2, 1), F.substring(c, 1, 1))).when(c.rlike("^[0-9][ABD]$"), c).otherwise(F.lit("Ctg"))


def main_rank(chrom: Column, main_chroms: tuple[str, ...] = MAIN_CHROMS) -> Column:
    """Place in the list of main chromosomes from 0, null for all others."""
    at = F.array_position(F.array(*map(F.lit, main_chroms)), chrom)
    return F.when(at > 0, at - 1)


def chrom_order(chrom: Column, main_chroms: tuple[str, ...] = MAIN_CHROMS) -> list[Column]:
    """Sort keys: main chromosomes in list order, then the others by lower case and by themselves."""
    rank = main_rank(chrom, main_chroms)
    return [F.when(rank.isNotNull(), F.lit(0)).otherwise(F.lit(1)), F.coalesce(rank, F.lit(0)), F.when(rank.isNull(), F.lower(chrom)).otherwise(F.lit("")), chrom]


def pan_order(gene: Column) -> list[Column]:
    """Sort keys of Pan ids: chromosome number, subgenome A, B, D, then text and number; contigs and all other ids follow."""
    chrom, letter, number = (F.regexp_extract(gene, r"^Pan([0-9]+)([ABD])([0-9]+)$", k) for k in (1, 2, 3))
    contig = F.regexp_extract(gene, r"^PanCtg([0-9]+)$", 1)
    placed = letter != ""
    return [
        F.when(placed, F.expr("try_cast(0 as long)") + chrom.try_cast("long")).otherwise(F.lit(999)),
        F.when(placed, F.instr(F.lit("ABD"), letter) - 1).otherwise(F.lit(999)),
        F.when(placed, letter).when(contig != "", F.lit("Ctg")).when(F.startswith(gene, F.lit("Pan")), F.substring(gene, 4, 1_000_000)).otherwise(gene),
        F.when(placed, number.try_cast("long")).when(contig != "", contig.try_cast("long")).otherwise(F.lit(999_999_999)),
    ]


def safe_ratio(part: Column, whole: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
