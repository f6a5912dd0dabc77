"""GTF files: rows, transcript models and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import cigar
from graphloom.functions import gtf as attributes
from graphloom.operators.validate import gtf_violations
from graphloom.operators.transcripts import GTF_COLUMNS


def read(spark: SparkSession, path: str) -> DataFrame:
    """line and raw; line ascends along each file."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.col("value").alias("raw"))


def parse(lines: DataFrame) -> DataFrame:
    """Rows of nine fields; comments and all other lines are left out."""
    f = F.split("raw", "\t")
    rows = lines.filter(~F.startswith("raw", F.lit("#"))).withColumn("f", f).filter(F.size("f") == 9)
    named = [F.col("f")[k].alias(c) for k, c in enumerate(GTF_COLUMNS)]
    return rows.select(F.col("line").alias("gtf_ord"), *named).withColumns({"start": F.col("start").try_cast("long"), "end": F.col("end").try_cast("long")})


def models(lines: DataFrame) -> DataFrame:
    """transcript_id, gene_id, tx_ord, exons and splices (the gaps between exons). Ends with an error that names the first broken rule."""
    bad = gtf_violations(lines).orderBy("line", "rule").limit(1).collect()
    if bad:
        raise ValueError(f"GTF line {bad[0]['line']}: {bad[0]['rule']} ({bad[0]['detail']})")
    rows = parse(lines).filter("feature in ('transcript', 'exon')")
    rows = rows.withColumns({"transcript_id": attributes.attribute(F.col("attributes"), "transcript_id"), "gene_id": attributes.attribute(F.col("attributes"), "gene_id")})
    exon = F.when(F.col("feature") == "exon", F.struct("start", "end"))
    per = rows.groupBy("transcript_id", "gene_id").agg(F.min("gtf_ord").alias("tx_ord"), F.array_sort(F.collect_list(exon)).alias("exons"))
    return per.withColumn("splices", cigar.gaps(F.col("exons")))


def lines_of(rows: DataFrame):
    return F.concat_ws("\t", *(F.col(c).cast("string") for c in GTF_COLUMNS))


def write(rows: DataFrame, path: str, order: list[str]) -> None:
    """Text lines of GTF rows, in ``order`` across the part files."""
    rows.orderBy(*order).select(lines_of(rows)).write.text(path)
