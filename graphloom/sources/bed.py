"""BED gene annotation: chrom, start, end, gene_id, score, strand, from raw lines with an ordinal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str) -> DataFrame:
    """bed_ord and raw lines; bed_ord ascends along each file."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("bed_ord"), F.col("value").alias("raw"))


def parse(lines: DataFrame) -> DataFrame:
    """Rows of six columns or more, in file order, as they stand; shorter rows are left out."""
    f = F.split(F.rtrim("raw"), "\t")
    rows = lines.withColumn("f", f).filter(F.size("f") >= 6)
    return rows.select("bed_ord", "raw", F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("start"), F.col("f")[2].cast("long").alias("end"), F.col("f")[3].alias("gene_id"), F.col("f")[4].alias("score"), F.col("f")[5].alias("strand"))


def last_places(rows: DataFrame) -> DataFrame:
    """One place per gene, from its last row, with start <= end."""
    place = F.struct("chrom", F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end"), "strand", "raw")
    return rows.groupBy("gene_id").agg(F.max_by(place, "bed_ord").alias("p"), F.max("bed_ord").alias("bed_ord")).select("gene_id", "p.*", "bed_ord")


def package_rows(lines: DataFrame) -> DataFrame:
    """For graph packages: blank lines are dropped, four columns are enough (the strand is "." then), equal rows of a gene become the
    first; fewer columns or different rows of one gene are an error."""
    f = F.split(F.rtrim("raw"), "\t")
    rows = lines.filter(F.trim("raw") != "").withColumn("f", f)
    field = lambda k: F.when(F.size("f") > k, F.col("f")[k])
    ok = F.when(F.size("f") >= 4, F.col("f")[3]).otherwise(F.raise_error(F.concat(F.lit("BED row with fewer than 4 columns: "), "raw")).cast("string"))
    rows = rows.select("bed_ord", "raw", F.col("f")[0].alias("chrom"), field(1).cast("long").alias("start"), field(2).cast("long").alias("end"), ok.alias("gene_id"), F.coalesce(field(5), F.lit(".")).alias("strand"))
    place = F.struct("chrom", "start", "end", "strand")
    per = rows.groupBy("gene_id").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.min("bed_ord").alias("bed_ord"), F.min_by("raw", "bed_ord").alias("raw"))
    same = F.when(F.col("a") == F.col("b"), F.col("gene_id")).otherwise(F.raise_error(F.concat(F.lit("different BED rows of gene "), "gene_id")).cast("string"))
    return per.select(same.alias("gene_id"), "a.*", "bed_ord", "raw")


def subset(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The last row of each wanted gene; with a column pos in ``wanted`` that gives the order."""
    columns = ["gene_id", *(["pos"] if "pos" in wanted.columns else [])]
    last = rows.groupBy("gene_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "gene_id"]), "bed_ord").alias("r"))
    return wanted.select(*columns).distinct().join(last, "gene_id").select(*columns, "r.*")


def varieties(rows: DataFrame, without: list[str] | None = None) -> DataFrame:
    """variety and first_ord: what stands before the first dot of the gene ids, in the order of their first rows; ids that begin with one
    of ``without`` are left out."""
    if without:
        rows = rows.filter(~F.exists(F.array(*map(F.lit, without)), lambda p: F.startswith("gene_id", p)))
    return rows.groupBy(F.substring_index("gene_id", ".", 1).alias("variety")).agg(F.min("bed_ord").alias("first_ord"))
