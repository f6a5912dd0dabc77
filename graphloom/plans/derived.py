"""Genes, alignments and sequences derived from the tables part and lineitem, for queries over growing inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.functions.ids import MAIN_CHROMS
from graphloom.sources.shared import written

VARIETIES = ["STANDARD", "ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL"]
REFERENCE = "STANDARD"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gene_id(variety: Column, key: Column) -> Column:
    return F.concat(variety, F.lit(".g"), key.cast("string"))


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene_id, gene_len, chrom, start, end, strand, bed_ord, variety: one gene per part."""
    key, brand = F.col("p_partkey"), F.substring("p_brand", 7, 9).cast("int")
    length = (500 + 100 * (key % 5)).cast("long")
    chrom = F.when(brand <= 21, F.element_at(F.array(*map(F.lit, MAIN_CHROMS)), F.least(brand, F.lit(21)))).otherwise(F.concat(F.lit("Ctg"), brand.cast("string")))
    return table(spark, sf_dir, "part").select(
        gene_id(F.col("p_type"), key).alias("gene_id"), length.alias("gene_len"), chrom.alias("chrom"), ((key % 7) * 100).cast("long").alias("start"),
        ((key % 7) * 100 + length).cast("long").alias("end"), F.when(key % 2 == 0, "+").otherwise("-").alias("strand"), key.cast("long").alias("bed_ord"), F.col("p_type").alias("variety"),
    )


PAIRED = ["l_orderkey", "p_size"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the gene and size of their part."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), gene_id(F.col("p_type"), F.col("p_partkey")).alias("qg"), "p_size")
    cents = lambda c: F.round(F.col(c) * 100).cast("int")
    return table(spark, sf_dir, "lineitem").join(part, "l_partkey").select(
        *PAIRED, "qg", F.col("l_linenumber").alias("la"), cents("l_discount").alias("dc"), cents("l_tax").alias("tx"),
        F.col("l_quantity").cast("int").alias("qy"), (F.col("l_returnflag") == "R").alias("is_secondary"), F.col("l_suppkey").alias("sk"),
    )


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records from pairs of lines in one order whose parts have one size: the first line's gene maps to the second's."""
    line = lines(spark, sf_dir)
    return _records(line.join(line.select(*PAIRED, F.col("qg").alias("target"), F.col("la").alias("lb")), PAIRED))


def stored_alignments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[DataFrame]]:
    """The same records over stored tables, and these. A line's pair with itself needs no join; only lines that are not alone in their order
    and size, few of all, are joined with one another."""
    line = written(lines(spark, sf_dir).dropna(subset=PAIRED), "lines")
    same = Window.partitionBy(*PAIRED)
    several = line.withColumns({"__n": F.count(F.lit(1)).over(same), "__a": F.row_number().over(same.orderBy("la", "qg"))})
    several = written(several.filter("__n > 1").drop("__n"), "several-lines")
    other = several.select(*PAIRED, F.col("qg").alias("target"), F.col("la").alias("lb"), F.col("__a").alias("__b"))
    pairs = several.join(other, PAIRED).filter("__a <> __b").drop("__a", "__b")
    own = line.withColumns({"target": F.col("qg"), "lb": F.col("la")})
    return _records(own.unionByName(pairs)), [line, several]


def _records(pairs: DataFrame) -> DataFrame:
    rows = pairs.withColumns({"soft": 20 * F.col("dc"), "mlen": 900 + 2 * F.col("qy") - 20 * F.col("dc"), "k": F.col("qy") % 3})
    intron = (50 + 10 * (F.col("qy") % 4)).cast("string")
    text = lambda c: c.cast("string")
    body = (
        F.when(F.col("k") == 0, F.concat(text(F.col("mlen")), F.lit("M")))
        .when(F.col("k") == 1, F.concat(F.lit("100M"), intron, F.lit("N"), text(F.col("mlen") - 100), F.lit("M")))
        .otherwise(F.concat(F.lit("100M"), intron, F.lit("N60M200N"), text(F.col("mlen") - 160), F.lit("M")))
    )
    return rows.select(
        ((F.col("l_orderkey") * 10 + F.col("la")) * 10 + F.col("lb")).cast("long").alias("rec_ord"),
        F.concat("qg", F.lit("."), text(F.col("la"))).alias("query_id"), "target",
        (F.col("sk") % 50 == 7).alias("is_unmapped"), "is_secondary", (F.col("sk") % 50 == 9).alias("is_supplementary"),
        ((F.col("sk") % 3) * 10).cast("long").alias("pos0"),
        F.concat(F.when(F.col("soft") > 0, F.concat(text(F.col("soft")), F.lit("S"))).otherwise(F.lit("")), body).alias("cigar"),
        F.when(~F.col("is_secondary"), F.col("mlen") + F.col("soft")).alias("seq_len"),
        F.when(F.col("la") % 2 == 0, F.col("mlen") - 14 * F.col("tx")).alias("as_score"), F.when(F.col("la") % 3 == 0, F.col("mlen") - 28 * F.col("tx")).alias("ms_score"),
        (14 * F.col("tx")).alias("nm"),
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_ord, record_id and seq of each gene: letters from the digest of its id, over its length."""
    g = genes(spark, sf_dir)
    unit = F.translate(F.md5("gene_id"), "0123456789abcdef", "ACGTacgtACGTNRYK")
    return g.select(F.col("bed_ord").alias("record_ord"), F.col("gene_id").alias("record_id"), F.substring(F.repeat(unit, 32), F.lit(1), F.col("gene_len").cast("int")).alias("seq"))


#: The same derivation for DuckDB: gene, al (alignments with their parts in place of the CIGAR), kept (quality filter), edge, seqs.
SQL = """
gene as (
    select p_type || '.g' || p_partkey as gene_id, (500 + 100 * (p_partkey % 5))::bigint as gene_len,
           case when substr(p_brand, 7)::int <= 21 then substr('AAAAAAABBBBBBBDDDDDDD', substr(p_brand, 7)::int, 1) || ((substr(p_brand, 7)::int - 1) % 7 + 1)
                else 'Ctg' || substr(p_brand, 7) end as chrom,
           ((p_partkey % 7) * 100)::bigint as start, ((p_partkey % 7) * 100 + 500 + 100 * (p_partkey % 5))::bigint as "end",
           case when p_partkey % 2 = 0 then '+' else '-' end as strand, p_partkey::bigint as bed_ord, p_type as variety, p_size
    from part
), li as (
    select l_orderkey, l_linenumber, l_suppkey, l_returnflag, round(l_discount * 100)::int as dc, round(l_tax * 100)::int as tx, l_quantity::int as qy,
           gene_id, p_size
    from lineitem join gene on bed_ord = l_partkey
), al as (
    select ((a.l_orderkey * 10 + a.l_linenumber) * 10 + b.l_linenumber)::bigint as rec_ord, a.gene_id as qg, a.gene_id || '.' || a.l_linenumber as query_id,
           b.gene_id as target, a.l_suppkey % 50 = 7 as is_unmapped, a.l_returnflag = 'R' as is_secondary, a.l_suppkey % 50 = 9 as is_supplementary,
           ((a.l_suppkey % 3) * 10)::bigint as pos0, 20 * a.dc as soft, 900 + 2 * a.qy - 20 * a.dc as mlen, a.qy % 3 as k, 50 + 10 * (a.qy % 4) as intron,
           14 * a.tx as nm, case when a.l_linenumber % 2 = 0 then 900 + 2 * a.qy - 20 * a.dc - 14 * a.tx end as as_score,
           case when a.l_linenumber % 3 = 0 then 900 + 2 * a.qy - 20 * a.dc - 28 * a.tx end as ms_score
    from li a join li b on a.l_orderkey = b.l_orderkey and a.p_size = b.p_size
), ql as (
    select *, case when is_secondary then mlen else mlen + soft end as qlen from al where not is_unmapped and not is_supplementary
), kept as (
    select * from ql
    where qg = target or (mlen::double / qlen >= 0.8::double and 1.0::double - nm::double / mlen >= 0.9::double and soft::double / qlen <= 0.1::double)
), edge as (
    select distinct qg as src, target as dst from kept
), seqs as (
    select bed_ord as record_ord, gene_id as record_id, substr(repeat(translate(md5(gene_id), '0123456789abcdef', 'ACGTacgtACGTNRYK'), 32), 1, gene_len) as seq, gene_len
    from gene
)
"""
