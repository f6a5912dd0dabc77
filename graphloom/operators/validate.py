"""Checks of inputs: each gives a DataFrame of violations, and require() ends a job that has some."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions import gtf
from graphloom.functions.ids import gene_of


def require(violations: DataFrame, what: str, show: int = 10) -> None:
    """Raises with the first ids of ``violations`` (one column is shown), if there are any."""
    found = [str(r[0]) for r in violations.orderBy(violations.columns[0]).limit(show + 1).collect()]
    if found:
        raise ValueError(f"{what}: " + ", ".join(found[:show]) + (", ..." if len(found) > show else ""))


def prefix_clashes(varieties: list[str]) -> list[tuple[str, str]]:
    """Repeated names and pairs of which one is a prefix of the other; the list is short and checked on the driver."""
    return [(a, b) for i, a in enumerate(varieties) for j, b in enumerate(varieties) if i != j and b.startswith(a) and (a != b or i < j)]


def variety_matches(genes: DataFrame, varieties: list[str]) -> DataFrame:
    """gene_id and n_varieties: of how many varieties the name is a prefix of the id."""
    n = sum((F.startswith("gene_id", F.lit(v)).cast("int") for v in varieties), F.lit(0))
    return genes.select("gene_id", n.alias("n_varieties"))


def missing_from(wanted: DataFrame, present: DataFrame, column: str = "gene_id") -> DataFrame:
    return wanted.select(column).distinct().join(present.select(column).distinct(), column, "left_anti")


def transcript_violations(history: DataFrame, sequences: DataFrame, graph_genes: DataFrame) -> DataFrame:
    """rule and detail: transcript ids on one side only, genes named Pan..., and genes outside the graph."""
    a, b = (x.select("transcript_id").distinct() for x in (history, sequences))
    genes = a.select(gene_of(F.col("transcript_id")).alias("gene_id")).distinct()
    rule = lambda df, name: df.select(F.lit(name).alias("rule"), F.col(df.columns[0]).alias("detail"))
    out = rule(a.join(b, "transcript_id", "left_anti"), "no sequence").unionByName(rule(b.join(a, "transcript_id", "left_anti"), "no model"))
    out = out.unionByName(rule(genes.filter(F.startswith("gene_id", F.lit("Pan"))), "renamed gene"))
    return out.unionByName(rule(missing_from(genes, graph_genes), "outside graph"))


def resume_violations(alignments: DataFrame, expected: DataFrame) -> DataFrame:
    """rule and query_id for the primary records of a resumed alignment against ``expected`` (query_id, seq_len, sha256): unexpected and
    missing queries, and those whose sequence is another one. Unmapped primary records count as present."""
    primary = alignments.filter(~F.col("is_secondary") & ~F.col("is_supplementary")).select("query_id", F.col("seq_len").alias("l"), F.col("seq_sha256").alias("h"))
    seen = primary.groupBy("query_id").agg(F.min(F.struct("l", "h")).alias("low"), F.max(F.struct("l", "h")).alias("high"))
    both = seen.join(expected, "query_id", "full")
    same = (F.col("low") == F.struct(F.col("seq_len").alias("l"), F.col("sha256").alias("h"))) & (F.col("low") == F.col("high"))
    rule = F.when(F.col("seq_len").isNull(), "unexpected").when(F.col("low").isNull(), "missing").when(~F.coalesce(same, F.lit(False)), "changed")
    return both.select(rule.alias("rule"), "query_id").filter("rule is not null")


def check_raw(alignments: DataFrame, expected: DataFrame, label: str, targets: tuple[DataFrame, DataFrame] | None = None, filtered: bool = False) -> None:
    """Raises unless alignments that are used again are raw, of exactly the ``expected`` transcripts (query_id, seq_len, sha256) and, where
    ``targets`` gives those of the header and those wanted (name, length each), on exactly these targets."""
    if filtered:
        raise ValueError(f"{label}: alignments are filtered already, give the raw ones")
    if targets:
        own, wanted = (t.select("name", "length").distinct() for t in targets)
        marked = own.withColumn("s", F.lit(1)).unionByName(wanted.withColumn("s", F.lit(2))).groupBy("name", "length").agg(F.sum("s").alias("s"))
        require(marked.filter("s <> 3").select("name").distinct(), f"{label}: targets other than the genes' sequences")
    require(resume_violations(alignments, expected).select(F.concat_ws(": ", "rule", "query_id")), f"{label}: transcripts other than expected")


def gtf_violations(rows: DataFrame) -> DataFrame:
    """rule, line and detail of GTF rows (line, raw): fields, ids, names, numbers, order, one place per transcript, exons and their gaps."""
    f = F.split("raw", "\t")
    split = rows.filter("raw <> '' and not startswith(raw, '#')").withColumns({"f": f, "n": F.size(f)})
    bad_fields = split.filter("n <> 9").select(F.lit("fields").alias("rule"), "line", F.col("n").cast("string").alias("detail"))
    at = lambda k: F.col("f")[k]
    attrs = split.filter("n = 9 and f[2] in ('transcript', 'exon')").select(
        "line", at(0).alias("seqname"), at(2).alias("feature"), at(3).try_cast("long").alias("start"), at(4).try_cast("long").alias("end"), at(6).alias("strand"),
        gtf.attribute(at(8), "gene_id").alias("gene_id"), gtf.attribute(at(8), "transcript_id").alias("transcript_id"),
    )
    named = (F.coalesce("gene_id", F.lit("")) != "") & (F.coalesce("transcript_id", F.lit("")) != "")
    per_row = F.array_compact(
        F.array(
            F.when(~named, "ids"),
            F.when(named & (F.col("seqname") != F.col("gene_id")), "sequence name"),
            F.when(named & (gene_of(F.col("transcript_id")) != F.col("gene_id")), "gene of transcript"),
            F.when(F.col("start").isNull() | F.col("end").isNull(), "coordinates"),
            F.when((F.col("start") < 1) | (F.col("end") < F.col("start")), "order"),
        )
    )
    by_row = attrs.select(F.explode(per_row).alias("rule"), "line", F.coalesce("transcript_id", F.lit("")).alias("detail"))
    exons = F.array_sort(F.collect_list(F.when(F.col("feature") == "exon", F.struct("start", "end"))))
    per = attrs.filter(named).groupBy("transcript_id").agg(
        F.min("line").alias("line"), F.count_distinct("seqname", "strand").alias("places"), F.count_if(F.col("feature") == "transcript").alias("heads"), exons.alias("exons")
    )
    tight = F.exists(F.sequence(F.lit(2), F.size("exons")), lambda i: F.element_at("exons", i)["start"] <= F.element_at("exons", i - 1)["end"] + 1)
    per_tx = F.array_compact(
        F.array(F.when(F.col("places") > 1, "place"), F.when(F.col("heads") == 0, "transcript row"), F.when(F.size("exons") == 0, "exons"), F.when((F.size("exons") > 1) & F.when(F.size("exons") > 1, tight).otherwise(False), "gaps"))
    )
    by_tx = per.select(F.explode(per_tx).alias("rule"), "line", F.col("transcript_id").alias("detail"))
    return bad_fields.unionByName(by_row).unionByName(by_tx)
