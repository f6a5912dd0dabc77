"""Mixing of sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.llm.common import written


def targets(totals: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """``totals`` (source, words) with target. Sources in code-point order, null last, take ``weights`` in turn and share ``share``
    times all words by weight; those above ``max_epochs`` times their own words are clamped there, and the excess goes to the others by
    weight until none is above. If all are clamped, their sum is less than the total.

    A source is clamped once its weight times the words for one unit of weight reaches its cap, and these words only grow from round to round.
    So a round is one aggregate over the sources, and only its sums reach the driver.
    """
    ranked = totals.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    ranked = written(ranked.withColumn("__at", F.monotonically_increasing_id()), "mix-sources").withColumn("__part", F.shiftright("__at", 33))
    held = ranked.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).collect()  # a row per partition
    before, so_far = {}, 0
    for r in sorted(held, key=lambda r: r["__part"]):
        before[r["__part"]] = so_far
        so_far += r["__n"]
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("__part")) if before else F.lit(0)
    turn = ((offset + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))) % len(weights)).cast("int")
    ranked = written(ranked.withColumn("__weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)).drop("__at", "__part"), "mix-sources")
    cap = F.col("words") * F.lit(float(max_epochs))
    unit, clamped = 0.0, -1
    while True:
        over = F.col("__weight") * F.lit(unit) >= cap if clamped >= 0 else F.lit(False)
        r = ranked.agg(
            F.coalesce(F.sum("words"), F.lit(0)).alias("all"), F.coalesce(F.sum(F.when(over, F.col("words"))), F.lit(0)).alias("full"),
            F.sum(F.when(~over, F.col("__weight"))).alias("open"), F.count(F.when(over, F.lit(1))).alias("n"),
        ).first()
        if r["n"] == clamped or not r["open"]:
            break
        unit, clamped = max(unit, (share * r["all"] - max_epochs * r["full"]) / r["open"]), r["n"]
    return ranked.withColumn("target", F.least(cap, F.col("__weight") * F.lit(unit)) if r["open"] else cap).drop("__weight")


def _quotas(g: pd.DataFrame) -> pd.DataFrame:
    """For one source, from its largest document size to its smallest: how many of the documents of a size are drawn once more, so
    that after each size the words drawn are as near to the fraction's share as documents of that size allow."""
    g = g.sort_values("size", ascending=False)
    part, left, drawn = float(g["fraction"].iloc[0]), 0.0, []
    for size, n in zip(g["size"].tolist(), g["n"].tolist(), strict=True):
        left += part * size * n
        k = max(0, min(n, round(left / size))) if size else 0
        left -= k * size
        drawn.append(k)
    return g.assign(drawn=drawn)[["source", "size", "n", "drawn"]]


def word_count(text: Column) -> Column:
    """The number of ``[^\\x20\\x09-\\x0D]+``: places where a word ends."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def mix(documents: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2, seed: int = 7, bucket_rows: int = 20_000) -> DataFrame:
    """``documents`` with size, source_size, target and copies: how often the mix takes each document.

    Sources in code-point order, null last, take ``weights`` in turn; size is the number of words, 0 for a null text. A source of
    target t and size s repeats each document floor(t/s) times; what is left of t is drawn by size: of a source's n documents of
    one size those with the smallest seeded hash of doc_id and text. Rows alike in both are drawn together or not at all. The draw
    goes from large to small, so what large documents leave over small ones make up. Empty documents are never drawn.
    Columns of ``documents`` with the four names are replaced.

    Only sums over the sources reach the driver. The walk over a source sees one row per
    distinct size. The last hash that is drawn is searched in buckets of about ``bucket_rows`` rows after equal rows are counted
    together, so copies that hold a third of all rows spread over many tasks.
    """
    own = documents.drop("size", "source_size", "target", "copies").withColumns({"size": word_count(F.col("text")), "__hash": F.xxhash64(F.lit(seed), "doc_id", "text")})
    rows = written(own.groupBy("source", "size", "__hash").agg(F.count(F.lit(1)).alias("n")), "mix-rows")
    by_size = written(rows.groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    totals = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    ratio = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    sources = targets(totals, weights, share, max_epochs).withColumn("ratio", ratio)
    sources = written(sources.select(F.col("source").alias("__source"), F.col("words").alias("source_size"), "target", F.floor("ratio").cast("int").alias("__whole"), (F.col("ratio") - F.floor("ratio")).alias("fraction")), "mix-targets")
    here = F.col("source").eqNullSafe(F.col("__source"))
    quotas = by_size.join(sources, here).select("source", "size", "n", "fraction").groupBy("source").applyInPandas(_quotas, "source string, size long, n long, drawn long")
    quotas = written(quotas.withColumn("buckets", F.ceil(F.col("n") / bucket_rows)), "mix-quotas")

    named = lambda df: df.withColumnsRenamed({"source": "__source", "size": "__size"})
    at = here & (F.col("size") == F.col("__size"))
    some = named(quotas.filter((F.col("drawn") > 0) & (F.col("drawn") < F.col("n"))).drop("n"))
    # the hash's high bits, as an unsigned number below 2^31, name the bucket
    unsigned = F.col("__hash").bitwiseXOR(F.lit(-(2**63)))
    part = rows.join(some, at).drop("__source", "__size").withColumn("bucket", F.floor(F.shiftrightunsigned(unsigned, 33) * F.col("buckets") / F.lit(2.0**31)))
    filled = part.groupBy("source", "size", "drawn", "bucket").agg(F.sum("n").alias("n"))
    so_far = Window.partitionBy("source", "size").orderBy("bucket")
    filled = filled.withColumn("below", F.sum("n").over(so_far) - F.col("n"))
    cut = filled.filter((F.col("below") < F.col("drawn")) & (F.col("below") + F.col("n") >= F.col("drawn")))
    cut = named(cut.select("source", "size", F.col("bucket").alias("cut"), (F.col("drawn") - F.col("below")).alias("rest")))
    inside = part.join(cut, at & (F.col("bucket") == F.col("cut")))
    inside = inside.withColumn("upto", F.sum("n").over(Window.partitionBy("source", "size").orderBy("__hash")))
    # all rows below the bucket, and those in it up to the last that fits
    last = inside.groupBy("source", "size").agg(F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("__hash"))), F.min("__hash") - 1).alias("last"))
    limits = named(quotas).join(named(last).withColumnsRenamed({"__source": "__s", "__size": "__z"}), F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__size") == F.col("__z")), "left")
    sources = sources.withColumnRenamed("__source", "__s")
    limits = limits.drop("__s", "__z").join(sources, F.col("__source").eqNullSafe(F.col("__s"))).select("__source", "__size", "source_size", "target", "__whole", F.coalesce("last", F.when((F.col("drawn") > 0) & (F.col("drawn") >= F.col("n")), F.lit(2**63 - 1))).alias("last"))
    out = own.join(written(limits, "mix-limits"), at)
    drawn = F.coalesce((F.col("__hash") <= F.col("last")) & (F.col("size") > 0), F.lit(False)).cast("int")
    return out.withColumn("copies", (F.when(F.col("size") > 0, F.col("__whole")).otherwise(F.lit(0)) + drawn)).drop("__source", "__size", "__whole", "last", "__hash")


def mixed(documents: DataFrame, **parameters) -> DataFrame:
    """The mix itself: each document of ``documents`` as often as mix() takes it, with its own columns only."""
    plan = mix(documents, **parameters).filter(F.col("copies") > 0)
    return plan.withColumn("__copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*documents.columns)
