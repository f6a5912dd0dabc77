"""A training corpus from raw documents: five stages, each one operator of graphloom.llm on all that the stage before kept.

Every stage takes documents with doc_id and text (mixing: source too) and any other columns, whatever their names, and all but the last
give rows of the same columns. Null and empty texts, null and repeated ids, rows alike in all columns and empty tables are handled as each
stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import decontam, minhash_forest, mixing, token_output, toxicity
from graphloom.llm.common import new_path, table, written

#: SQL has neither a tokenizer nor the fitted toxicity model; tests/llm holds each stage against brute force or an exact round trip.
ORACLE_SQL = None


def _set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list]:
    """``docs`` with all columns but the needed ones under names that no operator uses, and what brings them back."""
    renamed = {c: c if c in needed else f"__own{i}" for i, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed(renamed), [F.col(new).alias(c) for c, new in renamed.items()]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted grammar scores below 0.3; each row is judged by its text, null and empty ones as texts without matches."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    own, back = _set_aside(docs, "doc_id", "text")
    return toxicity.score(own, model, 0.3).filter("predicted = 0").select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are alike to 0.8: the one with the least doc_id, then hash of the text.

    Rows with one doc_id and different texts are judged apart; of rows alike in both one stays. A null doc_id is the largest. Texts without
    words are in no group, and stay.
    """
    found = minhash_forest.near_duplicates(docs.select("doc_id", "text"), k=5, percent=80, with_tie=True)
    kept = written(found.filter("chosen").select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).distinct(), "kept-ids")
    own, back = _set_aside(docs, "doc_id", "text")
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    one = own.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (tie == F.col("__tie")), "left_semi").dropDuplicates(["doc_id", "text"])
    return one.select(*back)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item of which tiles cover 0.6; rows are judged by their texts, null and empty ones stay."""
    own, back = _set_aside(docs, "doc_id", "text")
    return decontam.decontaminate(own, table(spark, sf_dir, "benchmark")).select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights: a document stands as often as the mix takes it, one without words never; a null source is a
    source, the last. Rows alike in id and text are drawn together."""
    own, back = _set_aside(docs, "doc_id", "text", "source")
    return mixing.mixed(own).select(*back)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in grammar-compressed blocks; one row per document as read back from them, by ascending doc_id, null ids first. A null text
    has the end id alone."""
    import public_tokenizers

    path = new_path(spark, "pipeline-tokens")
    token_output.write_tokens(docs.select("doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read_tokens(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
