"""Stored edge tables that grow by micro-batches of alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from graphloom.operators.alignment import gene_edges, quality_filter


def grow_edges(alignments: DataFrame, genes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the distinct edges of each micro-batch of a stream of alignments that the table in ``path`` has not yet."""

    def add(batch: DataFrame, number: int) -> None:
        new = gene_edges(quality_filter(batch, genes))
        spark = batch.sparkSession
        try:
            known = spark.read.parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        else:
            new = new.join(known, ["src", "dst"], "left_anti")
        new.write.mode("append").parquet(path)

    return alignments.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
