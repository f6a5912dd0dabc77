"""Files that tasks read in ranges of bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def open_at(path: str):
    """A file that can be read from any place, through the file system that the path names."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system.open_input_file(inner)


def sized(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and size of the files that Spark finds under ``path``, by path. Names are listed, nothing is read."""
    return sorted((r["path"], r["length"]) for r in spark.read.format("binaryFile").load(path).select("path", "length").collect())


#: Ranges of one job at most; beyond, ranges grow with the files.
MAX_RANGES = 20_000


def step_of(files: list[tuple[str, int]], range_mb: float) -> int:
    """Bytes of a range."""
    return max(1, int(range_mb * (1 << 20)), -(-sum(size for _, size in files) // MAX_RANGES))


def ranges(spark: SparkSession, files: list[tuple[str, int]], step: int) -> DataFrame:
    """number (from 0, along the files), file_no, path, size, start and end of ranges of ``step`` bytes, one in each partition."""
    rows = [(k, path, size, at, min(size, at + step)) for k, (path, size) in enumerate(files) for at in range(0, size, step)]
    numbered = [(i, *r) for i, r in enumerate(rows)]
    table = spark.createDataFrame(numbered, "number long, file_no long, path string, size long, start long, end long")
    return table.repartitionByRange(max(1, len(rows)), "number")
