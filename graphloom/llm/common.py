"""Shared helpers of the corpus operators: inputs, the shared folder, and vectorised word hashing."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six characters that separate words: space and U+0009 to U+000D.
BLANKS = "\t\n\x0b\x0c\r "
#: Bytes of text that one numpy pass looks at; its temporary arrays take about 60 times as much.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
#: Blanks and ASCII punctuation.
PUNCTUATION = _SPACE.copy()
PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_P, _Q = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_local: dict[str, str] = {}  # of each local application without the setting


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors see; a temporary one only where that is unset and Spark is local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = _local.setdefault(spark.sparkContext.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="graphloom-")
        _local[spark.sparkContext.applicationId] = at
    return at.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Writes ``df`` into the shared folder and reads it back: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Gives freed memory back to the system: a Python worker lives on after its task, and the next one may be another's."""
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library keeps it


def releasing(run: Callable) -> Callable:
    """A function over batches that releases its memory when it ends."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER_LETTERS)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 4096) - 1, _P)]), dtype=np.uint64)
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of bytes, none of them empty."""
    if not len(lens):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum())) - np.repeat(first, lens)
    # bytes are 1..256 so that leading zeros count; the sum wraps modulo 2^64
    with np.errstate(over="ignore"):
        part = (data[np.repeat(starts, lens) + place].astype(np.uint64) + np.uint64(1)) * powers(int(lens.max()))[place]
    return mix(np.add.reduceat(part, first))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of several texts: byte ranges, 64-bit hashes and, for each text, its range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, breaks: np.ndarray = _SPACE, hashed: bool = True):
        """``breaks``: which bytes stand between words, instead of the blanks."""
        self.data, self.offsets = data, offsets
        n = len(data)
        solid = ~breaks[data]
        edge = offsets[(offsets > 0) & (offsets < n)]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        before[edge], after[edge - 1] = False, False
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        if hashed:
            self.hashes = span_hashes(_ASCII_LOWER[data] if lower else data, self.starts, self.ends - self.starts)
        self.bounds = np.searchsorted(self.starts, offsets)

    def grams(self, k: int) -> np.ndarray:
        """A hash of the k words from each word on; the last k - 1 of a text reach into the next one and mean nothing."""
        h, out = self.hashes, np.zeros(max(0, len(self.hashes) - k + 1), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                out = out * _Q + h[j : len(h) - k + 1 + j]
        return mix(out + np.uint64(k))


def fold(h: np.ndarray) -> int:
    """One hash for a sequence of word hashes, as Words.grams gives for its length."""
    v = 0
    for x in h.tolist():
        v = (v * int(_Q) + x) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([(v + len(h)) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in runs of about ``limit`` bytes of text with the texts' bytes and offsets; a null text is empty."""
    i, n = 0, batch.num_rows
    texts = batch.column(column)
    if not pa.types.is_large_binary(texts.type):
        texts = texts.cast(pa.binary()).cast(pa.large_binary()) if not pa.types.is_large_string(texts.type) else texts.cast(pa.large_binary())
    texts = texts.fill_null(b"")
    offs = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if n and texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j
