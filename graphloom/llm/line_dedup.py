"""Reversible line dedup: exact tables of how many documents hold a line, and sharded cuckoo filters of the frequent ones.

The state is two tables. ``counts`` has, for each line key's 128-bit digest, the number of documents that hold it; ``filters``
has one cuckoo filter per shard with the keys that at least ``min_docs`` documents hold. Adding documents raises counts and
inserts the keys that cross the limit; deleting documents lowers counts and deletes the keys that fall below it, which a cuckoo
filter can do, so that state after delete is state before insert. Cleaning asks the filter first and the exact counts then, for
the few lines that the filter lets through.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.common import BLANKS, text_slices, written

SLOTS = 4
#: Tasks that lines are dealt to at most; beyond, a task takes several filters one after the other.
MAX_TASKS = 20_000
_BLANKS = BLANKS.encode()


class CuckooFilter:
    """Partial-key cuckoo filter with 16-bit fingerprints in buckets of four, over digests given as two 64-bit halves."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, n) / (SLOTS * 0.85)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def loads(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dumps(self) -> bytes:
        return self.slots.tobytes()

    def _places(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.slots) - 1)
        print_ = np.maximum(low >> np.uint64(48), np.uint64(1))
        first = low & mask
        return print_.astype(np.uint16), first, first ^ self._jump(print_)

    def _jump(self, print_):
        with np.errstate(over="ignore"):
            return (np.asarray(print_, np.uint64) * np.uint64(0x5BD1E9955BD1E995) >> np.uint64(20)) & np.uint64(len(self.slots) - 1)

    def contains(self, low: np.ndarray) -> np.ndarray:
        p, a, b = self._places(low)
        return (self.slots[a] == p[:, None]).any(axis=1) | (self.slots[b] == p[:, None]).any(axis=1)

    def insert(self, low: np.ndarray) -> bool:
        """False if some key finds no place; the filter must then be built anew, larger."""
        for p, a, b in zip(*(x.tolist() for x in self._places(low)), strict=True):
            for at in (a, b):
                free = np.flatnonzero(self.slots[at] == 0)
                if len(free):
                    self.slots[at, free[0]] = p
                    break
            else:
                at = b
                for k in range(500):
                    self.slots[at, k % SLOTS], p = p, int(self.slots[at, k % SLOTS])
                    at ^= int(self._jump(p))
                    free = np.flatnonzero(self.slots[at] == 0)
                    if len(free):
                        self.slots[at, free[0]] = p
                        break
                else:
                    return False
        return True

    def delete(self, low: np.ndarray) -> None:
        """Of keys that were inserted only."""
        for p, a, b in zip(*(x.tolist() for x in self._places(low)), strict=True):
            for at in (a, b):
                held = np.flatnonzero(self.slots[at] == p)
                if len(held):
                    self.slots[at, held[0]] = 0
                    break


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANKS).lower()  # bytes.lower() is for A-Z only


def _code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "surrogatepass"))


def _keys(min_chars: int):
    """Digests of the distinct keys of each document, counted together over a batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, int] = {}
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                for key in {line_key(x) for x in (text or b"").split(b"\n")}:
                    if key and _code_points(key) >= min_chars:
                        seen[key] = seen.get(key, 0) + 1
            digests = b"".join(hashlib.md5(k).digest() for k in seen)
            both = np.frombuffer(digests, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(list(seen.values()), pa.int64())], ["low", "high", "n_docs"])

    return count


@dataclass(frozen=True)
class LineState:
    counts: DataFrame
    filters: DataFrame
    min_docs: int
    min_chars: int
    shards: int
    shard_keys: int


def empty_state(spark, min_docs: int = 10, min_chars: int = 1, shards: int = 1, shard_keys: int = 100_000) -> LineState:
    """No documents yet. ``shards``: of the filters to begin with; where more than ``shard_keys`` frequent lines come to one, all filters
    are built anew in at least twice as many shards, so that they stay small at any size."""
    return LineState(spark.createDataFrame([], "low long, high long, n_docs long"), spark.createDataFrame([], "shard int, filter binary"), min_docs, min_chars, shards, shard_keys)


def _changed(state: LineState, documents: DataFrame, sign: int) -> LineState:
    new = documents.select("text").mapInArrow(_keys(state.min_chars), "low long, high long, n_docs long")
    delta = new.groupBy("low", "high").agg((F.sum("n_docs") * sign).alias("change"))
    both = state.counts.withColumn("change", F.lit(0).cast("long")).unionByName(delta.withColumn("n_docs", F.lit(0).cast("long")))
    merged = written(both.groupBy("low", "high").agg(F.sum("n_docs").alias("before"), (F.sum("n_docs") + F.sum("change")).alias("n_docs")), "line-counts")
    counts = merged.filter("n_docs > 0").select("low", "high", "n_docs")
    crossed = merged.filter((F.col("before") >= state.min_docs) != (F.col("n_docs") >= state.min_docs))
    held = counts.filter(F.col("n_docs") >= state.min_docs)
    wanted, shards = -(-held.count() // state.shard_keys), state.shards
    if wanted > shards:
        shards = max(wanted, 2 * shards)
    shard = F.pmod(F.col("high"), F.lit(shards)).cast("int")
    crossed = crossed.select(shard.alias("shard"), "low", (F.col("n_docs") >= state.min_docs).alias("enters"))
    frequent = held.select(shard.alias("shard"), "low")

    def build(key: tuple, held: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
        if not len(moves):
            return held[["shard", "filter"]]
        low = moves["low"].to_numpy(np.int64).view(np.uint64)
        enters = moves["enters"].to_numpy(bool)
        f = CuckooFilter.loads(held["filter"].iloc[0]) if len(held) else CuckooFilter.sized(2 * int(enters.sum()))
        f.delete(low[~enters])
        if not f.insert(low[enters]):
            return pd.DataFrame({"shard": [int(key[0])], "filter": [b""]})  # full: built anew below
        return pd.DataFrame({"shard": [int(key[0])], "filter": [f.dumps()]})

    def anew(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
        low, n = keys["low"].to_numpy(np.int64).view(np.uint64), len(keys)
        while not (f := CuckooFilter.sized(n)).insert(low):
            n *= 2
        return pd.DataFrame({"shard": [int(key[0])], "filter": [f.dumps()]})

    schema = "shard int, filter binary"
    if shards > state.shards:
        return LineState(counts, written(frequent.groupBy("shard").applyInPandas(anew, schema), "line-filters"), state.min_docs, state.min_chars, shards, state.shard_keys)
    moved = written(state.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(build, schema), "line-filters")
    full = moved.filter(F.length("filter") == 0).select("shard")
    rebuilt = frequent.join(full, "shard", "left_semi").groupBy("shard").applyInPandas(anew, schema)
    filters = written(moved.filter(F.length("filter") > 0).unionByName(rebuilt), "line-filters")
    return LineState(counts, filters, state.min_docs, state.min_chars, shards, state.shard_keys)


def insert_documents(state: LineState, documents: DataFrame) -> LineState:
    """The state with ``documents`` added. Each row is a document; a null text is one empty line, which has no key."""
    return _changed(state, documents, 1)


def delete_documents(state: LineState, documents: DataFrame) -> LineState:
    """The state without ``documents``, which must have been added with the same texts."""
    return _changed(state, documents, -1)


def clean_lines(documents: DataFrame, state: LineState, broadcast_mb: int = 64, part_mb: int = 64) -> DataFrame:
    """``documents`` with n_lines, n_dropped and kept_text: without the lines that at least ``min_docs`` documents of the state hold.

    A line's key is the line without blanks at both ends and with A-Z lower-cased; keys of fewer than ``min_chars`` code points (and
    empty ones) stay. A null or empty text is one empty line. Columns of the three names are replaced.

    The filters, and the digests of frequent lines that the filters lead to, are broadcast while both are within ``broadcast_mb``.
    Beyond that, lines go to the filter of their shard, in as many parts of it as give each about ``part_mb`` of the texts, and those that
    it lets through are joined with the exact counts by digest.
    """
    documents = documents.drop("n_lines", "n_dropped", "kept_text")
    spark = documents.sparkSession
    frequent = state.counts.filter(F.col("n_docs") >= state.min_docs)
    n_bytes = state.filters.agg(F.coalesce(F.sum(F.length("filter")), F.lit(0)).alias("b")).first()["b"] + 16 * frequent.count()
    if n_bytes > broadcast_mb << 20:
        text_mb = (documents.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0) / (1 << 20)
        return _sharded(documents, frequent, state, max(1, math.ceil(text_mb / part_mb / state.shards)))
    filters = {r["shard"]: bytes(r["filter"]) for r in state.filters.collect()}
    exact = np.array([(r["low"], r["high"]) for r in frequent.select("low", "high").collect()], PAIR)
    shared = spark.sparkContext.broadcast((filters, np.sort(exact).tobytes()))
    schema = T.StructType([*documents.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("__kept", T.BinaryType())])
    return documents.mapInArrow(_dropper(shared, state.shards, state.min_chars), schema).withColumn("kept_text", F.decode("__kept", "UTF-8")).drop("__kept")


PAIR = np.dtype([("low", "<i8"), ("high", "<i8")])


def _lines(data: bytes, offsets: np.ndarray, min_chars: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The lines of several texts, how many each text has, and the digests' halves; (0, 0) where a line has no key."""
    lines: list[bytes] = []
    counts = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        own = data[a:b].split(b"\n")
        lines += own
        counts.append(len(own))
    none = bytes(16)
    digests = b"".join(hashlib.md5(k).digest() if (k := line_key(x)) and _code_points(k) >= min_chars else none for x in lines)
    both = np.frombuffer(digests, np.int64).reshape(-1, 2)
    return lines, np.array(counts, np.int64), both[:, 0], both[:, 1]


def _dropper(shared, shards: int, min_chars: int):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {k: CuckooFilter.loads(v) for k, v in shared.value[0].items()}
        exact = np.frombuffer(shared.value[1], PAIR)
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                lines, counts, low, high = _lines(data.tobytes(), offsets, min_chars)
                maybe = np.zeros(len(lines), bool)
                shard = high % shards
                for k, f in filters.items():
                    own = np.flatnonzero(shard == k)
                    maybe[own] = f.contains(low[own].view(np.uint64))
                dropped = np.zeros(len(lines), bool)
                if maybe.any() and len(exact):
                    asked = np.zeros(int(maybe.sum()), PAIR)
                    asked["low"], asked["high"] = low[maybe], high[maybe]
                    at = np.minimum(np.searchsorted(exact, asked), len(exact) - 1)
                    dropped[maybe] = exact[at] == asked
                gone = dropped.tolist()
                kept, n_dropped, i = [], [], 0
                for n in counts.tolist():
                    d = sum(gone[i : i + n])
                    kept.append(b"\n".join(lines[i : i + n]) if not d else b"\n".join(x for x, g in zip(lines[i : i + n], gone[i : i + n], strict=True) if not g))
                    n_dropped.append(d)
                    i += n
                columns = [*rows.columns, pa.array(counts), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names, "n_lines", "n_dropped", "__kept"])

    return drop


def _sharded(documents: DataFrame, frequent: DataFrame, state: LineState, spread: int) -> DataFrame:
    """clean_lines() without a broadcast: what is dropped depends on the text alone, so each distinct text is judged once."""
    text = F.coalesce("text", F.lit(""))
    of, min_chars = F.sha2(text, 256), state.min_chars

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                _, counts, low, high = _lines(data.tobytes(), offsets, min_chars)
                number = np.arange(len(low)) - np.repeat(np.cumsum(counts) - counts, counts)
                keyed = np.flatnonzero((low != 0) | (high != 0))
                which = np.repeat(np.arange(len(counts)), counts)[keyed]
                yield pa.RecordBatch.from_arrays([rows.column("of").take(pa.array(which)), *(pa.array(x[keyed]) for x in (number, low, high))], ["of", "line", "low", "high"])

    once = documents.select(of.alias("of"), text.alias("text")).groupBy("of").agg(F.first("text").alias("text"))
    lines = once.mapInArrow(explode, "of string, line long, low long, high long")
    lines = lines.withColumns({"shard": F.pmod("high", F.lit(state.shards)).cast("int"), "part": F.pmod(F.xxhash64("of"), F.lit(spread)).cast("int"), "filter": F.lit(None).cast("binary")})
    none = {"of": F.lit(None).cast("string"), **{c: F.lit(None).cast("long") for c in ("line", "low", "high")}}
    filters = state.filters.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(spread - 1))), **none})
    parts = min(state.shards * spread, MAX_TASKS)
    dealt = lines.unionByName(filters).repartition(parts, "shard", "part").sortWithinPartitions("shard", "part", F.col("filter").isNull())
    passed = dealt.mapInArrow(_probe, "of string, line long, low long, high long")
    gone = passed.join(written(frequent.select("low", "high"), "line-frequent"), ["low", "high"], "left_semi").groupBy("of").agg(F.collect_set("line").alias("gone"))
    out = documents.withColumn("__of", of).join(written(gone, "line-gone").withColumnRenamed("of", "__of"), "__of", "left")
    all_ = F.split(text, "\n", -1)
    left = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(F.filter(all_, lambda x, i: ~F.array_contains("gone", i.cast("long"))), "\n"))
    return out.withColumns({"n_lines": F.size(all_).cast("long"), "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long"), "kept_text": left}).select(*documents.columns, "n_lines", "n_dropped", "kept_text")


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lines that stand behind their shard's filter: those that it lets through. One filter is held at a time."""
    at, own = None, None
    for batch in batches:
        place = np.column_stack([batch.column(c).to_numpy() for c in ("shard", "part")])
        edge = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(axis=1), [True]]))
        low = batch.column("low").fill_null(0).to_numpy().view(np.uint64)
        passed = np.zeros(batch.num_rows, bool)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if tuple(place[a]) != at:
                at, own = tuple(place[a]), None
            if batch.column("filter")[a].is_valid:
                own, a = CuckooFilter.loads(batch.column("filter")[a].as_py()), a + 1
            if own is not None and a < b:
                passed[a:b] = own.contains(low[a:b])
        rows = pa.array(np.flatnonzero(passed))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in ("of", "line", "low", "high")], ["of", "line", "low", "high"])
