"""Substring dedup: FM-indexes by shard, searched backward for windows of words that start in an earlier document too.

Each window of ``window`` words has an anchor, the least hash of its runs of ``gram`` words, so equal windows have equal anchors.
Anchors that several documents hold lead to the windows worth a search. These are segments, runs of windows with one anchor, and each
distinct segment is kept once, with the first document that holds it. Segments of anchors that many documents hold are cut down to
windows whose own hash two documents share, so that a passage which a third of all documents quote in different places becomes a
few distinct pieces. Pieces go to their anchor's shard, which builds an FM-index over all of them and streams them through it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import SLICE_BYTES, Words, release, releasing, text_slices, written
from graphloom.llm.fm_index import FMIndex

#: Tasks of the search at most; beyond, a task takes several shards one after the other.
MAX_TASKS = 5_000
PIECE = ["digest", "owner", "anchor", "at", "n_windows", "body"]


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n values in a row."""
    out, k = x, 1
    while 2 * k <= n:
        out = np.minimum(out[: len(out) - k], out[k:])
        k *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - k : n - k + len(x) - n + 1]) if len(x) >= n else x[:0]


def _windows(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts (word numbers), anchors and text numbers of all windows that lie in one text."""
    anchors = _sliding_min(words.grams(gram), window - gram + 1)
    doc = np.searchsorted(words.bounds, np.arange(len(anchors)), side="right") - 1
    inside = np.flatnonzero(np.arange(len(anchors)) + window <= words.bounds[doc + 1]) if len(anchors) else np.zeros(0, np.int64)
    return inside, anchors[inside].view(np.int64), doc[inside]


def _anchors(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                _, anchor, doc = _windows(Words(data, offsets), window, gram)
                order = np.lexsort((anchor, doc))
                anchor, doc = anchor[order], doc[order]
                new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]) if len(doc) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[new]), *(rows.column(c).take(pa.array(doc[new])) for c in ("id", "tie"))], ["anchor", "id", "tie"])

    return releasing(run)


def _segments(window: int, gram: int):
    """Runs of windows with one shared anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                words = Words(data, offsets)
                start, anchor, doc = _windows(words, window, gram)
                shared, hot = (rows.column(c) for c in ("shared", "hot"))
                raw, out = data.tobytes(), []
                first = np.searchsorted(doc, np.arange(rows.num_rows + 1))
                for d in range(rows.num_rows):
                    if not shared[d].is_valid or first[d] == first[d + 1]:
                        continue
                    own, at = anchor[first[d] : first[d + 1]], start[first[d] : first[d + 1]]
                    marks = np.sort(np.asarray(shared[d].as_py(), np.int64))
                    often = frozenset(hot[d].as_py() or [])
                    if not len(marks):
                        continue
                    wanted = marks[np.minimum(np.searchsorted(marks, own), len(marks) - 1)] == own
                    edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]]))
                    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                        if wanted[a]:
                            x, y = int(at[a]), int(at[b - 1]) + window
                            body = b" ".join(raw[i:j] for i, j in zip(words.starts[x:y].tolist(), words.ends[x:y].tolist(), strict=True))
                            key = int(own[a])
                            out.append((d, key, key in often, x - int(words.bounds[d]), b - a, body))
                if out:
                    d, key, often, begin, n, body = zip(*out, strict=True)
                    columns = [pa.array(key, pa.int64()), pa.array(often), pa.array(begin, pa.int64()), pa.array(n, pa.int64()), pa.array(body, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*(rows.column(c).take(pa.array(d)) for c in ("id", "tie")), *columns], ["id", "tie", "anchor", "hot", "begin", "n_windows", "body"])

    return releasing(run)


def _window_hashes(window: int):
    """Of distinct segments: each window's place and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "body"):
                words = Words(data, offsets)
                n = np.maximum(np.diff(words.bounds) - window + 1, 0)
                of = np.repeat(np.arange(len(n)), n)
                at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                hashes = words.grams(window)[words.bounds[of] + at] if len(of) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([*(rows.column(c).take(pa.array(of)) for c in ("digest", "owner", "last")), pa.array(at), pa.array(hashes.view(np.int64))], ["digest", "owner", "last", "at", "hash"])

    return releasing(run)


def _cut(window: int):
    """Of segments: the runs of windows that ``kept`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, (body, kept) in enumerate(zip(batch.column("body").to_pylist(), batch.column("kept").to_pylist(), strict=True)):
                words, at = body.split(b" "), np.sort(np.asarray(kept, np.int64))
                for part in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                    i, n = int(part[0]), len(part)
                    out.append((row, i, n, b" ".join(words[i : i + n - 1 + window])))
            if out:
                row, at, n, body = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(row)) for c in ("digest", "owner", "anchor")), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(body, pa.binary())], PIECE)

    return releasing(run)


def _single_windows(window: int):
    """Pieces window by window, each with its own hash as anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "body", SLICE_BYTES // 16):
                words, raw = Words(data, offsets), data.tobytes()
                n = np.maximum(np.diff(words.bounds) - window + 1, 0)
                of = np.repeat(np.arange(len(n)), n)
                at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                first = words.bounds[of] + at
                body = [raw[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first + window - 1].tolist(), strict=True)]
                begin = rows.column("at").to_numpy()[of] + at
                columns = [*(rows.column(c).take(pa.array(of)) for c in ("digest", "owner")), pa.array(words.grams(window)[first].view(np.int64)), pa.array(begin), pa.array(np.ones(len(of), np.int64)), pa.array(body, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, PIECE)

    return releasing(run)


def _search(window: int):
    """One shard: each distinct piece with the windows that an earlier document than its own first one holds, as text "from-to,..."."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("owner", kind="stable")
        ids: dict[bytes, int] = {}
        sequences = [np.array([ids.setdefault(w, len(ids) + 1) for w in body.split(b" ")], np.int64) for body in g["body"]]
        owners = g["owner"].to_numpy(np.int64)
        rank = np.unique(owners, return_inverse=True)[1].astype(np.int32)  # owners by their order, in half the space
        index = FMIndex(sequences, rank, len(ids) + 1)
        sizes = np.array([len(s) for s in sequences])
        end = np.cumsum(sizes)
        found = index.windows_held_earlier(np.concatenate(sequences), end - sizes, end, rank, window)
        texts = []
        for x in found:
            cut = np.flatnonzero(np.diff(x) > 1)
            texts.append(",".join(f"{a}-{b + 1}" for a, b in zip(x[np.concatenate([[0], cut + 1])].tolist(), x[np.concatenate([cut, [len(x) - 1]])].tolist(), strict=True)) if len(x) else "")
        del index, sequences, ids
        release()
        return pd.DataFrame({"piece": g["piece"].to_numpy(), "owner": owners, "windows": texts})

    return run


def repeated_windows(documents: DataFrame, window: int = 50, gram: int = 16, hot_docs: int = 64, shard_words: int = 800_000) -> DataFrame:
    """Word ranges that repeat: id (doc_id, the largest long for null), tie (xxhash64 of the text), begin and end of words, all of
    whose windows of ``window`` words also start in a row with a smaller id. Ranges may overlap. Rows of one id never count as earlier than
    one another; a null id is later than all others.

    ``hot_docs`` and ``shard_words`` decide only how windows get to an index: an anchor of more documents has its distinct segments cut to
    windows that two documents share, and an anchor with more than ``shard_words`` words left is dealt window by window. A segment that
    an earlier document has word for word (by md5) is a repeat as a whole; the index judges the windows of each segment's first document.
    """
    docs = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    anchors = written(docs.mapInArrow(_anchors(window, gram), "anchor long, id long, tie long"), "anchors")
    shared = written(anchors.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n")).filter("a < b").select("anchor", (F.col("n") > hot_docs).alias("often")), "anchors-shared")
    marks = anchors.join(shared, "anchor").groupBy("id", "tie").agg(F.collect_set("anchor").alias("shared"), F.collect_set(F.when(F.col("often"), F.col("anchor"))).alias("hot"))
    schema = "id long, tie long, anchor long, hot boolean, begin long, n_windows long, body binary"
    parts = written(docs.join(marks, ["id", "tie"]).mapInArrow(_segments(window, gram), schema).withColumn("digest", F.unhex(F.md5("body"))), "segments")
    firsts = [F.first(c).alias(c) for c in ("body", "anchor", "hot", "n_windows")]
    distinct = written(parts.groupBy("digest").agg(*firsts, F.min("id").alias("owner"), F.max("id").alias("last")), "segments-distinct")

    # a hot segment that two documents share stays whole; of one document's own, windows stay that another segment has too
    hot = distinct.filter("hot")
    hashed = "digest binary, owner long, last long, at long, hash long"
    each = written(hot.select("digest", "owner", "last", "body").mapInArrow(_window_hashes(window), hashed), "windows")
    twice = written(each.groupBy("hash").agg(F.min("owner").alias("a"), F.max("last").alias("b")).filter("a < b").select("hash"), "windows-shared")
    kept = each.filter("owner = last").select("digest", "at", "hash").join(twice, "hash", "left_semi").groupBy("digest").agg(F.collect_set("at").alias("kept"))
    piece = "digest binary, owner long, anchor long, at long, n_windows long, body binary"
    cut = hot.filter("owner = last").select("digest", "owner", "anchor", "body").join(kept, "digest").mapInArrow(_cut(window), piece)
    whole = distinct.filter("not hot or owner < last").withColumn("at", F.lit(0).cast("long"))
    pieces = written(whole.select(*PIECE, "hot").unionByName(cut.withColumn("hot", F.lit(True))), "pieces")
    words = pieces.groupBy("anchor").agg(F.sum(F.col("n_windows") + window - 1).alias("n"))
    large = written(words.filter(F.col("n") > shard_words).select("anchor"), "anchors-large")
    if not large.isEmpty():
        single = pieces.join(large, "anchor", "left_semi").select(*PIECE).mapInArrow(_single_windows(window), piece)
        pieces = written(pieces.join(large, "anchor", "left_anti").unionByName(single.withColumn("hot", F.lit(True))), "pieces")
    pieces = pieces.withColumn("piece", F.when(F.col("hot"), F.unhex(F.md5("body"))).otherwise(F.col("digest")))
    again = pieces.filter("hot").groupBy("piece").agg(F.first("body").alias("body"), F.first("anchor").alias("anchor"), F.min("owner").alias("owner"))
    searched = written(pieces.filter("not hot").select("piece", "body", "anchor", "owner").unionByName(again), "pieces-distinct")
    n_words = searched.agg(F.coalesce(F.sum(F.size(F.split(F.decode("body", "ISO-8859-1"), " ")).cast("long")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-n_words // shard_words))
    judged = searched.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).repartition(min(shards, MAX_TASKS), "shard").groupBy("shard").applyInPandas(_search(window), "piece binary, owner long, windows string")
    judged = written(judged, "pieces-judged").withColumnRenamed("owner", "first")

    # a piece of a later document than the piece's first one repeats all of it
    ranges = F.when(F.col("owner") > F.col("first"), F.concat(F.lit("0-"), F.col("n_windows").cast("string"))).otherwise(F.col("windows"))
    own = pieces.select("digest", "owner", "at", "n_windows", "piece").join(judged, "piece").withColumn("range", F.explode(F.split(ranges, ","))).filter("range <> ''")
    place = lambda k: F.col("at") + F.split_part("range", F.lit("-"), F.lit(k)).cast("long")
    own = written(own.groupBy("digest").agg(F.collect_list(F.struct(place(1).alias("from"), place(2).alias("to"))).alias("ranges")), "segments-judged")
    owners = distinct.select("digest", "owner").join(own, "digest", "left")
    found = parts.select("id", "tie", "begin", "n_windows", "digest").join(owners, "digest")
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("n_windows").alias("to")))
    found = found.withColumn("range", F.explode(F.when(F.col("id") > F.col("owner"), all_).otherwise(F.col("ranges"))))
    return found.select("id", "tie", (F.col("begin") + F.col("range.from")).alias("begin"), (F.col("begin") + F.col("range.to") + window - 1).alias("end"))


def remove_repeats(documents: DataFrame, window: int = 50, **parameters) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text for each row of ``documents``: without the words in repeated_windows(), joined by one space.

    Windows are judged on the input. A null or empty text has no words. Rows alike in doc_id and text each get the same answer.
    """
    gone = repeated_windows(documents, window, **parameters).groupBy("id", "tie").agg(F.collect_set(F.struct("begin", "end")).alias("gone"))
    docs = documents.select("doc_id", "text").withColumns({"id": F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), "tie": F.xxhash64(F.coalesce("text", F.lit("")))})
    joined = docs.join(written(gone, "ranges"), ["id", "tie"], "left").select("doc_id", "text", F.col("gone.begin").alias("begin"), F.col("gone.end").alias("end"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            n, removed, kept = [], [], []
            for text, begin, end in zip(texts, batch.column("begin").to_pylist(), batch.column("end").to_pylist(), strict=True):
                words = (text or b"").split()
                n.append(len(words))
                if begin:
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, np.array(begin), 1)
                    np.add.at(step, np.array(end), -1)
                    stays = (np.cumsum(step)[:-1] == 0).tolist()
                    words = [w for w, s in zip(words, stays, strict=True) if s]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept binary").withColumn("kept_text", F.decode("kept", "UTF-8")).drop("kept")
