"""I-Match fingerprints: terms within a band of inverse document frequency, hashed in several randomised lexicon subsets.

The lexicon holds the terms whose idf lies in the band; a random subset of it keeps a term by a hash of the term and the subset's
seed, at one of several rates; with one seed, a sparser subset is part of the denser ones. For each subset a document's distinct
terms that are in it are sorted and hashed together. Two texts agree in a subset if not a single one of its terms differs, so dense
subsets tell copies apart and sparse ones still agree after edits. The likeness is the share of seeds whose sparsest subset that
either text has terms in agrees, which suits texts of ten words and of ten thousand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import PUNCTUATION, SLICE_BYTES, Words, mix, releasing, text_slices


@dataclass(frozen=True)
class IMatch:
    """``idf``: the band of ln(documents / documents with the term). A lexicon has at most (terms per document) * exp(band's end) terms."""

    idf: tuple[float, float] = (2.3, 6.9)
    subsets: int = 12
    rates: tuple[float, ...] = (1 / 2, 1 / 8, 1 / 32, 1 / 128, 1 / 512)
    chunk_docs: int = 20_000
    broadcast_terms: int = 4_000_000


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, term hash), sorted."""
    doc = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    order = np.lexsort((words.hashes, doc))
    doc, h = doc[order], words.hashes[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool)
    return doc[new], h[new]


def _counted(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(hashes), return_counts=True) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _batch(h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["term", "n"])


def _term_counts(share: float, chunk_docs: int, wanted=None):
    """Document counts of terms by chunks of documents: of the terms in ``wanted``, or of those that reach ``share`` in their chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.frombuffer(wanted.value, np.uint64) if wanted else None
        hashes: list[np.ndarray] = []
        docs = 0
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                _, h = _distinct(Words(data, offsets, lower=True, breaks=PUNCTUATION))
                if keep is not None and len(h):
                    h = h[keep[np.minimum(np.searchsorted(keep, h), len(keep) - 1)] == h] if len(keep) else h[:0]
                hashes.append(h)
                docs += rows.num_rows
                if docs >= chunk_docs or sum(map(len, hashes)) > 8_000_000:
                    t, n = _counted(hashes)
                    yield _batch(t, n) if keep is not None else _batch(t[n >= share * docs], n[n >= share * docs])
                    hashes, docs = [], 0
        t, n = _counted(hashes)
        yield _batch(t, n) if keep is not None else _batch(t[n >= share * docs], n[n >= share * docs])

    return releasing(run)


def lexicon(documents: DataFrame, p: IMatch) -> np.ndarray:
    """Sorted hashes of the terms in the band. Counts are exact and cover every row; null texts count as documents without terms.

    A term that reaches the band's least share of all documents reaches it in some chunk of them, so a first pass finds the terms that
    can, and a second counts only these. If there are too many to broadcast, all terms are counted by a shuffle.
    """
    spark, n_docs = documents.sparkSession, documents.count()
    least, most = n_docs * np.exp(-p.idf[1]), n_docs * np.exp(-p.idf[0])
    texts = documents.select("text")
    found = texts.mapInArrow(_term_counts(float(np.exp(-p.idf[1])), p.chunk_docs), "term long, n long").select("term").distinct().limit(p.broadcast_terms + 1).toPandas()["term"].to_numpy(np.int64)
    if len(found) <= p.broadcast_terms:
        wanted = spark.sparkContext.broadcast(np.sort(found.view(np.uint64)).tobytes())
        counts = texts.mapInArrow(_term_counts(0.0, p.chunk_docs, wanted), "term long, n long")
    else:
        counts = texts.mapInArrow(_term_counts(0.0, p.chunk_docs), "term long, n long")
    counts = counts.groupBy("term").agg(F.sum("n").alias("n")).filter((F.col("n") >= float(least)) & (F.col("n") <= float(most)))
    return np.sort(counts.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64))


def fingerprints(texts: list[bytes], lex: np.ndarray, p: IMatch) -> np.ndarray:
    """One row per text, one 16-bit hash per subset and rate, 0 where the subset has none of its terms; the last column hashes all terms."""
    words = Words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), lower=True, breaks=PUNCTUATION)
    doc, h = _distinct(words)
    out = np.zeros((len(texts), p.subsets * len(p.rates) + 1), np.uint16)

    def put(column: int, d: np.ndarray, value: np.ndarray) -> None:
        if len(d):
            first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
            with np.errstate(over="ignore"):
                total = mix(np.add.reduceat(value, first)) >> np.uint64(48)
            out[d[first], column] = np.maximum(total, np.uint64(1))

    put(out.shape[1] - 1, doc, mix(h))
    if len(h) and len(lex):
        inside = lex[np.minimum(np.searchsorted(lex, h), len(lex) - 1)] == h
        doc, h = doc[inside], h[inside]
        for s in range(p.subsets):
            d, own = doc, mix(h + np.uint64(7919 * (s + 1)))
            for k, rate in enumerate(p.rates):  # a sparser subset is part of the denser one with the same seed
                chosen = own < np.uint64(int(rate * 2**64))
                d, own = d[chosen], own[chosen]
                put(s * len(p.rates) + k, d, mix(own))
    return out


def likeness(a: np.ndarray, b: np.ndarray, p: IMatch) -> np.ndarray:
    """Of fingerprints row by row. Where no subset has a term of either text, 1 if the hashes of all terms are equal, else 0."""
    x, y = (f[:, :-1].reshape(len(f), p.subsets, len(p.rates)) for f in (a, b))
    either = (x != 0) | (y != 0)
    last = len(p.rates) - 1 - np.argmax(either[:, :, ::-1], axis=2)
    used = either.any(axis=2)
    same = (np.take_along_axis(x == y, last[:, :, None], axis=2)[:, :, 0] & used).sum(axis=1)
    n = used.sum(axis=1)
    return np.where(n > 0, same / np.maximum(n, 1), (a[:, -1] == b[:, -1]).astype(float))


def _hex(f: np.ndarray) -> list[str]:
    flat, n = f.astype(">u2").tobytes().hex(), 4 * f.shape[1]
    return [flat[i : i + n] for i in range(0, len(flat), n)]


def fingerprint_documents(documents: DataFrame, p: IMatch = IMatch()) -> DataFrame:
    """``documents`` with ``fingerprint``; a null text is empty and has a fingerprint of zeros. No row is shuffled."""
    shared = documents.sparkSession.sparkContext.broadcast(lexicon(documents, p).tobytes())

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        lex = np.frombuffer(shared.value, np.uint64)
        raw = [(t or "").encode() for t in texts]
        return pd.Series([x for run in _runs(raw) for x in _hex(fingerprints(run, lex, p))])

    return documents.withColumn("fingerprint", made(F.col("text")))


def _runs(raw: list[bytes]) -> Iterator[list[bytes]]:
    run, size = [], 0
    for t in raw:
        run.append(t)
        size += len(t)
        if size > SLICE_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def with_next(documents: DataFrame, bucket_mb: int = 16, max_parts: int = 10_000) -> DataFrame:
    """Rows of doc_id and text in partitions, such that a row's next document (descending doc_id, nulls last; rows of one id by a
    hash of the text; after the last the first) is the row behind it in its part. Columns part, ahead, doc_id, text and tie.

    Parts are ranges of (doc_id, tie), from bounds of a sample, so one repeated id does not fill one task. Each part ends with a copy of the
    first row of the part below, marked ``ahead``. Texts are shuffled once. There are at most ``max_parts`` parts, which bounds the sample (60 keys a
    part) and the greatest keys that reach the driver; parts may be of any size, as they are read as streams.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    keys = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), "tie", F.octet_length("text").cast("long").alias("size"))
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n = min(max_parts, max(1, total["b"] // (bucket_mb << 20)))
    pair = np.dtype([("id", "<i8"), ("tie", "<i8")])
    drawn = keys.select("id", "tie").sample(min(1.0, 60 * n / max(1, total["n"])), 11).toPandas() if n > 1 else pd.DataFrame({"id": [], "tie": []})
    sample = np.zeros(len(drawn), pair)
    sample["id"], sample["tie"] = drawn["id"], drawn["tie"]
    sample = np.sort(sample)
    bounds = np.unique(sample[[len(sample) * k // n for k in range(1, n)]]) if len(sample) else sample
    limits = spark.sparkContext.broadcast(bounds.tobytes())

    def part_of(ids: np.ndarray, ties: np.ndarray) -> np.ndarray:
        rows = np.zeros(len(ids), pair)
        rows["id"], rows["tie"] = ids, ties
        return np.searchsorted(np.frombuffer(limits.value, pair), rows, side="right")

    @F.pandas_udf("int")
    def part(ids: pd.Series, ties: pd.Series) -> pd.Series:
        return pd.Series(part_of(ids.to_numpy(np.int64), ties.to_numpy(np.int64)))

    # the greatest key of each part that has rows, as many as parts
    tops = keys.select(part("id", "tie").alias("part"), "id", "tie").groupBy("part").agg(F.max(F.struct("id", "tie")).alias("top")).orderBy("part").collect()
    goes: dict[tuple[int, int], list[int]] = {}
    for below, above in zip(tops, [*tops[1:], tops[0]] if tops else [], strict=True):
        goes.setdefault((below["top"]["id"], below["top"]["tie"]), []).append(above["part"])
    to = spark.sparkContext.broadcast(goes)

    @F.pandas_udf("array<int>")
    def parts(ids: pd.Series, ties: pd.Series) -> pd.Series:
        own = part_of(ids.to_numpy(np.int64), ties.to_numpy(np.int64)).tolist()
        more = to.value
        return pd.Series([[p, *(-q - 1 for q in more.get(key, ()))] for p, key in zip(own, zip(ids.tolist(), ties.tolist(), strict=True), strict=True)])

    placed = docs.withColumn("to", F.explode(parts(F.coalesce("doc_id", F.lit(-(2**63))), "tie")))
    placed = placed.withColumns({"ahead": F.col("to") < 0, "part": F.when(F.col("to") < 0, -F.col("to") - 1).otherwise(F.col("to"))}).drop("to")
    return placed.repartition(max(n, 2), "part").sortWithinPartitions("part", "ahead", F.col("doc_id").desc_nulls_last(), F.col("tie").desc(), F.col("text").desc())


EDIT_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_fingerprints(documents: DataFrame, p: IMatch = IMatch()) -> DataFrame:
    """Per row: its fingerprint, that of its edited text (the last third replaced by the beginning of the next document), and likenesses.

    doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text is empty; a
    single row is its own next document. Two texts without any term are alike (1); a text without terms is unlike one with some.
    """
    shared = documents.sparkSession.sparkContext.broadcast(lexicon(documents, p).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = np.frombuffer(shared.value, np.uint64)
        held: list[tuple[int, bool, int | None, str]] = []
        size = 0

        def judged() -> pa.RecordBatch | None:
            texts = [r[3] for r in held]
            rows = [i for i in range(len(held) - 1) if held[i][0] == held[i + 1][0] and not held[i][1]]
            if not rows:
                return None
            edited = [texts[i][: len(texts[i]) - len(texts[i]) // 3] + texts[i + 1][: len(texts[i]) // 3] for i in rows]
            raw = [t.encode("utf-8", "surrogatepass") for t in edited]
            f, e = (np.concatenate([fingerprints(r, lex, p) for r in _runs(x)]) for x in ([t.encode("utf-8", "surrogatepass") for t in texts], raw))
            at = np.array(rows)
            columns = [
                pa.array([held[i][2] for i in rows], pa.int64()), pa.array([len(texts[i]) for i in rows], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raw]), pa.array(_hex(f[at])), pa.array(_hex(e)),
                pa.array(likeness(f[at], e, p)), pa.array(likeness(f[at], f[at + 1], p)),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in EDIT_SCHEMA.split(", ")])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "ahead", "doc_id", "text")), strict=True):
                held.append(row)
                size += len(row[3])
                if size > SLICE_BYTES and len(held) > 1:
                    if (out := judged()) is not None:
                        yield out
                    held, size = held[-1:], len(held[-1][3])
        if (out := judged()) is not None:
            yield out

    return with_next(documents).drop("tie").mapInArrow(releasing(run), EDIT_SCHEMA)
