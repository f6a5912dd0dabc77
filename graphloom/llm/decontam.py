"""Benchmark decontamination by greedy string tiling.

Shared-token seeds (five words in a row) pick pairs of a document and a benchmark item. For each pair the longest matches that do
not overlap are marked again and again, found by running Karp-Rabin hashes over the words that are not yet marked, until none of at
least five words is left. The share of the item's words under tiles is its coverage; tiles may lie in any order, so a passage whose
sentences were moved is covered as well as one that was copied whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.common import PUNCTUATION, Words, text_slices, written

_BASE = np.uint64(0x9FB21C651E98DF25)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))


def _windows(h: np.ndarray, n: int) -> np.ndarray:
    """Running Karp-Rabin: the hash of each n words in a row, from prefix sums modulo 2^64."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, back = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(h) - 1, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, _BACK))
        prefix = np.concatenate([[np.uint64(0)], np.cumsum(h * power, dtype=np.uint64)])
        return (prefix[n:] - prefix[:-n]) * back[: len(h) - n + 1]  # equal windows have equal hashes wherever they stand


def _free(marked: np.ndarray, n: int) -> np.ndarray:
    """Starts of n words in a row without a mark."""
    taken = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(taken[n:] == taken[:-n]) if len(marked) >= n else np.zeros(0, np.int64)


def tiles(item: np.ndarray, text: np.ndarray, least: int = 5) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in item, start in text, length), longest first; word hashes of 0 stand for gaps and match nothing.

    Matches of one length are marked from the item's first word on, each with the first free place in the text.
    """
    mark_i, mark_t = item == 0, text == 0
    out: list[tuple[int, int, int]] = []

    def common(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = _free(mark_i, n), _free(mark_t, n)
        return a, b, _windows(item, n)[a] if len(a) else a, _windows(text, n)[b] if len(b) else b

    high = min(len(item), len(text))
    while high >= least:
        low, best = least, 0
        while low <= high:  # a match of n words holds one of n - 1, so the greatest length is found by halving
            n = (low + high) // 2
            a, b, ha, hb = common(n)
            if len(a) and len(b) and np.isin(ha, hb).any():
                best, low = n, n + 1
            else:
                high = n - 1
        if not best:
            break
        a, b, ha, hb = common(best)
        places: dict[int, list[int]] = {}
        for x, h in zip(b.tolist(), hb.tolist(), strict=True):
            places.setdefault(h, []).append(x)
        for x, h in zip(a.tolist(), ha.tolist(), strict=True):
            if mark_i[x : x + best].any():
                continue
            for y in places.get(h, ()):
                if not mark_t[y : y + best].any() and (item[x : x + best] == text[y : y + best]).all():
                    mark_i[x : x + best] = mark_t[y : y + best] = True
                    out.append((x, y, best))
                    break
        high = best - 1
    return out


class Benchmark:
    """One block of items: their word hashes, and seeds from each gram to the items that hold it."""

    def __init__(self, items: list[tuple[int, str]], k: int):
        self.k, self.ids = k, [i for i, _ in items]
        raw = [(t or "").encode("utf-8", "surrogatepass") for _, t in items]
        words = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), lower=True, breaks=PUNCTUATION)
        grams = words.grams(k)
        self.items = [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
        found: dict[int, list[int]] = {}
        self.grams = []
        for n, (a, b) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True)):
            own = grams[a : max(a, b - k + 1)]
            self.grams.append(own)
            for g in set(own.tolist()):
                found.setdefault(g, []).append(n)
        self.by_gram = found
        self.seeds = np.sort(np.fromiter(found, np.uint64, len(found)))

    def judge(self, words: np.ndarray, at: np.ndarray, grams: np.ndarray, threshold: float) -> list[tuple[int, float, int, int]]:
        """For a document with shared grams at word positions ``at``: (item_id, coverage, tiles, words covered) of each item that is covered enough."""
        k, out = self.k, []
        shared = set(grams.tolist())
        wanted = {n for g in shared for n in self.by_gram[g]}
        held = np.fromiter(shared, np.uint64, len(shared))
        text = None
        for n in sorted(wanted):
            item = self.items[n]
            # no tile can cover a word that is in no shared gram
            can = np.zeros(len(item) + 1, np.int64)
            starts = np.flatnonzero(np.isin(self.grams[n], held))
            np.add.at(can, starts, 1)
            np.add.at(can, starts + k, -1)
            if (np.cumsum(can)[:-1] > 0).sum() < threshold * len(item):
                continue
            if text is None:  # only words in shared grams, with a gap wherever others were
                near = np.unique((at[:, None] + np.arange(k)).ravel())
                gaps = np.flatnonzero(np.diff(near) > 1) + 1
                text = np.insert(words[near], gaps, np.uint64(0))
            got = tiles(item, text, k)
            covered = sum(t[2] for t in got)
            if covered >= threshold * len(item):
                out.append((self.ids[n], covered / len(item), len(got), covered))
        return out


def contaminated(documents: DataFrame, benchmark: DataFrame, threshold: float = 0.6, k: int = 5, block_mb: float = 16, hot_pairs: int = 10_000) -> DataFrame:
    """Pairs doc_id, item_id, coverage, n_tiles, n_words, one for each row of ``documents`` and item with coverage >= ``threshold``.

    Words are runs without blanks and ASCII punctuation, A-Z lower-cased; ``k`` words are a seed and the shortest tile. Null and
    empty texts and items of fewer than ``k`` words are in no pair. Repeated rows give repeated pairs. A benchmark of at most
    ``block_mb`` of text is broadcast to the documents, which are not shuffled; a larger one meets them in a join on seeds, and what
    is broadcast is a bit set of at most ``block_mb``. Both ways give the same pairs. ``hot_pairs``: of texts and items, from which a
    seed is left out of the join where the item's other seeds suffice.
    """
    spark = documents.sparkSession
    items = benchmark.filter(F.col("text").isNotNull()).select("item_id", "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("b")).first()["b"]
    measures = [T.StructField(n, t) for n, t in (("coverage", T.DoubleType()), ("n_tiles", T.LongType()), ("n_words", T.LongType()))]
    if total > int(block_mb * 2**20):
        return _seed_joined(documents.select("doc_id", "text"), items, T.StructType(measures), threshold, k, block_mb, hot_pairs)
    rows = sorted(((r["item_id"], r["text"]) for r in items.collect()), key=lambda r: (r[0] is None, r))
    schema = T.StructType([documents.schema["doc_id"], benchmark.schema["item_id"], *measures])
    return documents.select("doc_id", "text").mapInArrow(_judge(spark.sparkContext.broadcast((rows, k)), threshold), schema)


_BIT_SEGMENT = 1 << 20  # bits that one task packs


def _text_grams(k: int, bits=None):
    """Distinct grams of each text by its digest ``__text``, with their places counted (n) and the text's words (words). With ``bits``, a
    broadcast bit set by the grams' low bits, only those whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bits.value, np.uint8) if bits is not None else None
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                words = Words(data, offsets, lower=True, breaks=PUNCTUATION)
                grams, b = words.grams(k), words.bounds
                owner = np.repeat(np.arange(len(b) - 1), np.diff(b))[: len(grams)]
                inside = np.arange(len(grams)) + k <= b[owner + 1]
                if known is not None:
                    low = grams & np.uint64(8 * len(known) - 1)
                    inside &= (known[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1
                grams, owner = grams[inside], owner[inside]
                order = np.lexsort((grams, owner))
                grams, owner = grams[order], owner[order]
                first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])])) if len(grams) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("__text").take(pa.array(owner[first])), pa.array(grams[first].view(np.int64)), pa.array(np.diff(np.append(first, len(grams)))), pa.array(np.diff(b)[owner[first]])],
                    ["__text", "gram", "n", "words"],
                )

    return run


def _bit_set(seeds: DataFrame, block_mb: float) -> bytes:
    """Bits of the low bits of ``seeds`` (gram), about 16 for each seed and ``block_mb`` in all at most; packed by tasks in equal segments."""
    n = seeds.count()
    limit = max(_BIT_SEGMENT, int(block_mb * 2**23))
    size = _BIT_SEGMENT
    while size < 16 * n and 2 * size <= limit:
        size *= 2
    low = F.col("gram").bitwiseAND(F.lit(size - 1))
    places = seeds.select(F.floor(low / _BIT_SEGMENT).alias("segment"), (low % _BIT_SEGMENT).cast("int").alias("at")).distinct()

    def pack(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(_BIT_SEGMENT, np.uint8)
        held[own["at"].to_numpy()] = 1
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(held, bitorder="little").tobytes()]})

    out = bytearray(size // 8)
    for r in places.groupBy("segment").applyInPandas(pack, "segment long, bits binary").collect():
        out[r["segment"] * _BIT_SEGMENT // 8 : (r["segment"] + 1) * _BIT_SEGMENT // 8] = r["bits"]
    return bytes(out)


def _gram_places(k: int):
    """Every gram of each item with its place, and the item's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                words = Words(data, offsets, lower=True, breaks=PUNCTUATION)
                grams, b = words.grams(k), words.bounds
                owner = np.repeat(np.arange(len(b) - 1), np.diff(b))[: len(grams)]
                at = np.flatnonzero(np.arange(len(grams)) + k <= b[owner + 1])
                own = owner[at]
                yield pa.RecordBatch.from_arrays([rows.column("__text").take(pa.array(own)), pa.array(grams[at].view(np.int64)), pa.array(at - b[own]), pa.array(np.diff(b)[own])], ["__item", "gram", "at", "words"])

    return run


def _kept_seeds(threshold: float, k: int, hot_pairs: int):
    """Of one item's places: the seeds that go into the join, how many places each has, and how many of these places a covered text has at least.

    A covered item shares at least m = ceil(threshold * words / k) places. Seeds are looked at from the most frequent on. One of which
    texts and items make over ``hot_pairs`` pairs is left out while the words under all that are left out are fewer than the threshold
    asks for: a text that covers the item then has another place, too. Others are left out up to floor((m - 1) / 2) places.
    """

    def run(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        words = int(own["words"].iloc[0])
        least = max(1, int(np.ceil(words * threshold / k - 1e-9)))
        spare, gone, under = (least - 1) // 2, 0, np.zeros(words + k, bool)
        rows = []
        order = own.sort_values(["texts", "gram", "at"], ascending=[False, True, True], kind="stable")
        for gram, part in order.groupby("gram", sort=False):
            at = part["at"].to_numpy(np.int64)
            more = under.copy()
            more[(at[:, None] + np.arange(k)).ravel()] = True
            hot = int(part["texts"].iloc[0]) * int(part["items"].iloc[0]) > hot_pairs
            if (hot and more.sum() < threshold * words - 1e-9) or gone + len(at) <= spare:
                under, gone = more, gone + len(at)
            else:
                rows.append((int(gram), len(at)))
        out = pd.DataFrame(rows, columns=["gram", "n"]).astype("int64")
        return out.assign(__item=key[0], needed=max(1, least - gone))[["__item", "gram", "n", "needed"]]

    return run


def _seed_joined(documents: DataFrame, items: DataFrame, measures: T.StructType, threshold: float, k: int, block_mb: float, hot_pairs: int) -> DataFrame:
    """contaminated() for a benchmark of any size, by digests of texts.

    An item's seeds meet those of the texts in a join, where a bit set of all seeds has kept out most words of the corpus. What
    _kept_seeds() leaves out is in no such join: a line that many items and many texts share does not make pairs by itself.
    """
    spark = documents.sparkSession
    digest = F.sha2("text", 256)
    docs, keyed = documents.withColumn("__text", digest), items.withColumn("__item", digest)
    grams = "__text string, gram long, n long, words long"
    item_texts = written(keyed.groupBy(F.col("__item").alias("__text")).agg(F.first("text").alias("text")), "items")
    item_grams = written(item_texts.mapInArrow(_text_grams(k), grams), "item-grams")
    bits = spark.sparkContext.broadcast(_bit_set(item_grams.select("gram").distinct(), block_mb))
    hits = written(docs.filter("text is not null").select("__text", "text").mapInArrow(_text_grams(k, bits), grams).select("__text", "gram").distinct(), "seed-hits")
    bits.destroy()

    spread = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("texts")).join(item_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("items")), "gram")
    places = item_texts.mapInArrow(_gram_places(k), "__item string, gram long, at long, words long").join(spread, "gram")
    kept = written(places.groupBy("__item").applyInPandas(_kept_seeds(threshold, k, hot_pairs), "__item string, gram long, n long, needed long"), "item-seeds")
    shared = hits.join(kept, "gram").groupBy("__text", "__item").agg(F.sum("n").alias("n"), F.first("needed").alias("needed"))
    pairs = written(shared.filter("n >= needed").select("__text", "__item"), "seed-pairs")

    texts = docs.select("__text", "text").join(pairs.select("__text").distinct(), "__text", "left_semi").groupBy("__text").agg(F.first("text").alias("text"))
    both = pairs.join(item_texts.select(F.col("__text").alias("__item"), F.col("text").alias("item")), "__item").join(texts, "__text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, (item, text) in enumerate(zip(batch.column("item"), batch.column("text"), strict=True)):
                bench, data = Benchmark([(row, item.as_py())], k), np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                words = Words(data, np.array([0, len(data)]), lower=True, breaks=PUNCTUATION)
                gram = words.grams(k)
                at = np.flatnonzero(np.isin(gram, bench.seeds))
                out += bench.judge(words.hashes, at, gram[at], threshold)
            if out:
                row, *found = zip(*out, strict=True)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__text").take(at), batch.column("__item").take(at), *(pa.array(c, t) for c, t in zip(found, (pa.float64(), pa.int64(), pa.int64()), strict=True))],
                    ["__text", "__item", *measures.names],
                )

    schema = T.StructType([T.StructField("__text", T.StringType()), T.StructField("__item", T.StringType()), *measures])
    found = written(both.select("__text", "__item", "item", "text").mapInArrow(compare, schema), "tiled-pairs")
    return docs.select("doc_id", "__text").join(found, "__text").join(keyed.select("item_id", "__item"), "__item").select("doc_id", "item_id", *measures.names)


def _judge(shared, threshold: float):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(*shared.value)
        k = bench.k
        for batch in batches:
            for rows, data, offsets in text_slices(batch, "text"):
                if not len(bench.seeds) or not len(data):
                    continue
                words = Words(data, offsets, lower=True, breaks=PUNCTUATION)
                grams = words.grams(k)
                place = np.minimum(np.searchsorted(bench.seeds, grams), len(bench.seeds) - 1)
                hits = np.flatnonzero(bench.seeds[place] == grams)
                owner = np.searchsorted(words.bounds, hits, side="right") - 1
                hits, owner = (x[hits + k <= words.bounds[owner + 1]] for x in (hits, owner)) if len(hits) else (hits, owner)
                out: list[tuple] = []
                for d in np.unique(owner).tolist():
                    own = hits[owner == d]
                    begin = words.bounds[d]
                    out += [(d, *x) for x in bench.judge(words.hashes[begin : words.bounds[d + 1]], own - begin, grams[own], threshold)]
                if out:
                    d, item, coverage, n, covered = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id").take(pa.array(d)), pa.array(item), pa.array(coverage, pa.float64()), pa.array(n, pa.int64()), pa.array(covered, pa.int64())],
                        ["doc_id", "item_id", "coverage", "n_tiles", "n_words"],
                    )

    return judge


def decontaminate(documents: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``documents`` without the rows that contaminated() pairs with an item. Texts that leak are judged by text, so rows without a
    doc_id are handled too; the join carries digests of the leaking texts only."""
    keyed = documents.withColumn("__text", F.sha2("text", 256))
    pairs = contaminated(keyed.select(F.col("__text").alias("doc_id"), "text"), benchmark, **parameters)
    leaks = written(pairs.select(F.col("doc_id").alias("__text")).distinct(), "leaks")
    return keyed.join(leaks, "__text", "left_anti").select(*documents.columns)
