"""Substring dedup, near dedup, decontamination, fingerprints, token output and toxicity against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from graphloom.llm import decontam, fm_index, imatch, minhash_forest, substring_dedup, token_output, toxicity
from graphloom.llm.common import PUNCTUATION, Words, new_path

RNG = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(300)] + ["É", "ß", "Foo,", "ends."]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def corpus():
    """Copies, edits, shared passages, and rows that are odd in some way."""
    base, passage = [prose(80) for _ in range(12)], prose(30)
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(24):
        words = base[i % 6].split()
        for _ in range(i % 5):
            words[RNG.randrange(len(words))] = RNG.choice(VOCABULARY)
        rows.append((100 + i, " ".join(words)))
    rows += [(200 + i, f"{prose(25)} {passage}\n{prose(9)}") for i in range(8)]
    rows += [(300, base[0]), (301, base[0].upper()), (302, None), (303, ""), (304, " \n\t "), (305, "one"), (306, "one"), (307, "One two"), (None, base[1]), (None, None), (5, base[7]), (5, base[7]), (5, prose(40)), (308, prose(3000)), (309, "x" * 20_000)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, node string").repartition(3)


def test_words():
    texts = ["a bcé A\n", "", "  x\x0by\x1cz ", "bcé"]
    raw = [t.encode() for t in texts]
    w = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    data = b"".join(raw)
    assert [data[a:b] for a, b in zip(w.starts, w.ends, strict=True)] == [x for r in raw for x in r.split()]
    assert w.bounds.tolist() == [0, 3, 3, 5, 6] and w.hashes[1] == w.hashes[5] and len(set(w.hashes.tolist())) == 5


def test_fm_index_counts():
    rng = np.random.default_rng(3)
    parts = [rng.integers(1, 6, n) for n in (30, 1, 17, 55)]
    index = fm_index.FMIndex(parts, np.arange(4), 6)
    for _ in range(200):
        p = rng.integers(1, 6, rng.integers(1, 5))
        low, high = np.zeros(1, np.int64), np.array([index.n])
        for c in p[::-1]:
            low, high = index.extend(np.array([c]), low, high)
        places = [(k, i) for k, s in enumerate(parts) for i in range(len(s) - len(p) + 1) if (s[i : i + len(p)] == p).all()]
        assert max(0, int(high[0] - low[0])) == len(places)
        if places:
            assert index.least_owner(low, high)[0] == min(places)[0]


def without_repeats(rows, window):
    split = [((i if i is not None else 2**63 - 1), (t or "").split()) for i, t in rows]
    first: dict = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize(("hot", "shard"), [(1000, 10**6), (2, 300)])
def test_substrings(documents, rows, hot, shard):
    got = substring_dedup.remove_repeats(documents, window=12, gram=5, hot_docs=hot, shard_words=shard).collect()
    assert Counter((r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == without_repeats([(i, t) for i, t in rows if not t or "\x1c" not in t], 12)


def test_substrings_of_nothing(documents):
    assert substring_dedup.remove_repeats(documents.limit(0)).collect() == []


def components(rows, k):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    sets = []
    for _, t in rows:
        w = low(t or "").split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    ids = [i if i is not None else 2**63 - 1 for i, _ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least: dict = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    null = lambda x: None if x == 2**63 - 1 else x
    return Counter((rows[i][0], len(sets[i]), null(least[root(i)]), least[root(i)] == ids[i]) for i in range(len(rows)))


@pytest.mark.parametrize("limits", [{}, {"block_nodes": 3, "hubs": 1}])
def test_near_duplicates(documents, rows, limits):
    got = minhash_forest.near_duplicates(documents, k=4, **limits).collect()
    assert Counter(map(tuple, got)) == components(rows, 4)


@pytest.mark.parametrize("copies", [5, 40])
def test_long_near_copies_end(spark, copies):
    """A text of more shingles than a block takes, in a few and in many near copies, beside a pair that is near only to itself."""
    rng = random.Random(copies)
    base = prose(400, rng).split()
    rows = []
    for i in range(copies):
        words = list(base)
        for _ in range(i % 4 * 6):
            words[rng.randrange(len(words))] = f"e{rng.randrange(999)}"
        rows.append((i, " ".join(words)))
    rows += [(1000, prose(200, rng))] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for limits in ({"block_shingles": 150}, {"block_shingles": 1200, "hubs": 1}):
        assert Counter(map(tuple, minhash_forest.near_duplicates(df, k=4, **limits).collect())) == components(rows, 4)


def test_crowds_link_by_the_short_prefix(spark):
    """Nodes of one 4-value prefix and different longer paths are candidates in a crowd as well as elsewhere."""
    paths = [b"12345678" + i.to_bytes(4, "big") for i in range(200)]
    rows = spark.createDataFrame([(0, bytearray(p), i) for i, p in enumerate(paths)], "tree int, path binary, node long").coalesce(1)
    found = rows.mapInArrow(minhash_forest._neighbours(4), "kind int, part int, a long, b long, tree int, path binary").filter("kind = 0").collect()
    assert {(r["a"], r["b"]) for r in found} == {(0, i) for i in range(1, 200)}


def test_near_duplicates_of_nothing(documents):
    assert minhash_forest.near_duplicates(documents.limit(0)).collect() == []
    assert minhash_forest.near_duplicates(documents.filter("text is null")).count() == 2


def naive_tiles(a, b, least):
    """Greedy string tiling by trying all places; lengths of the tiles."""
    used_a, used_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        n, i, j = best
        used_a[i : i + n], used_b[j : j + n] = [True] * n, [True] * n
        out.append(n)


def test_tiles():
    rng = random.Random(2)
    for _ in range(150):
        a, b = ([rng.randrange(1, 4) for _ in range(rng.randrange(0, 25))] for _ in range(2))
        got = decontam.tiles(np.array(a, np.uint64), np.array(b, np.uint64), 2)
        assert [n for _, _, n in got] == naive_tiles(a, b, 2)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in got)


def test_contaminated(spark, documents):
    items = [(i, prose(20 + i, random.Random(i))) for i in range(5)] + [(7, "too short here"), (8, None), (9, "")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, n_chars long")
    words = [t.split() for _, t in items[:5]]
    turned = " ".join(words[1][10:] + words[1][:10])
    rows = [(1, f"{prose(30)} {items[0][1].upper()} {prose(3)}"), (2, f"{prose(50)} {turned}!"), (3, prose(90)), (4, " ".join(words[2][:8]) + prose(30)), (5, None), (6, ""), (None, items[3][1]), (8, "too short here"), (1, items[0][1])]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, item_id string")
    want = Counter([(1, 0), (1, 0), (2, 1), (None, 3)])
    got = decontam.contaminated(docs, bench).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in got) == want
    assert {r["n_tiles"] for r in got if r["doc_id"] == 2} == {2} and all(r["coverage"] == 1 for r in got)
    assert Counter(decontam.contaminated(docs, bench, block_mb=0.0002).collect()) == Counter(got)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter([3, 4, 5, 6, 8])
    assert decontam.contaminated(docs.limit(0), bench).collect() == [] == decontam.contaminated(docs, bench.limit(0)).collect()


def test_large_benchmark(spark):
    """The seed join gives the rows of the broadcast, with repeated rows, shared phrases and items alike to each other."""
    rng = random.Random(11)
    phrase = prose(6, rng)
    items = [(i, f"{phrase} {prose(rng.randrange(3, 60), rng)}") for i in range(60)] + [(100, phrase), (101, f"{phrase} {phrase}"), (7, phrase), (None, prose(9, rng)), (8, None), (9, "")]
    texts = [t for _, t in items if t]
    rows = [(n, f"{phrase} {prose(40, rng)}") for n in range(40)]
    for n in range(60):
        words = rng.choice(texts).split()
        a = rng.randrange(len(words))
        rows.append((100 + n, " ".join(words[a:] + [prose(rng.randrange(3), rng)] + words[: rng.randrange(a + 1)]) + " " + prose(20, rng)))
    rows += [rows[50], (None, rows[60][1]), (None, None), (5, "")]
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (0.3, 0.6, 0.95):
        want = Counter(decontam.contaminated(docs, bench, threshold).collect())
        assert len(want) > 5 and Counter(decontam.contaminated(docs, bench, threshold, block_mb=0.0001).collect()) == want


def test_contaminated_against_brute_force(spark):
    """Both paths, with hot seeds too, against tiles by trying all places: moved sentences, a prompt that all items and most texts share."""
    rng = random.Random(21)
    prompt = prose(14, rng)
    items = [(i, f"{prompt} {prose(rng.randrange(16, 40), rng)}") for i in range(12)] + [(50, None), (51, "too short"), (52, prose(9, rng))]
    docs = []
    for i in range(70):
        words = items[i % 12][1].split()
        a, b = sorted(rng.sample(range(len(words)), 2))
        parts = [" ".join(words[a:b]), " ".join(words[b:]), prompt if i % 3 else "", prose(12, rng)]
        rng.shuffle(parts)
        docs.append((i, ", ".join(parts)))
    docs += [(90, None), (91, ""), (3, docs[3][1]), (92, items[4][1].upper()), (93, items[14][1])]
    plain = lambda t: [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in ",." else c for c in t or "").split()]
    want = Counter()
    for d, text in docs:
        for i, item in items:
            words = plain(item)
            covered = sum(naive_tiles(words, plain(text), 5)) if len(words) >= 5 else 0
            if covered and covered >= 0.6 * len(words):
                want[d, i, covered] += 1
    assert 20 < len(want) < 200
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for limits in ({}, {"block_mb": 0}, {"block_mb": 0, "hot_pairs": 20}, {"block_mb": 0, "hot_pairs": 0}):
        got = decontam.contaminated(df, bench, **limits).collect()
        assert Counter((r["doc_id"], r["item_id"], r["n_words"]) for r in got) == want
    # the shared prompt is in no item's join
    import pandas as pd

    rows = pd.DataFrame([("i", g, g, 40, 1000 if g < 10 else 1, 12) for g in range(36)], columns=["__item", "gram", "at", "words", "texts", "items"])
    kept = decontam._kept_seeds(0.6, 5, 100)(("i",), rows)
    assert set(kept["gram"]) <= set(range(10, 36)) and len(kept) > 0 and set(kept["needed"]) == {1}


def test_fingerprints(documents, rows):
    got = imatch.edited_fingerprints(documents).collect()
    order = sorted(((i if i is not None else -(2**63), t or "") for i, t in rows), key=lambda r: -r[0])
    assert len(got) == len(rows)
    once = {i: t for i, t in order}
    by_id = Counter(i for i, _ in order)
    place = {i: k for k, (i, _) in enumerate(order)}
    for r in got:
        i = r["doc_id"]
        if i is None or by_id[i] > 1 or by_id[order[(place[i] + 1) % len(order)][0]] > 1:
            continue
        text, after = once[i], order[(place[i] + 1) % len(order)][1]
        cut = len(text) // 3
        assert r["edited_sha256"] == hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()
        assert r["n_chars"] == len(text) and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    prints: dict = {}
    texts = {i: t or "" for i, t in rows if i is not None and by_id[i] == 1}
    for r in got:
        if r["doc_id"] in texts:
            prints.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert imatch.edited_fingerprints(documents.limit(0)).collect() == []
    one = documents.filter("doc_id = 3")
    assert imatch.edited_fingerprints(one).first()["near_next"] == 1.0


def _plain_imatch(texts, p):
    """Fingerprints and likeness term by term; only the hash of a single word is the library's."""
    mask = 2**64 - 1
    one = lambda x: int(imatch.mix(np.array([x & mask], np.uint64))[0])
    break_ = "".join(c for c in map(chr, range(128)) if PUNCTUATION[ord(c)])
    terms = [{w for w in t.translate(str.maketrans(break_, " " * len(break_))).split(" ") if w} for t in texts]
    lower = lambda w: "".join(c.lower() if c.isascii() else c for c in w)
    terms = [{lower(w) for w in own} for own in terms]
    hashes = {w: int(Words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())])).hashes[0]) for own in terms for w in own}
    return terms, hashes, one, mask


def test_fingerprints_against_plain_python(spark, documents, rows):
    p = imatch.IMatch(idf=(0.2, 3.0), chunk_docs=7)
    order = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: -r[0])
    order = [r for k, r in enumerate(order) if k == 0 or r[0] != order[k - 1][0]]
    docs = spark.createDataFrame(order, "doc_id long, text string")
    terms, hashes, one, mask = _plain_imatch([t for _, t in order], p)
    df = Counter(w for own in terms for w in own)
    lex = {w for w, n in df.items() if len(order) * np.exp(-p.idf[1]) <= n <= len(order) * np.exp(-p.idf[0])}
    assert {int(x) for x in imatch.lexicon(docs, p)} == {hashes[w] for w in lex} and len(lex) > 10

    def made(text):
        (own,), more, _, _ = _plain_imatch([text], p)
        values = {**hashes, **more}
        out = []
        for s in range(p.subsets):
            chosen = [one(values[w] + 7919 * (s + 1)) for w in own & lex]
            for rate in p.rates:
                chosen = [x for x in chosen if x < int(rate * 2**64)]
                out.append(max(1, one_sum(chosen)) if chosen else 0)
        return out, own

    def one_sum(chosen):
        return one(sum(one(x) for x in chosen)) >> 48

    def alike(a, b):
        (x, own), (y, other) = a, b
        n = len(p.rates)
        agree = used = 0
        for s in range(p.subsets):
            at = [k for k in range(n) if x[s * n + k] or y[s * n + k]]
            if at:
                used += 1
                agree += x[s * n + at[-1]] == y[s * n + at[-1]]
        return agree / used if used else float(own == other)

    got = {r["doc_id"]: r for r in imatch.edited_fingerprints(docs, p).collect()}
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        a, b, c = made(text), made(edited), made(after)
        r = got[i]
        assert [int(r["fingerprint"][j : j + 4], 16) for j in range(0, 4 * len(a[0]), 4)] == a[0]
        assert [int(r["edited_fingerprint"][j : j + 4], 16) for j in range(0, 4 * len(b[0]), 4)] == b[0]
        assert r["near_edited"] == pytest.approx(alike(a, b)) and r["near_next"] == pytest.approx(alike(a, c))
    assert len({r["fingerprint"] for r in got.values()}) > len(order) // 3


def test_lexicon_paths_agree(documents):
    few = imatch.IMatch(idf=(0.2, 3.0), chunk_docs=4)
    all_ = imatch.IMatch(idf=(0.2, 3.0), chunk_docs=4, broadcast_terms=0)
    a, b = imatch.lexicon(documents, few), imatch.lexicon(documents, all_)
    assert len(a) > 20 and (a == b).all()


def test_tokens(spark, documents, rows):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    odd = [(900, "two  blanks \n line"), (901, " lead"), (902, "trail "), (903, "a<|endoftext|>b it's"), (904, "tab\tand nbsp 　x")]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    at = new_path(spark, "tokens-test")
    token_output.write_tokens(docs, at, path, shard_tokens=500, task_mb=1)
    got = token_output.read_tokens(spark, at, with_ids=True).orderBy("start").collect()
    encode = Tokenizer.from_file(path).encode
    want = Counter((i, tuple(encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t in rows + odd)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    sizes = spark.read.parquet(at).select("n_docs", "n_tokens").collect()
    assert len(sizes) > 5 and all(r["n_tokens"] <= 500 or r["n_docs"] == 1 for r in sizes)
    start, last = 0, -1
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) and (r["doc_id"] if r["doc_id"] is not None else -1) >= last
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start, last = start + r["n_tokens"], r["doc_id"] if r["doc_id"] is not None else -1
    empty = new_path(spark, "tokens-empty")
    token_output.write_tokens(docs.limit(0), empty, path)
    assert token_output.read_tokens(spark, empty).collect() == []


def test_shards():
    rng = np.random.default_rng(4)
    for counts in ([0], [1], [5, 0, 7], [400, 3, 900], [2000]):
        ids = rng.integers(0, 12, sum(counts)).astype(np.uint32)
        ids[: len(ids) // 3] = 7  # runs of one symbol
        shard = token_output.Shard(token_output.pack(ids, np.array(counts), 12))
        assert (shard.expand(shard.seq) == ids).all() and shard.tokens.tolist() == counts
        begin = np.cumsum([0, *counts])
        for k, n in enumerate(counts):
            assert (shard.document(k) == ids[begin[k] : begin[k + 1]]).all()
            if n > 3:
                assert (shard.slice(k, 1, n - 1) == ids[begin[k] + 1 : begin[k + 1] - 1]).all()
    assert len(shard.rules) > 0 and (shard.lengths[12:] >= 2).all()


def test_shards_leave_no_frequent_pair():
    rng = np.random.default_rng(6)
    copies = np.tile(rng.integers(0, 40_000, 5000), 8)  # an expansion of 5000 ids takes more than a few rounds
    many = np.tile(rng.integers(0, 50_000, 50_000), 8)  # more rules than 16-bit symbols have room for
    for ids, counts in ((copies, [5000] * 8), (many, [50] * 8000), (np.full(10_001, 3), [10_000, 1]), (rng.integers(0, 3, 5000), [5000])):
        ids = ids.astype(np.uint32)
        data = token_output.pack(ids, np.array(counts), 50_257)
        shard = token_output.Shard(data)
        assert (shard.expand(shard.seq) == ids).all() and shard.symbols.sum() == len(shard.seq)
        doc = np.repeat(np.arange(len(counts)), shard.symbols)
        pairs = Counter((a, b) for a, b, x, y in zip(shard.seq[:-1].tolist(), shard.seq[1:].tolist(), doc[:-1], doc[1:], strict=True) if x == y)
        assert max(pairs.values(), default=0) < 6
    assert len(token_output.Shard(token_output.pack(copies.astype(np.uint32), np.array([5000] * 8), 50_257)).seq) == 8


def test_one_grammar_for_a_shard(spark):
    public = pytest.importorskip("public_tokenizers")
    at = new_path(spark, "tokens-shard")
    rng = random.Random(11)
    docs = spark.createDataFrame([(i, prose(600, rng)) for i in range(900)], "doc_id long, text string")
    token_output.write_tokens(docs, at, public.path("byte_bpe_50k.json"))
    shards = spark.read.parquet(at).collect()
    assert len(shards) == 1 and shards[0]["n_tokens"] > 1_000_000
    assert len(shards[0]["payload"]) < 0.75 * 2 * shards[0]["n_tokens"]  # of two bytes a token
    got = token_output.read_tokens(spark, at).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == list(range(900)) and sum(r["n_tokens"] for r in got) == shards[0]["n_tokens"]


def test_added_tokens_anywhere():
    """Texts with the tokenizer's added token, or a part of it, glued, spaced, at line ends and after marks."""
    public = pytest.importorskip("public_tokenizers")
    encoder = token_output.UnitEncoder(public.path("byte_bpe_50k.json"))
    token, rng = "<|endoftext|>", random.Random(8)
    texts = [f"foo.{token} bar", f"a {token} b", f"foo{token}", f"a\n{token}\nb", token, token * 2, f"{token} x", "a <|endoftext| > b", "a <|", "endoftext|> b"]
    parts = [token, "<|", "|>", "endoftext", " ", "\n", ".", "foo", "Ü", "9", "'s"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    for begin in range(0, len(texts), 500):
        own = texts[begin : begin + 500]
        raw = [t.encode() for t in own]
        ids, n = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in own]


def test_units_that_share_a_hash_are_encoded_whole(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    encoder = token_output.UnitEncoder(path, max_units=3)
    monkeypatch.setattr(token_output, "mix", lambda x: x % np.uint64(5))
    texts = ["ab cd ef\ngh", "", " ", "gh ab", "x\u00a0y z", "one two three four five six seven", "été über niño", "cd\n\nab", "z"]
    for _ in range(2):
        raw = [t.encode() for t in texts]
        ids, n = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def same_as_library(encoder, texts):
    raw = [t.encode() for t in texts]
    ids, n = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_units_that_share_a_hash_and_differ_in_separator_or_middle(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(token_output, "mix", lambda x: x * np.uint64(0))
    long = ["a" * 8 + x * 5 + "b" * 8 for x in "xyz"]
    for texts in (["ab ab", "ab\nab"], ["z ab", "ab ab", "ab\nab"], long, [f"{long[0]} {w}" for w in long], ["éé" * 4 + "xy", "éé" * 4 + "zy"]):
        encoder = token_output.UnitEncoder(public.path("byte_bpe_50k.json"))
        for _ in range(2):
            assert same_as_library(encoder, texts)


def test_only_the_middles_of_long_words_are_hashed_byte_by_byte(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    hashed, real = [], token_output.span_hashes
    monkeypatch.setattr(token_output, "span_hashes", lambda data, starts, lens: hashed.append(int(lens.sum())) or real(data, starts, lens))
    encoder, rng = token_output.UnitEncoder(public.path("byte_bpe_50k.json")), random.Random(9)
    words = ["".join(rng.choice("abcdeéß19") for _ in range(rng.randrange(1, 14))) for _ in range(300)] + ["a" * n for n in range(1, 40)]
    texts = [" ".join(rng.choice(words) for _ in range(100)) for _ in range(50)]
    for _ in range(2):
        hashed.clear()
        assert same_as_library(encoder, texts)
        assert sum(hashed) == sum(max(0, len(w.encode()) - 16) for t in texts for w in t.split())


def test_units_met_again_outlast_those_met_once():
    public = pytest.importorskip("public_tokenizers")
    encoder, rng = token_output.UnitEncoder(public.path("byte_bpe_50k.json"), max_units=120), random.Random(10)
    common = ["".join(rng.choice("abcdefé") for _ in range(rng.randrange(1, 25))) for _ in range(30)]
    assert same_as_library(encoder, [" ".join(common)])
    for k in range(40):
        rare = [f"{k}x{i}" + "longer" * (i % 4) for i in range(30)]
        learned = []
        encoder._whole = lambda texts, learned=learned: learned.extend(texts) or token_output.UnitEncoder._whole(encoder, texts)
        assert same_as_library(encoder, [" ".join([*common, *rare]), " ".join(rare)])
        assert not any(c in t.split() for t in learned for c in common if len(c) > 4)
        assert len(encoder.keys) < 250


def plain_re_pair(docs, first, least):
    """Rounds of Re-Pair on lists: the rules, and what is left of each document."""
    rules = []
    while True:
        found = Counter(p for d in docs for p in itertools.pairwise(d))
        best = sorted((p for p, n in found.items() if n >= max(least, max(found.values()) // 64)), key=lambda p: (-found[p], p))
        if not best:
            return rules, docs
        lefts, rights, chosen = set(), set(), []
        for a, b in best:
            if a not in rights and b not in lefts and (a != b or a not in lefts and b not in rights):
                lefts.add(a)
                rights.add(b)
                chosen.append((a, b))
        own = {p: first + len(rules) + k for k, p in enumerate(sorted(chosen))}
        rules += sorted(chosen)
        for k, d in enumerate(docs):
            out, i = [], 0
            while i < len(d):
                pair = own.get(tuple(d[i : i + 2]))
                out.append(d[i] if pair is None else pair)
                i += 1 if pair is None else 2
            docs[k] = out


def test_grammar_against_plain_rounds(monkeypatch):
    rng = random.Random(12)
    for case in range(150):
        n = rng.randrange(2, 8)
        monkeypatch.setattr(token_output, "SHORT", rng.choice([2, 64]))
        docs = [[rng.randrange(n) for _ in range(rng.choice([0, 1, 2, 40, 300]))] for _ in range(rng.randrange(1, 7))] * rng.choice([1, 1, 3])
        least = rng.choice([2, 3, 6])
        ids, counts = np.array([x for d in docs for x in d], np.uint32), np.array([len(d) for d in docs])
        rules, seq, symbols = token_output.re_pair(ids, counts, n, least=least)
        want_rules, want = plain_re_pair([list(d) for d in docs], n, least)
        assert [tuple(r) for r in rules.tolist()] == want_rules
        assert [x.tolist() for x in np.split(seq, np.cumsum(symbols)[:-1])] == want
        shard = token_output.Shard(token_output.pack(ids, counts, n, least=least))
        assert (shard.expand(shard.seq) == ids).all()


def test_toxicity(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        words = prose(30, rng).split()
        if bad:
            for w in ("grumpfing", "grumpfel", "Zork!"):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        if i % 3 != 1:
            labels.append((i, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "you zork " * 5000), (None, "zork zork")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    known = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, known)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(got[i]["predicted"] == (i % 6 == 0) for i in held)
    assert got[1000]["predicted"] == 0 == got[1001]["predicted"] and got[1002]["predicted"] == 1 == got[None]["predicted"]
    # labels of held-out rows change nothing
    turned = spark.createDataFrame([(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels], "doc_id long, toxic int")
    assert toxicity.train(docs, turned).lexicon == model.lexicon
    assert toxicity.score(docs.limit(0), model).collect() == []
    nothing = toxicity.train(docs, known.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, nothing).collect()} == {0}


def test_clause_states():
    model = toxicity.ToxicityModel({"zork$": 2.0, "grum": 3.0})
    f = lambda t: dict(zip(toxicity.FEATURES, model.features(t), strict=True))
    assert f("a zork b")["affirmed"] == 2 and f("not a zork")["negated"] == 2 and f("zorks")["total"] == 0
    assert f("not so, a zork")["affirmed"] == 2 and f("kein Grumpf")["negated"] == 3
    assert f("she said zork")["reported"] == 2 and f("il dit grum")["reported"] == 3 and f("she said not zork")["reported"] == 2
    assert f("you zork")["aimed"] == 1 and f("zork is what you are")["aimed"] == 1 and f("zork in some other way you")["aimed"] == 0
    assert f("I will kill")["threats"] == 1 and f("nice words")["affirmed"] == 0
    assert f("you zork")["total"] == 2 * toxicity.AIMED and f("not you zork")["total"] == 2 * toxicity.AIMED * toxicity.NEGATED
    assert f("zork. zork zork. zork")["worst"] == 4 and f("zork. zork zork. zork")["total"] == 8


def _clause_by_hand(kinds):
    """What the grammar makes of a clause's classes, told from the positions alone: (output, weight) of each."""
    out, waits = [], None
    for i, x in enumerate(kinds):
        near = lambda name, i=i: any(k == name for k in kinds[max(0, i - toxicity.REACH) : i])
        if x in ("insult", "threat"):
            mark, weight = "", 1.0
            if near("negation"):
                mark, weight = "-", toxicity.NEGATED
            if "reported" in kinds[:i]:
                mark, weight = "~", weight * toxicity.QUOTED
            if near("target"):
                mark, weight, waits = mark + "@", weight * toxicity.AIMED, None
            else:
                waits = i
            out.append((x + mark, weight))
        elif x == "target":
            aimed = waits is not None and i - waits <= toxicity.REACH
            out.append(("target@" if aimed else "target", 1.0))
            waits = None
        else:
            out.append((x, 1.0))
    return out


def test_grammar_is_its_parts_and_its_meaning():
    parts = toxicity.negation(), toxicity.reported(), toxicity.aim()
    for n in range(1, 6):
        for kinds in itertools.product(toxicity.CLASSES, repeat=n):
            want = _clause_by_hand(kinds)
            assert toxicity.GRAMMAR.run(kinds) == want
    rng = random.Random(5)
    for _ in range(500):  # one after the other gives what the composition gives
        kinds = rng.choices(toxicity.CLASSES, k=20)
        symbols, weights = kinds, [1.0] * 20
        for t in parts:
            steps = t.run(symbols)
            symbols, weights = [y for y, _ in steps], [w * v for w, (_, v) in zip(weights, steps, strict=True)]
        assert toxicity.GRAMMAR.run(kinds) == list(zip(symbols, weights, strict=True)) == _clause_by_hand(kinds)


def test_composition_against_all_paths():
    rng = random.Random(6)
    for _ in range(30):
        machine = lambda inputs, outputs: toxicity.Transducer({(p, x): (rng.randrange(3), rng.choice(outputs), rng.choice([0.5, 1.0, 2.0])) for p in range(3) for x in inputs if rng.random() < 0.8})
        a, b = machine("xy", "uv"), machine("uv", "st")
        both = toxicity.compose(a, b)
        for n in range(5):
            for word in itertools.product("xy", repeat=n):
                try:
                    first = a.run(word)
                    second = b.run([y for y, _ in first])
                    want = [(z, w * v) for (_, w), (z, v) in zip(first, second, strict=True)]
                except KeyError:
                    want = None
                try:
                    got = both.run(word)
                except KeyError:
                    got = None
                assert got == want


def test_word_transducer():
    rng = random.Random(7)
    words = ["".join(rng.choices("abß", k=rng.randint(1, 9))) for _ in range(400)]
    lexicon = {rng.choice(toxicity.stems(w)): rng.random() for w in words[:60]}
    read = toxicity.WordTransducer(lexicon).read
    for w in words:
        best = max((lexicon.get(x, 0.0) for x in toxicity.stems(w) + [w[:k] for k in toxicity.STEM_LENGTHS if len(w) == k]), default=0.0)
        assert read(w) == ((0, best) if best else (toxicity.CLASSES.index("other"), 0.0))
    for name, languages in (("target", toxicity.TARGET), ("negation", toxicity.NEGATION), ("reported", toxicity.REPORTED), ("threat", toxicity.THREAT)):
        assert set(languages) == {"en", "de", "fr", "es"}
        assert all(toxicity.WordTransducer({}).read(w)[0] == toxicity.CLASSES.index(name) for v in languages.values() for w in v.split() if w not in ("no", "ni", "te", "ton", "sie"))


def test_specific_stems():
    toxic = {"zork$": 10, "zor": 10, "grumpfel$": 5, "grumpfing$": 6, "grump": 11, "grumpf": 11, "gru": 11}
    assert toxicity.specific(dict.fromkeys(toxic, 1.0), toxic) == {"zork$": 1.0, "grumpfel$": 1.0, "grumpfing$": 1.0, "grumpf": 1.0}


def test_many_null_ids_end_soon(spark):
    rng = random.Random(12)
    docs = spark.createDataFrame([(None, prose(60, rng)) for _ in range(5000)], "doc_id long, text string")
    begin = time.monotonic()
    assert substring_dedup.remove_repeats(docs).agg({"n_removed": "sum"}).first()[0] == 0
    near = minhash_forest.near_duplicates(docs)
    assert near.filter("component_id is null and doc_id is null").count() == 5000
    assert time.monotonic() - begin < 90
