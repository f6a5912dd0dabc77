"""URL filter, WARC archive, mixing and line dedup against plain Python, with nulls, empty tables, repeated rows and clashing columns."""

from __future__ import annotations

import base64
import gzip
import hashlib
import pathlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import line_dedup, mixing, url_filter, warc
from graphloom.llm.common import new_path
from graphloom.llm.queries import URL_RULES

URLS = [
    "http://Example.ORG/en/15?x", "https://a.example.org/es/1#t", "http://example.org", "http://notexample.org/es/", "ftp://x.com/fr/1", "http://x.com/de/", "http://com/fr/",
    "no scheme", "", None, "://", "http:///org/", "http://evil.net/x.org/", "http://a.org?/x", "http://org/", "HTTP://A.B.C.COM/de/" + "y" * 5000, "http://é.org/ü", "http://x.com/fr/", "http://x.com/fr/",
]


def judge(url):
    at = (url or "").find("://")
    after = url[at + 3 :] if url and at >= 0 else ""
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.label), default=None)
    return host, path, best and best.label, best.verdict if best else "allow"


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, URL_RULES).collect()}
    assert got == {i: judge(u) for i, u in enumerate(URLS)}
    assert url_filter.filter_urls(df.limit(0), URL_RULES).collect() == []
    assert {r["verdict"] for r in url_filter.filter_urls(df, []).collect()} == {"allow"}


def test_automaton_over_many_words():
    globs = [f"*.host{i}.org/p{i}/**" for i in range(40)] + ["a*c", "a**c"]
    a = url_filter.GlobAutomaton(globs)
    assert a.words > 5
    hit = a.match([".x.host7.org/p7/z", ".host39.org/p39/", ".host7.org/p8/", "abc", "a/c", "ac", ""])
    assert hit.nonzero()[0].tolist() == [0, 1, 3, 3, 4, 5, 5]
    assert hit[0, 7] and hit[1, 39] and hit[3, 40] and hit[3, 41] and hit[4, 41] and hit[5, 40] and not hit[6].any()


def test_archive(spark):
    pages = [(3, "http://a", "same"), (1, "http://b\r\nX: y", "same"), (2, None, "é"), (4, "u", None), (5, "u", ""), (1, "http://again", "same"), (None, "n", "same"), (None, "m", "alone"), (6, "l", "z" * 100_000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    path = new_path(spark, "warc-test")
    warc.write_archive(df, path)
    got = warc.record_bytes(warc.read_archive(spark, path, payloads=True)).collect()
    assert len(got) == len(pages)
    for r in got:
        body = bytes(r["payload"])
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert r["payload_bytes"] == len(body)
        head, rest = bytes(r["record"]).split(b"\r\n\r\n", 1)
        assert rest == (body if r["record_type"] == "response" else b"") + b"\r\n\r\n"
        assert f"Content-Length: {len(rest) - 4}".encode() in head
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter({(3, "revisit", 1): 1, (1, "response", None): 2, (2, "response", None): 1, (4, "response", None): 1, (5, "revisit", 4): 1, (None, "revisit", 1): 1, (None, "response", None): 1, (6, "response", None): 1})
    assert spark.read.parquet(f"{path}/payloads").count() == 5
    rebuilt = warc.rebuilt_records(spark, path)
    assert sorted(bytes(r["record"]) for r in rebuilt.collect()) == sorted(bytes(r["record"]) for r in got)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, warc.measured(rebuilt).select(*columns).collect())) == Counter(tuple(r[c] for c in columns) for r in got)
    damaged = rebuilt.withColumn("record", F.when(F.col("page_id") == 6, F.concat("record", F.lit(b"x"))).otherwise(F.col("record")))
    with pytest.raises(Exception, match="damaged record of page 6"):
        warc.measured(damaged).collect()
    with pytest.raises(Exception, match="damaged record of page 3"):
        warc.measured(rebuilt.filter("page_id <> 1")).collect()
    warc.write_warc_files(rebuilt, f"{path}/files", per_file=3)
    held = [gzip.decompress(p.read_bytes()) for p in sorted(pathlib.Path(f"{path}/files".removeprefix("file://")).glob("*.warc.gz"))]
    assert len(held) > 1 and sum(len(x) for x in held) == sum(len(r["record"]) for r in got) and all(bytes(r["record"]) in b"".join(held) for r in got)
    empty = new_path(spark, "warc-empty")
    warc.write_archive(df.limit(0), empty)
    assert warc.read_archive(spark, empty).collect() == [] == warc.measured(warc.rebuilt_records(spark, empty)).collect()


def water_fill(sizes, weights, total, epochs):
    """One source at a time, the one whose cap is reached first."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), total
    while open_:
        i = min(open_, key=lambda i: (epochs * sizes[i] / weights[i], i))
        unit = left / sum(weights[j] for j in open_)
        if weights[i] * unit < epochs * sizes[i]:
            for j in open_:
                out[j] = weights[j] * unit
            break
        out[i] = float(epochs * sizes[i])
        left -= out[i]
        open_.remove(i)
    return out


def test_water_fill(spark):
    rng = np.random.default_rng(3)
    cases = [([10, 10, 10], 1.0, 2), ([10, 10, 10], 1.5, 2), ([1, 100], 0.6, 2), ([], 1.5, 2), ([0, 5], 1.0, 2), ([1, 1], 4.5, 2), ((rng.pareto(0.7, 3000) * 50).astype(int).tolist(), 1.5, 2)]
    for sizes, share, epochs in cases:
        names = sorted(f"s{i}" for i in range(len(sizes)))
        df = spark.createDataFrame([(n, x) for n, x in zip(names, sizes, strict=True)], "source string, words long")
        got = {r["source"]: r["target"] for r in mixing.targets(df, (3, 1, 2), share, epochs).collect()}
        want = water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], share * sum(sizes), epochs)
        assert [got[n] for n in names] == pytest.approx(want, rel=1e-9)


def test_mix(spark):
    rows = [(i, ("a", "b", None, "c")[i % 7 % 4], " ".join(["w"] * (1 + i * 13 % 40))) for i in range(400)]
    rows += [(1000 + i, "a", "copy of one text") for i in range(300)] + [(None, "b", None), (5, "b", ""), (None, "d", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, size string")
    out = mixing.mix(df, bucket_rows=20).collect()
    assert len(out) == len(rows)
    again = mixing.mix(df.repartition(7), bucket_rows=20).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), str(r["text"]), r["size"], r["copies"], r["target"])
    assert sorted(map(key, out)) == sorted(map(key, again))
    sources = sorted({r[1] for r in rows if r[1]}) + [None]
    sizes = [sum(len((t or "").split()) for _, s, t in rows if s == x) for x in sources]
    want = water_fill(sizes, [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5 * sum(sizes), 2)
    for s, size, target in zip(sources, sizes, want, strict=True):
        own = [r for r in out if r["source"] == s]
        assert {(r["source_size"], round(r["target"], 6)) for r in own} == {(size, round(target, 6))}
        assert abs(sum(r["copies"] * r["size"] for r in own) - target) <= max(r["size"] for r in own) / 2
        assert all(r["copies"] <= 2 for r in own)
    mixed = mixing.mixed(df, bucket_rows=20)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in out)
    assert mixing.mix(df.limit(0)).collect() == []


def clean(texts, least):
    lines = [(t or "").split("\n") for t in texts]
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    n = Counter(k for own in lines for k in {key(x) for x in own} if k)
    kept = [[x for x in own if n[key(x)] < least] for own in lines]
    return Counter((len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(lines, kept, strict=True))


TEXTS = [None, "", "\n", "one\nTwo\n two \n", "É\né", "two", "TWO\t", "only\x1c", "x\n" * 5000, "license\nbody a", "license\nbody b", " License\r\nbody c", "license", "license\nbody a"]


def test_lines(spark):
    df = spark.createDataFrame([(i % 9, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_lines int")
    state = line_dedup.insert_documents(line_dedup.empty_state(spark, min_docs=3, shards=2), df)
    for broadcast_mb, part_mb in ((64, 64), (-1, 64), (-1, 0.001)):
        got = line_dedup.clean_lines(df, state, broadcast_mb, part_mb).collect()
        assert Counter((r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == clean(TEXTS, 3)
    assert line_dedup.clean_lines(df.limit(0), state).collect() == []


def test_lines_are_reversible(spark):
    a = spark.createDataFrame([(i, f"all\nown {i}\npair {i // 2}") for i in range(40)], "doc_id long, text string")
    b = spark.createDataFrame([(i, f"all\npair {i // 2}\nown {i % 5}") for i in range(40)], "doc_id long, text string")
    first = line_dedup.insert_documents(line_dedup.empty_state(spark, min_docs=3, shards=2), a)
    both = line_dedup.insert_documents(first, b)
    back = line_dedup.delete_documents(both, b)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(back.counts) == rows(first.counts) and rows(both.counts) != rows(first.counts)
    drop = lambda s: rows(line_dedup.clean_lines(a, s).select("doc_id", "kept_text"))
    assert drop(back) == drop(first) != drop(both)
    assert rows(line_dedup.delete_documents(back, a).counts) == []


def test_filters_get_more_shards_as_lines_come(spark):
    """Both paths of cleaning over a state whose shards grew, by an insert into an empty one and by later ones."""
    texts = [f"a {i % 30}\nb {i % 17}\nown {i}" for i in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    first = line_dedup.insert_documents(line_dedup.empty_state(spark, min_docs=4, shard_keys=8), df.filter("doc_id < 60"))
    state = line_dedup.insert_documents(first, df.filter("doc_id >= 60"))
    assert first.shards == 2 and state.shards >= 5 and state.filters.count() == state.shards
    for broadcast_mb in (64, -1):
        got = line_dedup.clean_lines(df, state, broadcast_mb, 0.001).collect()
        assert Counter((r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == clean(texts, 4)
    back = line_dedup.delete_documents(state, df.filter("doc_id >= 60"))
    got = line_dedup.clean_lines(df.filter("doc_id < 60"), back).collect()
    assert Counter((r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got) == clean(texts[:60], 4)


def test_cuckoo_filter():
    import numpy as np

    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    f = line_dedup.CuckooFilter.sized(len(keys))
    assert f.insert(keys) and f.contains(keys).all()
    other = rng.integers(0, 2**63, 50_000, dtype=np.uint64)
    assert f.contains(other).mean() < 0.001
    f.delete(keys[:2500])
    assert f.contains(keys[2500:]).all() and f.contains(keys[:2500]).mean() < 0.01
    assert not line_dedup.CuckooFilter(np.zeros((4, 4), np.uint16)).insert(keys[:40])
