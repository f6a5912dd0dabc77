"""What the queries leave on the disk, and that paths for many rows give what the plain ones give."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.operators import alignment, graph, relations, transcripts
from graphloom.plans import derived
from graphloom.plans.queries import QUERIES
from graphloom.sources import shared


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def scratch_tables(spark) -> Counter:
    path = spark._jvm.org.apache.hadoop.fs.Path(shared.scratch_dir(spark))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return Counter(x.getPath().getName().rsplit("-", 1)[0] for x in system.listStatus(path)) if system.exists(path) else Counter()


def rows_of(df, *columns) -> Counter:
    return Counter(map(str, df.select(*(columns or sorted(df.columns))).collect()))


def test_written_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    out = shared.written(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffle_files(spark) == before and out.count() == 7
    shared.dropped(out)
    assert "counts" not in scratch_tables(spark)


def odd_lines(spark, tmp_path):
    """Orders with lines of one number, of one part and of several sizes; null keys."""
    part = [(k, "STANDARD" if k % 2 else "SMALL", k % 2) for k in range(6)] + [(6, "LARGE", None)]
    line = [(o, p, n, 7 + n, 0.01 * n, 0.02, 10.0 * n, "R" if n == 2 else "N") for o in (1, 2, None) for p in (0, 1, 2, 2, 3, 6) for n in (1, 2, 2)]
    spark.createDataFrame(part, "p_partkey long, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    columns = "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_discount double, l_tax double, l_quantity double, l_returnflag string"
    spark.createDataFrame(line, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_stored_alignments_are_all_pairs(spark, tmp_path):
    at = odd_lines(spark, tmp_path)
    got, tables = derived.stored_alignments(spark, at)
    assert rows_of(got) == rows_of(derived.alignments(spark, at)) and got.count() > 100
    shared.dropped(*tables)


def test_hubs_of_many_patterns_are_grouped_alike(spark):
    texts = ["1-2", "11-22", "1-2:5-6", "11-2:5-66", "mono", "1-2:5-6:8-9", "8-9", "1-2", "5-6:8-9", "mono"]
    rows = [(f"h{h}", f"t{h}.{i}", texts[(i * (h + 1)) % len(texts)], i + 1) for h in range(4) for i in range(len(texts))]
    cands = spark.createDataFrame(rows, "hub string, transcript_id string, pattern string, cand_ord int")
    index = transcripts.superstring_groups(cands, hub_patterns=0)
    assert rows_of(transcripts.superstring_groups(cands)) == rows_of(index) == rows_of(transcripts.superstring_groups(cands, hub_patterns=5))


#: Queries and the scratch tables that are left when their result is computed.
LEFT = {
    "superstring_groups": ["edges", "grouped"],
    "gtf_rows": ["edges", "grouped"],
    "spliced_cdna": ["edges", "grouped"],
    "rescue_from_pre": ["edges", "grouped", "pre-gtf"],
    "representative_transcripts": ["edges", "grouped"],
    "gtf_attribute_parse": ["edges", "grouped"],
    "pan_sort": ["edges", "grouped", "ranges", "ranges", "ranges"],
}


@pytest.mark.parametrize("name", LEFT)
def test_queries_keep_little(spark, sf_dir, name):
    shared.clear_scratch(spark)
    before = shuffle_files(spark)
    got = QUERIES[name](spark, sf_dir)
    assert shuffle_files(spark) < before + 16  # those of counts, not of tables
    assert scratch_tables(spark) == Counter(LEFT[name])
    assert got.count() > 0


def test_records_without_an_exon(spark):
    columns = "rec_ord long, query_id string, target string, is_unmapped boolean, is_secondary boolean, is_supplementary boolean, pos0 long, cigar string, seq_len long, as_score int, ms_score int, nm int"
    rows = [(1, "a.g.1", "a.g", "5S0M"), (2, "a.g.1", "a.g", "10M"), (3, "a.g.2", "a.g", "*"), (4, "a.g.3", "a.g", None), (5, "b", "b", "3=2I1X"), (0, "a.g.1", "b", "4M")]
    df = spark.createDataFrame([(o, q, t, False, False, False, 0, c, 10, None, None, None) for o, q, t, c in rows], columns)
    members = spark.createDataFrame([("a.g", "a.g"), ("b", "b")], "hub string, gene_id string")
    got = alignment.best_alignments(df, members).select("transcript_id", "target", "rec_ord", "tx_ord").collect()
    assert {tuple(r) for r in got} == {("a.g.1", "a.g", 2, 2), ("b", "b", 5, 5)}
    kept = alignment.best_of_targets(df)
    assert kept.count() == 5 and kept.filter("best is null").count() == 2


def test_small_groups_share_calls(spark):
    """One call of a Python function for thousands of rows, whatever the number of groups; each group as peel() has it."""
    n = 6000
    members = spark.range(n).select(F.format_string("s%d", F.floor(F.col("id") / 3)).alias("group_id"), F.format_string("g%06d", "id").alias("gene_id"))
    assert members.select(relations.dealt(members, "group_id").alias("b")).distinct().count() == 2
    two = [(f"g{3 * k + i:06d}", f"g{3 * k + j:06d}") for k in range(n // 3) for i, j in ((0, 1), (1, 0), (k % 3, 2))]
    edges = spark.createDataFrame(two, "src string, dst string")
    genes = members.select("gene_id", F.lit(100).cast("long").alias("gene_len"))
    got = Counter((r["group_id"], r["round"], r["member_pos"], r["gene_id"]) for r in graph.hub_clusters(edges, members, genes, "none").collect())
    want = Counter()
    for k in range(n // 3):
        own = [(f"g{3 * k + i:06d}", 100, False) for i in range(3)]
        found = graph.peel(own, [e for e in two[3 * k : 3 * k + 3]])
        linked = {x for e in two[3 * k : 3 * k + 3] for x in e}
        assert linked == {x for x, _, _ in own}
        want.update((f"s{k}", r, i, x) for r, c in enumerate(found) for i, x in enumerate(c))
    assert got == want
