"""Graph packages: edges and nodes as tables, and a manifest with the provenance of each generation of edges."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators.alignment import COVERAGE, FILTER_LOGIC, IDENTITY, SOFT_CLIP
from graphloom.operators.relations import nodes_of
from graphloom.operators.validate import missing_from, require
from graphloom.sources.shared import written

FORMAT, VERSION = "graphloom-package", 3
#: Edges of a bucket.
BUCKET_EDGES = 2_000_000
#: Keys that must be equal in all generations of one graph.
PROVENANCE_KEYS = ("aligner", "aligner_version", "aligner_options", "filter_thresholds", "filter_logic")


def generation(aligner: str, version: str, options: str, scope: str, thresholds: dict | None = None) -> dict:
    """What a generation of edges comes from. ``thresholds`` as assumed are marked so by None and cannot be compared."""
    own = {"coverage": COVERAGE, "identity": IDENTITY, "soft_clip": SOFT_CLIP}
    return {"aligner": aligner, "aligner_version": version, "aligner_options": options, "scope": scope, "filter_logic": FILTER_LOGIC, "filter_thresholds": thresholds or own, "filter_thresholds_assumed": thresholds is None}


def digest(df: DataFrame) -> dict:
    """Rows and a hash of ``df`` that does not depend on their order; one aggregate."""
    columns = sorted(df.columns)
    row = df.select(F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns)).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()
    return {"columns": columns, "rows": row["n"], "hash": f"{row['x'] or 0}/{row['s'] or 0}"}


def check_inputs(manifest: dict, **inputs: DataFrame) -> None:
    """Raises unless each of ``inputs`` has the digest that the manifest keeps under its name."""
    for name, df in inputs.items():
        if manifest["inputs"].get(name) != digest(df):
            raise ValueError(f"{name}: not those the graph was made with")


def check_provenance(generations: list[dict], new: dict) -> None:
    """Raises unless every generation has the new one's aligner, version, options and thresholds, all known and none only assumed."""
    if not generations:
        raise ValueError("a graph without generations")
    if new.get("aligner") is None:
        raise ValueError("the aligner of the new alignments is not known")
    for i, g in enumerate(generations):
        if g.get("filter_thresholds_assumed", True):
            raise ValueError(f"generation {i}: filter thresholds are assumed")
        for key in PROVENANCE_KEYS:
            if g.get(key) != new.get(key):
                raise ValueError(f"generation {i}: {key} is {g.get(key)!r}, not {new.get(key)!r}")


def write(edges: DataFrame, genes: DataFrame, path: str, generations: list[dict], settings: dict | None = None, **inputs: DataFrame) -> None:
    """Distinct edges in buckets by their ends, each in order, the nodes of ``genes`` (gene_id, gene_len, chrom, start, end, strand, bed_ord) and the manifest, which
    keeps digests of both and of ``inputs`` for check_inputs(), and ``settings`` as they are.

    Genes without a length, and edge ends that are no gene, are errors that name up to ten of them.
    """
    for g in generations:
        for key, value in g["filter_thresholds"].items():
            if not 0 <= value <= 1:
                raise ValueError(f"threshold {key} is {value}")
    require(genes.filter("gene_len is null").select("gene_id"), "genes without a length")
    require(missing_from(nodes_of(edges), genes), "edge ends without a BED gene")
    spark = edges.sparkSession
    own = written(edges.select("src", "dst").distinct(), "package-edges")
    buckets = max(1, -(-own.count() // BUCKET_EDGES))
    name = f"graphloom_{uuid.uuid4().hex}"
    own.repartition(buckets, "src", "dst").write.bucketBy(buckets, "src", "dst").sortBy("src", "dst").option("path", f"{path}/edges").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    genes.orderBy("bed_ord").write.parquet(f"{path}/nodes")
    tables = {name: digest(spark.read.parquet(f"{path}/{name}")) for name in ("edges", "nodes")}
    manifest = json.dumps({"format": FORMAT, "version": VERSION, "tables": tables, "inputs": {n: digest(df) for n, df in inputs.items()}, "generations": generations, "settings": settings or {}, "buckets": buckets}, sort_keys=True)
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.text(f"{path}/manifest")


def _bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """Stored edges with what Spark has to know to join them without a shuffle; the session's catalog gets a name for the path."""
    name = f"graphloom_edges_{hashlib.md5(path.encode()).hexdigest()}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    at = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} (src STRING, dst STRING) USING parquet CLUSTERED BY (src, dst) SORTED BY (src, dst) INTO {buckets} BUCKETS LOCATION '{at}'")
    return spark.table(name)


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, dict]:
    """Edges, nodes and manifest; another format or version, or tables that differ from the manifest's digests, are errors."""
    manifest = json.loads("".join(r["value"] for r in spark.read.text(f"{path}/manifest").collect()))
    if (manifest.get("format"), manifest.get("version")) != (FORMAT, VERSION):
        raise ValueError(f"not a {FORMAT} of version {VERSION}")
    edges, nodes = _bucketed(spark, f"{path}/edges", manifest["buckets"]), spark.read.parquet(f"{path}/nodes")
    if manifest["tables"] != {"edges": digest(edges), "nodes": digest(nodes)}:
        raise ValueError("the package's tables are not those of its manifest")
    return edges, nodes, manifest


def write_tsv(edges: DataFrame, nodes: DataFrame, path: str) -> None:
    """The same tables as tab-separated text, edges in byte order."""
    edges.distinct().orderBy("src", "dst").write.csv(f"{path}/edges.tsv", sep="\t")
    nodes.orderBy("bed_ord").select("gene_id", "gene_len", "chrom", "start", "end", "strand").write.csv(f"{path}/nodes.tsv", sep="\t")


def read_edges_tsv(spark: SparkSession, path: str) -> DataFrame:
    """src and dst; a line of another number of fields is an error."""
    f = F.split("value", "\t")
    ok = F.when(F.size(f) == 2, f).otherwise(F.raise_error(F.concat(F.lit("not an edge: "), "value")).cast("array<string>"))
    return spark.read.text(path).select(ok.alias("f")).select(F.col("f")[0].alias("src"), F.col("f")[1].alias("dst"))


def read_nodes_tsv(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", "\t")
    ok = F.when(F.size(f) == 6, f).otherwise(F.raise_error(F.concat(F.lit("not a node: "), "value")).cast("array<string>"))
    return spark.read.text(path).select(ok.alias("f")).select(F.col("f")[0].alias("gene_id"), F.col("f")[1].cast("long").alias("gene_len"))
