"""SAM text and BAM files as alignment tables."""

from __future__ import annotations

import io
import json
import re
import shlex

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.sources import bam, files

ALIGNMENT = (
    "rec_ord long, query_id string, target string, is_unmapped boolean, is_secondary boolean, is_supplementary boolean, is_reverse boolean,"
    " pos0 long, cigar string, seq_len int, seq_sha256 string, as_score int, ms_score int, nm int"
)
def _flag(c: Column, bit: int) -> Column:
    return c.bitwiseAND(F.lit(bit)) != 0


def _typed(rows: DataFrame) -> DataFrame:
    """From rec_ord, query_id, flag, target, pos0, cigar, seq_len, seq, as_score, ms_score, nm. Sequence identity is that of the forward strand."""
    from graphloom.functions.sequence import reverse_complement

    flag = F.col("flag")
    seq = F.when(~F.col("seq").isin("*", ""), F.upper("seq"))
    forward = F.when(_flag(flag, 16), reverse_complement(seq)).otherwise(seq)
    return rows.select(
        "rec_ord", "query_id", F.when(F.col("target") != "*", F.col("target")).alias("target"), _flag(flag, 4).alias("is_unmapped"), _flag(flag, 256).alias("is_secondary"),
        _flag(flag, 2048).alias("is_supplementary"), _flag(flag, 16).alias("is_reverse"), "pos0", "cigar", "seq_len", F.sha2(forward, 256).alias("seq_sha256"),
        "as_score", "ms_score", "nm",
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of SAM text behind its headers: rec_ord and value."""
    return spark.read.text(path).filter(~F.startswith("value", F.lit("@"))).select(F.monotonically_increasing_id().alias("rec_ord"), "value")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment records of SAM text; header lines are passed over. Splits are read in parallel; rec_ord ascends along each file."""
    rows = _lines(spark, path).select("rec_ord", F.split("value", "\t").alias("f"))
    rows = rows.filter(F.size("f") >= 11)
    tag = lambda name: F.regexp_extract(F.try_element_at(F.filter(F.slice("f", 12, 100_000), lambda x: F.startswith(x, F.lit(f"{name}:i:"))), F.lit(1)), ":i:(-?[0-9]+)$", 1).try_cast("int")
    f = lambda k: F.col("f")[k]
    return _typed(
        rows.select("rec_ord", f(0).alias("query_id"), f(1).cast("int").alias("flag"), f(2).alias("target"), (f(3).cast("long") - 1).alias("pos0"), f(5).alias("cigar"), F.when(~f(9).isin("*", ""), F.length(f(9))).alias("seq_len"), f(9).alias("seq"), tag("AS").alias("as_score"), tag("ms").alias("ms_score"), tag("NM").alias("nm"))
    )


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """Header lines of SAM text or, where ``path`` ends in .bam, of BAM files: file, line_ord (ascending in a file) and line. The
    @SQ lines of a BAM file are made from its own list of targets."""
    if not path.endswith(".bam"):
        rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line_ord"), F.col("value").alias("line"))
        return rows.filter(F.startswith("line", F.lit("@")))

    def lines_of(text, targets):
        return [x for x in text.splitlines() if x and not x.startswith("@SQ")] + [f"@SQ\tSN:{name}\tLN:{n}" for name, n in targets]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for file in batch.column("path").to_pylist():
                with files.open_at(file) as at:
                    lines = lines_of(*bam.header_of(at, at.size()))
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(lines), pa.string()), pa.array(range(len(lines)), pa.int64()), pa.array(lines, pa.string())], ["file", "line_ord", "line"])

    def run_whole(batches):
        import pyarrow as pa

        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                raw = io.BytesIO(content.as_buffer().to_pybytes())
                lines = lines_of(*bam.header_of(raw, len(raw.getbuffer())))
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(lines), pa.string()), pa.array(range(len(lines)), pa.int64()), pa.array(lines, pa.string())], ["file", "line_ord", "line"])

    schema, (near, far) = "file string, line_ord long, line string", _files(spark, path)
    out = spark.createDataFrame([(p,) for p, _ in near], "path string").repartition(max(1, len(near))).mapInArrow(run, schema)
    return out if not far else out.unionByName(_contents(spark, far).mapInArrow(run_whole, schema))


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("line", rf"\t{name}:([^\t]+)", 1), F.lit(""))


def targets(lines: DataFrame) -> DataFrame:
    """name and length from the @SQ lines of a header, each once."""
    return lines.filter(F.startswith("line", F.lit("@SQ"))).select(_field("SN").alias("name"), _field("LN").cast("long").alias("length")).distinct()


def programs(lines: DataFrame) -> DataFrame:
    """file, line_ord, name, version and command of the @PG lines; null where a line does not have one."""
    return lines.filter(F.startswith("line", F.lit("@PG"))).select("file", "line_ord", _field("PN").alias("name"), _field("VN").alias("version"), _field("CL").alias("command"))


def comments(lines: DataFrame) -> DataFrame:
    """file and comment of the @CO lines."""
    return lines.filter(F.startswith("line", F.lit("@CO\t"))).select("file", F.substring("line", 5, 2**31 - 1).alias("comment"))


def aligner_options(command: str | None) -> str | None:
    """The options of an aligner's command line: without the program, the number of threads (-t) and the two files at its end. None
    if the line is missing or has no two files."""
    words = shlex.split(command or "")
    return " ".join(re.sub(r"(?<!\S)-t\s*\d+(?!\S)", "", " ".join(words[1:-2])).split()) if len(words) > 2 else None


def last_aligner(lines: DataFrame, name: str | None = None) -> dict | None:
    """aligner, aligner_version and aligner_options of the last @PG line of program ``name`` (of any that has a command, if None). Files
    with different ones are an error; None if no file has such a line."""
    rows = programs(lines).filter(F.col("name") == name if name else F.col("command").isNotNull())
    last = rows.groupBy("file").agg(F.max_by(F.struct("name", "version", "command"), "line_ord").alias("p")).select("p.*").distinct().limit(1_000)
    found = [{"aligner": r["name"], "aligner_version": r["version"], "aligner_options": aligner_options(r["command"])} for r in last.collect()]
    if any(x != found[0] for x in found):
        raise ValueError(f"alignments of several programs, versions or options: {found[:10]}")
    return found[0] if found else None


#: Columns of the data source that a column of ``ALIGNMENT`` is made from, besides its own name.
_MADE_FROM = {"is_unmapped": "flag", "is_secondary": "flag", "is_supplementary": "flag", "is_reverse": "flag"}


def _files(spark: SparkSession, path: str) -> tuple[list[tuple[str, int]], list[str]]:
    """BAM files (path, size) that Python can read in ranges, and those that only Spark reads or that have no blocks."""
    near, far = [], []
    for name, size in files.sized(spark, path):
        try:
            with files.open_at(name) as file:
                ranged = bam.is_blocked(file)
        except (OSError, ValueError, NotImplementedError):  # a store that only Spark reads
            ranged = False
        if ranged:
            near.append((name, size))
        else:
            far.append(name)
    return near, far


def _contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def _records(spark: SparkSession, path: str, columns: list[str], range_mb: float) -> DataFrame:
    near, far = _files(spark, path)
    spark.dataSource.register(bam.BamSource)
    options = {"columns": ",".join(columns), "files": json.dumps(near), "step": str(files.step_of(near, range_mb))}
    out = spark.read.format(bam.BamSource.name()).options(**options).load()
    if not far:
        return out
    want = set(columns)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(kinds)
        for batch in batches:
            for content in batch.column("content"):
                yield from bam.batches(bam.records_of_file(content.as_buffer().to_pybytes(), want), schema)

    kinds = out.schema
    return out.unionByName(_contents(spark, far).select("content").mapInArrow(run, kinds))


def read_bam(spark: SparkSession, path: str, columns: list[str] | None = None, range_mb: float = 16) -> DataFrame:
    """Alignment records of BAM files, each cut into ranges of ``range_mb`` that are read in parallel. ``columns`` of ``ALIGNMENT``, all if
    None: what the others need is not unpacked. rec_ord ascends along each file (it is a record's virtual offset).

    Files of which only Spark can read the store, and gzip streams without blocks, are read whole by a task each.
    """
    every = [c.split()[0] for c in ALIGNMENT.split(", ")]
    columns = every if columns is None else list(columns)
    need = {_MADE_FROM.get(c, c) for c in columns} | ({"seq", "flag"} if "seq_sha256" in columns else set())
    rows = _records(spark, path, [c.split()[0] for c in bam.RECORD.split(", ") if c.split()[0] in need], range_mb)
    missing = {c.split()[0]: F.lit(None).cast(c.split()[1]) for c in bam.RECORD.split(", ") if c.split()[0] not in need}
    return _typed(rows.withColumns(missing) if missing else rows).select(*columns)


def write_filtered_bam(filtered: DataFrame, path: str, out: str, mark: str, per_file: int = 1_000_000, range_mb: float = 16) -> None:
    """The records of the BAM file ``path`` whose rec_ord ``filtered`` holds, as they are, in a folder of BAM files: in the order of
    the names and of the records in each they follow rec_ord. Each has the whole header, with ``mark`` as a comment at its end.

    ``path`` is one file in blocks. About ``per_file`` records come to a file; no records give one file with the header alone.
    """
    spark = filtered.sparkSession
    near, far = _files(spark, path)
    if far or len(near) != 1:
        raise ValueError(f"not one BAM file in blocks that Python can read: {path}")
    with files.open_at(near[0][0]) as file:
        text, targets = bam.header_of(file, near[0][1])
    kept = filtered.select("rec_ord").distinct()
    rows = _records(spark, path, ["rec_ord", "raw"], range_mb).join(kept, "rec_ord", "left_semi")
    parts = max(1, -(-kept.count() // per_file))
    text = text + ("" if not text or text.endswith("\n") else "\n") + f"@CO\t{mark}\n"
    options = {"path": out, "text": text, "targets": json.dumps(targets)}
    rows.repartitionByRange(parts, "rec_ord").sortWithinPartitions("rec_ord").select("raw").write.format(bam.BamSource.name()).mode("overwrite").options(**options).save()


def write_filtered_sam(filtered: DataFrame, path: str, out: str, mark: str) -> None:
    """The lines of the SAM text ``path`` whose rec_ord ``filtered`` holds, as they are, behind all header lines and the comment ``mark``:
    a folder of text files whose names follow the order, so that together they are one SAM text."""
    spark = filtered.sparkSession
    lines = spark.read.text(path)
    head = lines.select(F.monotonically_increasing_id().alias("rec_ord"), "value").filter(F.startswith("value", F.lit("@"))).withColumn("part", F.lit(0))
    note = spark.createDataFrame([(0, f"@CO\t{mark}", 1)], "rec_ord long, value string, part int")
    body = _lines(spark, path).withColumn("part", F.lit(2)).join(filtered.select("rec_ord").distinct(), "rec_ord", "left_semi")
    head.unionByName(note).unionByName(body).repartitionByRange("part", "rec_ord").sortWithinPartitions("part", "rec_ord").select("value").write.mode("overwrite").text(out)
