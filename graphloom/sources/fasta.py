"""FASTA as DataFrames: record_ord, record_id, header and seq."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from graphloom.functions import sequence
from graphloom.functions.ids import gene_of
from graphloom.sources import files
from graphloom.sources.shared import written


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of one or more files, split at ``>`` at the beginning of a line, so that large files are read by many tasks.

    record_ord orders the records of one file by the place where they begin (file splits are ordered, and rows in them). Over several
    files the order is that of Spark's splits: where ids repeat across files, read each alone and put them together by concatenate().
    """
    text = spark.read.option("lineSep", "\n>").text(path).select(F.monotonically_increasing_id().alias("record_ord"), F.col("value").alias("record"))
    return parse(text)


def parse(records: DataFrame) -> DataFrame:
    """From record_ord and ``record``, the text of one record with or without its ``>``. The id is the header's first word; blank
    lines and blanks around lines (space, U+0009 to U+000D, so line ends of two characters too) are dropped. A record without an id is left out."""
    body = F.regexp_replace("record", "^>", "")
    stripped = lambda x: F.regexp_replace(x, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    header = stripped(F.substring_index(body, "\n", 1))
    rest = F.when(F.instr(body, "\n") > 0, F.expr("substring(regexp_replace(record, '^>', ''), instr(regexp_replace(record, '^>', ''), '\n') + 1)")).otherwise(F.lit(""))
    lines = F.transform(F.split(rest, "\n"), stripped)
    rows = records.select("record_ord", F.regexp_extract(header, r"^\S+", 0).alias("record_id"), header.alias("header"), F.array_join(lines, "").alias("seq"))
    return rows.filter("record_id <> ''")


INDEX = "record_ord long, record_id string, path string, offset long, size long"


def write_index(spark: SparkSession, path: str, out: str, range_mb: float = 64) -> None:
    """An index of FASTA files (not compressed): record_ord, record_id, path, offset and size in bytes of each record, sorted by id.

    Ranges of ``range_mb`` are read in parallel; a record belongs to the range where its ``>`` stands, and ends where the next one of its
    file begins. record_ord follows the files by path and the records in each.
    """
    found = files.sized(spark, path)
    starts = written(files.ranges(spark, found, files.step_of(found, range_mb)).mapInArrow(_starts, "number long, file_no long, path string, offset long, record_id string, next long"), "fasta-starts")
    firsts = {r["number"]: (r["path"], r["offset"]) for r in starts.groupBy("number").agg(F.first("path").alias("path"), F.min("offset").alias("offset")).collect()}  # one row per range
    ends, after, sizes = [], None, dict(found)
    for number, (name, offset) in sorted(firsts.items(), reverse=True):
        ends.append((number, after[1] if after and after[0] == name else sizes[name]))
        after = (name, offset)
    last = spark.createDataFrame(ends, "number long, range_end long")
    rows = starts.join(F.broadcast(last), "number").withColumn("size", F.coalesce("next", "range_end") - F.col("offset"))
    rows = rows.select((F.shiftleft("file_no", 44) + F.col("offset")).alias("record_ord"), "record_id", "path", "offset", "size")
    rows.filter("record_id <> ''").repartitionByRange("record_id").sortWithinPartitions("record_id").write.mode("overwrite").parquet(out)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """An index as records without header and sequence: subset(), by_ids() and by_genes() choose among them, fetch() reads what is chosen."""
    return spark.read.schema(INDEX).parquet(path)


def _starts(batches):
    """Of each range: where records begin, their ids, and where the next one of the range begins."""
    import pyarrow as pa

    def of_range(number, file_no, path, start, end):
        rows = []
        with files.open_at(path) as file:
            file.seek(max(0, start - 1))
            before, at = (b"\n" if start == 0 else file.read(1)), start
            while at < end:
                data = file.read(min(4 << 20, end - at))
                if not data:
                    break
                text = before + data  # a byte ahead, to see whether a line begins
                k = text.find(b"\n>")
                while k >= 0:
                    rows.append((at + k, text[k + 2 : k + 2002]))
                    k = text.find(b"\n>", k + 1)
                before, at = data[-1:], at + len(data)
            for i, (offset, head) in enumerate(rows):
                if b"\n" not in head and len(head) < 2000:  # cut off by the piece that was read
                    file.seek(offset + 1)
                    head = file.read(2000)
                rows[i] = (offset, (head.split(b"\n", 1)[0].split() or [b""])[0].decode())
        offsets = [r[0] for r in rows]
        return [(number, file_no, path, o, name, n) for (o, name), n in zip(rows, [*offsets[1:], None][: len(rows)], strict=True)]

    for batch in batches:
        for r in batch.to_pylist():
            rows = of_range(r["number"], r["file_no"], r["path"], r["start"], r["end"])
            for k in range(0, len(rows), 50_000):
                columns = list(zip(*rows[k : k + 50_000], strict=True))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["number", "file_no", "path", "offset", "record_id", "next"])


def fetch(chosen: DataFrame) -> DataFrame:
    """``chosen`` rows of an index with header and seq in place of path, offset and size: only their bytes are read, neighbours by one task."""
    rest = [f for f in chosen.schema if f.name not in ("path", "offset", "size")]
    schema = StructType([*rest, StructField("record", StringType())])

    def run(batches):
        import pyarrow as pa

        path, file = None, None
        for batch in batches:
            out, held, size = [], [], 0
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "size")), strict=True))
            for i, (name, offset, n) in enumerate(rows):
                if name != path:
                    if file is not None:
                        file.close()
                    path, file = name, files.open_at(name)
                file.seek(offset)
                out.append(file.read(n).decode())
                held.append(i)
                size += n
                if size > 32 << 20 or i == len(rows) - 1:
                    at = pa.array(held)
                    yield pa.RecordBatch.from_arrays([*(batch.column(f.name).take(at) for f in rest), pa.array(out, pa.string())], schema.names)
                    out, held, size = [], [], 0
        if file is not None:
            file.close()

    read_ = chosen.repartitionByRange("path", "offset").sortWithinPartitions("path", "offset").mapInArrow(run, schema)
    parsed = parse(read_.select(F.struct(*(f.name for f in rest)).alias("record_ord"), "record"))
    names = [f.name for f in rest if f.name != "record_id"]
    return parsed.select(*(F.col(f"record_ord.{c}").alias(c) for c in names), "record_id", "header", "seq")


def last_records(records: DataFrame, key: str = "record_id") -> DataFrame:
    """One record per key: the last."""
    return records.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(F.col("record_ord").desc()))).filter("__k = 1").drop("__k")


def lengths(records: DataFrame) -> DataFrame:
    """record_id and seq_len, of repeated ids the last; only lengths are shuffled."""
    rows = records.select("record_id", "record_ord", F.length("seq").cast("long").alias("n"))
    return rows.groupBy("record_id").agg(F.max_by("n", "record_ord").alias("seq_len"))


def identities(records: DataFrame) -> DataFrame:
    """record_id, seq_len and sha256 of the upper-case sequence, of repeated ids the last."""
    rows = records.select("record_id", "record_ord", sequence.identity(F.col("seq")).alias("i"))
    return rows.groupBy("record_id").agg(F.max_by("i", "record_ord").alias("i")).select("record_id", "i.seq_len", "i.sha256")


def transcript_index(records: DataFrame) -> DataFrame:
    """Records with the gene of their id and their place among the gene's records, in file order."""
    rows = records.withColumn("gene_id", gene_of(F.col("record_id")))
    return rows.withColumn("gene_pos", F.row_number().over(Window.partitionBy("gene_id").orderBy("record_ord")))


def subset(records: DataFrame, names: DataFrame, match: str = "full", case_sensitive: bool = False) -> DataFrame:
    """Records by ``names`` (pos, name), in the order of pos; names without a record are passed over.

    By default letter case makes no difference. ``token`` compares what stands before a space, and of that what stands before a
    bar. Of records with one key the last counts.
    """
    if match not in ("full", "token"):
        raise ValueError(f"match must be full or token, not {match!r}")

    def key(c):
        c = F.substring_index(F.substring_index(c, " ", 1), "|", 1) if match == "token" else c
        return c if case_sensitive else F.lower(c)

    keyed = last_records(records.withColumn("__key", key(F.col("record_id"))), "__key")
    return names.withColumn("__key", key(F.col("name"))).join(keyed, "__key").drop("__key")


def by_ids(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records of exactly these ids (record_id), in file order by record_ord."""
    return records.join(ids.select("record_id").distinct(), "record_id", "left_semi")


def by_genes(records: DataFrame, genes: DataFrame) -> DataFrame:
    rows = records.withColumn("gene_id", gene_of(F.col("record_id")))
    return rows.join(genes.select("gene_id").distinct(), "gene_id", "left_semi")


def concatenate(*parts: DataFrame) -> DataFrame:
    """All records, part after part; ``part`` goes before record_ord in the order."""
    out = None
    for k, p in enumerate(parts):
        p = p.withColumn("part", F.lit(k))
        out = p if out is None else out.unionByName(p)
    return out


def write(records: DataFrame, path: str, order: list[str] | None = None, width: int = 60, header: str = "record_id") -> None:
    """Text of the records with wrapped sequences, in ``order`` across the part files."""
    rows = records.orderBy(*(order or ["record_ord"]))
    rows.select(F.concat(F.lit(">"), header, F.lit("\n"), sequence.wrap(F.col("seq"), width))).write.text(path)
