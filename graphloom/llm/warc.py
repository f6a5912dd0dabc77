"""Content-addressed WARC archive: each payload once under its SHA-256, exact record headers apart, records by joins.

An archive is two tables in one folder: ``payloads`` (address, payload_digest, n_bytes, payload) and ``records``
(page_id, address, header). A record's bytes are its header block followed by the payload, for a response, or by nothing,
for a revisit, which names the response that carries the same payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import written

#: The digits that conv() writes in base 32, and those of RFC 4648.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary ``data``; 160 bits are four times eight digits, so there is no padding."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(data), 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*digits), CONV_DIGITS, BASE32_DIGITS)


PAYLOADS = "address binary, payload_digest string, n_bytes long, first_page long, payload binary"
RECORDS = "page_id long, address binary, header binary"


def _header(kind: Column, date: str) -> Column:
    """The header block up to and with the empty line. Values come last in their lines; line ends in a url become spaces."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: "), urn(page),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.translate(F.coalesce("url", F.lit("")), "\r\n", "  "),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(kind == "revisit", F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            urn(F.col("first_page")),
        )).otherwise(F.lit("")),
        F.lit("\r\nContent-Length: "), F.when(kind == "revisit", F.lit("0")).otherwise(F.col("n_bytes").cast("string")),
        F.lit("\r\n\r\n"),
    )


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes ``pages`` (page_id, url, html; other columns are left out) as an archive in folder ``path``.

    A null html is an empty payload. Of the records with equal payloads of at least ``min_revisit_bytes``, those with the
    smallest page_id are responses and the others revisits; rows that repeat the smallest page_id are all responses, and if
    every page_id is null, all are. Payload bytes are shuffled once, already joined into one copy by each map task; the
    records carry digests only, so that a payload which a third of all pages share stays small.
    """
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload")).withColumns(
        {"address": F.unhex(F.sha2("payload", 256)), "payload_digest": sha1_base32(F.col("payload")), "n_bytes": F.length("payload").cast("long")}
    )
    (
        hashed.groupBy("address")
        .agg(F.first("payload_digest").alias("payload_digest"), F.first("n_bytes").alias("n_bytes"), F.min("page_id").alias("first_page"), F.first("payload").alias("payload"))
        .write.parquet(f"{path}/payloads")
    )
    spark = pages.sparkSession
    store = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads").drop("payload", "n_bytes", "payload_digest")
    revisit = (F.col("n_bytes") >= min_revisit_bytes) & (F.col("page_id") != F.col("first_page"))
    kind = F.when(F.coalesce(revisit, F.col("page_id").isNull() & F.col("first_page").isNotNull()), F.lit("revisit")).otherwise(F.lit("response"))
    records = hashed.drop("payload").join(store, "address")
    records.select("page_id", "address", F.encode(_header(kind, date), "UTF-8").alias("header")).write.parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record, from the archive alone: page_id, record_type, payload_digest, payload_bytes, refers_to, header.

    Each stored payload is hashed again: a wrong SHA-256 address, a header whose digest or length differs, or a missing payload
    ends the job. With ``payloads``, ``payload`` is joined too, for responses and revisits alike.
    """
    store = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    sound = store.select(
        "address",
        F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), sha1_base32(F.col("payload"))).alias("__sha1"),
        F.length("payload").cast("long").alias("payload_bytes"),
        *(["payload"] if payloads else []),
    )
    text = F.decode("header", "UTF-8")
    field = lambda name: F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    records = spark.read.schema(RECORDS).parquet(f"{path}/records").withColumns(
        {
            "record_type": field("WARC-Type"),
            "payload_digest": F.substring(field("WARC-Payload-Digest"), 6, 32),
            "refers_to": F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1),
            "__length": field("Content-Length").cast("long"),
        }
    )
    ok = (F.col("payload_digest") == F.col("__sha1")) & (F.col("__length") == F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.col("payload_bytes")))
    return records.join(sound, "address", "left").select(
        "page_id",
        F.when(ok, F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("damaged record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))).cast("long")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.when(F.col("refers_to") != "", F.col("refers_to")).cast("long").alias("refers_to"),
        "header",
        *(["payload"] if payloads else []),
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """Adds ``record``: the exact bytes of each record as a WARC file holds them, from read_archive(payloads=True)."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.withColumn("record", F.concat("header", body, F.lit(b"\r\n\r\n")))


def rebuilt_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, address and record: the exact bytes of every record of an archive, responses by a join with the one copy of their payload.

    A stored payload that is not the one of its address, or a missing one, ends the job. Payloads meet the responses only, so that a
    payload with many revisits is not copied for them.
    """
    store = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    sound = store.select("address", F.when(F.unhex(F.sha2("payload", 256)) == F.col("address"), F.col("payload")).alias("payload"))
    records = spark.read.schema(RECORDS).parquet(f"{path}/records").withColumn("__revisit", F.contains(F.decode("header", "UTF-8"), F.lit("\r\nWARC-Type: revisit\r\n")))
    end = F.lit(b"\r\n\r\n")
    lost = F.raise_error(F.concat(F.lit("no sound payload for page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))).cast("binary")
    responses = records.filter("not __revisit").join(sound, "address", "left").withColumn("record", F.concat("header", F.coalesce("payload", lost), end))
    revisits = records.filter("__revisit").withColumn("record", F.concat("header", end))
    return responses.select("page_id", "address", "record").unionByName(revisits.select("page_id", "address", "record"))


def measured(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of rebuilt_records(), told from their bytes alone.

    A response's payload is what its header's Content-Length cuts off behind the empty line; it must hash to the header's digest and be
    followed by two line ends. A revisit has the measures of the response that it names and that has its digest; one without such a
    response, as any other damage, ends the job.
    """
    text = F.decode("record", "ISO-8859-1")  # one character for each byte
    head = F.substring_index(text, "\r\n\r\n", 1)
    field = lambda name: F.regexp_extract(F.concat(F.col("head"), F.lit("\r\n")), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    rows = records.withColumn("head", head).withColumns(
        {
            "record_type": field("WARC-Type"),
            "said": F.substring(field("WARC-Payload-Digest"), 6, 32),
            "length": field("Content-Length").cast("int"),
            "refers_to": F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).try_cast("long"),
        }
    )
    body = F.substring("record", F.length("head") + 5, F.col("length"))
    damage = lambda kind: F.raise_error(F.concat(F.lit("damaged record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))).cast(kind)
    whole = (F.length("record") == F.length("head") + F.col("length") + 8) & (F.substring("record", F.length("head") + F.col("length") + 5, F.lit(4)) == F.lit(b"\r\n\r\n"))
    own = rows.filter("record_type = 'response'").withColumn("payload_digest", sha1_base32(body))
    own = own.select("page_id", "address", F.when(whole & (F.col("payload_digest") == F.col("said")), F.col("length").cast("long")).otherwise(damage("long")).alias("payload_bytes"), "payload_digest")
    own = written(own, "warc-responses")
    named = own.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("said"), "payload_bytes").distinct()
    again = rows.filter("record_type = 'revisit'").select("page_id", "refers_to", "said").join(named, ["refers_to", "said"], "left")
    again = again.withColumn("payload_bytes", F.coalesce("payload_bytes", damage("long")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = own.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return first.unionByName(again.select("page_id", "payload_bytes", F.col("said").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to").select(*columns))


def write_warc_files(records: DataFrame, path: str, per_file: int = 10_000) -> None:
    """rebuilt_records() as files that other tools read: gzip with a member for each record, in a folder of about ``per_file`` records each,
    ordered by page_id. Each task writes its own under a name that no other try has, and what it wrote is listed in ``_files``."""
    import gzip
    import uuid

    from pyspark import TaskContext

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, folder = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        system.create_dir(folder, recursive=True)
        name, n, out = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.warc.gz", 0, None
        for batch in batches:
            for record in batch.column("record").to_pylist():
                out = out or system.open_output_stream(f"{folder}/{name}", compression=None)
                out.write(gzip.compress(record, mtime=0))
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "records"])

    parts = max(1, -(-records.count() // per_file))
    ordered = records.repartitionByRange(parts, "page_id", F.sha2("record", 256)).sortWithinPartitions("page_id")
    ordered.select("record").mapInArrow(run, "file string, records long").write.mode("overwrite").json(f"{path}/_files")
