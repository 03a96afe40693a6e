"""Content-addressed WARC archive.

An archive is a folder with two tables. ``payloads`` has the bytes of every distinct payload
once, under its SHA-256. ``headers`` has the exact header block of every record with the
digest that leads to the payload; rows lie in no order. Records are put together
again by a join: header block, payload (none for a revisit), two line ends.

Defined cases: a null payload is empty; payloads below ``MIN_REVISIT`` bytes are always
responses; rows that repeat a page id repeat its record; a null id or URL leaves its header
line out, and a null id is never referred to; line ends in a URL are percent-encoded. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepwise.llm.common import open_out

MIN_REVISIT = 100
EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(EOL))).otherwise(F.lit(""))


def record_urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def assign_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Every page with its payload digest, length, type and the response it refers to.

    The digests alone are shuffled: one reduced row per digest, then a join that adaptive
    execution can split when one payload has many pages.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    keyed = rows.select(
        "page_id", "url", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    first = keyed.groupBy("digest").agg(F.min("page_id").alias("first_page"))
    revisit = (F.col("payload_bytes") >= MIN_REVISIT) & ~F.col("page_id").eqNullSafe(F.col("first_page")) & F.col("first_page").isNotNull()
    return keyed.join(first, "digest").select(
        "page_id",
        "url",
        "digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_page")).alias("refers_to"),
    )


def with_header(records: DataFrame, date: str) -> DataFrame:
    """Adds the exact header block of each record."""
    revisit = F.col("record_type") == "revisit"
    safe_url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    block = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", record_urn(F.col("page_id"))),
        _line("WARC-Target-URI", safe_url),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Refers-To", record_urn(F.col("refers_to"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit(EOL),
    )
    return records.withColumn("header", block.cast("binary"))


def write_archive(
    pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", key: str = "page_id", url: str = "url", payload: str = "html"
) -> None:
    """Write ``headers`` and ``payloads`` below ``folder``.

    Of equal digests one payload is stored. That they stand for one payload is checked with an
    independent hash and the length; a collision ends the job instead of losing bytes.
    """
    records = with_header(assign_records(pages, key, url, payload), date)
    headers = records.select("page_id", "header", "digest", "record_type")
    headers.write.option("compression", "zstd").parquet(f"{folder}/headers")
    body = pages.select(F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    check = F.concat_ws("/", F.xxhash64("payload").cast("string"), F.octet_length("payload").cast("string"))
    once = (
        body.select(F.sha2("payload", 256).alias("digest"), check.alias("check"), "payload")
        .groupBy("digest")
        .agg(F.min("check").alias("low"), F.max("check").alias("high"), F.first("payload").alias("payload"))
    )
    clash = F.raise_error(F.lit("two payloads share a digest")).cast("binary")
    stored = once.select("digest", F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(clash).alias("payload"))
    stored.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The original records: page_id (of the index), record bytes, and the payload that its digest leads to."""
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads").select(
        "digest", "payload", (F.sha2("payload", 256) == F.col("digest")).alias("verified")
    )
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return headers.join(payloads, "digest", "left").select(
        "page_id",
        F.concat("header", body, F.lit(f"{EOL}{EOL}".encode())).alias("record"),
        "payload",
        "verified",
    )


def parse_records(records: DataFrame) -> DataFrame:
    """Read the fields back from the record bytes.

    The header block ends at the first empty line; the payload follows for as many bytes as
    Content-Length says. A record whose payload is missing or does not have its digest ends the job.
    """
    # Header text is ASCII but for the URL, whose bytes stay one character each in Latin-1.
    text = F.decode("record", "ISO-8859-1")
    head = F.substring_index(text, EOL * 2, 1)
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)", 1), F.lit(""))
    page = lambda name: F.regexp_extract(F.coalesce(field(name), F.lit("")), r"<urn:page:(-?\d+)>", 1)
    known = records.withColumn("head", head).select(
        F.nullif(page("WARC-Record-ID"), F.lit("")).cast("long").alias("page_id"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha256:([0-9a-f]{64})$", 1).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.nullif(page("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"),
        field("Content-Length").cast("long").alias("content_length"),
        (F.octet_length("record") - F.length("head") - F.lit(8)).cast("long").alias("body_bytes"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "verified",
    )
    whole = F.coalesce(F.col("verified"), F.lit(False)) & (F.col("content_length") == F.col("body_bytes"))
    broken = F.raise_error(F.concat(F.lit("record is damaged: page "), F.coalesce(F.col("page_id").cast("string"), F.lit("?"))))
    return known.withColumn("payload_bytes", F.when(whole, F.col("payload_bytes")).otherwise(broken.cast("long"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def export_files(records: DataFrame, folder: str, files: int) -> DataFrame:
    """Write the records as ``.warc`` files, ordered by page within a file; returns path, records and bytes of each."""

    def run(batches):
        import pyarrow as pa

        out, count, size = None, 0, 0
        for batch in batches:
            for record in batch.column("record").to_pylist():
                if out is None:
                    out, path = open_out(folder, "records")
                out.write(record)
                count, size = count + 1, size + len(record)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count], "bytes": [size]})

    dealt = records.repartitionByRange(files, "page_id").sortWithinPartitions("page_id")
    return dealt.select("record").mapInArrow(run, "path string, records long, bytes long")
