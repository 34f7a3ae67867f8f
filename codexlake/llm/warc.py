"""Content-addressed WARC archive.

``write_archive`` stores each distinct payload once, under its SHA-256, and the
records' header blocks, byte for byte, in a table of their own. Equal digests
are verified: a digest that stands for payloads of different length or SHA-1
stops the write. ``read_archive`` joins the two and returns whole records as
they stand in a WARC/1.1 file; ``parse_record`` columns take them apart again.

Of records with equal payloads of at least ``min_revisit`` bytes that with the
largest id is the response and the others revisit it; smaller ones are all
responses.

Defined cases: a null payload is empty; a null URL is an empty target; a null
id is written as no id, is never referred to, and its record revisits the
largest id of its group, if there is one; rows repeated with the largest id are
all responses; an empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

CRLF = "\r\n"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit(CRLF))


def records(pages: DataFrame, payload: Column, record_id: Column, url: Column) -> DataFrame:
    """One row per page: record_id, url, payload (binary), sha256, sha1, n."""
    rows = pages.select(record_id.cast("long").alias("record_id"), F.coalesce(F.regexp_replace(url, r"[\x00-\x1F\x7F]", "%20"), F.lit("")).alias("url"), F.coalesce(payload.cast("binary"), F.lit("").cast("binary")).alias("payload"))
    return rows.select("*", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n"))


def _written(scratch: Scratch, path: str | None, df: DataFrame, name: str) -> DataFrame:
    if path is None:
        return scratch.put(df, name)
    df.write.parquet(f"{path}/{name}")
    return scratch.spark.read.schema(df.schema).parquet(f"{path}/{name}")


def open_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The tables of an archive that was written at a path."""
    return spark.read.parquet(f"{path}/payloads"), spark.read.parquet(f"{path}/headers")


def write_archive(pages: DataFrame, scratch: Scratch, payload: str = "html", record_id: str = "page_id", url: str = "url", min_revisit: int = 1000, date: str = "2024-01-01T00:00:00Z", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The tables (payloads, headers) of an archive: at ``path``, where they stay
    (see open_archive), or in scratch.

    payloads: sha256, payload, sha1, n, keeper (largest record_id).
    headers: record_id, sha256, header (binary)."""
    rec = records(pages, F.col(payload), F.col(record_id), F.col(url))
    stored = rec.groupBy("sha256").agg(F.any_value("payload").alias("payload"), F.max("record_id").alias("keeper"), F.min(F.struct("n", "sha1")).alias("lo"), F.max(F.struct("n", "sha1")).alias("hi"))
    same = F.when(F.col("lo") == F.col("hi"), F.col("lo.n")).otherwise(F.raise_error(F.concat(F.lit("one digest, two payloads: "), "sha256")).cast("long"))
    payloads = _written(scratch, path, stored.select("sha256", "payload", F.col("lo.sha1").alias("sha1"), same.alias("n"), "keeper"), "payloads")
    # AQE splits the rows of a hot digest in this join
    head = rec.select("record_id", "url", "sha256", "sha1", "n").join(payloads.select("sha256", "keeper"), "sha256", "left")
    revisit = (F.col("n") >= min_revisit) & F.coalesce(F.col("record_id") != F.col("keeper"), F.col("keeper").isNotNull())
    block = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("record_id").cast("string"), F.lit("-")), F.lit(">"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("keeper").cast("string"), F.lit(">"))))).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit(CRLF),
    )
    headers = _written(scratch, path, head.select("record_id", "sha256", block.cast("binary").alias("header")), "headers")
    return payloads, headers


def read_archive(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """Records put together again: record_id, header, payload (the full one,
    also of revisits; its digest is verified) and record, the bytes as in a
    WARC file, where a revisit has no body."""
    both = headers.join(payloads.select("sha256", "payload"), "sha256", "left")
    sound = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "sha256")).cast("binary"))
    both = both.select("record_id", "header", sound.alias("payload"))
    body = F.when(header_field("WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return both.withColumn("record", F.concat(F.col("header"), body, F.lit(CRLF + CRLF).cast("binary")))


def header_field(name: str) -> Column:
    """A named field of the column ``header``; empty if it has none."""
    return F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def parsed(archive: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the
    records read; sizes and digests are those of the payload read."""
    def ident(name: str) -> Column:
        return F.regexp_extract(header_field(name), r"<urn:page:(-?\d+)>", 1)

    def number(c: Column) -> Column:
        return F.when(c != "", c.cast("long"))

    return archive.select(
        number(ident("WARC-Record-ID")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        number(ident("WARC-Refers-To")).alias("refers_to"),
    )


def scan_warc_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of plain or gzip-compressed WARC files: file, header, body."""
    from .warc_files import split_records

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.select(F.col("path").alias("file"), F.explode(split_records("content")).alias("r")).select("file", "r.header", "r.body")
