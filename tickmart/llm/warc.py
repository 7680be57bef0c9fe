"""Content-addressed web archive: every payload once under its SHA-256, exact record headers beside it.

An archive is two tables below one folder. ``payloads`` holds ``digest, payload, holder`` with one row per distinct
payload; ``headers`` holds the header bytes of every record, its digest and its type. Records come back by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Shorter payloads are always stored as full responses.
LEAST_SHARED = 100
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line, nothing where the value is null. Line breaks in the value are percent-coded."""
    clean = F.replace(F.replace(F.replace(value.cast("string"), F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _field(name: str) -> Column:
    """The value of a header line, null where there is none."""
    found = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.nullif(found, F.lit(""))


def _decoded(value: Column) -> Column:
    return F.replace(F.replace(F.replace(value, F.lit("%0A"), F.lit("\n")), F.lit("%0D"), F.lit("\r")), F.lit("%25"), F.lit("%"))


def _header(date: str) -> Column:
    kind = F.col("record_type")
    plain = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        _line("WARC-Target-URI", F.col("url")), _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Refers-To", F.when(kind == "revisit", F.concat(F.lit("<urn:page:"), F.col("holder").cast("string"), F.lit(">")))),
        _line("WARC-Profile", F.when(kind == "revisit", F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(kind == "revisit", F.lit(0)).otherwise(F.col("payload_bytes"))))
    return F.concat(plain, F.lit("\r\n")).cast("binary")


def write_archive(pages: DataFrame, path: str, least_shared: int = LEAST_SHARED, date: str = "2024-01-01T00:00:00Z") -> None:
    """Archive ``(page_id, url, html)`` below ``path``; the payload is the html in UTF-8.

    Of records with equal payloads of at least ``least_shared`` bytes the one with the smallest page_id is a response
    and the others revisit it; shorter ones are all responses. Null html is an empty payload. A null url leaves its
    header line out. Rows without page_id revisit a numbered one; if a payload has only such rows, one is the
    response. Repeated rows: one is the response, the rest revisit it. Other columns are not archived. An empty
    table makes an empty archive.

    Equal digests are verified: lengths and MD5 of all payloads under one SHA-256 must agree, else the write fails.
    Payloads are folded before the shuffle, so a page copied a billion times moves once per task.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    base = (pages.select("page_id", "url", payload.alias("payload"))
            .select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes")))
    proof = F.struct("payload_bytes", F.md5("payload"))
    once = base.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("page_id").alias("holder"),
                                      F.min(proof).alias("p1"), F.max(proof).alias("p2"))
    checked = F.when(F.col("p1") == F.col("p2"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("two payloads share the digest "), "digest")))
    # Without codec settings a text of some kilobytes is stored at a third of its size.
    once.select("digest", checked.alias("payload"), "holder").write.option("compression", "zstd").parquet(f"{path}/payloads")

    holders = pages.sparkSession.read.parquet(f"{path}/payloads").select("digest", "holder")
    twin = F.row_number().over(Window.partitionBy("digest", "page_id").orderBy("url"))
    kind = F.when((F.col("payload_bytes") < least_shared) | (F.col("page_id").eqNullSafe(F.col("holder")) & (F.col("twin") == 1)),
                  "response").otherwise("revisit")
    (base.select("page_id", "url", "digest", "payload_bytes").withColumn("twin", twin).join(holders, "digest")
     .withColumn("record_type", kind).select("digest", _header(date).alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(header, payload, record)``: the record as its exact bytes, the payload also for revisits."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    body = F.when(_field("WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return (headers.join(payloads.select("digest", "payload"), "digest")
            .select("header", "payload", F.concat("header", body, F.lit(END).cast("binary")).alias("record")))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records parsed back: ``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to``.

    Ids and types come from the header bytes, length and digest from the payload itself; a payload that doesn't
    match the digest in its header fails the read.
    """
    number = lambda field: F.regexp_extract(_field(field), r"<urn:page:(-?\d+)>", 1).try_cast("long")
    digest = F.sha2("payload", 256)
    right = F.concat(F.lit("sha256:"), digest) == _field("WARC-Payload-Digest")
    whole = (F.octet_length("header") + F.octet_length("payload") + len(END) == F.octet_length("record")) | (_field("WARC-Type") == "revisit")
    checked = F.when(right & whole, digest).otherwise(F.raise_error(F.lit("a payload does not match its header")))
    return read_records(spark, path).select(
        number("WARC-Record-ID").alias("page_id"), _decoded(_field("WARC-Target-URI")).alias("url"), "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"), checked.alias("payload_digest"),
        _field("WARC-Type").alias("record_type"), number("WARC-Refers-To").alias("refers_to"))
