"""Content-addressed WARC archive: every payload once by its SHA-256, the exact record headers apart, joined for reading."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.common import BROADCAST_ROWS, landed, shared_folder, small_or_shuffled

_CRLF = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """Folders of an archive: `headers` (one row a record) and `payloads` (one row a distinct payload)."""

    headers: str
    payloads: str


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as 32 upper-case base32 characters: each five hexadecimal digits are four characters."""
    hexadecimal = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    """A header line; line breaks in the value are escaped, a null value gives no line."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(_CRLF)), F.lit(""))


def _identifier(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archive(pages: DataFrame, folder: str | None = None, id_column: str = "page_id", url_column: str = "url",
                  payload_column: str = "html", date: str = "1970-01-01T00:00:00Z", min_revisit_bytes: int = 0,
                  broadcast_rows: int = BROADCAST_ROWS) -> Archive:
    """Write one record per row and each distinct payload once; gives the folders.

    Payloads are text in UTF-8, null as empty. Of records with equal payloads of at least `min_revisit_bytes`, the one
    with the smallest id (null ids last; of repeated rows one of them) is a response and the others are revisits of it.
    A shorter payload makes every record a response. A null URL leaves its header line out; line breaks in a URL are
    escaped. An empty table gives an archive without records.

    Payloads are combined by digest inside every task before the shuffle, so one payload of a third of all pages moves
    once per task. Headers meet the first record of their payload by a broadcast of checked size or a sort-merge join.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    archive = Archive(f"{folder}/headers", f"{folder}/payloads")
    plain = pages.toDF(*(f"c{i}" for i in range(len(pages.columns))))
    at = pages.columns.index
    payload = F.encode(F.coalesce(F.col(f"c{at(payload_column)}").cast("string"), F.lit("")), "UTF-8")
    records = plain.select(F.col(f"c{at(id_column)}").alias("page_id"), F.col(f"c{at(url_column)}").alias("url"),
                           payload.alias("payload"))

    (records.select(F.sha2("payload", 256).alias("address"), "payload").groupBy("address")
     .agg(F.first("payload").alias("payload"))
     .write.option("compression", "zstd").parquet(archive.payloads))

    described = landed(records.select(
        "page_id", "url", F.sha2("payload", 256).alias("address"), base32_sha1(F.col("payload")).alias("digest"),
        F.octet_length("payload").alias("bytes"), F.monotonically_increasing_id().alias("row")), "described")
    first = landed(described.filter(F.col("bytes") >= min_revisit_bytes).groupBy("address")
                   .agg(F.count("*").alias("records"),
                        F.min(F.struct(F.col("page_id").isNull(), "page_id", "row")).alias("first"))
                   .filter("records > 1").select("address", "first"), "first-records")
    revisit = F.col("first.row") != F.col("row")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}"),
                    _line("Content-Length", F.col("bytes")), F.lit(_CRLF))
    head = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _identifier(F.col("page_id"))), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(revisit, _identifier(F.col("first.page_id")))),
        _line("WARC-Profile", F.when(revisit, _PROFILE)),
        F.lit(f"Content-Type: application/http; msgtype=response{_CRLF}"),
        _line("Content-Length", F.octet_length("http") + F.when(revisit, 0).otherwise(F.col("bytes"))), F.lit(_CRLF))
    (described.join(small_or_shuffled(first, broadcast_rows), "address", "left").withColumn("http", http)
     .select("address", F.encode(head, "UTF-8").alias("warc_header"), F.encode("http", "UTF-8").alias("http_header"))
     .write.option("compression", "zstd").parquet(archive.headers))
    return archive


def _payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """Stored payloads; a payload that doesn't have the digest it is stored under ends the job."""
    return spark.read.parquet(archive.payloads).withColumn("payload", F.when(
        F.sha2("payload", 256) == F.col("address"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("address")))))


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Each record as it was written: warc_header, http_header, payload (of the full page, also for a revisit), record.

    `record` holds the bytes of the WARC file: a revisit's ends after its HTTP header.
    """
    whole = spark.read.parquet(archive.headers).join(_payloads(spark, archive), "address")
    revisit = F.decode("warc_header", "UTF-8").contains(f"{_CRLF}WARC-Type: revisit{_CRLF}")
    end = F.lit((_CRLF * 2).encode())
    return whole.select("warc_header", "http_header", "payload", F.concat(
        "warc_header", "http_header", F.when(revisit, F.lit(b"")).otherwise(F.col("payload")), end).alias("record"))


def read_index(spark: SparkSession, archive: Archive) -> DataFrame:
    """What the archive says of each record: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest are taken anew from each record as read_records puts it together (a revisit's from the payload it refers
    to) and must agree, as must the length of the record, with its headers: anything else ends the job.
    """
    head, http = F.octet_length("warc_header"), F.octet_length("http_header")
    whole = read_records(spark, archive).select(
        F.decode("warc_header", "UTF-8").alias("head"), F.decode("http_header", "UTF-8").alias("http"),
        (F.octet_length("record") - head - 4).alias("block_bytes"),
        F.when(F.octet_length("record") == head + http + 4, F.col("payload"))
        .otherwise(F.substr("record", head + http + 1, F.octet_length("record") - head - http - 4)).alias("body"))
    rows = whole.select("head", "http", "block_bytes", F.octet_length("body").cast("long").alias("payload_bytes"),
                        base32_sha1(F.col("body")).alias("payload_digest"))

    def value(name: str, pattern: str, lines: str = "head") -> Column:
        found = F.regexp_extract(lines, f"\r\n{name}: {pattern}\r\n", 1)
        return F.when(found != "", found)

    agrees = ((value("WARC-Payload-Digest", "sha1:([A-Z2-7]+)") == F.col("payload_digest"))
              & (value("Content-Length", "([0-9]+)").cast("long") == F.col("block_bytes"))
              & (value("Content-Length", "([0-9]+)", "http").cast("long") == F.col("payload_bytes")))
    return rows.select(
        value("WARC-Record-ID", "<urn:page:([^>]*)>").cast("long").alias("page_id"),
        value("WARC-Target-URI", "([^\r\n]*)").alias("url"), "payload_bytes",
        F.when(agrees, F.col("payload_digest")).otherwise(
            F.raise_error(F.concat(F.lit("record differs from its header: "), F.col("head")))).alias("payload_digest"),
        value("WARC-Type", "([a-z]+)").alias("record_type"),
        value("WARC-Refers-To", "<urn:page:([^>]*)>").cast("long").alias("refers_to"))
