"""WARC archives with revisit records for repeated payloads.

Headers (digest, length and record id, never the payload) are shuffled by
payload digest; the record with the largest id of each digest is written as a
response, the others as revisits that refer to it, with fresh headers. Reading
resolves a revisit by joining it with the response it refers to.

Archives are text files whose line separator is the blank-line pair that ends a
WARC record, so Spark's own writer commits them; a record is parsed by its
Content-Length, whatever bytes its payload holds.

Defined results: a null payload is an empty one; null ids rank below all others;
rows that share both payload and the largest id are all responses; payloads
under ``least_bytes`` are always responses; an empty table gives an archive
without records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.lookup import lookup_join

from .tables import kept

END = "\r\n\r\n"
FILE_BYTES = 16 << 20
RECORD = "urn:page:"


def base32(digest: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hexadecimal: 40 digits give 32 characters of 5 bits."""
    pieces = []
    for i in range(0, 40, 10):  # 40 bits at a time fit a long
        word = F.conv(F.substring(digest, i + 1, 10), 16, 10).cast("long")
        for shift in range(35, -5, -5):
            place = F.shiftright(word, shift).bitwiseAND(F.lit(31).cast("long")).cast("int") + 1
            pieces.append(F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), place, F.lit(1)))
    return F.concat(*pieces)


def resolved(pages: DataFrame, page_id: str = "page_id", payload: str = "html", url: str = "url",
             least_bytes: int = 0) -> DataFrame:
    """Record fields of every row: ``page_id, url, payload, payload_bytes, payload_digest, refers_to``.

    ``refers_to`` is null for responses. One header row per digest and task is
    shuffled. Only digests that repeat are joined back to the payloads: by
    broadcast after a size check, so that payloads stay where they are, else by
    a shuffled join that adaptive execution splits at very frequent digests.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"),
                        F.octet_length(body).cast("long").alias("payload_bytes"),
                        base32(F.sha1(F.encode(body, "UTF-8"))).alias("payload_digest"))
    first = rows.select("payload_digest", "page_id").groupBy("payload_digest").agg(
        F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeat = (F.col("payload_bytes") >= least_bytes) & F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(
        F.col("original"))
    return lookup_join(rows, first, ["payload_digest"]).select(
        *rows.columns, F.when(repeat, F.col("original")).alias("refers_to"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n"))


def record_text(records: DataFrame, date: str) -> DataFrame:
    """One WARC/1.1 record per row, without the blank lines that end it."""
    shown = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    address = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", " ")
    repeat = F.col("refers_to").isNotNull()
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    block = F.when(repeat, http).otherwise(F.concat(http, F.col("payload")))
    text = F.concat(
        F.lit("WARC/1.1\r\n"), F.when(repeat, "WARC-Type: revisit\r\n").otherwise("WARC-Type: response\r\n"),
        _header("WARC-Record-ID", F.concat(F.lit("<" + RECORD), shown, F.lit(">"))), _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", address), _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(repeat, F.concat(
            _header("WARC-Refers-To", F.concat(F.lit("<" + RECORD), F.col("refers_to").cast("string"), F.lit(">"))),
            _header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\n"), _header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"), block)
    return records.select(text.alias("value"))


def write_archives(records: DataFrame, path: str, mean_bytes: float, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write archives of about 16 MB where the records lie, given the mean size of a payload."""
    max_records = max(1, min(20_000, int(FILE_BYTES / (mean_bytes + 600))))
    (record_text(records, date).write.option("lineSep", END).option("maxRecordsPerFile", max_records)
     .option("compression", "none").text(path))


def _parsed(files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in files:
        for content in batch["content"]:
            rows = []
            at, content = 0, bytes(content)
            while at < len(content):
                end = content.index(END.encode(), at)
                fields = dict(line.split(": ", 1) for line in content[at:end].decode().split("\r\n")[1:])
                start = end + len(END)
                at = start + int(fields["Content-Length"])
                payload = content[content.index(END.encode(), start) + len(END):at]
                at += len(END)
                response = fields["WARC-Type"] == "response"
                rows.append((
                    fields["WARC-Record-ID"][len(RECORD) + 1:-1], fields["WARC-Target-URI"], fields["WARC-Type"],
                    fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                    fields["WARC-Refers-To"][len(RECORD) + 1:-1] if not response else None,
                    payload.decode() if response else None, len(payload) if response else None,
                    base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else None))
            out = pd.DataFrame(rows, columns=["record_id", "url", "record_type", "stated_digest", "refers_to", "payload",
                                              "own_bytes", "own_digest"])
            yield out.astype({"own_bytes": "Int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records as written; ``own_bytes`` and ``own_digest`` are measured on the payloads of responses."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_parsed, "record_id string, url string, record_type string, stated_digest string, "
                                      "refers_to string, payload string, own_bytes long, own_digest string")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every record with length and digest of its full payload, revisits by their response's.

    Archives are parsed once: headers are written, and only they are shuffled. A response that several equal rows wrote
    counts once.
    """
    records = kept(records.drop("payload"), "headers")
    found = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("original"), F.col(
        "own_digest").alias("stated_digest")).agg(F.first("own_bytes").alias("found_bytes"))
    key = F.when(F.col("record_type") == "revisit", F.col("refers_to")).otherwise(F.col("record_id"))
    heads = records.withColumn("original", key)
    joined = heads.join(found, ["original", "stated_digest"], "left")
    return joined.select("record_id", "url", "record_type", "refers_to",
                         F.col("found_bytes").alias("payload_bytes"),
                         F.when(F.col("found_bytes").isNotNull(), F.col("stated_digest")).alias("payload_digest"))
