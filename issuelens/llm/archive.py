"""A content-addressed WARC archive of pages.

The payload of a page is its html in UTF-8. The archive below one folder has two tables:

* `payloads`: each distinct payload once, under its SHA-256, with the capture that holds it as a `response`;
* `records`: one row per page with the exact WARC header and HTTP header and the SHA-256 of the payload.

A record with a payload that an earlier capture (smaller page_id) already holds is a `revisit` without a body.
Records and captures are put together again by a join on the digest. Copies of one payload meet only as one row per
map task, since the payload table is an aggregation; the joins move headers and digests, and the bytes only where
whole records are asked for. A hot digest is split by the engine's skew join.

The digest is verified twice: when payloads are stored, all copies under one SHA-256 must also agree in SHA-1 and
length; when they are read, both digests are computed from the stored bytes and compared with the key and with what
the headers state. A difference raises an error.

Edge cases: a null or empty html is an empty payload. A null url gives a header without WARC-Target-URI; line breaks
and other control characters of a url are percent-encoded. A null page_id comes after all others and is never
preferred as a response. Rows that share a page_id are told apart by url and payload; rows equal in all three are one
capture written as often as it occurs, so all of them are responses or all revisits. Payloads of any length go
through whole. Extra columns are not looked at, whatever their names. An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# RFC 4648, fixed value.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LINE = "\r\n"
# Names and values of the WARC 1.1 format, fixed values.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The tables have no time of capture.
CAPTURED = "2024-01-01T00:00:00Z"


def base32(digest: Column) -> Column:
    """The base32 text of a hex digest of 160 bits: eight groups of five hex digits, four characters each."""
    letters = []
    for group in range(8):
        bits = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*letters)


def checked(value: Column, condition: Column, fault: str) -> Column:
    """`value` where the condition holds; anything else ends the job."""
    return F.when(condition, value).otherwise(F.raise_error(F.lit(fault)))


def payloads_of(pages: DataFrame) -> DataFrame:
    """page_id, url and payload of each page with its digests."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    return rows.select("*", F.sha2("payload", 256).alias("digest"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))


def distinct_payloads(captures: DataFrame) -> DataFrame:
    """One row per digest: payload, sha1, n_bytes, copies and the first capture (nobody, page_id, url)."""
    first = F.struct(F.col("page_id").isNull().alias("nobody"), "page_id", "url")
    found = captures.groupBy("digest").agg(
        F.min(first).alias("first"),
        F.any_value("payload").alias("payload"),
        F.min(F.struct("sha1", "n_bytes")).alias("least"),
        F.max(F.struct("sha1", "n_bytes")).alias("most"),
        F.count(F.lit(1)).alias("copies"),
    )
    same = F.col("least") == F.col("most")
    return found.select(
        "digest", "payload", checked(F.col("least.sha1"), same, "different payloads under one digest").alias("sha1"),
        F.col("least.n_bytes").alias("n_bytes"), "copies", "first",
    )


def record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """A name of the capture that holds its page_id."""
    own = F.substring(F.sha2(F.concat_ws("|", digest, F.coalesce(url, F.lit("-"))), 256), 1, 16)
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), own, F.lit(">"))


def printable(url: Column) -> Column:
    """A url without control characters: each becomes its percent code."""
    plain = url
    for code in (*range(32), 127):
        plain = F.replace(plain, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x1F\x7F]"), plain).otherwise(url)


def headers(records: DataFrame) -> DataFrame:
    """The WARC header and the HTTP header of each record, to the byte."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=UTF-8{LINE}Content-Length: "),
        F.col("n_bytes").cast("string"), F.lit(LINE + LINE),
    )
    body = F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("n_bytes"))
    first = F.col("first")
    of_first = record_id(first["page_id"], first["url"], F.col("digest"))
    fields = F.concat_ws(
        LINE,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("page_id"), F.col("url"), F.col("digest"))),
        F.lit(f"WARC-Date: {CAPTURED}"),
        F.concat(F.lit("WARC-Target-URI: "), printable(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha1"))),
        F.when(F.col("revisit"), F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "), of_first)),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.length("http") + body).cast("string")),
        F.lit(LINE),
    )
    return records.withColumn("http", http).withColumn("header", fields)


def write_archive(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Writes `payloads` and `records` below `folder`. Payloads under `least_bytes` are responses in every record."""
    captures = payloads_of(pages)
    spark = pages.sparkSession
    distinct_payloads(captures).write.option("compression", "zstd").parquet(f"{folder}/payloads")
    firsts = spark.read.parquet(f"{folder}/payloads").select("digest", "first")
    records = captures.drop("payload").join(firsts, "digest")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    records = records.withColumn("revisit", ~is_first & (F.col("n_bytes") >= least_bytes))
    headers(records).select("digest", "header", "http").write.option("compression", "zstd").parquet(f"{folder}/records")


def stored_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """digest, payload, n_bytes and payload_digest, computed from the stored bytes and compared with the key."""
    rows = spark.read.parquet(f"{folder}/payloads").select("digest", "payload")
    intact = F.col("digest") == F.sha2("payload", 256)
    rows = rows.select(checked(F.col("digest"), intact, "a stored payload has changed").alias("digest"), "payload", F.sha1("payload").alias("sha1"))
    return rows.select("digest", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.col("sha1")).alias("payload_digest"))


def field(name: str) -> Column:
    """The value of a field of the header; null if it has none."""
    value = F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def page_of(identifier: Column) -> Column:
    return F.regexp_extract(identifier, r"^<urn:page:(-?\d+):", 1).try_cast("long")


def read_archive(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """One row per record, read from the headers and the stored payloads: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to; with `payload` also the original payload, for revisits that of the response."""
    rows = spark.read.parquet(f"{folder}/records")
    stored = stored_payloads(spark, folder)
    rows = rows.join(stored if payload else stored.drop("payload"), "digest")
    stated = field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    return rows.select(
        page_of(field("WARC-Record-ID")).alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        "payload_bytes",
        checked(F.col("payload_digest"), stated, "a header states another payload").alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        page_of(field("WARC-Refers-To")).alias("refers_to"),
        *(["payload"] if payload else []),
    )


def warc_records(spark: SparkSession, folder: str) -> DataFrame:
    """digest and the bytes of each record as they stand in a WARC file; several of them joined are such a file."""
    rows = spark.read.parquet(f"{folder}/records").join(stored_payloads(spark, folder), "digest")
    body = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    whole = F.concat(F.encode("header", "UTF-8"), F.encode("http", "UTF-8"), body, F.lit((LINE + LINE).encode()))
    return rows.select("digest", whole.alias("record"))
