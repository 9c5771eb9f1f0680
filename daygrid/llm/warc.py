"""WARC archives: revisit records by payload digest, written and read by Spark."""

from __future__ import annotations

import gzip
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Letters of base32 (fixed values of RFC 4648).
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"
#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 0
#: The most records of an archive file; a reader holds one file at a time.
FILE_RECORDS = 2_000
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column."""

    def letters(bits: Column) -> Column:  # 20 bits are 4 letters
        places = [F.shiftright(bits, shift).bitwiseAND(31) + 1 for shift in (15, 10, 5, 0)]
        return F.concat(*[F.lit(_BASE32).substr(at, F.lit(1)) for at in places])

    # Lambda variables hold the hash and its groups of 5 hex digits, each computed once.
    groups = F.transform(
        F.array(F.sha1(payload)),
        lambda hexed: F.transform(
            F.sequence(F.lit(0), F.lit(7)),
            lambda g: F.conv(hexed.substr(5 * g + 1, F.lit(5)), 16, 10).cast("int"),
        ),
    )[0]
    return F.array_join(F.transform(groups, letters), "")


def _field(name: str, value: Column) -> Column:
    """A header line; none for a null value. Control characters would break the header."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1f\x7f]", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _record_id(page_id: Column, digest: Column, copy: Column) -> Column:
    mixed = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest, copy.cast("string")))
    parts = [F.substring(mixed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def dedup_records(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """One row for each row of ``pages``, with the payload where it is written in full.

    Headers are combined by (digest, page, url) before the shuffle by digest, so a payload that
    a third of all pages share moves once for each task. Of equal payloads the one with the
    largest page_id (then url) is the response, of equal rows the first copy.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        payload_digest(payload).alias("digest"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )
    heads = rows.groupBy("digest", "page_id", "url").agg(
        F.count("*").alias("copies"), F.first("bytes").alias("bytes")
    )
    top = F.max(F.struct(F.coalesce("page_id", F.lit(-(2**63))).alias("p"), F.coalesce("url", F.lit("")).alias("u")))
    originals = rows.groupBy("digest").agg(
        top.alias("top"), F.first("html").alias("payload"), F.first("bytes").alias("bytes")
    )
    # Without a least size no revisit needs its payload, and payloads move once only.
    small = F.when(F.col("bytes") < LEAST_BYTES, F.col("payload")) if LEAST_BYTES else F.lit(None)
    same = F.coalesce("page_id", F.lit(-(2**63))).eqNullSafe(F.col("top.p")) & F.coalesce(
        "url", F.lit("")
    ).eqNullSafe(F.col("top.u"))
    ids = originals.select("digest", "top", small.cast("string").alias("small_payload"))
    repeated = (
        heads.join(ids, "digest")
        .select(
            "digest", "page_id", "url", "bytes", "small_payload", same.alias("is_top"),
            F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        )
        .where(~((F.col("copy") == 1) & F.col("is_top")))
        .select("digest", "page_id", "url", "bytes", "copy", F.col("small_payload").alias("payload"))
    )
    first = originals.select(
        "digest",
        F.when(F.col("top.p") != -(2**63), F.col("top.p")).alias("page_id"),
        F.col("top.u").alias("url"),
        "bytes",
        F.lit(1).alias("copy"),
        "payload",
    )
    return first.unionByName(repeated)


def record_text(date: Column) -> Column:
    """A record without the two line ends after its block."""
    digest, page_id = F.col("digest"), F.col("page_id")
    response = F.col("payload").isNotNull()
    http = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit(_END))
    block = F.concat(http, F.coalesce("payload", F.lit("")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        F.when(response, F.lit("WARC-Type: response\r\n")).otherwise(F.lit("WARC-Type: revisit\r\n")),
        _field("WARC-Record-ID", _record_id(page_id, digest, F.col("copy"))),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(response, F.lit("")).otherwise(F.lit(f"WARC-Profile: {_PROFILE}\r\n")),
        _field("X-Page-Id", page_id),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _field("Content-Length", F.octet_length(block.cast("binary"))),
        F.lit("\r\n"),
    )
    return F.concat(head, block)


def write_archives(records: DataFrame, path: str, date: str | None = None) -> None:
    """Writes records as gzipped WARC 1.1 files by Spark's text writer; two line ends part records.

    ``date`` is every record's WARC-Date, by default the time of the call.
    """
    stamp = F.lit(date) if date else F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = records.select(record_text(stamp).alias("value"))
    writer = lines.write.option("lineSep", _END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _parse(content: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        length = int(head["Content-Length"])
        block = content[end + 4 : end + 4 + length]
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        at = end + 4 + length + 4
        yield head, payload


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Headers of all records below ``path``, with lengths and digests of their payloads, and
    the payloads themselves unless they aren't wanted.

    Files hold bounded numbers of records and are read whole, one at a time, each where Spark
    places it. Lengths and digests are computed from the bytes read; a revisit has no length,
    and the digest that its header gives.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows: list[tuple] = []
                for head, payload in _parse(gzip.decompress(content)):
                    page = head.get("X-Page-Id")
                    kind = head["WARC-Type"]
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), None
                    if kind == "response":
                        digest, size = b32encode(sha1(payload).digest()).decode(), len(payload)
                    rows.append(
                        (
                            int(page) if page else None, kind, head["WARC-Record-ID"],
                            head.get("WARC-Target-URI"), digest, size,
                            payload if kind == "response" and payloads else None,
                        )
                    )
                    if len(rows) == 512:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(
        run,
        "page_id long, record_type string, record_id string, url string, payload_digest string, "
        "payload_bytes long, payload binary",
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = "page_id record_type record_id url payload_digest payload_bytes payload".split()
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"page_id": "Int64", "payload_bytes": "Int64"})


def resolve_revisits(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to for every record read.

    Revisits take their length, and the page they refer to, from the response with their digest.
    """
    own = records.select("page_id", "record_type", "payload_digest", "payload_bytes")
    responses = own.where("record_type = 'response'")
    originals = responses.groupBy("payload_digest").agg(
        F.max("page_id").alias("refers_to"), F.first("payload_bytes").alias("payload_bytes")
    )
    revisits = own.where("record_type = 'revisit'").drop("payload_bytes").join(originals, "payload_digest", "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(names).unionByName(
        revisits.select(names)
    )
