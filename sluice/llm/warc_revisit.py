"""Operator 4, WARC revisit resolution: deduplicated archives with fresh headers.

Headers alone (page_id, digest, length) are shuffled by payload digest; a payload's copies are revisits
of the one with the largest page_id.  The pages are then written as WARC 1.1 records: originals with
their payload, revisits with headers only.  A record ends with an empty line twice over, which is the
line separator of the text writer, so archives are written by Spark alone, to any file system, and a
task that is run again rewrites its own file.  ``read_archives`` streams them back by the text reader with
the same separator, so no archive is held whole, parses records by Content-Length and verifies each payload
against its digest; a payload that holds the separator arrives in several rows and is put together again.

Defined results.  Null html: empty payload.  Payloads below ``SMALLEST`` bytes are always responses.
Null page_id: never the original where another copy has an id; refers to it.  Copies whose ids are all
null stay responses.  Rows that share the largest page_id of a payload are all responses.  Line breaks in
a url are written as spaces; a null url has no header.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, if_small, materialise, new_folder

SMALLEST = 1000
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one archive file.
RECORDS = 5000


def resolve(pages: DataFrame, smallest: int = SMALLEST) -> tuple[DataFrame, int]:
    """(page_id, digest, refers_to of every revisit, how many there are)."""
    heads = pages.select("page_id", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("digest"), F.md5("payload").alias("second"))
    heads = materialise(heads.where(F.col("bytes") >= smallest), "warc-heads")
    copies = heads.groupBy("digest", "second", "bytes").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null")
    copies = materialise(copies, "warc-copies")
    hit = heads.join(if_small(copies, copies.count()), ["digest", "second", "bytes"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    hit = materialise(hit.select("page_id", "digest", "refers_to").distinct(), "warc-revisits")
    return hit, hit.count()


def _id(page: Column, digest: Column) -> Column:
    """A record id that depends on page and payload only, so reruns agree."""
    h = F.md5(F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(date: str) -> Column:
    """The whole record but for its last two line ends."""
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit("\r\n"),
        line("WARC-Record-ID", _id(F.col("page_id"), F.col("digest"))),
        F.lit(f"WARC-Date: {date}\r\n"),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(again, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\n"), line("WARC-Refers-To", _id(F.col("refers_to"), F.col("digest"))), line("X-Refers-To-Page", F.col("refers_to").cast("string")))).otherwise(""),
        line("X-Page", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(again, 0).otherwise(F.octet_length("payload"))).cast("string"), F.lit(END),
        http, F.when(again, "").otherwise(F.col("payload")),
    )


def write_archives(pages: DataFrame, path: str, smallest: int = SMALLEST, date: str = DATE, records: int = RECORDS) -> None:
    """Writes gzip-compressed archives of ``pages`` (page_id, url, html) to the new folder ``path``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    revisits, n = resolve(pages, smallest)
    revisits = revisits.withColumnsRenamed({"page_id": "of_page", "digest": "of_digest"})
    pages = pages.withColumn("digest", F.sha1("payload"))
    typed = pages.join(if_small(revisits, n), pages["page_id"].eqNullSafe(revisits["of_page"]) & (pages["digest"] == revisits["of_digest"]), "left")
    out = typed.select(_record(date).alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records)
    out.text(path)


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of uncompressed archives that arrive in pieces, one after the other."""
    held = b""
    done = False
    while not done or held:
        held = held.lstrip(b"\r\n")
        while (at := held.find(b"\r\n\r\n")) < 0 and not done:
            piece = next(chunks, None)
            done = piece is None
            held += piece or b""
        if at < 0:
            if held.strip():
                raise ValueError("an archive ends within a record's headers")
            return
        lines = held[:at].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        end = at + 4 + int(head["Content-Length"])
        parts, have = [held], len(held)
        while have < end + 4 and not done:
            piece = next(chunks, None)
            done = piece is None
            parts.append(piece or b"")
            have += len(piece or b"")
        held = b"".join(parts)
        if have < end:
            raise ValueError("an archive ends within a record")
        yield head, held[at + 4 : end]
        held = held[end + 4 :]


def _read(batches):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    end = END.encode()
    pieces = (memoryview(value.as_buffer()).tobytes() + end for b in batches for value in b.column("value"))
    records = parse(pieces)
    while some := list(islice(map(_fields, records), 4096)):
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=names)


def _fields(record: tuple[dict[str, str], bytes]) -> tuple:
    head, block = record
    cut = block.index(b"\r\n\r\n") + 4
    size = int(next(x.split(b": ", 1)[1] for x in block[:cut].split(b"\r\n") if x.lower().startswith(b"content-length")))
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "response" and (len(block) - cut != size or hashlib.sha1(memoryview(block)[cut:]).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} doesn't match its digest")
    page, to = head.get("X-Page"), head.get("X-Refers-To-Page")
    return int(page) if page else None, head.get("WARC-Target-URI"), size, digest, head["WARC-Type"], int(to) if to else None, head["WARC-Record-ID"]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, record_id of every record."""
    bounded_batches(spark)
    rows = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path)
    return rows.select(F.col("value").cast("binary").alias("value")).mapInArrow(_read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string")


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the archives of ``pages`` and reads them back."""
    spark = pages.sparkSession
    path = path or new_folder(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {SMALLEST} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {SMALLEST} AND page_id <> last THEN last END AS refers_to
FROM q
"""
