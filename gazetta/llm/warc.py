"""WARC archives of pages: write request, response or revisit, and metadata records; read them back as captures.

Every record is a gzip member of its own. The three records of a capture name each
other through WARC-Concurrent-To, and the reader joins them by it. Equal payloads
are stored once: of the records with one payload of at least ``LEAST`` bytes, that
with the largest page id is the response and the others revisit it.

Record ids are made from capture number and page id, so a task that runs again
writes the same records, and the page that a revisit refers to is read from the id
in WARC-Refers-To, without a join on a payload that a third of the pages may share.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazetta.llm.common import NO_ID, column, materialise, qualified, scratch_dir
from gazetta.llm.shared_files import read_files, write_file

LEAST, SUFFIX, FILE_BYTES = 1000, ".warc.gz", 8 << 20
#: Parts into which rows without an id are dealt.
SALTS = 64
KINDS = ("request", "response", "metadata")
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "kind string, record_id string, concurrent_to string, refers_to string, refers_page long, url string, date string, digest string, length long, page_id long, payload binary"


def record_id(page: int, copy: int, kind: str) -> str:
    """A version 8 UUID that holds the page id (64 bits), the copy number and the kind."""
    value = (page & (1 << 64) - 1) << 44 | (copy & (1 << 42) - 1) << 2 | KINDS.index(kind)
    high, mid, low = value >> 74, value >> 62 & 0xFFF, value & (1 << 62) - 1
    return f"<urn:uuid:{uuid.UUID(int=high << 80 | 8 << 76 | mid << 64 | 2 << 62 | low)}>"


def page_of(identifier: str) -> int | None:
    """The page that an id of ``record_id`` holds; null for ids of other archives."""
    try:
        number = uuid.UUID(identifier.strip("<>").removeprefix("urn:uuid:")).int
    except ValueError:
        return None
    if number >> 76 & 15 != 8 or number >> 62 & 3 != 2:
        return None
    value = (number >> 80) << 74 | (number >> 64 & 0xFFF) << 62 | number & (1 << 62) - 1
    page = value >> 44 & (1 << 64) - 1
    return page - (1 << 64) if page >> 63 else page


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _clean(url: str | None) -> str:
    """A URL in a header: no line breaks, which would end the header."""
    return re.sub(r"[\r\n]+", " ", url or "").strip()


def capture_records(page: int, copy: int, url: str | None, html: str | None, digest: str, original: int | None) -> bytes:
    """The three gzip members of a capture; ``original`` is the page it revisits."""
    payload, target = (html or "").encode(), _clean(url)
    ids = {k: record_id(page, copy, k) for k in KINDS}
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target)]
    response = [("WARC-Type", "response" if original is None else "revisit"), ("WARC-Record-ID", ids["response"]), *common, ("WARC-Payload-Digest", f"sha1:{digest}")]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if original is None:
        block += payload
    else:
        response += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(original, 0, "response")), ("WARC-Refers-To-Target-URI", target)]
    response.append(("Content-Type", "application/http;msgtype=response"))
    path = re.sub(r"^[a-zA-Z]+://[^/?#]*", "", target) or "/"
    request = [("WARC-Type", "request"), ("WARC-Record-ID", ids["request"]), *common, ("WARC-Concurrent-To", ids["response"]), ("Content-Type", "application/http;msgtype=request")]
    meta = [("WARC-Type", "metadata"), ("WARC-Record-ID", ids["metadata"]), *common, ("WARC-Concurrent-To", ids["response"]), ("Content-Type", "application/warc-fields")]
    fields = b"payloadLength: %d\r\n" % len(payload)
    return _member(request, f"GET {path} HTTP/1.1\r\n\r\n".encode()) + _member(response, block) + _member(meta, fields)


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, one at a time, in time linear in its length."""
    at, view = 0, memoryview(data)
    while at < len(data):
        reader, parts = zlib.decompressobj(31), []
        while not reader.eof and at < len(data):
            step = view[at : at + (1 << 13)]
            parts.append(reader.decompress(step))
            at += len(step) - len(reader.unused_data)
        if not reader.eof:
            raise ValueError("an archive ends within a record")
        yield b"".join(parts)


def parse_records(archive: bytes) -> Iterator[tuple]:
    """Rows of ``SCHEMA`` for the records of an archive; records of other types are passed over.

    Archives of other writers are read too: digests in base32 become hex, those of other algorithms stay as they are,
    what a record leaves out is null (its id: empty), and ids that hold no page give none. Headers that aren't UTF-8 are read with replacements, and a record
    without a length goes to the end of its member. A payload that
    contradicts its SHA-1 or the length that its HTTP head or metadata names is an error.
    """
    for data in members(archive):
        end = data.find(b"\r\n\r\n")
        lines = data[: max(0, end)].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = head.get("content-length", "")
        block = data[end + 4 : end + 4 + int(size)] if size.isdigit() else data[end + 4 :].removesuffix(b"\r\n\r\n")
        kind = head.get("warc-type")
        if kind not in ("request", "response", "revisit", "metadata"):
            continue
        digest, payload, length = None, None, None
        if kind in ("response", "revisit"):
            http, _, body = block.partition(b"\r\n\r\n")
            payload = body if kind == "response" else None
            digest = hex_digest(head.get("warc-payload-digest"))
            named = re.search(rb"(?im)^content-length: *(\d+)", http)
            encoded = re.search(rb"(?im)^(transfer|content)-encoding:", http)
            length = int(named[1]) if named else (len(body) if kind == "response" else None)
            if kind == "response" and not encoded and (length != len(body) or (digest and len(digest) == 40 and hashlib.sha1(body).hexdigest() != digest)):
                raise ValueError(f"the payload of {head.get('warc-record-id')} is damaged")
        elif kind == "metadata":
            named = re.search(rb"payloadLength: *(\d+)", block)
            length = int(named[1]) if named else None
        identifier, refers = head.get("warc-record-id", ""), head.get("warc-refers-to")
        yield kind, identifier, head.get("warc-concurrent-to"), refers, page_of(refers) if refers else None, head.get("warc-target-uri"), head.get("warc-date"), digest, length, page_of(identifier), payload


def hex_digest(named: str | None) -> str | None:
    """A labelled digest as bare hex, whether it is written in hex or in base32; other algorithms than SHA-1 keep their label."""
    if not named:
        return None
    label, _, value = named.rpartition(":")
    if label.lower() not in ("", "sha1"):
        return named
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        written = 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(capture_records(row["page"], row["copy"], row["url"], row["html"], row["digest"], row["original"]))
                size += len(held[-1])
                written += 1
                if size > FILE_BYTES:
                    write_file(folder, f"pages-{part:08d}-{number:05d}{SUFFIX}", b"".join(held))
                    number, held, size = number + 1, [], 0
        if held:
            write_file(folder, f"pages-{part:08d}-{number:05d}{SUFFIX}", b"".join(held))
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], ["written"])

    return run


def write_archives(pages: DataFrame, folder: str, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> int:
    """Write the captures of all rows as archives in ``folder``; returns their number.

    A null html or url is empty. Rows that share a page id are captures of their own,
    numbered by url and payload; where one of them has the largest id of its payload, all
    rows of that id and payload are responses. Rows without an id act as one page behind all others.
    """
    base = pages.select(F.coalesce(column(pages, page_col).cast("long"), F.lit(NO_ID)).alias("page"), column(pages, url_col).alias("url"), F.coalesce(column(pages, html_col), F.lit("")).alias("html"))
    base = base.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    # What a payload's rows revisit is settled on keys alone; pages meet it by their id, which also numbers
    # them, so that a payload is shuffled once.
    keys = base.where(F.octet_length("html") >= least).select("page", "digest")
    first = keys.groupBy("digest").agg(F.max("page").alias("last"), F.count(F.lit(1)).alias("k")).where("k > 1").select("digest", "last").hint("rebalance")
    revisits = keys.join(first, "digest").where("page != last").groupBy("page").agg(F.collect_set(F.struct("digest", "last")).alias("known"))
    original = F.filter("known", lambda x: x["digest"] == F.col("digest"))
    # Rows without an id never revisit (theirs is the largest); they are dealt by a salt, which is 0 for all others.
    base = base.withColumn("salt", F.when(F.col("page") == NO_ID, F.pmod(F.xxhash64("digest", "url"), F.lit(SALTS)).cast("int")).otherwise(0))
    named = base.join(revisits.withColumn("salt", F.lit(0)), ["page", "salt"], "left").withColumn("original", F.when(F.size(original) > 0, original[0]["last"])).drop("known")
    # Only ids that several rows share need a number, which tells their records apart.
    nth = F.row_number().over(Window.partitionBy("page", "salt").orderBy(F.col("original").isNotNull(), "url", "digest")) - 1
    copy = F.when(F.col("page") == NO_ID, nth * SALTS + F.col("salt")).otherwise(nth)
    ready = named.withColumn("copy", copy).select("page", "copy", "url", "html", "digest", "original")
    return materialise(ready.mapInArrow(_write(qualified(pages.sparkSession, folder)), "written long")).agg(F.sum("written")).first()[0] or 0


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 3 + [pa.int64(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            for content in batch.column("content"):
                rows = list(parse_records(content.as_buffer().to_pybytes()))
                for i in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 256], strict=True), kinds, strict=True)], names)

    return read_files(spark, folder, SUFFIX).mapInArrow(run, SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``page_id``, ``url``, ``date`` and the structs ``response``, ``request``, ``metadata``.

    A capture without request or metadata keeps a null there; a request or metadata
    record whose response is absent has no row.
    """
    def part(kind: str, *names: str) -> DataFrame:
        return records.where(F.col("kind") == kind).select(F.col("concurrent_to").alias("id"), F.struct("record_id", *names).alias(kind))

    responses = records.where(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").alias("id"), "page_id", "url", "date", F.struct("record_id", "kind", "digest", F.col("length").alias("header_length"), "refers_to", "refers_page", "payload").alias("response")
    )
    joined = responses.join(part("request", "url"), "id", "left").join(part("metadata", "length"), "id", "left")
    return joined.drop("id")


def archive_round_trip(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages as archives in the shared folder and describe each capture read back.

    Returns per row: page id, ``payload_bytes``, ``payload_digest`` (hex SHA-1), ``record_type``
    and ``refers_to`` (page id of the response that a revisit names). An empty table gives an empty result.
    """
    spark, folder = pages.sparkSession, scratch_dir(pages.sparkSession)
    if not write_archives(pages, folder, page_col, url_col, html_col):
        return spark.createDataFrame([], f"{page_col} long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    # The payloads stay behind: what is joined and returned here are facts about them, written once, so that the archives are read once.
    facts = materialise(read_records(spark, folder).drop("payload"))
    captures = assemble(facts.withColumn("payload", F.lit(None).cast("binary")))
    return captures.select(
        F.nullif("page_id", F.lit(NO_ID)).alias(page_col),
        F.col("response.header_length").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.nullif("response.refers_page", F.lit(NO_ID)).alias("refers_to"),
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
FROM p LEFT JOIN f ON f.d = p.d
"""
