"""Operator 7: web archives: write captures as records, read them back and assemble transactions."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import new_path, settle

RECORD = "file string, at long, type string, record_id string, concurrent_to string, refers_to string, target_uri string, content_type string, declared_digest string, declared_bytes long, payload_digest string, payload_bytes long, payload binary, fields map<string,string>"
BLANK = "\r\n\r\n"


def _id(kind: Column | str, page: Column, url: Column, digest: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    parts = F.md5(F.concat_ws("|", kind, F.coalesce(page.cast("string"), F.lit("-")), F.coalesce(url, F.lit("-")), digest))
    return F.concat(F.lit("<urn:md5:"), parts, F.lit(">"))


def first_captures(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Payloads of ``least_bytes`` or more that come twice or more: digest, the smallest page_id and its record."""
    slim = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    slim = slim.select("page_id", "url", F.sha2(F.encode("html", "UTF-8"), 256).alias("digest"), F.octet_length("html").alias("bytes")).where(F.col("bytes") >= least_bytes)
    page = F.struct("page_id", _id("response", F.col("page_id"), F.col("url"), F.col("digest")).alias("id"))
    found = slim.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("page_id").isNotNull(), page)).alias("first"))
    return settle(found.where("n > 1 and first is not null").select("digest", F.col("first.page_id").alias("first_page"), F.col("first.id").alias("first_id")), "first-captures")


def write_captures(pages: DataFrame, path: str, *, least_bytes: int = 100, file_bytes: int = 32 << 20, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a request, a response or revisit, and a metadata record per page as gzipped archives.

    Of pages with the same payload of ``least_bytes`` or more, the one with the smallest page_id is the response
    (all rows with that id, if it is repeated) and the others revisit it; smaller payloads are always responses.
    Null html is an empty payload; a null page_id revisits any page with an id. Record ids are digests of the row,
    so a task that runs twice writes the same records. Files hold a number of records that makes ``file_bytes``
    on average.
    """
    size = pages.agg(F.coalesce(F.avg(F.octet_length("html")), F.lit(0.0)).alias("mean")).first()["mean"]
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256)).withColumn("bytes", F.octet_length("html"))
    rows = rows.join(first_captures(pages, least_bytes), "digest", "left")
    revisit = F.col("first_page").isNotNull() & F.coalesce(F.col("page_id") != F.col("first_page"), F.lit(True))
    own = _id("response", F.col("page_id"), F.col("url"), F.col("digest"))
    # a header line can hold no line break
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))

    def record(kind: Column, record_id: Column, content_type: str, lines: list[Column], block: Column) -> Column:
        head = F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), uri,
            F.lit(f"\r\nContent-Type: {content_type}"), *lines, F.lit("\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(BLANK),
        )
        return F.concat(head, block)

    concurrent = F.concat(F.lit("\r\nWARC-Concurrent-To: "), own)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(BLANK))
    refers = F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), F.col("first_id"), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit(""))
    records = F.array(
        record(F.lit("request"), _id("request", F.col("page_id"), F.col("url"), F.col("digest")), "application/http; msgtype=request", [concurrent], F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{BLANK}"))),
        record(
            F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), own, "application/http; msgtype=response",
            [F.concat(F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest")), refers], F.when(revisit, http).otherwise(F.concat(http, "html")),
        ),
        record(F.lit("metadata"), _id("metadata", F.col("page_id"), F.col("url"), F.col("digest")), "application/warc-fields", [concurrent], F.concat(F.lit("pageId: "), page, F.lit("\r\n"))),
    )
    per_file = 3 * max(1, int(file_bytes / (size + 1024)))
    # each row of text is a record and the line separator is what ends a record
    writer = rows.select(F.explode(records).alias("value")).write.option("lineSep", BLANK).option("compression", "gzip").option("maxRecordsPerFile", per_file)
    writer.text(path)


def parse_headers(head: bytes) -> dict[str, str]:
    fields: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return fields


def records_of(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, header fields, block) of the records of an archive, gzipped in one or many members or plain.

    Blocks are taken by their Content-Length, so they may hold anything. A file that ends within a record, or
    holds something else, raises ValueError.
    """
    buffer, at, place, inflate, rest = bytearray(), 0, 0, None, memoryview(content)
    zipped = content[:2] == b"\x1f\x8b"

    def more() -> bool:
        nonlocal inflate, rest
        if not len(rest):
            return False
        if not zipped:
            buffer.extend(rest)
            rest = rest[len(rest) :]
            return True
        inflate = inflate or zlib.decompressobj(31)
        buffer.extend(inflate.decompress(rest[: 1 << 20]))
        unread = len(inflate.unused_data)
        step = min(len(rest), 1 << 20) - unread
        rest = rest[step:]
        if inflate.eof:
            inflate = None
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if bytes(buffer[at:]).strip():
                    raise ValueError("the archive ends within a record's header")
                return
        head = bytes(buffer[at:end])
        fields = parse_headers(head)
        if not head.startswith(b"WARC/") or not fields.get("content-length", "").isdigit():
            raise ValueError("not a record")
        stop = end + 4 + int(fields["content-length"])
        while len(buffer) < stop + 4:
            if not more():
                raise ValueError("the archive ends within a record")
        yield place, fields, bytes(buffer[end + 4 : stop])
        place += 1
        at = stop + 4
        if at > 1 << 22:
            del buffer[:at]
            at = 0


def read_records(spark: SparkSession, path: str, *, keep_payload: bool = False) -> DataFrame:
    """One row per record of all archives in a folder; see RECORD. Payloads are digested here and kept only on request."""
    names = [part.split()[0] for part in RECORD.replace("map<string,string>", "map").split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                rows, held = [], 0
                for at, fields, block in records_of(content):
                    kind, payload, inner = fields.get("warc-type", ""), block, {}
                    if fields.get("content-type", "").startswith("application/http"):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        inner = parse_headers(head)
                    if kind == "metadata":
                        inner = parse_headers(b"\r\n" + block)
                    declared = inner.get("content-length", "")
                    rows.append((
                        file, at, kind, fields.get("warc-record-id"), fields.get("warc-concurrent-to"), fields.get("warc-refers-to"), fields.get("warc-target-uri"),
                        fields.get("content-type"), fields.get("warc-payload-digest"), int(declared) if declared.isdigit() else -1,
                        hashlib.sha256(payload).hexdigest(), len(payload), payload if keep_payload else None, inner,
                    ))
                    held += len(payload) if keep_payload else 1000
                    if held > 1 << 24:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(read, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: response (or revisit), request and metadata joined through concurrent-to.

    Records meet on the id of their response by one map-side combined aggregation. A capture lacking a request or
    metadata has null there; requests and metadata whose response is missing give no capture. Records repeated
    with the same id (from repeated rows) are captures of their own. A revisit carries the digest and size that it
    declares, and the size is that of the payload it refers to.
    """
    is_capture = F.col("type").isin("response", "revisit")
    body = F.struct(
        "type", "record_id", "target_uri", "refers_to", "file", "at",
        F.when(F.col("type") == "revisit", F.regexp_replace("declared_digest", "^sha256:", "")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(F.col("type") == "revisit", F.col("declared_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"), "payload",
    )
    part = F.struct("record_id", "target_uri", F.to_json("fields").alias("fields"))
    keyed = records.where("type in ('response', 'revisit', 'request', 'metadata')").withColumn("capture_id", F.when(is_capture, F.col("record_id")).otherwise(F.col("concurrent_to")))
    grouped = keyed.groupBy("capture_id").agg(
        F.min(F.when(is_capture, body)).alias("capture"), F.count_if(is_capture).alias("copies"),
        F.min(F.when(F.col("type") == "request", part)).alias("request"), F.min(F.when(F.col("type") == "metadata", part)).alias("metadata"),
    )
    captures = grouped.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    fields = F.from_json("metadata.fields", "map<string,string>")
    return captures.select("capture_id", "capture", "request", F.struct("metadata.record_id", "metadata.target_uri", fields.alias("fields")).alias("metadata"))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages' archives to the shared folder, read them back and give one row per page.

    page_id, payload_bytes, payload_digest, record_type, refers_to (the page_id of the response) and the capture's uri.
    Other columns are ignored, whatever their names; repeated rows are captures of their own; no rows give no rows.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_captures(pages, path, **options)
    captures = assemble(read_records(spark, path))
    page = F.expr("try_cast(nullif(metadata.fields['pageid'], '') as long)")
    slim = settle(captures.select(
        page.alias("page_id"), F.col("capture.payload_bytes").alias("payload_bytes"), F.col("capture.payload_digest").alias("payload_digest"),
        F.col("capture.type").alias("record_type"), F.col("capture.refers_to").alias("_refers"), F.col("capture.target_uri").alias("uri"), F.col("capture.record_id").alias("_id"),
    ), "captures")
    # each response that is referred to, once, though many revisit it
    wanted = slim.where("_refers is not null").select(F.col("_refers").alias("_id")).distinct()
    target = settle(slim.where("record_type = 'response'").join(wanted, "_id").groupBy(F.col("_id").alias("_refers")).agg(F.min("page_id").alias("refers_to")), "referred")
    return slim.join(target, "_refers", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri")
