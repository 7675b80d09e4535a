"""Web archives: writing WARC files and assembling their records into captures.

A capture is a response or a revisit with the request and metadata records that were made along with it.
Those name it in WARC-Concurrent-To, so captures are assembled by joins on record ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit
from uuid import UUID

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadbook.llm.frames import blocks

#: First line of a record, which divides the files; end of a record.
VERSION, END = "WARC/1.1\r\n", "\r\n\r\n"
#: Payloads from this size on are stored once; pages with an equal payload revisit it.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload(column: Column) -> Column:
    """A page's payload; null counts as empty."""
    return F.coalesce(column, F.lit(""))


def with_kind(pages: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """Pages with payload and digest, and for revisits the id and URL of the page that is stored.

    Of pages with equal payloads of at least ``REVISIT_BYTES`` the one with the largest id is stored (null
    ids come first, then the largest URL); exact repeats of that row are stored as well.
    """
    text = payload(F.col(f"`{html_column}`").cast("string"))
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"), text.alias("body"),
        F.sha1(text.cast("binary")).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
    )
    key = F.struct(F.col("page_id").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"))
    large = rows.where(F.col("n_bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.max(key).alias("stored"), F.count(F.lit(1)).alias("n"))
    shared = large.where("n > 1").select("digest", "stored")
    own = rows.join(shared, "digest", "left")
    return own.select(
        "page_id", "url", "body", "digest", "n_bytes",
        F.when(F.col("stored").isNotNull() & ~F.col("stored").eqNullSafe(key), F.col("stored")).alias("stored"),
    )


def record_id(kind: str, page_id: int | None, url: str | None, digest: str) -> str:
    """The same id for the same record, however often a task runs."""
    name = "\n".join([kind, "" if page_id is None else str(page_id), url or "", digest])
    return f"<{UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=5).urn}>"


def _record(kind: str, name: str, date: str, fields: list[tuple[str, str | None]], block: str) -> str:
    """A record without its end, which the writer puts between records."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), *fields, ("Content-Length", str(len(block.encode())))]
    return VERSION + "\r\n".join(f"{k}: {v}" for k, v in head if v is not None) + END + block


def _records(page_id: int | None, url: str | None, body: str, digest: str, n_bytes: int, stored: dict | None, date: str) -> list[str]:
    """Request, response or revisit, and metadata of a page."""
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else None
    name = record_id("capture", page_id, url, digest)
    parts = urlsplit(target or "") if "[" not in (target or "") else None
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "") if parts else target
    ask = f"GET {path} HTTP/1.1\r\nHost: {parts.netloc if parts else ''}\r\n\r\n"
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n"
    proof = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    with_target = [("WARC-Target-URI", target)]
    kept = [*with_target, ("WARC-Payload-Digest", proof), ("Content-Type", "application/http;msgtype=response")]
    if stored is None:
        main = _record("response", name, date, kept, answer + body)
    else:
        first = record_id("capture", stored["page_id"], stored["url"] or None, digest)
        main = _record("revisit", name, date, [*kept, ("WARC-Profile", PROFILE), ("WARC-Refers-To", first)], answer)
    beside = [*with_target, ("WARC-Concurrent-To", name)]
    known = f"page_id: {'' if page_id is None else page_id}\r\n"
    return [
        _record("request", record_id("request", page_id, url, digest), date, [*beside, ("Content-Type", "application/http;msgtype=request")], ask),
        main,
        _record("metadata", record_id("metadata", page_id, url, digest), date, [*beside, ("Content-Type", "application/warc-fields")], known),
    ]


def write_archives(
    pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", date: str = DATE
) -> None:
    """Write gzip-compressed WARC files, one per task, with three records for each page.

    Records go through Spark's text writer, so files appear only once their task has ended well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in blocks(batch.column(2)):
                rows = batch.slice(begin, end - begin).to_pylist()
                out = [r for row in rows for r in _records(**row, date=date)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    records = with_kind(pages, id_column, url_column, html_column).mapInArrow(run, "value string")
    records.write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD = T.StructType([
    T.StructField("record_type", T.StringType()), T.StructField("record_id", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("concurrent_to", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType())), T.StructField("payload", T.BinaryType()),
])


def _headers(lines: bytes) -> dict[str, str]:
    """Header fields by name in lower case; a line that begins with white space continues the one before."""
    found: dict[str, str] = {}
    last = None
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            found[last] = value.strip()
    return found


def _digest(value: str | None) -> str | None:
    """A payload digest as bare lower-case hex; SHA-1 comes in base 32."""
    if not value:
        return None
    kind, _, text = value.rpartition(":")
    if kind.lower() in ("sha1", "") and len(text) == 32:
        return base64.b32decode(text.upper()).hex()
    return text.lower()


def _parse(record: bytes, with_payload: bool) -> tuple:
    """A row of ``RECORD`` from what follows a record's first line."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = _headers(head)
    kind, size = fields.get("warc-type", "").lower(), int(fields.get("content-length", 0))
    block, length, body, inner = block[:size], None, None, {}
    if kind in ("response", "revisit", "request") and fields.get("content-type", "").startswith("application/http"):
        top, _, body = block.partition(b"\r\n\r\n")
        inner = _headers(top.partition(b"\r\n")[2])
        length = len(body)
        if kind == "revisit":  # the payload is stored elsewhere; its size stands in the repeated header
            length, body = int(inner["content-length"]) if inner.get("content-length", "").isdigit() else None, None
    elif kind == "metadata" or fields.get("content-type", "").startswith("application/warc-fields"):
        inner = _headers(block)
    elif kind == "resource":
        length, body = len(block), block
    digest = _digest(fields.get("warc-payload-digest"))
    if digest is None and kind == "response" and body is not None:
        digest = hashlib.sha1(body).hexdigest()
    return (
        kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("warc-concurrent-to"),
        fields.get("warc-refers-to"), digest, length, list(inner.items()), body if with_payload else None,
    )


def _whole(parts: Iterator[tuple[str, bytes]]) -> Iterator[bytes]:
    """Records of files cut at :data:`VERSION`. A record whose block holds that line is put together again."""
    file, held, need = None, None, 0
    mark = VERSION.encode()
    for name, part in parts:
        if name != file:
            if held is not None:
                yield held
            file, held = name, None
            if not part:
                continue  # what stands before the first record
        if held is not None and len(held) < need:
            held += mark + part
        else:
            if held is not None:
                yield held
            held = part
            head = part.find(b"\r\n\r\n")
            size = _headers(part[: max(head, 0)]).get("content-length", "0")
            need = head + 4 + int(size) if size.isdigit() else 0
    if held is not None:
        yield held


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the gzip-compressed WARC files under ``path``, one row of ``RECORD`` each.

    A compressed file is read as a stream by one task. Payloads stay bytes; without ``with_payload`` only
    their sizes and digests are kept. Empty folders give no rows.
    """
    parts = spark.read.option("lineSep", VERSION).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, rows, size = to_arrow_schema(RECORD), [], 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        pairs = (
            (file, value) for batch in batches
            for file, value in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
        )
        for record in _whole(pairs):
            row = _parse(record, with_payload)
            rows.append(row)
            size += len(row[-1] or b"") + 500
            if size > 1 << 22:
                yield flush()
                rows, size = [], 0
        yield flush()

    return parts.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: the response or revisit, with its request and metadata records nested in it.

    Request and metadata records belong to the capture that they are concurrent to, or that is concurrent to
    them. Of several the one with the least id is nested, ``n_requests`` and ``n_metadata`` count them. A
    capture without them has null there; records concurrent to no capture belong to none. Records stored
    repeatedly under one id are one, ``copies`` counts them. Null ids belong to nothing and are left out.
    """
    named = records.where("record_id is not null")
    main = named.where("record_type in ('response', 'revisit')")
    body = F.struct(*[F.col(c) for c in RECORD.names if c != "fields"], F.map_entries("fields").alias("fields"))
    captures = main.groupBy("record_id").agg(F.min(body).alias("capture"), F.count(F.lit(1)).alias("copies"))
    captures = captures.withColumn("answers", F.coalesce("capture.concurrent_to", F.col("record_id")))

    def beside(kind: str) -> DataFrame:
        own = named.where(F.col("record_type") == kind)
        part = F.struct("record_id", "date", F.map_entries("fields").alias("fields"), "payload")
        once = own.groupBy("record_id", "concurrent_to").agg(F.min(part).alias("part"))
        # without a name of its capture a record can only be named by it
        return once.groupBy(F.coalesce("concurrent_to", "record_id").alias("of")).agg(
            F.min("part").alias(kind), F.count(F.lit(1)).alias(f"n_{kind}")
        )

    out = captures
    for kind in ("request", "metadata"):
        near = beside(kind)
        named_it = near.select(F.col("of").alias("record_id"), F.col(kind).alias("a"), F.col(f"n_{kind}").alias("na"))
        named_by = near.select(F.col("of").alias("answers"), F.col(kind).alias("b"), F.col(f"n_{kind}").alias("nb"))
        out = out.join(named_it, "record_id", "left").join(named_by, "answers", "left").select(
            *out.columns, F.coalesce("a", "b").alias(kind), F.coalesce("na", "nb", F.lit(0)).alias(f"n_{kind}")
        )
    return out.select(
        "record_id",
        *[F.col(f"capture.{c}").alias(c) for c in RECORD.names if c not in ("record_id", "fields")],
        F.map_from_entries("capture.fields").alias("fields"),
        *[
            F.when(F.col(kind).isNotNull(), F.col(kind).withField("fields", F.map_from_entries(f"{kind}.fields"))).alias(kind)
            for kind in ("request", "metadata")
        ],
        F.col("n_request").alias("n_requests"), "n_metadata", "copies",
    )
