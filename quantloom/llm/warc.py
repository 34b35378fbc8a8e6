"""WARC archives: write captures, read records back, assemble transactions.

Every capture gives three records: the request, the response (or a revisit, where an equal payload is
archived already) and metadata. Request and metadata name the response in WARC-Concurrent-To; reading
back joins the three on those identifiers and emits one nested row per capture.

Every record is a gzip member of its own. Tasks join members to archives of at most `archive_bytes`,
and Spark's text writer, one value a file, puts them on any store that it can reach, with the commit
protocol that survives lost executors. Reading inflates and parses by Content-Length, a record at a time.

Among captures with equal payloads of at least `least_bytes` the smallest page id is the response;
others revisit it. The smallest id per digest is a partial aggregate, and the joins are plain equi-joins
that adaptive execution splits when one digest holds many rows.

Cases: null html is the empty payload; null url is the empty target. A null page id is kept as null: its
capture is a response unless an equal payload has an id. Rows that repeat an id are captures of their
own; rows that share payload and smallest id are all responses. Very long payloads are one record each.
Other columns are not read. An empty table gives an empty archive and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, in_batches, record_batch, scratch

END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of SHA-1: 160 bits are four runs of 40 bits, each eight digits."""
    digest = F.sha1(payload)
    digits = F.concat(*(F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)))
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def header(kind: str, record_id: Column, length: Column, *fields: tuple[str, Column]) -> Column:
    """Fields whose value is null are left out."""
    all_fields = [("WARC-Type", F.lit(kind)), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(DATE)), *fields, ("Content-Length", length.cast("string"))]
    return F.concat(F.lit("WARC/1.1\r\n"), F.array_join(F.array_compact(F.array(*(F.concat(F.lit(f"{name}: "), value) for name, value in all_fields))), "\r\n"), F.lit(END))


@dataclass
class Archives:
    """Records as gzip members, joined to archives of about `archive_bytes` compressed bytes; a longer one is alone."""

    archive_bytes: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bytearray()
        out = lambda: record_batch(["archive"], [pa.binary()], [[bytes(held)]])
        for b in batches:
            for record in b.column(0):
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = pack.compress(record.as_buffer()) + pack.compress(b"\r\n\r\n") + pack.flush()
                if held and len(held) + len(member) > self.archive_bytes:
                    yield out()
                    held.clear()
                held += member
        if held:
            yield out()


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = 32 << 20) -> None:
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    size = F.octet_length(payload)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\r\n]", "%0A").alias("url"), payload.alias("payload")).withColumn("digest", base32_sha1(F.col("payload")))
    repeated = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "refers_to")
    whole = rows.join(repeated, "digest", "left").withColumn("key", F.expr("uuid()"))
    payload, size = F.col("payload"), F.octet_length("payload")
    urn = lambda kind: F.concat(F.lit("<urn:x-capture:"), F.col("key"), F.lit(f":{kind}>"))
    revisits = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    shared = (("WARC-Target-URI", F.col("url")), ("X-Page-ID", F.col("page_id").cast("string")))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    content = ("Content-Type", F.lit("application/http;msgtype=response"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ")
    head = F.concat(http, size.cast("string"), F.lit(END))
    ask = F.concat(F.lit("GET / HTTP/1.1\r\nX-Target: "), F.col("url"), F.lit(END))
    facts = F.concat(F.lit("fetchTimeMs: 0\r\npayloadBytes: "), size.cast("string"), F.lit("\r\n"))
    response = F.concat(header("response", urn("response"), F.octet_length(head) + size, *shared, digest, content), head, payload)
    revisit = F.concat(header("revisit", urn("response"), F.octet_length(head), *shared, digest, content, ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), ("X-Refers-To-Page", F.col("refers_to").cast("string"))), head)
    to = ("WARC-Concurrent-To", urn("response"))
    request = F.concat(header("request", urn("request"), F.octet_length(ask), *shared, to, ("Content-Type", F.lit("application/http;msgtype=request"))), ask)
    metadata = F.concat(header("metadata", urn("metadata"), F.octet_length(facts), *shared, to, ("Content-Type", F.lit("application/warc-fields"))), facts)
    records = whole.select(F.explode(F.array(request, F.when(revisits, revisit).otherwise(response), metadata)).alias("value"))
    archives = in_batches(records, Archives(archive_bytes), "archive binary")
    # A file is one archive and a zero byte, which gzip readers take for padding.
    archives.select(F.col("archive").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def inflate(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """Streams a gzip file of one or more members; zero bytes between or after them are padding."""
    view, at, rest, member = memoryview(data), 0, b"", None
    while rest or at < len(view):
        if not rest:
            rest, at = bytes(view[at : at + step]), at + step
        if member is None:
            if not (rest := rest.lstrip(b"\0")):
                continue
            member = zlib.decompressobj(31)
        yield member.decompress(rest)
        rest = member.unused_data
        member = None if member.eof else member
    if member is not None:
        raise ValueError("an archive ends within a gzip member")


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record; names of fields in lower case."""
    held = bytearray()
    more = iter(chunks)

    def need(n: int) -> bool:
        while len(held) < n:
            if (x := next(more, None)) is None:
                return False
            held.extend(x)
        return True

    while True:
        searched = 0
        while (stop := held.find(b"\r\n\r\n", max(0, searched - 3))) < 0:
            searched = len(held)
            if not need(searched + 1):
                if held.strip():
                    raise ValueError("an archive ends within a record")
                return
        first, *lines = held[:stop].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        end = stop + 4 + int(fields["content-length"])
        if not need(end + 4):
            raise ValueError("an archive ends within a record")
        yield fields, bytes(held[stop + 4 : end])
        del held[: end + 4]


RECORDS = "record_type string, record_id string, concurrent_to string, target_uri string, page_id long, refers_to long, payload_digest string, stated_digest string, payload_bytes long, block_bytes long, payload binary"


@dataclass
class ReadRecords:
    with_payload: bool

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        import hashlib

        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        names, types = zip(*((x.split()[0], kinds[x.split()[1]]) for x in RECORDS.split(", ")), strict=True)
        number = lambda x: None if x is None else int(x)
        rows, size = [], 0
        for b in batches:
            for data in b.column(0):
                for f, block in parse(inflate(data.as_buffer().to_pybytes())):
                    kind = f["warc-type"]
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    digest = None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    stated = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if digest != stated and payload is not None:
                        raise ValueError(f"{f['warc-record-id']}: the payload differs from its digest")
                    rows.append((kind, f["warc-record-id"], f.get("warc-concurrent-to"), f.get("warc-target-uri"), number(f.get("x-page-id")), number(f.get("x-refers-to-page")), digest, stated, None if payload is None else len(payload), len(block), payload if self.with_payload else None))
                    size += len(block) * self.with_payload + 500
                    if size > 8 << 20:
                        yield record_batch(list(names), list(types), list(zip(*rows, strict=True)))
                        rows, size = [], 0
        if rows:
            yield record_batch(list(names), list(types), list(zip(*rows, strict=True)))


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")
    return in_batches(files, ReadRecords(with_payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: request, response (or revisit) and metadata, joined by concurrent-to."""
    part = lambda kind, *cols: records.where(F.col("record_type") == kind).select(F.col("concurrent_to").alias("record_id"), F.struct("record_id", *cols).alias(kind))
    main = records.where(F.col("record_type").isin("response", "revisit"))
    # A revisit has no payload of its own: its length is that of the capture it refers to.
    lengths = main.where("record_type = 'response'").groupBy("stated_digest").agg(F.max("payload_bytes").alias("_bytes"))
    main = main.join(lengths, "stated_digest", "left")
    capture = F.struct("record_id", "record_type", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"), F.col("stated_digest").alias("payload_digest"), "refers_to", "payload").alias("response")
    return main.select("record_id", "page_id", "target_uri", capture).join(part("request", "block_bytes"), "record_id", "left").join(part("metadata", "block_bytes"), "record_id", "left").drop("record_id")


def round_trip(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes pages as archives to a folder, reads them back and assembles captures (without payloads)."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_archives(pages, path, least_bytes)
    # Archives are read once; the joins go over a table of records without payloads.
    return assemble(cut(read_archives(spark, path, with_payload=False), "records"))
