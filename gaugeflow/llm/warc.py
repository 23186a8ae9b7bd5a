"""WARC archives: one gzip member per record, written and read as sequential streams.

A task writes one archive into the shared folder under a name of its own and reports it in
the manifest, a table that Spark commits; archives of lost or repeated attempts are never in
it. A reader task opens the archives its manifest rows name, inflates them piece by piece,
frames records by their Content-Length and checks both digests, holding one payload at most.
"""

from __future__ import annotations

import hashlib
import json
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.common import open_folder, shuffle_partitions, stage, text_or_empty

# Marks and names of the format.
VERSION = b"WARC/1.0"
HEAD_END = b"\r\n\r\n"
RECORD_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

URI_CHARACTERS = "%/:=&?~#+!$,;'@()*[]"

CHUNK = 1 << 16
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, verified boolean"
)


def mark_revisits(spark: SparkSession, pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Columns page_id, url, payload, digest, record_type, refers_to of each page.

    Of equal payloads of at least ``least_bytes``, the one with the smallest page_id is the
    response and the others are its revisits; a page that has the same page_id and payload as
    the response is a response too. Null html is an empty payload. A null page_id never is
    the one referred to, unless all are null: then each is a response.
    """
    payload = F.encode(text_or_empty("html"), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"), payload.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= least_bytes
    firsts = rows.filter(long_enough).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies")
    ).filter("copies > 1").select("digest", "first_id")
    # Staged, so that a payload which many pages share can be split in the join.
    joined = rows.join(stage(spark, firsts, "first_pages"), "digest", "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first_id")), None).otherwise(
        F.col("first_id")
    )
    kind = F.when(refers.isNotNull(), "revisit").otherwise("response")
    return joined.select(
        "page_id", "url", "payload", "digest",
        kind.alias("record_type"), refers.alias("refers_to"),
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(row: dict, date: str) -> bytes:
    """One record, not yet compressed. A revisit has the HTTP head but no payload."""
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if row["record_type"] == "revisit" else http + payload
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": record_id(row["page_id"]),
        "WARC-Date": date,
        "WARC-Target-URI": urllib.parse.quote(row["url"] or "", safe=URI_CHARACTERS),
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if fields["WARC-Target-URI"] != row["url"]:  # not an ASCII URI, or none
        fields["X-Exact-URI"] = json.dumps(row["url"])
    if row["page_id"] is not None:
        fields["X-Page-ID"] = str(row["page_id"])
    if row["record_type"] == "revisit":
        fields["WARC-Profile"] = REVISIT_PROFILE
        fields["WARC-Refers-To"] = record_id(row["refers_to"])
        fields["X-Refers-To-Page-ID"] = str(row["refers_to"])
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + RECORD_END


def write_archives(
    records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", level: int = 6
) -> DataFrame:
    """Archives of ``mark_revisits``' rows; a manifest of path, records and bytes.

    The manifest must be staged before it is used: each evaluation writes anew.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = path = None
        count = size = 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                if sink is None:
                    store, root = open_folder(folder)
                    store.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path = f"{folder}/{name}"
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                deflater = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = deflater.compress(record_bytes(row, date)) + deflater.flush()
                sink.write(member)
                count, size = count + 1, size + len(member)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {"path": [path], "records": [count], "bytes": [size]}
            )

    return records.mapInArrow(write, "path string, records long, bytes long")


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


class RecordParser:
    """Takes the inflated bytes of one member as they come; ``finish`` gives the record."""

    def __init__(self, keep_payload: bool):
        self.keep, self.pending = keep_payload, b""
        self.head = self.http = None
        self.seen = self.payload_seen = 0
        self.block_hash, self.payload_hash = hashlib.sha256(), hashlib.sha256()
        self.payload: list[bytes] = []
        self.tail = b""

    def feed(self, data: bytes) -> None:
        if self.head is None:
            self.pending += data
            head, found, data = self.pending.partition(HEAD_END)
            if not found:
                return
            if not head.startswith(b"WARC/"):
                raise ValueError("a member does not begin with a WARC record")
            self.head, self.pending = fields_of(head), b""
            self.length = int(self.head["content-length"])
            self.is_http = self.head.get("content-type", "").startswith("application/http")
        block = data[: self.length - self.seen]
        self.tail += data[len(block) :]
        self.seen += len(block)
        self.block_hash.update(block)
        if self.is_http and self.http is None:
            self.pending += block
            http, found, block = self.pending.partition(HEAD_END)
            if not found:
                return
            self.http, self.pending = fields_of(http), b""
        self.payload_seen += len(block)
        self.payload_hash.update(block)
        if self.keep:
            self.payload.append(block)

    def finish(self) -> dict:
        if self.head is None or self.seen != self.length or self.tail != RECORD_END:
            raise ValueError("a record does not have the length that it states")
        stated = self.head.get("warc-payload-digest", "").removeprefix("sha256:") or None
        revisit = self.head.get("warc-type") == "revisit"
        own = self.payload_hash.hexdigest()
        block = self.head.get("warc-block-digest", "").removeprefix("sha256:")
        verified = block in ("", self.block_hash.hexdigest())
        verified &= revisit or stated in (None, own)
        size = int((self.http or {}).get("content-length", self.payload_seen))
        exact = self.head.get("x-exact-uri")
        number = lambda name: int(self.head[name]) if name in self.head else None
        return {
            "page_id": number("x-page-id"),
            "url": json.loads(exact) if exact else self.head.get("warc-target-uri"),
            "record_type": self.head.get("warc-type"),
            "refers_to": number("x-refers-to-page-id"),
            "payload_bytes": size if revisit else self.payload_seen,
            "payload_digest": stated if revisit else own,
            "payload": b"".join(self.payload) if self.keep and not revisit else None,
            "verified": verified,
        }


def parse_archive(stream, keep_payload: bool) -> Iterator[dict]:
    """Records of an open archive in their order, read sequentially chunk by chunk."""
    raw = stream.read(CHUNK)
    while raw:
        inflater, parser = zlib.decompressobj(31), RecordParser(keep_payload)
        while not inflater.eof:
            if not raw:
                raw = stream.read(CHUNK)
                if not raw:
                    raise EOFError("the archive ends within a member")
            parser.feed(inflater.decompress(raw))
            raw = inflater.unused_data
        yield parser.finish()
        raw = raw or stream.read(CHUNK)


def read_archives(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records of all archives named in column ``path``.

    A member that is cut off or does not frame raises an error; a digest that does not agree
    shows as ``verified`` false. Revisits have no payload of their own.
    """
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("payload", pa.binary()), ("verified", pa.bool_()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, place = open_folder(path)
                with store.open_input_stream(place, compression=None) as stream:
                    rows, held = [], 0
                    for record in parse_archive(stream, keep_payload):
                        rows.append(record)
                        held += len(record["payload"] or b"") + 200
                        if held > 1 << 23:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return manifest.select("path").mapInArrow(read, RECORD_SCHEMA)


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages`` as archives into ``folder``; the committed manifest."""
    return stage(spark, write_archives(mark_revisits(spark, pages), folder), "manifest")


def spread(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """A few archives to each task."""
    return manifest.repartition(shuffle_partitions(spark))


