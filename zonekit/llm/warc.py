"""5. Dictionary-compressed WARC writer and reader.

``plan`` finds the record type of every page: of equal payloads of at least ``LEAST_BYTES`` bytes the one with the
smallest page id is the response, others revisit it; smaller payloads are all responses. Digests are grouped before
any payload moves; the few digests that hold many pages are joined by broadcast, so no task gets one digest's pages.

``write``: each task writes archives of about ``ARCHIVE_BYTES``: a Zstandard dictionary built from the archive's own
first records stands in a leading skippable frame, each record is a frame of its own. A task names its files by itself;
only tasks that succeed reach the manifest. ``read`` streams the archives of a manifest back, one a task at a time.

Null html counts as empty, a null url is left out of the record. Pages without an id can be responses only where no
page with an id has their payload; their revisits then refer to null. Rows that repeat the smallest page id of a payload are all responses,
of one record id.
Other columns are not read. An empty table makes no archive.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import lookup, open_folder, stored

#: Smallest payload that others may refer to.
LEAST_BYTES = 100
#: Uncompressed bytes of an archive, of the records that its dictionary is built from, and of the dictionary.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 32 << 20, 2 << 20, 32 << 10
#: Fixed values of the formats.
SKIPPABLE, VERSION, DATE = 0x184D2A5D, "WARC/1.1", "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PLANNED = "page_id", "url", "payload", "payload_digest", "record_type", "refers_to", "refers_to_url"
MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def plan(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, payload_digest, record_type, and of revisits refers_to, refers_to_url, of every page."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    shared = (rows.where(F.octet_length("payload") >= LEAST_BYTES).groupBy("payload_digest")
              .agg(F.count("*").alias("copies"), F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url")).where("copies > 1"))
    shared = stored(shared, "shared_payloads")
    out = lookup(rows, shared, ["payload_digest"], "copies", pages.count())
    # without an id at all, the first of equal pages can't be told: all are responses
    revisit = F.col("copies").isNotNull() & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "payload", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                      F.when(revisit, F.col("first")).alias("refers_to"), F.when(revisit, F.col("first_url")).alias("refers_to_url"))


def record_id(page_id: int | None, digest: str, kind: str) -> str:
    """The same for the same page, payload and type, so that a revisit can name a record that another task writes."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{page_id}:{digest}')}>"


def record(row: dict) -> bytes:
    """One WARC record. The id of a page goes into the record's id and a field of its own; a revisit names its response by the standard fields."""
    revisit = row["record_type"] == "revisit"
    payload = row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_id(row["page_id"], row["payload_digest"], row["record_type"])), ("WARC-Date", DATE)]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", " ".join(row["url"].split())))
    if row["page_id"] is not None:
        fields.append(("WARC-Page-ID", row["page_id"]))
    fields.append(("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(row["refers_to"], row["payload_digest"], "response")),
                   ("WARC-Refers-To-Date", DATE), ("WARC-Refers-To-Page-ID", row["refers_to"])]
        if row.get("refers_to_url") is not None:
            fields.append(("WARC-Refers-To-Target-URI", " ".join(row["refers_to_url"].split())))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


class Archive:
    """One archive file that is being written."""

    def __init__(self, store, place: str):
        self.path = f"{place}/{uuid.uuid4().hex}.warc.zst"
        self.out = store.open_output_stream(self.path, compression=None)  # else taken from the name
        self.waiting: list[bytes] = []
        self.size = self.records = 0
        self.compress = None

    def add(self, data: bytes) -> None:
        self.size += len(data)
        self.records += 1
        if self.compress is not None:
            self.out.write(self.compress(data))
            return
        self.waiting.append(data)
        if self.size >= SAMPLE_BYTES:
            self.start()

    def start(self) -> None:
        samples, kind = self.waiting, zstandard.DICT_TYPE_FULLDICT
        try:
            words = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # too few records to train on: their bytes are the dictionary
            words, kind = b"".join(samples)[-DICTIONARY_BYTES:], zstandard.DICT_TYPE_RAWCONTENT
        self.out.write(struct.pack("<II", SKIPPABLE, len(words)) + words)
        compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(words, dict_type=kind))
        self.compress = compressor.compress
        for data in self.waiting:
            self.out.write(self.compress(data))
        self.waiting = []

    def close(self) -> dict:
        if self.compress is None:
            self.start()
        self.out.close()
        return {"path": self.path, "records": self.records, "bytes": self.size}


def write(planned: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all records; returns the stored manifest, one row an archive."""
    folder = folder or scratch_path(planned.sparkSession, "warc")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = open_folder(folder)
        schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        now = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if now is None:
                        store.create_dir(place, recursive=True)
                        now = Archive(store, place)
                    now.add(record(row))
                    if now.size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist([now.close()], schema)
                        now = None
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.close()], schema)

    manifest = planned.select(*PLANNED).mapInArrow(archive, MANIFEST).withColumn("folder", F.lit(folder))
    return stored(manifest, "archives")


def records(stream) -> Iterator[dict]:
    """The records of one archive, from a binary file object."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary in the first frame")
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size))).stream_reader(stream, read_across_frames=True)
    lines = io.BufferedReader(plain, 1 << 20)
    while version := lines.readline():
        if version.strip().decode() != VERSION:
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = {}
        while (line := lines.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        block = lines.read(int(fields["Content-Length"]))
        lines.read(4)
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of page {fields.get('WARC-Page-ID')} differs from its digest")
        declared = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        number = lambda k: int(fields[k]) if fields.get(k) not in (None, "None") else None
        yield {"page_id": number("WARC-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": declared if revisit else len(payload),
               "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To-Page-ID"),
               "payload": None if revisit else payload}


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row a record of the archives; ``payloads`` False checks them but leaves them out."""
    files = max(1, manifest.count())
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, _ = open_folder(row["folder"])
                with store.open_input_stream(row["path"], compression=None) as stream:
                    part = []
                    for r in records(stream):
                        part.append(r if payloads else r | {"payload": None})
                        if len(part) == 256:
                            yield pa.RecordBatch.from_pylist(part, schema)
                            part = []
                    if part:
                        yield pa.RecordBatch.from_pylist(part, schema)

    return manifest.repartition(files).mapInArrow(load, RECORD)
