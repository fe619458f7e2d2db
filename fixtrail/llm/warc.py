"""WARC archives: write pages as records, read them back in sequence.

Writing: a page becomes one record in a gzip member of its own. Among pages whose payloads are
equal and at least ``revisit_from`` bytes long, the one with the smallest id is a ``response`` record
and the others are ``revisit`` records that name it and keep only the HTTP head; shorter pages are
always responses. Every task writes one archive to the shared folder under a name no other
attempt uses; only the manifest of finished tasks says which archives count, so a lost or repeated
task leaves no record twice.

Reading: a task streams an archive in blocks of 64 KB through an incremental zlib decompressor. A
record's head is parsed as soon as it is there, its block is framed by Content-Length, and the
digest headers are checked against what was read. One record is held at a time.

A null payload is empty. A null id is written as such; it never is the smallest unless all are
null. Rows that repeat both id and payload are the same page and have the same type. An empty table
writes no record and reads back as an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtrail.operators.staging import scratch_folder, stage

REVISIT_FROM = 100
BLOCK = 1 << 16
#: Bytes that a record's head may have.
MOST_HEAD = 1 << 20
_GZIP = 31  # zlib's window bits for gzip framing
_VERSION = b"WARC/1.1"
# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP head."""
        return self.block.partition(b"\r\n\r\n")[2]

    def http_header(self, name: str) -> str | None:
        for line in self.block.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:]:
            key, _, value = line.partition(b":")
            if key.decode("latin-1").lower() == name:
                return value.decode("latin-1").strip()
        return None


def _sha256(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def _clean(value: object) -> str:
    return "".join(str(value).splitlines())


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": _clean(url or ""),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "WARC-Block-Digest": _sha256(block),
        "WARC-Payload-Digest": f"sha256:{digest}",
    }
    if revisit:
        head |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
    return packer.compress(_VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


class _Member:
    """The decompressed bytes of one gzip member, taken as far as they are asked for."""

    def __init__(self, stream: BinaryIO, waiting: bytes, block: int) -> None:
        self._stream, self._block = stream, block
        self._unpacker = zlib.decompressobj(_GZIP)
        self._packed, self._ready = waiting, bytearray()
        self.begun = bool(waiting)

    def _more(self) -> bool:
        """Decompress a little more; False at the end of the member."""
        if self._unpacker.eof:
            return False
        packed = self._packed or self._unpacker.unconsumed_tail or self._stream.read(self._block)
        if not packed:
            if self.begun:
                raise ValueError("the archive ends inside a record")
            return False
        self.begun = True
        self._ready += self._unpacker.decompress(packed, self._block)
        self._packed = b""
        return True

    def until(self, end: bytes, most: int) -> bytes | None:
        """Up to and without ``end``, which has to come within ``most`` bytes; None before an archive's end."""
        at = self._ready.find(end)
        while at < 0:
            if len(self._ready) > most or not self._more():
                if not self.begun:
                    return None
                raise ValueError("a WARC record's head has no end")
            at = self._ready.find(end)
        found = bytes(self._ready[:at])
        del self._ready[: at + len(end)]
        return found

    def exactly(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes, in parts."""
        while length:
            if not self._ready and not self._more():
                raise ValueError("a WARC block doesn't have the length its head gives")
            part = bytes(self._ready[:length])
            del self._ready[:length]
            length -= len(part)
            if part:
                yield part

    def rest(self) -> bytes:
        """What of the archive was read behind the member, which has to end here."""
        while not self._ready and self._more():
            pass
        if self._ready or not self._unpacker.eof:
            raise ValueError("a WARC block doesn't have the length its head gives")
        return self._unpacker.unused_data


def _headers(head: bytes) -> dict[str, str]:
    version, *lines = head.split(b"\r\n")
    if version != _VERSION:
        raise ValueError("a WARC record must begin with its version line")
    headers = {}
    for line in lines:
        key, _, value = line.partition(b":")
        headers[key.decode().lower()] = value.decode("utf-8").strip()
    return headers


def _framed(member: _Member, headers: dict[str, str]) -> Record:
    """The block that the head announces; its digest is taken while it is read."""
    digest, parts = hashlib.sha256(), []
    for part in member.exactly(int(headers["content-length"])):
        digest.update(part)
        parts.append(part)
    if b"".join(member.exactly(4)) != b"\r\n\r\n":
        raise ValueError("a WARC block doesn't have the length its head gives")
    record = Record(headers, b"".join(parts))
    if headers.get("warc-block-digest", found := "sha256:" + digest.hexdigest()) != found:
        raise ValueError(f"block digest of {headers.get('warc-record-id')} differs")
    if headers["warc-type"] == "response" and _sha256(record.payload) != headers.get("warc-payload-digest"):
        raise ValueError(f"payload digest of {headers.get('warc-record-id')} differs")
    return record


def records(stream: BinaryIO, block: int = BLOCK) -> Iterator[Record]:
    """Records of one archive, in order: the head as soon as it is there, then as many bytes as it announces."""
    waiting = b""
    while True:
        member = _Member(stream, waiting, block)
        head = member.until(b"\r\n\r\n", MOST_HEAD)
        if head is None:
            return
        record = _framed(member, _headers(head))
        waiting = member.rest()
        yield record


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def with_first_copy(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """page_id, url, payload (string), digest, refers_to (null for responses)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    digest = F.sha2(payload.cast("binary"), 256)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), digest.alias("digest"),
    )
    # hot payloads are counted map-side; only payloads with several ids go on
    repeated = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), digest.alias("digest"), F.octet_length(payload).alias("bytes"))
        .where(F.col("bytes") >= revisit_from)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n")
    )
    revisit = ~F.col("page_id").eqNullSafe(F.col("_first"))
    columns = ("page_id", "url", "payload", "digest")
    large = F.octet_length("payload") >= revisit_from
    joined = rows.where(large).join(repeated, F.col("digest") == F.col("_digest"), "left")
    # small payloads, of which many are equal, take no part in the join
    return joined.select(*columns, F.when(revisit, F.col("_first")).alias("refers_to")).unionAll(
        rows.where(~large).select(*columns, F.lit(None).cast("long").alias("refers_to"))
    )


def write_archives(pages: DataFrame, folder: str | None = None, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write all pages as archives and return their manifest (path, records)."""
    folder = folder or scratch_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, count = None, 0
        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        store, inner = fs.FileSystem.from_uri(path)
                        store.create_dir(inner.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(inner, compression=None)
                    out.write(member(row["page_id"], row["url"], row["payload"].encode(), row["digest"], row["refers_to"]))
                    count += 1
        finally:
            if out is not None:
                out.close()
        if count:
            yield pa.record_batch([pa.array([path]), pa.array([count], pa.int64())], ["path", "records"])

    done = with_first_copy(pages, revisit_from).mapInArrow(write, "path string, records long")
    return stage(done, "warc_manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to and the payload of responses.

    ``manifest`` has the column ``path``. Each archive is read by one task.
    """
    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    schema += ", payload binary" if with_payload else ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        fields = [pa.field(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")]

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, pa.schema(fields))

        for batch in batches:
            for path in batch["path"].to_pylist():
                store, inner = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_stream(inner, compression=None) as stream:
                    for record in records(stream):
                        h = record.headers
                        row = {
                            "page_id": _page(h["warc-record-id"]),
                            "url": h["warc-target-uri"],
                            "record_type": h["warc-type"],
                            "payload_bytes": int(record.http_header("content-length")),
                            "payload_digest": h["warc-payload-digest"].removeprefix("sha256:"),
                            "refers_to": _page(h["warc-refers-to"]) if "warc-refers-to" in h else None,
                        }
                        if with_payload:
                            row["payload"] = record.payload if h["warc-type"] == "response" else None
                            held += len(record.payload)
                        rows.append(row)
                        if len(rows) >= 4096 or held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    spark = manifest.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("path").repartition(tasks).mapInArrow(read, schema)
