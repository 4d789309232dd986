"""Deterministic sharded WARC archives.

Records are range-sorted by page_id into shards whose bounds come from a sample chosen by hash; records that tie are
equal. So the same rows give the same files, byte for byte, in whatever files or partitions they come. Within a shard, files roll when their
compressed size reaches FILE_BYTES. Every record is a gzip member of its own. Headers and digests are
made anew from the payload; record ids derive from page id and payload. A file is written under a
temporary name and moved to its final one; a manifest table, written last, lists what is committed.

Of records with equal payloads of at least REVISIT_BYTES, that with the largest page_id is the
response and the others are revisits of it, without payload. Which payloads repeat is found on
(page_id, digest) rows alone; the decisions travel to the records as extra rows of the same
shuffle, so pages cross the network once.

Defined cases: null html is an empty payload, a null url leaves the target out; records that share
the largest page_id of a payload are all responses; a record with a null page_id comes first, without
page header, and is a response only if all records of its payload have none; control characters in URLs are
percent-encoded; an empty table gives one manifest without files; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.llm.batches import field, map_batches
from tidemark.plans.materialize import materialize

REVISIT_BYTES = 1000
SHARD_BYTES = 64 << 20  # payload bytes dealt to a task
FILE_BYTES = 16 << 20  # compressed bytes after which a file is closed
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # a fixed time: archives of equal tables are equal
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BLANK = b"\r\n\r\n"


def _record_id(page_id: int | None, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest.hex()}')}>"


def _labelled(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record: an HTTP response, or a revisit that holds its head only."""
    digest = hashlib.sha1(payload).digest()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{_BLANK.decode()}".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += [
        f"WARC-Payload-Digest: {_labelled(digest)}", f"X-Payload-Length: {len(payload)}",
        f"WARC-Block-Digest: {_labelled(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + _BLANK + block + _BLANK


def _member(data: bytes) -> bytes:
    """A gzip member whose bytes depend on the data alone."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + tail


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the records that repeat the payload of a larger page_id."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    slim = pages.select("page_id", F.unhex(F.sha1(payload)).alias("digest"), F.octet_length(payload).alias("size"))
    slim = materialize(slim.where(F.col("size") >= REVISIT_BYTES).drop("size"))
    best = slim.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    best = best.where("n > 1 and refers_to is not null").drop("n")
    # A payload that a third of all pages share is a skewed key here; rows are tens of bytes, and
    # adaptive execution splits it, as nothing above the join needs the key together.
    found = slim.join(best, "digest").where("page_id is null or page_id < refers_to")
    return found.select("page_id", "digest", "refers_to")


def write_warc(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) as archives below `folder`; returns the stored manifest
    (shard, part, path, records, bytes, sha256)."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    own = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    own = own.withColumn("refers_to", F.lit(None).cast("bigint"))
    # A decision comes before the record that it is about: same page_id, same digest, no payload.
    told = revisits(pages).distinct().select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "refers_to"
    )
    ranged, _ = files.sorted_shards(own, "page_id", F.col("digest"), F.octet_length("payload"), shard_bytes, led_by=told)

    def work(batches):
        # A decision directly precedes the records that it is about, so only the last one is kept.
        writer, decision = None, (None, None, None)
        for b in batches:
            if not b.num_rows:
                continue
            writer = writer or _Writer(folder, field(b, "_shard")[0].as_py(), file_bytes)
            columns = [field(b, n).to_pylist() for n in ("page_id", "url", "payload", "digest", "refers_to", "_copies")]
            for page_id, url, data, digest, refers_to, copies in zip(*columns, strict=True):
                if data is None:
                    decision = (page_id, digest, refers_to)
                else:
                    target = decision[2] if decision[:2] == (page_id, digest) else None
                    written = record(page_id, url, data, target, target is not None)
                    for _ in range(copies):
                        writer.add(written)
        if writer:
            yield writer.close()

    schema = "shard int, part int, path string, records bigint, bytes bigint, sha256 string"
    return materialize(map_batches(ranged.select("page_id", "url", "payload", "digest", "refers_to", "_shard", "_copies"), schema, work))


class _Writer:
    """Writes the files of one shard, one after the other."""

    def __init__(self, folder: str, shard: int, limit: int):
        self.folder, self.shard, self.limit = folder, shard, limit
        self.rows: list[tuple] = []
        self.context = None

    def add(self, data: bytes) -> None:
        if self.context is None:
            self.name = f"part-{self.shard:06d}-{len(self.rows):04d}.warc.gz"
            self.context = files.replacing(self.folder, self.name)
            self.out, self.records, self.size, self.sum = self.context.__enter__(), 0, 0, hashlib.sha256()
        member = _member(data)
        self.out.write(member)
        self.sum.update(member)
        self.records, self.size = self.records + 1, self.size + len(member)
        if self.size >= self.limit:
            self._roll()

    def _roll(self) -> None:
        if self.context is not None:
            self.context.__exit__(None, None, None)
            self.context = None
            self.rows.append((self.shard, len(self.rows), f"{self.folder}/{self.name}", self.records, self.size, self.sum.hexdigest()))

    def close(self) -> pa.RecordBatch:
        self._roll()
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = ["shard", "part", "path", "records", "bytes", "sha256"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in self.rows], t) for i, t in enumerate(types)], names)


def members(uri: str, block: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed records of an archive, one at a time."""
    with files.open_file(uri) as source:
        data, parts, unpacker = source.read(block), [], zlib.decompressobj(31)
        while data:
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(parts)
                parts, unpacker = [], zlib.decompressobj(31)
            data = data or source.read(block)
        if parts:
            raise ValueError(f"{uri} ends inside a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises if a length or digest is wrong."""
    head, _, rest = data.partition(_BLANK)
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if not first.startswith("WARC/") or rest[len(block) :] != _BLANK:
        raise ValueError("a record's length is wrong")
    if _labelled(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
        raise ValueError("a record's block digest is wrong")
    if fields["WARC-Type"] == "response":
        payload = block.partition(_BLANK)[2]
        if _labelled(hashlib.sha1(payload).digest()) != fields["WARC-Payload-Digest"]:
            raise ValueError("a record's payload digest is wrong")
    return fields, block


ROWS = 500


def read_warc(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every committed
    record, with `payload` (binary, null for revisits) if asked for. Digests are verified."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    if payloads:
        names, types, schema = [*names, "payload"], [*types, pa.binary()], schema + ", payload binary"

    def rows(uri: str) -> Iterator[tuple]:
        for data in members(uri):
            fields, block = parse(data)
            digest = base64.b32decode(fields["WARC-Payload-Digest"].partition(":")[2]).hex()
            number = [int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Payload-Length", "X-Refers-To-Page-ID")]
            row = (number[0], fields.get("WARC-Target-URI"), number[1], digest, fields["WARC-Type"], number[2])
            if payloads:
                row += (block.partition(_BLANK)[2] if fields["WARC-Type"] == "response" else None,)
            yield row

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    def work(batches):
        for b in batches:
            for uri in field(b, "path").to_pylist():
                held = []
                for row in rows(uri):
                    held.append(row)
                    if len(held) == ROWS:
                        yield batch(held)
                        held = []
                if held:
                    yield batch(held)

    count = manifest.agg(F.count(F.lit(1))).first()[0]
    place = F.pmod(F.col("shard") * 31 + F.col("part"), F.lit(max(1, count)))
    each = manifest.repartitionById(max(1, count), place.cast("int"))
    return map_batches(each.select("path"), schema, work)
