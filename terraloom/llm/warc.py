"""WARC archives: writing, normalising whole-file gzip streams to a member a record, and reading by offset index (operator 7)."""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.shared import saved

LEAST_REVISIT = 100  # bytes; smaller payloads are always stored
ARCHIVE_BYTES = 64 << 20  # an archive is closed after so many bytes of payload
INDEX = "path string, index_path string, records long, bytes long"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 20


def revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Pages with ``payload`` (UTF-8, null: empty), ``payload_digest``, ``payload_bytes``, ``record_type`` and ``refers_to``.

    Of equal payloads of at least 100 bytes the one with the smallest id is the response, the others revisit it. Rows with a null id
    are responses; of rows that repeat the smallest id, each is a response.
    """
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    held = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), body.alias("payload"))
    held = held.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    first = held.where(f"payload_bytes >= {LEAST_REVISIT}").groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("size")).where("size > 1").drop("size")
    again = F.coalesce(F.col("page_id") != F.col("first"), F.lit(False))
    return held.join(first, "payload_digest", "left").select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_digest", "payload_bytes", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def record(row: dict) -> bytes:
    """One WARC/1.1 record: HTTP head and payload, or the head alone for a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = head + (row["payload"] or b"")
    number = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{row['page_id']}")
    url = row["url"].replace("\r", "%0D").replace("\n", "%0A")
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<urn:uuid:{number}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"), ("X-Page-ID", "" if row["page_id"] is None else str(row["page_id"]))]
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{row["refers_to"]}')}>"), ("X-Refers-To-Page", str(row["refers_to"]))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Page id, sizes, digest, type and reference of a record; a stored payload is hashed and measured again."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().replace(":\r\n", ": \r\n").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != stated or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of page {fields['X-Page-ID']} is damaged")
    number = lambda k: int(fields[k]) if fields.get(k, "").strip() else None
    return {"page_id": number("X-Page-ID"), "payload_bytes": stated, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page")}


class Archive:
    """A file under a name of its own in the shared folder; it counts only once its row of the manifest is committed."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        fs, self.name = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(self.name.rpartition("/")[0], recursive=True)
        self.out, self.fs, self.records, self.bytes = fs.open_output_stream(self.name, compression=None), fs, 0, 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes records as archives that are one gzip stream each, as some crawlers leave them; returns their manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, size, pack = None, 0, None
        done = []
        for batch in batches:
            for at in range(0, len(batch), 256):
                for row in batch.slice(at, 256).to_pylist():
                    if archive is None:
                        archive, size, pack = Archive(folder), 0, zlib.compressobj(4, zlib.DEFLATED, 31)
                    data = record(row)
                    archive.write(pack.compress(data))
                    archive.records, size = archive.records + 1, size + len(data)
                    if size >= ARCHIVE_BYTES:
                        done.append(close(archive, pack))
                        archive = None
        if archive is not None:
            done.append(close(archive, pack))
        yield manifest(done)

    def close(archive: Archive, pack) -> tuple:  # noqa: ANN001
        archive.write(pack.flush())
        archive.out.close()
        return archive.path, "", archive.records, archive.bytes

    return saved(rows.mapInArrow(run, INDEX), "archives")


def manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = zip(("path", "index_path", "records", "bytes"), (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)
    return pa.record_batch({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate(kinds)})


def spread(files: DataFrame) -> DataFrame:
    """A manifest dealt by ranges of paths, about one file a partition: the work is in the files that the rows name."""
    return files.repartitionByRange(max(1, files.count()), "path")


def inflated(stream: io.RawIOBase | pa.NativeFile) -> Iterator[bytes]:
    """What the members of a gzip file hold, in pieces of _CHUNK bytes at most, however far a few bytes inflate."""
    unpack = zlib.decompressobj(31)
    while chunk := stream.read(_CHUNK):
        while chunk:
            yield unpack.decompress(chunk, _CHUNK)
            chunk = unpack.unconsumed_tail
            if unpack.eof:
                chunk, unpack = unpack.unused_data, zlib.decompressobj(31)
        while not unpack.eof and (rest := unpack.decompress(b"", _CHUNK)):
            yield rest


def records_of(stream: io.RawIOBase | pa.NativeFile) -> Iterator[bytes]:
    """Records of a gzip file, inflated once in a running window, whatever its members are."""
    held = bytearray()
    for piece in inflated(stream):
        held += piece
        at = 0
        while (end := held.find(b"\r\n\r\n", at)) >= 0:
            head = bytes(held[at:end])
            size = int(head[head.lower().rindex(b"\r\ncontent-length:") + 17 :].split(b"\r\n")[0])
            if len(held) < end + size + 8:
                break
            yield bytes(held[at : end + size + 8])
            at = end + size + 8
        del held[:at]
    if held.strip():
        raise ValueError("the archive breaks off within a record")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive with a gzip member for every record and a sidecar index of (offset, length) lines; returns the new manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, name = pafs.FileSystem.from_uri(row["path"])
                archive, index = Archive(folder), []
                with fs.open_input_stream(name, compression=None) as stream:
                    for data in records_of(stream):
                        pack = zlib.compressobj(4, zlib.DEFLATED, 31)
                        start = archive.bytes
                        archive.write(pack.compress(data) + pack.flush())
                        index.append([start, archive.bytes - start])
                archive.out.close()
                with archive.fs.open_output_stream(archive.name + ".idx", compression=None) as out:
                    out.write("".join(json.dumps(x) + "\n" for x in index).encode())
                yield manifest([(archive.path, archive.path + ".idx", len(index), archive.bytes)])

    return saved(spread(files).mapInArrow(run, INDEX), "members")


def read_records(files: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record, reached through the offset indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        for batch in batches:
            for row in batch.to_pylist():
                fs, name = pafs.FileSystem.from_uri(row["path"])
                with fs.open_input_stream(name + ".idx", compression=None) as side:
                    index = [json.loads(x) for x in side.read().splitlines()]
                with fs.open_input_file(name) as data:
                    for at in range(0, len(index), 1000):
                        rows = [parse(zlib.decompress(data.read_at(n, start), 31)) for start, n in index[at : at + 1000]]
                        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    return spread(files).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
