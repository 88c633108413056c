"""WARC archives: a normaliser for whole-file gzip streams, with a sidecar offset index.

``write_archives`` writes pages as WARC records into archives that are one gzip stream each.
``normalise`` inflates each stream once, rewrites every record as a gzip member of its own and
returns the sidecar index (archive, offset, length). ``read_archives`` reads the normalised
archives through Spark and yields the records of their members.

Archives are files of the shared folder. A task writes to a name of its own attempt and moves
the file into place, so a task that runs again replaces the same archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import drop, fresh_path, pick, sized, store

#: Payloads of at least this many bytes are revisited when equal; archives hold about this many raw bytes.
SMALL, ARCHIVE = 100, 16 << 20
CRLF = b"\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    head = [
        b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: <urn:page:%s>" % str(page_id if page_id is not None else "none").encode(), b"WARC-Date: 2024-01-01T00:00:00Z",
        b"WARC-Target-URI: " + " ".join((url or "").split()).encode(), b"WARC-Payload-Digest: sha256:" + digest.encode(), b"X-Payload-Length: %d" % len(payload), b"Content-Type: text/html; charset=utf-8",
    ]
    if revisit:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: <urn:page:%d>" % refers_to]
        payload = b""
    return CRLF.join([*head, b"Content-Length: %d" % len(payload), b"", b""]) + payload + CRLF + CRLF


class Stream:
    """Bytes of a gzip stream of one or more members, inflated piece by piece, each byte once."""

    def __init__(self, source):
        self.source, self.inflate, self.held = source, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        data = self.inflate.unused_data if self.inflate.eof else b""
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        data = data or self.source.read(1 << 18)
        if not data:
            return False
        self.held += self.inflate.decompress(data)
        return True

    def until(self, mark: bytes) -> bytes | None:
        at = 0
        while (i := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
        return self.take(i + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def records(source) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    """Raw bytes, headers and payload of each record of a gzip stream. A cut-off stream raises ValueError."""
    stream = Stream(source)
    while (head := stream.until(CRLF + CRLF)) is not None:
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)}
        size = int(fields.get("content-length", 0))
        body = stream.take(size + 4)
        if len(body) < size + 4:
            raise ValueError("the stream ends within a record")
        yield head + body, fields, body[:size]
    if stream.held.strip():
        raise ValueError("bytes after the last record")


def _place(folder: str, name: str, data: bytes) -> str:
    files, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    files.create_dir(root, recursive=True)
    own = f"{root}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(own, compression=None) as f:
        f.write(data)
    files.move(own, f"{root}/{name}")
    return name


def _uri(path: str) -> str:
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) -> one gzip stream for about ARCHIVE bytes of records; returns archive, n_records."""
    folder = _uri(folder)

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        held, count, size = [], 0, 0

        def flush():
            nonlocal held, count, size, n
            name = _place(folder, f"raw-{part:06d}-{n:05d}.warc.gz", gzip.compress(b"".join(held), 6, mtime=0))
            out = pa.RecordBatch.from_pydict({"archive": [name], "n_records": pa.array([count], pa.int64())})
            held, count, size, n = [], 0, 0, n + 1
            return out

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                held.append(record(*row))
                count, size = count + 1, size + len(held[-1])
                if size >= ARCHIVE:
                    yield flush()
        if held:
            yield flush()

    return pages.mapInArrow(run, "archive string, n_records long")


def normalise(spark: SparkSession, archives: DataFrame, folder: str, out: str) -> DataFrame:
    """Rewrite whole-stream archives, one member a record; returns the sidecar index: archive, offset, length, record_id, record_type."""
    folder, out = _uri(folder), _uri(out)

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                buffer, rows = io.BytesIO(), []
                with files.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for raw, fields, _ in records(source):
                        at = buffer.tell()
                        buffer.write(gzip.compress(raw, 6, mtime=0))
                        rows.append((name.replace("raw-", "warc-"), at, buffer.tell() - at, fields.get("warc-record-id"), fields.get("warc-type")))
                _place(out, name.replace("raw-", "warc-"), buffer.getvalue())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["archive", "offset", "length", "record_id", "record_type"])

    n = max(1, min(archives.count(), 100_000))
    return archives.select("archive").repartition(n).mapInArrow(run, "archive string, offset long, length long, record_id string, record_type string")


def read_archives(spark: SparkSession, index: DataFrame, folder: str) -> DataFrame:
    """The records of normalised archives by their index: each archive is opened once, each member inflated on its own, what it holds checked against its digest."""
    folder = _uri(folder)

    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, offsets, lengths in zip(*(batch.column(c).to_pylist() for c in ("archive", "offsets", "lengths")), strict=True):
                out = []
                with files.open_input_file(f"{root}/{name}") as source:
                    for at, n in zip(offsets, lengths, strict=True):
                        source.seek(at)
                        ((_, fields, payload),) = records(io.BytesIO(source.read(n)))
                        revisit, digest = fields["warc-type"] == "revisit", fields["warc-payload-digest"].removeprefix("sha256:")
                        if not revisit:
                            digest, found = hashlib.sha256(payload).hexdigest(), digest
                            if digest != found:
                                raise ValueError(f"{name}: payload of {fields['warc-record-id']} changed")
                        page = fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">")
                        refers = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")
                        out.append((None if page == "none" else int(page), int(fields["x-payload-length"]) if revisit else len(payload), digest, fields["warc-type"], int(refers) if refers else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    members = index.groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("m"))
    members = members.select("archive", F.col("m.offset").alias("offsets"), F.col("m.length").alias("lengths"))
    # an archive a task, however short the index
    members = members.repartition(max(1, min(index.select("archive").distinct().count(), 100_000)))
    return members.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html), written to archives and read again:
    page_id, payload_bytes, payload_digest, record_type, refers_to.

    Of records whose payloads are equal and have at least 100 bytes the one with the smallest
    page_id is a response (rows that repeat it too), the others revisit it; smaller payloads
    are responses. A null page_id is never the smallest; if all are null, all are responses.
    Null html is an empty payload. An empty table gives no rows; further columns are ignored.
    """
    spark = pages.sparkSession
    pages = pages.select(*pick(pages, "page_id", "url", "html"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    # only digests that several pages share need their first page
    again = pages.where(F.octet_length("payload") >= SMALL).select("page_id", "digest").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    again, _ = store(again, "again")
    told = pages.join(sized(again, limit=100_000), "digest", "left")
    told = told.select("page_id", "url", "payload", "digest", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers_to"))
    raw, folder = fresh_path(spark, "warc-raw"), fresh_path(spark, "warc")
    archives, _ = store(write_archives(told, raw), "archives")
    index, _ = store(normalise(spark, archives, raw, folder), "warc-index")
    drop(spark, raw)
    return read_archives(spark, index, folder)
