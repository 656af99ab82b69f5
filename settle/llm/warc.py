"""WARC archives: monolithic gzip files become files of one member a record, with an index.

`write_archives` writes records as WARC files that are one gzip stream each, as
crawls are often handed over. `normalise` inflates such a file once from start
to end, writes every record again as a gzip member of its own and lists the
offsets in a sidecar file. `read_index` reads the sidecars of finished files and
`read_records` single records by their offsets.

Files are written below a folder of the shared store. Each attempt of a task
writes under a name of its own and returns the names of what it finished, and
only files returned by successful attempts are read on; what a lost executor
left behind is never looked at. Tasks hold one record at a time and a file's
records stay in order. Archives are bounded by `ARCHIVE_BYTES` of payload, so
work is spread whatever the size of a partition.

Equal payloads of at least `LEAST_BYTES` are stored once: the record with the
largest id is the response, the others are revisits that refer to it. Copies
are found by digest, so a payload that makes up any share of the pages is one
row for each task before it is shuffled. Rows that repeat the largest id are
responses all. A null id gives way to any other; a null page is empty. An empty
table gives no archives and no rows. A very long page is one record, held once by
the task that writes or reads it. Only page_id, url and html are read, so other
columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.common import store
from settle.session import bounded, fresh_path

LEAST_BYTES = 1000
ARCHIVE_BYTES = 16_000_000
READ_BYTES = 1 << 20
BATCH_BYTES = 4_000_000  # payloads that a task returns at once
FAST, USUAL = 1, 6  # compression levels of the handed-over and the normalised files
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # records are the same on every attempt


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a path or a URI."""
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def record_bytes(kind: str, name: str, target: str, digest: str, length: int, refers_to: str | None, payload: bytes) -> bytes:
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        # A revisit has no payload of its own; its length is kept beside the digest.
        ("WARC-Payload-Length", str(length)),
        *([("WARC-Profile", REVISIT_PROFILE)] if kind == "revisit" else []),
        *([("WARC-Refers-To", f"<urn:page:{refers_to}>")] if refers_to is not None else []),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(payload))),
    ]
    head = b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in headers)
    return VERSION + b"\r\n" + head + b"\r\n" + payload + b"\r\n\r\n"


class Reader:
    """Records of a stream of bytes, whatever the pieces that it comes in."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.buffer = pieces, bytearray()

    def _fill(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.buffer += piece
        return True

    def _take(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._fill():
                raise ValueError("the archive ends within a record")
        data = bytes(self.buffer[:size])
        del self.buffer[:size]
        return data

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
        """Headers, payload and the bytes of the whole record."""
        while self.buffer or self._fill():
            while (end := self.buffer.find(b"\r\n\r\n")) < 0:
                if not self._fill():
                    if self.buffer.strip():
                        raise ValueError("the archive ends within a header")
                    return
            head = self._take(end + 4)
            lines = head.decode("utf-8", "surrogatepass").split("\r\n")
            if lines[0] != VERSION.decode():
                raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
            headers = dict(line.split(": ", 1) for line in lines[1:] if line)
            payload = self._take(int(headers["Content-Length"]))
            yield headers, payload, head + payload + self._take(4)


def inflate(stream, size: int = READ_BYTES) -> Iterator[bytes]:
    """Pieces of a gzip file of one or several members, READ_BYTES at most at a time."""
    member = zlib.decompressobj(wbits=31)
    fresh = True
    while data := stream.read(size):
        while data:
            if piece := member.decompress(data, READ_BYTES):
                yield piece
            fresh = False
            data = member.unconsumed_tail
            if member.eof:
                data = member.unused_data
                member, fresh = zlib.decompressobj(wbits=31), True
    while not fresh and not member.eof:
        if not (piece := member.decompress(member.unconsumed_tail, READ_BYTES)):
            raise ValueError("the gzip stream is cut off")
        yield piece


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, wbits=31)
    return packer.compress(data) + packer.flush()


def with_records(pages: DataFrame) -> DataFrame:
    """Adds `digest`, `length`, `kind` and `refers_to` to pages of page_id, url and payload."""
    sized = pages.withColumns({"digest": F.sha1("payload"), "length": F.octet_length("payload").cast("bigint")})
    digests = sized.where(F.col("length") >= LEAST_BYTES).groupBy("digest").agg(
        F.max("page_id").alias("largest"), F.count("*").alias("n")
    )
    # Payloads that occur once need no decision, so only copied digests are joined.
    copied = store(digests.where("n > 1").select("digest", "largest"), "copied_payloads")
    # Few copied digests are sent to the pages; with many the join shuffles and splits hot digests.
    joined = sized.join(bounded(copied, within=copied), "digest", "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select(
        "page_id", "url", "digest", "length",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("largest")).alias("refers_to"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
    )


FILES = "path string, records bigint, bytes bigint"


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the records as monolithic gzip files; returns the list of files, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store_, top = open_store(folder)
        out = path = packer = None
        count = size = 0

        def close() -> pa.RecordBatch:
            out.write(packer.flush())
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": count, "bytes": size}])

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, count, size = f"{top}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    store_.create_dir(top)
                    out, packer = store_.open_output_stream(path, compression=None), zlib.compressobj(FAST, wbits=31)
                target = row["url"] or ""
                out.write(packer.compress(record_bytes(
                    row["kind"], named(row["page_id"]), target.replace("\r", "").replace("\n", ""), row["digest"],
                    row["length"], None if row["refers_to"] is None else named(row["refers_to"]), row["payload"] or b"",
                )))
                count, size = count + 1, size + len(row["payload"] or b"")
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return store(records.mapInArrow(run, FILES), "warc_files")


def named(page_id: object) -> str:
    return "null" if page_id is None else str(page_id)


MEMBERS = "file string, path string, records bigint"
INDEX = "path string, start bigint, size bigint, record_id string"


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite each file with one gzip member a record and an index file beside it; returns the finished files, stored."""
    spark = files.sparkSession
    target, top = open_store(folder)
    target.create_dir(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store_, top = open_store(folder)
        for batch in batches:
            for source in batch.column("path").to_pylist():
                name, at, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                path = f"{top}/{name}"
                with (
                    store_.open_input_stream(source, compression=None) as stream,
                    store_.open_output_stream(path, compression=None) as out,
                    store_.open_output_stream(f"{path}.idx", compression=None) as sidecar,
                ):
                    for headers, _, whole in Reader(inflate(stream)):
                        member = gzip_member(whole, USUAL)
                        out.write(member)
                        place = {"record_id": headers["WARC-Record-ID"], "start": at, "size": len(member)}
                        sidecar.write((json.dumps(place) + "\n").encode())
                        at, count = at + len(member), count + 1
                yield pa.RecordBatch.from_pylist([{"file": f"{name}.idx", "path": path, "records": count}])

    # A file is a unit of work: files are dealt one by one to as many tasks as can run at once.
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    return store(files.select("path").repartition(tasks).mapInArrow(run, MEMBERS), "warc_members")


def read_index(files: DataFrame, folder: str) -> DataFrame:
    """The index of the finished files, from the sidecars in the folder. Others, left by lost attempts, are passed over."""
    reader = files.sparkSession.read.schema("record_id string, start bigint, size bigint")
    lines = reader.option("mode", "FAILFAST").option("pathGlobFilter", "*.idx").json(folder)
    placed = lines.select("*", F.col("_metadata.file_name").alias("file"))
    side = bounded(files.select("file", "path"), within=files)
    return placed.join(side, "file").select("path", "start", "size", "record_id")


RECORDS = "record_id string, kind string, digest string, length bigint, refers_to string, payload binary"


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that the index lists, each read by its offset; digests of payloads are verified.

    `payloads=False` leaves the payload out once it has been verified.
    """

    schema = pa.schema([
        ("record_id", pa.string()), ("kind", pa.string()), ("digest", pa.string()), ("length", pa.int64()),
        ("refers_to", pa.string()), ("payload", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store_, _ = open_store(folder)
        opened, stream, rows, held = None, None, [], 0
        for batch in batches:
            for place in batch.to_pylist():
                if place["path"] != opened:
                    if stream is not None:
                        stream.close()
                    opened, stream = place["path"], store_.open_input_file(place["path"])
                stream.seek(place["start"])
                whole = zlib.decompress(stream.read(place["size"]), wbits=31)
                headers, payload, _ = next(iter(Reader(iter([whole]))))
                if headers["WARC-Record-ID"] != place["record_id"]:
                    raise ValueError(f"the index of {place['path']} does not belong to it")
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                length = int(headers["WARC-Payload-Length"])
                if headers["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, length):
                    raise ValueError(f"{headers['WARC-Record-ID']} differs from its digest")
                refers = headers.get("WARC-Refers-To")
                rows.append({
                    "record_id": unnamed(headers["WARC-Record-ID"]), "kind": headers["WARC-Type"], "digest": digest,
                    "length": length, "refers_to": None if refers is None else unnamed(refers),
                    "payload": payload if payloads else None,
                })
                held += len(payload) if payloads else 0
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, held = [], 0

    return index.mapInArrow(run, RECORDS)


def unnamed(urn: str) -> str:
    return urn.removeprefix("<urn:page:").removesuffix(">")


def archive(pages: DataFrame) -> tuple[DataFrame, str]:
    """Write the pages as archives, normalise them; the index and the folder of the normalised files."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = with_records(pages.select("page_id", "url", payload.alias("payload")))
    spark = pages.sparkSession
    files = write_archives(records, fresh_path(spark, "warc_whole"))
    folder = fresh_path(spark, "warc_members")
    return read_index(normalise(files, folder), folder), folder
