"""Deterministic sharded WARC archives, and their reader.

Records are sorted by page id and split into ranges of equal bytes by exact counts. A task
writes the records of a range; a file that has reached its compressed size is closed and the
next one begun. Files are written under temporary names and renamed when complete. The bytes
depend on the records alone, so a second attempt of a task writes the same file again. The
manifest, a table with a row for each file, is written last: readers open what it lists and nothing else.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careerloom.llm.common import located, shared_folder, written
from careerloom.llm.sharding import HIGHEST, find_ranges, range_of

VERSION = "WARC/1.1"
#: Fixed, so that archives of the same records are the same.
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 6
#: Payload bytes of the records of a task, about, and compressed bytes at which a file is closed.
RANGE_BYTES, ROLL_BYTES = 256 << 20, 1 << 30
#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 0
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the one for URLs
#: Bytes that a record is counted with besides its payload.
HEADER_BYTES = 512
MANIFEST = "file string, records bigint, bytes bigint, sha256 string"


def file_system(folder: str):
    """The store of a folder, and the folder's path in it."""
    from pyarrow.fs import FileSystem

    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    return FileSystem.from_uri(folder)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_line(value: str) -> str:
    """A header's value with control characters percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(headers: dict[str, str | None], block: bytes) -> bytes:
    """A record as a gzip member of its own."""
    lines = [VERSION, *(f"{k}: {one_line(v)}" for k, v in headers.items() if v is not None)]
    lines += [f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", LEVEL, mtime=0)


def record_id(page: str | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, repr((page, url, digest)))}>"


def page_record(page: str | None, url: str | None, payload: bytes, first: tuple | None) -> bytes:
    """A response, or with first (page, url) of the response that holds the same payload, a revisit of it."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = {
        "WARC-Type": "revisit" if first else "response",
        "WARC-Record-ID": record_id(page, url, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "Page-ID": page,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if first:
        headers |= {
            "WARC-Profile": REVISIT,
            "WARC-Refers-To": record_id(*first, digest),
            "WARC-Refers-To-Target-URI": first[1],
            "Refers-To-Page-ID": first[0],
        }
    return record(headers, http.encode() + (b"" if first else payload))


class RollingFile:
    """Files of one range; manifest rows of those that are complete are in `closed`."""

    def __init__(self, folder: str, part: int, roll_bytes: int):
        self.store, self.path = file_system(folder)
        self.part, self.roll_bytes, self.turn, self.stream, self.closed = part, roll_bytes, 0, None, []

    def add(self, data: bytes) -> None:
        if self.stream is None:
            self.name = f"part-{self.part:06d}-{self.turn:04d}.warc.gz"
            self.temporary = f"{self.path}/.{self.name}.{uuid.uuid4().hex}.tmp"
            self.stream = self.store.open_output_stream(self.temporary)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
            self.write(record({
                "WARC-Type": "warcinfo", "WARC-Record-ID": record_id(None, self.name, ""), "WARC-Date": DATE,
                "WARC-Filename": self.name, "Content-Type": "application/warc-fields",
            }, b"format: WARC File Format 1.1\r\n"))
        self.write(data)
        self.records += 1
        if self.bytes >= self.roll_bytes:
            self.close()

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.store.move(self.temporary, f"{self.path}/{self.name}")
            self.closed.append((self.name, self.records, self.bytes, self.sha.hexdigest()))
            self.stream, self.turn = None, self.turn + 1


def with_first(pages: DataFrame, id_col: str, url_col: str, html_col: str, revisit_bytes: int) -> DataFrame:
    """Rows (id, url, payload, size, first): first is the row (id, url) that holds the payload, null if this one does."""
    rows = located(
        pages,
        [
            F.col(id_col).alias("id"),
            F.col(url_col).alias("url"),
            F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
        ],
    ).withColumn("size", F.octet_length("payload").cast("bigint"))
    digest = F.sha2("payload", 256)
    # A row without an id comes after those that have one.
    order = F.struct(F.col("id").isNull().alias("last"), "id", "at_file", "at_row", "url")
    firsts = (
        rows.filter(F.col("size") >= revisit_bytes)
        .groupBy(digest.alias("digest"))
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    firsts = written(firsts, "warc-firsts")
    own = (F.col("first.at_file") == F.col("at_file")) & (F.col("first.at_row") == F.col("at_row"))
    return rows.withColumn("digest", digest).join(firsts, "digest", "left").select(
        "id", "url", "payload", "size", F.when(~own, F.struct("first.id", "first.url")).alias("first")
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    range_bytes: int = RANGE_BYTES,
    roll_bytes: int = ROLL_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Write a record per row into archives under folder, and return the manifest.

    Ids are whole numbers; rows without one come last in the order. Of rows with equal payloads (null: empty) of at
    least revisit_bytes, the one with the smallest id is a response and the others revisit it; smaller payloads
    are all responses. Of rows with that same id, the one stored first is the response. Rows
    without a URL have no target. An empty table gives an empty manifest; other columns aren't read.
    """
    archives = f"{folder}/archives"
    store, path = file_system(archives)
    store.create_dir(path, recursive=True)
    key = F.coalesce(F.col("id").cast("bigint"), F.lit(HIGHEST))
    keys = written(
        pages.select(
            F.coalesce(F.col(id_col).cast("bigint"), F.lit(HIGHEST)).alias("key"),
            (F.coalesce(F.octet_length(html_col), F.lit(0)).cast("bigint") + HEADER_BYTES).alias("size"),
        ),
        "warc-keys",
    )
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = find_ranges(keys, max(1, -(-total // range_bytes)), tolerance=0.01)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, closed = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("part", "id", "url", "payload", "first")]
            for part, page, url, payload, first in zip(*columns, strict=True):
                if file is None or file.part != part.as_py():
                    if file is not None:
                        file.close()
                        closed += file.closed
                    file = RollingFile(archives, part.as_py(), roll_bytes)
                first = first.as_py()
                file.add(page_record(page.as_py(), url.as_py(), payload.as_py(), first and (first["id"], first["url"])))
        if file is not None:
            file.close()
            closed += file.closed
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[k] for c in closed], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["file", "records", "bytes", "sha256"],
        )

    rows = with_first(pages, id_col, url_col, html_col, revisit_bytes)
    rows = rows.withColumn("key", key).withColumn("part", range_of(F.col("key"), ranges, 1)["part"])
    rows = rows.repartition(len(ranges.splitters) + 1, "part").sortWithinPartitions("part", "key", "url", "payload")
    rows = rows.select(
        "part",
        F.col("id").cast("string").alias("id"),
        "url",
        "payload",
        F.when(F.col("first").isNotNull(), F.struct(F.col("first.id").cast("string").alias("id"), "first.url")).alias("first"),
    )
    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def headers_of(stream) -> dict[str, str]:
    found = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed archive; wrong block digests are an error."""
    while line := stream.readline():
        if line.rstrip() != VERSION.encode():
            raise ValueError(f"a record begins with {line[:40]!r}")
        headers = headers_of(stream)
        block = stream.read(int(headers["content-length"]))
        if headers["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
            raise ValueError(f"wrong block digest in {headers['warc-record-id']}")
        stream.read(4)
        yield headers, block


def read_warc(manifest: DataFrame, folder: str, files: int | None = None) -> DataFrame:
    """The records that the manifest lists: id (as text), url, record_type, payload_bytes, payload_digest, refers_to, payload.

    Revisits have no payload of their own; their size is that of the HTTP headers they keep.
    """
    archives = f"{folder}/archives"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(archives)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                out: list[tuple] = []
                with store.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    for headers, block in records_of(gzip.GzipFile(fileobj=raw)):
                        kind = headers["warc-type"]
                        if kind == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = next(
                            int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")
                        )
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and (len(payload), base32_sha1(payload)) != (length, digest):
                            raise ValueError(f"wrong payload in {headers['warc-record-id']}")
                        out.append((
                            headers.get("page-id"), headers.get("warc-target-uri"), kind, length, digest,
                            headers.get("refers-to-page-id"), payload if kind == "response" else None,
                        ))
                        if len(out) == 500:
                            yield to_batch(out)
                            out = []
                yield to_batch(out)

    # Each archive is a task of its own where there are that many.
    tasks = files or max(1, manifest.count())
    return manifest.select("file").repartition(tasks, "file").mapInArrow(
        read,
        "id string, url string, record_type string, payload_bytes bigint, payload_digest string, "
        "refers_to string, payload binary",
    )


def to_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = ["id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)


def warc_folder(spark) -> str:
    return shared_folder(spark, "warc")
