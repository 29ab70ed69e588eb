"""WARC archives, and their chunked record table.

``write_archives`` writes one gzip member per record into archives of about ``ARCHIVE_BYTES``, in the
tasks that hold the rows, and returns their manifest, written once: a task that runs again writes new
files, and only those of the manifest are read. Of records with equal payloads, one carries the payload
and the others revisit it.

``read_chunks`` streams the archives: whatever a record's size, a task holds one chunk of it. A row is a
record identifier, a chunk number, where the chunk starts and the SHA-1 of the payload so far; the last
chunk has the digest of the whole. Archives lie in a folder that executors reach by the file systems
pyarrow knows (local and mounted folders, HDFS, S3, GCS).

Payloads cross the network once, with the decision about their record. Equal payloads are found from
their SHA-256 and size; a group of any size keeps one maximum, combined map-side.

Defined results: a null payload is empty; a null or empty address becomes ``urn:page:<id>``; line ends in
an address are escaped; a null page id is below all others, and rows that repeat the id and the payload
of the response are responses, too; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import doc_key, id_of, stage
from shelfmark.storage import new_folder

CHUNK_BYTES = 1 << 16
ARCHIVE_BYTES = 64_000_000
LEVEL = 4
#: Pages carry no time of their capture.
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def record_name(page: int, digest: bytes) -> str:
    """Record identifier, the same on every run."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(b'%d ' % page + digest).digest())}>"


def _head(fields: list[tuple[str, str]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode("utf-8", "surrogatepass")


def write_record(out: BinaryIO, page: int, url: str | None, payload: bytes, sha1: bytes, refers: int | None) -> int:
    """Write a record, chunk by chunk, as one gzip member; its compressed size. ``refers`` makes it a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = b"" if refers is not None else payload
    fields = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_name(page, sha1)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", (url or f"urn:page:{page}").replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()),
        ("Page-ID", str(page)),
    ]
    if refers is not None:
        fields += [("WARC-Refers-To", record_name(refers, sha1)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(http) + len(body)))]
    packer, written = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
    view = memoryview(body)
    parts = [_head(fields), http, *(view[i : i + CHUNK_BYTES] for i in range(0, len(body), CHUNK_BYTES)), END]
    for part in parts:
        data = packer.compress(part)
        written += len(data)
        out.write(data)
    data = packer.flush()
    out.write(data)
    return written + len(data)


def plan(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """(page, url, payload, refers): ``refers`` is the page whose record a revisit names, else null."""
    payload = F.encode(F.coalesce(pages[payload_col].cast("string"), F.lit("")), "utf-8")
    keys = pages.select(
        doc_key(pages[id_col]).alias("page"), F.sha2(payload, 256).alias("sha"), F.octet_length(payload).alias("size")
    )
    groups = keys.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(
        F.max("page").alias("keep"), F.count(F.lit(1)).alias("n")
    )
    groups = stage(groups.filter("n > 1").select("sha", "keep"), "equal-payloads")
    rows = pages.select(
        doc_key(pages[id_col]).alias("page"), pages[url_col].cast("string").alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("sha"),
    )
    refers = F.when(F.col("keep") != F.col("page"), F.col("keep"))
    return rows.join(groups, "sha", "left").select("page", "url", "payload", refers.alias("refers"))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> DataFrame:
    """The written manifest (path, records, bytes) of the archives in ``folder``."""
    records = plan(pages, id_col, url_col, payload_col, min_bytes)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        files, root = FileSystem.from_uri(folder)
        files.create_dir(root)
        out, path, count, size, done = None, "", 0, 0, []
        try:
            for rows in batches:
                for row in rows.itertuples(index=False):
                    if out is None:
                        path, count, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = files.open_output_stream(f"{root}/{path.rpartition('/')[2]}", compression=None)
                    refers = None if pd.isna(row.refers) else int(row.refers)
                    size += write_record(out, int(row.page), row.url, row.payload, hashlib.sha1(row.payload).digest(), refers)
                    count += 1
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                        done.append((path, count, size))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((path, count, size))
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    # refers is nullable: keep it exact as text on its way through pandas.
    sent = records.withColumn("refers", F.col("refers").cast("string"))
    return stage(sent.mapInPandas(write, "path string, records long, bytes long"), "warc-manifest")


class _Member:
    """The bytes of an archive, unpacked as they are asked for."""

    def __init__(self, source: BinaryIO):
        self.source, self.unpacker, self.held = source, zlib.decompressobj(31), b""

    def more(self) -> bool:
        data = self.unpacker.unconsumed_tail or self.unpacker.unused_data
        if self.unpacker.eof:
            self.unpacker = zlib.decompressobj(31)
        data = data or self.source.read(CHUNK_BYTES)
        if not data:
            return False
        self.held += self.unpacker.decompress(data, CHUNK_BYTES)
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                return None
        found, self.held = self.held[:at], self.held[at + len(mark) :]
        return found

    def take(self, size: int) -> bytes:
        while not self.held:
            if not self.more():
                raise EOFError("the archive ends inside a record")
        found, self.held = self.held[:size], self.held[size:]
        return found


def chunks_of(source: BinaryIO, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """Chunk rows of an archive, in order; at most one chunk is held."""
    stream = _Member(source)
    while (head := stream.until(END)) is not None:
        lines = head.decode("utf-8", "surrogatepass").lstrip("\r\n").split("\r\n")
        field = dict(line.split(": ", 1) for line in lines[1:])
        http = stream.until(END)
        left = int(field["Content-Length"]) - len(http) - len(END)
        record = {
            "record_id": field["WARC-Record-ID"], "record_type": field["WARC-Type"], "page": int(field["Page-ID"]),
            "refers_record": field.get("WARC-Refers-To"), "declared": field["WARC-Payload-Digest"].removeprefix("sha1:"),
        }
        digest, number, start = hashlib.sha1(), 0, 0
        while True:
            data, size = [], 0
            while size < chunk_bytes and left:
                part = stream.take(min(left, chunk_bytes - size))
                data.append(part)
                size += len(part)
                left -= len(part)
            data = b"".join(data)
            digest.update(data)
            yield record | {
                "chunk": number, "start": start, "size": size, "sha1": base64.b32encode(digest.digest()).decode(),
                "last": not left, "data": data,
            }
            number, start = number + 1, start + size
            if not left:
                break
        if stream.until(END) is None:
            raise EOFError("the archive ends inside a record")


CHUNK_SCHEMA = (
    "record_id string, record_type string, page long, refers_record string, declared string, chunk long, "
    "start long, size long, sha1 string, last boolean, data binary"
)


def read_chunks(manifest: DataFrame, with_data: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of the archives in ``manifest``; ``data`` is null without ``with_data``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        for rows in batches:
            for path in rows["path"]:
                files, name = FileSystem.from_uri(path)
                with files.open_input_stream(name, compression=None) as source:
                    held, size = [], 0
                    for chunk in chunks_of(source, chunk_bytes):
                        held.append(chunk if with_data else chunk | {"data": None})
                        size += chunk["size"] if with_data else 1
                        if size >= 1 << 22 or len(held) >= 5000:
                            yield pd.DataFrame(held)
                            held, size = [], 0
                    if held:
                        yield pd.DataFrame(held)

    archives = manifest.filter("records > 0").select("path")
    # A number of partitions that is given is kept; the adaptive plan would put all short paths into one.
    return archives.repartition(max(archives.count(), 1), "path").mapInPandas(read, CHUNK_SCHEMA)


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's payload is that of the record it names; a digest that differs from the declared one is null.
    """
    ends = chunks.filter("last").select(
        "record_id", "record_type", "page", "refers_record", "declared", (F.col("start") + F.col("size")).alias("bytes"), "sha1"
    )
    ends = stage(ends, "warc-records")
    target = ends.filter("record_type = 'response'").dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_record"), F.col("page").alias("to"),
        F.col("bytes").alias("to_bytes"), F.col("sha1").alias("to_sha1"),
    )
    own = F.col("record_type") == "response"
    joined = ends.join(stage(target, "warc-responses"), "refers_record", "left")
    digest = F.when(own, F.col("sha1")).otherwise(F.col("to_sha1"))
    return joined.select(
        id_of(F.col("page")).alias("page_id"),
        F.when(own, F.col("bytes")).otherwise(F.col("to_bytes")).alias("payload_bytes"),
        F.when(digest == F.col("declared"), digest).alias("payload_digest"),
        "record_type",
        F.when(~own, id_of(F.col("to"))).alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages as archives in the shared folder, read them back, one row per record."""
    spark = pages.sparkSession
    return records_of(read_chunks(write_archives(pages, new_folder(spark, "warc"), **options), with_data=False))
