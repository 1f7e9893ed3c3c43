"""WARC archives as a chunked record table.

Writing: a task streams its rows into archives of one gzip member per record, in the folder that all executors share. A
file's name holds the task attempt; only files named in the results of successful attempts are read, so lost executors
and repeated attempts leave nothing that counts. Reading: a task streams an archive member by member and yields rows
(record, chunk number) of at most chunk_bytes each with the running SHA-1 of the payload so far: no record is ever held
whole, and the last chunk of a record has its digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.shared import shared_dir, written

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record_id string, page_id long, record_type string, refers_to long, chunk_no long, offset long, data binary, digest string, last boolean, payload_bytes long, stated_digest string"
_URN = "urn:tidemill:page:"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight groups of five hex digits, each four letters of the alphabet."""
    hexed = F.sha1(payload)
    group = lambda i: F.conv(F.substr(hexed, 5 * i + 1, F.lit(5)), 16, 10).cast("int")
    letter = lambda v, shift: F.substr(F.lit(ALPHABET), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.concat(*[letter(group(i), s) for s in (15, 10, 5, 0)])), "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The head of a WARC record up to its payload: response, or revisit where refers_to is given."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    own = "" if page_id is None else str(page_id)
    target = "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url or "about:blank")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_URN}{own}>",
        f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {REVISIT}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (0 if revisit else len(payload))}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http


def _write(folder: str, roll: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        files: list[list] = []
        out = None
        for batch in batches:
            ids, urls, digests, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for i, x in enumerate(batch.column(2)):
                body = memoryview(x.as_buffer()) if x.is_valid else memoryview(b"")
                if out is None or files[-1][2] >= roll:
                    if out is not None:
                        out.close()
                    name = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(files):04d}.warc.gz"
                    out = fs.open_output_stream(name)
                    files.append([name, 0, 0])
                gz, size = zlib.compressobj(1, zlib.DEFLATED, 31), 0
                pieces = (body[k : k + (1 << 20)] for k in range(0, len(body) if refers[i] is None else 0, 1 << 20))
                for piece in chain([record(ids[i], urls[i], body, digests[i], refers[i])], pieces, [b"\r\n\r\n"]):
                    size += out.write(gz.compress(piece))  # each piece goes out as it is made
                size += out.write(gz.flush())
                files[-1][1] += 1
                files[-1][2] += size
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64()), pa.array([f[2] for f in files], pa.int64())], ["file", "records", "bytes"])

    return run


def write_warc(records: DataFrame, folder: str | None = None, roll_bytes: int = 256 << 20) -> DataFrame:
    """Writes records(id, url, payload binary, digest, refers_to) and returns the table of the files: file, records, bytes.

    A record with refers_to is a revisit without payload. Files are closed beyond roll_bytes. A folder that is given is the
    caller's and stays; else it is one in the shared folder that ends with the session.
    """
    spark = records.sparkSession
    own = folder is None
    folder = folder or f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    rows = records.select(F.col("id").cast("long"), F.col("url").cast("string"), F.col("payload").cast("binary"), F.col("digest").cast("string"), F.col("refers_to").cast("long"))
    done = written(rows.mapInArrow(_write(folder, roll_bytes), "file string, records long, bytes long"), "warc-files")
    if own:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return done.withColumn("file", F.concat(F.lit(folder.rstrip("/")), F.regexp_extract("file", r"/[^/]*$", 0)))


class Members:
    """A byte stream over all gzip members of a file, read in pieces."""

    def __init__(self, raw: BinaryIO, piece: int = 1 << 16) -> None:
        self.raw, self.piece, self.gz, self.held, self.left = raw, piece, None, b"", b""

    def _more(self) -> bool:
        while True:
            if not self.left:
                self.left = self.raw.read(self.piece)
                if not self.left:
                    return False
            if self.gz is None:
                self.gz = zlib.decompressobj(31)
            got = self.gz.decompress(self.left, 1 << 20)
            self.left = self.gz.unconsumed_tail or self.gz.unused_data
            if self.gz.eof:
                self.gz = None
            if got:
                self.held += got
                return True

    def upto(self, end: bytes) -> bytes | None:
        """Through the next occurrence of end, however far; None at the end of the stream."""
        seen = 0
        while (at := self.held.find(end, seen)) < 0:
            seen = max(0, len(self.held) - len(end) + 1)
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends within a record")
                return None
        out, self.held = self.held[: at + len(end)], self.held[at + len(end) :]
        return out

    def some(self, most: int) -> bytes:
        if not self.held and not self._more():
            raise ValueError("the archive ends within a record")
        out, self.held = self.held[:most], self.held[most:]
        return out


def chunks(raw: BinaryIO, chunk_bytes: int = 1 << 20) -> Iterator[tuple[dict[str, str], int, int, bytes, str, bool]]:
    """(headers, chunk number, offset, data, base32 SHA-1 of the payload so far, last) for each chunk of each record."""
    stream = Members(raw)
    while (head := stream.upto(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").strip().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        left = int(headers["content-length"])
        if headers.get("content-type", "").startswith("application/http"):
            left -= len(stream.upto(b"\r\n\r\n") or b"")
        sha, no, at, data = hashlib.sha1(), 0, 0, bytearray()
        while True:
            while left and len(data) < chunk_bytes:
                got = stream.some(min(left, chunk_bytes - len(data)))
                left -= len(got)
                data += got
            sha.update(data)
            yield headers, no, at, bytes(data), base64.b32encode(sha.digest()).decode(), not left
            no, at, data = no + 1, at + len(data), bytearray()
            if not left:
                break
        stream.upto(b"\r\n\r\n")


def _read(chunk_bytes: int, with_data: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    number = lambda urn: int(x) if (x := urn.strip("<>").removeprefix(_URN)).lstrip("-").isdigit() else None
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.bool_(), pa.int64(), pa.string()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for uri in files.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(uri)
                rows, held = [], 0
                with fs.open_input_stream(path, buffer_size=1 << 20) as raw:
                    for h, no, at, data, digest, last in chunks(raw, chunk_bytes):
                        rid = h.get("warc-record-id", "")
                        rows.append((rid, number(rid), h.get("warc-type"), number(h["warc-refers-to"]) if "warc-refers-to" in h else None, no, at, data if with_data else None, digest, last, at + len(data), h.get("warc-payload-digest", "").removeprefix("sha1:")))
                        held += len(data) if with_data else 1000
                        if held > 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                yield batch(rows)

    return run


def read_warc(files: DataFrame, chunk_bytes: int = 1 << 20, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives named in files.file. payload_bytes: bytes up to this chunk's end.

    with_data=False leaves data null where only digests are asked for; the payload is streamed and hashed all the same.
    """
    spread = files.select("file").repartition(max(1, min(100_000, files.count())), "file")
    return spread.mapInArrow(_read(chunk_bytes, with_data), CHUNKS)


def archive_pages(pages: DataFrame, least_revisit: int = 0, folder: str | None = None) -> DataFrame:
    """Writes a WARC record per row of pages(page_id, url, html) and returns the files' table, as write_warc does.

    Of rows with equal payloads of least_revisit bytes or more that with the least page_id is the response, the others
    revisit it. Null html: an empty payload. Null ids are responses. Repeated rows with the least id are responses each. Urls and
    payloads of any length are written and read whole. An empty table writes no file. Columns beside page_id, url and html are not
    read, so their names can't clash.
    """
    base = pages.select(F.col("page_id").alias("id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload")).withColumn("digest", base32_sha1(F.col("payload")))
    known = base.where((F.octet_length("payload") >= least_revisit) & F.col("id").isNotNull()).select("id", "digest")
    first = known.groupBy("digest").agg(F.min("id").alias("refers_to"), F.max("id").alias("far")).where("refers_to != far").drop("far")
    again = known.join(first, "digest").where("id != refers_to").select("id", F.col("digest"), "refers_to").distinct()
    return write_warc(base.join(again, ["id", "digest"], "left").select("id", "url", "payload", "digest", "refers_to"), folder)


def records(files: DataFrame) -> DataFrame:
    """A row per record read back: page_id, payload_bytes, payload_digest, record_type, refers_to; revisits have the
    size of the response that they refer to, and it is an error if that one's payload is not what they state."""
    last = written(read_warc(files, with_data=False).where("last").select("page_id", "record_type", "refers_to", "digest", "payload_bytes", "stated_digest"), "records")
    full = last.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("digest").alias("own"), F.col("payload_bytes").alias("size")).dropDuplicates(["refers_to", "own"])
    again = last.where("record_type = 'revisit'")
    revisits = again.join(full, (again["refers_to"] == full["refers_to"]) & (again["stated_digest"] == full["own"]), "left").select(again["*"], "own", "size")
    lost = F.raise_error(F.concat(F.lit("the response that a revisit refers to has another payload or is missing: "), F.coalesce(F.col("refers_to").cast("string"), F.lit("?"))))
    revisits = revisits.withColumn("size", F.when(F.col("own").isNotNull(), F.col("size")).otherwise(lost.cast("long")))
    out = lambda df, size, digest: df.select("page_id", F.col(size).alias("payload_bytes"), F.col(digest).alias("payload_digest"), "record_type", "refers_to")
    return out(last.where("record_type = 'response'"), "payload_bytes", "digest").unionByName(out(revisits, "size", "own"))


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")))


SQL = {
    "op1_warc_chunks": r"""
WITH h AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
v AS (SELECT page_id, payload_bytes, x, list_transform(range(0, 8), lambda i: CAST('0x' || substr(x, 5 * i + 1, 5) AS BIGINT)) AS g FROM h),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(g, lambda v: array_to_string(list_transform([15, 10, 5, 0],
        lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((v >> s) & 31 AS INT), 1)), '')), '') AS payload_digest FROM v),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = f OR page_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f THEN f END AS refers_to FROM f
"""
}
QUERIES = {"op1_warc_chunks": op1_warc_chunks}
