"""Files that still grow, as a stream: SRC-20.

The offset of a trigger is, for each file, who the file is (its inode where the file system has them, a checksum of its first bytes,
and how many files have had its name) and how many of its bytes are read. A trigger takes at most so many lines of a file, never one that has no end yet; a file
that another took the place of is read from its beginning, whether it is longer or shorter. The driver looks for the ends of lines
only; tasks read them.

The engine does not tell a source that is started again how far its checkpoint is, so the last offset that the source gave is kept
in a folder of its own (progress). It is never behind the checkpoint; if it is ahead, since a trigger was planned and not logged,
the next trigger takes the lines of both, so nothing is lost or repeated.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemill.functions.scratch import scratch
from tidemill.plans.registry import query
from tidemill.sources import views as V

HEAD = 256  # bytes that tell a file from one that took its place


def who(uri: str, size: int, head: int | None = None) -> dict:
    """A file's inode (0: none is known) and the checksum of its first `head` bytes (as many as there are, up to HEAD)."""
    fs, path = pafs.FileSystem.from_uri(uri)
    head = min(size, HEAD) if head is None else head
    with fs.open_input_file(path) as f:
        crc = zlib.crc32(f.read(head))
    inode = os.stat(unquote(urlparse(uri).path)).st_ino if isinstance(fs, pafs.LocalFileSystem) else 0
    return {"inode": inode, "head": head, "crc": crc}


def same(uri: str, known: dict, size: int) -> bool:
    """Whether a file is the one that it was, and has at least the bytes that were read."""
    if size < max(known["offset"], known["head"]):
        return False
    now = who(uri, size, known["head"])
    return all(now[k] == known[k] for k in ("inode", "crc"))


def lines_end(uri: str, start: int, rows: int, line_bytes: int) -> int:
    """Where the last of at most `rows` whole lines from start on ends (0: as many as there are; then it is looked for from the end
    of the file). It is an error if one of them is longer than line_bytes."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as f:
        if not rows:
            at = size = f.size()
            while at > start:
                step = min(1 << 16, at - start)
                f.seek(at - step)
                if (k := f.read(step).rfind(b"\n")) >= 0:
                    return at - step + k + 1
                at -= step
                if size - at > line_bytes:
                    raise ValueError(f"a line of {uri} behind {at} is longer than {line_bytes} bytes")
            return start
        f.seek(start)
        at = end = start
        while rows:
            some = f.read(1 << 16)
            if not some:
                break
            k = -1
            while rows and (k := some.find(b"\n", k + 1)) >= 0:
                if at + k + 1 - end > line_bytes:
                    raise ValueError(f"a line of {uri} at {end} is longer than {line_bytes} bytes")
                end, rows = at + k + 1, rows - 1
            at += len(some)
            if rows and at - end > line_bytes:
                raise ValueError(f"a line of {uri} at {end} is longer than {line_bytes} bytes")
        return end


class Stretch(InputPartition):
    """Bytes start to end of a file, as it was when they were found."""

    def __init__(self, uri: str, known: dict, start: int, end: int) -> None:
        self.uri, self.known, self.start, self.end = uri, known, start, end


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        for name in ("path", "progress"):
            if not options.get(name):
                raise ValueError(f"jsonl_tail needs the option {name}")
        self.path, self.suffix = options["path"].rstrip("/"), options.get("suffix", ".jsonl")
        self.rows, self.line_bytes = int(options.get("rows", 256)), int(options.get("line_bytes", 1 << 20))
        self.progress = options["progress"].rstrip("/") + "/offset.json"
        self.last: dict | None = None

    def initialOffset(self) -> dict:
        return {}

    def _files(self) -> dict[str, int]:
        """The files under path, and their sizes."""
        fs, root = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        base = self.path[: len(self.path) - len(root)] if self.path.endswith(root) else self.path.split("://")[0] + "://"
        return {base + x.path: x.size for x in sorted(found, key=lambda x: x.path) if x.type == pafs.FileType.File and x.path.endswith(self.suffix)}

    def _kept(self) -> dict:
        fs, path = pafs.FileSystem.from_uri(self.progress)
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return {}
        with fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def _keep(self, offset: dict) -> None:
        fs, path = pafs.FileSystem.from_uri(self.progress)
        fs.create_dir(os.path.dirname(path), recursive=True)
        with fs.open_output_stream(path + ".new") as f:
            f.write(json.dumps(offset).encode())
        fs.move(path + ".new", path)

    def latestOffset(self) -> dict:
        last = self._kept() if self.last is None else self.last
        new = {}
        for uri, size in self._files().items():
            known = last.get(uri)
            if known is None or not same(uri, known, size):
                known = {**who(uri, size), "offset": 0, "nth": known["nth"] + 1 if known else 0}
            if known["head"] < HEAD and size > known["head"]:
                known = {**known, **who(uri, size)}
            new[uri] = {**known, "offset": lines_end(uri, known["offset"], self.rows, self.line_bytes) if size > known["offset"] else known["offset"]}
        if new != last:
            self._keep(new)
        self.last = new
        return new

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for uri, known in end.items():
            before = start.get(uri)
            at = before["offset"] if before is not None and before["nth"] == known["nth"] and before["inode"] == known["inode"] else 0
            if known["offset"] > at:
                out.append(Stretch(uri, known, at, known["offset"]))
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(partition.uri)
        info = fs.get_file_info(path)
        if info.type != pafs.FileType.File or not same(partition.uri, partition.known, info.size):
            return  # another file took its place, and these bytes are gone
        with fs.open_input_file(path) as f:
            f.seek(partition.start)
            at, left, todo = partition.start, b"", partition.end - partition.start
            while todo:
                some = f.read(min(1 << 20, todo))
                todo -= len(some)
                lines = (left + some).split(b"\n")
                left, ends = lines.pop(), []
                if max(map(len, (*lines, left))) >= self.line_bytes:
                    raise ValueError(f"a line of {partition.uri} behind {at} is longer than {self.line_bytes} bytes")
                for x in lines:
                    at += len(x) + 1
                    ends.append(at)
                yield pa.RecordBatch.from_arrays([pa.array([partition.uri] * len(lines), pa.string()), pa.array(ends, pa.int64()), pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())], ["uri", "offset", "value"])


class JsonlTail(DataSource):
    """Options: path (a folder's URI, read with what is below it), progress (a folder's URI of its own), suffix, rows (of a file in
    a trigger; 0: all there are), line_bytes (the longest line allowed, its end included)."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_tail"

    def schema(self) -> str:
        return "uri string, offset long, value string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))


def tail_stream(spark: SparkSession, path: str, progress: str, rows: int = 256, suffix: str = ".jsonl", line_bytes: int = 1 << 20) -> DataFrame:
    """SRC-20: the lines of growing files as a stream: uri, offset (where the line ends), value. See JsonlTail for the options."""
    spark.dataSource.register(JsonlTail)
    options = {"path": path, "progress": progress, "rows": str(rows), "suffix": suffix, "line_bytes": str(line_bytes)}
    return spark.readStream.format("jsonl_tail").options(**options).load()


@query("src20_tail_stream", "SELECT event_id, user_id % 8 AS token, value FROM events")
def src20(spark: SparkSession, d: str) -> DataFrame:
    """The events as files of JSON lines, read by a stream in one go and parsed."""
    folder = scratch(spark, "tail")
    rows = V.events(spark, d).select("event_id", (F.col("user_id") % 8).alias("token"), "value")
    rows.select(F.to_json(F.struct("*"))).write.text(f"{folder}/in")
    lines = tail_stream(spark, f"{folder}/in", f"{folder}/progress", rows=0, suffix=".txt")
    lines.writeStream.option("checkpointLocation", f"{folder}/mark").trigger(availableNow=True).format("parquet").start(f"{folder}/out").awaitTermination()
    return spark.read.schema("uri string, offset long, value string").parquet(f"{folder}/out").select(F.from_json("value", "event_id long, token long, value double").alias("j")).select("j.*")
