"""Token ids in files of patched frame-of-reference blocks.

A block holds 256 ids: the least of them, and what each has beyond it, packed at the number of bits that a given percentile
of them needs; the others - the exceptions - keep their high bits in a list of places and values. Packed words are laid out in
eight lanes, so that packing and unpacking are a few vector operations for all blocks of a width. A file is

    magic | blocks | document ids, null flags, lengths | start of each block | footer

in little-endian order; a block is 32-bit words: least, (bits | ids << 8 | exceptions << 17), 8 x bits words, the exceptions'
places (a byte each, filled up to a word), their high bits. The index of block starts gives any range of ids without the
blocks before it.

Documents are dealt by ranges of their ids, so files follow each other in that order; a task streams its documents into files
named after its attempt. Only files named in the results of successful attempts, which are written as a table, are read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm import kernels as K
from tidemill.llm.packing import tokenizer
from tidemill.llm.shared import documents, shared_dir, text_bytes, written

BLOCK, LANES = 256, 8
ROUNDS = BLOCK // LANES
MAGIC = b"TIDEIDS1"
FOOTER = struct.Struct("<QQQQQ8s")  # ids, documents, blocks, where the documents begin, where the index begins, magic
CHUNK = 1 << 20  # ids packed or unpacked at a time


def pack(ids: np.ndarray, percentile: float = 0.9) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of ids as 32-bit words, and the word at which each begins."""
    n = -(-len(ids) // BLOCK)
    held = np.full(n, BLOCK, np.int64)
    if n:
        held[-1] = len(ids) - BLOCK * (n - 1)
    grid = np.empty(n * BLOCK, np.uint32)
    grid[: len(ids)] = ids
    grid[len(ids) :] = ids[-1] if len(ids) else 0
    grid = grid.reshape(n, BLOCK)
    least = grid.min(1, initial=0xFFFFFFFF)
    over = grid - least[:, None]
    at = min(BLOCK - 1, int(percentile * BLOCK))
    bits = np.frexp(np.partition(over, at, axis=1)[:, at].astype(np.float64))[1].astype(np.int64) if n else held
    high = (over.astype(np.uint64) >> bits[:, None].astype(np.uint64)).astype(np.uint32)
    row, place = np.nonzero(high)
    exceptions = np.bincount(row, minlength=n)
    size = 2 + LANES * bits + -(-exceptions // 4) + exceptions
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), "<u4")
    out[start] = least
    out[start + 1] = bits | held << 8 | exceptions << 17
    for w in np.unique(bits[bits > 0]).tolist():
        own = np.flatnonzero(bits == w)
        value = (over[own] & np.uint32((1 << w) - 1)).reshape(len(own), ROUNDS, LANES).transpose(1, 0, 2).copy()
        lanes = np.zeros((w, len(own), LANES), np.uint32)
        for r in range(ROUNDS):
            word, shift = r * w >> 5, r * w & 31
            lanes[word] |= value[r] << np.uint32(shift)
            if shift + w > 32:
                lanes[word + 1] |= value[r] >> np.uint32(32 - shift)
        out[(start[own] + 2)[:, None] + np.arange(w * LANES)] = lanes.transpose(1, 0, 2).reshape(len(own), -1)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        list_at = (start + 2 + LANES * bits)[row]
        out.view(np.uint8)[4 * list_at + nth] = place
        out[list_at + (-(-exceptions // 4))[row] + nth] = high[row, place]
    return out, start


def unpack(words: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at these words."""
    n = len(start)
    head = words[start + 1].astype(np.int64)
    bits, held, exceptions = head & 255, head >> 8 & 511, head >> 17
    out = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(bits[bits > 0]).tolist():
        own = np.flatnonzero(bits == w)
        lanes = words[(start[own] + 2)[:, None] + np.arange(w * LANES)].reshape(len(own), w, LANES).transpose(1, 0, 2).copy()
        value = np.empty((ROUNDS, len(own), LANES), np.uint32)
        mask = np.uint32((1 << w) - 1)
        for r in range(ROUNDS):
            word, shift = r * w >> 5, r * w & 31
            value[r] = lanes[word] >> np.uint32(shift)
            if shift + w > 32:
                value[r] |= lanes[word + 1] << np.uint32(32 - shift)
            value[r] &= mask
        out[own] = value.transpose(1, 0, 2).reshape(len(own), BLOCK)
    if exceptions.any():
        row = np.repeat(np.arange(n), exceptions)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        list_at = (start + 2 + LANES * bits)[row]
        place = words.view(np.uint8)[4 * list_at + nth]
        high = words[list_at + (-(-exceptions // 4))[row] + nth].astype(np.uint64)
        out[row, place] |= (high << bits[row].astype(np.uint64)).astype(np.uint32)
    out += words[start][:, None]
    return out.ravel() if not n or held.min() == BLOCK else out[np.arange(BLOCK) < held[:, None]]


def packed(ids: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as one string: how many blocks, where each begins, the blocks."""
    words, start = pack(ids)
    return np.concatenate([[len(start)], start]).astype("<u4").tobytes() + words.tobytes()


def unpacked(raw: bytes | memoryview) -> np.ndarray:
    words = np.frombuffer(raw, "<u4")
    n = int(words[0])
    return unpack(words[n + 1 :], words[1 : n + 1].astype(np.int64))


class Writer:
    """A file of blocks, written as ids come."""

    def __init__(self, out: pa.NativeFile, percentile: float) -> None:
        self.out, self.percentile, self.at = out, percentile, len(MAGIC)
        self.waiting, self.n_waiting, self.ids = [], 0, 0
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.starts: list[np.ndarray] = []
        out.write(MAGIC)

    def add(self, doc: int | None, ids: bytes) -> None:
        self.docs.append(doc)
        self.lengths.append(len(ids) // 4)
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= CHUNK:
            self._flush(self.n_waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        for a in range(0, n, CHUNK):  # whole blocks, but for the file's last ones
            words, start = pack(ids[a : min(n, a + CHUNK)], self.percentile)
            self.starts.append(self.at + 4 * start)
            self.out.write(words.tobytes())
            self.at += 4 * len(words)
        self.ids += n
        self.waiting, self.n_waiting = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> int:
        """Writes what is left, the documents and the index; the file's bytes."""
        self._flush(self.n_waiting)
        known = np.array([d is not None for d in self.docs], bool)
        ids = np.array([d or 0 for d in self.docs], "<i8")
        index = np.concatenate([np.zeros(0, np.int64), *self.starts]).astype("<u8")
        tail = ids.tobytes() + np.packbits(known).tobytes() + np.array(self.lengths, "<u8").tobytes()
        end = FOOTER.pack(self.ids, len(self.docs), len(index), self.at, self.at + len(tail), MAGIC)
        self.out.write(tail + index.tobytes() + end)
        self.out.close()
        return self.at + len(tail) + index.nbytes + len(end)


class Contents(NamedTuple):
    doc: np.ndarray
    known: np.ndarray
    length: np.ndarray
    start: np.ndarray
    end: int


def contents(f: pa.NativeFile) -> Contents:
    """A file's documents and block starts."""
    size = f.size()
    f.seek(size - FOOTER.size)
    _, n_docs, n_blocks, docs_at, index_at, magic = FOOTER.unpack(f.read(FOOTER.size))
    if magic != MAGIC:
        raise ValueError("not a file of token blocks, or not a whole one")
    f.seek(docs_at)
    raw = f.read(index_at - docs_at)
    flags = -(-n_docs // 8)
    known = np.unpackbits(np.frombuffer(raw, np.uint8, flags, 8 * n_docs), count=n_docs).astype(bool)
    index = np.frombuffer(f.read(8 * n_blocks), "<u8").astype(np.int64)
    return Contents(np.frombuffer(raw, "<i8", n_docs), known, np.frombuffer(raw, "<u8", n_docs, 8 * n_docs + flags).astype(np.int64), index, docs_at)


def blocks(f: pa.NativeFile, start: np.ndarray, end: int, first: int, last: int) -> np.ndarray:
    """The ids of blocks first to last - 1 of a file whose blocks start there and end at end."""
    stop = int(start[last]) if last < len(start) else end
    f.seek(int(start[first]))
    return unpack(np.frombuffer(f.read(stop - int(start[first])), "<u4"), (start[first:last] - start[first]) // 4)


def _write(folder: str, path: str, end_id: int, percentile: float, roll: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, tok, end = TaskContext.get(), tokenizer(path), end_id.to_bytes(4, "little")
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        files: list[tuple] = []
        to: Writer | None = None
        name = ""
        done = lambda: files.append((name, task.partitionId(), len(files), len(to.docs), to.ids + to.n_waiting, to.close()))
        for batch in batches:
            for a, b, _, _ in K.parts(batch.column(1)):
                for doc, ids in zip(batch.column(0).slice(a, b - a).to_pylist(), tok.encode(batch.column(1).slice(a, b - a).to_pylist())):
                    if to is None:
                        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(files):04d}.ids"
                        to = Writer(fs.open_output_stream(f"{root}/{name}"), percentile)
                    to.add(doc, ids + end)
                    if to.ids >= roll:
                        done()
                        to = None
        if to is not None:
            done()
        columns = zip(*files) if files else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), *[pa.int64()] * 5))], ["file", "part", "nth", "docs", "ids", "bytes"])

    return run


def write_ids(docs: DataFrame, path: str | None = None, folder: str | None = None, end_id: int = 1, percentile: float = 0.9, task_bytes: int = 32 << 20, roll: int = 1 << 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenises documents, writes their ids in ascending order of document id, and returns the table of the files: file, docs,
    ids, bytes, first (the ids in the files before it).

    Each document's ids end with end_id. Null and empty texts are that id alone. Null ids come first; rows of one id follow each
    other in the input's order, repeated rows too, and may be spread over tasks and files. An empty table writes no file. Very
    long texts are tokenised whole, one in memory at a time. Ids are whole numbers; columns beside id and text are not read, so
    their names can't clash. A folder that is given is the caller's and stays; else it is one in the shared folder that ends
    with the session. task_bytes: of text for a task; roll: ids beyond which a file is closed; path: the tokenizer's file.
    """
    spark = docs.sparkSession
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    own = folder is None
    folder = folder or f"{shared_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    total, _ = text_bytes(docs, text_col)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"), F.monotonically_increasing_id().alias("_at"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    ranged = rows.repartitionByRange(tasks, "_id", "_at").sortWithinPartitions("_id", "_at").select("_id", "_text")
    kinds = "file string, part long, nth long, docs long, ids long, bytes long"
    done = written(ranged.mapInArrow(_write(folder, path, end_id, percentile, roll), kinds), "ids-files")
    if own:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return numbered(done).withColumn("file", F.concat(F.lit(folder.rstrip("/") + "/"), "file")).select("file", "docs", "ids", "bytes", "first")


def numbered(files: DataFrame) -> DataFrame:
    """Adds first, the ids in the files before: sums over thousands of parts, then within a part."""
    parts = files.groupBy(F.shiftright("part", 10).alias("_far"), "part").agg(F.sum("ids").alias("_n"))
    far = parts.groupBy("_far").agg(F.sum("_n").alias("_m"))
    far = far.select("_far", F.coalesce(F.sum("_m").over(Window.orderBy("_far").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_a"))
    near = parts.select("_far", "part", F.coalesce(F.sum("_n").over(Window.partitionBy("_far").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    own = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("_c", own).join(near.join(far, "_far").drop("_far"), "part").withColumn("first", (F.col("_a") + F.col("_b") + F.col("_c")).cast("long")).drop("_a", "_b", "_c")


def _read(with_ids: bool, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for uri, at in zip(given.column(0).to_pylist(), given.column(1).to_pylist()):
                fs, path = pafs.FileSystem.from_uri(uri)
                with fs.open_input_file(path) as f:
                    c = contents(f)
                    rows, size, doc, crc, left, got = [], 0, 0, 0, int(c.length[0]) if len(c.doc) else 0, []
                    for k in range(0, len(c.start), CHUNK // BLOCK):
                        raw = memoryview(blocks(f, c.start, c.end, k, min(len(c.start), k + CHUNK // BLOCK)).tobytes())
                        while raw:
                            piece, raw = raw[: 4 * left], raw[4 * left :]
                            crc, left = zlib.crc32(piece, crc), left - len(piece) // 4
                            if with_ids:
                                got.append(piece)
                            if not left:
                                rows.append((int(c.doc[doc]) if c.known[doc] else None, at, int(c.length[doc]), crc, b"".join(got) if with_ids else None))
                                size += 40 + 4 * int(c.length[doc]) * with_ids
                                at, doc, crc, got = at + int(c.length[doc]), doc + 1, 0, []
                                left = int(c.length[doc]) if doc < len(c.doc) else 0
                        if size > most:
                            yield batch(rows)
                            rows, size = [], 0
                    yield batch(rows)

    return run


def read_ids(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """A row per document of the files in files(file, first): doc_id, start (the ids before it in all files), n_tokens, ids_crc32
    (of its ids as little-endian unsigned 32-bit integers), ids (those bytes; null with with_ids=False, though all are read)."""
    n = max(1, min(100_000, files.count()))
    return files.select("file", "first").repartitionByRange(n, "first").mapInArrow(_read(with_ids, 4 << 20), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def op12_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ids(write_ids(documents(spark, sf_dir)), with_ids=False).drop("ids")


QUERIES = {"op12_token_blocks": op12_token_blocks}
