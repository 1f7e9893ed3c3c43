"""TIFF pages: walk the image directories of a file, decode its strips or tiles, undo predictors, one row per page.

Compression: none (1), LZW (5), deflate (8, 32946), PackBits (32773). Predictors: none (1), horizontal differences (2).
Strips and tiles, 8 and 16 bits a sample, interleaved samples, both byte orders. A page that can't be read is a row with
its error; the pages before it stand.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.shared import documents

# Fixed values of the format: tags, field sizes, compression schemes.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES = 317, 322, 323, 324, 325
FIELD = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4)}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
CLEAR, END = 256, 257


class Page(NamedTuple):
    page: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    predictor: int
    tiled: bool
    pixels: bytes | None
    error: str | None


def lzw_encode(data: bytes) -> bytes:
    out, acc, held, width = bytearray(), CLEAR, 9, 9
    table: dict[int, int] = {}
    code, free = -1, 258
    for c in data:
        if code < 0:
            code = c
            continue
        key = code << 8 | c
        known = table.get(key)
        if known is not None:
            code = known
            continue
        acc, held = acc << width | code, held + width
        table[key] = free
        free += 1
        if free + 1 > 1 << width:
            width += 1
        if free == 4094:
            acc, held, width, free = acc << 12 | CLEAR, held + 12, 9, 258
            table = {}
        code = c
        if held > 512:
            keep = held & 7
            out += (acc >> keep).to_bytes(held >> 3, "big")
            acc, held = acc & (1 << keep) - 1, keep
    if code >= 0:
        acc, held, free = acc << width | code, held + width, free + 1
        if free + 1 > 1 << width and width < 12:
            width += 1
    acc, held = acc << width | END, held + width
    pad = -held & 7
    return bytes(out + (acc << pad).to_bytes(held + pad >> 3, "big"))


def lzw_decode(data: bytes, most: int) -> bytes:
    base = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, size, last = base[:], [], 0, None
    acc = held = at = 0
    width = 9
    while size < most:
        while held < width:
            step = data[at : at + 32]
            if not step:
                return b"".join(out)
            acc, held, at = acc << 8 * len(step) | int.from_bytes(step, "big"), held + 8 * len(step), at + len(step)
        held -= width
        code, acc = acc >> held, acc & (1 << held) - 1
        if code == END:
            break
        if code == CLEAR:
            table, width, last = base[:], 9, None
            continue
        if last is None:
            entry = table[code]
        elif code < len(table):
            entry = table[code]
            table.append(last + entry[:1])
        elif code == len(table):
            entry = last + last[:1]
            table.append(entry)
        else:
            raise ValueError("LZW code out of range")
        out.append(entry)
        size += len(entry)
        last = entry
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    return b"".join(out)


RUN = re.compile(rb"(.)\1{2,127}", re.DOTALL)


def packbits_encode(data: bytes) -> bytes:
    out, at = bytearray(), 0

    def literals(end: int) -> None:
        for i in range(at, end, 128):
            some = data[i : min(i + 128, end)]
            out.append(len(some) - 1)
            out.extend(some)

    for m in RUN.finditer(data):
        literals(m.start())
        at = m.end()
        out.append(257 - at + m.start())
        out.append(data[at - 1])
    literals(len(data))
    return bytes(out)


def packbits_decode(data: bytes, most: int) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n and len(out) < most:
        k = data[i]
        if k < 128:
            out += data[i + 1 : i + 2 + k]
            i += 2 + k
        elif k > 128:
            out += data[i + 1 : i + 2] * (257 - k)
            i += 2
        else:
            i += 1
    return bytes(out)


def _squeeze(block: np.ndarray, compression: int, predictor: int) -> bytes:
    if predictor == 2:
        block = np.diff(block, axis=1, prepend=np.uint8(0))
    raw = block.tobytes()
    if compression == LZW:
        return lzw_encode(raw)
    if compression == PACKBITS:
        return b"".join(packbits_encode(x.tobytes()) for x in block)
    return zlib.compress(raw, 1) if compression == DEFLATE else raw


def encode(payload: bytes, width: int = 96, page_rows: int = 768, strip_rows: int = 192, compression: int = DEFLATE, predictor: int = 1, tile: tuple[int, int] | None = None) -> bytes:
    """A TIFF of 8-bit grey pages that hold the payload, whose size is a multiple of width, row by row."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for top in range(0, len(rows), page_rows):
        page = rows[top : top + page_rows]
        h, parts = len(page), []
        if tile:
            tw, th = tile
            padded = np.zeros((-(-h // th) * th, -(-width // tw) * tw), np.uint8)
            padded[:h, :width] = page
            blocks = [padded[y : y + th, x : x + tw] for y in range(0, len(padded), th) for x in range(0, padded.shape[1], tw)]
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, h, strip_rows)]
        for b in blocks:
            data = _squeeze(b, compression, predictor)
            parts.append((len(out), len(data)))
            out += data + b"\0" * (len(data) & 1)
        tags = [(WIDTH, [width]), (HEIGHT, [h]), (BITS, [8]), (COMPRESSION, [compression]), (PHOTOMETRIC, [1]), (SAMPLES, [1]), (PREDICTOR, [predictor])]
        at, sizes = [p[0] for p in parts], [p[1] for p in parts]
        tags += [(TILE_WIDTH, [tile[0]]), (TILE_HEIGHT, [tile[1]]), (TILES, at), (TILE_BYTES, sizes)] if tile else [(STRIPS, at), (ROWS_PER_STRIP, [strip_rows]), (STRIP_BYTES, sizes)]
        entries = b""
        for tag, values in sorted(tags):
            raw = struct.pack(f"<{len(values)}I", *values)
            if len(raw) > 4:
                here, raw = len(out), raw
                out += raw
                raw = struct.pack("<I", here)
            entries += struct.pack("<HHI", tag, 4, len(values)) + raw
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(tags)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _directory(data: bytes, at: int, order: str) -> tuple[dict[int, list[int]], int]:
    (n,) = struct.unpack_from(f"{order}H", data, at)
    tags: dict[int, list[int]] = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * i)
        if kind not in FIELD:
            continue
        letter, size = FIELD[kind]
        place = at + 10 + 12 * i
        if size * count > 4:
            (place,) = struct.unpack_from(f"{order}I", data, place)
        tags[tag] = list(struct.unpack_from(f"{order}{count}{letter}", data, place))
    (follow,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)
    return tags, follow


def _block(data: bytes, at: int, size: int, compression: int, need: int) -> bytes:
    raw = data[at : at + size]
    if compression == LZW:
        raw = lzw_decode(raw, need)
    elif compression in (DEFLATE, OLD_DEFLATE):
        raw = zlib.decompressobj().decompress(raw, need)
    elif compression == PACKBITS:
        raw = packbits_decode(raw, need)
    elif compression != NONE:
        raise ValueError(f"compression {compression} is not known")
    if len(raw) < need:
        raise ValueError("a strip or tile is too short")
    return raw[:need]


def pages(data: bytes, most: int = 1 << 31) -> Iterator[Page]:
    """Every page of a file. most: bytes of pixels that a page may have."""
    at = no = 0
    try:
        order = {b"II": "<", b"MM": ">"}[bytes(data[:2])]
        magic, at = struct.unpack_from(f"{order}HI", data, 2)
        if magic != 42:
            raise ValueError("not a TIFF")
    except (KeyError, struct.error, ValueError):
        yield Page(0, 0, 0, 0, 0, 0, 0, False, None, "not a TIFF")
        return
    seen: set[int] = set()
    while at and at not in seen:
        seen.add(at)
        w = h = n = bits = compression = 0
        predictor, tiled = 1, False
        try:
            tags, at = _directory(data, at, order)
            one = lambda tag, other: (tags.get(tag) or [other])[0]
            w, h, n, bits = one(WIDTH, 0), one(HEIGHT, 0), one(SAMPLES, 1), one(BITS, 1)
            compression, predictor, tiled = one(COMPRESSION, NONE), one(PREDICTOR, 1), TILES in tags
            if bits not in (8, 16) or predictor not in (1, 2):
                raise ValueError(f"{bits} bits or predictor {predictor} not known")
            kind = np.dtype(np.uint8) if bits == 8 else np.dtype(f"{order}u2")
            if w * h * n * kind.itemsize > most:
                raise ValueError("the page is too large")
            bw, bh = (one(TILE_WIDTH, 0), one(TILE_HEIGHT, 0)) if tiled else (w, min(one(ROWS_PER_STRIP, h), h))
            offsets, sizes = (tags[TILES], tags[TILE_BYTES]) if tiled else (tags[STRIPS], tags[STRIP_BYTES])
            across = -(-w // bw)
            image = np.empty((h, w * n), kind)
            for i in range(across * -(-h // bh)):
                y, x = i // across * bh, i % across * bw
                rows = bh if tiled else min(bh, h - y)
                block = np.frombuffer(_block(data, offsets[i], sizes[i], compression, rows * bw * n * kind.itemsize), kind).reshape(rows, bw, n)
                if predictor == 2:
                    block = np.cumsum(block, axis=1, dtype=block.dtype.newbyteorder("=")).astype(kind)
                part = image[y : y + bh, x * n : (x + bw) * n]
                part[:] = block.reshape(rows, bw * n)[: part.shape[0], : part.shape[1]]
            yield Page(no, w, h, n, bits, compression, predictor, tiled, image.tobytes(), None)
        except (ValueError, KeyError, IndexError, ZeroDivisionError, struct.error, zlib.error, MemoryError) as e:
            yield Page(no, w, h, n, bits, compression, predictor, tiled, None, f"{type(e).__name__}: {e}"[:200])
            if isinstance(e, struct.error):
                return
        no += 1


PAGE = "page int, width int, height int, samples int, bits int, compression int, predictor int, tiled boolean, pixels binary, error string"


def tiff_pages(files: DataFrame, data_col: str = "media", carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per page of the TIFF files in data_col, with the carried columns.

    Null or empty data and files that aren't TIFF: one row with page 0, null pixels and the error. Repeated rows are read
    each; an empty table gives an empty result; columns that aren't carried are not read.
    """
    base = files.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{data_col}`").cast("binary").alias("_data"))
    schema = T.StructType([*base.schema.fields[:-1], *T._parse_datatype_string(PAGE).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(batch: pa.RecordBatch, row: list[int], found: list[Page]) -> pa.RecordBatch:
            own = [batch.column(i).take(pa.array(row, pa.int64())).cast(arrow.field(i).type) for i in range(len(carry))]
            return pa.RecordBatch.from_arrays([*own, *(pa.array(c, arrow.field(len(carry) + i).type) for i, c in enumerate(zip(*found) if found else [[]] * 10))], schema=arrow)

        for batch in batches:
            row, found, size = [], [], 0
            for i, x in enumerate(batch.column(len(carry))):
                for p in pages(x.as_py() or b""):
                    row.append(i)
                    found.append(p)
                    size += len(p.pixels or b"")
                    if size > 8 << 20:
                        yield out(batch, row, found)
                        row, found, size = [], [], 0
            if found:
                yield out(batch, row, found)

    return base.mapInArrow(run, schema)


UNIT = 576
#: How a text is stored, by its payload's CRC-32: each scheme, strips and tiles, with and without differences, as often.
STYLES = [(c, p, t) for c in (LZW, PACKBITS, DEFLATE) for p in (1, 2) for t in (None, (48, 16))]


def padded(text: bytes) -> bytes:
    """With bytes 255 up to a positive multiple of UNIT."""
    return bytes(text) + b"\xff" * (-len(text) % UNIT if text else UNIT)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as a TIFF file: id, row (a number of the row's own), n_bytes of the text, media.

    Null and empty texts are one page of padding; repeated rows are stored each; columns beside id and text are not read.
    """
    base = docs.select(F.col(f"`{id_col}`"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = T.StructType([*base.schema.fields[:2], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in K.parts(batch.column(2)):
                media = []
                for x, y in zip(offs[:-1].tolist(), offs[1:].tolist()):
                    payload = padded(data[x:y].tobytes())
                    compression, predictor, tile = STYLES[zlib.crc32(payload) % len(STYLES)]
                    media.append(encode(payload, compression=compression, predictor=predictor, tile=tile))
                own = [batch.column(i).slice(a, b - a).cast(arrow.field(i).type) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(offs), pa.int64()), pa.array(media, pa.binary())], schema=arrow)

    return base.mapInArrow(run, schema)


class Folded:
    """A file's digest, gathered from its pages in order."""

    def __init__(self) -> None:
        self.sha, self.size, self.tail, self.total, self.steps, self.n = hashlib.sha256(), 0, b"", 0, 0, 0
        self.bins = np.zeros(256, np.int64)
        self.kind = ""

    def add(self, pixels: bytes, compression: int, predictor: int, tiled: bool) -> None:
        own = np.frombuffer(pixels, np.uint8)
        self.sha.update(pixels)
        self.size, self.tail, self.n = self.size + len(own), (self.tail + pixels[-32:])[-32:], self.n + 1
        self.bins += np.bincount(own, minlength=256)
        self.steps += int(np.count_nonzero(own[1:] != own[:-1]))
        self.total += int(own.sum(dtype=np.int64))
        self.kind = f"compression={compression};predictor={predictor};tiled={int(tiled)}"

    def row(self) -> tuple:
        feature = f"pages={self.n};{self.kind};sum={self.total};levels={np.count_nonzero(self.bins)};mode={self.bins.argmax()};steps={self.steps}"
        return self.size, self.sha.hexdigest(), zlib.crc32(self.tail), feature


def folded(pages: DataFrame, carry: tuple[str, ...], row: str = "row") -> DataFrame:
    """One row per file from its page rows, which follow each other as tiff_pages gives them: the carried columns,
    payload_bytes, payload_sha256, tail_crc32, feature. A page with an error is an error."""
    base = pages.select(*[F.col(f"`{c}`") for c in carry], row, "pixels", "compression", "predictor", "tiled", "error")
    kinds = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("feature", T.StringType())]
    schema = T.StructType([*base.schema.fields[: len(carry)], *[T.StructField(c, t) for c, t in kinds]])
    arrow, k = to_arrow_schema(schema), len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, file = None, Folded()
        done: list[tuple] = []

        def out() -> pa.RecordBatch:
            cols = list(zip(*done)) if done else [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

        for batch in batches:
            own = list(zip(*(batch.column(i).to_pylist() for i in range(k)))) if k else [()] * len(batch)
            for i, (r, c, p, t, e) in enumerate(zip(*(batch.column(j).to_pylist() for j in (k, k + 2, k + 3, k + 4, k + 5)))):
                if e:
                    raise ValueError(e)
                if open_ is not None and open_[0] != r:
                    done.append((*open_[1], *file.row()))
                    file = Folded()
                open_ = (r, own[i])
                file.add(batch.column(k + 1)[i].as_buffer().to_pybytes(), c, p, t)
            if len(done) > 10_000:
                yield out()
                done = []
        if open_ is not None:
            done.append((*open_[1], *file.row()))
        yield out()

    return base.mapInArrow(run, schema)


def op5_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per text: stored as a TIFF file by encode_texts, read back as page rows by tiff_pages, which are then folded."""
    media = encode_texts(documents(spark, sf_dir)).select("doc_id", "row", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    carry = ("doc_id", "n_bytes", "media_bytes", "media_sha256")
    out = folded(tiff_pages(media, carry=(*carry, "row")), carry)
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


QUERIES = {"op5_tiff_pages": op5_tiff_pages}
