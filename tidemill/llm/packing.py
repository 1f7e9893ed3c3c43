"""Best-fit packing of tokenised documents into sequences of a fixed length.

Best-fit decreasing places documents from long to short, each into the open sequence with the least room that still
takes it; a segment tree over remaining capacities finds that sequence in logarithmic time. The placement of a document
depends on its length alone, so the corpus is packed as one: Spark counts the pieces of each length (at most
sequence_len rows reach the driver), the driver places lengths with their counts - a run of sequences of equal content
takes a run of equal pieces at once - and Spark deals the pieces, by their rank among those of the same length, to the
places. Every find in the tree still stands for best fit of the next piece; runs only repeat it.

Pieces of one length take their places in the order of the input, and sequences are numbered by the first of their pieces
in that order: of a mixed stream neighbours in the stream come out as near each other as their lengths allow.

The places are few whatever the input: a length opens or splits at most three runs, and a run that takes pieces is left
with less than half its room, so there are at most 3 * L * log2(L) rows for sequences of L tokens (150,000 for 4096,
about 7 MB), which is why they are broadcast.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.shared import documents, written


class Place(NamedTuple):
    """Pieces first .. first + count - 1 of this length go to sequences from sequence on, each a sequence, from offset on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


class CapacityTree:
    """A segment tree over the capacities 0..size: which have open sequences, and the least of them from a capacity on."""

    def __init__(self, size: int) -> None:
        self.base = 1 << (size + 1).bit_length()
        self.full = bytearray(2 * self.base)

    def mark(self, capacity: int, full: bool) -> None:
        i = self.base + capacity
        self.full[i] = full
        while i > 1:
            i >>= 1
            self.full[i] = self.full[2 * i] | self.full[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        i = self.base + least
        while not self.full[i]:
            while i & 1:
                i >>= 1
                if i <= 1:
                    return None
            if i <= 1:
                return None
            i += 1
        while i < self.base:
            i = 2 * i if self.full[2 * i] else 2 * i + 1
        return i - self.base


def best_fit_decreasing(counts: dict[int, int], size: int) -> list[Place]:
    """Places for counts[length] pieces of each length, best fit decreasing."""
    tree, open_ = CapacityTree(size), {}
    places: list[Place] = []
    sequences = 0

    def put(capacity: int, start: int, n: int) -> None:
        if n and capacity:
            open_.setdefault(capacity, []).append((start, n))
            tree.mark(capacity, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = size
                start, n = sequences, -(-left // (size // length))
                sequences += n
            else:
                start, n = open_[capacity].pop()
                if not open_[capacity]:
                    tree.mark(capacity, False)
            each = capacity // length
            whole = min(n, left // each)
            if whole:
                places.append(Place(length, rank, whole * each, start, each, size - capacity))
                rank, left = rank + whole * each, left - whole * each
                put(capacity - each * length, start, whole)
            if left and whole < n:  # the last pieces share one more sequence
                places.append(Place(length, rank, left, start + whole, each, size - capacity))
                put(capacity - left * length, start + whole, 1)
                whole, rank, left = whole + 1, rank + left, 0
            put(capacity, start + whole, n - whole)
    return places


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PlainIds:
    """The same tokenizer's ids of plain texts: letters up to U+024F (where all libraries agree on classes and nothing is
    composed), no special token's beginning, no control that libraries take for white space or not.

    Its pieces are written one a line, and merged by ranks with the line's end as the end-of-word mark. That gives the
    merges by pairs where ids are in the order of the merges and each entry is encoded as itself (a test holds that):
    merges that don't cross an entry's bounds go on in it as if it stood alone.
    """

    PLAIN = re.compile("[^\x1c-\x1f\u0250-\U0010ffff]*\\Z")
    CONTRACTION = re.compile("\n'\n(s|t|re|ve|m|ll|d)")
    NUMBERS = "0123456789\u00b2\u00b3\u00b9\u00bc\u00bd\u00be"
    NUMBER = re.compile(f"[{NUMBERS}]")
    #: Runs of all else but letters and white space. U+0307 comes of a letter's lower case.
    MARKS = re.compile(f"[{re.escape(''.join(filter(lambda c: not c.isalpha() and not c.isspace() and not c.isnumeric(), map(chr, [*range(0x250), 0x307]))))}]+")

    def __init__(self, vocab: dict[str, int], special: set[str]) -> None:
        import tiktoken

        of, self.special = byte_letters(), {x[:2] for x in special}
        raw = lambda w: bytes(of[c] for c in w.removesuffix("</w>")) + b"\n" * w.endswith("</w>")
        ranks = {raw(w): i for w, i in vocab.items() if w not in special}
        if len(ranks) != len(vocab) - len(special):
            raise ValueError("entries of the vocabulary can't be told apart")
        self.ranks = tiktoken.Encoding("lines", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})

    def takes(self, text: str) -> bool:
        return self.PLAIN.match(text) is not None and not any(x in text for x in self.special)

    def encode(self, text: str) -> bytes:
        lines = self.MARKS.sub("\n\\g<0>\n", text.lower())
        if "'" in text:
            lines = self.CONTRACTION.sub("\n'\\1\n", lines)
        if self.NUMBER.search(lines):
            lines = self.NUMBER.sub(" \\g<0> ", lines)
        return np.array(self.ranks.encode_ordinary("\n".join([*lines.split(), ""])), "<u4").tobytes()


class WordIds:
    """A tokenizer's ids of a text: of plain texts by PlainIds, of others by a bounded cache of the ids of words between white
    space.

    Valid for tokenizers that drop white space and whose pieces end with an end-of-word mark, as word_bpe_49k: new words
    are encoded together, and the ids that end a piece show where each word's ids end.
    """

    CONTROL = "\x1c\x1d\x1e\x1f"  # str.split takes these for white space, the tokenizer doesn't

    def __init__(self, path: str, most: int = 250_000) -> None:
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok, self.most, self.cache = Tokenizer.from_file(path), most, {}
        self.cores: dict[str, bytes] = {}
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.space = regex.compile(r"[^\s" + self.CONTROL + r"]+|[" + self.CONTROL + r"]+")
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        added = {x.content for x in self.tok.get_added_tokens_decoder().values()}
        self.special = tuple({x[0] for x in added})
        self.plain = PlainIds(vocab, added)

    def split(self, text: str) -> list[str]:
        if any(c in text for c in self.CONTROL):
            return [w for w in self._joined(text)]
        return text.split()

    def _joined(self, text: str) -> Iterator[str]:
        run, end = "", -1
        for m in self.space.finditer(text):
            if m.start() == end:
                run += m[0]
            else:
                if run:
                    yield run
                run = m[0]
            end = m.end()
        if run:
            yield run

    def _batch(self, some: list[str], pieces: list[int] | None) -> list[bytes]:
        """Ids of words, encoded together; pieces: how many each has (None: one)."""
        ids = np.array(self.tok.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        at = np.concatenate([[0], np.cumsum(pieces)]) if pieces else np.arange(len(some) + 1)
        if len(ends) != at[-1] + 1:  # words that can't be told apart: one by one
            return [np.array(self.tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in some]
        cut, raw = (ends[at] * 4).tolist(), ids.tobytes()
        return [raw[x:y] for x, y in zip(cut[:-1], cut[1:])]

    def _learn(self, new: list[str]) -> None:
        """A word of letters is one piece; letters and closing marks are two, cached apart; other words go whole."""
        cores, tails, other = {}, {}, []
        for w in new:
            if w.isalpha():
                core = w.lower()
            else:
                core = w.rstrip(".,!?;:")
                if not core.isalpha():
                    other.append(w)
                    continue
                tails[w] = w[len(core) :]
                core = core.lower()
            if core.isalpha() and "\u03c2" not in core:  # no mark split off, no final sigma
                cores[w] = core
            else:
                tails.pop(w, None)
                other.append(w)
        fresh = list({c for c in cores.values() if c not in self.cores} | {t for t in tails.values() if t not in self.cores})
        for a in range(0, len(fresh), 1000):
            self.cores.update(zip(fresh[a : a + 1000], self._batch(fresh[a : a + 1000], None)))
        for w, c in cores.items():
            self.cache[w] = self.cores[c] + self.cores[tails[w]] if w in tails else self.cores[c]
        odd = [w for w in other if any(c in w for c in self.special)]
        for w in odd:
            self.cache[w] = np.array(self.tok.encode(w, add_special_tokens=False).ids, "<u4").tobytes()
        other = [w for w in other if w not in self.cache]
        for a in range(0, len(other), 1000):
            some = other[a : a + 1000]
            n = [len(self.pieces.findall("".join(c.lower() for c in normalize("NFC", w)))) for w in some]
            self.cache.update(zip(some, self._batch(some, n)))
        if len(self.cores) > self.most:
            self.cores = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        out = [self.plain.encode(t) if t and self.plain.takes(t) else b"" for t in texts]
        others = [i for i, t in enumerate(texts) if t and not out[i]]
        for i, ids in zip(others, self._by_words([texts[i] for i in others])):
            out[i] = ids
        return out

    def _by_words(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) if t else [] for t in texts]
        distinct = set(chain.from_iterable(split))
        if new := [w for w in distinct if w not in self.cache]:
            self._learn(new)
        out = [b"".join(map(self.cache.__getitem__, ws)) for ws in split]
        if len(self.cache) > self.most:
            self.cache = {w: self.cache[w] for w in distinct} if len(distinct) < self.most // 2 else {}
        return out


_LOADED: dict[str, WordIds] = {}


def tokenizer(path: str) -> WordIds:
    """This worker's tokenizer, whose cache lives as long as the worker."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def _pieces(path: str, size: int, end_id: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = tokenizer(path), end_id.to_bytes(4, "little")
        for batch in batches:
            column = batch.column(2)
            for a, b, _, _ in K.parts(column):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(tok.encode(column.slice(a, b - a).to_pylist())):
                    ids += end
                    for k in range(0, len(ids), 4 * size):
                        own = ids[k : k + 4 * size]
                        row.append(a + i)
                        piece.append(k // (4 * size))
                        start.append(k // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                of = [batch.column(i).take(pa.array(row, pa.int64())).cast(schema.field(i).type) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*of, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    return run


def pieces(docs: DataFrame, path: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", order: Column | None = None) -> DataFrame:
    """A row for each piece of each tokenised document: id, _at, piece, start, length, ids_crc32. order: a whole number that
    places a row in the stream, as the input's parts and their rows if not given."""
    at = F.monotonically_increasing_id() if order is None else order.cast("long")
    base = docs.select(F.col(f"`{id_col}`"), at.alias("_at"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kinds = [("piece", T.IntegerType()), *((c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    schema = T.StructType([base.schema[0], base.schema[1], *[T.StructField(c, t) for c, t in kinds]])
    return base.mapInArrow(_pieces(path, size, end_id, to_arrow_schema(schema)), schema)


def ranked(rows: DataFrame, key: list[str], rank: str) -> DataFrame:
    """Adds each row's place from 0 among those of its key, in the order of _at and piece: by places within stretches of the
    stream and counts of the stretches before, so that a frequent key is ranked in as many tasks as it has stretches."""
    dealt = rows.withColumn("_part", F.shiftright("_at", 16))
    own = F.row_number().over(Window.partitionBy(*key, "_part").orderBy("_at", "piece")) - 1
    counts = dealt.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*(key or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.withColumn("_own", own).join(counts.withColumn("_before", before).drop("_n"), [*key, "_part"]).withColumn(rank, (F.col("_own") + F.col("_before")).cast("long")).drop("_own", "_before", "_part")


def pack(cut: DataFrame, size: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to pieces (a table that can be read again) by best fit decreasing over all of them."""
    spark = cut.sparkSession
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most size rows
    kinds = "length long, _first long, _count long, _sequence long, _each long, _offset long"
    places = spark.createDataFrame([tuple(p) for p in best_fit_decreasing(counts, size)], kinds)
    i = F.col("_rank") - F.col("_first")
    placed = ranked(cut, ["length"], "_rank").join(F.broadcast(places), ["length"]).where((i >= 0) & (i < F.col("_count")))
    placed = placed.select(*cut.columns, (F.col("_sequence") + F.floor(i / F.col("_each"))).cast("long").alias("_of"), (F.col("_offset") + i % F.col("_each") * F.col("length")).cast("long").alias("offset"))
    placed = written(placed, "placed")
    first = placed.groupBy("_of").agg(F.min(F.struct("_at", "piece")).alias("_head")).select("_of", "_head._at", "_head.piece")
    named = ranked(first, [], "sequence_id").select("_of", "sequence_id")
    return placed.join(named, "_of").drop("_of", "_at")


def best_fit_packing(docs: DataFrame, path: str | None = None, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", order: Column | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids end with end_id; only documents longer than a sequence are cut. Null and empty texts are the end id
    alone. Repeated rows and rows with null ids are packed each; equal lengths take places in the order of the input. An
    empty table gives an empty result. Columns beside id and text are not read. path: the tokenizer's file. order: as in pieces.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    out = pack(written(pieces(docs, path, size, end_id, id_col, text_col, order), "pieces"), size)
    return out.select(F.col(f"`{id_col}`"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir))


def file_order(docs: DataFrame) -> Column | None:
    """A row's place by its file's part number and its place in the file; None where docs is not read from files."""
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        docs.select(path, row).schema  # noqa: B018
    except AnalysisException:
        return None
    part = lambda i: F.coalesce(F.regexp_extract(path, r"part-(\d+)-[^/]*-c(\d+)[^/]*$", i).try_cast("long"), F.lit(0))
    return F.shiftleft(part(1), 42) + F.shiftleft(part(2), 32) + row


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the sequences, which follow the order of docs' files and rows: that of
    the mix.

    Null and empty texts are the end id alone; repeated rows and null ids are packed each. Extra columns are not read. Empty
    in, empty out.
    """
    return best_fit_packing(docs, order=file_order(docs))


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
