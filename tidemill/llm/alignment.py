"""Alignment of two tokenizers' tokens: which tokens end at the same bytes, and how often two ids are so linked in the corpus.

The ends of A's and of B's tokens are two ascending lists over the same bytes. Their merge is cut by merge-path partitioning:
on each of equally spaced diagonals a binary search finds how many ends of A and of B lie before it, so the pieces between
diagonals are equal work and independent of each other. A piece emits the ends that both lists have in it; an end whose A lies
before a diagonal and whose B behind it is found where the pieces meet, and what a piece leaves open behind its last common
end is joined to the next one's first group.

Corpus counts: texts are tokenised once, in chunks, and a chunk is one row of a table in the shared folder: its documents'
figures, its distinct pairs of linked ids with their numbers, and each document's links as sorted places among them, bit-packed.
Chunks send their distinct pairs - never a link - to buckets by a hash of the pair; a bucket adds them up, answers each chunk,
and gives the greatest count that each B id has in it. Those, at most one for each entry of B's vocabulary, are merged and given
to the last pass, which reads chunks with their answers. A pair that is in every text reaches a bucket once a chunk.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
import secrets
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.packing import byte_letters
from tidemill.llm.shared import documents, text_bytes, written
from tidemill.llm.token_blocks import packed, unpacked

WORK = 1 << 16  # ends that a piece merges
#: Where classes of letters, numbers and spaces are the same in all versions of Unicode that the libraries may have.
OTHER = re.compile("[^\x00-ɏ]")


def diagonals(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the first at[k] elements of the merge of two ascending lists are a's; of equals a's come first."""
    low, high = np.maximum(0, at - len(b)), np.minimum(at, len(a))
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        i = np.minimum(mid, len(a) - 1)
        j = np.clip(at - mid - 1, 0, len(b) - 1)
        more = open_ & (a[i] <= b[j])  # that element of a comes before that of b: take more of a
        low = np.where(more, mid + 1, low)
        high = np.where(open_ & ~more, mid, high)
    return low


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places in two strictly ascending lists of the values that both have."""
    if not len(a) or not len(b):
        z = np.zeros(0, np.int64)
        return z, z
    at = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    i = diagonals(a, b, at)
    j = at - i
    found_a, found_b = [], []
    for k in range(len(at) - 1):
        if k and i[k] and j[k] < len(b) and a[i[k] - 1] == b[j[k]]:  # one end, its two tokens on either side of the diagonal
            found_a.append(i[k : k + 1] - 1)
            found_b.append(j[k : k + 1])
        x, y = a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]
        if len(x) and len(y):
            to = np.searchsorted(y, x)
            hit = np.flatnonzero(y[np.minimum(to, len(y) - 1)] == x)
            found_a.append(i[k] + hit)
            found_b.append(j[k] + to[hit])
    return np.concatenate(found_a or [np.zeros(0, np.int64)]), np.concatenate(found_b or [np.zeros(0, np.int64)])


class Vocabulary(NamedTuple):
    """Each id's bytes (None: stands for none), and their number."""

    bytes: list[bytes | None]
    size: np.ndarray


def vocabulary(entries: list[bytes | None]) -> Vocabulary:
    return Vocabulary(entries, np.array([len(x or b"") for x in entries], np.int64))


class ByteLevel:
    """A byte-level BPE file of the tokenizers library.

    Where its ids are in the order of its merges, as here, the same merges by ranks give the same ids, as long as each entry
    is encoded as itself (a test holds that): merges that don't cross an entry's bounds go on in it as if it stood alone.
    tiktoken does that some five times as fast. Texts with letters beyond U+024F, whose classes the libraries may know
    differently, are encoded by the tokenizers library."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        special, of = set(self.whole.get_added_tokens_decoder()), byte_letters()
        known = self.whole.get_vocab(with_added_tokens=True)
        entries: list[bytes | None] = [None] * (max(known.values()) + 1)
        for w, i in known.items():
            if i not in special:
                entries[i] = bytes(of[c] for c in w)
        self.vocabulary = vocabulary(entries)
        ranks = {b: i for i, b in enumerate(entries) if b is not None}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids if OTHER.search(text) else self.ranks.encode_ordinary(text)


class Pieces:
    """A sentencepiece model, which adds a space before a text."""

    BYTE = re.compile(r"<0x([0-9A-F]{2})>\Z")

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries: list[bytes | None] = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i):
                entries.append(None)
            elif self.model.is_byte(i) and (m := self.BYTE.match(piece)):
                entries.append(bytes([int(m[1], 16)]))
            else:
                entries.append(piece.replace("▁", " ").encode())
        self.vocabulary = vocabulary(entries)

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


_LOADED: dict[tuple[type, str], ByteLevel | Pieces] = {}


def loaded(kind: type, path: str) -> ByteLevel | Pieces:
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]


def joined(v: Vocabulary, ids: list[int]) -> bytes | None:
    try:
        return b"".join([v.bytes[i] for i in ids])
    except TypeError:  # an id that stands for no bytes
        return None


class Aligned(NamedTuple):
    """Ids of A and B over some texts, how many each text has, and where tokens of both end together."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray


def align(texts: list[str | None], first: ByteLevel, second: Pieces, work: int = WORK) -> Aligned:
    """Tokens of texts by both; none of a text whose tokens are not its bytes behind a space."""
    a, b, n_a, n_b = [], [], [], []
    for text in texts:
        x, y = [], []
        if text:
            whole = " " + text
            x, y = first.ids(whole), second.ids(text)
            raw = whole.encode()
            if joined(first.vocabulary, x) != raw or joined(second.vocabulary, y) != raw:
                x, y = [], []
        a.append(np.array(x, np.int32))
        b.append(np.array(y, np.int32))
        n_a.append(len(x))
        n_b.append(len(y))
    ids_a, ids_b = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (a, b))
    return Aligned(ids_a, ids_b, np.array(n_a), np.array(n_b), *common_ends(np.cumsum(first.vocabulary.size[ids_a]), np.cumsum(second.vocabulary.size[ids_b]), work))


class Digits(NamedTuple):
    """The decimal numbers below 2 ** 17 with each of four marks behind, six letters wide at least, and their lengths."""

    letters: np.ndarray
    size: np.ndarray


def digits(most: int) -> Digits:
    """Row 4 * i + k: the number i and the k-th of , | , ; - within A's, behind A's, within B's, behind B's tokens of a group."""
    text = np.array([f"{i}{mark}" for i in range(most) for mark in ",|,;"], dtype=bytes)
    return Digits(text.view(np.uint8).reshape(len(text), -1), np.char.str_len(text))


_DIGITS: list[Digits] = []


def group_digests(x: Aligned, links: np.ndarray) -> list[str]:
    """Each text's SHA-256 of its groups; links: how many groups each text has."""
    if not _DIGITS or len(_DIGITS[0].size) < 4 * (1 + max(x.a.max(initial=0), x.b.max(initial=0))):
        _DIGITS[:] = [digits(max(1 << 16, 1 + int(max(x.a.max(initial=0), x.b.max(initial=0)))))]
    table = _DIGITS[0]
    sizes_a, sizes_b = np.diff(x.last_a, prepend=-1), np.diff(x.last_b, prepend=-1)
    row = np.empty(len(x.a) + len(x.b), np.int64)  # groups one after the other, A's tokens before B's
    group_a, group_b = np.repeat(np.arange(len(sizes_a)), sizes_a), np.repeat(np.arange(len(sizes_b)), sizes_b)
    before_b = np.cumsum(sizes_b) - sizes_b
    mark_a, mark_b = np.zeros(len(x.a), np.int64), np.full(len(x.b), 2)
    mark_a[x.last_a], mark_b[x.last_b] = 1, 3
    row[np.arange(len(x.a)) + before_b[group_a]] = 4 * x.a.astype(np.int64) + mark_a
    row[np.arange(len(x.b)) + np.cumsum(sizes_a)[group_b]] = 4 * x.b.astype(np.int64) + mark_b
    size = table.size[row]
    out = table.letters[row][np.arange(table.letters.shape[1]) < size[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(x.n_a + x.n_b)])].tolist()
    return [hashlib.sha256(memoryview(out)[s : e - 1]).hexdigest() if n else "" for s, e, n in zip(ends[:-1], ends[1:], links.tolist())]


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _chunks(path_a: str, path_b: str, chunk_bytes: int, work: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = loaded(ByteLevel, path_a), loaded(Pieces, path_b)
        entries = len(second.vocabulary.size)
        for batch in batches:
            for s, e, _, _ in K.parts(batch.column(1), chunk_bytes):
                x = align(batch.column(1).slice(s, e - s).to_pylist(), first, second, work)
                links = np.diff(np.searchsorted(x.last_a, np.concatenate([[0], np.cumsum(x.n_a)])))
                codes, which, counts = np.unique(x.a[x.last_a].astype(np.int64) * entries + x.b[x.last_b], return_inverse=True, return_counts=True)
                order = np.lexsort((which, np.repeat(np.arange(e - s), links)))
                steps = np.diff(which[order], prepend=0)
                heads = (np.cumsum(links) - links)[links > 0]
                steps[heads] = which[order][heads]  # each document's places begin anew
                figures = [x.n_a, x.n_b, links, links]
                values = [
                    [secrets.randbits(63)],
                    [batch.column(0).slice(s, e - s).to_pylist()],
                    *([f.tolist()] for f in figures),
                    [group_digests(x, links)],
                    [len(codes)],
                    [packed(np.diff(codes, prepend=0).astype(np.uint32)) if entries * len(first.vocabulary.size) < 1 << 32 else K.squeeze(codes.astype(np.uint64))],
                    [packed(counts.astype(np.uint32))],
                    [packed(steps.astype(np.uint32))],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

    return run


def _codes(raw: bytes | memoryview, narrow: bool) -> np.ndarray:
    return np.cumsum(unpacked(raw), dtype=np.int64) if narrow else K.unsqueeze(bytes(raw)).astype(np.int64)


def _bucketed(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of codes by bucket, the buckets there are, and where each begins in that order."""
    bucket = (K.mix(codes.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(codes), np.int64)
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    return order, own[at], at


def _send(bits: int, narrow: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, raw, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                codes, counts = _codes(raw.as_buffer(), narrow), unpacked(n.as_buffer())
                order, own, at = _bucketed(codes, bits)
                ends = [*at[1:].tolist(), len(codes)]
                sent = [(codes[order[s:e]].astype("<i8").tobytes(), counts[order[s:e]].astype("<u4").tobytes()) for s, e in zip(at.tolist(), ends)]
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(own), pa.int64()), pa.array(own, pa.int64()), *(pa.array(v, pa.binary()) for v in (zip(*sent) if sent else ([], [])))], names=["_g", "_b", "_codes", "_counts"])

    return run


def _totals(entries: int) -> Callable[[pa.Table], pa.Table]:
    def total(table: pa.Table) -> pa.Table:
        """Each chunk's pairs with their counts in all chunks; and, in a row without chunk, B's ids with their greatest."""
        sizes = [len(x.as_buffer()) // 8 for x in table["_codes"]]
        codes = np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for x in table["_codes"]])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table["_counts"]]).astype(np.int64)
        known, which = np.unique(codes, return_inverse=True)
        order = np.argsort(which, kind="stable")
        sums = np.add.reduceat(counts[order], np.searchsorted(which[order], np.arange(len(known))))
        answers = [x.astype("<i8").tobytes() for x in np.split(sums[which], np.cumsum(sizes)[:-1])]
        b = known % entries
        by = np.lexsort((sums, b))
        last = np.flatnonzero(np.append(b[by][1:] != b[by][:-1], True))
        return pa.table({
            "_g": pa.array([*table["_g"].to_pylist(), None], pa.int64()),
            "_b": pa.array([*table["_b"].to_pylist(), None], pa.int64()),
            "_sums": pa.array([*answers, None], pa.binary()),
            "_ids": pa.array([*[None] * len(sizes), b[by][last].tolist()], pa.list_(pa.int64())),
            "_most": pa.array([*[None] * len(sizes), sums[by][last].tolist()], pa.list_(pa.int64())),
        })

    return total


def _scored(bits: int, narrow: bool, entries: int, best: np.ndarray, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        raw = chunks.slice(0, 1)
        codes = _codes(raw["_codes"][0].as_buffer(), narrow)
        order, own, at = _bucketed(codes, bits)
        begin = dict(zip(own.tolist(), at.tolist()))
        sums = np.zeros(len(codes), np.int64)
        for k, x in zip(answers["_b"].to_pylist(), answers["_sums"]):
            got = np.frombuffer(x.as_buffer(), "<i8")
            sums[order[begin[k] : begin[k] + len(got)]] = got
        top = sums == best[codes % entries]
        links = np.array(raw["n_links"][0].as_py(), np.int64)
        steps = unpacked(raw["_steps"][0].as_buffer()).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(links)])
        run = np.cumsum(steps)
        which = run - np.repeat(np.concatenate([[0], run])[ends[:-1]], links)
        added = lambda v: np.diff(np.concatenate([[0], np.cumsum(v[which])])[ends])
        out = {c: raw[c].combine_chunks().flatten() for c in ("_id", *COUNTS, "groups_sha256")}
        out |= {"n_best": pa.array(added(top.astype(np.int64))), "count_sum": pa.array(added(sums))}
        return pa.table({f.name: out[f.name].cast(f.type) for f in schema}, schema=schema)

    return score


def align_tokenizers(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = 4 << 20, work: int = WORK, bucket_pairs: int = 1 << 20) -> DataFrame:
    """One row per input row: id, n_a, n_b (tokens of space + text by A and of text by B), n_groups (stretches between the bytes
    where tokens of both end), n_links (pairs of tokens that end together), n_best (links whose pair of ids is linked at least as
    often, in all rows, as any other pair of that B id), count_sum (of those numbers over the links), groups_sha256.

    path_a: a byte-level BPE file of the tokenizers library; path_b: a sentencepiece model. Special tokens' strings in texts are
    plain text. Null and empty texts, and texts whose tokens by A or B are not the bytes of space + text, have no tokens: zeros
    and ''. Repeated rows count each, null ids too; ties for the best are all best. Very long texts are aligned whole, in pieces,
    one in memory at a time. An empty table gives an empty result. Columns beside id and text are not read, so their names
    can't clash. chunk_bytes: of text for a chunk, up to eight times as many as the corpus grows; work: ends that a piece
    merges; bucket_pairs: pairs that a bucket takes from all chunks, about.
    """
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a, path_b = path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    sizes = [len(loaded(kind, path).vocabulary.size) for kind, path in ((ByteLevel, path_a), (Pieces, path_b))]
    entries, narrow = sizes[1], sizes[0] * sizes[1] < 1 << 32
    total, _ = text_bytes(docs, text_col)
    chunk = max(chunk_bytes, min(math.isqrt(500 * total), 8 * chunk_bytes))  # larger chunks repeat fewer pairs
    base = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    long = T.LongType()
    many = [T.StructField("_id", T.ArrayType(base.schema[0].dataType)), *[T.StructField(c, T.ArrayType(long)) for c in COUNTS], T.StructField("groups_sha256", T.ArrayType(T.StringType()))]
    schema = T.StructType([T.StructField("_g", long), *many, T.StructField("_n", long), *[T.StructField(c, T.BinaryType()) for c in ("_codes", "_counts", "_steps")]])
    chunks = written(base.mapInArrow(_chunks(path_a, path_b, chunk, work, to_arrow_schema(schema)), schema), "aligned")
    pairs = chunks.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    bits = int(pairs // bucket_pairs).bit_length()
    sent = chunks.select("_g", "_codes", "_counts").mapInArrow(_send(bits, narrow), "_g long, _b long, _codes binary, _counts binary")
    answers = written(sent.groupBy("_b").applyInArrow(_totals(entries), "_g long, _b long, _sums binary, _ids array<long>, _most array<long>"), "pair-counts")
    greatest = answers.where("_g IS NULL").select(F.explode(F.arrays_zip("_ids", "_most")).alias("x")).groupBy("x._ids").agg(F.max("x._most").alias("most"))
    best = np.zeros(entries, np.int64)
    for r in greatest.collect():  # at most one row for each entry of B's vocabulary
        best[r["_ids"]] = r["most"]
    added = [T.StructField(c, long) for c in (*COUNTS, "n_best", "count_sum")]
    out = T.StructType([base.schema[0], *added, T.StructField("groups_sha256", T.StringType())])
    scored = chunks.groupBy("_g").cogroup(answers.where("_g IS NOT NULL").select("_g", "_b", "_sums").groupBy("_g")).applyInArrow(_scored(bits, narrow, entries, best, to_arrow_schema(out)), out)
    return scored.withColumnRenamed("_id", id_col)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(documents(spark, sf_dir))


QUERIES = {"op13_tokenizer_alignment": op13_tokenizer_alignment}
