"""Substring dedup: every window of a fixed number of words is hashed (Rabin-Karp), the hashes are counted over the
corpus in Spark, and repeated windows merge into maximal removal intervals.

Plan: documents are dealt to groups of about group_bytes by a hash of id, text and input part. A group sends its sorted
distinct window hashes to hash-range buckets, one row per group and bucket, so a passage that many documents share reaches a
bucket once per group at most (counting starts before the shuffle). A bucket answers each group with one bit per hash:
seen elsewhere or not. The group, read again from the same exchange, hashes again, adds its own repeats, and cuts. Both
shuffles have even parts whatever the corpus repeats; groups and buckets grow with the root of the corpus, so that a row
of the exchange holds many hashes at any size.

Windows count as equal when two independent hashes are, one of 61 bits over the field of 2**61 - 1 and one of 32 bits,
each with its own keys for letters and windows, drawn for the run. For any two unlike windows of w words the chance that
both agree is below (2**-56 + w / 2**61) * 2**-31, about 2**-86 for w = 35, so with n windows a given one is wrongly held to
be repeated with a chance of n / 2**86 (10**-13 at 10**13 windows, some 60 TB of text), whatever the texts are.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.shared import documents, text_bytes


class Found(NamedTuple):
    """Distinct windows in order of their hashes, how often each occurs, and which of them each window is."""

    hash: np.ndarray
    check: np.ndarray
    count: np.ndarray
    which: np.ndarray


def distinct(h: np.ndarray, check: np.ndarray) -> Found:
    order = np.argsort(h, kind="stable")
    a, b = h[order], check[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = a[1:] != a[:-1]
    if (~fresh[1:] & (b[1:] != b[:-1])).any():  # equal hashes of unlike windows
        order = np.lexsort((check, h))
        a, b = h[order], check[order]
        fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(fresh) - 1
    return Found(a[fresh], b[fresh], np.bincount(which), which)


def _found(table: pa.Table, width: int, seed: int) -> Found:
    hashes, checks = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
    for _, _, data, offs in K.parts(table["_text"]):
        w = K.words(data, offs, seed=seed)
        at, h = K.windows(w, width, seed)
        if len(at):
            again = K.rabin_karp(K.rehash(data, w.start, w.end, ~K.SEP[data], seed=seed + 1), width, seed + 1)[at]
            hashes.append(h)
            checks.append((again >> np.uint64(32)).astype(np.uint32))
    return distinct(np.concatenate(hashes), np.concatenate(checks))


def _buckets(u: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted hashes fall into by their first bits, and where each begins."""
    own = u >> np.uint64(64 - bits) if bits else np.zeros(len(u), np.uint64)
    at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(u) else np.zeros(0, np.int64)
    return own[at].astype(np.int64), at


def _send(width: int, bits: int, seed: int) -> Callable[[pa.Table], pa.Table]:
    def send(table: pa.Table) -> pa.Table:
        found = _found(table, width, seed)
        own, at = _buckets(found.hash, bits)
        ends = np.append(at[1:], len(found.hash))
        g = table["_g"][0].as_py()
        rows = [K.squeeze(found.hash[x:y]) + found.check[x:y].tobytes() for x, y in zip(at, ends)]
        return pa.table({"_g": pa.array([g] * len(at), pa.int64()), "_b": pa.array(own, pa.int64()), "_hashes": pa.array(rows, pa.binary())})

    return send


def _answer(table: pa.Table) -> pa.Table:
    """For each group, which of its windows another group has too."""
    raw = [memoryview(x.as_buffer()) for x in table["_hashes"]]
    sizes = [len(x) // 12 for x in raw]
    found = distinct(np.concatenate([K.unsqueeze(x[: 8 * n]) for x, n in zip(raw, sizes)]), np.concatenate([np.frombuffer(x[8 * n :], np.uint32) for x, n in zip(raw, sizes)]))
    twice = (found.count > 1)[found.which]
    return pa.table({"_g": table["_g"].cast(pa.int64()), "_b": table["_b"].cast(pa.int64()), "_bits": pa.array([np.packbits(x).tobytes() for x in np.split(twice, np.cumsum(sizes)[:-1])], pa.binary())})


def _cut(width: int, bits: int, seed: int, schema: pa.Schema, rejoin: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        found = _found(docs, width, seed)
        twice = found.count > 1
        at = dict(zip(*(x.tolist() for x in _buckets(found.hash, bits))))
        for k, x in zip(answers["_b"].to_pylist(), answers["_bits"]):
            own = np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8))[: len(twice) - at[k]].astype(bool)
            twice[at[k] : at[k] + len(own)] |= own  # the bits that fill the last byte are 0
        repeated, seen = twice[found.which], 0
        n_words, n_removed, spans, kept = [], [], [], []
        for _, _, data, offs in K.parts(docs["_text"]):
            w = K.words(data, offs, seed=seed)
            first = np.flatnonzero(w.doc[: len(w.doc) - width + 1] == w.doc[width - 1 :]) if len(w.doc) >= width else np.zeros(0, np.int64)
            gone = K.covered(first[repeated[seen : seen + len(first)]], width, len(w.doc))
            seen += len(first)
            cuts = np.searchsorted(w.doc, np.arange(len(offs)))
            removed = np.concatenate([[0], np.cumsum(gone)])[cuts]
            raw = data.tobytes()
            for i in range(len(offs) - 1):
                text, n = raw[offs[i] : offs[i + 1]], int(cuts[i + 1] - cuts[i])
                k = int(removed[i + 1] - removed[i])
                own = text.split() if k or rejoin else [text]
                runs = []
                if k:
                    mine = gone[cuts[i] : cuts[i + 1]]
                    edge = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
                    runs = [{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)]
                    own = compress(own, ~mine)
                n_words.append(n)
                n_removed.append(k)
                spans.append(runs)
                kept.append(b" ".join(own))
        texts = pa.array(kept, pa.binary()).cast(pa.string())
        if not rejoin:
            texts = pc.if_else(docs["_text"].combine_chunks().is_null(), None, texts)
        out = {
            "_n_words": pa.array(n_words, pa.int64()),
            "_n_removed": pa.array(n_removed, pa.int64()),
            "_spans": pa.array(spans, schema.field("_spans").type),
            "_kept": texts,
        }
        return pa.table({f.name: out[f.name] if f.name in out else docs[f.name].cast(f.type) for f in schema}, schema=schema)

    return cut


ADDED = {"n_words": "_n_words", "n_removed": "_n_removed", "spans": "_spans", "kept_text": "_kept"}


def _cuts(docs: DataFrame, text_col: str, others: list[str], width: int, rejoin: bool, group_bytes: int, bucket_windows: int, seed: int | None) -> DataFrame:
    """The columns others as _0, _1, ..., whose names can't clash, then _n_words, _n_removed, _spans, _kept."""
    total, _ = text_bytes(docs, text_col)
    seed = K.draw(seed)
    root = math.isqrt(500 * total)  # rows of the exchange then weigh little beside the hashes in them
    groups = max(1, -(-total // max(group_bytes, min(root, 8 * group_bytes))))
    bits = max(0, (total // max(6 * bucket_windows, min(root, 48 * bucket_windows))).bit_length())
    text = F.col(f"`{text_col}`").cast("string")
    dealt = F.pmod(F.xxhash64(text, *[F.col(f"`{c}`") for c in others[:1]], F.spark_partition_id()), F.lit(groups))
    base = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)], text.alias("_text"), dealt.alias("_g"))
    sent = base.groupBy("_g").applyInArrow(_send(width, bits, seed), "_g long, _b long, _hashes binary")
    answers = sent.groupBy("_b").applyInArrow(_answer, "_g long, _b long, _bits binary")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    added = [T.StructField(c, t) for c, t in zip(ADDED.values(), (T.LongType(), T.LongType(), span, T.StringType()))]
    schema = T.StructType([*base.schema.fields[: len(others)], *added])
    return base.groupBy("_g").cogroup(answers.groupBy("_g")).applyInArrow(_cut(width, bits, seed, to_arrow_schema(schema), rejoin), schema)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35, carry: tuple[str, ...] = (), rejoin: bool = True, group_bytes: int = 8 << 20, bucket_windows: int = 1 << 21, seed: int | None = None) -> DataFrame:
    """One row per input row: the id, the carried columns, n_words, n_removed, spans (word intervals taken out), kept_text.

    A word goes when it lies in a window of width words whose word sequence also starts elsewhere in the corpus, same
    document included; windows are judged on the input. kept_text joins the words that stay by one space; with rejoin=False
    a text that loses no word stays as it is, null included.
    Null and empty texts have no words: n_words 0, kept_text ''. Texts shorter than a window keep all words. Repeated
    rows are rows of their own and repeat each other. Null ids and rows of one id are dealt by their texts. An empty table
    gives an empty result. Columns beside id, text and carry are not read, so their names can't clash. seed: of the hashes'
    keys, drawn if not given.
    """
    others = [id_col, *carry]
    out = _cuts(docs, text_col, others, width, rejoin, group_bytes, bucket_windows, seed)
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(others)], *[F.col(c).alias(name) for name, c in ADDED.items()])


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of those with repeated passages the text is what is left, words joined by one space.

    A null text stays null. Empty texts and texts without repeats stay as they are; repeated rows repeat each other, so each
    loses the windows that they share. Null ids count as any other. Extra columns pass through under any name. Empty in,
    empty out.
    """
    others = [c for c in docs.columns if c != "text"]
    cut = _cuts(docs, "text", others, 35, False, 4 << 20, 1 << 20, None)
    own = {c: F.col(f"_{i}") for i, c in enumerate(others)} | {"text": F.col("_kept")}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("_n_removed") > 0, F.length("_kept").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    return cut.select(*[own[c].alias(c) for c in docs.columns])


#: For DuckDB; windows are compared as word sequences.
SQL = {
    "op3_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+34], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM rep),
g AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ks), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(ws, lambda x, j: NOT list_contains(coalesce(ks, []), j)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""
}
QUERIES = {"op3_substring_dedup": op3_substring_dedup}
