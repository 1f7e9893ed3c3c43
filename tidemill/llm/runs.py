"""Periodic runs of words: maximal stretches that repeat with some period, found by a descending-LCP Kruskal.

Two places i < j of a document whose words agree for exactly l words on make the stretch from i to j + l repeat with period
j - i. The classes of places that agree for at least l words grow as l falls: they are the components of the graph of
suffix-array neighbours, whose edges weigh their longest common prefix, and Kruskal's algorithm unites them from the
longest on. A class keeps its places in order. When two classes unite at l, places of one that become neighbours of places
of the other at a distance within l seed runs: i and i + q, for a run from i with smallest period q that is at least 2 q
long, agree for (length - q) words, and no place between them agrees with i as far, or the run would have a smaller period;
so they become neighbours just when their classes unite, and the seed gives the run's end. Conversely a seed whose words
before i and j differ is a maximal run, and its distance is its smallest period, since a smaller one would have put a place
between the two at a greater l.

A document's work is n log n: prefix doubling orders the places of documents where some words come again, levels of its ranks
give common prefixes, and the smaller class moves into the larger. Words are compared as words, by numbers that a dictionary
gives.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.shared import documents


class Places:
    """An ordered set of places in sorted blocks, so that an insertion moves few of them whatever the set's size."""

    BLOCK = 1024

    def __init__(self, places: list[int]) -> None:
        self.blocks = [places[a : a + self.BLOCK // 2] for a in range(0, len(places), self.BLOCK // 2)]
        self.first = [b[0] for b in self.blocks]
        self.n = len(places)

    def __len__(self) -> int:
        return self.n

    def __iter__(self) -> Iterator[int]:
        for b in self.blocks:
            yield from b

    def around(self, x: int) -> tuple[int, int]:
        """The nearest place before x and the nearest behind it; -1 where there is none."""
        k = bisect_right(self.first, x) - 1
        if k < 0:
            return -1, self.first[0]
        block = self.blocks[k]
        i = bisect_left(block, x)
        return block[i - 1], block[i] if i < len(block) else self.first[k + 1] if k + 1 < len(self.first) else -1

    def add(self, x: int) -> None:
        k = max(0, bisect_right(self.first, x) - 1)
        block = self.blocks[k]
        insort(block, x)
        self.first[k] = block[0]
        self.n += 1
        if len(block) > self.BLOCK:
            self.blocks.insert(k + 1, block[self.BLOCK // 2 :])
            self.first.insert(k + 1, self.blocks[k + 1][0])
            del block[self.BLOCK // 2 :]


def repeating(ids: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Which words belong to documents where some k words stand at two places: all those documents, by a hash."""
    live = np.zeros(int(doc[-1]) + 1 if len(doc) else 0, bool)
    n = len(ids) - k + 1
    at = np.flatnonzero(doc[:n] == doc[k - 1 :]) if n > 0 else np.zeros(0, np.int64)
    if len(at):
        wide = ids.astype(np.uint64)
        h = doc[at].astype(np.uint64)
        for i in range(k):
            h = h * np.uint64(K.BASE) + wide[at + i]
        h = K.mix(h)
        order = np.argsort(h)
        live[doc[at[order[1:][h[order[1:]] == h[order[:-1]]]]]] = True
    return live[doc]


def common_prefixes(ids: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places, so ordered that those of a document that agree on any number of words stand together; the words that each
    shares with the next, where these are at least k (else 0); and the class of k words of each."""
    n = len(ids)
    last = np.searchsorted(doc, doc, "right")  # behind the document's last word
    bits = int(ids.max(initial=0) + 1).bit_length()
    keys, room = [], 0
    for i in range(k):
        at = np.arange(n) + i
        word = np.where(at < last, ids[np.minimum(at, n - 1)].astype(np.int64) + 1, 0)
        if room < bits:
            keys.append(word)
            room = 62 - bits
        else:
            keys[-1] = keys[-1] << bits | word
            room -= bits
    keys.insert(0, doc)
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(n, bool)
    fresh[:1] = True
    for x in keys:
        fresh[1:] |= x[order[1:]] != x[order[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = n  # behind the last word
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    classes, width, levels = rank[order], k, [(k, rank.astype(np.int32))]
    while True:
        of = rank[order]
        open_ = np.zeros(n, bool)
        open_[1:] = of[1:] == of[:-1]
        open_[:-1] |= open_[1:]
        slots = np.flatnonzero(open_)
        if not len(slots):
            break
        own = order[slots]
        key = of[slots] * (n + 1) + rank[own + width]  # at the document's end: a greater rank than any in it, of one place alone
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[slots] = own
        rank[own] = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), slots, 0))
        width *= 2
        levels.append((width, rank.astype(np.int32)))
    near = np.flatnonzero(classes[1:] == classes[:-1])
    i, j = order[near], order[near + 1]
    shared = np.zeros(len(near), np.int64)
    for w, r in reversed(levels):
        shared += w * (r[np.minimum(i + shared, n)] == r[np.minimum(j + shared, n)])
    going = np.ones(len(near), bool)
    for _ in range(k - 1):
        a, b = i + shared, j + shared
        going &= np.maximum(a, b) < last[i]
        going[going] = ids[a[going]] == ids[b[going]]
        shared += going
    out = np.zeros(n, np.int64)
    out[near] = shared
    return order, out, classes


def seeds(place: list[int], slots: list[int], shared: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(i, j, l) for places that become neighbours as slots s and s + 1 unite, edges in descending order of shared words, and
    that make a stretch of at least `least` words and `times` periods. A class is an interval of slots: its ends find it."""
    m, found = len(place), []
    low, high = list(range(m)), list(range(m))
    kept: list[list[int] | Places | None] = [None] * m

    def meet(i: int, j: int, shared: int) -> None:
        d = j - i
        if d * (times - 1) <= shared and d + shared >= least:
            found.append((i, j, shared))

    for s, l in zip(slots, shared):
        a, b = low[s], high[s + 1]
        big, small = kept[a] or [place[a]], kept[s + 1] or [place[s + 1]]
        kept[s + 1] = None
        if len(big) < len(small):
            big, small = small, big
        if type(big) is list and len(big) > Places.BLOCK:
            big = Places(big)
        ahead = iter(small)
        next(ahead)
        last = -1
        for x in small:  # in order; the next of the small class is not yet in the large one
            after = next(ahead, -1)
            if type(big) is list:
                k = bisect_left(big, x)
                before, behind = big[k - 1] if k else -1, big[k] if k < len(big) else -1
                big.insert(k, x)
            else:
                before, behind = big.around(x)
                big.add(x)
            if before >= 0 and before != last:
                meet(before, x, l)
            if behind >= 0 and not 0 <= after < behind:
                meet(x, behind, l)
            last = x
        kept[a] = big
        high[a], low[b] = b, a
    return found


def find_runs(ids: np.ndarray, doc: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (first word, length, smallest period) of every maximal run of at least `least` words and `times` periods, by
    document, start and period. Words are counted over all documents, which follow each other."""
    if times < 2:
        raise ValueError("a run has at least two periods")
    k = min(max(least - d, (times - 1) * d) for d in range(1, least + 1)) if least > 1 else times - 1
    use = np.flatnonzero(repeating(ids, doc, k))
    if not len(use):
        return np.zeros((0, 3), np.int64)
    place, shared, classes = common_prefixes(ids[use], doc[use], k)
    # a class whose places lie too far apart for the words that its closest share has no run
    alike = np.flatnonzero(np.bincount(classes, minlength=len(place))[classes] > 1)
    by = alike[np.lexsort((place[alike], classes[alike]))]
    gap = np.full(len(place), np.iinfo(np.int64).max)
    same = classes[by[1:]] == classes[by[:-1]]
    np.minimum.at(gap, classes[by[1:]][same], (place[by[1:]] - place[by[:-1]])[same])
    most = np.zeros(len(place), np.int64)
    np.maximum.at(most, classes, shared)
    hopeful = alike[(most // (times - 1) >= gap)[classes[alike]]]
    place, shared = use[place[hopeful]], shared[hopeful]
    edges = np.flatnonzero(shared)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    got = np.array(seeds(place.tolist(), edges.tolist(), shared[edges].tolist(), least, times), np.int64).reshape(-1, 3)
    i, j, l = got.T
    inner = (i > 0) & (doc[np.maximum(i - 1, 0)] == doc[i]) if len(i) else np.zeros(0, bool)
    first = ~(inner & (ids[np.maximum(i - 1, 0)] == ids[np.maximum(j - 1, 0)]))
    out = np.stack([i, j + l - i, j - i], 1)[first]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


RUN = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _runs(least: int, times: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, b, data, offs in K.parts(column):
                doc, start, end, solid = K.bounds(data, offs)
                found = find_runs(K.word_ids(data, start, end, solid), doc, least, times)
                cuts = np.searchsorted(doc, np.arange(b - a + 1))
                edge = np.bincount(found[:, 0] + found[:, 2], minlength=len(doc) + 1) - np.bincount(found[:, 0] + found[:, 1], minlength=len(doc) + 1)
                stays = np.cumsum(edge)[: len(doc)] == 0
                of = doc[found[:, 0]]
                n_kept = np.concatenate([[0], np.cumsum(stays)])[cuts]
                raw, kept = data.tobytes(), []
                for i in range(b - a):
                    words = raw[offs[i] : offs[i + 1]].split()
                    if n_kept[i + 1] - n_kept[i] < len(words):
                        words = [words[k] for k in np.flatnonzero(stays[cuts[i] : cuts[i + 1]])]
                    kept.append(b" ".join(words))
                rows = pa.StructArray.from_arrays([pa.array(found[:, 0] - cuts[of]), pa.array(found[:, 1]), pa.array(found[:, 2])], fields=list(schema.field("_runs").type.value_type))
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(b - a + 1)).astype(np.int32)), rows, type=schema.field("_runs").type)
                others = [batch.column(i).slice(a, b - a).cast(schema.field(i).type) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*others, pa.array(np.diff(cuts)), lists, pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)

    return run


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, runs (start, length and smallest period in words, by start and period), kept_text.

    A run is a stretch of at least `least` words and `times` periods that no neighbouring word extends; kept_text joins by one
    space the words that no run holds behind its first period. Null and empty texts have no words, no runs and kept_text ''.
    A text is judged alone, so repeated rows and ties each give their own row, null ids too; very long texts are whole, one in
    memory at a time. An empty table gives an empty result. Columns beside id and text are not read, so their names can't clash.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = T.StructType([base.schema[0], T.StructField("_n", T.LongType()), T.StructField("_runs", RUN), T.StructField("_kept", T.StringType())])
    out = base.mapInArrow(_runs(least, times, to_arrow_schema(schema)), schema)
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_words"), F.col("_runs").alias("runs"), F.col("_kept").alias("kept_text"))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text of documents; of every tenth by the CRC of its id the words from some place on repeat those there, with a
    period and number of repeats that follow from the same CRC. Altered texts have one space between words; a null id alters
    nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc, text = batch.column(1), batch.column(2)
            hit = np.flatnonzero(crc.fill_null(1).to_numpy() % 10 == 0)
            if len(hit):
                column: list = text.to_pylist()
                for i in hit.tolist():
                    words, g = (column[i] or "").encode().split(), crc[i].as_py() // 10
                    if n := len(words):
                        a = g % n
                        p = 1 + (n - a) // (3 + g % 8)
                        column[i] = b" ".join(words[:a] + [words[a + (k - a) % p] for k in range(a, n)]).decode()
                text = pa.array(column, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), text], names=["doc_id", "text"])

    base = docs.select("doc_id", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("crc"), F.col("text").cast("string"))
    return base.mapInArrow(run, T.StructType([base.schema[0], base.schema[2]]))


def digests(runs: Column) -> list[Column]:
    """The number of runs, the columns of the longest (ties: least start, then period), and the digest of all."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    start, length, period = -best["start"], best["length"], -best["period"]
    shown = {"n_runs": F.size(runs).cast("long"), "start": start, "length": length, "period": period, "exponent_milli": F.floor(1000 * length / period), "runs_sha256": F.sha2(F.encode(F.array_join(line, ""), "UTF-8"), 256)}
    return [c.alias(name) for name, c in shown.items()]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(planted(documents(spark, sf_dir)))
    return out.select("doc_id", *digests(F.col("runs")), F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("collapsed_sha256"))


#: For DuckDB. Stretches of equal words q apart are islands; a run is one that no run of a smaller period holds.
SQL = {
    "op11_periodic_runs": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, CAST(doc_id AS VARCHAR) AS id FROM documents),
bits AS (SELECT doc_id, ws, list_prepend(4294967295, flatten(list_transform(range(1, len(id) + 1), lambda i: [CAST(ascii(id[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))) AS steps FROM d),
crc AS (SELECT doc_id, ws, len(ws) AS n, xor(4294967295, list_reduce(steps, lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END))) AS h FROM bits),
plan AS (SELECT doc_id, ws, n, h % 10 = 0 AND n > 0 AS hit, CASE WHEN n > 0 THEN (h // 10) % n END AS a, 3 + (h // 10) % 8 AS times FROM crc),
t AS (SELECT doc_id, n, CASE WHEN hit THEN list_transform(range(0, n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // times) END]) ELSE ws END AS ws FROM plan),
w AS (SELECT doc_id, n, unnest(ws) AS word, unnest(range(0, n)) AS i FROM t),
pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM pairs),
stretch AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM isle GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT * FROM stretch s WHERE NOT EXISTS (SELECT 1 FROM stretch r WHERE r.doc_id = s.doc_id AND r.q < s.q AND r.start <= s.start AND r.start + r.length >= s.start + s.length)),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM (SELECT doc_id, word, i FROM w ANTI JOIN gone USING (doc_id, i)) GROUP BY doc_id),
sums AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines,
                arg_min({'start': start, 'length': length, 'q': q}, {'a': -length, 'b': start, 'c': q}) AS best FROM runs GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length, CAST(best.q AS BIGINT) AS period,
       CAST(1000 * best.length // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""
}
QUERIES = {"op11_periodic_runs": op11_periodic_runs}
