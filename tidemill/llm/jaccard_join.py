"""N-gram Jaccard self-join by universe partitioning and the pigeonhole principle.

A document's set holds its distinct word n-grams as 64-bit hashes. Two sets of sizes a and b whose similarity reaches
t / 100 differ in at most H = (a + b)(100 - t) / (100 + t) elements. Sets are banded by size; for the band of a pair's
smaller set H is known, and the hash universe is cut into m segments, of which

- the first d are indexed as their subset and all its one-deletion neighbourhoods (a pair that shares none of these
  differs there twice at least), and
- of the others each set skips its e smallest subsets, ordered by size and hash, and indexes the rest as they are. Equal
  subsets have equal order, so of the segments in which a pair agrees at most e are skipped on both sides.

A pair that shares no signature differs in at least 2d + (m - d - e) places, so m = H + 1 + e - d loses none. The
allocation (d, e) of each band comes from a cost model: signatures written against candidates expected by chance, from
the number of documents in the band; more documents buy larger or fewer empty segments.

Sets, not documents, are joined: equal sets are one node, so copies never multiply. A node's name is a 128-bit hash of its
set. Each set that shares a signature has a parity sketch, bits of which each element flips one; two sets differ in at
least as many elements as their sketches in bits, which turns away most pairs beyond H without sending a text. Each set is
first verified against one hub, of the sets that share a signature with it the one with most shared signatures (of a group
of copies that is the text they derive from). Components of the links found leave few signatures whose sets lie in
different components; of these, pairs across components that the sketches allow are verified. A pair inside a component
needs no proof, since the result is reachability. Verification compares the shingles' words themselves.

Hot signatures. A sample of the sets shows which signatures are very common; their rows are dealt to several tasks. A
signature that still joins more than hot_rows sets across components is refined: a similar pair also shares a signature of
any other cut of the universe, so the group falls apart into groups by both. What stays large is joined in blocks. In tasks the sketches of a
group are compared many at a time, each set with those of other components only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.components import connected_components
from tidemill.llm.shared import documents, dropped, written

U64 = np.uint64
SKETCH, LARGE, WIDE = 1024, 1500, 16384  # bits; sets from LARGE elements on have a sketch of WIDE bits as well


class Band(NamedTuple):
    low: int
    high: int
    segments: int
    deletions: int
    skipped: int


def differences(a: int, b: int, t: int) -> int:
    """The most elements in which sets of these sizes may differ at similarity t / 100."""
    return (a + b) * (100 - t) // (100 + t)


def step(t: int) -> float:
    """A band's largest size over its smallest: wider bands write sets to fewer of them, narrower ones cut H closer."""
    return (100 / t) ** 2


def limits(t: int, largest: int = 1 << 40) -> list[tuple[int, int]]:
    out, low = [], 1
    while low <= largest:
        high = max(low, int(low * step(t)))
        out.append((low, high))
        low = high + 1
    return out


def beyond(mean: float, e: int) -> float:
    """By how much a Poisson number of this mean exceeds e, on average."""
    if mean > 1000:  # as a normal number
        sd = math.sqrt(mean)
        z = (e - mean) / sd
        return sd * math.exp(-z * z / 2) / math.sqrt(2 * math.pi) + (mean - e) * math.erfc(z / math.sqrt(2)) / 2
    mean = max(mean, 1e-300)
    return sum((k - e) * math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(e + 1, int(max(e, mean) + 10 * math.sqrt(mean) + 40)))


def skips(h: int) -> list[int]:
    """How many subsets a set may skip: up to 48, and up to a quarter of h, as the empty ones of a set grow with h."""
    return sorted({0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48} | {e for k in range(1, 9) if (e := h * k // 32) > 48})


def allocate(low: int, high: int, docs: int, t: int, pair_cost: float = 40.0) -> Band:
    """The cheapest (d, e) for a band that holds so many documents: signatures written plus candidates by chance."""
    h = differences(high, high * 100 // t, t)
    best, chosen = math.inf, Band(low, high, h + 1, 0, 0)
    for d in range(0, 3):
        for e in skips(h):
            m = h + 1 + e - d
            if m < max(d, 1) or (m == d and e) or m - d - e < 0:
                continue
            size = low / m
            empty, one = math.exp(-size), size * math.exp(-size)
            plain = m - d
            over = beyond(plain * empty, e) / max(plain, 1)  # chance that a given plain segment is empty and still indexed
            chance = plain * (over**2 + 1e-4 * (one / (1 + e)) ** 2) + d * ((empty + one) ** 2)
            written_ = (m - d - e) + d * (1 + size)
            cost = written_ + pair_cost * docs / 2 * chance
            if cost < best:
                best, chosen = cost, Band(low, high, m, d, e)
    return chosen


class Shingles(NamedTuple):
    """A text's distinct shingles: their hashes in order, the first word of one occurrence of each, words in a shingle,
    and the words' places in the folded text."""

    hash: np.ndarray
    first: np.ndarray
    width: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray


def shingles(column: pa.Array, n: int, seed: int) -> Iterator[Shingles]:
    """Each text's n-word shingles; of fewer words the whole sequence; none without words."""
    for _, _, data, offs in K.parts(column, 1 << 20):
        w = K.words(data, offs, fold=True, seed=seed)
        at, h = K.windows(w, n, seed)
        docs = len(offs) - 1
        count = np.bincount(w.doc, minlength=docs)
        begin = np.concatenate([[0], np.cumsum(count)])
        owner, values = w.doc[at], h
        short = np.flatnonzero((count > 0) & (count < n))
        if len(short):
            own = np.array([int(K.mix(K.rabin_karp(w.hash[begin[i] : begin[i + 1]], int(count[i]), seed) + U64(count[i]))[0]) for i in short], U64)
            owner, values, at = np.concatenate([owner, short]), np.concatenate([values, own]), np.concatenate([at, begin[short]])
        order = np.lexsort((values, owner))
        owner, values, at = owner[order], values[order], at[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
        owner, values, at = owner[fresh], values[fresh], at[fresh]
        edge = np.searchsorted(owner, np.arange(docs + 1))
        for i in range(docs):
            x, y = edge[i], edge[i + 1]
            yield Shingles(values[x:y], at[x:y], min(n, int(count[i])), data, w.start, w.end)


def ngram_sets(column: pa.Array, n: int, seed: int = 0) -> Iterator[np.ndarray]:
    """Each text's sorted distinct hashes of n-word shingles."""
    return (s.hash for s in shingles(column, n, seed))


def common(a: Shingles, b: Shingles) -> int:
    """Shingles that both texts have, compared word by word: runs of shingles that follow each other in both texts are
    compared once; only where a word differs is each shingle compared by itself."""
    _, i, j = np.intersect1d(a.hash, b.hash, assume_unique=True, return_indices=True)
    if a.width != b.width or not len(i):
        return 0
    order = np.argsort(a.first[i])
    x, y = a.first[i][order], b.first[j][order]
    same = lambda x, y: K.same_bytes(a.data, a.start[x], a.end[x], b.data, b.start[y], b.end[y], K.LOWER)
    ends = np.append((np.diff(x) != 1) | (np.diff(y) != 1), True)
    tail = np.arange(1, a.width)
    if same(np.append(x, np.add.outer(x[ends], tail)), np.append(y, np.add.outer(y[ends], tail))).all():
        return len(x)
    return int(np.logical_and.reduce([same(x + k, y + k) for k in range(a.width)]).sum())


def set_key(s: np.ndarray, salt: int = 0xA5A5A5A5A5A5A5A5) -> int:
    """A set's 64-bit name; two salts give 128 bits."""
    return int(K.mix(np.array([int(K.mix(s ^ U64(salt)).sum(dtype=U64)) + len(s) & (1 << 64) - 1], U64)).view(np.int64)[0])


CHECK = 0x3C6EF372FE94F82B


class Signer:
    """Signatures of sets under an allocation. salt: another one cuts the universe in other places."""

    def __init__(self, bands: list[Band], t: int, salt: int = 0) -> None:
        self.bands, self.t, self.salt = bands, t, salt
        self.lows = [b.low for b in bands]

    def __call__(self, s: np.ndarray) -> np.ndarray:
        n, out = len(s), []
        if not n:
            return np.zeros(0, np.int64)
        if self.salt:
            s = np.sort(K.mix(s ^ U64(self.salt)))
        own = K.mix(s)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(own, dtype=U64)])
        k = int(np.searchsorted(self.lows, n, "right")) - 1
        if 100 * self.bands[-1].high < self.t * n:
            raise ValueError(f"a set of {n} elements is beyond the last band")
        while k >= 0 and 100 * self.bands[k].high >= self.t * n:
            b = self.bands[k]
            if differences(b.high, b.high * 100 // self.t, self.t):
                salt = int(K.mix(np.array([k + 1 + self.salt & (1 << 64) - 1], U64))[0])
                if b.segments >= 1 << 32:
                    raise ValueError(f"{b.segments} segments")
                place = ((s >> U64(32)) * U64(b.segments) >> U64(32)).astype(np.int64)
                size = np.bincount(place, minlength=b.segments)
                cut = np.concatenate([[0], np.cumsum(size)])
                name = np.arange(b.segments, dtype=U64) * U64(K.BASE) + U64(salt)
                total = sums[cut[1:]] - sums[cut[:-1]]
                sig = K.mix(total + name)
                d = b.deletions
                plain, many = sig[d:], size[d:]
                if b.skipped and len(plain):
                    plain = plain[np.lexsort((plain, many))[b.skipped :]]
                out.append(plain)
                for i in range(d):
                    out.append(sig[i : i + 1])
                    out.append(K.mix(total[i] - own[cut[i] : cut[i + 1]] + name[i]))
            k -= 1
        return np.unique(np.concatenate(out)).view(np.int64) if out else np.zeros(0, np.int64)


def _describe(n: int, seed: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for s in ngram_sets(batch.column(1), n, seed):
                rows.append((len(s), set_key(s), set_key(s, CHECK), sketch(s), sketch(s, WIDE) if len(s) >= LARGE else None) if len(s) else (0, None, None, None, None))
            own = [pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * 5, list(schema)[2:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(schema.field(0).type), batch.column(2), *own], schema=schema)

    return run


def _sign(n: int, seed: int, bands: list[Band], t: int, salt: int = 0) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (sig, key) of texts in the first column; a set that this task has signed lately is not signed again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign, recent = Signer(bands, t, salt), set()
        for batch in batches:
            sigs, keys, held = [], [], 0
            for s in ngram_sets(batch.column(0), n, seed):
                if not len(s) or (k := set_key(s)) in recent:
                    continue
                recent.add(k)
                own = sign(s)
                sigs.append(own)
                keys.append(np.full(len(own), k))
                held += len(own)
                if held > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(keys))], ["sig", "key"])
                    sigs, keys, held = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(keys))], ["sig", "key"])
            if len(recent) > 50_000:
                recent.clear()

    return run


def sketch(s: np.ndarray, bits: int = SKETCH) -> list[int]:
    """Parities of the elements by classes of their hashes, as 64-bit words."""
    odd = np.bincount((K.mix(s) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


NODE = "struct<key: long, check: long>"


def _verify(n: int, seed: int, t: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order of hub, the hub's own text first in each salt: one text is held, however many follow it.

    Two sets may share a hub's 64-bit key; then each is held.
    """
    kind = pa.struct([("key", pa.int64()), ("check", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hubs = None, []
        for batch in batches:
            a, b = [], []
            cols = [batch.column(i).to_pylist() for i in range(4)]
            for h, salt, key, check, s in zip(*cols, shingles(batch.column(4), n, seed)):
                if key == h:
                    if held != (h, salt):
                        held, hubs = (h, salt), []
                    own = slice(int(s.start[s.first.min()]), int(s.end[s.first.max() + s.width - 1])) if len(s.first) else slice(0, 0)
                    hubs.append((check, s._replace(data=s.data[own].copy(), start=s.start - own.start, end=s.end - own.start)))
                elif held == (h, salt):
                    for of, hub in hubs:
                        both = common(s, hub)
                        if 100 * both >= t * (len(s.hash) + len(hub.hash) - both):
                            a.append({"key": h, "check": of})
                            b.append({"key": key, "check": check})
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

    return run


def _texts(keys: DataFrame, told: DataFrame, base: DataFrame) -> DataFrame:
    """(key, check, text) for each set with one of these keys. The texts are shuffled at any size, against hash tables of the
    rows wanted: a broadcast of these would only do for small corpora."""
    rep = told.join(keys, "key").where("id is not null").groupBy("key", "check").agg(F.min(F.struct("id", "th")).alias("r"))
    wanted = written(rep.select("key", "check", F.col("r.id").alias("id"), F.col("r.th").alias("th")), "wanted")
    return base.join(wanted.hint("shuffle_hash"), ["id", "th"]).dropDuplicates(["key", "check"]).select("key", "check", "text")


def verified(pairs: DataFrame, told: DataFrame, base: DataFrame, n: int, t: int, seed: int, salt_rows: int = 2000) -> DataFrame:
    """Of pairs(hub, key), a written table, those whose sets are similar, as nodes (a, b). Only the texts of these pairs are
    read. A hub with many partners is dealt to several tasks."""
    texts = _texts(pairs.select("key").union(pairs.select("hub")).distinct(), told, base)
    salts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / F.lit(salt_rows)).cast("int").alias("n"))
    hubs = salts.select("hub", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"), F.col("hub").alias("key"))
    members = pairs.join(salts, "hub").select("hub", F.pmod(F.xxhash64("key"), F.col("n")).cast("int").alias("salt"), "key")
    rows = members.unionByName(hubs).join(texts, "key").select("hub", "salt", "key", "check", "text")
    dealt = rows.repartition(F.col("hub"), F.col("salt")).sortWithinPartitions("hub", "salt", F.col("key") != F.col("hub"))
    return dealt.mapInArrow(_verify(n, seed, t), f"a {NODE}, b {NODE}")


def _allowed(n: np.ndarray, run: np.ndarray, sketches: np.ndarray, wide: np.ndarray, at: np.ndarray, group: np.ndarray, t: int, small: int = 24, cells: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group that lie in different runs and whose sizes and sketches don't rule out similarity.

    Rows come in order of group and run. sketches: 64-bit words by row; at: a row's place in wide, -1 for none. Small groups
    are compared all at once, row by row at each distance; of larger ones a block of rows at a time with all rows behind it.
    """
    bits = np.ascontiguousarray(sketches.T)
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    size = np.diff(edge)
    most = lambda i, j: (n[i] + n[j]) * (100 - t) // (100 + t)

    def left(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = at[i], at[j]
        both = np.flatnonzero((x >= 0) & (y >= 0))
        far = np.zeros(len(i), bool)
        for k in np.array_split(both, len(both) // 4096 + 1):
            far[k] = np.bitwise_count(wide[x[k]] ^ wide[y[k]]).sum(1, dtype=np.int64) > most(i[k], j[k])
        return i[~far], j[~far]

    little = np.repeat(size <= small, size)
    for k in range(1, min(small, int(size.max(initial=0)))):
        i = np.flatnonzero(little[:-k] & (group[:-k] == group[k:]) & (run[:-k] != run[k:]) & (np.abs(n[:-k] - n[k:]) <= (n[:-k] + n[k:]) * (100 - t) // (100 + t)))
        for i in np.array_split(i, len(i) // cells + 1):
            apart = np.bitwise_count(sketches[i] ^ sketches[i + k]).sum(1, dtype=np.int64)
            i = i[apart <= most(i, i + k)]
            yield left(i, i + k)
    for a, z in zip(edge[:-1][size > small], edge[1:][size > small]):
        ends = a + np.searchsorted(run[a:z], run[a:z], "right")
        i = a
        while i < z and ends[i - a] < z:  # the last run has nothing behind it
            rows = max(1, cells // int(z - i))
            stop = min(z, i + rows)
            # a block of one run meets what follows the run; runs in a block meet what follows its first row's run
            begin = int(ends[i - a])
            stop = min(stop, begin) if begin - i > 1 else stop
            r, c = np.arange(i, stop)[:, None], np.arange(begin, z)[None, :]
            apart = np.zeros((len(r), c.shape[1]), np.uint16)
            for w in bits:
                apart += np.bitwise_count(w[i:stop, None] ^ w[None, begin:z])
            limit = most(r, c)
            ok = (apart <= limit) & (np.abs(n[r] - n[c]) <= limit) & (run[r] != run[c]) & (r < c)
            x, y = np.nonzero(ok)
            yield left(x + i, y + begin)
            i = stop


def _compare(t: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (sig, cell, part's key and check, key, n, sketch, wide) in order of the first four: pairs (hub, key) that may be
    similar. What is held is a batch and the one group that has begun in it."""

    def pairs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        sig, cell, part, check, key, n = (rows.column(i).to_numpy() for i in range(6))
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (cell[1:] != cell[:-1])
        run = new.copy()
        run[1:] |= (part[1:] != part[:-1]) | (check[1:] != check[:-1])
        lists = [pa.concat_arrays(rows.column(i).chunks) for i in (6, 7)]
        sketches, wide = (x.flatten().to_numpy().view(U64).reshape(-1, bits // 64) for x, bits in zip(lists, (SKETCH, WIDE)))
        has = lists[1].is_valid().to_numpy(zero_copy_only=False)
        at = np.where(has, np.cumsum(has) - 1, -1)
        for i, j in _allowed(n, np.cumsum(run), sketches, wide, at, np.cumsum(new), t):
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(key[i], key[j])), pa.array(np.maximum(key[i], key[j]))], ["hub", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            sig, cell = (batch.column(i).to_numpy() for i in range(2))
            last = int(np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (cell[1:] != cell[:-1])]))[-1])
            name = lambda b, i: (b.column(0)[i].as_py(), b.column(1)[i].as_py())
            if held and (last or name(held[-1], len(held[-1]) - 1) != name(batch, 0)):
                yield from pairs([*held, batch.slice(0, last)])
                held = []
            elif last:
                yield from pairs([batch.slice(0, last)])
            held.append(batch.slice(last))
        if held:
            yield from pairs(held)

    return run


def _met(base: DataFrame, n: int, t: int, seed: int, bands: list[Band], hot_rows: int) -> DataFrame:
    """(sig, key): every signature that two sets or more share, in one exchange of all signatures.

    The sets of one text in 64 show the common signatures, of which the 4096 most common ones are dealt by set as well; that
    steers where rows go, not which there are. Rows of a salted signature stay without a look at the others.
    """
    few = base.where(F.pmod("th", F.lit(64)) == 7).select("text").mapInArrow(_sign(n, seed, bands, t), "sig long, key long").distinct()
    hot = few.groupBy("sig").count().where(F.col("count") >= max(2, hot_rows // 64)).orderBy(F.desc("count"), "sig").limit(4096)
    hot = written(hot.select("sig", F.ceil(F.col("count") * 64 / hot_rows).cast("int").alias("salts")), "hot")
    rows = base.select("text").mapInArrow(_sign(n, seed, bands, t), "sig long, key long")
    salt = F.when(F.col("salts").isNull(), -1).otherwise(F.pmod(F.xxhash64("key"), F.col("salts"))).cast("int")
    rows = rows.join(F.broadcast(hot), "sig", "left").select("sig", "key", salt.alias("salt")).repartition("sig", "salt")  # read twice
    shared = rows.groupBy("sig", "salt").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a != b or salt >= 0").select("sig", "salt")
    met = written(rows.join(shared, ["sig", "salt"]).distinct().select("sig", "key"), "met")
    dropped(hot)
    return met


def _refined(open_: DataFrame, told: DataFrame, base: DataFrame, n: int, t: int, seed: int, bands: list[Band], hot_rows: int, levels: int = 3) -> DataFrame:
    """open_(sig, key, part), a written table, with signatures of more than hot_rows sets replaced by those that its sets
    share in another cut of the universe as well: similar sets share one there too."""
    for level in range(1, levels + 1):
        hot = written(open_.groupBy("sig").count().where(F.col("count") > hot_rows).select("sig"), "hot")
        if hot.isEmpty():
            break
        again = open_.join(hot, "sig", "left_semi")
        salt = int(K.mix(np.array([level], U64))[0])
        signed = _texts(again.select("key").distinct(), told, base).select("text").mapInArrow(_sign(n, seed, bands, t, salt), "other long, key long").distinct()
        finer = written(again.join(signed, "key").select(F.xxhash64("sig", "other", F.lit(level)).alias("sig"), "key", "part"), "finer")
        mixed = finer.groupBy("sig").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x != y").select("sig")
        rest = written(open_.join(hot, "sig", "left_anti").unionByName(finer.join(mixed, "sig", "left_semi")), "open")
        dropped(open_, hot, finer)
        open_ = rest
    return open_


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, t: int = 90, seed: int | None = None, hot_rows: int = 20_000) -> DataFrame:
    """One row per input row: id, n_shingles (set size), component_id (least id reachable by links, itself included).

    Rows link when 100 * |intersection| >= t * |union| of their n-word shingle sets, A-Z folded. Null, empty and wordless
    texts have no set and link with nothing. Repeated rows and equal texts are one node. A set that only rows with null ids
    have links with nothing, and their component is null; other null ids share their set's component. Columns beside id and
    text are not read. Empty in, empty out. A set's size counts the distinct 64-bit hashes of its shingles; which shingles
    two sets share is compared by their words. seed: of the hashes' keys, drawn if not given. hot_rows: sets that may share a
    signature before it is refined; from there on comparing sketches costs more than writing the finer signatures.
    """
    seed = K.draw(seed)
    text = F.col(f"`{text_col}`").cast("string")
    base = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(text).alias("th"))
    # sizes only steer the cost model: words by the spaces between them
    size = F.greatest(F.lit(1), F.octet_length("text") - F.octet_length(F.replace("text", F.lit(" "))) + 1 - (n - 1))
    rung = F.floor(F.log(size.cast("double")) / math.log(step(t))).cast("int")
    by = {r["k"]: r["count"] for r in base.where("text is not null").groupBy(rung.alias("k")).count().collect()}  # a dozen rows for each power of ten in size
    bands = [allocate(lo, hi, by.get(int(math.log(lo) / math.log(step(t)) + 1e-9), 0), t) for lo, hi in limits(t)]
    schema = T.StructType([base.schema["id"], base.schema["th"], *[T.StructField(c, T.LongType()) for c in ("n_shingles", "key", "check")], *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("sketch", "wide")]])
    told = written(base.select("id", "text", "th").mapInArrow(_describe(n, seed, to_arrow_schema(schema)), schema), "sets")
    met = _met(base, n, t, seed, bands, hot_rows)
    small = written(told.join(met.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]).select("key", F.col("n_shingles").alias("n"), "sketch", "wide"), "sketches")
    differ = sum((F.bit_count(F.expr(f"asketch[{i}] ^ bsketch[{i}]")) for i in range(SKETCH // 64)), F.lit(0))
    most = F.floor((F.col("an") + F.col("bn")) * (100 - t) / (100 + t))
    apart = F.aggregate(F.zip_with("awide", "bwide", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    near = (differ <= most) & (F.col("awide").isNull() | F.col("bwide").isNull() | (apart <= most))
    shares = met.groupBy("key").agg(F.count(F.lit(1)).alias("deg"))
    may = met.join(shares, "key")
    hub = may.groupBy("sig").agg(F.max(F.struct("deg", "key")).alias("hub"))
    one = may.join(hub, "sig").groupBy("key").agg(F.max("hub").alias("hub")).select(F.col("key"), F.col("hub.key").alias("hub")).where("hub != key")
    side = lambda c: small.select(*[F.col(x).alias(f"{c}{x}") for x in ("key", "n", "sketch", "wide")])
    one = one.join(side("a"), F.col("key") == F.col("akey")).join(side("b"), F.col("hub") == F.col("bkey")).where(near).select("hub", "key")
    pairs = written(one, "pairs")
    links = written(verified(pairs, told, base, n, t, seed), "links")
    dropped(pairs)
    # what still crosses components; a key that two sets share goes by the lesser one's component, which only asks for more pairs
    of = connected_components(links).groupBy("node.key").agg(F.min("component").alias("component"))
    part = met.join(of, "key", "left").select("sig", "key", F.coalesce("component", F.struct("key", F.lit(0).cast("long").alias("check"))).alias("part"))
    mixed = part.groupBy("sig").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x != y").select("sig")
    open_ = _refined(written(part.join(mixed, "sig", "left_semi"), "open"), told, base, n, t, seed, bands, hot_rows)
    hot = written(open_.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / max(1, hot_rows // 2)).cast("int").alias("blocks")).where(F.col("blocks") > 2), "hot")
    rows = open_.withColumn("cell", F.lit(0))
    if not hot.isEmpty():  # in blocks of hot_rows / 2 sets: each two blocks of a signature meet in a cell
        own = open_.join(hot, "sig").withColumn("x", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        other = own.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("x != y")
        cells = other.select(*open_.columns, (F.least("x", "y") * F.col("blocks") + F.greatest("x", "y")).alias("cell"))
        rows = open_.join(hot, "sig", "left_anti").withColumn("cell", F.lit(0)).unionByName(cells)
    rows = rows.join(small, "key").select("sig", "cell", F.col("part.key").alias("part"), F.col("part.check").alias("check"), "key", "n", "sketch", "wide")
    cross = rows.repartition("sig", "cell").sortWithinPartitions("sig", "cell", "part", "check").mapInArrow(_compare(t), "hub long, key long").distinct()
    pairs = written(cross, "pairs")
    more = written(verified(pairs, told, base, n, t, seed), "links")
    all_parts = connected_components(links.unionByName(more))
    dropped(pairs, met, small, open_, hot, links, more)
    node = F.struct("key", "check")
    of_node = told.where("key is not null").groupBy(node.alias("node")).agg(F.min("id").alias("first"))
    named = of_node.join(all_parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    least_id = named.groupBy("part").agg(F.min("first").alias("_least"))
    final = named.join(least_id, "part").select("node", "_least")
    out = told.withColumn("node", F.when(F.col("key").isNotNull(), node)).select("id", "n_shingles", "node")
    return out.join(final, "node", "left").select(F.col("id").alias(id_col), "n_shingles", F.coalesce("_least", "id").alias("component_id"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that 5-word shingles link at 0.8 or more, the rows with the least doc_id.

    Null, empty and wordless texts link with nothing and stay. Repeated rows (one doc_id, one text) all stay or all go; rows
    with a null doc_id stay, as nothing names them. Extra columns pass through under any name. Empty in, empty out.
    """
    found = jaccard_components(docs, n=5, t=80)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])


SQL = {
    "op10_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 90 * (nx.n + ny.n - i)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(y) AS c FROM r GROUP BY x) m USING (doc_id)
"""
}
QUERIES = {"op10_jaccard_join": op10_jaccard_join}
