"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model over the votes on every document,
and a linear classifier trained on the posterior labels that scores every document.

Features of a text are the presence of words and of word beginnings of 4, 5 and 6 bytes (letters and digits, A-Z folded),
as 64-bit hashes. Seeds, a bounded sample of labelled rows, show which of them mark toxic texts: such words become lexicon
voters, beginnings pattern voters, and shouting and symbols further pattern voters. A voter fires or abstains.

The label model is a tree of voters for each of the hidden classes: P(voter fires | class, its parent fires or not). It estimates
how often voters are right and which ones repeat each other: a word's beginning that fires whenever the word does tells
nothing more. Expectation maximisation fits it to the votes on all documents, labelled or not, as counts of distinct vote
patterns that Spark keeps and adds up round by round; the seeds only start it and weigh as much as all documents together,
which keeps the classes in their places. The classifier, logistic over a small vocabulary, learns the model's posteriors - not
labels - on the seeds' texts; its scale and intercept are calibrated on the seeds (Platt) and set to the labelled rows' share of toxic ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.shared import documents, dropped, written

U64 = np.uint64
BEGINNINGS = (4, 5, 6)
BANGS = np.zeros(256, bool)
BANGS[list(b"!?")] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>@")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
#: Pattern voters on a text's shape: bytes of a class, and the share of all bytes from which they fire.
SHAPES = ((BANGS, 0.02), (SYMBOLS, 0.02), (UPPER, 0.3))


class Model(NamedTuple):
    """vocabulary: sorted feature hashes; weights: theirs; intercept; the voters' part for the report."""

    vocabulary: np.ndarray
    weights: np.ndarray
    intercept: float
    report: dict


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document index, feature hash) of every word and word beginning; repeats included."""
    w = K.words(data, offs, fold=True, sep=K.PUNCT)
    docs, values = [w.doc], [w.hash]
    for k in BEGINNINGS:
        at, h = K.prefixes(data, w, k)
        docs.append(w.doc[at])
        values.append(h)
    return np.concatenate(docs), np.concatenate(values)


def shapes(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which shape voters fire, a row per document."""
    n = np.maximum(np.diff(offs), 1)
    return np.stack([np.diff(np.concatenate([[0], np.cumsum(mask[data])])[offs]) >= share * n for mask, share in SHAPES], axis=1)


class Lookup:
    """Places of hashes in a sorted vocabulary, behind a bitmap that turns most others away."""

    def __init__(self, vocabulary: np.ndarray) -> None:
        self.v, self.bits = vocabulary, np.zeros(1 << 20, bool)
        self.bits[(vocabulary & U64((1 << 20) - 1)).astype(np.int64)] = True

    def __call__(self, docs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, place) of the hashes that the vocabulary has."""
        if not len(self.v):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        may = self.bits[(values & U64((1 << 20) - 1)).astype(np.int64)]
        docs, values = docs[may], values[may]
        at = np.minimum(np.searchsorted(self.v, values), len(self.v) - 1)
        hit = self.v[at] == values
        both = np.unique(docs[hit].astype(np.int64) * len(self.v) + at[hit])
        return both // len(self.v), both % len(self.v)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (text, label): feature, rows of label 1 and of label 0 that have it, summed within a part."""
    for batch in batches:
        label = np.array(batch.column(1).to_pylist(), np.int64)
        for a, b, data, offs in K.parts(batch.column(0)):
            docs, values = features(data, offs)
            order = np.lexsort((docs, values))
            docs, values = docs[order], values[order]
            fresh = np.ones(len(values), bool)
            fresh[1:] = (values[1:] != values[:-1]) | (docs[1:] != docs[:-1])
            docs, values = docs[fresh], values[fresh]
            head = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
            ones = label[a:b][docs]
            pos = np.add.reduceat(ones, head) if len(head) else head
            size = np.diff(np.concatenate([head, [len(values)]])) if len(head) else head
            yield pa.RecordBatch.from_arrays([pa.array(values[head].view(np.int64)), pa.array(pos, pa.int64()), pa.array(size - pos, pa.int64())], ["feature", "pos", "neg"])


def _hits(vocabulary: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(vocabulary)
        for batch in batches:
            for a, b, data, offs in K.parts(batch.column(0)):
                docs, at = find(*features(data, offs))
                lists = np.split(at, np.searchsorted(docs, np.arange(1, b - a)))
                fired = shapes(data, offs)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array([x.tolist() for x in lists], pa.list_(pa.int32())), pa.array([x.tolist() for x in fired], pa.list_(pa.bool_()))], ["label", "hits", "shapes"])

    return run


def vote_patterns(docs: DataFrame, lexicon: np.ndarray, text_col: str = "text") -> DataFrame:
    """(votes, n): each distinct pattern of votes of the lexicon (sorted hashes) and the shapes, packed, and its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(lexicon)
        for batch in batches:
            for a, b, data, offs in K.parts(batch.column(0)):
                votes = np.zeros((b - a, len(lexicon) + len(SHAPES)), bool)
                at, which = find(*features(data, offs))
                votes[at, which] = True
                votes[:, len(lexicon) :] = shapes(data, offs)
                rows, n = np.unique(np.packbits(votes, axis=1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in rows], pa.binary()), pa.array(n, pa.int64())], ["votes", "n"])

    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "votes binary, n long")
    return rows.groupBy("votes").agg(F.sum("n").alias("n"))


class LabelModel(NamedTuple):
    """parent: of each voter the one it leans on (-1: none); fires[class, parent's vote, voter]; prior of class 1. The last voter
    says that no other fires."""

    parent: np.ndarray
    fires: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(class 1) of rows of votes. A voter that fires is evidence given its parent's vote; one that abstains is none, as
        voters for one language are quiet on the others."""
        v = votes.astype(np.float64)
        led = np.where(self.parent >= 0, v[:, self.parent], 0.0)
        odds = np.log(self.fires[1] / self.fires[0])
        z = np.log(self.prior / (1 - self.prior)) + (v * (led * odds[1] + (1 - led) * odds[0])).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def with_none(votes: np.ndarray) -> np.ndarray:
    return np.concatenate([votes, ~votes.any(axis=1, keepdims=True)], axis=1)


def moments(votes: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of each class the weighted counts of pairs of voters that fire together, with a last column of ones: [class, i, j]."""
    v = np.concatenate([votes, np.ones((len(votes), 1))], axis=1).astype(np.float64)
    return np.stack([(v * (p * weight)[:, None]).T @ v for p in (1 - toxic, toxic)])


def tree(m: np.ndarray) -> np.ndarray:
    """Each voter's parent in the tree that shares most information within the classes (Chow and Liu); -1 where it shares no more
    than chance would."""
    total = m[:, -1, -1]
    n, one, both = total[:, None, None], np.diagonal(m, axis1=1, axis2=2)[:, :-1], m[:, :-1, :-1]
    k = one.shape[1]
    info = np.zeros((k, k))
    for c in range(2):
        cells = [both[c], one[c][:, None] - both[c], one[c][None, :] - both[c], n[c] - one[c][:, None] - one[c][None, :] + both[c]]
        a, b = one[c] / max(total[c], 1e-9), 1 - one[c] / max(total[c], 1e-9)
        for cell, x, y in zip(cells, (a, a, b, b), (a, b, a, b)):
            p = np.maximum(cell, 0) / max(total[c], 1e-9)
            info += total[c] * p * np.log(np.maximum(p, 1e-12) / np.maximum(np.outer(x, y), 1e-12))
    info[:, -1] = info[-1, :] = -1.0  # that no other voter fires stands alone
    np.fill_diagonal(info, -1.0)
    parent = np.full(k, -1)
    left = set(range(k - 1)) - {0}
    best, lead = info[0].copy(), np.zeros(k, int)
    while left:
        i = max(left, key=lambda j: (best[j], -j))
        left.remove(i)
        if best[i] > 3.84 / 2:  # no chance association at one in twenty
            parent[i] = lead[i]
        more = info[i] > best
        best, lead = np.where(more, info[i], best), np.where(more, i, lead)
    return parent


def maximised(m: np.ndarray, parent: np.ndarray, smooth: float = 0.05) -> LabelModel:
    """The rates of largest likelihood along a tree for these moments, lightly smoothed."""
    total, one, both = m[:, -1, -1], np.diagonal(m, axis1=1, axis2=2)[:, :-1], m[:, :-1, :-1]
    k = one.shape[1]
    fires = np.zeros((2, 2, k))
    for c in range(2):
        with_parent = both[c][np.arange(k), np.maximum(parent, 0)] * (parent >= 0)
        led = one[c][np.maximum(parent, 0)] * (parent >= 0)
        fires[c, 1] = (with_parent + smooth) / (led + 2 * smooth)
        fires[c, 0] = (one[c] - with_parent + smooth) / (total[c] - led + 2 * smooth)
    return LabelModel(parent, np.clip(fires, 1e-6, 1 - 1e-6), float(np.clip(total[1] / max(total.sum(), 1e-9), 1e-3, 1 - 1e-3)))


def label_model(patterns: DataFrame, seeds: np.ndarray, seed_toxic: np.ndarray, rounds: int = 12, parts: int = 16) -> tuple[LabelModel, list[dict]]:
    """EM over patterns(votes binary, n), a written table of packed votes and how many documents cast them. Starts from the seeds'
    votes and classes, whose moments weigh as much as those of all documents in every round; which voters repeat each other is
    read from the seeds, as a tree that could move would take the classes' part."""
    own = with_none(seeds)
    first = moments(own, seed_toxic.astype(float), np.ones(len(own)))
    parent = tree(first)
    model, k, told = maximised(first, parent), seeds.shape[1], []
    documents_ = patterns.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    few = patterns.coalesce(parts)
    for r in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], model: LabelModel = model) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, k + 2, k + 2))
            for batch in batches:
                if len(batch):
                    raw = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(len(batch), -1)
                    v = with_none(np.unpackbits(raw, axis=1)[:, :k].astype(bool))
                    total += moments(v, model.posterior(v), batch.column(1).to_numpy(zero_copy_only=False).astype(float))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        got = few.mapInArrow(expect, "sums binary").collect() if documents_ else []  # parts rows of (voters + 2) ** 2 numbers
        all_ = sum((np.frombuffer(x["sums"]).reshape(first.shape) for x in got), np.zeros(first.shape))
        fresh = maximised(first + all_ * (len(own) / max(documents_, 1)), parent)
        moved = float(np.abs(fresh.fires - model.fires).max())
        told.append({"round": r, "prior": fresh.prior, "moved": moved})
        model = fresh
        if moved < 1e-3:
            break
    return model, told


def logistic(rows: np.ndarray, cols: np.ndarray, n: int, m: int, y: np.ndarray, l2: float = 1.0, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on a 0/1 matrix given by its ones, with soft labels, by accelerated gradient steps."""
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    lw, lb, t = w, b, 1.0
    heavy = np.bincount(rows, minlength=n).max(initial=0) + 1
    step = 4.0 / (heavy * max(n, 1) / 4 + l2)
    for _ in range(rounds):
        z = np.bincount(rows, w[cols], minlength=n) + b
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        nw, nb = w - step * (np.bincount(cols, g[rows], minlength=m) + l2 * w), b - step * g.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, b = nw + (t - 1) / t2 * (nw - lw), nb + (t - 1) / t2 * (nb - lb)
        lw, lb, t = nw, nb, t2
    return lw, lb


def calibration(z: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Platt's line: slope and shift that turn scores into log-odds of the labels, by Newton steps."""
    a, w = np.stack([z, np.ones(len(z))], 1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag([1e-3, 1e-3]), a.T @ (p - y) + 1e-3 * (w - [1.0, 0.0]))
        w = w - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = 6000, voters: int = 96, vocabulary: int = 2048) -> Model:
    """A model from seeds, at most sample_rows labelled documents of each class, the least by a hash of the id, and from the votes
    on all documents. Rows whose crc32(id as text) mod 5 is 0 are held out: their labels are never read. A document's label is
    the greatest of its rows; of several texts with its id the least counts."""
    spark = docs.sparkSession
    held = F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 == 0
    known = labels.where(F.col(f"`{id_col}`").isNotNull() & ~held & F.col(f"`{label_col}`").isin(0, 1)).groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.max(F.col(f"`{label_col}`").cast("int")).alias("_label"))
    share = known.agg(F.coalesce(F.avg("_label"), F.lit(0.5))).first()[0]
    few = [known.where(F.col("_label") == c).orderBy(F.xxhash64("_id")).limit(sample_rows) for c in (0, 1)]
    wanted = few[0].unionByName(few[1])  # at most 2 * sample_rows rows
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    one = texts.join(F.broadcast(wanted), "_id").groupBy("_id").agg(F.min("text").alias("text"), F.max("_label").alias("label"))
    rows = written(one.select("text", "label"), "toxic-seeds").repartition(2 * spark.sparkContext.defaultParallelism)
    sums = rows.mapInArrow(_counts, "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where("pos + neg >= 3")
    size = rows.groupBy("label").count().collect()
    n1, n0 = (sum(r["count"] for r in size if r["label"] == c) for c in (1, 0))
    if not n1 or not n0:
        return Model(np.zeros(0, U64), np.zeros(0), float(np.log((share + 1e-3) / (1 - share + 1e-3))), {"voters": 0})
    # log-likelihood ratio (G) of the feature against the class; sign by which class has it more often
    p, q = F.col("pos") / n1, F.col("neg") / n0
    mean = (F.col("pos") + F.col("neg")) / (n1 + n0)
    part = lambda k, n: F.when(k > 0, k * F.log(k / (n * mean))).otherwise(0.0) + F.when(k < n, (n - k) * F.log((n - k) / (n * (1 - mean)))).otherwise(0.0)
    scored = sums.where(F.col("pos") + F.col("neg") < n1 + n0).withColumn("g", part(F.col("pos"), F.lit(float(n1))) + part(F.col("neg"), F.lit(float(n0)))).withColumn("up", p > q)
    best = scored.where("g > 12").orderBy(F.desc("g"), "feature").limit(vocabulary).collect()  # 12: one in a million by chance
    lexicon = [r["feature"] for r in best if r["up"] and r["pos"] >= 3 and (r["neg"] + 0.5) / n0 * 8 < r["pos"] / n1][:voters]
    lexicon = np.sort(np.array(lexicon, np.int64).view(U64))
    vocab = np.sort(np.array([r["feature"] for r in best], np.int64).view(U64))
    got = rows.mapInArrow(_hits(vocab), "label int, hits array<int>, shapes array<boolean>").collect()
    rows_ = np.concatenate([np.full(len(r["hits"]), i) for i, r in enumerate(got)]).astype(np.int64)
    cols_ = np.concatenate([np.array(r["hits"], np.int64) for r in got])
    votes = np.zeros((len(got), len(lexicon) + len(SHAPES)), bool)
    column = np.full(len(vocab), -1)
    column[np.searchsorted(vocab, lexicon)] = np.arange(len(lexicon))
    on = column[cols_] >= 0 if len(cols_) else np.zeros(0, bool)
    votes[rows_[on], column[cols_[on]]] = True
    votes[:, len(lexicon) :] = np.array([r["shapes"] for r in got], bool).reshape(len(got), len(SHAPES))
    patterns = written(vote_patterns(docs, lexicon, text_col), "votes")
    labeller, told = label_model(patterns, votes, np.array([r["label"] for r in got]))
    dropped(patterns)
    post = labeller.posterior(with_none(votes))
    w, b = logistic(rows_, cols_, len(got), len(vocab), post)
    truth = np.array([r["label"] for r in got])
    z = np.bincount(rows_, w[cols_], minlength=len(got)) + b
    slope, shift = calibration(z, truth)
    w, b = w * slope, b * slope + shift
    b += float(np.log((share + 1e-3) / (1 - share + 1e-3)) - np.log((n1 + 1e-3) / (n0 + 1e-3)))
    report = {"voters": votes.shape[1], "seeds": int(n1 + n0), "rounds": told, "leaning": int((labeller.parent >= 0).sum()), "fires": labeller.fires.round(4).tolist()}
    return Model(vocab, w, b, report)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1) of every row, over its whole text; a null or empty text has no features and gets the base rate."""
    base = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    schema = T.StructType([base.schema[0], T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(model.vocabulary)
        for batch in batches:
            out = [np.zeros(0)]
            for a, b, data, offs in K.parts(batch.column(1)):
                docs_, at = find(*features(data, offs))
                z = np.bincount(docs_, model.weights[at], minlength=b - a) + model.intercept
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type), pa.array(np.concatenate(out))], schema=arrow)

    return base.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op6_toxicity": op6_toxicity}
