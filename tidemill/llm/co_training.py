"""Quality classifier by co-training: one classifier on text content, one on page metadata, teaching each other.

Views. Content: the text's words and word pairs, folded and hashed to rates, with the shapes of its words - marks, digits,
capitals, echoes - and binned shares of them. Metadata: what is known about the page without its text - language, source,
stated size. No column feeds both views.

Each view is a linear discriminant, so learning is adding up moments: in each round Spark scores every unlabelled document by
both views, takes those of which a view is sure - calibrated probability beyond `sure` - and adds up their moments for the other
view. Pseudo-labels weigh as much as labels at most, and in the labels' proportion of classes. After the last round both views
are calibrated on labelled rows kept out of training (Platt) and their log-odds are combined with weights fitted on the same
rows. All documents, labelled or not, are learned from and scored; only scores of at most sample_rows labelled rows reach the
driver, and sixteen rows of moments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.shared import documents, dropped, written

WORDS, PAIRS = 64, 64  # buckets of hashed words and of word pairs
SHAPES = 32  # classes of words by their bytes
SHARES = np.array([0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7])  # bounds of binned shares
MARKS = ("upper", "symbol", "digit", "bang", "echo", "long")
BINS = len(SHARES) + 1
CONTENT = WORDS + PAIRS + SHAPES + len(MARKS) * BINS
LANGS, SOURCES, SIZES = 64, 64, 32
META = LANGS + SOURCES + SIZES
UPPER, LOWER_, DIGIT, BANG, SYMBOL = (np.zeros(256, bool) for _ in range(5))
UPPER[65:91] = True
LOWER_[97:123] = True
DIGIT[48:58] = True
BANG[list(b"!?")] = True
SYMBOL[list(b"#*$%&|<>@^~=+{}[]_")] = True


def content_features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row for each text: roots of the rates of hashed words, pairs and shapes, and the bins of the shares of marks."""
    w, n = K.words(data, offs, fold=True), len(offs) - 1
    out = np.zeros((n, CONTENT), np.float32)
    total = np.maximum(np.bincount(w.doc, minlength=n), 1)
    if len(w.doc):
        has = lambda mask: np.logical_or.reduceat(np.append(mask[data], False), np.stack([w.start, w.end], 1).ravel())[::2]
        upper, lower, digit, bang, symbol = (has(m) for m in (UPPER, LOWER_, DIGIT, BANG, SYMBOL))
        shout = upper & ~lower & (w.end - w.start > 1)
        after = np.zeros(len(w.doc), bool)
        after[1:] = w.doc[1:] == w.doc[:-1]
        echo = after.copy()
        echo[1:] &= w.hash[1:] == w.hash[:-1]
        marks = [shout, symbol, digit, bang, echo, w.end - w.start > 12]
        pair = np.flatnonzero(after)
        both = K.mix(w.hash[pair - 1] * np.uint64(3) + w.hash[pair])
        rate = lambda doc, x, m: np.sqrt(np.bincount(doc * m + x.astype(np.int64), minlength=n * m).reshape(n, m) / total[:, None])
        out[:, :WORDS] = rate(w.doc, w.hash % np.uint64(WORDS), WORDS)
        out[:, WORDS : WORDS + PAIRS] = rate(w.doc[pair], both % np.uint64(PAIRS), PAIRS)
        out[:, WORDS + PAIRS : WORDS + PAIRS + SHAPES] = rate(w.doc, shout + 2 * symbol + 4 * digit + 8 * bang + 16 * echo, SHAPES)
    else:
        marks = [np.zeros(0, bool)] * len(MARKS)
    for i, m in enumerate(marks):
        at = np.searchsorted(SHARES, np.bincount(w.doc, m, minlength=n) / total, "left")
        out[np.arange(n), WORDS + PAIRS + SHAPES + BINS * i + at] = 1
    return out


def meta_features(langs: list[str | None], sources: list[str | None], sizes: list[int | None]) -> np.ndarray:
    """A row for each page: indicators of language, source and binary size; names beyond the few common ones share buckets."""
    h = lambda x, m: int.from_bytes(hashlib.blake2b((x or "").encode(), digest_size=8).digest(), "little") % m
    out, rows = np.zeros((len(langs), META), np.float32), np.arange(len(langs))
    for at, m, values in ((0, LANGS, langs), (LANGS, SOURCES, sources)):
        known = {x: h(x, m) for x in set(values)}
        out[rows, at + np.array([known[x] for x in values], np.int64)] = 1
    out[rows, LANGS + SOURCES + np.array([min(31, x.bit_length()) if x is not None and x >= 0 else 0 for x in sizes], np.int64)] = 1
    return out


class View(NamedTuple):
    """A linear score and the Platt line that makes it a log-odds."""

    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


class Model(NamedTuple):
    content: View
    metadata: View
    mix: tuple[float, float, float]
    report: dict


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def discriminant(good: np.ndarray, bad: np.ndarray, ridge: float = 0.02) -> View:
    """A view from the moments [1, x] x [1, x] of good and of bad documents: Fisher's linear discriminant, its pooled covariance
    shrunk towards its mean variance."""
    n = [max(m[0, 0], 1e-9) for m in (good, bad)]
    mean = [m[0, 1:] / k for m, k in zip((good, bad), n)]
    within = sum(m[1:, 1:] - k * np.outer(u, u) for m, k, u in zip((good, bad), n, mean)) / max(sum(n), 1)
    within += np.eye(len(within)) * (ridge * np.trace(within) / len(within) + 1e-6)
    return View(np.linalg.solve(within, mean[0] - mean[1]))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.1, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression of a few columns by Newton steps; the intercept is not shrunk."""
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, ridge = np.zeros(a.shape[1]), np.append(np.full(x.shape[1], l2), 1e-3)
    for _ in range(rounds):
        p = _sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(ridge), a.T @ (p - y) + ridge * w)
        w = w - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def views(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", size_col: str = "n_chars") -> DataFrame:
    """(_id, c, m): the features of both views of every row. A null text is an empty one; null metadata are values of their own."""
    base = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{size_col}`").cast("long").alias("size"))
    schema = T.StructType([base.schema["_id"], *[T.StructField(x, T.ArrayType(T.FloatType())) for x in "cm"]])
    arrow = to_arrow_schema(schema)
    listed = lambda x, kind: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())).cast(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in K.parts(batch.column(1)):
                meta = meta_features(*(batch.column(i).slice(a, b - a).to_pylist() for i in (2, 3, 4)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(arrow.field(0).type), listed(content_features(data, offs), arrow.field(1).type), listed(meta, arrow.field(2).type)], schema=arrow)

    return base.mapInArrow(run, schema)


def _moments(rows: DataFrame, model: tuple[View, View] | None, sure: float) -> list[np.ndarray]:
    """Of each view the moments [class, 1 + feature, 1 + feature] over rows (c, m, y): by label where there is no model, else by
    what the other view is sure of. Each task sends one row, which sixteen tasks add up."""
    widths = (CONTENT, META)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, w + 1, w + 1)) for w in widths]
        for batch in batches:
            x = [_matrix(batch.column(i), w) for i, w in enumerate(widths)]
            if model is None:
                told = [batch.column(2).to_numpy(zero_copy_only=False)] * 2
            else:
                p = [_sigmoid(v.logit(m)) for v, m in zip(model, x)]
                told = [np.where(q >= sure, 1, np.where(q <= 1 - sure, 0, -1)) for q in p[::-1]]  # each view learns from the other
            for v, m in enumerate(x):
                for k in (0, 1):
                    own = m[told[v] == k].astype(np.float64)
                    own = np.concatenate([np.ones((len(own), 1)), own], axis=1)
                    sums[v][k] += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([m.ravel() for m in sums]).tobytes()], pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(2 * (w + 1) ** 2 for w in widths))
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    found = rows.select("c", "m", "y").mapInArrow(run, "sums binary").repartition(16).mapInArrow(add, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"]) for r in found), np.zeros(sum(2 * (w + 1) ** 2 for w in widths)))
    cut = 2 * (CONTENT + 1) ** 2
    return [x.reshape(2, w + 1, w + 1) for x, w in zip((total[:cut], total[cut:]), widths)]


def _scores(rows: DataFrame, model: tuple[View, View]) -> np.ndarray:
    """Raw scores of both views and the label, of the few rows kept for calibration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [v.raw(_matrix(batch.column(i), len(v.weights))) for i, v in enumerate(model)]
            yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.float64)) for x in raw), batch.column(2).cast(pa.float64())], ["c", "m", "y"])

    return np.array([tuple(r) for r in rows.select("c", "m", "y").mapInArrow(run, "c double, m double, y double").collect()], float).reshape(-1, 3)


def learned(own: np.ndarray, taught: np.ndarray) -> View:
    """A view from labelled moments [class, ...] and taught ones, scaled to weigh no more than the labelled ones of their class. None
    are taken while a class has none."""
    if taught[:, 0, 0].all():
        own = own + taught * np.minimum(1.0, own[:, 0, 0] / taught[:, 0, 0])[:, None, None]
    return discriminant(own[1], own[0])


def fit(shown: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", sample_rows: int = 8000, rounds: int = 4, sure: float = 0.95) -> Model:
    """A model from shown (views(), a written table) and labels. A quarter of the labelled rows, at most sample_rows, the least by
    a hash of the id, calibrates; all others are counted. A document's label is the greatest of its rows."""
    known = labels.where(F.col(good_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(good_col).cast("int")).alias("y"))
    kept = F.crc32(F.col("_id").cast("string")) % 4 == 0
    # labels are attached once, by one shuffle at any size, so that no round joins; null ids have none
    of = shown.where("_id IS NOT NULL").join(known.hint("shuffle_hash"), "_id", "left").unionByName(shown.where("_id IS NULL").withColumn("y", F.lit(None).cast("int")))
    rows = written(of.select("_id", "c", "m", F.coalesce("y", F.lit(-1)).alias("y")), "told")
    told, rest = rows.where("y >= 0"), rows.where("y < 0")
    held = told.where(kept).orderBy(F.xxhash64("_id"), "c").limit(sample_rows)
    own = _moments(told.where(~kept), None, sure)
    report: dict = {"labelled": int(own[0][:, 0, 0].sum()), "rounds": []}
    pair = tuple(discriminant(m[1], m[0]) for m in own)

    def calibrated(pair: tuple[View, View]) -> tuple[tuple[View, View], np.ndarray]:
        x = _scores(held, pair)
        if len(set(x[:, 2])) < 2:
            return pair, x
        lines = [logistic(x[:, [i]], x[:, 2]) for i in (0, 1)]
        return tuple(v._replace(slope=float(w[0]), shift=b) for v, (w, b) in zip(pair, lines)), x

    pair, x = calibrated(pair)
    for r in range(rounds):
        taught = _moments(rest, pair, sure)
        report["rounds"].append({"round": r, "from_content": int(taught[1][:, 0, 0].sum()), "from_metadata": int(taught[0][:, 0, 0].sum())})
        fresh, x = calibrated(tuple(learned(a, b) for a, b in zip(own, taught)))
        moved = max(np.abs(a.weights - b.weights).max() for a, b in zip(pair, fresh))
        pair = fresh
        if moved < 1e-3:
            break
    dropped(rows)
    mix = (1.0, 0.0, 0.0)
    if len(set(x[:, 2])) == 2:
        both = np.stack([v.slope * x[:, i] + v.shift for i, v in enumerate(pair)], 1)
        w, b = logistic(both, x[:, 2], 1.0)
        w = np.maximum(w, 0)
        mix = (float(w[0]), float(w[1]), float(b))
        report["held_out_right"] = float(((_sigmoid(both @ w + b) >= 0.5) == x[:, 2]).mean())
        report["held_out_right_alone"] = [float(((both[:, i] >= 0) == x[:, 2]).mean()) for i in (0, 1)]
    return Model(*pair, mix, report)


def score(shown: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """id, content_score, metadata_score (calibrated views) and score (combined), 0 to 1, of every row of views()."""
    schema = T.StructType([T.StructField(id_col, shown.schema["_id"].dataType), *[T.StructField(s, T.DoubleType()) for s in ("content_score", "metadata_score", "score")]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, shift = model.mix
        for batch in batches:
            z = [v.logit(_matrix(batch.column(i + 1), len(v.weights))) for i, v in enumerate((model.content, model.metadata))]
            out = [_sigmoid(x) for x in (*z, a * z[0] + b * z[1] + shift)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type), *map(pa.array, out)], schema=arrow)

    return shown.select("_id", "c", "m").mapInArrow(run, schema)


def op2_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, content_score, metadata_score, score (1: good), keep (score of 0.5 or more). Null and empty texts are scored by what
    is known of them; repeated rows get equal scores; an empty table gives none; other columns are not read."""
    shown = written(views(documents(spark, sf_dir)), "views")
    model = fit(shown, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(shown, model).select("doc_id", "content_score", "metadata_score", "score", (F.col("score") >= 0.5).alias("keep"))


QUERIES = {"op2_co_training": op2_co_training}
