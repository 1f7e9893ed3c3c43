"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose signal exceeds a cutoff; a setting is a cutoff for each rule, or none. Settings are chosen per
stratum from labelled holdouts, and what is certified is a setting as a whole: the good documents that any of its rules rejects.
A third of the good documents, by a hash of the id, and the bad ones lay a path of settings from mild to strict: the next move
tightens the rule that rejects most bad documents that nothing rejects yet, a good one counting as ten bad ones, and goes there
by every cutoff on its way. The other two thirds, which the path has not seen, certify it: a setting holds while the exact
binomial test rejects "more than alpha of the good documents of this stratum are rejected" at level delta / strata; the first
failure ends the path (fixed-sequence testing needs no further correction along it, and Bonferroni covers the strata). So with
probability 1 - delta, in every stratum, the rules together reject at most alpha of the good documents. Of the certified settings
of its path a stratum takes the one that gains most; strata without enough labelled good documents certify nothing and reject
nothing beyond the base rules.

All labelled documents that pass the base rules count. They are written once as distinct lists of strictness with their counts;
each move is a sum over those that the present settings keep, of which strata x rules x grid rows reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.shared import documents, dropped, written

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER, LETTERS = np.zeros(256, bool), np.zeros(256, bool)
UPPER[65:91] = True
LETTERS[65:91] = LETTERS[97:123] = True
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bangs", "n_echoes")
#: Signals of which more is worse, from the counts.
SIGNALS: dict[str, Callable[[], Column]] = {
    "symbols_a_word": lambda: F.col("n_symbols") / F.col("n_words"),
    "dup_line_share": lambda: F.col("n_dup_lines") / F.col("n_lines"),
    "repeat_share": lambda: F.col("n_repeat_words") / F.col("n_words"),
    "upper_share": lambda: F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)),
    "bangs_a_word": lambda: F.col("n_bangs") / F.col("n_words"),
    "echo_share": lambda: F.col("n_echoes") / F.col("n_words"),
}
#: Cutoffs from mild to strict: 4.0 down to about 0.01, each a twelfth less than the one before.
GRID = [round(4.0 * (11 / 12) ** i, 6) for i in range(70)]


class Rules(NamedTuple):
    """cutoffs: signal -> stratum -> cutoff. report: a dict for each stratum with enough good documents."""

    cutoffs: dict[str, dict[str, float]]
    report: list[dict]


def _sums(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offs])


def _dup_lines(text: bytes) -> tuple[int, int]:
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    again = 0
    for x in lines:
        if x in seen:
            again += bool(x.strip(b" \t\r\x0b\x0c"))
        else:
            seen.add(x)
    return again, len(lines)


def _stats(names: list[str], text: int, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(column: pa.Array) -> dict[str, np.ndarray]:
        found: dict[str, list] = {s: [] for s in STATS}
        for _, _, data, offs in K.parts(column):
            w, n = K.words(data, offs), len(offs) - 1
            per = lambda doc, x=None: np.bincount(doc, x, minlength=n).astype(np.int64)
            solid = ~K.SEP[data]
            at, h = K.windows(w, 8)
            key = K.mix(h ^ K.mix(w.doc[at].astype(np.uint64) + np.uint64(1)))
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            twice = np.zeros(len(at), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            echo = np.zeros(len(w.hash), bool)
            echo[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
            raw = data.tobytes()
            lines = np.array([_dup_lines(raw[offs[i] : offs[i + 1]]) for i in range(n)], np.int64).reshape(n, 2)
            own = {
                "n_words": per(w.doc),
                "word_chars": _sums(solid & ((data & 0xC0) != 0x80), offs),
                "n_symbols": _sums(SYMBOL[data], offs),
                "n_dup_lines": lines[:, 0],
                "n_repeat_words": per(w.doc[K.covered(at[twice], 8, len(w.hash))]),
                "n_lines": lines[:, 1],
                "n_upper": _sums(UPPER[data], offs),
                "n_letters": _sums(LETTERS[data], offs),
                "n_bangs": _sums(data == 33, offs),
                "n_echoes": per(w.doc[echo]),
            }
            for s in STATS:
                found[s].append(own[s])
        return {s: np.concatenate(x) if x else np.zeros(0, np.int64) for s, x in found.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = count(batch.column(text))
            yield pa.RecordBatch.from_arrays([*(batch.column(i).cast(schema.field(i).type) for i in range(len(names))), *(pa.array(stats[s]) for s in STATS)], schema=schema)

    return run


def statistics(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, the counts of STATS and base_failed for each row, over the whole text (null: no words)."""
    text = F.col(f"`{text_col}`")
    plain = text_col in carry and docs.schema[text_col].dataType == T.StringType()
    base = docs.select(*[F.col(f"`{c}`") for c in carry], *([] if plain else [text.cast("string").alias("_text")]))
    schema = T.StructType([*base.schema.fields[: len(carry)], *[T.StructField(s, T.LongType()) for s in STATS]])
    out = base.mapInArrow(_stats(list(carry), carry.index(text_col) if plain else len(carry), to_arrow_schema(schema)), schema)
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed exactly."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def least_good(n_strata: int, alpha: float, delta: float) -> int:
    """Good documents that must test a stratum's path for a setting that rejects none of them to be certified."""
    return math.ceil(math.log(delta / max(1, n_strata)) / math.log1p(-alpha))


class Path:
    """A stratum's way from no cutoffs to stricter settings, and the best setting that was certified on it.

    setting: the number of cutoffs of the grid that each signal has passed, less one. It moves by the counts of documents that it
    keeps: signal -> strictness at which a document is first rejected -> (good that lay the path, good that test it, bad).
    """

    def __init__(self, n_good: int, n_strata: int, alpha: float, delta: float, good_weight: float = 10.0) -> None:
        self.n_good, self.level, self.alpha, self.weight = n_good, delta / max(1, n_strata), alpha, good_weight
        self.setting = dict.fromkeys(SIGNALS, -1)
        self.rejected, self.moves, self.ended = np.zeros(3, np.int64), 0, not n_good
        self.best, self.chosen, self.chosen_rejected = 0.0, dict(self.setting), self.rejected

    def move(self, counts: dict[str, dict[int, tuple[int, int, int]]]) -> None:
        """One move: to the cutoff of one rule that gains most (ties: fewest good documents, the mildest, the first rule)."""
        best = None
        for i, signal in enumerate(SIGNALS):
            guides = bad = 0
            for at in sorted(a for a in counts.get(signal, {}) if self.setting[signal] < a < len(GRID)):
                g, _, b = counts[signal][at]
                guides, bad = guides + g, bad + b
                if (gain := bad - self.weight * guides) > 0 and (best is None or (-gain, guides, at, i) < best[0]):
                    best = (-gain, guides, at, i), signal, at
        if best is None:
            self.ended = True
            return
        self.moves += 1
        _, signal, end = best
        for at in sorted(a for a in counts[signal] if self.setting[signal] < a <= end):
            self.rejected = self.rejected + np.array(counts[signal][at])
            self.setting[signal] = at
            guides, tests, bad = (int(x) for x in self.rejected)
            if binomial_tail(tests, self.n_good, self.alpha) > self.level:
                self.ended = True
                return
            if (gain := bad - self.weight * (guides + tests)) > self.best:
                self.best, self.chosen, self.chosen_rejected = gain, dict(self.setting), self.rejected

    def cutoffs(self) -> dict[str, float]:
        return {signal: GRID[at] for signal, at in self.chosen.items() if at >= 0}


def fit(stats: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", good_col: str = "quality", alpha: float = 0.03, delta: float = 0.05, label_id: str = "doc_id") -> Rules:
    """Cutoffs from every labelled document that passes the base rules. A null stratum is the stratum ''.

    A document is an id: one with several labels is good if one of them is, and of several rows with its id the one that is
    rejected first counts, so copies of a label or of a row add nothing. Ids whose crc32 as text is divisible by 3 lay the paths.
    Only strata with enough good documents to certify a setting reach the driver, of which there are at most one for each
    least_good labelled documents. No labels, or no documents: no cutoffs.
    """
    held = labels.where(F.col(f"`{label_id}`").isNotNull()).groupBy(F.col(f"`{label_id}`").alias("_id")).agg(F.max(F.col(f"`{good_col}`")).alias("_good")).where(F.col("_good").isNotNull())
    own = F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit(""))
    edges = F.array(*[F.lit(x) for x in GRID])
    first = lambda s: F.aggregate(edges, F.lit(0), lambda n, e: n + F.when(s <= e, 1).otherwise(0))  # noqa: E731  rejected from the first cutoff below the signal on
    at = [f"at_{n}" for n in SIGNALS]
    rows = stats.where(~F.col("base_failed")).select(F.col(f"`{id_col}`").alias("_id"), own.alias("stratum"), *[first(s()).alias(f"at_{n}") for n, s in SIGNALS.items()]).join(held, "_id")
    docs = rows.groupBy("_id").agg(F.min("stratum").alias("stratum"), F.max("_good").alias("_good"), *[F.min(a).alias(a) for a in at])
    good, lays = F.col("_good") == 1, F.crc32(F.col("_id").cast("string")) % 3 == 0
    lists = written(docs.groupBy("stratum", *at).agg(F.count_if(good & lays).alias("guides"), F.count_if(good & ~lays).alias("tests"), F.count_if(F.col("_good") == 0).alias("bad")), "strictness")
    sizes = lists.groupBy("stratum").agg(F.sum("guides").alias("guides"), F.sum("tests").alias("tests"), F.sum("bad").alias("bad"))
    n_strata = sizes.count()
    size = {r["stratum"]: r for r in sizes.where(F.col("tests") >= least_good(n_strata, alpha, delta)).collect()}
    paths = {s: Path(r["tests"], n_strata, alpha, delta) for s, r in size.items()}
    while going := [s for s, p in sorted(paths.items()) if not p.ended]:
        for s, counts in _kept_counts(lists, {s: paths[s].setting for s in going}).items():
            paths[s].move(counts)
    dropped(lists)
    cutoffs: dict[str, dict[str, float]] = {n: {} for n in SIGNALS}
    for s, p in sorted(paths.items()):
        for n, cut in p.cutoffs().items():
            cutoffs[n][s] = cut
    report = [
        {"stratum": s, "good_testing": p.n_good, "good_guiding": size[s]["guides"], "bad": size[s]["bad"], "moves": p.moves, "cutoffs": p.cutoffs()}
        | dict(zip(("guiding_rejected", "testing_rejected", "bad_rejected"), (int(x) for x in p.chosen_rejected)))
        for s, p in sorted(paths.items())
    ]
    return Rules(cutoffs, report)


def _kept_counts(lists: DataFrame, settings: dict[str, dict[str, int]]) -> dict[str, dict[str, dict[int, tuple[int, int, int]]]]:
    """For each stratum of settings the counts, by signal and strictness, of documents that its setting keeps."""
    table = lists.sparkSession.createDataFrame([(s, *(c[n] for n in SIGNALS)) for s, c in settings.items()], ", ".join(["stratum string", *(f"to_{n} int" for n in SIGNALS)]))
    kept = lists.join(F.broadcast(table) if len(settings) <= 100_000 else table, "stratum")
    for n in SIGNALS:
        kept = kept.where(F.col(f"at_{n}") > F.col(f"to_{n}"))
    long = kept.select("stratum", "guides", "tests", "bad", F.explode(F.array(*[F.struct(F.lit(n).alias("signal"), F.col(f"at_{n}").alias("at")) for n in SIGNALS])).alias("x"))
    sums = long.groupBy("stratum", "x.signal", "x.at").agg(F.sum("guides").alias("guides"), F.sum("tests").alias("tests"), F.sum("bad").alias("bad")).where(F.col("at") < len(GRID))
    found: dict[str, dict[str, dict[int, tuple[int, int, int]]]] = {s: {} for s in settings}
    for r in sums.collect():
        found[r["stratum"]].setdefault(r["signal"], {})[r["at"]] = (r["guides"], r["tests"], r["bad"])
    return found


def verdict(stats: DataFrame, rules: Rules, stratum: str = "lang") -> DataFrame:
    """Adds kept: false if a base rule fails or a signal exceeds its stratum's cutoff. The cutoffs are a table, a row for each
    stratum that has some; it is broadcast up to 100,000 rows, and joined as Spark sees fit beyond that."""
    strata = sorted({s for cuts in rules.cutoffs.values() for s in cuts})
    table = stats.sparkSession.createDataFrame([(s, *(cuts.get(s) for cuts in rules.cutoffs.values())) for s in strata], ", ".join(["_stratum string", *(f"_cut_{n} double" for n in rules.cutoffs)]))
    if len(strata) <= 100_000:
        table = F.broadcast(table)
    over = F.lit(False)
    for signal in rules.cutoffs:
        over = over | F.coalesce(SIGNALS[signal]() > F.col(f"_cut_{signal}"), F.lit(False))
    kept = ~F.when(F.col("base_failed"), True).otherwise(over)
    joined = stats.join(table, F.coalesce(stats[f"`{stratum}`"].cast("string"), F.lit("")) == table["_stratum"], "left")
    return joined.withColumn("kept", kept).drop(*table.columns)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and verdicts of all documents. Null and empty texts have no words and fail the base rules; a null lang is the
    stratum ''; repeated rows are judged alike, and a row with a null id like others; no documents, no rows."""
    stats = written(statistics(documents(spark, sf_dir), carry=("doc_id", "lang")), "op4")
    rules = fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return verdict(stats, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, with their columns; cutoffs are fitted on the stage's own input.

    Null and empty texts have no words and go by the base rules, as do texts of under 20 words; a null lang is the stratum ''.
    Repeated rows are judged alike and stay or go together; null ids have no label and are judged like others. Extra columns
    pass through under any name. Empty in, empty out. Texts are counted twice, for the fit and for the verdict, as a copy of the
    corpus with its counts would stay on disk until the result is written.
    """
    names = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    stats = written(statistics(plain, names["text"], (names["doc_id"], names["lang"])), "rules")
    rules = fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"), names["lang"], names["doc_id"])
    dropped(stats)
    return verdict(statistics(plain, names["text"], tuple(names.values())), rules, names["lang"]).where("kept").select(*[F.col(n).alias(c) for c, n in names.items()])


QUERIES = {"op4_quality_rules": op4_quality_rules}
