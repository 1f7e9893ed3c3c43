"""Bars: versioned deduplication, scans, coverage, gaps, quality, set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import rounded
from tidemill.plans.registry import query
from tidemill.sources import views as V

KEY = ("symbol", "ts")


def latest(bars: DataFrame, key: tuple[str, ...] = KEY, version: tuple[str, ...] = ("ingested_at", "id")) -> DataFrame:
    """WIN-01: of each key the row ingested last, the id breaking ties. One aggregate, no window over a hot key."""
    rest = [c for c in bars.columns if c not in key]
    newest = bars.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_row"))
    return newest.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def between(bars: DataFrame, start: str | None = None, end: str | None = None, inclusive: bool = True) -> DataFrame:
    """SRC-01/02, PRJ-06: bars from start to end, the end in or out. On the key, so the filter reaches the scan."""
    if start:
        bars = bars.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        stop = F.lit(end).cast("timestamp_ntz")
        bars = bars.where(F.col("ts") <= stop if inclusive else F.col("ts") < stop)
    return bars


def last_n(bars: DataFrame, n: int) -> DataFrame:
    """SRC-03, SRT-01/03: the last n bars of each symbol, ascending."""
    w = Window.partitionBy("symbol").orderBy(F.desc("ts"))
    return bars.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def coverage(bars: DataFrame) -> DataFrame:
    """AGG-01: first and last bar and distinct bars of each symbol."""
    return bars.groupBy("symbol").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.countDistinct("ts").alias("n_bars"))


def missing_grid(bars: DataFrame, step: str) -> DataFrame:
    """SET-06, PRJ-20: steps between a symbol's first and last bar that have no bar."""
    span = bars.groupBy("symbol").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    grid = span.select("symbol", F.explode(F.sequence("a", "b", F.expr(step))).alias("ts"))
    return grid.join(bars.select(*KEY).distinct(), list(KEY), "left_anti")


def first_gap(bars: DataFrame, step: str) -> DataFrame:
    """JN-05: the first step after a bar, before the last bar, that has no bar itself."""
    seen = bars.select(*KEY).distinct()
    nxt = seen.select("symbol", (F.col("ts") + F.expr(step)).alias("ts"))
    last = seen.groupBy("symbol").agg(F.max("ts").alias("last"))
    return nxt.join(seen, list(KEY), "left_anti").join(last, "symbol").where("ts < last").groupBy("symbol").agg(F.min("ts").alias("gap_ts"))


def quality(bars: DataFrame, step_seconds: int) -> DataFrame:
    """AGG-07: expected and actual bars, missing share, the largest gap and where it begins."""
    w = Window.partitionBy("symbol").orderBy("ts")
    at = bars.select("symbol", "ts", V.epoch("ts").alias("s")).withColumn("prev", F.lag("ts").over(w)).withColumn("gap", F.col("s") - F.lag("s").over(w))
    agg = at.groupBy("symbol").agg(F.count(F.lit(1)).alias("actual"), F.min("s").alias("a"), F.max("s").alias("b"), F.max("gap").alias("g"), F.max_by("prev", F.struct("gap", -V.epoch("prev"))).alias("gap_from"))
    expected = F.floor((F.col("b") - F.col("a")) / step_seconds) + 1
    return agg.select("symbol", expected.alias("expected"), "actual", ((expected - F.col("actual")) * 100.0 / expected).alias("missing_pct"), F.floor(F.col("g") / 60).alias("largest_gap_min"), "gap_from")


def distinct_times(bars: DataFrame) -> DataFrame:
    """PRJ-01: the keys that come more than once; a frame is valid where there are none."""
    return bars.groupBy(*KEY).count().where("count > 1").select(*KEY, F.col("count").alias("copies"))


def contiguous(bars: DataFrame, step_seconds: int) -> DataFrame:
    """SET-07: whether each symbol's day has all steps between its first and last bar."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    s = V.epoch("ts")
    return bars.groupBy("symbol", day).agg(F.count(F.lit(1)).alias("n"), ((F.max(s) - F.min(s)) / step_seconds + 1 == F.countDistinct(s)).alias("contiguous"))


def closed(bars: DataFrame, now: Column, step: str) -> DataFrame:
    """SRC-09/10: bars whose last instant is before now."""
    return bars.where(F.col("ts") + F.expr(step) <= now)


BARS = ", ".join(("symbol", "ts", "open", "high", "low", "close", "round(volume, 6) AS volume", "CAST(num_trades AS BIGINT) AS num_trades", "round(taker, 6) AS taker"))
LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, ts ORDER BY ingested_at DESC, id DESC) AS rn FROM bars_raw) WHERE rn = 1"


@query("win01_latest_version", V.sql("bars_raw", f"SELECT {BARS}, CAST(id AS BIGINT) AS id FROM ({LATEST})"))
def win01(spark: SparkSession, d: str) -> DataFrame:
    return rounded(latest(V.bars_raw(spark, d)).drop("ingested_at"))


@query("src01_bars_inclusive", V.sql("bars_raw", f"SELECT {BARS} FROM ({LATEST}) WHERE ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-05 00:00:00'"))
def src01(spark: SparkSession, d: str) -> DataFrame:
    return rounded(latest(between(V.bars_raw(spark, d), "2024-01-03 00:00:00", "2024-01-05 00:00:00")).drop("ingested_at", "id"))


@query("src02_bars_half_open", V.sql("bars_raw", f"SELECT {BARS} FROM ({LATEST}) WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-05 00:00:00'"))
def src02(spark: SparkSession, d: str) -> DataFrame:
    return rounded(latest(between(V.bars_raw(spark, d), "2024-01-03 00:00:00", "2024-01-05 00:00:00", False)).drop("ingested_at", "id"))


@query("src03_last_n", V.sql("bars_raw", f"SELECT {BARS} FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS k FROM ({LATEST})) WHERE k <= 50"))
def src03(spark: SparkSession, d: str) -> DataFrame:
    return rounded(last_n(latest(V.bars_raw(spark, d)).drop("ingested_at", "id"), 50))


@query("src09_closed_bars", V.sql("bars_15m", f"SELECT {BARS} FROM bars_15m WHERE ts + INTERVAL 15 MINUTE <= TIMESTAMP '2024-01-10 10:05:00'"))
def src09(spark: SparkSession, d: str) -> DataFrame:
    return rounded(closed(V.bars_15m(spark, d), F.lit("2024-01-10 10:05:00").cast("timestamp_ntz"), "INTERVAL 15 MINUTE"))


@query("agg01_coverage", V.sql("bars_15m", "SELECT symbol, min(ts) AS first_ts, max(ts) AS last_ts, CAST(count(DISTINCT ts) AS BIGINT) AS n_bars FROM bars_15m GROUP BY symbol"))
def agg01(spark: SparkSession, d: str) -> DataFrame:
    return coverage(V.bars_15m(spark, d))


@query("jn05_first_gap", V.sql("bars_15m", "SELECT symbol, min(ts + INTERVAL 15 MINUTE) AS gap_ts FROM bars_15m a WHERE NOT EXISTS (SELECT 1 FROM bars_15m b WHERE b.symbol = a.symbol AND b.ts = a.ts + INTERVAL 15 MINUTE) AND a.ts + INTERVAL 15 MINUTE < (SELECT max(ts) FROM bars_15m c WHERE c.symbol = a.symbol) GROUP BY symbol"))
def jn05(spark: SparkSession, d: str) -> DataFrame:
    return first_gap(V.bars_15m(spark, d), "INTERVAL 15 MINUTE")


@query("set06_missing_grid", V.sql("bars_15m", "SELECT g.symbol, g.ts FROM (SELECT symbol, unnest(generate_series(min(ts), max(ts), INTERVAL 15 MINUTE)) AS ts FROM bars_15m GROUP BY symbol) g LEFT JOIN bars_15m b ON b.symbol = g.symbol AND b.ts = g.ts WHERE b.ts IS NULL"))
def set06(spark: SparkSession, d: str) -> DataFrame:
    return missing_grid(V.bars_15m(spark, d), "INTERVAL 15 MINUTE")


@query(
    "agg07_quality",
    V.sql(
        "bars_15m",
        """WITH p AS (SELECT symbol, ts, lag(ts) OVER (PARTITION BY symbol ORDER BY ts) AS prev FROM bars_15m),
q AS (SELECT symbol, CAST((epoch(max(ts)) - epoch(min(ts))) / 900 + 1 AS BIGINT) AS expected, count(*) AS actual, max(epoch(ts) - epoch(prev)) AS g FROM p GROUP BY symbol)
SELECT symbol, expected, CAST(actual AS BIGINT) AS actual, round((expected - actual) * 100.0 / expected, 6) AS missing_pct, CAST(g / 60 AS BIGINT) AS largest_gap_min,
(SELECT min(prev) FROM p WHERE p.symbol = q.symbol AND epoch(ts) - epoch(prev) = g) AS gap_from FROM q""",
    ),
)
def agg07(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality(V.bars_15m(spark, d), 900))


@query("prj01_duplicate_times", V.sql("bars_raw", "SELECT symbol, ts, CAST(count(*) AS BIGINT) AS copies FROM bars_raw GROUP BY ALL HAVING count(*) > 1"))
def prj01(spark: SparkSession, d: str) -> DataFrame:
    return distinct_times(V.bars_raw(spark, d))


@query("set07_contiguous", V.sql("bars_1h", "SELECT symbol, strftime(ts, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n, ((epoch(max(ts)) - epoch(min(ts))) / 3600 + 1 = count(DISTINCT ts)) AS contiguous FROM bars_1h GROUP BY ALL"))
def set07(spark: SparkSession, d: str) -> DataFrame:
    return contiguous(V.bars_1h(spark, d), 3600)


@query("set01_union_batches", V.sql("bars_1h", f"SELECT {BARS} FROM bars_1h WHERE ts < TIMESTAMP '2024-01-10' UNION ALL SELECT {BARS} FROM bars_1h WHERE ts >= TIMESTAMP '2024-01-05'"))
def set01(spark: SparkSession, d: str) -> DataFrame:
    """SET-01: batches appended, overlaps and all."""
    b = rounded(V.bars_1h(spark, d))
    return between(b, None, "2024-01-10 00:00:00", False).unionByName(between(b, "2024-01-05 00:00:00"))


@query("set02_keep_last", V.sql("bars_1h", f"SELECT {BARS} FROM bars_1h WHERE ts < TIMESTAMP '2024-01-05' UNION ALL BY NAME SELECT * REPLACE (close + 2 AS close) FROM (SELECT {BARS} FROM bars_1h WHERE ts >= TIMESTAMP '2024-01-05')"))
def set02(spark: SparkSession, d: str) -> DataFrame:
    """SET-02: of two batches the later one's bars win."""
    b = rounded(V.bars_1h(spark, d))
    late = between(b, "2024-01-05 00:00:00").withColumn("close", F.col("close") + 2).withColumn("batch", F.lit(2))
    return latest(b.withColumn("batch", F.lit(1)).unionByName(late), version=("batch",)).drop("batch")


@query("set03_distinct_windows", "SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, ts) AS epoch, event_type FROM events")
def set03(spark: SparkSession, d: str) -> DataFrame:
    return V.events(spark, d).select(F.timestamp_seconds(F.floor(V.epoch("ts") / 900) * 900).cast("timestamp_ntz").alias("epoch"), "event_type").distinct()


@query("set04_subscriptions", "SELECT DISTINCT user_id FROM events WHERE event_type = 'click' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND ts >= TIMESTAMP '2024-01-20')")
def set04(spark: SparkSession, d: str) -> DataFrame:
    """SET-04: wanted keys that are not yet there."""
    ev = V.events(spark, d)
    there = ev.where((F.col("event_type") == "signup") & (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")))
    return ev.where("event_type = 'click'").select("user_id").distinct().join(there.select("user_id"), "user_id", "left_anti")


@query("set05_both_sides", "SELECT user_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase' AND ts < TIMESTAMP '2024-01-03'")
def set05(spark: SparkSession, d: str) -> DataFrame:
    ev = V.events(spark, d)
    return ev.where("event_type = 'click'").select("user_id").intersect(ev.where((F.col("event_type") == "purchase") & (F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz"))).select("user_id"))


@query("srt02_stable_sort", V.sql("trades", "SELECT token, t, seq, price, CAST(row_number() OVER (PARTITION BY token ORDER BY t, seq) AS BIGINT) AS place FROM trades"))
def srt02(spark: SparkSession, d: str) -> DataFrame:
    """SRT-02, STR-23: a total order by time and sequence."""
    return V.trades(spark, d).select("token", "t", "seq", "price", F.row_number().over(Window.partitionBy("token").orderBy("t", "seq")).cast("bigint").alias("place"))


@query("srt08_retention", "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 6")
def srt08(spark: SparkSession, d: str) -> DataFrame:
    """SRT-08: the last seven days up to a date."""
    return V.events(spark, d).where(F.to_date("ts") >= F.date_sub(F.lit("2024-01-30").cast("date"), 6)).select("event_id", "ts")


@query("src24_sql_passthrough", V.sql("bars_1h", "SELECT symbol, CAST(count(*) AS BIGINT) AS n, round(avg(close), 6) AS mean_close FROM bars_1h WHERE high > low GROUP BY symbol"))
def src24(spark: SparkSession, d: str) -> DataFrame:
    """SRC-24: SQL of the caller's over the bars."""
    return rounded(spark.sql("SELECT symbol, count(*) AS n, avg(close) AS mean_close FROM {bars} WHERE high > low GROUP BY symbol", bars=V.bars_1h(spark, d)))
