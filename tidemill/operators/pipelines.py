"""Composed pipelines: daily artifacts, replay and reconciliation, gap repair, incremental loads, replay diff and settlement."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import ratio, rounded
from tidemill.functions.frames import forward
from tidemill.functions.scratch import scratch
from tidemill.operators import bars as B
from tidemill.operators import features as X
from tidemill.operators import model as M
from tidemill.operators import ladder, onset, rules, walk
from tidemill.plans.registry import query
from tidemill.sources import sinks
from tidemill.sources import views as V

c = F.col
DAY = 86_400


# PIPE-04: daily artifacts


class Build(NamedTuple):
    """How artifacts are built. Steps are bars of step_s seconds; the values are chosen defaults."""

    step_s: int = 3600
    windows: tuple[int, ...] = (5, 15)
    horizons: tuple[int, ...] = (1, 3, 5)
    weights: tuple[float, ...] = (0.2, 0.3, 0.5)
    group: int = 15
    train_days: int = 5
    pool_days: int = 4
    least_rows: int = 30
    least_pool: int = 20


def prepared(bars: DataFrame, b: Build) -> DataFrame:
    """Features (Parkinson), targets (mean absolute log return of the next h bars), forward returns and minutes to the strike."""
    w = X.W()
    x = bars.withColumn("_r", F.abs(F.log(ratio(c("close"), F.lag("close").over(w)))))
    feats = [X.parkinson(n).alias(f"pk_{n}") for n in b.windows]
    targets = [forward(F.avg, c("_r"), h, w).alias(f"mar_next_{h}") for h in b.horizons]
    ttl = X.time_to_strike(F.pmod(F.floor(V.epoch("ts") / b.step_s), F.lit(b.group)).cast("int"), b.group)
    ahead = F.array(*[X.forward_return(n) for n in range(1, b.group + 1)])
    return x.select("symbol", "ts", "close", *feats, *targets, ttl.alias("ttl"), ahead.alias("ahead"))


def trained(rows: DataFrame, b: Build) -> DataFrame:
    """AGG-23: a model for each symbol, score day and horizon, from the rows of the train_days days before it, less the horizon."""
    targets = {h: (f"mar_next_{h}", h * b.step_s) for h in b.horizons}
    return walk.walk_fit(rows, V.epoch("ts"), targets, [f"pk_{n}" for n in b.windows], b.train_days, b.least_rows, ("symbol",)).where("intercept IS NOT NULL")


def scored_days(rows: DataFrame, models: DataFrame, b: Build) -> DataFrame:
    """Each row by its own day's models: pred_h, their blend and the volatility to the strike; NULL without all models."""
    m = models.withColumn("one", F.struct("intercept", *[f"b_pk_{n}" for n in b.windows])).groupBy("symbol", "score_day").agg(F.map_from_entries(F.collect_list(F.struct("horizon", "one"))).alias("by"))
    day = rows.withColumn("score_day", F.floor(V.epoch("ts") / DAY)).join(m, ["symbol", "score_day"])
    at = lambda h, f: F.try_element_at(c("by"), F.lit(h))[f]
    preds = {f"pred_{h}": reduce(lambda a, n: a + at(h, f"b_pk_{n}") * c(f"pk_{n}"), b.windows, at(h, "intercept")) for h in b.horizons}
    blend = reduce(lambda a, x: a + x, [w * c(f"pred_{h}") for w, h in zip(b.weights, b.horizons)])
    return day.withColumns(preds).withColumn("mar", blend).withColumn("sigma", X.sigma_over(c("mar"), c("ttl"))).drop("by")


def pools(scored: DataFrame, b: Build) -> DataFrame:
    """AGG-24: the z values - forward returns to the strike over their volatility - of each symbol and day as sorted runs; a score day's
    pool is those of the pool_days days before it, less one group of bars."""
    z = scored.select("symbol", V.epoch("ts").alias("s"), ratio(F.try_element_at(c("ahead"), c("ttl").cast("int")), c("sigma")).alias("z"))
    return walk.day_runs(z, c("s"), "z", b.group * b.step_s)


def window_quality(bars: DataFrame, days: DataFrame, b: Build) -> DataFrame:
    """AGG-07: bars expected and there in each score day's training window: sums of the days' counts."""
    day = bars.groupBy("symbol", F.floor(V.epoch("ts") / DAY).alias("score_day")).agg(F.countDistinct("ts").alias("n"))
    both = day.unionByName(days.select("symbol", "score_day", F.lit(None).cast("long").alias("n")))
    sums = both.select("symbol", "score_day", "n", F.sum("n").over(Window.partitionBy("symbol").orderBy("score_day").rangeBetween(-b.train_days, -1)).alias("actual"))
    expected = F.lit(b.train_days * DAY // b.step_s)
    return sums.where("n IS NULL AND actual > 0").drop("n").withColumn("expected", expected.cast("long")).withColumn("missing_pct", (c("expected") - c("actual")) * 100.0 / c("expected"))


def build_artifacts(bars: DataFrame, path: str, b: Build = Build()) -> DataFrame:
    """PIPE-04, SNK-02: models and quality of every day that has all models and a pool, and the pools' values once, as runs by day,
    saved under path; returns what load_artifacts reads back: a row for each symbol and day."""
    rows = prepared(bars, b)
    sinks.save_partitions(trained(rows, b), f"{path}/trained", ["score_day"])
    models = saved(bars.sparkSession, path, "trained", b)
    sinks.save_partitions(pools(scored_days(rows, models, b), b), f"{path}/pool", ["day"])
    runs = saved(bars.sparkSession, path, "pool", b)
    full = models.groupBy("symbol", "score_day").count().where(c("count") == len(b.horizons)).select("symbol", "score_day")
    big = walk.pool_sizes(runs, b.pool_days, most=-(-b.group * b.step_s // DAY)).where(c("pool_size") >= b.least_pool).select("symbol", "score_day")
    ready = full.join(big, ["symbol", "score_day"])
    sinks.save_partitions(models.join(ready, ["symbol", "score_day"], "left_semi"), f"{path}/models", ["score_day"])
    sinks.save_partitions(window_quality(bars, ready, b), f"{path}/quality", ["score_day"])
    return load_artifacts(bars.sparkSession, path, b)


def saved(spark: SparkSession, path: str, part: str, b: Build) -> DataFrame:
    """A part of the artifacts; without rows where no day had any to save, as such a folder holds no file to tell its columns."""
    fits = "symbol string, horizon int, n long, intercept double, " + "".join(f"b_pk_{n} double, " for n in b.windows) + "score_day long"
    kinds = {"trained": fits, "models": fits, "quality": "symbol string, actual long, expected long, missing_pct double, score_day long", "pool": "symbol string, late int, zs array<double>, n long, lo double, hi double, day long"}
    rows = sinks.stored(spark, f"{path}/{part}")
    day = "day" if part == "pool" else "score_day"
    return spark.createDataFrame([], kinds[part]) if rows is None else rows.withColumn(day, c(day).cast("long"))


def load_artifacts(spark: SparkSession, path: str, b: Build = Build()) -> DataFrame:
    """The saved artifacts: models of each horizon as a map, the pool's size, ends and median, and the window's quality."""
    models, quality, runs = (saved(spark, path, x, b) for x in ("models", "quality", "pool"))
    slopes = [x for x in models.columns if x.startswith("b_")]
    m = models.groupBy("symbol", "score_day").agg(F.map_from_entries(F.collect_list(F.struct("horizon", F.struct("intercept", "n", *slopes)))).alias("models"))
    z = walk.pool_sizes(runs, b.pool_days, most=-(-b.group * b.step_s // DAY))
    mid = walk.pool_medians(runs, m.select("symbol", "score_day"), b.pool_days)
    return m.join(z, ["symbol", "score_day"]).join(mid, ["symbol", "score_day"]).join(quality, ["symbol", "score_day"], "left")


_PK = {n: X.PARK[n] if n in X.PARK else "" for n in (5, 15)}
PIPE04 = f"""WITH r AS (SELECT *, abs(ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY ts))) AS r FROM bars_1h),
f AS (SELECT symbol, ts, close, CAST(epoch(ts) AS BIGINT) AS s, {_PK[5]} AS x, {_PK[15]} AS y, ((13 - (CAST(epoch(ts) AS BIGINT) // 3600) % 15) % 15 + 15) % 15 + 1 AS ttl,
{", ".join(f"CASE WHEN count(r) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) = {h} THEN avg(r) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) END AS t{h}" for h in (1, 3, 5))},
[{", ".join(f"ln(lead(close, {n}) OVER (PARTITION BY symbol ORDER BY ts) / close)" for n in range(1, 16))}] AS ahead FROM r),
l AS (SELECT symbol, s, x, y, unnest([1, 3, 5]) AS h, unnest([t1, t3, t5]) AS t FROM f), g AS (SELECT l.*, d FROM (SELECT *, unnest(range(s // 86400, s // 86400 + 7)) AS d FROM l) l WHERE s < d * 86400 - h * 3600 AND s >= (d - 5) * 86400 AND x IS NOT NULL AND y IS NOT NULL AND t IS NOT NULL),
o AS (SELECT symbol, d, h, count(*) AS n, covar_pop(x, t) AS xt, covar_pop(y, t) AS yt, covar_pop(x, y) AS xy, var_pop(x) AS xx, var_pop(y) AS yy, avg(x) AS mx, avg(y) AS my, avg(t) AS mt FROM g GROUP BY ALL HAVING count(*) >= 30),
m AS (SELECT symbol, d, h, n, (xt * yy - yt * xy) / (xx * yy - xy * xy) AS b1, (yt * xx - xt * xy) / (xx * yy - xy * xy) AS b2, mx, my, mt FROM o),
k AS (SELECT symbol, d, h, n, mt - b1 * mx - b2 * my AS a, b1, b2 FROM m), p AS (SELECT f.*, f.s // 86400 AS d FROM f),
q AS (SELECT p.symbol, p.s, p.d, p.ttl, p.ahead, 0.2 * (k1.a + k1.b1 * x + k1.b2 * y) + 0.3 * (k3.a + k3.b1 * x + k3.b2 * y) + 0.5 * (k5.a + k5.b1 * x + k5.b2 * y) AS mar FROM p JOIN k k1 ON k1.symbol = p.symbol AND k1.d = p.d AND k1.h = 1 JOIN k k3 ON k3.symbol = p.symbol AND k3.d = p.d AND k3.h = 3 JOIN k k5 ON k5.symbol = p.symbol AND k5.d = p.d AND k5.h = 5),
z AS (SELECT symbol, s, ahead[ttl] / nullif(sqrt(pi() / 2) * greatest(mar, 0) * sqrt(ttl), 0) AS z FROM q WHERE mar IS NOT NULL), u AS (SELECT symbol, z, s, unnest(range(s // 86400, s // 86400 + 6)) AS d FROM z WHERE z IS NOT NULL),
e AS (SELECT symbol, d, count(*) AS pool_size, min(z) AS lo, median(z) AS mid, max(z) AS hi FROM u WHERE s < d * 86400 - 54000 AND s >= (d - 4) * 86400 GROUP BY ALL HAVING count(*) >= 20), w AS (SELECT symbol, d, count(*) AS horizons, max(n) FILTER (h = 3) AS n3, max(a) FILTER (h = 3) AS a3 FROM k GROUP BY ALL HAVING count(*) = 3)
SELECT w.symbol, w.d AS score_day, CAST(n3 AS BIGINT) AS train_rows, round(a3, 5) AS intercept_3, CAST(pool_size AS BIGINT) AS pool_size, round(lo, 4) AS pool_lo, round(mid, 4) AS pool_mid, round(hi, 4) AS pool_hi, CAST((SELECT count(*) FROM f b WHERE b.symbol = w.symbol AND b.s >= (w.d - 5) * 86400 AND b.s < w.d * 86400) AS BIGINT) AS actual FROM w JOIN e USING (symbol, d)"""


@query("pipe04_artifacts", V.sql("bars_1h", PIPE04))
def pipe04(spark: SparkSession, d: str) -> DataFrame:
    """Artifacts of every day, saved and loaded."""
    a = build_artifacts(V.bars_1h(spark, d), scratch(spark, "artifacts"))
    three = F.try_element_at(c("models"), F.lit(3))
    out = a.select("symbol", "score_day", three["n"].alias("train_rows"), three["intercept"].alias("intercept_3"), "pool_size", "pool_lo", "pool_mid", "pool_hi", "actual")
    return rounded(rounded(out.select("symbol", "score_day", "intercept_3"), 5).join(rounded(out.drop("intercept_3"), 4), ["symbol", "score_day"]), 6)


@query("fn06_daily_pools", V.sql("bars_1h", PIPE04[: PIPE04.index("e AS (SELECT symbol, d, count(*) AS pool_size")] + """
v AS (SELECT q.symbol, q.s, q.d, ln(b.close / 100) / nullif(sqrt(pi() / 2) * greatest(mar, 0) * sqrt(q.ttl), 0) AS x FROM q JOIN f b ON b.symbol = q.symbol AND b.s = q.s WHERE mar IS NOT NULL)
SELECT v.symbol, v.s, round(count(*) FILTER (u.z > v.x) * 1.0 / count(*), 6) AS p_yes
FROM v JOIN u ON u.symbol = v.symbol AND u.d = v.d AND u.s < u.d * 86400 - 54000 AND u.s >= (u.d - 4) * 86400 WHERE v.x IS NOT NULL GROUP BY ALL"""))
def fn06_daily(spark: SparkSession, d: str) -> DataFrame:
    """FN-06 by the artifact's pools: for each bar the share of its own day's pool over its distance from the strike."""
    b = Build()
    rows = prepared(V.bars_1h(spark, d), b)
    scored = scored_days(rows, trained(rows, b), b)
    x = scored.select("symbol", V.epoch("ts").alias("s"), "score_day", ratio(F.log(c("close") / 100), c("sigma")).alias("x")).where("x IS NOT NULL")
    out = walk.pool_shares(x, pools(scored, b), "x", b.pool_days)
    return rounded(out.select("symbol", "s", c("share").alias("p_yes")).where("p_yes IS NOT NULL"))


# PIPE-05: replay and reconciliation


def replay(bars: DataFrame, deciles: DataFrame, horizon: int, buffer: int, arm: int) -> dict[str, DataFrame]:
    """PIPE-05: firings with their reasons, entries and results of the rules over closed bars (symbol, ts, i, close), from bar
    `arm` on, when every rank window is full. A result is an entry whose exit bar is there, with its signed return in bps."""
    fired = rules.firings(deciles.where(c("i") >= arm)).select("symbol", "i", "cell_id", "side")
    reasons = onset.single_slot(fired, horizon, buffer).join(fired, ["symbol", "i", "cell_id"])
    entries = reasons.where("reason = 'taken'").join(bars.select("symbol", "i", c("close").alias("entry_close")), ["symbol", "i"])
    entries = entries.withColumn("entry_id", F.row_number().over(Window.partitionBy("symbol").orderBy("i"))).withColumn("exit_i", c("i") + horizon)
    out = bars.select("symbol", c("i").alias("exit_i"), c("close").alias("exit_close"))
    sign = F.when(c("side") == "long", 1).otherwise(-1)
    results = entries.join(out, ["symbol", "exit_i"]).withColumn("ret_bps", sign * (ratio(c("exit_close"), c("entry_close")) - 1) * 1e4)
    return {"firings": reasons, "entries": entries, "results": results}


def reconciliation(deciles: DataFrame, done: dict[str, DataFrame], horizon: int, arm: int, bars_a_day: int) -> DataFrame:
    """PIPE-05: per symbol armed bars, share in the regime, firings, entries and completed holds, entries a day, mean return, and
    share of the time in position."""
    a = deciles.where(c("i") >= arm).groupBy("symbol").agg(F.count(F.lit(1)).alias("armed"), F.avg(F.coalesce(c("d_pk").isin(*rules.REGIME), F.lit(False)).cast("double")).alias("regime_share"))
    n = {k: done[k].groupBy("symbol").agg(F.count(F.lit(1)).alias(k), *([F.avg("ret_bps").alias("mean_ret_bps")] if k == "results" else [])) for k in ("firings", "entries", "results")}
    j = reduce(lambda x, y: x.join(y, "symbol", "left"), n.values(), a)
    j = j.withColumns({k: F.coalesce(k, F.lit(0)).cast("long") for k in n})
    return j.withColumn("entries_a_day", c("entries") * bars_a_day / c("armed")).withColumn("in_position_pct", c("results") * horizon * 100.0 / c("armed"))


ARM = 100
PIPE05 = f"""WITH RECURSIVE {rules.FIRE}, n AS (SELECT symbol, ts, close, d_pk, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i FROM dec),
o AS (SELECT f.symbol, n.i, f.cell_id, f.side, row_number() OVER (PARTITION BY f.symbol ORDER BY n.i, f.cell_id) AS q FROM fire f JOIN n ON n.symbol = f.symbol AND n.ts = f.ts WHERE n.i >= {ARM}),
s AS (SELECT symbol, q, i, cell_id, side, i AS entry, 'taken' AS reason FROM o WHERE q = 1 UNION ALL SELECT o.symbol, o.q, o.i, o.cell_id, o.side, CASE WHEN o.i >= s.entry + 12 THEN o.i ELSE s.entry END, CASE WHEN o.i >= s.entry + 12 THEN 'taken' WHEN o.i = s.entry THEN 'lost_tie' WHEN o.i < s.entry + 10 THEN 'in_position' ELSE 'buffer' END FROM s JOIN o ON o.symbol = s.symbol AND o.q = s.q + 1),
a AS (SELECT symbol, count(*) AS armed, avg(CASE WHEN coalesce(d_pk IN (9, 10), false) THEN 1.0 ELSE 0 END) AS share FROM n WHERE i >= {ARM} GROUP BY symbol), t AS (SELECT s.symbol, count(*) AS firings, count(*) FILTER (reason = 'taken') AS entries FROM s GROUP BY symbol),
x AS (SELECT s.symbol, count(*) AS results, avg(CASE WHEN side = 'long' THEN 1 ELSE -1 END * (y.close / e.close - 1) * 1e4) AS mean FROM s JOIN n e ON e.symbol = s.symbol AND e.i = s.i JOIN n y ON y.symbol = s.symbol AND y.i = s.i + 10 WHERE reason = 'taken' GROUP BY s.symbol)
SELECT a.symbol, CAST(armed AS BIGINT) AS armed, round(share, 6) AS regime_share, CAST(coalesce(firings, 0) AS BIGINT) AS firings, CAST(coalesce(entries, 0) AS BIGINT) AS entries, CAST(coalesce(results, 0) AS BIGINT) AS results, round(mean, 6) AS mean_ret_bps, round(coalesce(entries, 0) * 24 / armed, 6) AS entries_a_day, round(coalesce(results, 0) * 1000.0 / armed, 6) AS in_position_pct FROM a LEFT JOIN t USING (symbol) LEFT JOIN x USING (symbol)"""


@query("pipe05_reconciliation", V.sql("bars_1h", PIPE05))
def pipe05(spark: SparkSession, d: str) -> DataFrame:
    dec = rules.deciles(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("symbol").orderBy("ts")) - 1)
    done = replay(dec.select("symbol", "ts", "i", "close"), dec, 10, 2, ARM)
    return rounded(reconciliation(dec, done, 10, ARM, 24))


# PIPE-01, PIPE-02: loads and repair


def accumulate(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """PIPE-01: of the fetched bars those after the last one stored, by symbol; all of a symbol that has none."""
    last = stored.groupBy("symbol").agg(F.max("ts").alias("_last"))
    return fetched.join(last, "symbol", "left").where(c("_last").isNull() | (c("ts") > c("_last"))).drop("_last")


def repaired(stored: DataFrame, source: DataFrame, step: str, now: Column) -> DataFrame:
    """PIPE-02: the bars that a repair appends to stored ones: from the source, closed by now, those after a symbol's last bar, and
    those from its first gap on, as a fetch from a time brings all since then; newer versions win where both have one."""
    closed = B.closed(source, now, step)
    tail = accumulate(stored, closed)
    gap = B.first_gap(stored.select("symbol", "ts").unionByName(tail.select("symbol", "ts")), step)
    since = closed.join(gap, "symbol").where(c("ts") >= c("gap_ts")).drop("gap_ts")
    return tail.unionByName(since).dropDuplicates(["symbol", "ts"])


def gap_report(bars: DataFrame, step_s: int) -> DataFrame:
    """PIPE-02: every gap of a symbol: its first missing step and how many are missing."""
    nxt = F.lead("ts").over(Window.partitionBy("symbol").orderBy("ts"))
    g = bars.select("symbol", "ts", nxt.alias("nxt")).where("nxt IS NOT NULL")
    n = (F.expr("timestampdiff(SECOND, ts, nxt)") / step_s - 1).cast("long")
    return g.withColumn("missing", n).where("missing > 0").select("symbol", (c("ts") + F.make_dt_interval(secs=F.lit(step_s))).alias("gap_ts"), "missing")


HOLES = "epoch(ts) % 104400 >= 3600 * 3 AND ts < TIMESTAMP '2024-01-20'"


@query("pipe02_gap_repair", V.sql("bars_1h", f"WITH st AS (SELECT symbol, ts FROM bars_1h WHERE {HOLES}), cl AS (SELECT symbol, ts, close FROM bars_1h WHERE ts + INTERVAL 1 HOUR <= TIMESTAMP '2024-01-25 10:30:00'), la AS (SELECT symbol, max(ts) AS last FROM st GROUP BY 1), ta AS (SELECT cl.* FROM cl JOIN la USING (symbol) WHERE ts > last), al AS (SELECT symbol, ts FROM st UNION SELECT symbol, ts FROM ta), ga AS (SELECT symbol, min(ts + INTERVAL 1 HOUR) AS gap FROM al a WHERE NOT EXISTS (SELECT 1 FROM al b WHERE b.symbol = a.symbol AND b.ts = a.ts + INTERVAL 1 HOUR) AND a.ts + INTERVAL 1 HOUR < (SELECT max(ts) FROM al b WHERE b.symbol = a.symbol) GROUP BY 1) SELECT DISTINCT symbol, ts, close FROM (SELECT * FROM ta UNION ALL SELECT cl.* FROM cl JOIN ga USING (symbol) WHERE ts >= gap)"))
def pipe02(spark: SparkSession, d: str) -> DataFrame:
    bars = V.bars_1h(spark, d)
    stored = bars.where((V.epoch("ts") % 104_400 >= 10_800) & (c("ts") < F.lit("2024-01-20").cast("timestamp_ntz")))
    return repaired(stored, bars, "INTERVAL 1 HOUR", F.lit("2024-01-25 10:30:00").cast("timestamp_ntz")).select("symbol", "ts", "close")


@query("pipe01_accumulate", V.sql("bars_1h", "WITH st AS (SELECT symbol, max(ts) AS last FROM bars_1h WHERE ts < TIMESTAMP '2024-01-12' AND symbol <> 's3' GROUP BY 1) SELECT b.symbol, b.ts, b.close FROM bars_1h b LEFT JOIN st USING (symbol) WHERE last IS NULL OR ts > last"))
def pipe01(spark: SparkSession, d: str) -> DataFrame:
    """Bars appended to a store, read back: what a second load brings."""
    bars, path = V.bars_1h(spark, d), scratch(spark, "bars")
    stored = bars.where((c("ts") < F.lit("2024-01-12").cast("timestamp_ntz")) & (c("symbol") != "s3"))
    sinks.append(stored, path)
    return accumulate(spark.read.parquet(path), bars).select("symbol", "ts", "close")


@query("pipe02_gap_report", V.sql("bars_1h", "SELECT symbol, ts + INTERVAL 1 HOUR AS gap_ts, CAST((epoch(nxt) - epoch(ts)) / 3600 - 1 AS BIGINT) AS missing FROM (SELECT symbol, ts, lead(ts) OVER (PARTITION BY symbol ORDER BY ts) AS nxt FROM bars_1h) WHERE epoch(nxt) - epoch(ts) > 3600"))
def pipe02_report(spark: SparkSession, d: str) -> DataFrame:
    return gap_report(V.bars_1h(spark, d), 3600)


# PIPE-13, PIPE-14


@query("pipe13_z_diagnosis", V.sql("bars_1h", f"WITH {M.SCORED}, z AS (SELECT symbol, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, target / nullif(greatest(pred, 0), 0) AS z FROM s) SELECT symbol, day, CAST(count(z) AS BIGINT) AS n, round(avg(z), 4) AS mean, round(stddev_samp(z), 4) AS std, round(quantile_cont(z, 0.1), 4) AS q10, round(quantile_cont(z, 0.9), 4) AS q90 FROM z GROUP BY ALL HAVING count(z) > 0"))
def pipe13(spark: SparkSession, d: str) -> DataFrame:
    """PIPE-13: the z values of each day of a range: how many, their mean, deviation and tails."""
    z = M.scored(spark, d).select("symbol", F.floor(V.epoch("ts") / DAY).alias("day"), ratio(c("target"), F.greatest(c("pred"), F.lit(0.0))).alias("z")).where("z IS NOT NULL")
    q = lambda p: F.percentile("z", F.lit(p))
    return rounded(z.groupBy("symbol", "day").agg(F.count("z").alias("n"), F.avg("z").alias("mean"), F.stddev_samp("z").alias("std"), q(0.1).alias("q10"), q(0.9).alias("q90")), 4)


def add_flow(changes: DataFrame, back: int = 30, near: float = 0.02, side: tuple[str, str] = ("bid", "ask")) -> DataFrame:
    """PIPE-14, STR-16: from changes of ladders (token, side, t_s, price, before, after, best; see ladder.changes) per second with any
    the sizes added within `near` of the side's best, summed over the last `back` seconds, as up and down, and their asymmetry
    (up - down) / (up + down), NULL without any."""
    x = changes.withColumn("added", ladder.added(changes, near))
    per = x.groupBy("token", "t_s").agg(*[F.coalesce(F.sum(F.when(c("side") == s, c("added"))), F.lit(0)).cast("double").alias(n) for s, n in zip(side, ("up", "down"))])
    w = Window.partitionBy("token").orderBy("t_s").rangeBetween(-(back - 1), 0)
    x = per.select("token", "t_s", *[F.sum(s).over(w).alias(s) for s in ("up", "down")])
    return x.withColumn("v", ratio(c("up") - c("down"), c("up") + c("down")))


def run_diff(live: DataFrame, again: DataFrame, key: str, order: list[str], skip: tuple[str, ...] = ()) -> DataFrame:
    """PIPE-14, JN-21: two runs' rows by place within their key: rows of each, and differing ones among the places both have;
    columns in skip don't count."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    cols = [x for x in live.columns if x not in (key, *skip)]
    a, b = (df.select(key, at.alias("i"), F.struct(*cols).alias(n)) for df, n in ((live, "a"), (again, "b")))
    j = a.join(b, [key, "i"], "full")
    return j.groupBy(key).agg(F.count("a").alias("live_rows"), F.count("b").alias("replay_rows"), F.count_if(c("a").isNotNull() & c("b").isNotNull() & ~c("a").eqNullSafe(c("b"))).alias("differing"))


FLOW = f"""{ladder.WIRE},
p AS (SELECT token, t // 1000000 AS t_s, coalesce(sum(added) FILTER (side = 'bid'), 0) AS up, coalesce(sum(added) FILTER (side = 'ask'), 0) AS down FROM adds GROUP BY ALL),
s AS (SELECT token, t_s, sum(up) OVER w AS up, sum(down) OVER w AS down FROM p WINDOW w AS (PARTITION BY token ORDER BY t_s RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)),
f AS (SELECT *, (up - down) / nullif(up + down, 0) AS v FROM s)"""


def _flow(spark: SparkSession, d: str) -> DataFrame:
    """The flow of the driver's messages, whose seconds are thousands of seconds, as they are sparse."""
    wire = ladder.wire(spark, d)
    x = ladder.changes(ladder.book_events(wire)).join(wire.select("seq", F.floor(c("t") / 1_000_000).alias("t_s")), "seq")
    return add_flow(x)


@query("pipe14_add_flow", f"{FLOW} SELECT token, t_s, round(up, 4) AS up, round(down, 4) AS down, round(v, 6) AS v FROM f")
def pipe14(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_flow(spark, d))


@query("pipe14_replay_diff", f"""{FLOW},
a AS (SELECT token, up, down, v, row_number() OVER (PARTITION BY token ORDER BY t_s) AS i FROM f),
b AS (SELECT token, CASE WHEN i % 19 = 0 THEN up + 1 ELSE up END AS up, down, v, i FROM a WHERE NOT (token = 'tok3' AND i > 40))
SELECT token, CAST(count(a.i) AS BIGINT) AS live_rows, CAST(count(b.i) AS BIGINT) AS replay_rows,
  CAST(count(*) FILTER (a.i IS NOT NULL AND b.i IS NOT NULL AND (a.up IS DISTINCT FROM b.up)) AS BIGINT) AS differing
FROM a FULL JOIN b USING (token, i) GROUP BY token""")
def pipe14_diff(spark: SparkSession, d: str) -> DataFrame:
    live = _flow(spark, d).withColumn("wall", F.lit(1))
    i = F.row_number().over(Window.partitionBy("token").orderBy("t_s"))
    again = live.withColumn("i", i).where(~((c("token") == "tok3") & (c("i") > 40))).withColumn("up", F.when(c("i") % 19 == 0, c("up") + 1).otherwise(c("up"))).withColumn("wall", F.lit(2)).drop("i")
    return run_diff(live, again, "token", ["t_s"], ("wall",))
