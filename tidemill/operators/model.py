"""Walk-forward regression, empirical pools and probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import ratio, rounded
from tidemill.operators import features as X
from tidemill.operators.walk import walk_fit
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col


def ols_one(y: Column, x: Column) -> tuple[Column, Column]:
    """AGG-22 with one regressor: (slope, intercept), NULL for a constant regressor."""
    slope = ratio(F.covar_pop(y, x), F.var_pop(x))
    return slope, F.avg(y) - slope * F.avg(x)


def features(spark: SparkSession, d: str) -> DataFrame:
    b = V.bars_1h(spark, d).withColumn("_ret", F.log(ratio(c("close"), F.lag("close").over(X.W()))))
    return b.select("symbol", "ts", "close", X.mean_abs_return(1).alias("mar_1"), X.mean_abs_return(4).alias("mar_4"), F.abs(X.forward_return(1)).alias("target"))


F_SQL = f"f AS (SELECT symbol, ts, close, {X.least('avg', 'abs(r)', 1)} AS mar_1, {X.least('avg', 'abs(r)', 4)} AS mar_4, abs(ln(lead(close) OVER (PARTITION BY symbol ORDER BY ts) / close)) AS target FROM (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY ts)) AS r FROM bars_1h))"
WALK = f"""{F_SQL}, d AS (SELECT unnest(range(CAST(epoch(min(ts)) AS BIGINT) // 86400 - 6, CAST(epoch(max(ts)) AS BIGINT) // 86400 + 8)) AS score_day FROM f), t AS (SELECT d.score_day, f.* FROM d JOIN f ON epoch(ts) < score_day * 86400 - 3600 AND epoch(ts) >= (score_day - 5) * 86400)"""


def daily(f: DataFrame) -> DataFrame:
    """The model of each score day, from the five days before it less an hour."""
    return walk_fit(f, V.epoch("ts"), {1: ("target", 3600)}, ["mar_4"], 5).drop("horizon")


@query("agg22_ols", V.sql("bars_1h", f"WITH {F_SQL} SELECT symbol, CAST(regr_count(target, mar_4) AS BIGINT) AS n, round(regr_slope(target, mar_4), 6) AS slope, round(regr_intercept(target, mar_4), 6) AS intercept FROM f GROUP BY symbol"))
def agg22(spark: SparkSession, d: str) -> DataFrame:
    slope, intercept = ols_one(c("target"), c("mar_4"))
    f = features(spark, d).dropna(subset=["target", "mar_4"])
    return rounded(f.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), slope.alias("slope"), intercept.alias("intercept")))


@query("agg23_walk_forward", V.sql("bars_1h", f"WITH {WALK} SELECT score_day, CAST(regr_count(target, mar_4) AS BIGINT) AS n, CASE WHEN regr_count(target, mar_4) >= 30 THEN round(regr_intercept(target, mar_4), 6) END AS intercept, CASE WHEN regr_count(target, mar_4) >= 30 THEN round(regr_slope(target, mar_4), 6) END AS b_mar_4 FROM t GROUP BY score_day"))
def agg23(spark: SparkSession, d: str) -> DataFrame:
    return rounded(daily(features(spark, d)))


SCORED = f"{WALK}, m AS (SELECT score_day, regr_intercept(target, mar_4) AS a, regr_slope(target, mar_4) AS b FROM t GROUP BY score_day HAVING regr_count(target, mar_4) >= 30), s AS (SELECT f.symbol, f.ts, f.close, f.target, a + b * mar_4 AS pred FROM f JOIN m ON m.score_day = CAST(floor(epoch(f.ts) / 86400) AS BIGINT) WHERE mar_4 IS NOT NULL)"


def scored(spark: SparkSession, d: str) -> DataFrame:
    """JN-19: each bar with the coefficients of its day. The models are one row a day."""
    f = features(spark, d)
    m = daily(f)
    day = f.dropna(subset=["mar_4"]).withColumn("score_day", F.floor(V.epoch("ts") / 86_400))
    return day.join(m.where("intercept IS NOT NULL"), "score_day").select("symbol", "ts", "close", "target", (c("intercept") + c("b_mar_4") * c("mar_4")).alias("pred"))


@query("jn19_score_rows", V.sql("bars_1h", f"WITH {SCORED} SELECT symbol, ts, round(pred, 6) AS pred FROM s"))
def jn19(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scored(spark, d).select("symbol", "ts", "pred"))


@query("agg24_z_pool", V.sql("bars_1h", f"WITH {SCORED} SELECT symbol, CAST(count(z) AS BIGINT) AS n, round(min(z), 5) AS lo, round(median(z), 5) AS mid, round(max(z), 5) AS hi FROM (SELECT symbol, target / nullif(greatest(pred, 0), 0) AS z FROM s) GROUP BY symbol"))
def agg24(spark: SparkSession, d: str) -> DataFrame:
    """AGG-24/25/16: the pool of target over prediction, zero predictions dropped, and its median."""
    z = scored(spark, d).select("symbol", ratio(c("target"), F.greatest(c("pred"), F.lit(0.0))).alias("z"))
    return rounded(z.groupBy("symbol").agg(F.count("z").alias("n"), F.min("z").alias("lo"), F.median("z").alias("mid"), F.max("z").alias("hi")), 5)


def share_above(rows: DataFrame, pool: DataFrame, key: str, x: str, z: str, strict: bool = True, cuts: int = 200) -> DataFrame:
    """JN-20, FN-06: for each row the share of its key's pool over x (strict) or at least x; the pool is never collected.

    Both are dealt to ranges of values, between approximate quantiles of the key's pool, and ordered within a range; counts of
    the ranges below complete the ranks, so a large pool is ranked in as many tasks as it has ranges.
    """
    p = pool.where(c(z).isNotNull()).select(c(key).alias("_k"), c(z).alias("_x"), F.lit(1).alias("_n"), F.lit(None).cast(rows.select(F.struct("*").alias("r")).schema["r"].dataType).alias("_row"))
    r = rows.select(c(key).alias("_k"), c(x).alias("_x"), F.lit(0).alias("_n"), F.struct("*").alias("_row"))
    edges = p.groupBy("_k").agg(F.percentile_approx("_x", [i / cuts for i in range(1, cuts)], 10_000).alias("_e"), F.count(F.lit(1)).alias("_total"))
    both = p.unionByName(r).join(edges, "_k", "left").withColumn("_b", F.size(F.filter(F.array_distinct("_e"), lambda e: e < c("_x")))).drop("_e")
    sizes = both.groupBy("_k", "_b").agg(F.sum("_n").alias("_in"))
    below = F.coalesce(F.sum("_in").over(Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    both = both.join(sizes.select("_k", "_b", below.alias("_below")), ["_k", "_b"])
    w = Window.partitionBy("_k", "_b").orderBy("_x").rangeBetween(Window.unboundedPreceding, 0)
    upto = c("_below") + F.sum("_n").over(w)
    if not strict:
        upto = upto - F.sum("_n").over(Window.partitionBy("_k", "_b", "_x"))
    both = both.withColumn("_p", ratio(c("_total") - upto, c("_total"))).where("_row IS NOT NULL")
    return both.select("_row.*", F.when(c("_x").isNotNull(), c("_p")).alias("share"))


@query("fn06_probability", V.sql("bars_1h", f"WITH {SCORED}, z AS (SELECT symbol, target / nullif(greatest(pred, 0), 0) AS z FROM s), q AS (SELECT symbol, ts, ln(close / 100) / nullif(greatest(pred, 0), 0) AS x FROM s) SELECT q.symbol, q.ts, round(count(z.z) FILTER (z.z > q.x) * 1.0 / count(z.z), 6) AS p_yes FROM q JOIN z ON z.symbol = q.symbol AND z.z IS NOT NULL WHERE q.x IS NOT NULL GROUP BY ALL"))
def fn06(spark: SparkSession, d: str) -> DataFrame:
    s = scored(spark, d)
    low = F.greatest(c("pred"), F.lit(0.0))
    q = s.select("symbol", "ts", ratio(F.log(c("close") / 100), low).alias("x")).where("x IS NOT NULL")
    z = s.select("symbol", ratio(c("target"), low).alias("z"))
    return rounded(share_above(q, z, "symbol", "x", "z").select("symbol", "ts", c("share").alias("p_yes")))


@query("agg25_describe", V.sql("bars_1h", "SELECT symbol, CAST(count(*) AS BIGINT) AS n, round(avg(close), 4) AS mean, round(stddev_samp(close), 4) AS std, min(close) AS lo, round(quantile_cont(close, 0.25), 4) AS q25, round(quantile_cont(close, 0.5), 4) AS q50, round(quantile_cont(close, 0.75), 4) AS q75, max(close) AS hi FROM bars_1h GROUP BY symbol"))
def agg25(spark: SparkSession, d: str) -> DataFrame:
    q = lambda p: F.percentile("close", F.lit(p))
    return rounded(V.bars_1h(spark, d).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.avg("close").alias("mean"), F.stddev_samp("close").alias("std"), F.min("close").alias("lo"), q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.75).alias("q75"), F.max("close").alias("hi")), 4)


@query("agg26_parity", V.sql("bars_1h", "WITH o AS (SELECT *, close + CASE WHEN num_trades > 5 THEN 0.001 ELSE 0 END AS b FROM bars_1h), p AS (SELECT close AS a, CASE WHEN num_trades = 7 THEN NULL ELSE b END AS b FROM o) SELECT round(max(abs(a - b)), 6) AS max_abs_diff, CAST(count(*) FILTER ((a IS NULL) <> (b IS NULL)) AS BIGINT) AS null_mismatch, CAST(count(*) AS BIGINT) AS n FROM p"))
def agg26(spark: SparkSession, d: str) -> DataFrame:
    """AGG-26, JN-01: largest difference and unequal NULLs of a column between two frames joined on their key."""
    a = V.bars_1h(spark, d)
    b = a.select("symbol", "ts", F.when(c("num_trades") != 7, c("close") + F.when(c("num_trades") > 5, 0.001).otherwise(0.0)).alias("close_b"))
    j = a.join(b, ["symbol", "ts"])
    return rounded(j.agg(F.max(F.abs(c("close") - c("close_b"))).alias("max_abs_diff"), F.count_if(c("close").isNull() != c("close_b").isNull()).alias("null_mismatch"), F.count(F.lit(1)).alias("n")))
