"""Pipelines over tables that remember: reports of windows that are resolved and not yet reported, backfills of archives."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.clean import holds
from tidemill.functions.scratch import scratch
from tidemill.plans.registry import query
from tidemill.sources import pages
from tidemill.sources import views as V
from tidemill.sources.store import Store

c = F.col


def report_sweep(fires: DataFrame, resolved: DataFrame, evaluations: DataFrame, done: Store, number: int) -> DataFrame:
    """PIPE-09: of the windows (epoch, token) with fires those that are resolved and that no earlier sweep has dealt with, marked in the
    table `done` with sweep, sent, n_fires, y and message; the rows of this sweep are returned.

    A window is sent if one of its evaluations(epoch, token, passes) passes; one without is marked and nothing is sent. Marks and
    messages are one write with the sweep's number, so a sweep that is repeated after a crash finds its own rows and sends the same.
    A window with several resolutions takes the greatest."""
    key = ["epoch", "token"]
    marked = done.latest()
    if marked is None or not marked.where(c("sweep") == number).limit(1).count():
        windows = fires.groupBy(*key).agg(F.count(F.lit(1)).alias("n_fires"))
        fresh = windows.join(resolved.groupBy(*key).agg(F.max("y").alias("y")), key)
        if marked is not None:
            fresh = fresh.join(marked.select(*key), key, "left_anti")
        passing = evaluations.groupBy(*key).agg(F.max(holds(c("passes")).cast("int")).alias("p"))
        out = fresh.join(passing, key, "left").withColumn("sent", F.coalesce(c("p") == 1, F.lit(False))).drop("p")
        text = F.format_string("window %d of %d: %d fires, settled %d", "epoch", "token", "n_fires", "y")
        done.put(out.select(*key, F.lit(number).cast("long").alias("sweep"), "sent", "n_fires", "y", F.when(c("sent"), text).alias("message")), ("sweep", number))
        marked = done.latest()
    return marked.where(c("sweep") == number)


def archive_plan(first_month: str, today: date) -> list[str]:
    """PIPE-03: the archives that a backfill takes: months up to the last whole one, then the days of the one that runs, up to
    yesterday, each as its name states it."""
    year, month = map(int, first_month.split("-"))
    out = []
    while (year, month) < (today.year, today.month):
        out.append(f"{year:04d}-{month:02d}")
        year, month = year + month // 12, month % 12 + 1
    return [*out, *(f"{today - timedelta(days=today.day - 1 - i):%Y-%m-%d}" for i in range(today.day - 1))]


def backfill(spark: SparkSession, folder: str, symbol: str, first_month: str, today: date, table: Store) -> DataFrame:
    """PIPE-03: the bars of a folder of monthly and daily archives from a month on and up to yesterday, imported into a table by symbol
    and time, where a bar that several archives have is one; returns the table."""
    begin, end = f"{first_month}-01 00:00:00", f"{today:%Y-%m-%d} 00:00:00"
    bars = pages.klines(spark, folder).where((c("ts") >= F.lit(begin).cast("timestamp_ntz")) & (c("ts") < F.lit(end).cast("timestamp_ntz")))
    table.put(bars.select(F.lit(symbol).alias("symbol"), *bars.columns))
    return table.latest()


@query("pipe09_report_sweep", V.sql("fires trades", """WITH f AS (SELECT token, t // 86400000 AS epoch FROM fires), e AS (SELECT token, t // 86400000 AS epoch, price > 100 AND size >= 90 AS passes FROM trades),
w AS (SELECT epoch, token, count(*) AS n_fires FROM f GROUP BY ALL), p AS (SELECT epoch, token, bool_or(passes) AS p FROM e GROUP BY ALL)
SELECT epoch, token, CASE WHEN epoch % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS sweep, coalesce(p, false) AS sent, n_fires, CAST((epoch + token) % 2 AS BIGINT) AS y,
  CASE WHEN p THEN printf('window %d of %d: %d fires, settled %d', epoch, token, n_fires, (epoch + token) % 2) END AS message
FROM w LEFT JOIN p USING (epoch, token) WHERE epoch % 5 <> 0"""))
def pipe09(spark: SparkSession, d: str) -> DataFrame:
    """Two sweeps, the second repeated: even days are resolved before the first, the others, but for each fifth, before the second."""
    epoch = F.floor(c("t") / 86_400_000).alias("epoch")
    fires = V.fires(spark, d).select("token", epoch)
    evaluations = V.trades(spark, d).select("token", epoch, ((c("price") > 100) & (c("size") >= 90)).alias("passes"))
    all_ = fires.distinct().where("epoch % 5 <> 0").select("epoch", "token", ((c("epoch") + c("token")) % 2).cast("long").alias("y"))
    done = Store(spark, scratch(spark, "sweeps"), ("epoch", "token"))
    for number, resolved in ((1, all_.where("epoch % 2 = 0")), (2, all_), (2, all_)):
        report_sweep(fires, resolved, evaluations, done, number)
    return done.latest()


@query("pipe03_backfill", V.sql("bars_1h", """SELECT symbol, ts, round(open, 4) AS open, round(close, 4) AS close, num_trades FROM bars_1h
WHERE symbol = 's2' AND ts >= TIMESTAMP '2024-01-01' AND ts < (SELECT date_trunc('day', max(ts)) FROM bars_1h)"""))
def pipe03(spark: SparkSession, d: str) -> DataFrame:
    """A symbol's bars as archives of months and of the last month's days, imported up to the last day; the first day of each month is
    in both."""
    folder, ms = scratch(spark, "archives"), V.millis("ts")
    bars = V.bars_1h(spark, d).where("symbol = 's2'")
    last = bars.agg(F.max("ts")).first()[0].date()
    text = lambda n: F.format_string("%.10f", c(n))
    row = F.array(ms.cast("string"), text("open"), text("high"), text("low"), text("close"), text("volume"), (ms + 3_599_999).cast("string"), F.lit("0"), c("num_trades").cast("string"), text("taker"), F.lit("0"))
    month = F.date_format("ts", "yyyy-MM")
    daily = (month == F.lit(f"{last:%Y-%m}")) | (F.dayofmonth("ts") == 1)
    named = F.explode(F.array_compact(F.array(F.when(month != F.lit(f"{last:%Y-%m}"), month), F.when(daily, F.date_format("ts", "yyyy-MM-dd")))))
    bars.select(named.alias("archive"), row.alias("row")).groupBy("archive").agg(F.to_json(F.collect_list("row")).alias("value")).write.partitionBy("archive").text(folder)
    got = backfill(spark, folder, "s2", "2024-01", last, Store(spark, scratch(spark, "imported"), ("symbol", "ts")))
    one = lambda n: (F.floor(c(n) * 1e4 + 0.5) / 1e4).alias(n)
    return got.select("symbol", "ts", one("open"), one("close"), "num_trades")
