"""Market-shaped views over the driver's tables, as DataFrames and, for the oracle, as SQL of the same names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.clean import half_up

CLICK = "click"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _bars(ev: DataFrame, bucket) -> DataFrame:
    at = F.struct("ts", "event_id")
    symbol = F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string"))
    taker = F.when(F.col("event_type") == CLICK, F.col("value")).otherwise(0.0)
    one = ev.select(symbol.alias("symbol"), bucket.alias("bar"), at.alias("at"), "value", taker.alias("taker"))
    return one.groupBy("symbol", F.col("bar").alias("ts")).agg(F.min_by("value", "at").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "at").alias("close"), F.sum("value").alias("volume"), F.count(F.lit(1)).alias("num_trades"), F.sum("taker").alias("taker"))


def bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(events(spark, sf_dir), F.date_trunc("hour", "ts").cast("timestamp_ntz"))


def bars_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(events(spark, sf_dir), F.timestamp_seconds(F.floor(epoch("ts") / 900) * 900).cast("timestamp_ntz"))


def bars_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in versions: each bar as first ingested (id even) and, for every third hour, a correction ingested later."""
    bars = bars_1h(spark, sf_dir)
    hour = F.floor(epoch("ts") / 3600).cast("long")
    first = bars.withColumn("ingested_at", F.col("ts") + F.expr("INTERVAL 1 HOUR")).withColumn("id", hour * 2)
    again = bars.where(F.pmod(hour, F.lit(3)) == 0).withColumn("close", F.col("close") + 1).withColumn("ingested_at", F.col("ts") + F.when(F.pmod(hour, F.lit(2)) == 0, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 2 HOUR"))).withColumn("id", hour * 2 + 1)
    return first.unionByName(again)


def epoch(ts: str):
    """Seconds since 1970 of a timestamp without zone, whole."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def millis(ts: str):
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades: clicks as token, time, price, size, side."""
    k = F.get_json_object("props", "$.k").cast("int")
    ev = events(spark, sf_dir).where(F.col("event_type") == CLICK)
    return ev.select((F.col("user_id") % 8).alias("token"), millis("ts").alias("t"), F.col("event_id").alias("seq"), F.col("value").alias("price"), (k + 1).cast("double").alias("size"), F.when(k % 2 == 0, "buy").otherwise("sell").alias("side"))


def mids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mid prices: views as token, time, mid."""
    ev = events(spark, sf_dir).where(F.col("event_type") == "view")
    return ev.select((F.col("user_id") % 8).alias("token"), millis("ts").alias("t"), F.col("event_id").alias("seq"), F.col("value").alias("mid"))


def fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals: errors as token, time."""
    ev = events(spark, sf_dir).where(F.col("event_type") == "error")
    return ev.select((F.col("user_id") % 8).alias("token"), millis("ts").alias("t"), F.col("event_id").alias("seq"), F.col("value"))


def book_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order book levels: lineitem as book, side, level price and size."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("book"), F.when(F.col("l_returnflag") == "N", "ask").otherwise("bid").alias("side"), F.col("l_linenumber").alias("lvl"), half_up(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("price"), F.col("l_quantity").alias("size"))


#: The same views for DuckDB.
SQL = {
    "bars_1h": """SELECT 's' || CAST(user_id % 4 AS VARCHAR) AS symbol, date_trunc('hour', ts) AS ts, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
        min(value) AS low, arg_max(value, (ts, event_id)) AS close, sum(value) AS volume, count(*) AS num_trades,
        sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS taker FROM events GROUP BY 1, 2""",
    "bars_15m": """SELECT 's' || CAST(user_id % 4 AS VARCHAR) AS symbol, time_bucket(INTERVAL 15 MINUTE, ts) AS ts, arg_min(value, (ts, event_id)) AS open, max(value) AS high,
        min(value) AS low, arg_max(value, (ts, event_id)) AS close, sum(value) AS volume, count(*) AS num_trades,
        sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS taker FROM events GROUP BY 1, 2""",
    "bars_raw": """SELECT *, ts + INTERVAL 1 HOUR AS ingested_at, (epoch_ms(ts) // 3600000) * 2 AS id FROM bars_1h
        UNION ALL BY NAME SELECT * REPLACE (close + 1 AS close), ts + (CASE WHEN (epoch_ms(ts) // 3600000) % 2 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 2 HOUR END) AS ingested_at,
        (epoch_ms(ts) // 3600000) * 2 + 1 AS id FROM bars_1h WHERE (epoch_ms(ts) // 3600000) % 3 = 0""",
    "trades": """SELECT user_id % 8 AS token, epoch_us(ts) // 1000 AS t, event_id AS seq, value AS price, CAST(json_extract(props, '$.k') AS INT) + 1.0::DOUBLE AS size,
        CASE WHEN CAST(json_extract(props, '$.k') AS INT) % 2 = 0 THEN 'buy' ELSE 'sell' END AS side FROM events WHERE event_type = 'click'""",
    "mids": "SELECT user_id % 8 AS token, epoch_us(ts) // 1000 AS t, event_id AS seq, value AS mid FROM events WHERE event_type = 'view'",
    "fires": "SELECT user_id % 8 AS token, epoch_us(ts) // 1000 AS t, event_id AS seq, value FROM events WHERE event_type = 'error'",
    "book_levels": """SELECT l_orderkey AS book, CASE WHEN l_returnflag = 'N' THEN 'ask' ELSE 'bid' END AS side, l_linenumber AS lvl,
        round(l_extendedprice / l_quantity, 2) AS price, l_quantity AS size FROM lineitem""",
}
NEEDS = {"bars_raw": ["bars_1h"]}


def sql(views: str, body: str) -> str:
    """body after the definitions of the named views, and of those that they need."""
    names: list[str] = []
    for v in views.split():
        names += [x for x in [*NEEDS.get(v, []), v] if x not in names]
    own = ", ".join(f"{v} AS ({SQL[v]})" for v in names)
    lead = body.lstrip()
    if lead[:4].upper() == "WITH":
        rest = lead[4:].lstrip()
        recursive = rest[:9].upper() == "RECURSIVE"
        return f"WITH {'RECURSIVE ' if recursive else ''}{own}, {rest[9:].lstrip() if recursive else rest}"
    return f"WITH {own} {body}"
