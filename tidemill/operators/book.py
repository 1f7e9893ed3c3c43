"""Order books: levels as arrays, walks by notional and quantity, statistics. Ladders that messages change are in ladder.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import ratio, rounded
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col


def ladders(levels: DataFrame) -> DataFrame:
    """SRT-05: one row per book with its asks ascending and bids descending, as arrays of (price, size, lvl)."""
    level = F.struct("price", "lvl", "size")
    both = levels.groupBy("book").agg(F.array_sort(F.collect_list(F.when(c("side") == "ask", level))).alias("asks"), F.sort_array(F.collect_list(F.when(c("side") == "bid", level)), asc=False).alias("bids"))
    return both


def walk_notional(asks: Column, usd: float) -> Column:
    """FN-09: buys up the ladder for an amount of money: average price, whether filled, money spent."""
    zero = F.struct(F.lit(0.0).alias("usd"), F.lit(0.0).alias("qty"))

    def step(acc: Column, x: Column) -> Column:
        take = F.least(x["price"] * x["size"], F.lit(usd) - acc["usd"])
        return F.struct((acc["usd"] + take).alias("usd"), (acc["qty"] + F.coalesce(ratio(take, x["price"]), F.lit(0.0))).alias("qty"))

    done = F.aggregate(asks, zero, step)
    return F.struct(ratio(done["usd"], done["qty"]).alias("avg_px"), (done["usd"] >= F.lit(usd) - 1e-6).alias("filled"), done["usd"].alias("usd"))


def walk_quantity(asks: Column, quantity: float) -> Column:
    """FN-10: average price of a quantity bought up the ladder, NULL if there is not enough."""
    zero = F.struct(F.lit(0.0).alias("cost"), F.lit(0.0).alias("qty"))

    def step(acc: Column, x: Column) -> Column:
        take = F.least(x["size"].cast("double"), F.lit(quantity) - acc["qty"])
        return F.struct((acc["cost"] + take * x["price"]).alias("cost"), (acc["qty"] + take).alias("qty"))

    done = F.aggregate(asks, zero, step)
    return F.when(done["qty"] >= quantity - 1e-9, done["cost"] / quantity)


def near_shares(asks: Column, within: float) -> Column:
    """AGG-11/34: shares at the best price and up to `within` over it."""
    best = F.try_element_at(asks, F.lit(1))["price"]
    return F.aggregate(F.filter(asks, lambda x: x["price"] <= best + within), F.lit(0.0), lambda a, x: a + x["size"])


ASKS = "SELECT book, price, size, lvl, sum(size) OVER w AS cum, coalesce(sum(size) OVER (PARTITION BY book ORDER BY price, lvl ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev, coalesce(sum(price * size) OVER (PARTITION BY book ORDER BY price, lvl ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev_usd FROM book_levels WHERE side = 'ask' WINDOW w AS (PARTITION BY book ORDER BY price, lvl)"
USD = 60_000.0


def _asks(spark: SparkSession, d: str) -> DataFrame:
    return ladders(V.book_levels(spark, d)).where(F.size("asks") > 0)


@query("fn09_walk_notional", V.sql("book_levels", f"WITH a AS ({ASKS}), f AS (SELECT book, least(price * size, greatest({USD} - prev_usd, 0)) AS take, price FROM a) SELECT book, round(sum(take) / nullif(sum(take / price), 0), 4) AS avg_px, sum(take) >= {USD} - 1e-6 AS filled, round(sum(take), 4) AS usd FROM f GROUP BY book"))
def fn09(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_asks(spark, d).select("book", walk_notional(c("asks"), USD).alias("w")).select("book", "w.avg_px", "w.filled", "w.usd"), 4)


@query("fn10_walk_quantity", V.sql("book_levels", f"WITH a AS ({ASKS}) SELECT book, round(CASE WHEN sum(size) >= 60 THEN sum(least(size, greatest(60 - prev, 0)) * price) / 60 END, 4) AS px FROM a GROUP BY book"))
def fn10(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_asks(spark, d).select("book", walk_quantity(c("asks"), 60.0).alias("px")), 4)


@query("fn11_executable_ladder", V.sql("book_levels", f"""WITH a AS ({ASKS}), r AS (SELECT * FROM a, (VALUES (1000.0), (30000.0), (90000.0)) n(notional)), f AS (SELECT book, notional, price, least(price * size, greatest(notional - prev_usd, 0)) AS take, first_value(price) OVER (PARTITION BY book, notional ORDER BY price, lvl) AS best FROM r)
SELECT book, CAST(notional AS DOUBLE) AS notional, round(sum(take) / nullif(sum(take / price), 0), 4) AS fill_px, round((sum(take) / nullif(sum(take / price), 0) / any_value(best) - 1) * 10000, 4) AS slippage_bps FROM f GROUP BY book, notional"""))
def fn11(spark: SparkSession, d: str) -> DataFrame:
    """FN-11/12: fill price and slippage from the best price for each rung of money."""
    rungs = [1000.0, 30000.0, 90000.0]
    x = _asks(spark, d).select("book", c("asks")[0]["price"].alias("best"), F.explode(F.array(*[F.struct(F.lit(u).alias("notional"), walk_notional(c("asks"), u)["avg_px"].alias("fill_px")) for u in rungs])).alias("r"))
    return rounded(x.select("book", "r.notional", "r.fill_px", ((ratio(c("r.fill_px"), c("best")) - 1) * 10000).alias("slippage_bps")), 4)


@query("agg09_book_stats", V.sql("book_levels", """WITH g AS (SELECT book, sum(size) FILTER (side = 'bid') AS b, sum(size) FILTER (side = 'ask') AS a, max(price) FILTER (side = 'bid') AS bb, min(price) FILTER (side = 'ask') AS ba,
arg_max(size, (price, lvl)) FILTER (side = 'bid') AS bs, arg_min(size, (price, lvl)) FILTER (side = 'ask') AS sa FROM book_levels GROUP BY book HAVING a > 0 AND b > 0)
SELECT book, round(b, 4) AS bid_size, round(a, 4) AS ask_size, round((b - a) / (b + a), 4) AS imbalance, round((bb + ba) / 2, 4) AS mid, round((ba - bb) / ((bb + ba) / 2) * 10000, 4) AS spread_bps, round((bb * sa + ba * bs) / (bs + sa), 4) AS micro FROM g"""))
def agg09(spark: SparkSession, d: str) -> DataFrame:
    """AGG-09, FN-08: totals, imbalance, mid, spread and micro-price of each two-sided book."""
    total = lambda side: F.aggregate(side, F.lit(0.0), lambda s, x: s + x["size"])
    x = ladders(V.book_levels(spark, d)).where((F.size("asks") > 0) & (F.size("bids") > 0))
    x = x.select("book", total(c("bids")).alias("b"), total(c("asks")).alias("a"), c("bids")[0].alias("bb"), c("asks")[0].alias("ba"))
    bp, ap, bs, sa = c("bb.price"), c("ba.price"), c("bb.size"), c("ba.size")
    return rounded(x.select("book", c("b").alias("bid_size"), c("a").alias("ask_size"), ratio(c("b") - c("a"), c("b") + c("a")).alias("imbalance"), ((bp + ap) / 2).alias("mid"), ((ap - bp) / ((bp + ap) / 2) * 10000).alias("spread_bps"), ratio(bp * sa + ap * bs, bs + sa).alias("micro")), 4)


@query("agg34_near_best", V.sql("book_levels", "WITH a AS (SELECT *, min(price) OVER (PARTITION BY book) AS best FROM book_levels WHERE side = 'ask') SELECT book, min(best) AS best, round(sum(size) FILTER (price <= best + 100), 4) AS near_size FROM a GROUP BY book"))
def agg34(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_asks(spark, d).select("book", c("asks")[0]["price"].alias("best"), near_shares(c("asks"), 100.0).alias("near_size")), 4)


@query("agg11_liquidity_to_price", V.sql("book_levels", "WITH a AS (SELECT *, min(price) OVER (PARTITION BY book) AS best FROM book_levels WHERE side = 'ask') SELECT book, round(sum(size), 4) AS shares, round(sum(price * size) / nullif(sum(size), 0), 4) AS vwap FROM a WHERE price BETWEEN best AND best * 1.1 GROUP BY book"))
def agg11(spark: SparkSession, d: str) -> DataFrame:
    """AGG-11, AGG-08: size and VWAP of the asks up to a tenth over the best."""
    a = V.book_levels(spark, d).where("side = 'ask'").withColumn("best", F.min("price").over(Window.partitionBy("book")))
    a = a.where(c("price") <= c("best") * 1.1)
    return rounded(a.groupBy("book").agg(F.sum("size").alias("shares"), ratio(F.sum(c("price") * c("size")), F.sum("size")).alias("vwap")), 4)


@query("agg10_trade_pivot", V.sql("trades", "SELECT token, CAST(count(*) AS BIGINT) AS n, round(sum(price * size), 4) AS notional, coalesce(sum(size) FILTER (side = 'buy'), 0) AS buy, coalesce(sum(size) FILTER (side = 'sell'), 0) AS sell FROM trades GROUP BY token"))
def agg10(spark: SparkSession, d: str) -> DataFrame:
    one = lambda s: F.coalesce(F.sum(F.when(c("side") == s, c("size"))), F.lit(0.0)).alias(s)
    return rounded(V.trades(spark, d).groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(c("price") * c("size")).alias("notional"), one("buy"), one("sell")), 4)


@query("agg08_vwap", V.sql("trades", "SELECT token, t // 86400000 AS day, round(sum(price * size) / sum(size), 4) AS vwap FROM trades GROUP BY ALL"))
def agg08(spark: SparkSession, d: str) -> DataFrame:
    return rounded(V.trades(spark, d).groupBy("token", F.floor(c("t") / 86_400_000).alias("day")).agg(ratio(F.sum(c("price") * c("size")), F.sum("size")).alias("vwap")), 4)


@query("agg15_staleness", V.sql("mids", "WITH m AS (SELECT token, t, floor(mid / 50) AS h, lag(floor(mid / 50)) OVER (PARTITION BY token ORDER BY t, seq) AS p FROM mids) SELECT token, CAST(count(*) FILTER (h = p) AS BIGINT) AS unchanged, CAST(count(DISTINCT h) AS BIGINT) AS distinct_hashes, max(t) - min(t) AS span_ms FROM m GROUP BY token"))
def agg15(spark: SparkSession, d: str) -> DataFrame:
    m = V.mids(spark, d).withColumn("h", F.floor(c("mid") / 50))
    m = m.withColumn("p", F.lag("h").over(Window.partitionBy("token").orderBy("t", "seq")))
    return m.groupBy("token").agg(F.count_if(c("h") == c("p")).alias("unchanged"), F.countDistinct("h").alias("distinct_hashes"), (F.max("t") - F.min("t")).alias("span_ms"))
