"""Recorded messages as rows: exchange streams, book polls, market look-ups, paged downloads. Readers parse text columns with
from_json, so a file, a table or a stream of messages works alike; nothing here opens a connection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import half_up, holds, rounded
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col


def _seconds(ms: Column) -> Column:
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def kline_messages(messages: DataFrame, column: str = "m") -> DataFrame:
    """SRC-10: bars of kline messages {k: {t, o, h, l, c, v, n, q, V, Q, x}} that are closed (x); others and unreadable ones go."""
    kind = "k struct<t: bigint, o: string, h: string, l: string, c: string, v: string, n: bigint, x: boolean>"
    k = messages.select(F.from_json(column, kind)["k"].alias("k")).where(holds(c("k.x")))
    number = lambda f, n: c(f"k.{f}").try_cast("double").alias(n)
    return k.select(_seconds(c("k.t")).alias("ts"), number("o", "open"), number("h", "high"), number("l", "low"), number("c", "close"), number("v", "volume"), c("k.n").alias("num_trades"))


def mid_messages(messages: DataFrame, column: str = "m", recv: str = "recv_ms") -> DataFrame:
    """SRC-11: mids of best bid and ask messages {b, a, E}: event_ms (the time of receipt where E is missing), recv_ms, mid.
    Messages without both prices, or with a mid of 0 or less, go. spaced(..., 250) keeps one in 250 ms."""
    j = messages.select(c(recv).alias("recv_ms"), F.from_json(column, "b string, a string, E bigint").alias("j"))
    mid = (c("j.b").try_cast("double") + c("j.a").try_cast("double")) / 2
    return j.select(F.coalesce("j.E", "recv_ms").alias("event_ms"), "recv_ms", mid.alias("mid")).where("mid > 0")


def depth_messages(messages: DataFrame, column: str = "m", recv: str = "recv_ms") -> DataFrame:
    """SRC-12: depth frames {b|bids, a|asks: [[price, size], ...], E}: event_ms, recv_ms, bids and asks as arrays of structs,
    unreadable levels left out. One frame a second: spaced(..., 1000)."""
    side = "array<array<string>>"
    j = messages.select(c(recv).alias("recv_ms"), F.from_json(column, f"b {side}, a {side}, bids {side}, asks {side}, E bigint").alias("j"))
    levels = lambda x: F.filter(F.transform(x, lambda v: F.struct(F.get(v, F.lit(0)).try_cast("double").alias("price"), F.get(v, F.lit(1)).try_cast("double").alias("size"))), lambda v: v["price"].isNotNull() & v["size"].isNotNull())
    out = j.select(F.coalesce("j.E", "recv_ms").alias("event_ms"), "recv_ms", levels(F.coalesce("j.b", "j.bids")).alias("bids"), levels(F.coalesce("j.a", "j.asks")).alias("asks"))
    return out.where(c("bids").isNotNull() & c("asks").isNotNull())


def liquidations(messages: DataFrame, column: str = "m", alert: float = 1.0) -> DataFrame:
    """SRC-14: orders of liquidation messages {E, o: {S, p, q, z, X}}: event_ms, side, price, size, filled, status, alert (a
    size of at least `alert`)."""
    j = messages.select(F.from_json(column, "E bigint, o struct<S: string, p: string, q: string, z: string, X: string>").alias("j")).where("j.o IS NOT NULL")
    number = lambda f: c(f"j.o.{f}").try_cast("double")
    size = F.coalesce(number("q"), F.lit(0.0))
    return j.select(c("j.E").alias("event_ms"), c("j.o.S").alias("side"), number("p").alias("price"), size.alias("size"), number("z").alias("filled"), c("j.o.X").alias("status"), (size >= alert).alias("alert"))


def book_polls(polls: DataFrame, column: str = "m") -> DataFrame:
    """SRC-15: a poll of a book {bids, asks: [{price, size}], timestamp, hash, last_trade_price}, whose best levels come last:
    best bid and ask with their sizes, mid (0 unless both are there), the asks from low to high, book_ms, hash, last_trade."""
    side = "array<struct<price: string, size: string>>"
    j = polls.withColumn("j", F.from_json(column, f"bids {side}, asks {side}, timestamp string, hash string, last_trade_price string"))
    best = lambda x, f: F.coalesce(F.try_element_at(c(f"j.{x}"), F.lit(-1))[f], F.lit("0"))
    bid, ask = best("bids", "price").try_cast("double"), best("asks", "price").try_cast("double")
    ladder = F.array_sort(F.transform(F.coalesce(c("j.asks"), F.array().cast(side)), lambda v: F.struct(v["price"].try_cast("double").alias("price"), v["size"].try_cast("double").alias("size"))))
    out = {"bid": bid, "bid_size": best("bids", "size").try_cast("double"), "ask": ask, "ask_size": best("asks", "size").try_cast("double"), "mid": F.when((bid > 0) & (ask > 0), (bid + ask) / 2).otherwise(0.0), "ask_ladder": ladder, "book_ms": c("j.timestamp").try_cast("bigint"), "hash": c("j.hash"), "last_trade": c("j.last_trade_price").try_cast("double")}
    return j.where("j IS NOT NULL").withColumns(out).drop("j", column)


def resolved_markets(replies: DataFrame, column: str = "m") -> DataFrame:
    """SRC-16: the first market of a look-up's first event, with its lists, which come as JSON within JSON or as lists: slug,
    title, outcomes, token_ids, condition_id; replies without a market go."""
    market = "struct<outcomes: string, clobTokenIds: string, conditionId: string>"
    j = replies.select(F.from_json(column, f"events array<struct<slug: string, title: string, markets: array<{market}>>>").alias("j"))
    e = j.select(F.get(c("j.events"), F.lit(0)).alias("e")).select("e", F.get(c("e.markets"), F.lit(0)).alias("m")).where("m IS NOT NULL")
    return e.select("e.slug", "e.title", F.from_json("m.outcomes", "array<string>").alias("outcomes"), F.from_json("m.clobTokenIds", "array<string>").alias("token_ids"), c("m.conditionId").alias("condition_id"))


def paged_trades(pages: DataFrame, cutoff: int, limit: int, most: int, column: str = "m") -> tuple[DataFrame, DataFrame]:
    """SRC-17, AGG-21: downloads newest first, pages(slug, page, m: a JSON list of trades).

    Gives (trades, summary). Trades: slug, ts, price, size, side of the pages up to the first one that is short, empty or whose
    last trade lies before the cutoff; none before the cutoff. Summary, a row per slug: n_trades, n_pages, earliest, latest,
    capped: the pages ended before the cutoff with at least most - limit trades, so the source's limit cut them off.
    """
    rows = "array<struct<timestamp: bigint, price: double, size: double, side: string>>"
    p = pages.select("slug", "page", F.from_json(column, rows).alias("t")).withColumn("n", F.coalesce(F.size("t"), F.lit(0)))
    past = holds(F.try_element_at(c("t"), F.lit(-1))["timestamp"] < cutoff)
    stop = F.when(past | (c("n") < limit), c("page"))
    p = p.withColumn("reached", past).withColumn("stop", F.min(stop).over(Window.partitionBy("slug"))).where(c("stop").isNull() | (c("page") <= c("stop")))
    trades = p.select("slug", F.explode("t").alias("t")).where(c("t.timestamp") >= cutoff).select("slug", c("t.timestamp").alias("ts"), "t.price", "t.size", "t.side")
    per = p.groupBy("slug").agg(F.count(F.lit(1)).alias("n_pages"), F.max("reached").alias("reached"))
    sums = trades.groupBy("slug").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("earliest"), F.max("ts").alias("latest"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return trades, per.join(sums, "slug", "left").select("slug", n.alias("n_trades"), "n_pages", (~c("reached") & (n >= most - limit)).alias("capped"), "earliest", "latest")


def run_totals(wanted: DataFrame, there: DataFrame, summary: DataFrame) -> DataFrame:
    """AGG-21: totals of a run over wanted(slug): ok, skip (there before), no_market (neither there nor downloaded), capped,
    trades_total."""
    j = wanted.select("slug").distinct().join(there.select("slug", F.lit(True).alias("skip")).distinct(), "slug", "left").join(summary, "slug", "left")
    got = c("n_pages").isNotNull() & c("skip").isNull()
    return j.agg(F.count_if(got).alias("ok"), F.count_if(c("skip")).alias("skip"), F.count_if(c("skip").isNull() & c("n_pages").isNull()).alias("no_market"), F.count_if(got & c("capped")).alias("capped"), F.coalesce(F.sum(F.when(got, c("n_trades"))), F.lit(0)).alias("trades_total"))


def discovered(pages: DataFrame, column: str = "m") -> DataFrame:
    """SRC-22: entries of paged or cursor-paged listings, pages(fetch, page, m: {events: [...], next_cursor}), each once as
    first seen: id, slug, n_markets, seen_on (page). Pages after one without a cursor, or after one whose cursor came before (a
    loop), don't count."""
    kind = "events array<struct<id: string, slug: string, markets: array<string>>>, next_cursor string"
    p = pages.select("fetch", "page", F.from_json(column, kind).alias("j"))
    again = F.row_number().over(Window.partitionBy("fetch", "j.next_cursor").orderBy("page")) > 1
    p = p.withColumn("stop", c("j.next_cursor").isNull() | (c("j.next_cursor") == "") | again)
    p = p.withColumn("last", F.min(F.when(c("stop"), c("page"))).over(Window.partitionBy("fetch"))).where(c("last").isNull() | (c("page") <= c("last")))
    e = p.select("page", F.posexplode("j.events").alias("at", "e")).select("e.id", "page", "at", "e.slug", F.coalesce(F.size("e.markets"), F.lit(0)).alias("n_markets"))
    return e.groupBy("id").agg(F.min_by(F.struct("slug", "n_markets", "page"), F.struct("page", "at")).alias("x")).select("id", "x.slug", "x.n_markets", c("x.page").alias("seen_on"))


def ladder_messages(messages: DataFrame, column: str = "m", recv: str = "recv_ms") -> DataFrame:
    """SRC-13: book, price_change and tick_size_change messages, one or a list, as ladder events: recv_ms, frame_index, at (place
    in the message), kind (book, delta, tick), asset_id, side, price, size. A book is one row for each of its levels."""
    lv = "array<struct<asset_id: string, price: string, size: string, side: string>>"
    kind = f"array<struct<event_type: string, asset_id: string, bids: {lv}, asks: {lv}, price_changes: {lv}, changes: {lv}, new_tick_size: string>>"
    text = F.when(F.ltrim(column).startswith("["), c(column)).otherwise(F.concat(F.lit("["), c(column), F.lit("]")))
    x = messages.select(c(recv).alias("recv_ms"), F.posexplode(F.from_json(text, kind)).alias("frame_index", "x"))
    none = F.array().cast("array<struct<kind:string,asset_id:string,side:string,price:string,size:string>>")
    row = lambda k, levels, side: F.transform(levels, lambda v: F.struct(F.lit(k).alias("kind"), F.coalesce(v["asset_id"], c("x.asset_id")).alias("asset_id"), (F.lit(side) if side else F.lower(v["side"])).alias("side"), v["price"].alias("price"), v["size"].alias("size")))
    book = F.concat(F.coalesce(row("book", c("x.bids"), "buy"), none), F.coalesce(row("book", c("x.asks"), "sell"), none))
    tick = F.array(F.struct(F.lit("tick").alias("kind"), c("x.asset_id").alias("asset_id"), F.lit(None).cast("string").alias("side"), c("x.new_tick_size").alias("price"), F.lit(None).cast("string").alias("size")))
    each = F.when(c("x.event_type") == "book", book).when(c("x.event_type") == "price_change", F.coalesce(row("delta", F.coalesce("x.price_changes", "x.changes"), None), none)).when(c("x.event_type") == "tick_size_change", tick)
    out = x.select("recv_ms", "frame_index", F.posexplode(each).alias("at", "v"))
    return out.select("recv_ms", "frame_index", "at", "v.kind", "v.asset_id", "v.side", c("v.price").try_cast("decimal(20,6)").alias("price"), c("v.size").try_cast("decimal(20,6)").alias("size"))


# Queries: the driver's events as messages, parsed back.


def _text(x: Column) -> Column:
    """A price with two decimals as text."""
    return x.cast("decimal(12,2)").cast("string")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return V.events(spark, d).withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn("ms", V.millis("ts"))


K = "CAST(json_extract(props, '$.k') AS INT)"
P = "CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE)"


@query("src10_kline_messages", f"SELECT ts, {P} AS open, round({P} + 1, 2) AS high, round({P} - 1, 2) AS low, {P} AS close, CAST(k AS DOUBLE) AS volume, CAST(event_id AS BIGINT) AS num_trades FROM (SELECT *, {K} AS k FROM (SELECT event_id, value, props, to_timestamp(epoch_us(ts) // 1000000)::TIMESTAMP AS ts FROM events)) WHERE event_id % 3 = 0 AND event_id % 31 <> 30")
def src10(spark: SparkSession, d: str) -> DataFrame:
    p = c("value").cast("decimal(12,2)")
    k = F.struct((F.floor(c("ms") / 1000) * 1000).alias("t"), _text(p).alias("o"), _text(p + 1).alias("h"), _text(p - 1).alias("l"), _text(p).alias("c"), c("k").cast("string").alias("v"), c("event_id").alias("n"), (c("event_id") % 3 == 0).alias("x"))
    return kline_messages(_events(spark, d).select(F.when(c("event_id") % 31 == 30, "{torn").otherwise(F.to_json(F.struct(k.alias("k")))).alias("m"))).withColumns({x: half_up(c(x), 2) for x in ("high", "low")})


@query("src11_mid_messages", f"WITH m AS (SELECT event_id, epoch_us(ts) // 1000 AS ms, {P} AS b, {K} AS k FROM events) SELECT CASE WHEN event_id % 5 = 0 THEN ms ELSE ms - 40 END AS event_ms, ms AS recv_ms, round(b + k / 2.0, 6) AS mid FROM m WHERE event_id % 7 <> 0 AND b + k / 2.0 > 0")
def src11(spark: SparkSession, d: str) -> DataFrame:
    p = c("value").cast("decimal(12,2)")
    m = F.to_json(F.struct(F.when(c("event_id") % 7 != 0, _text(p)).alias("b"), _text(p + c("k")).alias("a"), F.when(c("event_id") % 5 != 0, c("ms") - 40).alias("E")))
    return rounded(mid_messages(_events(spark, d).select(m.alias("m"), c("ms").alias("recv_ms"))))


@query("src14_liquidations", f"SELECT epoch_us(ts) // 1000 AS event_ms, CASE WHEN event_type = 'click' THEN 'BUY' ELSE 'SELL' END AS side, {P} AS price, {K} / 10.0 AS size, {K} / 10.0 >= 1 AS alert FROM events")
def src14(spark: SparkSession, d: str) -> DataFrame:
    o = F.struct(F.when(c("event_type") == "click", "BUY").otherwise("SELL").alias("S"), _text(c("value")).alias("p"), (c("k") / 10).cast("string").alias("q"))
    return liquidations(_events(spark, d).select(F.to_json(F.struct(c("ms").alias("E"), o.alias("o"))).alias("m"))).select("event_ms", "side", "price", "size", "alert")


@query("src15_book_polls", "WITH b AS (SELECT l_orderkey AS book, CASE WHEN l_returnflag = 'N' THEN 'ask' ELSE 'bid' END AS side, CAST(CAST(l_discount AS DECIMAL(12,2)) AS DOUBLE) + l_linenumber AS price, l_quantity AS size FROM lineitem), g AS (SELECT book, max(price) FILTER (side = 'bid') AS bid, min(price) FILTER (side = 'ask') AS ask, CAST(count(*) FILTER (side = 'ask') AS INT) AS n_asks FROM b GROUP BY book) SELECT book, coalesce(bid, 0) AS bid, coalesce(ask, 0) AS ask, round(CASE WHEN bid > 0 AND ask > 0 THEN (bid + ask) / 2 ELSE 0 END, 6) AS mid, n_asks FROM g")
def src15(spark: SparkSession, d: str) -> DataFrame:
    li = V.table(spark, d, "lineitem").withColumn("price", (c("l_discount").cast("decimal(12,2)") + c("l_linenumber")).cast("decimal(12,2)"))
    lv = F.struct(c("price").alias("p"), c("price").cast("string").alias("price"), c("l_quantity").cast("string").alias("size"))
    g = li.groupBy(c("l_orderkey").alias("book")).agg(F.array_sort(F.collect_list(F.when(c("l_returnflag") != "N", lv))).alias("bids"), F.reverse(F.array_sort(F.collect_list(F.when(c("l_returnflag") == "N", lv)))).alias("asks"))
    side = lambda x: F.transform(x, lambda v: F.struct(v["price"].alias("price"), v["size"].alias("size"))).alias(x)
    polls = g.select("book", F.to_json(F.struct(side("bids"), side("asks"))).alias("m"))
    return rounded(book_polls(polls).select("book", "bid", "ask", "mid", F.size("ask_ladder").alias("n_asks")))


@query("src16_market_lookup", "SELECT 'm-' || o_orderkey AS slug, CASE WHEN o_orderkey % 2 = 0 THEN 'Up,Down' ELSE 'Yes,No' END AS outcomes, CAST(o_orderkey AS VARCHAR) || 'a' AS first_token, 'c' || o_custkey AS condition_id FROM orders WHERE o_orderkey % 9 <> 0")
def src16(spark: SparkSession, d: str) -> DataFrame:
    k = c("o_orderkey")
    tokens = F.to_json(F.array(F.concat(k.cast("string"), F.lit("a")), F.concat(k.cast("string"), F.lit("b"))))
    market = F.struct(F.when(k % 2 == 0, '["Up", "Down"]').otherwise('["Yes", "No"]').alias("outcomes"), tokens.alias("clobTokenIds"), F.concat(F.lit("c"), c("o_custkey").cast("string")).alias("conditionId"))
    markets = F.when(k % 9 == 0, F.slice(F.array(market), 1, 0)).otherwise(F.array(market))
    m = F.to_json(F.struct(F.array(F.struct(F.concat(F.lit("m-"), k.cast("string")).alias("slug"), c("o_orderstatus").alias("title"), markets.alias("markets"))).alias("events")))
    return resolved_markets(V.table(spark, d, "orders").select(m.alias("m"))).select("slug", F.array_join("outcomes", ",").alias("outcomes"), F.get("token_ids", F.lit(0)).alias("first_token"), "condition_id")


CUT = 1_704_900_000  # seconds; trades before it are not wanted


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Clicks of a token as pages of 20, newest first."""
    t = V.trades(spark, d)
    t = t.withColumn("i", F.row_number().over(Window.partitionBy("token").orderBy(F.desc("t"), F.desc("seq"))) - 1)
    row = F.struct("i", F.floor(c("t") / 1000).alias("timestamp"), "price", "size", "side")
    g = t.groupBy(c("token").alias("slug"), F.floor(c("i") / 20).alias("page")).agg(F.array_sort(F.collect_list(row)).alias("a"))
    return g.select("slug", "page", F.to_json("a").alias("m"))


PAGED = f"""WITH t AS (SELECT token AS slug, t // 1000 AS ts, row_number() OVER (PARTITION BY token ORDER BY t DESC, seq DESC) - 1 AS i FROM trades),
g AS (SELECT slug, i // 20 AS page, count(*) AS n, min(ts) AS lo FROM t GROUP BY ALL), s AS (SELECT slug, min(page) FILTER (lo < {CUT} OR n < 20) AS stop, bool_or(lo < {CUT}) AS past FROM g GROUP BY slug),
p AS (SELECT g.* FROM g JOIN s USING (slug) WHERE stop IS NULL OR page <= stop), k AS (SELECT t.slug, t.ts FROM t JOIN p ON p.slug = t.slug AND p.page = t.i // 20 WHERE t.ts >= {CUT})"""


@query("src17_paged_trades", V.sql("trades", f"{PAGED}, x AS (SELECT slug, count(*) AS n_pages, bool_or(lo < {CUT}) AS reached FROM p GROUP BY slug), y AS (SELECT slug, count(*) AS n, min(ts) AS earliest, max(ts) AS latest FROM k GROUP BY slug) SELECT slug, CAST(coalesce(n, 0) AS BIGINT) AS n_trades, CAST(n_pages AS BIGINT) AS n_pages, NOT reached AND coalesce(n, 0) >= 180 AS capped, earliest, latest FROM x LEFT JOIN y USING (slug)"))
def src17(spark: SparkSession, d: str) -> DataFrame:
    return paged_trades(_pages(spark, d), CUT, 20, 200)[1]


@query("agg21_run_totals", V.sql("trades", f"{PAGED}, x AS (SELECT slug, count(*) AS n_pages, bool_or(lo < {CUT}) AS reached FROM p GROUP BY slug), y AS (SELECT slug, count(*) AS n FROM k GROUP BY slug), w AS (SELECT unnest(range(0, 12)) AS slug), j AS (SELECT w.slug, w.slug IN (1, 9) AS skip, n_pages, coalesce(n, 0) AS n, NOT reached AND coalesce(n, 0) >= 180 AS capped FROM w LEFT JOIN x USING (slug) LEFT JOIN y USING (slug)) SELECT CAST(count(*) FILTER (NOT skip AND n_pages IS NOT NULL) AS BIGINT) AS ok, CAST(count(*) FILTER (skip) AS BIGINT) AS skip, CAST(count(*) FILTER (NOT skip AND n_pages IS NULL) AS BIGINT) AS no_market, CAST(count(*) FILTER (NOT skip AND capped AND n_pages IS NOT NULL) AS BIGINT) AS capped, CAST(coalesce(sum(n) FILTER (NOT skip AND n_pages IS NOT NULL), 0) AS BIGINT) AS trades_total FROM j"))
def agg21(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.range(12).select(c("id").alias("slug"))
    return run_totals(wanted, wanted.where("slug IN (1, 9)"), paged_trades(_pages(spark, d), CUT, 20, 200)[1])


@query("src22_discovery", "WITH e AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id, CAST(o_orderkey // 100 AS BIGINT) AS page FROM orders) SELECT id, min(page) AS seen_on FROM e GROUP BY id")
def src22(spark: SparkSession, d: str) -> DataFrame:
    e = F.struct(c("o_custkey").cast("string").alias("id"), c("o_orderstatus").alias("slug"))
    o = V.table(spark, d, "orders").groupBy(F.floor(c("o_orderkey") / 100).alias("page")).agg(F.collect_list(e).alias("events"))
    nxt = F.lead("page").over(Window.partitionBy(F.lit(0)).orderBy("page"))  # a row per page
    pages = o.withColumn("next_cursor", nxt.cast("string")).select(F.lit("all").alias("fetch"), "page", F.to_json(F.struct("events", "next_cursor")).alias("m"))
    return discovered(pages).select("id", "seen_on")
