"""Order-book ladders from whole messages: snapshots of all levels of both sides, absolute sizes that set or delete levels, changes
of the tick size, gaps.

A book's life begins with a snapshot message and ends with the next one or with a gap; lives don't depend on each other, so they
are replayed in as many tasks as there are, however hot a token is. An unreadable level ends the life of every token in its
message, and nothing but a snapshot begins another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.clean import rounded
from tidemill.functions.folds import carried
from tidemill.functions.scratch import scratch
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col
SCALE = 1_000_000  # prices and sizes are whole millionths inside
LEVELS = "array<struct<side: string, price: bigint, size: bigint>>"
EVENT = f"token string, seq long, at int, kind string, tick long, levels {LEVELS}"
BID, ASK = 0, 1


def book_events(messages: DataFrame, column: str = "m", seq: str = "seq", keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC-13, STR-14: messages, one or a list of them, as one row for each token that a message concerns: token, seq and at (its
    place in the list), kind, tick, levels (side, price, size), and the columns to keep.

    Kinds: book (all levels of the token), delta (new sizes of levels; 0 deletes), tick, gap ({"kind": "gap", "tokens": [...]}),
    bad: a level of the message is no price from 0 to 1 with a size from 0 and a known side. A book without a side has no levels on
    it. Other messages go."""
    lv = "array<struct<asset_id: string, price: string, size: string, side: string>>"
    wire = f"array<struct<event_type: string, kind: string, tokens: array<string>, asset_id: string, tick_size: string, new_tick_size: string, bids: {lv}, asks: {lv}, price_changes: {lv}, changes: {lv}>>"
    text = F.when(F.ltrim(column).startswith("["), c(column)).otherwise(F.concat(F.lit("["), c(column), F.lit("]")))
    x = messages.select(c(seq).cast("long").alias("seq"), *keep, F.posexplode(F.from_json(text, wire)).alias("at", "x"))
    micro = lambda v: (v.try_cast("decimal(20,6)") * SCALE).cast("long")

    def level(v: Column, side: Column) -> Column:
        price, size = micro(v["price"]), micro(v["size"])
        good = side.isin("bid", "ask") & price.between(0, SCALE) & (size >= 0)
        return F.struct(F.coalesce(v["asset_id"], c("x.asset_id")).alias("token"), F.when(good, side).alias("side"), price.alias("price"), size.alias("size"))

    sided = F.create_map(F.lit("buy"), F.lit("bid"), F.lit("sell"), F.lit("ask"))
    levels = lambda column, side: F.coalesce(F.transform(c(column), lambda v: level(v, side(v))), F.array().cast("array<struct<token: string, side: string, price: bigint, size: bigint>>"))
    book = F.concat(levels("x.bids", lambda _: F.lit("bid")), levels("x.asks", lambda _: F.lit("ask")))
    change = F.coalesce("x.price_changes", "x.changes")
    x = x.withColumn("_change", change).withColumn("_book", book).withColumn("_delta", levels("_change", lambda v: sided[F.lower(v["side"])]))
    bare = lambda v: F.struct(v["side"].alias("side"), v["price"].alias("price"), v["size"].alias("size"))
    nothing = F.array().cast(LEVELS)
    row = lambda token, kind, tick, levels: F.struct(token.alias("token"), kind.alias("kind"), tick.alias("tick"), levels.alias("levels"))
    none = F.lit(None).cast("long")
    sound = lambda levels: F.forall(levels, lambda v: v["side"].isNotNull())
    one = F.array(row(c("x.asset_id"), F.when(sound(c("_book")), "book").otherwise("bad"), micro(c("x.tick_size")), F.when(sound(c("_book")), F.transform("_book", bare)).otherwise(nothing)))
    kind = F.when(sound(c("_delta")), "delta").otherwise("bad")
    tokens = F.array_distinct(F.transform("_delta", lambda v: v["token"]))
    many = F.transform(tokens, lambda t: row(t, kind, none, F.when(kind == "delta", F.transform(F.filter("_delta", lambda v: v["token"].eqNullSafe(t)), bare)).otherwise(nothing)))
    tick = F.array(row(c("x.asset_id"), F.lit("tick"), micro(c("x.new_tick_size")), nothing))
    gap = F.transform("x.tokens", lambda t: row(t, F.lit("gap"), none, nothing))
    each = F.when(c("x.kind") == "gap", gap).when(c("x.event_type") == "book", one).when(c("x.event_type") == "price_change", many).when(c("x.event_type") == "tick_size_change", tick)
    out = x.select("seq", "at", *keep, F.explode(each).alias("y")).where("y.token IS NOT NULL")
    return out.select("y.token", "seq", "at", "y.kind", "y.tick", "y.levels", *keep)


def lives(ev: DataFrame, span: int = 1 << 16) -> DataFrame:
    """STR-15: adds life - the (seq, at) of the snapshot, gap or bad message that the token's book dates from - and alive, whether that
    is a snapshot. Marks are carried through stretches of `span` numbers, so a hot token is spread over its stretches."""
    mark = F.when(~c("kind").isin("delta", "tick"), F.struct("seq", "at", (c("kind") == "book").alias("alive")))
    out = carried(ev, ["token"], ["seq", "at"], F.floor(c("seq") / span), mark, "_mark")
    return out.withColumns({"life": F.struct("_mark.seq", "_mark.at"), "alive": F.coalesce("_mark.alive", F.lit(False))}).drop("_mark")


def versions(ev: DataFrame) -> DataFrame:
    """STR-14: each level's sizes with the numbers [seq, until) for which they hold, within a book's life: token, life, side, price,
    size, seq, until. A size of 0 is a deletion."""
    rows = lives(ev).where("alive").select("token", "life", "seq", "at", F.posexplode("levels").alias("nth", "v"))
    w = Window.partitionBy("token", "life", "side", "price").orderBy("seq", "at", "nth")
    one = rows.select("token", "life", "v.side", "v.price", "v.size", "seq", "at", "nth")
    return one.select("token", c("life.seq").alias("life"), "side", _number("price"), _number("size"), "seq", F.lead("seq").over(w).alias("until"))


def _number(name: str) -> Column:
    return (c(name) / F.lit(SCALE).cast("decimal(20,0)")).cast("decimal(20,6)").alias(name)


class Book:
    """Sizes by price of both sides, and the best of each."""

    __slots__ = ("sizes", "heaps", "tick")

    def __init__(self, tick: int | None = None) -> None:
        self.sizes: tuple[dict[int, int], dict[int, int]] = ({}, {})
        self.heaps: tuple[list[int], list[int]] = ([], [])
        self.tick = tick

    def set(self, side: int, price: int, size: int) -> int:
        """Gives a level its new size, and returns the one that it had."""
        own = self.sizes[side]
        before = own.get(price, 0)
        if size > 0:
            if not before:
                heappush(self.heaps[side], price if side == ASK else -price)
            own[price] = size
        elif before:
            del own[price]
        return before

    def best(self, side: int) -> int | None:
        own, heap = self.sizes[side], self.heaps[side]
        while heap and abs(heap[0]) not in own:
            heappop(heap)
        return abs(heap[0]) if heap else None

    def near(self, side: int, within: int) -> int | None:
        best = self.best(side)
        return None if best is None else sum(q for p, q in self.sizes[side].items() if abs(p - best) <= within)


TOP = ("bid", "bid_size", "ask", "ask_size", "ask_near", "tick")
CHANGE = ("price", "before", "after", "best")


def top(book: Book | None, within: int) -> tuple:
    """TOP of a book; nothing of one that is not known."""
    if book is None:
        return (None,) * 6
    bid, ask = book.best(BID), book.best(ASK)
    return bid, book.sizes[BID].get(bid), ask, book.sizes[ASK].get(ask), book.near(ASK, within), book.tick


def _replayed(within: int, changes: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, book = None, None
        for batch in batches:
            token, seq, at, kind, tick, alive, life = (batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 6, 7))
            column = batch.column(5)
            begin, flat = column.offsets.to_pylist(), column.values
            side, price, size = (flat.field(i).to_pylist() for i in range(3))
            rows: list[tuple] = []
            for i in range(len(token)):
                if (token[i], life[i]) != held:
                    held, book = (token[i], life[i]), Book() if alive[i] else None
                if book is not None:
                    if kind[i] in ("book", "tick"):
                        book.tick = tick[i]
                    for k in range(begin[i], begin[i + 1]):
                        s = ASK if side[k] == "ask" else BID
                        before = book.set(s, price[k], size[k])
                        if changes and kind[i] == "delta":
                            rows.append((token[i], life[i], seq[i], at[i], side[k], price[k], before, size[k], book.best(s)))
                if not changes:
                    rows.append((token[i], seq[i], at[i], *top(book, within)))
            many = pa.int64()
            kinds = (pa.string(), many, many, pa.int32(), pa.string(), *[many] * 4) if changes else (pa.string(), many, pa.int32(), *[many] * 6)
            names = ["token", "life", "seq", "at", "side", *CHANGE] if changes else ["token", "seq", "at", *TOP]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names)

    return run


def _replay(ev: DataFrame, within: int, changes: bool, schema: str) -> DataFrame:
    rows = lives(ev).select("token", "seq", "at", "kind", "tick", "levels", "alive", c("life.seq").alias("life"), c("life.at").alias("_life_at"))
    dealt = rows.repartition("token", "life", "_life_at").sortWithinPartitions("token", "life", "_life_at", "seq", "at").drop("_life_at")
    return dealt.mapInArrow(_replayed(within, changes), schema)


def tops(ev: DataFrame, within: float = 0.01) -> DataFrame:
    """STR-14/15, AGG-34: after each event of a token (see book_events) its best bid and ask with their sizes, the shares asked up to
    `within` over the best, and the tick size: token, seq, at, bid, bid_size, ask, ask_size, ask_near, tick. All NULL from a gap or a
    bad message to the next snapshot."""
    out = _replay(ev, round(within * SCALE), False, "token string, seq long, at int, " + ", ".join(f"{n} long" for n in TOP))
    return out.select("token", "seq", "at", *[_number(n) for n in TOP])


def changes(ev: DataFrame) -> DataFrame:
    """STR-16: each level that a delta sets in a known book: token, life, seq, at, side, price, before, after, best (of its side, after
    it)."""
    out = _replay(ev, 0, True, "token string, life long, seq long, at int, side string, " + ", ".join(f"{n} long" for n in CHANGE))
    return out.select("token", "life", "seq", "at", "side", *[_number(n) for n in CHANGE])


def added(rows: DataFrame, near: float = 0.02) -> Column:
    """The size that a row of changes adds, if it does and within `near` of its side's best; else NULL."""
    return F.when((c("after") > c("before")) & (F.abs(c("price") - c("best")) <= F.lit(near).cast("decimal(20,6)")), c("after") - c("before"))


# Queries: the driver's events as messages of a market channel, written as JSON and read back. A book has six levels on each side; a
# change sets a level of each side of its token, and one of the next token; some messages are gaps, bad, or change the tick size.


def wire(spark: SparkSession, d: str) -> DataFrame:
    """The messages: seq, t (ms), m."""
    k, e = F.get_json_object("props", "$.k").cast("int"), c("event_id")
    token = F.concat(F.lit("tok"), (c("user_id") % 8).cast("string"))
    other = F.concat(F.lit("tok"), ((c("user_id") + 1) % 8).cast("string"))
    cents = lambda x: (x.cast("decimal(12,0)") / 100).cast("decimal(12,2)").cast("string")
    level = lambda p, q, *more: F.struct(*more, cents(p).alias("price"), q.cast("string").alias("size"))
    center = 45 + e % 11
    side = lambda sign: F.transform(F.sequence(F.lit(0), F.lit(5)), lambda j: level(center + sign * (j + 1), j + 1 + k % 5))
    book = F.to_json(F.struct(F.lit("book").alias("event_type"), token.alias("asset_id"), F.lit("0.01").alias("tick_size"), side(-1).alias("bids"), side(1).alias("asks")))
    set_ = lambda t, s, p, q: level(p, q, t.alias("asset_id"), F.lit(s).alias("side"))
    three = F.array(set_(token, "BUY", 49 - k % 6, F.when(e % 97 == 1, -1).when(e % 3 == 0, 0).otherwise(k + 1)), set_(token, "SELL", 51 + k % 7, F.when(e % 5 == 0, 0).otherwise(k + 2)), set_(other, "SELL", 50 + k % 5, F.when(e % 4 == 0, 0).otherwise(k + 3)))
    delta = F.to_json(F.struct(F.lit("price_change").alias("event_type"), three.alias("price_changes")))
    gap = F.to_json(F.struct(F.lit("gap").alias("kind"), F.array(token).alias("tokens")))
    tick = F.to_json(F.struct(F.lit("tick_size_change").alias("event_type"), token.alias("asset_id"), F.lit("0.001").alias("new_tick_size")))
    text = F.when(e % 23 == 0, gap).when(e % 41 == 0, tick).when(e % 7 == 0, book).otherwise(delta)
    rows = V.events(spark, d).repartition(spark.sparkContext.defaultParallelism, "event_id")  # the table is one file
    return rows.select(e.alias("seq"), V.millis("ts").alias("t"), F.when(e % 2 == 0, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text).alias("m"))


WIRE = """WITH e AS (SELECT event_id AS seq, epoch_us(ts) // 1000 AS t, 'tok' || (user_id % 8) AS token, 'tok' || ((user_id + 1) % 8) AS other,
  CAST(json_extract(props, '$.k') AS INT) AS k,
  CASE WHEN event_id % 23 = 0 THEN 'gap' WHEN event_id % 41 = 0 THEN 'tick' WHEN event_id % 7 = 0 THEN 'book'
       WHEN event_id % 97 = 1 THEN 'bad' ELSE 'delta' END AS kind FROM events),
ev AS (SELECT seq, t, token, kind, k FROM e UNION ALL SELECT seq, t, other, kind, k FROM e WHERE kind IN ('delta', 'bad')),
lf AS (SELECT *, last_value(CASE WHEN kind NOT IN ('delta', 'tick') THEN {'s': seq, 'k': kind} END IGNORE NULLS)
         OVER (PARTITION BY token ORDER BY seq ROWS UNBOUNDED PRECEDING) AS m FROM ev),
lives AS (SELECT seq, t, token, kind, m.s AS life, coalesce(m.k = 'book', false) AS alive FROM lf),
lv AS (SELECT seq, token, 'bid' AS side, 44 + seq % 11 - j AS p, j + 1 + k % 5 AS q FROM e, range(6) r(j) WHERE kind = 'book'
  UNION ALL SELECT seq, token, 'ask', 46 + seq % 11 + j, j + 1 + k % 5 FROM e, range(6) r(j) WHERE kind = 'book'
  UNION ALL SELECT seq, token, 'bid', 49 - k % 6, CASE WHEN seq % 3 = 0 THEN 0 ELSE k + 1 END FROM e WHERE kind = 'delta'
  UNION ALL SELECT seq, token, 'ask', 51 + k % 7, CASE WHEN seq % 5 = 0 THEN 0 ELSE k + 2 END FROM e WHERE kind = 'delta'
  UNION ALL SELECT seq, other, 'ask', 50 + k % 5, CASE WHEN seq % 4 = 0 THEN 0 ELSE k + 3 END FROM e WHERE kind = 'delta'),
own AS (SELECT lives.token, life, lives.seq, t, kind, side, p / 100.0::DOUBLE AS price, q::DOUBLE AS size FROM lives JOIN lv USING (token, seq) WHERE alive),
v AS (SELECT *, lead(seq) OVER w AS until, coalesce(lag(size) OVER w, 0) AS before FROM own WINDOW w AS (PARTITION BY token, life, side, price ORDER BY seq)),
held AS (SELECT x.token, x.seq, x.life, v.side, v.price, v.size FROM lives x JOIN v ON v.token = x.token AND v.life = x.life AND v.seq <= x.seq
  AND (v.until IS NULL OR v.until > x.seq) WHERE x.alive AND v.size > 0),
best AS (SELECT token, seq, max(price) FILTER (side = 'bid') AS bid, min(price) FILTER (side = 'ask') AS ask FROM held GROUP BY ALL),
ch AS (SELECT v.token, life, seq, t, side, price, before, size AS after, CASE WHEN side = 'bid' THEN bid ELSE ask END AS best
  FROM v JOIN best USING (token, seq) WHERE kind = 'delta'),
adds AS (SELECT *, CASE WHEN after > before AND abs(price - best) <= 0.02 + 1e-9 THEN after - before END AS added FROM ch)"""


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*[c(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c(f.name) for f in df.schema])


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The events, parsed once and written, as lives() reads them three times."""
    path = scratch(spark, "book-events")
    book_events(wire(spark, d)).write.parquet(path)
    return spark.read.parquet(path)


@query("str14_ladder_versions", f"{WIRE} SELECT token, life, side, price, size, seq, until FROM v")
def str14(spark: SparkSession, d: str) -> DataFrame:
    return _doubles(versions(_events(spark, d)))


@query("str14_best_ask", f"""{WIRE},
ticks AS (SELECT token, seq, last_value(CASE kind WHEN 'book' THEN 0.01 WHEN 'tick' THEN 0.001 END IGNORE NULLS) OVER (PARTITION BY token, life ORDER BY seq ROWS UNBOUNDED PRECEDING) AS tick FROM lives WHERE alive),
s AS (SELECT h.token, h.seq, sum(size) FILTER (side = 'bid' AND price = bid) AS bid_size, sum(size) FILTER (side = 'ask' AND price = ask) AS ask_size,
        sum(size) FILTER (side = 'ask' AND price <= ask + 0.01 + 1e-9) AS ask_near FROM held h JOIN best USING (token, seq) GROUP BY ALL)
SELECT l.token, l.seq, bid, bid_size, ask, ask_size, ask_near, CAST(tick AS DOUBLE) AS tick
FROM lives l LEFT JOIN best USING (token, seq) LEFT JOIN s USING (token, seq) LEFT JOIN ticks USING (token, seq)""")
def str14_best(spark: SparkSession, d: str) -> DataFrame:
    return _doubles(tops(_events(spark, d)).drop("at"))


@query("str16_add_flow", f"""{WIRE} SELECT token, life, side, count(added) AS adds, round(coalesce(sum(added), 0), 4) AS added FROM adds GROUP BY ALL""")
def str16(spark: SparkSession, d: str) -> DataFrame:
    """Sizes that deltas add near the best, in each life and on each side that they touch."""
    x = changes(_events(spark, d))
    x = x.withColumn("added", added(x))
    return rounded(_doubles(x.groupBy("token", "life", "side").agg(F.count("added").alias("adds"), F.coalesce(F.sum("added"), F.lit(0)).cast("double").alias("added"))), 4)
