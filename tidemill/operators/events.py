"""Impulses, change logs, entity resolution and reports over event and record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import holds, ratio, rounded
from tidemill.plans.registry import query
from tidemill.sources import views as V
from tidemill.sources.files import millis_of

c = F.col
HOUR = 3_600_000


def robust(x: str, key: str, order: tuple[str, ...], n: int = 10, least: int = 5, floor: float = 0.01) -> tuple[Column, Column]:
    """AGG-29: median and max(floor, 3 MAD) of the n values before this one; of the last `least` with fewer than n; NULL with
    fewer than that. By index of sorted arrays, so decimals stay exact."""
    w = Window.partitionBy(key).orderBy(*order)
    all_ = F.collect_list(x).over(w.rowsBetween(-n, -1))
    seen = F.when(F.size(all_) >= n, all_).when(F.size(all_) >= least, F.slice(all_, -least, least))

    def median(a: Column) -> Column:
        s = F.array_sort(a)
        m = F.size(s)
        return (F.element_at(s, (F.floor((m - 1) / 2) + 1).cast("int")) + F.element_at(s, (F.floor(m / 2) + 1).cast("int"))) / 2

    mid = median(seen)
    return mid, F.when(mid.isNotNull(), F.greatest(F.lit(floor), 3 * median(F.transform(seen, lambda v: F.abs(v - mid)))))


@query("agg29_robust_reference", V.sql("trades", """WITH a AS (SELECT token, t, seq, price, list(price) OVER (PARTITION BY token ORDER BY t, seq ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS l FROM trades),
s AS (SELECT *, CASE WHEN len(l) >= 10 THEN l WHEN len(l) >= 5 THEN l[-5:] END AS x FROM a), m AS (SELECT *, list_aggregate(x, 'median') AS ref FROM s)
SELECT token, seq, round(ref, 4) AS ref, round(CASE WHEN ref IS NOT NULL THEN greatest(0.01, 3 * list_aggregate(list_transform(x, lambda v: abs(v - ref)), 'median')) END, 4) AS noise FROM m"""))
def agg29(spark: SparkSession, d: str) -> DataFrame:
    ref, noise = robust("price", "token", ("t", "seq"))
    return rounded(V.trades(spark, d).select("token", "seq", ref.alias("ref"), noise.alias("noise")), 4)


def impulse_checks(role: Column, d: Column, ref: Column, home: Column, away: Column, minute: Column) -> Column:
    """PRJ-13: of a move d (1 or -1) of a book's price from ref, in a match that stands home to away in a minute (unknown ones NULL):
    struct(gate, gate_reasons, hypothesis, favoured_side, lead_home, f_minute30, f_leader1_up).

    The gate fails, with its reasons, on a dead price, a favoured side that leads by two, or a draw that rises at a level score; it is
    unknown where that takes a score that isn't known. The hypothesis fails for a late fall of a favourite's price that leads, and
    for a rising draw at a level score."""
    lead, draw, up = home - away, role == "draw", d > 0
    side = F.when(draw, F.lit(None)).when(up, role).otherwise(F.when(role == "home", "away").otherwise("home"))
    ahead = F.when(side == "home", lead).when(side == "away", -lead)
    why = F.array_compact(F.array(F.when(~ref.between(0.05, 0.95), "dead_price"), F.when(ahead >= 2, "favoured_leads_by_2"), F.when(draw & up & (lead == 0), "draw_up_level")))
    unknown = ref.isNull() | ((~draw | up) & lead.isNull())
    gate = F.when(F.size(why) > 0, False).when(~unknown, True)
    late = F.when(minute.isNotNull(), minute < 75)
    leads = F.when(role == "home", lead > 0).otherwise(lead < 0)
    hypothesis = F.when(draw, F.when(up, lead != 0).otherwise(True)).when(up | (ref < 0.85) | F.coalesce(late, F.lit(False)), True).when(lead.isNotNull(), F.when(leads, late).otherwise(True))
    first = F.when(~draw & up, ahead == 1).otherwise(False)
    shown = {"gate": gate, "gate_reasons": why, "hypothesis": hypothesis, "favoured_side": side, "lead_home": lead, "f_minute30": minute >= 30, "f_leader1_up": first}
    return F.struct(*[x.alias(n) for n, x in shown.items()])


@query("prj13_impulse_checks", V.sql("trades", """WITH a AS (SELECT token, seq, CASE seq % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'away' ELSE 'draw' END AS role,
  CASE WHEN price > lag(price) OVER (PARTITION BY token ORDER BY t, seq) THEN 1 ELSE -1 END AS d, CAST(floor(price) AS INT) % 101 / 100.0::DOUBLE AS ref,
  CASE WHEN seq % 11 <> 0 THEN CAST(size AS INT) % 4 END AS h, CAST(size AS INT) // 4 % 3 AS w, CASE WHEN seq % 7 <> 0 THEN seq % 91 END AS minute FROM trades),
b AS (SELECT *, h - w AS lead, CASE WHEN role = 'draw' THEN NULL WHEN d > 0 THEN role WHEN role = 'home' THEN 'away' ELSE 'home' END AS side FROM a),
g AS (SELECT *, CASE side WHEN 'home' THEN lead WHEN 'away' THEN -lead END AS ahead FROM b),
r AS (SELECT *, list_filter([CASE WHEN ref < 0.05 OR ref > 0.95 THEN 'dead_price' END, CASE WHEN ahead >= 2 THEN 'favoured_leads_by_2' END,
  CASE WHEN role = 'draw' AND d > 0 AND lead = 0 THEN 'draw_up_level' END], lambda x: x IS NOT NULL) AS why FROM g)
SELECT token, seq, CASE WHEN len(why) > 0 THEN false WHEN (role = 'draw' AND d < 0) OR lead IS NOT NULL THEN true END AS gate, array_to_string(why, ',') AS reasons,
  CASE WHEN role = 'draw' AND d < 0 THEN true WHEN role = 'draw' THEN lead <> 0 WHEN d > 0 OR ref < 0.85 OR coalesce(minute < 75, false) THEN true
       WHEN lead IS NULL THEN NULL WHEN CASE role WHEN 'home' THEN lead > 0 ELSE lead < 0 END THEN minute < 75 ELSE true END AS hypothesis,
  side AS favoured_side, CAST(lead AS BIGINT) AS lead_home, minute >= 30 AS f_minute30, CASE WHEN role <> 'draw' AND d > 0 THEN ahead = 1 ELSE false END AS f_leader1_up FROM r"""))
def prj13(spark: SparkSession, d: str) -> DataFrame:
    """The checks of every trade's move against the one before it."""
    q, k = c("seq"), c("size").cast("int")
    move = F.when(c("price") > F.lag("price").over(Window.partitionBy("token").orderBy("t", "seq")), 1).otherwise(-1)
    role = F.when(q % 3 == 0, "home").when(q % 3 == 1, "away").otherwise("draw")
    x = V.trades(spark, d).select("token", "seq", role.alias("role"), move.alias("d"), (F.floor("price").cast("int") % 101 / 100).alias("ref"), F.when(q % 11 != 0, k % 4).alias("h"), (F.floor(k / 4) % 3).cast("int").alias("w"), F.when(q % 7 != 0, q % 91).alias("minute"))
    x = x.select("token", "seq", impulse_checks(c("role"), c("d"), c("ref"), c("h"), c("w"), c("minute")).alias("x")).select("token", "seq", "x.*")
    return x.withColumn("lead_home", c("lead_home").cast("long")).withColumn("reasons", F.array_join("gate_reasons", ",")).drop("gate_reasons")


def yes_price(price: Column, is_yes: Column) -> Column:
    """FN-17: a No price as its Yes price, in decimals."""
    p = price.cast("decimal(10,6)")
    return F.when(is_yes, p).otherwise(F.lit(1).cast("decimal(10,6)") - p)


def net_cents(y: Column, e: Column, fee: float = 0.07) -> Column:
    """FN-14: cents a share of an entry at e that settles at y, after a fee on e (1 - e)."""
    return (y - e - fee * e * (1 - e)) * 100


def pnl(entry: Column, exit_: Column, size: Column, cost: float = 0.0) -> Column:
    """FN-15: struct(gross, net, roi) of a position, NULL where a price is."""
    gross = (exit_ - entry) * size
    return F.struct(gross.alias("gross"), (gross - cost).alias("net"), ratio(gross - cost, entry * size).alias("roi"))


@query("fn17_price_normalise", V.sql("trades", "SELECT token, seq, CAST(CASE WHEN side = 'buy' THEN CAST(price / 500 AS DECIMAL(10,6)) ELSE 1 - CAST(price / 500 AS DECIMAL(10,6)) END AS DOUBLE) AS p_yes FROM trades"))
def fn17(spark: SparkSession, d: str) -> DataFrame:
    return V.trades(spark, d).select("token", "seq", yes_price(c("price") / 500, c("side") == "buy").cast("double").alias("p_yes"))


@query("fn14_net_after_fee", V.sql("trades", "SELECT token, seq, round((CASE WHEN side = 'buy' THEN 1 ELSE 0 END - e - 0.07 * e * (1 - e)) * 100, 6) AS net_cents FROM (SELECT *, price / 500 AS e FROM trades)"))
def fn14(spark: SparkSession, d: str) -> DataFrame:
    e = c("price") / 500
    y = F.when(c("side") == "buy", 1).otherwise(0)
    return rounded(V.trades(spark, d).select("token", "seq", net_cents(y, e).alias("net_cents")))


@query("fn15_pnl", V.sql("trades", "WITH p AS (SELECT token, seq, price, size, lead(price) OVER (PARTITION BY token ORDER BY t, seq) AS x FROM trades) SELECT token, seq, round((x - price) * size, 4) AS gross, round((x - price) * size - 0.5, 4) AS net, round(((x - price) * size - 0.5) / nullif(price * size, 0), 4) AS roi FROM p"))
def fn15(spark: SparkSession, d: str) -> DataFrame:
    x = F.lead("price").over(Window.partitionBy("token").orderBy("t", "seq"))
    p = V.trades(spark, d).select("token", "seq", "price", "size", x.alias("x"))
    return rounded(p.select("token", "seq", pnl(c("price"), c("x"), c("size"), 0.5).alias("p")).select("token", "seq", "p.*"), 4)


# Reports


def heartbeat(rows: DataFrame, every_ms: int = 900_000) -> DataFrame:
    """AGG-12: counts and sizes of either side, rows(t, side, size), in buckets of time."""
    buy = c("side") == "buy"
    size = lambda x: F.coalesce(F.sum(F.when(x, c("size"))), F.lit(0.0))
    return rows.groupBy((F.floor(c("t") / every_ms) * every_ms).alias("bucket")).agg(F.count_if(buy).alias("buys"), F.count_if(~buy).alias("sells"), size(buy).alias("buy_size"), size(~buy).alias("sell_size"))


@query("agg12_heartbeat", V.sql("trades", "SELECT t // 900000 * 900000 AS bucket, CAST(count(*) FILTER (side = 'buy') AS BIGINT) AS buys, CAST(count(*) FILTER (side = 'sell') AS BIGINT) AS sells, coalesce(sum(size) FILTER (side = 'buy'), 0) AS buy_size, coalesce(sum(size) FILTER (side = 'sell'), 0) AS sell_size FROM trades GROUP BY 1"))
def agg12(spark: SparkSession, d: str) -> DataFrame:
    return heartbeat(V.trades(spark, d))


@query("agg02_by_group", "SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total, CAST(count(*) FILTER (value > 250) AS BIGINT) AS large FROM events GROUP BY event_type")
def agg02(spark: SparkSession, d: str) -> DataFrame:
    """AGG-02/03/31: sums, counts and filtered counts of a group."""
    return rounded(V.events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.count_if(c("value") > 250).alias("large")), 4)


def elementwise_mean(rows: DataFrame, js: str) -> DataFrame:
    """AGG-04: mean and count at each position of JSON lists of numbers, NULLs left out: pos, mean, n."""
    e = rows.select(F.posexplode(F.from_json(js, "array<double>")).alias("pos", "x"))
    return e.groupBy("pos").agg(F.avg("x").alias("mean"), F.count("x").alias("n"))


@query("agg04_elementwise_mean", "WITH a AS (SELECT l_orderkey, list(CASE WHEN l_discount > 0 THEN l_quantity END ORDER BY l_linenumber, l_quantity, l_discount) AS q FROM lineitem GROUP BY 1), e AS (SELECT q[pos + 1] AS v, pos FROM (SELECT q, unnest(range(len(q))) AS pos FROM a)) SELECT CAST(pos AS INT) AS pos, round(avg(v), 4) AS mean, CAST(count(v) AS BIGINT) AS n FROM e GROUP BY pos")
def agg04(spark: SparkSession, d: str) -> DataFrame:
    li = V.table(spark, d, "lineitem")
    q = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_discount", F.when(c("l_discount") > 0, c("l_quantity")).alias("q")))).alias("a"))
    js = q.select(F.to_json(F.transform("a", lambda x: x["q"])).alias("js"))
    return rounded(elementwise_mean(js, "js"), 4)


def time_in_position(spans: DataFrame, day_ms: int = 86_400_000) -> DataFrame:
    """AGG-05: the share of each day that spans(start, stop) cover, a span that passes midnight counting for each of its days."""
    one = spans.withColumn("day", F.explode(F.sequence(F.floor(c("start") / day_ms), F.floor((c("stop") - 1) / day_ms))))
    held = F.greatest(F.lit(0), F.least(c("stop"), (c("day") + 1) * day_ms) - F.greatest(c("start"), c("day") * day_ms))
    return one.groupBy("day").agg((F.sum(held) / day_ms).alias("share"))


@query("agg05_time_in_position", V.sql("fires", "WITH s AS (SELECT t AS a, t + 7200000 AS b FROM fires WHERE value > 200), e AS (SELECT *, unnest(range(a // 86400000, (b - 1) // 86400000 + 1)) AS day FROM s) SELECT day, round(sum(least(b, (day + 1) * 86400000) - greatest(a, day * 86400000)) / 86400000.0, 6) AS share FROM e GROUP BY day"))
def agg05(spark: SparkSession, d: str) -> DataFrame:
    return rounded(time_in_position(V.fires(spark, d).where("value > 200").select(c("t").alias("start"), (c("t") + 7_200_000).alias("stop"))))


def segment_stats(rows: DataFrame, segment: str, x: str, window: str, over: float) -> DataFrame:
    """AGG-19: entries, windows, mean x and share of x over a bound, of all rows (a NULL segment) and of each segment."""
    win = F.when(c(x) > over, 1.0).otherwise(0.0)
    return rows.groupingSets([[], [segment]], segment).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(window).alias("windows"), F.avg(x).alias("mean_entry"), F.avg(win).alias("win_rate"))


@query("agg19_grouping_sets", V.sql("fires", "SELECT token % 2 AS gap, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT t // 86400000) AS BIGINT) AS windows, round(avg(value), 4) AS mean_entry, round(avg(CASE WHEN value > 100 THEN 1.0 ELSE 0 END), 4) AS win_rate FROM fires GROUP BY GROUPING SETS ((), (token % 2))"))
def agg19(spark: SparkSession, d: str) -> DataFrame:
    f = V.fires(spark, d).select((c("token") % 2).alias("gap"), "value", F.floor(c("t") / 86_400_000).alias("w"))
    return rounded(segment_stats(f, "gap", "value", "w", 100.0), 4)


def cluster_t(rows: DataFrame, x: str, cluster: Column) -> DataFrame:
    """AGG-20: a mean with its error by clusters, in two levels: sums and counts of a cluster, then all."""
    g = rows.groupBy(cluster.alias("w")).agg(F.sum(x).alias("s"), F.count(F.lit(1)).alias("n"))
    a = g.agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum(c("s") * c("s")).alias("ss"), F.sum(c("s") * c("n")).alias("sn"), F.sum(c("n") * c("n")).alias("nn"))
    mu = c("s") / c("n")
    se = F.sqrt(c("ss") - 2 * mu * c("sn") + mu * mu * c("nn")) / c("n")
    return a.select(mu.alias("mean"), se.alias("se"), (mu / se).alias("t"))


@query("agg20_cluster_t", V.sql("fires", "WITH m AS (SELECT avg(value) AS mu, count(*) AS n FROM fires), w AS (SELECT sum(value - mu) AS s FROM fires, m GROUP BY t // 86400000) SELECT round(any_value(mu), 4) AS mean, round(sqrt(sum(s * s)) / any_value(n), 4) AS se, round(any_value(mu) / (sqrt(sum(s * s)) / any_value(n)), 4) AS t FROM w, m"))
def agg20(spark: SparkSession, d: str) -> DataFrame:
    return rounded(cluster_t(V.fires(spark, d), "value", F.floor(c("t") / 86_400_000)), 4)


def winners(rows: DataFrame, keys: list[str], side: str, x: str, least: float) -> DataFrame:
    """AGG-30: of each group the side of the greatest x (of equal ones the last in order), and whether that reaches `least`."""
    return rows.groupBy(*keys).agg(F.max_by(side, F.struct(x, side)).alias("winner"), (F.max(x) >= least).alias("resolved"))


@query("agg30_winner", V.sql("trades", "SELECT token, t // 86400000 AS day, arg_max(side, (p, side)) AS winner, max(p) >= 6000 AS resolved FROM (SELECT token, t // 86400000 * 86400000 AS t, side, sum(price) AS p FROM trades GROUP BY ALL) GROUP BY ALL"))
def agg30(spark: SparkSession, d: str) -> DataFrame:
    day = F.floor(c("t") / 86_400_000).alias("day")
    s = V.trades(spark, d).groupBy("token", day, "side").agg(F.sum("price").alias("p"))
    return winners(s, ["token", "day"], "side", "p", 6000.0)


@query("agg32_next_id", "SELECT o_orderstatus, CAST(max(o_orderkey) + 1 AS BIGINT) AS next_id FROM orders GROUP BY 1")
def agg32(spark: SparkSession, d: str) -> DataFrame:
    return V.table(spark, d, "orders").groupBy("o_orderstatus").agg((F.max("o_orderkey") + 1).alias("next_id"))


def valid_stats(rows: DataFrame, keys: list[str], x: str) -> DataFrame:
    """AGG-14: least, greatest, mean and number of the values of a group that are there and over 0: keys, lo, hi, mean, n."""
    v = F.when(c(x) > 0, c(x))
    return rows.groupBy(*keys).agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), F.count(v).alias("n"))


@query("agg14_ask_stats", "SELECT user_id, round(min(value) FILTER (value > 0), 4) AS lo, round(max(value) FILTER (value > 0), 4) AS hi, round(avg(value) FILTER (value > 0), 4) AS mean, CAST(count(*) FILTER (value > 0) AS BIGINT) AS n FROM events GROUP BY user_id")
def agg14(spark: SparkSession, d: str) -> DataFrame:
    return rounded(valid_stats(V.events(spark, d), ["user_id"], "value"), 4)


@query("fn30_messages", V.sql("fires", "SELECT token, seq, printf('token %d: %.2f at %d', token, value, t) AS message FROM fires"))
def fn30(spark: SparkSession, d: str) -> DataFrame:
    return V.fires(spark, d).select("token", "seq", F.format_string("token %d: %.2f at %d", "token", "value", "t").alias("message"))


# Change logs and resolution


def changes(rows: DataFrame, value: str, key: str = "token", order: tuple[str, ...] = ("t", "seq")) -> DataFrame:
    """WIN-24: rows whose value differs from the one before it, the first one included; NULL is a value."""
    p = F.lag(F.struct(value)).over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_p", p).where(c("_p").isNull() | ~c(value).eqNullSafe(c(f"_p.{value}"))).drop("_p")


def high_water(rows: DataFrame, value: str, order: str, key: str = "token") -> DataFrame:
    """WIN-26: rows with `stale`: whether the value is under the greatest one before it in order; NULL for the first."""
    high = F.max(value).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("stale", c(value) < high)


def last_values(rows: DataFrame, value: str, key: str = "token", order: tuple[str, ...] = ("t", "seq")) -> DataFrame:
    """WIN-28: each key's last value."""
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


@query("win24_changes", V.sql("mids", "WITH m AS (SELECT token, t, seq, CAST(floor(mid / 100) AS BIGINT) AS level, lag(CAST(floor(mid / 100) AS BIGINT)) OVER (PARTITION BY token ORDER BY t, seq) AS p FROM mids) SELECT token, t, seq, level FROM m WHERE level IS DISTINCT FROM p"))
def win24(spark: SparkSession, d: str) -> DataFrame:
    m = V.mids(spark, d).withColumn("level", F.floor(c("mid") / 100))
    return changes(m, "level").select("token", "t", "seq", "level")


CDC = """WITH p AS (SELECT o_custkey % 20 AS grp, CAST(o_orderdate AS DATE) - DATE '1992-01-01' AS d, o_custkey AS k, max(o_totalprice) AS v FROM orders GROUP BY ALL),
polls AS (SELECT grp, d, row_number() OVER (PARTITION BY grp ORDER BY d) AS i FROM (SELECT DISTINCT grp, d FROM p)), x AS (SELECT p.grp, i, k, v FROM p JOIN polls USING (grp, d)),
l AS (SELECT *, lag(i) OVER w AS pi, lag(v) OVER w AS pv, lead(i) OVER w AS ni FROM x WINDOW w AS (PARTITION BY grp, k ORDER BY i)), n AS (SELECT grp, max(i) AS m FROM polls GROUP BY grp)"""


def change_log(rows: DataFrame, key: str, poll: str, k: str, v: str) -> DataFrame:
    """WIN-25, SET-04: of rows(key, poll, k, v), the entries k that each poll of a key found and their values, what changed from poll to
    poll: key, i (the poll's number), k, kind - new, changed or gone. One that comes back counts as changed."""
    polls = rows.select(key, poll).distinct().withColumn("i", F.row_number().over(Window.partitionBy(key).orderBy(poll)))
    w = Window.partitionBy(key, k).orderBy("i")
    x = rows.join(polls, [key, poll]).select(key, "i", k, v, F.lag("i").over(w).alias("_pi"), F.lag(v).over(w).alias("_pv"), F.lead("i").over(w).alias("_ni"))
    ends = polls.groupBy(key).agg(F.max("i").alias("_m"))
    here = F.when(c("_pi").isNull(), "new").when((c("_pi") < c("i") - 1) | ~c(v).eqNullSafe(c("_pv")), "changed")
    gone = F.when((c("i") < c("_m")) & (c("_ni").isNull() | (c("_ni") > c("i") + 1)), "gone")
    log = x.join(ends, key).select(key, k, F.explode(F.array(F.struct(c("i").alias("i"), here.alias("kind")), F.struct((c("i") + 1).alias("i"), gone.alias("kind")))).alias("e"))
    return log.select(key, "e.i", k, "e.kind").where("kind IS NOT NULL")


@query("win25_change_log", f"{CDC} SELECT grp, CAST(i AS INT) AS i, k, 'new' AS kind FROM l WHERE pi IS NULL UNION ALL SELECT grp, CAST(i AS INT), k, 'changed' FROM l WHERE pi IS NOT NULL AND (pi < i - 1 OR v IS DISTINCT FROM pv) UNION ALL SELECT grp, CAST(i + 1 AS INT), k, 'gone' FROM l JOIN n USING (grp) WHERE i < m AND (ni IS NULL OR ni > i + 1)")
def win25(spark: SparkSession, d: str) -> DataFrame:
    """Customers' greatest order of a day, in twenty groups, each day a poll."""
    o = V.table(spark, d, "orders")
    p = o.groupBy((c("o_custkey") % 20).alias("grp"), F.to_date("o_orderdate").alias("d"), c("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("v"))
    return change_log(p, "grp", "d", "k", "v")


@query("win26_high_water", V.sql("mids", "SELECT token, seq, t < max(t) OVER (PARTITION BY token ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stale FROM (SELECT token, seq, t - CASE WHEN seq % 13 = 0 THEN 90000000 ELSE 0 END AS t FROM mids)"))
def win26(spark: SparkSession, d: str) -> DataFrame:
    m = V.mids(spark, d).withColumn("t", c("t") - F.when(c("seq") % 13 == 0, 90_000_000).otherwise(0))
    return high_water(m, "t", "seq").select("token", "seq", "stale")


@query("win28_last_value", V.sql("mids", "SELECT token, arg_max(mid, (t, seq)) AS final_mid FROM mids GROUP BY token"))
def win28(spark: SparkSession, d: str) -> DataFrame:
    return last_values(V.mids(spark, d), "mid").withColumnRenamed("mid", "final_mid")


def resolved_entities(matches: DataFrame, feed: DataFrame, within_ms: int = 3 * HOUR, close_ms: int = 30 * 60_000) -> DataFrame:
    """JN-17, SRT-06: each match(slug, home, away, kickoff_ms; team ids) with the feed event(id, home, away, start_ms) of the
    same two teams, in either order, that starts nearest to its kickoff, at most within_ms away.

    Gives slug, status, id, swapped, delta_ms. status: team_not_whitelisted where an id is NULL, team_identity_conflict where
    both are one, missing, ambiguous where the runner-up is at most close_ms farther off than the nearest, else matched.
    Of the feed's events only distinct times of a pair are kept, each with its first id, whether it has others, and the times beside
    it; a match sees the last one up to its kickoff and the first one after it, in one order of both by pair and bucket of within_ms
    (a feed's time goes to the buckets beside its own too). So no match is joined with all events near to it.
    """
    pair = (F.least("home", "away").alias("lo"), F.greatest("home", "away").alias("hi"))
    own = F.floor(c("_t") / within_ms)
    near = lambda x: F.when(x <= within_ms, x)
    times = feed.where("home <> away AND start_ms IS NOT NULL").groupBy(*pair, c("start_ms").alias("_t")).agg(F.min(F.struct("id", c("home").alias("ehome"))).alias("e"), F.max("id").alias("last"))
    times = times.withColumn("_b", F.explode(F.array(own - 1, own, own + 1)))
    w = Window.partitionBy("lo", "hi", "_b")
    beside = w.orderBy("_t")
    event = F.struct("_t", "e.id", "e.ehome", (c("e.id") != c("last")).alias("more"), F.lag("_t").over(beside).alias("before"), F.lead("_t").over(beside).alias("after"))
    have = times.select("lo", "hi", "_b", "_t", F.lit(0).alias("_side"), event.alias("_e"))
    m = matches.select("slug", "home", "away", "kickoff_ms")
    want = m.where("home <> away").select(*pair, c("kickoff_ms").alias("_t"), F.lit(1).alias("_side"), "slug", "home").withColumn("_b", own)
    seen = have.unionByName(want, allowMissingColumns=True)
    seen = seen.withColumn("past", F.last("_e", True).over(w.orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)))
    seen = seen.withColumn("next", F.last("_e", True).over(w.orderBy(F.desc("_t"), F.desc("_side")).rowsBetween(Window.unboundedPreceding, 0))).where("_side = 1")
    x = seen.withColumns({"back": near(c("_t") - c("past._t")), "ahead": near(c("next._t") - c("_t"))}).withColumn("delta_ms", F.least("back", "ahead"))
    earlier = holds((c("back") < c("ahead")) | ((c("back") == c("ahead")) & (c("past.id") < c("next.id"))) | c("ahead").isNull())
    one = F.when(earlier, c("past")).otherwise(c("next"))
    x = x.withColumns({"one": one, "other": F.when(earlier, F.least("ahead", near(c("_t") - c("past.before")))).otherwise(F.least("back", near(c("next.after") - c("_t"))))})
    close = holds(F.when(c("one.more"), c("delta_ms")).otherwise(c("other")) - c("delta_ms") <= close_ms)
    known = x.select("slug", F.when(c("delta_ms").isNull(), "missing").when(close, "ambiguous").otherwise("matched").alias("status"), "one", "home", "delta_ms")
    only = lambda x: F.when(c("status") == "matched", x)
    found = known.select("slug", "status", only(c("one.id")).alias("id"), only(c("one.ehome") != c("home")).alias("swapped"), only(c("delta_ms")).alias("delta_ms"))
    rest = m.where("home IS NULL OR away IS NULL OR home = away").select("slug", F.when(c("home").isNull() | c("away").isNull(), "team_not_whitelisted").otherwise("team_identity_conflict").alias("status"))
    return found.unionByName(rest, allowMissingColumns=True)


MATCHES = """m AS (SELECT o_orderkey AS slug, CASE WHEN o_custkey % 10 < 9 THEN o_custkey % 10 END AS home, (o_custkey // 10) % 10 AS away, epoch_ms(o_orderdate) + (o_orderkey % 300) * 60000 AS kickoff_ms FROM orders),
f AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey % 10 ELSE (o_custkey // 10) % 10 END AS home, CASE WHEN o_orderkey % 2 = 0 THEN (o_custkey // 10) % 10 ELSE o_custkey % 10 END AS away, epoch_ms(o_orderdate) + (o_orderkey % 7) * 5400000 AS start_ms FROM orders)"""


def fixtures(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as matches, and as a feed that knows half of them with the sides swapped and other times."""
    o = V.table(spark, d, "orders").withColumn("ts", c("o_orderdate").cast("timestamp_ntz"))
    k, a, b = c("o_orderkey"), c("o_custkey") % 10, F.floor(c("o_custkey") / 10) % 10
    day = V.epoch("ts") * 1000
    matches = o.select(k.alias("slug"), F.when(a < 9, a).alias("home"), b.alias("away"), (day + k % 300 * 60_000).alias("kickoff_ms"))
    feed = o.select(k.alias("id"), F.when(k % 2 == 0, a).otherwise(b).alias("home"), F.when(k % 2 == 0, b).otherwise(a).alias("away"), (day + k % 7 * 5_400_000).alias("start_ms"))
    return matches, feed


@query("jn17_nearest_entity", f"""WITH {MATCHES}, n AS (SELECT m.slug, f.id, f.home <> m.home AS swapped, abs(f.start_ms - m.kickoff_ms) AS delta FROM m JOIN f ON m.home <> m.away AND ((f.home = m.home AND f.away = m.away) OR (f.home = m.away AND f.away = m.home)) AND abs(f.start_ms - m.kickoff_ms) <= 10800000),
r AS (SELECT *, row_number() OVER w AS k, lead(delta) OVER w AS nxt FROM n WINDOW w AS (PARTITION BY slug ORDER BY delta, id)),
s AS (SELECT m.slug, CASE WHEN home IS NULL OR away IS NULL THEN 'team_not_whitelisted' WHEN home = away THEN 'team_identity_conflict' WHEN id IS NULL THEN 'missing' WHEN coalesce(nxt - delta <= 1800000, false) THEN 'ambiguous' ELSE 'matched' END AS status, id, swapped, delta FROM m LEFT JOIN r ON r.slug = m.slug AND r.k = 1)
SELECT slug, status, CASE WHEN status = 'matched' THEN id END AS id, CASE WHEN status = 'matched' THEN swapped END AS swapped, CASE WHEN status = 'matched' THEN delta END AS delta_ms FROM s""")
def jn17(spark: SparkSession, d: str) -> DataFrame:
    return resolved_entities(*fixtures(spark, d))


def named_entities(games: DataFrame, feed: DataFrame, alias: dict[str, str] | None = None) -> DataFrame:
    """JN-18: each game(slug, a, b; names) with the one feed event(id, home, away) of the same two names, an alias counting as
    the name that it stands for. Gives slug, status (missing, ambiguous, matched), id, a_home (whether a is at home)."""
    name = lambda x: F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in alias.items() for v in kv]), x), x) if alias else x
    key = lambda x, y: F.array_sort(F.array_distinct(F.array(x, y)))
    ev = feed.select(key(c("home"), c("away")).alias("k"), "id", "home").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("id", "home"), "id").alias("e"))
    j = games.withColumn("k", key(name(c("a")), name(c("b")))).join(ev, "k", "left")
    status = F.when(c("n").isNull(), "missing").when(c("n") > 1, "ambiguous").otherwise("matched")
    return j.select("slug", status.alias("status"), F.when(c("n") == 1, c("e.id")).alias("id"), F.when(c("n") == 1, c("e.home") == name(c("a"))).alias("a_home"))


@query("jn18_set_equality", """WITH g AS (SELECT o_orderkey AS slug, CASE WHEN o_custkey % 400 = 7 THEN 'Sevens' ELSE 'T' || (o_custkey % 400) END AS a,
  'T' || (o_orderkey % 400) AS b FROM orders),
e AS (SELECT min(l_orderkey * 10 + l_linenumber) AS id, 'T' || (l_suppkey % 400) AS home, 'T' || (l_partkey % 400) AS away FROM lineitem GROUP BY l_suppkey, l_partkey),
n AS (SELECT list_sort(list_distinct([home, away])) AS k, count(*) AS n, min(id) AS id, arg_min(home, id) AS home FROM e GROUP BY 1),
x AS (SELECT slug, CASE WHEN a = 'Sevens' THEN 'T7' ELSE a END AS a, b FROM g)
SELECT slug, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS status, CASE WHEN n = 1 THEN id END AS id,
  CASE WHEN n = 1 THEN home = a END AS a_home FROM x LEFT JOIN n ON n.k = list_sort(list_distinct([a, b]))""")
def jn18(spark: SparkSession, d: str) -> DataFrame:
    """Orders' two teams against a feed of an event for each supplier and part of lineitem."""
    team = lambda x: F.concat(F.lit("T"), (x % 400).cast("string"))
    a = team(c("o_custkey"))
    games = V.table(spark, d, "orders").select(c("o_orderkey").alias("slug"), F.when(a == "T7", "Sevens").otherwise(a).alias("a"), team(c("o_orderkey")).alias("b"))
    once = V.table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.min(c("l_orderkey") * 10 + c("l_linenumber")).alias("id"))
    return named_entities(games, once.select("id", team(c("l_suppkey")).alias("home"), team(c("l_partkey")).alias("away")), {"Sevens": "T7"})


def routed(rows: DataFrame, routes: DataFrame, id_col: str, keys: list[Column]) -> DataFrame:
    """JN-15/16: the slugs of rows by any of several keys, routes(key, slug): exploded to one key each, joined, made distinct."""
    each = rows.select(id_col, F.explode(F.array(*keys)).alias("key"))
    return each.join(routes, "key").select(id_col, "slug").distinct()


@query("jn16_routing", "WITH k AS (SELECT DISTINCT user_id % 50 AS key, 'u' || CAST(user_id % 10 AS VARCHAR) AS slug FROM events) SELECT e.event_id, k.slug FROM events e JOIN k ON k.key = e.user_id UNION SELECT e.event_id, k.slug FROM events e JOIN k ON k.key = e.event_id % 50")
def jn16(spark: SparkSession, d: str) -> DataFrame:
    e = V.events(spark, d)
    routes = e.select((c("user_id") % 50).alias("key"), F.concat(F.lit("u"), (c("user_id") % 10).cast("string")).alias("slug")).distinct()
    return routed(e, routes, "event_id", [c("user_id"), c("event_id") % 50])


def children(parents: DataFrame, rows: DataFrame, key: str, foreign: str) -> DataFrame:
    """JN-02: the distinct rows whose foreign key names a parent, with the parent's columns; rows without one go."""
    return parents.join(rows, parents[key] == rows[foreign]).drop(foreign).distinct()


@query("jn02_star", "SELECT DISTINCT o_orderkey, o_orderpriority, l_suppkey, l_returnflag FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'O'")
def jn02(spark: SparkSession, d: str) -> DataFrame:
    """The children of parents that a filter leaves: orders that are not open, as captures that are done."""
    o = V.table(spark, d, "orders").where("o_orderstatus <> 'O'").select("o_orderkey", "o_orderpriority")
    return children(o, V.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag"), "o_orderkey", "l_orderkey")


@query("jn03_semi", "SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_discount > 0.09)")
def jn03(spark: SparkSession, d: str) -> DataFrame:
    """JN-03/04."""
    li = V.table(spark, d, "lineitem").where("l_discount > 0.09")
    o = V.table(spark, d, "orders")
    return o.join(li, o["o_orderkey"] == li["l_orderkey"], "left_semi").select("o_orderkey")


@query("jn21_row_diff", V.sql("mids", "WITH a AS (SELECT token, mid, row_number() OVER (PARTITION BY token ORDER BY t, seq) AS i FROM mids), b AS (SELECT token, CASE WHEN i % 17 = 0 THEN mid + 1 ELSE mid END AS mid, i FROM a WHERE i % 101 <> 0) SELECT a.token, CAST(count(*) FILTER (b.i IS NULL) AS BIGINT) AS missing, CAST(count(*) FILTER (b.i IS NOT NULL AND a.mid IS DISTINCT FROM b.mid) AS BIGINT) AS different FROM a LEFT JOIN b USING (token, i) GROUP BY a.token"))
def jn21(spark: SparkSession, d: str) -> DataFrame:
    """JN-21: two runs' rows compared by position."""
    a = V.mids(spark, d).select("token", "mid", F.row_number().over(Window.partitionBy("token").orderBy("t", "seq")).alias("i"))
    b = a.where("i % 101 <> 0").select("token", "i", F.when(c("i") % 17 == 0, c("mid") + 1).otherwise(c("mid")).alias("other"), F.lit(1).alias("there"))
    j = a.join(b, ["token", "i"], "left")
    return j.groupBy("token").agg(F.count_if(c("there").isNull()).alias("missing"), F.count_if(c("there").isNotNull() & ~c("mid").eqNullSafe(c("other"))).alias("different"))


def ruled(rows: DataFrame, rules: DataFrame, key: str, value: str) -> DataFrame:
    """PRJ-10: rows under a table of rules(key, op gt or lt, thr, target), a row for each rule that holds. The table is small and
    broadcast if Spark's size check allows it."""
    hit = F.when(c("op") == "gt", c(value) > c("thr")).otherwise(c(value) < c("thr"))
    return rows.join(rules, key).where(hit)


@query("prj10_rule_table", "SELECT e.event_id, r.target FROM events e JOIN (VALUES ('click', 'gt', 400.0, 'up'), ('click', 'lt', 50.0, 'down'), ('view', 'gt', 450.0, 'up')) r(kind, op, thr, target) ON r.kind = e.event_type AND CASE r.op WHEN 'gt' THEN e.value > r.thr ELSE e.value < r.thr END")
def prj10(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES ('click', 'gt', 400.0D, 'up'), ('click', 'lt', 50.0D, 'down'), ('view', 'gt', 450.0D, 'up') AS r(event_type, op, thr, target)")
    return ruled(V.events(spark, d), rules, "event_type", "value").select("event_id", "target")


def in_discovery(kickoff_ms: Column, at_ms: Column, back_ms: int = 4 * HOUR, ahead_ms: int = 7 * 24 * HOUR) -> Column:
    """PRJ-16: whether a match is near enough to be watched."""
    return kickoff_ms.between(at_ms - back_ms, at_ms + ahead_ms)


def collection_end(kickoff_ms: Column, expired_ms: Column, full_time_ms: Column, all_closed_ms: Column, any_closed: Column, score_ms: Column, back_ms: int = 4 * HOUR) -> Column:
    """PRJ-16: struct(end_ms, reason) of a match's collection, NULL while it is still awaited: expired before, at the later
    of its close and half an hour after full time, or four hours after a kickoff that left no score, full time or close."""
    of = lambda ms, why: F.struct(ms.cast("long").alias("end_ms"), F.lit(why).alias("reason"))
    nothing = score_ms.isNull() & full_time_ms.isNull() & all_closed_ms.isNull() & ~holds(any_closed)
    return F.when(expired_ms.isNotNull(), of(expired_ms, "no_feed_or_close")).when(full_time_ms.isNotNull() & all_closed_ms.isNotNull(), of(F.greatest(all_closed_ms, full_time_ms + 30 * 60_000), "finished_and_closed")).when(nothing, of(kickoff_ms + back_ms, "no_feed_or_close"))


@query("prj16_lifecycle", """WITH m AS (SELECT o_orderkey, epoch_ms(o_orderdate) AS k, o_orderkey % 11 = 0 AS x, o_orderstatus = 'F' AS f, o_orderkey % 3 = 0 AS z, o_orderkey % 5 = 0 AS any_closed, o_orderkey % 2 = 0 AS s FROM orders)
SELECT o_orderkey, CASE WHEN x THEN k + 1 WHEN f AND z THEN greatest(k + 7000000 + (o_orderkey % 4) * 1000000, k + 6600000 + 1800000) WHEN NOT s AND NOT f AND NOT z AND NOT any_closed THEN k + 14400000 END AS end_ms,
CASE WHEN x THEN 'no_feed_or_close' WHEN f AND z THEN 'finished_and_closed' WHEN NOT s AND NOT f AND NOT z AND NOT any_closed THEN 'no_feed_or_close' END AS reason, k BETWEEN 820454400000 - 14400000 AND 820454400000 + 604800000 AS watched FROM m""")
def prj16(spark: SparkSession, d: str) -> DataFrame:
    o = V.table(spark, d, "orders").withColumn("ts", c("o_orderdate").cast("timestamp_ntz"))
    key, k = c("o_orderkey"), V.epoch("ts") * 1000
    when = lambda x, y: F.when(x, y)
    end = collection_end(k, when(key % 11 == 0, k + 1), when(c("o_orderstatus") == "F", k + 6_600_000), when(key % 3 == 0, k + 7_000_000 + key % 4 * 1_000_000), key % 5 == 0, when(key % 2 == 0, k))
    return o.select(key, end.alias("e"), in_discovery(k, F.lit(820_454_400_000)).alias("watched")).select("o_orderkey", "e.end_ms", "e.reason", "watched")


def stride_sample(rows: DataFrame, most: int = 5, key: str = "token", order: tuple[str, ...] = ("t", "seq")) -> DataFrame:
    """SRT-07: at most `most` evenly spaced rows of each key, and the last."""
    w = Window.partitionBy(key)
    m = rows.withColumns({"_i": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count(F.lit(1)).over(w)})
    step = F.greatest(F.lit(1), F.floor(c("_n") / most))
    return m.where(((c("_i") % step == 0) & (F.floor(c("_i") / step) < most)) | (c("_i") == c("_n") - 1)).drop("_i", "_n")


@query("srt07_stride_sample", V.sql("mids", "WITH m AS (SELECT token, t, seq, row_number() OVER (PARTITION BY token ORDER BY t, seq) - 1 AS i, count(*) OVER (PARTITION BY token) AS n FROM mids) SELECT token, t, seq FROM m WHERE (i % greatest(1, n // 5) = 0 AND i // greatest(1, n // 5) < 5) OR i = n - 1"))
def srt07(spark: SparkSession, d: str) -> DataFrame:
    return stride_sample(V.mids(spark, d)).select("token", "t", "seq")


@query("fn25_slugs", "SELECT page_id, regexp_extract(url, 'https?://([^/]+)', 1) AS host, regexp_matches(url, '/[a-z]{2}/[0-9]+') AS valid, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) AS number FROM pages")
def fn25(spark: SparkSession, d: str) -> DataFrame:
    """FN-25: parts of a slug by pattern, and whether it is well formed."""
    u = c("url")
    return V.table(spark, d, "pages").select("page_id", F.regexp_extract(u, "https?://([^/]+)", 1).alias("host"), u.rlike("/[a-z]{2}/[0-9]+").alias("valid"), F.regexp_extract(u, "/([a-z]{2})/([0-9]+)", 2).alias("number"))


@query("fn26_json_coercion", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, CAST(json_extract('[' || props || ']', '$[0].k') AS INT) AS k_array FROM events")
def fn26(spark: SparkSession, d: str) -> DataFrame:
    """FN-26, SRC-13: a JSON object, or an array of them, as rows."""
    kind = "array<struct<k:int>>"
    return V.events(spark, d).select("event_id", F.from_json("props", "k int")["k"].alias("k"), F.from_json(F.concat(F.lit("["), c("props"), F.lit("]")), kind)[0]["k"].alias("k_array"))


def digest(*columns: Column) -> Column:
    """FN-32: SHA-256 of the columns as one canonical JSON object."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def utc_day(ts: Column) -> Column:
    """FN-29: the day in UTC."""
    return F.date_format(ts, "yyyy-MM-dd")


def us_date(ts: Column) -> Column:
    """FN-29: the date of a US evening, six hours behind UTC."""
    return F.date_format(ts - F.expr("INTERVAL 6 HOURS"), "yyyyMMdd")


@query("fn32_digest", "SELECT o_orderkey, sha256('{\"id\":' || o_orderkey || ',\"status\":\"' || o_orderstatus || '\"}') AS digest FROM orders")
def fn32(spark: SparkSession, d: str) -> DataFrame:
    """FN-32, SNK-12: digest of canonical JSON."""
    return V.table(spark, d, "orders").select("o_orderkey", digest(c("o_orderkey").alias("id"), c("o_orderstatus").alias("status")).alias("digest"))


@query("fn29_day_keys", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts - INTERVAL 6 HOUR, '%Y%m%d') AS us_day FROM events")
def fn29(spark: SparkSession, d: str) -> DataFrame:
    return V.events(spark, d).select("event_id", utc_day(c("ts")).alias("day"), us_date(c("ts")).alias("us_day"))


@query("fn20_time_units", "SELECT event_id, CASE WHEN x > 1e15 THEN x // 1000 WHEN x < 1e11 THEN x * 1000 ELSE x END AS ms FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) // 1000000 END AS x FROM events)")
def fn20(spark: SparkSession, d: str) -> DataFrame:
    """FN-20: seconds, milliseconds or microseconds, told by size, as milliseconds."""
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    x = F.when(c("event_id") % 3 == 0, us).when(c("event_id") % 3 == 1, F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")).otherwise(V.epoch("ts"))
    e = V.events(spark, d).withColumn("x", x)
    return e.select("event_id", millis_of(c("x")).alias("ms"))


@query("snk06_widening_window", V.sql("fires", "SELECT token, t // 86400000 AS epoch, min(t - 60000) AS t_back, max(t + 120000) AS t_fwd FROM fires GROUP BY ALL"))
def snk06(spark: SparkSession, d: str) -> DataFrame:
    return V.fires(spark, d).groupBy("token", F.floor(c("t") / 86_400_000).alias("epoch")).agg(F.min(c("t") - 60_000).alias("t_back"), F.max(c("t") + 120_000).alias("t_fwd"))


@query("snk05_first_writer", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def snk05(spark: SparkSession, d: str) -> DataFrame:
    """SNK-05: of rows with the same key the first stays."""
    return V.events(spark, d).groupBy("user_id").agg(F.min_by("event_id", "event_id").alias("event_id"))


@query("snk04_late_update", "SELECT o_orderkey, coalesce(u.p, o_totalprice) AS price FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS p FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) u ON u.l_orderkey = o.o_orderkey")
def snk04(spark: SparkSession, d: str) -> DataFrame:
    """SNK-04: results completed by later rows, by key."""
    u = V.table(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("p"))
    return V.table(spark, d, "orders").join(u, "o_orderkey", "left").select("o_orderkey", F.coalesce("p", "o_totalprice").alias("price"))


def sequence_check(rows: DataFrame, scope: list[str], seq: str = "seq", at: str = "t") -> DataFrame:
    """PIPE-10: of each scope whether its sequence numbers follow each other by one in order of arrival, the breaks, the first
    and last number, and the largest wait between rows."""
    w = Window.partitionBy(*scope).orderBy(at, seq)
    x = rows.withColumns({"_p": F.lag(seq).over(w), "_w": c(at) - F.lag(at).over(w)})
    broken = F.count_if(c("_p") + 1 != c(seq))
    return x.groupBy(*scope).agg(F.count(F.lit(1)).alias("n"), broken.alias("breaks"), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), F.max("_w").alias("largest_wait"), (broken == 0).alias("in_sequence"))


@query("pipe10_sequence_check", V.sql("mids fires", """WITH n AS (SELECT token, t, row_number() OVER (PARTITION BY token ORDER BY t, seq) + CASE WHEN token % 2 = 0 AND seq % 97 = 0 THEN 1 ELSE 0 END AS q FROM mids WHERE token IN (SELECT token FROM fires)),
l AS (SELECT *, lag(q) OVER w AS p, t - lag(t) OVER w AS wait FROM n WINDOW w AS (PARTITION BY token ORDER BY t, q))
SELECT token, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (p + 1 <> q) AS BIGINT) AS breaks, min(q) AS first_seq, max(q) AS last_seq, max(wait) AS largest_wait, count(*) FILTER (p + 1 <> q) = 0 AS in_sequence FROM l GROUP BY token"""))
def pipe10(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("token").orderBy("t", "seq")) + F.when((c("token") % 2 == 0) & (c("seq") % 97 == 0), 1).otherwise(0)
    scope = V.fires(spark, d).select("token").distinct()  # the tokens that are relayed
    frames = V.mids(spark, d).join(scope, "token", "left_semi")
    return sequence_check(frames.select("token", "t", n.cast("long").alias("q")), ["token"], "q")
