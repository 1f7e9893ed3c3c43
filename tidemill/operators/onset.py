"""Onset detectors and greedy state machines: per-second grids, rising edges, cooldowns, throttles, single-slot positions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.clean import holds, ratio, rounded
from tidemill.functions.folds import fold, kept_apart
from tidemill.operators import rules as R
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col
HOUR = 3_600_000


def spaced(events: DataFrame, gap: int, key: list[str], on: str = "t", seq: str = "seq") -> DataFrame:
    """STR-05/06: greedily keeps events at least gap after the last one kept, by key. An ordered fold whose state is one time."""
    rows = events.select(*key, on, seq)

    def step(pdf: pd.DataFrame, last: int | None) -> tuple[pd.DataFrame, int | None]:
        keep, last = kept_apart(pdf[on].to_numpy(), gap, last)
        return pdf.iloc[keep], last

    return fold(rows, key, [on, seq], step, rows.schema)


def rising(df: DataFrame, value: str, threshold: float, key: str = "token", order: tuple[str, ...] = ("t", "seq")) -> DataFrame:
    """WIN-22: rows whose value reaches the threshold while the last known value before was under it (unknown values carry)."""
    before = F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_b", before).where(holds(c(value) >= threshold) & holds(F.coalesce(c("_b"), F.lit(float("-inf"))) < threshold)).drop("_b")


def grid(trades: DataFrame, step_ms: int) -> DataFrame:
    """WIN-18, STR-01/22: a dense grid per token and day of the step's VWAP, filled forward within the day, and its age in steps."""
    day = F.floor(c("t") / 86_400_000)
    per = trades.groupBy("token", day.alias("day"), F.floor(F.pmod(c("t"), F.lit(86_400_000)) / step_ms).alias("k")).agg(ratio(F.sum(c("price") * c("size")), F.sum("size")).alias("p"))
    dense = per.select("token", "day").distinct().withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(86_400_000 // step_ms - 1).cast("bigint"))))
    w = Window.partitionBy("token", "day").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    x = dense.join(per, ["token", "day", "k"], "left")
    return x.select("token", "day", "k", F.last("p", True).over(w).alias("p"), (c("k") - F.max(F.when(c("p").isNotNull(), c("k"))).over(w)).alias("age"))


STEP = 900_000
GRID = f"""WITH per AS (SELECT token, t // 86400000 AS day, (t % 86400000) // {STEP} AS k, sum(price * size) / sum(size) AS p FROM trades GROUP BY ALL),
dense AS (SELECT token, day, unnest(range(0, {86_400_000 // STEP})) AS k FROM (SELECT DISTINCT token, day FROM per)),
grid AS (SELECT d.token, d.day, d.k, last_value(p IGNORE NULLS) OVER w AS p, d.k - max(CASE WHEN p IS NOT NULL THEN d.k END) OVER w AS age FROM dense d LEFT JOIN per USING (token, day, k) WINDOW w AS (PARTITION BY d.token, d.day ORDER BY d.k ROWS UNBOUNDED PRECEDING))"""


def by_day():
    return Window.partitionBy("token", "day").orderBy("k")


def _grid(spark: SparkSession, d: str) -> DataFrame:
    return grid(V.trades(spark, d), STEP)


@query("win18_vwap_grid", V.sql("trades", f"{GRID} SELECT token, day, k, round(p, 4) AS p, age FROM grid"))
def win18(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_grid(spark, d), 4)


def trail_ratio(n: int) -> Column:
    """WIN-19: price over its mean of the last n steps, where n steps ago there was a fresh one."""
    fresh = F.lag("age", n).over(by_day()) <= n
    w = by_day().rowsBetween(-(n - 1), 0)
    return F.when(holds(fresh) & (F.count("p").over(w) == n), ratio(c("p"), F.avg("p").over(w)))


def consistent_ratio(steps: tuple[int, ...]) -> Column:
    """WIN-20: the least of the ratios to several steps ago, NULL if one is missing."""
    r = [ratio(c("p"), F.lag("p", n).over(by_day())) for n in steps]
    known = r[0].isNotNull()
    for x in r[1:]:
        known = known & x.isNotNull()
    return F.when(known, F.least(*r))


def asym_ratio(recent: int, gap: int, base: int) -> Column:
    """WIN-21: the recent steps' mean over that of a base window further back."""
    now, then = by_day().rowsBetween(-(recent - 1), 0), by_day().rowsBetween(-(recent + gap + base - 1), -(recent + gap))
    return F.when(F.count("p").over(then) > 0, ratio(F.avg("p").over(now), F.avg("p").over(then)))


W = "(PARTITION BY token, day ORDER BY k"


@query("win19_trailing_mean_ratio", V.sql("trades", f"{GRID} SELECT token, day, k, round(CASE WHEN lag(age, 8) OVER {W}) <= 8 AND count(p) OVER {W} ROWS 7 PRECEDING) = 8 THEN p / nullif(avg(p) OVER {W} ROWS 7 PRECEDING), 0) END, 4) AS ratio FROM grid"))
def win19(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_grid(spark, d).select("token", "day", "k", trail_ratio(8).alias("ratio")), 4)


@query("win20_consistent_ratio", V.sql("trades", f"{GRID}, r AS (SELECT token, day, k, p / lag(p, 2) OVER {W}) AS a, p / lag(p, 5) OVER {W}) AS b, p / lag(p, 10) OVER {W}) AS e FROM grid) SELECT token, day, k, round(CASE WHEN a IS NOT NULL AND b IS NOT NULL AND e IS NOT NULL THEN least(a, b, e) END, 4) AS ratio FROM r"))
def win20(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_grid(spark, d).select("token", "day", "k", consistent_ratio((2, 5, 10)).alias("ratio")), 4)


@query("win21_asymmetric_ratio", V.sql("trades", f"{GRID} SELECT token, day, k, round(avg(p) OVER {W} ROWS 1 PRECEDING) / nullif(avg(p) OVER {W} ROWS BETWEEN 16 PRECEDING AND 7 PRECEDING), 0), 4) AS ratio FROM grid"))
def win21(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_grid(spark, d).select("token", "day", "k", asym_ratio(2, 5, 10).alias("ratio")), 4)


EDGE = f"{GRID}, r AS (SELECT token, day * {86_400_000 // STEP} + k AS t, 0 AS seq, CASE WHEN count(p) OVER {W} ROWS BETWEEN 16 PRECEDING AND 7 PRECEDING) > 0 THEN avg(p) OVER {W} ROWS 1 PRECEDING) / nullif(avg(p) OVER {W} ROWS BETWEEN 16 PRECEDING AND 7 PRECEDING), 0) END AS ratio FROM grid), e AS (SELECT token, t, ratio, last_value(ratio IGNORE NULLS) OVER (PARTITION BY token ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM r), x AS (SELECT token, t FROM e WHERE ratio >= 1.5 AND coalesce(b, -1e300) < 1.5)"


def edges(spark: SparkSession, d: str) -> DataFrame:
    g = _grid(spark, d).select("token", (c("day") * (86_400_000 // STEP) + c("k")).alias("t"), F.lit(0).alias("seq"), asym_ratio(2, 5, 10).alias("ratio"))
    return rising(g, "ratio", 1.5)


@query("win22_rising_edge", V.sql("trades", f"{EDGE} SELECT token, t FROM x"))
def win22(spark: SparkSession, d: str) -> DataFrame:
    return edges(spark, d).select("token", "t")


def _greedy(source: str, gap: int) -> str:
    return f"k AS (SELECT token, t, seq, row_number() OVER (PARTITION BY token ORDER BY t, seq) AS i FROM {source}), r AS (SELECT token, i, t, seq, t AS last, true AS kept FROM k WHERE i = 1 UNION ALL SELECT k.token, k.i, k.t, k.seq, CASE WHEN k.t - r.last >= {gap} THEN k.t ELSE r.last END, k.t - r.last >= {gap} FROM r JOIN k ON k.token = r.token AND k.i = r.i + 1) SELECT token, t, seq FROM r WHERE kept"


@query("str05_cooldown", V.sql("fires", f"WITH RECURSIVE {_greedy('fires', 8 * HOUR)}"))
def str05(spark: SparkSession, d: str) -> DataFrame:
    return spaced(V.fires(spark, d), 8 * HOUR, ["token"]).select("token", "t", "seq")


@query("str06_throttle", V.sql("mids", f"WITH RECURSIVE {_greedy('mids', HOUR)}"))
def str06(spark: SparkSession, d: str) -> DataFrame:
    return spaced(V.mids(spark, d), HOUR, ["token"]).select("token", "t", "seq")


@query("prj15_policy_entries", V.sql("fires", f"WITH RECURSIVE p AS (SELECT token, t, seq FROM fires WHERE value <= 300 AND value BETWEEN 20 AND 280), {_greedy('p', 4 * HOUR)}"))
def prj15(spark: SparkSession, d: str) -> DataFrame:
    """PRJ-15: signals within the policy's bounds, spaced by the cooldown."""
    return spaced(V.fires(spark, d).where("value <= 300 AND value BETWEEN 20 AND 280"), 4 * HOUR, ["token"]).select("token", "t", "seq")


def single_slot(firings: DataFrame, horizon: int, buffer: int, key: str = "symbol") -> DataFrame:
    """STR-04: one position at a time, first come first served. firings(key, i, cell_id): the least cell of a bar is tried;
    a position opened at bar i closes at i + horizon, and a new one may open from buffer bars after that.

    Every firing gets a reason: taken, in_position, buffer, lost_tie. Outcome: key, i, cell_id, reason.
    """
    rows = firings.select(key, c("i").cast("bigint").alias("i"), c("cell_id").cast("bigint").alias("cell_id"))
    schema = T.StructType([*rows.schema.fields, T.StructField("reason", T.StringType())])

    def step(pdf: pd.DataFrame, entry: int | None) -> tuple[pd.DataFrame, int | None]:
        i = pdf["i"].to_numpy()
        reason = np.full(len(i), "", object)
        at = 0
        while at < len(i):
            if entry is None or i[at] >= entry + horizon + buffer:
                entry, reason[at] = int(i[at]), "taken"
                at += 1
            ends = np.searchsorted(i, [entry + 1, entry + horizon, entry + horizon + buffer])
            for a, b, why in zip([at, *ends], ends, ("lost_tie", "in_position", "buffer")):
                reason[max(a, at) : max(b, at)] = why
            at = max(at, int(ends[2]))
        return pdf.assign(reason=reason), entry

    return fold(rows, [key], ["i", "cell_id"], step, schema)


def bar_firings(spark: SparkSession, d: str) -> DataFrame:
    dec = R.deciles(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("symbol").orderBy("ts")))
    return R.firings(dec).select("symbol", "ts", "i", "cell_id", "side", "close")


SLOT = f"""{R.FIRE}, n AS (SELECT symbol, ts, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM dec),
o AS (SELECT f.symbol, n.i, f.cell_id, row_number() OVER (PARTITION BY f.symbol ORDER BY n.i, f.cell_id) AS q FROM fire f JOIN n ON n.symbol = f.symbol AND n.ts = f.ts),
s AS (SELECT symbol, q, i, cell_id, i AS entry, 'taken' AS reason FROM o WHERE q = 1 UNION ALL
SELECT o.symbol, o.q, o.i, o.cell_id, CASE WHEN o.i >= s.entry + 12 THEN o.i ELSE s.entry END, CASE WHEN o.i >= s.entry + 12 THEN 'taken' WHEN o.i = s.entry THEN 'lost_tie' WHEN o.i < s.entry + 10 THEN 'in_position' ELSE 'buffer' END FROM s JOIN o ON o.symbol = s.symbol AND o.q = s.q + 1)"""


@query("str04_single_slot", V.sql("bars_1h", f"WITH RECURSIVE {SLOT} SELECT symbol, i, cell_id, reason FROM s"))
def str04(spark: SparkSession, d: str) -> DataFrame:
    return single_slot(bar_firings(spark, d), 10, 2)


@query("str13_positions", V.sql("bars_1h", f"WITH RECURSIVE {SLOT}, b AS (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM dec) SELECT s.symbol, s.i AS entry_i, x.close AS entry_px, y.close AS exit_px, round((y.close / x.close - 1) * 10000, 4) AS ret_bps FROM s JOIN b x ON x.symbol = s.symbol AND x.i = s.i LEFT JOIN b y ON y.symbol = s.symbol AND y.i = s.i + 10 WHERE reason = 'taken'"))
def str13(spark: SparkSession, d: str) -> DataFrame:
    """STR-13, FN-13: positions taken, closed a horizon later; NULL while open."""
    dec = R.deciles(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("symbol").orderBy("ts")))
    taken = single_slot(R.firings(dec).select("symbol", "i", "cell_id"), 10, 2).where("reason = 'taken'").select("symbol", "i")
    entry = taken.join(dec.select("symbol", "i", c("close").alias("entry_px")), ["symbol", "i"])
    out = dec.select("symbol", (c("i") - 10).alias("i"), c("close").alias("exit_px"))
    return rounded(entry.join(out, ["symbol", "i"], "left").select("symbol", c("i").alias("entry_i"), "entry_px", "exit_px", ((ratio(c("exit_px"), c("entry_px")) - 1) * 10000).alias("ret_bps")), 4)


def capture_windows(fires: DataFrame, length_ms: int, key: str = "token") -> DataFrame:
    """STR-03: windows that last length_ms from their last signal(key, t, seq): key, opened, closed, n. One at a window's very end opens a
    new one."""
    w = Window.partitionBy(key).orderBy("t", "seq")
    new = F.when(holds(c("t") - F.lag("t").over(w) < length_ms), 0).otherwise(1)
    s = fires.withColumn("_new", new).withColumn("_w", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy(key, "_w").agg(F.min("t").alias("opened"), (F.max("t") + length_ms).alias("closed"), F.count(F.lit(1)).alias("n")).drop("_w")


@query("str03_extending_windows", V.sql("fires", f"WITH g AS (SELECT token, t, CASE WHEN t - lag(t) OVER (PARTITION BY token ORDER BY t, seq) < {2 * HOUR} THEN 0 ELSE 1 END AS n, seq FROM fires), s AS (SELECT *, sum(n) OVER (PARTITION BY token ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS w FROM g) SELECT token, min(t) AS opened, max(t) + {2 * HOUR} AS closed, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY token, w"))
def str03(spark: SparkSession, d: str) -> DataFrame:
    return capture_windows(V.fires(spark, d), 2 * HOUR)


def late_counts(rows: DataFrame, key: str = "token", span: int = 1 << 16) -> DataFrame:
    """STR-09: of each key how many rows(key, t, seq) are behind the highest time received before them (late) and how many there are.
    Highest times are carried through stretches of seq, so a hot key is spread."""
    part = F.floor(c("seq") / span)
    tops = rows.groupBy(key, part.alias("_p")).agg(F.max("t").alias("_top"))
    before = tops.select(key, "_p", F.max("_top").over(Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    own = F.max("t").over(Window.partitionBy(key, "_p").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    x = rows.withColumn("_p", part).join(before, [key, "_p"]).withColumn("_high", F.greatest(own, "_before"))
    return x.groupBy(key).agg(F.count_if(c("t") < c("_high")).alias("late"), F.count(F.lit(1)).alias("n"))


@query("str09_late_events", V.sql("trades", "WITH o AS (SELECT token, seq, t - (CASE WHEN seq % 11 = 0 THEN 7200000 ELSE 0 END) AS t FROM trades), m AS (SELECT *, max(t) OVER (PARTITION BY token ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hw FROM o) SELECT token, CAST(count(*) FILTER (t < hw) AS BIGINT) AS late, CAST(count(*) AS BIGINT) AS n FROM m GROUP BY token"))
def str09(spark: SparkSession, d: str) -> DataFrame:
    """Trades, each eleventh of which is two hours behind."""
    return late_counts(V.trades(spark, d).withColumn("t", c("t") - F.when(c("seq") % 11 == 0, 7_200_000).otherwise(0)))


@query("str11_confirm_or_expire", V.sql("fires trades", f"SELECT f.token, f.seq, CASE WHEN min(x.t) IS NOT NULL THEN 'confirmed' ELSE 'expired' END AS result, coalesce(min(x.t), f.t + {HOUR}) AS at FROM fires f LEFT JOIN trades x ON x.token = f.token AND x.t BETWEEN f.t AND f.t + {HOUR} GROUP BY f.token, f.seq, f.t"))
def str11(spark: SparkSession, d: str) -> DataFrame:
    """STR-10/11: each candidate ends once: confirmed by a trade up to its deadline, the deadline included, or expired."""
    from tidemill.operators.asof import asof

    nxt = asof(V.fires(spark, d), V.trades(spark, d).withColumn("x", c("t")), ["x"], forward=True)
    ok = holds(c("x") <= c("t") + HOUR)
    return nxt.select("token", "seq", F.when(ok, "confirmed").otherwise("expired").alias("result"), F.when(ok, c("x")).otherwise(c("t") + HOUR).alias("at"))


def price_jumps(rows: DataFrame, x: str, amount: float = 0.05, pct: float = 20.0, alone: float = 30.0, key: str = "token") -> DataFrame:
    """PRJ-11, WIN-27: rows(key, t, seq, x) that rise against the row before by an amount and a share in percent, or by a share alone:
    key, t, seq, delta, pct. A first row, and one after a price of 0 or less, is none."""
    m = rows.withColumn("_p", F.lag(x).over(Window.partitionBy(key).orderBy("t", "seq")))
    m = m.withColumn("delta", c(x) - c("_p")).withColumn("pct", ratio(c("delta"), c("_p")) * 100)
    big = ((c("delta") >= amount) & (c("pct") >= pct)) | (c("pct") >= alone)
    return m.where((c("_p") > 0) & (c("delta") > 0) & big).select(key, "t", "seq", "delta", "pct")


@query("prj11_price_jump", V.sql("mids", "WITH m AS (SELECT token, t, seq, mid, lag(mid) OVER (PARTITION BY token ORDER BY t, seq) AS p FROM mids) SELECT token, t, seq, round(mid - p, 4) AS delta, round((mid - p) / p * 100, 4) AS pct FROM m WHERE p > 0 AND mid > p AND ((mid - p >= 50 AND (mid - p) / p * 100 >= 20) OR (mid - p) / p * 100 >= 300)"))
def prj11(spark: SparkSession, d: str) -> DataFrame:
    return rounded(price_jumps(V.mids(spark, d), "mid", 50.0, 20.0, 300.0), 4)
