"""Rules of running state over recorded rows: thinning with keepalives, rejected and late rows, gaps, restarts, sampling rates,
retention, poll schedules. Streaming twins are in streaming.live."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.clean import holds
from tidemill.functions.folds import fold
from tidemill.operators.asof import asof
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col
HOUR = 3_600_000


def kept_fast(t: np.ndarray, fast: np.ndarray, slow_ms: int, last: int | None) -> tuple[list[int], int | None]:
    """Places in ascending times that are fast, or at least slow_ms after the last one kept; and the time of the last."""
    quick, at, out = np.flatnonzero(fast), 0 if last is None else int(np.searchsorted(t, last + slow_ms)), []
    k = 0
    while True:
        while k < len(quick) and out and quick[k] <= out[-1]:
            k += 1
        at = min(at, int(quick[k]) if k < len(quick) else len(t))
        if at >= len(t):
            return out, last
        out.append(at)
        last = int(t[at])
        at = max(at + 1, int(np.searchsorted(t, last + slow_ms)))


def thinned(rows: DataFrame, slow_ms: int, key: str = "token", until: int | None = None) -> DataFrame:
    """STR-07: of rows(key, t, seq, fast) those in a reaction (fast), others at least slow_ms after the last kept one; and a keepalive
    for each slow_ms without a kept row before the next one, and after the last one up to `until`: key, t, seq (the row that stands),
    kind (kept, keepalive). The streaming twin, whose keepalives time alone emits, is streaming.timers.thinned."""
    base = rows.select(key, c("t").cast("long").alias("t"), c("seq").cast("long").alias("seq"), holds(c("fast")).alias("fast"))
    schema = T.StructType([base.schema[key], *[T.StructField(x, T.LongType()) for x in ("t", "seq")]])

    def step(pdf: pd.DataFrame, last: int | None) -> tuple[pd.DataFrame, int | None]:
        at, last = kept_fast(pdf["t"].to_numpy(), pdf["fast"].to_numpy(bool), slow_ms, last)
        return pdf.iloc[at][schema.names], last

    kept = fold(base, [key], ["t", "seq"], step, schema)
    nxt = F.coalesce(F.lead("t").over(Window.partitionBy(key).orderBy("t", "seq")), F.lit(None if until is None else until + 1).cast("long"))
    n = F.greatest(F.coalesce(F.floor((nxt - c("t") - 1) / slow_ms), F.lit(0)), F.lit(0))
    each = kept.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), c("n"))))
    return each.select(key, (c("t") + c("i") * slow_ms).alias("t"), "seq", F.when(c("i") == 0, "kept").otherwise("keepalive").alias("kind"))


SECOND = 1000


def second_states(rows: DataFrame, epoch_ms: int = 900_000, wait_ms: int = 1000, key: str = "token") -> DataFrame:
    """STR-01/08/09/10: of rows(key, t, recv, seq, value), taken as they are received (recv, seq), the state at the end of each second of
    a key's epoch: key, epoch, at (the second's end), n, total, last (how many values, their sum, the last), late.

    A second is over, and is given as it stands, once a row with a later t is received, or any row wait_ms after it. A row whose second
    is given already is late: it is counted, once, and changes the seconds after those. State begins with an epoch's first row and
    nothing is given behind the epoch's end. The streaming twin is streaming.timers.second_states."""
    epoch = F.floor(c("t") / epoch_ms) * epoch_ms
    x = rows.select(key, epoch.alias("epoch"), "t", "recv", "seq", "value")
    w = Window.partitionBy(key, "epoch").orderBy("recv", "seq")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    horizon = F.max(F.greatest(c("t"), c("recv") - wait_ms)).over(upto)
    done = F.least(F.ceil(horizon / SECOND) * SECOND - SECOND, c("epoch") + epoch_ms)
    x = x.withColumns({"done": done, "first": (F.floor(F.first("t").over(upto) / SECOND) + 1) * SECOND})
    x = x.withColumn("done", F.greatest(c("done"), c("first") - SECOND)).withColumn("is_late", (c("t") <= c("done")) & (c("done") >= c("first")))
    state = {"n": F.count(F.lit(1)).over(before), "total": F.sum("value").over(before), "last": F.lag("value").over(w), "late": F.coalesce(F.sum(c("is_late").cast("long")).over(before), F.lit(0)), "prev": F.lag("done").over(w)}
    each = x.withColumns(state).where((c("n") > 0) & (c("done") > c("prev")))
    return each.select(key, "epoch", F.explode(F.sequence(c("prev") + SECOND, c("done"), F.lit(SECOND).cast("long"))).alias("at"), "n", "total", "last", "late")


def accepted(rows: DataFrame, key: str, at: str, arrival: list[str]) -> DataFrame:
    """STR-17: rows with `accepted`: whether their time is beyond all that came before them in order of arrival. Rows at a time seen
    before are duplicates, earlier ones are out of order; both are rejected."""
    high = F.max(at).over(Window.partitionBy(key).orderBy(*arrival).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("accepted", F.coalesce(c(at) > high, F.lit(True)))


def gap_actions(bars: DataFrame, most_missing: int, warm: int, key: str = "symbol", at: str = "i") -> DataFrame:
    """STR-18: what each bar makes the engine do: ok, backfill (up to most_missing bars are missing before it) or rewarm (more), and
    whether it is armed: at least `warm` bars of history since the start or the last rewarm, backfilled ones included."""
    w = Window.partitionBy(key).orderBy(at)
    missing = F.coalesce(c(at) - F.lag(at).over(w) - 1, F.lit(0))
    x = bars.withColumn("missing", missing)
    action = F.when(c("missing") > most_missing, "rewarm").when(c("missing") > 0, "backfill").otherwise("ok")
    since = F.coalesce(F.last(F.when(c("action") == "rewarm", c(at)), True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first(at).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.withColumn("action", action).withColumn("armed", c(at) - since + 1 >= warm)


def restarted(positions: DataFrame, last_bar: DataFrame, key: str = "symbol") -> DataFrame:
    """STR-19: open positions(key, entry_id, exit_i) after a restart, by the last bar seen (key, last_i): missed_exit where the exit bar
    has passed, else resume; resume too where no bar was seen."""
    missed = holds(c("exit_i") <= c("last_i"))
    return positions.join(last_bar, key, "left").withColumn("status", F.when(missed, "missed_exit").otherwise("resume"))


def cadence_s(t: Column, entry: Column, exit_: Column, near_s: int = 5, before_s: int = 60) -> Column:
    """STR-20: seconds between samples of a hold: 0.1 up to near_s after the entry and from before_s before the exit on, else 1."""
    return F.when((t <= entry + near_s * 1000) | (t >= exit_ - before_s * 1000), 0.1).otherwise(1.0)


def retained(rows: DataFrame, key: str, now: Column, keep_ms: int, ring: int | None = None) -> DataFrame:
    """STR-21: rows(key, t, seq, stale) that a bounded memory still holds at `now`: the last keep_ms, the last accepted row before that,
    and of all these at most the last `ring`."""
    old = c("t") < now - keep_ms
    last = F.max(F.when(old & ~holds(c("stale")), F.struct("t", "seq"))).over(Window.partitionBy(key))
    kept = rows.where(c("t") <= now).withColumn("_last", last).where(~old | holds(F.struct("t", "seq") == c("_last"))).drop("_last")
    if ring is None:
        return kept
    n = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("t"), F.desc("seq")))
    return kept.withColumn("_n", n).where(c("_n") <= ring).drop("_n")


def poll_schedule(jobs: DataFrame, polls: int = 10, gap_ms: int = 3000, extended: int = 8, pause_ms: int = 10_000, close: tuple[int, ...] = (2000, 1000)) -> DataFrame:
    """STR-24: the polls of jobs(job, t, extend, end_ms): every gap_ms after the trigger, `extended` more after a pause where the job
    asks for it, and the tries just before the window's end; none later than that end. job, phase, poll, at."""
    one = lambda phase, i, at: F.struct(F.lit(phase).alias("phase"), i.cast("int").alias("poll"), at.cast("long").alias("at"))
    first = F.transform(F.sequence(F.lit(0), F.lit(polls - 1)), lambda i: one("first", i, c("t") + i * gap_ms))
    begin = c("t") + (polls - 1) * gap_ms + pause_ms
    more = F.transform(F.sequence(F.lit(0), F.lit(extended - 1)), lambda i: one("extended", i, begin + i * gap_ms))
    last = F.array(*[one("close", F.lit(i), c("end_ms") - b) for i, b in enumerate(close)])
    all_ = F.concat(first, F.when(holds(c("extend")), more).otherwise(F.slice(more, 1, 0)), last)
    return jobs.select("job", "t", "end_ms", F.explode(all_).alias("p")).where((c("p.at") >= c("t")) & (c("p.at") <= c("end_ms"))).select("job", "p.phase", "p.poll", "p.at")


def late_rows(rows: DataFrame, windows: DataFrame, key: str = "token") -> DataFrame:
    """STR-10: rows(key, t, seq, done: when they were handled) by the last window(key, opened, closed) opened before them: inside, late
    (of the window, handled after it closed, which doesn't open it again) or outside."""
    w = windows.select(key, c("opened").alias("t"), "opened", "closed", F.lit(0).cast("long").alias("seq"))
    j = asof(rows, w, ["opened", "closed"], key=key)
    return j.withColumn("place", F.when(holds(c("t") <= c("closed")), F.when(c("done") > c("closed"), "late").otherwise("inside")).otherwise("outside"))


# Queries


REACT = "m AS (SELECT token, t, seq, EXISTS (SELECT 1 FROM fires f WHERE f.token = mids.token AND mids.t BETWEEN f.t AND f.t + 1800000) AS fast, row_number() OVER (PARTITION BY token ORDER BY t, seq) AS i FROM mids)"


@query("str07_thinning", V.sql("mids fires", f"""WITH RECURSIVE {REACT}, r AS (SELECT token, i, t, seq, t AS last, true AS kept FROM m WHERE i = 1 UNION ALL SELECT m.token, m.i, m.t, m.seq, CASE WHEN m.fast OR m.t - r.last >= 14400000 THEN m.t ELSE r.last END, m.fast OR m.t - r.last >= 14400000 FROM r JOIN m ON m.token = r.token AND m.i = r.i + 1),
k AS (SELECT token, t, seq, lead(t) OVER (PARTITION BY token ORDER BY t, seq) AS nxt FROM r WHERE kept), n AS (SELECT *, unnest(range(0, greatest(coalesce((nxt - t - 1) // 14400000, 0), 0) + 1)) AS j FROM k) SELECT token, t + j * 14400000 AS t, seq, CASE WHEN j = 0 THEN 'kept' ELSE 'keepalive' END AS kind FROM n"""))
def str07(spark: SparkSession, d: str) -> DataFrame:
    m, f = V.mids(spark, d), V.fires(spark, d)
    near = asof(m, f.withColumn("f_t", c("t")), ["f_t"]).withColumn("fast", c("t") - c("f_t") <= 1_800_000)
    return thinned(near, 4 * HOUR)


@query("str08_second_states", V.sql("trades", """WITH e AS (SELECT token, t // 100 AS t, t // 100 + seq % 7 * 300 + CASE WHEN seq % 11 = 0 THEN 9000 ELSE 0 END AS recv, seq, size AS v FROM trades),
x AS (SELECT *, t // 900000 * 900000 AS epoch FROM e),
h AS (SELECT *, max(greatest(t, recv - 1000)) OVER w AS h, (first_value(t) OVER w // 1000 + 1) * 1000 AS b0, count(*) OVER w - 1 AS n, sum(v) OVER w - v AS total, lag(v) OVER w AS last
  FROM x WINDOW w AS (PARTITION BY token, epoch ORDER BY recv, seq ROWS UNBOUNDED PRECEDING)),
d AS (SELECT *, greatest(least((h - 1) // 1000 * 1000, epoch + 900000), b0 - 1000) AS done FROM h),
l AS (SELECT *, CASE WHEN t <= done AND done >= b0 THEN 1 ELSE 0 END AS is_late FROM d),
p AS (SELECT *, lag(done) OVER w AS prev, sum(is_late) OVER w - is_late AS late FROM l WINDOW w AS (PARTITION BY token, epoch ORDER BY recv, seq ROWS UNBOUNDED PRECEDING))
SELECT token, epoch, unnest(range(prev + 1000, done + 1000, 1000)) AS at, n, total, last, CAST(late AS BIGINT) AS late FROM p WHERE n > 0 AND done > prev"""))
def str08(spark: SparkSession, d: str) -> DataFrame:
    """Trades ten times as dense, received up to eleven seconds late."""
    t = F.floor(c("t") / 100)
    rows = V.trades(spark, d).select("token", t.alias("t"), (t + c("seq") % 7 * 300 + F.when(c("seq") % 11 == 0, 9000).otherwise(0)).alias("recv"), "seq", c("size").alias("value"))
    return second_states(rows)


@query("str17_rejected_rows", V.sql("mids", "WITH o AS (SELECT token, seq, t - CASE WHEN seq % 11 = 0 THEN 7200000 ELSE 0 END AS t FROM mids) SELECT token, seq, coalesce(t > max(t) OVER (PARTITION BY token ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS accepted FROM o"))
def str17(spark: SparkSession, d: str) -> DataFrame:
    o = V.mids(spark, d).withColumn("t", c("t") - F.when(c("seq") % 11 == 0, 7_200_000).otherwise(0))
    return accepted(o, "token", "t", ["seq"]).select("token", "seq", "accepted")


@query("str18_gap_actions", V.sql("bars_15m", """WITH b AS (SELECT symbol, CAST(epoch(ts) AS BIGINT) // 900 AS i FROM bars_15m), m AS (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY symbol ORDER BY i) - 1, 0) AS missing FROM b), a AS (SELECT *, CASE WHEN missing > 6 THEN 'rewarm' WHEN missing > 0 THEN 'backfill' ELSE 'ok' END AS action FROM m)
SELECT symbol, i, missing, action, i - coalesce(last_value(CASE WHEN action = 'rewarm' THEN i END IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY i ROWS UNBOUNDED PRECEDING), first_value(i) OVER (PARTITION BY symbol ORDER BY i)) + 1 >= 20 AS armed FROM a"""))
def str18(spark: SparkSession, d: str) -> DataFrame:
    b = V.bars_15m(spark, d).select("symbol", F.floor(V.epoch("ts") / 900).alias("i"))
    return gap_actions(b, 6, 20).select("symbol", "i", "missing", "action", "armed")


@query("str19_restart", """WITH l AS (SELECT o_custkey % 5 AS symbol, max(o_orderkey % 83) AS last_i FROM orders WHERE o_custkey % 5 < 4 GROUP BY 1)
SELECT o_orderkey AS entry_id, CASE WHEN o_orderkey % 97 + 20 <= last_i THEN 'missed_exit' ELSE 'resume' END AS status FROM orders LEFT JOIN l ON l.symbol = o_custkey % 5""")
def str19(spark: SparkSession, d: str) -> DataFrame:
    """Orders as positions with an exit bar; a symbol without bars resumes."""
    o = V.table(spark, d, "orders").select((c("o_custkey") % 5).alias("symbol"), c("o_orderkey").alias("entry_id"), (c("o_orderkey") % 97 + 20).alias("exit_i"), (c("o_orderkey") % 83).alias("i"))
    last = o.where("symbol < 4").groupBy("symbol").agg(F.max("i").alias("last_i"))
    return restarted(o.drop("i"), last).select("entry_id", "status")


@query("str20_cadence", V.sql("fires mids", f"SELECT f.token, f.seq, m.seq AS sample, CASE WHEN m.t <= f.t + 5000 OR m.t >= f.t + {4 * HOUR} - 3600000 THEN 0.1 ELSE 1.0 END::DOUBLE AS every_s FROM fires f JOIN mids m ON m.token = f.token AND m.t BETWEEN f.t AND f.t + {4 * HOUR}"))
def str20(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.operators.asof import hold

    s = V.fires(spark, d).select("token", "seq", c("t").alias("start"), (c("t") + 4 * HOUR).alias("stop"))
    return hold(s, V.mids(spark, d), "mid").select("token", "seq", c("_s").alias("sample"), cadence_s(c("_t"), c("start"), c("stop"), 5, 3600).alias("every_s"))


NOW = 1_705_000_000_000


@query("str21_retention", V.sql("mids", f"WITH m AS (SELECT *, seq % 3 = 0 AS stale FROM mids WHERE t <= {NOW}), l AS (SELECT token, arg_max(seq, (t, seq)) AS last FROM m WHERE t < {NOW} - 36000000 AND NOT stale GROUP BY token), k AS (SELECT m.token, m.t, m.seq FROM m LEFT JOIN l ON l.token = m.token AND l.last = m.seq WHERE m.t >= {NOW} - 36000000 OR l.last IS NOT NULL) SELECT token, t, seq FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY t DESC, seq DESC) AS n FROM k) WHERE n <= 6"))
def str21(spark: SparkSession, d: str) -> DataFrame:
    m = V.mids(spark, d).withColumn("stale", c("seq") % 3 == 0)
    return retained(m, "token", F.lit(NOW), 36_000_000, 6).select("token", "t", "seq")


@query("str24_poll_phases", V.sql("fires", """WITH j AS (SELECT seq AS job, t, seq % 2 = 0 AS extend, (t // 900000 + 1) * 900000 AS end_ms FROM fires), p AS (SELECT *, 'first' AS phase, unnest(range(0, 10)) AS poll FROM j UNION ALL SELECT *, 'extended', unnest(range(0, 8)) FROM j WHERE extend UNION ALL SELECT *, 'close', unnest(range(0, 2)) FROM j),
a AS (SELECT *, CASE phase WHEN 'first' THEN t + poll * 3000 WHEN 'extended' THEN t + 27000 + 10000 + poll * 3000 ELSE end_ms - 2000 + poll * 1000 END AS at FROM p) SELECT job, phase, CAST(poll AS INT) AS poll, at FROM a WHERE at BETWEEN t AND end_ms""".replace(" AS at FROM p)", " AS \"at\" FROM p)").replace("AS poll, at FROM a WHERE at ", "AS poll, \"at\" FROM a WHERE \"at\" ")))
def str24_phases(spark: SparkSession, d: str) -> DataFrame:
    j = V.fires(spark, d).select(c("seq").alias("job"), "t", (c("seq") % 2 == 0).alias("extend"), ((F.floor(c("t") / 900_000) + 1) * 900_000).alias("end_ms"))
    return poll_schedule(j)


@query("str10_late_rows", V.sql("fires mids", f"WITH w AS (SELECT token, t, max(t) + {2 * HOUR} AS closed FROM fires GROUP BY ALL), j AS (SELECT m.*, w.closed FROM (SELECT token, t, seq, t + (seq % 4) * 3600000 AS done FROM mids) m ASOF LEFT JOIN w ON w.token = m.token AND w.t <= m.t) SELECT token, seq, CASE WHEN t <= closed THEN CASE WHEN done > closed THEN 'late' ELSE 'inside' END ELSE 'outside' END AS place FROM j"))
def str10(spark: SparkSession, d: str) -> DataFrame:
    w = V.fires(spark, d).select("token", c("t").alias("opened"), (c("t") + 2 * HOUR).alias("closed")).distinct()
    m = V.mids(spark, d).withColumn("done", c("t") + c("seq") % 4 * HOUR)
    return late_rows(m, w).select("token", "seq", "place")
