"""Signal rules, decile ranks and cells."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.clean import holds, rounded
from tidemill.functions.sliding import Roll, slide
from tidemill.operators import features as X
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col
OPS = {">": lambda a, b: a > b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, "==": lambda a, b: a == b}


def all_hold(filters: dict[str, tuple[str, float]]) -> Column:
    """PRJ-03: every {column: (comparison, threshold)} holds; an unknown value fails."""
    return reduce(lambda a, b: a & b, [holds(OPS[op](c(name), F.lit(v))) for name, (op, v) in filters.items()], F.lit(True))


def side_of(common: dict, long: dict, short: dict) -> Column:
    """PRJ-02: 'long' or 'short' where the common and that side's filters hold, long first; else NULL."""
    return F.when(all_hold(common) & all_hold(long), "long").when(all_hold(common) & all_hold(short), "short")


def decile_chunked(df: DataFrame, x: str, n: int, least: int, chunk: int = 20_000, key: str = "symbol", by: str = "ts", bucket: Column | None = None) -> DataFrame:
    """WIN-13: adds decile, that (1 to 10) of x among the last n values, ties at their mean rank; exact at any n, and a row is in two
    chunks at most. Rows are numbered by buckets of time (bucket; ten days of a timestamp if not given)."""
    return slide(df, {"decile": Roll("decile", x, n, least)}, key, by, bucket, chunk)


class Cell(NamedTuple):
    """A rule: in the regime, every feature in its decile."""

    cell_id: int
    side: str
    legs: tuple[tuple[str, int], ...]


#: Example cells; the legs are chosen defaults, any others may be given.
CELLS = (Cell(1, "short", (("d_pk", 10), ("d_ret", 10))), Cell(2, "short", (("d_pk", 9), ("d_vol", 9))), Cell(3, "long", (("d_ret", 1), ("d_vol", 5))), Cell(4, "long", (("d_pk", 1), ("d_ret", 5))))
REGIME = (9, 10)


def firings(df: DataFrame, cells: tuple[Cell, ...] = CELLS, regime: str = "d_pk", accepted: tuple[int, ...] = REGIME) -> DataFrame:
    """PRJ-04/05: a row for each bar and cell that fires, with its legs (feature, actual, required)."""
    one = []
    for cell in cells:
        legs = F.array(*[F.struct(F.lit(f).alias("feature"), c(f).alias("actual"), F.lit(q).alias("required")) for f, q in cell.legs])
        fires = holds(c(regime).isin(*accepted)) & all_hold({f: ("==", q) for f, q in cell.legs})
        one.append(F.when(fires, F.struct(F.lit(cell.cell_id).alias("cell_id"), F.lit(cell.side).alias("side"), legs.alias("legs"))))
    return df.withColumn("_f", F.explode(F.array_compact(F.array(*one)))).select("*", "_f.*").drop("_f")


def featured(spark: SparkSession, d: str) -> DataFrame:
    b = V.bars_1h(spark, d)
    return b.select("symbol", "ts", "open", "close", X.parkinson(10).alias("pk_10"), X.volume_ratio(20).alias("vol_ratio_20"), X.cum_return(6).alias("ret_6"))


F_SQL = f"SELECT symbol, ts, open, close, {X.PARK[10]} AS pk_10, volume / nullif({X.least('avg', 'volume', 20)}, 0) AS vol_ratio_20, close / nullif(lag(open, 5) OVER (PARTITION BY symbol ORDER BY ts), 0) - 1 AS ret_6 FROM bars_1h"
COMMON, LONG, SHORT = {"pk_10": (">", 0.1), "vol_ratio_20": (">", 1.0)}, {"ret_6": ("<", -0.2)}, {"ret_6": (">", 0.2)}


@query("prj02_signals", V.sql("bars_1h", f"WITH f AS ({F_SQL}), s AS (SELECT *, CASE WHEN pk_10 > 0.1 AND vol_ratio_20 > 1.0 AND ret_6 < -0.2 THEN 'long' WHEN pk_10 > 0.1 AND vol_ratio_20 > 1.0 AND ret_6 > 0.2 THEN 'short' END AS side FROM f) SELECT symbol, ts, side, close, round(pk_10, 6) AS pk_10, round(vol_ratio_20, 6) AS vol_ratio_20, round(ret_6, 6) AS ret_6 FROM s WHERE side IS NOT NULL"))
def prj02(spark: SparkSession, d: str) -> DataFrame:
    s = featured(spark, d).withColumn("side", side_of(COMMON, LONG, SHORT)).where("side IS NOT NULL")
    return rounded(s.select("symbol", "ts", "side", "close", "pk_10", "vol_ratio_20", "ret_6"))


@query("prj03_filter_dict", V.sql("bars_1h", f"SELECT symbol, ts, coalesce(pk_10 >= 0.2 AND ret_6 <= 0 AND vol_ratio_20 < 2, false) AS passes FROM ({F_SQL})"))
def prj03(spark: SparkSession, d: str) -> DataFrame:
    return featured(spark, d).select("symbol", "ts", all_hold({"pk_10": (">=", 0.2), "ret_6": ("<=", 0.0), "vol_ratio_20": ("<", 2.0)}).alias("passes"))


@query("prj07_complete_rows", V.sql("bars_1h", f"SELECT symbol, ts FROM ({F_SQL}) WHERE pk_10 IS NOT NULL AND vol_ratio_20 IS NOT NULL AND ret_6 IS NOT NULL"))
def prj07(spark: SparkSession, d: str) -> DataFrame:
    return featured(spark, d).dropna(subset=["pk_10", "vol_ratio_20", "ret_6"]).select("symbol", "ts")


def _decile_sql(x: str, n: int, m: int) -> str:
    return f"""SELECT a.symbol, a.ts, CASE WHEN any_value(a.{x}) IS NOT NULL AND count(b.{x}) >= {m} THEN CAST(least(9, floor((count(*) FILTER (b.{x} < a.{x}) + (count(*) FILTER (b.{x} = a.{x}) + 1) / 2.0) / count(b.{x}) * 10)) AS INT) + 1 END AS d
FROM k a JOIN k b ON b.symbol = a.symbol AND b.i BETWEEN a.i - {n - 1} AND a.i GROUP BY a.symbol, a.ts"""


NUM = "k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM f)"


@query("win13_decile", V.sql("bars_1h", f"WITH f AS (SELECT symbol, ts, num_trades FROM bars_1h), {NUM} SELECT symbol, ts, d AS decile FROM ({_decile_sql('num_trades', 50, 25)})"))
def win13(spark: SparkSession, d: str) -> DataFrame:
    return decile_chunked(V.bars_1h(spark, d).select("symbol", "ts", "num_trades"), "num_trades", 50, 25).select("symbol", "ts", "decile")


@query("win13_decile_chunked", V.sql("bars_1h", f"WITH f AS (SELECT symbol, ts, num_trades FROM bars_1h), {NUM} SELECT symbol, ts, d AS decile FROM ({_decile_sql('num_trades', 200, 100)})"))
def win13_chunked(spark: SparkSession, d: str) -> DataFrame:
    b = V.bars_1h(spark, d).select("symbol", "ts", c("num_trades").cast("double").alias("num_trades"))
    return decile_chunked(b, "num_trades", 200, 100, chunk=300).select("symbol", "ts", "decile")


def deciles(spark: SparkSession, d: str) -> DataFrame:
    b = V.bars_1h(spark, d).select("symbol", "ts", "close", "volume", X.parkinson(5).alias("pk"), X.cum_return(3).alias("ret"))
    return slide(b, {name: Roll("decile", x, 100, 50) for name, x in (("d_pk", "pk"), ("d_ret", "ret"), ("d_vol", "volume"))}).select("symbol", "ts", "close", "d_pk", "d_ret", "d_vol")


DEC = f"""f AS (SELECT symbol, ts, close, volume, {X.PARK[5]} AS pk, close / lag(open, 2) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars_1h), {NUM},
p AS ({_decile_sql('pk', 100, 50)}), q AS ({_decile_sql('ret', 100, 50)}), v AS ({_decile_sql('volume', 100, 50)}),
dec AS (SELECT f.symbol, f.ts, f.close, p.d AS d_pk, q.d AS d_ret, v.d AS d_vol FROM f JOIN p ON p.symbol = f.symbol AND p.ts = f.ts JOIN q ON q.symbol = f.symbol AND q.ts = f.ts JOIN v ON v.symbol = f.symbol AND v.ts = f.ts)"""
FIRE = f"""{DEC}, fire AS (SELECT symbol, ts, close, cell_id, side FROM dec JOIN (VALUES (1, 'short', 10, 10, NULL), (2, 'short', 9, NULL, 9), (3, 'long', NULL, 1, 5), (4, 'long', 1, 5, NULL)) cells(cell_id, side, a, b, v)
ON (a IS NULL OR d_pk = a) AND (b IS NULL OR d_ret = b) AND (v IS NULL OR d_vol = v) WHERE d_pk IN (9, 10))"""


@query("prj04_cells", V.sql("bars_1h", f"WITH {FIRE} SELECT symbol, ts, cell_id, side FROM fire"))
def prj04(spark: SparkSession, d: str) -> DataFrame:
    return firings(deciles(spark, d)).select("symbol", "ts", "cell_id", "side")


@query("prj05_leg_detail", V.sql("bars_1h", f"""WITH {FIRE}, legs AS (SELECT f.symbol, f.ts, f.cell_id, unnest([{{'feature': 'd_pk', 'required': a, 'actual': d_pk}}, {{'feature': 'd_ret', 'required': b, 'actual': d_ret}}, {{'feature': 'd_vol', 'required': v, 'actual': d_vol}}]) AS l FROM fire f JOIN dec USING (symbol, ts)
JOIN (VALUES (1, 10, 10, NULL), (2, 9, NULL, 9), (3, NULL, 1, 5), (4, 1, 5, NULL)) cells(cell_id, a, b, v) USING (cell_id)) SELECT symbol, ts, cell_id, l.feature AS feature, l.actual AS actual, l.required AS required FROM legs WHERE l.required IS NOT NULL"""))
def prj05(spark: SparkSession, d: str) -> DataFrame:
    f = firings(deciles(spark, d))
    return f.select("symbol", "ts", "cell_id", F.explode("legs").alias("leg")).select("symbol", "ts", "cell_id", "leg.*")


@query("srt04_lowest_cell", V.sql("bars_1h", f"WITH {FIRE} SELECT symbol, ts, min(cell_id) AS cell_id, CAST(count(*) AS BIGINT) AS n FROM fire GROUP BY ALL"))
def srt04(spark: SparkSession, d: str) -> DataFrame:
    """SRT-04: of cells that fire together the lowest id is taken."""
    return firings(deciles(spark, d)).groupBy("symbol", "ts").agg(F.min("cell_id").alias("cell_id"), F.count(F.lit(1)).alias("n"))


@query("agg06_replay_stats", V.sql("bars_1h", f"WITH {FIRE} SELECT s.symbol, round(avg(CASE WHEN d_pk IN (9, 10) THEN 1.0 WHEN d_pk IS NULL THEN NULL ELSE 0.0 END), 6) AS regime_share, CAST((SELECT count(*) FROM fire f WHERE f.symbol = s.symbol) AS BIGINT) AS n_firings FROM dec s GROUP BY s.symbol"))
def agg06(spark: SparkSession, d: str) -> DataFrame:
    """AGG-06: share of bars in the regime and firings."""
    dec = deciles(spark, d)
    share = dec.groupBy("symbol").agg(F.avg(c("d_pk").isin(*REGIME).cast("double")).alias("regime_share"))
    n = firings(dec).groupBy("symbol").agg(F.count(F.lit(1)).alias("n_firings"))
    return rounded(share.join(n, "symbol", "left").withColumn("n_firings", F.coalesce("n_firings", F.lit(0)).cast("bigint")))
