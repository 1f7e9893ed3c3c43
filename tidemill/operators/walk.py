"""Walk-forward fits from moments by day, and pools of many days as sorted runs by day: no row is copied to the days that learn
from it.

A row of day d is known to a score day D > d once its target is over: from day d + 1 + late on, where late is what its time of day
and its horizon make it. So the moments of each (key, day, late) are added up once, and a score day's window is a sum of those: of
the days back to D - train_days, less the `late` last ones. What is shuffled is (p + 2) ** 2 numbers a day.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement as pairs

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

c = F.col
DAY = 86_400


def _late(s: Column, delay: Column) -> Column:
    """How many days behind the next one a row is known, whose target is over delay seconds after it."""
    return (F.floor((s + delay) / DAY) - F.floor(s / DAY)).cast("int")


def _windowed(cells: DataFrame, keys: list[str], days: int, most: int, values: list[str], least: dict[str, Column] | None = None) -> DataFrame:
    """For each key and score day with a cell (keys, _day, _late, values) in its window the sums of the values; least: further columns,
    as functions of a cell's, whose least is taken."""
    spine = cells.select(*keys, F.explode(F.sequence(c("_day") + 1 + c("_late"), F.greatest(c("_day") + days, c("_day") + 1 + c("_late")))).alias("_day")).distinct()
    rows = cells.unionByName(spine, allowMissingColumns=True)
    over = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_day")
    frames = {k: over.rangeBetween(-days, -1 - k) for k in range(min(most, days - 1) + 1)}
    one = lambda f, v, k: f(F.when(c("_late") == k, v)).over(frames[k])
    total = lambda v: sum((F.coalesce(one(F.sum, c(v), k), F.lit(0)) for k in frames), F.lit(0))
    lows = {n: F.least(F.lit(None).cast("double"), *[one(F.min, v, k) for k in frames]) for n, v in (least or {}).items()}
    out = rows.select(*keys, "_day", "_late", *[total(v).alias(v) for v in values], *[v.alias(n) for n, v in lows.items()])
    return out.where("_late IS NULL").drop("_late").withColumnRenamed("_day", "score_day")


def _solved(keys: list[str], names: list[str], least: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    p = len(names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for m in frames:
            n = m["n"].to_numpy(float)
            beta, intercept = np.full((len(m), p), np.nan), np.full(len(m), np.nan)
            use = np.flatnonzero(n >= max(least, 1))
            if len(use):
                k = n[use]
                sx = np.stack([m[f"_x{i}"].to_numpy(float)[use] for i in range(p)], 1)
                sy = m["_y"].to_numpy(float)[use]
                xx = np.empty((len(use), p, p))
                for i, j in pairs(range(p), 2):
                    xx[:, i, j] = xx[:, j, i] = m[f"_x{i}x{j}"].to_numpy(float)[use] - sx[:, i] * sx[:, j] / k
                xy = np.stack([m[f"_x{i}y"].to_numpy(float)[use] - sx[:, i] * sy / k for i in range(p)], 1)
                scale = np.sqrt(np.maximum(np.einsum("kii->ki", xx), 0.0))
                scale[scale == 0] = 1.0
                b = (np.linalg.pinv(xx / scale[:, :, None] / scale[:, None, :], rcond=1e-12, hermitian=True) @ (xy / scale)[:, :, None])[:, :, 0] / scale
                beta[use], intercept[use] = b, (sy - (b * sx).sum(1)) / k
            out = {**{x: m[x] for x in [*keys, "score_day", "n"]}, "intercept": intercept, **{f"b_{x}": beta[:, i] for i, x in enumerate(names)}}
            yield pd.DataFrame(out).replace({np.nan: None})

    return run


def walk_fit(rows: DataFrame, s: Column, targets: dict[int, tuple[str, int]], names: list[str], days: int, least: int = 30, keys: tuple[str, ...] = ()) -> DataFrame:
    """AGG-22/23: for each key, score day and horizon of targets {horizon: (column, seconds until it is over)} the least squares, with
    intercept, of the target on names over the complete rows of the `days` days before it that are over by then: keys, horizon,
    score_day, n, intercept, b_<name>; coefficients are NULL with fewer than `least` rows. s: a row's time in seconds."""
    each = F.array(*[F.struct(F.lit(h).alias("horizon"), c(y).alias("y"), F.lit(delay).alias("delay")) for h, (y, delay) in targets.items()])
    long = rows.select(*keys, s.alias("_s"), *names, F.explode(each).alias("t")).select(*keys, "_s", *names, "t.horizon", "t.y", "t.delay")
    good = c("y").isNotNull()
    for x in names:
        good = good & c(x).isNotNull()
    added = lambda v: F.coalesce(F.sum(F.when(good, v)), F.lit(0.0))
    x = [c(n).cast("double") for n in names]
    moments = {"_y": c("y"), **{f"_x{i}": v for i, v in enumerate(x)}, **{f"_x{i}y": v * c("y") for i, v in enumerate(x)}, **{f"_x{i}x{j}": x[i] * x[j] for i, j in pairs(range(len(x)), 2)}}
    own = [*keys, "horizon"]
    cells = long.groupBy(*own, F.floor(c("_s") / DAY).alias("_day"), _late(c("_s"), c("delay")).alias("_late")).agg(F.count_if(good).alias("n"), *[added(v).alias(n) for n, v in moments.items()])
    most = max(-(-delay // DAY) for _, delay in targets.values())
    sums = _windowed(cells, own, days, most, ["n", *moments])
    kinds = [*(f"{k} {long.schema[k].dataType.simpleString()}" for k in own), "score_day long", "n long", "intercept double", *(f"b_{n} double" for n in names)]
    return sums.withColumn("n", c("n").cast("long")).mapInPandas(_solved(own, names, least), ", ".join(kinds))


# Pools of days


def day_runs(values: DataFrame, s: Column, z: str, delay: int, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """AGG-24: the values of each key, day and lateness as one sorted run: keys, day, late, zs, n, lo, hi. A value is in one run."""
    one = values.where(c(z).isNotNull()).groupBy(*keys, F.floor(s / DAY).alias("day"), _late(s, F.lit(delay)).alias("late"))
    return one.agg(F.array_sort(F.collect_list(c(z).cast("double"))).alias("zs")).withColumns({"n": F.size("zs").cast("long"), "lo": c("zs")[0], "hi": F.element_at("zs", -1)})


def pool_sizes(runs: DataFrame, days: int, keys: tuple[str, ...] = ("symbol",), most: int = 1) -> DataFrame:
    """Each key's score days with the size and ends of their pools: keys, score_day, pool_size, pool_lo, pool_hi."""
    cells = runs.select(*keys, c("day").alias("_day"), c("late").alias("_late"), "n", "lo", (-c("hi")).alias("_hi"))
    out = _windowed(cells, list(keys), days, most, ["n"], {"pool_lo": c("lo"), "_hi": c("_hi")})
    return out.select(*keys, "score_day", c("n").cast("long").alias("pool_size"), "pool_lo", (-c("_hi")).alias("pool_hi")).where("pool_size > 0")


def kth(runs: list[np.ndarray], k: int) -> float:
    """The k-th least (from 0) of all values of sorted runs, without merging them: each step takes the middle of the longest stretch
    that is left, counts what lies below it in every run, and drops the half that can't hold the answer."""
    low, high = [0] * len(runs), [len(r) for r in runs]
    while True:
        i = max(range(len(runs)), key=lambda i: high[i] - low[i])
        v = runs[i][(low[i] + high[i]) // 2]
        less = [int(np.searchsorted(r, v)) for r in runs]
        upto = [int(np.searchsorted(r, v, "right")) for r in runs]
        if sum(less) <= k < sum(upto):
            return float(v)
        if k < sum(less):
            high = [min(h, x) for h, x in zip(high, less)]
        else:
            low = [max(a, x) for a, x in zip(low, upto)]


def median(runs: list[np.ndarray]) -> float | None:
    n = sum(map(len, runs))
    return None if not n else kth(runs, n // 2) if n % 2 else (kth(runs, n // 2 - 1) + kth(runs, n // 2)) / 2


def share_over(runs: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Of all values of the runs the share over each x: ranks in the runs, added."""
    n = sum(map(len, runs))
    return 1 - sum(np.searchsorted(r, x, "right") for r in runs) / n if n else np.full(len(x), np.nan)


def _pool(runs: pa.Table, days: int) -> dict[int, list[np.ndarray]]:
    """The runs of each score day's pool, by day."""
    out: dict[int, list[np.ndarray]] = {}
    for day, late, zs in zip(runs["day"].to_pylist(), runs["late"].to_pylist(), runs["zs"]):
        z = np.asarray(zs.values)
        for d in range(day + 1 + late, day + days + 1):
            out.setdefault(d, []).append(z)  # the run itself, not a copy
    return out


def _stretches(df: DataFrame, day: str, days: int, back: bool) -> DataFrame:
    """Rows in stretches of `days` score days; back: runs, for the stretches of all score days that they serve (two at most)."""
    own = F.floor(c(day) / days)
    return df.withColumn("_part", F.explode(F.sequence(F.floor((c(day) + 1) / days), F.floor((c(day) + days) / days))) if back else own)


def pool_medians(runs: DataFrame, wanted: DataFrame, days: int, key: str = "symbol") -> DataFrame:
    """wanted(key, score_day) with pool_mid, the median of each day's pool. A run goes to two stretches of days at most."""

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        pool = _pool(given, days)
        mids = [median(pool.get(d, [])) for d in asked["score_day"].to_pylist()]
        return pa.table({key: asked[key], "score_day": asked["score_day"].cast(pa.int64()), "pool_mid": pa.array(mids, pa.float64())})

    schema = T.StructType([wanted.schema[key], T.StructField("score_day", T.LongType()), T.StructField("pool_mid", T.DoubleType())])
    left = _stretches(wanted.select(key, c("score_day").cast("long")), "score_day", days, False)
    right = _stretches(runs.select(c(key).alias("_key"), *[c(x).alias(x) for x in ("day", "late", "zs")]), "day", days, True)
    return left.groupBy(key, "_part").cogroup(right.groupBy("_key", "_part")).applyInArrow(run, schema)


def pool_shares(rows: DataFrame, runs: DataFrame, x: str, days: int, name: str = "share", key: str = "symbol", day: str = "score_day") -> DataFrame:
    """JN-20, FN-06: rows(key, day, x, ...) with the share of their day's pool over x; NULL without a pool or x."""
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        pool, out = _pool(given, days), np.full(asked.num_rows, np.nan)
        at, v = np.array(asked[day].to_pylist(), np.int64), np.array(asked[x].cast(pa.float64()).to_numpy(), float)
        for d in np.unique(at):
            mine = np.flatnonzero((at == d) & ~np.isnan(v))
            if len(mine) and pool.get(int(d)):
                out[mine] = share_over(pool[int(d)], v[mine])
        columns = [asked[f.name].cast(f.type) for f in list(arrow)[:-1]]
        return pa.table([*columns, pa.array(out, from_pandas=True)], schema=arrow)

    left = _stretches(rows, day, days, False)
    right = _stretches(runs.select(c(key).alias("_key"), *[c(x).alias(x) for x in ("day", "late", "zs")]), "day", days, True)
    return left.groupBy(key, "_part").cogroup(right.groupBy("_key", "_part")).applyInArrow(run, schema)
