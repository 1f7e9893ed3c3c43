"""Rolling aggregates that are NULL until enough values are seen, and overlap chunks for one long series."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

Agg = Callable[[Column], Column]


def order(key: str | list[str] = "symbol", by: str | list[str] = "ts") -> WindowSpec:
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*([by] if isinstance(by, str) else by))


def trailing(n: int, over: WindowSpec) -> WindowSpec:
    return over.rowsBetween(-(n - 1), 0)


def rolling(agg: Agg, x: Column, n: int, over: WindowSpec, least: int | None = None) -> Column:
    """agg of the last n values of x, NULL unless at least `least` (n by default) of them are present."""
    w = trailing(n, over)
    return F.when(F.count(x).over(w) >= (n if least is None else least), agg(x).over(w))


def forward(agg: Agg, x: Column, n: int, over: WindowSpec) -> Column:
    """agg of the next n values, NULL unless all are there."""
    w = over.rowsBetween(1, n)
    return F.when(F.count(x).over(w) == n, agg(x).over(w))


def overlap_chunks(df: DataFrame, position: str, chunk: int, back: int, ahead: int = 0) -> DataFrame:
    """Each row once for every chunk of positions whose frames can reach it, with _chunk and _own (whether it is its own).

    Exact for frames of at most back rows before and ahead rows after; a series becomes parallel in its chunks.
    """
    p = F.col(position)
    first, last = F.floor((p - ahead) / chunk), F.floor((p + back) / chunk)
    own = F.floor(p / chunk)
    out = df.withColumn("_chunk", F.explode(F.sequence(F.greatest(first, F.lit(0)).cast("long"), last.cast("long"))))
    return out.withColumn("_own", F.col("_chunk") == own)
