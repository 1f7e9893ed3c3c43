"""Sliding windows of long series at a cost that doesn't grow with the window.

A series is numbered and cut into chunks at least as long as its longest window, each with what its windows reach back to, so a row
is in two chunks at most and a key's rows are worked on in as many tasks as it has chunks. In a chunk, sums, minima and maxima take
aligned blocks of the window's length: a window is the end of one block and the beginning of the next, so accumulating each block
from both sides gives it in one step, and no difference of large sums is taken. Ranks count, for each row, the lesser and the equal
values in its window by a merge-sort tree: sorted runs of 1, 2, 4, ... rows, of which a stretch from the chunk's beginning is a few.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.functions.folds import positions
from tidemill.functions.frames import overlap_chunks


class Roll(NamedTuple):
    """op (count, sum, avg, std, min, max, lag, decile) of the last n values of a column, NULL with fewer than `least` of them (n).
    lag: the value n rows back. decile: 1 to 10, of the row's value among the window's, ties at their mean rank."""

    op: str
    column: str
    n: int
    least: int | None = None


def accumulated(v: np.ndarray, n: int, op: np.ufunc, none: float) -> np.ndarray:
    """op over the last n values (fewer at the beginning), by aligned blocks of n."""
    if n == 1:
        return v.copy()
    m = len(v)
    blocks = np.full(-(-m // n) * n, none, v.dtype)
    blocks[:m] = v
    blocks = blocks.reshape(-1, n)
    out = op.accumulate(blocks, axis=1).ravel()[:m]
    back = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    i = np.arange(n, m)
    i = i[(i + 1) % n != 0]  # the window is not one block
    out[i] = op(back[i - n + 1], out[i])
    return out


def ranked(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each value how many of the last n are less, how many are equal (itself included), how many there are. NaN is none."""
    m, good = len(x), ~np.isnan(x)
    values, r = np.unique(x[good], return_inverse=True)
    most = len(values)
    rank = np.full(m, most, np.int64)
    rank[good] = r
    less, upto = np.zeros(m, np.int64), np.zeros(m, np.int64)
    end = np.arange(1, m + 1)
    ends = ((end, 1), (np.maximum(end - n, 0), -1))
    for k in range(max(1, m).bit_length()):
        runs = np.sort((np.arange(m) >> k) * (most + 1) + rank)
        for t, sign in ends:  # the rows before t are runs of the sizes that t's bits give
            use = np.flatnonzero((t >> k & 1).astype(bool) & good)
            run = (t[use] >> k) - 1
            at = run * (most + 1) + rank[use]
            less[use] += sign * (np.searchsorted(runs, at) - (run << k))
            upto[use] += sign * (np.searchsorted(runs, at, "right") - (run << k))
    return less, upto - less, accumulated(good.astype(np.int64), n, np.add, 0)


def rolled(x: np.ndarray, roll: Roll) -> np.ndarray:
    """The values of a Roll over a series with NaN for NULL, NaN where there is none."""
    good, n = ~np.isnan(x), roll.n
    if roll.op == "lag":
        return np.concatenate([np.full(min(n, len(x)), np.nan), x[: max(0, len(x) - n)]])
    if roll.op == "decile":
        less, same, seen = ranked(x, n)
        out = np.minimum(9, (20 * less + 10 * same + 10) // np.maximum(2 * seen, 1)) + 1.0
        out[~good] = np.nan
    else:
        seen = accumulated(good.astype(np.int64), n, np.add, 0)
        total = lambda v: accumulated(np.where(good, v, 0.0), n, np.add, 0.0)
        with np.errstate(invalid="ignore", divide="ignore"):
            if roll.op == "count":
                out = seen.astype(float)
            elif roll.op == "sum":
                out = total(x)
            elif roll.op == "avg":
                out = total(x) / seen
            elif roll.op in ("min", "max"):
                none = np.inf if roll.op == "min" else -np.inf
                out = accumulated(np.where(good, x, none), n, np.minimum if roll.op == "min" else np.maximum, none)
            elif roll.op == "std":
                v = x - (np.mean(x[good]) if good.any() else 0.0)
                s = total(v)
                out = np.sqrt(np.maximum(total(v * v) - s * s / seen, 0.0) / (seen - 1))
                flat = accumulated(np.where(good, x, np.inf), n, np.minimum, np.inf) == accumulated(np.where(good, x, -np.inf), n, np.maximum, -np.inf)
                out[flat & (seen > 1)] = 0.0
                out[seen < 2] = np.nan
            else:
                raise ValueError(f"no such op: {roll.op}")
    out[seen < (n if roll.least is None else roll.least)] = np.nan
    return out


def _run(rolls: dict[str, Roll], schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        own = table["_own"]
        out = {}
        for name, roll in rolls.items():
            x = np.array(table[roll.column].cast(pa.float64()).to_numpy(), float)
            out[name] = pa.chunked_array([pa.array(rolled(x, roll), from_pandas=True)])
        kept = {f.name: (out[f.name] if f.name in out else table[f.name]).filter(own) for f in schema}
        return pa.table({f.name: kept[f.name].cast(f.type) for f in schema}, schema=schema)

    return run


def slide(df: DataFrame, rolls: dict[str, Roll], key: str = "symbol", by: str = "ts", bucket: Column | None = None, chunk: int = 20_000) -> DataFrame:
    """df with a column for each roll. Rows of a key are in the order of `by`, which has no ties; bucket grows with it (ten days of a
    timestamp if not given) and cuts the numbering. chunk: rows of a task at least."""
    if bucket is None:
        bucket = F.floor(F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {by})") / 864_000)
    back = max(r.n for r in rolls.values())
    at = positions(df, key, by, bucket)
    added = [T.StructField(n, T.IntegerType() if r.op == "decile" else T.LongType() if r.op == "count" else T.DoubleType()) for n, r in rolls.items()]
    schema = T.StructType([*at.drop("_at").schema.fields, *added])
    return overlap_chunks(at, "_at", max(chunk, back), back).groupBy(key, "_chunk").applyInArrow(_run(rolls, to_arrow_schema(schema)), schema)
