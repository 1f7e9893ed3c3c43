"""Ordered folds whose state is small: rows stream through a task in order, key after key, so memory is bounded whatever the
size of a key. Times within a run are numpy arrays, and folds jump from one decision to the next."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (rows of one key in order, the state that the rows before them left or None) -> (rows out, state)
Step = Callable[[pd.DataFrame, Any], tuple[pd.DataFrame, Any]]


def runs(pdf: pd.DataFrame, key: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Stretches of rows of one key each."""
    same = np.ones(len(pdf), bool)
    for k in key:
        before = pdf[k].shift()
        same &= ((pdf[k] == before) | (pdf[k].isna() & before.isna())).to_numpy(bool)
    same[:1] = False
    at = np.append(np.flatnonzero(~same), len(pdf))
    for a, b in zip(at[:-1], at[1:]):
        yield tuple(None if pd.isna(v) else v for v in (pdf[k].iloc[a] for k in key)), pdf.iloc[a:b]


def fold(df: DataFrame, key: list[str], order: list[str], step: Step, schema: T.StructType | str) -> DataFrame:
    """step over each key's rows in order. A key goes to one task, which reads it in batches and holds its state alone."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, state = None, None
        for pdf in frames:
            outs = []
            for k, rows in runs(pdf, key):
                out, state = step(rows, state if k == held else None)
                held = k
                outs.append(out)
            if outs:
                yield pd.concat(outs, ignore_index=True) if len(outs) > 1 else outs[0]

    dealt = df.repartition(*[F.col(k) for k in key]).sortWithinPartitions(*key, *order)
    return dealt.mapInPandas(run, schema)


def kept_apart(t: np.ndarray, gap: int, last: int | None) -> tuple[list[int], int | None]:
    """Places in ascending times that are kept greedily at least gap apart, and the last time kept."""
    at = 0 if last is None else int(np.searchsorted(t, last + gap))
    out: list[int] = []
    while at < len(t):
        out.append(at)
        last = int(t[at])
        at = int(np.searchsorted(t, last + gap))
    return out, last


def positions(df: DataFrame, key: str, by: str, bucket, name: str = "_at") -> DataFrame:
    """Adds each row's place from 0 in its key's order by `by`: places within buckets of `by`, which must grow with it, and
    counts of the buckets before, so that a long series is numbered in as many tasks as it has buckets."""
    from pyspark.sql import Window

    dealt = df.withColumn("_bucket", bucket)
    own = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(by)) - 1
    counts = dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offset = counts.select(key, "_bucket", before.alias("_before"))
    return dealt.withColumn("_own_at", own).join(offset, [key, "_bucket"]).withColumn(name, F.col("_own_at") + F.col("_before")).drop("_bucket", "_own_at", "_before")


def carried(df: DataFrame, key: list[str], order: list[str], bucket, value, name: str) -> DataFrame:
    """Adds the last value that is not null up to each row, in its key's order: within buckets, which must grow with the order, and
    from the last bucket before that has one, so that a long series is filled in as many tasks as it has buckets."""
    from pyspark.sql import Window

    dealt = df.withColumns({"_bucket": bucket, "_value": value})
    last = dealt.where(F.col("_value").isNotNull()).groupBy(*key, "_bucket").agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    all_ = dealt.select(*key, "_bucket").distinct().join(last, [*key, "_bucket"], "left")
    before = all_.select(*key, "_bucket", F.last("_last", True).over(Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    own = F.last("_value", True).over(Window.partitionBy(*key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(before, [*key, "_bucket"]).withColumn(name, F.coalesce(own, "_before")).drop("_bucket", "_value", "_before")
