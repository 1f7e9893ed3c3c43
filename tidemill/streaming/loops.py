"""PIPE-06: a signal loop as micro-batches that count once, however often they are repeated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators import features as X
from tidemill.operators import rules
from tidemill.sources.store import Store

c = F.col


def signals(bars: DataFrame, common: dict, long: dict, short: dict) -> DataFrame:
    """Each bar's features and side: symbol, ts, close, pk_10, vol_ratio_20, ret_6, side."""
    x = bars.select("symbol", "ts", "close", X.parkinson(10).alias("pk_10"), X.volume_ratio(20).alias("vol_ratio_20"), X.cum_return(6).alias("ret_6"))
    return x.withColumn("side", rules.side_of(common, long, short))


def buffered(table: Store, new: DataFrame, back: int) -> DataFrame:
    """The bars of a batch with, of each symbol, the `back` stored ones before its first."""
    old = table.latest()
    if old is None:
        return new
    first = new.groupBy("symbol").agg(F.min("ts").alias("_first"))
    before = old.join(first, "symbol").where("ts < _first")
    at = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("ts")))
    return before.withColumn("_at", at).where(c("_at") <= back).select(*new.columns).unionByName(new)


def signal_loop(name: str, bars: Store, out: Store, common: dict, long: dict, short: dict, back: int = 20, notify: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: closed bars go to the table `bars`, and the signals of those that are new, over a rolling buffer, to `out`.

    A batch is worked out from what was stored before it: bars that the same batch stored in an earlier try are no part of its
    buffer, since they are not before its first. Signals are written with the batch's number, so a try after a crash, whether that
    came before or after either write, leaves each row once. Bars come in order of time, batch after batch."""

    def run(rows: DataFrame, number: int) -> None:
        fresh = rows.persist()
        try:
            if fresh.isEmpty():
                return
            # the batch's bars are put first and the buffer is what lies before them, in this try and in any other
            bars.put(fresh, (name, number))
            found = signals(buffered(bars, fresh, back), common, long, short)
            mine = found.join(fresh.select("symbol", "ts"), ["symbol", "ts"], "left_semi").where("side IS NOT NULL")
            out.put(mine, (name, number))
            if notify is not None:
                notify(mine)
        finally:
            fresh.unpersist()

    return run


def run_loop(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Everything there is, in batches as the source admits them."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
