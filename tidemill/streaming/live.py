"""Structured Streaming twins of the batch operators: tumbling bars, stream-stream confirmation, cooldown, sessions, sinks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemill.functions.folds import kept_apart
from tidemill.operators import ladder


def event_stream(spark, path: str, schema: str, files_at_a_time: int = 1) -> DataFrame:
    """SRC-20: a directory of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_a_time).parquet(path)


def tumbling_bars(events: DataFrame, width: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """STR-01/08: bars of a window, emitted once the watermark passes its end; later events are dropped by it."""
    at = F.struct("ts", "event_id")
    w = F.window("ts", width)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", at).alias("close"), F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("ts"), "event_type", "open", "high", "low", "close", "n")


def confirmations(fires: DataFrame, trades: DataFrame, within: str = "1 minute", late: str = "1 hour") -> DataFrame:
    """JN-13, STR-11: trades of the same token up to `within` of a fire on either side, ends included; state is bounded by the
    watermarks and the interval."""
    f = fires.withWatermark("fire_ts", late).alias("f")
    t = trades.withWatermark("trade_ts", late).alias("t")
    near = F.expr(f"f.token = t.token AND t.trade_ts >= f.fire_ts - INTERVAL {within} AND t.trade_ts <= f.fire_ts + INTERVAL {within}")
    return f.join(t, near).select("f.token", "fire_ts", "trade_ts")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """STR-03: windows that each event extends."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("opened"), F.col("w.end").alias("closed"), "user_id", "n")


def _frames(frames: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames)).sort_values(order)


def cooldown(events: DataFrame, gap_ms: int, late: str = "1 hour") -> DataFrame:
    """STR-05: per token, events at least gap_ms after the last one kept; state is one number a token, dropped once the watermark is
    past the gap, when it can't suppress any more. events(token, t, seq, ts); rows of a trigger are taken in order of (t, seq); the
    batch twin is onset.spaced."""

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = _frames(frames, ["t", "seq"])
        at, last = kept_apart(rows["t"].to_numpy(), gap_ms, state.get[0] if state.exists else None)
        state.update((last,))
        state.setTimeoutTimestamp(max(last + gap_ms, state.getCurrentWatermarkMs() + 1))
        yield rows.iloc[at][["token", "t", "seq"]]

    return events.withWatermark("ts", late).groupBy("token").applyInPandasWithState(keep, "token long, t long, seq long", "last long", "append", GroupStateTimeout.EventTimeTimeout)


def positions(firings: DataFrame, horizon: int, buffer: int) -> DataFrame:
    """STR-04: single slots of firings(symbol, i, cell_id), the reason of each; state is the open or last entry's bar, one number a
    symbol, which a restart resumes from the checkpoint. The batch twin is onset.single_slot."""

    def slot(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, entry, reasons = _frames(frames, ["i", "cell_id"]), state.get[0] if state.exists else None, []
        for i in rows["i"].tolist():
            if entry is None or i >= entry + horizon + buffer:
                entry = i
                reasons.append("taken")
            else:
                reasons.append("lost_tie" if i == entry else "in_position" if i < entry + horizon else "buffer")
        state.update((entry,))
        yield rows.assign(reason=reasons)[["symbol", "i", "cell_id", "reason"]]

    return firings.groupBy("symbol").applyInPandasWithState(slot, "symbol string, i long, cell_id long, reason string", "entry long", "append", GroupStateTimeout.NoTimeout)


class Ladders(StatefulProcessor):
    """A token's book as keyed state: sizes by side and price, one entry a level, so that a trigger writes the levels that it changes,
    not the ladder; whether the book is known, and its tick size."""

    def __init__(self, within: int) -> None:
        self.within = within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "side int, price long", "size long")
        self.known = handle.getValueState("known", "tick long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        book: ladder.Book | None = None
        if self.known.exists():
            book = ladder.Book(self.known.get()[0])
            for (side, price), (size,) in self.levels.iterator():
                book.set(side, price, size)
        before = {(s, p): q for s in (ladder.BID, ladder.ASK) for p, q in (book.sizes[s].items() if book else ())}
        frame, out = _frames(rows, ["seq", "at"]), []
        for seq, at, kind, tick, levels in zip(frame["seq"], frame["at"], frame["kind"], frame["tick"], frame["levels"]):
            if kind not in ("delta", "tick"):
                book = ladder.Book() if kind == "book" else None
            if book is not None:
                if kind != "delta":
                    book.tick = None if pd.isna(tick) else int(tick)
                for v in levels:
                    book.set(ladder.ASK if v["side"] == "ask" else ladder.BID, int(v["price"]), int(v["size"]))
            out.append((key[0], seq, at, *ladder.top(book, self.within)))
        after = {(s, p): q for s in (ladder.BID, ladder.ASK) for p, q in (book.sizes[s].items() if book else ())}
        for k in before.keys() - after.keys():
            self.levels.removeKey(k)
        for k, q in after.items():
            if before.get(k) != q:
                self.levels.updateValue(k, (q,))
        if book is None:
            self.known.clear()
        else:
            self.known.update((book.tick,))
        yield pd.DataFrame(out, columns=["token", "seq", "at", *ladder.TOP]).astype({n: "Int64" for n in ladder.TOP})

    def close(self) -> None:
        pass


def ladders(events: DataFrame, within: float = 0.01) -> DataFrame:
    """STR-14/15: after each event of ladder.book_events the token's best bid and ask, as ladder.tops gives them, which is the batch
    twin. The session's state store must be RocksDB's (see rocks)."""
    schema = "token string, seq long, at int, " + ", ".join(f"{n} long" for n in ladder.TOP)
    rows = events.select("token", "seq", "at", "kind", "tick", "levels").groupBy("token")
    out = rows.transformWithStateInPandas(Ladders(round(within * ladder.SCALE)), schema, "append", "none")
    return out.select("token", "seq", "at", *[ladder._number(n) for n in ladder.TOP])


def rocks(spark) -> None:
    """Keyed state of any size: the store that stateful processors need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def expiring(candidates: DataFrame, confirms: DataFrame, wait_ms: int, late: str = "10 minutes") -> DataFrame:
    """STR-11: each candidate(token, seq, t, ts) ends once: confirmed by the first confirm(token, t, ts) up to its deadline, the
    deadline included, or expired when the watermark has passed it. State is the open candidates of a token and the confirms that
    may still answer a late one."""
    kind = "token long, seq long, t long, ts timestamp"
    both = candidates.selectExpr("token", "seq", "t", "ts").unionByName(confirms.selectExpr("token", "CAST(NULL AS long) AS seq", "t", "ts"))
    assert both.columns == [x.split()[0] for x in kind.split(", ")]

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_t, open_seq, seen = map(list, state.get) if state.exists else ([], [], [])
        if not state.hasTimedOut:
            rows = _frames(frames, ["t"])
            for seq, t in zip(rows["seq"], rows["t"]):
                if pd.isna(seq):
                    seen.append(int(t))
                else:
                    open_t.append(int(t))
                    open_seq.append(int(seq))
        seen.sort()
        mark, out, rest = state.getCurrentWatermarkMs(), [], []
        for t, seq in sorted(zip(open_t, open_seq)):
            first = next((x for x in seen if t <= x <= t + wait_ms), None)
            if mark > t + wait_ms:  # nothing earlier can come any more
                out.append((key[0], seq, "expired" if first is None else "confirmed", t + wait_ms if first is None else first))
            else:
                rest.append((t, seq))
        seen = [x for x in seen if x >= mark - wait_ms or any(t <= x for t, _ in rest)]
        if rest or seen:
            state.update(([t for t, _ in rest], [q for _, q in rest], seen))
            state.setTimeoutTimestamp(max(mark + 1, (min(rest)[0] if rest else seen[-1]) + wait_ms + 1))
        else:
            state.remove()
        yield pd.DataFrame(out, columns=["token", "seq", "result", "at"])

    return both.withWatermark("ts", late).groupBy("token").applyInPandasWithState(judge, "token long, seq long, result string, at long", "t array<long>, seq array<long>, seen array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def first_arrivals(events: DataFrame, key: list[str], late: str = "1 hour") -> DataFrame:
    """STR-17: each key once, as it first arrives; state is dropped with the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", partition: list[str] | None = None) -> None:
    """Everything there is, to Parquet, with recovery from the checkpoint."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition:
        writer = writer.partitionBy(*partition)
    writer.format("parquet").start(path).awaitTermination()
