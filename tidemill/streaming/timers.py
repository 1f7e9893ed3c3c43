"""Stateful streams that time moves on: keepalives without a row, seconds that are over, late rows that still count."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemill.operators.lifecycle import SECOND, kept_fast


def _rearmed(handle: StatefulProcessorHandle, at: int | None) -> None:
    """Leaves the one timer at `at`, or none."""
    for t in list(handle.listTimers()):
        if t != at:
            handle.deleteTimer(t)
    if at is not None:
        handle.registerTimer(at)


class Thinning(StatefulProcessor):
    """Rows wait until the watermark has passed them, so they are taken in order whatever order they came in; between two kept rows,
    and after the last one as far as the watermark goes, a timer emits the keepalives."""

    def __init__(self, slow_ms: int, until: int | None) -> None:
        self.slow, self.until = slow_ms, until

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, seq long, fast boolean")
        self.last = handle.getValueState("last", "t long, seq long, said long")  # the last kept row, the last time said of it

    def _moved(self, key, mark: int) -> pd.DataFrame:
        """What is certain once no row up to `mark` can come any more."""
        rows = sorted(self.waiting.get()) if self.waiting.exists() else []
        ready, rest = [r for r in rows if r[0] <= mark], [r for r in rows if r[0] > mark]
        state = self.last.get() if self.last.exists() else None
        out: list[tuple] = []

        def quiet(upto: int) -> None:
            """Keepalives of the standing row before the time upto."""
            nonlocal state
            while state is not None and state[2] + self.slow < upto and (self.until is None or state[2] + self.slow <= self.until):
                state = (state[0], state[1], state[2] + self.slow)
                out.append((state[2], state[1], "keepalive"))

        if ready:
            t = np.array([r[0] for r in ready], np.int64)
            at, _ = kept_fast(t, np.array([bool(r[2]) for r in ready]), self.slow, None if state is None else state[0])
            for i in at:
                quiet(ready[i][0])
                state = (ready[i][0], ready[i][1], ready[i][0])
                out.append((ready[i][0], ready[i][1], "kept"))
        quiet(mark + 1)
        if ready:
            self.waiting.clear()
            if rest:
                self.waiting.put([tuple(r) for r in rest])
        if state is not None:
            self.last.update(tuple(state))
        due = [r[0] for r in rest]
        if state is not None and (self.until is None or state[2] + self.slow <= self.until):
            due.append(state[2] + self.slow)
        _rearmed(self.handle, max(mark + 1, min(due)) if due else None)
        return pd.DataFrame([(key[0], *r) for r in out], columns=["token", "t", "seq", "kind"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            self.waiting.appendList([(int(t), int(s), bool(f)) for t, s, f in zip(pdf["t"], pdf["seq"], pdf["fast"])])
        yield self._moved(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._moved(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def thinned(rows: DataFrame, slow_ms: int, late: str = "10 seconds", until: int | None = None) -> DataFrame:
    """STR-07: lifecycle.thinned of a stream of rows(token, t, seq, fast), as far as the watermark goes, which is `late` behind the latest
    row; rows behind it are lost. The session's state store must be RocksDB's (live.rocks)."""
    timed = rows.select("token", "t", "seq", F.coalesce("fast", F.lit(False)).alias("fast"), F.timestamp_millis("t").alias("ts")).withWatermark("ts", late)
    return timed.groupBy("token").transformWithStateInPandas(Thinning(slow_ms, until), "token long, t long, seq long, kind string", "append", "eventTime")


class Seconds(StatefulProcessor):
    """A key's own progress: the seconds given so far, and the values that its rows have added up to, late ones too."""

    def __init__(self, epoch_ms: int, wait_ms: int, keep_ms: int) -> None:
        self.epoch, self.wait, self.keep = epoch_ms, wait_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "done long, n long, total double, last double, late long, first long")

    def _given(self, key, state: list, horizon: int, out: list[tuple]) -> None:
        """The seconds that end before the horizon, and within the epoch, as the state stands."""
        while state[0] + SECOND < horizon and state[0] + SECOND <= key[1] + self.epoch:
            state[0] += SECOND
            if state[1]:
                out.append((key[0], key[1], state[0], *state[1:5]))

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["token", "epoch", "at", "n", "total", "last", "late"])

    def _next(self, key, state: list, now: int) -> None:
        if state[0] < key[1] + self.epoch:
            _rearmed(self.handle, max(now + 1, state[0] + SECOND + self.wait + 1))
        else:
            _rearmed(self.handle, max(now + 1, key[1] + self.epoch + self.keep))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state, out = list(self.state.get()) if self.state.exists() else None, []
        pdf = pd.concat(list(rows)).sort_values(["recv", "seq"])
        for t, recv, value in zip(pdf["t"].tolist(), pdf["recv"].tolist(), pdf["value"].tolist()):
            if state is None:
                begin = t // SECOND * SECOND
                state = [begin, 0, 0.0, None, 0, begin]
            self._given(key, state, max(t, recv - self.wait), out)
            state[4] += t <= state[0] and state[0] > state[5]
            state[1], state[2], state[3] = state[1] + 1, state[2] + value, value
        self.state.update(tuple(state))
        self._next(key, state, timerValues.getCurrentWatermarkInMs())
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, out = timerValues.getCurrentWatermarkInMs(), []
        if self.state.exists():
            state = list(self.state.get())
            if state[0] >= key[1] + self.epoch and now >= key[1] + self.epoch + self.keep:
                self.state.clear()
                _rearmed(self.handle, None)
            else:
                self._given(key, state, now - self.wait, out)
                self.state.update(tuple(state))
                self._next(key, state, now)
        yield self._frame(out)

    def close(self) -> None:
        pass


def second_states(rows: DataFrame, epoch_ms: int = 900_000, wait_ms: int = 1000, keep_ms: int = 3_600_000) -> DataFrame:
    """STR-01/08/09/10: lifecycle.second_states of a stream of rows(token, t, recv, seq, value) in the order of recv. The clock is that of
    receipt: a key that goes quiet gives its seconds wait_ms after they end, as other keys' rows move the clock; no row is lost for
    a late t. A closed epoch's state is kept for keep_ms, so a late row does not open it again."""
    epoch = (F.floor(F.col("t") / epoch_ms) * epoch_ms).cast("long")
    timed = rows.select("token", epoch.alias("epoch"), "t", "recv", "seq", F.col("value").cast("double").alias("value"), F.timestamp_millis("recv").alias("ts")).withWatermark("ts", "0 seconds")
    schema = "token long, epoch long, at long, n long, total double, last double, late long"
    return timed.groupBy("token", "epoch").transformWithStateInPandas(Seconds(epoch_ms, wait_ms, keep_ms), schema, "append", "eventTime")
