"""Sweeps that report a window once, and backfills of archives."""

from datetime import date, datetime

import pytest

from tidemill.operators import sweeps
from tidemill.sources.store import Store


def test_a_window_is_reported_once_and_only_if_an_evaluation_passes(spark, tmp_path, monkeypatch):
    fires = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (3, 7), (4, 7)], "epoch long, token long")
    evals = spark.createDataFrame([(1, 7, False), (1, 7, True), (2, 7, False), (2, 7, None), (4, 7, True)], "epoch long, token long, passes boolean")
    resolved = lambda *e: spark.createDataFrame([(x, 7, x % 2) for x in e], "epoch long, token long, y long")
    done = Store(spark, f"file://{tmp_path}/done", ("epoch", "token"))
    shown = lambda df: sorted((r["epoch"], r["sent"], r["message"]) for r in df.collect())
    first = shown(sweeps.report_sweep(fires, resolved(1, 2, 9), evals, done, 1))
    assert first == [(1, True, "window 1 of 7: 2 fires, settled 1"), (2, False, None)]
    with monkeypatch.context() as m:
        m.setattr(Store, "_commit", lambda self, new: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            sweeps.report_sweep(fires, resolved(1, 2, 3, 4), evals, done, 2)
    second = shown(sweeps.report_sweep(fires, resolved(1, 2, 3, 4), evals, done, 2))
    assert second == [(3, False, None), (4, True, "window 4 of 7: 1 fires, settled 0")]
    assert shown(sweeps.report_sweep(fires, resolved(1, 2, 3, 4), evals, done, 2)) == second  # repeated after a crash: the same
    assert shown(sweeps.report_sweep(fires, resolved(1, 2, 3, 4), evals, done, 3)) == []


def test_archives_of_whole_months_and_of_the_days_of_the_one_that_runs(spark, tmp_path):
    assert sweeps.archive_plan("2023-11", date(2024, 2, 3)) == ["2023-11", "2023-12", "2024-01", "2024-02-01", "2024-02-02"]
    assert sweeps.archive_plan("2024-02", date(2024, 2, 1)) == []
    line = lambda at, close: f"{int(at.timestamp() * 1000)},1,1,1,{close},1,0,0,1,0,0,0\n"
    utc = lambda *x: datetime.fromisoformat(datetime(*x).isoformat() + "+00:00")
    (tmp_path / "b-1m-2024-01.csv").write_text(line(utc(2024, 1, 31), 1) + line(utc(2023, 12, 31), 9))
    (tmp_path / "b-1m-2024-01-31.csv").write_text(line(utc(2024, 1, 31), 1))
    (tmp_path / "b-1m-2024-02-02.csv").write_text(line(utc(2024, 2, 2), 2))
    (tmp_path / "b-1m-2024-02-03.csv").write_text("torn")  # today's, not opened
    table = Store(spark, f"file://{tmp_path}/table", ("symbol", "ts"))
    got = sweeps.backfill(spark, f"file://{tmp_path}", "b", "2024-01", date(2024, 2, 3), table).collect()
    assert sorted((r["symbol"], r["ts"].day, r["close"]) for r in got) == [("b", 2, 2.0), ("b", 31, 1.0)]
