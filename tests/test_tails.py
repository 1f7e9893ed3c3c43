"""Tails of growing files as a stream, and batches of replies as a partitioned source."""

import os
import zipfile
from datetime import datetime

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

from tidemill.sources import files, pages, tails
from tidemill.streaming import live


def reader(tmp_path, **options):
    return tails.TailReader({"path": f"file://{tmp_path}/in", "progress": f"file://{tmp_path}/progress", **options})


def taken(r, start, end):
    return [(os.path.basename(b["uri"][i].as_py()), b["offset"][i].as_py(), b["value"][i].as_py()) for p in r.partitions(start, end) for b in r.read(p) for i in range(b.num_rows)]


def write(path, text, mode="a"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)


def test_whole_lines_only_and_at_most_so_many(tmp_path):
    f = f"{tmp_path}/in/s/a.jsonl"
    write(f, '{"x": 1')
    r = reader(tmp_path, rows="2")
    at = r.latestOffset()
    assert taken(r, {}, at) == []
    write(f, '}\n{"x": 2}\n{"x": 3}\n{"x": 4')
    nxt = r.latestOffset()
    assert [v for _, _, v in taken(r, at, nxt)] == ['{"x": 1}', '{"x": 2}']
    last = r.latestOffset()
    assert taken(r, nxt, last) == [("a.jsonl", 27, '{"x": 3}')] and r.latestOffset() == last


def test_a_file_in_anothers_place_is_read_from_its_beginning(tmp_path):
    f = f"{tmp_path}/in/a.jsonl"
    write(f, "one\ntwo\n")
    r = reader(tmp_path)
    at = r.latestOffset()
    for text in ("other line, longer\nthan before\n", "short\n"):
        os.rename(f, f + ".old")  # keeps the inode in use
        write(f, text)
        nxt = r.latestOffset()
        assert [v for _, _, v in taken(r, at, nxt)] == text.splitlines()
        at = nxt
        os.remove(f + ".old")
    write(f, "in place, another text of the same inode\n", "w")
    nxt = r.latestOffset()
    assert [v for _, _, v in taken(r, at, nxt)] == ["in place, another text of the same inode"]
    os.remove(f)
    assert taken(r, nxt, r.latestOffset()) == []
    assert taken(r, at, nxt) == []  # what was planned is gone


def test_a_line_that_is_too_long_is_an_error(tmp_path):
    f = f"{tmp_path}/in/a.jsonl"
    write(f, "x" * 100 + "\n")
    reader(tmp_path, line_bytes="101").latestOffset()
    with pytest.raises(ValueError, match="longer"):
        reader(tmp_path, line_bytes="100", progress=f"file://{tmp_path}/p2").latestOffset()
    write(f, "y" * 200_000)  # no end yet, and too long already
    with pytest.raises(ValueError, match="longer"):
        reader(tmp_path, line_bytes="150000").latestOffset()


def test_a_planned_trigger_that_was_not_logged_is_taken_with_the_next(tmp_path):
    f = f"{tmp_path}/in/a.jsonl"
    write(f, "".join(f"{i}\n" for i in range(10)))
    r = reader(tmp_path, rows="3")
    first = r.latestOffset()
    r.latestOffset()  # planned, and the process is lost
    again = reader(tmp_path, rows="3")
    assert [v for _, _, v in taken(again, first, again.latestOffset())] == ["3", "4", "5", "6", "7", "8"]


def test_stream_over_restarts_loses_and_repeats_nothing(spark, tmp_path):
    files = [f"{tmp_path}/in/{n}.jsonl" for n in "ab"]
    expected = []
    for step in range(4):
        for n, f in zip("ab", files):
            lines = [f'{{"f": "{n}", "i": {i}}}' for i in range(step * 7, step * 7 + 7)]
            expected += lines
            write(f, "\n".join(lines) + ("\n" if step < 3 else ""))  # the last line has no end
        stream = tails.tail_stream(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/progress", rows=5).select("value", "offset")
        live.run_once(stream, str(tmp_path / "out"), str(tmp_path / "mark"))
    for _ in range(4):
        stream = tails.tail_stream(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/progress", rows=5).select("value", "offset")
        live.run_once(stream, str(tmp_path / "out"), str(tmp_path / "mark"))
    got = sorted(r["value"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(x for x in expected if '"i": 27}' not in x)


def page(folder, name, text):
    write(f"{folder}/{name}", text, "w")


def test_pages_prune_windows_before_files_are_opened(spark, tmp_path):
    row = lambda ms, close: f'["{ms}", "1", "2", "0.5", "{close}", "7", "0", "70", 3, "4", "40", "0"]'
    feb = 1_706_745_600_000
    page(tmp_path, f"k-{feb}-{feb + 120_000}.json", f'{{"data": [{row(feb, 1)}, {row(feb + 60_000, 2)}, ["x"], []]}}')
    page(tmp_path, f"k-{feb - 60_000}-{feb}.json", "torn")  # opening it would be an error
    page(tmp_path, "btc-1m-2024-01.csv", "torn,\n")
    page(tmp_path, "btc-1m-2024-02-02.csv", f"open_time,open,high,low,close,volume\n{(feb + 86_400_000) * 1000},1,1,1,9,1\n\nshort\n")
    df = pages.klines(spark, f"file://{tmp_path}")
    got = df.where("ts >= TIMESTAMP_NTZ'2024-02-01 00:00:00'").orderBy("ts").collect()
    assert [(r["ts"].isoformat(), r["close"], r["num_trades"]) for r in got] == [("2024-02-01T00:00:00", 1, 3), ("2024-02-01T00:01:00", 2, 3), ("2024-02-02T00:00:00", 9, None)]
    r = pages.KlinesReader({"path": f"file://{tmp_path}"})
    assert len(r.partitions()) == 4
    assert list(r.pushFilters([GreaterThanOrEqual(("ts",), datetime(2024, 2, 1)), LessThan(("ts",), datetime(2024, 2, 2)), EqualTo(("close",), 1.0)])) and len(r.filters) == 2
    assert [p.uri.rpartition("/")[2] for p in r.partitions()] == [f"k-{feb}-{feb + 120_000}.json"]
    assert df.where("ts > TIMESTAMP_NTZ'2030-01-01 00:00:00'").count() == 0


def test_windows_of_paths():
    assert pages.window("x/window=0000000000000-0000000060000/part-1.txt") == (datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 1))
    assert pages.window("BTCUSDT-1m-2023-12.zip") == (datetime(2023, 12, 1), datetime(2024, 1, 1))
    assert pages.window("a/2023-12-31.csv") == (datetime(2023, 12, 31), datetime(2024, 1, 1)) and pages.window("a/2023-13.csv") is None


def test_zipped_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a-2024-02.zip", "w") as z:
        z.writestr("a.csv", "﻿open_time,open,high,low,close,volume\n1706745600000,1,2,3,4,5,6,7,8,9,10,11\n1706745660,1,2,3,5,5,6,7,8,9,10,11\n")
        z.writestr("readme.txt", "no")
    got = pages.klines(spark, f"file://{tmp_path}").orderBy("ts").collect()
    assert [(r["close"], r["num_trades"], r["taker_buy_base_volume"]) for r in got] == [(4, 8, 9), (5, 8, 9)] and (got[1]["ts"] - got[0]["ts"]).seconds == 60


def test_batch_tails_know_a_longer_file_in_anothers_place(spark, tmp_path):
    f = f"{tmp_path}/a.jsonl"
    write(f, "one\n")
    first = files.tail_lines(spark.createDataFrame([(f"file://{f}", 0)], "uri string, offset long")).collect()
    assert [r["value"] for r in first] == ["one"]
    known = spark.createDataFrame([(first[0]["uri"], first[0]["offset"], first[0]["inode"], first[0]["head"], first[0]["crc"])], "uri string, offset long, inode long, head long, crc long")
    write(f, "two\n")
    assert [r["value"] for r in files.tail_lines(known).collect()] == ["two"]
    os.rename(f, f + ".old")
    write(f, '{"new":111111}\nmore\n')
    assert [r["value"] for r in files.tail_lines(known).collect()] == ['{"new":111111}', "more"]
