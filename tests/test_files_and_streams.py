"""File sources and sinks, and streams against their batch twins."""

import gzip
import zipfile

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemill.operators import onset
from tidemill.sources import files, sinks
from tidemill.sources import views as V
from tidemill.streaming import live

LINE = "{t},1.0,2.0,0.5,1.5,10,{t2},15,3,4,6,0"


def test_kline_csv_zip_and_headers(spark, tmp_path):
    lines = ["open_time,open,high,low,close,volume,close_time,q,n,tb,tq,ignore", LINE.format(t=1704067200000, t2=1), LINE.format(t=1704067260000000, t2=1), "bad,line", "", "1704067320000,x"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    got = files.csv_window(spark, str(tmp_path / "a.csv"), "2024-01-01 00:00:00", "2024-01-02 00:00:00").orderBy("ts").collect()
    assert [str(r["ts"]) for r in got] == ["2024-01-01 00:00:00", "2024-01-01 00:01:00"] and got[0]["num_trades"] == 3
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("b.txt", "no")
        z.writestr("a.csv", "﻿" + "\n".join(lines))
    assert files.klines_of_lines(files.zip_lines(spark, str(tmp_path))).count() == 2


def test_exchange_payloads_and_messages(spark):
    one = spark.createDataFrame([('[[1704067200000,"1","2","0.5","1.5","10"]]',)], "value string")
    assert files.klines_of_json(one).first()["close"] == 1.5
    two = spark.createDataFrame([("[[1704067200, 0.5, 2, 1, 1.5, 10]]",)], "value string")
    r = files.candles_of_json(two).first()
    assert (r["open"], r["high"], r["low"], r["close"]) == (1.0, 2.0, 0.5, 1.5)
    wire = spark.createDataFrame([(1, '{"event_type":"price_change","asset_id":"A","changes":[{"price":"0.5","size":"3","side":"BUY"}]}'), (2, '[{"event_type":"price_change","price_changes":[{"asset_id":"B","price":"x","size":"1"}]},{"event_type":"last_trade_price","asset_id":"C","price":"0.7"}]')], "r int, m string")
    rows = {(x["r"], x["frame_index"], x["event_type"], x["asset_id"]): x["price"] for x in files.demux(wire).collect()}
    assert set(rows) == {(1, 0, "price_change", "A"), (2, 0, "price_change", "B"), (2, 1, "last_trade_price", "C")}
    assert rows[(2, 0, "price_change", "B")] is None


def test_json_lines_with_a_torn_end(spark, tmp_path):
    with gzip.open(tmp_path / "x.jsonl.gz", "wt") as f:
        f.write('{"a": 1}\n{"a": 2}\n{"a": ')
    assert sorted(r["a"] for r in files.json_lines(spark, str(tmp_path), "a int").collect()) == [1, 2]


def test_sinks(spark, tmp_path):
    bars = V.bars_1h(spark, SMALL).limit(20)
    for _ in range(2):
        files.append_bars(bars, str(tmp_path / "bars"))
    assert spark.read.parquet(str(tmp_path / "bars")).count() == 40
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id int, body string")
    for _ in range(2):
        kept = sinks.payload_store(rows, "body", str(tmp_path / "store"))
    assert kept.select("digest").distinct().count() == 2 and spark.read.parquet(str(tmp_path / "store")).count() == 2
    sinks.write_merged_csv([rows, rows], str(tmp_path / "csv"), {"twice": F.col("id") * 2}, "id")
    got = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert got.count() == 6 and all(int(r["twice"]) == 2 * int(r["id"]) for r in got.collect())


def test_backups_are_checked_by_prefix(spark, tmp_path):
    for name, body in (("a/x", b"abc"), ("a/y", b"12345"), ("z", b"q"), ("w", b"ww")):
        (tmp_path / "src" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "src" / name).write_bytes(body)
    wanted = sinks.manifest(spark, str(tmp_path / "src")).cache()
    assert {r["name"]: r["length"] for r in wanted.collect()} == {"a/x": 3, "a/y": 5, "z": 1, "w": 2}
    (tmp_path / "copy" / "a").mkdir(parents=True)
    (tmp_path / "copy" / "a" / "x").write_bytes(b"abcdef")  # grown since
    (tmp_path / "copy" / "a" / "y").write_bytes(b"1234")
    (tmp_path / "copy" / "w").write_bytes(b"wv")
    assert {r["name"]: r["status"] for r in sinks.verified(wanted, str(tmp_path / "copy")).collect()} == {"a/x": "ok", "a/y": "short", "z": "missing", "w": "changed"}


def test_state_and_notifications(spark, tmp_path):
    path = str(tmp_path / "state")
    assert sinks.get_state(spark, path, "a") is None
    sinks.set_state(spark, path, {"a": "1", "b": "2"}, 1)
    sinks.set_state(spark, path, {"a": None}, 2)
    assert sinks.get_state(spark, path, "a") is None and sinks.get_state(spark, path, "b") == "2" and sinks.get_state(spark, path, "c") is None
    out = tmp_path / "sent"
    out.mkdir()

    def send(text, to=str(out)):
        import uuid

        with open(f"{to}/{uuid.uuid4().hex}", "w") as f:
            f.write(text)

    sinks.notified(spark.createDataFrame([("x",), ("y",)], "message string"), send)
    assert sorted(f.read_text() for f in out.iterdir()) == ["x", "y"]


def test_tail_stops_before_an_incomplete_line(spark, tmp_path):
    f = tmp_path / "log.jsonl"
    f.write_bytes(b'{"a":1}\n{"a":2}\n{"a"')
    read = lambda offset: [(r["value"], r["offset"]) for r in files.tail_lines(spark.createDataFrame([(f"file://{f}", offset)], "uri string, offset long")).collect()]
    assert read(0) == [('{"a":1}', 8), ('{"a":2}', 16)]
    f.write_bytes(f.read_bytes() + b":3}\n")
    assert read(16) == [('{"a":3}', 24)] and read(24) == []
    f.write_bytes(b"new\n")
    assert read(24) == [("new", 4)]


def test_cooldown_stream_equals_batch(spark, tmp_path):
    fires = V.fires(spark, SMALL).select("token", "t", "seq", F.timestamp_millis("t").alias("ts")).orderBy("t")
    n = fires.count()
    fires.limit(n // 2).coalesce(1).write.parquet(str(tmp_path / "in"))
    fires.offset(n // 2).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.event_stream(spark, str(tmp_path / "in"), "token long, t long, seq long, ts timestamp", 10)
    live.run_once(live.cooldown(stream, 8 * 3_600_000), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {(r["token"], r["seq"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r["token"], r["seq"]) for r in onset.spaced(fires, 8 * 3_600_000, ["token"]).collect()}
    assert got == want


def test_tumbling_bars_equal_batch(spark, tmp_path):
    ev = V.events(spark, SMALL).withColumn("ts", F.col("ts").cast("timestamp"))
    ev.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = live.event_stream(spark, str(tmp_path / "in"), ev._jdf.schema().toDDL())
    live.run_once(live.tumbling_bars(stream, "1 hour", "0 seconds"), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {(str(r["ts"]), r["event_type"]): (r["open"], r["close"], r["n"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    at = F.struct("ts", "event_id")
    batch = ev.groupBy(F.date_trunc("hour", "ts").alias("h"), "event_type").agg(F.min_by("value", at).alias("open"), F.max_by("value", at).alias("close"), F.count(F.lit(1)).alias("n")).collect()
    want = {(str(r["h"]), r["event_type"]): (r["open"], r["close"], r["n"]) for r in batch}
    assert got and all(want[k] == v for k, v in got.items()) and len(got) >= len(want) - 5  # the last window is still open


def test_confirmation_stream(spark, tmp_path):
    spark.sql("SELECT 1L AS token, timestamp'2024-01-01 00:00:00' AS fire_ts").write.parquet(str(tmp_path / "f"))
    spark.sql("SELECT 1L AS token, explode(array(timestamp'2024-01-01 00:01:00', timestamp'2024-01-01 00:01:01', timestamp'2023-12-31 23:59:00')) AS trade_ts").write.parquet(str(tmp_path / "t"))
    f = live.event_stream(spark, str(tmp_path / "f"), "token long, fire_ts timestamp")
    t = live.event_stream(spark, str(tmp_path / "t"), "token long, trade_ts timestamp")
    live.run_once(live.confirmations(f, t), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(str(r["trade_ts"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["2023-12-31 23:59:00", "2024-01-01 00:01:00"]


def in_two_files(df, path):
    n = df.count()
    df.limit(n // 2).coalesce(1).write.parquet(str(path))
    df.offset(n // 2).coalesce(1).write.mode("append").parquet(str(path))


def test_slots_equal_batch_across_triggers(spark, tmp_path):
    firings = spark.createDataFrame([("a", i * 3 % 50 + i // 17 * 50, i % 3) for i in range(60)], "symbol string, i long, cell_id long").orderBy("i", "cell_id")
    in_two_files(firings, tmp_path / "f")
    for _ in range(2):  # a run that is started again goes on from its checkpoint
        live.run_once(live.positions(live.event_stream(spark, str(tmp_path / "f"), "symbol string, i long, cell_id long"), 10, 2), str(tmp_path / "fo"), str(tmp_path / "fc"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "fo")).select("symbol", "i", "cell_id", "reason").collect())
    assert got == sorted(tuple(r) for r in onset.single_slot(firings, 10, 2).collect())


def test_candidates_end_once(spark, tmp_path):
    at = "timestamp_millis(t) AS ts"
    cand = spark.createDataFrame([(1, 1, 1_000), (1, 2, 100_000), (1, 3, 900_000), (2, 4, 1_000)], "token long, seq long, t long").selectExpr("token", "seq", "t", at)
    conf = spark.createDataFrame([(1, 61_000), (1, 161_001), (2, 500), (9, 50_000_000)], "token long, t long").selectExpr("token", "t", at)
    cand.coalesce(1).write.parquet(str(tmp_path / "c"))
    conf.coalesce(1).write.parquet(str(tmp_path / "k"))
    out = live.expiring(live.event_stream(spark, str(tmp_path / "c"), "token long, seq long, t long, ts timestamp"), live.event_stream(spark, str(tmp_path / "k"), "token long, t long, ts timestamp"), 60_000, "1 second")
    live.run_once(out, str(tmp_path / "out"), str(tmp_path / "cp"))
    spark.createDataFrame([(9, 90_000_000)], "token long, t long").selectExpr("token", "t", at).coalesce(1).write.mode("append").parquet(str(tmp_path / "k"))
    live.run_once(out, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r["seq"], r["result"], r["at"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, "confirmed", 61_000), (2, "expired", 160_000), (3, "expired", 960_000), (4, "expired", 61_000)]
