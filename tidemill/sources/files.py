"""File sources: CSV layouts with and without headers, zipped CSV, JSON lines with torn ends, exchange payloads; sinks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources import tails

#: The columns of a raw kline line, in order; a thirteenth, the time as text, may follow.
KLINE = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_asset_volume", "num_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "ignore")


def millis_of(x: Column) -> Column:
    """FN-20: an epoch in seconds, milliseconds or microseconds, told by its size, in milliseconds."""
    return F.when(x > 10**15, F.floor(x / 1000)).when(x < 10**11, x * 1000).otherwise(x).cast("bigint")


def is_header(line: Column) -> Column:
    """FN-21: a line whose first field is no number."""
    return ~F.split(F.ltrim(line), ",")[0].rlike(r"^﻿?\s*\d+(\.\d+)?\s*$")


def klines_of_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """SRC-05, FN-22: typed bars of kline lines; headers, short and unreadable lines are dropped."""
    parts = F.split(F.regexp_replace(F.trim(line), "^﻿", ""), ",")
    rows = lines.where(F.col(line).isNotNull() & (F.length(F.trim(line)) > 0) & ~is_header(F.col(line))).select(parts.alias("p")).where(F.size("p") >= 12)
    number = lambda i, t: F.col("p")[i].try_cast(t)
    bars = rows.select(F.timestamp_millis(millis_of(number(0, "double"))).cast("timestamp_ntz").alias("ts"), *[number(i, "double").alias(KLINE[i]) for i in (1, 2, 3, 4, 5)], number(7, "double").alias(KLINE[7]), number(8, "bigint").alias(KLINE[8]), number(9, "double").alias(KLINE[9]), number(10, "double").alias(KLINE[10]))
    return bars.where(F.col("ts").isNotNull() & F.col("close").isNotNull())


def csv_window(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """SRC-04: bars of CSV files from start to before end; the scan splits files as it likes."""
    bars = klines_of_lines(spark.read.text(path))
    return bars.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            fs, path = pafs.FileSystem.from_uri(uri)
            with fs.open_input_file(path) as raw, zipfile.ZipFile(raw) as z:
                names = [n for n in sorted(z.namelist()) if n.lower().endswith(".csv")]
                if not names:
                    continue
                with z.open(names[0]) as f:
                    lines = io.TextIOWrapper(f, "utf-8-sig")
                    while some := lines.readlines(1 << 20):
                        yield pa.RecordBatch.from_arrays([pa.array([x.rstrip("\r\n") for x in some])], ["value"])


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-06: lines of the first CSV of each zip file, a byte-order mark removed; a file is streamed in a task of its own, whatever
    its size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    return files.repartition(F.col("path")).mapInArrow(_unzip, "value string")


def klines_of_json(payload: DataFrame, column: str = "value") -> DataFrame:
    """SRC-07: rows of a REST reply [[time, o, h, l, c, v, close time, quote volume, trades, taker base, taker quote, ...], ...]; fields
    that a reply leaves out are NULL. Ordered by time where it matters, not here."""
    rows = payload.select(F.explode(F.from_json(column, "array<array<string>>")).alias("r"))
    return rows.select(F.timestamp_millis(F.col("r")[0].cast("bigint")).cast("timestamp_ntz").alias("ts"), *[F.get("r", F.lit(i)).try_cast("bigint" if n in ("close_time", "num_trades") else "double").alias(n) for i, n in enumerate(KLINE[:11]) if i])


def candles_of_json(payload: DataFrame, column: str = "value") -> DataFrame:
    """SRC-08: rows [time, low, high, open, close, volume], the other exchange's field order."""
    rows = payload.select(F.explode(F.from_json(column, "array<array<double>>")).alias("r"))
    return rows.select(F.timestamp_seconds(F.col("r")[0]).cast("timestamp_ntz").alias("ts"), F.col("r")[3].alias("open"), F.col("r")[2].alias("high"), F.col("r")[1].alias("low"), F.col("r")[4].alias("close"), F.col("r")[5].alias("volume"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-18/19: JSON lines, gzip or plain; torn and unreadable lines are dropped."""
    kept = spark.read.text(path).select(F.from_json("value", schema + ", _torn string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_torn"}).alias("j"))
    return kept.where("j IS NOT NULL AND j._torn IS NULL").select("j.*").drop("_torn")


def demux(messages: DataFrame, column: str = "m") -> DataFrame:
    """SRC-13: messages, one object or an array, as rows (frame_index, event_type, asset_id, price, size, side); both shapes
    of price changes - a list with ids of its own, or one with the message's id - give the same rows."""
    change = "asset_id: string, price: string, size: string, side: string"
    kind = f"array<struct<event_type: string, asset_id: string, price: string, size: string, side: string, price_changes: array<struct<{change}>>, changes: array<struct<{change}>>>>"
    text = F.when(F.ltrim(column).startswith("["), F.col(column)).otherwise(F.concat(F.lit("["), F.col(column), F.lit("]")))
    rows = messages.select("*", F.posexplode(F.from_json(text, kind)).alias("frame_index", "x"))
    own = F.array(F.struct(F.col("x.asset_id").alias("asset_id"), F.col("x.price").alias("price"), F.col("x.size").alias("size"), F.col("x.side").alias("side")))
    each = rows.withColumn("y", F.explode(F.coalesce("x.price_changes", "x.changes", own)))
    number = lambda n: F.col(f"y.{n}").try_cast("decimal(20,6)").alias(n)
    return each.select(*messages.columns, "frame_index", F.col("x.event_type").alias("event_type"), F.coalesce("y.asset_id", "x.asset_id").alias("asset_id"), number("price"), number("size"), F.col("y.side").alias("side"))


def append_bars(bars: DataFrame, path: str) -> None:
    """SNK-01: bars appended with the time of ingest, partitioned by day; repeats are allowed, latest() picks."""
    bars.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz")).withColumn("day", F.to_date("ts")).write.mode("append").partitionBy("day").parquet(path)


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["inode", "head", "crc"]
    for batch in batches:
        for uri, begin, *known in zip(*(batch.column(i).to_pylist() for i in range(5))):
            fs, path = pafs.FileSystem.from_uri(uri)
            with fs.open_input_file(path) as f:
                size, left = f.size(), b""
                kept = known[0] is None or tails.same(uri, {**dict(zip(names, known)), "offset": begin}, size)
                at = begin if kept and begin <= size else 0  # another file has taken its place
                own = tails.who(uri, size)
                f.seek(at)
                while some := f.read(1 << 20):
                    lines = (left + some).split(b"\n")
                    left = lines.pop()
                    ends = []
                    for x in lines:
                        at += len(x) + 1
                        ends.append(at)
                    n = len(lines)
                    yield pa.RecordBatch.from_arrays([pa.array([uri] * n, pa.string()), pa.array([x.decode("utf-8", "replace") for x in lines], pa.string()), pa.array(ends, pa.int64()), *(pa.array([own[k]] * n, pa.int64()) for k in names)], ["uri", "value", "offset", *names])


def tail_lines(files: DataFrame) -> DataFrame:
    """SRC-20, as a batch: of files(uri, offset) the lines that end after their offset, never past an incomplete one: uri, value, offset
    (where the line ends, from which the next reading goes on), and inode, head, crc, which tell the file from one in its place. A
    file that is not the one these say (where given, in columns of these names), or is shorter than its offset, is read from its
    beginning. Streams are in tails.py."""
    known = [c_long(k) if k in files.columns else F.lit(None).cast("long").alias(k) for k in ("inode", "head", "crc")]
    rows = files.select("uri", c_long("offset"), *known).repartition(F.col("uri"))
    return rows.mapInArrow(_tails, "uri string, value string, offset long, inode long, head long, crc long")


def c_long(name: str) -> Column:
    return F.col(name).cast("long").alias(name)
