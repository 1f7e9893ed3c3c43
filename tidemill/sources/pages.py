"""Files of kline replies and archives as a partitioned batch source: SRC-06, SRC-07, SRC-09.

    spark.dataSource.register(Klines)
    spark.read.format("klines").option("path", folder).load().where("ts >= TIMESTAMP_NTZ'2024-02-01 00:00:00'")

Each file is a partition: a REST reply (.json: a list of rows, or {"data": rows}), CSV (.csv), or a zip of CSV (.zip, its first
member). Where a file's path states the window of its bars' times - two epochs in milliseconds (1706745600000-1707350400000, the
second not included), a day (2024-02-01) or a month (2024-02) - a filter on ts that lies outside the window drops the file before it
is opened; filters are applied to the rows again behind that.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tidemill.functions.scratch import scratch
from tidemill.plans.registry import query
from tidemill.sources import views as V

#: Columns by their places in a row.
NUMBERS = {"open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "quote_asset_volume": 7, "num_trades": 8, "taker_buy_base_volume": 9, "taker_buy_quote_volume": 10}
SCHEMA = "ts timestamp_ntz, " + ", ".join(f"{n} {'long' if n == 'num_trades' else 'double'}" for n in NUMBERS)
SUFFIXES = (".json", ".csv", ".zip", ".txt")
EPOCHS, DATE = re.compile(r"(?<!\d)(\d{13})-(\d{13})(?!\d)"), re.compile(r"(?<!\d)(\d{4})-(\d{2})(?:-(\d{2}))?(?!\d)")
START = datetime(1970, 1, 1)


def window(path: str) -> tuple[datetime, datetime] | None:
    """The times [from, to) that a path states, by the last part of it that does."""
    if found := EPOCHS.findall(path):
        return tuple(START + timedelta(milliseconds=int(x)) for x in found[-1])
    for year, month, day in reversed(DATE.findall(path)):
        try:
            first = datetime(int(year), int(month), int(day or 1))
        except ValueError:
            continue
        return first, first + timedelta(days=1) if day else datetime(first.year + first.month // 12, first.month % 12 + 1, 1)
    return None


class Page(InputPartition):
    def __init__(self, uri: str) -> None:
        self.uri = uri


def may_hold(span: tuple[datetime, datetime] | None, f: Filter) -> bool:
    """Whether a file of this window can have rows that a filter on ts keeps."""
    if span is None:
        return True
    first, end = span
    if isinstance(f, GreaterThan | GreaterThanOrEqual):
        return end > f.value
    if isinstance(f, LessThan):
        return first < f.value
    if isinstance(f, LessThanOrEqual):
        return first <= f.value
    if isinstance(f, In):
        return any(first <= v < end for v in f.value)
    return first <= f.value < end


def moment(x) -> datetime | None:
    """The time of an epoch in seconds, milliseconds or microseconds, told by its size."""
    try:
        at = float(x)
        ms = at / 1000 if at > 1e15 else at * 1000 if at < 1e11 else at
        return START + timedelta(milliseconds=int(ms))
    except (TypeError, ValueError, OverflowError):
        return None


def number(row: list, i: int, kind: type):
    try:
        return kind(row[i])
    except (IndexError, TypeError, ValueError):
        return None


def rows_of(uri: str) -> Iterator[list]:
    """The rows of a file as it has them."""
    fs, path = pafs.FileSystem.from_uri(uri)
    if path.endswith((".json", ".txt")):
        with fs.open_input_stream(path) as f:
            for line in io.TextIOWrapper(f, "utf-8-sig"):  # a reply is one line
                if line.strip():
                    got = json.loads(line)
                    yield from got.get("data") or [] if isinstance(got, dict) else got
    elif path.endswith(".csv"):
        with fs.open_input_stream(path) as f:
            yield from csv.reader(io.TextIOWrapper(f, "utf-8-sig", errors="replace", newline=""))
    else:
        with fs.open_input_file(path) as f, zipfile.ZipFile(f) as z:
            names = [n for n in sorted(z.namelist()) if n.lower().endswith(".csv")]
            if names:
                with z.open(names[0]) as g:
                    yield from csv.reader(io.TextIOWrapper(g, "utf-8-sig", errors="replace", newline=""))


class KlinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        if not options.get("path"):
            raise ValueError("klines needs the option path")
        self.path, self.filters = options["path"].rstrip("/"), []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual | In) and f.attribute == ("ts",):
                self.filters.append(f)
            yield f  # the rows of the files that are left are filtered by Spark

    def partitions(self) -> list[Page]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        base = self.path[: len(self.path) - len(root)] if self.path.endswith(root) else self.path.split("://")[0] + "://"
        files = sorted(x.path for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.type == pafs.FileType.File and x.path.endswith(SUFFIXES) and x.size)
        left = [p for p in files if all(may_hold(window(p[len(root) :]), f) for f in self.filters)]
        return [Page(base + p) for p in left] or [Page("")]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held)) or [[]] * (1 + len(NUMBERS))
            kinds = [pa.timestamp("us"), *(pa.int64() if n == "num_trades" else pa.float64() for n in NUMBERS)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["ts", *NUMBERS])

        for row in rows_of(partition.uri) if partition.uri else ():
            at, close = moment(row[0] if row else None), number(row, 4, float)
            if at is not None and close is not None:  # headers, short and unreadable rows go
                held.append((at, *(number(row, i, int if n == "num_trades" else float) for n, i in NUMBERS.items())))
                if len(held) >= 1 << 16:
                    yield batch()
                    held = []
        yield batch()


class Klines(DataSource):
    """Option: path, a folder's URI, read with what is below it."""

    @classmethod
    def name(cls) -> str:
        return "klines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> KlinesReader:
        return KlinesReader(dict(self.options))


def klines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-06/07/09: the bars of a folder of replies and archives; filters on ts prune files."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Klines)
    return spark.read.format("klines").option("path", path).load()


@query("src07_kline_pages", V.sql("bars_1h", """SELECT ts, round(open, 4) AS open, round(close, 4) AS close, num_trades, round(taker, 4) AS taker FROM bars_1h
WHERE symbol = 's1' AND ts >= TIMESTAMP '2024-01-10 00:00:00'"""))
def src07_pages(spark: SparkSession, d: str) -> DataFrame:
    """A symbol's bars as replies of a week each, read back from a time on: earlier weeks' files are not opened."""
    folder, week = scratch(spark, "pages"), 7 * 86_400_000
    ms, text = V.millis("ts"), lambda n: F.format_string("%.10f", F.col(n))
    bars = V.bars_1h(spark, d).where("symbol = 's1'")
    row = F.array(ms.cast("string"), text("open"), text("high"), text("low"), text("close"), text("volume"), (ms + 3_599_999).cast("string"), F.lit("0"), F.col("num_trades").cast("string"), text("taker"), F.lit("0"))
    begin = F.floor(ms / week) * week
    pages = bars.groupBy(F.concat(begin.cast("string"), F.lit("-"), (begin + week).cast("string")).alias("window")).agg(F.to_json(F.collect_list(row)).alias("value"))
    pages.write.partitionBy("window").text(folder)
    got = klines(spark, folder).where("ts >= TIMESTAMP_NTZ'2024-01-10 00:00:00'")
    one = lambda n: (F.floor(F.col(n) * 1e4 + 0.5) / 1e4)
    return got.select("ts", one("open").alias("open"), one("close").alias("close"), "num_trades", one("taker_buy_base_volume").alias("taker"))
