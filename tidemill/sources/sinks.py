"""Sinks on plain files: appended versions with a view of the latest, first writers, sequenced and partitioned JSON lines, content
stores, backups checked by prefix, key-value state, notifications.

Parquet has no update in place, so a table is what was appended and a view picks each key's row; writes are whole files named by
Spark's committer, which a lost executor leaves nothing of.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.clean import rounded
from tidemill.functions.scratch import scratch
from tidemill.plans.registry import query
from tidemill.sources import views as V

c = F.col


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows under a path; None where nothing has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append(rows: DataFrame, path: str, partition: list[str] | None = None) -> None:
    """SNK-15: rows as they are, to those that are there."""
    w = rows.write.mode("append")
    (w.partitionBy(*partition) if partition else w).parquet(path)


def save_partitions(rows: DataFrame, path: str, partition: list[str]) -> None:
    """SNK-02: rows in place of those of the same partitions; other partitions stay."""
    rows.repartition(*[c(p) for p in partition]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def put(rows: DataFrame, path: str, version: int) -> None:
    """SNK-03: rows that replace earlier ones of the same key, by a version that grows from write to write."""
    append(rows.withColumn("_version", F.lit(version).cast("long")), path)


def latest_of(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """SNK-03: of each key the row of its last version; of two in one version the greater one."""
    t = spark.read.parquet(path)
    rest = [x for x in t.columns if x not in key and x != "_version"]
    return t.groupBy(*key).agg(F.max(F.struct("_version", *rest)).alias("_r")).select(*key, *[f"_r.{x}" for x in rest])


def completed(results: DataFrame, updates: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """SNK-04: results whose block of columns is filled in by a later update of the same key; what an update leaves NULL stays."""
    late = updates.select(*key, *[c(x).alias(f"_u_{x}") for x in columns])
    return results.join(late, key, "left").select(*[F.coalesce(c(f"_u_{x}"), c(x)).alias(x) if x in columns else c(x) for x in results.columns])


def append_first(rows: DataFrame, path: str, key: list[str], order: list[str]) -> None:
    """SNK-05: rows whose key is not there yet, and of several with one key the first in order."""
    rest = [x for x in rows.columns if x not in key]
    one = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, *[f"_r.{x}" for x in rest])
    there = stored(rows.sparkSession, path)
    append(one if there is None else one.join(there.select(*key), key, "left_anti"), path)


def windows_of(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """SNK-06: of each key the window that all its requests, appended with t_back and t_fwd, widen."""
    return spark.read.parquet(path).groupBy(*key).agg(F.min("t_back").alias("t_back"), F.max("t_fwd").alias("t_fwd"))


def set_state(spark: SparkSession, path: str, values: dict[str, str | None], version: int) -> None:
    """SNK-07: JSON texts by key."""
    put(spark.createDataFrame([Row(k=k, v=v) for k, v in values.items()], "k string, v string"), path, version)


def get_state(spark: SparkSession, path: str, key: str) -> str | None:
    """SNK-07: a key's last text; None for one that was never set or was set to None."""
    if stored(spark, path) is None:
        return None
    row = latest_of(spark, path, ["k"]).where(c("k") == key).first()
    return row["v"] if row else None


def numbered(rows: DataFrame, order: list[str], after: int = 0) -> DataFrame:
    """event_seq from after + 1 on, in the order of the columns: ranges of the order are numbered on their own and counts of the
    ranges before complete the numbers. The ranges are written to a table first, so that both readings of them are of the same."""
    spark = rows.sparkSession
    at = scratch(spark, "ranges")
    rows.repartitionByRange(*[c(x) for x in order]).withColumn("_range", F.spark_partition_id()).write.parquet(at)
    dealt = spark.read.parquet(at)
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.withColumn("_own", own).join(counts.select("_range", before.alias("_before")), "_range").withColumn("event_seq", (c("_own") + c("_before") + after).cast("long")).drop("_range", "_own", "_before")


def write_sequenced(rows: DataFrame, path: str, order: list[str], partition: list[str]) -> int:
    """SNK-08: JSON lines under partition folders, each row with a session-wide number that goes on from what is there; gives the
    last number. The rows are written to a table first, so that numbers hold if a task is repeated."""
    spark = rows.sparkSession
    try:
        last = spark.read.json(path).agg(F.max("event_seq")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = 0
    out = numbered(rows, order, last)
    out.write.mode("append").partitionBy(*partition).json(path)
    return last + out.count()


def append_daily(rows: DataFrame, path: str, ts: str = "ts") -> None:
    """SNK-09: JSON lines in a folder for each day."""
    rows.withColumn("day", F.date_format(ts, "yyyy-MM-dd")).write.mode("append").partitionBy("day").json(path)


def append_hourly(rows: DataFrame, path: str, ts: str = "ts", csv: str | None = None) -> None:
    """SNK-10: the raw rows as gzip JSON lines in a folder for each hour and, with csv, as CSV with a header besides."""
    rows.withColumn("hour", F.date_format(ts, "yyyyMMdd'T'HH")).write.mode("append").option("compression", "gzip").partitionBy("hour").json(path)
    if csv:
        rows.write.mode("append").option("header", True).csv(csv)


def write_merged_csv(parts: list[DataFrame], path: str, derived: dict[str, Column] | None = None, order: str | None = None) -> None:
    """SNK-11: several frames as CSV with a header and derived columns; with an order as ranges of it, file after file."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumns(derived or {})
    out = out.repartitionByRange(order).sortWithinPartitions(order) if order else out
    out.write.mode("overwrite").option("header", True).csv(path)


def payload_store(rows: DataFrame, column: str, path: str) -> DataFrame:
    """SNK-12: payloads once each under their SHA-256, gzip-compressed, those that are there left out; returns the rows with their
    digest."""
    keyed = rows.withColumn("digest", F.sha2(c(column).cast("binary"), 256))
    fresh = keyed.select("digest", column).groupBy("digest").agg(F.first(column).alias(column))
    there = stored(rows.sparkSession, path)
    if there is not None:
        fresh = fresh.join(there.select("digest"), "digest", "left_anti")
    fresh.write.mode("append").option("compression", "gzip").parquet(path)
    return keyed.drop(column)


def _prefix_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for uri, length in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            fs, path = pafs.FileSystem.from_uri(uri)
            sha, left = hashlib.sha256(), length
            with fs.open_input_stream(path) as f:
                while left and (some := f.read(min(left, 1 << 20))):
                    sha.update(some)
                    left -= len(some)
            digests.append(None if left else sha.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(digests, pa.string())], ["name", "length", "digest"])


def listed(spark: SparkSession, path: str) -> DataFrame:
    """uri, name below path, and length of the files under a folder; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(c("path").alias("uri"), "length")
    root = path.split("://", 1)[-1].removeprefix("file:").rstrip("/")
    return files.select("uri", F.expr(f"substring(uri, instr(uri, '{root}') + {len(root) + 1})").alias("name"), "length")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """SNK-13: name, length and SHA-256 of files, streamed a mebibyte at a time: a boundary that later appends don't move."""
    return listed(spark, path).mapInArrow(_prefix_digests, "name string, length long, digest string")


def verified(wanted: DataFrame, path: str) -> DataFrame:
    """SNK-13: each file of a manifest against a copy, by the manifest's length of it: name, status: ok (what follows doesn't
    matter), missing, short or changed."""
    spark = wanted.sparkSession
    j = wanted.join(listed(spark, path).select("name", "uri", c("length").alias("has")), "name", "left")
    found = j.where(c("has") >= c("length")).select("uri", "name", "length").mapInArrow(_prefix_digests, "name string, length long, got string")
    status = F.when(c("has").isNull(), "missing").when(c("has") < c("length"), "short").when(c("got") == c("digest"), "ok").otherwise("changed")
    return j.join(found.select("name", "got"), "name", "left").select("name", status.alias("status"))


def notified(messages: DataFrame, send: Callable[[str], None], column: str = "message") -> None:
    """SNK-14: send for each message, in the tasks; for streams use it in foreachBatch."""

    def each(rows: Iterable[Row]) -> None:
        for r in rows:
            send(r[column])

    messages.select(column).foreachPartition(each)


def snapshot(events: DataFrame, path: str, taken_at: str) -> DataFrame:
    """SNK-16: a listing as JSON lines under its time, and a row of its counts: snapshot, total_events, total_markets."""
    events.write.mode("overwrite").json(f"{path}/snapshot={taken_at}")
    return events.agg(F.lit(taken_at).alias("snapshot"), F.count(F.lit(1)).alias("total_events"), F.coalesce(F.sum(F.greatest(F.size("markets"), F.lit(0))), F.lit(0)).alias("total_markets"))


# Queries: written in two goes, read back.


def _halves(df: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    return df.where(c(on) % 2 == 0), df.where(c(on) % 2 == 1)


@query("snk03_latest_rows", "SELECT o_custkey, max(o_orderkey) FILTER (o_orderkey % 2 = 1) IS NOT NULL AS again, coalesce(arg_max(o_totalprice, (o_totalprice, o_orderkey)) FILTER (o_orderkey % 2 = 1), arg_max(o_totalprice, (o_totalprice, o_orderkey)) FILTER (o_orderkey % 2 = 0)) AS price FROM orders GROUP BY o_custkey")
def snk03(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "rows")
    rows = V.table(spark, d, "orders").select("o_custkey", c("o_totalprice").alias("price"), "o_orderkey")
    for version, half in enumerate(_halves(rows, "o_orderkey")):
        put(half, path, version)
    return latest_of(spark, path, ["o_custkey"]).select("o_custkey", (c("o_orderkey") % 2 == 1).alias("again"), "price")


@query("snk05_first_rows", "SELECT user_id, coalesce(min(event_id) FILTER (event_id % 2 = 0), min(event_id)) AS event_id FROM events GROUP BY user_id")
def snk05_rows(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "first")
    for half in _halves(V.events(spark, d).select("user_id", "event_id"), "event_id"):
        append_first(half, path, ["user_id"], ["event_id"])
    return spark.read.parquet(path)


@query("snk06_stored_windows", V.sql("fires", "SELECT token, t // 86400000 AS epoch, min(t - 60000) AS t_back, max(t + 120000) AS t_fwd FROM fires GROUP BY ALL"))
def snk06_rows(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "windows")
    rows = V.fires(spark, d).select("token", F.floor(c("t") / 86_400_000).alias("epoch"), (c("t") - 60_000).alias("t_back"), (c("t") + 120_000).alias("t_fwd"), "seq")
    for half in _halves(rows, "seq"):
        append(half.drop("seq"), path)
    return windows_of(spark, path, ["token", "epoch"])


@query("snk07_state", """SELECT 'k' || event_id % 10 AS k, CASE WHEN max(event_id) % 7 <> 0 THEN '{"at":' || max(event_id) || '}' END AS v
FROM events GROUP BY event_id % 10""")
def snk07(spark: SparkSession, d: str) -> DataFrame:
    """State set four times, by a quarter of all events each; the last text of each key, NULL where that was none."""
    path = scratch(spark, "state")
    e = V.events(spark, d).select(F.concat(F.lit("k"), (c("event_id") % 10).cast("string")).alias("k"), F.when(c("event_id") % 7 != 0, F.concat(F.lit('{"at":'), c("event_id").cast("string"), F.lit("}"))).alias("v"), "event_id")
    most = e.agg(F.max("event_id")).first()[0]
    for version in range(4):
        one = e.where(F.floor(c("event_id") * 4 / (most + 1)) == version).groupBy("k").agg(F.max_by(F.struct("v"), "event_id").alias("r")).select("k", "r.v")
        put(one, path, version)
    return latest_of(spark, path, ["k"])


@query("snk08_sequenced", "SELECT event_id, CAST(row_number() OVER (ORDER BY event_id % 2, event_id) AS BIGINT) AS event_seq, event_type FROM events")
def snk08(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "lines")
    rows = V.events(spark, d).select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    for half in _halves(rows, "event_id"):
        write_sequenced(half, path, ["event_id"], ["event_type", "day"])
    return spark.read.json(path).select("event_id", "event_seq", "event_type")


@query("snk10_hourly", "SELECT strftime(ts, '%Y%m%dT%H') AS hour, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def snk10(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "hours")
    append_hourly(V.events(spark, d).select("event_id", "ts", "value"), path)
    got = spark.read.option("basePath", path).schema("event_id long, value double, hour string").json(path)
    return rounded(got.groupBy("hour").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), 4)


@query("snk12_payloads", "SELECT CAST(count(DISTINCT html) AS BIGINT) AS payloads, CAST(count(*) AS BIGINT) AS n FROM pages WHERE html IS NOT NULL")
def snk12(spark: SparkSession, d: str) -> DataFrame:
    """Pages stored twice over: each payload is there once."""
    path = scratch(spark, "payloads")
    pages = V.table(spark, d, "pages").where("html IS NOT NULL").select("page_id", "html")
    for half in (pages.where("page_id % 3 < 2"), pages):
        kept = payload_store(half, "html", path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("payloads")).crossJoin(kept.agg(F.count(F.lit(1)).alias("n")))  # a row each


@query("snk16_snapshot", "SELECT 'now' AS snapshot, CAST(count(*) AS BIGINT) AS total_events, CAST(sum(n) AS BIGINT) AS total_markets FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)")
def snk16(spark: SparkSession, d: str) -> DataFrame:
    e = V.table(spark, d, "lineitem").groupBy(c("l_orderkey").alias("id")).agg(F.collect_list(c("l_linenumber").cast("string")).alias("markets"))
    return snapshot(e, scratch(spark, "snapshots"), "now")
