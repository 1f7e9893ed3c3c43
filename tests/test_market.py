"""Market operators: micro-cases by hand, differential tests, and every query against its SQL on the smallest tables."""

import math
import os
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemill import catalog
from tidemill.functions import clean
from tidemill.operators import asof, bars, book, events, features, model, onset, rules
from tidemill.plans.registry import same_rounding


def frames_equal(a: pd.DataFrame, b: pd.DataFrame) -> bool:
    def plain(x: pd.DataFrame) -> pd.DataFrame:
        out = x[sorted(x.columns)].copy()
        for col in out:
            kind = out[col].dtype
            if kind.kind in "iuf" or str(kind).startswith("Int"):
                out[col] = out[col].astype("float").map(lambda v: "" if pd.isna(v) else f"{v + 0.0:.5f}")
            else:
                out[col] = out[col].map(lambda v: "" if v is None or (not isinstance(v, list | np.ndarray) and pd.isna(v)) else str(v))
        return out.sort_values(list(out.columns)).reset_index(drop=True)

    return plain(a).equals(plain(b))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SMALL).toPandas()
    want = duck.sql(catalog.oracle_sql()[name]).df()
    assert set(got.columns) == set(want.columns)
    assert len(got) == len(want)
    assert frames_equal(got, want)


def test_latest_version_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("a", 1, 100.0, 5, 1), ("a", 1, 200.0, 5, 2)], "symbol string, ts int, open double, ingested_at int, id int")
    assert bars.latest(df).first()["open"] == 200.0


def test_walk_by_notional_and_quantity(spark):
    df = spark.sql("SELECT array(struct(100D AS price, 1D AS size), struct(101D AS price, 2D AS size), struct(102D AS price, 5D AS size)) AS asks, array(struct(0.31D AS price, 5D AS size), struct(0.32D AS price, 20D AS size)) AS q")
    r = df.select(book.walk_notional(F.col("asks"), 150.0).alias("a"), book.walk_notional(F.col("asks"), 10_000.0).alias("b"), book.walk_quantity(F.col("q"), 10.0).alias("c"), book.walk_quantity(F.col("q"), 30.0).alias("d")).first()
    assert r["a"]["filled"] and math.isclose(r["a"]["avg_px"], 150 / (1 + 50 / 101))
    assert not r["b"]["filled"] and r["b"]["usd"] == 812.0
    assert math.isclose(r["c"], 0.315) and r["d"] is None


def test_interpolation_needs_both_neighbours(spark):
    s = spark.createDataFrame([(1, 0, 0, 100.0), (1, 10, 1, 110.0)], "token long, t long, seq long, mid double")
    p = spark.createDataFrame([(1, 5, 0), (1, 11, 1), (1, -1, 2), (1, 10, 3)], "token long, t long, seq long")
    got = {r["t"]: r["at"] for r in asof.interpolated(p, s, "mid").collect()}
    assert got == {5: 105.0, 11: None, -1: None, 10: 110.0}


def test_single_slot_trace(spark):
    df = spark.createDataFrame([("a", i, 1) for i in (0, 1, 5, 6, 7)], "symbol string, i long, cell_id long")
    got = {r["i"]: r["reason"] for r in onset.single_slot(df, 5, 2).collect()}
    assert got == {0: "taken", 1: "in_position", 5: "buffer", 6: "buffer", 7: "taken"}


def test_one_token_with_most_rows(spark):
    """A token that holds nine tenths of the rows: as-of, sums and cooldown against plain loops."""
    import bisect

    rng = np.random.default_rng(4)
    n = 4000
    rows = [(1 if rng.random() < 0.9 else int(rng.integers(2, 6)), int(t), i, float(rng.integers(1, 100)), 1.0) for i, t in enumerate(np.sort(rng.integers(0, 5 * 86_400_000, n)))]
    right = spark.createDataFrame(rows, "token long, t long, seq long, price double, size double")
    points = [(int(rng.integers(1, 6)), int(rng.integers(-1000, 5 * 86_400_000)), i) for i in range(300)]
    left = spark.createDataFrame(points, "token long, t long, seq long")
    by = {}
    for k, t, s, p, _ in rows:
        by.setdefault(k, []).append((t, s, p))
    back = {r["seq"]: r["price"] for r in asof.asof(left, right, ["price"]).collect()}
    ahead = {r["seq"]: r["price"] for r in asof.asof(left, right, ["price"], forward=True).collect()}
    sums = {r["seq"]: r["q"] for r in asof.trailing_sums(left, right, {"q": F.col("size")}, 7_200_000).collect()}
    for k, t, s in points:
        own = by.get(k, [])
        i = bisect.bisect_right(own, (t, n, 0))
        assert back[s] == (own[i - 1][2] if i else None)
        j = bisect.bisect_left(own, (t, -1, 0))
        assert ahead[s] == (own[j][2] if j < len(own) else None)
        assert sums[s] == sum(t - 7_200_000 < x[0] <= t for x in own)
    want, last = set(), {}
    for k, t, s, *_ in rows:
        if k not in last or t - last[k] >= 600_000:
            want.add(s)
            last[k] = t
    assert {r["seq"] for r in onset.spaced(right, 600_000, ["token"]).collect()} == want


def test_ewm_equals_pandas(spark):
    rng = np.random.default_rng(3)
    x = [None if rng.random() < 0.2 else float(v) for v in rng.normal(size=300)]
    df = spark.createDataFrame([("a", datetime(2024, 1, 1) + timedelta(hours=7 * i), v) for i, v in enumerate([None, None, *x])], "symbol string, ts timestamp_ntz, x double")
    got = [r["m"] for r in features.ewm(df, "x", 10, "m", chunk_seconds=86_400).orderBy("ts").collect()]
    want = pd.Series([v for v in x if v is not None]).ewm(span=10, adjust=False).mean().tolist()
    seen = -1
    for v, m in zip([None, None, *x], got):
        seen += v is not None
        assert (m is None) == (seen < 1) and (m is None or math.isclose(m, want[seen], rel_tol=1e-9, abs_tol=1e-12))


def test_cooldown_is_greedy(spark):
    df = spark.createDataFrame([(1, t, t) for t in (0, 10, 20, 25, 40)], "token long, t long, seq long")
    assert sorted(r["t"] for r in onset.spaced(df, 20, ["token"]).collect()) == [0, 20, 40]


def test_robust_reference(spark):
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate((0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.0))], "token long, t long, price double")
    ref, noise = events.robust("price", "token", ("t",))
    rows = {r["t"]: r for r in df.select("t", ref.alias("ref"), noise.alias("noise")).collect()}
    assert math.isclose(rows[7]["ref"], 0.5) and math.isclose(rows[7]["noise"], 0.3)
    assert rows[4]["ref"] is None


def test_time_to_strike(spark):
    got = spark.createDataFrame([(0,), (13,), (14,)], "m int").select(features.time_to_strike(F.col("m")).alias("t")).collect()
    assert [r["t"] for r in got] == [14, 1, 15]


def test_chunked_decile_equals_pandas(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 9, 700).astype(float)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)], "symbol string, ts long, v double")
    pct = pd.Series(x).rolling(100, min_periods=50).rank(pct=True)
    want = [None if math.isnan(p) else min(9, int(p * 10 + 1e-9)) + 1 for p in pct]
    got = rules.decile_chunked(df, "v", 100, 50, chunk=60, bucket=F.floor(F.col("ts") / 90)).orderBy("ts").collect()
    assert [r["decile"] for r in got] == want


def test_share_above_is_strict_or_not(spark):
    pool = spark.createDataFrame([("a", z) for z in (1.0, 2.0, 2.0, 3.0)], "k string, z double")
    rows = spark.createDataFrame([("a", 2.0), ("a", 0.0)], "k string, x double")
    strict = {r["x"]: r["share"] for r in model.share_above(rows, pool, "k", "x", "z").collect()}
    loose = {r["x"]: r["share"] for r in model.share_above(rows, pool, "k", "x", "z", False).collect()}
    assert strict == {2.0: 0.25, 0.0: 1.0} and loose == {2.0: 0.75, 0.0: 1.0}


def test_division_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, 0.0), (float("nan"), 2.0)], "a double, b double")
    got = clean.nan_to_null(df).select(clean.ratio(F.col("a"), F.col("b")).alias("r"), clean.floor_at(F.col("a"), 5.0).alias("f")).collect()
    assert [(r["r"], r["f"]) for r in got] == [(None, 5.0), (None, None)]


def test_rounding_in_sql_is_rewritten_inside_out():
    assert same_rounding("round(a + round(b, 2), 4)") == "(floor((a + (floor((b) * 1e2 + 0.5) / 1e2)) * 1e4 + 0.5) / 1e4)"


def test_repartitioning_changes_nothing(spark):
    from tidemill.sources import views as V

    t, f = V.trades(spark, SMALL), V.fires(spark, SMALL)
    a = asof.asof(f, t, ["price"]).toPandas()
    b = asof.asof(f.repartition(7), t.repartition(5), ["price"]).toPandas()
    assert frames_equal(a, b)


def test_plans_read_only_the_columns_they_need(spark):
    plan = catalog.queries()["agg02_by_group"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[-1]


def test_entry_imports_without_a_session_and_without_the_corpus_operators(tmp_path):
    import shutil
    import subprocess
    import sys

    from tests.conftest import ROOT

    shutil.copytree(ROOT / "tidemill", tmp_path / "tidemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_names(spark):
    """Words and similarity of club names, by hand."""
    from difflib import SequenceMatcher

    from tidemill.operators import text

    df = spark.createDataFrame([("abcd", "bcde"), (None, "x")], "a string, b string")
    got = df.select(text.sequence_ratio("a", "b").alias("r"), text.words(F.lit("Olympique de Lyon FC 1899, \u00c9t\u00e9 \u0160k\u014fda")).alias("w")).collect()
    assert got[0]["r"] == 0.75 and got[1]["r"] is None and got[0]["w"] == ["ete", "lyon", "olympique", "skoda"]
    pairs = spark.createDataFrame([("FC Internazionale Milano", "Inter Milano"), ("Real Betis Balompie", "Betis"), ("FC", "AC"), ("A B", "a b c")], "a string, b string")
    got = [r["s"] for r in pairs.select(text.similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    ratio = lambda x, y: SequenceMatcher(None, x, y).ratio()
    want = [100 / 2 + 10 + ratio("internazionale milano", "inter milano"), 100 + 10 + ratio("betis real", "betis"), 0, 100 + 20 + ratio("a b", "a b c")]
    assert all(math.isclose(a, b) for a, b in zip(got, want))


def test_clocks_and_minutes(spark):
    from tidemill.operators import text

    clocks = [("45+2'", 45), ("90+4", 90), ("HT", None), ("121", None), ("7\u2032", 7), (" 12 ", 12), ("45+123", None), ("", None), (None, None)]
    df = spark.createDataFrame(clocks, "clock string, want int")
    assert all(r["got"] == r["want"] for r in df.select("want", text.minute_hint(F.col("clock")).alias("got")).collect())
    rows = [(1, 100.0, "inprogress", 160_000, 1.0), (2, 100.0, "inprogress", 160_000, 46.0), (1, 100.0, "finished", 160_000, None), (3, 100.0, "inprogress", 160_000, None), (1, 100.0, "inprogress", 40_000, None), (1, None, "inprogress", 160_000, None)]
    df = spark.createDataFrame(rows, "period int, start double, status string, at long, want double")
    assert all(r["got"] == r["want"] for r in df.select("want", text.match_minute(F.col("period"), F.col("start"), F.col("status"), F.col("at")).alias("got")).collect())


def test_levels_and_settlements(spark):
    from tidemill.operators import text

    rows = spark.createDataFrame([("0.5", "3", True, False), ("1", "0", True, True), ("1.01", "1", False, None), ("0.5", "-1", False, None), ("NaN", "1", False, None), (None, "1", False, None)], "p string, q string, ok boolean, deletion boolean")
    for r in rows.select("*", text.level(F.col("p"), F.col("q")).alias("v")).collect():
        assert (r["v"] is not None) == r["ok"] and (r["v"] is None or r["v"]["deletion"] == r["deletion"])
    cases = [('["Yes","No"]', '["1","0"]', True, "resolved", (1, "resolved")), ('["No","Yes"]', '["1","0"]', True, "resolved", (0, "resolved")), ('["Yes","No"]', '["0.5","0.5"]', True, "resolved", (None, "non_binary_resolution")), ('["Yes","No"]', '["1","0"]', False, "resolved", None), ('["Up","Down"]', '["1","0"]', True, "resolved", None), ('["Yes","No"]', '["1","0"]', True, "proposed", None)]
    df = spark.createDataFrame([(i, *x[:4]) for i, x in enumerate(cases)], "i int, o string, p string, closed boolean, st string")
    for r in df.select("i", text.settlement(F.col("o"), F.col("p"), F.col("closed"), F.col("st")).alias("s")).collect():
        assert (tuple(r["s"]) if r["s"] else None) == cases[r["i"]][4]
