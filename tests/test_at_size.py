"""What larger tables and odd values bring: pairs in runs, equal times, zeros, days without a model."""

import os

import duckdb
import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemill import catalog
from tidemill.operators import events as market_events
from tidemill.operators import names, text


def written(tmp_path, table, rows, columns):
    pd.DataFrame(rows, columns=columns).to_parquet(tmp_path / f"{table}.parquet", coerce_timestamps="us")
    return str(tmp_path)


def test_pairs_of_a_brand_over_several_runs(spark, tmp_path):
    parts = [(k * 7 % 45, f"b{k % 2}", f"t{k % 3}" if k % 11 else None) for k in range(45)]
    d = written(tmp_path, "part", parts, ["p_partkey", "p_brand", "p_type"])
    kinds = lambda a, b: text.F.concat_ws("-", a, b)
    want = sorted((a, b, "-".join(x for x in (s, t) if x)) for a, p, s in parts for b, q, t in parts if p == q and a < b)
    for run in (1, 4, 64):
        out = text.brand_pairs(spark, d, kinds, "kinds", run)
        assert sorted(tuple(r) for r in out.collect()) == want
    # runs of which no key of the first comes before one of the second are never laid out: about half of the pairs of runs
    plan = text.brand_pairs(spark, d, kinds, "kinds", 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "least_a" in plan and "most_b" in plan


def test_sequence_ratio_of_a_brand_over_several_runs(spark, tmp_path):
    parts = [(k, "b", ("OAK", "OAK PIN", "TIN CASE")[k % 3]) for k in range(600)]
    d = written(tmp_path, "part", parts, ["p_partkey", "p_brand", "p_type"])
    out = text.fn24_ratio(spark, d)
    assert out.count() == 600 * 599 // 2 and out.distinct().count() == 600 * 599 // 2
    assert {r["ratio"] for r in out.where("a % 3 = 0 AND b % 3 = 1").select("ratio").distinct().collect()} == {110.6}


def against_sql(spark, d, name):
    """A query's rows and its SQL's, in order, values as texts so that NULL, NaN and infinities are told apart."""
    con = duckdb.connect()
    for f in os.listdir(d):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{d}/{f}'")
    want = con.execute(catalog.oracle_sql()[name])
    columns = [x[0] for x in want.description]
    text = lambda v: f"{v + 0.0:.6f}".replace("-nan", "nan") if isinstance(v, float) else str(v)
    plain = lambda rows: sorted([text(v) for v in r] for r in rows)
    want = plain(want.fetchall())
    assert plain(catalog.queries()[name](spark, d).select(*columns).collect()) == want
    return columns, want


def events(tmp_path, rows):
    """Events of one user from (seconds, type, value)."""
    start = pd.Timestamp("2024-01-01")
    full = [(i, start + pd.Timedelta(microseconds=round(s * 1e6)), 8, kind, value, '{"k": 60}') for i, (s, kind, value) in enumerate(rows)]
    return written(tmp_path, "events", full, ["event_id", "ts", "user_id", "event_type", "value", "props"])


def test_hold_stats_of_entries_at_zero_and_unknown_mids(spark, tmp_path):
    day = 86_400
    d = events(tmp_path, [(0, "error", 0.0), (1, "view", 5.0), (2, "view", 0.0), (day, "error", 0.0), (day + 1, "view", 0.0), (2 * day, "error", 3.0), (2 * day + 1, "view", None), (3 * day, "error", 1e-6), (3 * day + 1, "view", None), (3 * day + 2, "view", 7.5e7), (3 * day + 3, "view", None)])
    columns, rows = against_sql(spark, d, "agg17_hold_stats")
    high, mean = columns.index("mfe_bps"), columns.index("mean_mid")
    assert [r[high] for r in rows] == ["inf", "nan", "None", f"{(7.5e7 / 1e-6 - 1) * 1e4:.6f}"] and rows[2][mean] == "None"


def test_epochs_of_times_next_to_a_boundary(spark, tmp_path):
    near = [0, 0.000499, 0.0005, 0.000501, 899.999499, 899.9995, 899.9999, 299.9996, 900]
    old = [-1_704_067_200 + s for s in (-0.0004, -0.0005, -0.000501, -900, -900.0004, -900.0005, -899.9995, -899.9996)]
    d = events(tmp_path, [(s, "view", 1.0) for s in [*near, *old]])
    columns, rows = against_sql(spark, d, "fn02_epoch_floor")
    at = columns.index("epoch_15m")
    assert [r[at] for r in rows if r[columns.index("event_id")] in ("4", "5", "6")] == ["1704067200", "1704068100", "1704068100"]


def test_shocks_after_a_mid_of_zero(spark, tmp_path):
    mids = [10.0 + i % 7 for i in range(70)]
    mids[10], mids[50] = 0.0, None
    d = events(tmp_path, [(i, "view", m) for i, m in enumerate(mids)])
    columns, rows = against_sql(spark, d, "fn07_z_shock")
    z = {int(r[columns.index("seq")]): r[columns.index("z")] for r in rows}
    assert [i for i in z if z[i] == "nan"] and all(z[i] == "nan" for i in range(12, 30)) and z[11] == "None" and z[30] != "nan"


def test_returns_left_at_zero(spark, tmp_path):
    d = events(tmp_path, [(i, "click", p) for i, p in enumerate([5.0, 0.0, 4.0, None, 0.0, 0.0, 3.0])])
    columns, rows = against_sql(spark, d, "fn12_execution_returns")
    got = {r[columns.index("seq")]: r[columns.index("ret_mid_bps")] for r in rows}
    assert got["0"] == "-10000.000000" and got["1"] == "None"


def test_points_between_rows_of_one_time(spark, tmp_path):
    d = events(tmp_path, [(0, "view", 10.0), (0, "view", 20.0), (1, "error", 1.0), (2, "view", 40.0), (2, "view", 60.0), (2, "view", None), (2, "error", 1.0), (3, "view", None), (4, "error", 1.0), (5, "view", 1.0)])
    columns, rows = against_sql(spark, d, "jn08_interpolated")
    mid = {r[columns.index("seq")]: r[columns.index("btc_mid")] for r in rows}
    assert mid == {"2": "40.000000", "6": "60.000000", "8": "None"}


def test_realised_vol_over_rows_of_one_time_and_zeros(spark, tmp_path):
    hour, day = 3_600, 86_400
    rows = [(i * hour, "view", 10.0 + i % 5) for i in range(14)] + [(i * hour, "view", 20.0 + i % 3) for i in range(0, 14, 2)] + [(13 * hour, "error", 1.0)]
    rows += [(day + i * hour, "view", 0.0 if i == 4 else 5.0 + i) for i in range(14)] + [(day + 13 * hour, "error", 1.0), (day + 13.5 * hour, "error", 1.0), (2 * day, "error", 1.0)]
    rows = [(s + 10, kind, v) for s, kind, v in rows]
    columns, got = against_sql(spark, events(tmp_path, rows), "agg27_realised_vol")
    assert "nan" in {r[columns.index("rv")] for r in got}


def test_artifacts_where_no_day_has_a_model(spark, tmp_path):
    rows = [(h * 3_600 + k, "view", v) for h in range(24 * 8) for k, v in enumerate((0.0, 5.0 + h % 9))]
    assert against_sql(spark, events(tmp_path, rows), "pipe04_artifacts")[1] == []


def test_a_name_is_aligned_only_where_the_ratio_decides(spark):
    rows = [("Alpha", "Alpha Town", "Beta City"), ("Alpha City", "Alpha City Rovers", "Beta City"), ("Real Town", "Real Town", "Town Real"), ("Nord Ost", "Nord West", "Sud West"), ("Gamma", "Alpha", "Beta"), ("United", "East United", "United"), ("2024", "Alpha", "Beta")]
    df = spark.createDataFrame(rows, "who string, home string, away string")
    for least in (60.0, 60.6, 100.0, 110.5):
        h, a = text.similarity(F.col("who"), F.col("home")), text.similarity(F.col("who"), F.col("away"))
        plain = F.when((h != a) & (F.greatest(h, a) >= least), F.when(h > a, "home").otherwise("away"))
        want = sorted((*r[:3], str(r[3])) for r in df.select("who", "home", "away", plain.alias("near")).collect())
        assert sorted((r["who"], r["home"], r["away"], str(r["near"])) for r in names.nearer_team(df, least).collect()) == want
    # questions and teams that come back are judged once: the aligning step reads distinct names, not the rows
    plan = names.fn25_roles(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("sequence_ratio(")
    assert "Aggregate [who#" in plan[at:] and plan.count("sequence_ratio(") == 2


def test_nearest_of_many_events_at_one_time(spark):
    random = np.random.default_rng(5)
    matches = [(f"m{i}", int(random.integers(1, 4)), int(random.integers(1, 4)), int(random.integers(-600, 600)) * 60_000) for i in range(300)]
    feed = [(int(i), int(random.integers(1, 4)), int(random.integers(1, 4)), int(random.integers(-40, 40)) * 900_000) for i in random.permutation(60)]
    want = set()
    for slug, home, away, at in matches:
        near = sorted((abs(start - at), i, h != home) for i, h, a, start in feed if home != away and {h, a} == {home, away} and abs(start - at) <= 10_800_000)
        if home == away:
            want.add((slug, "team_identity_conflict", None, None, None))
        elif not near:
            want.add((slug, "missing", None, None, None))
        elif len(near) > 1 and near[1][0] - near[0][0] <= 1_800_000:
            want.add((slug, "ambiguous", None, None, None))
        else:
            want.add((slug, "matched", near[0][1], near[0][2], near[0][0]))
    assert {x[1] for x in want} == {"team_identity_conflict", "missing", "ambiguous", "matched"}
    found = market_events.resolved_entities(spark.createDataFrame(matches, "slug string, home long, away long, kickoff_ms long"), spark.createDataFrame(feed, "id long, home long, away long, start_ms long"))
    assert {tuple(r) for r in found.collect()} == want
    # a match is not joined with the events near to it
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
