"""Checks, resolution, lifecycle and reports: cases by hand."""

import math

from pyspark.sql import functions as F

from tidemill.operators import checks, events, lifecycle, pipelines

c = F.col
MIN = 60_000


def test_entities_in_either_order_nearest_and_ambiguous(spark):
    matches = spark.createDataFrame([("a", 1, 2, 0), ("b", 1, 3, 0), ("c", None, 2, 0), ("d", 4, 4, 0), ("e", 5, 6, 0), ("f", 7, 8, 0), ("g", 9, 10, 0)], "slug string, home long, away long, kickoff_ms long")
    feed = [(10, 2, 1, 5 * MIN), (11, 1, 2, 50 * MIN), (12, 1, 3, 10 * MIN), (13, 1, 3, -40 * MIN), (14, 5, 6, 181 * MIN), (15, 7, 8, -180 * MIN), (16, 9, 10, 0), (17, 10, 9, 31 * MIN)]
    got = {r["slug"]: (r["status"], r["id"], r["swapped"], r["delta_ms"]) for r in events.resolved_entities(matches, spark.createDataFrame(feed, "id long, home long, away long, start_ms long")).collect()}
    none = (None, None, None)
    assert got == {
        "a": ("matched", 10, True, 5 * MIN),  # the sides swapped; the runner-up is 45 minutes farther off
        "b": ("ambiguous", *none),  # 10 and 40 minutes off: half an hour apart
        "c": ("team_not_whitelisted", *none),
        "d": ("team_identity_conflict", *none),
        "e": ("missing", *none),  # more than three hours
        "f": ("matched", 15, False, 180 * MIN),  # exactly three
        "g": ("matched", 16, False, 0),
    }


def test_entities_by_names(spark):
    games = spark.createDataFrame([("x", "LA Clippers", "Hawks"), ("y", "Heat", "Nets"), ("z", "Bulls", "Jazz")], "slug string, a string, b string")
    feed = spark.createDataFrame([(1, "Hawks", "Clippers"), (2, "Bulls", "Jazz"), (3, "Jazz", "Bulls")], "id long, home string, away string")
    got = {r["slug"]: (r["status"], r["id"], r["a_home"]) for r in events.named_entities(games, feed, {"LA Clippers": "Clippers"}).collect()}
    assert got == {"x": ("matched", 1, False), "y": ("missing", None, None), "z": ("ambiguous", None, None)}


def test_collection_ends(spark):
    rows = [("expired", 0, 9, None, None, False, None, 9, "no_feed_or_close"), ("late close", 0, None, 100, 9_000_000, True, 5, 9_000_000, "finished_and_closed"), ("early close", 0, None, 100, 50, True, 5, 100 + 30 * MIN, "finished_and_closed"), ("no evidence", 7, None, None, None, False, None, 7 + 240 * MIN, "no_feed_or_close"), ("score seen", 7, None, None, None, False, 8, None, None), ("one book closed", 7, None, None, None, True, None, None, None)]
    df = spark.createDataFrame(rows, "name string, k long, x long, ft long, cl long, any boolean, s long, end long, why string")
    for r in df.select("*", events.collection_end(c("k"), c("x"), c("ft"), c("cl"), c("any"), c("s")).alias("e")).collect():
        assert (r["e"]["end_ms"], r["e"]["reason"]) == (r["end"], r["why"]) if r["why"] else r["e"] is None, r["name"]


def test_implied_directions(spark):
    cases = [("home", "away", 1, None, -1), ("home", "away", -1, None, 1), ("home", "draw", 1, 0, -1), ("home", "draw", 1, -1, 1), ("away", "draw", 1, 1, 1), ("home", "draw", 1, None, None), ("draw", "home", -1, 0, 0), ("draw", "home", 1, -1, 1), ("draw", "home", -1, 1, 1), ("draw", "away", -1, 1, -1), ("draw", "away", 1, None, None)]
    df = spark.createDataFrame(cases, "role string, other string, direction int, lead int, want int")
    assert all(r["got"] == r["want"] for r in df.select("want", checks.implied_direction(c("role"), c("other"), c("direction"), c("lead")).alias("got")).collect())


def test_sentinel_and_feed_states(spark):
    rows = [("ok", False, False, 3.0, None), ("ok", False, False, 30.0, None), ("ok", False, False, 30.1, "primary_observation_expired"), ("ok", False, False, -1.0, "primary_observation_expired"), ("ok", False, False, None, "primary_observation_expired"), ("ok", True, False, 3.0, "primary_missing_or_stale_score"), ("backoff", True, False, 3.0, "primary_backoff"), (None, False, False, 3.0, "primary_unknown")]
    df = spark.createDataFrame(rows, "s string, n boolean, st boolean, a double, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", checks.primary_failure(c("s"), c("n"), c("st"), c("a")).alias("got")).collect())
    flags = spark.createDataFrame([(True, True, True, "Postponed"), (True, True, True, None), (None, True, True, "x"), (None, None, True, None), (None, None, None, None)], "a boolean, b boolean, d boolean, r string")
    assert [r[0] for r in flags.select(checks.feed_state(c("a"), c("b"), c("d"), c("r"))).collect()] == ["postponed", "cancelled", "finished", "inprogress", "notstarted"]
    scores = spark.createDataFrame([(2, 1, False), (2, 1, True), (-1, 3, True)], "a int, b int, s boolean")
    assert [tuple(r[0]) for r in scores.select(checks.feed_scores(c("a"), c("b"), c("s"))).collect()] == [(2, 1), (1, 2), (3, None)]


def test_returns_and_pnl(spark):
    df = spark.sql("SELECT -1 AS s, array(101D, NULL, 0D) AS e, array(99D, 98D, 97D) AS x, 100D AS em, 98D AS xm, 150D AS r")
    (got,) = df.select(checks.execution_returns(c("s"), c("e"), c("x"), c("em"), c("xm"), c("r")).alias("v")).collect()
    v = got["v"]
    assert math.isclose(v["ret_mid_bps"], 200) and math.isclose(v["ret_exec_bps"][0], -(99 / 101 - 1) * 1e4) and v["ret_exec_bps"][1:] == [None, None]
    assert math.isclose(v["cost_bps"][0], 150 - v["ret_exec_bps"][0])
    fires = spark.createDataFrame([(1, 0, 1, 10, 0.5, 0.52, 1.0), (1, 0, 2, 899, 0.5, 0.52, 0.0), (1, 99_000, 3, 10, 0.5, None, None)], "token long, t long, seq long, sec long, p_entry double, entry_ask double, settle double")
    book = spark.createDataFrame([(1, 4_999, 1, 0.1, 0.2), (1, 5_000, 2, 0.6, 0.64), (1, 6_000, 3, 0.9, 0.9)], "token long, t long, seq long, bid double, ask double")
    got = {r["seq"]: (r["net"], r["gross"], r["sold"]) for r in checks.pnl_at(fires, book, 5).collect()}
    assert math.isclose(got[1][0], 0.08) and math.isclose(got[1][1], 0.12) and got[1][2]
    assert math.isclose(got[2][0], -0.52) and not got[2][2] and got[3] == (None, None, False)


def test_gaps_restarts_retention_and_polls(spark):
    bars = spark.createDataFrame([("s", i) for i in (1, 2, 3, 5, 6, 20, 21, 22, 23)], "symbol string, i long")
    got = {r["i"]: (r["action"], r["armed"]) for r in lifecycle.gap_actions(bars, 3, 3).collect()}
    assert got == {1: ("ok", False), 2: ("ok", False), 3: ("ok", True), 5: ("backfill", True), 6: ("ok", True), 20: ("rewarm", False), 21: ("ok", False), 22: ("ok", True), 23: ("ok", True)}
    open_ = spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("b", 3, 1)], "symbol string, entry_id long, exit_i long")
    last = spark.createDataFrame([("a", 10)], "symbol string, last_i long")
    assert {r["entry_id"]: r["status"] for r in lifecycle.restarted(open_, last).collect()} == {1: "missed_exit", 2: "resume", 3: "resume"}
    rows = spark.createDataFrame([("k", t, t, stale) for t, stale in ((1, False), (2, False), (3, True), (12, True), (13, False), (30, False))], "token string, t long, seq long, stale boolean")
    assert sorted(r["t"] for r in lifecycle.retained(rows, "token", F.lit(20), 10).collect()) == [2, 12, 13]
    assert sorted(r["t"] for r in lifecycle.retained(rows, "token", F.lit(20), 10, 2).collect()) == [12, 13]
    jobs = spark.createDataFrame([(1, 0, True, 70_000), (2, 0, False, 10_000)], "job long, t long, extend boolean, end_ms long")
    got = {}
    for r in lifecycle.poll_schedule(jobs).orderBy("at").collect():
        got.setdefault((r["job"], r["phase"]), []).append(r["at"])
    assert got == {(1, "first"): [i * 3000 for i in range(10)], (1, "extended"): [37_000 + i * 3000 for i in range(8)], (1, "close"): [68_000, 69_000], (2, "first"): [0, 3000, 6000, 9000], (2, "close"): [8000, 9000]}


def test_thinning_keeps_reactions_and_a_standing_row(spark):
    rows = spark.createDataFrame([(1, t, t, fast) for t, fast in ((0, False), (300, False), (400, True), (900, True), (1000, False), (5000, False))], "token long, t long, seq long, fast boolean")
    got = sorted((r["t"], r["seq"], r["kind"]) for r in lifecycle.thinned(rows, 1000).collect())
    assert got == [(0, 0, "kept"), (400, 400, "kept"), (900, 900, "kept"), (1900, 900, "keepalive"), (2900, 900, "keepalive"), (3900, 900, "keepalive"), (4900, 900, "keepalive"), (5000, 5000, "kept")]


def test_settlement_needs_a_binary_payout(spark):
    entries = spark.createDataFrame([(1, "up", 0.4, 0), (1, "down", 0.5, 1), (2, "up", 0.4, 0), (3, "up", 0.4, 0), (4, "up", 0.2, 1)], "window long, token string, e double, gap int")
    markets = spark.createDataFrame([(w, tok, y, closed) for w, up, closed in ((1, 1.0, True), (2, 0.5, True), (3, 1.0, False), (4, 0.0, True)) for tok, y in (("up", up), ("down", 1 - up))], "window long, token string, y double, closed boolean")
    rows = checks.settled(entries, markets)
    got = {(r["window"], r["token"]): r["net"] for r in rows.collect()}
    assert set(got) == {(1, "up"), (1, "down"), (4, "up")} and math.isclose(got[1, "up"], (1 - 0.4 - 0.07 * 0.4 * 0.6) * 100)
    report = {r["segment"]: r for r in checks.settlement_report(rows, 2.0).collect()}
    assert report["all"]["entries"] == 3 and report["all"]["windows"] == 2 and report["gap 0"]["t"] is None and math.isclose(report["all"]["per_day"], 1.5)


def test_repair_brings_the_tail_and_all_since_the_first_gap(spark):
    hour = lambda n: F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, {n})")
    source = spark.range(10).select(F.lit("s").alias("symbol"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, int(id))").alias("ts"), F.col("id").alias("close"))
    stored = source.where("close in (0, 1, 4)")
    got = sorted(r["close"] for r in pipelines.repaired(stored, source, "INTERVAL 1 HOUR", hour(8)).collect())
    assert got == [2, 3, 4, 5, 6, 7]  # the last closed bar is 7; from the gap at 2 on
    assert {r["missing"] for r in pipelines.gap_report(stored, 3600).collect()} == {2}
