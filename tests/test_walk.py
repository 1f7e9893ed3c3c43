"""Walk-forward fits and pools against plain loops over rows."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import walk

DAY = 86_400


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=12), min_size=1, max_size=7))
def test_selection_and_ranks_over_runs(lists):
    runs = [np.array(sorted(x), float) for x in lists]
    flat = sorted(v for x in lists for v in x)
    assert [walk.kth(runs, k) for k in range(len(flat))] == flat
    assert walk.median(runs) == float(np.median(flat)) and walk.median([]) is None
    x = np.arange(-1, 11) / 1.0
    assert walk.share_over(runs, x) == pytest.approx([sum(v > y for v in flat) / len(flat) for y in x])


def rows_of(n, seed, days=40, nulls=0.1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.gauss(5, 1), rng.gauss(-2, 3)
        y = 3 + 2 * a - 0.5 * b + rng.gauss(0, 0.1)
        hole = lambda v: None if rng.random() < nulls else v
        out.append((rng.choice("st"), rng.randrange(10 * DAY, (10 + days) * DAY), hole(a), hole(b), hole(y), hole(y * 2)))
    return out


def test_fits_equal_least_squares_over_each_days_rows(spark):
    rows, days, least = rows_of(900, 1), 6, 12
    rows = [r for r in rows if not 20 * DAY <= r[1] < 24 * DAY]  # days without rows have models of the days before
    df = spark.createDataFrame(rows, "k string, s long, a double, b double, y double, y2 double")
    targets = {1: ("y", 3_600), 7: ("y2", 30 * 3_600)}
    got = {(r["k"], r["horizon"], r["score_day"]): r for r in walk.walk_fit(df, F.col("s"), targets, ["a", "b"], days, least, ("k",)).collect()}
    seen = set()
    for k in "st":
        for h, (name, delay) in targets.items():
            for d in range(9, 60):
                known = [r for r in rows if r[0] == k and (d - days) * DAY <= r[1] < d * DAY - delay]
                if not known:
                    assert (k, h, d) not in got
                    continue
                seen.add((k, h, d))
                y = 4 if h == 1 else 5
                full = [r for r in known if None not in (r[2], r[3], r[y])]
                r = got[k, h, d]
                assert r["n"] == len(full)
                if len(full) < least:
                    assert r["intercept"] is None and r["b_a"] is None
                else:
                    beta = np.linalg.lstsq(np.array([[1, x[2], x[3]] for x in full]), np.array([x[y] for x in full]), rcond=None)[0]
                    assert [r["intercept"], r["b_a"], r["b_b"]] == pytest.approx(beta.tolist(), rel=1e-7, abs=1e-8)
    assert seen == set(got)


def test_no_key_a_constant_regressor_and_no_rows(spark):
    df = spark.createDataFrame([(DAY * 3 + i, 1.0, float(i)) for i in range(40)], "s long, a double, y double")
    r = walk.walk_fit(df, F.col("s"), {1: ("y", 60)}, ["a"], 5).orderBy("score_day").collect()
    assert [x["score_day"] for x in r] == [4, 5, 6, 7, 8] and math.isclose(r[0]["intercept"] + r[0]["b_a"], 19.5)
    assert walk.walk_fit(df.limit(0), F.col("s"), {1: ("y", 60)}, ["a"], 5).count() == 0


def test_pools_equal_all_rows_of_their_days(spark):
    rows, days, delay = rows_of(700, 3), 5, 20 * 3_600
    df = spark.createDataFrame([(r[0], r[1], r[4]) for r in rows], "symbol string, s long, z double")
    runs = walk.day_runs(df, F.col("s"), "z", delay).cache()
    assert runs.agg(F.sum("n")).first()[0] == sum(r[4] is not None for r in rows)  # each value is stored once
    sizes = {(r["symbol"], r["score_day"]): (r["pool_size"], r["pool_lo"], r["pool_hi"]) for r in walk.pool_sizes(runs, days).collect()}
    want = {}
    for k in "st":
        for d in range(9, 60):
            pool = [r[4] for r in rows if r[0] == k and r[4] is not None and (d - days) * DAY <= r[1] < d * DAY - delay]
            if pool:
                want[k, d] = pool
    assert sizes == {key: (len(p), min(p), max(p)) for key, p in want.items()}
    asked = spark.createDataFrame([*want, ("s", 5)], "symbol string, score_day long")
    mids = {(r["symbol"], r["score_day"]): r["pool_mid"] for r in walk.pool_medians(runs, asked, days).collect()}
    assert mids == {**{key: pytest.approx(float(np.median(p))) for key, p in want.items()}, ("s", 5): None}
    ask = [(k, d, x) for k, d in want for x in (1.0, 14.0, None)] + [("s", 5, 1.0)]
    got = walk.pool_shares(spark.createDataFrame(ask, "symbol string, score_day long, x double"), runs, "x", days).collect()
    for r in got:
        pool = want.get((r["symbol"], r["score_day"]))
        assert r["share"] == (None if pool is None or r["x"] is None else pytest.approx(sum(v > r["x"] for v in pool) / len(pool)))
    assert len(got) == len(ask)
