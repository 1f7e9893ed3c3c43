"""Streams that time moves on against their batch twins, and hand-written cases."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import lifecycle
from tidemill.streaming import live, timers


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.booleans()), max_size=30), st.integers(1, 15), st.none() | st.integers(-20, 10))
def test_jumps_keep_what_a_plain_loop_keeps(rows, slow, last):
    rows.sort(key=lambda r: r[0])
    want, at = [], last
    for i, (t, fast) in enumerate(rows):
        if fast or at is None or t - at >= slow:
            want.append(i)
            at = t
    assert lifecycle.kept_fast(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], bool), slow, last) == (want, at)


def streamed(spark, tmp_path, df, parts, run, schema):
    """What a stream gives of a frame's parts, a run of its own for each, from the same checkpoint."""
    live.rocks(spark)
    for k, part in enumerate(parts):
        df.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        live.run_once(run(live.event_stream(spark, str(tmp_path / "in"), schema)), str(tmp_path / "out"), str(tmp_path / "mark"))
    return sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)


def test_keepalives_between_rows_and_through_a_trailing_quiet_spell(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, t, k * 1000 + i, rng.random() < 0.1) for k in (1, 2) for i, t in enumerate(sorted(rng.sample(range(0, 400_000, 50), 60)))]
    rows += [(9, 1_000_000, 9000, False)]  # moves the watermark; the others are quiet for long
    schema = "token long, t long, seq long, fast boolean"
    df = spark.createDataFrame(rows, schema)
    got = streamed(spark, tmp_path, df, ["t < 100000 AND seq % 2 = 0", "t < 100000 AND seq % 2 = 1 AND t > 95000", "t >= 100000 AND t < 1000000", "t >= 1000000"], lambda s: timers.thinned(s, 7_000, "6 seconds"), schema)
    taken = df.where("NOT (t < 100000 AND seq % 2 = 1 AND t <= 95000)")
    upto = 1_000_000 - 6_000
    mark = [upto]
    want = lifecycle.thinned(taken.where("token <> 9"), 7_000, until=mark[0])
    late = [r for r in got if r[0] == 9]
    assert late == [] and [r for r in got if r[0] != 9] == sorted((tuple(r) for r in want.collect()), key=repr)
    assert sum(r[3] == "keepalive" and r[1] > 400_000 for r in got) > 150


def test_seconds_are_given_when_over_and_late_rows_count_once(spark):
    rows = [(1, t, r, i, 1.0) for i, (t, r) in enumerate([(100, 110), (1_500, 1_510), (900, 1_600), (4_200, 4_210), (1_900, 4_300), (4_300, 4_310), (9_000, 9_000)])]
    got = {r["at"]: (r["n"], r["total"], r["late"]) for r in lifecycle.second_states(spark.createDataFrame(rows, "token long, t long, recv long, seq long, value double")).collect()}
    assert got == {1000: (1, 1.0, 0), 2000: (3, 3.0, 1), 3000: (3, 3.0, 1), 4000: (3, 3.0, 1), 5000: (6, 6.0, 2), 6000: (6, 6.0, 2), 7000: (6, 6.0, 2), 8000: (6, 6.0, 2)}


def test_stream_of_seconds_equals_batch_and_goes_on_without_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(250):
        t = rng.randrange(880_000, 960_000)
        rows.append((rng.randint(1, 3), t, t + rng.choice([0, 100, 900, 5_000]), i, float(rng.randint(1, 5))))
    rows.append((7, 2_500_000, 2_500_000, 999, 1.0))
    schema = "token long, t long, recv long, seq long, value double"
    df = spark.createDataFrame(rows, schema)
    got = streamed(spark, tmp_path, df, ["recv < 900000", "recv >= 900000 AND recv < 930000", "recv >= 930000 AND recv < 2000000", "recv >= 2000000"], timers.second_states, schema)
    batch = {tuple(r) for r in lifecycle.second_states(df).collect()}
    assert batch <= set(got) and len(got) == len(set(got))
    last = {}
    for r in batch:
        last[r[0], r[1]] = max(last.get((r[0], r[1]), 0), r[2])
    more = [r for r in got if r not in batch]
    assert all(r[2] > last.get((r[0], r[1]), 0) for r in more)
    ends = {(k, e): max(r[2] for r in got if (r[0], r[1]) == (k, e)) for k, e, *_ in got}
    assert all(end == e + 900_000 for (k, e), end in ends.items() if k != 7)  # quiet keys go on to the epoch's end
    late = {k: max((r[6] for r in got if r[0] == k), default=0) for k in (1, 2, 3)}
    assert all(v > 0 for v in late.values())
