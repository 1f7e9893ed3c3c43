"""Sliding windows of chunks against pandas, ranks against pandas at large windows."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.functions.sliding import Roll, ranked, rolled, slide


def series(n, seed, gaps=0.1, kinds=9):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, kinds, n).astype(float) if kinds else rng.normal(size=n)
    x[rng.random(n) < gaps] = np.nan
    return x


def by_pandas(x, roll):
    s, least = pd.Series(x), roll.n if roll.least is None else roll.least
    r = s.rolling(roll.n, min_periods=min(least, roll.n))
    if roll.op == "lag":
        return s.shift(roll.n).to_numpy()
    if roll.op == "decile":
        pct = r.rank(pct=True, method="average")
        return (np.floor(pct * 10 + 1e-9).clip(upper=9) + 1).to_numpy()
    if roll.op == "count":
        n = s.notna().astype(int).rolling(roll.n, min_periods=1).sum()
        return n.where(n >= least).to_numpy()
    return {"sum": r.sum, "avg": r.mean, "std": r.std, "min": r.min, "max": r.max}[roll.op]().to_numpy()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 80), st.integers(1, 30), st.sampled_from(["count", "sum", "avg", "std", "min", "max", "lag", "decile"]), st.integers(1, 8), st.integers(0, 1000))
def test_rolls_equal_pandas(m, n, op, least, seed):
    x = series(m, seed, kinds=seed % 3 * 4)
    roll = Roll(op, "x", n, min(least, n))
    np.testing.assert_allclose(rolled(x, roll), by_pandas(x, roll), rtol=1e-9, atol=1e-7)


@pytest.mark.parametrize("kinds", [0, 50])
def test_ranks_equal_pandas_at_a_window_of_50_000(kinds):
    x = series(120_000, 1, kinds=kinds)
    less, same, seen = ranked(x, 50_000)
    want = pd.Series(x).rolling(50_000, min_periods=1).rank(method="average").to_numpy()
    good = ~np.isnan(x)
    assert (less + (same + 1) / 2)[good].tolist() == want[good].tolist() and seen[-1] == good[-50_000:].sum()


def test_a_constant_series_has_no_deviation_and_huge_values_keep_their_digits():
    x = np.full(500, 0.1)
    assert rolled(x, Roll("std", "x", 100))[99:].max() == 0.0
    x = np.concatenate([np.full(1000, 1e15), np.arange(1000) / 8])
    assert rolled(x, Roll("sum", "x", 100))[-1] == (np.arange(900, 1000) / 8).sum()


def test_one_symbol_in_chunks(spark):
    n = 3000
    x, start = series(n, 5, kinds=0), datetime(2024, 1, 1)
    rows = [("a", start + timedelta(minutes=7 * i), None if np.isnan(v) else float(v)) for i, v in enumerate(x)] + [("b", start, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, x double")
    rolls = {"s": Roll("sum", "x", 300, 100), "d": Roll("decile", "x", 200, 50), "p": Roll("lag", "x", 5), "z": Roll("std", "x", 50, 10), "k": Roll("count", "x", 7, 1)}
    out = slide(df, rolls, chunk=400)
    assert out.columns == ["symbol", "ts", "x", *rolls] and dict(out.dtypes)["d"] == "int"
    got = out.where("symbol = 'a'").orderBy("ts").toPandas()
    assert len(got) == n
    for name, roll in rolls.items():
        np.testing.assert_allclose(got[name].astype(float).to_numpy(), by_pandas(x, roll), rtol=1e-9, atol=1e-9)
    one = out.where("symbol = 'b'").first()
    assert one["s"] is None and one["d"] is None and one["k"] == 1
    assert slide(df.limit(0), rolls).count() == 0


def test_features_of_chunks_equal_those_of_the_series(spark):
    from tests.conftest import SMALL
    from tidemill.operators import features as X
    from tidemill.sources import views as V

    bars = V.bars_1h(spark, SMALL)
    made = lambda: {"pk": X.parkinson(10), "z": X.log_zscore(bars["volume"], 12), "v": X.vwap(24), "f": X.forward_return(3), "r": X.cum_return(6)}
    whole, parts = bars.withColumns(made()), X.spread(bars, made, 24, 3, chunk=40)
    assert whole.columns == parts.columns
    shown = lambda df: sorted((r["symbol"], r["ts"], *(None if r[c] is None else round(r[c], 9) for c in ("pk", "z", "v", "f", "r"))) for r in df.collect())
    assert shown(whole) == shown(parts)
