"""Queries over whole tables against brute force, on inputs that a cut by id, key or date would shorten."""

from __future__ import annotations

from collections import defaultdict
from difflib import SequenceMatcher

import numpy as np
import pandas as pd

from tests.conftest import MIDDLE, SMALL
from tidemill import catalog
from tidemill.operators import model, rules


def run(spark, name, d=SMALL):
    got = catalog.queries()[name](spark, str(d)).toPandas()
    return sorted(tuple(r) for r in got[sorted(got.columns)].itertuples(index=False))


def test_change_log_covers_every_customer(spark):
    orders = pd.read_parquet(f"{SMALL}/orders.parquet")
    polls = defaultdict(dict)
    for k, day, v in zip(orders["o_custkey"], pd.to_datetime(orders["o_orderdate"]).dt.date, orders["o_totalprice"]):
        one = polls[k % 20].setdefault(day, {})
        one[k] = max(v, one.get(k, v))
    want = []
    for grp, days in polls.items():
        seen, last = {}, {}
        for i, (_, now) in enumerate(sorted(days.items()), 1):
            want += [(grp, i, k, "new" if k not in seen else "changed") for k, v in now.items() if k not in last or seen[k] != v]
            want += [(grp, i, k, "gone") for k in last if k not in now]
            seen, last = seen | now, now
    got = run(spark, "win25_change_log")
    assert got == sorted((g, i, k, kind) for g, i, k, kind in want)
    assert {r[2] for r in got} == set(orders["o_custkey"])


def test_routing_of_late_events(spark, tmp_path):
    events = pd.read_parquet(f"{SMALL}/events.parquet")
    events["event_id"] += 5_000
    events.to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
    slugs = {(u % 50, f"u{u % 10}") for u in events["user_id"]}
    want = {(e, slug) for e, u in zip(events["event_id"], events["user_id"]) for key, slug in slugs if key in (u, e % 50)}
    assert want and run(spark, "jn16_routing", tmp_path) == sorted(want)


def test_names_of_a_brand_are_compared_across_id_blocks(spark, tmp_path):
    types = ["LARGE BRASS CASE", "SMALL CASE", "small case", None, "LARGE TIN CASE", "PIN"]
    parts = [(k, f"b{k % 3}", types[k % 5 if k % 7 else 5]) for k in range(1, 70)]
    pd.DataFrame(parts, columns=["p_partkey", "p_brand", "p_type"]).to_parquet(tmp_path / "part.parquet")
    pairs = [(a, b, x, y) for a, p, x in parts for b, q, y in parts if p == q and a < b]
    own = lambda x: sorted(set(x.lower().split()))

    def shares(x, y):
        n = len(set(own(x)) & set(own(y)))
        return 100 * n / min(len(own(x)), len(own(y))) + 10 * n

    ratio = {(a, b): r for a, b, r in run(spark, "fn24_sequence_ratio", tmp_path)}
    assert set(ratio) == {(a, b) for a, b, _, _ in pairs}
    assert all(pd.isna(ratio[a, b]) if x is None or y is None else abs(ratio[a, b] - shares(x, y) - SequenceMatcher(None, " ".join(own(x)), " ".join(own(y))).ratio()) < 1e-5 for a, b, x, y in pairs)
    shared = {(a, b): o for a, b, o in run(spark, "fn24_name_overlap", tmp_path)}
    assert set(shared) == set(ratio)
    for a, b, x, y in pairs:
        if x is not None and y is not None:
            assert abs(shared[a, b] - shares(x, y)) < 1e-5


def test_walk_forward_in_any_month(spark, tmp_path):
    events = pd.read_parquet(f"{SMALL}/events.parquet")
    events["ts"] += pd.Timedelta(days=75)
    events.to_parquet(tmp_path / "events.parquet", coerce_timestamps="us")
    rows = model.features(spark, str(tmp_path)).toPandas()
    s = (rows["ts"] - pd.Timestamp("1970-01-01")) // pd.Timedelta(seconds=1)
    want = {}
    for day in range(s.min() // 86_400 - 9, s.max() // 86_400 + 10):
        t = rows[(s < day * 86_400 - 3_600) & (s >= (day - 5) * 86_400)]
        if len(t):
            t = t.dropna(subset=["target", "mar_4"])
            want[day] = (len(t), *(np.polyfit(t["mar_4"], t["target"], 1) if len(t) >= 30 else (np.nan, np.nan)))
    got = {day: (n, b, a) for b, a, n, day in run(spark, "agg23_walk_forward", tmp_path)}
    assert set(got) == set(want) and len(got) > 30
    assert all(got[d][0] == want[d][0] and np.allclose(got[d][1:], want[d][1:], atol=1e-5, equal_nan=True) for d in want)


def test_legs_of_all_cells(spark):
    bars = rules.deciles(spark, MIDDLE).toPandas()
    want = []
    for cell in rules.CELLS:
        for r in bars.to_dict("records"):
            if r["d_pk"] in rules.REGIME and all(r[f] == q for f, q in cell.legs):
                want += [(q, cell.cell_id, f, q, r["symbol"], r["ts"]) for f, q in cell.legs]
    got = run(spark, "prj05_leg_detail", MIDDLE)
    assert got == sorted(want) and len({r[1] for r in got}) > 1
