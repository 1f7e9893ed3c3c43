"""Ladders from whole messages: hand-written cases, a plain replay, and the stream against the batch."""

import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemill.operators import ladder, pipelines
from tidemill.streaming import live


def level(price, size):
    return {"price": price, "size": size}


def book(token, bids, asks, tick="0.01"):
    return {"event_type": "book", "asset_id": token, "tick_size": tick, "bids": [level(*x) for x in bids], "asks": [level(*x) for x in asks]}


def change(*rows):
    return {"event_type": "price_change", "price_changes": [{"asset_id": t, "side": s, "price": p, "size": q} for t, s, p, q in rows]}


def events(spark, messages):
    rows = [(i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)]
    return ladder.book_events(spark.createDataFrame(rows, "seq long, m string"))


def shown(df):
    return {(r["token"], r["seq"], r["at"]): tuple(None if r[n] is None else float(r[n]) for n in ladder.TOP) for r in df.collect()}


def test_snapshot_of_many_levels_deltas_deletes_and_reconnect(spark):
    ask_book = book("a", [("0.40", "2"), ("0.39", "3")], [("0.60", "9"), ("0.50", "5"), ("0.51", "3"), ("0.55", "8")])
    other = book("b", [], [("0.2", "10")])
    got = shown(ladder.tops(events(spark, [
        [ask_book, other, change(("a", "SELL", "0.5", "4"))],  # one frame: two books and a change of one
        change(("a", "SELL", "0.60", "0")),
        change(("a", "SELL", "0.50", "0")),
        {"kind": "gap", "tokens": ["a", "b"]},
        change(("a", "SELL", "0.5", "4")),  # revives nothing
        book("b", [("0.1", "7")], [("0.2", "10"), ("0.21", "1"), ("0.22", "1")], tick=None),
        {"event_type": "tick_size_change", "asset_id": "b", "new_tick_size": "0.001"},
        {"event_type": "last_trade_price", "asset_id": "b", "price": "0.3"},
        "not json",
    ])))
    assert got[("a", 0, 0)] == (0.40, 2, 0.50, 5, 8, 0.01)
    assert got[("b", 0, 1)] == (None, None, 0.2, 10, 10, 0.01)
    assert got[("a", 0, 2)] == (0.40, 2, 0.50, 4, 7, 0.01)
    assert got[("a", 1, 0)][2] == 0.50 and got[("a", 2, 0)] == (0.40, 2, 0.51, 3, 3, 0.01)
    assert got[("a", 3, 0)] == got[("b", 3, 0)] == got[("a", 4, 0)] == (None,) * 6
    assert got[("b", 5, 0)] == (0.1, 7, 0.2, 10, 11, None) and got[("b", 6, 0)] == (0.1, 7, 0.2, 10, 11, 0.001)
    assert len(got) == 10


def test_a_bad_level_voids_all_books_of_its_message(spark):
    start = [book(t, [("0.4", "1")], [("0.6", "1")]) for t in ("a", "b", "c")]
    for bad in (("a", "SELL", "1.5", "1"), ("a", "SELL", "0.5", "-1"), ("a", "HOLD", "0.5", "1"), ("a", "BUY", "x", "1"), ("a", "BUY", None, "1")):
        got = shown(ladder.tops(events(spark, [*start, change(bad, ("b", "BUY", "0.41", "2")), change(("a", "BUY", "0.42", "1"), ("b", "BUY", "0.42", "1"), ("c", "BUY", "0.42", "1")), start[0]])))
        assert got[("a", 3, 0)] == got[("b", 3, 0)] == got[("a", 4, 0)] == got[("b", 4, 0)] == (None,) * 6
        assert got[("c", 4, 0)][0] == 0.42 and got[("a", 5, 0)][:2] == (0.4, 1)
    got = shown(ladder.tops(events(spark, [start[0], book("a", [("2", "1")], [])])))
    assert got[("a", 1, 0)] == (None,) * 6


def test_empty_books_missing_sides_and_tables(spark):
    got = shown(ladder.tops(events(spark, [book("a", [], []), {"event_type": "book", "asset_id": "b", "asks": [level("0.5", "1")]}, change(("a", "BUY", "0.3", "2"))])))
    assert got[("a", 0, 0)] == (None,) * 5 + (0.01,) and got[("b", 1, 0)][2] == 0.5 and got[("a", 2, 0)][:2] == (0.3, 2)
    none = events(spark, [book("a", [], [])]).limit(0)
    assert ladder.tops(none).count() == ladder.versions(none).count() == ladder.changes(none).count() == 0


def plain(messages):
    """tops and changes by dictionaries, message by message."""
    books, tops, changes = {}, {}, []
    for seq, m in enumerate(messages):
        if m.get("kind") == "gap":
            touched = m["tokens"]
            for t in touched:
                books.pop(t, None)
        elif m["event_type"] == "book":
            touched = [m["asset_id"]]
            books[m["asset_id"]] = {s: {Decimal(x["price"]): Decimal(x["size"]) for x in m[f"{s}s"] if Decimal(x["size"]) > 0} for s in ("bid", "ask")}
        else:
            touched = list(dict.fromkeys(x["asset_id"] for x in m["price_changes"]))
            for x in m["price_changes"]:
                own = books.get(x["asset_id"])
                if own is not None:
                    s, p, q = "bid" if x["side"] == "BUY" else "ask", Decimal(x["price"]), Decimal(x["size"])
                    before = own[s].get(p, Decimal(0))
                    if q:
                        own[s][p] = q
                    else:
                        own[s].pop(p, None)
                    best = max(own["bid"], default=None) if s == "bid" else min(own["ask"], default=None)
                    changes.append((x["asset_id"], seq, s, p, before, q, best))
        for t in touched:
            own = books.get(t)
            if own is None:
                tops[(t, seq)] = (None,) * 5
            else:
                bid, ask = max(own["bid"], default=None), min(own["ask"], default=None)
                near = sum(q for p, q in own["ask"].items() if p <= ask + Decimal("0.01")) if ask is not None else None
                tops[(t, seq)] = (bid, own["bid"].get(bid), ask, own["ask"].get(ask), near)
    return tops, changes


def random_messages(n, seed):
    rng, out = random.Random(seed), []
    price = lambda: f"0.{rng.randint(40, 60)}"
    for _ in range(n):
        t = rng.choice("abc")
        x = rng.random()
        if x < 0.05:
            out.append({"kind": "gap", "tokens": rng.sample("abc", rng.randint(1, 3))})
        elif x < 0.15:
            out.append(book(t, [(price(), str(rng.randint(0, 3))) for _ in range(rng.randint(0, 6))], [(price(), str(rng.randint(0, 3))) for _ in range(rng.randint(0, 6))]))
        else:
            out.append(change(*[(rng.choice("abc"), rng.choice(["BUY", "SELL"]), price(), str(rng.randint(0, 3))) for _ in range(rng.randint(1, 4))]))
    for m in out:  # one size a level in a snapshot
        for s in ("bids", "asks"):
            if s in m:
                m[s] = list({x["price"]: x for x in m[s]}.values())
    return out


def test_replay_equals_dictionaries(spark, tmp_path):
    messages = random_messages(600, 4)
    tops, changes = plain(messages)
    ev = events(spark, messages)
    got = {(r["token"], r["seq"]): (r["bid"], r["bid_size"], r["ask"], r["ask_size"], r["ask_near"]) for r in ladder.tops(ev).collect()}
    assert got == tops
    key = lambda r: tuple(map(str, r))
    rows = [(r["token"], r["seq"], r["side"], r["price"], r["before"], r["after"], r["best"]) for r in ladder.changes(ev).collect()]
    same = lambda rs: sorted((t, s, side, float(p), float(b), float(a), None if x is None else float(x)) for t, s, side, p, b, a, x in rs)
    assert sorted(map(key, same(rows))) == sorted(map(key, same(changes)))
    spread = ladder.lives(ev, span=7)  # marks carried through many stretches
    assert sorted(map(str, spread.collect())) == sorted(map(str, ladder.lives(ev).select(spread.columns).collect()))


def test_versions_give_the_ladder_at_any_message(spark):
    messages = random_messages(200, 9)
    tops, _ = plain(messages)
    ev = events(spark, messages)
    rows = [r for r in ladder.versions(ev).collect() if r["size"] > 0 and r["side"] == "ask"]
    known = {(r["token"], r["seq"]): r["life"]["seq"] for r in ladder.lives(ev).where("alive").collect()}
    for (t, s), top in tops.items():
        held = [r["price"] for r in rows if (t, s) in known and r["token"] == t and r["life"] == known[t, s] and r["seq"] <= s and (r["until"] is None or r["until"] > s)]
        assert min(held, default=None) == top[2]


def test_adds_count_near_the_sides_best_only(spark):
    ev = events(spark, [
        book("a", [("0.50", "5")], [("0.60", "5")]),
        change(("a", "BUY", "0.50", "8")),  # +3 at the best
        change(("a", "BUY", "0.48", "2")),  # +2, two cents off
        change(("a", "BUY", "0.47", "9")),  # three cents off
        change(("a", "BUY", "0.50", "1")),  # less
        change(("a", "SELL", "0.59", "4")),  # +4: a new best is near itself
        change(("a", "SELL", "0.59", "0")),
        change(("b", "SELL", "0.59", "7")),  # no book
    ])
    rows = ladder.changes(ev)
    got = {(r["seq"], r["side"]): r["x"] for r in rows.withColumn("x", ladder.added(rows)).collect()}
    assert {k: float(v) for k, v in got.items() if v is not None} == {(1, "bid"): 3, (2, "bid"): 2, (5, "ask"): 4} and len(got) == 6
    flow = {r["t_s"]: (r["up"], r["down"], r["v"]) for r in pipelines.add_flow(rows.withColumn("t_s", F.col("seq") * 10)).collect()}
    assert flow[20] == (5.0, 0.0, 1.0) and flow[50][:2] == (0.0, 4.0) and flow[60] == (0.0, 4.0, -1.0) and flow[30] == (5.0, 0.0, 1.0) and flow[40][0] == 2.0


def test_stream_equals_batch_over_triggers_and_a_restart(spark, tmp_path):
    live.rocks(spark)
    ev = ladder.book_events(ladder.wire(spark, SMALL)).where("seq < 400")
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    parts = [(0, 60), (60, 61), (61, 250), (250, 400)]
    for k, (a, b) in enumerate(parts):
        ev.where((F.col("seq") >= a) & (F.col("seq") < b)).coalesce(1).write.mode("append").parquet(source)
        if k != 1:  # the second and third parts come in one run of two triggers
            live.run_once(live.ladders(live.event_stream(spark, source, ladder.EVENT)), out, mark)
    got = shown(spark.read.parquet(out))
    assert got == shown(ladder.tops(ev)) and len(got) == spark.read.parquet(out).count()
