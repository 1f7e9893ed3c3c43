"""Best names against all pairs, the roles of a match's questions, and the checks of a move, by hand."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tidemill.operators import events, names
from tidemill.operators.text import GENERIC


def plain_words(x):
    return sorted({w for w in x.lower().split() if w not in GENERIC and not (w.isdigit() and 2 <= len(w) <= 4)})


def plain_similarity(a, b):
    wa, wb = plain_words(a), plain_words(b)
    if not wa or not wb:
        return 0
    n = len(set(wa) & set(wb))
    return 100 * n / min(len(wa), len(wb)) + 10 * n + SequenceMatcher(None, " ".join(wa), " ".join(wb)).ratio()


@pytest.mark.parametrize("least", [60.0, 100.0, 125.0])
def test_best_and_margin_equal_all_pairs(spark, least):
    rng = random.Random(int(least))
    vocabulary = [f"w{int(rng.paretovariate(0.8)) % 60}" for _ in range(400)] + ["fc", "cf", "united"] * 20
    make = lambda n: [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 7))) for _ in range(n)]
    a, b = make(150) + ["fc", ""], make(120) + ["united"]
    got = names.best_matches(spark.createDataFrame([(x,) for x in a], "name string"), spark.createDataFrame([(x,) for x in b], "candidate string"), least).collect()
    want = {}
    for x in set(a):
        s = sorted(((plain_similarity(x, y), y) for y in set(b)), key=lambda r: (-r[0], r[1]))
        s = [r for r in s if r[0] >= least and plain_words(x) and plain_words(r[1])]
        if s:
            want[x] = (s[0][1], pytest.approx(s[0][0]), pytest.approx(s[0][0] - s[1][0]) if len(s) > 1 else None)
    assert {r["name"]: (r["candidate"], r["score"], r["margin"]) for r in got} == want and len(got) == len(want) > 20


def market(question, token, kind="moneyline", outcomes='["No", "Yes"]', start=5):
    return (kind, question, outcomes, f'["{token}n", "{token}y"]', start)


def roles(spark, title, markets, slug="home-away"):
    df = spark.createDataFrame([(1, title, slug, markets)], f"event_id long, title string, slug string, markets {names.MARKET}")
    return [(r["home"], r["away"], r["kickoff_ms"], {k: (v["yes"], v["no"]) for k, v in r["roles"].items()}) for r in names.event_roles(df).collect()]


def test_a_trio_of_questions_becomes_home_draw_and_away_or_nothing(spark):
    title = "Real Madrid CF VS Atlético Madrid"
    trio = [market("Will Real Madrid CF win on 2026-01-01?", "h"), market("Will Real Madrid CF vs Atlético end in a draw?", "d"), market("Will Atletico Madrid win on 2026-01-01?", "a", "child_moneyline")]
    want = [("Real Madrid CF", "Atlético Madrid", 5, {"home": ("hy", "hn"), "draw": ("dy", "dn"), "away": ("ay", "an")})]
    assert roles(spark, title, trio) == want
    assert roles(spark, title, [*trio, market("Will Real Madrid win on x?", "z", "totals"), market("Over 2.5?", "o")]) == want
    assert roles(spark, title, trio[:2]) == []
    assert roles(spark, title, [*trio, trio[0]]) == []
    assert roles(spark, title, [*trio[:2], market("Will Madrid win on 2026-01-01?", "a")]) == []  # as near to either
    assert roles(spark, title, [*trio[:2], market("Will Atletico Madrid win on x?", "a", start=6)]) == []
    assert roles(spark, title, [*trio[:2], market("Will Atletico Madrid win on x?", "a", start=None)]) == []
    assert roles(spark, title, [*trio[:2], market("Will Atletico Madrid win on x?", "a", outcomes='["Up", "Down"]')]) == []
    assert roles(spark, "One team", trio) == [] and roles(spark, title, trio, "no slug") == []


def test_checks_of_a_move(spark):
    def checks(role, d, ref, home, away, minute):
        df = spark.createDataFrame([(role, d, ref, home, away, minute)], "role string, d int, ref double, home int, away int, minute int")
        return df.select(events.impulse_checks(*map(F.col, ("role", "d", "ref", "home", "away", "minute"))).alias("x")).first()["x"]

    assert checks("home", -1, 0.85, 1, 0, 75)["hypothesis"] is False and checks("home", -1, 0.84, 1, 0, 75)["hypothesis"] is True
    assert checks("home", -1, 0.9, 1, 0, None)["hypothesis"] is None and checks("home", -1, 0.9, 0, 1, 80)["hypothesis"] is True
    level = checks("draw", 1, 0.5, 1, 1, 75)
    assert level["gate"] is False and level["gate_reasons"] == ["draw_up_level"] and level["hypothesis"] is False
    assert checks("draw", -1, 0.5, 1, 1, 75)["gate"] is True and checks("draw", -1, 0.5, None, 1, 75)["gate"] is True
    none = checks("home", 1, 0.5, None, None, None)
    assert none["gate"] is None and none["f_minute30"] is None and none["hypothesis"] is True and none["f_leader1_up"] is None
    lead = checks("away", 1, 0.97, 0, 2, 10)
    assert lead["gate_reasons"] == ["dead_price", "favoured_leads_by_2"] and lead["favoured_side"] == "away" and lead["f_leader1_up"] is False
    assert checks("home", -1, 0.5, 0, 1, 40)["favoured_side"] == "away" and checks("away", 1, 0.5, 0, 1, 40)["f_leader1_up"] is True
