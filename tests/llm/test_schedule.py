"""Schedules of thousands of blocks: each block once, in its window, slots without gaps."""

import random
from collections import Counter
from fractions import Fraction
from heapq import heappop, heappush
from math import ceil, floor

import pytest

from tidemill.llm import mixing


SKEWED = list(zip([40, 30, 1900, 4900, 1200, 1700, 3400, 3450, 50, 3300, 10, 60], [30, 27, 1840, 4844, 1143, 1696, 3384, 3427, 38, 3281, 4, 41]))


@pytest.mark.parametrize("blocks", [SKEWED, [(900, 5000), (35, 60), (4, 4), (610, 2100), (33, 41), (1500, 4700), (8, 9), (77, 95)]])
def test_schedule_of_thousands_of_blocks(spark, blocks):
    sources = [(f"s{i}", n, w) for i, (n, w) in enumerate(blocks)]
    got = mixing.schedule(spark.createDataFrame(sources, "s string, n long, w long")).orderBy("slot").collect()
    assert [r["slot"] for r in got] == list(range(sum(n for _, n, _ in sources)))
    assert {(r["s"], r["k"]) for r in got} == {(s, k) for s, n, _ in sources for k in range(n)}
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    done = Counter()
    for r in got:
        assert r["k"] == done[r["s"]]
        done[r["s"]] += 1


def test_schedule_of_twenty_thousand_sources(spark):
    from pyspark.sql import functions as F

    sources = spark.range(20_000).select(F.concat(F.lit("s"), "id").alias("s"), (1 + F.col("id") % 2).alias("n"), F.lit(1).cast("long").alias("w"))
    got = mixing.schedule(sources).agg(F.count(F.lit(1)), F.countDistinct("slot"), F.min("slot"), F.max("slot"), F.count_if(F.expr("release <= slot AND slot < deadline"))).first()
    assert tuple(got) == (30_000, 30_000, 0, 29_999, 30_000)


def plain_edf(sources):
    """(s, k) -> (release, deadline, slot): windows from the fluid mix in fractions, then slot after slot the released block that is
    due first."""
    def slot_of(v):
        return sum((min(Fraction(n), w * v) for _, n, w in sources), Fraction(0))

    jobs = sorted((floor(slot_of(Fraction(k, w))), ceil(slot_of(Fraction(k + 1, w))), s, k) for s, n, w in sources for k in range(n))
    out, ready, at = {}, [], 0
    for slot in range(len(jobs)):
        while at < len(jobs) and jobs[at][0] <= slot:
            release, deadline, s, k = jobs[at]
            heappush(ready, (deadline, s, k, release))
            at += 1
        deadline, s, k, release = heappop(ready)
        out[s, k] = (release, deadline, slot)
    return out


def test_slots_equal_a_plain_earliest_deadline_run(spark):
    rng = random.Random(6)
    for _ in range(6):
        sources = [(f"s{i}", rng.randint(1, 60), rng.choice([1, 2, 3, 7, 20])) for i in range(rng.randint(1, 9))]
        got = mixing.schedule(spark.createDataFrame(sources, "s string, n long, w long")).collect()
        assert {(r["s"], r["k"]): (r["release"], r["deadline"], r["slot"]) for r in got} == plain_edf(sources)


def test_documents_take_the_slots_of_a_plain_run(spark):
    """The whole operator: weights from characters, blocks, and every document's slot and place in its block."""
    from tests.conftest import MIDDLE
    from tidemill.llm.shared import documents

    docs, size = documents(spark, MIDDLE).select("doc_id", "source", "text"), 20_000
    rows = [(r["doc_id"], r["source"], max(1, len(r["text"] or ""))) for r in docs.collect()]
    total = Counter()
    for _, s, n in rows:
        total[s] += n
    share = {s: n**0.5 for s, n in total.items()}
    sources = [(s, -(-n // size), max(1, floor(mixing.UNITS * share[s] / sum(share.values()) + 0.5))) for s, n in total.items()]
    plan = plain_edf(sources)
    got = mixing.mix_sources(docs, block_size=size).collect()
    assert len(got) == len(rows)
    begins = {}
    for r in got:
        assert (r["release"], r["deadline"], r["slot"]) == plan[r["source"], r["block"]]
        begins[r["doc_id"]] = (r["source"], r["block"] * size + r["within"])
    for s in total:  # laid end to end
        at = 0
        for begin, n in sorted((begins[d][1], n) for d, of, n in rows if of == s):
            assert begin == at
            at += n
