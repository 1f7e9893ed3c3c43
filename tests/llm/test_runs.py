"""Periodic runs against brute force, on odd rows and on empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import MIDDLE
from tests.llm.conftest import ODD
from tidemill.llm import runs
from tidemill.llm.shared import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, least=6, times=4):
    """Every maximal run by trying all periods."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if i > s and size >= max(least, times * q) and not any(all(w[k] == w[k + p] for k in range(s, s + size - p)) for p in range(1, q)):
                out.append((s, size, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(documents_, least=6, times=4):
    """find_runs over several documents, in each one's own words."""
    at = np.cumsum([0, *map(len, documents_)])
    ids = np.array([x for d in documents_ for x in d], np.int32)
    doc = np.repeat(np.arange(len(documents_)), [len(d) for d in documents_])
    out = [[] for _ in documents_]
    for s, size, q in runs.find_runs(ids, doc, least, times).tolist():
        out[doc[s]].append((s - int(at[doc[s]]), size, q))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9), st.integers(0, 5)), max_size=5), min_size=1, max_size=4))
def test_runs_equal_all_periods_tried(parts):
    docs = [[x for block, times, extra in d for x in block * times + block[:extra]] for d in parts]
    assert found(docs) == [plain_runs(d) for d in docs]


@pytest.mark.parametrize("least,times", [(1, 2), (2, 2), (10, 2), (4, 3), (6, 4), (7, 5)])
def test_other_lengths_and_exponents(least, times):
    rng = random.Random(least * times)
    docs = [[rng.randint(0, 1) for _ in range(rng.randint(0, 60))] for _ in range(60)]
    assert found(docs, least, times) == [plain_runs(d, least, times) for d in docs]


def test_long_periodic_texts_and_places_in_blocks():
    assert found([[1] * 20_000, list(range(50)) * 100 + [7]]) == [[(0, 20_000, 1)], [(0, 5_000, 50)]]
    rng, places, plain = random.Random(1), runs.Places([5]), [5]
    for x in rng.sample(range(10, 100_000), 5_000):
        before, behind = places.around(x)
        assert before == max((y for y in plain if y < x), default=-1) and behind == min((y for y in plain if y > x), default=-1)
        places.add(x)
        plain.append(x)
    assert list(places) == sorted(plain) and len(places) == len(plain)


def plain_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    rs = plain_runs(w)
    gone = {i for s, size, q in rs for i in range(s + q, s + size)}
    best = min(rs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in rs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(rs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def shown(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def digests_of(docs):
    from pyspark.sql import functions as F

    out = runs.periodic_runs(runs.planted(docs))
    return out.select("doc_id", *runs.digests(F.col("runs")), F.sha2(F.encode("kept_text", "UTF-8"), 256))


def test_odd_rows_and_empty_tables_equal_the_plain_version(spark, odd, empty):
    short = odd.where("doc_id <> 7 OR doc_id IS NULL")  # all periods of 9,000 words take the plain version too long
    assert shown(digests_of(short)) == sorted((plain_row(r[0], r[1]) for r in ODD if r[0] != 7), key=repr)
    seven = shown(digests_of(odd.where("doc_id = 7")))
    assert len(seven) == 2 and seven[0] == seven[1]
    assert digests_of(empty).count() == 0 and runs.periodic_runs(empty).columns == ["doc_id", "n_words", "runs", "kept_text"]


def test_planted_rows_equal_the_plain_version(spark):
    docs = documents(spark, MIDDLE).where("length(text) < 3000").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert shown(digests_of(docs)) == sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(1 for r in rows if plain_row(*r)[1]) > 20
