"""Corpus operators against brute force, on odd rows and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import MIDDLE, SMALL
from tests.llm.conftest import ODD, SCHEMA
from tidemill.llm import co_training, components, jaccard_join, kernels, mixing, packing, quality_rules, substring_dedup, tiff, token_counts, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall(text or "")


def texts(n, seed, vocabulary=40, longest=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.4:
            w = split(rng.choice(out))
            for _ in range(rng.randint(0, 2)):
                if w:
                    w[rng.randrange(len(w))] = f"z{rng.randint(0, 9)}"
            out.append(" ".join(w))
        else:
            out.append(" ".join(f"w{rng.randint(0, vocabulary)}" for _ in range(rng.randint(0, longest))))
    return out


def morse(n, letters):
    """Thue-Morse words, on which polynomials modulo a power of two collide whatever their base."""
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


def docs_of(spark, ts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(ts)], SCHEMA)


def test_words_and_hashes_equal_python():
    ts = ["", "a b", " a\tb\n", "x" * 70_000 + " y", "é   z", "A a"]
    col = pa.array(ts)
    for _, _, data, offs in kernels.parts(col):
        w = kernels.words(data, offs)
        got = [[data[s:e].tobytes().decode() for s, e, d in zip(w.start, w.end, w.doc) if d == i] for i in range(len(ts))]
        assert got == [split(t) for t in ts]
        by = {}
        for s, e, h in zip(w.start, w.end, w.hash):
            assert by.setdefault(data[s:e].tobytes(), h) == h
        assert len(set(by.values())) == len(by)
        assert len(set(kernels.words(data, offs, fold=True).hash.tolist())) == len({x.lower() for x in by})
    h = np.arange(1, 200, dtype=np.uint64) % np.uint64(7)
    for width in (1, 2, 3, 8, 35):
        r = kernels.rabin_karp(h, width)
        seen = {}
        for i in range(len(h) - width + 1):
            assert seen.setdefault(tuple(h[i : i + width].tolist()), r[i]) == r[i]
        assert len(set(seen.values())) == len(seen)
    s = np.sort(kernels.mix(np.arange(50, dtype=np.uint64)))
    assert (kernels.unsqueeze(kernels.squeeze(s)) == s).all()


def brute_dedup(ts, width):
    at = Counter(tuple(w[i : i + width]) for w in map(split, ts) for i in range(len(w) - width + 1))
    out = []
    for t in ts:
        w = split(t)
        gone = {k for i in range(len(w) - width + 1) if at[tuple(w[i : i + width])] > 1 for k in range(i, i + width)}
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


@pytest.mark.parametrize("width", [3, 35])
def test_substring_dedup_equals_brute_force(spark, width):
    ts = texts(60, 1, longest=90)
    got = substring_dedup.substring_dedup(docs_of(spark, ts), width=width, group_bytes=500, bucket_windows=100).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_removed"], r["kept_text"]) for r in got] == brute_dedup(ts, width)
    for r, t in zip(got, ts):
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_texts_that_differ_in_one_long_word(spark):
    """35 words, one of which differs: a word of 1,024 letters, its letters swapped."""
    rest = " ".join(f"w{i}" for i in range(34))
    ts = [f"{morse(1024, 'ab')} {rest}", f"{morse(1024, 'ba')} {rest}", f"{morse(70_000, 'ab')} {rest}", f"{morse(70_000, 'ba')} {rest}"]
    got = substring_dedup.substring_dedup(docs_of(spark, ts)).collect()
    assert [r["n_removed"] for r in got] == [0] * 4
    pairs = [f"a {morse(1024, 'ab')}", f"a {morse(1024, 'ba')}", *(" ".join(morse(2048, x)) for x in ("cd", "dc"))]
    found = jaccard_join.jaccard_components(docs_of(spark, pairs)).orderBy("doc_id").collect()
    assert [r["component_id"] for r in found] == [c for _, c in brute_components(pairs, 3, 90)] and found[0]["component_id"] != found[1]["component_id"]
    wide = [" ".join(morse(4096, x)) for x in (["p", "q"], ["q", "p"])]
    assert [r["n_removed"] for r in substring_dedup.substring_dedup(docs_of(spark, wide), width=4096).collect()] == [0, 0]


def test_windows_with_equal_hashes_are_told_apart():
    h, check = np.array([5, 7, 5, 5, 7], np.uint64), np.array([1, 2, 9, 1, 2], np.uint32)
    found = substring_dedup.distinct(h, check)
    assert found.count.tolist() == [2, 1, 2] and found.which.tolist() == [0, 2, 1, 0, 2]


def test_shingles_are_compared_by_their_words():
    a, b = jaccard_join.shingles(pa.array(["a b C d e f", "x A B c D e z"]), 3, 1)
    assert jaccard_join.common(a, b) == 3
    forged = b._replace(hash=np.append(a.hash, np.uint64(2**64 - 1)))  # all hashes equal, few words
    words = lambda s, i: [bytes(kernels.LOWER[s.data[s.start[s.first[i] + k] : s.end[s.first[i] + k]]]) for k in range(s.width)]
    assert jaccard_join.common(a, forged) == sum(words(a, i) == words(forged, i) for i in range(len(a.hash)))


def test_substring_dedup_odd_rows(spark, odd, empty):
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(odd).collect())
    want = sorted((d or 0, n, k) for (d, *_), (n, k, _) in zip(ODD, brute_dedup([r[1] for r in ODD], 35)))
    assert got == want
    assert substring_dedup.substring_dedup(empty).count() == 0
    cut = substring_dedup.stage(spark, odd, "")
    assert cut.columns == odd.columns and {r["doc_id"]: r["text"] for r in cut.collect()} == {d: (" ".join(f"v{i}" for i in range(100)) if d == 8 else t if d != 7 else "") for d, t, *_ in ODD}
    assert substring_dedup.stage(spark, empty, "").count() == 0
    nulls = docs_of(spark, texts(60, 1, longest=90)).selectExpr("CAST(null AS long) AS doc_id", "text")
    found = Counter((r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.substring_dedup(nulls, width=3, group_bytes=500).collect())
    assert found == Counter(brute_dedup(texts(60, 1, longest=90), 3))


def brute_components(ts, n, t):
    sets = []
    for x in ts:
        w = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(ts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("n", "t", "seed"), [(3, 90, 2), (1, 90, 3), (5, 80, 4), (1, 60, 5)])
def test_jaccard_equals_brute_force(spark, n, t, seed):
    ts = texts(150, seed, vocabulary=400 if n == 1 else 40, longest=70)
    got = jaccard_join.jaccard_components(docs_of(spark, ts), n=n, t=t).orderBy("doc_id").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in got] == brute_components(ts, n, t)


@pytest.mark.parametrize("t", [60, 80, 90])
def test_similar_sets_always_share_a_signature(t):
    rng = np.random.default_rng(t)
    for docs in (0, 100, 10**9):
        sign = jaccard_join.Signer([jaccard_join.allocate(lo, hi, docs, t) for lo, hi in jaccard_join.limits(t, 4000)], t)
        for _ in range(150):
            a = int(rng.integers(1, 400))
            base = np.unique(rng.integers(1, 1 << 63, a, dtype=np.uint64))
            drop, add = rng.integers(0, max(1, a * (100 - t) // 100 + 1)), rng.integers(0, max(1, a * (100 - t) // 100 + 1))
            other = np.unique(np.concatenate([base[int(drop) :], rng.integers(1, 1 << 63, int(add), dtype=np.uint64)]))
            both = len(np.intersect1d(base, other))
            alike = len(other) and 100 * both >= t * (len(base) + len(other) - both)
            if alike and not np.array_equal(base, other):
                assert len(np.intersect1d(sign(base), sign(other)))
                x, y = (np.array(jaccard_join.sketch(s), np.int64) for s in (base, other))
                assert sum(bin(int(v) & (1 << 64) - 1).count("1") for v in x ^ y) <= len(base) + len(other) - 2 * both


def test_hot_signatures_are_refined_and_joined_in_blocks(spark):
    """Unlike sets with one long passage in common, and near copies of a few of them, at a bound of 5 sets a signature."""
    rng = random.Random(9)
    shared = [f"s{i}" for i in range(40)]
    ts = []
    for i in range(120):
        own = [f"o{rng.randint(0, 10**9)}" for _ in range(rng.randint(10, 30))]
        ts.append(" ".join(shared + own))
        if i % 10 == 0:
            ts.append(" ".join(shared + own[:-1] + ["end"]))
    got = jaccard_join.jaccard_components(docs_of(spark, ts), n=1, t=90, hot_rows=5).orderBy("doc_id").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in got] == brute_components(ts, 1, 90)


def test_large_sets_skip_their_empty_segments():
    """Before, sets of 1,654 to 2,584 shingles indexed some 50 empty segments each, which any two of them share by chance."""
    for t in (80, 90):
        for low, high in jaccard_join.limits(t, 60_000):
            b = jaccard_join.allocate(low, high, 100_000, t)
            if low >= 100:
                empty = (b.segments - b.deletions) * (1 - 1 / b.segments) ** low
                assert empty + 2 * empty**0.5 <= b.skipped + 1


@pytest.mark.parametrize("small", [2, 24, 1000])
def test_allowed_pairs_equal_plain_loops(small):
    rng = np.random.default_rng(small)
    group = np.sort(rng.choice([1, 2, 3, 5, 8, 8, 8, 8], 400))
    run = np.cumsum(np.append(True, (group[1:] != group[:-1]) | (rng.random(399) < 0.4)))
    base = [np.unique(rng.integers(1, 1 << 63, k, dtype=np.uint64)) for k in (60, 70, 1600)]
    sets = [np.concatenate([own[int(rng.integers(0, len(own) // 4)) :], rng.integers(1, 1 << 63, int(rng.integers(0, 12)), dtype=np.uint64)]) for own in (base[i] for i in rng.integers(0, 3, 400))]
    n = np.array([len(s) for s in sets])
    sketches, wide = (np.array([jaccard_join.sketch(s, bits) for s in sets], np.int64).view(np.uint64) for bits in (jaccard_join.SKETCH, jaccard_join.WIDE))
    large = n >= jaccard_join.LARGE
    at = np.where(large, np.cumsum(large) - 1, -1)
    got = Counter(x for i, j in jaccard_join._allowed(n, run, sketches, wide[large], at, group, 80, small, 512) for x in zip(i.tolist(), j.tolist()))
    want = set()
    for i in range(400):
        for j in range(i + 1, 400):
            most = jaccard_join.differences(int(n[i]), int(n[j]), 80)
            apart = lambda x: int(np.bitwise_count(x[i] ^ x[j]).sum())  # noqa: B023, E731
            if group[i] == group[j] and run[i] != run[j] and abs(n[i] - n[j]) <= most and apart(sketches) <= most and (not (large[i] and large[j]) or apart(wide) <= most):
                want.add((i, j))
    assert set(got) == want and want and max(got.values()) == 1


def test_pairs_of_groups_over_many_batches():
    kind = pa.schema([("sig", pa.int64()), ("cell", pa.int32()), ("part", pa.int64()), ("check", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("sketch", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64()))])
    own = jaccard_join.sketch(np.arange(1, 50, dtype=np.uint64))
    rows = [(g, c, k // 2, 0, 1000 * g + 100 * c - k, 49, own, None) for g, c, size in ((1, 0, 1), (1, 1, 7), (2, 0, 40), (4, 0, 2), (5, 0, 3)) for k in range(size)]
    table = pa.table([list(x) for x in zip(*rows)], schema=kind)
    want = sorted((min(x[4], y[4]), max(x[4], y[4])) for i, x in enumerate(rows) for y in rows[:i] if x[:2] == y[:2] and x[2] != y[2])
    for size in (1, 3, 8, 100):
        batches = table.to_batches(max_chunksize=size)
        got = [x for b in jaccard_join._compare(80)(iter([batches[0].slice(0, 0), *batches])) for x in zip(b["hub"].to_pylist(), b["key"].to_pylist())]
        assert sorted(got) == want


def test_jaccard_odd_rows(spark, odd, empty):
    kept = jaccard_join.stage(spark, odd, "")
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 7, 8, 9]
    assert jaccard_join.stage(spark, empty, "").count() == 0
    got = {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in jaccard_join.jaccard_components(odd).collect()}
    assert {(4, 4, 1), (5, 4, 1), (1, 1, 0), (2, 2, 0), (3, 3, 0), (7, 7, 8998)} <= got
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_components_of_a_long_path(spark):
    order = list(range(60))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame([*zip(order, order[1:]), (100, 101), (101, 100), (102, 102)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {**dict.fromkeys(range(60), 0), 100: 100, 101: 100}


def test_base_counts_equal_brute_force(spark, odd, empty):
    ts = [*texts(40, 6, vocabulary=6), "a#b *\nx\nx\n\n\n x\nx", None, "é é", "! !! A\tB"]
    df = spark.createDataFrame(list(enumerate(ts)), "doc_id long, text string")
    for r in quality_rules.statistics(df).collect():
        t = ts[r["doc_id"]] or ""
        w = split(t)
        at = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {k for i in range(len(w) - 7) if at[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            dup += line in seen and bool(split(line))
            seen.add(line)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(again))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(again) > 30 * len(w))
    assert quality_rules.statistics(odd).count() == len(ODD)
    assert quality_rules.statistics(empty).count() == 0


def test_thresholds_keep_their_promise():
    assert abs(quality_rules.binomial_tail(0, 100, 0.05) - 0.95**100) < 1e-12
    assert quality_rules.binomial_tail(5, 5, 0.3) == 1.0
    assert quality_rules.least_good(4, 0.03, 0.05) == 144 and 0.97**144 <= 0.05 / 4 < 0.97**143
    few = quality_rules.Path(143, 4, 0.03, 0.05)
    few.move({"upper_share": {20: (0, 0, 50)}})
    assert few.ended and few.cutoffs() == {}  # 143 good documents certify nothing at this level
    path = quality_rules.Path(150, 4, 0.03, 0.05)
    path.move({"upper_share": {20: (0, 0, 50), 30: (9, 20, 5)}, "echo_share": {10: (0, 0, 30), 12: (0, 0, 30)}})
    assert path.setting == dict.fromkeys(quality_rules.SIGNALS, -1) | {"echo_share": 12} and path.best == 60
    path.move({"upper_share": {20: (0, 0, 40), 30: (9, 20, 5)}})
    path.move({"upper_share": {30: (0, 20, 5)}})  # it looks free to those that lay the path, and fails the test
    assert path.ended and path.moves == 3 and path.cutoffs() == {"upper_share": quality_rules.GRID[20], "echo_share": quality_rules.GRID[12]}


def test_good_documents_are_safe_with_the_stated_probability():
    """300 draws of labelled documents whose rules truly reject more than alpha from some cutoff on: at most delta of the
    chosen settings go beyond it (a chance of 1e-6 for the bound below)."""
    rng = np.random.default_rng(5)
    signals, grid, alpha, delta = list(quality_rules.SIGNALS), len(quality_rules.GRID), 0.05, 0.1
    odds = np.full((len(signals), grid + 1), 0.0)
    odds[:3, 20:32] = 0.002  # each of three rules rejects 2.4 % of the good ones by cutoff 31, all of them 7 %
    odds[:, grid] = 1 - odds[:, :grid].sum(1)
    wrong = chosen = 0
    for _ in range(300):
        good = np.stack([rng.choice(grid + 1, 450, p=o) for o in odds], 1)
        bad = np.stack([rng.integers(15, 45, 2000) if i < 3 else np.full(2000, grid) for i in range(len(signals))], 1)
        every = np.concatenate([good, bad])
        kind = np.concatenate([np.where(np.arange(450) < 150, 0, 1), np.full(2000, 2)])
        path = quality_rules.Path(300, 1, alpha, delta, good_weight=1.0)
        while not path.ended:
            rest = (every > np.array(list(path.setting.values()))).all(1)
            counts = {}
            for i, s in enumerate(signals):
                by = np.stack([np.bincount(every[rest & (kind == c), i], minlength=grid + 1) for c in range(3)], 1)
                counts[s] = {int(a): tuple(int(x) for x in by[a]) for a in np.flatnonzero(by.sum(1))}
            path.move(counts)
        true = 1 - np.prod([1 - odds[i, : path.chosen[s] + 1].sum() for i, s in enumerate(signals)])
        wrong, chosen = wrong + (true > alpha), chosen + bool(path.cutoffs())
    assert chosen > 250 and wrong <= 300 * delta + 25


def plain_verdicts(rows, labels, alpha=0.03, delta=0.05):
    """Documents (id, lang, counts) kept by plain loops over signals, strata and cutoffs; labels: id -> set of labels."""
    signals = {
        "symbols_a_word": lambda r: r["n_symbols"] / r["n_words"],
        "dup_line_share": lambda r: r["n_dup_lines"] / r["n_lines"],
        "repeat_share": lambda r: r["n_repeat_words"] / r["n_words"],
        "upper_share": lambda r: r["n_upper"] / max(r["n_letters"], 1),
        "bangs_a_word": lambda r: r["n_bangs"] / r["n_words"],
        "echo_share": lambda r: r["n_echoes"] / r["n_words"],
    }
    good = {i: max(x) for i, x in labels.items()}
    held = [r for r in rows if not r["base_failed"] and r["doc_id"] in good]
    strata = {r["lang"] or "" for r in held}
    cut = {}
    for s in strata:
        own = [([f(r) for f in signals.values()], good[r["doc_id"]], zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0) for r in held if (r["lang"] or "") == s]
        n = sum(y == 1 and not lays for _, y, lays in own)

        def rejected(setting):
            """Documents that lay the path, that test it, and bad ones, beyond a setting's cutoffs."""
            hit = [(y, lays) for v, y, lays in own if any(at >= 0 and x > quality_rules.GRID[at] for x, at in zip(v, setting))]
            return sum(y == 1 and lays for y, lays in hit), sum(y == 1 and not lays for y, lays in hit), sum(y == 0 for y, _ in hit)

        setting, best, chosen, going = [-1] * 6, 0, [-1] * 6, n > 0
        while going:
            now = rejected(setting)
            options = []
            for i in range(6):
                for at in range(setting[i] + 1, len(quality_rules.GRID)):
                    then = rejected([*setting[:i], at, *setting[i + 1 :]])
                    options.append((-(then[2] - now[2] - 10 * (then[0] - now[0])), then[0] - now[0], at, i))
            gain, _, end, i = min(options, default=(0, 0, 0, 0))
            if gain >= 0:
                break
            while going and setting[i] < end:
                setting[i] += 1
                g, k, bad = rejected(setting)
                tail = sum(Fraction(comb(n, j)) * Fraction(alpha) ** j * (1 - Fraction(alpha)) ** (n - j) for j in range(k + 1)) if n < 500 else quality_rules.binomial_tail(k, n, alpha)
                going = tail <= delta / len(strata)
                if going and bad - 10 * (g + k) > best:
                    best, chosen = bad - 10 * (g + k), list(setting)
        cut |= {(name, s): quality_rules.GRID[at] for name, at in zip(signals, chosen) if at >= 0}
    return {r["doc_id"]: not r["base_failed"] and not any((name, r["lang"] or "") in cut and f(r) > cut[name, r["lang"] or ""] for name, f in signals.items()) for r in rows}, cut


def test_verdicts_equal_plain_loops(spark, odd, empty):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(4000):
        bad = rng.random() < 0.2
        w = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(20, 30))]
        text = " ".join(x + "#!"[rng.randint(0, 1)] * 2 if bad and rng.random() < 0.5 else x for x in w)
        rows.append((i, text, rng.choice(["en", "en", "en", None])))
        labels += [(i, int(not bad))] * rng.choice([1, 1, 5])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    stats = quality_rules.statistics(docs, carry=("doc_id", "lang")).cache()
    by = {}
    for i, y in labels:
        by.setdefault(i, set()).add(y)
    want, cut = plain_verdicts([r.asDict() for r in stats.collect()], by)
    rules = quality_rules.fit(stats, told)
    assert {(n, s): c for n, cuts in rules.cutoffs.items() for s, c in cuts.items()} == cut and cut
    assert {r["doc_id"]: r["kept"] for r in quality_rules.verdict(stats, rules).collect()} == want
    one = spark.createDataFrame([(0, 1)] * 5000, "doc_id long, quality int")  # copies of a label certify nothing
    assert not any(quality_rules.fit(stats, one).cutoffs.values())


def test_quality_rules_query_and_stage(spark, odd, empty):
    kept = quality_rules.stage(spark, odd, SMALL)
    assert kept.columns == odd.columns and Counter(r["doc_id"] for r in kept.collect()) == {7: 2, 8: 1}
    assert quality_rules.stage(spark, empty, SMALL).count() == 0
    stats = quality_rules.statistics(spark.read.parquet(f"{MIDDLE}/documents.parquet"), carry=("doc_id", "lang"))
    told = {}
    for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect():
        told.setdefault(r["doc_id"], set()).add(r["quality"])
    want, _ = plain_verdicts([r.asDict() for r in stats.collect()], told)
    assert {r["doc_id"]: r["kept"] for r in quality_rules.op4_quality_rules(spark, MIDDLE).collect()} == want
    rows = quality_rules.op4_quality_rules(spark, MIDDLE).collect()
    assert len(rows) == 1000 and not any(r["kept"] and r["base_failed"] for r in rows)
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    assert quality_rules.stage(spark, docs, MIDDLE).count() == sum(r["kept"] for r in rows)


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nX: y", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 3), (6, "u", "é" * 300_000), (7, "u", "é" * 300_000), (None, "u", "<p>x</p>"), (8, "", "one")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    files = warc.archive_pages(pages)
    got = {r["page_id"]: r for r in warc.records(files).collect()}
    first = {}
    for i, _, html in sorted((r for r in rows if r[0]), key=lambda r: r[0]):
        first.setdefault(html or "", i)
    import base64

    for i, _, html in rows:
        raw = (html or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        revisit = i is not None and first[html or ""] != i
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[html or ""]) if revisit else ("response", None))
    parts = warc.read_warc(files, chunk_bytes=100_000).where("page_id = 6").orderBy("chunk_no").collect()
    assert [len(p["data"]) for p in parts] == [100_000] * 6 and [p["last"] for p in parts] == [False] * 5 + [True]
    assert b"".join(p["data"] for p in parts).decode() == rows[5][2]
    assert parts[2]["digest"] == base64.b32encode(hashlib.sha1(b"".join(p["data"] for p in parts[:3])).digest()).decode()
    assert warc.records(warc.archive_pages(pages.limit(0))).count() == 0
    from pyspark.sql import functions as F

    clashing = pages.withColumns({x: F.lit(1) for x in ("id", "digest", "payload", "refers_to", "own", "size", "file")})
    assert {r["page_id"]: r["payload_digest"] for r in warc.records(warc.archive_pages(clashing)).collect()} == {i: r["payload_digest"] for i, r in got.items()}
    lost = warc.write_warc(spark.createDataFrame([(1, "u", bytearray(b"x"), "A", None), (2, "u", None, "B", 1)], "id long, url string, payload binary, digest string, refers_to long"))
    with pytest.raises(Exception, match="has another payload"):
        warc.records(lost).collect()
    with pytest.raises(ValueError, match="within a record"):
        import gzip
        import io

        list(warc.chunks(io.BytesIO(gzip.compress(warc.record(1, "u", b"abc", "D", None) + b"ab"))))


def test_tiff_codecs_round_trip():
    rng = random.Random(3)
    for n in (0, 1, 2, 100, 5000, 30_000):
        for data in (rng.randbytes(n), bytes(rng.choice(b"ab") for _ in range(n)), b"the quick " * (n // 10)):
            assert tiff.lzw_decode(tiff.lzw_encode(data), len(data)) == data
            assert tiff.packbits_decode(tiff.packbits_encode(data), len(data)) == data
    p = tiff.padded(rng.randbytes(30_000))
    for c in (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS):
        for predictor in (1, 2):
            for tile in (None, (48, 16)):
                got = list(tiff.pages(tiff.encode(p, compression=c, predictor=predictor, tile=tile, page_rows=100)))
                assert len(got) == 4 and b"".join(x.pixels for x in got) == p
    broken = tiff.encode(p)[:-40]
    assert [x.error is None for x in tiff.pages(b"nonsense")] == [False]
    assert any(x.error for x in tiff.pages(broken))


def test_tiff_big_endian_sixteen_bits():
    import struct

    pixels = np.arange(12, dtype=">u2").reshape(3, 4)
    body = np.diff(pixels.astype(np.uint16), axis=1, prepend=np.uint16(0)).astype(">u2").tobytes()
    tags = [(256, 4), (257, 3), (258, 16), (259, 1), (273, 8), (277, 1), (278, 3), (279, len(body)), (317, 2)]
    data = b"MM\0*" + struct.pack(">I", 8 + len(body)) + body + struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", t, 4, 1, v) for t, v in tags) + b"\0\0\0\0"
    (page,) = tiff.pages(data)
    assert page.error is None and page.pixels == pixels.tobytes()


def test_tiff_query_and_odd_rows(spark, odd, empty):
    for r in tiff.op5_tiff_pages(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        p = tiff.padded(r["text"].encode())
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(r["text"].encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
    media = tiff.encode_texts(odd)
    got = tiff.tiff_pages(media, carry=("doc_id", "n_bytes", "row")).collect()
    assert all(r["error"] is None for r in got) and len({r["doc_id"] for r in got}) == 10
    files = tiff.folded(tiff.tiff_pages(media, carry=("doc_id", "row")), ("doc_id",)).collect()
    want = sorted((r[0] or 0, hashlib.sha256(tiff.padded((r[1] or "").encode())).hexdigest()) for r in ODD)
    assert sorted((r["doc_id"] or 0, r["payload_sha256"]) for r in files) == want
    assert tiff.folded(tiff.tiff_pages(tiff.encode_texts(empty), carry=("row",)), ()).count() == 0
    styles = Counter((r["compression"], r["predictor"], r["tiled"]) for r in tiff.tiff_pages(tiff.encode_texts(spark.read.parquet(f"{MIDDLE}/documents.parquet"))).select("compression", "predictor", "tiled").collect())
    assert len(styles) == 12 and min(styles.values()) > 40
    assert tiff.tiff_pages(tiff.encode_texts(empty)).count() == 0


def test_toxicity_on_held_out_rows(spark, odd, empty):
    rng = random.Random(5)
    vocabulary = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    bad = {"en": ["vilea", "vileb"], "fr": ["grosa", "grosb"]}
    rows = []
    for i in range(1500):
        lang, toxic = rng.choice(["en", "fr"]), int(rng.random() < 0.2)
        w = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        for _ in range(2 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad[lang]) + rng.choice("xyz"))
        rows.append((i, " ".join(w), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df.select("doc_id", "toxic"))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    held = [(got[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.97
    flipped = df.selectExpr("doc_id", "IF(crc32(cast(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    again = {r["doc_id"]: r["score"] for r in toxicity.score(df, toxicity.fit(df, flipped)).collect()}
    assert again == got  # held-out labels are never read
    assert toxicity.score(odd, model).count() == len(ODD)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(df, df.select("doc_id", "toxic").limit(0))
    assert toxicity.score(df, none).count() == len(rows)


def plain_maximised(votes, toxic, weight, smooth=0.05):
    """The tree of voters and its rates by loops over rows and pairs."""
    k = votes.shape[1]
    parent, fires = [-1] * k, np.zeros((2, 2, k))
    mass = [[sum(w * (t if c else 1 - t) for w, t in zip(weight, toxic))] for c in (0, 1)]
    share = lambda c, test: sum(w * (t if c else 1 - t) for v, w, t in zip(votes, weight, toxic) if test(v))
    info = {}
    for i in range(k - 1):
        for j in range(i):
            total = 0.0
            for c in (0, 1):
                n = mass[c][0]
                for x in (True, False):
                    for y in (True, False):
                        p = share(c, lambda v, i=i, j=j, x=x, y=y: v[i] == x and v[j] == y) / n
                        q = share(c, lambda v, i=i, x=x: v[i] == x) * share(c, lambda v, j=j, y=y: v[j] == y) / n / n
                        total += n * p * np.log(max(p, 1e-12) / max(q, 1e-12)) if p > 0 else 0.0
            info[i, j] = info[j, i] = total
    inside = {0}
    while len(inside) < k - 1:
        gain, j, i = max((info[j, i], -j, -i) for j in range(k - 1) if j not in inside for i in inside)
        inside.add(-j)
        if gain > 3.84 / 2:
            parent[-j] = -i
    for c in (0, 1):
        for i in range(k):
            led = share(c, lambda v, i=i: parent[i] >= 0 and v[parent[i]])
            both = share(c, lambda v, i=i: v[i] and parent[i] >= 0 and v[parent[i]])
            one = share(c, lambda v, i=i: v[i])
            fires[c, 1, i] = (both + smooth) / (led + 2 * smooth)
            fires[c, 0, i] = (one - both + smooth) / (mass[c][0] - led + 2 * smooth)
    prior = mass[1][0] / (mass[0][0] + mass[1][0])
    post = []
    for v in votes:
        odds = prior / (1 - prior)
        for i in range(k):
            if v[i]:
                at = int(parent[i] >= 0 and v[parent[i]])
                odds *= fires[1, at, i] / fires[0, at, i]
        post.append(odds / (1 + odds))
    return parent, fires, np.array(post)


def test_label_model_equals_plain_loops(spark):
    """One step of the model by hand, then a corpus with a voter that repeats another one."""
    rng = np.random.default_rng(1)
    y = rng.random(3000) < 0.2
    votes = np.stack([(rng.random(3000) < np.where(y, a, b)) for a, b in ((0.7, 0.02), (0.6, 0.03), (0.5, 0.02), (0.1, 0.1))], axis=1)
    copy = votes[:, 0] & (rng.random(3000) < 0.97)
    votes = np.concatenate([votes, copy[:, None]], axis=1)
    some = toxicity.with_none(votes[:200])
    soft, weight = rng.random(200), rng.integers(1, 4, 200).astype(float)
    m = toxicity.moments(some, soft, weight)
    model = toxicity.maximised(m, toxicity.tree(m))
    parent, fires, post = plain_maximised(some, soft, weight)
    assert np.allclose(model.fires, np.clip(fires, 1e-6, 1 - 1e-6)) and [{i, int(p)} for i, p in enumerate(model.parent) if p >= 0] == [{i, p} for i, p in enumerate(parent) if p >= 0]
    assert np.allclose(model.posterior(some), post)
    rows, n = np.unique(np.packbits(votes, axis=1), axis=0, return_counts=True)
    patterns = spark.createDataFrame([(bytearray(x.tobytes()), int(c)) for x, c in zip(rows, n)], "votes binary, n long")
    fitted, told = toxicity.label_model(patterns, votes[:300], y[:300].astype(float))
    own = toxicity.with_none(votes)
    assert ((fitted.posterior(own) > 0.5) == y).mean() > 0.93
    assert {0, 4} in [{i, int(p)} for i, p in enumerate(fitted.parent)]  # the copy leans on what it copies
    led = fitted.fires[1, 1] / fitted.fires[0, 1]
    assert abs(np.log(led[4] if fitted.parent[4] == 0 else led[0])) < 0.2  # and tells little beyond it
    assert toxicity.label_model(patterns.limit(0), votes[:300], y[:300].astype(float))[0].posterior(own).shape == (3000,)


def plain_co_training(rows, labels, rounds=4, sure=0.95):
    """Scores by plain numpy: the rounds of co-training over (id, text, lang, source, size)."""
    x = []
    for _, text, lang, source, size in rows:
        raw = (text or "").encode()
        content = co_training.content_features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].astype(float)
        x.append((content, co_training.meta_features([lang], [source], [size])[0].astype(float)))
    x = [np.array([r[v] for r in x]) for v in (0, 1)]
    held = np.array([i in labels and zlib.crc32(str(i).encode()) % 4 == 0 for i, *_ in rows])
    known = np.array([i in labels for i, *_ in rows])
    y = np.array([labels.get(i, -1) for i, *_ in rows])

    def solved(good, bad, weight):
        mean = [(m * w[:, None]).sum(0) / w.sum() for m, w in ((good, weight[0]), (bad, weight[1]))]
        within = sum(((m - u) * w[:, None]).T @ (m - u) for m, u, w in zip((good, bad), mean, weight)) / (weight[0].sum() + weight[1].sum())
        within += np.eye(len(within)) * (0.02 * np.trace(within) / len(within) + 1e-6)
        return np.linalg.solve(within, mean[0] - mean[1])

    def learn(v, said):
        groups, weights = [], []
        for k in (1, 0):
            own = x[v][known & ~held & (y == k)]
            more = x[v][~known][said == k] if said is not None and all((said == j).any() for j in (0, 1)) else own[:0]
            groups.append(np.concatenate([own, more]))
            weights.append(np.concatenate([np.ones(len(own)), np.full(len(more), min(1.0, len(own) / max(len(more), 1)))]))
        w = solved(*groups, weights)
        slope, shift = co_training.logistic((x[v][held] @ w)[:, None], y[held].astype(float))
        return x[v] @ w * slope[0] + shift, w

    logits, ws = zip(*(learn(v, None) for v in (0, 1)))
    for _ in range(rounds):
        p = [1 / (1 + np.exp(-np.clip(z[~known], -30, 30))) for z in logits]
        said = [np.where(q >= sure, 1, np.where(q <= 1 - sure, 0, -1)) for q in p]
        logits, fresh = zip(*(learn(v, said[1 - v]) for v in (0, 1)))
        moved, ws = max(np.abs(a - b).max() for a, b in zip(ws, fresh)), fresh
        if moved < 1e-3:
            break
    both = np.stack(logits, 1)
    w, b = co_training.logistic(both[held], y[held].astype(float), 1.0)
    return {r[0]: 1 / (1 + np.exp(-np.clip(both[i] @ np.maximum(w, 0) + b, -30, 30))) for i, r in enumerate(rows)}


def two_views(n, seed):
    """Documents whose words and whose source each say something about their quality, in ways of their own."""
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        y = int(rng.random() < 0.5)
        words = [rng.choice(["alpha", "beta", "gamma", "delta"] if rng.random() < (0.56 if y else 0.44) else ["omega", "sigma", "tau", "rho"]) for _ in range(60)]
        rows.append((i, " ".join(words), "en", f"s{rng.randint(0, 3) + (0 if rng.random() < (0.97 if y else 0.03) else 4)}", 10))
        truth[i] = y
    return rows, truth


def test_co_training_equals_plain_numpy_and_exchange_helps(spark, odd, empty):
    rows, truth = two_views(3000, 2)
    labels = {i: truth[i] for i in range(160)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    shown = co_training.views(docs).cache()
    told = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    model = co_training.fit(shown, told)
    got = {r["doc_id"]: r["score"] for r in co_training.score(shown, model).collect()}
    want = plain_co_training(rows, labels)
    assert max(abs(got[i] - want[i]) for i in want) < 1e-3
    right = lambda m, col: np.mean([(r[col] >= 0.5) == bool(truth[r["doc_id"]]) for r in co_training.score(shown, m).collect() if r["doc_id"] >= 160])
    alone = co_training.fit(shown, told, rounds=0)
    assert model.report["rounds"][0]["from_metadata"] > 100
    assert right(model, "content_score") > right(alone, "content_score")  # what metadata taught it
    assert right(model, "score") >= max(right(alone, "content_score"), right(alone, "metadata_score"), right(alone, "score"))


def test_co_training_rows(spark, odd, empty):
    rows = co_training.op2_co_training(spark, MIDDLE).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert np.mean([r["keep"] == bool(labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels]) > 0.95
    shown = co_training.views(odd)
    model = co_training.fit(shown, spark.createDataFrame([], "doc_id long, quality int"))
    assert co_training.score(shown, model).count() == len(ODD)
    assert co_training.score(co_training.views(empty), model).count() == 0


def test_edit_aware_counts_equal_full_counts(spark, odd, empty):
    import public_tokenizers

    count = token_counts.counter(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(5)
    parts = ["the", " ", "  ", "\n", "a", "é", "1", "23", ",", "'s", "!!", " of", "x y"]
    for _ in range(600):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        tree = token_counts.Counted(s, count, least=rng.choice([1, 3, 8]))
        for _ in range(4):
            a = rng.randint(0, len(s))
            b, r = min(len(s), a + rng.choice([0, 1, 5, 30])), "".join(rng.choice(parts) for _ in range(rng.randint(0, 3)))
            tree.apply(a, b, r)
            s = s[:a] + r + s[b:]
            assert tree.text() == s and tree.total == count(s) and tree.chars[1] == len(s)
    long = "word " * 20_000
    tree = token_counts.Counted(long, count)
    tree.apply(50_000, 50_004, "other")
    assert tree.encoded < 2000 and tree.total == count(tree.text())
    assert token_counts.edit_aware_counts(empty).count() == 0
    mixed = [*(r[1] for r in ODD), "write to a.b@c.org, or x@y.z now", "漢字，" * 400 + "q@w.de" + "漢字。" * 400, "a" * 300_000 + "@" + "b." * 300_000, "tel +49 (0)30 1234-5678 " * 200]
    got = token_counts.edit_aware_counts(spark.createDataFrame(list(enumerate(mixed)), "doc_id long, text string")).collect()
    assert len(got) == len(mixed)
    for r in got:
        text = mixed[r["doc_id"]] or ""
        assert r["n_tokens"] == count(text)
        after = text
        for e in reversed(token_counts.redactions(text)):
            after = after[: e.start] + e.text + after[e.end :]
        assert (r["n_tokens_after"], r["n_chars_after"]) == (count(after), len(after))
    tree = token_counts.Counted("漢字，" * 5000, count)
    tree.apply(7000, 7001, "x")
    assert tree.encoded < 2000 and tree.total == count(tree.text())
    import time

    begin = time.perf_counter()
    assert len(token_counts.redactions("a" * 500_000 + "@" + "b" * 500_000)) == 0 and len(token_counts.redactions("@a.b" * 250_000)) == 125_000
    assert time.perf_counter() - begin < 5
    assert token_counts.redactions("x" * 100 + "@y.z..") == [token_counts.Edit(36, 104, "[EMAIL]")]
    assert [e.text for e in token_counts.redactions("mail a.b@c.org or +49 (0)30 1234-5678.")] == ["[EMAIL]", "[NUMBER]"]


def fluid(sources, t):
    """Blocks of each source in the ideal mix after t slots."""
    n, w = {s: a for s, a, _ in sources}, {s: b for s, _, b in sources}
    slot = lambda v: sum(min(n[s], w[s] * v) for s in n)
    low = Fraction(0)
    for end in sorted(Fraction(n[s], w[s]) for s in n):
        if slot(end) >= t:
            v = low + (t - slot(low)) / sum(w[s] for s in n if Fraction(n[s], w[s]) > low)
            return {s: min(n[s], w[s] * v) for s in n}
        low = end
    return n


@pytest.mark.parametrize("seed", [3, 64])
def test_pfair_deviates_less_than_a_block(spark, seed):
    rng = random.Random(seed)
    for sources in ([("a", 5, 1), ("b", 7, 3), ("c", 20, 6)], [(f"s{i}", rng.randint(1, 25), rng.randint(1, 50)) for i in range(7)], [("only", 4, 3)]):
        got = mixing.schedule(spark.createDataFrame(sources, "s string, n long, w long")).orderBy("slot").collect()
        assert [r["slot"] for r in got] == list(range(sum(n for _, n, _ in sources)))
        assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
        done = Counter()
        for r in got:
            assert r["k"] == done[r["s"]]
            done[r["s"]] += 1
            assert all(abs(done[s] - x) < 1 for s, x in fluid(sources, r["slot"] + 1).items())


def test_mixing_rows(spark, odd, empty):
    out = mixing.mix_sources(odd, block_size=1000).collect()
    assert len(out) == len(ODD)
    by = {}
    for r in out:
        by.setdefault(r["source"] or "", []).append(r)
    for rows in by.values():
        assert all(0 <= r["within"] < 1000 for r in rows)
        rows.sort(key=lambda r: r["block"])
        assert all(a["slot"] <= b["slot"] for a, b in zip(rows, rows[1:]))
    given = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, weight double")
    assert mixing.mix_sources(odd, given, block_size=1000).count() == len(ODD)
    assert mixing.mix_sources(empty).count() == 0
    staged = mixing.stage(spark, odd, "")
    assert staged.columns == odd.columns and Counter(r["doc_id"] for r in staged.collect()) == Counter(r[0] for r in ODD)
    assert mixing.stage(spark, empty, "").count() == 0
    size = {d: max(1, len(t or "")) for d, t, *_ in ODD}
    for rows in by.values():  # each row begins where the one before it in its source ends
        rows.sort(key=lambda r: r["block"] * 1000 + r["within"])
        begin = [r["block"] * 1000 + r["within"] for r in rows]
        assert begin[0] == 0 and [b - a for a, b in zip(begin, begin[1:])] == [size[r["doc_id"]] for r in rows[:-1]]


def test_packing_equals_plain_best_fit():
    rng = random.Random(2)
    for _ in range(150):
        size = rng.choice([10, 17, 64])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 80))]
        bins = []
        for x in sorted(lengths, reverse=True):
            open_ = [i for i, room in enumerate(bins) if room >= x]
            if open_:
                bins[min(open_, key=bins.__getitem__)] -= x
            else:
                bins.append(size - x)
        held = {}
        for p in packing.best_fit_decreasing(Counter(lengths), size):
            for i in range(p.count):
                held.setdefault(p.sequence + i // p.each, []).append((p.offset + i % p.each * p.length, p.length))
        assert sorted(x for v in held.values() for _, x in v) == sorted(lengths)
        assert len(held) == len(bins)
        for v in held.values():
            ends = np.cumsum([x for _, x in sorted(v)])
            assert [o for o, _ in sorted(v)] == [0, *ends[:-1]] and ends[-1] <= size


def test_packing_rows(spark, odd, empty):
    import public_tokenizers

    words = packing.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    odd_texts = ["", "The the THE.", "İx ΣΑΣ ΟΔΟΣ", "a<|endoftext|>b", "\x1c\x85\xa0", "don't it's", "ﬁ Å 中文 한가", "a.b x... ½²", None, "é é"]
    for t, ids in zip(odd_texts, words.encode(odd_texts)):
        assert list(np.frombuffer(ids, "<u4")) == (words.tok.encode(t, add_special_tokens=False).ids if t else [])
    got = packing.best_fit_packing(odd, size=256).collect()
    for doc in {r[0] for r in ODD}:
        text = next(r[1] for r in ODD if r[0] == doc) or ""
        ids = [*words.tok.encode(text, add_special_tokens=False).ids, 1]
        own = sorted(((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == doc))
        want = [(k // 256, k, len(ids[k : k + 256]), zlib.crc32(np.array(ids[k : k + 256], "<u4").tobytes())) for k in range(0, len(ids), 256)]
        assert own == sorted(want * sum(r[0] == doc for r in ODD))
    at = {}
    for r in got:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in at.values():
        v.sort()
        assert [o for o, _ in v] == [0, *np.cumsum([n for _, n in v])[:-1]] and sum(n for _, n in v) <= 256
    assert packing.best_fit_packing(empty).count() == 0
    assert packing.stage(spark, odd, "").count() == len(packing.best_fit_packing(odd).collect()) and packing.stage(spark, empty, "").count() == 0


def test_sequences_follow_the_mix(spark, tmp_path):
    """Documents of one length fill sequences in the order of files and rows, whatever their ids."""
    from pyspark.sql import functions as F

    docs = spark.range(3000).select((F.lit(5000) - F.col("id")).alias("doc_id"), F.lit("one two three").alias("text"), F.col("id").alias("place"))
    docs.repartitionByRange(7, "place").sortWithinPartitions("place").select("doc_id", "text").write.parquet(str(tmp_path / "mixed"))
    got = packing.stage(spark, spark.read.parquet(str(tmp_path / "mixed")), "").orderBy("sequence_id", "offset").collect()
    assert [r["doc_id"] for r in got] == list(range(5000, 2000, -1)) and [r["sequence_id"] for r in got] == sorted(r["sequence_id"] for r in got)


def test_pipeline_stages(spark):
    import corpus_pipeline
    from tidemill.llm.shared import written

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SMALL), name)
        steps[name] = docs
        if name != "best_fit_packing":
            assert docs.dtypes == before.dtypes
    ids = lambda name: [r["doc_id"] for r in steps[name].select("doc_id").collect()]
    kept = steps["quality_rules"].orderBy("doc_id").collect()
    found = brute_components([r["text"] for r in kept], 5, 80)
    assert sorted(ids("ngram_jaccard_join")) == [kept[i]["doc_id"] for i, (_, c) in enumerate(found) if c == i]
    rest = steps["ngram_jaccard_join"].orderBy("doc_id").collect()
    cut = {r["doc_id"]: r["text"] for r in steps["substring_dedup"].collect()}
    for r, (_, removed, text) in zip(rest, brute_dedup([r["text"] for r in rest], 35)):
        assert cut[r["doc_id"]] == (text if removed else r["text"])
    assert sorted(ids("mix_sources")) == sorted(cut)
    order = [r["doc_id"] for r in mixing.mix_sources(steps["substring_dedup"]).orderBy("slot", "within").collect()]
    at = {d: i for i, d in enumerate(order)}
    stream = [r["doc_id"] for r in steps["mix_sources"].select("doc_id", packing.file_order(steps["mix_sources"]).alias("at")).orderBy("at").collect()]
    assert [at[d] for d in stream] == sorted(at.values())
    # the packed rows: every piece as a plain tokeniser cuts it, sequences without gaps, numbered by their first piece in the mix
    import public_tokenizers

    tok = packing.tokenizer(public_tokenizers.path("word_bpe_49k.json")).tok
    packed = {}
    sequences = {}
    for r in steps["best_fit_packing"].collect():
        packed[r["doc_id"], r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], at[r["doc_id"]], r["piece"]))
    want = {}
    for d, text in cut.items():
        run = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(run), 4096):
            want[d, k // 4096] = (k, len(run[k : k + 4096]), zlib.crc32(np.array(run[k : k + 4096], "<u4").tobytes()))
    assert packed == want
    for v in sequences.values():
        v.sort()
        assert [o for o, *_ in v] == [0, *np.cumsum([n for _, n, *_ in v])[:-1]]
    first = [min(x[2:] for x in sequences[i]) for i in sorted(sequences)]
    assert first == sorted(first)


def test_queries_equal_their_sql(spark):
    import os

    import duckdb

    from tidemill.llm import registry

    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    for name, sql in registry.sql().items():
        got = registry.queries()[name](spark, SMALL).toPandas()
        want = c.sql(sql).df()
        key = sorted(got.columns)
        a, b = (x[key].astype(object).where(x[key].notna(), None).map(lambda v: str(int(v)) if isinstance(v, float) else str(v)).sort_values(key).reset_index(drop=True) for x in (got, want))
        assert a.equals(b), name


@pytest.fixture(scope="module")
def odd_dir(spark, odd, tmp_path_factory):
    """The odd rows as a data folder: documents, labels (some repeated, some null) and pages."""
    at = tmp_path_factory.mktemp("odd")
    odd.write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame([(i, (i or 0) % 2, (i or 0) % 3 // 2) for i in (1, 4, 5, 6, 7, 7, 8, None)], "doc_id long, quality int, toxic int").write.parquet(str(at / "labels.parquet"))
    odd.selectExpr("doc_id AS page_id", "source AS url", "text AS html", "1 AS payload", "2 AS digest").write.parquet(str(at / "pages.parquet"))
    return str(at)


@pytest.fixture(scope="module")
def empty_dir(spark, odd_dir, tmp_path_factory):
    at = tmp_path_factory.mktemp("empty")
    for name in ("documents", "labels", "pages"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(str(at / f"{name}.parquet"))
    return str(at)


def test_queries_on_odd_and_empty_tables(spark, odd_dir, empty_dir):
    from tidemill.llm import registry

    for name, q in registry.queries().items():
        rows = q(spark, odd_dir).collect()
        of = Counter(r["page_id" if name.startswith("op1_") else "doc_id"] for r in rows if "piece" not in r or r["piece"] == 0)
        assert of == Counter(r[0] for r in ODD), name
        assert q(spark, empty_dir).count() == 0, name


def test_pipeline_on_odd_and_empty_tables(spark, odd_dir, empty_dir):
    import corpus_pipeline

    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, odd_dir).collect()}
    assert kept == {7, 8}  # 20 words or more; row 7 twice
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
