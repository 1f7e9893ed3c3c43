"""Alignment of two tokenizers against a plain version, on odd rows and on empty tables."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tidemill.llm import alignment
from tidemill.llm.shared import documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)), st.integers(1, 9))
def test_common_ends_are_those_of_both(a, b, work):
    x, y = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    i, j = alignment.common_ends(x, y, work)
    both = sorted(a & b)
    assert x[i].tolist() == both and y[j].tolist() == both


def test_diagonals_cut_the_merge_into_equal_pieces():
    rng = random.Random(5)
    for _ in range(200):
        a, b = (np.array(sorted(rng.sample(range(50), rng.randint(1, 40)))) for _ in range(2))
        merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
        at = np.arange(len(merged) + 1)
        assert alignment.diagonals(a, b, at).tolist() == [sum(side == 0 for _, side in merged[:k]) for k in at]


def test_each_entry_of_the_vocabulary_is_encoded_as_itself():
    """So merging by ranks is the same as by pairs (see ByteLevel)."""
    first = alignment.ByteLevel(A)
    merges = Tokenizer(Tokenizer.from_file(A).model)  # without the split into words
    known = {w: i for w, i in merges.get_vocab().items() if w != "<|endoftext|>"}
    assert all(merges.encode(w, add_special_tokens=False).ids == [i] for w, i in known.items())
    of = alignment.byte_letters()
    assert {bytes(of[c] for c in w): i for w, i in known.items()} == {b: i for i, b in enumerate(first.vocabulary.bytes) if b is not None}
    with open(A, encoding="utf-8") as f:
        model = json.load(f)["model"]
    order = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    assert order == sorted(order)  # ids are in the order of merges


def test_fast_ids_equal_the_library():
    rng, tok = random.Random(1), Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    first = alignment.ByteLevel(A)
    letters = [chr(c) for c in range(0x250)] + [" "] * 60 + list("aeiouthersn'") * 12
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) + rng.choice(["", "<|endoftext|>", "  ", "\n\n x", " don't", "界"])
        assert first.ids(text) == tok.encode(text, add_special_tokens=False).ids, repr(text)


def plain(rows):
    tok, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    letters = alignment.byte_letters()
    links, pairs, out = [], Counter(), []
    for _, text in rows:
        a = b = []
        if text:
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
        size = lambda p: 1 if len(p) == 6 and p.startswith("<0x") else len(p.replace("▁", " ").encode())
        raw_a = [bytes(letters[c] for c in tok.id_to_token(i)) for i in a]
        raw_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(model.id_to_piece, b)]
        if text and (b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode()):
            a = b = raw_a = raw_b = []
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        own, groups, i, j = [], [], 0, 0
        for e in both:
            x, y = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            own.append((a[x - 1], b[y - 1]))
            i, j = x, y
        pairs.update(own)
        links.append(own)
        out.append((len(a), len(b), len(both), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    return sorted(((d, *o[:4], sum(pairs[x] == best[x[1]] for x in own), sum(pairs[x] for x in own), o[4]) for (d, _), o, own in zip(rows, out, links)), key=repr)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


@pytest.mark.parametrize("chunk,work", [(4 << 20, 1 << 16), (3_000, 7)])
def test_documents_equal_the_plain_version(spark, chunk, work):
    docs = documents(spark, SMALL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert shown(alignment.align_tokenizers(docs.repartition(3), chunk_bytes=chunk, work=work)) == plain(rows)


def test_odd_rows_and_empty_tables(spark, odd, empty):
    more = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(20, "a▁b"), (21, "  two  spaces "), (22, "<s> </s> <unk> <0x41>"), (23, "界🙂 mixed\u0000nul"), (24, "\n\t")], "doc_id long, text string"))
    rows = [(r["doc_id"], r["text"]) for r in more.collect()]
    got = shown(alignment.align_tokenizers(more))
    assert got == plain(rows) and (20, 0, 0, 0, 0, 0, 0, "") in got
    assert alignment.align_tokenizers(empty).count() == 0


def test_buckets_add_up_what_chunks_send(spark):
    """Many buckets: pairs are spread by their hash, and the greatest count of a B id is over all buckets."""
    docs = documents(spark, SMALL).select("doc_id", "text")
    whole = shown(alignment.align_tokenizers(docs))
    assert shown(alignment.align_tokenizers(docs, chunk_bytes=2_000, bucket_pairs=500)) == whole
    codes = np.arange(5000, dtype=np.int64) * 7919
    order, own, at = alignment._bucketed(codes, 6)
    assert len(own) == 64 and sorted(order.tolist()) == list(range(5000)) and at[0] == 0
