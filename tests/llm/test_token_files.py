"""Token block files against plain encodings, round trips, on odd rows and on empty tables."""

import json
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import MIDDLE
from tidemill.llm import packing, token_blocks
from tidemill.llm.shared import documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 3), max_size=900), st.sampled_from([0, 0.5, 0.9, 1]))
def test_blocks_give_back_what_was_packed(ids, percentile):
    x = np.array(ids, np.uint32)
    words, start = token_blocks.pack(x, percentile)
    assert token_blocks.unpack(words, start).tolist() == ids
    assert token_blocks.unpacked(token_blocks.packed(x)).tolist() == ids
    for k, s in enumerate(start):  # any block without the others
        end = start[k + 1] if k + 1 < len(start) else len(words)
        assert token_blocks.unpack(words[s:end], np.zeros(1, np.int64)).tolist() == ids[256 * k : 256 * (k + 1)]


def test_outliers_are_exceptions_and_the_rest_is_narrow():
    x = np.arange(4096, dtype=np.uint32) % 16 + 1000
    x[::100] = 49_000
    words, start = token_blocks.pack(x)
    assert (words[start + 1] & 255 == 4).all() and (words[start] == 1000).all() and (words[start + 1] >> 17).sum() == 41
    assert len(words) < 16 * (2 + 8 * 4) + 41 * 2 + 16


@pytest.mark.parametrize("chunk", [256, 1024])
def test_a_file_is_read_by_ranges_of_blocks(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(token_blocks, "CHUNK", chunk)
    rng = random.Random(3)
    docs = [(None if i == 0 else i, np.array([rng.randint(0, 49_407) for _ in range(rng.choice([1, 2, 700]))], "<u4")) for i in range(40)]
    fs = pafs.LocalFileSystem()
    out = token_blocks.Writer(fs.open_output_stream(str(tmp_path / "x.ids")), 0.9)
    for d, ids in docs:
        out.add(d, ids.tobytes())
    assert out.close() == os.path.getsize(tmp_path / "x.ids")
    with fs.open_input_file(str(tmp_path / "x.ids")) as f:
        c = token_blocks.contents(f)
        whole = np.concatenate([ids for _, ids in docs])
        assert [int(d) if k else None for d, k in zip(c.doc, c.known)] == [d for d, _ in docs] and c.length.tolist() == [len(ids) for _, ids in docs]
        for first in range(0, len(c.start), 3):
            assert (token_blocks.blocks(f, c.start, c.end, first, first + 2) == whole[256 * first : 256 * (first + 2)]).all()
    with open(tmp_path / "x.ids", "rb+") as f:
        f.truncate(os.path.getsize(tmp_path / "x.ids") - 1)
    with fs.open_input_file(str(tmp_path / "x.ids")) as f, pytest.raises(ValueError):
        token_blocks.contents(f)


def plain(rows):
    """doc_id, start, n_tokens, ids_crc32 and ids by the library alone; rows of (doc_id, text) in the input's order."""
    tok, at, out = Tokenizer.from_file(PATH), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        out.append((d, at, len(ids) // 4, zlib.crc32(ids), ids))
        at += len(ids) // 4
    return out


def read(files):
    return sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in token_blocks.read_ids(files).collect()) if files.count() else []


def test_files_hold_all_documents_in_order(spark):
    docs = documents(spark, MIDDLE)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    files = token_blocks.write_ids(docs.repartition(7), task_bytes=200_000, roll=20_000)
    assert files.count() > 12 and read(files) == sorted(plain(rows))
    short = token_blocks.read_ids(files, with_ids=False).drop("ids").collect()
    assert sorted(map(tuple, short)) == sorted(x[:4] for x in plain(rows))


def test_odd_rows_empty_tables_and_given_folders(spark, odd, empty, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    folder = f"file://{tmp_path}/ids"
    files = token_blocks.write_ids(odd, folder=folder)
    got = [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in token_blocks.read_ids(files).collect()]
    assert sorted(got, key=lambda r: r[1]) == plain(rows)
    assert files.where(f"NOT startswith(file, '{folder}/')").isEmpty()
    none = token_blocks.write_ids(empty)
    assert none.count() == 0 and token_blocks.read_ids(none).count() == 0
    assert not spark._jvm.org.apache.hadoop.fs.FileSystem.getLocal(spark._jsc.hadoopConfiguration()).cancelDeleteOnExit(spark._jvm.org.apache.hadoop.fs.Path(folder))


def merged(symbols, ranks):
    """BPE by pairs, the plain way: the pair of least rank first, from the left."""
    while len(symbols) > 1:
        best = min(range(len(symbols) - 1), key=lambda i: ranks.get((symbols[i], symbols[i + 1]), 1 << 60))
        if (symbols[best], symbols[best + 1]) not in ranks:
            break
        symbols = [*symbols[:best], symbols[best] + symbols[best + 1], *symbols[best + 2 :]]
    return symbols


def test_plain_texts_are_encoded_as_the_library_does():
    with open(PATH, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ranks = {p: i for i, p in enumerate(pairs)}
    ids = [model["vocab"]["".join(p)] for p in pairs]
    assert ids == sorted(ids)  # ids are in the order of merges
    for w in model["vocab"]:  # each entry is encoded as itself
        if not w.startswith("<|"):
            own = w.removesuffix("</w>")
            letters = [*own[:-1], own[-1] + "</w>"] if w.endswith("</w>") else [*own]
            assert merged(letters, ranks) == [w]
    rng, tok, ours = random.Random(2), Tokenizer.from_file(PATH), packing.WordIds(PATH)
    letters = [chr(c) for c in range(0x250)] + [" "] * 80 + list("aeiourstnl'.,7") * 12 + ["'s", "'ll ", "...", "<|endoftext|>", "界"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(1500)] + ["don't 'tis ''s 's. it'sx'll 12.5% İ²", "\n \t", "'"]
    got = [np.frombuffer(x, "<u4").tolist() for x in ours.encode(texts)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    plain = [t for t in texts if ours.plain.takes(t)]
    assert len(plain) > 20 and [ours.plain.encode(t) for t in plain] == ours._by_words(plain)
