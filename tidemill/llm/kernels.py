"""Array kernels shared by the corpus operators: word boundaries, word hashes and window hashes.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. All kernels work on the value buffer of an
Arrow string column, without making a Python object per word.

Both hashes are universal: their bounds hold for any two inputs over the draw of the key, which a seed gives. A word is
hashed by the multilinear form sum of (byte + 1) * key[place] modulo 2**64, with a random 64-bit key for each place: two
given words collide with a chance of 2**-56 at most. A window is a polynomial in a random base over the field of
2**61 - 1: two given windows of w unlike word hashes collide with a chance of w / 2**61 at most.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 18  # bytes hashed at a time; they stay in a core's cache
LONG = 1 << 16  # longer words are hashed by keyed BLAKE2b
M61 = (1 << 61) - 1
U64 = np.uint64
SEP = np.zeros(256, bool)
SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


LETTER = np.arange(1, 257, dtype=U64)
FOLDED = LETTER.copy()
FOLDED[65:91] = LETTER[97:123]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=8)
def word_key(seed: int) -> np.ndarray:
    """A random 64-bit number for each place in a word."""
    return np.random.Generator(np.random.Philox(key=seed)).integers(0, 1 << 64, LONG, U64)


@lru_cache(maxsize=8)
def window_base(seed: int) -> int:
    return int(np.random.Generator(np.random.Philox(key=seed + (1 << 64))).integers(1 << 60, M61 - 1))


class Words(NamedTuple):
    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if large else np.int32, count=len(column) + 1, offset=column.offset * (8 if large else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def parts(column: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about most bytes at a time: first row, last row + 1, bytes, offsets."""
    data, offs = buffers(column)
    n, a = len(offs) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def bounds(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each word's document, first byte and last byte + 1, and which bytes belong to words."""
    n = len(data)
    solid = ~sep[data]
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, solid
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offs[(offs > 0) & (offs < n)]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return np.searchsorted(offs, start, "right") - 1, start, end, solid


def words(data: np.ndarray, offs: np.ndarray, fold: bool = False, sep: np.ndarray = SEP, seed: int = 0) -> Words:
    """Every word with its hash, its document's index and its bytes' place. fold: A-Z count as a-z. sep: bytes between words."""
    doc, start, end, solid = bounds(data, offs, sep)
    if not len(start):
        return Words(np.zeros(0, U64), doc, start, end)
    return Words(rehash(data, start, end, solid, fold, seed), doc, start, end)


def word_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray, solid: np.ndarray) -> np.ndarray:
    """A number for each word, the same for equal words alone: no hash stands for a word."""
    at = np.concatenate([[0], np.cumsum(end - start)])
    column = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data[solid])])
    return column.dictionary_encode().indices.to_numpy()


def rehash(data: np.ndarray, start: np.ndarray, end: np.ndarray, solid: np.ndarray, fold: bool = False, seed: int = 0) -> np.ndarray:
    """The hashes of the words at these places under a seed; solid: which bytes belong to words."""
    letters, key = FOLDED if fold else LETTER, word_key(seed)
    out, i = np.empty(len(start), U64), 0
    while i < len(start):
        base = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, base + SLICE, "right")))
        size = (end[i:j] - start[i:j]).astype(np.int32)
        long = np.flatnonzero(size > LONG)
        if len(long):  # a long word goes alone
            j = i + max(1, int(long[0]))
            size = size[: j - i]
        if size[0] > LONG:
            own = data[base : end[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(own.lower() if fold else own, digest_size=8, key=seed.to_bytes(16, "little")).digest(), "little")
        else:
            part = slice(base, int(end[j - 1]))
            begin = np.cumsum(size, dtype=np.int32) - size
            place = np.arange(begin[-1] + size[-1], dtype=np.int32) - np.repeat(begin, size)
            out[i:j] = np.add.reduceat(letters[data[part][solid[part]]] * key[place], begin)
        i = j
    return mix(out)


#: Bytes between letters and digits; UTF-8's bytes from 128 on count as letters.
PUNCT = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def prefixes(data: np.ndarray, w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of at least k bytes (indices) and the folded hash of their first k bytes."""
    at = np.flatnonzero(w.end - w.start >= k)
    h = np.full(len(at), k * 0x5851F42D4C957F2D & (1 << 64) - 1, U64)
    for i in range(k):
        h = h * U64(BASE) + FOLDED[data[w.start[at] + i]]
    return at, mix(h)


def _times(x: np.ndarray, p: int) -> np.ndarray:
    """x * p modulo 2**61 - 1, up to a multiple that add() takes out; x below 2**62, p below 2**61."""
    high, low = x >> U64(31), x & U64((1 << 31) - 1)
    ph, pl = U64(p >> 31), U64(p & (1 << 31) - 1)
    mid = high * pl + low * ph
    return high * (ph << U64(1)) + (mid >> U64(30)) + ((mid & U64((1 << 30) - 1)) << U64(31)) + low * pl


def _folded(x: np.ndarray) -> np.ndarray:
    return (x & U64(M61)) + (x >> U64(61))


def rabin_karp(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """The polynomial hash of each run of width values: sum of h[i+j] * base**(width-1-j) modulo 2**61 - 1, spread over 64 bits.

    A run's hash comes from those of its halves, so all runs take about 2 log2(width) vector operations.
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    base = window_base(seed)
    acc, a, cur, w, rest = None, 0, _folded(h), 1, width
    while rest:
        p = pow(base, w, M61)
        if rest & 1:
            if acc is None:
                acc, a = cur, w
            else:
                k = len(h) - (a + w) + 1
                acc, a = _folded(_times(acc[:k], p) + cur[a : a + k]), a + w
        rest >>= 1
        if rest:
            cur, w = _folded(_times(cur[:-w], p) + cur[w:]), 2 * w
    acc = _folded(acc[:n])
    return mix(acc - U64(M61) * (acc >= U64(M61)))


def windows(w: Words, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First word of each window that lies in one document, and the window's hash."""
    n = len(w.hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    at = np.flatnonzero(w.doc[:n] == w.doc[width - 1 :])
    return at, rabin_karp(w.hash, width, seed)[at]


def same_bytes(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether the i-th span of a and the i-th span of b, none empty, hold bytes of equal value in a table."""
    size = a_end - a_start
    out = size == b_end - b_start
    at = np.flatnonzero(out)
    if len(at):
        size = size[at]
        begin = np.cumsum(size) - size
        place = np.arange(begin[-1] + size[-1]) - np.repeat(begin, size)
        out[at] = np.logical_and.reduceat(table[a[np.repeat(a_start[at], size) + place]] == table[b[np.repeat(b_start[at], size) + place]], begin)
    return out


def covered(at: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of the given words."""
    edge = np.bincount(at, minlength=n + 1)[: n + 1] - np.bincount(at + width, minlength=n + 1)[: n + 1]
    return np.cumsum(edge[:n]) > 0


def draw(seed: int | None) -> int:
    """A seed; a fresh one for None."""
    return secrets.randbits(64) if seed is None else seed


def squeeze(sorted_hashes: np.ndarray) -> bytes:
    """Sorted hashes as byte planes of their differences; the high planes are mostly zero, which block compression removes."""
    return np.diff(sorted_hashes, prepend=U64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unsqueeze(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(U64).ravel(), dtype=U64)
