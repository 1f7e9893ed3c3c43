"""Edit-aware token counts: a document keeps a segment tree over runs of pre-tokens, whose nodes hold characters and
tokens below them. An edit re-encodes only the runs that it touches, with their neighbours where a boundary no longer
holds, and updates the sums above them.

Runs are cut where a pre-token must begin whatever lies on either side: before a single space that follows a character
and precedes one, none of them white space, and between a letter or number and a mark. The byte-level pattern always starts
a pre-token there, so counts of runs add up to the count of the text. A stretch of letters alone or of marks alone is one
pre-token under that pattern, so an edit in it encodes it whole, as any exact count must.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.llm import kernels as K
from tidemill.llm.shared import documents

Count = Callable[[str], int]


class Edit(NamedTuple):
    """Replace text[start:end]; a document's edits don't overlap and are in order."""

    start: int
    end: int
    text: str


CUT = re.compile(r"(?<=\S) (?=\S)|(?<=[^\W\d_])(?=[^\w\s])")


def cuts(text: str, least: int = 512) -> list[str]:
    """The text in runs of at least so many characters."""
    out, a = [], 0
    while m := CUT.search(text, a + least):
        out.append(text[a : m.start()])
        a = m.start()
    return [*out, text[a:]] if a < len(text) or not out else out


def joined(left: str, right: str) -> bool:
    """Whether the border between two runs is not one of cuts()."""
    return not (left and right and CUT.match(left[-1] + right[:2], 1))


class Counted:
    """A text's runs and a segment tree of their characters and tokens."""

    def __init__(self, text: str, count: Count, least: int = 512) -> None:
        self.count, self.runs, self.encoded = count, cuts(text, least), 0
        self.n = 1 << max(0, len(self.runs) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.n), [0] * (2 * self.n)
        for i, run in enumerate(self.runs):
            self.chars[self.n + i], self.tokens[self.n + i] = len(run), count(run)
        for i in range(self.n - 1, 0, -1):
            self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.runs)

    def find(self, at: int) -> tuple[int, int]:
        """The run that holds character at, and its place in it; the last full run for the text's end."""
        if at >= self.chars[1] and at:
            i, off = self.find(at - 1)
            return i, off + 1
        i = 1
        while i < self.n:
            i *= 2
            if at >= self.chars[i]:
                at -= self.chars[i]
                i += 1
        return min(i - self.n, len(self.runs) - 1), at

    def _set(self, i: int, run: str, tokens: int) -> None:
        self.runs[i] = run
        k = self.n + i
        dc, dt = len(run) - self.chars[k], tokens - self.tokens[k]
        while k:
            self.chars[k] += dc
            self.tokens[k] += dt
            k >>= 1

    def _near(self, i: int, step: int) -> int | None:
        i += step
        while 0 <= i < len(self.runs):
            if self.runs[i]:
                return i
            i += step
        return None

    def apply(self, start: int, end: int, text: str) -> None:
        """Replaces characters start to end of the text as it is now."""
        a, off = self.find(start)
        b, last = (a, off) if end <= start else self.find(end - 1)
        last += end > start
        region = self.runs[a][:off] + text + self.runs[b][last:]
        for i in range(a + 1, b + 1):
            self._set(i, "", 0)
        while (left := self._near(a, -1)) is not None and joined(self.runs[left], region):
            region = self.runs[left] + region
            self._set(a, "", 0)
            a = left
        right = a
        while (right := self._near(right, 1)) is not None and joined(region, self.runs[right]):
            region += self.runs[right]
            self._set(right, "", 0)
        self.encoded += len(region)
        self._set(a, region, self.count(region) if region else 0)

    def edit(self, edits: list[Edit]) -> None:
        """Applies edits that are in the text's present offsets, the last first."""
        for e in reversed(edits):
            self.apply(e.start, e.end, e.text)


LOCAL = re.compile(r"[^\s@<>()\[\],;:\"]+\Z")
DOMAIN = re.compile(r"[^\s@<>()\[\],;:\"]+")
NUMBER = re.compile(r"\+?\d(?:[ .()/-]{0,2}\d){7,}")


def addresses(text: str, most: int = 64) -> Iterator[Edit]:
    """E-mail addresses, found outward from each '@': at most so many characters before it, and a dotted name after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        local = LOCAL.search(text[max(done, at - most) : at])
        domain = DOMAIN.match(text, at + 1)
        name = domain[0].rstrip(".") if domain else ""
        if local and name.find(".", 1) > 0:
            done = at + 1 + len(name)
            yield Edit(at - len(local[0]), done, "[EMAIL]")
        at = text.find("@", at + 1)


def redactions(text: str) -> list[Edit]:
    """Edits that replace e-mail addresses and long numbers by a mark."""
    found = [*addresses(text), *(Edit(m.start(), m.end(), "[NUMBER]") for m in NUMBER.finditer(text))]
    out: list[Edit] = []
    for e in sorted(found):
        if not out or e.start >= out[-1].end:
            out.append(e)
    return out


_LOADED: dict[str, Count] = {}


def counter(path: str) -> Count:
    """Tokens of a text under a file of byte-level ranks, loaded once a worker."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _LOADED[path] = lambda text: len(encoding.encode_ordinary(text))
    return _LOADED[path]


def edit_aware_counts(docs: DataFrame, edits: Callable[[str], list[Edit]] = redactions, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", least: int = 512) -> DataFrame:
    """One row per input row: id, n_tokens, n_edits, n_tokens_after the edits, n_chars_after, encoded_chars (re-encoded).

    edits(text) gives a text's edits. Null and empty texts have 0 tokens and are edited as ''. Repeated rows count each; an
    empty table gives an empty result; columns beside id and text are not read. path: the tokenizer's file of ranks.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    base = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    names = ["n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "encoded_chars"]
    schema = T.StructType([base.schema[0], *[T.StructField(n, T.LongType()) for n in names]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            column = batch.column(1)
            for a, b, _, _ in K.parts(column):
                rows = []
                for text in column.slice(a, b - a).to_pylist():
                    tree = Counted(text or "", count, least)
                    before, changes = tree.total, edits(text or "")
                    tree.edit(changes)
                    rows.append((before, len(changes), tree.total, tree.chars[1], tree.encoded))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(arrow.field(0).type), *(pa.array(c, pa.int64()) for c in zip(*rows))], schema=arrow)

    return base.mapInArrow(run, schema)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_aware_counts(documents(spark, sf_dir))


QUERIES = {"op7_token_counts": op7_token_counts}
