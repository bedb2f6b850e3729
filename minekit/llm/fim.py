"""Fill-in-middle transformation with memoised chunks.

A rolling hash cuts texts where their content says so, so that equal passages give equal chunks wherever they
stand. A chunk's summary (tokens, code points, whether a letter stands at either end) is kept in a cache under its
content; a chunk met again is compared byte by byte with what the cache holds. The tokens of a text are the sum of
its chunks' tokens, less one at every boundary that parts a run of letters; running sums find the chunk that holds a
cut, and only that chunk is searched.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import in_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of a chunk: at least, about on top of that, and at most.
LEAST, MEAN, MOST = 64, 256, 4096
#: Bytes of chunks that a task's cache holds in its young generation.
CACHE_BYTES = 16 << 20

#: Bytes that the rolling hash sees, and bytes hashed in one step.
_WINDOW, _AT_ONCE = 16, 1 << 20
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
_FOLLOWING = bytes(range(0x80, 0xC0))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
#: Every letter becomes `a`, the first byte of every other character a blank; following bytes are deleted.
_CLASSES = bytes(97 if b in _LETTERS else 32 for b in range(256))
_TOKEN = re.compile(rb"a+| ")


def candidates(raw: np.ndarray) -> np.ndarray:
    """Where a chunk may end: the rolling hash of the last 16 bytes is zero in its top bits and a character begins."""
    found = [np.empty(0, np.int64)]
    for base in range(0, len(raw) - _WINDOW, _AT_ONCE):
        rolling, size = _GEAR[raw[base:base + _AT_ONCE + _WINDOW - 1]], 1
        while size < _WINDOW:
            rolling = rolling[size:] + (rolling[:-size] << np.uint32(size))
            size *= 2
        found.append(np.flatnonzero(rolling >> np.uint32(32 - (MEAN.bit_length() - 1)) == 0) + base + _WINDOW)
    ends = np.concatenate(found)
    ends = ends[ends < len(raw)]
    return ends[(raw[ends] & 0xC0) != 0x80]


def chunk_ends(text: bytes, found: list[int]) -> list[int]:
    """Ends of the chunks of a text, given where they may end."""
    ends, start, size = [], 0, len(text)
    while start < size:
        at = bisect_right(found, start + LEAST - 1)
        end = found[at] if at < len(found) else size
        if end > start + MOST:
            end = start + MOST
            while text[end] & 0xC0 == 0x80:
                end -= 1
        ends.append(end)
        start = end
    return ends


class Summary:
    """What a chunk adds to its text: tokens, code points, letters at its ends. `classes` has a byte per code point."""

    __slots__ = ("tokens", "chars", "begins", "ends")

    def __init__(self, chunk: bytes):
        kinds = classes(chunk)
        self.tokens = kinds.count(b" ") + len(kinds.split())
        self.chars = len(kinds)
        self.begins, self.ends = kinds.startswith(b"a"), kinds.endswith(b"a")


def classes(chunk: bytes) -> bytes:
    return chunk.translate(_CLASSES, _FOLLOWING)


class ChunkCache:
    """Summaries by content, in two generations: a full young one becomes the old one, and chunks met again come back.

    A dictionary compares the content behind equal hashes, so a summary is never taken from another chunk.
    """

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.size = most, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.made = 0

    def __getitem__(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is None:
            found = self.old.get(chunk)
            if found is None:
                found = Summary(chunk)
                self.made += 1
            self.young[chunk] = found
            self.size += len(chunk)
            if self.size > self.most:
                self.old, self.young, self.size = self.young, {}, 0
        return found


class Counted:
    """The tokens of one text, from the summaries of its chunks."""

    def __init__(self, text: bytes, ends: list[int], cache: ChunkCache):
        self.text, self.ends = text, ends
        begins = [0, *ends[:-1]]
        found = [cache[text[a:b]] for a, b in zip(begins, ends)]
        # A chunk that goes on with its predecessor's letters begins no token at its first code point.
        self.joined = [False, *(a.ends and b.begins for a, b in zip(found, found[1:]))]
        self.before = [0, *accumulate(s.tokens - j for s, j in zip(found, self.joined))]
        self.points = [0, *accumulate(s.chars for s in found)]
        self.begins = begins

    @property
    def tokens(self) -> int:
        return self.before[-1]

    def start_of(self, token: int) -> tuple[int, int]:
        """(code points, bytes) before the token of that number; beyond the last one, those of the whole text."""
        if token >= self.tokens:
            return self.points[-1], len(self.text)
        at = bisect_right(self.before, token) - 1
        chunk = self.text[self.begins[at]:self.ends[at]]
        inside = token - self.before[at] + self.joined[at]
        point = next(islice(_TOKEN.finditer(classes(chunk)), inside, None)).start()
        return self.points[at] + point, self.begins[at] + len(chunk.decode()[:point].encode())


def draws(key: str) -> list[int]:
    """Four numbers of 32 bits that belong to a document."""
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transformed(key: str, text: bytes, count: Counted, plain: int, spm: int) -> tuple[str, bytes, int | None, int | None]:
    """Form, output, and the code points of prefix and middle."""
    h1, h2, h3, h4 = draws(key)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or h3 % 100 >= 100 - plain or any(m in text for m in marks):
        return "plain", text, None, None
    first, second = sorted((h1 % (count.tokens + 1), h2 % (count.tokens + 1)))
    (chars, a), (chars_to, b) = count.start_of(first), count.start_of(second)
    prefix, middle, suffix = marks[0] + text[:a], marks[2] + text[a:b], marks[1] + text[b:]
    spm_form = h4 % 100 < spm
    out = suffix + prefix + middle if spm_form else prefix + suffix + middle
    return "spm" if spm_form else "psm", out, chars, chars_to - chars


def fill_in_middle(
    docs: DataFrame, id: str = "doc_id", text: str = "text", plain: int = 10, spm: int = 20
) -> DataFrame:
    """Per row of `docs`: `id`, `n` (tokens: runs of A-Z and a-z, or one other code point), `form`, `output`,
    `prefix_chars` and `middle_chars` (code points, null if plain).

    `plain` percent of the texts, empty and null ones, and those that hold a marker stay as they are; of the rest
    `spm` percent put the suffix first. Cuts and form depend on the id as text only (a null id counts as the empty
    text), so repeated rows give the same output whatever the partitioning.
    """

    def batch(rows: pa.RecordBatch, cache: ChunkCache) -> pa.RecordBatch:
        texts = [(t or "").encode() for t in rows.column(2).to_pylist()]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        stops = np.cumsum(sizes)
        found = _candidates_of(texts, stops)
        out = []
        for key, body, (low, ends) in zip(rows.column(1).to_pylist(), texts, found):
            count = Counted(body, chunk_ends(body, (ends - low).tolist()), cache)
            form, output, prefix, middle = transformed(key or "", body, count, plain, spm)
            out.append((count.tokens, form, output, prefix, middle))
        n, form, output, prefix, middle = (list(c) for c in zip(*out)) if out else ([],) * 5
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(output, pa.binary()).cast(pa.string()),
             pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())],
            names=["id", "n", "form", "output", "prefix_chars", "middle_chars"])

    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(id).alias("id"), F.col(id).cast("string").alias("key"), F.col(text).alias("text"))
    schema = f"id {kind}, n long, form string, output string, prefix_chars long, middle_chars long"
    return in_batches(narrow, batch, schema, ChunkCache).withColumnRenamed("id", id)


def _candidates_of(texts: list[bytes], stops: np.ndarray):
    """Per text (offset, candidates); short texts share a pass of the rolling hash, which they may not reach across."""
    start = 0
    while start < len(texts):
        base = int(stops[start]) - len(texts[start])
        stop = max(start + 1, int(np.searchsorted(stops, base + _AT_ONCE, "right")))
        ends = candidates(np.frombuffer(b"".join(texts[start:stop]), np.uint8))
        for i in range(start, stop):
            high = int(stops[i]) - base
            low = high - len(texts[i])
            # The first 16 bytes of a text hold no full window of it, so that a text's chunks do not depend on others.
            yield low, ends[np.searchsorted(ends, low + _WINDOW):np.searchsorted(ends, high)]
        start = stop


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
