"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words; every distinct benchmark word gets a code point, and a text becomes a string of
code points (a null character for words no item has). The automaton holds each item's windows of 13 words in
that form, so one scan finds all windows, one step a word. Word numbers map back to offsets in the text.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import in_batches

WINDOW = 13
#: Benchmark text in one automaton, in bytes. More is scanned in several passes, one automaton each.
BLOCK_BYTES = 32 << 20
#: Words of one part of an item; a block has at most twice as many, so they have code points to spare.
BLOCK_WORDS = 500_000
#: Documents that are scanned as one string; longer ones in runs that overlap by a window.
_RUN = 1 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: A-Z in lower case, other bytes that no word holds as spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_SURROGATES = 0xD800, 0xE000


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the UTF-8 text with A-Z in lower case."""
    return (text or b"").translate(_FOLD).split()


class Windows:
    """The automaton over the windows of `items`, pairs of (id, text)."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.codes: dict[bytes, str] = {}
        self.longest = window
        owners: dict[str, set[str | None]] = {}
        for item, text in items:
            coded = "".join(map(self._code, words_of(text)))
            for at in range(max(1, len(coded) - window + 1) if coded else 0):
                owners.setdefault(coded[at:at + window], set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for coded, own in owners.items():
            self.automaton.add_word(coded, (len(coded), tuple(_in_order(own))))
        self.automaton.make_automaton()
        self.empty = not owners

    def _code(self, word: bytes) -> str:
        known = self.codes.get(word)
        if known is None:
            number = len(self.codes) + 1
            known = self.codes[word] = chr(number if number < _SURROGATES[0] else number + _SURROGATES[1] - _SURROGATES[0])
        return known

    def scan(self, words: list[bytes]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first word, word after the last, items) of every occurrence, by last word."""
        if self.empty:
            return
        code = self.codes.get
        for start in range(0, len(words), _RUN):
            at = max(0, start - self.longest + 1)
            coded = "".join([code(w, "\0") for w in words[at:start + _RUN]])
            for end, (length, items) in self.automaton.iter(coded):
                if at + end >= start:
                    yield at + end + 1 - length, at + end + 1, items


def _in_order(items: set[str | None]) -> list[str | None]:
    """Ids as sorted strings; items without an id share one null, which comes last."""
    return sorted(items, key=lambda i: (i is None, i or ""))


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or adjacent spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _offsets(text: bytes, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Spans of words as offsets in code points of the original text."""
    if not spans:
        return []
    wanted = {n for a, b in spans for n in (a, b - 1)}
    folded = text.translate(_FOLD)
    places = {n: m.span() for n, m in enumerate(_WORD.finditer(folded)) if n in wanted}
    out, chars, seen = [], 0, 0
    for a, b in spans:
        start, end = places[a][0], places[b - 1][1]
        first = chars + len(text[seen:start].decode(errors="replace"))
        chars, seen = first + len(text[start:end].decode(errors="replace")), end
        out.append({"start": first, "end": chars})
    return out


def _parts(text: bytes, window: int) -> Iterator[tuple[bytes, int]]:
    """A text and its number of words; one of very many words in parts that overlap, so that each window is in one."""
    words = words_of(text)
    if len(words) <= BLOCK_WORDS:
        yield text, len(words)
        return
    for at in range(0, len(words) - window + 1, BLOCK_WORDS):
        part = words[at:at + BLOCK_WORDS + window - 1]
        yield b" ".join(part), len(part)


def _blocks(benchmark: DataFrame, id: str, text: str, window: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark in blocks that fit one automaton (a block's words have a code point each); rows come one
    partition at a time."""
    block, size, count = [], 0, 0
    rows = benchmark.select(F.col(id).cast("string").alias("id"), F.col(text).cast("binary").alias("text")).where("text is not null")
    for row in rows.toLocalIterator():
        for part, words in _parts(bytes(row["text"]), window):
            if block and count + words > 2 * BLOCK_WORDS:
                yield block
                block, size, count = [], 0, 0
            block.append((row["id"], part))
            size, count = size + len(part), count + words
            if size >= BLOCK_BYTES:
                yield block
                block, size, count = [], 0, 0
    if block:
        yield block


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("words", _SPAN), ("spans", _SPAN)])
_SPARK_SPAN = "array<struct<start:long,end:long>>"
_SPARK_FOUND = f"struct<n_words:long,n_hit:long,items:array<string>,words:{_SPARK_SPAN},spans:{_SPARK_SPAN}>"


def _pass(rows: DataFrame, text: str, items: list[tuple[str, bytes]], window: int) -> DataFrame:
    """Scan the texts in `row` with one automaton; hits that `rows` already has are kept as well."""
    shared = rows.sparkSession.sparkContext.broadcast(items)  # at most BLOCK_BYTES and one text
    again = "hits" in rows.columns

    def batch(part: pa.RecordBatch, automaton: Windows) -> pa.RecordBatch:
        found = []
        texts = part.column(0).field(text).cast(pa.binary())
        earlier = part.column(1) if again else itertools.repeat(None)
        for value, old in zip(texts, earlier):
            raw = value.as_py() or b""
            words = words_of(raw)
            hits, own = [], set()
            for a, b, owners in automaton.scan(words):
                hits.append((a, b))
                own.update(owners)
            if old is not None:
                known = old.as_py()
                own.update(known["items"])
                hits += [(s["start"], s["end"]) for s in known["words"]]
            spans = merged(hits)
            found.append({
                "n_words": len(words), "n_hit": sum(b - a for a, b in spans), "items": _in_order(own),
                "words": [{"start": a, "end": b} for a, b in spans], "spans": _offsets(raw, spans),
            })
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(found, _FOUND)], names=["row", "hits"])

    schema = rows.select("row", F.lit(None).cast(_SPARK_FOUND).alias("hits")).schema
    return in_batches(rows, batch, schema, lambda: Windows(shared.value, window))


def hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """`row` (the columns of `docs` as a struct) and `hits`: `n_words`, `n_hit` (words inside an occurrence of a
    window), `items` (ids with an occurrence, as sorted strings; items without an id hit as others do and appear as
    one null, which `items_sha256` leaves out), `words` (spans of hit words, by number) and
    `spans` (the same as offsets in code points of the text).

    An item shorter than a window, but not empty, is one window. Null texts and empty ones have no words; items
    without words never occur. Without any item nothing is hit. A benchmark larger than `BLOCK_BYTES` is scanned in several passes.
    """
    rows = docs.select(F.struct("*").alias("row"))
    for block in _blocks(benchmark, item, item_text, window):
        rows = _pass(rows, text, block, window)
    return rows if "hits" in rows.columns else _pass(rows, text, [], window)


def contaminated(found: Column) -> Column:
    """At least one twentieth of the words, and at least one, are hit."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])


def decontamination(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per row of `docs`: id, `n_words`, `n_hit`, `n_items`, `items_sha256`, `contaminated` and the `spans` that are hit."""
    found = F.col("hits")
    return hits(docs.select(id, text), benchmark, text, item, item_text).select(
        F.col("row")[id].alias(id), found["n_words"].alias("n_words"), found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        contaminated(found).alias("contaminated"), found["spans"].alias("spans"),
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of `docs` that are not contaminated, unchanged."""
    found = hits(docs, benchmark, text, item, item_text)
    return found.where(~contaminated(F.col("hits"))).select("row.*")
