"""Packing documents into sequences by best-fit decreasing.

Documents are tokenised where they lie; only the lengths and checksums of their pieces travel. A document longer
than a window is first cut into full windows, which are sequences of their own; what is left over goes into the
tightest open window that holds it, longest first, found by a segment tree indexed by remaining capacity.

Windows that stay loose are opened again: their pieces are cut at the largest power of two within, and the parts
are packed by the same rule, beside the holes of the other windows. (A sequence whose length is a power of two
is not padded.) Pieces are dealt to groups by hash and each group is packed by itself.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import in_batches, in_worker

WINDOW = 2048
END_ID = 1
#: Pieces that one task packs, about.
GROUP = 20_000
#: A window is loose if it would be padded by more than one part in this many.
LOOSE = 64
#: Code points that are split into words at once.
_AT_ONCE = 4 << 20
_BLANK = re.compile(r"[ \t\n\v\f\r]")

#: Tokenizers that fold case and split letters, digits and signs apart, as far as `WordCache` cuts words.
_FOLDS = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITS = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Parts that such a tokenizer hands to its model as they are, but for the letters of bytes.
_ONE = re.compile(r"[a-zß-öø-ÿ]+|[!-/:-@\[-`{-~]+|[0-9]")

_LETTER, _DIGIT, _SIGN, _APOSTROPHE = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = _APOSTROPHE
#: By kind of a byte * 8 + kind of the next: whether a word is cut there. 's is left alone: what 's is depends on what stands before.
_CUT = np.zeros(64, bool)
_CUT[[a * 8 + b for a, b in ((_LETTER, _DIGIT), (_LETTER, _SIGN), (_LETTER, _APOSTROPHE), (_DIGIT, _LETTER), (_DIGIT, _DIGIT),
                             (_DIGIT, _SIGN), (_DIGIT, _APOSTROPHE), (_SIGN, _LETTER), (_SIGN, _DIGIT), (_APOSTROPHE, _DIGIT))]] = True


def _bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each starts, with the end."""
    _, starts, data = texts.buffers()
    starts = np.frombuffer(starts, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[:starts[-1]], starts


def _cut(words: pa.LargeStringArray, bounds: np.ndarray, odd: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Words cut between letters, digits and signs, without empty ones; `bounds`, the first word of each text and
    the end, become the first parts. The words of `odd` texts stay whole."""
    data, starts = _bytes(words)
    kind = _KIND[data]
    latin = np.flatnonzero(data == 0xC3)  # à to ÿ and their capitals are two bytes from here; × and ÷ are among them
    latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
    kind[latin] = kind[latin + 1] = _LETTER
    first = np.zeros(len(data), bool)
    first[1:] = _CUT[kind[:-1] * 8 + kind[1:]]
    for n in np.flatnonzero(odd):
        first[starts[bounds[n]]:starts[bounds[n + 1]]] = False
    first[starts[:-1][np.diff(starts) > 0]] = True
    at = np.append(np.flatnonzero(first), len(data))
    parts = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), words.buffers()[2])
    return parts, np.searchsorted(at, starts[bounds])


class WordCache:
    """Token ids of texts, from the ids of their words between ASCII white space.

    Right for tokenizers whose words never reach across white space, such as those that drop it. Arrow finds the
    distinct words of a batch; they are encoded once and remembered in two generations: when the young one is full
    it becomes the old one, and words met again come back from there, so frequent words stay and rare ones go.

    With `special`, the tokens that a tokenizer finds in texts as they are, words are lower-cased and cut between
    letters, digits and signs before, so the same letters beside other signs are one word. That is right for
    tokenizers that fold and split as `_FOLDS` and `_SPLITS`: no ASCII character joins one before it to a composed
    character, and none of the words they find reach across such a cut. Texts with a special token, or with a
    combining mark (which some small letters join, but not their capitals), keep their words as they are.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = 500_000, special: list[str] | None = None):
        self.encode, self.most, self.special = encode, most, special
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _known(self, words: list[str]) -> list[bytes]:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        again = [self.old.get(words[i]) for i in missing]
        new = [words[i] for i, ids in zip(missing, again) if ids is None]
        made = iter([array("I", ids).tobytes() for ids in self.encode(new)] if new else ())
        for i, ids in zip(missing, again):
            found[i] = self.young[words[i]] = next(made) if ids is None else ids
        return found

    def _odd(self, lower: pa.LargeStringArray) -> np.ndarray:
        """Whether each text has a special token, in any case, or a combining mark of Latin letters."""
        odd = np.zeros(len(lower), bool)
        for token in self.special:
            odd |= pc.match_substring(lower, token.lower()).to_numpy(zero_copy_only=False)
        data, starts = _bytes(lower)
        marks = np.flatnonzero(data & 0xFE == 0xCC)  # U+0300 to U+037F start with CC or CD
        odd[np.searchsorted(starts, marks, "right") - 1] = True
        return odd

    def _words(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The words of all texts in a row, and the first of each text, with the end."""
        whole = pa.array(texts, pa.large_string())
        if self.special is not None:
            lower = pc.ascii_lower(whole)
            odd = self._odd(lower)
            whole = pc.if_else(pa.array(odd), whole, lower) if odd.any() else lower
        split = pc.ascii_split_whitespace(whole)
        words, bounds = split.flatten(), split.offsets.to_numpy()
        return (words, bounds) if self.special is None else _cut(words, bounds, odd)

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        words, bounds = self._words(texts)
        words = words.dictionary_encode()
        ids = self._known(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, first = np.frombuffer(b"".join(ids), np.uint32), np.cumsum(lengths) - lengths
        index = words.indices.to_numpy()
        sizes = lengths[index]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        # The ids of a word follow each other: count up from its first.
        every = flat[np.repeat(first[index] - ends[:-1], sizes) + np.arange(ends[-1])]
        return np.split(every, ends[bounds[1:-1]])

    def ids_of(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; long texts are cut at white space and encoded part by part."""
        held: list[str] = []
        size = 0
        for text in (t or "" for t in texts):
            if size + len(text) > _AT_ONCE and held:
                yield from self._batch(held)
                held, size = [], 0
            if len(text) > _AT_ONCE:
                yield np.concatenate([self._batch([part])[0] for part in _parts(text)])
            else:
                held.append(text)
                size += len(text)
        if held:
            yield from self._batch(held)


def _parts(text: str) -> Iterator[str]:
    """A text in parts of about `_AT_ONCE` code points that end at ASCII white space."""
    start = 0
    while start < len(text):
        found = _BLANK.search(text, start + _AT_ONCE)
        end = found.end() if found else len(text)
        yield text[start:end]
        start = end


def word_encoder(path: str) -> WordCache:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def whole(words: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    added = list(tokenizer.get_added_tokens_decoder().values())
    if not _splits(tokenizer) or any(t.normalized or not t.content.isascii() or _ONE.fullmatch(t.content) for t in added):
        return WordCache(whole)
    model, split = tokenizer.model, tokenizer.pre_tokenizer
    letters = {n: split.pre_tokenize_str(chr(n))[0][0] for n in range(0xDF, 0x100) if n != 0xF7}

    def by_model(words: list[str]) -> list[list[int]]:
        ids = [[t.id for t in model.tokenize(w if w.isascii() else w.translate(letters))] if _ONE.fullmatch(w) else None for w in words]
        rest = [i for i, found in enumerate(ids) if found is None]
        for i, found in zip(rest, whole([words[i] for i in rest])):
            ids[i] = found
        return ids

    return WordCache(by_model, special=[t.content for t in added])


def _splits(tokenizer) -> bool:
    """Whether a tokenizer is one whose words may be lower-cased and cut."""
    steps = (tokenizer.normalizer, tokenizer.pre_tokenizer)
    return all(s is not None for s in steps) and [json.loads(s.__getstate__()) for s in steps] == [_FOLDS, _SPLITS]


def cut_at(length: int) -> int:
    """Where a piece may be cut: at the largest power of two within it."""
    return 1 << (length.bit_length() - 1)


class OpenWindows:
    """Open windows by remaining capacity, a segment tree: leaf r says whether a window with room r is open, a
    parent whether any leaf below is. The tightest window for a piece is the first such leaf from its length on."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, window: int, left: int) -> None:
        self.open[left].append(window)
        at = self.size + left
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The window with the least room for `length`, taken out, and its room."""
        at = self.size + length
        if not self.any[at]:
            while at & (at + 1) and not (at % 2 == 0 and self.any[at + 1]):
                at >>= 1
            if not at & (at + 1):  # the right edge: nothing has more room
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.any[2 * at] else 2 * at + 1
        left = at - self.size
        window = self.open[left].pop()
        while at and not (self.open[left] if at >= self.size else self.any[2 * at] or self.any[2 * at + 1]):
            self.any[at] = 0
            at >>= 1
        return window, left


def best_fit(lengths: list[int], capacity: int, holes: dict[int, int] | None = None, first: int = 0) -> list[int]:
    """The window of each length (in descending order); `holes` are windows with room, new ones count from `first`."""
    tree = OpenWindows(capacity)
    for window, left in (holes or {}).items():
        if left:
            tree.add(window, left)
    out = []
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found, first = (first, capacity), first + 1
        window, left = found
        out.append(window)
        if left > length:
            tree.add(window, left - length)
    return out


def pack_group(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """`window` and `offset` of the pieces of a group, some cut in two.

    Columns `doc`, `start`, `length`, `crc`, and `crc_head` and `crc_tail` of the parts before and behind the cut.
    """
    pieces = pieces.sort_values(["length", "doc", "start", "crc"], ascending=[False, True, True, True], na_position="last",
                                ignore_index=True)
    window = np.array(best_fit(pieces["length"].tolist(), capacity), np.int64)
    filled = np.bincount(window, pieces["length"], minlength=1).astype(np.int64)
    loose = (capacity - filled > capacity // LOOSE) & (filled & (filled - 1) != 0)
    again = loose[window] & (pieces["length"].to_numpy() & (pieces["length"].to_numpy() - 1) != 0)
    # A loose window keeps its pieces that cannot be cut; its room is a hole like others.
    cut = pieces[again]
    heads = np.array([cut_at(n) for n in cut["length"].tolist()], np.int64)
    head = cut.assign(length=heads, crc=cut["crc_head"])
    tail = cut.assign(start=cut["start"] + heads, length=cut["length"] - heads, crc=cut["crc_tail"])
    parts = pd.concat([head, tail], ignore_index=True).sort_values(
        ["length", "doc", "start", "crc"], ascending=[False, True, True, True], na_position="last", ignore_index=True)
    filled = np.bincount(window[~again], pieces["length"][~again], minlength=len(filled)).astype(np.int64)
    holes = {w: capacity - n for w, n in enumerate(filled.tolist()) if 0 < n < capacity}
    placed = best_fit(parts["length"].tolist(), capacity, holes, len(filled))
    out = pd.concat([pieces[~again].assign(window=window[~again]), parts.assign(window=placed)], ignore_index=True)
    out = out.sort_values(["window", "length", "doc", "start"], ascending=[True, False, True, True], ignore_index=True)
    out["offset"] = out.groupby("window")["length"].cumsum() - out["length"]
    out["window"] = pd.factorize(out["window"])[0]
    return out


def pieces_of(docs: DataFrame, tokenizer: str, id: str, text: str, window: int, end_id: int) -> DataFrame:
    """The full windows and the rest of every document: `doc`, `start`, `length`, `crc`, `doc_tokens`, and the
    checksums of the rest's two parts."""

    def batch(rows: pa.RecordBatch, cache: WordCache) -> pa.RecordBatch:
        taken, starts, lengths, sums, totals, heads, tails = [], [], [], [], [], [], []
        for n, found in enumerate(cache.ids_of(rows.column(1).to_pylist())):
            ids = np.append(found, np.uint32(end_id)).astype("<u4")
            for start in range(0, len(ids), window):
                piece = ids[start:start + window]
                head = cut_at(len(piece))
                taken.append(n)
                starts.append(start)
                lengths.append(len(piece))
                sums.append(zlib.crc32(piece))
                totals.append(len(ids))
                heads.append(zlib.crc32(piece[:head]))
                tails.append(zlib.crc32(piece[head:]))
        numbers = [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals, heads, tails)]
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(taken, pa.int64())), *numbers],
            names=["doc", "start", "length", "crc", "doc_tokens", "crc_head", "crc_tail"])

    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(id).alias("doc"), F.col(text).alias("text"))
    schema = f"doc {kind}, start long, length long, crc long, doc_tokens long, crc_head long, crc_tail long"
    return in_batches(narrow, batch, schema, lambda: in_worker(f"words of {tokenizer}", lambda: word_encoder(tokenizer)))


def pack(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: id, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id` and `offset` there.

    A document's ids are those of its text followed by `end_id`; null and empty texts have `end_id` alone. Every
    row of `docs` is packed, also rows that repeat an id. An empty table gives no rows. `tokenizer` is the path of
    a vocabulary whose words end at white space.
    """
    pieces = pieces_of(docs, tokenizer, id, text, window, end_id)
    groups = max(1, -(-docs.count() // group))
    # Equal pieces of one id meet in a group; all others are dealt evenly.
    part = F.pmod(F.xxhash64("doc", "start", "crc"), F.lit(groups)).cast("long")
    dealt = pieces.withColumn("part", part).withColumn("doc", F.col("doc").cast("string"))  # pandas has no null integers
    kind = docs.schema[id].dataType

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = pack_group(rows, window)
        out["sequence_id"] = (key[0] << 32) + out["window"]
        return out[["doc", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"]]

    schema = "doc string, start long, length long, crc long, doc_tokens long, sequence_id long, offset long"
    found = dealt.groupBy("part").applyInPandas(packed, schema)
    return found.select(F.col("doc").cast(kind).alias(id), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
