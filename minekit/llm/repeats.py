"""Removal of repeated byte strings by a Burrows-Wheeler transform built column by column.

Every window (100 bytes) has a key: the least hash of its 32-byte strings. Equal windows have equal keys, and windows
that follow each other mostly share theirs, so a text falls into pieces: runs of windows with one key. Only pieces
whose key occurs twice can hold a repeat. Their bytes are fetched once per distinct piece and meet by key, and for a
bucket of pieces a collection's transform is built: each round inserts one symbol of every piece, from its end to its
start, into the sorted suffixes, by reading the transform so far from front to back and writing the next one. Common
prefixes are renewed at the places of insertion. Suffixes in a row with a common prefix of a window's length are
equal windows; all but the earliest are repeats.

What stands between the steps lies in Parquet files of the shared folder. A bucket's transform is bounded and held in
arrays, because a task may not rely on a local folder; a key with too many distinct pieces is not built at once: its
pieces are cut again by the contents of both halves of their windows and, if that is not enough, into single windows.
Equal pieces are collapsed before, for copies of a piece repeat all of it, and a piece whose key no other one has is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import forget, in_batches, stored, text_hash

WINDOW = 100
#: Bytes of the strings whose least hash is a window's key, and of those that cut the pieces of a hot key again.
SEED, FINE = 32, 16
#: Windows of a piece at most; bytes looked at in one step; pieces of a bucket, and of one key before it is cut again.
RUN, AT_ONCE, BUCKET, HOT = 128, 1 << 18, 2048, 4096
#: Symbols of a transform's leaf when leaves are dealt, and at most.
LEAF, MOST_IN_LEAF = 192, 384

#: Kinds of rows, as bits: a piece that its batch holds again, one that may hold a window twice, one that repeats another.
_NEW, _TWICE, _INNER, _SEEN = 0, 1, 2, 4


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as a number."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[:len(raw)] = raw
    return np.ndarray((len(raw) + 1,), np.uint64, padded, 0, (1,))


def _string_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from every place on; `size` is a multiple of eight."""
    eights, n = _eights(raw), max(len(raw) - size + 1, 0)
    found = np.zeros(n, np.uint64)
    for at in range(0, size, 8):
        found = _mixed(found ^ eights[at:at + n])
    return found


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values that follow each other."""
    size, found = 1, values
    while 2 * size <= width:
        found = np.minimum(found[:-size], found[size:])
        size *= 2
    rest = width - size
    return np.minimum(found[:len(found) - rest], found[rest:]) if rest else found


def window_keys(raw: np.ndarray, window: int, level: int) -> np.ndarray:
    """The key of the window at every place. Level 0: its least string; 1: the least strings of its halves; 2: all of it."""
    n = len(raw) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    if level == 0:
        return _least(_string_hashes(raw, SEED), window - SEED + 1)
    if level == 1:
        half = window // 2
        least = _least(_string_hashes(raw, FINE), half - FINE + 1)
        return _mixed(least[:n] ^ _mixed(least[window - half:][:n] + np.uint64(1)))
    eights, found = _eights(raw), np.zeros(n, np.uint64)
    for at in [*range(0, window - 7, 8), window - 8]:
        found = _mixed(found ^ eights[at:at + n])
    return found


def _holds_twice(raw: np.ndarray, keys: np.ndarray, window: int, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Whether a piece holds its least string twice; if not, its windows differ, for the string stands elsewhere in each."""
    strings, width = _string_hashes(raw, SEED), window - SEED + 1
    edge = np.full(width - 1, ~np.uint64(0))
    # The greatest key of the windows around a string: that string's own hash if it is the least one of any.
    least = np.flatnonzero(strings == ~_least(np.concatenate((edge, ~keys, edge)), width))
    low, high = np.searchsorted(least, at), np.searchsorted(least, at + count + width - 1)
    of = np.repeat(np.arange(len(at)), high - low)
    inside = least[np.arange(len(of)) - np.repeat(np.cumsum(high - low) - high, high - low)]
    return np.bincount(of[strings[inside] == keys[at][of]], minlength=len(at)) > 1


def pieces_of(texts: list[bytes], window: int, level: int = 0) -> tuple[np.ndarray, ...]:
    """(text, start, windows, key, twice) of the pieces: runs of windows with one key, of at most `RUN` windows. Any
    cut of a run is right, because windows meet by key. Pieces that are not `twice` hold no window twice."""
    out = []
    held, size = [], 0

    def flush():
        nonlocal held, size
        raw = np.frombuffer(b"".join(part for _, _, part in held), np.uint8)
        keys = window_keys(raw, window, level)
        ends = np.cumsum([len(part) for _, _, part in held])
        begins = ends - [len(part) for _, _, part in held]
        valid = np.zeros(len(keys) + 1, np.int8)
        np.add.at(valid, begins, 1)
        np.add.at(valid, ends - window + 1, -1)
        valid = np.cumsum(valid[:-1]) > 0
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        new[begins] = True
        new[(ends - window + 1)[:-1]] = True
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(keys)))
        parts = -(-lengths // RUN)  # long runs are cut
        inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(starts, parts) + inside * RUN
        count = np.minimum(RUN, np.repeat(lengths, parts) - inside * RUN)
        use = valid[at]
        at, count = at[use], count[use]
        part = np.searchsorted(ends, at, "right")
        which = np.array([t for t, _, _ in held])[part]
        offset = np.array([o for _, o, _ in held])[part] + at - begins[part]
        twice = _holds_twice(raw, keys, window, at, count) if level == 0 else np.ones(len(at), bool)
        out.append((which, offset, count, keys[at], twice))
        held, size = [], 0

    for i, text in enumerate(texts):
        for low in range(0, len(text) - window + 1, AT_ONCE):
            part = text[low:low + AT_ONCE + window - 1]
            held.append((i, low, part))
            size += len(part)
            if size >= AT_ONCE:
                flush()
    if held:
        flush()
    if not out:
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, bool))
    return tuple(np.concatenate(c) for c in zip(*out))


def _piece_hashes(texts: list[bytes], which: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    views = list(map(memoryview, texts))
    found = (xxh3_64_intdigest(views[i][a:b]) for i, a, b in zip(which.tolist(), start.tolist(), (start + size).tolist()))
    return np.fromiter(found, np.uint64, len(which))


class CollectionTransform:
    """The Burrows-Wheeler transform of a collection of pieces of at least a window, one symbol of every piece a round.

    The transform lies in leaves with a count of every symbol, so that a round counts the symbols before the newest
    suffixes from whole leaves and a part of one. Once suffixes are as long as a window, `suffix` (the sorted suffixes,
    as places in the joined pieces) and `equal` (whether a suffix shares `window` bytes with the one before it) are
    carried along, the latter as the lowest bit beside the place; shorter suffixes share no window.
    """

    def __init__(self, pieces: list[bytes], window: int):
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        present = np.bincount(raw, minlength=256) > 0
        symbol = np.where(present, np.cumsum(present), 0)[raw].astype(np.uint8)  # 0 ends a piece
        self.n, self.kinds, self.window, self._eights = len(pieces), int(present.sum()) + 1, window, _eights(raw)
        self.transform = symbol[ends - 1]
        self._deal()
        place, active = np.arange(self.n), np.arange(self.n)  # where the newest suffix of each active piece stands
        for length in range(1, int(sizes.max()) + 1):
            if length == window:
                self._entries = self._suffixes(ends, place) << 1
            if length > window:
                go_on = sizes[active] >= length
                active, place = active[go_on], place[go_on]
            by = np.argsort(place)
            active, place = active[by], place[by]
            starts = ends[active] - length
            preceding = np.where(sizes[active] > length, symbol[np.maximum(starts - 1, 0)], 0).astype(np.uint8)
            place = self._targets(symbol[starts], place)
            self._insert(place, preceding)
            if length >= window:
                self._insert_suffixes(place, starts)
        self.suffix, self.equal = (self._entries >> 1).astype(np.int64), (self._entries & 1).astype(bool)

    def _deal(self) -> None:
        """Deal the transform to leaves of one size and count the symbols of each."""
        size, leaves = len(self.transform), -(-len(self.transform) // LEAF)
        self._starts = np.minimum(np.arange(leaves + 1) * LEAF, size)
        cells = self.transform.astype(np.int64) * leaves
        cells += np.arange(size) // LEAF
        self._counts = np.bincount(cells, minlength=self.kinds * leaves).astype(np.int32).reshape(self.kinds, leaves)

    def _targets(self, inserted: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the symbols put before the suffixes at `place` take them, once all are inserted."""
        leaf = np.searchsorted(self._starts, place, "right") - 1
        leaf = np.minimum(leaf, len(self._starts) - 2)
        first, size = self._starts[leaf], np.diff(self._starts)[leaf]
        inside = place - first
        upto = np.cumsum(self._counts, axis=1, dtype=np.int32)
        total = upto[:, -1].astype(np.int64)
        total[0] = self.n  # the pieces' empty suffixes come first
        found = np.cumsum(total)[inserted.astype(np.int64) - 1] + upto[inserted, leaf]
        # What is counted one by one lies between the place and the nearer end of its leaf.
        back = inside * 2 > size
        found[~back] -= self._counts[inserted, leaf][~back]
        span = np.where(back, size - inside, inside)
        width = int(span.max())
        if width:
            padded = np.concatenate((self.transform, np.zeros(width, np.uint8)))
            rows = np.ndarray((len(self.transform) + 1, width), np.uint8, padded, 0, (1, 1))[np.where(back, place, first)]
            same = rows == inserted[:, None]
            same &= np.arange(width, dtype=np.uint16) < span[:, None].astype(np.uint16)
            counted = np.bitwise_count(np.packbits(same, axis=1)).sum(axis=1, dtype=np.int64)
            found += np.where(back, -counted, counted)
        return found

    def _insert(self, target: np.ndarray, preceding: np.ndarray) -> None:
        self._old = np.ones(len(self.transform) + len(target), bool)
        self._old[target] = False
        self.transform = self._merged(self.transform, target, preceding)
        by = np.argsort(target)
        leaves = len(self._starts) - 1
        leaf = np.minimum(np.searchsorted(self._starts, target[by] - np.arange(len(target)), "right") - 1, leaves - 1)
        self._starts[1:] += np.cumsum(np.bincount(leaf, minlength=leaves))
        cells = preceding[by].astype(np.int64) * leaves + leaf
        self._counts += np.bincount(cells, minlength=self.kinds * leaves).astype(np.int32).reshape(self.kinds, leaves)
        if np.diff(self._starts).max() > MOST_IN_LEAF:
            self._deal()

    def _merged(self, held: np.ndarray, target: np.ndarray, values) -> np.ndarray:
        made = np.empty(len(self._old), held.dtype)
        made[self._old] = held
        made[target] = values
        return made

    def _suffixes(self, ends: np.ndarray, newest: np.ndarray) -> np.ndarray:
        """The sorted suffixes so far: from every piece's end, the transform leads to the suffix one symbol longer."""
        inserted = self.transform.copy()
        inserted[newest] = 0  # their symbols are not inserted yet
        order = np.argsort(inserted, kind="stable")
        known = order[np.count_nonzero(inserted == 0):]
        longer = np.empty(len(inserted), np.int64)
        longer[known] = self.n + np.arange(len(known))
        suffix = np.empty(len(inserted), np.int32 if ends[-1] < 1 << 30 else np.int64)
        at = np.arange(self.n)
        for length in range(self.window):
            if length:
                at = longer[at]
            suffix[at] = ends - length
        return suffix

    def _insert_suffixes(self, target: np.ndarray, starts: np.ndarray) -> None:
        self._entries = self._merged(self._entries, target, starts << 1)
        inserted = ~self._old
        # A new suffix is compared with its neighbours on both sides; between two new ones that is done once.
        below = target + 1
        below = below[below < len(inserted)]
        for upper in (target, below[~inserted[below]]):
            place = self._entries[upper] >> 1
            self._entries[upper] = (place << 1) | self._same((self._entries[upper - 1] >> 1).astype(np.int64), place.astype(np.int64))

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows at the places are equal. (Next to a shorter suffix, which ends in its piece, the answer
        has no meaning, and no two equal windows have one between them.)"""
        last = len(self._eights) - 1
        same = np.zeros(len(a), bool)
        open_ = np.arange(len(a))
        for at in [*range(0, self.window - 7, 8), self.window - 8]:
            open_ = open_[self._eights[np.minimum(a[open_] + at, last)] == self._eights[np.minimum(b[open_] + at, last)]]
        same[open_] = True
        return same


def repeated_spans(
    pieces: list[bytes], rank: np.ndarray, start: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, begin, end) of the runs of bytes, as offsets in the documents, that repeated windows cover.

    `rank` orders the pieces' documents and `start` is a piece's offset; the earliest of equal windows is none.
    """
    transform = CollectionTransform(pieces, window)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes)
    suffix = transform.suffix
    piece = np.minimum(np.searchsorted(ends, suffix, "right"), len(pieces) - 1)
    whole = ends[piece] - suffix >= window
    run = np.cumsum(~transform.equal)[whole]
    piece = piece[whole]
    at = suffix[whole] - (ends - sizes)[piece] + start[piece]
    by = np.lexsort((at, rank[piece], run))
    run, piece, at = run[by], piece[by], at[by]
    repeat = np.zeros(len(run), bool)
    repeat[1:] = run[1:] == run[:-1]
    piece, at = piece[repeat], at[repeat]
    by = np.lexsort((at, piece))
    piece, at = piece[by], at[by]
    new = np.ones(len(at), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (at[1:] > at[:-1] + window)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(first) else first
    return piece[first], at[first], at[last] + window


def _fields(kind: pa.DataType, body: bool = False) -> pa.Schema:
    names = [("key", pa.int64()), ("piece", pa.int64()), ("doc", kind), ("hash", pa.int64()), ("start", pa.int64()),
             ("windows", pa.int32()), ("kind", pa.int32())]
    return pa.schema(names + [("body", pa.binary())] * body)


def _ddl(kind: str, body: bool = False) -> str:
    return f"key long, piece long, doc {kind}, hash long, start long, windows int, kind int" + ", body binary" * body


def _document_rank(doc: list, hash: list) -> np.ndarray:
    """Ranks of documents: by id, null first, then by the hash of the text."""
    keys = [(d is not None, d, h) if d is not None else (False, 0, h) for d, h in zip(doc, hash)]
    order = {key: i for i, key in enumerate(sorted(set(keys)))}
    return np.fromiter(map(order.__getitem__, keys), np.int64, len(keys))


def _batch_pieces(rows: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """The pieces of a batch of documents. Of equal pieces the earliest stays new; the others are seen already, so
    that a piece of a third of all documents leaves one row a batch to be compared."""
    texts = [t or b"" for t in rows.column("text").cast(pa.binary()).to_pylist()]
    which, start, windows, key, twice = pieces_of(texts, window)
    piece = _piece_hashes(texts, which, start, windows + window - 1)
    rank = _document_rank(rows.column("doc").to_pylist(), rows.column("hash").to_pylist())[which]
    by = np.lexsort((start, rank, piece, key))
    which, start, windows, key, piece, rank, twice = (c[by] for c in (which, start, windows, key, piece, rank, twice))
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (piece[1:] == piece[:-1])
    row = same.copy()  # the same place of a repeated row
    row[1:] &= (rank[1:] == rank[:-1]) & (start[1:] == start[:-1])
    other = np.cumsum(~same) - 1
    held = np.bincount(other, weights=~row, minlength=1)[other] > 1 if len(other) else row
    kind = np.where(same, _SEEN, np.where(held, _TWICE, _NEW) | np.where(twice, _INNER, _NEW))
    keep = pa.array(np.flatnonzero(~row))
    columns = [pa.array(key.view(np.int64)), pa.array(piece.view(np.int64)), rows.column("doc").take(pa.array(which)),
               rows.column("hash").take(pa.array(which)), pa.array(start), pa.array(windows.astype(np.int32)), pa.array(kind.astype(np.int32))]
    return pa.RecordBatch.from_arrays([c.take(keep) for c in columns], schema=_fields(rows.schema.field("doc").type))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces sorted by key, piece and place, those whose key occurs again; the first of equal pieces is new.

    The last row of a batch waits for the next one. A place met again belongs to a repeated row and is left out.
    """
    held, before = None, None  # the row that waits, and the one before it

    def judged(rows: pa.RecordBatch, last: bool) -> pa.RecordBatch:
        nonlocal before
        known = rows if before is None else pa.Table.from_batches([before, rows]).combine_chunks().to_batches()[0]
        skip = len(known) - len(rows)
        key, piece, hash, start, kind = (known.column(c).to_numpy() for c in ("key", "piece", "hash", "start", "kind"))
        like = np.zeros(len(key), bool)
        like[1:] = key[1:] == key[:-1]
        equal = like.copy()
        equal[1:] &= piece[1:] == piece[:-1]
        place = equal.copy()
        place[1:] &= (hash[1:] == hash[:-1]) & (start[1:] == start[:-1])
        doc = known.column("doc")
        for i in np.flatnonzero(place).tolist():
            place[i] = doc[i].as_py() == doc[i - 1].as_py()
        use = like | np.append(like[1:], False) | (kind != _NEW)
        use &= ~place
        use[:skip] = False
        if not last:
            use[-1] = False
            before = known.slice(len(known) - 2, 1) if len(known) > 1 else None
        out = known.set_column(6, "kind", pa.array(np.where(equal, _SEEN, kind & _INNER).astype(np.int32)))
        return out.take(pa.array(np.flatnonzero(use)))

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        yield judged(rows, False)
        held = rows.slice(len(rows) - 1)
    if held is not None:
        yield judged(held, True)


def _cut(key: int, body: bytes, window: int, level: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """The pieces of a piece by the keys of a finer level: key, piece, offset, windows and bytes."""
    which, at, windows, finer, _ = pieces_of([body], window, level)
    own = _piece_hashes([body], which, at, windows + window - 1)
    finer = _mixed(finer ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF))
    for k, p, a, n in zip(finer.view(np.int64).tolist(), own.view(np.int64).tolist(), at.tolist(), windows.tolist()):
        yield k, p, a, n, body[a:a + n + window - 1]


class _Resolver:
    """Takes pieces sorted by key, piece and place; gives seen pieces, repeated spans, and pieces cut again."""

    def __init__(self, window: int, level: int, kind: pa.DataType, bucket: int, hot: int):
        self.window, self.level, self.kind, self.bucket, self.hot = window, level, kind, bucket, hot
        self.group: list[tuple] = []
        self.ready: list[tuple] = []
        self.out: list[tuple] = []
        self.key, self.last, self.cutting = None, None, False

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "piece", "doc", "hash", "start", "windows", "body")]
            for row in zip(*columns):
                self.take(row)
                if len(self.out) >= 8192:
                    yield self.given()
        self.close()
        self.build()
        yield self.given()

    def take(self, row: tuple) -> None:
        key, piece, doc, hash, start, windows, body = row
        if key != self.key:
            self.close()
            self.key, self.last = key, None
        if self.last and self.last[0] == piece:
            if self.last[1:] != (doc, hash, start):
                self.out.append((key, piece, doc, hash, start, windows, _SEEN, None))
            return
        self.last = (piece, doc, hash, start)
        if self.cutting:
            self.cut(row)
            return
        self.group.append(row)
        if len(self.group) > self.hot and self.level < 2:
            self.cutting = True
            for held in self.group:
                self.cut(held)
            self.group = []

    def cut(self, row: tuple) -> None:
        _, _, doc, hash, start, _, body = row
        for k, p, a, n, part in _cut(self.key, body, self.window, self.level + 1):
            self.out.append((k, p, doc, hash, start + a, n, _NEW, part))

    def close(self) -> None:
        self.ready += self.group
        self.group, self.cutting = [], False
        if len(self.ready) >= self.bucket:
            self.build()

    def build(self) -> None:
        if not self.ready:
            return
        _, _, doc, hash, start, _, body = zip(*self.ready)
        rank = _document_rank(doc, hash)
        for i, begin, end in zip(*(c.tolist() for c in repeated_spans(list(body), rank, np.array(start, np.int64), self.window))):
            self.out.append((0, 0, doc[i], hash[i], begin, end - begin - self.window + 1, _SEEN, None))
        self.ready = []

    def given(self) -> pa.RecordBatch:
        fields = _fields(self.kind, body=True)
        columns = zip(*self.out) if self.out else [()] * len(fields)
        made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields)
        self.out = []
        return made


def _resolved(pieces: DataFrame, kind: str, window: int, level: int, bucket: int, hot: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        first = next(batches, None)
        if first is None:
            return
        resolver = _Resolver(window, level, first.schema.field("doc").type, bucket, hot)
        yield from resolver(itertools.chain([first], batches))

    met = pieces.repartition("key").sortWithinPartitions("key", "piece", "doc", "hash", "start")
    return met.mapInArrow(run, _ddl(kind, body=True))


def repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, bucket: int = BUCKET, hot: int = HOT
) -> DataFrame:
    """`doc`, `hash` (of the text) and `spans`, an array of (`begin`, `end`) byte offsets, sorted and apart: the bytes
    covered by `window`-byte strings that also start earlier, in a smaller id or earlier in the same document.

    Rows that share id and text count as one document; rows that share an id only are ordered by a hash of the text,
    and a null id comes first. Documents without repeats have no row.
    """
    kind = docs.schema[id].dataType.simpleString()
    keyed = docs.select(F.col(id).alias("doc"), text_hash(F.col(text)).alias("hash"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    every = stored(in_batches(keyed, lambda rows: _batch_pieces(rows, window), _ddl(kind)), "pieces")
    met = every.where(F.col("kind") != _SEEN).repartition("key").sortWithinPartitions("key", "piece", "doc", "hash", "start")
    found = stored(met.mapInArrow(_candidates, _ddl(kind)).unionByName(every.where(F.col("kind") == _SEEN)), "candidates")
    forget(every)

    # A window can only equal one of another piece with its key, or one of its own piece that holds the key's string twice.
    first = found.where(F.col("kind") != _SEEN)
    partners = first.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    first = first.join(partners, "key").where((F.col("n") > 1) | (F.col("kind") == _INNER))
    wanted = first.groupBy("doc", "hash").agg(
        F.collect_list(F.struct("key", "piece", "start", "windows", (F.col("n") > hot).alias("crowded"))).alias("pieces"),
    ).withColumnsRenamed({"doc": "_doc", "hash": "_hash"})
    fetched = keyed.join(wanted, keyed["doc"].eqNullSafe(wanted["_doc"]) & (keyed["hash"] == wanted["_hash"])).select("doc", "hash", "text", "pieces")
    bodies = in_batches(fetched, lambda rows: _bodies(rows, window), _ddl(kind, body=True))
    results, level = [found.where(F.col("kind") == _SEEN).select("doc", "hash", "start", "windows")], 0
    while True:
        made = stored(_resolved(bodies, kind, window, level, bucket, hot), f"repeats-{level}")
        results.append(made.where(F.col("kind") == _SEEN).select("doc", "hash", "start", "windows"))
        bodies, level = made.where(F.col("kind") != _SEEN), level + 1
        if level > 2 or bodies.isEmpty():
            break
    spans = results[0]
    for more in results[1:]:
        spans = spans.unionByName(more)
    spans = spans.select("doc", "hash", F.struct(F.col("start").alias("begin"), (F.col("start") + F.col("windows") + window - 1).alias("end")).alias("span"))
    return spans.groupBy("doc", "hash").agg(F.sort_array(F.collect_list("span")).alias("spans")).select("doc", "hash", _apart("spans"))


def _apart(spans: str):
    """Sorted spans with those that touch made one."""
    end = "greatest(last.end, s.end)"
    return F.expr(f"""
        aggregate({spans}, CAST(array() AS array<struct<begin:bigint,end:bigint>>), (all, s) ->
          CASE WHEN size(all) = 0 OR s.begin > element_at(all, -1).end THEN array_append(all, s)
               WHEN s.end <= element_at(all, -1).end THEN all
               ELSE array_append(slice(all, 1, size(all) - 1), struct(element_at(all, -1).begin AS begin, s.end AS end)) END)
    """).alias("spans")


def _bodies(rows: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """A row with its bytes per wanted piece; pieces of a crowded key are cut by the next level's keys at once."""
    out = []
    texts = rows.column("text").cast(pa.binary()).to_pylist()
    for doc, hash, text, pieces in zip(rows.column("doc").to_pylist(), rows.column("hash").to_pylist(), texts, rows.column("pieces").to_pylist()):
        for p in pieces:
            start, windows = p["start"], p["windows"]
            body = text[start:start + windows + window - 1]
            if p["crowded"]:
                out += [(k, q, doc, hash, start + a, n, _NEW, part) for k, q, a, n, part in _cut(p["key"], body, window, 1)]
            else:
                out.append((p["key"], p["piece"], doc, hash, start, windows, _NEW, body))
    fields = _fields(rows.schema.field("doc").type, body=True)
    columns = zip(*out) if out else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields)


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, bucket: int = BUCKET, hot: int = HOT
) -> DataFrame:
    """Per row of `docs`: `id`, `n_bytes`, `n_removed`, `spans` removed and the bytes `kept`, joined. (They need not
    be UTF-8: a span may begin or end inside a character.) A null text counts as empty and keeps nothing."""
    found = repeats(docs, id, text, window, bucket, hot)
    rows = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"), text_hash(F.col(text)).alias("_hash"))
    joined = rows.join(found, rows["_id"].eqNullSafe(found["doc"]) & (rows["_hash"] == found["hash"]), "left")
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    known = joined.select(F.col("_id").alias(id), "_text", F.octet_length("_text").cast("long").alias("n_bytes"), F.coalesce("spans", none).alias("spans"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.begin)
    # What stays lies between the end of one span and the begin of the next.
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s.end))
    begins = F.concat(F.transform("spans", lambda s: s.begin), F.array("n_bytes"))
    gaps = F.zip_with(ends, begins, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    parts = F.transform(gaps, lambda g: F.substring(F.col("_text"), (g.a + 1).cast("int"), (g.b - g.a).cast("int")))
    kept = F.aggregate(parts, F.lit(b""), lambda out, part: F.concat(out, part))
    return known.select(id, "n_bytes", removed.alias("n_removed"), "spans", F.when(F.size("spans") == 0, F.col("_text")).otherwise(kept).alias("kept"))
