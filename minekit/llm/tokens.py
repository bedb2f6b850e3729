"""Token counts of whole texts, huge ones by overlapping chunks that are spliced again.

A huge document is encoded in chunks that overlap, with the offset of every token. Two neighbours are spliced at
a boundary that both have in their overlap and that no encoding of any longer text could move. For the pieces of
the vocabularies served here that is proven before a space that follows another character: no piece holds a
space behind another character, so no merge reaches across. If the overlap holds no such boundary it is doubled,
until one is found or the chunk covers the rest of the text.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import in_batches

#: Code points of a chunk and of the overlap of two chunks.
CHUNK, OVERLAP = 1 << 16, 1 << 9


class Pieces:
    """A sentencepiece model: token counts, and token starts in code points."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.splices = not any("▁" in p.lstrip("▁") for p in pieces)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, return_type="numpy", num_threads=1)]

    def starts(self, text: str) -> list[int]:
        """Token starts; the bytes of one character start together."""
        found = self.model.encode(text, return_type="proto", num_threads=1).pieces
        raw = np.frombuffer(text.encode(), np.uint8)
        # The library counts bytes: number the code points that begin up to each byte.
        point = np.append(np.cumsum((raw & 0xC0) != 0x80) - 1, len(text))
        return point[[piece.begin for piece in found]].tolist() if found else []


def stable(text: str, at: int) -> bool:
    """Whether a space that follows another character stands at `at`."""
    return 0 < at < len(text) and text[at] == " " and text[at - 1] not in " ▁"


def spliced_count(text: str, pieces: Pieces, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, from chunks of at most `chunk` code points where boundaries allow it."""
    total, start = 0, 0  # tokens before `start` are counted; `start` is 0 or a stable boundary
    end = min(len(text), chunk)
    own = _starts(text, start, end, pieces)
    while end < len(text):
        reach = overlap
        while True:
            # The next chunk begins before this one ends, at whatever character is there.
            begin = max(start + 1, end - reach)
            last = min(len(text), begin + max(chunk, 2 * reach))
            following = _starts(text, begin, last, pieces)
            both = set(following)
            common = next((at for at in reversed(own) if at > begin and at in both and stable(text, at)), None)
            if common is not None or begin == start + 1:
                break
            reach *= 2  # widen: no boundary is in both
        if common is None:  # the chunk has no stable boundary at all: take both as one
            end = min(len(text), max(last, 2 * end - start))
            own = _starts(text, start, end, pieces)
            continue
        total += bisect.bisect_left(own, common)
        own = following[bisect.bisect_left(following, common):]
        start, end = common, last
    return total + len(own)


def _starts(text: str, begin: int, end: int, pieces: Pieces) -> list[int]:
    """Token starts of text[begin:end], as offsets in the text.

    A chunk that begins with a space hands it to the model's own space. A chunk that begins elsewhere may be
    wrong up to its first stable boundary; only boundaries behind that are ever used.
    """
    skip = 1 if begin and text[begin] == " " else 0
    found = pieces.starts(text[begin + skip:end])
    return [begin] * min(1, max(len(found), skip)) + [begin + skip + at for at in found[1:]]


def token_counts(
    docs: DataFrame, model: str, id: str = "doc_id", text: str = "text", limit: int = 4096,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """`id`, `n_bytes` (UTF-8), `n_tokens` and `over_limit` of every row, without begin or end tokens.

    Null texts count as empty: no bytes, no tokens. `model` is the path of a sentencepiece model; with a
    vocabulary for which no boundary is proven stable every text is encoded whole.
    """

    def batch(rows: pa.RecordBatch, pieces: Pieces) -> pa.RecordBatch:
        texts = [t or "" for t in rows.column(1).to_pylist()]
        huge = [pieces.splices and len(t) > chunk for t in texts]
        short = iter(pieces.counts([t for t, h in zip(texts, huge) if not h]))
        counts = [spliced_count(t, pieces, chunk, overlap) if h else next(short) for t, h in zip(texts, huge)]
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64()),
             pa.array([n > limit for n in counts], pa.bool_())], names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = in_batches(narrow, batch, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean", lambda: Pieces(model))
    return found.withColumnRenamed("id", id)
