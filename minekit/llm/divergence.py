"""Source divergence audit: how far the sources of a language differ in their words.

Words are counted by sorting pointers. A task takes the bytes of an Arrow buffer, marks the word starts, and sorts
them by multikey quicksort whose characters are eight bytes wide: a slice is parted around a pivot into less, equal
and greater, and the equal part moves on to the next eight bytes. Small slices are finished column by column. Runs
of equal words then give, per language and source, how often a word occurs and in how many documents. Slices are
summed by Spark, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import forget, in_batches, stored
from ..plans.bounds import attach

#: Slices of fewer pointers are finished column by column instead of being parted further.
SMALL = 4096
#: Sources of one language whose distances a task sums in one matrix (its rows and its columns).
BLOCK = 256
SCALE, SMOOTH = 1_000_000_000, 5

_IS_WORD = np.array([b > 127 or 65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def word_pointers(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words of texts that follow each other in `raw`; no word reaches across a bound."""
    word = _IS_WORD[raw]
    before = np.empty_like(word)
    before[:1] = False
    before[1:] = word[:-1]
    after = np.empty_like(word)
    after[-1:] = False
    after[:-1] = word[1:]
    inner = bounds[(bounds > 0) & (bounds < len(raw))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(word & ~before)
    return starts, np.flatnonzero(word & ~after) + 1 - starts


class PointerSort:
    """Multikey quicksort of word pointers. `order` are the pointers in sorted order, `run` numbers equal words."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, small: int = SMALL):
        padded = np.zeros(len(raw) + 8, np.uint8)
        padded[:len(raw)] = raw
        self.at = np.ndarray((len(raw) + 1,), ">u8", padded, 0, (1,))
        self.starts, self.lengths = starts, lengths
        self.order = np.arange(len(starts))
        begins = np.zeros(len(starts), bool)
        begins[:1] = True
        slices = [(0, len(starts), 0)]
        while slices:
            low, high, depth = slices.pop()
            if high - low <= small:
                self._finish(low, high, depth, begins)
                continue
            mine = self.order[low:high]
            keys = self.characters(mine, depth)
            sample = np.sort(keys[:: max(1, len(keys) // 9)])
            pivot = sample[len(sample) // 2]
            less, equal = keys < pivot, keys == pivot
            self.order[low:high] = np.concatenate((mine[less], mine[equal], mine[~(less | equal)]))
            first = low + int(np.count_nonzero(less))
            second = first + int(np.count_nonzero(equal))
            begins[first] = True
            if second < high:
                begins[second] = True
                slices.append((second, high, depth))
            if first > low:
                slices.append((low, first, depth))
            if pivot & np.uint64(255):  # the words go on
                slices.append((first, second, depth + 8))
        self.run = np.cumsum(begins) - 1

    def characters(self, pointers: np.ndarray, depth: int) -> np.ndarray:
        """The eight bytes of each word from `depth` on as a number; bytes behind the word's end are zero."""
        left = np.clip(self.lengths[pointers] - depth, 0, 8)
        here = self.at[np.minimum(self.starts[pointers] + depth, len(self.at) - 1)].astype(np.uint64)
        drop = (8 * (8 - left)).astype(np.uint64)
        half = drop >> np.uint64(1)  # shifts by 64 bits are undefined: shift in two steps
        return here >> half >> (drop - half) << half << (drop - half)

    def _finish(self, low: int, high: int, depth: int, begins: np.ndarray) -> None:
        """Sort a small slice column by column; places whose words still tie go on."""
        places = np.arange(low, high)
        tied = np.zeros(high - low, np.int64)
        while len(places):
            mine = self.order[places]
            keys = self.characters(mine, depth)
            by = np.lexsort((keys, tied))
            self.order[places], keys, tied = mine[by], keys[by], tied[by]
            new = np.ones(len(places), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (tied[1:] != tied[:-1])
            begins[places[new]] = True
            group = np.cumsum(new) - 1
            more = (np.bincount(group)[group] > 1) & ((keys & np.uint64(255)) != 0)
            places, tied = places[more], group[more]
            depth += 8


def _slice_counts(rows: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of one slice of documents."""
    texts = rows.column("text").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    raw = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.empty(0, np.uint8)
    raw, bounds = _FOLD[raw], offsets - offsets[0]
    starts, lengths = word_pointers(raw, bounds)
    sort = PointerSort(raw, starts, lengths)
    doc = np.searchsorted(bounds, starts[sort.order], "right") - 1
    code, group = {}, np.empty(len(rows), np.int64)
    for i, p in enumerate(zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist())):
        group[i] = code.setdefault(p, len(code))
    # A run's words, one entry per document, then per group.
    in_doc, n = np.unique(sort.run * max(len(rows), 1) + doc, return_counts=True)
    run, doc = np.divmod(in_doc, max(len(rows), 1))
    cell, back, docs = np.unique(run * max(len(code), 1) + group[doc], return_inverse=True, return_counts=True)
    total = np.bincount(back, weights=n, minlength=len(cell)).astype(np.int64)
    run, of = np.divmod(cell, max(len(code), 1))
    first = sort.order[np.searchsorted(sort.run, run)]
    data = raw.tobytes()
    terms = [data[a:a + k].decode() for a, k in zip(starts[first].tolist(), lengths[first].tolist())]
    names = list(code) or [("", "")]
    lang, source = (pa.array([p[k] for p in names], pa.string()).take(pa.array(of)) for k in (0, 1))
    return pa.RecordBatch.from_arrays(
        [lang, source, pa.array(terms, pa.string()), pa.array(total), pa.array(docs.astype(np.int64))],
        names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """`lang`, `source`, `term`, `n` occurrences and `docs` that hold the term. Words are runs of letters A-Z, in
    lower case, and of characters beyond ASCII. Every row counts as a document; null texts have no terms."""
    counted = in_batches(_narrow(docs, text, lang, source), _slice_counts, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _narrow(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    named = (("text", text), ("lang", lang), ("source", source))
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for name, c in named])


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(1e9 (n + 5) / (total + 5 terms)) in whole numbers."""
    over, under = f"(CAST({n} AS DECIMAL(20,0)) + {SMOOTH}) * {SCALE}", f"(CAST({total} AS DECIMAL(20,0)) + {SMOOTH} * {terms})"
    return F.expr(f"1 + {over} div {under}")


def _distances(cells: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of |p - q| over terms, for the sources of one block against those of another, one matrix per task."""
    sums: dict[tuple, np.ndarray] = {}

    def out():
        rows = [(k[0], k[1], k[2], m.ravel().tolist()) for k, m in sums.items()]
        sums.clear()
        lang, a, b, values = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(values, pa.list_(pa.int64()))],
            names=["lang", "a", "b", "sums"])

    for batch in cells:
        langs = batch.column("lang").to_pylist()
        place = {}
        for i, key in enumerate(zip(langs, batch.column("a").to_pylist(), batch.column("b").to_pylist())):
            place.setdefault(key, []).append(i)
        for key, rows in place.items():
            for at in range(0, len(rows), 1024):
                part = batch.take(pa.array(rows[at:at + 1024]))
                left, right = (_dense(part, key[k], key[0]) for k in (1, 2))
                held = sums.setdefault(key, np.zeros((left.shape[1], right.shape[1]), np.int64))
                for i in range(left.shape[1]):
                    held[i] += np.abs(right - left[:, i:i + 1]).sum(axis=0)
        if len(sums) * BLOCK * BLOCK > 4 << 20:
            yield out()
    if sums:
        yield out()


def _dense(part: pa.RecordBatch, block: int, lang: str) -> np.ndarray:
    """Terms by sources of a block: the share of a term that a source lacks, overwritten where it has the term."""
    low = block * BLOCK
    rest = part.column("rest")[0].values.to_numpy()[low:low + BLOCK]
    matrix = np.repeat(rest[None, :], len(part), axis=0)
    cells = part.column("cells")
    flat = cells.flatten()
    row = np.repeat(np.arange(len(part)), cells.value_lengths().fill_null(0).to_numpy())
    index, share = flat.field("index").to_numpy(), flat.field("p").to_numpy()
    inside = (index >= low) & (index < low + BLOCK)
    matrix[row[inside], index[inside] - low] = share[inside]
    seed = part.column("seed").to_numpy(zero_copy_only=False)
    matrix[seed] = 0  # the row that only makes the matrix exist adds nothing
    return matrix


def divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 30, top: int = 50
) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank` per group of language and source.

    Each language keeps the terms in at least `min_docs` of its documents. A group's share of a kept term is
    p = 1 + floor(1e9 (n + 5) / (N + 5 V)), with N its occurrences of kept terms and V the number of kept terms; so is
    the language's, q. Part `pair`: every other source of the language with the sum of |p - p'| over all kept terms.
    Part `term`: the `top` kept terms of the group with the greatest p - q > 0. Ranks count from 1 by value descending,
    then item in byte order. Null text, language and source count as empty. Groups without kept terms take part; a
    table without rows gives none. Distances grow with the square of a language's sources, as the result does.
    """
    counts = stored(term_counts(docs, text, lang, source), "term-counts")
    groups = stored(_narrow(docs, text, lang, source).select("lang", "source").distinct(), "groups")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n")).where(F.col("docs") >= min_docs)
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("all_total"))
    # One row per language and term on the right, so nothing multiplies.
    own = stored(counts.select("lang", "source", "term", "n").join(kept.select("lang", "term", "all_n"), ["lang", "term"]), "kept-counts")
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    facts = (groups.join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
             .fillna(0, ["total", "terms", "all_total"])
             .withColumn("index", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1))
    facts = stored(facts.withColumn("rest", F.when(F.col("terms") > 0, _share("0", "total", "terms")).otherwise(F.lit(0))), "group-facts")
    forget(counts)
    forget(groups)

    shares = attach(own, facts.drop("rest"), ["lang", "source"]).withColumn("p", _share("n", "total", "terms"))
    above = shares.withColumn("q", _share("all_n", "all_total", "terms")).where("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    part_term = (above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
                 .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))

    lists = facts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("index", "rest"))).alias("list"))
    lists = lists.select("lang", F.transform("list", lambda s: s.rest).alias("rest"))
    per_term = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("index", "p")).alias("cells")).withColumn("seed", F.lit(False))
    none = F.array().cast("array<struct<index:int,p:long>>")
    seeds = facts.select("lang").distinct().select("lang", F.lit("").alias("term"), none.alias("cells"), F.lit(True).alias("seed"))
    rows = attach(per_term.unionByName(seeds), lists, ["lang"])
    blocks = F.sequence(F.lit(0), F.floor((F.size("rest") - 1) / BLOCK).cast("int"))
    rows = rows.select("lang", "cells", "seed", "rest", F.explode(blocks).alias("a"))
    rows = rows.select("lang", "cells", "seed", "rest", "a", F.explode(F.sequence(F.lit(0), F.floor((F.size("rest") - 1) / BLOCK).cast("int"))).alias("b"))
    matrices = rows.mapInArrow(_distances, "lang string, a int, b int, sums array<long>")
    width = F.least(F.lit(BLOCK), F.col("sources") - F.col("b") * BLOCK)
    sized = attach(matrices, facts.groupBy("lang").agg(F.count(F.lit(1)).cast("int").alias("sources")), ["lang"])
    entries = sized.select("lang", "a", "b", width.alias("width"), F.posexplode("sums").alias("at", "f"))
    summed = entries.select(
        "lang", (F.col("a") * BLOCK + F.floor(F.col("at") / F.col("width"))).cast("int").alias("i"),
        (F.col("b") * BLOCK + F.col("at") % F.col("width")).cast("int").alias("j"), "f").where("i <> j").groupBy("lang", "i", "j").agg(F.sum("f").alias("value"))
    names = facts.select("lang", F.col("index").alias("i"), "source")
    named = attach(attach(summed, names, ["lang", "i"]), names.select("lang", F.col("i").alias("j"), F.col("source").alias("item")), ["lang", "j"])
    part_pair = (named.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
                 .withColumn("rank", F.row_number().over(order)))
    return part_pair.unionByName(part_term)
