"""Order MinHash fingerprints of documents. DataFrame functions only.

The k-mers of a text are runs of words, numbered by occurrence: the second time a k-mer occurs it is another
element. All elements are hashed; the range of hashes is cut into equal bins, and the least element of each bin
is selected. Neighbouring bins form a group; its elements are put in the order they have in the text, and the
hash of their k-mers in that order is one slot of the fingerprint. Two texts agree in a slot if they select the
same elements in the same order, so moving or replacing stretches of text lowers their likeness.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

KMER = 2  # words
SLOTS, GROUP = 64, 2  # slots of a fingerprint, bins of a slot
#: Positions take the low bits of a packed element, hashes the others. Longer texts have at most 2^31 bytes.
_POSITION = 30
_EMPTY = 0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _run_starts(values: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Indexes (from 0) where a sorted array's element is not the `same` as the one before."""
    indexes = F.sequence(F.lit(0), F.size(values) - 1)
    return F.filter(indexes, lambda i: (i == 0) | ~same(F.get(values, i), F.get(values, i - 1)))


def _pack(hashed: Column, position: Column) -> Column:
    """One long that sorts by the upper bits of the hash, then by position."""
    return F.shiftleft(F.shiftright(hashed, _POSITION), _POSITION).bitwiseOR(position.cast("long"))


def _position(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << _POSITION) - 1).cast("long"))


def _kmers(words: Column) -> Column:
    """Packed (hash, position) of every k-mer; a text of fewer words than a k-mer is one."""
    last = F.greatest(F.size(words) - KMER, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: _pack(F.xxhash64(*[F.get(words, i + j) for j in range(KMER)]), i))


def _numbered(kmers: Column) -> Column:
    """Elements packed as (hash of k-mer and occurrence, position), from sorted k-mers."""
    of = lambda packed: F.shiftright(packed, _POSITION)
    element = lambda packed, n: _pack(F.xxhash64(of(packed), n), _position(packed))

    def by_run(starts: Column) -> Column:
        def run(start: Column, i: Column) -> Column:
            length = F.coalesce(F.get(starts, i + 1), F.size(kmers)) - start
            return F.transform(F.slice(kmers, start + 1, length), element)

        none_repeats = F.transform(kmers, lambda packed: element(packed, F.lit(0)))
        return F.when(F.size(starts) == F.size(kmers), none_repeats).otherwise(F.flatten(F.transform(starts, run)))

    return _let(_run_starts(kmers, lambda a, b: of(a) == of(b)), by_run)


def _bin(packed: Column) -> Column:
    """Which of SLOTS * GROUP equal ranges a signed hash lies in."""
    bins = SLOTS * GROUP
    return F.shiftright(packed, 64 - bins.bit_length() + 1) + bins // 2


def _slots(elements: Column) -> Column:
    """Fingerprint from the sorted elements: one int per slot, 0 where no element fell into its bins."""
    slot_of = lambda packed: F.shiftright(packed, 64 - SLOTS.bit_length() + 1) + SLOTS // 2

    def of_least(least: Column) -> Column:
        def filled(starts: Column) -> Column:
            def slot(start: Column, i: Column) -> Column:
                own = F.slice(least, start + 1, F.coalesce(F.get(starts, i + 1), F.size(least)) - start)
                # Position in the upper bits, hash in the lower ones: sorted, they are in text order.
                turned = F.sort_array(F.transform(own, lambda e: F.shiftleft(_position(e), 64 - _POSITION).bitwiseOR(
                    F.shiftrightunsigned(e, _POSITION))))
                hashed = F.hash(F.transform(turned, lambda e: e.bitwiseAND(F.lit((1 << 64 - _POSITION) - 1).cast("long"))))
                return F.struct(slot_of(F.get(least, start)).cast("int").alias("slot"), F.when(hashed == _EMPTY, 1).otherwise(hashed).alias("hash"))

            return F.map_from_entries(F.transform(starts, slot))

        found = _let(_run_starts(least, lambda a, b: slot_of(a) == slot_of(b)), filled)
        return _let(found, lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.coalesce(F.try_element_at(m, s), F.lit(_EMPTY))))

    least = F.transform(_run_starts(elements, lambda a, b: _bin(a) == _bin(b)), lambda i: F.get(elements, i))
    return _let(least, of_least)


def order_minhash(text: Column) -> Column:
    """Array of SLOTS ints. Null and empty texts have all slots empty."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    found = _let(words, lambda w: F.when(F.size(w) == 0, F.array_repeat(F.lit(_EMPTY), SLOTS)).otherwise(
        _let(F.sort_array(_kmers(w)), lambda k: _let(F.sort_array(_numbered(k)), _slots))))
    return found


def as_text(slots: Column) -> Column:
    """Eight hex digits per slot."""
    return F.array_join(F.transform(slots, lambda s: F.lpad(F.lower(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal slots among those filled in either (0 to 1); 1 where all are empty in both."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == _EMPTY) & (y == _EMPTY), F.lit(None)).otherwise((x == y).cast("int")))
    filled = F.filter(pairs, lambda p: p.isNotNull())
    hits = F.aggregate(filled, F.lit(0), lambda n, p: n + p)
    return _let(F.struct(hits.alias("hits"), F.size(filled).alias("all")),
                lambda s: F.when(s["all"] == 0, F.lit(1.0)).otherwise(s["hits"] / s["all"]))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and `fingerprint` (text) of every row."""
    return docs.select(F.col(id), as_text(order_minhash(F.col(text))).alias("fingerprint"))


def _longs(values: list[int]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<bigint>") if values else F.array().cast("array<bigint>")


def with_next(docs: DataFrame, id: str, columns: dict[str, Column], parts: int | None = None) -> DataFrame:
    """`id`, `columns` and `next`, a struct of `columns` of the row with the next smaller id (after the smallest: of the
    largest). Null ids come last; rows with equal ids follow each other in the order of the columns.

    Ranges of ids end at ids that occur, so a range's last row finds its successor as a guest row: the
    next range's first, which is the row at that range's upper end. `parts` bounds the ranges, and so the guests.
    The ends are the greatest ids of Spark's own ranges: approximate percentiles are doubles, which miss ids above 2^53.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(id).cast("long").alias("end")).where("end is not null").repartitionByRange(parts, "end")
    greatest = ids.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.max("end").alias("end"))
    ends = sorted(r["end"] for r in greatest.collect())
    key = F.coalesce(F.col(id).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(id).alias("id"), key.alias("key"), F.struct(*[c.alias(n) for n, c in columns.items()]).alias("own"))
    # The range of a row: how many upper ends lie below it, counted by blocks of ends first.
    step = max(1, math.isqrt(len(ends)))
    uppers, blocks = _longs(ends), _longs(ends[step - 1::step])
    whole = step * F.size(F.filter(blocks, lambda e: e < F.col("key")))
    ranged = rows.withColumn("range", whole + F.size(F.filter(F.slice(uppers, whole + 1, step), lambda e: e < F.col("key"))))
    last = max(len(ends) - 1, 0)
    above = F.when(F.col("range") == last, 0).otherwise(F.col("range") + 1)
    is_end = F.get(uppers, F.col("range")) == F.col("key") if ends else F.lit(True)
    copies = F.when(is_end, F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")),
                                    F.struct(above.alias("range"), F.lit(True).alias("guest")))).otherwise(
        F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))))
    dealt = ranged.select("id", "key", "own", F.explode(copies).alias("at")).select("id", "key", "own", "at.range", "at.guest")
    order = Window.partitionBy("range").orderBy("guest", F.desc("key"), "own")
    return dealt.withColumn("next", F.lead("own").over(order)).where(~F.col("guest")).select(F.col("id").alias(id), "own.*", "next")


def edited(text: Column, following: Column) -> Column:
    """`text` with its last floor(n / 2) code points replaced by the first as many (or all) of `following`."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def edit_likeness(docs: DataFrame, id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Per row: id, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited`, `near_next`.

    The edited text takes half of the next document's, by descending id. A single row is its own successor.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = with_next(docs.select(F.col(id), body.alias("_text")).select(F.col(id), F.col("_text"), order_minhash(F.col("_text")).alias("_print")),
                     id, {"text": F.col("_text"), "print": F.col("_print")}, parts)
    changed = rows.select("*", edited(F.col("text"), F.col("next.text")).alias("edited"))
    marked = changed.select("*", order_minhash(F.col("edited")).alias("edited_print"))
    return marked.select(
        F.col(id), F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"), as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next.print")).alias("near_next"),
    )
