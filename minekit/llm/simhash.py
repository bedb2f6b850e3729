"""Near-duplicates by SimHash, with pigeonring filtering of the candidates.

A fingerprint is cut into five segments placed on a ring. If two fingerprints differ in at most four bits,
some segment starts a chain in which the first l segments differ in at most floor(4 l / 5) bits, for every l
(the pigeonring principle). So the first segment of that chain is equal, the next two differ in at most two
bits, and of four blocks of those two at least two are equal. Index keys are (start, first segment, two equal
blocks): about 26 bits, so that unrelated fingerprints seldom meet. Within a key the chain budgets are tested
before the full Hamming distance, and only a spanning forest of the links leaves the group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import forget, in_batches, stored

SEGMENTS = (13, 13, 13, 13, 12)  # bits, from the lowest
BLOCKS = 4  # of the two segments after the first
DISTANCE = 4
#: Members of one key that a task compares at once; larger groups are compared block by block.
GROUP = 20_000
_AT_ONCE = 1 << 16  # hashes per step
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """SimHash of word shingles: XXH64 with seed 42, majority of each bit; 0 without words."""
    words = text.translate(_FOLD).split()
    if not words:
        return 0
    width = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    ends = (ends[width - 1:] - 1).tolist()
    joined = b" ".join(words)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _AT_ONCE):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + _AT_ONCE], ends[at:at + _AT_ONCE])],
                          "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """`id` and `fingerprint` (the 64 bits as a signed long) of every row. Null texts have no words."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(t.as_py() or b"", shingle) for t in rows.column(1)]
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["id", "fingerprint"]
        )

    kind = docs.schema[id].dataType.simpleString()
    narrow = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    return in_batches(narrow, batch, f"id {kind}, fingerprint long")


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _keys(bits: Column) -> Column:
    """The 30 index keys of a fingerprint: five starts, two of four blocks."""
    keys, at = [], 0
    for start, width in enumerate(SEGMENTS):
        ring = bits if at == 0 else F.shiftrightunsigned(bits, at).bitwiseOR(F.shiftleft(bits, 64 - at))
        following = [SEGMENTS[(start + i) % 5] for i in (1, 2)]
        cuts = [round(sum(following) * i / BLOCKS) for i in range(BLOCKS + 1)]
        first = ring.bitwiseAND(F.lit((1 << width) - 1))
        blocks = [
            F.shiftrightunsigned(ring, width + a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in itertools.pairwise(cuts)
        ]
        for n, (i, j) in enumerate(itertools.combinations(range(BLOCKS), 2)):
            tag = F.lit(start * 6 + n).cast("long")
            keys.append(
                F.shiftleft(tag, 40).bitwiseOR(F.shiftleft(first, 20)).bitwiseOR(F.shiftleft(blocks[i], 10)).bitwiseOR(blocks[j])
            )
        at += width
    return F.array(*keys)


def _masks() -> np.ndarray:
    """For each start, the bits of its chains of one to five segments."""
    edges = np.cumsum((0, *SEGMENTS))
    single = [((1 << w) - 1) << int(e) for w, e in zip(SEGMENTS, edges)]
    return np.array([[sum(single[(s + i) % 5] for i in range(n)) for n in range(1, 6)] for s in range(5)], np.uint64)


MASKS = _masks()


def in_chain(difference: np.ndarray, start: int) -> np.ndarray:
    """Whether each chain from `start` stays within its budget; the last chain is the whole fingerprint."""
    fits = np.ones(len(difference), bool)
    for n, mask in enumerate(MASKS[start], 1):
        fits &= np.bitwise_count(difference & mask) <= DISTANCE * n // 5
    return fits


def forest(members: np.ndarray, start: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges that connect what the links of one key group connect: each member found is searched from
    once, among those not found yet, so that dense groups cost little more than their size."""
    left, right, open_ = [], [], members
    while len(open_) > 1:
        queue, open_ = [open_[0]], open_[1:]
        while queue and len(open_):
            one = queue.pop()
            near = in_chain(open_ ^ one, start)
            if near.any():
                found = open_[near]
                left.append(np.full(len(found), one, np.uint64))
                right.append(found)
                queue.extend(found)
                open_ = open_[~near]
    return left, right


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (key, slot); groups may go on in the next batch."""

    def pairs_of(key: np.ndarray, slot: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (slot[1:] != slot[:-1]))))
        sizes = np.diff(np.append(new, len(key)))
        twos = new[sizes == 2]
        left, right = [], []
        starts = key[twos] >> 40
        for start in range(5):
            at = twos[starts // 6 == start]
            fits = in_chain(value[at] ^ value[at + 1], start)
            left.append(value[at][fits])
            right.append(value[at + 1][fits])
        for a, n in zip(new[sizes > 2], sizes[sizes > 2]):
            l, r = forest(value[a:a + n], int(key[a] >> 40) // 6)
            left += l
            right += r
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["a", "b"]
        )

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        parts = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if held and (parts[0][-1], parts[1][-1]) == (held[0][0][0], held[0][1][0]):
            held.append(tuple(parts))  # all of one group
            continue
        key, slot, value = (np.concatenate([*[h[i] for h in held], parts[i]]) for i in range(3))
        last = int(np.flatnonzero((key != key[-1]) | (slot != slot[-1]))[-1]) + 1 if (key[0], slot[0]) != (key[-1], slot[-1]) else 0
        if last:
            yield pairs_of(key[:last], slot[:last], value[:last].view(np.uint64))
        held = [(key[last:], slot[last:], value[last:])]
    if held:
        key, slot, value = (np.concatenate([h[i] for h in held]) for i in range(3))
        yield pairs_of(key, slot, value.view(np.uint64))


def links(prints: DataFrame, group: int = GROUP) -> DataFrame:
    """Edges (`a` < `b`) between the distinct longs in `fingerprint`, which connect exactly the fingerprints
    that chains of links of at most four differing bits connect. Not every link is an edge."""
    distinct = prints.select("fingerprint").distinct()
    index = distinct.select("fingerprint", F.explode(_keys(F.col("fingerprint"))).alias("key"))
    crowded = stored(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group), "crowded")
    if crowded.isEmpty():
        index = index.withColumn("slot", F.lit(0).cast("long"))
    else:
        # Members of a crowded key are dealt to blocks, and each pair of blocks is compared in a group of its own.
        blocks = F.ceil(F.col("n") / group)
        mine = F.pmod(F.xxhash64("fingerprint"), blocks)
        other = F.col("other")
        slots = F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
            F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1),
                        lambda o: F.least(mine, o) * blocks + F.greatest(mine, o) + 1))
        index = index.join(crowded, "key", "left").select("fingerprint", "key", F.explode(slots).alias("slot"))
    dealt = index.select("key", "slot", "fingerprint").repartition("key", "slot").sortWithinPartitions("key", "slot")
    found = dealt.mapInArrow(_edges, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node of its component) for every node of `edges` (`a`, `b`).

    Alternates large-star and small-star steps: each joins a node's neighbours with the smallest of them.
    A step is written to the shared folder; the loop ends when it changes nothing.
    """
    total = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = edges.agg(total.alias("t")).first()["t"]
    while before["n"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: greater neighbours of a node point at the least one.
        large = (both.join(least, both.a == least.node).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # Small star: a node and its smaller neighbours point at the least one.
        small = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        step = (large.join(small, large.a == small.node)
                .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                          F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
                .select("e.a", "e.b").where("a <> b").distinct())
        edges, passed = stored(step, "edges"), edges
        forget(passed)
        after = edges.agg(total.alias("t")).first()["t"]
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()).distinct()


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, group: int = GROUP
) -> DataFrame:
    """One row per row of `docs`: its id, `fingerprint` (hex) and `component_id`, the smallest id that links reach.

    Texts without words share fingerprint 0 and are linked like others. Rows with equal ids count as they
    stand; a null id gets the component of its fingerprint and is never a component's name, which is null
    where a component has no other. Further columns are not read. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, id, text, shingle), "prints")
    roots = components(links(prints, group))
    named = prints.groupBy("fingerprint").agg(F.min("id").alias("first"))
    rooted = named.join(roots, named.fingerprint == roots.node, "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(names, "root").select(F.col("fingerprint").alias("_f"), "component_id")
    joined = prints.join(labels, F.col("fingerprint") == F.col("_f"))
    return joined.select(F.col("id").alias(id), as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4) -> DataFrame:
    """The rows of `docs` whose id names its component: one document of each group stays, as it was.

    Rows that share an id are one document and stay or go together; rows without an id stay.
    """
    found = near_duplicates(docs, id, text, shingle)
    gone = found.where(F.col(id) != F.col("component_id")).select(F.col(id).alias("_gone")).distinct()
    named = found.where(F.col(id) == F.col("component_id")).select(F.col(id).alias("_gone")).distinct()
    gone = gone.join(named, "_gone", "left_anti")  # an id that also names a component stays
    return docs.join(gone, docs[id] == gone["_gone"], "left_anti")
