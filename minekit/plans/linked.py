"""Single-linkage clusters without their tree: components of points that lie within a height of each other.

Points of up to three dimensions fall into cells in which all lie within the height. Neighbouring cells are linked
where two of their outermost points are near enough, or not at all where their boxes are too far apart; only what
this leaves open is decided point by point. Points of more dimensions meet in pairs of packed groups, each of which
gives a spanning forest instead of its pairs. Clusters cut into a number are those at a height with that many.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bounds import attach, pinned
from .neighbours import _TILE, Tiles, number_of, packed, unpacked
from .spanning import boruvka

#: Rows of a group of points of many dimensions, and of one side of a pair of cells, about.
GROUP = 32_768
#: Heights that are tried for a number of clusters.
TRIES = 40
_PAIR = "a long, b long"


def joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels (the least member of each component) after the edges between `u` and `v`."""
    while True:
        a, b = label[u], label[v]
        differ = a != b
        if not differ.any():
            return label
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = parent[parent]
            if (further == parent).all():
                break
            parent = further
        label = parent[label]


def _links(ids: np.ndarray, points: np.ndarray, others: np.ndarray, offered: np.ndarray, height: float) -> pd.DataFrame:
    """A forest that connects the rows of both sides within `height` of each other; equal ids are one row."""
    names, n = np.concatenate([ids, others]), len(ids)
    same = pd.DataFrame({"id": ids, "q": np.arange(n)}).merge(pd.DataFrame({"id": others, "b": np.arange(len(others))}), on="id")
    label = joined(np.arange(len(names)), same["q"].to_numpy(), n + same["b"].to_numpy())
    tiles = Tiles(points, offered, height * height)
    bound = (height * height - tiles.lift) / 2
    for start in range(0, n, _TILE[0]):
        chunk = slice(start, min(start + _TILE[0], n))
        limit = bound[chunk, None]
        for first in range(0, len(others), _TILE[1]):
            width = min(_TILE[1], len(others) - first)
            near = tiles.half(chunk, slice(first, first + width))
            found = np.flatnonzero(near <= np.nextafter((limit + tiles.slack).astype(near.dtype), np.asarray(np.inf, near.dtype)))
            rows, cols = np.divmod(found, width)
            apart = label[start + rows] != label[n + first + cols]
            rows, cols, values = rows[apart], cols[apart], near.ravel()[found[apart]].astype(float)
            sure = values < limit[rows, 0] - tiles.slack
            label = joined(label, start + rows[sure], n + first + cols[sure])
            rows, cols = rows[~sure], cols[~sure]
            for at in range(0, len(rows), 50_000):
                r, c = start + rows[at : at + 50_000], first + cols[at : at + 50_000]
                close = np.sqrt(((offered[c] - points[r]) ** 2).sum(1)) <= height
                label = joined(label, r[close], n + c[close])
    moved = np.flatnonzero(label != np.arange(len(names)))
    a, b = names[moved], names[label[moved]]
    made = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return made[made["a"] != made["b"]].drop_duplicates()


def _named(points: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """`points` with the component that `edges` between the values of `key` give; without an edge it is the value."""
    members = boruvka(edges.select("a", "b", F.lit(0.0).alias("d")))[1].select(F.col("id").alias("_id"), "component")
    out = points.join(members, F.col(key) == F.col("_id"), "left").drop("_id")
    return out.withColumn("component", F.coalesce("component", key))


def _by_groups(points: DataFrame, height: float) -> DataFrame:
    cores = points.sparkSession.sparkContext.defaultParallelism
    distinct = pinned(points.groupBy("v").agg(F.min("id").alias("id")))
    n = distinct.count()
    groups = max(1, -(-n // GROUP), min(math.isqrt(8 * cores), -(-n // 512)))
    blocks = packed(distinct.withColumn("times", F.lit(1)), groups)
    last = F.lit(groups - 1)
    left = blocks.withColumn("other", F.explode(F.sequence(F.col("grp"), last))).withColumn("pair", F.col("grp") * groups + F.col("other"))
    right = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("grp")))).withColumn("pair", F.col("other") * groups + F.col("grp"))
    parts = min(groups * (groups + 1) // 2, 10_000)
    left, right = (side.select("pair", "ids", "vectors", "times") for side in (left, right))
    right = right.toDF("_pair", "_ids", "_vectors", "_times")  # both sides come from one table, whose columns cogroup would mix up
    number, schema = number_of(distinct), pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(one: pa.Table, two: pa.Table) -> pa.Table:
        if not one.num_rows or not two.num_rows:
            return schema.empty_table()
        (ids, points, _), (others, offered, _) = unpacked(one, number), unpacked(two.rename_columns(one.column_names), number)
        return pa.Table.from_pandas(_links(ids, points, others, offered, height), schema, preserve_index=False)

    left, right = left.repartition(parts, "pair"), right.repartition(parts, "_pair")
    edges = left.groupBy("pair").cogroup(right.groupBy("_pair")).applyInArrow(meet, _PAIR)
    # Copies are linked at any height.
    known = _named(distinct.withColumnRenamed("id", "_least"), "_least", edges).select(F.col("v").alias("_v"), "component")
    return points.join(known, F.col("v") == F.col("_v")).select("id", "component")


class _Cells:
    """Cells of points that lie within a height of each other, over the box of all points."""

    def __init__(self, points: DataFrame, low: list[float], extent: float):
        self.points, self.low, self.extent, self.width = points, low, extent, len(low)

    def placed(self, height: float) -> DataFrame:
        side = height / math.sqrt(self.width) * (1 - 1e-6)  # rounding must not put points into one cell that lie further apart
        return self.points.withColumn("cell", F.array(*[F.floor((F.col("v")[i] - F.lit(self.low[i])) / F.lit(side)) for i in range(self.width)]))

    def fine(self, height: float) -> bool:
        """Whether places can be told to far less than the margin of a cell's side."""
        offset = max(abs(x) for x in self.low)
        return (self.extent + offset) / height < 1e8

    def components(self, height: float) -> DataFrame:
        """(cell, component)."""
        v, dims = F.col("v"), range(self.width)
        if self.width == 1:
            ends = [F.array(f(v[0])) for f in (F.min, F.max)]
        elif self.width == 2:  # over numbers, so that Spark can aggregate by hash
            ends = [F.array(f(v[0]), g(v[1], v[0])) for f, g in ((F.min, F.min_by), (F.max, F.max_by))]
            ends += [F.array(g(v[0], v[1]), f(v[1])) for f, g in ((F.min, F.min_by), (F.max, F.max_by))]
        else:
            ends = [g("v", v[i]) for g in (F.min_by, F.max_by) for i in dims]
        cells = pinned(self.placed(height).groupBy("cell").agg(
            F.min("id").alias("name"), F.count("*").alias("n"), F.array(*[F.min(v[i]) for i in dims]).alias("lo"),
            F.array(*[F.max(v[i]) for i in dims]).alias("hi"), F.array(*ends).alias("ends")))
        reach = math.ceil(math.sqrt(self.width) / (1 - 1e-6))
        steps = [o for o in itertools.product(range(-reach, reach + 1), repeat=self.width) if o > (0,) * self.width]
        around = F.explode(F.array(*[F.array(*[F.lit(x).cast("long") for x in o]) for o in steps]))
        a = cells.select(F.struct("cell", "name", "n", "lo", "hi", "ends").alias("a"), around.alias("step"))
        a = a.withColumn("at", F.zip_with("a.cell", "step", lambda x, y: x + y)).drop("step")
        b = cells.select(F.col("cell").alias("at"), F.struct("cell", "name", "n", "lo", "hi", "ends").alias("b"))
        wide = [F.greatest(F.col("b.lo")[i] - F.col("a.hi")[i], F.col("a.lo")[i] - F.col("b.hi")[i], F.lit(0.0)) for i in dims]

        def apart(p, q):
            return F.sqrt(sum(((p[i] - q[i]) * (p[i] - q[i]) for i in dims), F.lit(0.0)))

        close = F.exists("a.ends", lambda p: F.exists("b.ends", lambda q: apart(p, q) <= F.lit(height)))
        near = a.join(b, "at").filter(F.sqrt(sum((w * w for w in wide), F.lit(0.0))) <= F.lit(height * (1 + 1e-9)))
        near = pinned(near.select("a", "b", close.alias("sure")))
        edges = near.filter("sure").select(F.col("a.name").alias("a"), F.col("b.name").alias("b"))
        open_pairs = near.filter("not sure")
        if not open_pairs.isEmpty():
            so_far = _named(cells.select(F.col("name").alias("_name")), "_name", edges)
            one, two = (so_far.withColumnsRenamed({"_name": f"_{s}", "component": f"_c{s}"}) for s in "ab")
            open_pairs = pinned(open_pairs.join(one, F.col("a.name") == F.col("_a")).join(two, F.col("b.name") == F.col("_b")).filter("_ca <> _cb").select("a", "b"))
            edges = edges.unionByName(self._decided(open_pairs, height))
        return pinned(_named(cells.select("cell", "name"), "name", edges).select("cell", "component"))

    def _decided(self, pairs: DataFrame, height: float) -> DataFrame:
        """Those of the pairs of cells that have two points within the height."""
        count = {s: F.ceil(F.col(f"{s}.n") / GROUP) for s in "ab"}
        sides = []
        for own, other in ("ab", "ba"):
            asked = pairs.select(
                F.col("a.name").alias("a"), F.col("b.name").alias("b"), F.col(f"{own}.cell").alias("cell"), F.col(f"{other}.lo").alias("lo"),
                F.col(f"{other}.hi").alias("hi"), count[own].alias("own"), count[other].alias("others"))
            points = attach(self.placed(height), asked.groupBy("cell").agg(F.collect_list(F.struct("a", "b", "lo", "hi", "own", "others")).alias("asked")), ["cell"])
            points = points.select("id", "v", F.explode("asked").alias("p")).select("id", "v", "p.*")
            wide = [F.greatest(F.col("v")[i] - F.col("hi")[i], F.col("lo")[i] - F.col("v")[i], F.lit(0.0)) for i in range(self.width)]
            points = points.filter(F.sqrt(sum((w * w for w in wide), F.lit(0.0))) <= F.lit(height * (1 + 1e-9)))
            part = F.pmod(F.xxhash64("id"), F.col("own"))
            every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
            points = points.withColumn("part", part).withColumn("every", every)
            at = ["part", "every"] if own == "a" else ["every", "part"]
            names = [f"{c}{'' if own == 'a' else '_'}" for c in ("a", "b", "i", "j", "id", "v")]  # columns of their own, as above
            sides.append(points.select("a", "b", *at, "id", "v").toDF(*names))

        def meet(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
            none = pd.DataFrame({"a": [], "b": []}, dtype="int64")
            if one.empty or two.empty:
                return none
            p, q = (np.stack(side.iloc[:, 5].to_list()).astype(float) for side in (one, two))
            for start in range(0, len(p), 256):
                for first in range(0, len(q), 4096):
                    if (np.sqrt(((p[start : start + 256, None] - q[None, first : first + 4096]) ** 2).sum(2)) <= height).any():
                        return one[["a", "b"]].head(1)
            return none

        grouped = [side.groupBy(*side.columns[:4]) for side in sides]
        return grouped[0].cogroup(grouped[1]).applyInPandas(meet, _PAIR)

    def members(self, cells: DataFrame, height: float) -> DataFrame:
        return attach(self.placed(height), cells, ["cell"]).select("id", "component")


def _cells(points: DataFrame) -> _Cells | None:
    """None for points of more than three dimensions, and where one is missing or not finite."""
    first = points.select(F.size("v").alias("n")).first()
    width = first["n"] if first else 0
    if not 1 <= width <= 3:
        return None
    v = F.col("v")
    odd = F.count_if(v.isNull() | (F.size("v") != width) | F.exists("v", lambda x: x.isNull() | F.isnan(x)))
    box = points.agg(odd.alias("odd"), *[f(v[i]).alias(f"{n}{i}") for i in range(width) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if box["odd"]:
        return None
    low, high = ([box[f"{n}{i}"] for i in range(width)] for n in ("lo", "hi"))
    extent = math.hypot(*(h - l for l, h in zip(low, high)))
    return _Cells(points, low, extent) if math.isfinite(extent) else None


def clusters_at(points: DataFrame, height: float) -> DataFrame:
    """(id, component) of points (id, v): the clusters of single linkage at a height, named by their least id."""
    cells = _cells(points) if height > 0 else None
    if cells is not None and cells.fine(height):
        return cells.members(cells.components(height), height)
    return _by_groups(points, height)


def clusters_of(points: DataFrame, k: int) -> DataFrame | None:
    """(id, component) of the clusters of single linkage cut into `k`, or None where that takes the tree: for points of
    more than three dimensions, and where no height that is tried has as many clusters, as with ties at the cut."""
    cells = _cells(points)
    if cells is None or not cells.extent:
        return None
    low, high = 0.0, cells.extent
    height = high / 2
    for _ in range(TRIES):
        if not cells.fine(height) or high <= low * (1 + 1e-9):
            return None
        found = cells.components(height)
        n = found.select("component").distinct().count()
        if n == k:
            return cells.members(found, height)
        low, high = (low, height) if n < k else (height, high)
        height = math.sqrt(low * high) if low else high / 2
    return None
