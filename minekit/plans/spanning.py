"""Exact Euclidean minimum spanning trees of large point tables, and components of forests.

Points lie in cells around sampled centres, cut into blocks of bounded size. Every edge of the tree is an edge of the
tree of some pair of blocks, so blocks meet in pairs; a pair is left out where a path known already (trees inside
blocks, and one over their representatives) has no edge as long as the distance between the two. What remains is a
sparse graph, on which Boruvka's rounds run as joins and grouped minima. Edges are ordered by length, then ids, so the
tree is unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .bounds import BROADCAST_ROWS, join_facts, limit_of, pinned, small_rows
from .hashing import shuffle_key

#: Points of a block, about; two blocks' distances are held by one task.
BLOCK = 1000
_EDGE = "a long, b long, d double"


def _distances(points: np.ndarray) -> np.ndarray:
    """All distances, worked out difference by difference so that close points lose no digits."""
    out = np.empty((len(points), len(points)))
    for i, p in enumerate(points):
        out[i] = np.sqrt(((points - p) ** 2).sum(1))
    return out


def dense_tree(ids: np.ndarray, points: np.ndarray) -> list[tuple[int, int, float]]:
    """The minimum spanning tree of a few points, by Prim's method; ties go to the smaller ids."""
    n = len(ids)
    if n < 2:
        return []
    apart = _distances(points)
    outside = np.ones(n, bool)
    outside[0] = False
    nearest, parent, edges = apart[0].copy(), np.zeros(n, np.int64), []
    for _ in range(n - 1):
        least = nearest[outside].min()
        tied = np.flatnonzero(outside & (nearest == least))
        # A point keeps its least edge, so ties are between the edges of different points.
        at = min(tied.tolist(), key=lambda i: (min(ids[i], ids[parent[i]]), max(ids[i], ids[parent[i]])))
        a, b = sorted((int(ids[at]), int(ids[parent[at]])))
        edges.append((a, b, float(least)))
        outside[at] = False
        closer = outside & (apart[at] < nearest)
        even = outside & (apart[at] == nearest)
        for i in np.flatnonzero(even).tolist():
            old, new = sorted((ids[i], ids[parent[i]])), sorted((ids[i], ids[at]))
            closer[i] |= new < old
        nearest[closer], parent[closer] = apart[at][closer], at
    return edges


def kruskal(edges: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The edges of a minimum spanning forest of a few edges."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up] if up in root else up
            x = root[x]
        return x

    kept = []
    for a, b, d in sorted(edges, key=lambda e: (e[2], e[0], e[1])):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b, d))
    return kept


def _blocks(points: DataFrame, n: int) -> DataFrame:
    """Points with the number of their block: a cell around a sampled centre, cut by a hash if it is crowded."""
    count = max(1, -(-n // BLOCK))
    rows = points.orderBy(shuffle_key(["id"], 0)).limit(min(count, 4096)).collect()
    centres = np.array([r["v"] for r in rows], dtype=float)

    @F.pandas_udf("int")
    def cell(v: pd.Series) -> pd.Series:
        found = [((centres - np.asarray(p, dtype=float)) ** 2).sum(1).argmin() for p in v]
        return pd.Series(found, dtype="int32")

    placed = pinned(points.withColumn("cell", cell("v")))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))  # a row per centre
    parts = F.broadcast(placed.sparkSession.createDataFrame(sizes.collect(), sizes.schema))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    return placed.join(parts, "cell").select("id", "v", F.struct("cell", part.alias("part")).alias("at"))


def _near_pairs(facts: list) -> list[tuple]:
    """Pairs of blocks between which an edge of the tree may run, from each block's centre, radius, a point of it, and
    the longest edge of its own tree."""
    n = len(facts)
    centre = np.array([f["centre"] for f in facts], dtype=float)
    point = np.array([f["point"] for f in facts], dtype=float)
    radius, longest = (np.array([f[c] for f in facts], dtype=float) for c in ("radius", "longest"))
    # The tree over the representatives, and the longest edge on the way between any two of them.
    way = np.zeros((n, n))
    members = {i: [i] for i in range(n)}
    where = list(range(n))
    for a, b, d in sorted(dense_tree(np.arange(n), point), key=lambda e: e[2]):
        x, y = where[a], where[b]
        way[np.ix_(members[x], members[y])] = way[np.ix_(members[y], members[x])] = d
        for m in members[y]:
            where[m] = x
        members[x] += members.pop(y)
    pairs = []
    for i in range(n):
        gap = np.sqrt(((centre - centre[i]) ** 2).sum(1)) - radius - radius[i]
        bound = np.maximum(way[i], np.maximum(longest, longest[i]))
        # Rounding must not drop a pair: leave some slack.
        near = np.flatnonzero(gap <= bound * (1 + 1e-9) + 1e-9)
        pairs += [(facts[i]["at"], facts[j]["at"]) for j in near.tolist() if j > i]
    return pairs


def spanning_tree(points: DataFrame) -> DataFrame:
    """(a, b, d) with a < b: the n - 1 edges of the minimum spanning tree of `id` (unique longs) and `v` (doubles).

    The driver holds facts of blocks, one for about a thousand points. Without points, or with one, there is no edge.
    """
    spark = points.sparkSession
    points = pinned(points.select("id", "v"))
    n = points.count()
    if n < 2:
        return spark.createDataFrame([], _EDGE)
    blocks = pinned(_blocks(points, n))
    own_schema = f"at struct<cell:int,part:bigint>, edges array<struct<a:bigint,b:bigint,d:double>>, centre array<double>, radius double, point array<double>, longest double"

    def own(rows: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(rows["v"].map(np.asarray)).astype(float)
        edges = dense_tree(rows["id"].to_numpy(), v)
        middle = v.mean(0)
        away = np.sqrt(((v - middle) ** 2).sum(1))
        return pd.DataFrame({
            "at": [rows["at"].iloc[0]], "edges": [[{"a": a, "b": b, "d": d} for a, b, d in edges]], "centre": [middle.tolist()],
            "radius": [float(away.max())], "point": [v[away.argmin()].tolist()], "longest": [max((d for _, _, d in edges), default=0.0)]})

    inner = pinned(blocks.groupBy("at").applyInPandas(own, own_schema))
    edges = inner.select(F.explode("edges").alias("e")).select("e.*")
    pairs = _near_pairs(inner.drop("edges").collect())
    if pairs:
        kind = "left struct<cell:int,part:bigint>, right struct<cell:int,part:bigint>, pair long"
        numbered = [(tuple(a), tuple(b), i) for i, (a, b) in enumerate(pairs)]
        table = spark.createDataFrame(numbered, kind)
        sides = table.select("pair", F.col("left").alias("at"), F.lit(0).alias("side")).unionByName(
            table.select("pair", F.col("right").alias("at"), F.lit(1).alias("side")))
        met = blocks.join(sides, "at").select("pair", "side", "id", "v")

        def cross(rows: pd.DataFrame) -> pd.DataFrame:
            side = dict(zip(rows["id"], rows["side"]))
            tree = dense_tree(rows["id"].to_numpy(), np.stack(rows["v"].map(np.asarray)).astype(float))
            return pd.DataFrame([e for e in tree if side[e[0]] != side[e[1]]], columns=["a", "b", "d"])

        edges = edges.unionByName(met.groupBy("pair").applyInPandas(cross, _EDGE))
    return boruvka(edges)[0]


def _forests(edges: DataFrame) -> DataFrame:
    """Edges without those that close a circle within their partition; they are in no minimum tree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, int, float]] = []
        for batch in batches:
            held = kruskal([*held, *batch.itertuples(index=False, name=None)])
            if len(held) > 200_000:
                yield pd.DataFrame(held, columns=["a", "b", "d"])
                held = []
        yield pd.DataFrame(held, columns=["a", "b", "d"])

    return edges.select("a", "b", "d").mapInPandas(run, _EDGE)


def boruvka(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The minimum spanning forest of (a, b, d), and (id, component) of the points it joins, named by their least id.

    Every round joins each component to another along its least edge, so components at least halve. Once the edges
    left between components fit the broadcast bound, the driver finishes them.
    """
    spark = edges.sparkSession
    left = pinned(_forests(edges).select("a", "b", "d", F.col("a").alias("x"), F.col("b").alias("y")))
    members = pinned(left.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("component")))
    chosen = []
    while True:
        rows = small_rows(left.select("x", "y", "d", "a", "b"), limit_of(spark, BROADCAST_ROWS))
        if rows is not None:
            break
        ends = left.select(F.explode(F.array(F.struct("x", F.col("y").alias("other")), F.struct(F.col("y").alias("x"), F.col("x").alias("other")))).alias("e"), "a", "b", "d")
        least = ends.groupBy("e.x").agg(F.min(F.struct("d", "a", "b", F.col("e.other").alias("other"))).alias("m")).select("x", "m.*")
        least = pinned(least)
        chosen.append(least.select("a", "b", "d").distinct())
        # Following least edges ends in two components that chose each other; the smaller one is the root.
        up = least.join(least.select(F.col("x").alias("_x"), F.col("other").alias("_back")), F.col("other") == F.col("_x"))
        up = pinned(up.select("x", F.when((F.col("_back") == F.col("x")) & (F.col("x") < F.col("other")), F.col("x")).otherwise(F.col("other")).alias("root")))
        while True:
            further = up.join(up.select(F.col("root").alias("_up"), F.col("x").alias("_at")), F.col("root") == F.col("_at"))
            further = pinned(further.select("x", F.col("_up").alias("root"), (F.col("_up") != F.col("root")).alias("moved")))
            up = further.drop("moved")
            if further.where("moved").isEmpty():
                break
        left = left.join(up.select(F.col("x"), F.col("root").alias("_rx")), "x").join(
            up.select(F.col("x").alias("y"), F.col("root").alias("_ry")), "y").where("_rx <> _ry")
        # Between two components only the least edge can be in the tree.
        pair = [F.least("_rx", "_ry").alias("x"), F.greatest("_rx", "_ry").alias("y")]
        left = pinned(left.select(*pair, "a", "b", "d").groupBy("x", "y").agg(F.min(F.struct("d", "a", "b")).alias("m")).select("m.a", "m.b", "m.d", "x", "y"))
        members = pinned(join_facts(members, up.withColumnRenamed("x", "component"), ["component"], "left").select(
            "id", F.coalesce("root", "component").alias("component")))
    name: dict[int, int] = {}

    def find(x: int) -> int:
        while name.setdefault(x, x) != x:
            x = name[x]
        return x

    last = []
    for r in sorted(rows, key=lambda r: (r["d"], r["a"], r["b"])):
        x, y = find(r["x"]), find(r["y"])
        if x != y:
            name[max(x, y)] = min(x, y)
            last.append((r["a"], r["b"], r["d"]))
    chosen.append(spark.createDataFrame(last, _EDGE))
    ends = [(x, find(x)) for x in list(name)]  # at most two per edge that fitted the bound
    if ends:
        known = F.broadcast(spark.createDataFrame(ends, "component long, root long"))
        members = members.join(known, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
    named = members.groupBy("component").agg(F.min("id").alias("_least"))
    members = members.join(named, "component").select("id", F.col("_least").alias("component"))
    tree = chosen[0]
    for more in chosen[1:]:
        tree = tree.unionByName(more)
    return pinned(tree), pinned(members)
