"""Exact k nearest neighbours (Euclidean) as a partitioned join.

Both sides are packed into blocks of rows and dealt into groups of bounded size; every group of queries meets every
group of base rows in one task, which keeps what can be among the k closest after one matrix product and works the
distances of these out exactly. Copies of a base row are left out beyond those that can be found. No pairs are emitted
except the k best of two groups. A small base is sent to every task instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .bounds import BROADCAST_ROWS, limit_of, pinned, small_rows

#: A base of up to 40 times as many rows is sent to every task.
_CENTRES = 256
#: Rows of a packed block, and of a group, about, on either side.
_BLOCK_ROWS = 2_000
QUERY_GROUP, BASE_GROUP = 16_384, 65_536
#: Queries and base rows of one matrix product.
_TILE = 1_024, 4_096


def _slack(norm: float, offset: float, width: int, kind: type) -> float:
    """More than rounding can change a squared distance of rows this far from their middle, which lies `offset` away."""
    exact = 16.0 * (width + 4) * np.finfo(float).eps * norm * (norm + offset)
    return exact + (16.0 * (width + 4) * np.finfo(np.float32).eps * norm * norm if kind is np.float32 else 0.0)


class Tiles:
    """Squared distances between queries and base rows, a tile at a time, in single precision where that tells rows apart.

    `half(q, b)` gives half the squared distance less half the squared length of the query; adding `lift` to a bound
    on the squared distance and halving gives the bound on it.
    """

    def __init__(self, queries: np.ndarray, base: np.ndarray, typical: float | None = None):
        middle = base.mean(0)
        left, right = queries - middle, base - middle
        self.width = base.shape[1]
        squares, others = (left**2).sum(1), (right**2).sum(1)
        norm = float(np.sqrt(np.nan_to_num(max(squares.max(initial=0.0), others.max(initial=0.0)), nan=0.0)))
        offset = float(np.sqrt(np.nan_to_num((middle**2).sum(), nan=0.0)))
        if typical is None:
            some = left[:: max(1, len(left) // 32)]
            near = [np.nanmin(((right[:: max(1, len(right) // 4096)] - p) ** 2).sum(1)) for p in some]
            typical = float(np.median(near))
        single = _slack(norm, offset, self.width, np.float32)
        kind = np.float32 if norm < 1e15 and single < 0.01 * typical else np.float64
        self.slack = _slack(norm, offset, self.width, kind)
        self.left = np.hstack([-left, np.ones((len(left), 1))]).astype(kind)
        self.right = np.vstack([right.T, others[None, :] / 2]).astype(kind)
        self.lift = squares

    def half(self, q: slice, b: slice) -> np.ndarray:
        return self.left[q] @ self.right[:, b]


def _best_of(rows: np.ndarray, values: np.ndarray, n: int, depth: int) -> np.ndarray:
    """The `depth`-th smallest value of each of `n` rows, infinite where a row has fewer."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    first = np.searchsorted(rows, np.arange(n))
    out = np.full(n, np.inf)
    at = first + depth - 1
    there = (at < len(rows)) & (np.searchsorted(rows, np.arange(n), "right") - first >= depth)
    out[there] = values[at[there]]
    return out


def _closest(query_ids, queries, base_ids, base, times, k: int) -> pd.DataFrame:
    """The k closest base rows of each query, ties by id; a base row counts `times`, and not for a query of its own id."""
    none = pd.DataFrame({"query_id": query_ids[:0], "base_id": base_ids[:0], "distance": np.empty(0)})
    if not len(queries) or not len(base):
        return none
    tiles = Tiles(queries, base)
    same = pd.DataFrame({"id": query_ids, "q": np.arange(len(query_ids))}).merge(
        pd.DataFrame({"id": base_ids, "b": np.arange(len(base_ids))}), on="id").sort_values("q")
    same_q, same_b = same["q"].to_numpy(), same["b"].to_numpy()
    kept = []
    for start in range(0, len(queries), _TILE[0]):
        chunk = slice(start, min(start + _TILE[0], len(queries)))
        n = chunk.stop - start
        own = slice(*np.searchsorted(same_q, [start, chunk.stop]))
        rows, cols, values = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        bound = np.full(n, np.inf)  # of half the squared distance, less half the squared length of the query
        slack = tiles.slack
        for first in range(0, len(base), _TILE[1]):
            last = min(first + _TILE[1], len(base))
            near = tiles.half(chunk, slice(first, last))
            inside = (same_b[own] >= first) & (same_b[own] < last)
            near[same_q[own][inside] - start, same_b[own][inside] - first] = np.inf
            if first == 0:
                depth = min(k, last)
                if depth == k:
                    bound = np.partition(near, depth - 1, axis=1)[:, depth - 1].astype(float)
                    bound[np.isnan(bound)] = np.inf
            limit = (bound + slack).astype(near.dtype)
            limit = np.nextafter(limit, np.asarray(np.inf, near.dtype))
            found = np.flatnonzero((near <= limit[:, None]) & (near < np.inf))
            if not len(found):
                continue
            new_rows, new_cols = np.divmod(found, last - first)
            rows = np.concatenate([rows, new_rows])
            cols = np.concatenate([cols, new_cols + first])
            values = np.concatenate([values, near.ravel()[found].astype(float)])
            bound = np.minimum(bound, _best_of(rows, values, n, k))
            stay = values <= bound[rows] + 2 * slack
            rows, cols, values = rows[stay], cols[stay], values[stay]
        for some in np.array_split(np.arange(len(rows)), -(-len(rows) // 50_000) or 1):
            values[some] = np.sqrt(((base[cols[some]] - queries[start + rows[some]]) ** 2).sum(1))
        kept.append(_ranked(query_ids[start + rows], base_ids[cols], values, times[cols], rows, k))
    return pd.concat(kept, ignore_index=True) if kept else none


def _ranked(queries, found, distance, times, rows, k: int) -> pd.DataFrame:
    """The first k of each row by distance, then id, each as often as it counts."""
    table = pd.DataFrame({"query_id": queries, "base_id": found, "distance": distance, "row": rows})
    order = np.repeat(np.arange(len(table)), np.minimum(times, k))
    table = table.take(order).sort_values(["row", "distance", "base_id"], kind="stable")
    return table[table.groupby("row").cumcount() < k].drop(columns="row")


def packed(rows: DataFrame, groups: int) -> DataFrame:
    """(grp, ids, vectors, times): blocks of the rows (id, v, times), dealt evenly into `groups`. Written once, so that
    every later reader sees the same blocks."""
    id_type = rows.schema["id"].dataType.simpleString()
    number = "<f4" if rows.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK_ROWS):
                part = batch.slice(at, _BLOCK_ROWS)
                ids, times = (pa.ListArray.from_arrays([0, part.num_rows], part.column(i)) for i in (0, 2))
                vectors = matrix_of(part.column(1)).astype(number).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group], pa.int32()), ids, pa.array([vectors], pa.binary()), times],
                    names=["grp", "ids", "vectors", "times"])

    dealt = rows.select("id", "v", "times").repartition(groups)
    return pinned(dealt.mapInArrow(pack, f"grp int, ids array<{id_type}>, vectors binary, times array<int>"))


def matrix_of(vectors: pa.Array) -> np.ndarray:
    """A row per vector; vectors must be there and equally long."""
    lengths = np.unique(vectors.value_lengths().to_numpy(zero_copy_only=False))
    flat = vectors.flatten()
    if vectors.null_count or flat.null_count or len(lengths) > 1:
        raise ValueError("vectors must be present, complete and equally long")
    return flat.to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def unpacked(blocks: pa.Table, number: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors as doubles and counts of a group's blocks."""
    ids = np.concatenate([ids.values.to_numpy(zero_copy_only=False) for ids in blocks.column("ids").combine_chunks()])
    times = np.concatenate([n.values.to_numpy() for n in blocks.column("times").combine_chunks()])
    held = b"".join(v.as_py() for v in blocks.column("vectors"))
    return ids, np.frombuffer(held, number).astype(float).reshape(len(ids), -1), times


def number_of(rows: DataFrame) -> str:
    return "<f4" if rows.schema["v"].dataType.elementType.simpleString() == "float" else "<f8"


def _as_floats(df: DataFrame, column: str) -> Column:
    """The vector, as floats if it holds floats (half the bytes to move), else as doubles."""
    held = df.schema[column].dataType.simpleString()
    return (F.col(column) if held == "array<float>" else F.col(column).cast("array<double>")).alias("v")


def nearest(queries: DataFrame, base: DataFrame, k: int, id_col: str, vector_col: str) -> DataFrame:
    """(query_id, base_id, distance, rank) for the k nearest base rows; a row is not its own neighbour.

    `id_col` should be unique across both inputs; equal ids mean the same row.
    """
    spark = base.sparkSession
    base = base.select(F.col(id_col).alias("id"), _as_floats(base, vector_col))
    queries = queries.select(F.col(id_col).alias("id"), _as_floats(queries, vector_col))
    id_type = base.schema["id"].dataType.simpleString()
    result = f"query_id {id_type}, base_id {id_type}, distance double"
    cores = spark.sparkContext.defaultParallelism

    rows = small_rows(base, min(_CENTRES * 40, limit_of(spark, BROADCAST_ROWS)))
    if rows is not None:
        matrix = np.array([r["v"] for r in rows], dtype=float)
        names = np.array([r["id"] for r in rows], dtype=object if id_type == "string" else None)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows if len(names) else 0, _BLOCK_ROWS):
                    part = batch.slice(at, _BLOCK_ROWS)
                    ids = part.column(0).to_numpy(zero_copy_only=False)
                    found = _closest(ids, matrix_of(part.column(1)).astype(float), names, matrix, np.ones(len(names), int), k)
                    yield pa.RecordBatch.from_pandas(found, part_schema, preserve_index=False)

        part_schema = _arrow_schema(queries, base)
        # A file of a few megabytes is one task; the work here is queries times base rows.
        found = queries.repartition(2 * cores).mapInArrow(scan, result)
    else:
        found = _by_groups(queries, base, k, result, cores)
    best = Window.partitionBy("query_id").orderBy("distance", "base_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _arrow_schema(queries: DataFrame, base: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema([("query_id", to_arrow_type(queries.schema["id"].dataType)),
                      ("base_id", to_arrow_type(base.schema["id"].dataType)), ("distance", pa.float64())])


def _by_groups(queries: DataFrame, base: DataFrame, k: int, result: str, cores: int) -> DataFrame:
    # Of equal vectors only the k + 1 least ids can be found (the query's own is left out); rows that repeat count.
    counted = base.groupBy("v", "id").agg(F.count("*").alias("times"))
    least = Window.partitionBy("v").orderBy("id")
    distinct = counted.withColumn("at", F.row_number().over(least)).filter(F.col("at") <= k + 1).select(
        "id", "v", F.least("times", F.lit(k)).cast("int").alias("times"))
    distinct = pinned(distinct)
    asked, held = queries.count(), distinct.count()
    base_groups = max(1, -(-held // BASE_GROUP))
    query_groups = max(1, -(-asked // QUERY_GROUP))
    if query_groups * base_groups < 4 * cores:  # enough tasks, of at least a few hundred queries
        query_groups = max(query_groups, min(-(-4 * cores // base_groups), -(-asked // 512)))
    left = packed(queries.withColumn("times", F.lit(1)), query_groups)
    right = packed(distinct, base_groups)
    pairs = query_groups * base_groups
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(base_groups - 1)))).withColumn(
        "pair", F.col("grp") * base_groups + F.col("other"))
    right = right.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1)))).withColumn(
        "pair", F.col("other") * base_groups + F.col("grp"))
    sides = [side.select("pair", "ids", "vectors", "times").repartition(min(pairs, 10_000), "pair") for side in (left, right)]
    schema, numbers = _arrow_schema(queries, base), (number_of(queries), number_of(base))

    def meet(asking: pa.Table, offered: pa.Table) -> pa.Table:
        if not asking.num_rows or not offered.num_rows:
            return schema.empty_table()
        (ids, points, _), (names, others, times) = (unpacked(t, n) for t, n in zip((asking, offered), numbers))
        return pa.Table.from_pandas(_closest(ids, points, names, others, times, k), schema, preserve_index=False)

    return sides[0].groupBy("pair").cogroup(sides[1].groupBy("pair")).applyInArrow(meet, result)
