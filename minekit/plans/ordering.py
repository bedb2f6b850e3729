"""Ordered computations (row numbers, running sums, lags) that never put a large group in one task.

A group within the row bound uses a plain window.  Beyond it, rows are range-partitioned on
(keys, order), each range is handled on its own, and per-range totals carry the running state
from one range to the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .bounds import GROUP_ROWS, attach, has_large_group, limit_of, pinned

Order = Sequence[str | Column]


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Order, sums: Mapping[str, Column], large: bool | None = None
) -> DataFrame:
    """Add running totals of `sums` along `order` within `keys`; `order` must be unique per key.

    `large` is passed by callers that have counted the groups already.
    """
    keys = list(keys)
    if not (has_large_group(df, keys) if large is None else large):
        running = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(e).over(running).alias(n) for n, e in sums.items()])

    ranged = df.select("*", *[e.alias(f"_v_{n}") for n, e in sums.items()])
    ranged = ranged.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = pinned(ranged)
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_range", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums]
    )
    inside = (
        Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    with_offsets = attach(ranged, offsets, [*keys, "_range"])
    return with_offsets.select(
        *df.columns, *[(F.sum(f"_v_{n}").over(inside) + F.col(f"_o_{n}")).alias(n) for n in sums]
    )


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Order, name: str = "row_number", large: bool | None = None
) -> DataFrame:
    """Add the 1-based position along `order` within `keys`."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("long")}, large)


def lagged(
    df: DataFrame, keys: Sequence[str], order: Order, lags: Mapping[str, tuple[str, int]], large: bool | None = None
) -> DataFrame:
    """Add columns `name -> (source column, distance)` looking back along `order` within `keys`."""
    keys = list(keys)
    if not (has_large_group(df, keys) if large is None else large):
        back = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[F.lag(c, i).over(back).alias(n) for n, (c, i) in lags.items()])

    # Cut each group into runs of fixed length and give every run the last rows of the run before.
    reach = max(i for _, i in lags.values())
    length = max(limit_of(df.sparkSession, GROUP_ROWS), reach)
    numbered = row_numbers(df, keys, order, "_pos", large=True)
    run = F.floor((F.col("_pos") - 1) / length)
    tail = F.pmod(F.col("_pos") - 1, F.lit(length)) >= length - reach
    copies = F.when(tail, F.array(run, run + 1)).otherwise(F.array(run))
    spread = numbered.withColumn("_run", F.explode(copies)).withColumn("_own", F.col("_run") == run)
    back = Window.partitionBy(*keys, "_run").orderBy("_pos")
    out = spread.select("*", *[F.lag(c, i).over(back).alias(n) for n, (c, i) in lags.items()])
    return out.filter("_own").drop("_pos", "_run", "_own")
