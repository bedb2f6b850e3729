"""Exact linear-interpolation quantiles for groups of any size."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .bounds import attach, has_large_group, join_facts, pinned, small_rows
from .ordering import running_sums

_ACCURACY = 10_000


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group; each of `columns` becomes an array aligned with `probs` (nulls skipped)."""
    by = list(by)
    if not has_large_group(df, by):
        at = F.array(*[F.lit(float(p)) for p in probs])
        picked = [F.percentile(F.col(c).cast("double"), at).alias(c) for c in columns]
        return df.groupBy(*by).agg(*picked)

    keys = [f"_g{i}" for i in range(len(by))]
    values = [f"_v{j}" for j in range(len(columns))]
    rows = df.select(
        *[F.col(b).alias(k) for b, k in zip(by, keys)],
        *[F.col(c).cast("double").alias(v) for c, v in zip(columns, values)],
    )
    found = _order_statistics(rows, keys, values, probs)
    picked = [
        F.sort_array(F.collect_list(F.when(F.col("_c") == j, F.struct("_i", "_q"))))["_q"].alias(v)
        for j, v in enumerate(values)
    ]
    wide = found.groupBy(*keys).agg(*picked)
    groups = rows.select(*keys).distinct() if by else None
    both = join_facts(groups, wide, keys, how="left") if by else wide
    return both.select(
        *[F.col(k).alias(b) for b, k in zip(by, keys)],
        *[F.when(F.size(v) > 0, F.col(v)).alias(c) for c, v in zip(columns, values)],
    )


def _order_statistics(rows: DataFrame, keys: list[str], values: list[str], probs: Sequence[float]) -> DataFrame:
    """(keys, _c, _i, _q) for every column number and prob; only values near the wanted ranks are sorted."""
    slack = 2.0 / _ACCURACY
    ends = F.array(*[F.lit(min(max(p + d, 0.0), 1.0)) for p in probs for d in (-slack, slack)])
    sketch = rows.groupBy(*keys).agg(
        *[F.count(v).alias(f"_n{v}") for v in values],
        *[F.percentile_approx(v, ends, _ACCURACY).alias(f"_e{v}") for v in values],
    )
    known = small_rows(sketch)
    if known is not None:
        wanted = sum(1 for r in known for v in values if r[f"_n{v}"]) * len(probs)
        found = _pick(rows, keys, values, probs, rows.sparkSession.createDataFrame(known, sketch.schema))
        near = small_rows(found)
        if near is not None and len(near) == wanted:
            return rows.sparkSession.createDataFrame(near, found.schema)
    # Some bracket missed its rank, or there are too many groups to check: take the whole value range.
    whole = rows.groupBy(*keys).agg(
        *[F.count(v).alias(f"_n{v}") for v in values],
        *[F.flatten(F.array_repeat(F.array(F.min(v), F.max(v)), len(probs))).alias(f"_e{v}") for v in values],
    )
    return _pick(rows, keys, values, probs, whole)


def _pick(rows: DataFrame, keys: list[str], values: list[str], probs: Sequence[float], brackets: DataFrame) -> DataFrame:
    marked = attach(rows, brackets, keys)
    slots = [(j, v, i) for j, v in enumerate(values) for i in range(len(probs))]
    inside = {(j, i): F.col(v).between(F.col(f"_e{v}")[2 * i], F.col(f"_e{v}")[2 * i + 1]) for j, v, i in slots}
    below = marked.groupBy(*keys).agg(
        *[F.first(f"_n{v}").alias(f"_n{v}") for v in values],
        F.array(*[F.count_if(F.col(v) < F.col(f"_e{v}")[2 * i]) for _, v, i in slots]).alias("_below"),
    )
    # A row sends each value once, whichever brackets it lies in; equal values are counted first.
    near = {j: functools.reduce(operator.or_, [inside[j, i] for i in range(len(probs))]) for j in range(len(values))}
    hits = F.array(*[F.when(near[j], F.struct(F.lit(j).alias("_c"), F.col(v).alias("_v"))) for j, v in enumerate(values)])
    emitted = marked.filter(functools.reduce(operator.or_, near.values())).select(*keys, F.inline(hits))
    counted = emitted.filter("_c is not null").groupBy(*keys, "_c", "_v").agg(F.count("*").alias("_count"))
    ends = F.array(*[F.col(f"_e{v}") for v in values])[F.col("_c")]
    slot = F.explode(F.sequence(F.lit(0), F.lit(len(probs) - 1))).alias("_i")
    placed = attach(counted, brackets, keys).select(*keys, "_c", "_v", "_count", ends.alias("_ends"), slot)
    kept = placed.filter(F.col("_v").between(F.col("_ends")[2 * F.col("_i")], F.col("_ends")[2 * F.col("_i") + 1]))
    kept = pinned(kept.drop("_ends"))
    upto = running_sums(kept, [*keys, "_c", "_i"], ["_v"], {"_upto": F.col("_count")})
    ranked = attach(upto, below, keys)
    size = F.array(*[F.col(f"_n{v}") for v in values])[F.col("_c")]
    position = (size - 1) * F.array(*map(F.lit, map(float, probs)))[F.col("_i")]
    first, last = F.floor(position), F.ceil(position)
    base = F.col("_below")[F.col("_c") * len(probs) + F.col("_i")]

    def holds(rank):
        return (rank < base + F.col("_upto")) & (rank >= base + F.col("_upto") - F.col("_count"))

    ends = ranked.select(
        *keys, "_c", "_i", "_v", holds(first).alias("_is_lo"), holds(last).alias("_is_hi"), (position - first).alias("_w")
    ).filter("_is_lo or _is_hi")
    both = ends.groupBy(*keys, "_c", "_i").agg(
        F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_is_hi"), F.col("_v"))).alias("_hi"),
        F.max("_w").alias("_w"),
    ).filter("_lo is not null and _hi is not null")
    return both.select(*keys, "_c", "_i", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")).alias("_q"))
