"""Repeatable pseudo-random order: every row gets a key from its identity and a seed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .bounds import attach, has_large_group
from .ordering import row_numbers


def row_text(ids: Sequence[str]) -> Column:
    """Text that is as unique as the values of `ids`: one column as it stands, several with their lengths."""
    texts = [F.col(c).cast("string") for c in ids]
    if len(texts) == 1:
        return F.coalesce(texts[0], F.lit(""))
    sized = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]
    return F.concat(*sized) if sized else F.lit("")


def shuffle_key(ids: Sequence[str], seed: int) -> Column:
    """A sort key that looks random, is the same in every run, and is unique when `ids` is."""
    text = row_text(ids)
    return F.concat_ws("-", F.md5(F.concat_ws("-", text, F.lit(seed).cast("string"))), text)


def uniform_long(text: Column) -> Column:
    """A non-negative long spread evenly over 60 bits."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def uniform_double(text: Column) -> Column:
    """A double in [0, 1) with 52 random bits."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def slice_by_rank(
    df: DataFrame,
    ids: Sequence[str],
    seed: int,
    by: Sequence[str],
    bounds: Callable[[Column], list[Column]],
    name: str,
) -> DataFrame:
    """Number the slices that rank bounds cut out of each group's pseudo-random order.

    `bounds` turns the group size into increasing ranks r1 < r2 < ...; rows ranked up to r1 get
    slice 0, up to r2 slice 1, and so on; rows that share their ids stay together.  Large groups are not sorted: counting digest prefixes
    finds the few rows next to each bound, and every row is then compared with the bound keys.
    """
    by = list(by)
    keyed = df.withColumn("_key", shuffle_key(ids, seed))
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n"))
    if not has_large_group(df, by):
        ranked = keyed.withColumn("_rank", F.rank().over(Window.partitionBy(*by).orderBy("_key")))
        ranked = attach(ranked, sizes, by)
        passed = [F.when(F.col("_rank") > b, 1).otherwise(0) for b in bounds(F.col("_n"))]
        return ranked.select(*df.columns, sum(passed, F.lit(0)).cast("int").alias(name))

    prefixes = keyed.groupBy(*by, F.substring("_key", 1, 3).alias("_prefix")).agg(F.count("*").alias("_c"))
    upto = Window.partitionBy(*by).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    counted = attach(prefixes.withColumn("_upto", F.sum("_c").over(upto)), sizes, by)
    wanted = counted.select(
        *by,
        "_prefix",
        (F.col("_upto") - F.col("_c")).alias("_before"),
        "_upto",
        F.posexplode(F.array(*[b.cast("long") for b in bounds(F.col("_n"))])).alias("_slice", "_bound"),
    ).filter("_bound > _before and _bound <= _upto")
    near = attach(
        keyed.select(*by, "_key", F.substring("_key", 1, 3).alias("_prefix")),
        wanted.select(*by, "_prefix").distinct(),
        [*by, "_prefix"],
    )
    near = row_numbers(near, [*by, "_prefix"], ["_key"], "_rank")
    hits = attach(near, wanted.groupBy(*by, "_prefix").agg(
        F.collect_list(F.struct("_slice", (F.col("_bound") - F.col("_before")).alias("_at"))).alias("_want")
    ), [*by, "_prefix"])
    hits = hits.filter("exists(_want, w -> w._at = _rank)")
    cuts = hits.groupBy(*by).agg(F.collect_list(F.struct("_key", F.size("_want").alias("_w"))).alias("_cuts"))
    # A bound of zero rows lies before every row, so it has no cut key of its own.
    empty = sum((F.when(b <= 0, 1).otherwise(0) for b in bounds(F.col("_n"))), F.lit(0))
    facts = attach(sizes.select(*by, empty.alias("_empty")), cuts, by, how="left")
    out = attach(keyed, facts, by)
    passed = F.expr("_empty + aggregate(coalesce(_cuts, array()), 0, (a, c) -> a + if(_key > c._key, c._w, 0))")
    return out.select(*df.columns, passed.cast("int").alias(name))
