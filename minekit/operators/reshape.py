"""Joins, unions, and moves between wide and long tables."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.bounds import attach, require, same_keys
from .clean import numeric_names


def carry_columns(df: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Bring columns of the source table to derived rows by row identity."""
    return df.join(source.select(key, *columns), key)


def calendar(df: DataFrame, date: str, by: Sequence[str] = (), step: str = "1 day") -> DataFrame:
    """Every date between the first and last of each series."""
    ends = df.groupBy(*by).agg(F.min(F.to_date(date)).alias("_a"), F.max(F.to_date(date)).alias("_b"))
    days = F.explode(F.expr(f"sequence(_a, _b, interval {step})"))
    return ends.filter("_a is not null").select(*by, days.alias(date))


def missing_dates(df: DataFrame, date: str, by: Sequence[str] = (), step: str = "1 day") -> DataFrame:
    seen = df.select(*by, F.to_date(date).alias(date)).distinct()
    """Dates of the calendar that a series lacks; a null key is a series like any other."""
    keys = [*by, date]
    renamed = seen.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    every = calendar(df, date, by, step)
    return every.join(renamed, same_keys(every, renamed, keys, "_k_"), "left_anti")


def map_labels(df: DataFrame, column: str, labels: Mapping, out: str) -> DataFrame:
    """A display label per value; values without one show themselves."""
    text = F.col(column).cast("string")
    if not labels:
        return df.withColumn(out, text)
    pairs = F.create_map(*[F.lit(str(x)) for pair in labels.items() for x in pair])
    return df.withColumn(out, F.coalesce(F.try_element_at(pairs, text), text))


def compare_metrics(holdout: DataFrame, cv: DataFrame) -> DataFrame:
    """(metric, holdout, cv): each side's (metric, value) rows, kept when the other has none."""
    left = holdout.select("metric", F.col("value").alias("holdout"))
    return left.join(cv.select("metric", F.col("value").alias("cv")), "metric", "full")


def word_flags(df: DataFrame, text: Column, words: Sequence[str], prefix: str = "kw_") -> DataFrame:
    """A 0/1 column per word that stands in the text as a whole word.

    The text is cut into words once, whatever the number of words looked for.
    """
    tokens = df.withColumn("_tokens", F.array_distinct(F.split(text, r"[^\p{L}\p{N}_]+")))
    return tokens.withColumns({f"{prefix}{w}": F.array_contains("_tokens", w).cast("int") for w in words}).drop("_tokens")


def upsert_rows(base: DataFrame, new: DataFrame, key: str, sort_by: str | None = None) -> DataFrame:
    """Rows of `new` replace rows of `base` with the same key."""
    merged = base.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)
    return merged.orderBy(F.col(sort_by).try_cast("double").desc_nulls_last(), key) if sort_by else merged


def stack_distinct(tables: Sequence[DataFrame]) -> DataFrame:
    return stack(tables).distinct()


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables; a column one of them lacks is null there."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def history_and_forecast(history: DataFrame, forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One chart table with `actual` and `forecast` columns."""
    past = history.select(*keys, F.col("value").alias("actual"))
    return stack([past, forecast.select(*keys, F.col("value").alias("forecast"))])


def date_difference(left: DataFrame, right: DataFrame, date: str) -> DataFrame:
    """Dates of `left` that `right` does not have."""
    return left.select(F.to_date(date).alias(date)).subtract(right.select(F.to_date(date).alias(date)))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] = (), name: str = "metric") -> DataFrame:
    names = list(values) or [c for c in numeric_names(df) if c not in ids]
    same = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in names])
    return same.unpivot(list(ids), names, name, "value")


def metrics_to_rows(df: DataFrame) -> DataFrame:
    """Scalar metric columns of a one-row table as (metric, value); others are skipped."""
    return melt(df, [])


def basket_matrix(pairs: DataFrame, tx: str, item: str, items: Sequence[str]) -> DataFrame:
    """A 0/1 column per listed item; the long form is what mining uses, this is for display."""
    require(pairs, tx, item)
    wide = pairs.select(tx, item).distinct().groupBy(tx).pivot(item, list(items)).agg(F.lit(1))
    return wide.na.fill(0, subset=list(items))


def explode_tokens(df: DataFrame, text: Column, pattern: str, ids: Sequence[str] = ()) -> DataFrame:
    return df.select(*ids, F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("token"))


def sort_by(df: DataFrame, column: str, ascending: bool = True, ties: Sequence[str] = (), numeric: bool = False) -> DataFrame:
    """Nulls last in either direction; `numeric` sorts text by the number it holds."""
    require(df, column, *ties)
    c = F.col(column).try_cast("double") if numeric else F.col(column)
    return df.orderBy(c.asc_nulls_last() if ascending else c.desc_nulls_last(), *ties)


def tail(df: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows by `order`, in order."""
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)


def best_metric(df: DataFrame, priority: Sequence[str]) -> str | None:
    """The first metric of the list that has any value."""
    names = [c for c in priority if c in df.columns]
    if not names:
        return None
    filled = df.agg(*[F.count(F.col(c).try_cast("double")).alias(c) for c in names]).first()
    return next((c for c in names if filled[c]), None)


def pick_best(df: DataFrame, name: str, metric: str, higher: bool = True) -> DataFrame:
    """One row: the best name by a metric, ties by name."""
    rows = df.filter(F.col(metric).isNotNull())
    order = F.desc(metric) if higher else F.asc(metric)
    return rows.orderBy(order, name).limit(1).select(name, metric)


def attach_facts(df: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return attach(df, facts, keys, how="left")
