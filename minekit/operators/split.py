"""Train/test splits and folds that give the same rows in every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..plans.bounds import attach
from ..plans.hashing import slice_by_rank
from ..plans.ordering import row_numbers

def train_test(
    df: DataFrame, ids: Sequence[str], train_size: float = 0.75, seed: int = 42, stratify: str | None = None
) -> DataFrame:
    """Add `is_train`; with `stratify` every class keeps its share on both sides."""
    by = [stratify] if stratify else []
    out = slice_by_rank(df, ids, seed, by, lambda n: [F.round(n * train_size)], "_slice")
    return out.withColumn("is_train", F.col("_slice") == 0).drop("_slice")


def folds(df: DataFrame, ids: Sequence[str], k: int = 10, seed: int = 42, stratify: str | None = None) -> DataFrame:
    """Add `fold` (0..k-1); fold sizes differ by at most one, within every class if stratified."""
    by = [stratify] if stratify else []
    return slice_by_rank(df, ids, seed, by, lambda n: [F.ceil(n * j / k) for j in range(1, k)], "fold")


def _tie_order(df: DataFrame, time: str, by: Sequence[str], ties: Sequence[str] | None) -> list[str]:
    """Time, then what tells rows of one time apart: the given columns, or all others that can be sorted."""
    if ties is not None:
        return [time, *ties]
    flat = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return [time, *(c for c in flat if c != time and c not in by)]


def time_positions(df: DataFrame, time: str, by: Sequence[str] = (), ties: Sequence[str] | None = None) -> DataFrame:
    """Add the 1-based position along time and the length of the series."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("_size"))
    return attach(row_numbers(df, by, _tie_order(df, time, by, ties), "_pos"), sizes, by)


def time_split(
    df: DataFrame, time: str, by: Sequence[str] = (), test_size: int | None = None, train_size: float = 0.75,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Add `is_train`; the last rows of each series (a quarter unless a count is given) are the test.

    Rows of equal time are ordered by `ties` (by default by their other columns), so a count is met exactly.
    A series with fewer than two rows, or no more rows than the test takes, cannot be split: its rows get a
    null. Where there is one series only that is an error.
    """
    if test_size is not None and test_size < 1:
        raise ValueError("the test needs at least one row")
    # Halves round to even, the rule behind the sizes users know.
    held = F.lit(test_size) if test_size else F.greatest(F.lit(1), F.bround(F.col("_size") * (1 - train_size)))
    if not by:
        n = df.count()
        if n < 2 or (test_size is not None and test_size >= n):
            raise ValueError("the series needs at least two rows and a test size below its length")
    placed = time_positions(df, time, by, ties)
    fits = (F.col("_size") >= 2) & (held < F.col("_size"))
    return placed.withColumn("is_train", F.when(fits, F.col("_pos") <= F.col("_size") - held)).drop("_pos", "_size")


def series_split(df: DataFrame, time: str, value: str, by: Sequence[str] = (), **sizes) -> DataFrame:
    """As `time_split`, on the numeric, non-null values of a raw series."""
    clean = df.select(*by, time, F.col(value).try_cast("double").alias(value)).filter(F.col(value).isNotNull())
    return time_split(clean, time, by, **sizes)


def expanding_folds(
    df: DataFrame, time: str, by: Sequence[str] = (), k: int = 5, test_size: int | None = None, gap: int = 0
) -> DataFrame:
    """One row per (row, fold, role): fold i tests the i-th of the last k blocks, trains on all before.

    Rows are repeated because a row trains every later fold.
    """
    placed = time_positions(df, time, by)
    size = F.lit(test_size) if test_size else F.floor(F.col("_size") / (k + 1))
    start = F.col("_size") - (F.lit(k) - F.col("fold")) * size
    at = F.col("_pos") - 1
    role = F.when((at >= start) & (at < start + size), "test").when(at < start - gap, "train")
    out = placed.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn("role", role)
    return out.filter("role is not null").drop("_pos", "_size")


def backtest_size(n: int, lags: int, k: int, wanted: int) -> int:
    """The test block length for a back-test; too short a series is an error."""
    if n <= lags + max(5, k):
        raise ValueError(f"{n} rows are too few for {lags} lags and {k} folds")
    return max(1, min(wanted, (n - lags) // (k + 1)))
