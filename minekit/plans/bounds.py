"""Size checks: what may be broadcast, what one task may hold, and where lineage is cut."""

from __future__ import annotations

import functools
import operator
import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

BROADCAST_ROWS = "spark.minekit.maxBroadcastRows"
GROUP_ROWS = "spark.minekit.maxGroupRows"
_DEFAULTS = {BROADCAST_ROWS: 100_000, GROUP_ROWS: 1_000_000}

#: Spark fills Arrow batches up to this many bytes while Python operators are planned, unless the session sets a limit
#: of its own: a batch is held several times by a task, next to those of its neighbours.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def limit_of(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(name, str(_DEFAULTS[name])))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach; a temporary one is made only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="minekit-")
    sc.setCheckpointDir(made)
    return made


def pinned(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder, so later reads see one and the same result."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep `df` while a function reads it several times; lost blocks are recomputed by Spark."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def small_rows(df: DataFrame, bound: int | None = None) -> list[Row] | None:
    """The rows of `df` if there are at most `bound` of them, else None."""
    bound = bound or limit_of(df.sparkSession, BROADCAST_ROWS)
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality between `keys` of `left` and the prefixed keys of `right`."""
    pairs = [left[k].eqNullSafe(right[prefix + k]) for k in keys]
    return functools.reduce(operator.and_, pairs, F.lit(True))


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-group facts to `df` on `keys` (null keys match).

    The facts are broadcast only when counting showed that they fit the bound; otherwise
    Spark chooses the join and splits skewed partitions at run time.
    """
    rows = small_rows(small)
    if rows is not None:
        small = df.sparkSession.createDataFrame(rows, small.schema)
    facts = small.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in small.columns if c not in keys]
    )
    if rows is not None:
        facts = F.broadcast(facts)
    joined = df.join(facts, same_keys(df, facts, keys, "_k_"), how)
    return joined.drop(*[f"_k_{k}" for k in keys])


def join_facts(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables that hold one row per group; with one row per key there is no skew to guard."""
    keys = list(keys)
    if not keys:
        return left.withColumn("_one", F.lit(1)).join(right.withColumn("_one", F.lit(1)), "_one", how).drop("_one")
    renamed = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return left.join(renamed, same_keys(left, renamed, keys, "_k_"), how).drop(*[f"_k_{k}" for k in keys])


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    if not keys:
        return df.count()
    top = df.groupBy(*keys).count().agg(F.max("count").alias("n")).first()
    return top["n"] or 0


def has_large_group(df: DataFrame, keys: Sequence[str]) -> bool:
    return largest_group(df, keys) > limit_of(df.sparkSession, GROUP_ROWS)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every column is present (NaN counts as missing).

    One condition per column: a single test over many columns makes the optimizer derive a
    variant of it for every alias below.
    """
    types = dict(df.dtypes)
    present = [
        F.col(c).isNotNull() & ~F.isnan(F.col(c)) if types[c] in ("double", "float") else F.col(c).isNotNull()
        for c in columns
    ]
    return df.filter(functools.reduce(operator.and_, present)) if present else df


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
