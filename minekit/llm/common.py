"""What the operators share: written intermediates, small Arrow batches and ASCII lower case."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.bounds import shared_dir, small_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_written: list[str] = []


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write `df` as Parquet under the shared folder and read it back: lineage ends there, and a
    lost executor costs no earlier stage. Later jobs read only the columns they need."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/minekit-llm-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that no later job reads, in whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def forget(df: DataFrame) -> None:
    """Remove what `stored` wrote for a DataFrame that no later job reads."""
    path = vars(df)["_stored_at"]
    _written.remove(path)
    remove(df.sparkSession, path)


@contextmanager
def intermediates_removed(spark: SparkSession) -> Iterator[None]:
    """Remove what `stored` wrote inside the block, which must have run all jobs that read it."""
    before = len(_written)
    try:
        yield
    finally:
        while len(_written) > before:
            remove(spark, _written.pop())


def in_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
    start: Callable[[], object] | None = None,
) -> DataFrame:
    """Apply `function` to small Arrow batches of `df`; it also gets what `start` made once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start() if start else None
        drop_held(state)
        for batch in batches:
            for part in _slices(batch):
                yield function(part, state) if start else function(part)
            del batch
        pa.default_memory_pool().release_unused()  # the worker stays, next to those of later stages

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def in_worker(name: str, make: Callable[[], object]) -> object:
    """What `make` made when a Python worker of Spark first asked for `name`; later tasks of that worker find it
    again. A worker holds one such object, so what an earlier operator remembered is dropped."""
    import pyspark

    held = vars(pyspark).setdefault("_minekit_held", {})
    if name not in held:
        held.clear()
        held[name] = make()
    return held[name]


def drop_held(but: object = None) -> None:
    """Forget what `in_worker` keeps for another operator, as a worker outlives the stage that asked for it."""
    import pyspark

    held = vars(pyspark).get("_minekit_held", {})
    if not any(kept is but for kept in held.values()):
        held.clear()


def _slices(batch: pa.RecordBatch, most: int = 2048) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, most):
        yield batch.slice(at, most)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def text_hash(text: Column) -> Column:
    """Tells texts apart that share a document id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
