"""Result sinks."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..plans.bounds import cached


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """One file per partition, headed, UTF-8."""
    df.write.mode("errorifexists").csv(path, header=True, sep=sep, encoding="UTF-8", escape='"')


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").json(path)


def write_document(spark: SparkSession, document: Mapping, path: str) -> None:
    """A small pretty JSON document as a one-row text file."""
    text = json.dumps(document, indent=2, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(path)


def write_bundle(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], facts: Mapping) -> dict:
    """Write each table and a manifest that names them all with their row counts.

    Rows are counted from the cache that writing fills.  An Observation would do it in one pass, but
    in Spark 4.1 it leaves a session with which MLlib's binary classifiers cannot be sent to tasks.
    """
    counts, files = {}, {}
    for name, df in tables.items():
        with cached(df) as rows:
            write_csv(rows, f"{folder}/{name}")
            counts[name], files[name] = rows.count(), name
    manifest = dict(facts) | {"row_counts": counts, "files": files}
    write_document(spark, manifest, f"{folder}/manifest.json")
    return manifest
