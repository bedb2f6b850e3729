"""Delimited, JSON and bundle scans."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

SEPARATORS = {"comma": ",", "semicolon": ";", "tab": "\t", "pipe": "|", "space": " "}


def _index_free(df: DataFrame) -> DataFrame:
    """Drop an exported index: a first column without a name of its own."""
    first = df.columns[0].strip()
    if first in ("", "_c0") or first.lower().startswith("unnamed:"):
        return df.drop(df.columns[0])
    return df


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def read_delimited(spark: SparkSession, path: str, sep: str, schema: StructType | None = None) -> DataFrame:
    """Headed text with the given separator; types are inferred only when no schema is given."""
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(_index_free(reader.csv(path)))


def read_csv(spark: SparkSession, path: str, mode: int = 1, schema: StructType | None = None) -> DataFrame:
    """Mode 1 reads commas, mode 2 semicolons."""
    if mode not in (1, 2):
        raise ValueError("mode must be 1 (comma) or 2 (semicolon)")
    return read_delimited(spark, path, "," if mode == 1 else ";", schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).limit(0).collect()
        return True
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def read_csv_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_csv(spark, path, schema=schema) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_json(spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest of a bundle with the folder it lies in."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    return json.loads(text) | {"base_dir": path.rsplit("/", 1)[0]}


def read_bundle(spark: SparkSession, manifest_path: str) -> dict[str, DataFrame]:
    """Open every table a manifest names."""
    manifest = read_manifest(spark, manifest_path)
    return {n: read_csv(spark, f"{manifest['base_dir']}/{p}") for n, p in manifest["files"].items()}


def header(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types; no data is read."""
    return df.dtypes


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
