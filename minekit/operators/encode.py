"""Encoding, scaling and bucketing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..plans.bounds import attach, require, small_rows
from ..plans.ordering import row_numbers
from ..plans.quantiles import quantiles
from .clean import numeric_names, text_names

MAX_DUMMIES = 5_000


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values of each column, found in one pass."""
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    rows = small_rows(df.select(F.inline(pairs)).filter("v is not null").distinct(), MAX_DUMMIES)
    if rows is None:
        raise ValueError(f"more than {MAX_DUMMIES} categories; use one_hot_vector, which adds one column")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        found[r["c"]].append(r["v"])
    return {c: sorted(v) for c, v in found.items()}


def one_hot(df: DataFrame, columns: Sequence[str] | None = None, drop_first: bool = True) -> DataFrame:
    """Replace text columns by 0/1 columns `column_value` in value order; null gives all zeros."""
    names = text_names(df) if columns is None else list(columns)
    require(df, *names)
    levels = categories(df, names)
    dummies = [
        F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c in names for v in levels[c][1 if drop_first else 0 :]
    ]
    booleans = [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    kept = [F.col(c).cast("int").alias(c) if c in booleans else F.col(c) for c in df.columns if c not in names]
    return df.select(*kept, *dummies)


def one_hot_vector(df: DataFrame, columns: Sequence[str], drop_first: bool = True) -> DataFrame:
    """The same coding as one sparse vector column `column_vector` per text column, for many categories."""
    names = list(columns)
    full = [f"{c}_all" if drop_first else f"{c}_vector" for c in names]
    # Nulls get an index behind all categories, and that last slot is the one the encoder drops.
    index = StringIndexer(
        inputCols=names, outputCols=[f"{c}_index" for c in names], stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(df)
    code = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=full, dropLast=True)
    coded = index.transform(df)
    out = code.fit(coded).transform(coded).drop(*index.getOutputCols())
    if not drop_first:
        return out
    for c, labels in zip(names, index.labelsArray):
        if len(labels) > 1:
            out = VectorSlicer(inputCol=f"{c}_all", outputCol=f"{c}_vector", indices=list(range(1, len(labels)))).transform(out)
        else:
            out = out.withColumn(f"{c}_vector", array_to_vector(F.array().cast("array<double>")))
    return out.drop(*full)


def dedup_and_encode(df: DataFrame, dummies: bool = True, drop_first: bool = True) -> DataFrame:
    out = df.distinct()
    return one_hot(out, drop_first=drop_first) if dummies else out


class Scaler:
    """Centre and scale by the mean and population deviation of the rows it was fitted on."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.facts: dict[str, tuple[float, float]] = {}

    def fit(self, df: DataFrame) -> Scaler:
        row = df.agg(
            *[F.avg(c).alias(f"{c}__m") for c in self.columns],
            *[F.stddev_pop(c).alias(f"{c}__s") for c in self.columns],
        ).first()
        self.facts = {c: (row[f"{c}__m"] or 0.0, row[f"{c}__s"] or 1.0) for c in self.columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.facts.items()})


def standardize(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    names = list(columns) or numeric_names(df)
    return Scaler(names).fit(df).transform(df)


def encode_labels(df: DataFrame, column: str, out: str = "label") -> tuple[DataFrame, DataFrame]:
    """Codes by sorted class, and the (value, code) table.

    Text becomes 0..k-1; numbers with exactly two values other than 0 and 1 become 0 and 1;
    other numbers stay as they are.
    """
    require(df, column)
    values = df.select(column).na.drop().distinct()
    is_text = isinstance(df.schema[column].dataType, (T.StringType, T.BooleanType))
    if not is_text:
        few = small_rows(values, 2)
        found = None if few is None else sorted(float(r[0]) for r in few)
        if found is None or len(found) != 2 or found == [0.0, 1.0]:
            same = F.col(column).cast("double")
            return df.withColumn(out, same), values.select(F.col(column).alias("value"), same.alias("code"))
    codes = row_numbers(values, [], [column], "_n").select(column, (F.col("_n") - 1).cast("double").alias(out))
    coded = attach(df.drop(out) if out != column else df, codes, [column], how="left")
    return coded, codes.select(F.col(column).alias("value"), F.col(out).alias("code"))


def positive_label(df: DataFrame, label: str, wanted=None):
    """The wanted class if it occurs, else the larger of two classes, else None."""
    values = df.select(label).na.drop()
    if wanted is not None:
        c = F.col(label)
        same = c.cast("string") == str(wanted)
        if isinstance(wanted, (int, float)):
            same = same | (c.try_cast("double") == float(wanted))
        found = values.filter(same).limit(1).collect()
        if found:
            return found[0][0]
    classes = small_rows(values.distinct(), 2)
    return max(r[0] for r in classes) if classes is not None and len(classes) == 2 else None


def cut_at(c: Column, edges: Sequence[float], labels: Sequence[str], missing: str | None = None) -> Column:
    """Label of the right-closed interval that holds the value."""
    out = F.when(c.isNull(), F.lit(missing))
    for edge, label in zip(edges, labels):
        out = out.when(c <= edge, label)
    return out.otherwise(labels[-1])


def quantile_segments(
    df: DataFrame, column: str, probs: Sequence[float] = (0.33, 0.66),
    labels: Sequence[str] = ("Budget", "MidRange", "Premium"), out: str = "price_segment",
) -> tuple[DataFrame, list[float]]:
    """Cut a column at its own quantiles; also returns the cut points."""
    edges = quantiles(df, [column], probs).first()[column]
    return df.withColumn(out, cut_at(F.col(column), edges, labels)), list(edges)


def scale_to_unit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column divided by its largest absolute value."""
    row = df.agg(*[F.max(F.abs(c)).alias(c) for c in columns]).first()
    return df.withColumns({c: F.col(c) / (F.lit(float(row[c] or 0.0)) + 1e-9) for c in columns})


def date_like_columns(df: DataFrame, sample_size: int = 20, threshold: float = 0.7) -> list[str]:
    """Date columns, and text columns whose first values mostly parse as dates."""
    names = [f.name for f in df.schema if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    for c in text_names(df):
        first = df.select(c).filter(F.col(c).isNotNull()).limit(sample_size)
        share = first.agg(F.avg(F.col(c).try_cast("timestamp_ntz").isNotNull().cast("int")).alias("p")).first()["p"]
        if share is not None and share >= threshold:
            names.append(c)
    return [c for c in df.columns if c in names]
