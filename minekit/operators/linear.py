"""Least squares for many groups at once: sums of products are aggregated, small systems are solved."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.bounds import attach, complete_rows


def fit(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (), alpha: float = 0.0) -> DataFrame:
    """(by, coefficients, intercept, n) per group; `alpha` > 0 is ridge on standardised features.

    Only means and co-moments leave a task, so the size of a group does not matter.
    """
    xs, width = list(xs), len(xs)
    rows = df.select(*by, F.col(y).cast("double").alias("_y"), *[F.col(x).cast("double").alias(f"_x{i}") for i, x in enumerate(xs)])
    names = [f"_x{i}" for i in range(width)]
    rows = complete_rows(rows, ["_y", *names])
    pairs = {(i, j): F.covar_pop(names[i], names[j]) for i in range(width) for j in range(i, width)}
    facts = rows.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("_y").alias("_my"),
        F.array(*[F.avg(x) for x in names]).alias("_mx"),
        F.array(*[F.covar_pop(x, "_y") for x in names]).alias("_cy"),
        F.array(*[pairs[min(i, j), max(i, j)] for i in range(width) for j in range(width)]).alias("_cx"),
    ).filter("n > 0")

    @F.pandas_udf("array<double>")
    def solve(cx: pd.Series, cy: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for flat, right, size in zip(cx, cy, n):
            matrix, right = np.array(flat, dtype=float).reshape(width, width), np.array(right, dtype=float)
            spread = np.sqrt(np.diag(matrix))
            spread[spread == 0] = 1.0
            scaled = matrix / np.outer(spread, spread) + alpha / size * np.eye(width)
            out.append((np.linalg.lstsq(scaled, right / spread, rcond=1e-10)[0] / spread).tolist())
        return pd.Series(out)

    solved = facts.withColumn("coefficients", solve("_cx", "_cy", "n"))
    shift = sum((F.col("coefficients")[i] * F.col("_mx")[i] for i in range(width)), F.lit(0.0))
    return solved.select(*by, "coefficients", (F.col("_my") - shift).alias("intercept"), "n")


def linear_value(xs: Sequence[Column]) -> Column:
    """intercept + coefficients . xs, for rows that carry the model columns."""
    return sum((F.col("coefficients")[i] * x for i, x in enumerate(xs)), F.col("intercept"))


def predict(df: DataFrame, models: DataFrame, xs: Sequence[str], by: Sequence[str] = (), out: str = "prediction") -> DataFrame:
    """Add the prediction; rows of a group without a model get a null."""
    carried = attach(df, models.select(*by, "coefficients", "intercept"), by, "left")
    return carried.withColumn(out, linear_value([F.col(x) for x in xs])).drop("coefficients", "intercept")
