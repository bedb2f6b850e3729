"""Logistic regressions on many training sets of one table, fitted together by Newton's method.

A training set (a fold's complement, a seed's train side, a weighting) is a column of row weights. One pass over the
table gives gradient, Hessian and loss of every set: tasks add up their own rows, and only these sums are shuffled. So
the number of jobs is that of the iterations, however many sets there are. The driver holds a set's parameters and its
square matrix, nothing that grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


@dataclass
class Logistic:
    """Coefficients (one row per training set) on the features' own scale, intercepts, and what the fit took."""

    coefficients: np.ndarray
    intercepts: np.ndarray
    losses: np.ndarray
    iterations: int

    def score(self, features: Column, model: Column) -> Column:
        """The probability of label 1 by the model of that number, for an array of features."""
        weights = F.array(*[F.array(*[F.lit(float(c)) for c in row]) for row in self.coefficients])
        offsets = F.array(*[F.lit(float(b)) for b in self.intercepts])
        products = F.zip_with(features, F.get(weights, model), lambda x, c: x * c)
        eta = F.get(offsets, model) + F.aggregate(products, F.lit(0.0), lambda a, x: a + x)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


def _summed(df: DataFrame, function, size: int) -> np.ndarray:
    """Sums over all rows of what `function(x, y, w)` gives (an array of shape (models, size)); rows without weight in
    any model add nothing. A task gives one row per model, and a model's rows, one per task, are added by one task."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = (np.asarray(batch.column(c).flatten()).reshape(batch.num_rows, -1) for c in ("x", "w"))
            found = function(x, batch.column("y").to_numpy(), w)
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["model", "sums"])

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [key[0]], "sums": [np.sum(np.stack(rows["sums"]), axis=0)]})

    schema = "model int, sums array<double>"
    rows = df.mapInArrow(part, schema).groupBy("model").applyInPandas(add, schema).collect()
    return np.array([r["sums"] for r in sorted(rows, key=lambda r: r["model"])]).reshape(-1, size)


def fit(
    df: DataFrame, y: str, features: str, weights: Column, l2: float = 1.0, scale: bool = True, iterations: int = 25,
    tolerance: float = 1e-8,
) -> Logistic:
    """One model per element of `weights`, an array of row weights (0 leaves the row out of that model).

    `features` is an array of doubles and `y` is 0 or 1. Minimised is the weighted log loss plus l2 / 2 times the squared
    coefficients, which count after scaling by the model's own training mean and deviation (`scale`). A step that
    raises a model's loss is halved. With `tolerance` 0 there are exactly `iterations` steps. A table without rows
    gives no model.
    """
    rows = df.select(F.transform(F.col(features), lambda v: v.cast("double")).alias("x"), F.col(y).cast("double").alias("y"),
                     F.transform(weights, lambda v: v.cast("double")).alias("w"))
    first = rows.select(F.size("x").alias("d"), F.size("w").alias("m")).first()
    if first is None:
        return Logistic(np.empty((0, 0)), np.empty(0), np.empty(0), 0)
    d, m = first["d"], first["m"]
    middle, spread = _scales(rows, d, m) if scale else (np.zeros((m, d)), np.ones((m, d)))

    beta, last = np.zeros((m, d + 1)), np.zeros((m, d + 1))
    best = np.full(m, np.inf)
    penalty = np.append(np.full(d, float(l2)), 0.0)
    width = d + 1
    done = 0
    for done in range(1, iterations + 1):
        sums = _summed(rows, _derivatives(beta, middle, spread), width * width + width + 1)
        loss = sums[:, -1] + 0.5 * (penalty * beta**2).sum(1)
        moved = 0.0
        for j in range(m):
            if loss[j] > best[j] + 1e-9 * (1 + abs(best[j])):
                beta[j] = (beta[j] + last[j]) / 2
                moved = max(moved, float(np.abs(beta[j] - last[j]).max()))
                continue
            gradient = sums[j, width * width:-1] + penalty * beta[j]
            hessian = sums[j, :width * width].reshape(width, width) + np.diag(penalty)
            step = np.linalg.lstsq(hessian, gradient, rcond=1e-12)[0]
            best[j], last[j] = loss[j], beta[j]
            beta[j] = beta[j] - step
            moved = max(moved, float(np.abs(step).max()))
        if moved <= tolerance:
            break
    coefficients = beta[:, :-1] / spread
    return Logistic(coefficients, beta[:, -1] - (coefficients * middle).sum(1), best, done)


def _derivatives(beta: np.ndarray, middle: np.ndarray, spread: np.ndarray):
    """Per model: Hessian, gradient and loss of the rows given, as one row of numbers."""

    def sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = []
        for j in range(len(beta)):
            use = w[:, j] != 0
            z = np.column_stack(((x[use] - middle[j]) / spread[j], np.ones(int(use.sum()))))
            eta, weight, label = z @ beta[j], w[use, j], y[use]
            p = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
            curve = weight * p * (1 - p)
            loss = (weight * (np.logaddexp(0.0, eta) - label * eta)).sum()
            out.append(np.concatenate((((z * curve[:, None]).T @ z).ravel(), z.T @ (weight * (p - label)), [loss])))
        return np.array(out)

    return sums


def _scales(rows: DataFrame, d: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted means and population deviations of every model's training rows; a constant feature is not scaled."""
    means = rows.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)]).first()
    middle = np.array(means, dtype=float)

    def sums(x: np.ndarray, _: np.ndarray, w: np.ndarray) -> np.ndarray:
        near = x - middle
        return np.hstack((w.sum(0)[:, None], w.T @ near, w.T @ near**2))

    found = _summed(rows, sums, 2 * d + 1)
    n = np.maximum(found[:, :1], 1e-300)
    shift = found[:, 1:d + 1] / n
    variance = found[:, d + 1:] / n - shift**2
    spread = np.sqrt(np.maximum(variance, 0.0))
    spread[variance <= 1e-12 * (found[:, d + 1:] / n) + 1e-300] = 1.0
    return middle + shift, spread
