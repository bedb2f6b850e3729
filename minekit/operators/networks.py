"""Feed-forward networks trained by data-parallel mini-batches.

Rows belong to batches by a hash of their identity. A step is one pass over a batch: tasks work out the gradients of
their own rows, only their sums are shuffled, and the driver, which holds the parameters, moves them by Adam or by
momentum. Several networks may train in the same passes, so jobs grow with epochs and batches only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.bounds import pinned
from .newton import _summed


@dataclass(frozen=True)
class Net:
    """The shape of a network and how it is trained; names follow common usage."""

    hidden: Sequence[int] = (32, 16)
    activation: str = "relu"
    solver: str = "adam"
    rate: float = 0.001
    momentum: float = 0.9
    l2: float = 1e-4
    seed: int = 42


_ACTIVATIONS = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "tanh": (np.tanh, lambda a: 1 - a**2),
    "logistic": (lambda z: 1 / (1 + np.exp(-np.clip(z, -700, 700))), lambda a: a * (1 - a)),
}


@dataclass
class Trained:
    """Parameters as one vector, the sizes of the layers, and the loss of each epoch's last look."""

    net: Net
    sizes: list[int]
    parameters: np.ndarray
    classes: int
    losses: list[float] = field(default_factory=list)

    def outputs(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities, or the value of a regression."""
        out = forward(self.parameters, self.sizes, self.net.activation, x)[-1]
        return softmax(out) if self.classes else out

    def predict(self, features: Column) -> Column:
        """`outputs` for a column of arrays of doubles."""
        outputs = self.outputs

        @F.pandas_udf("array<double>")
        def run(rows: pd.Series) -> pd.Series:
            return pd.Series(list(outputs(np.stack(rows.to_numpy())))) if len(rows) else pd.Series([], dtype=object)

        return run(features)


def first_parameters(net: Net, sizes: Sequence[int]) -> np.ndarray:
    """Weights drawn evenly within a bound that keeps the size of signals, and biases alike."""
    draw, parts = np.random.default_rng(net.seed), []
    for a, b in zip(sizes, sizes[1:]):
        bound = np.sqrt((2.0 if net.activation == "logistic" else 6.0) / (a + b))
        parts += [draw.uniform(-bound, bound, a * b), draw.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def _layers(parameters: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    at, out = 0, []
    for a, b in zip(sizes, sizes[1:]):
        out.append((parameters[at:at + a * b].reshape(a, b), parameters[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def forward(parameters: np.ndarray, sizes: Sequence[int], activation: str, x: np.ndarray) -> list[np.ndarray]:
    """The values of every layer, the input first; the last one is linear."""
    values, layers = [x], _layers(parameters, sizes)
    for i, (w, b) in enumerate(layers):
        z = values[-1] @ w + b
        values.append(z if i == len(layers) - 1 else _ACTIVATIONS[activation][0](z))
    return values


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradient(parameters: np.ndarray, sizes: Sequence[int], activation: str, classes: int, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Summed gradient over rows of weight `w`, then their summed loss and weight: log loss for classes (labels from 0),
    half the squared error for a regression (`classes` 0)."""
    values = forward(parameters, sizes, activation, x)
    if classes:
        p = softmax(values[-1])
        label = y.astype(int)
        loss = -(w * np.log(np.maximum(p[np.arange(len(y)), label], 1e-300))).sum()
        delta = p
        delta[np.arange(len(y)), label] -= 1
    else:
        delta = values[-1] - y[:, None]
        loss = 0.5 * (w * delta[:, 0] ** 2).sum()
    delta = delta * w[:, None]
    parts = []
    for (weight, _), before in zip(reversed(_layers(parameters, sizes)), reversed(values[:-1])):
        parts[:0] = [(before.T @ delta).ravel(), delta.sum(0)]
        delta = (delta @ weight.T) * _ACTIVATIONS[activation][1](before)
    return np.concatenate([*parts, [loss, w.sum()]])


class _Mover:
    """Moves parameters along mean gradients by Adam or by Nesterov's momentum."""

    def __init__(self, net: Net, size: int):
        self.net, self.step = net, 0
        self.first, self.second = np.zeros(size), np.zeros(size)

    def move(self, parameters: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.step += 1
        if self.net.solver == "sgd":
            self.first = self.net.momentum * self.first - self.net.rate * grad
            return parameters + self.net.momentum * self.first - self.net.rate * grad
        self.first = 0.9 * self.first + 0.1 * grad
        self.second = 0.999 * self.second + 0.001 * grad**2
        rate = self.net.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        return parameters - rate * self.first / (np.sqrt(self.second) + 1e-8)


def fit(
    df: DataFrame, y: str, features: str, key: Sequence[str], nets: Sequence[Net], classes: int = 0, weights: Column | None = None,
    epochs: int = 50, batches: int = 4, early_stopping: bool = False, validation: float = 0.1, patience: int = 10, tolerance: float = 1e-4,
) -> list[Trained]:
    """Train `nets` together on arrays of doubles; `classes` 0 means a regression.

    `weights` may give each network its own row weights (an array; 0 leaves a row out). A row's batch, and whether it
    only validates, follow from a hash of `key`. With `early_stopping` a network keeps the parameters of its least
    validation loss and training ends when no network has improved by `tolerance` for `patience` epochs. Without rows
    the networks keep their first parameters' shape with a width of no features.
    """
    for net in nets:
        if net.activation not in _ACTIVATIONS or net.solver not in ("adam", "sgd"):
            raise ValueError(f"unknown activation or solver: {net.activation}, {net.solver}")
    each = weights if weights is not None else F.array(*[F.lit(1.0) for _ in nets])
    mark = F.pmod(F.xxhash64(*key), F.lit(1_000_003))
    rows = pinned(df.select(
        F.transform(F.col(features), lambda v: v.cast("double")).alias("x"), F.col(y).cast("double").alias("y"),
        F.transform(each, lambda v: v.cast("double")).alias("w"), (mark % batches).cast("int").alias("batch"),
        (F.floor(mark / batches) % 1000 < int(1000 * validation)).alias("held")))
    first = rows.select(F.size("x").alias("d")).first()
    width, out = first["d"] if first else 0, classes or 1
    made = []
    for net in nets:
        sizes = [width, *net.hidden, out]
        made.append(Trained(net, sizes, first_parameters(net, sizes), classes))
    if first is None:
        return made
    movers = [_Mover(t.net, len(t.parameters)) for t in made]
    longest = max(len(t.parameters) for t in made) + 2
    training = rows.where(~F.col("held")) if early_stopping else rows
    best = [(np.inf, t.parameters) for t in made]
    idle = 0
    for _ in range(epochs):
        seen = np.zeros((len(made), 2))
        for b in range(batches):
            sums = _summed(training.where(F.col("batch") == b), _gradients(made, longest), longest)
            for t, mover, row, total in zip(made, movers, sums, seen):
                size, weight = len(t.parameters), row[len(t.parameters) + 1]
                total += row[size:size + 2]
                if weight > 0:
                    t.parameters = mover.move(t.parameters, row[:size] / weight + t.net.l2 * t.parameters / weight)
        if early_stopping:
            seen = np.array([row[len(t.parameters):len(t.parameters) + 2] for t, row in zip(made, _summed(rows.where("held"), _gradients(made, longest), longest))])
        losses = [float(loss / n) if n > 0 else 0.0 for loss, n in seen] if len(seen) else [0.0] * len(made)
        better = False
        for i, (t, loss) in enumerate(zip(made, losses)):
            t.losses.append(loss)
            better |= loss < best[i][0] - tolerance
            if loss < best[i][0]:
                best[i] = (loss, t.parameters)
        idle = 0 if better else idle + 1
        if early_stopping and idle >= patience:
            break
    if early_stopping:
        for t, (_, parameters) in zip(made, best):
            t.parameters = parameters
    return made


def _gradients(made: Sequence[Trained], longest: int):
    held = [(t.parameters, t.sizes, t.net.activation, t.classes) for t in made]

    def sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.zeros((len(held), longest))
        for j, (parameters, sizes, activation, classes) in enumerate(held):
            use = w[:, j] != 0
            out[j, :len(parameters) + 2] = gradient(parameters, sizes, activation, classes, x[use], y[use], w[use, j])
        return out

    return sums
