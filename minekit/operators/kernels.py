"""Kernel feature maps as MLlib transformers: a linear solver on mapped vectors is a kernel machine.

The products of mapped vectors approach the kernel's values as `dims` grows, with an error of the order of one over its
root. Maps are functions of the seed and the width of the vectors, so nothing is fitted and nothing is sent but them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F


def rbf_map(x: np.ndarray, gamma: float, dims: int, seed: int) -> np.ndarray:
    """Random cosines whose products approach exp(-gamma |x - y|^2)."""
    draw = np.random.default_rng(seed)
    directions = draw.normal(scale=np.sqrt(2 * gamma), size=(x.shape[1], dims))
    phases = draw.uniform(0, 2 * np.pi, dims)
    return np.sqrt(2 / dims) * np.cos(x @ directions + phases)


def polynomial_map(x: np.ndarray, gamma: float, degree: int, offset: float, dims: int, seed: int) -> np.ndarray:
    """Sketches of tensor powers whose products approach (gamma x.y + offset)^degree: the sketch of a product of vectors
    is the convolution of their sketches."""
    draw = np.random.default_rng(seed)
    wide = np.hstack((x * np.sqrt(gamma), np.full((len(x), 1), np.sqrt(offset))))
    product = None
    for _ in range(degree):
        place, sign = draw.integers(0, dims, wide.shape[1]), draw.choice([-1.0, 1.0], wide.shape[1])
        sketch = np.zeros((wide.shape[1], dims))
        sketch[np.arange(wide.shape[1]), place] = sign
        spectrum = np.fft.rfft(wide @ sketch, axis=1)
        product = spectrum if product is None else product * spectrum
    return np.fft.irfft(product, n=dims, axis=1)


class KernelMap(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Maps a vector column so that products of mapped vectors approach a kernel: `rbf` or `poly`.

    `gamma` 0 means one over the width of the vectors, which suits scaled features. Null vectors stay null.
    """

    kernel = Param(Params._dummy(), "kernel", "rbf or poly", TypeConverters.toString)
    gamma = Param(Params._dummy(), "gamma", "scale of the kernel; 0 for one over the width", TypeConverters.toFloat)
    degree = Param(Params._dummy(), "degree", "power of the polynomial kernel", TypeConverters.toInt)
    offset = Param(Params._dummy(), "offset", "constant of the polynomial kernel", TypeConverters.toFloat)
    dims = Param(Params._dummy(), "dims", "width of the mapped vectors", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="mapped", kernel="rbf", gamma=0.0, degree=3, offset=1.0, dims=512, seed=42):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="mapped", kernel="rbf", gamma=0.0, degree=3, offset=1.0, dims=512, seed=42)
        self._set(**self._input_kwargs)

    def mapped(self, x: np.ndarray) -> np.ndarray:
        kernel, dims, seed = (self.getOrDefault(p) for p in (self.kernel, self.dims, self.seed))
        gamma = self.getOrDefault(self.gamma) or 1.0 / max(x.shape[1], 1)
        if kernel == "rbf":
            return rbf_map(x, gamma, dims, seed)
        if kernel == "poly":
            return polynomial_map(x, gamma, self.getOrDefault(self.degree), self.getOrDefault(self.offset), dims, seed)
        raise ValueError(f"unknown kernel: {kernel}")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        mapped = self.mapped

        @F.pandas_udf("array<double>")
        def run(vectors: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(vectors), dtype=object)
            known = [i for i, v in enumerate(vectors) if v is not None]
            # Rows of one width are mapped together; a table has one width.
            if known:
                found = mapped(np.stack([vectors.iloc[i] for i in known]))
                for i, row in zip(known, found):
                    out.iloc[i] = row
            return out

        given = F.col(self.getInputCol())
        values = run(F.when(given.isNotNull(), vector_to_array(given)))
        return dataset.withColumn(self.getOutputCol(), F.when(given.isNotNull(), array_to_vector(values)))
