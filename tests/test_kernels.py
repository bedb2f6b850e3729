"""Kernel maps: products near the kernel, rings told apart, saved and loaded in a pipeline."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from minekit.operators import kernels, supervised


@pytest.fixture(scope="module")
def rings(spark):
    angle, ring = F.radians(F.col("id") * 7 % 360), F.col("id") % 2
    radius = 1 + 3 * ring + (F.col("id") % 10) / 40
    return spark.range(400).select("id", ring.cast("int").alias("ring"), (radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y")).cache()


@pytest.mark.parametrize("kernel", ["rbf", "poly"])
def test_products_approach_the_kernel(kernel):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(60, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kernel == "rbf":
        want = np.exp(-0.7 * ((x[:, None] - x[None, :]) ** 2).sum(2))
    else:
        want = (0.7 * x @ x.T + 1.0) ** 2
    errors = []
    for dims in (256, 8192):
        z = kernels.KernelMap(kernel=kernel, gamma=0.7, degree=2, dims=dims).mapped(x)
        errors.append(np.abs(z @ z.T - want).max() / want.max())
    assert errors[1] < 0.06 and errors[1] < errors[0]
    with pytest.raises(ValueError):
        kernels.KernelMap(kernel="other").mapped(x)


@pytest.mark.parametrize("params", [{"kernel": "rbf", "gamma": 0.5, "dims": 128}, {"kernel": "poly", "degree": 2, "dims": 64}])
def test_rings_are_told_apart_by_kernels_only(rings, params):
    task = supervised.Task(rings, ["id"], "ring", ["x", "y"])
    right = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    assert supervised.holdout(task, "svm", max_iter=8).agg(right).first()[0] < 0.75
    assert supervised.holdout(task, "svm", max_iter=30, **params).agg(right).first()[0] == 1.0


def test_three_classes_and_weights(rings):
    three = rings.withColumn("ring", F.when(F.col("x") > 3, 2).otherwise(F.col("ring")))
    task = supervised.Task(three, ["id"], "ring", ["x", "y"], class_weight="balanced")
    found = supervised.holdout(task, "svm", kernel="rbf", gamma=0.5, dims=64, max_iter=8)
    assert found.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.9


def test_a_pipeline_with_a_map_is_saved_and_loaded(spark, rings, tmp_path):
    vectors = rings.select("id", F.col("ring").cast("double").alias("label"), array_to_vector(F.array("x", "y")).alias("features"))
    model = Pipeline(stages=[kernels.KernelMap(gamma=0.5, dims=64), LinearSVC(featuresCol="mapped", maxIter=5)]).fit(vectors)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    first, second = ([r.prediction for r in m.transform(vectors).orderBy("id").collect()] for m in (model, again))
    assert first == second
    nothing = vectors.withColumn("features", F.when(F.col("id") < 0, F.col("features")))
    assert kernels.KernelMap().transform(nothing).where("mapped is not null").count() == 0
