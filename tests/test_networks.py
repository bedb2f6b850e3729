"""Networks: gradients against differences, steps against plain ones, learning, early stopping."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.operators import networks, supervised


@pytest.mark.parametrize("activation", ["relu", "tanh", "logistic"])
@pytest.mark.parametrize("classes", [0, 3])
def test_the_gradient_is_that_of_the_loss(activation, classes):
    draw = np.random.default_rng(1)
    sizes = [4, 5, 3, classes or 1]
    at = networks.first_parameters(networks.Net(activation=activation), sizes)
    x, w = draw.normal(size=(20, 4)), draw.uniform(0.5, 2, 20)
    y = draw.integers(0, 3, 20).astype(float) if classes else draw.normal(size=20)
    found = networks.gradient(at, sizes, activation, classes, x, y, w)
    assert found[-1] == pytest.approx(w.sum())
    for i in draw.choice(len(at), 12, replace=False):
        step = np.zeros(len(at))
        step[i] = 1e-6
        up, down = (networks.gradient(at + s, sizes, activation, classes, x, y, w)[-2] for s in (step, -step))
        assert found[i] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-5)


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(300, 2))
    y = (np.hypot(x[:, 0], x[:, 1]) > 1.1).astype(float)
    made = spark.createDataFrame([(i, y[i].item(), x[i].tolist()) for i in range(300)], "id long, y double, x array<double>")
    return made.cache(), x, y


def test_a_step_over_all_rows_equals_a_plain_one(rows):
    df, x, y = rows
    for solver in ("adam", "sgd"):
        net = networks.Net((4,), "tanh", solver, 0.01)
        found = networks.fit(df.repartition(3), "y", "x", ["id"], [net], 2, epochs=1, batches=1)[0]
        start = networks.first_parameters(net, [2, 4, 2])
        grad = networks.gradient(start, [2, 4, 2], "tanh", 2, x, y, np.ones(300))
        moved = networks._Mover(net, len(start)).move(start, grad[:-2] / 300 + net.l2 * start / 300)
        assert found.parameters == pytest.approx(moved, abs=1e-9)
        assert found.losses == pytest.approx([grad[-2] / 300])


def test_networks_train_together_and_learn_a_circle(rows):
    df, x, y = rows
    nets = [networks.Net((12,), "tanh", "adam", 0.05), networks.Net((12,), "relu", "adam", 0.05)]
    weights = F.array(F.lit(1.0), (F.col("id") % 2).cast("double"))
    found = networks.fit(df, "y", "x", ["id"], nets, 2, weights, epochs=25, batches=2)
    for model in found:
        assert (model.outputs(x).argmax(1) == y).mean() > 0.9
        assert model.losses[-1] < model.losses[0]
    scored = df.select("id", found[0].predict(F.col("x")).alias("p")).collect()
    assert [r.p for r in scored[:20]] == [pytest.approx(found[0].outputs(x[r.id:r.id + 1])[0]) for r in scored[:20]]


def test_early_stopping_ends_training_and_keeps_the_best(rows):
    df, _, _ = rows
    net = networks.Net((3,), "tanh", "sgd", 0.0)  # never moves
    found = networks.fit(df, "y", "x", ["id"], [net], 2, epochs=50, batches=1, early_stopping=True, patience=2)[0]
    assert len(found.losses) == 3
    assert found.parameters == pytest.approx(networks.first_parameters(net, [2, 3, 2]))
    with pytest.raises(ValueError):
        networks.fit(df, "y", "x", ["id"], [networks.Net(activation="other")])


def test_network_tasks(spark, rows):
    df, _, _ = rows
    flat = df.select("id", F.col("y").cast("int").alias("y"), F.col("x")[0].alias("a"), F.col("x")[1].alias("b"), (F.col("x")[0] * 3).alias("z"))
    task = supervised.Task(flat, ["id"], "y", ["a", "b"])
    held = supervised.holdout(task, "mlp", hidden=(12,), solver="adam", activation="tanh", learning_rate=0.05, max_iter=15, batches=1)
    assert held.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.8
    task = supervised.Task(flat, ["id"], "z", ["a", "b"], kind="regression")
    held = supervised.holdout(task, "mlp", hidden=(8,), learning_rate=0.05, max_iter=25, batches=1)
    assert supervised.evaluate(task, held).first()["R2"] > 0.8


def test_no_rows_train_nothing(rows):
    df, _, _ = rows
    assert networks.fit(df.where("false"), "y", "x", ["id"], [networks.Net((2,))], 2)[0].losses == []
