"""Trees and logistic regressions that are fitted for many groups or training sets at once."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.operators import newton, supervised, timeseries, trees


def jobs_of(spark, action):
    """How many jobs an action starts."""
    name = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(name, name)
    action()
    spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def plain_tree(points, bins, depth, min_leaf):
    """A tree over (bins of features, target); returns a function of bins."""
    def grow(rows, left):
        n, s = len(rows), math.fsum(t for _, t in rows)
        best = None
        for f in range(len(rows[0][0])):
            for b in sorted({r[0][f] for r in rows}):
                low = [t for x, t in rows if x[f] <= b]
                if left and len(low) >= min_leaf and n - len(low) >= max(min_leaf, 1):
                    sl = math.fsum(low)
                    raw = sl * sl / len(low) + (s - sl) ** 2 / (n - len(low)) - s * s / n
                    if round(raw, 6) > 0 and (best is None or round(raw, 6) > best[0]):
                        best = (round(raw, 6), f, b)
        if best is None:
            return lambda x: s / n
        _, f, b = best
        low, high = grow([r for r in rows if r[0][f] <= b], left - 1), grow([r for r in rows if r[0][f] > b], left - 1)
        return lambda x: low(x) if x[f] <= b else high(x)

    return grow(points, depth)


def plain_bins(xs, rows, bins):
    low, high = [min(c) for c in zip(*rows)], [max(c) for c in zip(*rows)]
    return tuple(min(bins - 1, max(0, math.floor((x - a) / (b - a) * bins))) if b > a else 0 for x, a, b in zip(xs, low, high))


@pytest.fixture(scope="module")
def groups(spark):
    draw = random.Random(5)
    rows = []
    for g in ("a", "b", None):
        for i in range(120):
            x1, x2 = draw.uniform(0, 10), draw.uniform(-1, 1)
            rows.append((g, i, x1, x2, 3.0, (5.0 if x1 > 4 else 0.0) + (x2 if g == "a" else -2 * x2) + draw.gauss(0, 0.1)))
    rows += [("one", 0, 1.0, 1.0, 1.0, 7.0), ("gone", 0, None, 1.0, 1.0, 7.0)]
    return spark.createDataFrame(rows, "g string, i long, x1 double, x2 double, flat double, y double").cache()


@pytest.mark.parametrize("kind", ["tree", "boosted"])
def test_trees_equal_plain(groups, kind):
    xs, bins, depth, rounds = ["x1", "x2", "flat"], 16, 3, 3
    models = trees.fit(groups, "y", xs, ["g"], kind, depth, bins, min_leaf=4, rounds=rounds, rate=0.5)
    found = {(r.g, r.i): r.prediction for r in trees.predict(groups, models, xs, ["g"], depth, bins).collect()}
    held = [r for r in groups.collect()]
    for g in ("a", "b", None, "one"):
        rows = [r for r in held if r.g == g]
        features = [(r.x1, r.x2, r.flat) for r in rows]
        at = [plain_bins(x, features, bins) for x in features]
        f = [sum(r.y for r in rows) / len(rows) if kind == "boosted" else 0.0] * len(rows)
        for _ in range(rounds if kind == "boosted" else 1):
            tree = plain_tree([(b, r.y - v) for b, r, v in zip(at, rows, f)], bins, depth, 4)
            f = [v + (0.5 if kind == "boosted" else 1.0) * tree(b) for v, b in zip(f, at)]
        for r, want in zip(rows, f):
            assert found[g, r.i] == pytest.approx(want, abs=1e-6)
    assert found["gone", 0] is None


def test_a_forest_is_repeatable_and_near_the_truth(groups):
    xs = ["x1", "x2"]

    def run(df):
        models = trees.fit(df, "y", xs, ["g"], "forest", 3, 16, rounds=15, key=["g", "i"])
        return {(r.g, r.i): r.prediction for r in trees.predict(df, models, xs, ["g"], 3, 16).collect()}

    found, again = run(groups), run(groups.repartition(3, "i"))
    assert all(a == pytest.approx(again[k]) for k, a in found.items() if a is not None)
    errors = [(found[r.g, r.i] - r.y) ** 2 for r in groups.collect() if r.g in ("a", "b")]
    assert sum(errors) / len(errors) < 0.6  # the labels' variance is above 6
    with pytest.raises(ValueError):
        trees.fit(groups, "y", xs, ["g"], "forest")


def test_the_number_of_series_does_not_set_the_number_of_jobs(spark):
    def fit(series):
        rows = spark.range(series * 40).select((F.col("id") % series).alias("g"), F.col("id").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
        return jobs_of(spark, lambda: trees.fit(rows, "y", ["x"], ["g"], depth=2).count())

    assert fit(2) == fit(60)


def test_trees_of_nothing(groups):
    none = groups.where("false")
    models = trees.fit(none, "y", ["x1"], ["g"])
    assert models.count() == 0
    assert {r.prediction for r in trees.predict(groups, models, ["x1"], ["g"]).collect()} == {None}


def test_tree_forecasts_follow_a_step_pattern(spark):
    rows = [(s, f"2024-01-{d:02d}", float(10 * (d % 3 == 0) + (s == "b"))) for s in ("a", "b") for d in range(1, 31)] + [("short", "2024-01-01", 1.0)]
    df = spark.createDataFrame(rows, "s string, day string, v double").withColumn("day", F.to_date("day"))
    found = timeseries.lag_tree_forecast(df, "day", "v", 3, 6, ["s"], depth=2, bins=8).collect()
    values = {(r.s, r.day.day): r.forecast for r in found}
    assert all(values["short", d] is None for d in range(2, 8))
    for r in found:
        if r.s != "short":  # 31 January follows a multiple of three
            assert r.forecast == pytest.approx(10.0 * ((r.step + 30) % 3 == 0) + (r.s == "b"))
    tested = timeseries.lag_tree_holdout(df, "day", "v", 3, ["s"], 5, depth=2, bins=8).collect()
    assert len(tested) == 10 and all(r.prediction == pytest.approx(r.label) for r in tested)
    folds = timeseries.lag_tree_backtest(df, "day", "v", 3, ["s"], 3, 4, depth=2, bins=8).collect()
    assert {r.s for r in folds} == {"a", "b"} and all(v == pytest.approx(0.0, abs=1e-9) for r in folds for c, v in r.asDict().items() if c.startswith('RMSE') and v is not None)


# ---------------------------------------------------------------- logistic regressions


@pytest.fixture(scope="module")
def labelled(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 3)) * [1, 10, 0.1] + [0, 50, 2]
    y = (x[:, 0] + (x[:, 1] - 50) / 10 + draw.normal(size=400) > 0.5).astype(float)
    rows = [(i, i % 5, y[i].item(), x[i].tolist()) for i in range(400)]
    return spark.createDataFrame(rows, "id long, fold int, y double, x array<double>").cache(), x, y


def plain_newton(x, y, w, l2):
    use = w > 0
    middle, spread = x[use].mean(0), x[use].std(0)
    z = np.column_stack(((x - middle) / spread, np.ones(len(x))))
    beta, penalty = np.zeros(z.shape[1]), np.append(np.full(x.shape[1], l2), 0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ beta))
        h = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        beta -= np.linalg.solve(h, z.T @ (w * (p - y)) + penalty * beta)
    return beta[:-1] / spread, beta[-1] - (beta[:-1] / spread * middle).sum()


def test_every_fold_is_the_fit_of_its_own_rows(labelled):
    df, x, y = labelled
    sets = F.array(*[(F.col("fold") != i).cast("double") for i in range(5)])
    model = newton.fit(df, "y", "x", sets, l2=2.0)
    for i in range(5):
        want, offset = plain_newton(x, y, (np.arange(400) % 5 != i).astype(float), 2.0)
        assert model.coefficients[i] == pytest.approx(want, rel=1e-6)
        assert model.intercepts[i] == pytest.approx(offset, rel=1e-6)
    scored = df.select("id", model.score(F.col("x"), F.col("fold")).alias("p")).collect()
    for r in scored[:50]:
        eta = x[r.id] @ model.coefficients[r.id % 5] + model.intercepts[r.id % 5]
        assert r.p == pytest.approx(1 / (1 + math.exp(-eta)))


def test_a_set_without_rows_and_a_separable_one_are_fitted(labelled):
    df, _, _ = labelled
    model = newton.fit(df, "y", "x", F.array(F.lit(0.0), F.lit(1.0)), l2=1e-6)
    assert np.isfinite(model.coefficients).all() and np.isfinite(model.intercepts).all()
    apart = df.withColumn("x", F.array(F.col("y") * 2 - 1))
    assert newton.fit(apart, "y", "x", F.array(F.lit(1.0)), l2=0.01).coefficients[0][0] > 2
    assert len(newton.fit(df.where("false"), "y", "x", F.array(F.lit(1.0))).intercepts) == 0


def test_the_number_of_folds_does_not_set_the_number_of_jobs(spark, labelled):
    df, _, _ = labelled
    rows = df.select("id", "y", *[F.col("x")[i].alias(f"x{i}") for i in range(3)])
    counts = []
    for k in (3, 9):
        task = supervised.Task(rows, ["id"], "y", ["x0", "x1", "x2"], class_weight="balanced")
        counts.append(jobs_of(spark, lambda: supervised.folded(task, "logistic", k).count()))
    # The number of Newton steps may differ by one.
    assert abs(counts[0] - counts[1]) <= 4


def test_seeds_together_equal_seeds_apart(labelled):
    df, _, _ = labelled
    rows = df.select("id", "y", *[F.col("x")[i].alias(f"x{i}") for i in range(3)])
    task = supervised.Task(rows, ["id"], "y", ["x0", "x1", "x2"])
    each, summary = supervised.seed_stability(task, "logistic", [1, 2, 3])
    got = {r.seed: r.Accuracy for r in each.collect()}
    for seed in (1, 2, 3):
        one = supervised.Task(rows, ["id"], "y", ["x0", "x1", "x2"], seed=seed)
        assert got[seed] == pytest.approx(supervised.evaluate(one, supervised.holdout(one, "logistic")).first().Accuracy, abs=0.02)
    assert summary.where("metric = 'Accuracy'").count() == 1
    scenarios = {r.scenario for r in supervised.balance_comparison(task, "logistic")[0].collect()}
    assert scenarios == {"none", "balanced"}
