"""Training and evaluation of MLlib models: hold-out, folds, comparison, stability and grid search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.bounds import complete_rows, join_facts, pinned
from ..plans.hashing import row_text
from . import balance, encode, metrics, networks, newton, profile, reshape, split
from .kernels import KernelMap


@dataclass
class Task:
    """What is learnt from which table, and how it is split, scaled and balanced."""

    df: DataFrame
    ids: Sequence[str]
    target: str
    features: Sequence[str]
    kind: str = "classification"
    train_size: float = 0.75
    seed: int = 42
    positive: float = 1.0
    sampling: str | None = None
    class_weight: str | None = None
    scale: bool = True
    classes: DataFrame | None = field(default=None, repr=False)
    _table: DataFrame | None = field(default=None, repr=False)
    _sizes: tuple[int, int] | None = field(default=None, repr=False)

    def table(self) -> DataFrame:
        """(id, label, features...) over rows written once, as every fit reads them.

        Writing comes before filtering: a filter on computed features would compute them twice.
        """
        if self._table is None:
            made = pinned(self.df.select(*dict.fromkeys([*self.ids, self.target, *self.features])))
            rows = complete_rows(made, [self.target, *self.features])
            if self.kind == "classification":
                rows, self.classes = encode.encode_labels(rows, self.target, "_label")
            else:
                rows = rows.withColumn("_label", F.col(self.target).try_cast("double")).filter("_label is not null")
            self._table = rows.select(row_text(self.ids).alias("id"), F.col("_label").alias("label"), *self.features)
        return self._table

    def sizes(self) -> tuple[int, int]:
        """Rows and classes."""
        if self._sizes is None:
            per_label = self.table().groupBy("label").count()
            row = per_label.agg(F.sum("count").alias("n"), F.count("*").alias("k")).first()
            self._sizes = (row["n"] or 0, row["k"] if self.kind == "classification" else 0)
        return self._sizes

    def n_classes(self) -> int:
        return self.sizes()[1]

    def stratify(self) -> str | None:
        return "label" if self.kind == "classification" else None


def tree_depth(wanted: int | None) -> int:
    """No limit (null or negative) means the deepest that MLlib allows; a deeper limit is an error."""
    if wanted is None or wanted < 0:
        return 30
    if wanted > 30:
        raise ValueError(f"max_depth {wanted}: trees have at most 30 levels here; give -1 for no limit")
    return wanted


def build_model(name: str, kind: str, n_rows: int, n_classes: int, n_features: int, **p) -> Estimator:
    """An untrained MLlib estimator; parameter names follow common usage and unset ones keep fixed defaults."""
    seed = p.get("seed", 42)
    depth = tree_depth(p.get("max_depth", 5 if name == "gbt" else 10))
    if kind == "regression":
        if name in ("linear", "ridge"):
            alpha = p.get("alpha", 1.0) if name == "ridge" else 0.0
            return LinearRegression(regParam=alpha / n_rows, elasticNetParam=0.0, standardization=False)
        if name == "random_forest":
            return RandomForestRegressor(
                numTrees=p.get("n_estimators", 100), maxDepth=depth, minInstancesPerNode=p.get("min_samples_leaf", 1), seed=seed
            )
        if name == "gbt":
            return GBTRegressor(maxIter=p.get("n_estimators", 50), maxDepth=depth, stepSize=p.get("learning_rate", 0.1), seed=seed)
        raise ValueError(f"unknown regression model: {name}")
    many = n_classes > 2
    if name == "logistic":
        share = {"l2": 0.0, "l1": 1.0, "elasticnet": p.get("l1_ratio", 0.5)}[p.get("penalty", "l2")]
        return LogisticRegression(
            regParam=1.0 / (p.get("C", 1.0) * n_rows), elasticNetParam=share, standardization=False, maxIter=p.get("max_iter", 100)
        )
    if name == "random_forest":
        return RandomForestClassifier(
            numTrees=p.get("n_estimators", 100), maxDepth=depth, minInstancesPerNode=p.get("min_samples_leaf", 1),
            featureSubsetStrategy=str(p.get("max_features", "sqrt")), seed=seed,
        )
    if name == "gbt":
        one = GBTClassifier(maxIter=p.get("n_estimators", 50), maxDepth=depth, stepSize=p.get("learning_rate", 0.1), seed=seed)
        return OneVsRest(classifier=one) if many else one
    if name == "svm":
        kernel = p.get("kernel", "linear")
        seen = "features" if kernel == "linear" else "mapped"
        one = LinearSVC(regParam=1.0 / (p.get("C", 1.0) * n_rows), maxIter=p.get("max_iter", 100), featuresCol=seen)
        machine = OneVsRest(classifier=one, featuresCol=seen) if many else one
        if kernel == "linear":
            return machine
        shape = {k: p[k] for k in ("gamma", "degree", "offset", "dims") if k in p}
        return Pipeline(stages=[KernelMap(kernel=kernel, seed=seed, **shape), machine])
    if name == "mlp":
        layers = [n_features, *p.get("hidden", (32, 16)), max(n_classes, 2)]
        return MultilayerPerceptronClassifier(layers=layers, maxIter=p.get("max_iter", 100), solver="l-bfgs", seed=seed)
    raise ValueError(f"unknown classification model: {name}")


DEFAULTS = {
    "logistic": {"C": 1.0, "penalty": "l2", "max_iter": 100}, "random_forest": {"n_estimators": 100, "max_depth": 10},
    "gbt": {"n_estimators": 50, "learning_rate": 0.1}, "svm": {"C": 1.0}, "mlp": {"hidden": (32, 16)},
    "linear": {}, "ridge": {"alpha": 1.0},
}


def with_overrides(name: str, overrides: Mapping | None) -> dict:
    return DEFAULTS.get(name, {}) | dict(overrides or {})


def _vectors(df: DataFrame, features: Sequence[str], *kept: str) -> DataFrame:
    return df.select("id", "label", *kept, F.array(*[F.col(c).cast("double") for c in features]).alias("vector"))


def _ready(task: Task, train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scaled by train statistics, train side balanced, both as MLlib vectors."""
    if task.scale:
        scaler = encode.Scaler(task.features).fit(train)
        train, test = scaler.transform(train), scaler.transform(test)
    train, test = _vectors(train, task.features), _vectors(test, task.features)
    if task.kind == "classification":
        if task.sampling:
            train = balance.resample(train, task.sampling, "id", "label", "vector", task.seed)
        if task.class_weight == "balanced":
            train = balance.balanced_weights(train, "label")
        elif task.class_weight == "scale_pos_weight":
            train = balance.positive_weights(train, "label", task.positive)
    if "weight" not in train.columns:
        train = train.withColumn("weight", F.lit(1.0))
    return (
        train.select("id", "label", "weight", array_to_vector("vector").alias("features")),
        test.select("id", "label", array_to_vector("vector").alias("features")),
    )


def weighted(task: Task, name: str, model: Estimator) -> Estimator:
    """The model with the weight column set where the task asks for weights and the model takes them."""
    if isinstance(model, Pipeline):
        return Pipeline(stages=[*model.getStages()[:-1], weighted(task, name, model.getStages()[-1])])
    if task.class_weight is None or not model.hasParam("weightCol") or name == "mlp":
        return model
    return model.copy({model.getParam("weightCol"): "weight"})


def _fit_predict(task: Task, name: str, params: Mapping, train: DataFrame, test: DataFrame) -> DataFrame:
    fitted, shown = _ready(task, train, test)
    if name == "mlp" and (task.kind == "regression" or params.get("solver", "lbfgs") != "lbfgs"):
        return _network(task, params, fitted, shown)
    model = build_model(
        name, task.kind, *task.sizes(), len(task.features), **with_overrides(name, params)
    )
    model = weighted(task, name, model)
    scored = metrics.positive_score(model.fit(fitted).transform(shown))
    # Written once, as every metric reads it.
    return pinned(scored.select("id", "label", "prediction", "score"))


def _network(task: Task, params: Mapping, fitted: DataFrame, shown: DataFrame) -> DataFrame:
    """Predictions of a network trained by mini-batches: any of its activations, Adam or momentum."""
    p = with_overrides("mlp", {"activation": "relu", "solver": "adam", "max_iter": 50} | dict(params))
    net = networks.Net(tuple(p["hidden"]), p["activation"], p["solver"], p.get("learning_rate", 0.001), l2=p.get("l2", 1e-4), seed=p.get("seed", task.seed))
    rows = fitted.select("id", "label", "weight", vector_to_array("features").alias("x"))
    classes = max(task.n_classes(), 2) if task.kind == "classification" else 0
    model = networks.fit(
        rows, "label", "x", ["id"], [net], classes, F.array("weight"), p["max_iter"], p.get("batches", 4), p.get("early_stopping", False))[0]
    scored = shown.select("id", "label", model.predict(vector_to_array("features")).alias("_out"))
    if not classes:
        return pinned(scored.select("id", "label", F.col("_out")[0].alias("prediction"), F.col("_out")[0].alias("score")))
    place = F.array_position("_out", F.array_max("_out")) - 1
    return pinned(scored.select("id", "label", place.cast("double").alias("prediction"), F.col("_out")[1].alias("score")))


def holdout(task: Task, name: str, **params) -> DataFrame:
    """(id, label, prediction, score) of the held-out rows."""
    rows = split.train_test(task.table(), ["id"], task.train_size, task.seed, task.stratify())
    return _fit_predict(task, name, params, rows.filter("is_train"), rows.filter("not is_train"))


def fits_at_once(task: Task, name: str, params: Mapping) -> bool:
    """Whether all folds, seeds or weightings of a model are fitted by `newton` in the same passes: two-class logistic
    regression with a quadratic penalty and no resampling."""
    p = with_overrides(name, params)
    return name == "logistic" and task.kind == "classification" and not task.sampling and p["penalty"] == "l2" and task.n_classes() == 2


def _fit_at_once(task: Task, rows: DataFrame, members: Sequence[Column], weightings: Sequence[str | None], params: Mapping) -> newton.Logistic:
    """One model per membership condition over `rows`, with the class weights of its own training rows."""
    counts = rows.groupBy("label").agg(*[F.count_if(m).alias(f"n{i}") for i, m in enumerate(members)]).collect()  # two rows
    sizes = {r["label"]: r for r in counts}
    weights = []
    for i, (member, weighting) in enumerate(zip(members, weightings)):
        n = {label: max(sizes[label][f"n{i}"], 1) if label in sizes else 1 for label in (0.0, 1.0)}
        factor = {0.0: 1.0, 1.0: 1.0}
        if weighting == "balanced":
            factor = {label: (n[0.0] + n[1.0]) / (2.0 * n[label]) for label in n}
        elif weighting == "scale_pos_weight":
            factor[float(task.positive)] = max(n[1.0 - task.positive] / n[float(task.positive)], 1.0)
        chosen = F.when(F.col("label") == 1.0, F.lit(factor[1.0])).otherwise(F.lit(factor[0.0]))
        weights.append(F.when(member, chosen).otherwise(F.lit(0.0)))
    p = with_overrides("logistic", params)
    return newton.fit(rows, "label", "vector", F.array(*weights), 1.0 / p["C"], task.scale, p["max_iter"])


def _scored(rows: DataFrame, model: newton.Logistic, number: Column, *keys: Column) -> DataFrame:
    """Written once, as every metric reads it."""
    scored = rows.select(*keys, "id", "label", model.score(F.col("vector"), number).alias("score"))
    return pinned(scored.select(*[c for c in scored.columns if c != "score"], (F.col("score") > 0.5).cast("double").alias("prediction"), "score"))


def folded(task: Task, name: str, k: int = 10, **params) -> DataFrame:
    """(fold, id, label, prediction, score) over all folds; scaler, sampler and weights are refitted.

    Folds of a two-class logistic regression are fitted together, in as many passes as one of them takes.
    """
    rows = pinned(split.folds(task.table(), ["id"], k, task.seed, task.stratify()))
    if fits_at_once(task, name, params):
        points = _vectors(rows, task.features, "fold")
        model = _fit_at_once(task, points, [F.col("fold") != i for i in range(k)], [task.class_weight] * k, params)
        return _scored(points, model, F.col("fold"), F.col("fold"))
    made = []
    for i in range(k):
        part = _fit_predict(task, name, params, rows.filter(F.col("fold") != i), rows.filter(F.col("fold") == i))
        made.append(part.select(F.lit(i).alias("fold"), "*"))
    return reshape.stack(made)


def evaluate(task: Task, predictions: DataFrame, by: Sequence[str] = (), extra: Mapping[str, metrics.Metric] | None = None) -> DataFrame:
    """The task's metrics, one row per group; `extra` adds user metrics."""
    if task.kind == "regression":
        table = metrics.regression(predictions, by)
    else:
        counts = metrics.shared_counts(predictions, by)
        table = metrics.accuracy(counts, by, weight="count")
        scored = predictions.schema["score"].dataType.simpleString() == "double" and task.n_classes() <= 2
        table = join_facts(table, metrics.classification(predictions, task.positive, by, score="score" if scored else None, counts=counts), by)
        table = join_facts(table, metrics.macro(counts, by, weight="count"), by)
    return join_facts(table, metrics.evaluate(predictions, extra, by), by) if extra else table


def _criterion(task: Task, wanted: str | None) -> tuple[str, bool]:
    name = wanted or ("F1_Pos" if task.kind == "classification" and task.n_classes() <= 2 else "F1_Macro" if task.kind == "classification" else "RMSE")
    return name, name not in ("MAE", "MSE", "RMSE", "MAPE_pct", "Error")


def compare_models(task: Task, models: Mapping[str, tuple[str, Mapping]], k: int = 0, sort_by: str | None = None) -> DataFrame:
    """One row per model: hold-out metrics, and with k > 1 fold means and deviations as CV_*; best first."""
    held = reshape.stack([
        holdout(task, name, **params).select(F.lit(label).alias("model_name"), "*") for label, (name, params) in models.items()
    ])
    table = evaluate(task, held, ["model_name"])
    if k > 1:
        cv = reshape.stack([
            folded(task, name, k, **params).select(F.lit(label).alias("model_name"), "*")
            for label, (name, params) in models.items()
        ])
        each = evaluate(task, cv, ["model_name", "fold"]).drop("fold")
        names = [c for c in each.columns if c != "model_name"]
        summary = profile.metric_summary(each, ["model_name"], names)
        summary = summary.withColumnsRenamed({c: f"CV_{c}" for c in summary.columns if c != "model_name"})
        table = join_facts(table, summary, ["model_name"], "left")
    metric, higher = _criterion(task, sort_by)
    order = F.desc_nulls_last(metric) if higher else F.asc_nulls_last(metric)
    return table.orderBy(order, "model_name")


def model_detail(task: Task, name: str, **params) -> dict[str, DataFrame]:
    """Metrics, confusion matrix and curves (or the actual/predicted table) of one model."""
    held = holdout(task, name, **params)
    if task.kind == "regression":
        pairs, line = metrics.actual_vs_predicted(held)
        return {"metrics": evaluate(task, held), "pairs": pairs, "line": line}
    out = {"metrics": evaluate(task, held), "confusion": metrics.confusion_matrix(held)}
    if task.n_classes() <= 2:
        out |= {
            "counts": metrics.binary_counts(held, task.positive), "roc": metrics.roc_curve(held, task.positive),
            "pr": metrics.pr_curve(held, task.positive),
        }
    return out


def seed_stability(task: Task, name: str, seeds: Sequence[int], **params) -> tuple[DataFrame, DataFrame]:
    """Metrics per seed, and their mean, deviation and range."""
    task.sizes()  # shared by all seeds
    made = []
    together = fits_at_once(task, name, params)
    if together:
        rows = task.table()
        for i, seed in enumerate(seeds):
            rows = split.train_test(rows, ["id"], task.train_size, seed, task.stratify()).withColumnRenamed("is_train", f"_in{i}")
        flags = [f"_in{i}" for i in range(len(seeds))]
        points = _vectors(pinned(rows), task.features, *flags)
        model = _fit_at_once(task, points, [F.col(c) for c in flags], [task.class_weight] * len(seeds), params)
        held = F.filter(F.sequence(F.lit(0), F.lit(len(seeds) - 1)), lambda i: ~F.get(F.array(*flags), i))
        tested = points.select("id", "label", "vector", F.explode(held).alias("_model"))
        seed = F.get(F.array(*[F.lit(s) for s in seeds]), F.col("_model")).alias("seed")
        made.append(_scored(tested, model, F.col("_model"), seed))
    for seed in [] if together else seeds:
        one = Task(**{**task.__dict__, "seed": seed})
        made.append(holdout(one, name, **{**params, "seed": seed}).select(F.lit(seed).alias("seed"), "*"))
    each = evaluate(task, reshape.stack(made), ["seed"])
    names = [c for c in each.columns if c != "seed"]
    long = reshape.melt(each, ["seed"], names)
    summary = long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"), (F.max("value") - F.min("value")).alias("spread"),
    )
    return each, summary


def balance_comparison(task: Task, name: str, **params) -> tuple[DataFrame, DataFrame]:
    """Metrics and ROC points with plain and with balanced class weights."""
    task.sizes()  # shared by both scenarios
    made, scenarios = [], {"none": None, "balanced": "balanced"}
    together = fits_at_once(task, name, params)
    if together:
        rows = pinned(split.train_test(task.table(), ["id"], task.train_size, task.seed, task.stratify()))
        points = _vectors(rows, task.features, "is_train")
        model = _fit_at_once(task, points, [F.col("is_train")] * 2, list(scenarios.values()), params)
        tested = points.where(~F.col("is_train")).withColumn("_model", F.explode(F.array(F.lit(0), F.lit(1))))
        name_of = F.get(F.array(*map(F.lit, scenarios)), F.col("_model")).alias("scenario")
        made.append(_scored(tested, model, F.col("_model"), name_of))
    for label, weight in [] if together else scenarios.items():
        one = Task(**{**task.__dict__, "class_weight": weight})
        made.append(holdout(one, name, **params).select(F.lit(label).alias("scenario"), "*"))
    held = reshape.stack(made)
    return evaluate(task, held, ["scenario"]), metrics.roc_curve(held, task.positive, ["scenario"])


#: Common names of parameters and the ones MLlib has for them.
GRID_NAMES = {
    "n_estimators": {"random_forest": "numTrees", "gbt": "maxIter"}, "max_depth": "maxDepth", "learning_rate": "stepSize",
    "min_samples_leaf": "minInstancesPerNode", "max_features": "featureSubsetStrategy", "max_iter": "maxIter",
    "l1_ratio": "elasticNetParam", "C": "regParam", "alpha": "regParam",
}


def grid_values(name: str, param: str, values: Sequence, n_rows: int) -> tuple[str, list]:
    """The MLlib name of a grid parameter and its values on MLlib's scale; MLlib's own names pass as they are."""
    known = GRID_NAMES.get(param, param)
    known = known.get(name, param) if isinstance(known, dict) else known
    scale = {"max_depth": tree_depth, "C": lambda v: 1.0 / (v * n_rows), "alpha": lambda v: v / n_rows, "max_features": str}
    return known, [scale.get(param, lambda v: v)(v) for v in values]


def grid_search(task: Task, name: str, grid: Mapping[str, Sequence], k: int = 5, parallelism: int = 4, **params):
    """Every combination of MLlib parameters by k folds on the train side; the best is refitted.

    Returns the (combination, score) table, the hold-out predictions of the best and its parameters.
    """
    rows = split.train_test(task.table(), ["id"], task.train_size, task.seed, task.stratify())
    train, test = _ready(task, rows.filter("is_train"), rows.filter("not is_train"))
    train = pinned(split.folds(train, ["id"], k, task.seed, task.stratify()))
    classes = task.n_classes()
    model = build_model(name, task.kind, train.count(), classes, len(task.features), **with_overrides(name, params))
    model = weighted(task, name, model)
    # One-vs-rest has its parameters on the classifier inside.
    inner = model.getClassifier() if isinstance(model, OneVsRest) else model
    builder = ParamGridBuilder()
    for p, values in grid.items():
        param, given = grid_values(name, p, values, train.count())
        builder = builder.addGrid(inner.getParam(param), given)
    maps = builder.build()
    if task.kind == "regression":
        judge = RegressionEvaluator(metricName="mse")
    elif classes <= 2:
        judge = MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=float(task.positive))
    else:
        judge = MulticlassClassificationEvaluator(metricName="f1")
    search = CrossValidator(
        estimator=model, estimatorParamMaps=maps, evaluator=judge, numFolds=k, foldCol="fold", parallelism=parallelism
    ).fit(train)
    tried = [{p.name: v for p, v in m.items()} for m in maps]
    sign = 1.0 if judge.isLargerBetter() else -1.0
    table = task.df.sparkSession.createDataFrame(
        [(str(t), float(sign * s)) for t, s in zip(tried, search.avgMetrics)], "params string, score double"
    )
    pick = max if judge.isLargerBetter() else min
    best = tried[search.avgMetrics.index(pick(search.avgMetrics))]
    held = metrics.positive_score(search.bestModel.transform(test)).select("id", "label", "prediction", "score")
    return table, held, best


# The five networks that are compared, their hidden layers, activations and solvers. MLlib trains the one
# with L-BFGS (its layers are sigmoid), the others train by mini-batches.
NETWORKS = {"NN_01": (16,), "NN_02": (64, 32, 16), "NN_03": (128, 64), "NN_04": (32, 16), "NN_05": (48, 24, 12)}


SOLVERS = {
    "NN_01": ("relu", "adam"), "NN_02": ("relu", "adam"), "NN_03": ("tanh", "adam"), "NN_04": ("logistic", "lbfgs"), "NN_05": ("tanh", "sgd"),
}


def compare_networks(task: Task, k: int = 0, shapes: Mapping[str, Sequence[int]] = NETWORKS, max_iter: int = 100) -> DataFrame:
    models = {}
    for name, hidden in shapes.items():
        activation, solver = SOLVERS.get(name, ("logistic", "lbfgs"))
        models[name] = ("mlp", {"hidden": tuple(hidden), "max_iter": max_iter, "activation": activation, "solver": solver})
    return compare_models(task, models, k, "Accuracy")


def architecture(hidden: Sequence[int], n_features: int, n_classes: int) -> list[int]:
    return [n_features, *hidden, max(n_classes, 2)]
