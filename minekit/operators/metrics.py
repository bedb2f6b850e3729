"""Evaluation of (label, prediction[, score]) rows, for many models or folds at once via `by`."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.bounds import attach, join_facts, small_rows
from ..plans.ordering import running_sums


def _classes(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """The distinct classes on either side, as column `_class`."""
    both = F.explode(F.array(F.col(label), F.col(prediction)))
    return df.select(both.alias("_class")).filter("_class is not null").distinct()


def confusion_counts(
    df: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction", weight: str | None = None
) -> DataFrame:
    """Rows per (real, predicted) pair.

    The result can be given to the metrics below with `weight="count"`, so that several of them
    share one pass over the predictions.
    """
    total = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(*by, label, prediction).agg(total.alias("count"))


def shared_counts(df: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction") -> DataFrame:
    """Confusion counts, held by the driver when they are few."""
    counts = confusion_counts(df, by, label, prediction)
    rows = small_rows(counts)
    return counts if rows is None else df.sparkSession.createDataFrame(rows, counts.schema)


def _weight(weight: str | None) -> Column:
    return F.lit(1) if weight is None else F.col(weight)


def _sum_if(condition: Column, weight: str | None) -> Column:
    return F.sum(F.when(condition, _weight(weight)).otherwise(0))


def confusion_matrix(df: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction") -> DataFrame:
    """Every (real, predicted) pair of classes with its count, zero cells included."""
    seen = shared_counts(df, by, label, prediction)
    listed = _classes(seen, label, prediction).agg(F.collect_list("_class").alias("_all"))  # one row
    groups = seen.groupBy(*by).agg(F.sum("count").alias("_n")).crossJoin(F.broadcast(listed))
    cells = groups.withColumn(label, F.explode("_all")).withColumn(prediction, F.explode("_all")).drop("_n", "_all")
    keys = [*by, label, prediction]
    return join_facts(cells, seen, keys, how="left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))


def accuracy(
    df: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction", weight: str | None = None
) -> DataFrame:
    same = _sum_if(F.col(label) == F.col(prediction), weight)
    row = df.groupBy(*by).agg(F.try_divide(same, F.sum(_weight(weight))).alias("Accuracy"))
    return row.withColumn("Error", 1 - F.col("Accuracy"))


def binary_counts(
    df: DataFrame, positive, by: Sequence[str] = (), label="label", prediction="prediction", weight: str | None = None
) -> DataFrame:
    """TP, FP, FN, TN, each also as a percentage, with specificity and error rate."""
    real, said = F.col(label) == positive, F.col(prediction) == positive
    row = df.groupBy(*by).agg(
        _sum_if(real & said, weight).alias("TP"), _sum_if(~real & said, weight).alias("FP"),
        _sum_if(real & ~said, weight).alias("FN"), _sum_if(~real & ~said, weight).alias("TN"),
        F.sum(_weight(weight)).alias("n"),
    )
    shares = {f"{c}_pct": F.try_divide(F.col(c) * 100.0, F.col("n")) for c in ("TP", "FP", "FN", "TN")}
    return row.withColumns(shares).withColumns({
        "Specificity": F.coalesce(F.try_divide(F.col("TN"), F.col("TN") + F.col("FP")), F.lit(0.0)),
        "ErrorRate": F.try_divide(F.col("FP") + F.col("FN"), F.col("n")),
    })


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def classification(
    df: DataFrame, positive=1, by: Sequence[str] = (), label="label", prediction="prediction", score: str | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Recall, precision, F1 (and ROC-AUC with a score) of the positive class; null beyond two classes."""
    counts = shared_counts(df, by, label, prediction) if counts is None else counts
    row = binary_counts(counts, positive, by, label, prediction, "count")
    binary = small_rows(_classes(counts, label, prediction), 2) is not None
    recall = _ratio(F.col("TP"), F.col("TP") + F.col("FN"))
    precision = _ratio(F.col("TP"), F.col("TP") + F.col("FP"))
    f1 = _ratio(F.col("TP") * 2, F.col("TP") * 2 + F.col("FP") + F.col("FN"))
    keep = F.lit(binary)
    out = row.select(
        *by, F.when(keep, recall).alias("Recall_Pos"), F.when(keep, precision).alias("Precision_Pos"),
        F.when(keep, f1).alias("F1_Pos"),
    )
    if score is None or not binary:
        return out.withColumn("ROC_AUC_Pos", F.lit(None).cast("double"))
    return join_facts(out, roc_auc(df, positive, by, label, score), by, how="left").withColumnRenamed("auc", "ROC_AUC_Pos")


def macro(
    df: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction", weight: str | None = None
) -> DataFrame:
    """Unweighted class means of precision, recall and F1; an undefined ratio counts as 0."""
    counts = confusion_counts(df, by, label, prediction, weight)
    hit = F.when(F.col(label) == F.col(prediction), F.col("count")).otherwise(0)
    sides = counts.select(*by, F.inline(F.array(
        F.struct(F.col(label).alias("_class"), F.col("count").alias("_real"), F.lit(0).cast("long").alias("_said"), hit.cast("long").alias("_hit")),
        F.struct(F.col(prediction).alias("_class"), F.lit(0).cast("long").alias("_real"), F.col("count").alias("_said"), F.lit(0).cast("long").alias("_hit")),
    )))
    per_class = sides.groupBy(*by, "_class").agg(*[F.sum(c).alias(c) for c in ("_real", "_said", "_hit")])
    return per_class.groupBy(*by).agg(
        F.avg(_ratio(F.col("_hit"), F.col("_said"))).alias("Precision_Macro"),
        F.avg(_ratio(F.col("_hit"), F.col("_real"))).alias("Recall_Macro"),
        F.avg(_ratio(F.col("_hit") * 2, F.col("_real") + F.col("_said"))).alias("F1_Macro"),
    )


def _score_steps(df: DataFrame, positive, by, label, score) -> DataFrame:
    """Counts per distinct score with running totals from the highest score down."""
    real = F.col(label) == positive
    steps = df.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(real).alias("_pos"), F.count_if(~real).alias("_neg")
    )
    totals = steps.groupBy(*by).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    run = running_sums(steps, by, [F.desc("threshold")], {"tp": F.col("_pos"), "fp": F.col("_neg")})
    return attach(run, totals, by)


def roc_auc(df: DataFrame, positive=1, by: Sequence[str] = (), label="label", score="score") -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    steps = _score_steps(df, positive, by, label, score)
    # Positives above each negative, plus half of those with the same score.
    won = F.col("_neg") * (F.col("tp") - F.col("_pos") / 2)
    row = steps.groupBy(*by).agg(F.sum(won).alias("_won"), F.first("_P").alias("_P"), F.first("_N").alias("_N"))
    area = F.try_divide(F.col("_won"), F.col("_P") * F.col("_N"))
    return row.select(*by, area.alias("auc"))


def roc_curve(df: DataFrame, positive=1, by: Sequence[str] = (), label="label", score="score") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the origin with a null threshold."""
    steps = _score_steps(df, positive, by, label, score)
    points = steps.select(
        *by, "threshold", F.try_divide("fp", "_N").alias("fpr"), F.try_divide("tp", "_P").alias("tpr")
    )
    origin = points.groupBy(*by).agg(F.count("*").alias("_n")).select(
        *by, F.lit(None).cast(points.schema["threshold"].dataType).alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def pr_curve(df: DataFrame, positive=1, by: Sequence[str] = (), label="label", score="score") -> DataFrame:
    """(threshold, recall, precision) per distinct score, and the end point (0, 1)."""
    steps = _score_steps(df, positive, by, label, score)
    points = steps.select(
        *by, "threshold", F.try_divide("tp", "_P").alias("recall"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )
    end = points.groupBy(*by).agg(F.count("*").alias("_n")).select(
        *by, F.lit(None).cast(points.schema["threshold"].dataType).alias("threshold"),
        F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"),
    )
    return points.unionByName(end)


def complete_pairs(df: DataFrame, label="label", prediction="prediction") -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.filter(y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p))


def regression(df: DataFrame, by: Sequence[str] = (), label="label", prediction="prediction") -> DataFrame:
    """MAE, MSE, RMSE, R2 and MAPE in percent; null pairs are skipped, MAPE also skips zero labels."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    row = complete_pairs(df, label, prediction).groupBy(*by).agg(
        F.avg(F.abs(y - p)).alias("MAE"), F.avg((y - p) ** 2).alias("MSE"), F.var_pop(y).alias("_var"),
        F.count("*").alias("_n"), (F.avg(F.abs(F.try_divide(y - p, y))) * 100).alias("MAPE_pct"),
    )
    r2 = (
        F.when(F.col("_n") < 2, F.lit(None))
        .when(F.col("_var") > 0, 1 - F.try_divide("MSE", "_var"))
        .otherwise(F.when(F.col("MSE") == 0, 1.0).otherwise(0.0))
    )
    return row.select(*by, "MAE", "MSE", F.sqrt("MSE").alias("RMSE"), r2.alias("R2"), "MAPE_pct")


def positive_score(predictions: DataFrame, out: str = "score") -> DataFrame:
    """P(class 1) if the model gives probabilities, else its decision value, else null."""
    for c in ("probability", "rawPrediction"):
        if c in predictions.columns:
            return predictions.withColumn(out, vector_to_array(F.col(c))[1])
    return predictions.withColumn(out, F.lit(None).cast("double"))


def actual_vs_predicted(df: DataFrame, label="label", prediction="prediction") -> tuple[DataFrame, DataFrame]:
    """The pairs, and one row with the range of the identity line."""
    pairs = df.select(F.col(label).alias("actual"), F.col(prediction).alias("predicted"))
    return pairs, pairs.agg(F.min("actual").alias("line_min"), F.max("actual").alias("line_max"))


Metric = Callable[[DataFrame, Sequence[str]], DataFrame]


def evaluate(df: DataFrame, metrics: Mapping[str, Metric], by: Sequence[str] = ()) -> DataFrame:
    """Run metric functions (predictions, by) -> one row per group, side by side."""
    tables = [m(df, by) for m in metrics.values()]
    return functools.reduce(lambda a, b: join_facts(a, b, by, how="left"), tables)
