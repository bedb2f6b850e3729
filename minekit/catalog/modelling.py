"""Splits, balancing, evaluation, supervised and unsupervised learning."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..operators import aggregates, balance, clean, encode, metrics, newton, profile, reshape, split, supervised, unsupervised
from ..plans.neighbours import nearest
from .registry import query, table

R = clean.round_numbers

# ---------------------------------------------------------------- splits and folds


def _ranked(source: str, by: str, ids: str, seed: int) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in ids.split(", ")]
    text = texts[0] if len(texts) == 1 else " || ".join(f"CAST(length({t}) AS VARCHAR) || ':' || {t}" for t in texts)
    part = f"PARTITION BY {by} " if by else ""
    return f"""(SELECT *, row_number() OVER ({part}ORDER BY md5({text} || '-{seed}') || '-' || {text}) AS rk,
 count(*) OVER ({part.strip()}) AS n FROM {source})"""


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, rk <= round(n * 0.75) AS is_train FROM {_ranked('lineitem', '', 'l_orderkey, l_linenumber, l_partkey, l_suppkey', 42)}")
def train_test_split(spark, folder):
    lines = table(spark, folder, "lineitem")
    made = split.train_test(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return made.select("l_orderkey", "l_linenumber", "l_partkey", "is_train")


@query(f"SELECT doc_id, toxic, rk <= round(n * 0.75) AS is_train FROM {_ranked('labels', 'toxic', 'doc_id', 42)}")
def stratified_split(spark, folder):
    return split.train_test(table(spark, folder, "labels").select("doc_id", "toxic"), ["doc_id"], stratify="toxic")


@query("SELECT o_orderkey, o_orderstatus, CAST(CASE " + " ".join(f"WHEN rk <= ceil(n * {j} / 10) THEN {j - 1}" for j in range(1, 10))
       + f" ELSE 9 END AS INTEGER) AS fold FROM {_ranked('orders', 'o_orderstatus', 'o_orderkey', 7)}")
def stratified_folds(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return split.folds(rows, ["o_orderkey"], 10, 7, "o_orderstatus")


@query(f"SELECT o_orderkey, CAST(CASE " + " ".join(f"WHEN rk <= ceil(n * {j} / 5) THEN {j - 1}" for j in range(1, 5))
       + f" ELSE 4 END AS INTEGER) AS fold FROM {_ranked('orders', '', 'o_orderkey', 42)}")
def k_folds(spark, folder):
    return split.folds(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 5)


# ---------------------------------------------------------------- balancing


@query("SELECT doc_id, toxic, (SELECT count(*) FROM labels) / (2.0::DOUBLE * count(*) OVER (PARTITION BY toxic)) AS weight FROM labels")
def class_weights(spark, folder):
    return balance.balanced_weights(table(spark, folder, "labels").select("doc_id", "toxic"), "toxic")


@query("SELECT doc_id, toxic, CASE WHEN toxic = 1 THEN greatest((SELECT count_if(toxic <> 1) / count_if(toxic = 1) FROM labels), 1.0::DOUBLE) ELSE 1.0 END AS weight FROM labels")
def positive_weights(spark, folder):
    return balance.positive_weights(table(spark, folder, "labels").select("doc_id", "toxic"), "toxic")


PAIRS = """e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
 pairs AS (SELECT a.vec_id AS id, a.label AS la, b.vec_id AS other, b.label AS lb, list_distance(a.v, b.v) AS d FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""


@query(f"WITH {PAIRS} SELECT id AS query_id, other AS base_id, round(d, 8) AS distance, CAST(rk AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS rk FROM pairs) WHERE rk <= 5")
def nearest_neighbours(spark, folder):
    rows = table(spark, folder, "embeddings")
    return R(nearest(rows, rows, 5, "vec_id", "embedding"), 8)


@query(f"""WITH {PAIRS}, c AS (SELECT label, count(*) AS n FROM e GROUP BY 1), m AS (SELECT label, n FROM c ORDER BY n, label LIMIT 1),
 k AS (SELECT id, la, avg(d) AS d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, other) AS rk FROM pairs WHERE la <> (SELECT label FROM m) AND lb = (SELECT label FROM m)) WHERE rk <= 3 GROUP BY 1, 2)
 SELECT vec_id, label FROM e WHERE label = (SELECT label FROM m) UNION ALL
 SELECT id, la FROM (SELECT *, row_number() OVER (PARTITION BY la ORDER BY d, id) AS rk FROM k) WHERE rk <= (SELECT n FROM m)""")
def near_miss(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    return balance.near_miss(rows, "vec_id", "label", "embedding").select("vec_id", "label")


@query("""WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY doc_id) AS pos FROM labels),
 d AS (SELECT toxic, n, unnest(range((SELECT max(n) FROM c) - n)) AS draw FROM c),
 p AS (SELECT toxic, draw, CAST(('0x' || md5(toxic || '-' || draw || '-42-pick')[1:15]) AS BIGINT) % n + 1 AS pos FROM d)
 SELECT doc_id, toxic, CAST(0 AS BIGINT) AS copy FROM labels UNION ALL SELECT doc_id, r.toxic, draw + 1 FROM p JOIN r ON r.toxic = p.toxic AND r.pos = p.pos""")
def oversample(spark, folder):
    return balance.oversample(table(spark, folder, "labels").select("doc_id", "toxic"), ["doc_id"], "toxic")


@query(f"""WITH {PAIRS}, f AS (SELECT id, la, other, lb FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, other) = 1)
 SELECT a.id, a.other FROM f a JOIN f b ON a.id = b.other AND a.other = b.id WHERE a.la <> a.lb""")
def tomek_links(spark, folder):
    return balance.tomek_links(table(spark, folder, "embeddings"), "vec_id", "label", "embedding")


@query()
def smote_tomek(spark, folder):
    made = balance.smote_tomek(table(spark, folder, "embeddings"), "vec_id", "label", "embedding")
    return made.groupBy("label").agg(F.count("*").alias("n_rows"), F.count_if(F.col("id").startswith("new-")).alias("n_new"))


# ---------------------------------------------------------------- evaluation

BINARY = """p AS (SELECT l_shipdate, CAST(l_returnflag = 'R' AS INTEGER) AS label, CAST(l_quantity * (1 + l_tax) > 30 AS INTEGER) AS prediction,
 l_discount * 2 + l_tax AS score FROM lineitem)"""


def binary(spark, folder) -> DataFrame:
    """Made-up predictions on line items, so that SQL can evaluate the same ones."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_quantity") * (1 + F.col("l_tax")) > 30).cast("int").alias("prediction"),
        (F.col("l_discount") * 2 + F.col("l_tax")).alias("score"),
        F.col("l_linestatus").alias("model"),
    )


MULTI = """p AS (SELECT CAST(ascii(l_returnflag) AS INTEGER) AS label, CAST(CASE l_linenumber % 4 WHEN 0 THEN 65 WHEN 1 THEN 78 WHEN 2 THEN 82 ELSE 90 END AS INTEGER) AS prediction FROM lineitem)"""


def multi(spark, folder) -> DataFrame:
    by_line = F.element_at(F.array(*map(F.lit, (65, 78, 82, 90))), F.col("l_linenumber") % 4 + 1)
    return table(spark, folder, "lineitem").select(F.ascii("l_returnflag").alias("label"), by_line.alias("prediction"))


@query(f"""WITH {MULTI}, c AS (SELECT label AS c FROM p UNION SELECT prediction FROM p) SELECT a.c AS label, b.c AS prediction, count(p.label) AS "count"
 FROM c a CROSS JOIN c b LEFT JOIN p ON p.label = a.c AND p.prediction = b.c GROUP BY 1, 2""")
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(multi(spark, folder))


@query(f"WITH {MULTI} SELECT round(avg(CAST(label = prediction AS INTEGER)), 6) AS Accuracy, round(1 - avg(CAST(label = prediction AS INTEGER)), 6) AS Error FROM p")
def accuracy(spark, folder):
    return R(metrics.accuracy(multi(spark, folder)), 6)


@query(f"""WITH {BINARY}, c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS TP, count(*) FILTER (label = 0 AND prediction = 1) AS FP,
 count(*) FILTER (label = 1 AND prediction = 0) AS FN, count(*) FILTER (label = 0 AND prediction = 0) AS TN, count(*) AS n FROM p)
 SELECT *, round(TP * 100 / n, 4) AS "TP_pct", round(FP * 100 / n, 4) AS "FP_pct", round(FN * 100 / n, 4) AS "FN_pct", round(TN * 100 / n, 4) AS "TN_pct",
 round(TN / (TN + FP), 4) AS "Specificity", round((FP + FN) / n, 4) AS "ErrorRate" FROM c""")
def binary_counts(spark, folder):
    return R(metrics.binary_counts(binary(spark, folder), 1))


RANKS = "s AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM p GROUP BY 1), r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS np, sum(neg) OVER () AS nn FROM s WINDOW w AS (ORDER BY score DESC))"


@query(f"""WITH {BINARY}, {RANKS}, c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM p)
 SELECT round(c.tp / (c.tp + c.fn), 6) AS "Recall_Pos", round(c.tp / (c.tp + c.fp), 6) AS "Precision_Pos", round(2 * c.tp / (2 * c.tp + c.fp + c.fn), 6) AS "F1_Pos",
 round((SELECT sum(neg * (tp - pos / 2)) / any_value(np * nn) FROM r)::DOUBLE, 6) AS "ROC_AUC_Pos" FROM c""")
def classification_metrics(spark, folder):
    return R(metrics.classification(binary(spark, folder), 1, score="score"), 6)


@query(f"""WITH {MULTI}, c AS (SELECT label AS c FROM p UNION SELECT prediction FROM p), k AS (SELECT c, count(*) FILTER (label = c AND prediction = c) AS hit, count(*) FILTER (label = c) AS re, count(*) FILTER (prediction = c) AS said
 FROM c, (SELECT label, prediction FROM p) GROUP BY 1)
 SELECT round(avg(coalesce(hit / nullif(said, 0), 0)), 6) AS "Precision_Macro", round(avg(coalesce(hit / nullif(re, 0), 0)), 6) AS "Recall_Macro", round(avg(coalesce(2 * hit / nullif(re + said, 0), 0)), 6) AS "F1_Macro" FROM k""")
def macro_metrics(spark, folder):
    return R(metrics.macro(multi(spark, folder)), 6)


@query("""WITH p AS (SELECT l_linestatus AS model, CAST(l_returnflag = 'R' AS INTEGER) AS label, l_discount * 2 + l_tax AS score FROM lineitem),
 s AS (SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM p GROUP BY 1, 2),
 r AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp, sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn FROM s)
 SELECT model, round((sum(neg * (tp - pos / 2)) / any_value(np * nn))::DOUBLE, 6) AS auc FROM r GROUP BY 1""")
def roc_auc(spark, folder):
    return R(metrics.roc_auc(binary(spark, folder), 1, ["model"]), 6)


@query(f"WITH {BINARY}, {RANKS} SELECT score AS threshold, round((fp / nn)::DOUBLE, 6) AS fpr, round((tp / np)::DOUBLE, 6) AS tpr FROM r UNION ALL SELECT NULL, 0, 0")
def roc_curve(spark, folder):
    out = metrics.roc_curve(binary(spark, folder), 1)
    return out.withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


@query(f"WITH {BINARY}, {RANKS} SELECT score AS threshold, round((tp / np)::DOUBLE, 6) AS recall, round((tp / (tp + fp))::DOUBLE, 6) AS precision FROM r UNION ALL SELECT NULL, 0, 1")
def precision_recall_curve(spark, folder):
    out = metrics.pr_curve(binary(spark, folder), 1)
    return out.withColumns({c: F.round(c, 6) for c in ("recall", "precision")})


PRICED = "p AS (SELECT l_returnflag AS model, l_extendedprice AS label, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 2000 END AS prediction FROM lineitem)"


def priced(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("model"), F.col("l_extendedprice").alias("label"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity") * 2000).alias("prediction"),
    )


@query(f"""WITH {PRICED} SELECT model, round(avg(abs(label - prediction)), 3) AS MAE, round(avg((label - prediction) ** 2), 0) AS MSE, round(sqrt(avg((label - prediction) ** 2)), 3) AS RMSE,
 round(1 - avg((label - prediction) ** 2) / var_pop(label), 6) AS R2, round(avg(abs((label - prediction) / label)) * 100, 4) AS MAPE_pct FROM p WHERE prediction IS NOT NULL GROUP BY 1""")
def regression_metrics(spark, folder):
    out = metrics.regression(priced(spark, folder), ["model"])
    digits = {"MAE": 3, "MSE": 0, "RMSE": 3, "R2": 6, "MAPE_pct": 4}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(f"WITH {PRICED} SELECT model, label, prediction FROM p WHERE prediction IS NOT NULL")
def complete_pairs(spark, folder):
    return metrics.complete_pairs(priced(spark, folder))


@query(f"WITH {PRICED} SELECT min(label) AS line_min, max(label) AS line_max FROM p")
def identity_line(spark, folder):
    return metrics.actual_vs_predicted(priced(spark, folder))[1]


@query(f"""WITH {PRICED} SELECT model, round(avg(label - prediction), 3) AS bias, round(max(abs(label - prediction)), 3) AS worst FROM p WHERE prediction IS NOT NULL GROUP BY 1""")
def custom_metrics(spark, folder):
    """User metrics: functions from predictions and keys to one row per group."""
    gap = F.col("label") - F.col("prediction")
    own = {
        "bias": lambda d, by: d.groupBy(*by).agg(F.avg(gap).alias("bias")),
        "worst": lambda d, by: d.groupBy(*by).agg(F.max(F.abs(gap)).alias("worst")),
    }
    return R(metrics.evaluate(metrics.complete_pairs(priced(spark, folder)), own, ["model"]), 3)


@query(f"""WITH {PRICED} SELECT model, round(sqrt(avg(greatest(label - prediction, 0) ** 2)), 3) AS shortfall,
 round(avg(CASE WHEN abs(label - prediction) <= 1000 THEN (label - prediction) ** 2 / 2 ELSE 1000 * (abs(label - prediction) - 500) END), 2) AS huber
 FROM p WHERE prediction IS NOT NULL GROUP BY 1""")
def merged_metrics(spark, folder):
    """User metrics as states that merge."""
    def added(a, b):
        return a[0] + b[0], a[1] + b[1]

    def mean_of(loss, last):
        def update(state, rows):
            gap = rows["label"].to_numpy(dtype=float) - rows["prediction"].to_numpy(dtype=float)
            return added(state, (float(loss(gap).sum()), len(gap)))

        return aggregates.Aggregate(lambda: (0.0, 0), update, added, lambda s: last(s[0] / s[1]) if s[1] else None)

    own = {
        "shortfall": mean_of(lambda g: np.maximum(g, 0) ** 2, np.sqrt),
        "huber": mean_of(lambda g: np.where(abs(g) <= 1000, g**2 / 2, 1000 * (abs(g) - 500)), float),
    }
    found = aggregates.aggregate(metrics.complete_pairs(priced(spark, folder)), own, ["label", "prediction"], ["model"])
    return found.select("model", F.round("shortfall", 3).alias("shortfall"), F.round("huber", 2).alias("huber"))


# ---------------------------------------------------------------- supervised learning


def document_task(spark, folder, target="quality", **options) -> supervised.Task:
    """Labelled documents described by counts over their whole text."""
    text = F.col("text")
    counts = {
        "n_chars": F.col("n_chars"), "n_words": F.size(F.split(text, r"\s+")), "n_lines": F.size(F.split(text, "\n")),
        "n_digits": F.regexp_count(text, F.lit("[0-9]")), "n_capitals": F.regexp_count(text, F.lit("[A-Z]")),
        "n_marks": F.regexp_count(text, F.lit("[.,;:!?]")),
    }
    labelled = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    rows = labelled.select("doc_id", "quality", "toxic", *[c.cast("double").alias(n) for n, c in counts.items()])
    return supervised.Task(rows, ["doc_id"], target, list(counts), **options)


def embedding_task(spark, folder) -> supervised.Task:
    rows = table(spark, folder, "embeddings").select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    return supervised.Task(rows, ["vec_id"], "label", [f"e{i}" for i in range(64)])


@query()
def logistic_holdout(spark, folder):
    task = document_task(spark, folder)
    return R(supervised.evaluate(task, supervised.holdout(task, "logistic")))


@query()
def model_comparison(spark, folder):
    task = document_task(spark, folder)
    models = {
        "Logistic": ("logistic", {}), "Forest": ("random_forest", {"n_estimators": 20, "max_depth": 5}),
        "Boosting": ("gbt", {"n_estimators": 10, "max_depth": 3}), "SVM": ("svm", {"max_iter": 30}),
    }
    return R(supervised.compare_models(task, models))


@query()
def cross_validation(spark, folder):
    task = document_task(spark, folder, class_weight="balanced")
    scored = supervised.folded(task, "logistic", 5)
    return R(profile.metric_summary(supervised.evaluate(task, scored, ["fold"]).drop("fold")))


def _newton_sql(k: int, steps: int, l2: float) -> str:
    """Newton's method for one feature and an intercept, all folds side by side, a step per table expression."""
    parts = [f"""p AS (SELECT l_orderkey % {k} AS fold, l_quantity::DOUBLE / 50 AS x, CAST(l_returnflag = 'R' AS DOUBLE) AS y FROM lineitem),
 b_0 AS (SELECT range AS model, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b0 FROM range({k}))"""]
    for i in range(steps):
        parts.append(f"""d_{i} AS (SELECT model, b1, b0, x, y, 1 / (1 + exp(-(b1 * x + b0))) AS p FROM p JOIN b_{i} ON fold <> model),
 g_{i} AS (SELECT model, any_value(b1) AS b1, any_value(b0) AS b0, sum((p - y) * x) + {l2} * any_value(b1) AS g1, sum(p - y) AS g0,
   sum(p * (1 - p) * x * x) + {l2} AS h11, sum(p * (1 - p) * x) AS h10, sum(p * (1 - p)) AS h00 FROM d_{i} GROUP BY model),
 b_{i + 1} AS (SELECT model, b1 - (h00 * g1 - h10 * g0) / (h11 * h00 - h10 * h10) AS b1, b0 - (h11 * g0 - h10 * g1) / (h11 * h00 - h10 * h10) AS b0 FROM g_{i})""")
    return f"""WITH {", ".join(parts)}, s AS (SELECT fold, y, 1 / (1 + exp(-(b1 * x + b0))) AS p FROM p JOIN b_{steps} ON fold = model)
 SELECT fold, count(*) AS n, round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 6) AS log_loss, round(avg((y - p) ** 2), 6) AS brier FROM s GROUP BY fold"""


@query(_newton_sql(4, 4, 1.0))
def newton_folds(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 4).alias("fold"), F.array(F.col("l_quantity").cast("double") / 50).alias("x"),
        (F.col("l_returnflag") == "R").cast("double").alias("y"))
    sets = F.array(*[(F.col("fold") != i).cast("double") for i in range(4)])
    model = newton.fit(rows, "y", "x", sets, scale=False, iterations=4, tolerance=0.0)
    scored = rows.select("fold", "y", model.score(F.col("x"), F.col("fold").cast("int")).alias("p"))
    loss = -F.avg(F.col("y") * F.log("p") + (1 - F.col("y")) * F.log(1 - F.col("p")))
    return scored.groupBy("fold").agg(
        F.count("*").alias("n"), F.round(loss, 6).alias("log_loss"), F.round(F.avg((F.col("y") - F.col("p")) ** 2), 6).alias("brier"))


_RINGS_SQL = """rings AS (SELECT o_orderkey, o_orderkey % 2 AS ring FROM orders)"""


@query(f"WITH {_RINGS_SQL} SELECT ring::DOUBLE AS label, count(*) AS n_rows, count(*) AS n_right FROM {_ranked('rings', 'ring', 'o_orderkey', 42)} WHERE rk > round(n * 0.75) GROUP BY 1")
def kernel_svm_rings(spark, folder):
    """A ring around another one, which no line parts: every held-out row is told apart by a kernel machine."""
    angle, ring = F.radians(F.col("o_orderkey") % 360), F.col("o_orderkey") % 2
    radius = 1 + 3 * ring + F.col("o_totalprice") / 1e6
    rows = table(spark, folder, "orders").select("o_orderkey", ring.alias("ring"), (radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y"))
    task = supervised.Task(rows, ["o_orderkey"], "ring", ["x", "y"])
    held = supervised.holdout(task, "svm", kernel="rbf", gamma=0.5, dims=128, max_iter=30)
    return held.groupBy("label").agg(F.count("*").alias("n_rows"), F.count_if(F.col("prediction") == F.col("label")).alias("n_right"))


@query()
def network_comparison(spark, folder):
    task = document_task(spark, folder)
    return R(supervised.compare_networks(task, shapes={"NN_01": (16,), "NN_04": (32, 16), "NN_05": (48, 24, 12)}, max_iter=10))


@query()
def multiclass_forest(spark, folder):
    task = embedding_task(spark, folder)
    return R(supervised.evaluate(task, supervised.holdout(task, "random_forest", n_estimators=20, max_depth=5)))


@query()
def best_model_detail(spark, folder):
    task = document_task(spark, folder)
    return supervised.model_detail(task, "logistic")["confusion"]


@query()
def seed_stability(spark, folder):
    task = document_task(spark, folder)
    return R(supervised.seed_stability(task, "logistic", [11, 42, 77])[1])


@query()
def balance_comparison(spark, folder):
    task = document_task(spark, folder, target="toxic")
    return R(supervised.balance_comparison(task, "logistic")[0])


@query()
def resampled_training(spark, folder):
    task = document_task(spark, folder, target="toxic", sampling="undersample")
    return R(supervised.evaluate(task, supervised.holdout(task, "logistic")))


@query()
def grid_search(spark, folder):
    task = document_task(spark, folder)
    return R(supervised.grid_search(task, "logistic", {"regParam": [0.0, 0.01, 0.1]}, 3)[0])


PRICE_SPLIT = _ranked("part", "", "p_partkey", 42)


@query(f"""WITH s AS (SELECT *, rk <= round(n * 0.75) AS is_train FROM {PRICE_SPLIT}), m AS (SELECT regr_slope(p_retailprice, p_partkey) AS b, regr_intercept(p_retailprice, p_partkey) AS a FROM s WHERE is_train),
 e AS (SELECT p_retailprice AS y, a + b * p_partkey AS p FROM s, m WHERE NOT is_train)
 SELECT round(avg(abs(y - p)), 4) AS MAE, round(avg((y - p) ** 2), 2) AS MSE, round(sqrt(avg((y - p) ** 2)), 4) AS RMSE, round(1 - avg((y - p) ** 2) / var_pop(y), 6) AS R2, round(avg(abs((y - p) / y)) * 100, 4) AS MAPE_pct FROM e""")
def linear_holdout(spark, folder):
    task = supervised.Task(table(spark, folder, "part"), ["p_partkey"], "p_retailprice", ["p_partkey"], kind="regression")
    out = supervised.evaluate(task, supervised.holdout(task, "linear"))
    return out.withColumns({c: F.round(c, {"MSE": 2, "R2": 6}.get(c, 4)) for c in out.columns})


@query()
def forest_regression(spark, folder):
    rows = table(spark, folder, "orders").withColumn("month", F.month("o_orderdate"))
    task = supervised.Task(rows, ["o_orderkey"], "o_totalprice", ["o_custkey", "month"], kind="regression")
    return R(supervised.evaluate(task, supervised.holdout(task, "random_forest", n_estimators=5, max_depth=5)))


# ---------------------------------------------------------------- unsupervised learning


def points(spark, folder) -> DataFrame:
    return unsupervised.scaled_vectors(table(spark, folder, "embeddings"), "embedding")


@query()
def k_means(spark, folder):
    labelled, _ = unsupervised.k_means(points(spark, folder), 4)
    return labelled.groupBy("prediction").agg(F.count("*").alias("n_points"))


@query()
def hierarchical_clusters(spark, folder):
    return R(unsupervised.hierarchical(points(spark, folder), 4)[1])


@query()
def elbow_curve(spark, folder):
    return R(unsupervised.elbow(points(spark, folder), k_max=6), 3)


@query("""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
 d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, sum(list_distance(a.v, b.v) ** 2) AS s, count(*) AS n FROM e a, e b GROUP BY 1, 2, 3),
 x AS (SELECT vec_id, max(s / (n - 1)) FILTER (la = lb) AS own, min(s / n) FILTER (la <> lb) AS other FROM d GROUP BY 1)
 SELECT round(avg((other - own) / greatest(own, other)), 6) AS silhouette FROM x""")
def silhouette(spark, folder):
    """How well the given labels separate the raw vectors."""
    rows = unsupervised.scaled_vectors(table(spark, folder, "embeddings"), "embedding", scale=False)
    score = unsupervised.silhouette(rows, cluster="label")
    return rows.agg(F.lit(score).alias("silhouette")).select(F.round("silhouette", 6).alias("silhouette"))


def _components(spark, folder, k=8):
    return unsupervised.principal_components(points(spark, folder), k, [f"e{i}" for i in range(64)])


@query()
def pca_scores(spark, folder):
    made = _components(spark, folder, 2).scores
    return made.select("vec_id", "label", *[F.round(F.abs(F.col("embedding")[i]), 6).alias(f"abs_pc{i + 1}") for i in range(2)])


@query()
def pca_variance(spark, folder):
    return R(_components(spark, folder).variance_table(), 6)


@query()
def pca_metrics(spark, folder):
    return R(_components(spark, folder).metrics(), 6)


@query()
def pca_loadings(spark, folder):
    made = _components(spark, folder, 3).loadings()
    return made.select("feature", *[F.round(F.abs(f"PC{i}"), 6).alias(f"abs_pc{i}") for i in (1, 2, 3)])


# Two standardised columns have principal axes (1, 1) and (1, -1) over the root of 2, in the order of the sign of r,
# with variances n / (n - 1) * (1 + |r|) and n / (n - 1) * (1 - |r|).
PAIR = """WITH s AS (SELECT count(*) AS n, corr(p_size, p_retailprice) AS r, avg(p_size) AS a, stddev_pop(p_size) AS sa,
 avg(p_retailprice) AS b, stddev_pop(p_retailprice) AS sb FROM part)"""


def _pair(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", F.array(F.col("p_size").cast("double"), "p_retailprice").alias("both"))
    return unsupervised.principal_components(unsupervised.scaled_vectors(rows, "both"), 2, ["p_size", "p_retailprice"])


@query(PAIR + """ SELECT p_partkey, round(abs((p_size - a) / sa + sign(r) * (p_retailprice - b) / sb) / sqrt(2), 5) AS abs_pc1,
 round(abs((p_size - a) / sa - sign(r) * (p_retailprice - b) / sb) / sqrt(2), 5) AS abs_pc2 FROM part, s""")
def pca_pair_scores(spark, folder):
    return _pair(spark, folder).scores.select("p_partkey", *[F.round(F.abs(F.col("embedding")[i]), 5).alias(f"abs_pc{i + 1}") for i in range(2)])


@query(PAIR + """ SELECT 1::BIGINT AS component, round((1 + abs(r)) / 2, 6) AS ratio, round((1 + abs(r)) / 2, 6) AS cumulative FROM s
 UNION ALL SELECT 2::BIGINT, round((1 - abs(r)) / 2, 6), 1.0::DOUBLE FROM s""")
def pca_pair_variance(spark, folder):
    return R(_pair(spark, folder).variance_table(), 6)


@query(PAIR + """ SELECT c AS feature, round(sqrt((1 + abs(r)) / 2 * n / (n - 1)), 5) AS abs_pc1, round(sqrt((1 - abs(r)) / 2 * n / (n - 1)), 5) AS abs_pc2
 FROM s, (VALUES ('p_size'), ('p_retailprice')) AS v(c)""")
def pca_pair_loadings(spark, folder):
    made = _pair(spark, folder).loadings()
    return made.select("feature", *[F.round(F.abs(f"PC{i}"), 5).alias(f"abs_pc{i}") for i in (1, 2)])


@query(PAIR + """ SELECT 2::BIGINT AS n_components, 1.0::DOUBLE AS explained_total, 1.0::DOUBLE AS explained_first_two,
 round(2.0::DOUBLE * n / (n - 1), 6) AS total_variance FROM s""")
def pca_pair_metrics(spark, folder):
    return R(_pair(spark, folder).metrics(), 6)


# Three clouds, each far from the others, that any sound clustering finds: their squared errors are known.
CLOUDS = """WITH c AS (SELECT o_orderstatus, o_orderkey, CASE o_orderstatus WHEN 'O' THEN 100 WHEN 'P' THEN 50 ELSE 0 END + o_totalprice / 1e6::DOUBLE AS x,
 CASE o_orderstatus WHEN 'P' THEN 100 ELSE 0 END + (o_orderkey % 10) / 10.0::DOUBLE AS y FROM orders)"""


def _clouds(spark, folder):
    status = F.col("o_orderstatus")
    x = F.when(status == "O", 100).when(status == "P", 50).otherwise(0) + F.col("o_totalprice") / 1e6
    y = F.when(status == "P", 100).otherwise(0) + F.col("o_orderkey") % 10 / 10
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.array(x, y).alias("point"))
    return unsupervised.scaled_vectors(rows, "point", scale=False)


def _cluster_report(labelled):
    """Per cluster: its statuses, rows and middle."""
    xy = vector_to_array("features")
    return R(labelled.groupBy("prediction").agg(
        F.array_join(F.sort_array(F.collect_set("o_orderstatus")), ",").alias("statuses"), F.count("*").alias("n_points"),
        F.avg(xy[0]).alias("x"), F.avg(xy[1]).alias("y")).drop("prediction"))


_CLOUD_SQL = CLOUDS + """ SELECT o_orderstatus AS statuses, count(*) AS n_points, round(avg(x), 4) AS x, round(avg(y), 4) AS y FROM c GROUP BY 1"""


@query(_CLOUD_SQL)
def k_means_clouds(spark, folder):
    return _cluster_report(unsupervised.k_means(_clouds(spark, folder), 3, n_init=4)[0])


@query(CLOUDS + """ SELECT 3::BIGINT AS k, round(sum(s), 2) AS inertia FROM (SELECT count(*) * (var_pop(x) + var_pop(y)) AS s FROM c GROUP BY o_orderstatus)""")
def k_means_clouds_inertia(spark, folder):
    report = unsupervised.k_means(_clouds(spark, folder), 3, n_init=4)[1]
    return report.select("k", F.round("inertia", 2).alias("inertia"))


@query(_CLOUD_SQL)
def hierarchical_clouds(spark, folder):
    return _cluster_report(unsupervised.hierarchical(_clouds(spark, folder), 3)[0])


@query(_CLOUD_SQL)
def single_linkage_clouds(spark, folder):
    rows = _clouds(spark, folder)
    return _cluster_report(unsupervised.single_linkage(rows, ["o_orderkey"], "point", 3))


@query(_CLOUD_SQL)
def ward_linkage_clouds(spark, folder):
    return _cluster_report(unsupervised.linkage(_clouds(spark, folder), ["o_orderkey"], "point", 3, "ward", micro=200))


@query(f"""WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
 near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_distance(a.v, b.v) <= 1.1),
 reach AS (SELECT vec_id, vec_id AS least FROM e UNION SELECT b, least FROM reach JOIN near ON a = vec_id),
 found AS (SELECT vec_id, min(least) AS least FROM reach GROUP BY 1)
 SELECT vec_id, CAST(dense_rank() OVER (ORDER BY least) - 1 AS INTEGER) AS prediction FROM found""")
def embedding_linkage(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return unsupervised.single_linkage(rows, ["vec_id"], "embedding", height=1.1).select("vec_id", "prediction")


@query()
def embedding_clusters(spark, folder):
    plane = unsupervised.plane(points(spark, folder), [f"e{i}" for i in range(64)])
    labelled, _ = unsupervised.cluster_embedding(plane, 4)
    axes = labelled.select("prediction", *[F.col("embedding")[i].alias(f"axis_{i + 1}") for i in range(2)])
    return profile.centroids(axes, "prediction", ["axis_1", "axis_2"]).select("prediction", "n_points")


@query()
def clustering_comparison(spark, folder):
    runs = {"KMeans_3": ("k_means", 3), "KMeans_5": ("k_means", 5), "Tree_3": ("hierarchical", 3)}
    return R(unsupervised.compare(points(spark, folder), runs))


@query()
def best_clustering(spark, folder):
    runs = {"KMeans_3": ("k_means", 3), "KMeans_5": ("k_means", 5)}
    return R(reshape.pick_best(unsupervised.compare(points(spark, folder), runs), "model_name", "silhouette"))


@query()
def cluster_stability(spark, folder):
    return R(unsupervised.cluster_stability(points(spark, folder), [2, 3], [1, 2, 3]))


@query("""SELECT c_custkey, c_mktsegment = 'HOUSEHOLD' AS marked, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS label FROM customer""")
def label_codes(spark, folder):
    coded, _ = encode.encode_labels(table(spark, folder, "customer"), "c_mktsegment")
    return coded.select("c_custkey", (F.col("c_mktsegment") == "HOUSEHOLD").alias("marked"), "label")
