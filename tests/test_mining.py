"""Rules, pages, balancing, series and models against brute force and known values."""

import itertools

import numpy as np
import pytest
from table_data import DATA, rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from minekit.operators import balance, metrics, pages, rules, split, supervised, timeseries, unsupervised

BASKETS = [
    "bread milk", "bread nappies beer eggs", "milk nappies beer cola", "bread milk nappies beer", "bread milk nappies cola",
    "bread milk", "beer cola", "bread beer",
]


@pytest.fixture(scope="module")
def baskets(spark):
    pairs = [(i, item) for i, b in enumerate(BASKETS) for item in b.split()] + [(0, "milk"), (1, None)]
    return rules.baskets_from_pairs(spark.createDataFrame(pairs, "tx int, item string"), "tx", "item")


def brute_itemsets(least):
    sets = [set(b.split()) for b in BASKETS]
    items = sorted(set().union(*sets))
    found = {}
    for k in range(1, len(items) + 1):
        for c in itertools.combinations(items, k):
            s = sum(set(c) <= b for b in sets) / len(sets)
            if s >= least:
                found[c] = s
    return found


def test_itemsets_and_rules_match_brute_force(spark, baskets):
    itemsets = rules.frequent_itemsets(baskets, 0.2)
    want = brute_itemsets(0.2)
    assert {tuple(r["items"]): r["support"] for r in itemsets.collect()} == pytest.approx(want)
    got = {(tuple(r.antecedents), tuple(r.consequents)): r.confidence for r in rules.association_rules(itemsets, "confidence", 0.5).collect()}
    expected = {}
    for items, s in want.items():
        for k in range(1, len(items)):
            for a in itertools.combinations(items, k):
                c = tuple(x for x in items if x not in a)
                if s / want[a] >= 0.5:
                    expected[(a, c)] = s / want[a]
    assert got == pytest.approx(expected)
    assert any(len(c) > 1 for _, c in got)


def test_sure_rule_has_infinite_conviction(spark):
    pairs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "b")], "tx int, item string")
    made = rules.association_rules(rules.frequent_itemsets(rules.baskets_from_pairs(pairs, "tx", "item"), 0.1), "confidence", 0.9)
    assert [(r.antecedents, r.conviction) for r in made.collect()] == [(["a"], float("inf"))]


def test_item_lists_keep_repeats(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "tx int, item string")
    assert rows(rules.item_lists(df, "tx", "item")) == [(1, ["a", "b", "b"])]


# ---------------------------------------------------------------- pages

PAGE = """<html><head><style>p{}</style><script>var t="</p>";</script></head><body><!-- <p>no</p> -->
<div id="main" class="box wide"><p>One <b>two</b></p><p class="x">Three &amp; four<br>five</p></div>
<div class="item"><h2><a class="t" href="/a?x=1&amp;y=2">A</a></h2><span class="price"> $5 </span></div>
<div class="item"><h2><a class="t" href="b">B</a></h2></div>
<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>x</td></tr></table></body></html>"""


@pytest.fixture(scope="module")
def site(spark):
    return spark.createDataFrame([(1, "http://s.com/l/p", PAGE), (2, "http://s.com/", None)], "page_id int, url string, html string")


@pytest.mark.parametrize("selector,want", [
    ("p", ["Onetwo", "Three & fourfive"]), ("#main p.x", ["Three & fourfive"]), (".box.wide b", ["two"]),
    ("div[id=main] > p".replace(" > ", " "), ["Onetwo", "Three & fourfive"]), ("[class] a[href]", ["A", "B"]), (".none", []),
])
def test_selectors(site, selector, want):
    assert [r.text for r in pages.selected_text(site, selector).orderBy("pos").collect()] == want


def test_tables_links_and_records(site):
    assert rows(pages.table_cells(site).select("row", "col", "text")) == [(0, 0, "a"), (0, 1, "b"), (1, 0, "1"), (1, 1, "x")]
    assert [r.absolute for r in pages.links(site).orderBy("pos").collect()] == ["http://s.com/a?x=1&y=2", "http://s.com/l/b"]
    made = pages.records(site, ".item", {"title": {"selector": ".t"}, "href": {"selector": ".t", "attr": "href"}, "price": {"selector": ".price", "default": "?"}})
    assert rows(made.select("title", "href", "price")) == [("A", "/a?x=1&y=2", "$5"), ("B", "b", "?")]
    with pytest.raises(ValueError):
        pages.records(site, ".item", {"title": {}})


def test_regex_groups(spark):
    df = spark.createDataFrame([("Team A vs. Team B",), ("nothing",)], "text string")
    assert rows(pages.regex_groups(df, "text", r"(.+?)\s+vs\.\s+(.+)", ["home", "away"])) == [("Team A vs. Team B", "Team A", "Team B")]
    with pytest.raises(ValueError):
        pages.regex_groups(df, "text", "(a)(b)", ["x"])


# ---------------------------------------------------------------- balancing


@pytest.fixture(scope="module")
def classes(spark):
    data = spark.read.parquet(f"{DATA}/embeddings.parquet").filter("vec_id < 120")
    return data.select("vec_id", F.when(F.col("label") < 2, 1).when(F.col("label") < 6, 2).otherwise(3).alias("label"), "embedding")


def test_balanced_sizes(classes):
    counts = balance.class_counts(classes, "label")
    low, high = min(counts.values()), max(counts.values())
    assert set(balance.class_counts(balance.near_miss(classes, "vec_id", "label", "embedding"), "label").values()) == {low}
    grown = balance.oversample(classes, ["vec_id"], "label")
    assert set(balance.class_counts(grown, "label").values()) == {high}
    assert grown.select("vec_id", "label").distinct().count() == 120
    made = balance.smote(classes, "vec_id", "label", "embedding")
    assert set(balance.class_counts(made, "label").values()) == {high}


def test_smote_points_lie_between_class_mates(classes):
    made = balance.smote(classes, "vec_id", "label", "embedding")
    table = classes.toPandas()
    for r in made.filter(F.col("id").startswith("new-")).limit(10).collect():
        mates = np.stack(table[table["label"] == r.label]["embedding"]).astype(float)
        p, on_line = np.array(r.vector), False
        for a, b in itertools.combinations(range(len(mates)), 2):
            if abs(np.linalg.norm(mates[a] - p) + np.linalg.norm(mates[b] - p) - np.linalg.norm(mates[a] - mates[b])) < 1e-9:
                on_line = True
                break
        assert on_line


def test_no_tomek_link_survives_once_removed(classes):
    links = {frozenset(r) for r in balance.tomek_links(classes, "vec_id", "label", "embedding").collect()}
    table = classes.orderBy("vec_id").toPandas()
    v = np.stack(table["embedding"]).astype(float)
    away = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    np.fill_diagonal(away, np.inf)
    first = away.argmin(1)
    want = {frozenset((int(table["vec_id"][i]), int(table["vec_id"][first[i]]))) for i in range(len(v)) if first[first[i]] == i and table["label"][i] != table["label"][first[i]]}
    assert links == want


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert set(rows(balance.balanced_weights(df, "y"))) == {(0, 8 / 12), (1, 2.0)}
    assert balance.scale_pos_weight(df, "y") == 3.0
    assert balance.scale_pos_weight(df, "y", 0) == 1.0 and balance.scale_pos_weight(df, "y", 5) == 1.0


# ---------------------------------------------------------------- metrics


def test_known_confusion_matrix(spark):
    cells = [[9, 0, 1], [1, 6, 3], [0, 3, 7]]
    data = [(i, j) for i in range(3) for j in range(3) for _ in range(cells[i][j])]
    df = spark.createDataFrame(data, "label int, prediction int")
    assert metrics.accuracy(df).first()["Accuracy"] == pytest.approx(22 / 30)
    got = {(r.label, r.prediction): r["count"] for r in metrics.confusion_matrix(df).collect()}
    assert got == {(i, j): cells[i][j] for i in range(3) for j in range(3)}
    assert metrics.classification(df, 1).first()["F1_Pos"] is None


def test_auc_equals_mllib(tight):
    df = tight.range(300).select((F.col("id") % 3 == 0).cast("double").alias("label"), ((F.col("id") * 7919) % 41 / 41).alias("score"))
    # All scores count here: MLlib must not merge them into bins.
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert metrics.roc_auc(df).first()["auc"] == pytest.approx(want)


def test_constant_target_scores(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (None, 1.0)], "label double, prediction double")
    assert metrics.regression(df).first()["R2"] == 0.0
    assert metrics.regression(df.filter("prediction = 1")).first()["R2"] is None


# ---------------------------------------------------------------- splits and series


def test_folds_cover_and_balance(spark):
    df = spark.range(103).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    table = split.folds(df, ["id"], 5, stratify="y").toPandas()
    for _, part in table.groupby("y"):
        sizes = part.groupby("fold").size()
        assert len(sizes) == 5 and sizes.max() - sizes.min() <= 1


def series_frame(spark, n=60, series=("a", "b")):
    data = [(s, i, 50 + 0.5 * i + 10 * ((i + k) % 7) + (i * 13 % 5)) for k, s in enumerate(series) for i in range(n)]
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("i").cast("int"))
    return spark.createDataFrame(data, "s string, i long, v double").select("s", day.alias("day"), "v")


def test_expanding_folds(spark):
    table = split.expanding_folds(series_frame(spark, 20), "day", ["s"], 3, 4, gap=1).filter("s = 'a'").toPandas()
    for fold in range(3):
        part = table[table["fold"] == fold]
        start = 20 - (3 - fold) * 4
        assert (part["role"] == "test").sum() == 4 and (part["role"] == "train").sum() == start - 1


@pytest.mark.parametrize("size", [None, 5])
def test_time_split_in_runs(tight, size):
    table = split.time_split(series_frame(tight), "day", ["s"], size).toPandas()
    for _, part in table.groupby("s"):
        held = part[~part["is_train"]]
        assert len(held) == (size or 15) and held["day"].min() > part[part["is_train"]]["day"].max()


def test_holt_winters_long_series_equal_short_ones(tight):
    df = series_frame(tight, 95)
    names = ["s", "step", "forecast", "alpha", "beta", "gamma", "sse"]
    runs = timeseries.holt_winters(df, "day", "v", ["s"], 7, 10).select(*names).toPandas().sort_values(["s", "step"])
    tight.conf.unset("spark.minekit.maxGroupRows")
    whole = timeseries.holt_winters(df, "day", "v", ["s"], 7, 10).select(*names).toPandas().sort_values(["s", "step"])
    assert np.allclose(runs.iloc[:, 1:].to_numpy(float), whole.iloc[:, 1:].to_numpy(float))
    assert (runs["s"].to_numpy() == whole["s"].to_numpy()).all() and len(runs) == 20


def test_holt_winters_without_keys(spark):
    df = series_frame(spark, 40, ("a",)).drop("s")
    made = timeseries.holt_winters(df, "day", "v", [], 7, 3).orderBy("step").collect()
    assert [str(r.day) for r in made] == ["2020-02-10", "2020-02-11", "2020-02-12"]


def test_arima_follows_a_line(spark):
    df = series_frame(spark, 40, ("a",)).withColumn("v", F.datediff("day", F.lit("2020-01-01")) * 2.0)
    made = timeseries.arima(df, "day", "v", ["s"], (1, 1, 0), 3).orderBy("step").collect()
    assert [r.forecast for r in made] == pytest.approx([80.0, 82.0, 84.0])


def test_lag_forecast_repeats_a_cycle(tight):
    df = series_frame(tight).withColumn("v", (F.datediff("day", F.lit("2020-01-01")) % 7).cast("double"))
    made = timeseries.lag_forecast(df, "day", "v", 7, 14, ["s"]).filter("s = 'a'").orderBy("step").collect()
    assert [r.forecast for r in made] == pytest.approx([float((60 + i) % 7) for i in range(14)], abs=1e-6)


def test_comparison_has_every_model(spark):
    made = timeseries.compare(timeseries.holdout_predictions(series_frame(spark), "day", "v", ["s"], 7), ["s"])
    table = made.toPandas()
    assert len(table) == 10 and (table["RMSE"] >= 0).all() and table.groupby("s")["best_model"].nunique().eq(1).all()


# ---------------------------------------------------------------- models


@pytest.fixture(scope="module")
def task(spark):
    x = (F.col("id") * 37 % 101).cast("double")
    df = spark.range(240).select("id", x.alias("x"), (F.col("id") % 5).cast("double").alias("z"), F.when(x > 50, "yes").otherwise("no").alias("y"))
    return supervised.Task(df, ["id"], "y", ["x", "z"])


@pytest.mark.parametrize("name,params", [
    ("logistic", {}), ("random_forest", {"n_estimators": 5}), ("gbt", {"n_estimators": 3}), ("svm", {"max_iter": 20}), ("mlp", {"hidden": (4,), "max_iter": 60}),
])
def test_classifiers_learn_a_threshold(task, name, params):
    row = supervised.evaluate(task, supervised.holdout(task, name, **params)).first()
    assert row["Accuracy"] > 0.9 and row["F1_Pos"] > 0.85


def test_cross_validation_covers_all_rows(task):
    scored = supervised.folded(task, "logistic", 3)
    assert scored.select("id").distinct().count() == scored.count() == 240


def test_comparison_sorts_by_criterion(task):
    table = supervised.compare_models(task, {"A": ("logistic", {}), "B": ("random_forest", {"n_estimators": 3, "max_depth": 1})}, k=2).toPandas()
    assert list(table["F1_Pos"]) == sorted(table["F1_Pos"], reverse=True) and "CV_Accuracy_std" in table


def test_grid_search_picks_the_best(task):
    table, held, best = supervised.grid_search(task, "logistic", {"regParam": [0.0, 5.0]}, 3)
    assert table.count() == 2 and best["regParam"] == 0.0 and abs(held.count() - 60) <= 1


def test_resampling_only_touches_training_rows(spark):
    df = spark.range(200).select("id", (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    one = supervised.Task(df, ["id"], "y", ["x"], sampling="oversample", class_weight="balanced")
    assert supervised.holdout(one, "logistic").count() == 50


def test_components_match_numpy(spark):
    data = spark.read.parquet(f"{DATA}/embeddings.parquet").filter("vec_id < 150").select("vec_id", F.slice("embedding", 1, 6).alias("e"))
    x = np.stack(data.orderBy("vec_id").toPandas()["e"]).astype(float)
    x = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    order = values.argsort()[::-1]
    made = unsupervised.principal_components(unsupervised.scaled_vectors(data, "e"), 3, list("abcdef"))
    assert np.allclose(made.ratios, (values[order] / values.sum())[:3]) and made.total_variance == pytest.approx(values.sum())
    loadings = made.loadings().toPandas().sort_values("feature").iloc[:, 1:].to_numpy()
    assert np.allclose(loadings**2, (vectors[:, order[:3]] * np.sqrt(values[order[:3]])) ** 2)


def test_clusters_separate_two_clouds(spark):
    point = F.array((F.col("id") % 2 * 100 + F.col("id") % 5).cast("double"), (F.col("id") % 3).cast("double"))
    vectors = unsupervised.scaled_vectors(spark.range(60).select("id", point.alias("v")), "v", scale=False)
    for kind in (unsupervised.k_means, unsupervised.hierarchical):
        labelled, row = kind(vectors, 2)
        assert labelled.groupBy((F.col("id") % 2).alias("half"), "prediction").count().count() == 2
    inertia = [r.inertia for r in unsupervised.elbow(vectors, k_max=4).orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)
