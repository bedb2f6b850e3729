"""One answer on both sides of every bound, and no row, bin, series or link that vanishes."""

import pytest
from table_data import rows
from pyspark.sql import functions as F

from minekit.functions.markup import parse
from minekit.operators import encode, pages, profile, split, supervised


def test_a_test_size_is_met_exactly_with_tied_times(spark):
    df = spark.createDataFrame([(i, i // 5) for i in range(20)], "id int, t int")
    out = split.time_split(df, "t", test_size=2)
    assert sorted(r.id for r in out.filter("not is_train").collect()) == [18, 19]
    large = spark.range(6000).select(F.col("id").cast("int").alias("id"), F.floor(F.col("id") / 5).alias("t"))
    for size in (999, 1001):
        assert split.time_split(large, "t", test_size=size).filter("not is_train").count() == size


def test_short_series_get_no_split_and_others_do(spark):
    df = spark.createDataFrame([("a", i) for i in range(8)] + [("b", 1)], "k string, t int")
    out = split.time_split(df, "t", ["k"], test_size=3)
    assert out.filter("k = 'a' and not is_train").count() == 3
    assert [r.is_train for r in out.filter("k = 'b'").collect()] == [None]
    with pytest.raises(ValueError):
        split.time_split(df.filter("k = 'b'"), "t")


def test_positive_label_among_many_classes(spark):
    df = spark.range(1500).select(F.col("id").cast("string").alias("c"))
    assert encode.positive_label(df, "c", 1234) == "1234" and encode.positive_label(df, "c", "none") is None
    two = spark.createDataFrame([(0.0,), (1.0,), (None,)], "c double")
    assert encode.positive_label(two, "c", 1) == 1.0 and encode.positive_label(two, "c", 7) == 1.0


@pytest.mark.parametrize("drop_first", [True, False])
def test_one_hot_vector_equals_one_hot(spark, drop_first):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "x"), (4, "c", "x")], "id int, k string, one string")
    plain = encode.one_hot(df, ["k", "one"], drop_first)
    vector = encode.one_hot_vector(df, ["k", "one"], drop_first)
    wide = {r.id: [v for c, v in r.asDict().items() if c.startswith("k_")] for r in plain.collect()}
    got = {r.id: list(map(int, r.k_vector.toArray())) for r in vector.collect()}
    assert got == wide
    assert {len(r.one_vector) for r in vector.collect()} == {0 if drop_first else 1}


def test_histogram_lists_every_bin(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("b", 4.1), ("b", None)], "k string, v double")
    assert [(r.bin, r["count"]) for r in profile.histogram(df, "v", 5).orderBy("bin").collect()] == [(0, 1), (1, 0), (2, 1), (3, 0), (4, 1)]
    by = profile.histogram(df, "v", 5, ["k"])
    assert by.count() == 10 and {(r.k, r.bin) for r in by.filter("count > 0").collect()} == {("a", 0), ("a", 4), ("b", 2)}


def test_frequency_of_short_and_slow_series(spark):
    df = spark.createDataFrame([("a", "2020-01-01"), ("b", "2020-01-01"), ("b", "2020-02-10"), ("b", "2020-03-21")], "k string, d string")
    out = profile.frequency(df.withColumn("d", F.to_date("d")), "d", ["k"])
    assert {r.k: (r.gap_seconds, r.frequency) for r in out.collect()} == {
        "a": (None, "No determinada"), "b": (40 * 86400.0, "40 days 00:00:00")}


def test_links_in_any_quoting(spark):
    html = """<a href="/d">1</a><a class='x' href='/s'>2</a><A title="a > b" HREF=/bare>3</a><a name=n>4</a>
    <a data-href="/no" href = "/sp">5</a><link href='/css'><abbr href="/abbr"><a href="">6</a><!-- <a href="/c"> -->"""
    table = spark.createDataFrame([(1, "http://h/p", html)], "page_id int, url string, html string")
    assert [r.href for r in pages.links(table).orderBy("pos").collect()] == ["/d", "/s", "/bare", "/sp", ""]
    assert [r.href for r in pages.links(table, tag="link").collect()] == ["/css"]
    assert [r.href for r in pages.links(table, attrs={"class": "x"}).collect()] == ["/s"]


@pytest.mark.parametrize("selector", ["div>p", "p, b", "p:first-child", "", "p + b", "a[href^='x']"])
def test_unsupported_selectors_are_errors(spark, selector):
    table = spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id int, url string, html string")
    with pytest.raises(ValueError):
        parse("<p>x</p>").select(selector)
    with pytest.raises(ValueError):
        pages.selected_text(table, selector)


def test_supported_selectors_still_match():
    page = parse('<div class="a b" id="i"><p data-x="1 2">t</p></div>')
    for selector in ("div p", "div.a.b p", "#i p", "p[data-x]", "p[data-x='1 2']", "div * "):
        assert page.select(selector)


def test_tree_depth_is_not_cut_silently():
    assert supervised.tree_depth(-1) == supervised.tree_depth(None) == 30 and supervised.tree_depth(12) == 12
    with pytest.raises(ValueError):
        supervised.tree_depth(31)
    assert supervised.build_model("gbt", "classification", 100, 2, 3, max_depth=-1).getMaxDepth() == 30


def test_grid_search_heeds_weights_and_common_names(spark):
    rows_ = [(i, float(i % 20 == 0 and i % 3 > 0), (i * 7919 % 1000) / 1000 + (0.6 if i % 20 == 0 else 0.0)) for i in range(400)]
    df = spark.createDataFrame(rows_, "id int, y double, x double")
    table = {}
    for weight in (None, "balanced"):
        task = supervised.Task(df, ["id"], "y", ["x"], class_weight=weight)
        scores, held, best = supervised.grid_search(task, "logistic", {"C": [0.1, 1.0]}, k=3)
        assert scores.count() == 2 and held.count() > 0 and "regParam" in best
        table[weight] = rows(scores.select(F.round("score", 4)))
    assert table[None] != table["balanced"]



def test_slices_of_repeated_and_composite_ids_do_not_depend_on_size(spark):
    from minekit.plans.bounds import GROUP_ROWS

    df = spark.createDataFrame([(f"{i % 20}-{i % 3}", str(i % 7)) for i in range(120)] + [("1-2", "3"), ("1", "2-3"), (None, "x")], "a string, b string")
    got = []
    for bound in (1_000_000, 40):
        spark.conf.set(GROUP_ROWS, str(bound))
        got.append(sorted(map(str, split.folds(df, ["a", "b"], 4).groupBy("a", "b", "fold").count().collect())))
    spark.conf.unset(GROUP_ROWS)
    assert got[0] == got[1]
    assert len(got[0]) == df.distinct().count()  # rows of one identity stay together


def test_confusion_matrix_of_many_classes(spark):
    from minekit.operators import metrics

    df = spark.range(40).select(F.col("id").alias("label"), F.pmod(F.col("id") + 1, F.lit(40)).alias("prediction"))
    assert metrics.confusion_matrix(df).count() == 1600
    wide = spark.range(1200).select(F.col("id").alias("label"), F.col("id").alias("prediction"))
    row = metrics.classification(wide).first()
    assert row.F1_Pos is None


def test_weights_with_many_label_values(spark):
    from minekit.operators import balance

    df = spark.range(12_000).select(F.col("id").alias("y"))
    assert balance.balanced_weights(df, "y").agg(F.min("weight"), F.max("weight")).first() == (1.0, 1.0)
    assert balance.scale_pos_weight(df, "y", 5) == 11_999.0


def test_rules_of_long_itemsets(spark):
    from minekit.operators import rules

    names = [f"i{n:02d}" for n in range(33)]
    sets = [(names, 50)] + [([x for x in names if x != y], 50 if y < "i02" else 200) for y in names] + [([n], 60) for n in names]
    sets += [(names[2:], 50)]
    table = spark.createDataFrame([(s, f, f / 1000, len(s)) for s, f in sets], "items array<string>, freq long, support double, n_items int")
    found = rules.association_rules(table, "confidence", 0.9)
    assert sorted((len(r.antecedents), tuple(r.consequents)) for r in found.select("antecedents", "consequents").collect()) == [
        (31, ("i00",)), (31, ("i01",)), (32, ("i00",)), (32, ("i01",))]


def test_rules_grow_to_the_same_ones_that_masks_list(spark, monkeypatch):
    import random

    from minekit.operators import rules

    draw = random.Random(4)
    baskets = spark.createDataFrame([(i, sorted(draw.sample("abcdef", draw.randint(2, 6)))) for i in range(60)], "tx int, items array<string>")
    sets = rules.frequent_itemsets(baskets, 0.05)
    got = []
    for most in (rules.MASK_ITEMS, 2):
        monkeypatch.setattr(rules, "MASK_ITEMS", most)
        got.append(sorted(map(str, rules.association_rules(sets, "confidence", 0.6).collect())))
    assert got[0] == got[1] and len(got[0]) > 50


def _series(spark):
    import math

    wave = [(k, d, 10 + d * 0.3 + 4 * math.sin(d * (1.3 if k == "a" else 0.7)) + d % 5) for k in "ab" for d in range(40)]
    rows_ = [(k, d, v) for k, d, v in wave] + [("short", d, 1.0 + d) for d in range(5)] + [("one", 0, 3.0)]
    return spark.createDataFrame(rows_, "k string, d int, v double").withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))


def test_short_series_get_null_forecasts(spark):
    from minekit.operators import timeseries

    df = _series(spark)
    for out in (timeseries.holt_winters(df, "d", "v", ["k"], 7, 4), timeseries.arima(df, "d", "v", ["k"], (1, 1, 1), 4),
                timeseries.lag_forecast(df, "d", "v", 7, 4, ["k"])):
        found = out.groupBy("k").agg(F.count("*").alias("n"), F.count("forecast").alias("known")).collect()
        assert {r.k: r.n for r in found} == {"a": 4, "b": 4, "short": 4, "one": 4}
        assert {r.k for r in found if r.known == 4} >= {"a", "b"} and {r.k: r.known for r in found}["one"] == 0


def test_backtests_equal_one_fit_per_fold(spark):
    from minekit.operators import timeseries

    df = _series(spark)
    got = timeseries.backtest_predictions(df, "d", "v", ["k"], 2, 5, lags=3, period=4, orders=((1, 1, 0),)).collect()
    assert {r.fold for r in got if r.k in "ab"} == {0, 1}
    for fold, cut in ((0, 30), (1, 35)):
        train = df.filter(f"k = 'a' and d < date_add(date'2024-01-01', {cut})")
        for model, ahead in (("HoltWinters_4", timeseries.holt_winters(train, "d", "v", ["k"], 4, 5)),
                             ("ARIMA_110", timeseries.arima(train, "d", "v", ["k"], (1, 1, 0), 5))):
            want = [round(r.forecast, 6) for r in ahead.orderBy("step").collect()]
            mine = sorted((r.d, round(r.prediction, 6)) for r in got if (r.k, r.fold, r.model) == ("a", fold, model))
            assert [p for _, p in mine] == want


def test_ranking_is_by_the_folds(spark):
    from minekit.operators import timeseries

    table = timeseries.ranking(_series(spark), "d", "v", ["k"], 2, 5, lags=3, period=4, orders=((1, 1, 0),)).collect()
    for k in "ab":
        own = sorted((r for r in table if r.k == k), key=lambda r: r["rank"])
        assert len(own) == 4 and own[0].model == own[0].best_model
        assert [r.CV_RMSE for r in own] == sorted(r.CV_RMSE for r in own)
