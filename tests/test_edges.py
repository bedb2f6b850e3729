"""Null keys, ties, empty tables and broken markup have defined results."""

import datetime

import pytest
from pyspark.sql import functions as F

from minekit.functions.markup import parse
from minekit.operators import balance, clean, reshape, timeseries, unsupervised


@pytest.mark.parametrize("page", ["<p>a</p><![foo[bar", "<p>a</p><![foo[bar]]>", "<p>a</p><![ [x", "<p>a</p><![", "<p>a</p><![if x]>", "<p>a</p><!x", "<p>a</p><![CDATA[x"])
def test_unknown_marked_sections_are_read_as_comments(page):
    assert [n.text(" ", True) for n in parse(page).select("p")] == ["a"]


def test_text_after_a_marked_section_is_read():
    assert [n.text(" ", True) for n in parse("<p>a</p><![foo[bar]]><p>b</p>").select("p")] == ["a", "b"]


def series(spark, rows):
    made = [(k, datetime.date(2024, 1, d), float(v)) for k, d, v in rows]
    return spark.createDataFrame(made, "k string, day date, v double")


def test_a_series_with_a_null_key_misses_only_its_gaps(spark):
    df = series(spark, [(None, 1, 1), (None, 2, 1), (None, 4, 1), ("a", 1, 1), ("a", 2, 1)])
    found = reshape.missing_dates(df, "day", ["k"]).collect()
    assert [(r.k, r.day.day) for r in found] == [(None, 3)]


def test_holdout_predictions_keep_null_keys_and_tied_times(spark):
    rows = [(None, d, d + (d % 3)) for d in range(1, 31)] + [("a", d, 2 * d + d % 2) for d in range(1, 31)]
    plain = series(spark, rows)
    found = timeseries.holdout_predictions(plain, "day", "v", ["k"], 5, 3, 3, [(1, 1, 0)])
    counts = {(r.model, r.k): r["count"] for r in found.where("prediction is not null").groupBy("model", "k").count().collect()}
    assert len(counts) == 8 and set(counts.values()) == {5}
    tied = series(spark, [("a", (d + 1) // 2, d + d % 3) for d in range(1, 31)])
    found = timeseries.holdout_predictions(tied, "day", "v", ["k"], 6, 3, 3, [(1, 1, 0)])
    assert {r["count"] for r in found.groupBy("model").count().collect()} == {6}
    assert {r["count"] for r in found.where("prediction is not null").groupBy("model").count().collect()} == {6}


def test_tied_first_rows_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([("a", 1, v) for v in (7, 3, 5, 9, 4, 6, 8, 2)], "k string, t int, v int")
    for n in (1, 3, 5, 8):
        kept = clean.drop_duplicates(df.repartition(n), ["k"], ["t"]).collect()
        assert [tuple(r) for r in kept] == [("a", 1, 2)]


def test_modes_of_all_columns_come_from_one_count(spark):
    rows = [(1, 10, "x", 1.5, True, datetime.date(2024, 1, 2)), (2, 9, "y", 2.5, None, datetime.date(2024, 1, 1)),
            (None, 10, None, None, False, None), (None, 9, None, float(2.5), False, None)]
    df = spark.createDataFrame(rows, "a long, b int, c string, d double, e boolean, f date")
    got = clean.fill_statistics(df, "mode")
    assert got == {"a": 1, "b": 9, "c": "x", "d": 2.5, "e": False, "f": datetime.date(2024, 1, 1)}
    filled = clean.impute(df, "mode")
    assert filled.schema == df.schema or [f.dataType for f in filled.schema] == [f.dataType for f in df.schema]
    assert clean.fill_statistics(df.where("false"), "mode") == {}


def test_a_target_of_many_values_is_refused_for_what_it_holds(spark):
    many = spark.range(3000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(1).cast("int").alias("t"))
    assert {r.t for r in clean.remap_binary_target(many, "t").distinct().collect()} == {0, 1}
    with pytest.raises(ValueError):
        clean.remap_binary_target(spark.range(3000).withColumnRenamed("id", "t"), "t")


def test_empty_tables_have_empty_results(spark):
    none = spark.createDataFrame([], "id long, label int, v array<double>")
    assert balance.near_miss(none, "id", "label", "v").count() == 0
    assert balance.oversample(none, ["id"], "label").count() == 0
    assert balance.smote(none, "id", "label", "v").count() == 0
    assert balance.tomek_links(none, "id", "label", "v").count() == 0
    vectors = unsupervised.scaled_vectors(none, "v")
    for kind in (unsupervised.k_means, unsupervised.hierarchical):
        labelled, report = kind(vectors, 3)
        assert labelled.count() == 0 and "prediction" in labelled.columns
        assert [tuple(r) for r in report.collect()] == [(3, None, None)]
    made = unsupervised.principal_components(vectors, 2, ["a"])
    assert made.scores.count() == 0 and made.variance_table().count() == 0
    assert unsupervised.linkage(none, ["id"], "v", 2).count() == 0
    assert unsupervised.single_linkage(none, ["id"], "v", 2).count() == 0
