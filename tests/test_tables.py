"""Cleaning, profiling, encoding and reshaping on small tables."""

import math
from urllib.parse import urljoin

import numpy as np
import pytest
from table_data import DATA, rows
from pyspark.sql import functions as F

from minekit.functions import text
from minekit.operators import clean, encode, products, profile, reshape
from minekit.sources import readers, writers


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr(F.col("c"))).first()[0]


def test_links_resolve_like_the_standard_library(spark):
    bases = ["http://a.com/b/c/d?q=1#f", "http://a.com", "https://x.org/p/", "http://a.com/b"]
    hrefs = ["e", "/e/f", "//h.com/z", "http://k.com/x", "?y=1", "#top", "../g", "./h", "../../../i", "e/../f?x=/../y", "", "mailto:a@b.c", "..", "a/."]
    pairs = [(b, h) for b in bases for h in hrefs]
    df = spark.createDataFrame(pairs, "b string, h string")
    got = {(r.b, r.h): r.u for r in df.select("b", "h", text.absolute_url(F.col("b"), F.col("h")).alias("u")).collect()}
    assert got == {(b, h): urljoin(b, h) for b, h in pairs}


@pytest.mark.parametrize("value,options,want", [
    ("$ 1,234.50", {}, 1234.5), ("1.234,50 €", {"decimal": ",", "thousands": "."}, 1234.5), ("-7", {}, -7.0),
    ("-7", {"keep_sign": False}, 7.0), ("none", {}, None), ("1-2", {}, None),
])
def test_number_from_text(spark, value, options, want):
    assert one(spark, value, lambda c: text.number_from_text(c, **options)) == want


def test_text_helpers(spark):
    assert one(spark, ' "A  b\'\n c" ', lambda c: text.clean_text(c, lower=True)) == "a b c"
    assert one(spark, "  Hola, Señor! ", text.slugify) == "hola_señor"
    assert one(spark, None, text.slugify) == "na"
    assert one(spark, "$1,049.50", text.safe_float) == 1049.5
    assert one(spark, "14 reviews", text.safe_int) == 14
    assert one(spark, "no", text.safe_int) is None
    assert one(spark, " a, ,b ,", text.list_items) == ["a", "b"]


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], [' "Price (USD)" ', "a--b"])
    assert clean.slugify_header(df).columns == ["price_usd", "a_b"]
    assert clean.strip_header_quotes(df).columns == ["Price (USD)", "a--b"]


def test_csv_modes_and_index_column(spark, tmp_path):
    df = spark.createDataFrame([(0, "x", 1.5), (1, "y", float("nan"))], ["Unnamed: 0", "name", "value"])
    writers.write_csv(df, str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c"))
    assert back.columns == ["name", "value"] and rows(back.select("name")) == [("x",), ("y",)]
    assert back.filter("value is null").count() == 1
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(tmp_path / "c"), mode=3)


def test_missing_csv_is_empty(spark, tmp_path):
    assert readers.read_csv_or_empty(spark, str(tmp_path / "none"), spark.range(1).schema).count() == 0


def test_bundle_counts_rows(spark, tmp_path):
    made = writers.write_bundle(spark, str(tmp_path / "b"), {"a": spark.range(5), "b": spark.range(3)}, {"random_state": 42})
    assert made["row_counts"] == {"a": 5, "b": 3}
    opened = readers.read_bundle(spark, str(tmp_path / "b" / "manifest.json"))
    assert {n: d.count() for n, d in opened.items()} == {"a": 5, "b": 3}


def test_dates_in_several_formats(spark):
    df = spark.createDataFrame([("2019-03-02",), ("03/03/2019",), ("soon",)], "d string")
    got = [str(r[0]) for r in clean.to_datetime(df, ["d"], ["dd/MM/yyyy"]).collect()]
    assert got == ["2019-03-02 00:00:00", "2019-03-03 00:00:00", "None"]
    assert encode.date_like_columns(df, threshold=0.3) == ["d"] and encode.date_like_columns(df) == []


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="zz"):
        clean.to_number(spark.range(1), ["zz"])


def test_binary_remap_rejects_other_values(spark):
    df = spark.createDataFrame([(-1,), (1,)], "t int")
    assert rows(clean.remap_binary_target(df, "t")) == [(0,), (1,)]
    with pytest.raises(ValueError):
        clean.remap_binary_target(spark.createDataFrame([(-1,), (2,)], "t int"), "t")


def test_label_codes(spark):
    coded, table = encode.encode_labels(spark.createDataFrame([("b",), ("a",), (None,)], "t string"), "t")
    assert {(r.t, r.label) for r in coded.collect()} == {("b", 1.0), ("a", 0.0), (None, None)}
    assert rows(table) == [("a", 0.0), ("b", 1.0)]
    coded, _ = encode.encode_labels(spark.createDataFrame([(5,), (9,)], "t int"), "t")
    assert rows(coded.select("t", "label")) == [(5, 0.0), (9, 1.0)]
    assert encode.positive_label(coded, "t") == 9 and encode.positive_label(coded, "t", 5) == 5


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (6.0, None), (None, "b"), (None, "a")], "x double, s string")
    assert clean.fill_statistics(df, "mean")["x"] == 3.0
    assert clean.fill_statistics(df, "median")["x"] == 2.0
    assert clean.fill_statistics(df, "mode") == {"x": 1.0, "s": "a"}
    assert rows(clean.impute_for_model(df).filter("s = 'Unknown'")) == [(6.0, "Unknown")]


def test_constant_column_has_no_correlation(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("a"), F.lit(3.0).alias("b"))
    assert {(r.column_a, r.column_b): r.r for r in profile.correlations(df).collect()}[("a", "b")] is None


def test_describe_both_paths(tight):
    df = tight.read.parquet(f"{DATA}/part.parquet").select("p_size", "p_retailprice")
    large = rows(profile.describe(df))
    tight.conf.unset("spark.minekit.maxGroupRows")
    plain = rows(profile.describe(df))
    assert [r[0] for r in large] == [r[0] for r in plain]
    assert np.allclose([r[1:] for r in large], [r[1:] for r in plain])


def test_histogram_counts_like_numpy(spark):
    values = [float(v * v % 97) for v in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.bin: r["count"] for r in profile.histogram(df, "v", 8).collect()}
    want = np.histogram(values, 8)[0]
    assert [got.get(i, 0) for i in range(8)] == want.tolist()


def test_segments_are_right_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "price double")
    cut, edges = encode.quantile_segments(df, "price")
    assert np.allclose(edges, [33.67, 66.34])
    assert {r[0]: r[1] for r in cut.groupBy("price_segment").count().collect()} == {"Budget": 33, "MidRange": 33, "Premium": 34}


def test_one_hot_names_and_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    out = encode.one_hot(df, drop_first=False)
    assert out.columns == ["id", "c_a", "c_b"] and rows(out) == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]
    assert encode.one_hot(df).columns == ["id", "c_b"]
    vectors = encode.one_hot_vector(df, ["c"]).select("c_vector").collect()
    assert len(vectors) == 3


def test_keep_first_uses_the_order(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", "x"), (2, "b", "y")], "id int, k string, v string")
    assert rows(clean.drop_duplicates(df, ["k"], ["id"])) == [(1, "a", "x"), (2, "b", "y")]
    with pytest.raises(ValueError):
        clean.drop_duplicates(df, ["k"])


def test_product_text(spark):
    raw = spark.createDataFrame([
        ("Asus VivoBook 15", '15.6", Core i5, 8GB RAM, 256GB SSD', "$1,049.50", "3", "14 reviews"),
        ("packard-bell X", "Ryzen  5, 1 TB hdd", "$99", None, None), (None, "Pentium", "$5", "1", "0 reviews"),
    ], "title string, description string, price_text string, rating_text string, reviews_text string")
    kept = ["brand", "ram_gb", "storage_gb", "storage_type", "screen_inches", "cpu_family", "storage_bucket", "rating_bucket", "price", "reviews_count"]
    got = {r.price: tuple(r) for r in products.features(raw).select(*kept).collect()}
    # The first size in the text counts as storage, even where it is memory.
    assert got[1049.5] == ("Asus", 8, 8.0, None, 15.6, "I5", "<=128GB", "Medium", 1049.5, 14)
    assert got[99.0] == ("Packard-Bell", None, 1024.0, "HDD", None, "RYZEN 5", "513GB-1TB", "Unknown", 99.0, None)
    assert got[5.0][0] == "Unknown"


def test_gap_labels(spark):
    def label(step):
        df = spark.range(5).select((F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * step)).alias("t"))
        return profile.frequency(df, "t").first()["frequency"]

    assert [label(s) for s in (60, 86_400, 7 * 86_400, 30 * 86_400, 90 * 86_400)] == ["Horaria", "Diaria", "Semanal", "Mensual", "90 days 00:00:00"]


def test_upsert_and_best(spark):
    base = spark.createDataFrame([("a", 0.5), ("b", 0.7)], "m string, acc double")
    new = spark.createDataFrame([("a", 0.9)], "m string, acc double")
    merged = reshape.upsert_rows(base, new, "m", "acc")
    assert [tuple(r) for r in merged.collect()] == [("a", 0.9), ("b", 0.7)]
    assert reshape.pick_best(merged, "m", "acc", higher=False).first()["m"] == "b"
    assert reshape.best_metric(merged.withColumn("f1", F.lit(None).cast("double")), ["f1", "acc"]) == "acc"


def test_metric_table_drops_empty_columns(spark):
    df = spark.createDataFrame([("m", "0.5", "None", math.inf)], "name string, acc string, auc string, f1 double")
    assert clean.tidy_metric_table(df, ["acc", "auc", "f1"], ["acc"]).columns == ["acc", "name"]
