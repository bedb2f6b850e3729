"""Paths for large groups must give what the plain ones give, and what brute force gives."""

import numpy as np
import pytest
from table_data import DATA, rows
from pyspark.sql import Window, functions as F

from minekit.plans import neighbours
from minekit.plans.bounds import BROADCAST_ROWS, GROUP_ROWS, attach, complete_rows, has_large_group, small_rows
from minekit.plans.hashing import slice_by_rank
from minekit.plans.ordering import lagged, row_numbers, running_sums
from minekit.plans.quantiles import quantiles


@pytest.fixture
def skewed(spark):
    """One key holds a third of the rows, and one key is null."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    return spark.range(600).select("id", key.alias("key"), ((F.col("id") * 37) % 101).cast("double").alias("v"))


def test_large_group_is_noticed(tight, skewed):
    assert has_large_group(skewed, ["key"])


def test_running_sums_match_window(tight, skewed):
    got = rows(running_sums(skewed, ["key"], ["id"], {"s": F.col("v"), "n": F.lit(1)}).select("id", "s", "n"))
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    assert got == rows(skewed.select("id", F.sum("v").over(w), F.sum(F.lit(1)).over(w)))


def test_row_numbers_without_keys(tight, skewed):
    assert [n for _, n in rows(row_numbers(skewed, [], ["id"], "n").select("id", "n"))] == list(range(1, 601))


def test_lags_cross_run_ends(tight, skewed):
    got = rows(lagged(skewed, ["key"], ["id"], {"a": ("v", 1), "b": ("v", 5)}).select("id", F.coalesce("a", F.lit(-1.0)), F.coalesce("b", F.lit(-1.0))))
    w = Window.partitionBy("key").orderBy("id")
    want = rows(skewed.select("id", F.coalesce(F.lag("v", 1).over(w), F.lit(-1.0)), F.coalesce(F.lag("v", 5).over(w), F.lit(-1.0))))
    assert got == want


@pytest.mark.parametrize("by", [["key"], []])
def test_slices_match_ranks(tight, skewed, by):
    cut = lambda n: [F.lit(0), F.round(n * 0.25), F.ceil(n * 0.5), F.ceil(n * 0.5), n]
    large = rows(slice_by_rank(skewed, ["id"], 5, by, cut, "part").select("id", "part"))
    tight.conf.set(GROUP_ROWS, "100000")
    assert large == rows(slice_by_rank(skewed, ["id"], 5, by, cut, "part").select("id", "part"))
    assert {p for _, p in large} == {1, 2, 4}


@pytest.mark.parametrize("by", [["key"], []])
def test_quantiles_match_numpy(tight, skewed, by):
    probs = [0.0, 0.25, 0.33, 0.5, 0.9, 1.0]
    holed = skewed.withColumn("v", F.when(F.col("id") % 11 != 0, F.col("v"))).withColumn("none", F.lit(None).cast("double"))
    table = holed.toPandas()
    for r in quantiles(holed, ["v", "none"], probs, by).collect():
        part = table if not by else table[table["key"].isna()] if r["key"] is None else table[table["key"] == r["key"]]
        assert np.allclose(r["v"], np.quantile(part["v"].dropna(), probs))
        assert r["none"] is None


def test_quantiles_of_one_repeated_value(tight):
    same = tight.range(500).select(F.lit(7.0).alias("v"))
    assert quantiles(same, ["v"], [0.1, 0.5]).first()["v"] == [7.0, 7.0]


def test_attach_beyond_the_broadcast_bound(tight, skewed):
    facts = skewed.groupBy("key").agg(F.count("*").alias("n"))
    plain = rows(attach(skewed, facts, ["key"]).select("id", "n"))
    tight.conf.set(BROADCAST_ROWS, "2")
    assert small_rows(facts) is None
    assert rows(attach(skewed, facts, ["key"]).select("id", "n")) == plain
    assert len(plain) == 600


def test_nearest_by_cells_matches_brute_force(tight, monkeypatch):
    data = tight.read.parquet(f"{DATA}/embeddings.parquet").filter("vec_id < 200")
    monkeypatch.setattr(neighbours, "_CENTRES", 8)
    monkeypatch.setattr(neighbours, "_BLOCK_ROWS", 25)
    tight.conf.set(BROADCAST_ROWS, "50")
    got = rows(neighbours.nearest(data, data, 4, "vec_id", "embedding").select("query_id", "rank", "base_id"))
    table = data.orderBy("vec_id").toPandas()
    vectors = np.stack(table["embedding"]).astype(float)
    away = np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(-1))
    np.fill_diagonal(away, np.inf)
    want = [(int(table["vec_id"][i]), r + 1, int(table["vec_id"][j])) for i in range(len(vectors)) for r, j in enumerate(np.argsort(away[i])[:4])]
    assert got == sorted(want)


def test_nearest_with_a_crowded_cell(tight, monkeypatch):
    """A third of all points are copies of one."""
    point = F.when(F.col("id") % 3 == 0, F.array(F.lit(0.0), F.lit(0.0))).otherwise(F.array(F.col("id") * 1.0, (F.col("id") * 7 % 13) * 1.0))
    data = tight.range(150).select("id", point.alias("v"))
    plain = rows(neighbours.nearest(data, data, 3, "id", "v").select("query_id", "rank", "base_id"))
    monkeypatch.setattr(neighbours, "_CENTRES", 6)
    monkeypatch.setattr(neighbours, "_BLOCK_ROWS", 10)
    tight.conf.set(BROADCAST_ROWS, "20")
    assert rows(neighbours.nearest(data, data, 3, "id", "v").select("query_id", "rank", "base_id")) == plain
    assert len(plain) == 450


def test_complete_rows_drops_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, y string")
    assert rows(complete_rows(df, ["x", "y"])) == [(1.0, "a")]
