"""Nearest neighbours over groups of queries and base rows, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.operators import balance
from minekit.plans import neighbours
from minekit.plans.bounds import BROADCAST_ROWS


@pytest.fixture
def groups(spark, monkeypatch):
    """Groups and products so small that few rows need many of them."""
    monkeypatch.setattr(neighbours, "QUERY_GROUP", 40)
    monkeypatch.setattr(neighbours, "BASE_GROUP", 60)
    monkeypatch.setattr(neighbours, "_BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbours, "_TILE", (8, 16))
    spark.conf.set(BROADCAST_ROWS, "20")
    yield spark
    spark.conf.unset(BROADCAST_ROWS)


def plain(rows, k):
    """(query, base, rank) by distance, then id; rows that repeat count, a row of the same id does not."""
    out = []
    for query in {i for i, _ in rows}:
        found = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for i, v in rows if i == query for j, w in rows if j != i)
        out += [(query, j, r + 1) for r, (_, j) in enumerate(found[:k])]
    return sorted(out)


def found(spark, rows, k, kind="double"):
    df = spark.createDataFrame(rows, f"id long, v array<{kind}>").repartition(3)
    return sorted(tuple(r) for r in neighbours.nearest(df, df, k, "id", "v").select("query_id", "base_id", "rank").collect())


@pytest.mark.parametrize("kind", ["double", "float"])
def test_groups_equal_brute_force(groups, kind):
    points = np.random.default_rng(1).normal(size=(250, 5)).astype("float32").astype(float)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    assert found(groups, rows, 4, kind) == plain(rows, 4)


def test_close_rows_far_from_the_origin_are_told_apart(groups):
    draw = np.random.default_rng(2)
    rows = [(i, (1e6 + 1e-3 * p).tolist()) for i, p in enumerate(draw.normal(size=(150, 6)))]
    assert found(groups, rows, 3) == plain(rows, 3)


@pytest.mark.parametrize("bound", ["20", "1000"])
def test_repeated_rows_and_copies(groups, bound):
    groups.conf.set(BROADCAST_ROWS, bound)
    draw = np.random.default_rng(3)
    rows = [(i, draw.integers(0, 3, 2).astype(float).tolist()) for i in range(90)]
    rows += rows[10:25] + [(7, [9.0, 9.0]), (8, [9.0, 9.0])]
    assert found(groups, rows, 5) == plain(rows, 5)


def test_a_small_base_is_searched_by_all_cores(spark):
    many = spark.range(100).coalesce(1).select("id", F.array(F.col("id") * 1.0).alias("v"))
    few = many.filter("id < 20")
    asked = neighbours.nearest(many, few, 1, "id", "v")
    assert asked.filter("query_id = 57").collect()[0]["base_id"] == 19
    plan = asked._jdf.queryExecution().toString()
    assert "Repartition" in plan


def test_copies_of_a_base_row_are_left_out_before_they_meet(groups, monkeypatch):
    met = []
    monkeypatch.setattr(neighbours, "packed", lambda rows, n, real=neighbours.packed: met.append(rows.count()) or real(rows, n))
    rows = [(i, [1.0, 2.0]) for i in range(200)] + [(200 + i, [float(i), 0.0]) for i in range(30)]
    assert found(groups, rows, 2) == plain(rows, 2)
    assert met == [230, 33]


def test_vectors_must_be_equally_long(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, v array<double>")
    with pytest.raises(Exception, match="equally long"):
        neighbours.matrix_of(df.toArrow().column("v").combine_chunks())


def test_links_over_groups_equal_those_of_a_small_table(groups):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=3).tolist(), int(i % 3 == 0)) for i in range(200)]
    df = groups.createDataFrame(rows, "id long, v array<double>, label int")
    got = {tuple(r) for r in balance.tomek_links(df, "id", "label", "v").collect()}
    groups.conf.unset(BROADCAST_ROWS)
    assert got == {tuple(r) for r in balance.tomek_links(df, "id", "label", "v").collect()} != set()
