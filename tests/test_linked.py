"""Single-linkage clusters from cells and from packed groups, against the tree cut by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.operators import unsupervised
from minekit.plans import linked


def plain(points, height):
    """Least row of each component of points within `height` of each other."""
    label = np.arange(len(points))
    away = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) <= height
    while True:
        least = np.where(away, label[None, :], len(points)).min(1)
        if (least == label).all():
            return label.tolist()
        label = least


def frame(spark, points):
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, v array<double>").repartition(3)


def labels(df):
    return [r.component for r in df.orderBy("id").collect()]


def lines(width):
    """Rows of close points on lines further apart, with copies."""
    draw = np.random.default_rng(4)
    points = draw.uniform(0, 3, size=(240, width))
    points[:, -1] = np.round(points[:, -1])
    return np.vstack([points, points[:20]]) - 7.0


@pytest.mark.parametrize("width", [1, 2, 3, 5])
@pytest.mark.parametrize("height", [0.05, 0.3, 0.999, 4.0])
def test_clusters_at_a_height_equal_brute_force(spark, monkeypatch, width, height):
    monkeypatch.setattr(linked, "GROUP", 50)
    monkeypatch.setattr(linked, "_TILE", (16, 32))
    points = lines(width)
    assert labels(linked.clusters_at(frame(spark, points), height)) == plain(points, height)


def test_edges_as_long_as_the_height_count(spark):
    grid = np.array([(x * 0.1, y * 0.1) for x in range(8) for y in range(8)])
    for height in (0.1, float(np.nextafter(0.1, 0))):
        assert labels(linked.clusters_at(frame(spark, grid), height)) == plain(grid, height)
        assert labels(linked._by_groups(frame(spark, grid), height)) == plain(grid, height)


def test_cells_that_no_outermost_points_link(spark, monkeypatch):
    """Two rows of points whose ends are far apart and whose middles are close."""
    monkeypatch.setattr(linked, "GROUP", 7)
    x = np.linspace(-0.45, 0.45, 31)
    points = np.vstack([np.column_stack([x, x**2 * 2]), np.column_stack([x, -0.3 - x**2 * 2])])
    for height in (0.2, 0.31, 0.9):
        assert labels(linked.clusters_at(frame(spark, points), height)) == plain(points, height)


@pytest.mark.parametrize("k", [1, 2, 3, 9])
def test_cut_without_the_tree_equals_the_cut_tree(spark, monkeypatch, k):
    points = np.vstack([np.random.default_rng(6).normal(size=(50, 2)) * 0.3 + c for c in ([0, 0], [5, 0], [0, 9])])
    df = frame(spark, points)
    want = [r.prediction for r in unsupervised.single_linkage(df, ["id"], "v", k).orderBy("id").collect()]
    monkeypatch.setattr(unsupervised, "TREE_ROWS", 0)
    monkeypatch.setattr(unsupervised, "spanning_tree", None)
    assert [r.prediction for r in unsupervised.single_linkage(df, ["id"], "v", k).orderBy("id").collect()] == want


def test_ties_at_the_cut_take_the_tree(spark, monkeypatch):
    df = spark.range(12).select("id", F.array(F.col("id") * 1.0).alias("v"))
    want = [r.prediction for r in unsupervised.single_linkage(df, ["id"], "v", 3).orderBy("id").collect()]
    monkeypatch.setattr(unsupervised, "TREE_ROWS", 0)
    assert [r.prediction for r in unsupervised.single_linkage(df, ["id"], "v", 3).orderBy("id").collect()] == want
    assert want == [0] * 10 + [1, 2]


def test_links_of_dense_groups_are_a_forest(spark):
    points = np.random.default_rng(9).normal(size=(500, 6))
    made = linked._links(np.arange(300), points[:300], np.arange(250, 500), points[250:], 100.0)
    assert len(made) == 499 and set(made["a"]) | set(made["b"]) == set(range(500))
