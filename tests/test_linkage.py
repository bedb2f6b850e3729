"""Spanning trees, single linkage and merged clustering features against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from minekit.operators import unsupervised
from minekit.plans import spanning
from minekit.plans.bounds import BROADCAST_ROWS


def plain_tree(points):
    edges = sorted((float(np.sqrt(((a - b) ** 2).sum())), i + 1, j + 1) for i, a in enumerate(points) for j, b in enumerate(points) if i < j)
    root = list(range(len(points) + 1))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    kept = []
    for d, a, b in edges:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b, d))
    return kept


def points_of(kind):
    draw = np.random.default_rng(8)
    if kind == "grid":  # many equal distances
        return np.array([(x, y) for x in range(9) for y in range(9)], dtype=float)
    if kind == "copies":
        return np.repeat(draw.normal(size=(20, 2)), 6, axis=0)
    return np.vstack([draw.normal(size=(60, 3)) * 0.3 + c for c in ([0, 0, 0], [5, 0, 0], [0, 9, 0])])


def frame(spark, points):
    order = list(range(len(points)))
    random.Random(1).shuffle(order)
    return spark.createDataFrame([(i + 1, points[i].tolist()) for i in order], "id long, v array<double>").repartition(4)


@pytest.mark.parametrize("kind", ["clouds", "grid", "copies"])
@pytest.mark.parametrize("bound", [None, "20"])
def test_spanning_tree_equals_brute_force(spark, monkeypatch, kind, bound):
    monkeypatch.setattr(spanning, "BLOCK", 15)
    points = points_of(kind)
    if bound:
        spark.conf.set(BROADCAST_ROWS, bound)
    try:
        found = sorted(tuple(r) for r in spanning.spanning_tree(frame(spark, points)).collect())
    finally:
        spark.conf.unset(BROADCAST_ROWS)
    want = sorted(plain_tree(points))
    assert [e[:2] for e in found] == [e[:2] for e in want]
    assert [e[2] for e in found] == pytest.approx([e[2] for e in want])


def test_far_blocks_do_not_meet(spark):
    draw = np.random.default_rng(2)
    facts = [{"at": (i, 0), "centre": [100.0 * i, 0.0], "radius": 1.0, "point": [100.0 * i, 0.0], "longest": 0.5} for i in range(12)]
    pairs = spanning._near_pairs(facts)
    assert {(a[0], b[0]) for a, b in pairs} == {(i, i + 1) for i in range(11)}


def test_no_point_and_one_point_have_no_edge(spark):
    one = frame(spark, np.array([[1.0, 2.0]]))
    assert spanning.spanning_tree(one).count() == 0
    assert spanning.spanning_tree(one.where("false")).count() == 0
    assert [r.prediction for r in unsupervised.single_linkage(one, ["id"], "v", 3).collect()] == [0]


def plain_cut(points, k):
    """Single linkage by hand: clusters merge along the tree's edges but the last k - 1."""
    kept = sorted(plain_tree(points), key=lambda e: (e[2], e[0], e[1]))[: len(points) - k]
    label = {i + 1: i + 1 for i in range(len(points))}
    for a, b, _ in kept:
        low, high = sorted((label[a], label[b]))
        label = {i: low if c == high else c for i, c in label.items()}
    numbers = {c: n for n, c in enumerate(sorted(set(label.values())))}
    return {i: numbers[c] for i, c in label.items()}


@pytest.mark.parametrize("k", [1, 3, 7])
def test_single_linkage_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(spanning, "BLOCK", 25)
    points = points_of("clouds")
    df = frame(spark, points).withColumn("component", F.lit("kept"))
    found = unsupervised.single_linkage(df, ["id"], "v", k)
    assert {r.id: r.prediction for r in found.collect()} == plain_cut(points, k)
    assert set(found.columns) == {"id", "v", "component", "prediction"}


def test_a_dendrogram_has_a_merge_less_than_rows(spark):
    merges = unsupervised.dendrogram(frame(spark, points_of("clouds")), ["id"], "v").orderBy(F.desc("height")).collect()
    assert len(merges) == 179
    assert merges[1].height > 3 > merges[2].height


def plain_linkage(points, k, kind):
    clusters = [[i] for i in range(len(points))]

    def apart(a, b):
        d = np.sqrt(((points[a][:, None] - points[b][None, :]) ** 2).sum(2))
        if kind == "ward":
            gap = ((points[a].mean(0) - points[b].mean(0)) ** 2).sum()
            return np.sqrt(2 * len(a) * len(b) / (len(a) + len(b)) * gap)
        return {"average": d.mean(), "complete": d.max(), "single": d.min()}[kind]

    while len(clusters) > k:
        i, j = min(((i, j) for i in range(len(clusters)) for j in range(i)), key=lambda p: apart(clusters[p[0]], clusters[p[1]]))
        clusters[j] += clusters.pop(i)
    return {frozenset(c) for c in clusters}


@pytest.mark.parametrize("kind", unsupervised.LINKAGES)
def test_merged_features_equal_brute_force(kind):
    points = np.random.default_rng(4).normal(size=(30, 2))
    found = unsupervised.agglomerate(points, np.ones(30), 5, kind)
    groups = {frozenset(i for i, c in enumerate(found) if c == n) for n in range(5)}
    assert groups == plain_linkage(points, 5, kind)


@pytest.mark.parametrize("kind", unsupervised.LINKAGES)
def test_linkages_find_apart_clouds(spark, kind):
    found = unsupervised.linkage(frame(spark, points_of("clouds")), ["id"], "v", 3, kind, micro=40).collect()
    clouds = {}
    for r in found:
        clouds.setdefault((r.id - 1) // 60, set()).add(r.prediction)
    assert len(found) == 180 and sorted(map(tuple, clouds.values())) == [(0,), (1,), (2,)]
