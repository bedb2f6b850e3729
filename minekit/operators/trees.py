"""Histogram regression trees for many groups at once: one tree, a boosted sum, or a bagged mean per group.

All groups (series, folds, trees of a forest) grow level by level together. A level is one grouped sum over
(group, node, feature, bin): only bin totals leave a task, so neither the number of groups nor the size of one sets the
number of jobs or what a task holds. Bins are of equal width between a group's least and greatest value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.bounds import attach, complete_rows, join_facts, pinned
from . import reshape

def _bins(xs: Sequence[Column], bins: int, bounds: Column) -> Column:
    """Bin numbers of the features of a row, given (lo, hi); values beyond a bound fall into the last bin there."""
    def bin_of(i: int, x: Column) -> Column:
        low, high = bounds.lo[i], bounds.hi[i]
        at = F.floor(F.try_divide(x - low, high - low) * bins)
        return F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.coalesce(at, F.lit(0)))).cast("int")

    return F.array(*[bin_of(i, x) for i, x in enumerate(xs)])


def _place(tree: Column, bins: Column, depth: int) -> Column:
    """The node where a row ends: node n has children 2n and 2n + 1; a node without a split is a leaf."""
    def step(node: Column, _: Column) -> Column:
        cut = F.try_element_at(tree, node)
        return F.when(cut.isNull(), node).otherwise(node * 2 + (F.get(bins, cut.feature) > cut.bin).cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), step)


def _grow(rows: DataFrame, by: Sequence[str], depth: int, min_leaf: int) -> DataFrame:
    """(by, splits, leaves) of one tree per group, from rows of `by` (names that begin with `_`, or `tree`), `bins`,
    `target` and `weight`.

    A split needs `min_leaf` rows on either side and a gain; equal gains go to the first feature, then the least bin.
    """
    by = list(by)
    splits = None
    for level in range(depth):
        if level == 0:
            placed = rows.withColumn("node", F.lit(1))
        else:
            placed = attach(rows, splits, by, "left").withColumn("node", _place(F.col("splits"), F.col("bins"), level)).drop("splits")
            placed = placed.where(F.col("node") >= 2**level)  # rows in earlier leaves are done
        sums = (F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("target")).alias("s"))
        cells = placed.select(*by, "node", "target", "weight", F.posexplode("bins").alias("feature", "bin"))
        hist = cells.groupBy(*by, "node", "feature", "bin").agg(*sums)
        node = Window.partitionBy(*by, "node", "feature")  # at most one row per bin
        left = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        cut = hist.select(
            *by, "node", "feature", "bin", F.sum("n").over(left).alias("nl"), F.sum("s").over(left).alias("sl"),
            F.sum("n").over(node).alias("n"), F.sum("s").over(node).alias("s"))
        cut = cut.where((F.col("nl") >= min_leaf) & (F.col("n") - F.col("nl") >= min_leaf) & (F.col("nl") < F.col("n")))
        gain = F.expr("sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n")
        cut = cut.withColumn("gain", _significant(gain)).where("gain > 0")
        best = cut.groupBy(*by, "node").agg(F.max_by(F.struct("feature", "bin"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("cut"))
        found = best.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("node", "cut"))).alias("more"))
        if splits is None:
            # Every group has a tree, if only a leaf.
            splits = join_facts(rows.groupBy(*by).agg(F.count("*").alias("rows")), found, by, "left")
            none = F.expr("CAST(map() AS map<int,struct<feature:int,bin:int>>)")
            splits = splits.select(*by, F.coalesce("more", none).alias("splits"))
        else:
            splits = join_facts(splits, found, by, "left")
            splits = splits.select(*by, F.when(F.col("more").isNull(), F.col("splits")).otherwise(F.map_concat("splits", "more")).alias("splits"))
        splits = pinned(splits)
    placed = attach(rows, splits, by, "left").withColumn("node", _place(F.col("splits"), F.col("bins"), depth))
    leaf = placed.groupBy(*by, "node").agg((F.sum(F.col("weight") * F.col("target")) / F.sum("weight")).alias("value"))
    leaves = leaf.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("node", "value"))).alias("leaves"))
    return pinned(join_facts(splits, leaves, by, "left"))


def _significant(gain: Column) -> Column:
    """The gain, rounded so that sums taken in another order choose the same split; mere rounding error counts as none."""
    return F.when(gain > F.expr("(s * s / n + sl * sl / nl) * 1e-12"), F.round(gain, 6)).otherwise(F.lit(0.0))


def _value(tree: Column, bins: Column, depth: int) -> Column:
    return F.try_element_at(tree.leaves, _place(tree.splits, bins, depth))


def _poisson(key: Column, tree: Column) -> Column:
    """How often a row is drawn for a tree: Poisson with mean one, by a hash of its identity."""
    share = F.pmod(F.xxhash64(key, tree), F.lit(1 << 53)) / F.lit(float(1 << 53))
    bounds, total, term = [], 0.0, 0.36787944117144233
    for k in range(12):
        total += term
        bounds.append(total)
        term /= k + 1
    return sum(((share >= b).cast("int") for b in bounds), F.lit(0)).cast("double")


def fit(
    df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (), kind: str = "tree", depth: int = 3, bins: int = 32,
    min_leaf: int = 1, rounds: int = 20, rate: float = 0.1, key: Sequence[str] = (),
) -> DataFrame:
    """(by, _model) per group. `kind` is `tree`, `boosted` (each of `rounds` trees is fitted to what the sum before it
    leaves, shrunk by `rate`) or `forest` (the mean of `rounds` trees on rows drawn with replacement by a hash of
    `key`). Rows with a missing value are left out. Levels and boosting rounds are jobs; groups are not.
    """
    if kind not in ("tree", "boosted", "forest"):
        raise ValueError(f"unknown kind of trees: {kind}")
    xs = list(xs)
    if kind == "forest" and not key:
        raise ValueError("a forest draws rows by a hash of their key: name its columns")
    groups = [f"_k{i}" for i in range(len(by))]  # names of our own, whatever the caller's are
    names = [f"_x{i}" for i in range(len(xs))]
    draw = F.xxhash64(*key) if key else F.lit(0).cast("long")
    rows = complete_rows(df.select(
        *[F.col(c).alias(g) for c, g in zip(by, groups)], F.col(y).cast("double").alias("y"),
        *[F.col(x).cast("double").alias(n) for x, n in zip(xs, names)], draw.alias("key")), ["y", *names])
    bounds = F.struct(F.array(*[F.min(n) for n in names]).alias("lo"), F.array(*[F.max(n) for n in names]).alias("hi"))
    facts = pinned(rows.groupBy(*groups).agg(bounds.alias("bounds"), F.avg("y").alias("mean"), F.count("*").alias("n")).where("n > 0"))
    at = _bins([F.col(n) for n in names], bins, F.col("bounds"))
    placed = pinned(attach(rows, facts, groups).select(*groups, at.alias("bins"), "y", "mean", "key"))
    if kind == "forest":
        each = placed.withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
        drawn = each.withColumn("weight", _poisson(F.col("key"), F.col("tree"))).where("weight > 0").withColumnRenamed("y", "target")
        grown = _grow(drawn.select(*groups, "tree", "bins", "target", "weight"), [*groups, "tree"], depth, min_leaf)
        base, share = F.lit(0.0), 1.0 / rounds
    else:
        base, share = (F.col("mean"), rate) if kind == "boosted" else (F.lit(0.0), 1.0)
        sofar, made = placed.select(*groups, "bins", "y", base.alias("f")), []
        for number in range(1, (rounds if kind == "boosted" else 1) + 1):
            left = sofar.select(*groups, "bins", (F.col("y") - F.col("f")).alias("target"), F.lit(1.0).alias("weight"))
            made.append(_grow(left, groups, depth, min_leaf).withColumn("tree", F.lit(number)))
            if kind == "boosted":
                known = attach(sofar, made[-1].select(*groups, F.struct("splits", "leaves").alias("t")), groups)
                value = F.col("f") + share * _value(F.col("t"), F.col("bins"), depth)
                sofar = pinned(known.select(*groups, "bins", "y", value.alias("f")))
        grown = reshape.stack(made)
    out = join_facts(facts, _listed(grown, groups), groups)
    model = F.struct("bounds", base.alias("base"), F.lit(share).alias("share"), "trees").alias("_model")
    return pinned(out.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], model))


def _listed(grown: DataFrame, by: Sequence[str]) -> DataFrame:
    """The trees of a group in order. (A group's trees are as many as were asked for.)"""
    ordered = F.array_sort(
        F.collect_list(F.struct("tree", "splits", "leaves")), lambda a, b: F.when(a.tree < b.tree, -1).when(a.tree > b.tree, 1).otherwise(0))
    return grown.groupBy(*by).agg(ordered.alias("trees"))


def tree_value(xs: Sequence[Column], bins: int, depth: int) -> Column:
    """The prediction for a row that carries `_model`; null if that or a feature is missing."""
    model = F.col("_model")

    # The bin numbers are bound to a lambda variable, so they are worked out once and not once per tree.
    def total(at: Column) -> Column:
        return F.aggregate(model.trees, F.lit(0.0), lambda sum_, t: sum_ + F.coalesce(_value(t, at, depth), F.lit(0.0)))

    value = model.base + model.share * F.transform(F.array(_bins(xs, bins, model.bounds)), total)[0]
    known = model.isNotNull()
    for x in xs:
        known = known & x.isNotNull()
    return F.when(known, value)


def predict(
    df: DataFrame, models: DataFrame, xs: Sequence[str], by: Sequence[str] = (), depth: int = 3, bins: int = 32, out: str = "prediction",
) -> DataFrame:
    """Add the prediction, with the `depth` and `bins` of the fit; rows of a group without a model, or with a missing
    feature, get a null."""
    carried = attach(df, models, by, "left")
    return carried.withColumn(out, tree_value([F.col(x).cast("double") for x in xs], bins, depth)).drop("_model")
