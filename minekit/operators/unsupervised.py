"""Clustering and principal components on a scaled feature vector."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.bounds import attach, cached, pinned
from ..plans.hashing import shuffle_key
from ..plans.linked import clusters_at, clusters_of
from ..plans.ordering import row_numbers
from ..plans.spanning import boruvka, spanning_tree
from . import profile, reshape


def scaled_vectors(df: DataFrame, array: str, out: str = "features", scale: bool = True) -> DataFrame:
    """Add the array as a vector, centred and divided by the population deviation (nothing to do without rows)."""
    raw = df.withColumn("_raw", array_to_vector(F.col(array).cast("array<double>")))
    n = raw.count() if scale else 0
    if n == 0:
        return raw.withColumnRenamed("_raw", out)
    width = raw.select(F.size(array).alias("d")).first()["d"]
    # MLlib divides by the sample deviation.
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    steps = [
        StandardScaler(inputCol="_raw", outputCol="_sampled", withMean=True, withStd=True),
        ElementwiseProduct(inputCol="_sampled", outputCol=out, scalingVec=Vectors.dense([factor] * width)),
    ]
    return Pipeline(stages=steps).fit(raw).transform(raw).drop("_raw", "_sampled")


def _one_row(df: DataFrame, **values) -> DataFrame:
    typed = ", ".join(f"{k} {'long' if isinstance(v, int) else 'double'}" for k, v in values.items())
    return df.sparkSession.createDataFrame([tuple(values.values())], typed)


def _unlabelled(df: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    return df.withColumn("prediction", F.lit(None).cast("int")), _one_row(df, k=k, silhouette=None, inertia=None)


def silhouette(df: DataFrame, features: str = "features", cluster: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance, in time linear in the rows."""
    rows = df.withColumn(cluster, F.col(cluster).cast("double"))
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster, distanceMeasure="squaredEuclidean").evaluate(rows)


def k_means(
    df: DataFrame, k: int, features: str = "features", seed: int = 42, max_iter: int = 50, init: str = "k-means||",
    n_init: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Rows with `prediction`, and (k, silhouette, inertia) of the best of n_init starts; both are null without rows."""
    if df.isEmpty():
        return _unlabelled(df, k)
    fits = [KMeans(k=k, featuresCol=features, seed=seed + i, maxIter=max_iter, initMode=init).fit(df) for i in range(n_init)]
    model = min(fits, key=lambda m: m.summary.trainingCost)
    labelled = model.transform(df)
    score = silhouette(labelled, features) if k > 1 else None
    return labelled, _one_row(df, k=k, silhouette=score, inertia=float(model.summary.trainingCost))


def hierarchical(df: DataFrame, k: int, features: str = "features", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Divisive hierarchy cut at k leaves; without rows there is no cluster and no figure."""
    if df.isEmpty():
        return _unlabelled(df, k)
    # MLlib splits a cluster around its centre by a share of the centre's length, so centred data is
    # moved away from the origin; distances stay the same.
    moved = df.withColumn("_moved", array_to_vector(F.transform(vector_to_array(features), lambda x: x + 1.0)))
    model = BisectingKMeans(k=k, featuresCol="_moved", seed=seed).fit(moved)
    labelled = model.transform(moved).drop("_moved")
    return labelled, _one_row(df, k=k, silhouette=silhouette(labelled, features), inertia=float(model.summary.trainingCost))


def _numbered(df: DataFrame, ids: Sequence[str], array: str) -> DataFrame:
    """Rows with a unique long `_id`, in the order of `ids`, and the point `_v`."""
    return row_numbers(df, [], list(ids), "_id").withColumn("_v", F.transform(F.col(array), lambda x: x.cast("double")))


def dendrogram(df: DataFrame, ids: Sequence[str], array: str) -> DataFrame:
    """The merges of single linkage: (a, b, height), a row fewer than `df` has, where a and b are numbers of rows in the
    order of `ids` and the merge joins the clusters that hold them. Exact."""
    rows = _numbered(df, ids, array).select(F.col("_id").cast("long").alias("id"), F.col("_v").alias("v"))
    return spanning_tree(rows).withColumnRenamed("d", "height")


#: Up to so many rows the tree is made first and then cut.
TREE_ROWS = 5_000


def single_linkage(df: DataFrame, ids: Sequence[str], array: str, k: int | None = None, height: float | None = None) -> DataFrame:
    """Rows with `prediction`: the clusters of single linkage cut into `k`, or at a height (merges up to it count).

    Exact; of equally long edges those of the later rows are cut first. Clusters are numbered by their first row.
    Beyond `TREE_ROWS` rows the clusters are found without the tree, where a height gives them (see `plans.linked`).
    """
    if (k is None) == (height is None):
        raise ValueError("give either k or height")
    rows = pinned(_numbered(df, ids, array))
    points = rows.select(F.col("_id").cast("long").alias("id"), F.col("_v").alias("v"))
    members = None
    if points.count() > TREE_ROWS:
        members = clusters_of(points, k) if height is None else clusters_at(points, height)
    if members is None:
        tree = spanning_tree(points)
        if height is not None:
            kept = tree.where(F.col("d") <= height)
        else:
            cut = tree.orderBy(F.desc("d"), F.desc("a"), F.desc("b")).limit(max(k - 1, 0)).select(F.col("a").alias("_a"), F.col("b").alias("_b"))
            kept = tree.join(F.broadcast(cut), (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti")
        members = boruvka(kept)[1]
    members = members.select(F.col("id").alias("_member"), F.col("component").alias("_component"))
    labelled = rows.join(members, rows["_id"] == members["_member"], "left").withColumn("_c", F.coalesce("_component", "_id"))
    numbers = row_numbers(labelled.select("_c").distinct(), [], ["_c"], "_n")
    found = attach(labelled, numbers, ["_c"]).withColumn("prediction", (F.col("_n") - 1).cast("int"))
    return found.drop("_id", "_v", "_c", "_n", "_member", "_component")


LINKAGES = ("single", "average", "complete", "ward")


def agglomerate(centres: np.ndarray, sizes: np.ndarray, k: int, linkage: str) -> list[int]:
    """Cluster numbers of a few clustering features (their centres and sizes), merged until `k` are left.

    Distances to a merged cluster follow from those to its parts (Lance and Williams); ties merge the first pair.
    """
    n = len(centres)
    apart = np.sqrt(np.maximum(((centres[:, None] - centres[None, :]) ** 2).sum(2), 0.0))
    size = sizes.astype(float)
    if linkage == "ward":
        apart = apart * np.sqrt(2 * size[:, None] * size[None, :] / (size[:, None] + size[None, :]))
    np.fill_diagonal(apart, np.inf)
    members, alive = {i: [i] for i in range(n)}, np.ones(n, bool)
    for _ in range(max(n - k, 0)):
        i, j = divmod(int(apart.argmin()), n)
        i, j = min(i, j), max(i, j)
        a, b, d = apart[i], apart[j], apart[i, j]
        if linkage == "single":
            merged = np.minimum(a, b)
        elif linkage == "complete":
            merged = np.maximum(a, b)
        elif linkage == "average":
            merged = (size[i] * a + size[j] * b) / (size[i] + size[j])
        else:
            total = size[i] + size[j] + size
            with np.errstate(invalid="ignore"):
                merged = np.sqrt(np.maximum(((size[i] + size) * a**2 + (size[j] + size) * b**2 - size * d**2) / total, 0.0))
        alive[j] = False
        merged[~alive] = np.inf
        merged[i] = np.inf
        apart[i], apart[:, i] = merged, merged
        apart[j], apart[:, j] = np.inf, np.inf
        size[i] += size[j]
        members[i] += members.pop(j)
    number = [0] * n
    for c, (_, held) in enumerate(sorted(members.items())):
        for m in held:
            number[m] = c
    return number


def linkage(
    df: DataFrame, ids: Sequence[str], array: str, k: int, linkage: str = "ward", micro: int = 1000, seed: int = 42
) -> DataFrame:
    """Rows with `prediction`: agglomerative clustering into `k` clusters.

    `single` is exact (see `single_linkage`). For the others every row joins the nearest of `micro` rows drawn by hash;
    size and mean of these groups, which tasks add up, are merged on the driver. So they are exact up to `micro` rows
    (a parameter that bounds what the driver holds), and beyond that merge groups instead of rows.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"unknown linkage: {linkage}")
    if linkage == "single":
        return single_linkage(df, ids, array, k)
    rows = pinned(_numbered(df, ids, array))
    drawn = rows.orderBy(shuffle_key(["_id"], seed)).limit(micro).orderBy("_id").select("_v").collect()
    if not drawn:
        return df.withColumn("prediction", F.lit(None).cast("int"))
    points = np.array([r["_v"] for r in drawn], dtype=float)

    @F.pandas_udf("int")
    def nearest_of(v: pd.Series) -> pd.Series:
        return pd.Series([int(((points - np.asarray(p, dtype=float)) ** 2).sum(1).argmin()) for p in v], dtype="int32")

    placed = pinned(rows.withColumn("_cell", nearest_of("_v")))
    sums = placed.groupBy("_cell").agg(
        F.count("*").alias("n"), F.array(*[F.avg(F.col("_v")[i]) for i in range(points.shape[1])]).alias("mean"))
    features = sorted(sums.collect(), key=lambda r: r["_cell"])  # at most `micro` rows
    found = agglomerate(np.array([r["mean"] for r in features], dtype=float), np.array([r["n"] for r in features]), k, linkage)
    named = df.sparkSession.createDataFrame([(r["_cell"], c) for r, c in zip(features, found)], "_cell int, prediction int")
    return placed.join(F.broadcast(named), "_cell").drop("_cell", "_id", "_v")


def elbow(df: DataFrame, features: str = "features", k_max: int = 11, seed: int = 42) -> DataFrame:
    """(k, inertia) for k from 2 up to k_max or one less than the rows."""
    rows = []
    with cached(df.select(features)) as points:
        for k in range(2, min(k_max, points.count() - 1) + 1):
            model = KMeans(k=k, featuresCol=features, seed=seed).fit(points)
            rows.append((k, float(model.summary.trainingCost)))
    return df.sparkSession.createDataFrame(rows, "k long, inertia double")


@dataclass
class Components:
    """A fitted decomposition: scores of the rows and the tables that explain it."""

    scores: DataFrame
    ratios: list[float]
    total_variance: float
    axes: list[list[float]]  # feature by component
    names: Sequence[str]

    def metrics(self) -> DataFrame:
        return _one_row(
            self.scores, n_components=len(self.ratios), explained_total=float(sum(self.ratios)),
            explained_first_two=float(sum(self.ratios[:2])), total_variance=self.total_variance,
        )

    def variance_table(self) -> DataFrame:
        """(component, ratio, cumulative)."""
        rows = [(i + 1, float(r)) for i, r in enumerate(self.ratios)]
        table = self.scores.sparkSession.createDataFrame(rows, "component long, ratio double")
        upto = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)  # one row per component
        return table.withColumn("cumulative", F.sum("ratio").over(upto))

    def loadings(self) -> DataFrame:
        """(feature, PC1, PC2, ...): axis times the root of its variance, the correlation circle."""
        roots = [math.sqrt(r * self.total_variance) for r in self.ratios]
        rows = [(n, *[float(a * s) for a, s in zip(axis, roots)]) for n, axis in zip(self.names, self.axes)]
        typed = "feature string, " + ", ".join(f"PC{i + 1} double" for i in range(len(roots)))
        return self.scores.sparkSession.createDataFrame(rows, typed)


def principal_components(df: DataFrame, k: int, names: Sequence[str], features: str = "features") -> Components:
    """Scores as array column `embedding`; `features` must be centred. Without rows there is no component."""
    if df.isEmpty():
        return Components(df.withColumn("embedding", F.lit(None).cast("array<double>")), [], 0.0, [], names)
    model = PCA(k=k, inputCol=features, outputCol="_pc").fit(df)
    scores = model.transform(df).withColumn("embedding", vector_to_array("_pc")).drop("_pc")
    total = df.select(Summarizer.variance(F.col(features)).alias("v")).first()["v"].toArray().sum()
    return Components(scores, list(model.explainedVariance.toArray()), float(total), model.pc.toArray().tolist(), names)


def plane(df: DataFrame, names: Sequence[str], features: str = "features") -> DataFrame:
    """Rows with a two-dimensional `embedding`, whatever they had before."""
    return principal_components(df.drop("embedding"), 2, names, features).scores


def cluster_embedding(df: DataFrame, k: int = 4, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """K-means on an embedding and its silhouette."""
    return k_means(df.withColumn("_e", array_to_vector("embedding")), k, "_e", seed)


def compare(df: DataFrame, runs: Mapping[str, tuple[str, int]], features: str = "features", seed: int = 42) -> DataFrame:
    """(model_name, k, silhouette, inertia) of named clusterings."""
    kinds = {"k_means": k_means, "hierarchical": hierarchical}
    with cached(df.select(features)) as points:
        rows = [kinds[kind](points, k, features, seed=seed)[1].select(F.lit(n).alias("model_name"), "*") for n, (kind, k) in runs.items()]
        return pinned(reshape.stack(rows))


def cluster_stability(df: DataFrame, ks: Sequence[int], seeds: Sequence[int], features: str = "features") -> DataFrame:
    """Mean and deviation of silhouette and inertia over seeds, per k."""
    with cached(df.select(features)) as points:
        rows = [k_means(points, k, features, seed)[1] for k in ks for seed in seeds]
        each = pinned(reshape.stack(rows))
    return profile.metric_summary(each, ["k"], ["silhouette", "inertia"])
