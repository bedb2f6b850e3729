"""User aggregates that merge."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from minekit.operators import aggregates
from minekit.operators.aggregates import Aggregate


def moments():
    """Variance from count, mean and squared deviations, merged as Chan and others do."""
    def of(rows: pd.DataFrame):
        v = rows["v"].dropna()
        return len(v), float(v.mean()) if len(v) else 0.0, float(((v - v.mean()) ** 2).sum())

    def merge(a, b):
        n = a[0] + b[0]
        if not n:
            return a
        d = b[1] - a[1]
        return n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n

    return Aggregate(lambda: (0, 0.0, 0.0), lambda s, rows: merge(s, of(rows)), merge, lambda s: s[2] / s[0] if s[0] else None)


def test_a_hot_group_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "HELD", 3)
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 50 == 2, None).otherwise((F.col("id") % 40).cast("string")).alias("k"),
        (F.col("id") % 2).cast("int").alias("n"), F.when(F.col("id") % 11 > 0, F.sin("id") * 100).alias("v")).repartition(16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {(r.k, r.n): r.var for r in aggregates.aggregate(rows, {"var": moments()}, ["v"], ["k", "n"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {(r.k, r.n): r.x for r in rows.groupBy("k", "n").agg(F.var_pop("v").alias("x")).collect()}
    assert set(got) == set(want) and any(k is None for k, _ in got)
    for key, value in want.items():
        assert got[key] is None if value is None else got[key] == pytest.approx(value)


def test_without_keys_there_is_one_row(spark):
    rows = spark.range(100).select(F.col("id").cast("double").alias("v"))
    assert [tuple(r) for r in aggregates.aggregate(rows, {"var": moments()}, ["v"]).collect()] == [(pytest.approx(833.25),)]
    assert [tuple(r) for r in aggregates.aggregate(rows.where("v < 0"), {"var": moments()}, ["v"]).collect()] == [(None,)]
    keyed = rows.withColumn("k", F.lit(1)).where("v < 0")
    assert aggregates.aggregate(keyed, {"var": moments()}, ["v"], ["k"]).count() == 0
