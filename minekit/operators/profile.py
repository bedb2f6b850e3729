"""Profiles and summaries: one aggregate over many columns instead of one job per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.bounds import attach, join_facts, require
from ..plans.ordering import lagged
from ..plans.quantiles import quantiles
from .clean import numeric_names


def _long(row: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One-row aggregates to one row per entry; every entry is a struct of the same shape."""
    return row.select(F.inline(F.array(*entries)))


def describe(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max of each numeric column."""
    names = list(columns) or numeric_names(df)
    plain = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    # Moments stay apart from quantiles: one aggregate with both would leave generated code.
    row = df.agg(*[f(c).alias(f"{c}__{s}") for c in names for s, f in plain.items()])
    typed = {s: "long" if s == "count" else "double" for s in plain}
    stats = _long(row, [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{s}").cast(t).alias(s) for s, t in typed.items()]) for c in names
    ])
    cut = quantiles(df, names, [0.25, 0.5, 0.75])
    cut = _long(cut, [F.struct(F.lit(c).alias("column"), F.col(c).alias("q")) for c in names])
    return join_facts(stats, cut, ["column"]).select(
        "column", "count", "mean", "std", "min", *_quartiles(F.col("q")), "max"
    )


def _quartiles(q: Column) -> list[Column]:
    return [q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75")]


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, non-null count, null count and distinct count of each column.

    Exact distinct counts are taken over (column, value) pairs, which are combined before the
    shuffle; `exact=False` uses one sketch per column instead and needs no shuffle of values.
    """
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(c).alias(f"{c}__n") for c in df.columns],
        *([] if exact else [F.approx_count_distinct(c, 0.01).alias(f"{c}__d") for c in df.columns]),
    )
    kinds = dict(df.dtypes)

    def entry(c: str) -> Column:
        present = F.col(f"{c}__n")
        fields = [
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), present.alias("non_null"),
            (F.col("_rows") - present).alias("nulls"),
        ]
        return F.struct(*fields, *([] if exact else [F.col(f"{c}__d").alias("distinct_values")]))

    table = _long(counts, [entry(c) for c in df.columns])
    if not exact:
        return table
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns])
    distinct = df.select(F.inline(pairs)).filter("value is not null").distinct().groupBy("column").agg(
        F.count("*").alias("distinct_values")
    )
    return join_facts(table, distinct, ["column"], how="left").withColumn(
        "distinct_values", F.coalesce("distinct_values", F.lit(0).cast("long"))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Null count and percentage of each column."""
    row = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"{c}__n") for c in df.columns])
    entry = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"{c}__n").alias("nulls"),
            (F.try_divide(F.col(f"{c}__n"), F.col("_rows")) * 100).alias("null_pct"),
        )
        for c in df.columns
    ]
    return _long(row, entry)


def null_table(df: DataFrame) -> DataFrame:
    """Only columns that have nulls, most first."""
    return null_counts(df).filter("nulls > 0").orderBy(F.desc("null_pct"), "column")


def total_nulls(df: DataFrame) -> DataFrame:
    per_row = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0).cast("long")).alias("total_nulls"))


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    require(df, column)
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    return value_counts(df, column).limit(n)


def unique_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).na.drop().distinct().orderBy(column)


def class_ratio(df: DataFrame, target: str, positive) -> DataFrame:
    """Positive and negative counts and the text `1:k`."""
    pos = F.count_if(F.col(target) == positive)
    neg = F.count_if(F.col(target) != positive)
    row = df.agg(pos.alias("positives"), neg.alias("negatives"))
    times = F.round(F.try_divide("positives", "negatives")).cast("long")
    return row.withColumn("ratio", F.concat(F.lit("1:"), times.cast("string")))


def dataset_summary(df: DataFrame, target: str) -> DataFrame:
    """Rows, columns, nulls, repeated rows, classes and the size of the largest and smallest class.

    Repeated rows are counted first, so every later number is a sum over distinct rows.
    """
    per_row = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    distinct = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).select(
        F.col(target).alias("_class"), "_n", (per_row * F.col("_n")).alias("_nulls")
    )
    classes = distinct.groupBy("_class").agg(
        F.sum("_n").alias("_n"), F.count("*").alias("_d"), F.sum("_nulls").alias("_nulls")
    )
    known = F.col("_class").isNotNull()
    return classes.agg(
        F.sum("_n").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.sum("_nulls").alias("total_nulls"),
        F.sum(F.col("_n") - F.col("_d")).alias("duplicate_rows"),
        F.count_if(known).alias("n_classes"),
        F.max(F.when(known, F.col("_n"))).alias("largest_class"),
        F.min(F.when(known, F.col("_n"))).alias("smallest_class"),
    )


def _pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row with Pearson's r of each pair as r_0, r_1, ...; null where a side is constant.

    A first pass finds means and deviations.  The second sums products of centred values: one sum
    where neither side has nulls, six over the complete rows otherwise.
    """
    names = sorted({c for pair in pairs for c in pair})
    row = df.agg(
        F.count("*").alias("n"), *[F.count(c).alias(f"{c}__n") for c in names],
        *[F.avg(c).alias(f"{c}__m") for c in names], *[F.stddev_pop(c).alias(f"{c}__s") for c in names],
    ).first()

    def centred(c: str) -> Column:
        return F.col(c).cast("double") - F.lit(row[f"{c}__m"])

    def r(a: str, b: str) -> Column:
        if not row[f"{a}__s"] or not row[f"{b}__s"]:
            return F.max(F.lit(None).cast("double"))
        x, y = centred(a), centred(b)
        if row[f"{a}__n"] == row["n"] == row[f"{b}__n"]:
            return F.avg(x * y) / F.lit(row[f"{a}__s"] * row[f"{b}__s"])
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        n, sx, sy, xx, yy = F.count(x), F.sum(x), F.sum(y), F.sum(x * x), F.sum(y * y)
        vx, vy = n * xx - sx * sx, n * yy - sy * sy
        constant = (vx <= n * xx * 1e-12) | (vy <= n * yy * 1e-12)
        return F.when(~constant, F.try_divide(n * F.sum(x * y) - sx * sy, F.sqrt(vx) * F.sqrt(vy)))

    return df.agg(*[r(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)])


def correlations(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """(column_a, column_b, r) for every ordered pair; each unordered pair is computed once."""
    names = list(columns) or numeric_names(df)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    at = {pair: i for i, pair in enumerate(pairs)}
    entries = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r_{at.get((a, b), at.get((b, a)))}").alias("r"))
        for a in names for b in names
    ]
    return _long(_pair_correlations(df, pairs), entries)


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] = ()) -> DataFrame:
    require(df, target)
    names = [c for c in (columns or numeric_names(df)) if c != target]
    row = _pair_correlations(df, [(c, target) for c in names])
    table = _long(row, [F.struct(F.lit(c).alias("column"), F.col(f"r_{i}").alias("r")) for i, c in enumerate(names)])
    return table.orderBy(F.desc_nulls_last("r"), "column")


def top_target_correlations(df: DataFrame, target: str, n: int, columns: Sequence[str] = ()) -> DataFrame:
    table = target_correlations(df, target, columns).withColumn("abs_r", F.abs("r"))
    return table.filter("r is not null").orderBy(F.desc("abs_r"), "column").limit(n)


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = (), per_group: bool = False) -> DataFrame:
    """Counts in equal-width bins, empty ones included; the last bin includes the maximum.

    Bins span all rows, or each group of `by` when `per_group` is set.
    """
    keys = list(by) if per_group else []
    rows = df.filter(F.col(column).isNotNull())
    ends = [F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi")]
    if keys:
        rows = attach(rows, rows.groupBy(*keys).agg(*ends), keys)
    else:
        lo, hi = rows.agg(*ends).first()
        rows = rows.withColumns({"_lo": F.lit(lo).cast("double"), "_hi": F.lit(hi).cast("double")})
    flat = F.col("_lo") == F.col("_hi")
    low = F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo"))
    width = F.when(flat, 1.0).otherwise(F.col("_hi") - F.col("_lo")) / bins
    index = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
    shaped = rows.select(*by, index.alias("bin"), low.alias("_low"), width.alias("_width"))
    counted = shaped.groupBy(*by, "bin", "_low", "_width").agg(F.count("*").alias("_n"))
    # At most one entry per bin meets here, whatever the number of rows.
    groups = counted.groupBy(*by, "_low", "_width").agg(F.map_from_entries(F.collect_list(F.struct("bin", "_n"))).alias("_found"))
    listed = groups.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    start = F.col("_low") + F.col("bin") * F.col("_width")
    count = F.coalesce(F.try_element_at("_found", F.col("bin")), F.lit(0).cast("long"))
    return listed.select(*by, "bin", start.alias("bin_start"), (start + F.col("_width")).alias("bin_end"), count.alias("count"))


def boxplot(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends (last value within 1.5 IQR) and outlier count of each group."""
    rows = df.filter(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_v"))
    fenced = attach(rows, _fences(rows, by), by)
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    return fenced.groupBy(*by).agg(
        F.count("*").alias("count"),
        F.first("_q1").alias("q1"), F.first("_q2").alias("median"), F.first("_q3").alias("q3"),
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def _fences(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    cut = quantiles(rows, ["_v"], [0.25, 0.5, 0.75], by)
    q1, q3 = F.col("_v")[0], F.col("_v")[2]
    return cut.select(
        *by, q1.alias("_q1"), F.col("_v")[1].alias("_q2"), q3.alias("_q3"),
        (q1 - 1.5 * (q3 - q1)).alias("_low"), (q3 + 1.5 * (q3 - q1)).alias("_high"),
    )


def series_summary(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, IQR and max of a value, per group if keys are given."""
    basic = df.groupBy(*by).agg(
        F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    )
    cut = quantiles(df.select(*by, F.col(column).alias("_q")), ["_q"], [0.25, 0.5, 0.75], by)
    both = join_facts(basic, cut, by)
    q = F.col("_q")
    return both.select(
        *by, "count", "mean", "std", "min", q[0].alias("q25"), q[1].alias("median"), q[2].alias("q75"),
        (q[2] - q[0]).alias("iqr"), "max",
    )


def column_quantiles(df: DataFrame, columns: Mapping[str, float]) -> DataFrame:
    """One row with the given quantile of each column."""
    cut = quantiles(df, list(columns), list(columns.values()))
    return cut.select(*[F.col(c)[i].alias(c) for i, c in enumerate(columns)])


def gaps(df: DataFrame, time: str, by: Sequence[str] = ()) -> DataFrame:
    """Seconds since the row before, along `time` within each series."""
    before = lagged(df.select(*by, time).filter(F.col(time).isNotNull()), by, [time], {"_before": (time, 1)})
    micros = _micros(F.col(time)) - _micros(F.col("_before"))
    return before.select(*by, time, (micros / 1e6).alias("gap_seconds"))


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def frequency(df: DataFrame, time: str, by: Sequence[str] = ()) -> DataFrame:
    """The most common gap of each series (lowest on ties) and its name; a series of one row has no gap."""
    counted = gaps(df, time, by).groupBy(*by, "gap_seconds").agg(F.count("*").alias("n"))
    known = F.col("gap_seconds").isNotNull()
    common = counted.groupBy(*by).agg(
        F.max_by("gap_seconds", F.when(known, F.struct("n", -F.col("gap_seconds")))).alias("gap_seconds")
    )
    gap, day = F.col("gap_seconds"), 86_400
    rest = F.pmod(gap, F.lit(day))
    clock = F.concat_ws(":", *[F.lpad(F.floor(x).cast("string"), 2, "0") for x in (rest / 3600, rest % 3600 / 60, rest % 60)])
    # The names of the gaps.
    label = (
        F.when(gap.isNull(), "No determinada").when(gap <= 3600, "Horaria").when(gap <= day, "Diaria")
        .when(gap <= 7 * day, "Semanal").when(gap <= 31 * day, "Mensual")
        .otherwise(F.concat(F.floor(gap / day).cast("string"), F.lit(" days "), clock))
    )
    return common.withColumn("frequency", label)


def quick_look(df: DataFrame) -> tuple[DataFrame, DataFrame, list[tuple[str, str]]]:
    """Shape (one row), five rows, and column types."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")), df.limit(5), df.dtypes


def metric_summary(df: DataFrame, by: Sequence[str] = (), metrics: Sequence[str] = ()) -> DataFrame:
    """Mean and sample standard deviation of each metric."""
    names = list(metrics) or [c for c in numeric_names(df) if c not in by]
    return df.groupBy(*by).agg(
        *[F.avg(c).alias(c) for c in names], *[F.stddev_samp(c).alias(f"{c}_std") for c in names]
    )


def rule_kpis(rules: DataFrame) -> DataFrame:
    return rules.agg(
        F.count("*").alias("n_rules"), F.avg("confidence").alias("mean_confidence"),
        F.avg("lift").alias("mean_lift"), F.avg("support").alias("mean_support"), F.max("lift").alias("max_lift"),
    )


def centroids(df: DataFrame, cluster: str, axes: Sequence[str]) -> DataFrame:
    return df.groupBy(cluster).agg(*[F.avg(a).alias(a) for a in axes], F.count("*").alias("n_points"))


def first_last(df: DataFrame, time: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, first, last and last minus first along time."""
    return df.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.min_by(value, time).alias("first"), F.max_by(value, time).alias("last")
    ).withColumn("change", F.col("last") - F.col("first"))
