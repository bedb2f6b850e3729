"""Projection, casting, filtering, deduplication and imputation."""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import text
from ..plans.bounds import complete_rows, require
from ..plans.quantiles import quantiles


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_names(df))


def strip_header_quotes(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace('"', "").strip() for c in df.columns])


def slug_name(name: str) -> str:
    parts = re.split("[^a-z0-9áéíóúñü]+", name.strip().lower())
    return "_".join(p for p in parts if p) or "na"


def slugify_header(df: DataFrame) -> DataFrame:
    return df.toDF(*map(slug_name, df.columns))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def features_and_target(
    df: DataFrame, target: str, features: Sequence[str] = (), target_expr: Column | None = None
) -> DataFrame:
    """Feature columns (all others when none are named) and the target as `label`."""
    require(df, target, *features)
    names = list(features) or [c for c in df.columns if c != target]
    return df.select(*names, (F.col(target) if target_expr is None else target_expr).alias("label"))


def _each(df: DataFrame, columns: Sequence[str], change) -> DataFrame:
    require(df, *columns)
    return df.withColumns({c: change(F.col(c)) for c in columns})


def to_datetime(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = ()) -> DataFrame:
    return _each(df, columns, lambda c: text.to_date_time(c, formats))


def to_number(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _each(df, columns, lambda c: c.try_cast("double"))


def clean_text(df: DataFrame, columns: Sequence[str], **options: bool) -> DataFrame:
    return _each(df, columns, lambda c: text.clean_text(c, **options))


def replace_regex(df: DataFrame, columns: Sequence[str], pattern: str, repl: str = "") -> DataFrame:
    return _each(df, columns, lambda c: F.regexp_replace(c, pattern, repl))


def number_from_text(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    return _each(df, columns, lambda c: text.number_from_text(c, **options))


def null_out(df: DataFrame, sentinels: Sequence[str] = ("None",)) -> DataFrame:
    """NaN, infinities and sentinel texts become null."""
    changes = {}
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            odd = F.isnan(c) | c.isin(float("inf"), float("-inf"))
            changes[f.name] = F.when(~odd, c)
        elif isinstance(f.dataType, T.StringType):
            changes[f.name] = F.when(~c.isin(*sentinels), c)
    return df.withColumns(changes)


def round_numbers(df: DataFrame, digits: int = 4) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(c, digits) for c in names})


def date_text(df: DataFrame, columns: Sequence[str], pattern: str = "yyyy-MM-dd") -> DataFrame:
    return _each(df, columns, lambda c: F.date_format(c, pattern))


def tidy_metric_table(df: DataFrame, numeric: Sequence[str], preferred: Sequence[str]) -> DataFrame:
    """Metric columns as numbers, all-null columns dropped, preferred columns first."""
    df = to_number(null_out(df), [c for c in numeric if c in df.columns])
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    kept = [c for c in df.columns if filled[c]]
    first = [c for c in preferred if c in kept]
    return df.select(*first, *[c for c in kept if c not in first])


def time_parts(df: DataFrame, column: str) -> DataFrame:
    """Replace a timestamp by its hour and its day of week (Monday = 0)."""
    require(df, column)
    parts = {f"{column}_Hour": F.hour(column), f"{column}_DayOfWeek": F.weekday(column)}
    return df.withColumns(parts).drop(column)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return complete_rows(df, list(columns) if columns else df.columns)


def drop_duplicates(df: DataFrame, columns: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Distinct rows, or the first row by `order` for each value of `columns`; rows tied on `order` go by their other
    columns from left to right, so the partitioning decides nothing.

    Keeping the first is an aggregate, so each task sends at most one row per key.
    """
    if not columns:
        return df.distinct()
    require(df, *columns, *order)
    if not order:
        raise ValueError("keeping the first row of each key needs an order")
    rest = [c for c in df.columns if c not in columns]
    sortable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    lead = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *(c for c in rest if c in sortable)])])
    first = df.groupBy(*columns).agg(F.min_by(F.struct(*rest), lead).alias("_row")) if rest else df.distinct()
    return first.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier row."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows")
    )


def columns_with_nulls(df: DataFrame) -> list[str]:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if counts[c]]


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and other column names."""
    numbers = numeric_names(df)
    return numbers, [c for c in df.columns if c not in numbers]


def categorical_like(df: DataFrame, max_distinct: int = 20) -> list[str]:
    """Text and boolean columns, and integer columns with few distinct values."""
    ints = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    counts = df.agg(*[F.approx_count_distinct(c, 0.01).alias(c) for c in ints]).first() if ints else {}
    few = []
    for c in ints:
        # The sketch only sorts out clear cases; close ones are counted.
        if counts[c] <= max_distinct * 1.2 and df.select(c).na.drop().distinct().count() <= max_distinct:
            few.append(c)
    kinds = (T.StringType, T.BooleanType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) or f.name in few]


def fill_statistics(df: DataFrame, strategy: str) -> dict[str, object]:
    """The value each column is filled with: mean or median of numbers, lowest mode of any column."""
    if strategy == "mode":
        return _modes(df)
    names = numeric_names(df)
    if not names:
        return {}
    if strategy == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in names]).first()
        found = {c: row[c] for c in names}
    elif strategy == "median":
        row = quantiles(df, names, [0.5]).first()
        found = {c: row[c][0] if row[c] else None for c in names}
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    return {c: v for c, v in found.items() if v is not None}


def _modes(df: DataFrame) -> dict[str, object]:
    """The lowest most frequent value of each column, from one count of (column, value) pairs. Columns of other types
    than numbers, text, dates, times and booleans have none."""
    plain = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    fields = [f for f in df.schema if isinstance(f.dataType, plain)]
    if not fields:
        return {}
    number = [F.col(f.name).cast("double") if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double") for f in fields]
    pairs = F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(f.name).cast("string").alias("v"), x.alias("x")) for i, (f, x) in enumerate(zip(fields, number))])
    counted = df.select(F.inline(pairs)).filter("v is not null").groupBy("c", "v", "x").agg(F.count("*").alias("n"))
    rows = counted.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), "x", "v")).alias("v")).collect()  # a row per column
    if not rows:
        return {}
    typed = df.sparkSession.range(1).select(*[F.lit(r["v"]).cast(fields[r["c"]].dataType).alias(fields[r["c"]].name) for r in rows])
    return typed.first().asDict()


def impute(df: DataFrame, strategy: str = "mean") -> DataFrame:
    values = fill_statistics(df, strategy)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def impute_for_model(df: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """Median (0 when a column is empty) for numbers, a fixed word for text."""
    values = fill_statistics(df, "median")
    filled = {c: F.coalesce(F.col(c), F.lit(values.get(c, 0))) for c in numeric_names(df)}
    filled |= {c: F.coalesce(F.col(c), F.lit(unknown)) for c in text_names(df)}
    return df.withColumns(filled)


def prepare_for_display(
    df: DataFrame, exclude: Sequence[str] = (), strategy: str | None = None, one_hot: bool = False,
    drop_first: bool = True,
) -> DataFrame:
    """Exclude columns, drop duplicate rows, fill or drop nulls, encode text."""
    from .encode import one_hot as encode

    out = drop_duplicates(drop_columns(df, exclude))
    if strategy == "drop":
        out = drop_nulls(out)
    elif strategy:
        out = impute(out, strategy)
    return encode(out, drop_first=drop_first) if one_hot else out


def supervised_table(
    df: DataFrame, target: str, features: Sequence[str] = (), exclude: Sequence[str] = (), drop_first: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The modelling table and one row of counts that say what was dropped on the way."""
    from .encode import one_hot as encode

    require(df, target, *features)
    names = [c for c in (features or df.columns) if c not in exclude and c != target]
    initial = df.select(*names, target)
    distinct = drop_duplicates(initial)
    labelled = drop_nulls(distinct, [target])
    coded = encode(labelled, [c for c in text_names(labelled) if c != target], drop_first=drop_first)
    final = drop_nulls(coded)
    steps = {"rows_initial": initial, "rows_distinct": distinct, "rows_labelled": labelled, "rows_final": final}
    tall = functools.reduce(
        DataFrame.unionByName, [d.agg(F.count("*").alias("n")).withColumn("step", F.lit(s)) for s, d in steps.items()]
    )
    counts = tall.agg(*[F.max(F.when(F.col("step") == s, F.col("n"))).alias(s) for s in steps])
    audit = counts.select(
        "rows_initial",
        "rows_final",
        (F.col("rows_initial") - F.col("rows_distinct")).alias("dropped_duplicates"),
        (F.col("rows_distinct") - F.col("rows_labelled")).alias("dropped_null_target"),
        (F.col("rows_labelled") - F.col("rows_final")).alias("dropped_null_features"),
    )
    return final, audit


def remap_binary_target(df: DataFrame, target: str, mapping: Mapping[int, int] = {-1: 0, 1: 1}) -> DataFrame:
    """Map the two accepted values; any other value is an error."""
    allowed = list(mapping)
    value, done = F.col(target), list(mapping.values())
    if not df.filter(value.isNotNull() & ~value.isin([*allowed, *done])).isEmpty():
        raise ValueError(f"'{target}' holds values other than {allowed}")
    if df.filter(value.isin([x for x in allowed if x not in done])).isEmpty():
        return df.withColumn(target, F.col(target).cast("int"))
    coded = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return df.withColumn(target, F.try_element_at(coded, F.col(target).cast("int")))


def filter_rules(
    rules: DataFrame, min_confidence: float = 0.0, min_support: float = 0.0, min_lift: float = 0.0,
    max_antecedents: int | None = None, text_in: str = "",
) -> DataFrame:
    keep = (F.col("confidence") >= min_confidence) & (F.col("support") >= min_support) & (F.col("lift") >= min_lift)
    if max_antecedents is not None:
        keep &= F.size("antecedents") <= max_antecedents
    if text_in:
        sides = F.concat_ws(", ", F.array_sort("antecedents")), F.concat_ws(", ", F.array_sort("consequents"))
        keep &= F.lower(sides[0]).contains(text_in.lower()) | F.lower(sides[1]).contains(text_in.lower())
    return rules.filter(keep)


def filter_contains(df: DataFrame, column: str, text_in: str) -> DataFrame:
    return df.filter(F.lower(column).contains(text_in.lower()))


def filter_products(
    df: DataFrame, brands: Sequence[str] = (), segments: Sequence[str] = (), title: str = "",
    brand_col: str = "brand", segment_col: str = "price_segment", title_col: str = "title",
) -> DataFrame:
    if brands:
        df = df.filter(F.col(brand_col).isin(*brands))
    if segments:
        df = df.filter(F.col(segment_col).isin(*segments))
    return filter_contains(df, title_col, title) if title else df


def regex_filter(df: DataFrame, column: str, pattern: str, ignore_case: bool = False) -> DataFrame:
    return df.filter(F.col(column).rlike(("(?i)" if ignore_case else "") + pattern))
