"""Class weights and resampling of training rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.bounds import attach, pinned, small_rows
from ..plans.hashing import uniform_double, uniform_long
from ..plans.neighbours import nearest
from ..plans.ordering import row_numbers


def class_counts(df: DataFrame, label: str) -> dict:
    rows = small_rows(df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")), 10_000)
    if rows is None:
        raise ValueError(f"'{label}' has too many values to be a class")
    return {r[label]: r["n"] for r in sorted(rows, key=lambda r: r[label])}


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add n / (classes * class size)."""
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_m"))
    total = sizes.agg(F.sum("_m").alias("n"), F.count("*").alias("k")).first()
    facts = sizes.select(label, (F.lit(float(total["n"] or 0)) / (F.lit(total["k"]) * F.col("_m"))).alias(out))
    return attach(df, facts, [label])


def scale_pos_weight(df: DataFrame, label: str, positive=1) -> float:
    """Negatives per positive, at least 1; 1 without positives."""
    row = df.filter(F.col(label).isNotNull()).agg(F.count("*").alias("n"), F.count_if(F.col(label) == positive).alias("pos")).first()
    return max((row["n"] - row["pos"]) / row["pos"], 1.0) if row["pos"] else 1.0


def positive_weights(df: DataFrame, label: str, positive=1, out: str = "weight") -> DataFrame:
    weight = scale_pos_weight(df, label, positive)
    return df.withColumn(out, F.when(F.col(label) == positive, weight).otherwise(1.0))


def _by_size(counts: dict) -> list:
    """Classes from the smallest to the largest, ties by value."""
    return sorted(counts, key=lambda c: (counts[c], c))


def near_miss(df: DataFrame, id_col: str, label: str, vector: str, k: int = 3) -> DataFrame:
    """All rows of the smallest class, and as many of each other class: those whose k nearest rows of
    the smallest class are closest on average. Rows without a class go, so a table without classes gives no row."""
    counts = class_counts(df, label)
    if not counts:
        return df.filter(F.col(label).isNotNull())
    rare = _by_size(counts)[0]
    few = df.filter(F.col(label) == rare)
    many = df.filter(F.col(label) != rare)
    close = nearest(many, few, k, id_col, vector).groupBy(F.col("query_id").alias(id_col)).agg(F.avg("distance").alias("_d"))
    scored = pinned(many.select(id_col, label).join(close, id_col))
    ranked = row_numbers(scored, [label], ["_d", id_col], "_rank")
    kept = ranked.filter(F.col("_rank") <= counts[rare]).select(id_col)
    return few.unionByName(many.join(kept, id_col, "left_semi"))


def _draws(df: DataFrame, label: str, seed: int) -> tuple[DataFrame, dict]:
    """(label, _draw, _index): the picks that bring every class to the size of the largest one."""
    counts = class_counts(df, label)
    target = max(counts.values(), default=0)
    missing = [(c, target - n, n) for c, n in counts.items() if target > n]
    ends = list(accumulate(m for _, m, _ in missing))
    spark = df.sparkSession
    numbers = spark.range(ends[-1] if ends else 0)
    which, local, size = F.lit(None), F.lit(None), F.lit(None)
    for (c, m, n), end in reversed(list(zip(missing, ends))):
        inside = F.col("id") < end
        which = F.when(inside, F.lit(c)).otherwise(which)
        local = F.when(inside, F.col("id") - (end - m)).otherwise(local)
        size = F.when(inside, F.lit(n)).otherwise(size)
    named = numbers.select(which.cast(df.schema[label].dataType).alias(label), local.cast("long").alias("_draw"), size.cast("long").alias("_n"))
    pick = F.pmod(uniform_long(_draw_name(label, seed, "pick")), F.col("_n")) + 1
    return named.withColumn("_index", pick).drop("_n"), counts


def _draw_name(label: str, seed: int, what: str) -> Column:
    return F.concat_ws("-", F.col(label).cast("string"), F.col("_draw").cast("string"), F.lit(f"{seed}-{what}"))


def oversample(df: DataFrame, ids: Sequence[str], label: str, seed: int = 42) -> DataFrame:
    """All rows and, for smaller classes, rows drawn with replacement up to the largest class.

    `copy` is 0 for the row itself and the number of the draw otherwise.  Draws and rows meet by
    position in the class, so the join key is unique on one side and evenly spread on the other.
    """
    draws, _ = _draws(df, label, seed)
    indexed = row_numbers(df.filter(F.col(label).isNotNull()), [label], list(ids), "_index")
    picked = draws.join(indexed, [label, "_index"]).select(*df.columns, (F.col("_draw") + 1).alias("copy"))
    return df.withColumn("copy", F.lit(0).cast("long")).unionByName(picked)


def smote(df: DataFrame, id_col: str, label: str, vector: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(id, label, vector): all rows, and new points between a row and one of its k nearest class mates."""
    base = df.select(F.col(id_col).cast("string").alias("id"), label, F.col(vector).cast("array<double>").alias("vector"))
    base = pinned(base)
    draws, counts = _draws(base, label, seed)
    small = [c for c, n in counts.items() if n < max(counts.values())]
    if any(counts[c] < 2 for c in small):
        raise ValueError("a class needs two rows before points can be placed between them")
    links = None
    for c in small:
        mates = base.filter(F.col(label) == F.lit(c))
        found = nearest(mates, mates, k, "id", "vector").select(
            F.lit(c).cast(base.schema[label].dataType).alias(label), F.col("query_id").alias("id"), "base_id", "rank"
        )
        links = found if links is None else links.unionByName(found)
    if links is None:
        return base
    indexed = row_numbers(base.select("id", label), [label], ["id"], "_index")
    sizes = {c: min(k, counts[c] - 1) for c in small}
    reach = F.create_map(*[x for c, s in sizes.items() for x in (F.lit(c), F.lit(s))])[F.col(label)]
    chosen = draws.join(indexed, [label, "_index"]).select(
        label, "_draw", "id",
        (F.pmod(uniform_long(_draw_name(label, seed, "mate")), reach) + 1).cast("int").alias("rank"),
        uniform_double(_draw_name(label, seed, "gap")).alias("_gap"),
    )
    pairs = chosen.join(links, [label, "id", "rank"])
    ends = pairs.join(base.select("id", F.col("vector").alias("_from")), "id").join(
        base.select(F.col("id").alias("base_id"), F.col("vector").alias("_to")), "base_id"
    )
    point = F.zip_with("_from", "_to", lambda a, b: a + (b - a) * F.col("_gap"))
    name = F.concat_ws("-", F.lit("new"), F.col(label).cast("string"), F.col("_draw").cast("string"))
    return base.unionByName(ends.select(name.alias("id"), label, point.alias("vector")))


def tomek_links(df: DataFrame, id_col: str, label: str, vector: str) -> DataFrame:
    """(id, other): pairs of rows of different classes that are each other's nearest row; both orders."""
    first = nearest(df, df, 1, id_col, vector).select(F.col("query_id").alias("id"), F.col("base_id").alias("other"))
    first = pinned(first)
    back = first.select(F.col("id").alias("other"), F.col("other").alias("id"))
    mutual = first.join(back, ["id", "other"])
    classes = df.select(F.col(id_col).alias("id"), F.col(label).alias("_a"))
    others = df.select(F.col(id_col).alias("other"), F.col(label).alias("_b"))
    return mutual.join(classes, "id").join(others, "other").filter("_a <> _b").select("id", "other")


def smote_tomek(df: DataFrame, id_col: str, label: str, vector: str, k: int = 5, seed: int = 42) -> DataFrame:
    """SMOTE, then both ends of every Tomek link are removed."""
    grown = pinned(smote(df, id_col, label, vector, k, seed))
    return grown.join(tomek_links(grown, "id", label, "vector").select("id"), "id", "left_anti")


def resample(df: DataFrame, method: str | None, id_col: str, label: str, vector: str, seed: int = 42) -> DataFrame:
    """(id, label, vector) after the named method: undersample, oversample, smote_tomek or none."""
    shaped = df.select(F.col(id_col).cast("string").alias("id"), label, F.col(vector).cast("array<double>").alias("vector"))
    if method is None:
        return shaped
    if method == "undersample":
        return near_miss(shaped, "id", label, "vector")
    if method == "oversample":
        return oversample(shaped, ["id"], label, seed).drop("copy")
    if method == "smote_tomek":
        return smote_tomek(shaped, "id", label, "vector", seed=seed)
    raise ValueError("method must be None, 'undersample', 'oversample' or 'smote_tomek'")
