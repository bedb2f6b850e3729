"""Frequent itemsets and association rules with every antecedent/consequent partition."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import list_items
from ..plans.bounds import cached, complete_rows, pinned, require


def baskets_from_pairs(df: DataFrame, tx: str, item: str) -> DataFrame:
    """(tx, items) with sorted distinct items.

    Pairs are made distinct before they are grouped, so a basket whose rows repeat costs one
    row per distinct item.
    """
    require(df, tx, item)
    pairs = df.select(tx, F.col(item).cast("string").alias("_item")).na.drop().distinct()
    return pairs.groupBy(tx).agg(F.array_sort(F.collect_list("_item")).alias("items"))


def item_lists(df: DataFrame, tx: str, item: str) -> DataFrame:
    """(tx, items) with repeats kept; equal items are counted before they are grouped."""
    counted = df.select(tx, F.col(item).cast("string").alias("_item")).na.drop().groupBy(tx, "_item").agg(
        F.count("*").cast("int").alias("_n")
    )
    grouped = counted.groupBy(tx).agg(F.array_sort(F.collect_list(F.struct("_item", "_n"))).alias("_pairs"))
    repeated = F.flatten(F.transform("_pairs", lambda p: F.array_repeat(p["_item"], p["_n"])))
    return grouped.select(tx, repeated.alias("items"))


def baskets_from_columns(df: DataFrame, tx: str, columns: Sequence[str]) -> DataFrame:
    """One basket per complete row: `column=value` items."""
    rows = complete_rows(df, columns)
    items = F.array(*[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns])
    return rows.select(tx, F.array_sort(items).alias("items"))


def baskets_from_flags(df: DataFrame, tx: str, columns: Sequence[str]) -> DataFrame:
    """One basket per row: the names of the columns that are set."""
    items = F.array_compact(F.array(*[F.when(F.col(c).cast("int") != 0, F.lit(c)) for c in columns]))
    return df.select(tx, F.array_sort(items).alias("items"))


def baskets_from_lists(df: DataFrame, tx: str, column: str, separator: str = ",") -> DataFrame:
    items = F.array_sort(F.array_distinct(list_items(F.col(column), separator)))
    return df.filter(F.col(column).isNotNull()).select(tx, items.alias("items"))


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.01) -> DataFrame:
    """(items, freq, support, n_items) of every itemset at or above the support; items sorted.

    Mining runs once: the result is written to the checkpoint folder, because rule building
    reads it three times.
    """
    with cached(baskets.select("items")) as rows:
        n = rows.count()
        model = FPGrowth(itemsCol="items", minSupport=min_support).fit(rows)
        table = model.freqItemsets.select(
            F.array_sort("items").alias("items"), "freq",
            (F.col("freq") / F.lit(n)).alias("support"), F.size("items").alias("n_items"),
        )
        return pinned(table)


def item_support(pairs: DataFrame, tx: str, item: str) -> DataFrame:
    """Share of baskets that hold each item."""
    distinct = pairs.select(tx, item).na.drop().distinct()
    n = distinct.select(tx).distinct().count()
    return distinct.groupBy(item).agg((F.count("*") / F.lit(n)).alias("support"))


def top_items(pairs: DataFrame, tx: str, item: str, n: int = 15) -> DataFrame:
    return item_support(pairs, tx, item).orderBy(F.desc("support"), item).limit(n)


def rule_metrics(a: Column, c: Column, ac: Column) -> dict[str, Column]:
    """Measures of a rule from the supports of its antecedent, consequent and union."""
    confidence = ac / a
    zero = F.lit(0.0)
    strongest = F.greatest(ac * (1 - a), a * (c - ac))
    return {
        "support": ac,
        "confidence": confidence,
        "lift": confidence / c,
        "representativity": F.lit(1.0),
        "leverage": ac - a * c,
        "conviction": F.coalesce(F.try_divide(1 - c, 1 - confidence), F.lit(float("inf"))),
        "zhangs_metric": F.coalesce(F.try_divide(ac - a * c, strongest), zero),
        "jaccard": ac / (a + c - ac),
        "certainty": F.coalesce(F.try_divide(confidence - c, 1 - c), zero),
        "kulczynski": (confidence + ac / c) / 2,
    }


#: Sides of itemsets up to this size are listed by bit masks; for larger ones confident sides are grown.
MASK_ITEMS = 12
_LOW_BITS = 16  # masks are listed in runs of this many bits, as one array must not hold them all


def _masked_sides(itemsets: DataFrame) -> DataFrame:
    """Every split of every itemset into (antecedents, consequents), with the support `_ac` of the whole."""
    runs = itemsets.select(
        "items", F.col("support").alias("_ac"), "n_items",
        F.explode(F.expr(f"sequence(0L, shiftleft(1L, greatest(n_items - {_LOW_BITS}, 0)) - 1)")).alias("_high"),
    )
    masks = runs.select(
        "items", "_ac", "n_items", "_high", F.explode(F.expr(f"sequence(0L, shiftleft(1L, least(n_items, {_LOW_BITS})) - 1)")).alias("_low"),
    ).withColumn("_mask", F.expr(f"shiftleft(_high, {_LOW_BITS}) + _low"))
    return masks.filter("_mask > 0 and _mask < shiftleft(1L, n_items) - 1").select(
        F.expr("filter(items, (x, i) -> (shiftright(_mask, i) & 1) = 1)").alias("antecedents"),
        F.expr("filter(items, (x, i) -> (shiftright(_mask, i) & 1) = 0)").alias("consequents"), "_ac",
    )


def _grown_sides(itemsets: DataFrame, supports: DataFrame, min_confidence: float) -> DataFrame:
    """The same for sides that reach a confidence, with `antecedent_support`. A longer consequent is never more
    confident than a part of it, so consequents grow item by item from those that still reach it."""

    def reaching(sides: DataFrame) -> DataFrame:
        split = sides.withColumn("antecedents", F.array_except("items", "consequents"))
        return pinned(split.join(supports, "antecedents").filter(F.col("_ac") / F.col("antecedent_support") >= min_confidence))

    start = itemsets.select("items", F.col("support").alias("_ac"), F.explode("items").alias("_item"))
    level = reaching(start.select("items", "_ac", F.array("_item").alias("consequents")))
    levels = [level]
    while not level.isEmpty():
        stem = F.slice("consequents", 1, F.size("consequents") - 1)
        left = level.select("items", "_ac", stem.alias("_stem"), F.element_at("consequents", -1).alias("_a"))
        right = left.select("items", "_stem", F.col("_a").alias("_b"))
        wider = left.join(right, ["items", "_stem"]).filter("_a < _b and size(_stem) + 2 < size(items)")
        level = reaching(wider.select("items", "_ac", F.concat("_stem", F.array("_a", "_b")).alias("consequents")))
        levels.append(level)
    return functools.reduce(DataFrame.unionByName, levels).select("antecedents", "consequents", "_ac", "antecedent_support")


def association_rules(itemsets: DataFrame, metric: str = "confidence", min_threshold: float = 0.5) -> DataFrame:
    """Every split of every frequent itemset into two non-empty sides that reaches the threshold.

    Both sides are frequent themselves, so two equi-joins on the sorted item array find their supports.
    """
    left = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    right = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    measures = rule_metrics(F.col("antecedent_support"), F.col("consequent_support"), F.col("_ac"))
    if metric not in measures:
        raise ValueError(f"unknown metric: {metric}")
    many = itemsets.filter("n_items >= 2")
    if metric == "confidence":
        # A confidence bound needs the antecedent only, so weak splits never reach the second join.
        found = _masked_sides(many.filter(F.col("n_items") <= MASK_ITEMS)).join(left, "antecedents").filter(
            F.col("_ac") / F.col("antecedent_support") >= min_threshold)
        long = many.filter(F.col("n_items") > MASK_ITEMS)
        if not long.isEmpty():
            found = found.unionByName(_grown_sides(long, left, min_threshold))
    else:
        found = _masked_sides(many).join(left, "antecedents")
    rules = found.join(right, "consequents").select(
        "antecedents", "consequents", "antecedent_support", "consequent_support",
        *[e.alias(n) for n, e in measures.items()],
    )
    return rules.filter(F.col(metric) >= min_threshold)


def order_rules(rules: DataFrame, metric: str = "confidence", n: int | None = None) -> DataFrame:
    """Best first; only the best n when asked."""
    sides = F.concat_ws(",", "antecedents"), F.concat_ws(",", "consequents")
    ordered = rules.orderBy(F.desc(metric), *sides)
    return ordered.limit(n) if n is not None else ordered


def rules_about(rules: DataFrame, item: str) -> DataFrame:
    """Rules with the item among their consequents."""
    return rules.filter(F.array_contains("consequents", item))


def rules_within(rules: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Rules made of allowed items only, with all their items in `items`."""
    union = F.array_sort(F.array_union("antecedents", "consequents"))
    rest = F.array_except("items", F.array(*map(F.lit, allowed)))
    return rules.withColumn("items", union).filter(F.size(rest) == 0)


def shown(df: DataFrame, columns: Sequence[str] = ("antecedents", "consequents")) -> DataFrame:
    """Item arrays as comma-joined text."""
    return df.withColumns({c: F.concat_ws(", ", F.array_sort(c)) for c in columns})
