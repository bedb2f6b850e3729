"""From raw catalogue text to product features, transactions and a model table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import safe_float, safe_int, slugify
from ..plans.bounds import pinned
from . import clean, encode, reshape, rules
from .profile import value_counts

# They must equal the catalogue conventions for results to agree.
KNOWN_BRANDS = (
    "asus", "acer", "hp", "dell", "lenovo", "apple", "msi", "toshiba", "samsung", "sony", "gigabyte", "medion",
    "huawei", "xiaomi",
)
STOP_WORDS = (
    "with", "from", "have", "this", "that", "your", "laptop", "notebook", "intel", "windows", "inch", "black",
    "white", "silver", "gray",
)
RAM = r"(?i)(\d+)\s*gb\s*ram"
STORAGE = r"(?i)(\d+)\s*(gb|tb)\s*(ssd|hdd|emmc)?"
SCREEN = r'(\d+(?:\.\d+)?)\s*"'
CPU = r"(?i)(i3|i5|i7|i9|ryzen\s*3|ryzen\s*5|ryzen\s*7|celeron|pentium|atom|xeon)"
STORAGE_STEPS = ((128, "<=128GB"), (256, "129-256GB"), (512, "257-512GB"), (1024, "513GB-1TB"))
RAM_STEPS = ((4, "<=4GB"), (8, "5-8GB"), (16, "9-16GB"))
RATING_STEPS = ((2, "Low"), (3, "Medium"))


def _group(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def title_case(c: Column) -> Column:
    """Every run of letters starts with a capital."""
    runs = F.regexp_extract_all(c, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def brand(title: Column) -> Column:
    """The first known brand the title contains, else its first word."""
    low = F.lower(F.coalesce(title, F.lit("")))
    known = F.coalesce(*[F.when(low.contains(b), F.initcap(F.lit(b))) for b in KNOWN_BRANDS])
    first = F.nullif(title_case(F.trim(F.split(title, " ")[0])), F.lit(""))
    return F.coalesce(known, first, F.lit("Unknown"))


def ram_gb(text: Column) -> Column:
    return _group(text, RAM).cast("int")


def storage(text: Column) -> dict[str, Column]:
    """Amount in GB, unit and kind of the first size in the text."""
    unit = F.upper(_group(text, STORAGE, 2))
    amount = _group(text, STORAGE, 1).cast("double")
    return {
        "storage_gb": F.when(unit == "TB", amount * 1024).otherwise(amount),
        "storage_unit": unit,
        "storage_type": F.upper(_group(text, STORAGE, 3)),
    }


def screen_inches(text: Column) -> Column:
    return _group(text, SCREEN).cast("double")


def cpu_family(text: Column) -> Column:
    return F.coalesce(F.replace(F.upper(_group(text, CPU)), F.lit("  "), F.lit(" ")), F.lit("OTHER"))


def _ladder(c: Column, steps, above: str) -> Column:
    return encode.cut_at(c, [e for e, _ in steps], [*[n for _, n in steps], above], "Unknown")


def storage_bucket(c: Column) -> Column:
    return _ladder(c, STORAGE_STEPS, ">1TB")


def ram_bucket(c: Column) -> Column:
    return _ladder(c, RAM_STEPS, ">16GB")


def rating_bucket(c: Column) -> Column:
    return _ladder(c, RATING_STEPS, "High")


def full_text(title: str = "title", description: str = "description") -> Column:
    return F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(description), F.lit("")))


def top_words(df: DataFrame, text: Column, k: int = 15) -> list[str]:
    """The k most frequent words of four letters or more that are no stop words; ties by word."""
    tokens = reshape.explode_tokens(df, F.lower(text), "[a-zA-Z]{4,}").filter(~F.col("token").isin(*STOP_WORDS))
    return [r["token"] for r in value_counts(tokens, "token").limit(k).collect()]


def features(raw: DataFrame) -> DataFrame:
    """Parsed columns of each raw record; every column is an expression over the row."""
    text = full_text()
    out = raw.withColumns({
        "price": safe_float(F.col("price_text")),
        "rating": F.col("rating_text").try_cast("double"),
        "reviews_count": safe_int(F.col("reviews_text")),
        "brand": brand(F.col("title")),
        "ram_gb": ram_gb(text),
        **storage(text),
        "screen_inches": screen_inches(text),
        "cpu_family": cpu_family(text),
    })
    return out.withColumns({
        "ram_bucket": ram_bucket(F.col("ram_gb")),
        "storage_bucket": storage_bucket(F.col("storage_gb")),
        "rating_bucket": rating_bucket(F.col("rating")),
        "has_ssd": F.coalesce((F.col("storage_type") == "SSD").cast("int"), F.lit(0)),
        "has_hdd": F.coalesce((F.col("storage_type") == "HDD").cast("int"), F.lit(0)),
    })


def prepare(
    raw: DataFrame, order: Sequence[str], k: int = 15, probs: Sequence[float] = (0.33, 0.66)
) -> tuple[DataFrame, list[str], list[float]]:
    """The product table, its keywords and its price cut points.

    `order` decides which of several rows with one title, price and description is kept.
    """
    parsed = features(clean.slugify_header(raw))
    words = top_words(parsed, full_text(), k)
    flagged = reshape.word_flags(parsed, F.lower(full_text()), words)
    kept = clean.drop_duplicates(flagged, ["title", "price", "description"], order).filter("price is not null")
    kept = pinned(kept)  # cut points, transactions and the model table all read it
    cut, edges = encode.quantile_segments(kept, "price", probs)
    return cut.withColumn("is_premium", (F.col("price_segment") == "Premium").cast("int")), words, edges


def transactions(products: DataFrame, tx: str) -> DataFrame:
    """(tx, item) rows describing each product."""
    named = ["brand", "price_segment", "ram_bucket", "storage_bucket", "cpu_family", "rating_bucket"]
    items = [F.concat(F.lit(f"{c}="), slugify(F.col(c))) for c in named]
    items += [F.when(F.col(f"has_{t}") == 1, F.lit(f"storage_type={t}")) for t in ("ssd", "hdd")]
    words = [c for c in products.columns if c.startswith("kw_")]
    items += [F.when(F.col(c) == 1, F.lit(c.replace("kw_", "keyword=", 1))) for c in words]
    return products.select(tx, F.explode(F.array_compact(F.array(*items))).alias("item"))


def model_table(products: DataFrame, key: str | None = None) -> DataFrame:
    """Imputed and one-hot coded features with the price segment as target."""
    words = [c for c in products.columns if c.startswith("kw_")]
    kept = [
        "price", "rating", "reviews_count", "brand", "ram_gb", "storage_gb", "screen_inches", "cpu_family",
        "ram_bucket", "storage_bucket", "rating_bucket", "has_ssd", "has_hdd", *words, "price_segment",
    ]
    filled = clean.impute_for_model(products.select(*([key] if key else []), *kept))
    coded = [c for c in clean.text_names(filled) if c not in ("price_segment", key)]
    return encode.one_hot(filled, coded, drop_first=False)


def mine(
    products: DataFrame, tx: str, min_support: float = 0.10, min_confidence: float = 0.55, n_top: int = 15
) -> dict[str, DataFrame]:
    """Transactions, itemsets, rules and most common items of a product table."""
    pairs = transactions(products, tx)
    itemsets = rules.frequent_itemsets(rules.baskets_from_pairs(pairs, tx, "item"), min_support)
    return {
        "transactions": pairs,
        "itemsets": itemsets,
        "rules": rules.association_rules(itemsets, "confidence", min_confidence),
        "top_items": rules.top_items(pairs, tx, "item", n_top),
    }
