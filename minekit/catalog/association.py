"""Baskets, itemsets, rules and the product catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import clean, encode, products, profile, reshape, rules
from .registry import query, table
from .tables import TYPES

R = clean.round_numbers


def part_pairs(spark, folder) -> DataFrame:
    """(l_orderkey, p_type) of every line item."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_type")


def part_itemsets(spark, folder, min_support=0.05) -> DataFrame:
    return rules.frequent_itemsets(rules.baskets_from_pairs(part_pairs(spark, folder), "l_orderkey", "p_type"), min_support)


def _names(mask: str) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN ({mask} >> {i}) & 1 = 1 THEN '{t}' END" for i, t in enumerate(TYPES)) + ")"


# Every subset of the six part types is a bit mask; a basket supports it when it has all its bits.
MASKS = f"""b AS (SELECT l_orderkey, bit_or(CASE p_type {' '.join(f"WHEN '{t}' THEN {1 << i}" for i, t in enumerate(TYPES))} END) AS m
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), n AS (SELECT count(*) AS n FROM b),
 f AS (SELECT s.m, count(*) AS c, count(*) / any_value(n) AS support FROM (SELECT unnest(range(1, {1 << len(TYPES)}))::INTEGER AS m) s, b, n
 WHERE (b.m & s.m) = s.m GROUP BY 1 HAVING count(*) >= 0.05 * any_value(n)),
 r AS (SELECT a.m AS am, c.m AS cm, a.support AS sa, c.support AS sc, u.support AS s, u.support / a.support AS conf
 FROM f u JOIN f a ON (a.m & u.m) = a.m AND a.m <> u.m JOIN f c ON c.m = xor(u.m, a.m))"""


@query(f"WITH {MASKS} SELECT {_names('m')} AS items, c AS freq, round(support, 6) AS support, bit_count(m)::INTEGER AS n_items FROM f")
def frequent_itemsets(spark, folder):
    return R(rules.shown(part_itemsets(spark, folder), ["items"]), 6)


RULE_COLUMNS = f"""{_names('am')} AS antecedents, {_names('cm')} AS consequents, round(sa, 6) AS antecedent_support, round(sc, 6) AS consequent_support,
 round(s, 6) AS support, round(conf, 6) AS confidence, round(conf / sc, 6) AS lift"""


@query(f"""WITH {MASKS} SELECT {RULE_COLUMNS}, 1.0::DOUBLE AS representativity, round(s - sa * sc, 6) AS leverage, round((1 - sc) / (1 - conf), 6) AS conviction,
 round((s - sa * sc) / greatest(s * (1 - sa), sa * (sc - s)), 6) AS zhangs_metric, round(s / (sa + sc - s), 6) AS jaccard,
 round((conf - sc) / (1 - sc), 6) AS certainty, round((conf + s / sc) / 2, 6) AS kulczynski FROM r WHERE conf >= 0.3""")
def association_rules(spark, folder):
    """Orders as baskets, part types as items: every rule with all its measures."""
    return R(rules.shown(rules.association_rules(part_itemsets(spark, folder), "confidence", 0.3)), 6)


def _rules(spark, folder, metric="confidence", least=0.3):
    kept = ["antecedents", "consequents", "antecedent_support", "consequent_support", "support", "confidence", "lift"]
    return rules.association_rules(part_itemsets(spark, folder), metric, least).select(*kept)


@query(f"WITH {MASKS} SELECT {RULE_COLUMNS} FROM r WHERE conf / sc >= 1.0")
def rules_by_lift(spark, folder):
    return R(rules.shown(_rules(spark, folder, "lift", 1.0)), 6)


@query(f"WITH {MASKS} SELECT {RULE_COLUMNS} FROM r WHERE conf >= 0.45 AND s >= 0.1 AND conf / sc >= 0.9 AND bit_count(am) <= 2 AND (({_names('am')}) ILIKE '%eco%' OR ({_names('cm')}) ILIKE '%eco%')")
def filter_rules(spark, folder):
    return R(rules.shown(clean.filter_rules(_rules(spark, folder), 0.45, 0.1, 0.9, 2, "Eco")), 6)


@query(f"WITH {MASKS} SELECT {RULE_COLUMNS} FROM r WHERE conf >= 0.3 AND (cm >> 3) & 1 = 1")
def rules_about_item(spark, folder):
    return R(rules.shown(rules.rules_about(_rules(spark, folder), "PROMO")), 6)


@query(f"WITH {MASKS} SELECT {RULE_COLUMNS}, {_names('am | cm')} AS items FROM r WHERE conf >= 0.3 AND ((am | cm) & 52) = 0")
def rules_within_items(spark, folder):
    allowed = ["ECONOMY", "LARGE", "PROMO"]
    return R(rules.shown(rules.rules_within(_rules(spark, folder), allowed), ["antecedents", "consequents", "items"]), 6)


@query(f"WITH {MASKS} SELECT count(*) AS n_rules, round(avg(conf), 6) AS mean_confidence, round(avg(conf / sc), 6) AS mean_lift, round(avg(s), 6) AS mean_support, round(max(conf / sc), 6) AS max_lift FROM r WHERE conf >= 0.3")
def rule_kpis(spark, folder):
    return R(profile.rule_kpis(_rules(spark, folder)), 6)


@query(f"WITH {MASKS} SELECT {RULE_COLUMNS} FROM r WHERE conf >= 0.3 ORDER BY conf / sc DESC, antecedents, consequents LIMIT 10")
def top_rules(spark, folder):
    return R(rules.shown(rules.order_rules(_rules(spark, folder), "lift", 10)), 6)


@query(f"WITH {MASKS}, d AS (SELECT {_names('am')} AS antecedents, {_names('cm')} AS consequents FROM r WHERE conf >= 0.3) SELECT *, length(antecedents) - length(replace(antecedents, ',', '')) + 1 AS n_antecedents, length(consequents) - length(replace(consequents, ',', '')) + 1 AS n_consequents FROM d")
def rule_lengths(spark, folder):
    from ..functions.text import item_count

    shown = rules.shown(_rules(spark, folder)).select("antecedents", "consequents")
    return shown.withColumns({f"n_{c}": item_count(F.col(c)).cast("long") for c in shown.columns})


@query("""SELECT p_type AS item, round(count(DISTINCT l_orderkey) / (SELECT count(DISTINCT l_orderkey) FROM lineitem JOIN part ON l_partkey = p_partkey), 6) AS support
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def top_items(spark, folder):
    pairs = part_pairs(spark, folder).withColumnRenamed("p_type", "item")
    return R(rules.top_items(pairs, "l_orderkey", "item", 15), 6)


@query("""SELECT l_orderkey, string_agg(p_type, ', ' ORDER BY p_type) AS items FROM (SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1""")
def baskets_from_pairs(spark, folder):
    return rules.shown(rules.baskets_from_pairs(part_pairs(spark, folder), "l_orderkey", "p_type"), ["items"])


@query("""SELECT l_orderkey, string_agg(p_type, ', ' ORDER BY p_type) AS items FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def item_lists(spark, folder):
    return rules.shown(rules.item_lists(part_pairs(spark, folder), "l_orderkey", "p_type"), ["items"])


@query("""SELECT c_custkey, 'c_mktsegment=' || c_mktsegment || ', c_nationkey=' || c_nationkey AS items FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_nationkey FROM customer)
 WHERE c_mktsegment IS NOT NULL""")
def baskets_from_columns(spark, folder):
    rows = table(spark, folder, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return rules.shown(rules.baskets_from_columns(rows, "c_custkey", ["c_mktsegment", "c_nationkey"]), ["items"])


@query("SELECT doc_id, concat_ws(', ', CASE WHEN quality <> 0 THEN 'quality' END, CASE WHEN toxic <> 0 THEN 'toxic' END) AS items FROM labels")
def baskets_from_flags(spark, folder):
    return rules.shown(rules.baskets_from_flags(table(spark, folder, "labels"), "doc_id", ["quality", "toxic"]), ["items"])


@query(r"""SELECT conv_id, turn, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''))), ', ') AS items FROM conversations""")
def baskets_from_lists(spark, folder):
    rows = table(spark, folder, "conversations").withColumn("id", F.struct("conv_id", "turn"))
    made = rules.shown(rules.baskets_from_lists(rows, "id", "text"), ["items"])
    return made.select("id.conv_id", "id.turn", "items")


EVENT_PAIRS = "p AS (SELECT DISTINCT user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS tx, event_type AS item FROM events)"


@query(f"""WITH {EVENT_PAIRS}, n AS (SELECT count(DISTINCT tx) AS n FROM p), s AS (SELECT item, count(*) / any_value(n) AS s FROM p, n GROUP BY 1),
 u AS (SELECT a.item AS x, b.item AS y, count(*) / any_value(n) AS s FROM p a JOIN p b ON a.tx = b.tx AND a.item <> b.item, n GROUP BY 1, 2 HAVING count(*) >= 0.02 * any_value(n))
 SELECT x AS antecedents, y AS consequents, round(u.s, 6) AS support, round(u.s / sx.s, 6) AS confidence, round(u.s / sx.s / sy.s, 6) AS lift
 FROM u JOIN s sx ON sx.item = x JOIN s sy ON sy.item = y WHERE u.s / sx.s >= 0.1""")
def event_pair_rules(spark, folder):
    """Event types that users meet on one day: rules with one item on each side."""
    events = table(spark, folder, "events")
    day = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.to_date("ts").cast("string")).alias("tx")
    baskets = rules.baskets_from_pairs(events.select(day, F.col("event_type").alias("item")), "tx", "item")
    found = rules.association_rules(rules.frequent_itemsets(baskets, 0.02), "confidence", 0.1)
    pairs = found.filter("size(antecedents) = 1 and size(consequents) = 1")
    return R(rules.shown(pairs).select("antecedents", "consequents", "support", "confidence", "lift"), 6)


# ---------------------------------------------------------------- product catalogue

RAW = """raw AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Asus ' || p_name WHEN 1 THEN 'hp ' || p_name ELSE p_name END AS title,
 (10 + p_size % 8) || '.5" screen, Core i' || (3 + 2 * (p_partkey % 4)) || ', ' || (128 * (1 + p_partkey % 9)) || 'GB ' ||
 CASE WHEN p_partkey % 2 = 0 THEN 'SSD' ELSE 'hdd' END || CASE WHEN p_size % 2 = 0 THEN ', ' || 4 * (1 + p_size % 6) || 'GB RAM' ELSE '' END AS description,
 '$' || p_retailprice AS price_text, CASE WHEN p_size % 6 = 5 THEN 'n/a' ELSE CAST(p_size % 6 AS VARCHAR) END AS rating_text,
 (p_partkey % 50) || ' reviews' AS reviews_text FROM part)"""

FEATURES = r"""feat AS (SELECT *, TRY_CAST(replace(regexp_replace(price_text, '[^0-9.,-]', '', 'g'), ',', '') AS DOUBLE) AS price,
 TRY_CAST(rating_text AS DOUBLE) AS rating, TRY_CAST(regexp_extract(reviews_text, '(\d+)', 1) AS BIGINT) AS reviews_count,
 CASE WHEN contains(lower(title), 'asus') THEN 'Asus' WHEN contains(lower(title), 'hp') THEN 'Hp'
 ELSE upper(title[1]) || lower(string_split(title, ' ')[1][2:]) END AS brand,
 TRY_CAST(nullif(regexp_extract(title || ' ' || description, '(?i)(\d+)\s*gb\s*ram', 1), '') AS INTEGER) AS ram_gb,
 TRY_CAST(regexp_extract(title || ' ' || description, '(?i)(\d+)\s*(gb|tb)\s*(ssd|hdd|emmc)?', 1) AS DOUBLE) AS storage_gb,
 upper(regexp_extract(title || ' ' || description, '(?i)(\d+)\s*(gb|tb)\s*(ssd|hdd|emmc)?', 3)) AS storage_type,
 TRY_CAST(regexp_extract(title || ' ' || description, '(\d+(?:\.\d+)?)\s*"', 1) AS DOUBLE) AS screen_inches,
 upper(regexp_extract(title || ' ' || description, '(?i)(i3|i5|i7|i9|ryzen\s*3|ryzen\s*5|ryzen\s*7|celeron|pentium|atom|xeon)', 1)) AS cpu_family FROM raw),
 buck AS (SELECT *, CASE WHEN ram_gb IS NULL THEN 'Unknown' WHEN ram_gb <= 4 THEN '<=4GB' WHEN ram_gb <= 8 THEN '5-8GB' WHEN ram_gb <= 16 THEN '9-16GB' ELSE '>16GB' END AS ram_bucket,
 CASE WHEN storage_gb <= 128 THEN '<=128GB' WHEN storage_gb <= 256 THEN '129-256GB' WHEN storage_gb <= 512 THEN '257-512GB' WHEN storage_gb <= 1024 THEN '513GB-1TB' ELSE '>1TB' END AS storage_bucket,
 CASE WHEN rating IS NULL THEN 'Unknown' WHEN rating <= 2 THEN 'Low' WHEN rating <= 3 THEN 'Medium' ELSE 'High' END AS rating_bucket,
 CAST(storage_type = 'SSD' AS INTEGER) AS has_ssd, CAST(storage_type = 'HDD' AS INTEGER) AS has_hdd FROM feat)"""

DATASET = """prod AS (SELECT * FROM buck QUALIFY row_number() OVER (PARTITION BY title, price, description ORDER BY p_partkey) = 1),
 cuts AS (SELECT quantile_cont(price, 0.33) AS q1, quantile_cont(price, 0.66) AS q2 FROM prod),
 seg AS (SELECT *, CASE WHEN price <= q1 THEN 'Budget' WHEN price <= q2 THEN 'MidRange' ELSE 'Premium' END AS price_segment FROM prod, cuts)"""

TOP_WORDS = """words AS (SELECT word FROM (SELECT unnest(regexp_extract_all(lower(title || ' ' || description), '[a-zA-Z]{4,}')) AS word FROM raw)
 WHERE word NOT IN ('with', 'from', 'have', 'this', 'that', 'your', 'laptop', 'notebook', 'intel', 'windows', 'inch', 'black', 'white', 'silver', 'gray')
 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 15)"""


def raw_catalogue(spark, folder) -> DataFrame:
    """Catalogue text composed from the part table."""
    p, size = F.col("p_partkey"), F.col("p_size")
    text = lambda c: c.cast("string")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.when(p % 3 == 0, F.concat(F.lit("Asus "), "p_name")).when(p % 3 == 1, F.concat(F.lit("hp "), "p_name"))
        .otherwise(F.col("p_name")).alias("title"),
        F.concat(
            text(10 + size % 8), F.lit('.5" screen, Core i'), text(3 + 2 * (p % 4)), F.lit(", "), text(128 * (1 + p % 9)),
            F.lit("GB "), F.when(p % 2 == 0, "SSD").otherwise("hdd"),
            F.when(size % 2 == 0, F.concat(F.lit(", "), text(4 * (1 + size % 6)), F.lit("GB RAM"))).otherwise(""),
        ).alias("description"),
        F.concat(F.lit("$"), text(F.col("p_retailprice"))).alias("price_text"),
        F.when(size % 6 == 5, "n/a").otherwise(text(size % 6)).alias("rating_text"),
        F.concat(text(p % 50), F.lit(" reviews")).alias("reviews_text"),
    )


FEATURE_LIST = [
    "p_partkey", "price", "rating", "reviews_count", "brand", "ram_gb", "storage_gb", "storage_type", "screen_inches",
    "cpu_family", "ram_bucket", "storage_bucket", "rating_bucket", "has_ssd", "has_hdd",
]


@query(f"WITH {RAW}, {FEATURES} SELECT {', '.join(FEATURE_LIST)} FROM buck")
def product_features(spark, folder):
    return products.features(raw_catalogue(spark, folder)).select(*FEATURE_LIST)


@query(f"WITH {RAW}, {FEATURES}, {DATASET} SELECT {', '.join(FEATURE_LIST)}, price_segment, CAST(price_segment = 'Premium' AS INTEGER) AS is_premium FROM seg")
def product_dataset(spark, folder):
    made, _, _ = products.prepare(raw_catalogue(spark, folder), ["p_partkey"])
    return made.select(*FEATURE_LIST, "price_segment", "is_premium")


@query(f"WITH {RAW}, {TOP_WORDS} SELECT p_partkey, 'kw_' || word AS keyword, CAST(regexp_matches(lower(title || ' ' || description), '\\b' || word || '\\b') AS DOUBLE) AS value FROM raw, words")
def product_keyword_flags(spark, folder):
    raw = raw_catalogue(spark, folder)
    words = products.top_words(raw, products.full_text())
    flagged = reshape.word_flags(raw, F.lower(products.full_text()), words)
    return reshape.melt(flagged, ["p_partkey"], [f"kw_{w}" for w in words], "keyword")


@query("""WITH words AS (SELECT word FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-zA-Z]{4,}')) AS word FROM documents)
 WHERE word NOT IN ('with', 'from', 'have', 'this', 'that', 'your', 'laptop', 'notebook', 'intel', 'windows', 'inch', 'black', 'white', 'silver', 'gray')
 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 15)
 SELECT 'kw_' || word AS keyword, count(*) AS n_documents FROM documents, words WHERE regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])' || word || '([^\\p{L}\\p{N}_]|$)') GROUP BY 1""")
def document_keywords(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    words = products.top_words(docs, F.col("text"))
    flagged = reshape.word_flags(docs, F.lower("text"), words)
    totals = flagged.agg(*[F.sum(f"kw_{w}").alias(f"kw_{w}") for w in words])
    long = reshape.melt(totals, [], [f"kw_{w}" for w in words], "keyword")
    return long.filter("value > 0").select("keyword", F.col("value").cast("long").alias("n_documents"))


SLUG = "coalesce(nullif(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9áéíóúñü]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'na')"
ITEMS = " UNION ALL ".join(
    [f"SELECT p_partkey, '{c}=' || {SLUG.format(c)} AS item FROM seg"
     for c in ("brand", "price_segment", "ram_bucket", "storage_bucket", "cpu_family", "rating_bucket")]
    + [f"SELECT p_partkey, 'storage_type={t}' FROM seg WHERE has_{t} = 1" for t in ("ssd", "hdd")]
    + ["SELECT p_partkey, 'keyword=' || word FROM seg, words WHERE regexp_matches(lower(title || ' ' || description), '\\b' || word || '\\b')"]
)


@query(f"WITH {RAW}, {FEATURES}, {DATASET}, {TOP_WORDS} {ITEMS}")
def product_transactions(spark, folder):
    made, _, _ = products.prepare(raw_catalogue(spark, folder), ["p_partkey"])
    return products.transactions(made, "p_partkey")


@query()
def product_rules(spark, folder):
    """All rules over product descriptions at the catalogue's support and confidence."""
    made, _, _ = products.prepare(raw_catalogue(spark, folder), ["p_partkey"])
    return R(rules.shown(products.mine(made, "p_partkey")["rules"]), 6)


@query(f"""WITH {RAW}, {FEATURES}, {DATASET}, {TOP_WORDS}, p AS ({ITEMS}), n AS (SELECT count(*) AS n FROM seg), s AS (SELECT item, count(*) / any_value(n) AS s FROM p, n GROUP BY 1),
 u AS (SELECT a.item AS x, b.item AS y, count(*) / any_value(n) AS s FROM p a JOIN p b ON a.p_partkey = b.p_partkey AND a.item <> b.item, n GROUP BY 1, 2 HAVING count(*) >= 0.1 * any_value(n))
 SELECT x AS antecedents, y AS consequents, round(u.s, 6) AS support, round(u.s / sx.s, 6) AS confidence, round(u.s / sx.s / sy.s, 6) AS lift
 FROM u JOIN s sx ON sx.item = x JOIN s sy ON sy.item = y WHERE u.s / sx.s >= 0.55""")
def product_pair_rules(spark, folder):
    made, _, _ = products.prepare(raw_catalogue(spark, folder), ["p_partkey"])
    pairs = products.mine(made, "p_partkey")["rules"].filter("size(antecedents) = 1 and size(consequents) = 1")
    return R(rules.shown(pairs).select("antecedents", "consequents", "support", "confidence", "lift"), 6)


@query(f"""WITH {RAW}, {FEATURES}, {DATASET} SELECT p_partkey, price, coalesce(rating, (SELECT quantile_cont(rating, 0.5) FROM seg)) AS rating,
 coalesce(ram_gb, (SELECT quantile_cont(ram_gb, 0.5) FROM seg))::DOUBLE AS ram_gb, CAST(brand = 'Asus' AS INTEGER) AS "brand_Asus", CAST(brand = 'Hp' AS INTEGER) AS "brand_Hp",
 CAST(rating_bucket = 'Unknown' AS INTEGER) AS "rating_bucket_Unknown", price_segment FROM seg""")
def product_model_table(spark, folder):
    made, _, _ = products.prepare(raw_catalogue(spark, folder), ["p_partkey"])
    coded = products.model_table(made, "p_partkey")
    return coded.select(
        F.col("p_partkey").cast("long").alias("p_partkey"), "price", "rating", F.col("ram_gb").cast("double").alias("ram_gb"),
        "brand_Asus", "brand_Hp", "rating_bucket_Unknown", "price_segment",
    )


@query(f"WITH {RAW}, {FEATURES}, {DATASET} SELECT p_partkey, title, brand, price_segment FROM seg WHERE brand IN ('Asus', 'Hp') AND price_segment IN ('Premium') AND contains(lower(title), 'ring')")
def catalogue_filter(spark, folder):
    made, _, _ = products.prepare(raw_catalogue(spark, folder), ["p_partkey"])
    return clean.filter_products(made, ["Asus", "Hp"], ["Premium"], "Ring").select("p_partkey", "title", "brand", "price_segment")
