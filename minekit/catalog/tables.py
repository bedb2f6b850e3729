"""Scans, cleaning, filters, joins, aggregates, windows, sorts, reshaping and encoding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from ..operators import clean, encode, profile, reshape
from ..plans.bounds import shared_dir
from ..sources import readers, writers
from .registry import query, table

R = clean.round_numbers


def scratch(spark) -> str:
    """A new folder under the shared one; executors write and read it."""
    return f"{shared_dir(spark).rstrip('/')}/minekit-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- sources and sinks

@query(f"SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, "
       "o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_comma_scan(spark, folder):
    path = scratch(spark)
    orders = table(spark, folder, "orders").drop("o_orderdate")
    # An exported index arrives as a first column without a name.
    writers.write_csv(orders.select(F.col("o_orderkey").alias("Unnamed: 0"), "*"), path)
    return readers.read_csv(spark, path, mode=1)


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_semicolon_scan(spark, folder):
    path = scratch(spark)
    part = table(spark, folder, "part")
    writers.write_csv(part, path, sep=";")
    return readers.read_csv(spark, path, mode=2, schema=part.schema)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_tab_scan(spark, folder):
    path = scratch(spark)
    customer = table(spark, folder, "customer")
    writers.write_csv(customer, path, sep="\t")
    return readers.read_delimited(spark, path, "\t", schema=customer.schema)


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {i} AS position, count(*) - count({c}) AS nulls FROM lineitem""" for i, c in enumerate(
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus", "l_shipdate"], 1)
))
def header_scan(spark, folder):
    """Column order comes from the header alone; the counts read the rows."""
    lines = table(spark, folder, "lineitem")
    places = {name: i for i, (name, _) in enumerate(readers.header(lines), 1)}
    place = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    return profile.null_counts(lines).select("column", place[F.col("column")].alias("position"), "nulls")


@query("SELECT event_id, user_id, event_type, value FROM events")
def json_scan(spark, folder):
    path = scratch(spark)
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    writers.write_json(events, path)
    return readers.read_json(spark, path, schema=events.schema)


@query("SELECT item_id, text FROM benchmark")
def missing_file_scan(spark, folder):
    """An artefact that was never written adds no rows."""
    known = table(spark, folder, "benchmark")
    extra = readers.read_csv_or_empty(spark, f"{shared_dir(spark)}/no-such-file.csv", known.schema)
    return reshape.stack([known, extra])


@query("SELECT 'orders' AS artefact, count(*) AS n_rows FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def manifest_bundle(spark, folder):
    """Write two tables and their manifest, open them again through it, count what comes back."""
    path = scratch(spark)
    made = {n: table(spark, folder, n).select(k) for n, k in (("orders", "o_orderkey"), ("part", "p_partkey"))}
    writers.write_bundle(spark, path, made, {"scenario": "tables", "random_state": 42})
    opened = readers.read_bundle(spark, f"{path}/manifest.json")
    counts = [d.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("artefact"), "n_rows") for n, d in opened.items()]
    return reshape.stack(counts)


# ---------------------------------------------------------------- projection, cleaning, casting


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_numeric(spark, folder):
    return clean.select_numeric(table(spark, folder, "lineitem"))


@query("SELECT o_orderkey AS order_key, o_orderstatus AS status FROM orders")
def strip_header_quotes(spark, folder):
    odd = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias(' "order_key" '), F.col("o_orderstatus").alias('"status"')
    )
    return clean.strip_header_quotes(odd)


@query("SELECT o_orderkey AS order_key, o_totalprice AS total_price_usd FROM orders")
def slugify_header(spark, folder):
    odd = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Order  Key!"), F.col("o_totalprice").alias("  Total-Price (USD)")
    )
    return clean.slugify_header(odd)


@query("SELECT p_partkey AS part_id, p_name, p_brand AS brand, p_type, p_size, p_retailprice FROM part")
def rename_columns(spark, folder):
    return clean.rename_columns(table(spark, folder, "part"), {"p_partkey": "part_id", "p_brand": "brand", "zz": "y"})


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def drop_columns(spark, folder):
    gone = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate", "zz"]
    return clean.drop_columns(table(spark, folder, "lineitem"), gone)


@query("SELECT l_quantity, l_discount, l_extendedprice AS label FROM lineitem")
def features_and_target(spark, folder):
    return clean.features_and_target(table(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS day FROM orders""")
def to_datetime(spark, folder):
    day = F.col("o_orderdate")
    texts = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, "not a date")
        .when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("day"),
    )
    return clean.to_datetime(texts, ["day"], ["dd/MM/yyyy"])


@query("SELECT p_partkey, TRY_CAST(CASE WHEN p_size % 5 = 0 THEN 'x' || p_size ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS size FROM part")
def to_number(spark, folder):
    size = F.col("p_size").cast("string")
    texts = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("x"), size)).otherwise(size).alias("size")
    )
    return clean.to_number(texts, ["size"])


@query(r"""SELECT doc_id, lower(regexp_replace(regexp_replace(translate(text, '"''', ''), '\s+', ' ', 'g'),
       '^\s+|\s+$', '', 'g')) AS text FROM documents""")
def clean_text(spark, folder):
    return clean.clean_text(table(spark, folder, "documents").select("doc_id", "text"), ["text"], lower=True)


@query(r"SELECT conv_id, turn, regexp_replace(text, '([A-Z])([a-z]+)', '\2\1', 'g') AS text FROM conversations")
def replace_regex(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return clean.replace_regex(rows, ["text"], "([A-Z])([a-z]+)", "$2$1")


@query(r"""SELECT event_id, TRY_CAST(regexp_replace(replace(replace(regexp_replace('EUR -1.' || event_id || ',' ||
       props, '\s', '', 'g'), '.', ''), ',', '.'), '[^0-9.\-+]', '', 'g') AS DOUBLE) AS amount,
       TRY_CAST(regexp_replace(props, '[^0-9.]', '', 'g') AS DOUBLE) AS k FROM events""")
def number_from_text(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("EUR -1."), "event_id", F.lit(","), "props").alias("amount"), F.col("props").alias("k")
    )
    rows = clean.number_from_text(rows, ["amount"], decimal=",", thousands=".")
    return clean.number_from_text(rows, ["k"], keep_sign=False)


@query(r"""SELECT p_partkey, TRY_CAST(replace(regexp_replace(p_brand || ' 1,0', '[^0-9.,-]', '', 'g'), ',', '') AS DOUBLE) AS price,
       TRY_CAST(replace(regexp_replace(p_name, '[^0-9.,-]', '', 'g'), ',', '') AS DOUBLE) AS no_price FROM part""")
def safe_float(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", text.safe_float(F.concat("p_brand", F.lit(" 1,0"))).alias("price"),
        text.safe_float(F.col("p_name")).alias("no_price"),
    )


@query(r"""SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '(\d+)', 1), '') AS BIGINT) AS first_number FROM documents""")
def safe_int(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.safe_int(F.col("text")).alias("first_number"))


@query(r"""SELECT conv_id, turn, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(lower(trim(text)),
       '[^a-z0-9áéíóúñü]+', '_', 'g'), '^_+|_+$', '', 'g'), '_+', '_', 'g'), ''), 'na') AS slug FROM conversations""")
def slugify_text(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", text.slugify(F.col("text")).alias("slug"))


@query("SELECT doc_id, CAST(quality AS INTEGER) AS quality FROM labels")
def remap_binary_target(spark, folder):
    signed = table(spark, folder, "labels").select("doc_id", (F.col("quality") * 2 - 1).alias("quality"))
    return clean.remap_binary_target(signed, "quality")


@query("SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS label FROM orders")
def encode_labels(spark, folder):
    coded, _ = encode.encode_labels(table(spark, folder, "orders"), "o_orderpriority")
    return coded.select("o_orderkey", "label")


@query("SELECT doc_id, toxic FROM labels WHERE toxic = 1")
def positive_label(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return labels.filter(F.col("toxic") == encode.positive_label(labels, "toxic"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS balance,
       nullif(c_mktsegment, 'BUILDING') AS segment FROM customer""")
def null_out(spark, folder):
    bal = F.col("c_acctbal")
    odd = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(bal < 0, float("nan")).when(bal > 9000, float("inf")).otherwise(bal).alias("balance"),
        F.when(F.col("c_mktsegment") == "BUILDING", "None").otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    return clean.null_out(odd)


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 4) AS share FROM lineitem")
def round_numbers(spark, folder):
    return R(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 7).alias("share")))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders")
def date_text(spark, folder):
    return clean.date_text(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate"])


@query("SELECT o_orderpriority AS model_name, round(avg(o_totalprice), 4) AS F1_Pos, round(max(o_totalprice), 4) AS Accuracy FROM orders GROUP BY 1")
def tidy_metric_table(spark, folder):
    raw = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("model_name")).agg(
        F.lit("None").alias("ROC_AUC_Pos"), F.max("o_totalprice").cast("string").alias("Accuracy"),
        F.avg("o_totalprice").alias("F1_Pos"),
    )
    return R(clean.tidy_metric_table(raw, ["Accuracy", "F1_Pos", "ROC_AUC_Pos"], ["model_name", "F1_Pos"]))


@query("SELECT event_id, CAST(hour(ts) AS INTEGER) AS ts_Hour, CAST(isodow(ts) - 1 AS INTEGER) AS ts_DayOfWeek FROM events")
def time_parts(spark, folder):
    return clean.time_parts(table(spark, folder, "events").select("event_id", "ts"), "ts")


# ---------------------------------------------------------------- filters, nulls, duplicates

GAPPY = """gappy AS (SELECT c_custkey, nullif(c_nationkey, 3) AS nation, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
 nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)"""


def gappy(spark, folder) -> DataFrame:
    """Customers with nulls in three columns."""
    return table(spark, folder, "customer").select(
        "c_custkey", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
    )


@query(f"WITH {GAPPY} SELECT * FROM gappy WHERE nation IS NOT NULL AND balance IS NOT NULL AND segment IS NOT NULL")
def drop_null_rows(spark, folder):
    return clean.drop_nulls(gappy(spark, folder))


@query(f"WITH {GAPPY} SELECT * FROM gappy WHERE segment IS NOT NULL")
def drop_nulls_in(spark, folder):
    return clean.drop_nulls(gappy(spark, folder), ["segment"])


@query("SELECT DISTINCT l_quantity, l_discount, l_returnflag FROM lineitem")
def distinct_rows(spark, folder):
    return clean.drop_duplicates(table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_returnflag"))


@query("SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def keep_first_per_key(spark, folder):
    return clean.drop_duplicates(table(spark, folder, "documents"), ["text"], ["doc_id"])


@query("SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_tax FROM lineitem)) AS duplicate_rows FROM lineitem")
def duplicate_count(spark, folder):
    return clean.duplicate_count(table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax"))


@query(f"""WITH {GAPPY}, d AS (SELECT DISTINCT nation, balance, segment FROM gappy),
 f AS (SELECT coalesce(nation, (SELECT avg(nation) FROM d)) AS nation, coalesce(balance, (SELECT avg(balance) FROM d)) AS balance, segment FROM d)
 SELECT round(nation, 4) AS nation, round(balance, 4) AS balance,
 CAST(coalesce(segment = 'FURNITURE', false) AS INTEGER) AS segment_FURNITURE,
 CAST(coalesce(segment = 'HOUSEHOLD', false) AS INTEGER) AS segment_HOUSEHOLD,
 CAST(coalesce(segment = 'MACHINERY', false) AS INTEGER) AS segment_MACHINERY FROM f""")
def prepare_for_display(spark, folder):
    return R(clean.prepare_for_display(gappy(spark, folder), ["c_custkey"], "mean", one_hot=True))


SUPERVISED = f"""WITH {GAPPY}, d AS (SELECT DISTINCT nation, balance, segment FROM gappy),
 l AS (SELECT * FROM d WHERE balance IS NOT NULL)"""


@query(SUPERVISED + """ SELECT nation, balance, CAST(coalesce(segment = 'FURNITURE', false) AS INTEGER) AS segment_FURNITURE,
 CAST(coalesce(segment = 'HOUSEHOLD', false) AS INTEGER) AS segment_HOUSEHOLD,
 CAST(coalesce(segment = 'MACHINERY', false) AS INTEGER) AS segment_MACHINERY FROM l WHERE nation IS NOT NULL""")
def supervised_table(spark, folder):
    return clean.supervised_table(gappy(spark, folder), "balance", exclude=["c_custkey"])[0]


@query(SUPERVISED + """ SELECT (SELECT count(*) FROM gappy) AS rows_initial,
 (SELECT count(*) FROM l WHERE nation IS NOT NULL) AS rows_final,
 (SELECT count(*) FROM gappy) - (SELECT count(*) FROM d) AS dropped_duplicates,
 (SELECT count(*) FROM d) - (SELECT count(*) FROM l) AS dropped_null_target,
 (SELECT count(*) FROM l WHERE nation IS NULL) AS dropped_null_features""")
def supervised_audit(spark, folder):
    return clean.supervised_table(gappy(spark, folder), "balance", exclude=["c_custkey"])[1]


@query(f"""WITH {GAPPY} SELECT c_custkey, round(coalesce(nation, (SELECT avg(nation) FROM gappy)), 4) AS nation,
 round(coalesce(balance, (SELECT avg(balance) FROM gappy)), 4) AS balance, segment FROM gappy""")
def impute_mean(spark, folder):
    out = clean.impute(gappy(spark, folder), "mean")
    return R(out.withColumn("c_custkey", F.col("c_custkey").cast("long")))


@query(f"""WITH {GAPPY} SELECT c_custkey, round(coalesce(nation, (SELECT quantile_cont(nation, 0.5) FROM gappy)), 4) AS nation,
 round(coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM gappy)), 4) AS balance, segment FROM gappy""")
def impute_median(spark, folder):
    out = clean.impute(gappy(spark, folder), "median")
    return R(out.withColumn("c_custkey", F.col("c_custkey").cast("long")))


@query(f"""WITH {GAPPY} SELECT c_custkey,
 coalesce(nation, (SELECT nation FROM gappy WHERE nation IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS nation,
 coalesce(balance, (SELECT balance FROM gappy WHERE balance IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS balance,
 coalesce(segment, (SELECT segment FROM gappy WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS segment FROM gappy""")
def impute_mode(spark, folder):
    return clean.impute(gappy(spark, folder), "mode")


@query(f"""WITH {GAPPY} SELECT c_custkey, round(coalesce(balance, (SELECT quantile_cont(balance, 0.5) FROM gappy)), 4) AS balance,
 0.0::DOUBLE AS empty, coalesce(segment, 'Unknown') AS segment FROM gappy""")
def impute_for_model(spark, folder):
    rows = gappy(spark, folder).select("c_custkey", "balance", F.lit(None).cast("double").alias("empty"), "segment")
    out = clean.impute_for_model(rows)
    return R(out.withColumn("c_custkey", F.col("c_custkey").cast("long")))


@query("SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE p_brand IN ('Brand#2', 'Brand#17') AND p_type IN ('ECONOMY', 'SMALL') AND contains(lower(p_name), 'bolt')")
def filter_products(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return clean.filter_products(
        rows, ["Brand#2", "Brand#17"], ["ECONOMY", "SMALL"], "BOLT", "p_brand", "p_type", "p_name"
    )


@query(r"SELECT doc_id, text FROM documents WHERE regexp_matches(text, '(?i)\bthe [a-z]+ing\b')")
def regex_filter(spark, folder):
    return clean.regex_filter(table(spark, folder, "documents").select("doc_id", "text"), "text", r"\bthe [a-z]+ing\b", True)


@query("SELECT page_id, url FROM pages WHERE contains(url, 'page=')")
def link_filter(spark, folder):
    return table(spark, folder, "pages").select("page_id", "url").filter(F.col("url").contains("page="))


@query(f"""WITH {GAPPY} SELECT * FROM (SELECT 'nation' AS "column", count_if(nation IS NULL) > 0 AS has_nulls, true AS is_numeric FROM gappy
 UNION ALL SELECT 'balance', count_if(balance IS NULL) > 0, true FROM gappy
 UNION ALL SELECT 'segment', count_if(segment IS NULL) > 0, false FROM gappy
 UNION ALL SELECT 'c_custkey', count_if(c_custkey IS NULL) > 0, true FROM gappy)""")
def columns_with_nulls(spark, folder):
    rows = gappy(spark, folder)
    holes, numbers = clean.columns_with_nulls(rows), clean.split_by_type(rows)[0]
    return spark.createDataFrame(
        [(c, c in holes, c in numbers) for c in rows.columns], "column string, has_nulls boolean, is_numeric boolean"
    )


# ---------------------------------------------------------------- joins in disguise


@query("SELECT vec_id, label, CAST(vec_id % 4 AS INTEGER) AS cluster FROM embeddings")
def carry_columns(spark, folder):
    source = table(spark, folder, "embeddings")
    derived = source.select("vec_id", (F.col("vec_id") % 4).cast("int").alias("cluster"))
    return reshape.carry_columns(derived, source, "vec_id", ["label"])


@query("""WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS o_orderdate FROM orders),
 span AS (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM days),
 cal AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS o_orderdate FROM span)
 SELECT cal.o_orderdate FROM cal ANTI JOIN days USING (o_orderdate)""")
def missing_dates(spark, folder):
    return reshape.missing_dates(table(spark, folder, "orders"), "o_orderdate")


@query("""WITH days AS (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders),
 span AS (SELECT o_orderpriority, min(o_orderdate) AS a, max(o_orderdate) AS b FROM days GROUP BY 1),
 cal AS (SELECT o_orderpriority, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS o_orderdate FROM span)
 SELECT cal.* FROM cal ANTI JOIN days USING (o_orderpriority, o_orderdate)""")
def missing_dates_per_series(spark, folder):
    return reshape.missing_dates(table(spark, folder, "orders"), "o_orderdate", ["o_orderpriority"])


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS shown FROM orders")
def map_labels(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return reshape.map_labels(rows, "o_orderstatus", {"F": "Filled", "O": "Open"}, "shown").drop("o_orderstatus")


@query("""WITH a AS (SELECT o_orderpriority AS metric, max(o_totalprice) AS value FROM orders WHERE o_orderpriority < '4' GROUP BY 1),
 b AS (SELECT o_orderpriority AS metric, min(o_totalprice) AS value FROM orders WHERE o_orderpriority > '2' GROUP BY 1)
 SELECT coalesce(a.metric, b.metric) AS metric, a.value AS holdout, b.value AS cv FROM a FULL JOIN b ON a.metric = b.metric""")
def compare_metrics(spark, folder):
    rows = table(spark, folder, "orders")
    left = rows.filter("o_orderpriority < '4'").groupBy(F.col("o_orderpriority").alias("metric")).agg(F.max("o_totalprice").alias("value"))
    right = rows.filter("o_orderpriority > '2'").groupBy(F.col("o_orderpriority").alias("metric")).agg(F.min("o_totalprice").alias("value"))
    return reshape.compare_metrics(left, right)


WORDS = ["the", "que", "and", "de", "und", "para"]


@query("SELECT doc_id, " + ", ".join(
    rf"CAST(regexp_matches(lower(text), '(^|[^\p{{L}}\p{{N}}_]){w}([^\p{{L}}\p{{N}}_]|$)') AS INTEGER) AS kw_{w}" for w in WORDS
) + " FROM documents")
def word_flags(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "text")
    return reshape.word_flags(rows, F.lower("text"), WORDS).drop("text")


@query("""WITH base AS (SELECT c_mktsegment AS segment, avg(c_acctbal) AS score FROM customer GROUP BY 1),
 new AS (SELECT c_mktsegment AS segment, max(c_acctbal) AS score FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') GROUP BY 1)
 SELECT segment, round(score, 4) AS score FROM (SELECT * FROM base ANTI JOIN new USING (segment) UNION ALL SELECT * FROM new)""")
def upsert_rows(spark, folder):
    rows = table(spark, folder, "customer").withColumnRenamed("c_mktsegment", "segment")
    base = rows.groupBy("segment").agg(F.avg("c_acctbal").alias("score"))
    new = rows.filter(F.col("segment").isin("BUILDING", "FURNITURE")).groupBy("segment").agg(F.max("c_acctbal").alias("score"))
    return R(reshape.upsert_rows(base, new, "segment", "score"))


# ---------------------------------------------------------------- aggregates and profiles

NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std,
    round(min({c})::DOUBLE, 3) AS min, round(quantile_cont({c}, 0.25)::DOUBLE, 3) AS q25, round(quantile_cont({c}, 0.5)::DOUBLE, 3) AS q50,
    round(quantile_cont({c}, 0.75)::DOUBLE, 3) AS q75, round(max({c})::DOUBLE, 3) AS max FROM lineitem""" for c in NUMERIC
))
def describe(spark, folder):
    return R(profile.describe(table(spark, folder, "lineitem")), 3)


@query(f"WITH {GAPPY} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
    count(DISTINCT {c}) AS distinct_values FROM gappy"""
    for c, t in [("c_custkey", "bigint"), ("nation", "int"), ("balance", "double"), ("segment", "string")]
))
def column_profile(spark, folder):
    return profile.column_profile(gappy(spark, folder))


@query(f"WITH {GAPPY} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct FROM gappy"""
    for c in ["c_custkey", "nation", "balance", "segment"]
))
def null_counts(spark, folder):
    return R(profile.null_counts(gappy(spark, folder)))


@query(f"WITH {GAPPY} SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct FROM gappy"""
    for c in ["c_custkey", "nation", "balance", "segment"]
) + ") WHERE nulls > 0")
def null_table(spark, folder):
    return R(profile.null_table(gappy(spark, folder)))


@query(f"""WITH {GAPPY} SELECT CAST(sum((nation IS NULL)::INT + (balance IS NULL)::INT + (segment IS NULL)::INT) AS BIGINT) AS total_nulls FROM gappy""")
def total_nulls(spark, folder):
    return profile.total_nulls(gappy(spark, folder))


@query(f'WITH {GAPPY} SELECT segment, count(*) AS "count" FROM gappy GROUP BY 1')
def value_counts_with_null(spark, folder):
    return profile.value_counts(gappy(spark, folder), "segment", keep_null=True)


@query(f'WITH {GAPPY} SELECT segment, count(*) AS "count" FROM gappy WHERE segment IS NOT NULL GROUP BY 1')
def value_counts(spark, folder):
    return profile.value_counts(gappy(spark, folder), "segment")


@query("SELECT count(*) FILTER (toxic = 1) AS positives, count(*) FILTER (toxic <> 1) AS negatives, '1:' || CAST(round(count_if(toxic = 1) / count_if(toxic <> 1)) AS BIGINT) AS ratio FROM labels")
def class_ratio(spark, folder):
    return profile.class_ratio(table(spark, folder, "labels"), "toxic", 1)


@query("""WITH c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
 SELECT (SELECT count(*) FROM lineitem) AS n_rows, 4 AS n_columns, CAST(0 AS BIGINT) AS total_nulls,
 (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem)) AS duplicate_rows,
 count(*) AS n_classes, max(n) AS largest_class, min(n) AS smallest_class FROM c""")
def dataset_summary(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag")
    return profile.dataset_summary(rows, "l_returnflag")


CORR = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in CORR for b in CORR
))
def correlations(spark, folder):
    return R(profile.correlations(table(spark, folder, "lineitem"), CORR), 6)


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(corr({c}, l_extendedprice), 6) AS r FROM lineitem""" for c in NUMERIC if c != "l_extendedprice"
))
def target_correlations(spark, folder):
    return R(profile.target_correlations(table(spark, folder, "lineitem"), "l_extendedprice"), 6)


@query("""SELECT "column", round(r, 6) AS r, round(abs(r), 6) AS abs_r FROM (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", corr({c}, l_extendedprice) AS r FROM lineitem""" for c in NUMERIC if c != "l_extendedprice"
) + """) ORDER BY abs(r) DESC, "column" LIMIT 3""")
def top_target_correlations(spark, folder):
    return R(profile.top_target_correlations(table(spark, folder, "lineitem"), "l_extendedprice", 3), 6)


@query("""WITH m AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 8 AS w FROM orders),
 b AS (SELECT CAST(least(floor((o_totalprice - lo) / w), 7) AS INTEGER) AS bin, lo, w FROM orders, m)
 SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 4) AS bin_start, round(lo + i * w + w, 4) AS bin_end, (SELECT count(*) FROM b WHERE bin = i) AS "count"
 FROM m, range(8) AS t(i)""")
def histogram(spark, folder):
    return R(profile.histogram(table(spark, folder, "orders"), "o_totalprice", 8))


@query("""WITH m AS (SELECT min(value) AS lo, (max(value) - min(value)) / 10 AS w FROM events),
 b AS (SELECT event_type, CAST(least(floor((value - lo) / w), 9) AS INTEGER) AS bin, lo, w FROM events, m)
 SELECT e.event_type, CAST(i AS INTEGER) AS bin, round(m.lo + i * m.w, 4) AS bin_start, round(m.lo + i * m.w + m.w, 4) AS bin_end,
 (SELECT count(*) FROM b WHERE b.event_type = e.event_type AND b.bin = i) AS "count"
 FROM m, (SELECT DISTINCT event_type FROM events) AS e, range(10) AS t(i)""")
def histogram_by_colour(spark, folder):
    return R(profile.histogram(table(spark, folder, "events"), "value", 10, ["event_type"]))


@query("""WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
 SELECT event_type, count(*) AS "count", round(any_value(q1), 4) AS q1, round(any_value(q2), 4) AS median, round(any_value(q3), 4) AS q3,
 round(min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
 round(max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
 count(*) FILTER (NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers FROM events JOIN q USING (event_type) GROUP BY 1""")
def boxplot(spark, folder):
    return R(profile.boxplot(table(spark, folder, "events"), "value", ["event_type"]))


@query("""SELECT p_type, round(p_retailprice, 4) AS p_retailprice FROM part JOIN (SELECT p_type, quantile_cont(p_retailprice, 0.25) AS a,
 quantile_cont(p_retailprice, 0.75) AS b FROM part GROUP BY 1) USING (p_type) WHERE p_retailprice > b OR p_retailprice < a""")
def outside_quartiles(spark, folder):
    rows = table(spark, folder, "part").select("p_type", "p_retailprice")
    cut = profile.series_summary(rows, "p_retailprice", ["p_type"]).select("p_type", "q25", "q75")
    marked = reshape.attach_facts(rows, cut, ["p_type"])
    return R(marked.filter("p_retailprice > q75 or p_retailprice < q25").select("p_type", "p_retailprice"))


@query("""SELECT event_type, count(value) AS "count", round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min,
 round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q75,
 round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 4) AS iqr, round(max(value), 4) AS max FROM events GROUP BY 1""")
def series_summary(spark, folder):
    return R(profile.series_summary(table(spark, folder, "events"), "value", ["event_type"]))


@query("SELECT round(quantile_cont(l_extendedprice, 0.5), 4) AS l_extendedprice, round(quantile_cont(l_discount, 0.3), 4) AS l_discount FROM lineitem")
def column_quantiles(spark, folder):
    return R(profile.column_quantiles(table(spark, folder, "lineitem"), {"l_extendedprice": 0.5, "l_discount": 0.3}))


@query("""WITH g AS (SELECT event_type, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts)) AS gap FROM events)
 SELECT event_type, gap / 1e6 AS gap_seconds FROM g""")
def gaps(spark, folder):
    return profile.gaps(table(spark, folder, "events"), "ts", ["event_type"]).drop("ts")


@query("""WITH d AS (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders),
 g AS (SELECT o_orderpriority, (day - lag(day) OVER (PARTITION BY o_orderpriority ORDER BY day)) * 86400.0::DOUBLE AS gap_seconds FROM d),
 m AS (SELECT o_orderpriority, gap_seconds, count(*) AS n FROM g WHERE gap_seconds IS NOT NULL GROUP BY 1, 2)
 SELECT o_orderpriority, gap_seconds, CASE WHEN gap_seconds <= 86400 THEN 'Diaria' WHEN gap_seconds <= 7 * 86400 THEN 'Semanal' ELSE 'Mensual' END AS frequency
 FROM m QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, gap_seconds) = 1""")
def frequency(spark, folder):
    days = table(spark, folder, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("day")).distinct()
    return profile.frequency(days, "day", ["o_orderpriority"])


@query("SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def quick_look(spark, folder):
    return profile.quick_look(table(spark, folder, "lineitem"))[0]


@query("""SELECT l_returnflag, round(avg(l_quantity), 4) AS l_quantity, round(avg(l_tax), 4) AS l_tax,
 round(stddev_samp(l_quantity), 4) AS l_quantity_std, round(stddev_samp(l_tax), 4) AS l_tax_std FROM lineitem GROUP BY 1""")
def metric_summary(spark, folder):
    return R(profile.metric_summary(table(spark, folder, "lineitem"), ["l_returnflag"], ["l_quantity", "l_tax"]))


@query("""SELECT label, round(avg(embedding[1]), 5) AS axis_1, round(avg(embedding[2]), 5) AS axis_2, count(*) AS n_points FROM embeddings GROUP BY 1""")
def centroids(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        "label", *[F.col("embedding")[i].cast("double").alias(f"axis_{i + 1}") for i in range(2)]
    )
    return R(profile.centroids(rows, "label", ["axis_1", "axis_2"]), 5)


@query("""SELECT event_type, round(avg(value), 4) AS mean, arg_min(value, ts) AS first, arg_max(value, ts) AS last,
 round(arg_max(value, ts) - arg_min(value, ts), 4) AS change FROM events GROUP BY 1""")
def first_last(spark, folder):
    return R(profile.first_last(table(spark, folder, "events"), "ts", "value", ["event_type"]))


@query("""SELECT nation, CAST(coalesce(segment = 'FURNITURE', false) AS INTEGER) AS segment_FURNITURE,
 CAST(coalesce(segment = 'HOUSEHOLD', false) AS INTEGER) AS segment_HOUSEHOLD, CAST(coalesce(segment = 'MACHINERY', false) AS INTEGER) AS segment_MACHINERY
 FROM (SELECT DISTINCT nation, segment FROM (SELECT nullif(c_nationkey, 3) AS nation, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer))""")
def dedup_and_encode(spark, folder):
    return encode.dedup_and_encode(gappy(spark, folder).select("nation", "segment"))


# ---------------------------------------------------------------- sorts and limits


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey")
def sort_by_value(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return reshape.sort_by(rows, "c_acctbal", ascending=False, ties=["c_custkey"])


@query("""SELECT p_partkey, size FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS size FROM part)
 ORDER BY TRY_CAST(size AS DOUBLE) DESC NULLS LAST, p_partkey""")
def sort_by_text_number(spark, folder):
    size = F.col("p_size").cast("string")
    rows = table(spark, folder, "part").select("p_partkey", F.when(F.col("p_size") % 5 == 0, "n/a").otherwise(size).alias("size"))
    return reshape.sort_by(rows, "size", ascending=False, ties=["p_partkey"], numeric=True)


@query('SELECT p_name, count(*) AS "count" FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10')
def top_values(spark, folder):
    return profile.top_values(table(spark, folder, "part"), "p_name", 10)


@query("SELECT event_id, ts, value FROM events ORDER BY ts DESC LIMIT 30")
def tail_rows(spark, folder):
    return reshape.tail(table(spark, folder, "events").select("event_id", "ts", "value"), "ts", 30)


@query("SELECT DISTINCT p_brand FROM part")
def unique_values(spark, folder):
    return profile.unique_values(table(spark, folder, "part"), "p_brand")


@query("""SELECT o_orderpriority AS model, round(avg(o_totalprice), 4) AS score FROM orders GROUP BY 1 ORDER BY avg(o_totalprice) DESC, 1 LIMIT 1""")
def pick_best(spark, folder):
    rows = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("model")).agg(F.avg("o_totalprice").alias("score"))
    return R(reshape.pick_best(rows, "model", "score"))


@query("SELECT 'Accuracy' AS best_metric, count(*) AS n_models FROM (SELECT DISTINCT o_orderpriority FROM orders)")
def best_metric(spark, folder):
    rows = table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.lit(None).cast("double").alias("F1_Pos"), F.avg("o_totalprice").alias("Accuracy")
    )
    found = reshape.best_metric(rows, ["ROC_AUC_Pos", "F1_Pos", "Accuracy"])
    return rows.agg(F.count("*").alias("n_models")).select(F.lit(found).alias("best_metric"), "n_models")


# ---------------------------------------------------------------- set operations and shapes


@query("""SELECT DISTINCT * FROM (SELECT p_brand AS brand, p_type AS type, NULL AS nation FROM part
 UNION ALL SELECT p_brand, NULL, p_size FROM part)""")
def stack_distinct(spark, folder):
    part = table(spark, folder, "part")
    a = part.select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    return reshape.stack_distinct([a, part.select(F.col("p_brand").alias("brand"), F.col("p_size").alias("nation"))])


@query("""SELECT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT'
 EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '5-LOW'""")
def date_difference(spark, folder):
    rows = table(spark, folder, "orders").withColumnRenamed("o_orderdate", "day")
    return reshape.date_difference(
        rows.filter("o_orderpriority = '1-URGENT'"), rows.filter("o_orderpriority = '5-LOW'"), "day"
    )


@query("""SELECT l_orderkey, l_linenumber, metric, value FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
 UNPIVOT (value FOR metric IN (l_quantity, l_discount, l_tax))""")
def melt(spark, folder):
    rows = table(spark, folder, "lineitem")
    return reshape.melt(rows, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query("""SELECT 'mae' AS metric, round(avg(l_tax), 6) AS value FROM lineitem UNION ALL SELECT 'n', count(*) FROM lineitem""")
def metrics_to_rows(spark, folder):
    row = table(spark, folder, "lineitem").agg(
        F.avg("l_tax").alias("mae"), F.count("*").alias("n"), F.collect_set("l_returnflag").alias("labels")
    )
    return R(reshape.metrics_to_rows(row), 6)


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("SELECT l_orderkey, " + ", ".join(f"max(CAST(p_type = '{t}' AS INTEGER)) AS {t}" for t in TYPES)
       + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def basket_matrix(spark, folder):
    rows = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return reshape.basket_matrix(rows, "l_orderkey", "p_type", TYPES)


@query("""SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-zA-Z]{4,}')) AS token FROM documents) GROUP BY 1""")
def explode_tokens(spark, folder):
    tokens = reshape.explode_tokens(table(spark, folder, "documents"), F.lower("text"), "[a-zA-Z]{4,}")
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- encoding


@query("""SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P",
 CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS "o_orderpriority_2-HIGH", CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS "o_orderpriority_3-MEDIUM",
 CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS "o_orderpriority_4-NOT SPECIFIED", CAST(o_orderpriority = '5-LOW' AS INTEGER) AS "o_orderpriority_5-LOW" FROM orders""")
def one_hot(spark, folder):
    return encode.one_hot(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"))


@query("""SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity,
 round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 6) AS l_extendedprice, 0.0::DOUBLE AS flat FROM lineitem""")
def standardize(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.lit(3.0).alias("flat"))
    return R(encode.standardize(rows, ["l_quantity", "l_extendedprice", "flat"]), 6)


@query("""WITH s AS (SELECT avg(l_tax) AS m, stddev_pop(l_tax) AS s FROM lineitem WHERE l_linenumber <= 4)
 SELECT l_orderkey, l_linenumber, round((l_tax - m) / s, 6) AS l_tax FROM lineitem, s WHERE l_linenumber > 4""")
def standardize_train_to_test(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_tax")
    scaler = encode.Scaler(["l_tax"]).fit(rows.filter("l_linenumber <= 4"))
    return R(scaler.transform(rows.filter("l_linenumber > 4")), 6)


@query("""WITH q AS (SELECT quantile_cont(o_totalprice, 0.33) AS a, quantile_cont(o_totalprice, 0.66) AS b FROM orders)
 SELECT o_orderkey, CASE WHEN o_totalprice <= a THEN 'Budget' WHEN o_totalprice <= b THEN 'MidRange' ELSE 'Premium' END AS price_segment FROM orders, q""")
def quantile_segments(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return encode.quantile_segments(rows, "o_totalprice")[0].drop("o_totalprice")


@query("""SELECT vec_id, round(embedding[1] / ((SELECT max(abs(embedding[1])) FROM embeddings)::DOUBLE + 1e-9), 6) AS axis_1 FROM embeddings""")
def scale_to_unit(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("axis_1"))
    return R(encode.scale_to_unit(rows, ["axis_1"]), 6)


@query("""SELECT 'o_orderdate' AS "column", count(*) AS non_null FROM orders UNION ALL SELECT 'day_text', count(*) FROM orders""")
def date_like_columns(spark, folder):
    rows = table(spark, folder, "orders").withColumn("day_text", F.date_format("o_orderdate", "yyyy-MM-dd"))
    found = encode.date_like_columns(rows)
    return profile.column_profile(rows.select(*found), exact=False).select("column", "non_null")


@query(r"""SELECT doc_id, len(list_filter(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) AS n_items FROM documents""")
def list_item_count(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.item_count(F.col("text")).cast("long").alias("n_items"))


@query(r"""SELECT conv_id, turn, unnest(list_filter(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) AS item FROM conversations""")
def split_list_cells(spark, folder):
    rows = table(spark, folder, "conversations")
    return rows.select("conv_id", "turn", F.explode(text.list_items(F.col("text"))).alias("item"))
