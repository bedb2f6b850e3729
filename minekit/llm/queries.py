"""Registered queries of the corpus operators, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    decontaminate, divergence, fim, langid, lines, orderhash, packing, repeats, simhash, tokens, toxicity, urls, warc,
)
from .common import LOWER, UPPER, crc_mod
from ..catalog.registry import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op1_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


_WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


@query(f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS_SQL} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS size, words[i:i + least(len(words), 13) - 1] AS words
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 13, 0) + 2)) AS i FROM item WHERE len(words) > 0)
), doc AS (SELECT doc_id, {_WORDS_SQL} AS words FROM documents),
place AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM doc),
hit AS (
  SELECT doc_id, i, size, item_id
  FROM (SELECT doc_id, i, size, words[i:i + size - 1] AS words FROM place, (SELECT DISTINCT size FROM windows)
        WHERE i + size - 1 <= len(words)) JOIN windows USING (size, words)
), counted AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op2_decontamination(spark, folder):
    found = decontaminate.decontamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans")


_LINES_SQL = f"""
WITH line AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM line
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query(_LINES_SQL)
def op3_line_dedup(spark, folder):
    return lines.line_dedup(table(spark, folder, "documents"))


@query()
def op4_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0))
    found = toxicity.scores(docs, model)
    return found.select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op5_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op6_simhash_near_duplicates(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op9_token_counts(spark, folder):
    return tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


_URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
_SPAM_SQL = " OR ".join(f"regexp_matches(host || path, '{r.pattern}')" for r in urls.SPAM)


@query(f"""
WITH part AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rule AS (
  SELECT *, split_part(name, '/', 1) AS rule_host, substr(name, strpos(name, '/')) AS rule_path
  FROM (VALUES {", ".join(map(str, _URL_RULES))}) AS v(name, verdict)
), fit AS (
  SELECT page_id, arg_max(name, length(name)) AS name, arg_max(verdict, length(name)) AS verdict
  FROM part JOIN rule ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, name AS rule,
       coalesce(verdict, CASE WHEN {_SPAM_SQL} THEN 'block' ELSE 'allow' END) AS verdict
FROM part LEFT JOIN fit USING (page_id)
""")
def op7_url_filter(spark, folder):
    rules = [urls.host_path_rule(rule, verdict) for rule, verdict in _URL_RULES]
    found = urls.judge(table(spark, folder, "pages"), [*rules, *urls.SPAM])
    # The spam patterns are the filter's own: their verdict counts, `rule` names host and path rules.
    return found.withColumn("rule", F.when(~F.col("rule").startswith("spam:"), F.col("rule")))


@query()
def op8_order_minhash(spark, folder):
    return orderhash.edit_likeness(table(spark, folder, "documents"))


@query()
def op10_warc_derivatives(spark, folder):
    found = warc.derivatives(warc.responses(table(spark, folder, "pages")))
    header = F.col("headers")
    return found.select(
        F.col("key").alias("page_id"), "warc_type", "record_id", "refers_to",
        header["WARC-Target-URI"].alias("target_uri"), header["WARC-Date"].alias("date"),
        header["WARC-Source-Payload-Digest"].alias("payload_digest"), header["WARC-Block-Digest"].alias("block_digest"),
        header["Content-Type"].alias("content_type"),
        header["Content-Length"].cast("long").alias("content_length"),
        warc.text_of(F.col("block")).alias("block"), F.sha2("record", 256).alias("record_sha256"))


_TERMS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\\x{{80}}-\\x{{10FFFF}}]+')"


@query(f"""
WITH doc AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS_SQL} AS terms FROM documents
), word AS (SELECT row, lang, source, unnest(terms) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS all_n FROM word GROUP BY ALL HAVING count(DISTINCT row) >= 30),
cell AS (SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM doc),
total AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM grp LEFT JOIN cell USING (lang, source) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*)::HUGEINT AS v, sum(all_n)::HUGEINT AS all_total FROM kept GROUP BY lang),
share AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (all_n + 5)) // (all_total + 5 * v) AS q
  FROM total JOIN kept USING (lang) JOIN vocabulary USING (lang) LEFT JOIN cell USING (lang, source, term)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), merged AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM share WHERE n > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM merged)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def op11_source_divergence(spark, folder):
    return divergence.divergence(table(spark, folder, "documents"))


@query()
def op12_suffix_dedup(spark, folder):
    found = repeats.without_repeats(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex FROM documents
), counted AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
         ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2, ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4
  FROM doc
), formed AS (
  SELECT *, len(units) AS n, CASE
    WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b
  FROM counted
), parted AS (
  SELECT *, array_to_string(units[:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
  FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                        ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
""")
def op13_fill_in_middle(spark, folder):
    found = fim.fill_in_middle(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
