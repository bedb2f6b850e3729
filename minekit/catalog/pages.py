"""Text, links, tables and records from web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import page_table
from ..operators import pages, reshape
from .registry import query, table

VISIBLE = r"""v AS (SELECT page_id, url, html, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
 '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g') AS seen FROM pages)"""


def _decoded(text: str) -> str:
    for name, sign in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        text = f"replace({text}, '{name}', '{sign}')"
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def _elements(tag: str, pattern: str | None = None) -> str:
    pattern = pattern or rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"
    return f"""WITH {VISIBLE}, e AS (SELECT page_id, regexp_extract_all(seen, '{pattern}', 1) AS found FROM v),
 r AS (SELECT page_id, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos, regexp_replace(unnest(found), '<[^>]*>', '', 'g') AS inner_text FROM e)
 SELECT page_id, pos, {_decoded('inner_text')} AS text FROM r"""


@query(_elements("h1"))
def page_headings(spark, folder):
    return pages.element_text(table(spark, folder, "pages"), "h1")


@query(_elements("title"))
def page_titles(spark, folder):
    return pages.selected_text(table(spark, folder, "pages"), "title")


@query(_elements("li") + " WHERE pos < 3")
def page_menu_entries(spark, folder):
    """The first three menu entries of each page; the limit per page is the operator's own."""
    return pages.element_text(table(spark, folder, "pages"), "li", limit=3)


@query(_elements("div", '(?is)<div class="ad">(.*?)</div>'))
def page_selected_text(spark, folder):
    return pages.selected_text(table(spark, folder, "pages"), "div.ad")


@query(_elements("footer"))
def page_footers(spark, folder):
    return pages.selected_text(table(spark, folder, "pages"), "body footer", strip=False)


@query()
def page_paragraphs(spark, folder):
    """Paragraphs nest where a bold or a line break was left open, so only the parser form is right."""
    return pages.selected_text(table(spark, folder, "pages"), "article p")


LINKS = rf"""WITH {VISIBLE}, e AS (SELECT page_id, url, regexp_extract_all(seen, '(?is)<a\s(?:[^>]*?\s)?href="([^"]*)"', 1) AS found FROM v),
 r AS (SELECT page_id, url, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos, replace(unnest(found), '&amp;', '&') AS href FROM e)
 SELECT page_id, pos, href, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS absolute FROM r"""


@query(LINKS)
def page_links(spark, folder):
    return pages.links(table(spark, folder, "pages"))


@query(LINKS + " WHERE contains(href, 'the')")
def page_links_containing(spark, folder):
    return pages.links(table(spark, folder, "pages"), "the")


@query(rf"""WITH {VISIBLE}, e AS (SELECT page_id, url, regexp_extract_all(seen, '(?is)<li>(.*?)</li>', 1) AS found FROM v),
 r AS (SELECT page_id, url, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS pos, unnest(found) AS item FROM e)
 SELECT page_id, url, pos, {_decoded("regexp_replace(item, '<[^>]*>', '', 'g')")} AS label, {_decoded("regexp_extract(item, 'href=\"([^\"]*)\"', 1)")} AS href, 'none' AS price FROM r""")
def page_records(spark, folder):
    fields = {
        "label": {"selector": "a"}, "href": {"selector": "a[href]", "attr": "href"},
        "price": {"selector": ".price", "default": "none"},
    }
    return pages.records(table(spark, folder, "pages"), "nav ul li", fields)


@query("""SELECT o_orderkey AS page_id, 0 AS "row", c.i AS col, true AS is_header, c.h AS text FROM orders, (VALUES (0, 'status'), (1, 'priority')) c(i, h)
 UNION ALL SELECT o_orderkey, 1, 0, false, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, 1, 1, false, o_orderpriority FROM orders""")
def page_tables(spark, folder):
    """One page per order that shows a heading table and then its fields as a second table."""
    html = F.concat(
        F.lit("<body><table><tr><td>menu</td></tr></table><table class='order'><tr><th>status</th><th>priority</th></tr><tr><td>"),
        "o_orderstatus", F.lit("</td><td> <b>"), "o_orderpriority", F.lit("</b></td></tr></table></body>"),
    )
    made = table(spark, folder, "orders").select(F.col("o_orderkey").alias("page_id"), html.alias("html"))
    return pages.table_cells(made, index=1)


@query(r"""SELECT conv_id, turn, text, regexp_extract(text, '(?i)the (\w+) of (\w+)', 1) AS what, regexp_extract(text, '(?i)the (\w+) of (\w+)', 2) AS whose
 FROM conversations WHERE regexp_matches(text, '(?i)the (\w+) of (\w+)')""")
def regex_groups(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return pages.regex_groups(rows, "text", r"the (\w+) of (\w+)", ["what", "whose"], ignore_case=True)


@query("""SELECT DISTINCT p_brand || ' ' || p_name AS title, '/part?size=' || p_size AS detail_href, '$' || p_retailprice AS price_text, p_type AS description,
 CAST(p_size % 6 AS VARCHAR) AS rating_text, NULL::VARCHAR AS reviews_text, 'https://shop.example.com/list/' || (p_partkey % 3) AS source_url,
 'https://shop.example.com/part?size=' || p_size AS detail_url FROM part""")
def page_catalogue(spark, folder):
    """Product pages composed from the part table, read back as records."""
    html = F.concat(
        F.lit('<ul class="thumbnail item"><h4><a class="title" href="/part?size='), F.col("p_size").cast("string"), F.lit('">'),
        "p_brand", F.lit(" "), "p_name", F.lit('</a></h4><h4 class="pull-right price">$'), F.col("p_retailprice").cast("string"),
        F.lit('</h4><p class="description">'), "p_type", F.lit('</p><div class="ratings"><p data-rating="'),
        (F.col("p_size") % 6).cast("string"), F.lit('"><span></span></p></div></ul>'),
    )
    url = F.concat(F.lit("https://shop.example.com/list/"), (F.col("p_partkey") % 3).cast("string"))
    made = table(spark, folder, "part").select(F.col("p_partkey").alias("page_id"), url.alias("url"), html.alias("html"))
    return pages.catalogue(made)


@query(_elements("li"))
def page_nodes_in_sql(spark, folder):
    """The table function in SQL, next to the columns of its page."""
    page_table.register(spark)
    found = spark.sql("SELECT p.page_id, n.pos, n.text FROM {pages} p, LATERAL page_nodes(p.html, 'li') n", pages=table(spark, folder, "pages"))
    return found.select("page_id", "pos", "text")
