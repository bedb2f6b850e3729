"""Text, links, tables and records from a table of web pages (page_id, url, html)."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.markup import Node, parse, pick, selector_steps
from ..functions.text import absolute_url
from ..plans.bounds import small_batches


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    html = F.regexp_replace(html, "(?s)<!--.*?-->", "")
    html = F.regexp_replace(html, "(?is)<script[^>]*>.*?</script>", "")
    return F.regexp_replace(html, "(?is)<style[^>]*>.*?</style>", "")


def element_text(pages: DataFrame, tag: str, limit: int | None = None) -> DataFrame:
    """(page_id, pos, text) of elements that are always closed and never nest, without leaving the JVM.

    Use `selected_text` for tags that nest or are left open.
    """
    found = F.regexp_extract_all(visible(F.col("html")), F.lit(f"(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))
    rows = pages.select("page_id", F.posexplode(found).alias("pos", "_inner"))
    inner = F.regexp_replace("_inner", "<[^>]*>", "")
    for name, sign in {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "©",
                       "&middot;": "·", "&amp;": "&"}.items():
        inner = F.replace(inner, F.lit(name), F.lit(sign))
    out = rows.select("page_id", "pos", F.regexp_replace(inner, r"^\s+|\s+$", "").alias("text"))
    return out if limit is None else out.filter(F.col("pos") < limit)


_VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute in an opening tag, quoted or bare; null without that attribute or a value."""
    before = r"""^<[a-zA-Z][^\s/>]*(?:\s+[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?|\s*/)*?"""
    pattern = f"(?is){before}\\s+{re.escape(name)}\\s*=\\s*{_VALUE}"
    groups = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.when(tag.rlike(pattern), F.concat(*groups))


def links(
    pages: DataFrame, href_contains: str = "", tag: str = "a", attrs: Mapping[str, str] | None = None, attribute: str = "href"
) -> DataFrame:
    """(page_id, pos, href, absolute) of every link, in page order.

    Links are the `attribute` values of `tag` elements whose attributes equal `attrs`, however they are quoted.
    """
    pattern = f"(?is)<{re.escape(tag)}(?=[\\s/>])" + r"""(?:[^>"']|"[^"]*"|'[^']*')*>"""
    opened = F.regexp_extract_all(visible(F.col("html")), F.lit(pattern), F.lit(0))
    wanted = functools.reduce(
        lambda ok, pair: lambda t: ok(t) & F.coalesce(_attribute(t, pair[0]) == pair[1], F.lit(False)),
        (attrs or {}).items(), lambda t: _attribute(t, attribute).isNotNull())
    found = F.transform(F.filter(opened, wanted), lambda t: _attribute(t, attribute))
    rows = pages.select("page_id", "url", F.posexplode(found).alias("pos", "href"))
    rows = rows.withColumn("href", F.replace(F.col("href"), F.lit("&amp;"), F.lit("&")))
    if href_contains:
        rows = rows.filter(F.col("href").contains(href_contains))
    return rows.select("page_id", "pos", "href", absolute_url(F.col("url"), F.col("href")).alias("absolute"))


#: Pages that are parsed before their rows are handed on.
_PAGES = 64


def _scan(pages: DataFrame, schema: str, per_page: Callable[[Node], Iterable[tuple]], *carried: str) -> DataFrame:
    """Run a small function over the tree of every page; its rows follow the carried columns.

    Few pages are held at a time, and pages from few files are dealt to all cores first.
    """
    made = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _PAGES):
                rows = []
                for *keys, html in zip(*(column.to_pylist() for column in batch.slice(at, _PAGES).columns)):
                    tree = parse(html or "")
                    rows.extend((*keys, *row) for row in per_page(tree))
                    tree.release()
                yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], f.type) for i, f in enumerate(made)], schema=made)

    cores = pages.sparkSession.sparkContext.defaultParallelism
    wanted = pages.select(*carried, "html")
    if len(pages.inputFiles()) < cores:
        wanted = wanted.repartition(4 * cores)
    small_batches(pages.sparkSession)
    return wanted.mapInArrow(run, schema)


def selected_text(pages: DataFrame, selector: str, limit: int | None = None, strip: bool = True) -> DataFrame:
    """(page_id, pos, text) of the elements a selector matches, in page order."""
    selector_steps(selector)

    def per_page(page):
        for pos, node in enumerate(page.select(selector)[:limit]):
            yield pos, node.text("", strip)

    id_type = pages.schema["page_id"].dataType.simpleString()
    return _scan(pages, f"page_id {id_type}, pos int, text string", per_page, "page_id")


def table_cells(pages: DataFrame, index: int = 0, attrs: Mapping[str, str] | None = None) -> DataFrame:
    """(page_id, row, col, is_header, text) of the n-th table of each page."""
    wanted = dict(attrs or {})

    def per_page(page):
        tables = [t for t in page.select("table") if all(t.attrs.get(k) == v for k, v in wanted.items())]
        if len(tables) <= index:
            return
        for i, line in enumerate(tables[index].select("tr")):
            cells = [c for c in line.walk() if c.tag in ("td", "th")]
            for j, cell in enumerate(cells):
                yield i, j, cell.tag == "th", cell.text(" ", True)

    id_type = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {id_type}, row int, col int, is_header boolean, text string"
    return _scan(pages, schema, per_page, "page_id")


def records(pages: DataFrame, item_selector: str, fields: Mapping[str, Mapping]) -> DataFrame:
    """One row per repeated block: (page_id, url, pos, *fields).

    A field names a `selector` inside the block, an `attr` ("text" or an attribute), a `default`
    and whether to `strip`.
    """
    for name, spec in fields.items():
        if not spec.get("selector"):
            raise ValueError(f"field '{name}' needs a selector")
    specs = [dict(s) for s in fields.values()]
    for selector in (item_selector, *(s["selector"] for s in specs)):
        selector_steps(selector)

    def per_page(page):
        for pos, block in enumerate(page.select(item_selector)):
            yield (pos, *[pick(block, s) for s in specs])

    id_type = pages.schema["page_id"].dataType.simpleString()
    typed = ", ".join(f"`{name}` string" for name in fields)
    return _scan(pages, f"page_id {id_type}, url string, pos int, {typed}", per_page, "page_id", "url")


def regex_groups(
    df: DataFrame, column: str, pattern: str, names: Sequence[str] | None = None, ignore_case: bool = False
) -> DataFrame:
    """Rows that match, with the groups of the first match as columns and the text kept."""
    groups = _group_count(pattern)
    if names is not None and len(names) != groups:
        raise ValueError("names must match the number of groups")
    names = names or [f"group_{i + 1}" for i in range(groups)]
    pattern = ("(?i)" if ignore_case else "") + pattern
    found = {n: F.regexp_extract(column, pattern, i + 1) for i, n in enumerate(names)}
    return df.filter(F.col(column).rlike(pattern)).withColumns(found)


def _group_count(pattern: str) -> int:
    return re.compile(pattern).groups


# The fields of a product block.
CATALOGUE_FIELDS = {
    "title": {"selector": ".title"},
    "detail_href": {"selector": ".title", "attr": "href"},
    "price_text": {"selector": ".price"},
    "description": {"selector": ".description"},
    "rating_text": {"selector": ".ratings p[data-rating]", "attr": "data-rating"},
    "reviews_text": {"selector": ".ratings .pull-right"},
}


def catalogue(pages: DataFrame, item_selector: str = ".thumbnail", fields: Mapping = CATALOGUE_FIELDS) -> DataFrame:
    """Distinct product records of all pages, with the page they came from and absolute links. Equal pages are read once."""
    found = records(pages.select(F.lit(0).alias("page_id"), "url", "html").distinct(), item_selector, fields)
    link = F.when(F.col("detail_href").isNotNull(), absolute_url(F.col("url"), F.col("detail_href")))
    return found.select(*fields, F.col("url").alias("source_url"), link.alias("detail_url")).distinct()
