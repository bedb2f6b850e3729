"""Table functions over page markup, for LATERAL in SQL and `lateralJoin`."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from .markup import parse


@udtf(returnType="pos int, tag string, text string, attributes map<string,string>")
class PageNodes:
    """A row per element that a selector finds: its position, tag, stripped text and attributes. A null page or
    selector has none; broken markup is read as far as it goes."""

    def eval(self, html: str, selector: str) -> Iterator[tuple]:
        if html is None or selector is None:
            return
        for pos, node in enumerate(parse(html).select(selector)):
            yield pos, node.tag, node.text(" ", True), dict(node.attrs)


@udtf(returnType="record int, field string, value string")
class PageRecords:
    """A row per field of each block that `block` finds; `fields` maps a name to a selector, or to `selector@attribute`
    for an attribute's value. A field that a block lacks is null."""

    def eval(self, html: str, block: str, fields: dict) -> Iterator[tuple]:
        if html is None or block is None or not fields:
            return
        for number, node in enumerate(parse(html).select(block)):
            for name, spec in sorted(fields.items()):
                selector, _, attribute = spec.partition("@")
                found = node.select(selector)
                value = None
                if found:
                    value = found[0].attrs.get(attribute) if attribute else found[0].text(" ", True)
                yield number, name, value


def register(spark: SparkSession) -> None:
    """Make `page_nodes` and `page_records` known to SQL."""
    spark.udtf.register("page_nodes", PageNodes)
    spark.udtf.register("page_records", PageRecords)
