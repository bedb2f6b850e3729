"""Page markup through table functions."""

from pyspark.sql import functions as F

from minekit.functions import page_table

PAGE = '<div class="item"><a href="/a">First</a><b>1</b></div><div class="item"><a>Second</a></div><![foo[bar'


def test_nodes_and_records_in_sql(spark):
    page_table.register(spark)
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "id int, html string")
    nodes = spark.sql("SELECT id, n.pos, n.tag, n.text, n.attributes['href'] AS href FROM {p}, LATERAL page_nodes(html, 'a') n", p=pages)
    assert sorted(map(tuple, nodes.collect())) == [(1, 0, "a", "First", "/a"), (1, 1, "a", "Second", None)]
    records = spark.sql(
        "SELECT id, r.* FROM {p}, LATERAL page_records(html, 'div.item', map('link', 'a@href', 'name', 'a', 'price', 'b')) r", p=pages)
    assert sorted(map(tuple, records.collect()), key=str) == sorted([
        (1, 0, "link", "/a"), (1, 0, "name", "First"), (1, 0, "price", "1"), (1, 1, "link", None), (1, 1, "name", "Second"), (1, 1, "price", None)], key=str)


def test_a_lateral_join_of_the_dataframe_api(spark):
    pages = spark.createDataFrame([(1, PAGE)], "id int, html string")
    found = pages.lateralJoin(page_table.PageNodes(F.col("html").outer(), F.lit("b"))).select("id", "text")
    assert [tuple(r) for r in found.collect()] == [(1, "1")]
