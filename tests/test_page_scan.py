"""Pages are read a few at a time, spread over tasks, and equal ones once."""

import gc
import random
import re
import weakref

from pyspark.sql import functions as F

from minekit.functions import markup
from minekit.operators import pages

PAGE = '<div class="thumbnail"><a class="title" href="/x">{}</a><p class="description">d</p></div>'


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)


def test_pages_of_one_file_are_read_by_several_tasks(spark, tmp_path):
    table(spark, [(i, "http://a.b/", "<p>x</p>") for i in range(200)]).write.parquet(str(tmp_path / "pages"))
    read = spark.read.parquet(str(tmp_path / "pages"))
    found = pages.selected_text(read, "p")
    assert found.select(F.spark_partition_id()).distinct().count() > 1
    assert sorted(r.page_id for r in found.collect()) == list(range(200))


def test_equal_pages_are_parsed_once(spark):
    seen = spark.sparkContext.accumulator(0)
    fields = dict(pages.CATALOGUE_FIELDS)
    rows = [(i, f"http://a.b/{i % 2}", PAGE.format(i % 3)) for i in range(60)] + [(None, None, None), (99, "http://a.b/0", None)]
    real = pages._scan

    def counted(df, schema, per_page, *carried):
        def one(page):
            seen.add(1)
            return per_page(page)
        return real(df, schema, one, *carried)

    pages._scan = counted
    try:
        found = pages.catalogue(table(spark, rows), fields=fields).collect()
    finally:
        pages._scan = real
    assert sorted((r.title, r.source_url) for r in found) == [(str(t), f"http://a.b/{u}") for t in range(3) for u in range(2)]
    assert seen.value == 8


def test_a_released_tree_goes_without_a_collection():
    class Held(markup.Node):
        __slots__ = ("__weakref__",)

    root = markup.parse("<div><p>a<b>c</b></p></div>")
    child = Held("i", {}, root)
    root.parts.append(child)
    gone = weakref.ref(child)
    gc.disable()
    try:
        root.release()
        del root, child
        assert gone() is None
    finally:
        gc.enable()


def test_rows_follow_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(pages, "_PAGES", 3)
    rows = [(i, None, f"<p>{i}</p><p>b</p>" if i % 2 else None) for i in range(20)]
    found = pages.selected_text(table(spark, rows), "p").orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.pos, r.text) for r in found] == [(i, n, t) for i in range(1, 20, 2) for n, t in ((0, str(i)), (1, "b"))]


class Log(markup.TolerantParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.seen = []

    def handle_starttag(self, tag, attrs):
        self.seen.append((tag, attrs))

    def handle_endtag(self, tag):
        self.seen.append(f"/{tag}")


def test_plain_tags_are_read_as_the_standard_parser_does(monkeypatch):
    bits = ['<a href="x">', '<A HREF="y" b-c="z">', '<a b="1"c="2">', "<a b='1'>", '<a href="x', '<p', ">", "<br/>", "</p>", "</P >", "<script>", "</script>",
            '"', " text ", '<a x="&lt;">', "<!--", "-->", "<style>"]
    draw = random.Random(1)
    pages_ = ["".join(draw.choices(bits, k=draw.randint(1, 12))) for _ in range(4000)]

    def read(text):
        log = Log()
        log.feed(text)
        log.close()
        return log.seen

    found = [read(p) for p in pages_]
    assert markup._TAGS
    monkeypatch.setattr(markup, "_PLAIN_TAG", re.compile("(?!)"))
    monkeypatch.setattr(markup, "_PLAIN_END", re.compile("(?!)"))
    markup._TAGS.clear()
    assert [read(p) for p in pages_] == found and not markup._TAGS
