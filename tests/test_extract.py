"""Text, address and page expressions on hand-made edge cases."""

from __future__ import annotations

import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import text as T
from shelfmark.functions.html import EMPTY, RAW, Selector, elements, walk
from shelfmark.operators import extract


def evaluate(spark, column, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {column} string")
    return [r[0] for r in df.orderBy("i").select(make(F.col(column))).collect()]


def test_name_from_title(spark):
    cases = {
        "[Set] 王小明 - part": "王小明",
        "[Set] 王小明 ABC": "王小明",
        "王小明_12": "王小明",
        "王小明　7 days": "王小明",
        "　王小明　第二": "王小明",
        "x - y": None,
        "[A] b - c": "[A]",
        "": None,
        "ab": "ab",
        "a": None,
    }
    assert evaluate(spark, "t", list(cases), T.name_from_title) == list(cases.values())


def test_addresses_and_names(spark):
    assert evaluate(spark, "u", ["a?b?c", "a", ""], T.clean_url) == ["a", "a", ""]
    urls = ["x.PNG?y", "x.webp", "x.png.webp", "x.jpeg", "x"]
    assert evaluate(spark, "u", urls, T.url_extension) == [".png", ".webp", ".png", ".jpg", ".jpg"]
    names = spark.range(1).select(
        *[T.item_file_name(F.lit(n), F.lit(".jpg")) for n in (1, 999, 1000, 12345)]
    ).first()
    assert list(names) == ["001.jpg", "999.jpg", "1000.jpg", "12345.jpg"]
    title = "标" * 30 + "/" + "x" * 29
    folder = spark.range(1).select(T.folder_name(F.lit(12), F.lit(title))).first()[0]
    assert folder == "12_" + title[:50].replace("/", "_")
    assert evaluate(spark, "f", ["12_a_b", "12", "x_1", ""], T.id_from_folder) == [12, 12, None, None]


def test_paths(spark):
    paths = ["/a/b.JPG", "/a/.png", "/a.b/c", "c.tar.gif", "/x/y.bmp"]
    assert evaluate(spark, "p", paths, T.extension_of) == [".jpg", "", "", ".gif", ".bmp"]
    assert evaluate(spark, "p", paths, T.content_type) == ["image/jpeg"] * 3 + ["image/gif", "image/bmp"]
    assert evaluate(spark, "p", ["a%20b+c", "%E7%8E%8B", "plain"], T.percent_decode) == ["a b+c", "王", "plain"]
    relative = evaluate(spark, "p", ["/root/x/y", "/rooty/x"], lambda c: T.relative_path(c, "/root"))
    assert relative == ["x/y", "/rooty/x"]
    assert evaluate(spark, "p", ["a.tar.gz", "b", ".hid"], T.stem_of) == ["a.tar", "b", ".hid"]


def test_natural_order(spark):
    stems = ["a", "10", "2", "010", "1", "b2"]
    df = spark.createDataFrame([(s,) for s in stems], "stem string")
    assert [r.stem for r in df.orderBy(*T.natural_order("stem")).collect()] == ["1", "2", "010", "10", "a", "b2"]


PAGE = """<html><body><h1 class="t"> A &amp; <b>B</b>
 c </h1><div class="x tags y"><a href="1">one</a><a> </a><a>two</a><a>one</a></div>
<a class="girl-link" href="/girl/42"> Name </a>
<div class="photo-area"><img src="https://i.example.com/1.jpg?x=1"><img data-src='https://i.example.com/2.PNG'>
<img src="/rel.jpg"><img src="https://i.example.com/1.jpg"></div>
<script>"https://i.example.com/3.webp?q" "https://i.example.com/4.txt" "https://i.example.com/1.jpg"</script></body></html>"""


IMAGES = Selector("img", in_cls="photo-area")


def test_page(spark):
    df = spark.createDataFrame([(7, PAGE), (8, "<p>none</p>")], "page_id bigint, html string")
    html = F.col("html")
    titles = [r[0] for r in df.orderBy("page_id").select(extract.page_title(elements(html, Selector("h1")), F.col("page_id"))).collect()]
    assert titles == ["A &Bc", "album_8"]
    tags = extract.page_tags(df, elements(html, Selector("a", in_cls="tags"))).collect()
    assert [tuple(t) for t in tags] == [(7, 0, "one"), (7, 1, "two")]
    dom = extract.dom_urls(elements(html, IMAGES))
    raw = extract.pattern_urls(html, r"""https://i\.example\.com/[^"']+""")
    found = extract.media_urls(df, dom, raw).orderBy("position").collect()
    assert [(r.position, r.url.rsplit("/", 1)[1], r.file_name) for r in found] == [
        (1, "1.jpg", "001.jpg"),
        (2, "2.PNG", "002.png"),
        (3, "3.webp", "003.webp"),
    ]


def test_no_cap_and_numbering_past_999(spark):
    many = "".join(f'<img src="https://i.example.com/{i}.jpg">' for i in range(1005))
    df = spark.createDataFrame([(1, f'<div class="photo-area">{many}</div>')], "page_id bigint, html string")
    dom = extract.dom_urls(elements(F.col("html"), IMAGES))
    found = extract.media_urls(df, dom)
    assert found.count() == 1005 and found.agg(F.max("file_name")).first()[0] == "999.jpg"
    assert "1005.jpg" in {r.file_name for r in found.collect()}
    few = extract.dom_urls(elements(F.col("html"), IMAGES), most=3)
    assert extract.media_urls(df, few).count() == 3


NESTED = [
    ("<div class=photo-area><div><img 1></div><img 2></div><img 3>", ["<div><img 1></div><img 2>"]),
    ("<p class='a photo-area'>x<p2>y</p2></p><P CLASS=\"photo-area\">z</P>", ["x<p2>y</p2>", "z"]),
    ("<div class='photo-area'><div/><div class='photo-area'>in</div>out</div>", ["<div/><div class='photo-area'>in</div>out", "in"]),
    ("<div class='photo-area'>open <div>still", ["open <div>still"]),
    ("<div class='no-photo-area photo-areas'>x</div>", []),
    ("", []),
    (None, []),
]


def test_regions(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(NESTED)], "i int, html string").orderBy("i")
    found = df.select(extract.class_regions(F.col("html"), "photo-area"), extract.class_region(F.col("html"), "photo-area")).collect()
    assert [r[0] for r in found] == [wanted for _, wanted in NESTED]
    assert [r[1] for r in found] == [(wanted or [""])[0] for _, wanted in NESTED]


def test_no_region_no_addresses(spark):
    page = '<div class="photo-area"><img src="https://i.example.com/1.jpg"></div>'
    df = spark.createDataFrame([(1, page), (2, '"https://i.example.com/2.jpg"')], "page_id bigint, html string")
    raw = extract.pattern_urls(F.col("html"), r"""https://i\.example\.com/[^"']+""")
    area = elements(F.col("html"), Selector(cls="photo-area"))
    assert [r.page_id for r in extract.media_urls(df, raw, area=area).collect()] == [1]


@pytest.mark.parametrize(
    "element,value",
    [("<a href=\"/it's/1\">", "/it's/1"), ("<a href='/a\"b'>", '/a"b'), ("<a x=1 HREF = /bare?q=1 y>", "/bare?q=1"), ("<a data-href='x'>", ""), ("<a href>", "")],
)
def test_attributes(spark, element, value):
    df = spark.createDataFrame([(element,)], "e string")
    found = F.get(elements(F.col("e"), Selector("a")), F.lit(0))["attrs"]
    assert df.select(F.coalesce(F.try_element_at(found, F.lit("href")), F.lit(""))).first()[0] == value


def test_character_references(spark):
    cases = {
        "&eacute;&#8217;&#x27;&#X1F600;": "é’'😀", "&amp;lt;": "&lt;", "&lt;b&gt; &unknown; & &#0;": "<b> &unknown; & \ufffd",
        "no": "no", "": "", "&amp;": "&", "a&nbsp;b&apos;": "a\xa0b'", "&NotEqualTilde;&rarr;": "≂̸→",
    }
    df = spark.createDataFrame([(k, f"<i title='{k}'>{k}</i>") for k in cases], "t string, html string")
    found = F.get(elements(F.col("html"), Selector("i")), F.lit(0))
    rows = df.select("t", found["text"], F.try_element_at(found["attrs"], F.lit("title"))).collect()
    plain = {k: v for k, v in cases.items() if "'" not in v}
    assert {r[0]: r[1] for r in rows} == cases and {r[0]: r[2] for r in rows if r[0] in plain} == plain


class Tree(HTMLParser):
    """Elements by the standard parser, with the stack kept by hand."""

    def __init__(self):
        super().__init__()
        self.rows, self.open = [], []

    def handle_starttag(self, tag, attrs):
        self.rows.append([len(self.rows), self.open[-1][1] if self.open else -1, len(self.open), tag, ""])
        if tag not in EMPTY:
            self.open.append((tag, len(self.rows) - 1))

    def handle_startendtag(self, tag, attrs):
        self.rows.append([len(self.rows), self.open[-1][1] if self.open else -1, len(self.open), tag, ""])

    def handle_endtag(self, tag):
        names = [t for t, _ in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag) :]

    def handle_data(self, data):
        if self.open and self.open[-1][0] not in RAW:
            self.rows[self.open[-1][1]][4] += data.strip()


def test_elements_are_those_of_the_standard_parser(spark):
    rng = random.Random(3)
    parts = ["<p>", "</p>", "<div class='a b'>", "</div>", "<br>", "<b/>", "text", " é🙂 ", "<!-- <p> -->", "<script>if (a<b) '<p>'</script>", "</x>", "<a href='1>2'>", "</a>", "<!DOCTYPE x>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(300)]
    df = spark.createDataFrame([*enumerate(pages), (999, None)], "page_id int, html string")
    table = extract.element_table(df)
    got = {}
    for r in table.orderBy("page_id", "element").collect():
        got.setdefault(r["page_id"], []).append([r["element"], r["parent"], r["depth"], r["tag"], r["text"]])
        assert pages[r["page_id"]][r["start"]] == "<" and r["end"] > r["start"]
        assert (r["classes"] == ["a", "b"]) == (r["tag"] == "div")
    for i, page in enumerate(pages):
        tree = Tree()
        tree.feed(page)
        tree.close()
        assert got.get(i, []) == tree.rows, page
    assert 999 not in got


def test_ranges_and_deep_pages():
    html = "<a>x<b>y<i>z</a>w</b>"
    assert [(r[4], html[r[6] : r[7]], r[9]) for r in walk(html, (Selector(),))] == [("a", "<a>x<b>y<i>z</a>", "xyz"), ("b", "<b>y<i>z", "yz"), ("i", "<i>z", "z")]
    deep = "<div>" * 50_000 + "<a href=u>t</a>" * 50_000 + "</div>" * 10
    start = time.perf_counter()
    assert len(walk(deep, (Selector("a", in_tag="div"),))) == 50_000
    assert len(walk(deep, (Selector(),), own_text=True)) == 100_000
    small = time.perf_counter() - start
    start = time.perf_counter()
    walk(deep * 4, (Selector("a", in_tag="div"),))
    walk(deep * 4, (Selector(),), own_text=True)
    assert time.perf_counter() - start < 12 * small  # in proportion: about four times


def test_creator_name_needs_an_id(spark):
    df = spark.createDataFrame([("/girl/5", "Ann", "T x"), ("/about", "Ann", "王小 x"), ("/girl/6", "", "王小 x"), ("", "", "")], "h string, t string, title string")
    creator_id, name = extract.page_creator(F.col("h"), F.col("t"), F.col("title"))
    assert [tuple(r) for r in df.select(creator_id, name).collect()] == [(5, "Ann"), (None, "王小"), (6, "王小"), (None, "")]


@pytest.mark.parametrize("cap,expected", [(999, [1, 2, 3]), (1, [1, 2])])
def test_listing_stops_at_first_bare_page(spark, cap, expected):
    rows = [(1, 1, ["/album/1", "/album/2", "/x"]), (1, 2, ["/album/2", "/album/3"]), (1, 3, []), (1, 4, ["/album/9"])]
    df = spark.createDataFrame(rows, "listing_id int, page_no int, links array<string>")
    got = extract.listing_ids(df, F.col("links"), max_pages=cap).orderBy("page_no", "pos").collect()
    assert [r.collection_id for r in got] == expected


def test_listing_stops_at_a_missing_page(spark):
    rows = [(1, 1, ["/album/1"]), (1, 3, ["/album/3"]), (2, 2, ["/album/2"])]
    df = spark.createDataFrame(rows, "listing_id int, page_no int, links array<string>")
    assert [r.collection_id for r in extract.listing_ids(df, F.col("links")).collect()] == [1]
