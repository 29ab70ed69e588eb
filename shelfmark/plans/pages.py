"""Queries over raw pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.constants import SPACE_CLASS, WHITE_SPACE
from shelfmark.functions import media
from shelfmark.functions import text as T
from shelfmark.functions.html import EMPTY, Selector, elements, taken_by
from shelfmark.operators import extract, quality
from shelfmark.plans import bindings as B

URL_ID = r"/(\d+)"
ENGLISH_ID = r"/en/(\d+)"


TITLE, LINKS = Selector("h1"), Selector("a", in_tag="nav")


def _titled(spark, sf_dir):
    """Pages with their title and the links of their head."""
    found = B.pages(spark, sf_dir).withColumn("found", elements(F.col("html"), TITLE, LINKS))
    title = extract.page_title(taken_by(F.col("found"), 0), F.col("page_id"))
    return found.select("page_id", "url", title.alias("title"), taken_by(F.col("found"), 1).alias("links"))


def page_elements(spark, sf_dir):
    return extract.element_table(B.pages(spark, sf_dir)).withColumn("classes", F.array_join("classes", " "))


def page_title(spark, sf_dir):
    found = elements(F.col("html"), TITLE)
    return B.pages(spark, sf_dir).select("page_id", extract.page_title(found, F.col("page_id")).alias("title"))


def page_tags(spark, sf_dir):
    return extract.page_tags(B.pages(spark, sf_dir), elements(F.col("html"), LINKS))


def page_creator(spark, sf_dir):
    pages = _titled(spark, sf_dir)
    first_link = F.coalesce(F.get(extract.link_texts(F.col("links")), F.lit(0)), F.lit(""))
    creator_id, name = extract.page_creator(F.col("url"), first_link, F.col("title"), ENGLISH_ID)
    return pages.select("page_id", creator_id.alias("creator_id"), name.alias("creator_name"))


def name_from_title(spark, sf_dir):
    """Titles with a bracket, with a dash and as they are."""
    title = F.expr("""CASE page_id % 4 WHEN 0 THEN concat('[Set] ', title) WHEN 1 THEN concat(substring(title, 1, 7), ' - ', title)
                      WHEN 2 THEN concat('　', title) ELSE concat('x] 　', replace(title, ' ', '_')) END""")
    pages = _titled(spark, sf_dir).select("page_id", title.alias("title"))
    return pages.select("page_id", T.name_from_title("title").alias("name"))


def region_tags(spark, sf_dir):
    """The links wrapped in nested elements of one class, and again in a second one."""
    nav = F.regexp_extract("html", r"(?is)<nav\b[^>]*>(.*?)</nav\s*>", 1)
    wrapped = F.concat(
        F.lit("<section class='x tags'><div><b class=tag>no</b>"), nav, F.lit("<div></div></div><br/><a>last</a></section><a>outside</a>"),
        F.lit('<div id=2 class="tags">'), nav, F.lit("</div>"),
    )
    pages = B.pages(spark, sf_dir).select("page_id", wrapped.alias("html"))
    return extract.page_tags(pages, elements(F.col("html"), Selector("a", in_cls="tags")))


def _with_media(spark, sf_dir):
    """Pages whose links are made to point to media files, with a query part."""
    html = F.when(
        F.col("page_id") % 2 == 0,
        F.regexp_replace("html", 'href="/([^"]*)"', 'href="https://img.example.com/$1.jpg?w=1"'),
    ).otherwise(F.regexp_replace("html", 'href="/([^"]*)"', 'href="https://img.example.com/$1.txt?w=1"'))
    return B.pages(spark, sf_dir).select("page_id", html.alias("html"))


def page_media_urls(spark, sf_dir):
    pages = _with_media(spark, sf_dir)
    dom = extract.dom_urls(elements(F.col("html"), LINKS), ("data-src", "href"))
    raw = extract.pattern_urls(F.col("html"), r"""https://img\.example\.com/[^"']+""")
    return extract.media_urls(pages, dom, raw)


def listing_ids(spark, sf_dir):
    """Five listings; a page without its closing tag counts as one without links."""
    pages = B.pages(spark, sf_dir).selectExpr("page_id % 5 AS listing_id", "page_id div 5 + 1 AS page_no", "page_id", "url", "html")
    links = F.when(
        ~quality.truncated_html(F.col("html")),
        F.array("url", F.expr("concat('/album/', page_id div 3)"), F.lit("/about")),
    ).otherwise(F.array().cast("array<string>"))
    return extract.listing_ids(pages, links, URL_ID)


def url_clean(spark, sf_dir):
    return B.pages(spark, sf_dir).select("page_id", T.clean_url("url").alias("url"))


_URLS = "concat(url, element_at(array('.PNG', '.webp?x=.jpg', '/a.png.webp', '.jpeg'), cast(page_id % 4 AS int) + 1))"


def url_ext(spark, sf_dir):
    return B.pages(spark, sf_dir).select("page_id", T.url_extension(F.expr(_URLS)).alias("ext"))


def item_name(spark, sf_dir):
    """Positions below and above 999."""
    position = F.col("page_id") * 11
    return B.pages(spark, sf_dir).select(
        "page_id", T.item_file_name(position, T.url_extension(F.expr(_URLS))).alias("file_name")
    )


def broken_items(spark, sf_dir):
    return B.pages(spark, sf_dir).filter(quality.truncated_html(F.col("html"))).select("page_id")


def broken_bytes(spark, sf_dir):
    """Texts in the shell of an image: every fourth has no known magic, every third no end marker."""
    content = F.expr("""concat(unhex(CASE WHEN item_id % 4 = 0 THEN '00' ELSE '474946383961' END), encode(text, 'UTF-8'),
        unhex(CASE WHEN item_id % 3 = 0 THEN '' ELSE '3B' END))""")
    return B.items(spark, sf_dir).filter(media.is_broken(content)).select("item_id")


def header_probe(spark, sf_dir):
    """PNG and JPEG headers made of an item's length and id; every seventh item has other bytes."""
    content = F.expr("""CASE WHEN item_id % 7 = 0 THEN encode(text, 'UTF-8')
        WHEN item_id % 7 = 1 THEN concat(unhex('FFD8FFE000060102'), unhex('0304FFC0001108'), unhex(lpad(hex(item_id % 65536), 4, '0')),
               unhex(lpad(hex(bytes % 65536), 4, '0')), unhex('03'), encode(text, 'UTF-8'), unhex('FFD9')) ELSE
        concat(unhex('89504E470D0A1A0A0000000D49484452'), unhex(lpad(hex(bytes), 8, '0')),
               unhex(lpad(hex(item_id), 8, '0')), unhex('0802000000')) END""")
    return B.items(spark, sf_dir).select("item_id", media.header_size(content).alias("s")).select(
        "item_id", "s.width", "s.height"
    )


QUERIES = {
    "page_elements": page_elements,
    "page_title": page_title,
    "page_tags": page_tags,
    "page_creator": page_creator,
    "region_tags": region_tags,
    "name_from_title": name_from_title,
    "page_media_urls": page_media_urls,
    "listing_ids": listing_ids,
    "url_clean": url_clean,
    "url_ext": url_ext,
    "item_name": item_name,
    "broken_items": broken_items,
    "header_probe": header_probe,
    "broken_bytes": broken_bytes,
}


# The references that the pages hold; the ampersand comes last.
_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&copy;", "\xa9"), ("&middot;", "\xb7"), ("&amp;", "&"))


def _decoded(sql: str) -> str:
    for entity, char in _REFERENCES:
        sql = f"replace({sql}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return sql


def _text(sql: str) -> str:
    stripped = f"trim({_decoded('x')}, '{WHITE_SPACE}')"
    return f"array_to_string(list_transform(regexp_split_to_array({sql}, '<[^>]*>'), lambda x: {stripped}), '')"


_C = SPACE_CLASS
_NAME = f"""CASE
  WHEN length(trim(regexp_extract(t, '\\][{_C}]*([^\\[\\]]+?)(?:[{_C}]*[-_][{_C}]*|[{_C}]+[A-Za-z])', 1), '{WHITE_SPACE}')) > 1
  THEN trim(regexp_extract(t, '\\][{_C}]*([^\\[\\]]+?)(?:[{_C}]*[-_][{_C}]*|[{_C}]+[A-Za-z])', 1), '{WHITE_SPACE}')
  WHEN length(trim(regexp_extract(t, '^([^\\[\\]\\-_]+?)(?:[{_C}]*[-_][{_C}]*|[{_C}]+[A-Za-z0-9])', 1), '{WHITE_SPACE}')) > 1
  THEN trim(regexp_extract(t, '^([^\\[\\]\\-_]+?)(?:[{_C}]*[-_][{_C}]*|[{_C}]+[A-Za-z0-9])', 1), '{WHITE_SPACE}')
  WHEN length(regexp_extract(t, '^[^{_C}]+')) >= 2 THEN regexp_extract(t, '^[^{_C}]+') END"""
_TITLES = f"""titles AS (
  SELECT page_id, url, html, {_text("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")} AS title FROM pages)"""
_LINKS = f"""links AS (
  SELECT page_id, u.p, {_text("u.x")} AS tag
  FROM pages, LATERAL (SELECT unnest(a) AS x, unnest(range(1, len(a) + 1)) AS p FROM (
    SELECT regexp_extract_all(regexp_extract(html, '(?is)<nav[^>]*>(.*?)</nav>', 1), '(?is)<a\\b[^>]*>(.*?)</a>', 1) AS a)) u)"""
_TAGS = """tags AS (
  SELECT page_id, tag, row_number() OVER (PARTITION BY page_id ORDER BY min(p)) - 1 AS pos
  FROM links WHERE tag <> '' GROUP BY page_id, tag)"""
_URL_SQL = "url || ['.PNG', '.webp?x=.jpg', '/a.png.webp', '.jpeg'][page_id % 4 + 1]"
_EXT = f"CASE WHEN contains(lower({_URL_SQL}), '.png') THEN '.png' WHEN contains(lower({_URL_SQL}), '.webp') THEN '.webp' ELSE '.jpg' END"

_EMPTY_TAGS = ", ".join(f"'{t}'" for t in sorted(EMPTY))
# Pages as tokens (tags, comments, whole scripts) with the gap after each, walked with a stack of open elements.
_TOKENS = f"""tokens AS (
  SELECT page_id, size, t AS tok, gaps, k, list_sum(list_transform(gaps[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(t[1:k - 1], lambda x: length(x))), 0) AS spot
  FROM (SELECT *, unnest(range(1, len(t) + 1)) AS k FROM (SELECT page_id, length(html) AS size,
    regexp_extract_all(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<[!?][^>]*>|</?[a-z][^>]*>') AS t,
    regexp_split_to_array(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<[!?][^>]*>|</?[a-z][^>]*>') AS gaps FROM pages))),
tagged AS (
  SELECT page_id, size, k, spot, tok[k] AS tok, {_text("gaps[k + 1]")} AS text, lower(regexp_extract(tok[k], '^</?([a-zA-Z][^\\s/>]*)', 1)) AS tag, starts_with(tok[k], '</') AS closing FROM tokens),
numbered AS (
  SELECT *, CAST(sum(CASE WHEN tag <> '' AND NOT closing THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS element,
         tag <> '' AND NOT closing AS opens, tag IN ('script', 'style', {_EMPTY_TAGS}) OR right(tok, 2) = '/>' AS leaf FROM tagged),
walk(page_id, k, before, stack) AS (
  SELECT page_id, CAST(0 AS BIGINT), CAST([] AS STRUCT(tag VARCHAR, n INTEGER)[]), CAST([] AS STRUCT(tag VARCHAR, n INTEGER)[]) FROM (SELECT DISTINCT page_id FROM numbered)
  UNION ALL
  SELECT w.page_id, n.k, w.stack, CASE WHEN opens AND NOT leaf THEN list_append(w.stack, {{'tag': n.tag, 'n': n.element}})
    WHEN closing AND len(list_filter(w.stack, lambda s: s.tag = n.tag)) > 0 THEN
      w.stack[1:len(w.stack) - list_position(list_reverse(list_transform(w.stack, lambda s: s.tag)), n.tag)] ELSE w.stack END
  FROM walk w JOIN numbered n ON n.page_id = w.page_id AND n.k = w.k + 1),
opened AS (SELECT n.*, len(before) AS depth, coalesce(before[-1].n, -1) AS parent FROM numbered n JOIN walk w USING (page_id, k) WHERE opens),
ends AS (
  SELECT o.page_id, o.element, arg_min(CASE WHEN len(w.stack) = o.depth THEN n.spot + length(n.tok) ELSE n.spot END, n.k) AS spot
  FROM opened o JOIN walk w ON w.page_id = o.page_id AND w.k > o.k AND len(w.stack) <= o.depth JOIN numbered n ON n.page_id = w.page_id AND n.k = w.k
  WHERE NOT o.leaf GROUP BY ALL),
owned AS (SELECT n.page_id, w.stack[-1].n AS element, string_agg(text, '' ORDER BY n.k) AS text FROM numbered n JOIN walk w USING (page_id, k) GROUP BY ALL)"""

ORACLE = {
    "page_elements": B.cte(_TOKENS, recursive=True)
    + """SELECT page_id, element, CAST(parent AS INTEGER) AS parent, CAST(depth AS INTEGER) AS depth, tag,
           regexp_extract(tok, 'class="([^"]*)"', 1) AS classes, CAST(o.spot AS INTEGER) AS start,
           CAST(CASE WHEN leaf THEN o.spot + length(tok) ELSE coalesce(e.spot, size) END AS INTEGER) AS "end",
           CASE WHEN leaf THEN '' ELSE coalesce(owned.text, '') END AS text
         FROM opened o LEFT JOIN ends e USING (page_id, element) LEFT JOIN owned USING (page_id, element)""",
    "page_title": B.cte(_TITLES) + "SELECT page_id, title FROM titles",
    "page_tags": B.cte(_LINKS, _TAGS) + "SELECT page_id, CAST(pos AS INTEGER) AS pos, tag FROM tags",
    "region_tags": B.cte(_LINKS)
    + """SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(p)) - 1 AS INTEGER) AS pos, tag FROM (
           SELECT page_id, p, tag FROM links UNION ALL SELECT page_id, 1000000, 'last' FROM pages) WHERE tag <> '' GROUP BY page_id, tag""",
    "page_creator": B.cte(_TITLES, _LINKS, _TAGS)
    + f"""SELECT page_id, id AS creator_id, coalesce(CASE WHEN id IS NOT NULL THEN nullif(tag, '') END, {_NAME}, '') AS creator_name
          FROM (SELECT page_id, try_cast(regexp_extract(url, '/en/(\\d+)', 1) AS BIGINT) AS id, tag,
                       trim(title, '{WHITE_SPACE}') AS t
                FROM titles LEFT JOIN (SELECT page_id, tag FROM tags WHERE pos = 0) USING (page_id))""",
    "name_from_title": B.cte(_TITLES)
    + f"""SELECT page_id, {_NAME} AS name FROM (SELECT page_id, trim(CASE page_id % 4 WHEN 0 THEN '[Set] ' || title
            WHEN 1 THEN substr(title, 1, 7) || ' - ' || title WHEN 2 THEN '　' || title
            ELSE 'x] 　' || replace(title, ' ', '_') END, '{WHITE_SPACE}') AS t FROM titles)""",
    "page_media_urls": """
        WITH shown AS (SELECT page_id, regexp_replace(html, 'href="/([^"]*)"',
            'href="https://img.example.com/\\1.' || CASE WHEN page_id % 2 = 0 THEN 'jpg' ELSE 'txt' END || '?w=1"', 'g') AS html FROM pages),
        dom AS (SELECT page_id, u.x, u.p FROM shown, LATERAL (SELECT unnest(a) AS x, unnest(range(1, len(a) + 1)) AS p FROM (
            SELECT list_filter(regexp_extract_all(regexp_extract(html, '(?is)<nav[^>]*>(.*?)</nav>', 1), 'href="([^"]*)"', 1),
                               lambda x: contains(x, '://')) AS a)) u),
        raw AS (SELECT page_id, u.x, u.p + 1000000000 AS p FROM shown, LATERAL (SELECT unnest(a) AS x, unnest(range(1, len(a) + 1)) AS p FROM (
            SELECT regexp_extract_all(html, 'https://img\\.example\\.com/[^"'']+') AS a)) u),
        cleaned AS (
            SELECT page_id, p, replace(replace(replace(split_part(x, '?', 1), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS url FROM dom
            UNION ALL SELECT page_id, p, split_part(x, '?', 1) FROM raw WHERE regexp_matches(split_part(x, '?', 1), '\\.(jpg|jpeg|png|webp)$')),
        placed AS (SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY min(p)) AS position FROM cleaned GROUP BY page_id, url)
        SELECT page_id, CAST(position AS INTEGER) AS position, url, printf('%03d', position) ||
            CASE WHEN contains(lower(url), '.png') THEN '.png' WHEN contains(lower(url), '.webp') THEN '.webp' ELSE '.jpg' END AS file_name
        FROM placed""",
    "listing_ids": """
        WITH listed AS (SELECT page_id % 5 AS listing_id, page_id // 5 + 1 AS page_no,
            CASE WHEN contains(lower(html), '</html>') THEN [url, '/album/' || page_id // 3, '/about'] ELSE [] END AS links FROM pages),
        stops AS (SELECT listing_id, min(page_no) AS stop FROM listed WHERE len(links) = 0 GROUP BY listing_id),
        linked AS (SELECT l.listing_id, page_no, u.p, try_cast(regexp_extract(u.x, '/(\\d+)', 1) AS BIGINT) AS collection_id
            FROM listed l LEFT JOIN stops s ON s.listing_id = l.listing_id,
            LATERAL (SELECT unnest(links) AS x, unnest(range(0, len(links))) AS p) u
            WHERE stop IS NULL OR page_no < stop)
        SELECT listing_id, collection_id, page_no, CAST(p AS INTEGER) AS pos FROM linked WHERE collection_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY listing_id, collection_id ORDER BY page_no, p) = 1""",
    "url_clean": "SELECT page_id, split_part(url, '?', 1) AS url FROM pages",
    "url_ext": f"SELECT page_id, {_EXT} AS ext FROM pages",
    "item_name": f"SELECT page_id, printf('%03d', page_id * 11) || {_EXT} AS file_name FROM pages",
    "broken_items": "SELECT page_id FROM pages WHERE NOT contains(lower(html), '</html>')",
    "header_probe": B.cte(B.ITEMS)
    + """SELECT item_id, CASE item_id % 7 WHEN 0 THEN 0 WHEN 1 THEN bytes % 65536 ELSE bytes END AS width,
         CASE item_id % 7 WHEN 0 THEN 0 WHEN 1 THEN item_id % 65536 ELSE item_id END AS height FROM items""",
    "broken_bytes": B.cte(B.ITEMS)
    + "SELECT item_id FROM items WHERE item_id % 4 = 0 OR (item_id % 3 = 0 AND right(text, 1) <> ';')",
}
