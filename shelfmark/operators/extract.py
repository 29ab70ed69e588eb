"""Facts from raw pages, read from the elements of one pass. Everything per page is an expression over its row: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.constants import COLLECTION_LINK, CREATOR_LINK
from shelfmark.functions.html import Selector, elements
from shelfmark.functions.text import clean_url, item_file_name, name_from_title, url_extension
from shelfmark.scale import attach
from shelfmark.storage import stage

ITEM_SUFFIX = r"\.(jpg|jpeg|png|webp)$"


def class_regions(html: Column, name: str) -> Column:
    """Inner HTML of every element carrying a class, nested ones within their parents, too."""
    return F.transform(elements(html, Selector(cls=name), inner=True), lambda e: e["inner"])


def class_region(html: Column, name: str) -> Column:
    """Inner HTML of the first element carrying a class, empty without one."""
    return F.coalesce(F.get(class_regions(html, name), F.lit(0)), F.lit(""))


def element_table(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row per element: page_id, element, parent, depth, tag, classes, start, end and the text of its own.

    Elements are numbered in document order; ``parent`` is -1 and ``depth`` 0 at the top; ``start`` and ``end`` are
    code points of the page, tags included.
    """
    rows = pages.select("page_id", F.inline(elements(F.col(html), Selector(), own_text=True)))
    names = F.filter(F.split(F.coalesce(F.try_element_at("attrs", F.lit("class")), F.lit("")), r"\s+"), lambda c: c != "")
    return rows.select("page_id", "element", "parent", "depth", "tag", names.alias("classes"), "start", "end", "text")


def page_title(found: Column, page_id: Column) -> Column:
    """Text of the first of the ``h1`` elements; ``album_<id>`` when the page has none."""
    return F.coalesce(F.get(found, F.lit(0))["text"], F.format_string("album_%s", page_id.cast("string")))


def link_texts(found: Column) -> Column:
    """Non-empty texts of elements, each once, in order of first appearance."""
    return F.array_distinct(F.filter(F.transform(found, lambda e: e["text"]), lambda x: x != ""))


def page_tags(pages: DataFrame, found: Column) -> DataFrame:
    return pages.select("page_id", F.posexplode(link_texts(found)).alias("pos", "tag"))


def page_creator(link_href: Column, link_text: Column, title: Column, pattern: str = CREATOR_LINK) -> tuple[Column, Column]:
    """(creator id, creator name); the link's text counts only when its address has an id."""
    creator_id = F.regexp_extract(link_href, pattern, 1).try_cast("bigint")
    name = F.when(creator_id.isNotNull() & (link_text != ""), link_text)
    return creator_id, F.coalesce(name, name_from_title(title), F.lit(""))


def dom_urls(found: Column, attributes: tuple[str, ...] = ("src", "data-src"), most: int | None = None) -> Column:
    """Absolute addresses of elements, query dropped; the first attribute that is not empty counts, ``most`` may limit their number."""

    def address(element: Column) -> Column:
        return F.coalesce(*[F.nullif(F.try_element_at(element["attrs"], F.lit(a)), F.lit("")) for a in attributes], F.lit(""))

    absolute = F.filter(F.transform(found, address), lambda u: F.contains(u, F.lit("://")))
    urls = F.transform(absolute, clean_url)
    return urls if most is None else F.slice(urls, 1, most)


def pattern_urls(html: Column, pattern: str, most: int | None = None) -> Column:
    """Raw matches that end in an item suffix once the query is dropped; ``most`` may limit the matches."""
    matches = F.regexp_extract_all(html, F.lit(pattern), 0)
    matches = matches if most is None else F.slice(matches, 1, most)
    return F.filter(F.transform(matches, clean_url), lambda u: u.rlike(ITEM_SUFFIX))


def media_urls(pages: DataFrame, *passes: Column, area: Column | None = None) -> DataFrame:
    """Addresses of all passes in order, each once, with dense 1-based positions and file names.

    With ``area``, elements of the page, a page that has none of them has no addresses at all, raw ones included.
    """
    urls = F.array_distinct(F.concat(*passes))
    rows = pages if area is None else pages.filter(F.size(area) > 0)
    found = rows.select("page_id", F.posexplode(urls).alias("_p", "url"))
    return found.select(
        "page_id",
        (F.col("_p") + 1).alias("position"),
        "url",
        item_file_name((F.col("_p") + 1).cast("bigint"), url_extension("url")).alias("file_name"),
    )


def _missing_pages(listings: DataFrame) -> DataFrame:
    """Page numbers a walk from 1 would find absent: the one after each run of pages."""
    present = listings.select("listing_id", F.col("page_no").cast("bigint").alias("page_no"))
    wanted = present.select("listing_id", F.explode(F.array(F.lit(1).cast("bigint"), F.col("page_no") + 1)).alias("page_no"))
    return wanted.distinct().join(present, ["listing_id", "page_no"], "left_anti")


def listing_ids(
    listings: DataFrame, links: Column, pattern: str = COLLECTION_LINK, max_pages: int | None = None
) -> DataFrame:
    """Ids linked from listing pages, each at its first place.

    ``listings`` has listing_id, page_no and whatever ``links`` reads. A listing ends before its
    first page without links or that is missing. The pages are read once, into the first place of every id and of every
    listing's bare pages; an id first seen after the end is never seen before it.
    """
    hrefs = F.transform(F.coalesce(links, F.array()), lambda x: F.regexp_extract(x, pattern, 1).try_cast("bigint"))
    places = F.transform(hrefs, lambda x, i: F.struct(x.alias("collection_id"), i.alias("pos")))
    bare = F.array(F.struct(F.lit(None).cast("bigint").alias("collection_id"), F.lit(0).alias("pos")))
    found = F.when(F.size(places) == 0, bare).otherwise(F.filter(places, lambda p: p["collection_id"].isNotNull()))
    first = stage(
        (listings if max_pages is None else listings.filter(F.col("page_no") <= max_pages))
        .select("listing_id", "page_no", F.explode(found).alias("p"))
        .groupBy("listing_id", "p.collection_id")
        .agg(F.min(F.struct("page_no", "p.pos")).alias("at"))
        .select("listing_id", "collection_id", "at.page_no", "at.pos"),
        "listing",
    )
    bare_pages = first.filter(F.col("collection_id").isNull()).select("listing_id", "page_no")
    ends = bare_pages.unionByName(_missing_pages(listings)).groupBy("listing_id").agg(F.min("page_no").alias("_end"))
    ids = first.filter(F.col("collection_id").isNotNull())
    return (
        attach(ids, ends, ["listing_id"], ["collection_id"])
        .filter(F.col("_end").isNull() | (F.col("page_no") < F.col("_end")))
        .drop("_end")
    )
