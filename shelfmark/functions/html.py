"""Elements of HTML pages, in one pass over a page's tags with a stack of the open ones.

``elements`` is an expression: the wanted elements of a page as an array, in document order, each with its place
in the tree, its attributes and its text. It runs as an Arrow UDF, as matching closing tags needs a stack; the pass is
linear in the page, and only what the selectors ask for leaves it.

Rules, those of lenient parsers: an element without a closing tag ends with the one around it, or with the page; a
closing tag without an open element is nothing; empty elements and ``<x/>`` have no content; comments, declarations,
scripts and styles have no text. A null page has no elements.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that have no content, and those whose content is no HTML.
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in ("script", "style")}

# Quotes hide a closing bracket, unless they are never closed.
_TOKEN = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|(/)?([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>|[!?][^>]*>)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")

ELEMENT = (
    "struct<selector:int,element:int,parent:int,depth:int,tag:string,attrs:map<string,string>,"
    "start:int,end:int,inner:string,text:string>"
)


class Selector(NamedTuple):
    """Elements by name or class, perhaps only those inside an element by name or class; without any, all."""

    tag: str | None = None
    cls: str | None = None
    in_tag: str | None = None
    in_cls: str | None = None


class _Open:
    """An element on the stack; ``taken`` are its numbers among the results."""

    __slots__ = ("number", "tag", "marks", "taken", "texts", "own")

    def __init__(self, number: int, tag: str, marks: list[str], taken: list[int], texts: int):
        self.number, self.tag, self.marks, self.taken, self.texts, self.own = number, tag, marks, taken, texts, []


def attributes(rest: str) -> dict[str, str]:
    """Attributes of an opening tag by lower-case name, decoded; the first of a name counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(rest):
        value = double or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


def walk(html: str, selectors: tuple[Selector, ...], inner: bool = False, own_text: bool = False) -> list[tuple]:
    """Rows of ELEMENT, one for each selector that takes an element.

    Positions are code points. ``inner`` adds the inner HTML; ``own_text`` leaves the text of children to these.
    """
    names = {n for s in selectors for n in (s.tag, s.in_tag) if n}
    classes_count = any(s.cls or s.in_cls for s in selectors)
    every = any(not (s.tag or s.cls) for s in selectors)
    out: list[list] = []
    stack: list[_Open] = []
    inside: dict[str, int] = {}  # open elements by tag and by "." and class
    texts: list[str] = []
    at = number = reading = 0  # ``reading``: open elements that are taken

    def leave(size: int, inner_end: int, end: int) -> None:
        """Close all elements above ``size``; those above it end where its closing tag begins."""
        nonlocal reading
        while len(stack) > size:
            top = stack.pop()
            for mark in top.marks:
                inside[mark] -= 1
            reading -= bool(top.taken)
            upto = end if len(stack) == size else inner_end
            for k in top.taken:
                row = out[k]
                row[7], row[9] = upto, "".join(top.own if own_text else texts[top.texts :])
                if inner:
                    row[8] = html[row[8] : inner_end]

    while True:
        found = _TOKEN.search(html, at)
        text = html[at : found.start() if found else len(html)] if reading else ""
        if text and (text := (unescape(text) if "&" in text else text).strip()):
            if own_text:
                stack[-1].own.append(text)
            else:
                texts.append(text)
        if not found:
            break
        at = found.end()
        closing, tag, rest = found.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if inside.get(tag):
                size = len(stack) - 1
                while stack[size].tag != tag:
                    size -= 1
                leave(size, found.start(), at)
            continue
        marks, taken = [tag], []
        if every or tag in names or (classes_count and "class" in rest.lower()):
            attrs = attributes(rest)
            own = attrs.get("class", "").split()
            marks += ["." + c for c in dict.fromkeys(own)]
            for k, s in enumerate(selectors):
                if (
                    (s.tag is None or s.tag == tag) and (s.cls is None or s.cls in own)
                    and (s.in_tag is None or inside.get(s.in_tag)) and (s.in_cls is None or inside.get("." + s.in_cls))
                ):
                    taken.append(len(out))
                    out.append([k, number, stack[-1].number if stack else -1, len(stack), tag, attrs, found.start(), at, at if inner else None, ""])
        stack.append(_Open(number, tag, marks, taken, len(texts)))
        for mark in marks:
            inside[mark] = inside.get(mark, 0) + 1
        reading += bool(taken)
        number += 1
        if tag in RAW:
            last = RAW[tag].search(html, at)
            leave(len(stack) - 1, *last.span() if last else (len(html), len(html)))
            at = last.end() if last else len(html)
        elif tag in EMPTY or rest.endswith("/"):
            leave(len(stack) - 1, at, at)
    leave(0, len(html), len(html))
    return out


def elements(html: Column, *selectors: Selector, inner: bool = False, own_text: bool = False) -> Column:
    """Array of ELEMENT: what ``selectors`` take of a page, in document order."""
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.int32(), pa.int32(), pa.string(), pa.string())
    fields = ("selector", "element", "parent", "depth", "tag", "attrs", "start", "end", "inner", "text")

    def take(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            offsets, rows = [0], []
            for page in pages.to_pylist():
                rows += walk(page or "", selectors, inner, own_text)
                offsets.append(len(rows))
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            columns[5] = [list(attrs.items()) for attrs in columns[5]]
            found = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], fields)
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)

    return F.arrow_udf(take, f"array<{ELEMENT}>")(html)


def taken_by(found: Column, selector: int) -> Column:
    return F.filter(found, lambda e: e["selector"] == selector)
