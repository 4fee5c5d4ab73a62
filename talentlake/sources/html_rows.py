"""Rows of repeating HTML elements.

``link_items`` needs no more than expressions. A table of market values nests further
tables in its rows, which no regular expression can match, so ``table_rows`` runs the
standard library's parser over batches of pages.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree.ElementTree import Element, TreeBuilder

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.schemas import MARKET_VALUES

# Python workers get the parser by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The classes that mark the table, its name cell and its value cells.
TABLE_CLASS = "items"
NAME_CLASS = "hauptlink"
VALUE_CLASS = "rechts"
# The HTML elements that never have an end tag.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)

ITEM = r"(?is)<li\b[^>]*>(.*?)</li>"
HREF = r'(?is)<a\b[^>]*\bhref="([^"]*)"'
ANCHOR = r"(?is)<a\b[^>]*>(.*?)</a>"
TAG = r"(?s)<[^>]*>"


def link_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """Text and target of the first anchor of every list item; items lacking it are skipped."""
    item = F.col("item")
    others = [c for c in pages.columns if c != html]
    return (
        pages.select(*others, F.posexplode(F.regexp_extract_all(html, F.lit(ITEM))))
        .withColumnsRenamed({"pos": "position", "col": "item"})
        .select(
            *others,
            "position",
            F.trim(F.regexp_replace(F.regexp_extract(item, ANCHOR, 1), TAG, "")).alias("text"),
            F.regexp_extract(item, HREF, 1).alias("href"),
        )
        .where("text <> '' and href <> ''")
    )


class _Tree(HTMLParser):
    """Builds an element tree; closes what an end tag leaves open, ignores stray end tags."""

    def __init__(self) -> None:
        super().__init__()
        self._builder = TreeBuilder()
        self._open = ["document"]
        self._builder.start("document", {})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._builder.start(tag, {name: value or "" for name, value in attrs})
        self._open.append(tag)
        if tag in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self._open[1:]:
            while True:
                closed = self._open.pop()
                self._builder.end(closed)
                if closed == tag:
                    break

    def handle_data(self, data: str) -> None:
        self._builder.data(data)

    def root(self, html: str) -> Element:
        self.feed(html)
        self.close()
        while self._open:
            self._builder.end(self._open.pop())
        return self._builder.close()


def _with_class(element: Element, tag: str, name: str) -> list[Element]:
    return [e for e in element.iter(tag) if name in e.get("class", "").split()]


def _text(element: Element) -> str:
    return "".join(element.itertext()).strip()


def parse_table(html: str) -> list[tuple[str, str]]:
    """(name, value) of every body row of the first items table, nested rows included."""
    tables = _with_class(_Tree().root(html), "table", TABLE_CLASS)
    rows = {id(r): r for t in tables[:1] for b in t.iter("tbody") for r in b.iter("tr")}
    found = []
    for row in rows.values():
        anchors = [a for cell in _with_class(row, "td", NAME_CLASS) for a in cell.iter("a")]
        cells = _with_class(row, "td", VALUE_CLASS)
        if anchors and cells:
            found.append((_text(anchors[0]), _text(cells[-1])))
    return found


def table_rows(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Market-value rows of every page: name, raw value and the page they came from."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["player_name", "market_value_raw", "scraped_url"]
        for batch in batches:
            rows = [
                (*row, address)
                for address, page in zip(batch[url], batch[html])
                if page is not None
                for row in parse_table(page)
            ]
            yield pd.DataFrame(rows, columns=columns, dtype="object")

    return pages.select(url, html).mapInPandas(parse, MARKET_VALUES)
