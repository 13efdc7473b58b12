"""Rows from HTML pages: titles and links by expressions, table rows by a tolerant parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def title(html: Column) -> Column:
    """The text of the title element as it stands."""
    return F.regexp_extract(html, "<title>([^<]*)", 1)


def links(html: Column) -> Column:
    """How many links a page has."""
    return F.size(F.regexp_extract_all(html, F.lit("<a "), 0)).cast("bigint")


class Tables(HTMLParser):
    """Cells of all rows of all tables, a cell as (text, first link). End tags of cells and rows may be left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, list[tuple[str, str]]]] = []
        self.open: list[int] = []
        self.count = 0
        self.cell: list[str] | None = None
        self.link = ""

    def end_cell(self) -> None:
        if self.cell is not None and self.rows:
            self.rows[-1][1].append((" ".join("".join(self.cell).split()), self.link))
        self.cell, self.link = None, ""

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.end_cell()
            self.open.append(self.count)
            self.count += 1
        elif tag == "tr" and self.open:
            self.end_cell()
            self.rows.append((self.open[-1], []))
        elif tag in ("td", "th") and self.open:
            self.end_cell()
            if not self.rows or self.rows[-1][0] != self.open[-1]:
                self.rows.append((self.open[-1], []))
            self.cell = []
        elif tag == "a" and self.cell is not None and not self.link:
            self.link = dict(attrs).get("href") or ""

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.end_cell()
        if tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def page_rows(html: str | None) -> list[tuple[int, int, list[str], list[str]]]:
    parser = Tables()
    parser.feed(html or "")
    parser.close()
    parser.end_cell()
    numbers: dict[int, int] = {}
    out = []
    for table, cells in parser.rows:
        numbers[table] = numbers.get(table, -1) + 1
        out.append((table, numbers[table], [t for t, _ in cells], [a for _, a in cells]))
    return out


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table, row, cells, links) of every table row of every page."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(k, *r) for k, h in zip(pdf[key], pdf[html], strict=True) for r in page_rows(h)]
            yield pd.DataFrame(found, columns=[key, "table_no", "row_no", "cells", "links"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInPandas(rows, f"{key} {kind}, table_no int, row_no int, cells array<string>, links array<string>")
