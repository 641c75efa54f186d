"""HTML table rows from a table of pages.

Each page is parsed independently inside a ``mapInPandas`` task (stdlib
``html.parser``; pages are partitioned by Spark, never gathered). For every
row element inside the chosen container the output holds the texts of its
cell elements and, per cell, the texts of the links in it — the shape the
banks extract reads (rank cell, name cell with links, value cell).

Matching follows ``find_all`` semantics: a row collects every cell below
it, a cell every text and link below it; texts are stripped like
``str.strip()``; character references are decoded.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import drop_last_char, safe_double, safe_long

ROW_SCHEMA = "page_id long, row_no int, cells array<string>, links array<array<string>>"


class _RowCollector(HTMLParser):
    def __init__(self, container, row, cell, link, first_only):
        super().__init__(convert_charrefs=True)
        self.container, self.row, self.cell, self.link = container, row, cell, link
        self.first_only = first_only
        self.containers_seen = 0
        self.in_container = 0 if container else 1
        self.rows: list[dict] = []
        self.open_rows: list[dict] = []
        self.open_cells: list[dict] = []
        self.open_links: list[list] = []

    def handle_starttag(self, tag, attrs):
        if self.container and tag == self.container:
            if self.in_container:
                self.in_container += 1
            elif not (self.first_only and self.containers_seen):
                self.containers_seen += 1
                self.in_container = 1
            return
        if not self.in_container:
            return
        if tag == self.row:
            r = {"cells": [], "links": []}
            self.rows.append(r)
            self.open_rows.append(r)
            if self.cell is None:  # the row is its own single cell
                c = {"text": [], "links": [], "row": r}
                r["cells"].append(c)
                self.open_cells.append(c)
        elif self.cell is not None and tag == self.cell and self.open_rows:
            c = {"text": [], "links": []}
            for r in self.open_rows:
                r["cells"].append(c)
            self.open_cells.append(c)
        elif tag == self.link and self.open_cells:
            lk: list = []
            for c in self.open_cells:
                c["links"].append(lk)
            self.open_links.append(lk)

    def handle_endtag(self, tag):
        if self.container and tag == self.container and self.in_container:
            self.in_container -= 1
            if not self.in_container:
                self.open_rows, self.open_cells, self.open_links = [], [], []
            return
        if tag == self.link and self.open_links:
            self.open_links.pop()
        elif self.cell is not None and tag == self.cell and self.open_cells:
            self.open_cells.pop()
        elif tag == self.row and self.open_rows:
            r = self.open_rows.pop()
            if self.cell is None:
                self.open_cells = [c for c in self.open_cells if c.get("row") is not r]

    def handle_data(self, data):
        for c in self.open_cells:
            c["text"].append(data)
        for lk in self.open_links:
            lk.append(data)


def parse_rows(html: str | None, container="tbody", row="tr", cell="td", link="a",
               first_only=True) -> list[tuple[list[str], list[list[str]]]]:
    """Rows of one page: (cell texts, link texts per cell)."""
    if not html:
        return []
    p = _RowCollector(container, row, cell, link, first_only)
    p.feed(html)
    p.close()
    out = []
    for r in p.rows:
        cells = ["".join(c["text"]).strip() for c in r["cells"]]
        links = [["".join(lk).strip() for lk in c["links"]] for c in r["cells"]]
        out.append((cells, links))
    return out


def extract_rows(pages: DataFrame, container: str | None = "tbody", row: str = "tr",
                 cell: str | None = "td", link: str = "a", first_only: bool = True,
                 id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page_id, row_no, cells, links)`` for every row of every page."""

    def run(batches):
        for pdf in batches:
            ids, nos, cells, links = [], [], [], []
            for pid, html in zip(pdf["__id"], pdf["__html"]):
                for i, (cs, ls) in enumerate(parse_rows(html, container, row, cell, link,
                                                        first_only), start=1):
                    ids.append(pid)
                    nos.append(i)
                    cells.append(cs)
                    links.append(ls)
            yield pd.DataFrame({"page_id": pd.Series(ids, dtype="int64"),
                                "row_no": pd.Series(nos, dtype="int32"),
                                "cells": cells, "links": links})

    src = pages.select(F.col(id_col).cast("long").alias("__id"), F.col(html_col).alias("__html"))
    return src.mapInPandas(run, ROW_SCHEMA)


def link_rows(rows: DataFrame) -> DataFrame:
    """Rows whose first cell holds a link: ``(page_id, row_no, link_text)``
    with the text of the cell's last link."""
    return (rows.where(F.size(F.try_element_at("links", F.lit(1))) > 0)
                .select("page_id", "row_no",
                        F.element_at(F.element_at("links", 1), -1).alias("link_text")))


def bank_rows(rows: DataFrame, drop_last: bool = True) -> DataFrame:
    """Banks table from table rows: rows with cells, whose second cell has
    a link; rank (int, bad -> null), name = last link of cell 2, market
    cap = cell 3 as a number (last character dropped when ``drop_last``,
    as the source page puts a marker after the figure)."""
    has = (F.size("cells") >= 3) & (F.size(F.element_at("links", 2)) > 0)
    mc = F.element_at("cells", 3)
    if drop_last:
        mc = drop_last_char(mc)
    return rows.where(has).select(
        "page_id", "row_no",
        safe_long(F.element_at("cells", 1)).alias("Rank"),
        F.element_at(F.element_at("links", 2), -1).alias("Country"),
        safe_double(mc).alias("MC_USD_Billion"))


def banks(pages: DataFrame) -> DataFrame:
    """``(Rank, Country, MC_USD_Billion)`` from the first table body of every page."""
    return bank_rows(extract_rows(pages)).drop("page_id", "row_no")
