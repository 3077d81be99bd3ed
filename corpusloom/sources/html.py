"""Tables inside stored HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROWS = "page_id bigint, table_idx int, row_idx int, is_header boolean, cells array<string>, error string"


_SPAN_LIMIT = 1000  # what browsers take of a cell's span


def _hidden(attrs) -> bool:
    given = dict(attrs)
    return "hidden" in given or "display:none" in (given.get("style") or "").replace(" ", "").lower()


def _span(attrs, name: str) -> int:
    value = (dict(attrs).get(name) or "").strip()
    return min(max(int(value), 1), _SPAN_LIMIT) if value.isdecimal() else 1


class _Tables(HTMLParser):
    """Collects the cells of every outer table that has text; text of a table inside a cell belongs to that cell.

    A cell that spans columns or rows is repeated. Rows of a head, and rows of head cells before any
    other, are header rows. Hidden rows and cells, scripts and styles are left out.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[tuple[bool, list[str]]]] = []
        self._depth = 0
        self._rows: list[tuple[bool, list[str]]] = []
        self._row: list[str] | None = None
        self._cell: list[str] | None = None
        self._spans = (1, 1)
        self._down: dict[int, tuple[int, str]] = {}
        self._header = self._in_head = self._skip_row = self._skip_cell = False
        self._silent = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self._silent += 1
        elif tag == "table":
            self._depth += 1
            if self._depth == 1:
                self._rows, self._down, self._in_head = [], {}, False
        elif self._depth == 1 and tag in ("thead", "tbody", "tfoot"):
            self._end_row()
            self._in_head = tag == "thead"
        elif self._depth == 1 and tag == "tr":
            self._end_row()
            self._row, self._header, self._skip_row = [], True, _hidden(attrs)
        elif self._depth == 1 and tag in ("td", "th"):
            self._end_cell()
            if self._row is None:
                self._row, self._header, self._skip_row = [], True, False
            self._cell, self._skip_cell = [], _hidden(attrs)
            self._spans = _span(attrs, "colspan"), _span(attrs, "rowspan")
            self._header &= tag == "th"

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self._silent = max(self._silent - 1, 0)
        elif tag == "table" and self._depth:
            if self._depth == 1:
                self._end_table()
            self._depth -= 1
        elif self._depth == 1 and tag in ("td", "th"):
            self._end_cell()
        elif self._depth == 1 and tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()
            self._in_head &= tag == "tr"

    def handle_data(self, data):
        if self._cell is not None and not self._silent:
            self._cell.append(data)

    def close(self):
        super().close()
        if self._depth:
            self._end_table()

    def _from_above(self):
        while len(self._row) in self._down:
            left, text = self._down.pop(at := len(self._row))
            self._row.append(text)
            if left > 1:
                self._down[at] = (left - 1, text)

    def _end_cell(self):
        if self._cell is not None and not self._skip_cell:
            text = " ".join("".join(self._cell).split())
            self._from_above()
            for _ in range(self._spans[0]):
                if self._spans[1] > 1:
                    self._down[len(self._row)] = (self._spans[1] - 1, text)
                self._row.append(text)
        self._cell = None

    def _end_row(self):
        self._end_cell()
        if self._row and not self._skip_row:
            self._from_above_rest()
            leading = all(header for header, _ in self._rows)
            self._rows.append((self._in_head or self._header and leading, self._row))
        self._row = None

    def _from_above_rest(self):
        """Cells of rows above that end to the right of the row's own."""
        for at in sorted(c for c in self._down if c >= len(self._row)):
            if at == len(self._row):
                left, text = self._down.pop(at)
                self._row.append(text)
                if left > 1:
                    self._down[at] = (left - 1, text)

    def _end_table(self):
        self._end_row()
        if any(cell for _, row in self._rows for cell in row):
            self.tables.append(self._rows)
        self._rows = []


def html_table_rows(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Rows of all tables: ``page_id, table_idx, row_idx, is_header, cells, error``.

    A page that cannot be parsed gives one row with ``error`` and no cells; a page without a table
    gives none. Pages are independent, so nothing is shuffled.
    """

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for page, text in zip(frame["page_id"], frame["html"]):
                try:
                    parser = _Tables()
                    parser.feed(text)
                    parser.close()
                except Exception as failure:  # noqa: BLE001 - a bad page must not fail the run
                    out.append((page, None, None, None, None, str(failure)))
                    continue
                for t, rows in enumerate(parser.tables):
                    out.extend((page, t, r, header, cells, None) for r, (header, cells) in enumerate(rows))
            yield pd.DataFrame(out, columns=["page_id", "table_idx", "row_idx", "is_header", "cells", "error"])

    # Most pages of a crawl hold no table; they never reach Python.
    candidates = pages.where(F.col(html).rlike("(?i)<table")).select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(html).alias("html")
    )
    return candidates.mapInPandas(parse, _ROWS)


def first_table(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Body rows of the first table of each page."""
    rows = html_table_rows(pages, page_id, html)
    return rows.where((F.col("table_idx") == 0) & ~F.col("is_header")).select("page_id", "row_idx", "cells")
