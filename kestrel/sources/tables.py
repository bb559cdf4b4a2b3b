"""HTML tables as rows (S19, D4): any table of a page, laid out on its grid.

A page becomes 0..n rows in its own task: the parser walks the markup once, and spanning cells fill
every place of the grid that they cover.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The HTML standard's largest spans.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534


class _Table:
    def __init__(self):
        self.rows: list[list] = []  # cells (text pieces, colspan, rowspan, is header)
        self.head_rows = 0
        self.in_head = False
        self.cell = None


class TableReader(HTMLParser):
    """Collects the tables of a page in the order of their opening tags.

    Omitted end tags close as in browsers: a cell ends at the next cell or row of its table. A nested
    table is a table of its own; its text is also part of the cell around it. Scripts and styles
    are no text.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self.open: list[_Table] = []
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.silent += 1
        elif tag == "table":
            self.open.append(_Table())
            self.tables.append(self.open[-1])
        elif not self.open:
            return
        elif tag == "thead":
            self.open[-1].in_head = True
        elif tag in ("tbody", "tfoot"):
            self.open[-1].in_head, self.open[-1].cell = False, None
        elif tag == "tr":
            self._row()
        elif tag in ("td", "th"):
            t = self.open[-1]
            if not t.rows or t.cell == "closed":
                self._row()
            t.cell = [[], _span(attrs, "colspan", MAX_COLSPAN), _span(attrs, "rowspan", MAX_ROWSPAN), tag == "th"]
            t.rows[-1].append(t.cell)
        elif tag in ("br", "p", "div", "li"):
            self.handle_data(" ")

    def _row(self):
        t = self.open[-1]
        t.rows.append([])
        t.cell = None
        if t.in_head:
            t.head_rows = len(t.rows)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.silent = max(0, self.silent - 1)
        elif tag == "table" and self.open:
            self.open.pop()
        elif self.open and tag in ("td", "th"):
            self.open[-1].cell = None
        elif self.open and tag == "tr":
            self.open[-1].cell = "closed"
        elif self.open and tag == "thead":
            self.open[-1].in_head = False

    def handle_data(self, data):
        if self.silent:
            return
        for t in self.open:
            if isinstance(t.cell, list):
                t.cell[0].append(data)


def _span(attrs, name: str, most: int) -> int:
    """A span attribute as browsers read it: leading digits, 1 when there are none; rowspan 0 reaches the end."""
    text = next((v or "" for k, v in attrs if k == name), "").strip()
    digits = text[:len(text) - len(text.lstrip("0123456789"))]
    n = int(digits) if digits else 1
    return min(n, most) if n else (most if name == "rowspan" else 1)


def grid(table: _Table) -> list[list]:
    """The table's rows laid out: each place holds the text of the cell that covers it, or None."""
    out, hanging = [], {}  # hanging: column -> (text, rows left)
    for cells in table.rows:
        line: dict = {}
        kept = {}
        for col, (text, left) in hanging.items():
            line[col] = text
            if left > 1:
                kept[col] = (text, left - 1)
        hanging, at = kept, 0
        for pieces, colspan, rowspan, _ in cells:
            while at in line:
                at += 1
            text = " ".join("".join(pieces).split())
            for col in range(at, at + colspan):
                line[col] = text
                if rowspan > 1:
                    hanging[col] = (text, rowspan - 1)
            at += colspan
        out.append([line.get(c) for c in range(max(line, default=-1) + 1)])
    width = max(map(len, out), default=0)
    return [row + [None] * (width - len(row)) for row in out]


def header_rows(table: _Table) -> int:
    """Rows of names: those of ``thead``, or else the leading rows made of ``th`` cells only."""
    if table.head_rows:
        return table.head_rows
    n = 0
    while n < len(table.rows) and table.rows[n] and all(c[3] for c in table.rows[n]):
        n += 1
    return n


def page_tables(html: str | None) -> Iterator[tuple[int, int, int, str, str | None]]:
    """(table number, row, position, column name, text) of every place of every table of a page.

    Several header rows join their different names with a blank; without a header row the names are
    the positions.
    """
    reader = TableReader()
    reader.feed(html or "")
    reader.close()
    for number, table in enumerate(reader.tables):
        rows, heads = grid(table), header_rows(table)
        width = len(rows[0]) if rows else 0
        names = [" ".join(dict.fromkeys(r[c] for r in rows[:heads] if r[c])) or str(c) for c in range(width)]
        for i, row in enumerate(rows[heads:]):
            for c, text in enumerate(row):
                yield number, i, c, names[c], text


def html_tables(df: DataFrame, html_col: str, keep: Sequence[str] = (), only: int | None = None) -> DataFrame:
    """The tables of each page as long rows: (keep, table, row, position, column, value).

    ``only``: the number of the one table wanted (0: the first). Spanning cells repeat their text in
    every place they cover; places that no cell covers are null. Pages without a table, empty
    and null pages give no rows.
    """
    keep = list(keep)
    typed = "".join(f"`{k}` {t}, " for k, t in df.select(*keep).dtypes)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(i, *row) for i, html in enumerate(pdf["_html"]) for row in page_tables(html)
                     if only is None or row[0] == only]
            out = pd.DataFrame(found, columns=["_i", "table", "row", "position", "column", "value"])
            kept = pdf[keep].iloc[out["_i"]].reset_index(drop=True)
            yield pd.concat([kept, out.drop(columns="_i")], axis=1)

    return df.select(*keep, F.col(html_col).cast("string").alias("_html")).mapInPandas(
        read, f"{typed}table int, row long, position int, column string, value string")
