"""Row-local text extraction as table functions (S13, S14, S17-S19): regex groups,
link lists, key-value and 'key: value' records, HTML table cells. Each input row
yields 0..n output rows through ``explode``, so the work is spread like the input."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import last_path_part, zero_pad

# Link text pattern of game links, 'AAA@BBB (m/d/yy)', and the game id
# built from it: gid_<year>_<mm>_<dd>_<first team>mlb_<second team>mlb_1.
GAME_LINK_PATTERN = r"^([A-Z]{3})@([A-Z]{3})\s+\((\d+)/(\d+)/(\d+)\)"
GAME_ID_FORMAT = "gid_{year}_{month}_{day}_{first}mlb_{second}mlb_1"


def html_links(df: DataFrame, html_col: str, pattern: str = r'href="(/[^"]*)"', keep=()) -> DataFrame:
    """One row per matching link: href group 1 and its last path part as id."""
    hrefs = F.regexp_extract_all(F.col(html_col), F.lit(pattern), 1)
    return (df.select(*keep, F.explode(hrefs).alias("href"))
            .select(*keep, "href", last_path_part("href").alias("link_id")))


def game_ids(df: DataFrame, text_col: str, year: int, keep=()) -> DataFrame:
    """Parse 'AAA@BBB (m/d/yy)' link texts; keep those whose yy matches ``year``; build
    gid_<year>_<mm>_<dd>_<aaa>mlb_<bbb>mlb_1 (S18, F6)."""
    t = F.col(text_col)
    g = lambda i: F.regexp_extract(t, GAME_LINK_PATTERN, i)
    matched = df.filter(t.rlike(GAME_LINK_PATTERN))
    parts = {"year": F.lit(str(year)), "month": zero_pad(g(3), 2), "day": zero_pad(g(4), 2),
             "first": F.lower(g(1)), "second": F.lower(g(2))}
    gid = F.concat(*_format_columns(GAME_ID_FORMAT, parts))
    return matched.filter(g(5) == F.lit(str(year)[-2:])).select(*keep, gid.alias("game_id"))


def _format_columns(fmt: str, parts: dict) -> list:
    """Split a '{name}' format into literal and column pieces for ``concat``."""
    out = []
    for lit_text, field, _, _ in string.Formatter().parse(fmt):
        if lit_text:
            out.append(F.lit(lit_text))
        if field:
            out.append(parts[field])
    return out


def html_table_rows(df: DataFrame, html_col: str, keep=()) -> DataFrame:
    """First <table> of each page as long rows (row number, column name, cell text):
    the first row holds the column names (S19)."""
    table = F.regexp_extract(F.col(html_col), r"(?s)<table[^>]*>(.*?)</table>", 1)
    rows = F.regexp_extract_all(table, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), 1)
    cells = lambda r: F.regexp_extract_all(r, F.lit(r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"), 1)
    with_rows = df.select(*keep, F.transform(rows, cells).alias("_cells"))
    header = F.element_at("_cells", 1)
    body = F.slice("_cells", 2, F.greatest(F.size("_cells") - 1, F.lit(0)))
    ex = with_rows.select(*keep, header.alias("_h"), F.posexplode(body).alias("row", "_r"))
    return ex.select(*keep, F.col("row").cast("long").alias("row"),
                     F.explode(F.arrays_zip(F.col("_h").alias("column"), F.col("_r").alias("value"))).alias("_c")) \
        .select(*keep, "row", "_c.column", "_c.value")


def kv_map(text: Column, line_sep: str = "\n", kv_sep: str = "\t") -> Column:
    """'key<TAB>value' lines to a map (S13): the value is all after the first separator, the
    last line of a repeated key wins, a line without a separator is its own value."""
    lines = F.filter(F.split(text, line_sep), lambda x: F.length(x) > 0)
    key = lambda x: F.substring_index(x, kv_sep, 1)
    value = lambda x: F.when(F.contains(x, F.lit(kv_sep)),
                             F.substring(x, F.length(key(x)) + F.lit(len(kv_sep) + 1), F.length(x))).otherwise(x)
    entry = lambda x: F.struct(key(x).alias("key"), value(x).alias("value"))
    last = F.filter(F.transform(lines, entry), lambda e, i: ~F.exists(
        F.slice(lines, i + 2, F.size(lines)), lambda y: key(y) == e["key"]))
    return F.map_from_entries(last)


def record_lines(df: DataFrame, text_col: str, keep=(), sep: str = ": ") -> DataFrame:
    """'key: value' record lines to typed long rows (S14, D3): 'nan' -> NULL, a value
    that parses as a number -> num, anything else -> text."""
    lines = F.filter(F.split(F.col(text_col), "\n"), lambda x: F.length(x) > 0)
    ex = df.select(*keep, F.explode(lines).alias("_l"))
    key = F.substring_index("_l", sep, 1)
    raw = F.expr(f"substring(_l, length(substring_index(_l, '{sep}', 1)) + {len(sep) + 1})")
    num = F.when(raw == "nan", F.lit(None).cast("double")).otherwise(raw.try_cast("double"))
    text = F.when((raw != "nan") & raw.try_cast("double").isNull(), raw)
    return ex.select(*keep, key.alias("key"), num.alias("num"), text.alias("text"))
