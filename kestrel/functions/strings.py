"""String functions (F1-F8, F28): all built-in expressions, no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tag_normalize(col, prefix: str = "tag_") -> Column:
    """lower(x), '-' -> ' ', then prefix (F1)."""
    return F.concat(F.lit(prefix), F.replace(F.lower(_c(col)), F.lit("-"), F.lit(" ")))


def strip_chars(col, chars: str) -> Column:
    """Strip any of ``chars`` from both ends (Python ``str.strip(chars)``; F2, F3)."""
    return F.btrim(_c(col), F.lit(chars))


def suffix_collapse(col, suffix: str, replacement: str | None = None) -> Column:
    """If the text ends with ``suffix`` (compared on the last len(suffix) chars),
    replace the whole value by ``replacement`` (default: the suffix) (F4)."""
    c = _c(col)
    return F.when(F.right(c, F.lit(len(suffix))) == F.lit(suffix),
                  F.lit(replacement if replacement is not None else suffix)).otherwise(c)


def zip_prefix(col, n: int = 3) -> Column:
    """First n characters as an int; NULL when they do not parse."""
    return F.left(_c(col), F.lit(n)).try_cast("int")


def zero_pad(col, width: int) -> Column:
    """Left zero-pad to a width."""
    return F.lpad(_c(col).cast("string"), width, "0")


def last_path_part(col, sep: str = "/") -> Column:
    """Last element after splitting on ``sep`` (F8)."""
    return F.substring_index(_c(col), sep, -1)


def json_field(col, path: str) -> Column:
    """JSON path read."""
    return F.get_json_object(_c(col), path)
