"""Array functions (F24, F26, F29, F30, F33, W11) as higher-order built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def argmax_index(arr) -> Column:
    """1-based index of the largest element, first wins a tie."""
    a = _c(arr)
    return F.array_position(a, F.array_max(a)).cast("int")


def argmax_label(cols: list[str], names: list[str] | None = None) -> Column:
    """Name of the column holding the row maximum, first wins."""
    names = names or cols
    best = F.greatest(*[F.col(c) for c in cols])
    out = None
    for c, n in zip(cols, names):
        out = F.when(F.col(c) == best, F.lit(n)) if out is None else out.when(F.col(c) == best, F.lit(n))
    return out


def center_fit(arr, n: int, pad: float = 0.0) -> Column:
    """Centre-crop or centre-pad a 1-D array to length n.

    Crop keeps ``slice(a, (len-n)//2 + 1, n)``; pad puts ``(n-len)//2`` pad values
    before and the rest after.
    """
    a = _c(arr)
    ln = F.size(a)
    crop = F.slice(a, F.floor((ln - n) / 2).cast("int") + 1, F.lit(n))
    before = F.floor((F.lit(n) - ln) / 2).cast("int")
    after = (F.lit(n) - ln - before).cast("int")
    padv = F.lit(pad).cast("float")
    padded = F.concat(F.array_repeat(padv, before), a, F.array_repeat(padv, after))
    return F.when(ln >= n, crop).otherwise(padded)


def center_fit_image(img, height: int, width: int) -> Column:
    """Centre-crop or centre-pad an H x W x C image (nested arrays of double) to height x width
    x C (F29, D6): rows first, then the pixels of every row; padding pixels are zeros of the
    image's own channel count."""
    a = _c(img)
    pixel = F.transform(a[0][0], lambda x: F.lit(0.0))

    def fit(x, n: int, blank):
        ln = F.size(x)
        before = F.floor((F.lit(n) - ln) / 2).cast("int")
        padded = F.concat(F.array_repeat(blank, F.greatest(before, F.lit(0))), x,
                          F.array_repeat(blank, F.greatest((F.lit(n) - ln - before).cast("int"), F.lit(0))))
        cut = F.slice(x, F.greatest(F.floor((ln - n) / 2).cast("int"), F.lit(0)) + 1, F.lit(n))
        return F.when(ln >= n, cut).otherwise(padded)

    rows = F.transform(a, lambda r: fit(r, width, pixel))
    return fit(rows, height, F.array_repeat(pixel, width))


def array_scale(arr, divisor: float = 255.0) -> Column:
    """Element-wise divide (uint8 -> [0, 1]; F30)."""
    return F.transform(_c(arr), lambda x: x.cast("double") / F.lit(divisor))


def mean_abs_diff(a, b) -> Column:
    """Mean over positions of |a_i - b_i| (row residual score, W11)."""
    diffs = F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x) / F.size(diffs)
