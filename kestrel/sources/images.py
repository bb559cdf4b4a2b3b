"""Image files (S16): Spark's ``binaryFile`` source with a decoder in Arrow batches.

Every file is one row with its path and label; images keep their own sizes (ragged arrays).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The PNG signature, its channels by colour type, a Netpbm file's first comment, and
# Adam7's passes (first row, first column, row step, column step).
PNG = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
NOTE = re.compile(rb"P[1-7]\s*#([^\n]*)\n")
ADAM7 = [(0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1)]


def decode_netpbm(data: bytes) -> np.ndarray:
    """A grey or colour Netpbm image (P2, P3, P5, P6) of at most 8 bits as H x W x 3."""
    kind, at, numbers = data[:2], 2, []
    while len(numbers) < 3:
        while data[at:at + 1].isspace() or data[at:at + 1] == b"#":
            at = data.index(b"\n", at) if data[at:at + 1] == b"#" else at + 1
        end = at
        while data[end:end + 1].isdigit():
            end += 1
        if end == at:
            raise ValueError("bad header")
        numbers.append(int(data[at:end]))
        at = end
    width, height, top = numbers
    if not 0 < top < 256:
        raise ValueError("more than 8 bits")
    channels = 3 if kind in (b"P3", b"P6") else 1
    if kind in (b"P5", b"P6"):
        flat = np.frombuffer(data, np.uint8, width * height * channels, at + 1)
    else:
        flat = np.array(data[at:].split()[:width * height * channels], dtype=np.int64)
    x = flat.reshape(height, width, channels).astype(np.int64)
    x = x if top == 255 else (x * 255 + top // 2) // top
    return np.repeat(x, 3, axis=2) if channels == 1 else x


def _unfilter(raw: np.ndarray, height: int, line: int, step: int) -> np.ndarray:
    """Undo PNG's row filters; ``step`` bytes a pixel."""
    rows = raw[:height * (line + 1)].reshape(height, line + 1)
    out = np.zeros((height, line), np.uint8)
    before = np.zeros(line, np.uint8)
    for i in range(height):
        kind, x = int(rows[i, 0]), rows[i, 1:]
        if kind == 0:
            out[i] = x
        elif kind == 2:
            out[i] = x + before
        elif kind == 1:  # running sums of each byte of a pixel
            for c in range(step):
                out[i, c::step] = np.cumsum(x[c::step], dtype=np.uint64).astype(np.uint8)
        elif kind in (3, 4):
            row = bytearray(x.tobytes())
            up = before.tobytes()
            for j in range(line):
                a = row[j - step] if j >= step else 0
                if kind == 3:
                    guess = (a + up[j]) // 2
                else:
                    c = up[j - step] if j >= step else 0
                    p = a + up[j] - c
                    guess = min((abs(p - a), 0, a), (abs(p - up[j]), 1, up[j]), (abs(p - c), 2, c))[2]
                row[j] = (row[j] + guess) & 255
            out[i] = np.frombuffer(bytes(row), np.uint8)
        else:
            raise ValueError("unknown filter")
        before = out[i]
    return out


def decode_png(data: bytes) -> np.ndarray:
    """A PNG image as H x W x 3: 1 to 16 bits, grey, colour or palette, interlaced or not; alpha is dropped."""
    at, packed, palette, head = len(PNG), [], None, None
    while at < len(data):
        size, kind = int.from_bytes(data[at:at + 4]), data[at + 4:at + 8]
        body = data[at + 8:at + 8 + size]
        if zlib.crc32(kind + body) != int.from_bytes(data[at + 8 + size:at + 12 + size]):
            raise ValueError("bad checksum")
        if kind == b"IHDR":
            head = body
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    width, height, bits, colour, interlaced = (int.from_bytes(head[:4]), int.from_bytes(head[4:8]), head[8], head[9], head[12])
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    channels = CHANNELS[colour]
    out = np.zeros((height, width, channels), np.int64)
    for y, x, dy, dx in ADAM7 if interlaced else [(0, 0, 1, 1)]:
        h, w = len(range(y, height, dy)), len(range(x, width, dx))
        if not h or not w:
            continue
        line = (w * channels * bits + 7) // 8
        rows = _unfilter(raw, h, line, max(1, channels * bits // 8))
        raw = raw[h * (line + 1):]
        if bits == 16:
            rows = rows[:, ::2]
        elif bits < 8:
            spread = np.unpackbits(rows, axis=1).reshape(h, -1, bits)
            rows = (spread << np.arange(bits - 1, -1, -1)).sum(axis=2)[:, :w * channels]
        out[y::dy, x::dx] = rows.reshape(h, w, channels)
    if colour == 3:
        return palette[out[:, :, 0]].astype(np.int64)
    if bits < 8:
        out = out * 255 // ((1 << bits) - 1)
    return np.repeat(out[:, :, :1], 3, axis=2) if channels < 3 else out[:, :, :3]


def decode_image(data: bytes) -> np.ndarray:
    """H x W x 3 whole numbers 0..255 of a PNG or Netpbm file."""
    return decode_png(data) if data.startswith(PNG) else decode_netpbm(data)


def image_note(data: bytes) -> str | None:
    """The comment right behind a Netpbm file's kind; None without one, and for other files."""
    found = NOTE.match(data)
    return found[1].decode(errors="replace").strip() if found else None


def _nested(images: list):
    """Images (or None) as an Arrow array of rows of pixels of channels."""
    import pyarrow as pa

    shapes = [(0, 0) if x is None else x.shape[:2] for x in images]
    flat = np.concatenate([x.reshape(-1) for x in images if x is not None] or [np.zeros(0, np.int64)])
    widths = [w for h, w in shapes for _ in range(h)]

    def offsets(sizes) -> list:
        return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)

    pixels = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) // 3 + 1, dtype=np.int32) * 3),
                                      pa.array(flat.astype(np.int16)))
    rows = pa.ListArray.from_arrays(pa.array(offsets(widths)), pixels)
    return pa.ListArray.from_arrays(pa.array(offsets([h for h, _ in shapes])), rows,
                                    mask=pa.array([x is None for x in images]))


def _decoded(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            images, errors, notes = [], [], []
            for data in part.column(2).to_pylist():
                notes.append(image_note(data))
                try:
                    images.append(decode_image(data))
                    errors.append(None)
                except Exception as e:  # a broken file is a row with its error, not a failed job
                    images.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            sizes = [(None, None) if x is None else x.shape[:2] for x in images]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([s[0] for s in sizes], pa.int32()),
                 pa.array([s[1] for s in sizes], pa.int32()), _nested(images), pa.array(errors, pa.string()),
                 pa.array(notes, pa.string())],
                ["path", "label", "height", "width", "image", "error", "note"])


def read_images(spark: SparkSession, path: str, glob: str = "*", label_pattern: str = r"([^/]*)/[^/]*$") -> DataFrame:
    """Image files under a path (S16): (path, label, height, width, image, error, note).

    ``image`` is rows of pixels of three channels, each image of its own size. ``label`` is the first
    group of ``label_pattern`` in the path, by default the folder's name. Files that are no PNG or
    Netpbm image have a null image and an error text. ``note`` is a Netpbm file's first comment, which
    may name the image: many small files are listed far sooner in a few folders than in a folder each.
    Folders are searched in depth.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path))
    return files.select("path", F.regexp_extract("path", label_pattern, 1).alias("label"), "content").mapInArrow(
        _decoded, "path string, label string, height int, width int, image array<array<array<short>>>, error string, "
        "note string")


def plain_ppm(image, note=None) -> F.Column:
    """A nested H x W x 3 image column of 0..255 as the text of a plain Netpbm file; ``note``, a column of
    one line each, becomes its first comment (none where it is null)."""
    img = F.col(image) if isinstance(image, str) else image
    values = F.transform(F.flatten(F.flatten(img)), lambda v: v.cast("string"))
    kind = F.lit("P3")
    if note is not None:
        kind = F.concat(kind, F.coalesce(F.concat(F.lit(" # "), note.cast("string"), F.lit("\n")), F.lit("")))
    return F.concat_ws(" ", kind, F.size(img[0]).cast("string"), F.size(img).cast("string"), F.lit("255"),
                       F.array_join(values, " "))
