"""HTML table grids, image files, and lines that a typed read rejects."""

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.plans import io
from kestrel.session import scratch_path
from kestrel.sources.files import read_checked
from kestrel.sources.images import ADAM7, decode_image, image_note, plain_ppm, read_images
from kestrel.sources.tables import html_tables, page_tables


def shape(html, number=0):
    """{(row, position): text} and the names of one table."""
    rows = [r for r in page_tables(html) if r[0] == number]
    return {(r[1], r[2]): r[4] for r in rows}, {r[2]: r[3] for r in rows}


def test_spans_fill_their_places():
    html = """<table><tr><th>a<th colspan="2">b</tr>
      <tr><td rowspan=2>1</td><td>2</td><td>3</td></tr><tr><td>4</td><td rowspan="2">5</td></tr>
      <tr><td colspan=2>6</td></tr></table>"""
    cells, names = shape(html)
    assert names == {0: "a", 1: "b", 2: "b"}
    assert cells == {(0, 0): "1", (0, 1): "2", (0, 2): "3", (1, 0): "1", (1, 1): "4", (1, 2): "5",
                     (2, 0): "6", (2, 1): "6", (2, 2): "5"}


def test_entities_attributes_and_omitted_end_tags():
    html = """<TABLE title="a > b"><TR><TH data-x='<td>'>x &amp; y<TH>z
      <TR><TD>1 &lt; 2<br>&eacute;&#233;<TD><!-- <td>no</td> --><script>var t = '<td>';</script>k</TABLE>"""
    cells, names = shape(html)
    assert names == {0: "x & y", 1: "z"} and cells == {(0, 0): "1 < 2 éé", (0, 1): "k"}


def test_nested_tables_are_tables_of_their_own():
    html = """<table><tr><th>n</th><th>v</th></tr><tr><td>out</td><td>x <table><tr><td>in1</td><td>in2</td></tr>
      <tr><td>in3</td></tr></table> y</td></tr><tr><td>last</td><td>w</td></tr></table>"""
    cells, _ = shape(html)
    assert cells == {(0, 0): "out", (0, 1): "x in1in2 in3 y", (1, 0): "last", (1, 1): "w"}
    inner, names = shape(html, 1)
    assert inner == {(0, 0): "in1", (0, 1): "in2", (1, 0): "in3", (1, 1): None} and names == {0: "0", 1: "1"}


def test_headers():
    _, names = shape("<table><thead><tr><td>p</td><td>p</td></tr><tr><td>q</td><td>r</td></tr></thead>"
                     "<tbody><tr><th>1</th><td>2</td></tr></tbody></table>")
    assert names == {0: "p q", 1: "p r"}
    cells, names = shape("<table><tr><th>side</th><td>1</td></tr></table>")  # no row of names only
    assert names == {0: "0", 1: "1"} and cells[0, 0] == "side"
    assert list(page_tables(None)) == list(page_tables("<p>no table")) == list(page_tables("<table></table>")) == []


def test_rowspan_zero_and_bad_spans():
    cells, _ = shape("<table><tr><td rowspan=0>all</td><td colspan=x>1</td></tr><tr><td>2</td></tr><tr><td>3</td></tr></table>")
    assert cells == {(0, 0): "all", (0, 1): "1", (1, 0): "all", (1, 1): "2", (2, 0): "all", (2, 1): "3"}


def test_tables_of_a_frame(spark):
    df = spark.createDataFrame([(1, "<table><tr><th>a</th></tr><tr><td>1</td></tr></table><table><tr><td>z</td></tr></table>"),
                                (2, None), (3, "<p>")], "id long, html string")
    every = sorted(map(tuple, html_tables(df, "html", ["id"]).collect()))
    assert every == [(1, 0, 0, 0, "a", "1"), (1, 1, 0, 0, "0", "z")]
    assert [tuple(r) for r in html_tables(df, "html", ["id"], only=1).collect()] == [every[1]]


# -- images

def png(x, colour, bits=8, palette=None, filters=(0,), interlaced=False):
    """A PNG file of H x W x channels samples; the rows take the given filters in turn."""
    h, w, ch = x.shape
    step = max(1, ch * bits // 8)

    def lines(part):
        out, before = [], None
        for i, row in enumerate(part):
            flat = row.reshape(-1)
            if bits == 16:
                raw = flat.astype(">u2").tobytes()
            elif bits == 8:
                raw = flat.astype(np.uint8).tobytes()
            else:
                unpacked = (flat[:, None] >> np.arange(bits - 1, -1, -1)) & 1
                raw = np.packbits(unpacked.reshape(-1).astype(np.uint8)).tobytes()
            kind = filters[i % len(filters)]
            before = before or bytes(len(raw))
            coded = bytearray()
            for j, v in enumerate(raw):
                a = raw[j - step] if j >= step else 0
                b = before[j]
                c = before[j - step] if j >= step else 0
                p = a + b - c
                paeth = min([(abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)])[2]
                coded.append((v - (0, a, b, (a + b) // 2, paeth)[kind]) & 255)
            out.append(bytes([kind]) + bytes(coded))
            before = raw
        return b"".join(out)

    parts = [x[y::dy, c::dx] for y, c, dy, dx in ADAM7] if interlaced else [x]
    data = b"".join(lines(p) for p in parts if p.size)

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    packed = zlib.compress(data)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, bits, colour, 0, 0, int(interlaced)))
            + (chunk(b"PLTE", palette.astype(np.uint8).tobytes()) if palette is not None else b"")
            + chunk(b"IDAT", packed[:7]) + chunk(b"IDAT", packed[7:]) + chunk(b"IEND", b""))


@pytest.mark.parametrize("interlaced", [False, True])
def test_png_round_trips(interlaced):
    rng = np.random.default_rng(0)
    kw = {"filters": (0, 1, 2, 3, 4), "interlaced": interlaced}
    for h, w in ((1, 1), (7, 5), (13, 9)):
        rgb = rng.integers(0, 256, (h, w, 3))
        assert (decode_image(png(rgb, 2, **kw)) == rgb).all()
        assert (decode_image(png(np.concatenate([rgb, rgb[:, :, :1]], axis=2), 6, **kw)) == rgb).all()
        grey = rgb[:, :, :1]
        assert (decode_image(png(grey, 0, **kw)) == grey.repeat(3, axis=2)).all()
        assert (decode_image(png(rgb * 256 + 7, 2, bits=16, **kw)) == rgb).all()
        palette, index = rng.integers(0, 256, (4, 3)), rng.integers(0, 4, (h, w, 1))
        assert (decode_image(png(index, 3, bits=2, palette=palette, **kw)) == palette[index[:, :, 0]]).all()
        bit = rng.integers(0, 2, (h, w, 1))
        assert (decode_image(png(bit, 0, bits=1, **kw)) == bit.repeat(3, axis=2) * 255).all()


def test_netpbm():
    x = np.arange(2 * 3 * 3).reshape(2, 3, 3)
    assert (decode_image(b"P6\n# made here\n3 2\n255\n" + x.astype(np.uint8).tobytes()) == x).all()
    assert (decode_image(("P3 3 2 255 " + " ".join(map(str, x.ravel()))).encode()) == x).all()
    assert (decode_image(b"P5 3 2 255 " + bytes(range(6))) == np.arange(6).reshape(2, 3, 1).repeat(3, axis=2)).all()
    assert decode_image(b"P2 1 1 3 1")[0, 0, 0] == 85
    for bad in (b"P6 3 2 255 ab", b"GIF89a", b"", b"\x89PNG\r\n\x1a\nxx"):
        with pytest.raises(Exception):
            decode_image(bad)


def test_read_images_keeps_path_label_and_sizes(spark):
    base = scratch_path(spark, "img")
    rng = np.random.default_rng(2)
    known = {}
    for i, (label, h, w) in enumerate([("sick", 4, 6), ("well", 3, 2), ("well", 5, 5)]):
        os.makedirs(f"{base}/{label}", exist_ok=True)
        x = rng.integers(0, 256, (h, w, 3))
        with open(f"{base}/{label}/{i}.png", "wb") as f:
            f.write(png(x, 2, filters=(4,)))
        known[f"{label}/{i}.png"] = (label, x)
    with open(f"{base}/well/broken.png", "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n broken")
    got = {r["path"].split("/", 1)[1].split("img-")[1].split("/", 1)[1]: r for r in read_images(spark, base, "*.png").collect()}
    assert set(got) == {*known, "well/broken.png"}
    for name, (label, x) in known.items():
        r = got[name]
        assert (r["label"], r["height"], r["width"], r["error"]) == (label, *x.shape[:2], None)
        assert (np.array(r["image"]) == x).all()
    broken = got["well/broken.png"]
    assert broken["image"] is None and broken["height"] is None and broken["error"]


def test_plain_ppm_is_read_back(spark):
    img = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda r: F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda c: F.array(r * 10 + c, r, c)))
    text = spark.range(1).select(plain_ppm(img)).first()[0]
    x = decode_image(text.encode())
    assert x.shape == (3, 4, 3) and x[2, 3].tolist() == [23, 2, 3]


def test_notes_name_images(spark):
    """A note is a file's first comment and changes no pixel; files without one have none."""
    img = F.array(F.array(F.array(F.lit(1), F.lit(2), F.lit(3))))
    noted, plain = spark.range(7, 8).select(plain_ppm(img, F.col("id")), plain_ppm(img, F.lit(None))).first()
    assert (decode_image(noted.encode()) == decode_image(plain.encode())).all()
    assert [image_note(x) for x in (noted.encode(), plain.encode(), b"P5 #a b \n1 1 255 x", b"\x89PNG", b"")] == \
        ["7", None, "a b", None, None]


def test_image_files_share_folders(spark, monkeypatch, tmp_path):
    """A folder per label, not per file: listing a folder costs as much as a file. A row that comes twice is one
    image."""
    rows = [(i, [float(i + k) / 999 for k in range(64)], i % 3) for i in range(40)]
    spark.createDataFrame([*rows, rows[7]], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    made = []
    monkeypatch.setattr(io, "scratch_path", lambda *a: made.append(scratch_path(*a)) or made[-1])
    got = io.image_files_q(spark, str(tmp_path)).collect()
    want = [(v, str(y), 4 + y % 5, 8, [(int(abs(np.float32(e[k // 3])) * 1000) + 7 * (k % 3)) % 256
                                       for k in range((4 + y % 5) * 24)]) for v, e, y in rows]
    assert sorted(tuple(r) for r in got) == sorted(want)
    folders = [d for d, _, _ in os.walk(made[0].replace("file:", ""))]
    assert len(folders) <= 1 + 3


# -- rejects

LINES = ["id,name,price,day", "1,ann,2.5,2024-01-01", "2,bob,na,2024-02-30", "3,cy,x1,2024-01-03", "junk line", "4,dee,1.0",
         "5,eve,1,2024-01-05,more", '6,"f, g",7,2024-01-06', "", "id,name,price,day", "7,,,", "x,y,z,w", "8,hal,99999,2024-01-08"]


def test_every_line_is_a_row_or_a_reject(spark):
    path = scratch_path(spark, "checked")
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(path)
    got = read_checked(spark, path, "id int, name string, price double, day date", null_tokens={"price": "na"},
                       junk_lines=["junk line"])
    rows = {r["id"]: (r["name"], r["price"], r["day"] and r["day"].isoformat()) for r in got.rows.collect()}
    assert rows == {1: ("ann", 2.5, "2024-01-01"), 6: ("f, g", 7.0, "2024-01-06"), 7: (None, None, None),
                    8: ("hal", 99999.0, "2024-01-08")}
    bad = {r["line"]: r for r in got.rejects.collect()}
    assert {k: (v["column"], v["reason"]) for k, v in bad.items()} == {
        "2,bob,na,2024-02-30": ("day", "not date"), "3,cy,x1,2024-01-03": ("price", "not double"),
        "4,dee,1.0": (None, "not 4 fields"), "5,eve,1,2024-01-05,more": (None, "not 4 fields"),
        "x,y,z,w": ("id", "not int")}
    assert [p["column"] for p in bad["x,y,z,w"]["problems"]] == ["id", "price", "day"]
    assert all(r["file"].startswith("file:") and path.split("/")[-1] in r["file"] for r in bad.values())
    lines = [x for x in LINES if x and x not in (LINES[0], "junk line")]
    assert got.rows.count() + got.rejects.count() == len(lines)


def test_tabs_blanks_and_empty_files(spark):
    path = scratch_path(spark, "checked")
    spark.createDataFrame([("1\t 2.0",), ("2\tq",), ("99999999999\t1",)], "value string").write.text(path)
    got = read_checked(spark, path, "a int, b double", sep="\t", header=False, trim=True)
    assert [tuple(r) for r in got.rows.collect()] == [(1, 2.0)]
    assert {(r["column"], r["reason"]) for r in got.rejects.collect()} == {("b", "not double"), ("a", "not int")}
    empty = scratch_path(spark, "checked")
    spark.createDataFrame([], "value string").write.text(empty)
    got = read_checked(spark, empty, "a int")
    assert got.rows.count() == got.rejects.count() == 0
