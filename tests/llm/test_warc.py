import base64
import gzip
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from kestrel.llm.warc import START, cuts, parse_record, read_archives, read_segments, record_rows, round_trip, write_archives

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("record_type", T.StringType())])


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        own = first.get(h or "")
        again = own is not None and i != own
        out.append((i, len((h or "").encode()), digest(h), "revisit" if again else "response", own if again else None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


ROWS = [(3, "http://a b/\r\nX: y", "<p>é\r\n\r\nWARC/1.0\r\n</p>"), (4, None, "<p>é\r\n\r\nWARC/1.0\r\n</p>"),
        (5, "u", f"a{START}response\r\n\r\nb{START}{START}"), (6, "u", None), (7, "u", ""), (None, "u", ""),
        (None, "u", "only here"), (8, "u", "中文" * 5000), (9, "u", "中文" * 5000), (10, "u", "dup"), (10, "u", "dup"),
        (11, "u", "WARC/1.0\r\nWARC-" * 40), (12, "u", "\r\n\r\n" * 9)]


@pytest.mark.parametrize("limit", [1 << 18, 777])
def test_round_trip(spark, limit):
    got = round_trip(frame(spark, ROWS).repartition(3), segment_chars=limit).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                  key=str) == brute(ROWS)


def test_oversized_payload_is_many_rows(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    write_archives(frame(spark, ROWS[7:8]), path, segment_chars=1000, compression="none")
    rows = read_segments(spark, path).collect()
    assert len(rows) == 10 and {r.record_id for r in rows} == {rows[0].record_id}
    assert b"".join(r.body for r in sorted(rows, key=lambda r: r.segment)).decode() == ROWS[7][2]
    assert max(len(r.body) for r in rows) <= 4000


def test_damage_is_found(spark, tmp_path):
    path = tmp_path / "w"
    write_archives(frame(spark, ROWS[7:8]), f"file://{path}", segment_chars=1000)
    part = next(p for p in path.iterdir() if p.name.startswith("part-") and p.stat().st_size)
    data = gzip.decompress(part.read_bytes())
    part.write_bytes(gzip.compress(data.replace("中文中文".encode(), "中文中中".encode(), 1)))
    for crc in path.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="digest differs"):
        read_archives(spark, f"file://{path}").collect()


def test_empty(spark):
    assert round_trip(frame(spark, ROWS).limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([START, "WARC/1.0", "\r\n", "x", "é", "WARC-Type: "]), max_size=30), st.integers(1, 40))
def test_segments_hold_no_record_start(parts, limit):
    text = "".join(parts)
    ends = cuts(text, limit)
    pieces = [text[a:b] for a, b in zip([0, *ends], ends)]
    assert "".join(pieces) == text and all(START not in p and len(p) <= limit for p in pieces)
    sha = hashlib.sha1(text.encode()).hexdigest()
    records = list(record_rows(1, "u", None, None, len(text.encode()), sha, text, "n", limit))
    assert "".join(r for r in records).count(START) == len(records)
    for r in records:
        parse_record((r + "\r\n\r\n").encode()[len(START):])
