"""Live flags: the running maximum survives a restart, is forgotten after a pause, and equals SQL."""

import os
import tempfile

import duckdb
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kestrel.streaming.live import running_max_flags
from kestrel.streaming.signals import read_stream

SCHEMA = "row_id long, ts timestamp_ntz, channel string, score double"

TWIN = """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 1 HOUR THEN 1 ELSE 0 END AS pause FROM rows
           WINDOW w AS (PARTITION BY channel ORDER BY ts, row_id)),
s AS (SELECT *, sum(pause) OVER (PARTITION BY channel ORDER BY ts, row_id ROWS UNBOUNDED PRECEDING) AS part FROM g),
m AS (SELECT *, max(score) OVER (PARTITION BY channel, part ORDER BY ts, row_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT channel, row_id, score, 1.05 * before AS threshold, coalesce(score > 1.05 * before, false) AS anomaly FROM m
ORDER BY row_id"""


def write(folder, rows, name):
    pdf = pd.DataFrame(rows, columns=["row_id", "ts", "channel", "score"])
    pdf["ts"] = pd.to_datetime(pdf["ts"])
    t = pa.Table.from_pandas(pdf, schema=pa.schema([("row_id", pa.int64()), ("ts", pa.timestamp("us")), ("channel", pa.string()),
                                                    ("score", pa.float64())]), preserve_index=False)
    pq.write_table(t, os.path.join(folder, f"{name}.parquet"))


@pytest.fixture()
def folders():
    base = tempfile.mkdtemp(prefix="kestrel-live-")
    out = [os.path.join(base, d) for d in ("src", "out", "ckpt")]
    os.makedirs(out[0])
    return out


def run(spark, folders):
    src, out, ckpt = folders
    flags = running_max_flags(read_stream(spark, src, SCHEMA, glob="*.parquet"), "ts", "channel", "score", "row_id",
                              forget="1 hour")
    q = (flags.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return [tuple(r) for r in spark.read.parquet(out).orderBy("row_id").collect()]


def expected(rows):
    con = duckdb.connect()
    pdf = pd.DataFrame(rows, columns=["row_id", "ts", "channel", "score"])
    pdf["ts"] = pd.to_datetime(pdf["ts"])
    con.register("rows", pdf)
    return con.execute(TWIN).fetchall()


def test_two_batches_and_a_restart_equal_sql(spark, folders):
    first = [(1, "2024-01-01 00:00", "a", 1.0), (2, "2024-01-01 00:10", "a", 1.04), (3, "2024-01-01 00:20", "a", 1.2),
             (4, "2024-01-01 00:05", "b", -3.0), (5, "2024-01-01 00:30", "b", -2.0), (6, "2024-01-01 00:40", None, 7.0)]
    # another process resumes from the checkpoint: a's maximum 1.2 is known, b pauses for more than an hour
    second = [(7, "2024-01-01 00:50", "a", 1.25), (8, "2024-01-01 01:00", "a", 1.4), (9, "2024-01-01 02:20", "b", 50.0),
              (10, "2024-01-01 02:30", "b", 60.0), (11, "2024-01-01 01:00", None, 7.2)]
    write(folders[0], first, "b1")
    assert run(spark, folders) == expected(first)
    write(folders[0], second, "b2")
    got = run(spark, folders)
    assert got == expected(first + second)
    flagged = {r[1] for r in got if r[4]}
    assert flagged == {3, 5, 8, 10}
    # a third run, far later: every channel's state has timed out
    third = [(12, "2024-01-03 00:00", "a", 0.1), (13, "2024-01-03 00:01", "b", 0.1)]
    write(folders[0], third, "b3")
    got = run(spark, folders)
    assert got == expected(first + second + third) and [r[3] for r in got[-2:]] == [None, None]


def test_missing_scores_and_late_rows(spark, folders):
    write(folders[0], [(1, "2024-01-01 05:00", "a", 2.0), (2, "2024-01-01 05:01", "a", None), (3, "2024-01-01 05:02", "a", 2.2)],
          "b1")
    got = run(spark, folders)
    assert [(r[1], r[3], r[4]) for r in got] == [(1, None, False), (2, 2.1, False), (3, 2.1, True)]
    write(folders[0], [(4, "2024-01-01 05:03", "a", 1.0)], "b2")
    run(spark, folders)
    write(folders[0], [(5, "2024-01-01 01:00", "a", 99.0), (6, "2024-01-01 05:10", "a", 2.3)], "b3")
    got = {r[1]: r for r in run(spark, folders)}
    assert 5 not in got  # behind the watermark
    assert got[6][3] == pytest.approx(1.05 * 2.2)
