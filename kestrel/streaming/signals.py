"""Structured Streaming signal windows and live anomaly flags.

The same window functions run on a batch DataFrame (the "batch twin", checked
against SQL) and on a stream with a watermark (rows of windows the watermark has
closed). Event time must be a TIMESTAMP for ``withWatermark``; NTZ inputs are moved
to the instant whose UTC wall clock equals them (through epoch microseconds, not a
cast), and window bounds are moved back the same way, so window boundaries sit on
wall-clock hours whatever the session time zone is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(col) -> Column:
    """TIMESTAMP_NTZ wall clock -> the TIMESTAMP whose UTC wall clock it is (zone-free)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), c))


def instant_to_ntz(col) -> Column:
    """Inverse of ``ntz_to_instant``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def event_time(df: DataFrame, ts: str, name: str = "event_time") -> DataFrame:
    t = dict(df.dtypes)[ts]
    return df.withColumn(name, ntz_to_instant(ts) if t == "timestamp_ntz" else F.col(ts))


def _bounds(win: str) -> list:
    return [instant_to_ntz(f"{win}.start").alias("window_start"),
            instant_to_ntz(f"{win}.end").alias("window_end")]


def signal_windows(df: DataFrame, ts: str, values: Sequence[str], size: str, slide: str | None = None,
                   keys: Sequence[str] = (), watermark: str | None = None) -> DataFrame:
    """Tumbling (or sliding) windows per key: row count and mean |value| per channel
    (X1, X2). With ``watermark`` set the input may be a stream (append mode emits a
    window once the watermark passes its end; later rows for it are dropped, X5)."""
    e = event_time(df, ts)
    if watermark:
        e = e.withWatermark("event_time", watermark)
    win = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    agg = e.groupBy(win.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"),
                                                *[F.avg(F.abs(v)).alias(f"mean_abs_{v}") for v in values])
    return agg.select(*_bounds("w"), *keys, "n", *[f"mean_abs_{v}" for v in values])


def session_counts(df: DataFrame, ts: str, key: str, gap: str, watermark: str | None = None) -> DataFrame:
    """Sessions per key: a new session starts when the gap since the previous event
    reaches ``gap``; rows per session, start and end (= last event + gap) (X3)."""
    e = event_time(df, ts)
    if watermark:
        e = e.withWatermark("event_time", watermark)
    agg = e.groupBy(key, F.session_window("event_time", gap).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(key, instant_to_ntz("s.start").alias("session_start"),
                      instant_to_ntz("s.end").alias("session_end"), "n")


def flag_stream(stream: DataFrame, thresholds: DataFrame, key: str, score: str) -> DataFrame:
    """Stream-static join of each event to its key's threshold; anomaly = score >
    threshold (X4). The static side is one row per key."""
    j = stream.join(thresholds, key, "left")
    return j.withColumn("anomaly", F.coalesce(F.col(score) > F.col("threshold"), F.lit(False)))


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """File stream over a directory (optionally only files matching ``glob``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_to_files(df: DataFrame, label: str, output_mode: str = "append") -> DataFrame:
    """Run a streaming query over everything available (``availableNow``) into a
    Parquet sink with its checkpoint, both in the shared scratch folder; return the
    sink as a batch frame. A restarted query resumes from the checkpoint."""
    spark = df.sparkSession
    out = scratch_path(spark, f"{label}-out")
    ckpt = scratch_path(spark, f"{label}-ckpt")
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(df.schema).parquet(out)
