"""File readers: delimited text with declared schemas, null tokens and stray header
or junk lines; file-name keyed scans; JSON lines (S1-S12).

Line positions mean nothing in a split file, so "skip the first k lines" becomes a
filter on the known header/junk line contents, which holds on any number of shards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, *, sep: str = ",",
                   header: bool = True, trim: bool = False, null_tokens: Mapping[str, str] | None = None,
                   junk_lines: Sequence[str] = (), glob: str | None = None,
                   drop_repeated_headers: bool = False) -> DataFrame:
    """Typed read of CSV/TSV.

    Columns are read as text, then NULL tokens (per column) and junk / repeated
    header lines are removed, then each column is cast with ``try_cast`` to the
    declared type, so one dirty value never fails a whole job.
    """
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in st.fields])
    r = (spark.read.schema(text_schema).option("sep", sep).option("header", header)
         .option("ignoreLeadingWhiteSpace", trim).option("mode", "PERMISSIVE"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    raw = r.csv(path)
    names = [f.name for f in st.fields]
    first = F.col(names[0])
    if junk_lines:
        raw = raw.filter(~F.coalesce(first.isin(*junk_lines), F.lit(False)))
    if drop_repeated_headers:  # one header line per shard of a concatenated export
        raw = raw.filter(~F.coalesce(first == F.lit(names[0]), F.lit(False)))
    tokens = dict(null_tokens or {})
    cols = []
    for f in st.fields:
        c: Column = F.col(f.name)
        if f.name in tokens:
            c = F.when(c == F.lit(tokens[f.name]), F.lit(None).cast("string")).otherwise(c)
        cols.append((c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)).alias(f.name))
    return raw.select(*cols)


class Checked(NamedTuple):
    """Rows of the declared types, and the lines that are none: (file, line, column, reason, problems)."""
    rows: DataFrame
    rejects: DataFrame


def read_checked(spark: SparkSession, path: str, schema: T.StructType | str, *, sep: str = ",", header: bool = True,
                 trim: bool = False, null_tokens: Mapping[str, str] | None = None, junk_lines: Sequence[str] = (),
                 glob: str | None = None) -> Checked:
    """Typed read of CSV/TSV that reports what it cannot read.

    Every line is either a row, whose columns all have their declared types, or a reject: a line with
    another number of fields than the schema (``column`` null), or with a value that is neither
    null, its column's null token nor of its type. ``column`` and ``reason`` name the first
    problem, ``problems`` lists all. Header lines (the column names joined by ``sep``, wherever a
    shard has them), ``junk_lines`` (whole lines) and empty lines are neither. Records do not span lines.
    """
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = [f.name for f in st.fields]
    text_schema = ", ".join([*(f"c{i} string" for i in range(len(names))), "_bad string"])
    r = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = r.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    skip = [*junk_lines, *([sep.join(names)] if header else [])]
    lines = lines.where(F.trim("line") != "")
    if skip:
        lines = lines.where(~F.col("line").isin(*skip))
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad",
               "ignoreLeadingWhiteSpace": str(trim).lower()}
    split = lines.select("file", "line", F.from_csv("line", text_schema, options).alias("r"))
    tokens = dict(null_tokens or {})
    typed, problems = [], [F.when(F.col("r._bad").isNotNull(), F.struct(
        F.lit(None).cast("string").alias("column"), F.lit(f"not {len(names)} fields").alias("reason")))]
    for i, f in enumerate(st.fields):
        raw: Column = F.col(f"r.c{i}")
        if f.name in tokens:
            raw = F.when(raw != F.lit(tokens[f.name]), raw)
        value = raw if isinstance(f.dataType, T.StringType) else raw.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        problems.append(F.when(F.col("r._bad").isNull() & raw.isNotNull() & value.isNull(), F.struct(
            F.lit(f.name).alias("column"), F.lit(f"not {f.dataType.simpleString()}").alias("reason"))))
    found = split.select("file", "line", "r", F.array_compact(F.array(*problems)).alias("problems"))
    rejects = found.where(F.size("problems") > 0).select(
        "file", "line", F.col("problems")[0]["column"].alias("column"), F.col("problems")[0]["reason"].alias("reason"),
        "problems")
    return Checked(found.where(F.size("problems") == 0).select(*typed), rejects)


def read_with_filename(spark: SparkSession, path: str, fmt: str = "csv", schema=None,
                       options: Mapping[str, str] | None = None, name: str = "file_path") -> DataFrame:
    """Read every file under a path/glob in one scan and keep each row's file path."""
    r = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    return df.select("*", F.col("_metadata.file_path").alias(name))


def read_json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines with a declared schema (S12, K7 round trip)."""
    return spark.read.schema(schema).json(path)
