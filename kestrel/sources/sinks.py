"""Writers (K1-K8). Each task writes its own part file; a single output file is only
made when asked for (``single_file``), since that funnels the data through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_delimited(df: DataFrame, path: str, *, header: bool = True, sep: str = ",", mode: str = "overwrite",
                    partition_by: Sequence[str] = (), single_file: bool = False) -> None:
    """CSV/TSV with or without header, optionally partitioned into per-name folders
    (K1, K2, K4, K6, K8)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).option("header", header).option("sep", sep)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Columnar write (K3, K4)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", as_array: bool = False) -> None:
    """JSON lines of rows (K7); with ``as_array`` each line is the JSON array of the
    row's values (the instance format of a prediction request), one line per row."""
    if as_array:
        df.select(F.to_json(F.array(*[F.col(c).cast("double") for c in df.columns])).alias("value")) \
            .write.mode(mode).text(path)
    else:
        df.write.mode(mode).json(path)


class SchemaMismatch(ValueError):
    pass


def append_rows(df: DataFrame, path: str, schema: T.StructType | str, fmt: str = "parquet") -> None:
    """Append to a table path, creating it on first use; rows must carry the declared
    schema (names and types, in order) (K5, M10)."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in st.fields]
    if got != want:
        raise SchemaMismatch(f"rows {got} do not match declared schema {want}")
    df.write.mode("append").format(fmt).save(path)
