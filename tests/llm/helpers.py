"""Fixtures as literal rows; edge rows every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def documents(spark, rows, extra=()):
    """rows: (doc_id, text[, lang[, source]]); ``extra``: names of clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in extra:
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit("x"))
    return df


EDGE = [(None, "no id here"), (1, None), (2, ""), (3, "the same row"), (3, "the same row"), (4, "a b c " * 9000),
        (5, "é中\U0001f600 <|endoftext|> x"), (6, " \n\t "), (None, None)]
