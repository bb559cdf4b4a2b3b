"""Source and sink queries.

Round trips write into the shared scratch folder (``spark.checkpoint.dir``, or a
local one only when the session names none) and read the files back, so the
returned frame is what a later job would see.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import stable_bucket
from ..functions.strings import json_field
from ..operators.project import drop_header_rows
from ..session import scratch_path, table
from ..sources.files import read_checked, read_delimited, read_json_lines, read_with_filename
from ..sources.images import plain_ppm, read_images
from ..sources.sinks import append_rows, write_delimited, write_json, write_parquet
from ..sources.spine import calendar_spine, date_bounds
from ..sources.tables import html_tables
from ..sources.text import GAME_LINK_PATTERN, game_ids, html_links, html_table_rows, kv_map, record_lines
from .registry import query
from .relational import md5_bucket_sql

CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("src_csv_roundtrip", "SELECT * FROM customer")
def src_csv_roundtrip_q(spark, sf):
    """CSV with header written and read back with a declared schema."""
    path = scratch_path(spark, "customer-csv")
    write_delimited(table(spark, sf, "customer"), path)
    return read_delimited(spark, path, CUSTOMER_SCHEMA)


@query("src_csv_skip_lines", "SELECT c_custkey, c_name FROM customer")
def src_csv_skip_lines_q(spark, sf):
    """Headerless read with given names, dropping the header line and a known
    junk line wherever they sit in the shards."""
    path = scratch_path(spark, "customer-junk")
    c = table(spark, sf, "customer")
    text = c.select(F.col("c_custkey").cast("string").alias("a"), F.col("c_name").alias("b"))
    junk = c.limit(1).select(F.lit("|1x3 Cross validator").alias("a"), F.lit(None).cast("string").alias("b"))
    head = c.limit(1).select(F.lit("c_custkey").alias("a"), F.lit("c_name").alias("b"))
    write_delimited(head.unionByName(junk).unionByName(text), path, header=False)
    return read_delimited(spark, path, "c_custkey bigint, c_name string", header=False, drop_repeated_headers=True,
                          junk_lines=["|1x3 Cross validator"])


@query("src_tsv_typed", """
SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier""")
def src_tsv_typed_q(spark, sf):
    """TSV, declared types, a per-column NULL token ('na')."""
    path = scratch_path(spark, "supplier-tsv")
    sup = table(spark, sf, "supplier")
    raw = sup.select("s_suppkey", "s_name", "s_nationkey",
                     F.when(F.col("s_acctbal") < 0, F.lit("na")).otherwise(F.col("s_acctbal").cast("string")).alias("s_acctbal"))
    write_delimited(raw, path, sep="\t")
    return read_delimited(spark, path, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
                          sep="\t", null_tokens={"s_acctbal": "na"})


@query("src_csv_rejects", """
SELECT o_orderkey, CASE WHEN o_orderkey % 50 IN (1, 2) THEN NULL WHEN o_orderkey % 50 = 3 THEN 'o_totalprice'
         WHEN o_orderkey % 50 = 4 THEN 'o_orderdate' END AS "column",
       CASE WHEN o_orderkey % 50 IN (1, 2) THEN 'not 4 fields' WHEN o_orderkey % 50 = 3 THEN 'not double'
            WHEN o_orderkey % 50 = 4 THEN 'not date' END AS reason,
       CASE WHEN o_orderkey % 50 NOT IN (1, 2, 3, 4, 5) THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 50 NOT IN (1, 2, 3, 4) THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderkey % 50 NOT IN (1, 2, 3, 4) THEN CAST(o_orderdate AS DATE) END AS o_orderdate FROM orders""")
def src_csv_rejects_q(spark, sf):
    """Orders written as lines of which some are too long, too short or hold a value of another
    type; every line comes back as a typed row or as a reject with its column and reason."""
    path = scratch_path(spark, "orders-dirty")
    o = table(spark, sf, "orders")
    kind = F.col("o_orderkey") % 50
    price = F.when(kind == 3, F.lit("1O.5")).when(kind == 5, F.lit("na")).otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(kind == 4, F.lit("1998-02-31")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    fields = F.array(F.col("o_orderkey").cast("string"), price, F.col("o_orderpriority"), day)
    fields = F.when(kind == 1, F.concat(fields, F.array(F.lit("more")))).when(kind == 2, F.slice(fields, 1, 2)).otherwise(fields)
    o.select(F.array_join(fields, "|").alias("value")).write.text(path)
    got = read_checked(spark, path, "o_orderkey bigint, o_totalprice double, o_orderpriority string, o_orderdate date",
                       sep="|", null_tokens={"o_totalprice": "na"})
    none = F.lit(None)
    good = got.rows.select("o_orderkey", none.cast("string").alias("column"), none.cast("string").alias("reason"),
                           "o_totalprice", "o_orderpriority", "o_orderdate")
    bad = got.rejects.select(F.substring_index("line", "|", 1).cast("bigint").alias("o_orderkey"), "column", "reason",
                             none.cast("double").alias("o_totalprice"), none.cast("string").alias("o_orderpriority"),
                             none.cast("date").alias("o_orderdate"))
    return good.unionByName(bad)


@query("src_csv_trim", "SELECT * FROM customer")
def src_csv_trim_q(spark, sf):
    """Leading blanks trimmed at read time."""
    path = scratch_path(spark, "customer-blanks")
    c = table(spark, sf, "customer")
    raw = c.select(*[F.concat(F.lit(" " * (1 + i % 2)), F.col(n).cast("string")).alias(n) for i, n in enumerate(c.columns)])
    write_delimited(raw, path)
    return read_delimited(spark, path, CUSTOMER_SCHEMA, trim=True)


@query("drop_header_rows", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def drop_header_rows_q(spark, sf):
    """P10: shards concatenated with their header lines, read as text; rows equal to
    their own column names are dropped."""
    path = scratch_path(spark, "customer-shards")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    write_delimited(c.repartition(3), path, header=True)
    raw = spark.read.schema("c_custkey string, c_name string, c_nationkey string, c_mktsegment string").option(
        "header", False).csv(path)
    return drop_header_rows(raw)


@query("scan_all", "SELECT * FROM orders")
def scan_all_q(spark, sf):
    """Whole-table scan (columnar file)."""
    return table(spark, sf, "orders")


@query("scan_glob", "SELECT * FROM customer")
def scan_glob_q(spark, sf):
    """A sharded table read back through a file-name glob."""
    path = scratch_path(spark, "customer-sharded")
    write_delimited(table(spark, sf, "customer").repartition(4), path)
    return read_delimited(spark, path, CUSTOMER_SCHEMA, glob="part-*.csv")


@query("scan_with_filename", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(avg(abs(value)), 9) AS mean_abs FROM events GROUP BY 1""")
def scan_with_filename_q(spark, sf):
    """One file folder per day, read in one scan keeping the file path;
    the key is parsed from the path and each file reduced to summary numbers."""
    path = scratch_path(spark, "events-by-day")
    ev = table(spark, sf, "events").select(F.date_format("ts", "yyyy.MM.dd").alias("day_key"), "event_id", "value")
    write_delimited(ev, path, sep="\t", partition_by=["day_key"])
    files = read_with_filename(spark, path, "csv", "event_id long, value double", {"sep": "\t", "header": "true"})
    key = F.regexp_extract("file_path", r"day_key=(\d{4}\.\d{2}\.\d{2})", 1)
    day = F.to_date(key, "yyyy.MM.dd")
    return files.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"),
                                                F.round(F.avg(F.abs("value")), 9).alias("mean_abs"))


@query("json_props_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_props_extract_q(spark, sf):
    """JSON path read of a properties document."""
    ev = table(spark, sf, "events")
    parsed = F.from_json("props", "k int")
    return ev.select("event_id", parsed["k"].alias("k"))


@query("kv_map_parse", """
SELECT event_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events""")
def kv_map_parse_q(spark, sf):
    """key<TAB>value config lines parsed into a map, then read by key."""
    ev = table(spark, sf, "events")
    text = F.concat(F.lit("kind\t"), F.col("event_type"), F.lit("\nk\t"), json_field("props", "$.k"), F.lit("\n"))
    m = kv_map(text)
    return ev.select("event_id", m["kind"].alias("kind"), m["k"].alias("k"))


@query("record_line_parse", """
SELECT doc_id, key, num, text FROM (
  SELECT doc_id, 'lang' AS key, NULL::DOUBLE AS num, lang AS text FROM documents
  UNION ALL SELECT doc_id, 'n_chars', CAST(n_chars AS DOUBLE), NULL FROM documents
  UNION ALL SELECT doc_id, 'score', NULL::DOUBLE, NULL FROM documents
  UNION ALL SELECT doc_id, 'source', NULL::DOUBLE, source FROM documents)""")
def record_line_parse_q(spark, sf):
    """S14/D3: 'key: value' lines -> typed values ('nan' -> NULL, number -> num, else text)."""
    d = table(spark, sf, "documents")
    text = F.concat(F.lit("lang: "), F.col("lang"), F.lit("\nn_chars: "), F.col("n_chars").cast("string"),
                    F.lit("\nscore: nan\nsource: "), F.col("source"), F.lit("\n"))
    return record_lines(d.select("doc_id", text.alias("rec")), "rec", keep=["doc_id"])


@query("calendar_spine", """
SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE)
       AS day FROM orders""")
def calendar_spine_q(spark, sf):
    """One row per day between the first and last order date."""
    return calendar_spine(date_bounds(table(spark, sf, "orders"), "o_orderdate"), "lo", "hi")


@query("html_links", """
SELECT page_id, href, string_split(href, '/')[-1] AS link_id
FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS href FROM pages)""")
def html_links_q(spark, sf):
    """Root-relative link rows from raw pages, id = last path part."""
    return html_links(table(spark, sf, "pages"), "html", keep=["page_id"])


_LINK_TEXT_SQL = """(SELECT o.o_orderkey,
   CASE WHEN o.o_orderkey % 4 = 0 THEN lower(left(c.c_mktsegment, 3)) ELSE left(c.c_mktsegment, 3) END || '@' ||
   left(split_part(o.o_orderpriority, '-', 2), 3) || ' (' || CAST(month(o.o_orderdate) AS VARCHAR) || '/' ||
   CAST(day(o.o_orderdate) AS VARCHAR) || '/' || strftime(o.o_orderdate, '%y') || ')' AS txt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""


_P = GAME_LINK_PATTERN.replace("'", "''")
_GAME_SQL = (
    "SELECT o_orderkey, 'gid_1998_' || lpad(regexp_extract(txt, '" + _P + "', 3), 2, '0') || '_' || "
    "lpad(regexp_extract(txt, '" + _P + "', 4), 2, '0') || '_' || lower(regexp_extract(txt, '" + _P + "', 1)) || 'mlb_' || "
    "lower(regexp_extract(txt, '" + _P + "', 2)) || 'mlb_1' AS game_id FROM " + _LINK_TEXT_SQL +
    " WHERE regexp_matches(txt, '" + _P + "') AND regexp_extract(txt, '" + _P + "', 5) = '98'")


@query("game_id_build", _GAME_SQL)
def game_id_build_q(spark, sf):
    """Link texts 'AAA@BBB (m/d/yy)' matched, same-season kept, game id built."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    seg = F.left(F.col("c_mktsegment"), F.lit(3))
    home = F.when(F.col("o_orderkey") % 4 == 0, F.lower(seg)).otherwise(seg)
    away = F.left(F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(2)), F.lit(3))
    txt = F.concat(home, F.lit("@"), away, F.lit(" ("), F.month("o_orderdate").cast("string"), F.lit("/"),
                   F.dayofmonth("o_orderdate").cast("string"), F.lit("/"), F.date_format("o_orderdate", "yy"), F.lit(")"))
    links = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", txt.alias("txt"))
    return game_ids(links, "txt", 1998, keep=["o_orderkey"])


@query("html_table_rows", """
SELECT o_orderkey, CAST(r.row AS BIGINT) AS row, r.column, r.value FROM orders,
  LATERAL (SELECT 0 AS row, 'gid' AS column, '/gid_' || CAST(o_orderkey AS VARCHAR) || '/' AS value
           UNION ALL SELECT 0, 'status', o_orderstatus
           UNION ALL SELECT 1, 'gid', '/gid_' || CAST(o_custkey AS VARCHAR) || '/'
           UNION ALL SELECT 1, 'status', o_orderpriority) r""")
def html_table_rows_q(spark, sf):
    """First HTML table of each page to (row, column, value) rows."""
    o = table(spark, sf, "orders")
    td = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    html = F.concat(F.lit("<html><body><p>x</p><table class='t'><tr><th>gid</th><th>status</th></tr><tr>"),
                    td(F.concat(F.lit("/gid_"), F.col("o_orderkey").cast("string"), F.lit("/"))), td(F.col("o_orderstatus")),
                    F.lit("</tr>\n<tr>"), td(F.concat(F.lit("/gid_"), F.col("o_custkey").cast("string"), F.lit("/"))),
                    td(F.col("o_orderpriority")), F.lit("</tr></table><table><tr><td>2nd</td></tr></table></body></html>"))
    return html_table_rows(o.select("o_orderkey", html.alias("html")), "html", keep=["o_orderkey"])


_GRID_SQL = """
WITH p AS (SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_orderpriority,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i,
                  count(*) OVER (PARTITION BY o_custkey) AS n FROM orders o),
c AS (SELECT *, CAST(0 AS INTEGER) AS "table" FROM p)
SELECT o_custkey, "table", CAST(i AS BIGINT) AS row, CAST(0 AS INTEGER) AS position, 'customer' AS "column",
       CAST(o_custkey AS VARCHAR) AS value FROM c
UNION ALL SELECT o_custkey, "table", i, 1, 'order & state', '<' || CAST(o_orderkey AS VARCHAR) || '>' FROM c
UNION ALL SELECT o_custkey, "table", i, 2, 'order & state', o_orderstatus FROM c
UNION ALL SELECT o_custkey, "table", i, 3, 'note', o_orderpriority || ' 1 2' FROM c
UNION ALL SELECT o_custkey, "table", n, g, CASE g WHEN 0 THEN 'customer' WHEN 3 THEN 'note' ELSE 'order & state' END,
                 'orders: ' || CAST(n AS VARCHAR) FROM (SELECT DISTINCT o_custkey, "table", n FROM c),
                 (SELECT CAST(unnest(range(4)) AS INTEGER) AS g)"""


@query("html_table_grid", _GRID_SQL)
def html_table_grid_q(spark, sf):
    """A page per customer whose table has row and column spans, entities, a ``>`` inside an
    attribute, omitted end tags and a nested table in each row; its first table by the grid."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    row = F.struct("o_orderkey", F.concat(
        F.lit("<td>&lt;"), F.col("o_orderkey").cast("string"), F.lit("&gt;<td>"), F.col("o_orderstatus"),
        F.lit("<td title='a > b'>"), F.col("o_orderpriority"),
        F.lit(" <table><tr><td>1</td><td> 2</td></tr></table></td></tr>")).alias("cells"))
    pages = o.groupBy("o_custkey").agg(F.sort_array(F.collect_list(row)).alias("r"), F.count(F.lit(1)).alias("n"))
    head = F.concat(F.lit("<p>x</p><table data-x='<td>'><tr><th>customer<th colspan=2>order &amp; state<th>note</tr><tr>"
                          "<td rowspan="), F.col("n").cast("string"), F.lit(">"), F.col("o_custkey").cast("string"))
    html = F.concat(head, F.array_join(F.transform("r", lambda x: x["cells"]), "<tr>"), F.lit("<tr><td colspan=4>orders: "),
                    F.col("n").cast("string"), F.lit("</table><table><tr><td>2nd</td></tr></table>"))
    return html_tables(pages.select("o_custkey", html.alias("html")), "html", keep=["o_custkey"], only=0)


@query("image_files", """
SELECT vec_id, CAST(label AS VARCHAR) AS label, CAST(4 + label % 5 AS INTEGER) AS height, CAST(8 AS INTEGER) AS width,
       list_transform(range(0, (4 + label % 5) * 24), lambda k:
         CAST(CAST(floor(abs(CAST(embedding[k // 3 + 1] AS DOUBLE)) * 1000) + 7 * (k % 3) AS BIGINT) % 256 AS BIGINT)) AS pixels
FROM embeddings""")
def image_files_q(spark, sf):
    """An image file per vector (4 to 8 rows of 8 colour pixels) in a folder per label, read back by the
    binary file source: path, label, size and pixels. The vector's id is the file's comment, so that a
    folder holds many files; tasks, not the driver, put their files in place (their names are the same
    at a second attempt)."""
    e = table(spark, sf, "embeddings")
    pixel = lambda k, c: ((F.floor(F.abs(k.cast("double")) * 1000) + 7 * c) % 256).cast("int")
    row = lambda r: F.transform(F.slice("embedding", r * 8 + 1, F.lit(8)),
                                lambda k: F.array(*[pixel(k, c) for c in range(3)]))
    img = F.transform(F.sequence(F.lit(0), 3 + F.col("label") % 5), row)
    path = scratch_path(spark, "images")
    # one image for each id and label; a file costs far more than its bytes: a task for every 256 files
    files = e.dropDuplicates(["vec_id", "label"]).select(plain_ppm(img, F.col("vec_id")).alias("value"), "label")
    files = files.repartition(max(1, -(-e.count() // 256)))
    files.write.partitionBy("label").option("maxRecordsPerFile", 1) \
        .option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
    got = read_images(spark, path, "part-*", r"label=([^/]*)/")
    return got.select(F.col("note").cast("long").alias("vec_id"), "label", "height", "width",
                      F.transform(F.flatten(F.flatten("image")), lambda x: x.cast("long")).alias("pixels"))


# ---------------------------------------------------------------- sinks

@query("sink_parquet_roundtrip", "SELECT * FROM customer")
def sink_parquet_roundtrip_q(spark, sf):
    """K3: columnar write and read back."""
    path = scratch_path(spark, "customer-parquet")
    write_parquet(table(spark, sf, "customer"), path)
    return spark.read.parquet(path)


_PART_SQL = (f"CASE WHEN {md5_bucket_sql('o_orderkey', 10)} < 8 THEN 'train' "
             f"WHEN {md5_bucket_sql('o_orderkey', 10)} = 8 THEN 'valid' ELSE 'test' END")


@query("sink_partitioned", f"SELECT o_orderkey, o_custkey, {_PART_SQL} AS part FROM orders")
def sink_partitioned_q(spark, sf):
    """K2/K8: headerless CSV per data part (one folder per part), read back with the part."""
    path = scratch_path(spark, "orders-parts")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    b = stable_bucket("o_orderkey", 10)
    parts = o.withColumn("part", F.when(b < 8, "train").when(b == 8, "valid").otherwise("test"))
    write_delimited(parts, path, header=False, partition_by=["part"])
    back = spark.read.schema("o_orderkey long, o_custkey long, part string").option("header", False).csv(path)
    return back.select("o_orderkey", "o_custkey", "part")


@query("sink_overwrite", "SELECT * FROM customer")
def sink_overwrite_q(spark, sf):
    """K4: replace table: a second write with overwrite leaves only the new rows."""
    path = scratch_path(spark, "customer-overwrite")
    c = table(spark, sf, "customer")
    write_parquet(c.filter(F.col("c_custkey") % 2 == 0).withColumn("c_name", F.lit("stale")), path)
    write_parquet(c, path, mode="overwrite")
    return spark.read.parquet(path)


_CUSTOMER_T = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                            T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
                            T.StructField("c_mktsegment", T.StringType())])


@query("sink_append", "SELECT * FROM customer")
def sink_append_q(spark, sf):
    """K5: append to a table created on first use, rows checked against a declared schema."""
    path = scratch_path(spark, "customer-append")
    c = table(spark, sf, "customer")
    append_rows(c.filter(F.col("c_custkey") % 2 == 0), path, _CUSTOMER_T)
    append_rows(c.filter(F.col("c_custkey") % 2 == 1), path, _CUSTOMER_T)
    return spark.read.parquet(path)


@query("sink_single_file", "SELECT *, 1 AS n_files FROM customer")
def sink_single_file_q(spark, sf):
    """K6: shards merged into one output file on request (one writing task)."""
    path = scratch_path(spark, "customer-single")
    write_delimited(table(spark, sf, "customer").repartition(4), path, single_file=True)
    back = read_with_filename(spark, path, "csv", CUSTOMER_SCHEMA, {"header": "true"})
    n_files = back.agg(F.countDistinct("file_path").alias("n")).first()["n"]
    return back.drop("file_path").withColumn("n_files", F.lit(n_files))


@query("sink_json_roundtrip", """
SELECT o_orderkey, [o_totalprice, CAST(o_custkey AS DOUBLE)] AS instances FROM orders""")
def sink_json_roundtrip_q(spark, sf):
    """K7: feature rows written as JSON lines ({"o_orderkey":..,"instances":[..]}) and read back."""
    path = scratch_path(spark, "orders-json")
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.array(F.col("o_totalprice"), F.col("o_custkey").cast("double")).alias("instances"))
    write_json(o, path)
    return read_json_lines(spark, path, "o_orderkey long, instances array<double>")


@query("sink_json_array", """
SELECT [CAST(o_orderkey AS DOUBLE), o_totalprice, CAST(o_custkey AS DOUBLE)] AS instance FROM orders""")
def sink_json_array_q(spark, sf):
    """K7: each feature row written as a JSON array line (prediction-request instances),
    read back as text and parsed."""
    path = scratch_path(spark, "orders-json-array")
    write_json(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey"), path, as_array=True)
    return spark.read.text(path).select(F.from_json("value", "array<double>").alias("instance"))
