"""WARC archives of pages as a chunked record table.

A record's block is cut to segments of bounded size: rows (record, segment number), as the
format's own segmentation has it (a first record and ``continuation`` records). Each row
becomes one WARC record; Spark's text writer puts the record separator between rows, so
executors stream archives to any store Spark writes to. Readers split archives at record
starts, so that large uncompressed archives are read in parallel; a payload that holds the
text of a record start is segmented inside it. Digests go on chunk by chunk: every segment carries the
digest of the payload so far, and reading back checks it at every segment.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import scratch_path

from .common import blocks_of, slices, store, text_or_empty

#: What separates records, and what starts one. Fixed by the format (and the field order written here).
SEPARATOR, START = "\r\n\r\n", "WARC/1.0\r\nWARC-Type: "
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Characters of a segment (at most four times as many bytes).
SEGMENT_CHARS = 1 << 18

SEGMENT_SCHEMA = ("record_id string, segment int, single boolean, record_type string, page_id long, url string, "
                  "refers_to long, payload_bytes long, payload_digest string, so_far string, body binary")


def base32_sha1(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def cuts(text: str, limit: int) -> list[int]:
    """Ends of a text's segments: at most ``limit`` characters, none holding a record start whole."""
    ends = [m.start() + 8 for m in re.finditer(re.escape(START), text)] + [len(text)]
    out, at = [], 0
    for end in ends:
        while at < end:
            at = min(end, at + limit)
            out.append(at)
    return out or [0]


def _field(name: str, value) -> str:
    return "" if value is None else f"{name}: {''.join(c if c > ' ' else '%%%02X' % ord(c) for c in str(value))}\r\n"


def record_rows(page_id, url, refers_to, refers_url, n_bytes, sha1_hex, html, name, limit) -> Iterator[str]:
    """The WARC records of one page, one string each; ``html`` is not read for a revisit."""
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    about = _field("WARC-Target-URI", url) + _field("X-Page-Id", page_id) + _field("X-Payload-Length", n_bytes)
    rid = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
    date = "WARC-Date: 1970-01-01T00:00:00Z\r\n"  # the tables carry no fetch time
    if refers_to is not None:
        yield (f"{START}revisit\r\nWARC-Record-ID: {rid}\r\n{date}{about}WARC-Profile: {REVISIT_PROFILE}\r\n"
               f"WARC-Payload-Digest: sha1:{digest}\r\n{_field('WARC-Refers-To-Target-URI', refers_url)}"
               f"{_field('X-Refers-To-Page-Id', refers_to)}Content-Length: 0{SEPARATOR}")
        return
    running, at, total = hashlib.sha1(), 0, 0
    ends = cuts(html, limit)
    for k, end in enumerate(ends):
        body = html[at:end].encode()
        at = end
        running.update(body)
        head = HTTP_HEAD.encode() if k == 0 else b""
        total += len(head) + len(body)
        block = hashlib.sha1(head + body)
        fields = f"WARC-Block-Digest: sha1:{base32_sha1(block)}\r\nX-Payload-So-Far: {running.hexdigest()}\r\n"
        if k == 0:
            kind, own = "response", rid
            fields += f"{about}WARC-Payload-Digest: sha1:{digest}\r\nContent-Type: application/http; msgtype=response\r\n"
        else:
            kind, own = "continuation", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{k}')}>"
            fields += f"WARC-Segment-Origin-ID: {rid}\r\n"
        if len(ends) > 1:
            fields += f"WARC-Segment-Number: {k + 1}\r\n"
            if k == len(ends) - 1:
                fields += f"WARC-Segment-Total-Length: {total}\r\n"
        yield (f"{START}{kind}\r\nWARC-Record-ID: {own}\r\n{date}{fields}"
               f"Content-Length: {len(head) + len(body)}{SEPARATOR}{(head + body).decode()}")


def _write(limit: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 512, 6, 4 << 20):
                rows, held = [], 0
                for row in zip(*(part.column(c).to_pylist() for c in range(8)), strict=True):
                    for r in record_rows(*row[:7], str(row[7]), limit):
                        rows.append(r)
                        held += len(r)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])
                            rows, held = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])
    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0, segment_chars: int = SEGMENT_CHARS,
                   compression: str = "gzip", archive_bytes: int = 32 << 20) -> None:
    """Write a record per page under ``path``, as files of about ``archive_bytes`` of payloads.

    ``compression``: of whole files; "none" gives archives that many tasks can read at once.

    Of equal payloads (SHA-256 of the UTF-8 bytes) of at least ``min_bytes`` bytes the smallest
    page id is a response, other ids are revisits of it. Rows that repeat the smallest id are
    responses too; a null id is a response only if its payload has no other. Null html: the
    empty payload. Only the payloads of responses are written.
    """
    html = text_or_empty(pages, html_col)
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.octet_length(html).cast("long").alias("n"), F.sha1(html.cast("binary")).alias("sha1"),
                        F.sha2(html.cast("binary"), 256).alias("payload"), html.alias("html"))
    first = (rows.where((F.col("n") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("payload")
             .agg(F.min(F.struct("page_id", "url")).alias("first")))
    named = rows.join(first, "payload", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    ready = named.select("page_id", "url", F.when(again, F.col("first.page_id")).alias("refers_to"),
                         F.when(again, F.col("first.url")).alias("refers_url"), "n", "sha1",
                         F.when(again, F.lit("")).otherwise(F.col("html")).alias("html"))
    archives = blocks_of(rows.agg(F.sum("n")).first()[0] or 0, archive_bytes)
    if archives < int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        ready = ready.coalesce(archives)
    # The name only has to be unique inside this archive; a task's rows are written once.
    ready = ready.withColumn("name", F.concat_ws("/", F.lit(uuid.uuid4().hex), F.monotonically_increasing_id()))
    ready.mapInArrow(_write(segment_chars), "value string").write.option("lineSep", SEPARATOR).text(
        path, compression=compression)


def parse_record(value: bytes) -> tuple[str, dict[str, str], bytes]:
    """(type, fields, block) of what follows a record start; raises where lengths disagree."""
    head, _, rest = value.partition(SEPARATOR.encode())
    kind, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != SEPARATOR.encode():
        raise ValueError(f"record {fields.get('WARC-Record-ID')}: the block isn't {size} bytes long")
    return kind, fields, rest[:size]


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _parse(batches: Iterator) -> Iterator:
    """Segments of all records; the body stays only where a record has more than one."""
    import pyarrow as pa

    names = [c.split()[0] for c in SEGMENT_SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
             pa.string(), pa.string(), pa.binary()]
    for batch in batches:
        for part in slices(batch, 512, 0, 4 << 20):
            rows: list[list] = [[] for _ in names]
            for value in part.column(0).cast(pa.binary()).to_pylist():
                if not value:
                    continue  # before an archive's first record
                kind, f, block = parse_record(value)
                segment = int(f.get("WARC-Segment-Number", 1))
                single = "WARC-Segment-Number" not in f
                digest, size = f.get("WARC-Payload-Digest", "sha1:")[5:], _number(f.get("X-Payload-Length"))
                if kind != "revisit":
                    if "sha1:" + base32_sha1(hashlib.sha1(block)) != f["WARC-Block-Digest"]:
                        raise ValueError(f"record {f['WARC-Record-ID']}: the block's digest differs")
                    body = block.partition(SEPARATOR.encode())[2] if segment == 1 else block
                    if single:
                        digest, size, body = base32_sha1(hashlib.sha1(body)), len(body), None
                else:
                    body = None
                for r, v in zip(rows, (f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]), segment, single, kind,
                                       _number(f.get("X-Page-Id")), f.get("WARC-Target-URI"),
                                       _number(f.get("X-Refers-To-Page-Id")), size, digest,
                                       f.get("X-Payload-So-Far"), body), strict=True):
                    r.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names)


def _join_segments(batches: Iterator) -> Iterator:
    """Segments sorted by (record, number) -> a row per record; one running digest, never a whole payload."""
    import pyarrow as pa

    names = ["page_id", "url", "refers_to", "payload_bytes", "payload_digest", "record_type"]
    state = None

    def flush(rows: list[list]) -> None:
        if state:
            _, running, size, first = state
            for r, v in zip(rows, (first[0], first[1], None, size, base32_sha1(running), "response"), strict=True):
                r.append(v)

    for batch in batches:
        rows: list[list] = [[] for _ in names]
        for i in range(batch.num_rows):
            record, number, page, url, so_far, body = (batch.column(c)[i].as_py() for c in range(6))
            if state is None or state[0] != record:
                flush(rows)
                if number != 1:
                    raise ValueError(f"record {record}: its first segment is missing")
                state = [record, hashlib.sha1(), 0, (page, url)]
            state[1].update(body)
            state[2] += len(body)
            if so_far and state[1].hexdigest() != so_far:
                raise ValueError(f"record {record}: the payload differs at segment {number}")
        yield _records(rows, names)
    last: list[list] = [[] for _ in names]
    flush(last)
    yield _records(last, names)


def _records(rows: list[list], names: list[str]):
    import pyarrow as pa

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of archives that ``write_archives`` made."""
    return spark.read.option("lineSep", START).text(path).mapInArrow(_parse, SEGMENT_SCHEMA)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, refers_to, payload_bytes, payload_digest, record_type.

    Digests and lengths are those of the bytes read; a revisit's are its header's. Damaged
    records raise.
    """
    table = store(read_segments(spark, path), "warc-segments")
    columns = ["page_id", "url", "refers_to", "payload_bytes", "payload_digest", "record_type"]
    parts = (table.where("not single").select("record_id", "segment", "page_id", "url", "so_far", "body")
             .repartition("record_id").sortWithinPartitions("record_id", "segment"))
    joined = parts.mapInArrow(_join_segments, "page_id long, url string, refers_to long, payload_bytes long, "
                              "payload_digest string, record_type string")
    return table.where("single").select(*columns).unionByName(joined.select(*columns))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = 0, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Write all pages to archives in the shared scratch folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col, min_bytes, segment_chars)
    return read_archives(spark, path)
