"""WARC archives: writing, reading, and resolving repeated payloads.

Archives are gzip files whose records follow the WARC 1.1 form. They are
written by Spark's text writer, whose line end is the record end, so they lie
wherever Spark can write; and read as whole files of bounded size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake.llm.common import ready, spread_join
from rosterlake.session import cut, work_path

MIN_BYTES = 0             # payloads below are never revisits
FILE_RECORDS = 4000
DATE = "2024-01-01T00:00:00Z"   # the tables carry no capture time
# fixed values of the format
END = "\r\n\r\n"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = ("page_id long, url string, record_type string, record_id string, payload_digest string, "
         "refers_to long, payload string")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits are four letters."""
    digest = F.sha1(payload.cast("binary"))

    def letters(group: Column) -> Column:
        value = F.conv(F.substring(digest, group * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substring(F.lit(ALPHABET),
                                      F.shiftright(value, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                          for s in (15, 10, 5, 0)])
    return F.concat(*[letters(F.lit(g)) for g in range(8)])


def _record_id(page_id: str, digest: str) -> Column:
    h = F.md5(F.concat_ws("/", F.col(page_id).cast("string"), F.col(digest)).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none where the value is null. Line ends go."""
    clean = F.regexp_replace(value.cast("string"), "[\r\n]", "")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")))


def record_text() -> Column:
    """A record from page_id, url, record_type, record_id, payload_digest,
    refers_to, refers_to_id, refers_to_url and payload."""
    revisit = F.col("record_type") == "revisit"
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    F.lit("Content-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(head, F.col("payload")))
    lines = [
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.col("record_id")), _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Page-ID", F.col("page_id")),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.col("refers_to_id")),
        _line("WARC-Refers-To-Target-URI", F.col("refers_to_url")),
        _line("WARC-Refers-To-Page-ID", F.col("refers_to")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block)), F.lit("\r\n")]
    return F.concat(*[F.coalesce(x, F.lit("")) for x in lines], block)


def write_archives(records: DataFrame, path: str) -> str:
    """Gzip archives of at most ``FILE_RECORDS`` records each."""
    (records.select(record_text().alias("value")).write.option("lineSep", END)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))
    return path


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one unpacked archive."""
    at, end = 0, END.encode()
    while at < len(data):
        stop = data.index(end, at)
        first, *lines = data[at:stop].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/1."):
            raise ValueError(f"no record starts at byte {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                       for line in lines)
        body = stop + len(end)
        at = body + int(headers["Content-Length"])
        yield headers, data[body:at]
        if data[at:at + len(end)] != end:
            raise ValueError(f"record is not closed at byte {at}")
        at += len(end)


def unpack(data: bytes) -> bytes:
    """All members of a gzip file, or the bytes as they are."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        d = zlib.decompressobj(31)
        out.append(d.decompress(data) + d.flush())
        data = d.unused_data
    return b"".join(out)


def _row(headers: dict[str, str], block: bytes, payload: bool) -> tuple:
    number = lambda v: int(v) if v is not None else None
    body = block.split(END.encode(), 1)[1].decode("utf-8") if payload and block else None
    return (number(headers.get("WARC-Page-ID")), headers.get("WARC-Target-URI"),
            headers["WARC-Type"], headers["WARC-Record-ID"],
            headers.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
            number(headers.get("WARC-Refers-To-Page-ID")), body)


def _rows(payload: bool):
    names = [c.split()[0] for c in _READ.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for headers, block in parse(unpack(content.as_py())):
                    rows.append(_row(headers, block, payload))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    return run


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of all archives under ``path``; a broken record is an error."""
    ready(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_rows(payload), _READ)


def as_records(pages: DataFrame) -> DataFrame:
    """Response records of page_id, url and html; a null html is empty."""
    none = lambda kind: F.lit(None).cast(kind)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    return rows.withColumns({"record_type": F.lit("response"), "refers_to": none("long"),
                             "record_id": _record_id("page_id", "payload_digest"),
                             "refers_to_id": none("string"), "refers_to_url": none("string")})


def revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, payload_digest, refers_to, ...) of the records that repeat the
    payload of a smaller page id. ``headers``: page_id, url, payload_digest,
    payload_bytes, record_id. Digests are first counted, so a payload that a
    third of all records share is one row until it is joined back."""
    firsts = headers.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 AND refers_to IS NOT NULL").drop("n")
    firsts = firsts.withColumn("refers_to_id", _record_id("refers_to", "payload_digest"))
    urls = headers.groupBy("record_id").agg(F.min("url").alias("refers_to_url"))
    firsts = firsts.join(urls, firsts["refers_to_id"] == urls["record_id"], "left").drop("record_id")
    others = spread_join(headers.select("page_id", "payload_digest"), firsts, ["payload_digest"])
    return others.where("NOT (page_id <=> refers_to)").distinct()


def resolve(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES) -> str:
    """Rewrite archives so that each payload is stored once, with fresh headers."""
    records = read_archives(spark, source)
    headers = cut(records.select("page_id", "url", "payload_digest", "record_id",
                                 F.octet_length("payload").cast("long").alias("payload_bytes")))
    again = cut(revisits(headers, min_bytes))
    joined = spread_join(records.drop("refers_to"), again, ["page_id", "payload_digest"], "left")
    joined = joined.withColumn("record_type", F.when(F.col("refers_to").isNotNull(), "revisit")
                               .otherwise("response"))
    return write_archives(joined, target)


def archived_pages(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """What the deduplicated archives of a page table say of each page.

    A null html is empty, a null url has no header; pages without an id are
    revisits of the smallest id with their payload, or responses where none has
    one; rows that repeat the smallest id are responses like it; other columns
    are ignored; an empty table gives no rows.
    """
    spark = ready(pages.sparkSession)
    first = write_archives(as_records(pages), work_path(spark, "warc"))
    final = resolve(spark, first, work_path(spark, "warc-resolved"), min_bytes)
    read = cut(read_archives(spark, final).select(
        "page_id", "record_type", "payload_digest", "refers_to",
        F.octet_length("payload").cast("long").alias("payload_bytes")))
    stored = read.where("record_type = 'response'")
    held = stored.groupBy("payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    back = spread_join(read.where("record_type = 'revisit'").drop("payload_bytes"), held,
                       ["payload_digest"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return stored.select(*columns).unionByName(back.select(*columns))
