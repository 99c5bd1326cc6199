"""WARC archives of pages, written and read by Spark, and their capture index.

Archives are WARC 1.1 files: Spark's text writer puts the two line ends after each
record that the format asks for, and gzip packs each file. Records with a payload seen
before are revisits. The capture index comes from an external merge: each task sorts the
captures it read into runs by URL key and time, and loser trees merge the runs by range.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.joins import fits
from ..sources.session import settle
from .common import answer, utf8
from .merge import combine_ranges, decode, merge, pick_splitters, send_runs

LEAST = 100
"""Smallest payload, in bytes, that a revisit may refer to."""
WANTED_ROWS = 200_000
"""Most revisits (50 bytes each) that are broadcast to their pages; beyond it the join is shuffled."""
RECORDS = 5_000
"""Most records in one archive file."""
RANGE_CAPTURES = 20_000
EPOCH = 1_704_067_200
"""Captures without a time of their own are dated this second (2024-01-01) plus their page_id, within a year."""
END = "\r\n"
_YEAR = 31_536_000


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(END))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """page_id, url, html, sha (binary), bytes, first (the response's page_id where this is a revisit).

    Of equal payloads of ``least`` bytes or more the smallest page_id is the response;
    null ids come last. Rows that repeat that page_id are responses too.
    """
    body = utf8(F.col(html))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"), F.unhex(F.sha2(body, 256)).alias("sha"), F.length(body).cast("long").alias("bytes"))
    slim = rows.filter(F.col("bytes") >= least).select("sha", "page_id")
    groups = settle(slim.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1"))
    found = answer(slim.distinct(), groups, ["sha"], ["first"], "n", slim.count()).filter("first is not null and not (page_id <=> first)")
    revisits = settle(found.select(F.col("page_id").alias("id"), F.col("sha").alias("id_sha"), "first"))
    known = F.broadcast(revisits) if fits(revisits, WANTED_ROWS) else revisits
    return rows.join(known, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("id_sha")), "left").drop("id", "id_sha")


def write_archives(records: DataFrame, path: str, most: int = RECORDS) -> None:
    """Write planned records as gzipped WARC files under ``path``, at most ``most`` in each."""
    revisit = F.col("first").isNotNull()
    digest = F.concat(F.lit("sha256:"), F.lower(F.hex("sha")))
    when = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(_YEAR))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}"), _line("Content-Type", "text/html; charset=utf-8"), _line("Content-Length", F.col("bytes").cast("string")), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    target = F.regexp_replace("url", r"[\r\n]", " ")
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", when),
        _line("WARC-Target-URI", target),
        F.when(revisit, F.concat(_line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), _line("WARC-Refers-To", _urn(F.col("first"))))).otherwise(""),
        _line("WARC-Payload-Digest", digest),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
    )
    records.select(F.concat(header, block).alias("value")).write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def parse_records(archive: BinaryIO) -> Iterator[tuple[int, dict[bytes, bytes], bytes]]:
    """(offset, named fields in lower case, block) of every record in an unpacked archive, one record in memory at a time."""
    at = 0
    while version := archive.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields, size = {}, len(version)
        while (line := archive.readline()) != b"\r\n":
            if not line:
                raise ValueError(f"record at byte {at} is cut short")
            name, _, value = line.partition(b":")
            fields[name.strip().lower()] = value.strip()
            size += len(line)
        length = int(fields[b"content-length"])
        block = archive.read(length)
        if len(block) < length or archive.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield at, fields, block
        at += size + 2 + length + 4


def url_key(url: str) -> str:
    """Host labels from right to left, then path and query, all in lower case."""
    found = re.match(r"(?s)[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)(?::\d+)?([^#]*)", url)
    if not found:
        return url.lower()
    return (",".join(reversed(found[1].split("."))) + ")" + (found[2] or "/")).lower()


_RECORD = "page_id long, url string, captured_at string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long, archive string, offset long"
_RECORD_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("captured_at", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64())]
)


def _number(urn: bytes | None) -> int | None:
    last = (urn or b"null>").rpartition(b":")[2].rstrip(b">")
    return None if last == b"null" else int(last)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``; a response whose payload does not fit its digest ends the job.

    ``payload`` is null for revisits; ``payload_bytes`` and ``payload_digest`` are always
    those of the full payload. ``offset`` counts in the unpacked archive.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, packed in zip(batch.column("path").to_pylist(), batch.column("content")):
                archive, rows, held = gzip.GzipFile(fileobj=pa.BufferReader(packed.as_buffer())), [], 0
                for offset, fields, block in parse_records(archive):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields[b"warc-payload-digest"].partition(b":")[2].decode()
                    kind = fields[b"warc-type"].decode()
                    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)[1])
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                        raise ValueError(f"payload of the record at byte {offset} of {name} does not fit its digest")
                    rows.append((_number(fields[b"warc-record-id"]), fields[b"warc-target-uri"].decode(), fields[b"warc-date"].decode(), kind, payload if kind == "response" else None, size, digest, _number(fields.get(b"warc-refers-to")) if kind == "revisit" else None, name.rpartition("/")[2], offset))
                    held += len(payload)
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(read, _RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_RECORD_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RECORD_ARROW)], schema=_RECORD_ARROW)


_CAPTURE = [f for f in _RECORD_ARROW if f.name not in ("payload",)]
_INDEX = "page_id long, url string, captured_at string, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, offset long, url_key string, range int, place long, history_place long"
_INDEX_ARROW = pa.schema([*_CAPTURE, ("url_key", pa.string()), ("range", pa.int32()), ("place", pa.int64()), ("history_place", pa.int64())])


def index_captures(records: DataFrame, range_captures: int = RANGE_CAPTURES) -> DataFrame:
    """The capture index: every record, in the order of (range, place) by URL key, time and page_id.

    ``history_place`` counts a URL's captures within a range. Repeated records stay.
    """
    names = [f.name for f in _CAPTURE]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            keys = [b"\0".join((url_key(r["url"]).encode(), r["captured_at"].encode(), b"" if r["page_id"] is None else b"%020d" % (r["page_id"] + (1 << 63)))) for r in rows]
            values = ["\0".join("" if r[n] is None else str(r[n]) for n in names[2:]).encode() + b"\0" + str(r["page_id"]).encode() + b"\0" + r["url"].encode() for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.binary())], names=["key", "value"])

    rows = settle(records.select(*names).mapInArrow(keyed, "key binary, value binary"))
    splitters = pick_splitters(rows.select("key"), -(-rows.count() // range_captures))

    def handle(number: int, pieces: list[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
        out, at, history = [], None, 0
        for place, (key, _, value) in enumerate(merge(decode(blob) for _, blob in pieces)):
            host = key.split(b"\0", 1)[0]
            history = history + 1 if host == at else 0
            at = host
            when, kind, size, digest, refers, archive, offset, page, url = value.decode().split("\0", 8)
            out.append((None if page == "None" else int(page), url, when, kind, int(size), digest, int(refers) if refers else None, archive, int(offset), host.decode(), number, place, history))
            if len(out) == 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _INDEX_ARROW)], schema=_INDEX_ARROW)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _INDEX_ARROW)], schema=_INDEX_ARROW)

    return combine_ranges(send_runs(rows, splitters), handle, _INDEX)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives beside the shared checkpoints."""
    settle(spark.range(1))
    return f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"


def archive_pages(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write a WARC record per row of ``pages``, read the archives back and index the captures.

    Null html is an empty payload, a null url an empty target. Repeated rows are records
    of their own. An empty table gives no archive and an empty index.
    """
    spark = pages.sparkSession
    path = path or archive_folder(spark)
    write_archives(plan_records(pages, **columns), path)
    return index_captures(read_archives(spark, path))
