"""WARC archives (ISO 28500) as a chunked record table.

Writing: every payload becomes rows (record id, chunk number) of a bounded number of bytes; a payload of several chunks is stored by the
format's own segmentation, a response record followed by continuation records. Header and chunk are separate rows of a text file whose
line end is CRLF CRLF: exactly what ends a header and a record in the format. So any Spark file system can hold the archives, and nothing
larger than a chunk is ever written at once.

Reading: files are read as rows parted by CRLF CRLF, in order, and a small parser puts chunks together again by Content-Length and carries
a running SHA-1 over the chunks of a record. It holds one piece at a time and yields chunk rows and one row per record.

Of records with equal payloads that with the largest id is the response, the others are revisit records without payload. Copies are counted
per digest before they meet, so a payload that a third of all rows repeat is one row per task.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from . import common

CHUNK_BYTES = 1 << 20
#: Fixed values of the format.
VERSION, END = "WARC/1.1", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"
RECORD = "record_id string, kind string, uri string, refers_to string, payload_bytes long, payload_digest string, stated_digest string"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1; 40 bits at a time become eight digits of base 32, then letters."""
    # The digits of conv() and the alphabet of RFC 4648.
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), digits, letters)


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines of the fields that are not null."""
    return F.concat_ws("\r\n", F.lit(VERSION), *[F.when(v.isNotNull(), F.concat(F.lit(f"{n}: "), v.cast("string"))) for n, v in fields])


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = 0) -> DataFrame:
    """One row per page: ``_id``, ``_url``, ``_payload``, ``_digest``, ``_bytes``, ``_refers`` (null for a response).

    A page whose key is null is written as a response of its own. Rows that repeat both key and payload are alike: with the largest key all
    of them are responses, otherwise all are revisits. Payloads of fewer than ``revisit_from`` bytes are always responses. Null html is an
    empty payload. Other columns are not read.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("long").alias("_key"), F.regexp_replace(F.col(url), r"[\r\n]+", " ").alias("_url"), payload.alias("_payload"),
        base32_sha1(payload).alias("_digest"), F.octet_length(payload).cast("long").alias("_bytes"),
    )
    takes_part = F.col("_key").isNotNull() & (F.col("_bytes") >= revisit_from)
    # Maxima combine in every task before the shuffle; digests of one row need no join.
    top = rows.where(takes_part).groupBy("_digest").agg(F.max("_key").alias("_top"), F.count(F.lit(1)).alias("_copies"))
    found = rows.join(top.where("_copies > 1").select("_digest", "_top"), "_digest", "left")
    refers = F.when(takes_part & (F.col("_key") < F.col("_top")), F.col("_top"))
    return found.select(F.col("_key").cast("string").alias("_id"), "_url", "_payload", "_digest", "_bytes", refers.cast("string").alias("_refers"))


def chunk_rows(found: DataFrame, chunk_bytes: int) -> DataFrame:
    """Rows (record id, chunk number) with at most ``chunk_bytes`` of the payload; a revisit or empty payload has one empty chunk."""
    last = F.when(F.col("_refers").isNull(), F.ceil(F.col("_bytes") / chunk_bytes) - 1).otherwise(F.lit(0))
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0)).cast("long"))).alias("_chunk")
    rows = found.withColumn("_last", F.greatest(last, F.lit(0)).cast("long")).select("*", numbers)
    piece = F.when(F.col("_refers").isNull(), F.substring(F.col("_payload"), (F.col("_chunk") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes)))
    return rows.withColumn("_piece", F.coalesce(piece, F.lit(b""))).drop("_payload")


def write(found: DataFrame, path: str, date: str, chunk_bytes: int = CHUNK_BYTES, compression: str = "gzip") -> None:
    """Archive files below ``path``; chunks of a record follow each other in one file."""
    rows = chunk_rows(found, chunk_bytes)
    segmented, is_first = F.col("_last") > 0, F.col("_chunk") == 0
    uri = F.concat(F.lit("<"), F.lit(_ID), F.coalesce("_id", F.lit("")), F.when(is_first, F.lit("")).otherwise(F.concat(F.lit("/"), F.col("_chunk") + 1)), F.lit(">"))
    kind = F.when(~is_first, F.lit("continuation")).when(F.col("_refers").isNotNull(), F.lit("revisit")).otherwise(F.lit("response"))
    header = _lines(
        ("WARC-Type", kind),
        ("WARC-Record-ID", uri),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("_url")),
        ("WARC-Payload-Digest", F.when(is_first, F.concat(F.lit("sha1:"), "_digest"))),
        ("WARC-Profile", F.when(F.col("_refers").isNotNull(), F.lit(REVISIT_PROFILE))),
        ("WARC-Refers-To", F.concat(F.lit(f"<{_ID}"), F.col("_refers"), F.lit(">"))),
        ("Payload-Length", F.when(is_first, F.col("_bytes"))),
        ("WARC-Segment-Number", F.when(segmented, F.col("_chunk") + 1)),
        ("WARC-Segment-Origin-ID", F.when(segmented & ~is_first, F.concat(F.lit(f"<{_ID}"), F.coalesce("_id", F.lit("")), F.lit(">")))),
        ("WARC-Segment-Total-Length", F.when(segmented & (F.col("_chunk") == F.col("_last")), F.col("_bytes"))),
        ("Content-Length", F.octet_length("_piece")),
    )
    both = rows.select(F.explode(F.array(header.cast("binary"), "_piece")).alias("value")).select(F.col("value").cast("string").alias("value"))
    both.write.option("lineSep", END).option("compression", compression).text(path)


class Reader:
    """Records out of pieces that were parted by CRLF CRLF. One piece is in memory at a time."""

    def __init__(self):
        self.header: dict[str, str] | None = None
        self.left = -1  # bytes of the block still to come; -1 while a header is awaited
        self.open: dict | None = None  # the record whose digest is running

    def feed(self, piece: bytes) -> Iterator[tuple[str, dict, bytes]]:
        """('chunk', record, bytes) for every part of a payload and ('record', record, b'') when it is whole."""
        if self.left < 0:
            if not piece.strip():
                return
            lines = piece.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"not a WARC header: {lines[0][:60]!r}")
            self.header = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            self.left = int(self.header["content-length"])
            yield from self._begin()
            return
        data = piece if self.left >= len(piece) else piece[: self.left]
        if len(data) < len(piece):
            raise ValueError("a block is longer than its Content-Length")
        self.left -= len(data)
        yield from self._take(data)
        if self.left == 0:
            yield from self._end()
        else:  # the separator was part of the block
            end = END.encode()[: self.left]
            self.left -= len(end)
            yield from self._take(end)
            if len(end) < len(END):  # the end of the record began inside the separator; its rest leads the next header
                yield from self._end()
            # Otherwise what follows the separator comes as the next piece, even if it is empty.

    def _begin(self) -> Iterator[tuple[str, dict, bytes]]:
        h = self.header
        if h["warc-type"] == "continuation":
            if self.open is None or h.get("warc-segment-origin-id") != self.open["id"]:
                raise ValueError("a segment does not follow its record")
            return
        if self.open is not None:
            raise ValueError("a record has no last segment")
        self.open = {"id": h["warc-record-id"], "header": h, "sha1": hashlib.sha1(), "bytes": 0, "chunk": 0}
        yield from ()

    def _take(self, data: bytes) -> Iterator[tuple[str, dict, bytes]]:
        if data:
            self.open["sha1"].update(data)
            self.open["bytes"] += len(data)
            yield "chunk", self.open, data
            self.open["chunk"] += 1

    def _end(self) -> Iterator[tuple[str, dict, bytes]]:
        h, self.left = self.header, -1
        if "warc-segment-number" in h and "warc-segment-total-length" not in h:
            return  # another segment follows
        done, self.open = self.open, None
        yield "record", done, b""

    def close(self) -> None:
        if self.left > 0 or self.open is not None:
            raise ValueError("an archive ends inside a record")


def _plain(uri: str | None) -> str | None:
    return uri.strip("<>").removeprefix(_ID) if uri else None


def _parsed(spark: SparkSession, path: str, on_event, schema: str) -> DataFrame:
    """Runs the parser over every file. A file is read by one task, front to back, so archives are compressed or one split each."""
    pieces = spark.read.option("lineSep", END).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    names = common.schema(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, reader = None, Reader()
        rows: list[tuple] = []
        size = 0
        for b in batches:
            files, values = b.column("file"), b.column("value")
            for i in range(b.num_rows):
                if (name := files[i].as_py()) != at:
                    reader.close()
                    at, reader = name, Reader()
                for event in reader.feed(values[i].as_py()):
                    if (row := on_event(*event)) is not None:
                        rows.append(row)
                        size += len(event[2]) + 200
                if size > 8 << 20:
                    yield _batch(rows, names, schema)
                    rows, size = [], 0
        reader.close()
        yield _batch(rows, names, schema)

    return pieces.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[x.strip().split()[1]] for x in schema.split(",")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, with length and digest recomputed from the stored bytes (a revisit: as stated)."""

    def on_event(event: str, record: dict, _: bytes):
        if event != "record":
            return None
        h = record["header"]
        stated = h.get("warc-payload-digest", "").removeprefix("sha1:")
        revisit = h["warc-type"] == "revisit"
        digest = stated if revisit else base64.b32encode(record["sha1"].digest()).decode()
        size = int(h["payload-length"]) if revisit and "payload-length" in h else record["bytes"]
        return _plain(record["id"]), h["warc-type"], h.get("warc-target-uri"), _plain(h.get("warc-refers-to")), size, digest, stated

    return _parsed(spark, path, on_event, RECORD)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads as rows record_id, chunk (from 0), data, and the SHA-1 of the payload up to and with this chunk."""

    def on_event(event: str, record: dict, data: bytes):
        if event == "chunk":
            return _plain(record["id"]), record["chunk"], data, record["sha1"].hexdigest()
        return None

    return _parsed(spark, path, on_event, "record_id string, chunk long, data binary, sha1_so_far string")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "llm-warc")
    write(records(common.table(spark, sf_dir, "pages")), path, "2026-01-01T00:00:00Z")
    back = read_records(spark, path)
    digest = F.when(F.col("payload_digest") == F.col("stated_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a digest differs from the stated one")))
    number = F.when(F.col("record_id") != "", F.col("record_id")).cast("long")
    return back.select(number.alias("page_id"), "payload_bytes", digest.alias("payload_digest"), F.col("kind").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


QUERIES = {"op3_warc": op3_warc}
ORACLES = {
    "op3_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS x FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST(((('0x' || substr(x, 1 + 10 * CAST(floor(i / 8) AS INTEGER), 10))::BIGINT >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest FROM h),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM m"""
}
