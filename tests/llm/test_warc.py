"""Archives: round trip of hard payloads in small chunks, and the registered query's rules on repeats."""

import base64
import hashlib
from collections import defaultdict

from barloom.llm import warc
from barloom.session import shared_dir

PAYLOADS = [
    "", None, "a", "\r\n\r\n", "\r\n", "\r", "x\r\n\r", "x\r\n\r\n", "x\r\n", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "é" * 500,
    "line\n" * 400, "\r\n\r\n" * 97, "abc\r\n\r\n\r\ndef\r\n\r\n\r\n\r\n", "z" * 10_000, "a", "a", "ü\r\n" * 333 + "\r\n",
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, _row string, value int")


def test_round_trip_of_hard_payloads(spark):
    rows = [(i, f"http://x/{i}\r\nX: y", p, "clash", 1) for i, p in enumerate(PAYLOADS)] + [(None, None, "a", "c", 2), (None, None, None, "c", 2)]
    for chunk, codec in ((64, "gzip"), (7, "none"), (1 << 20, "gzip")):
        path = shared_dir(spark, "warc-test")
        warc.write(warc.records(pages(spark, rows).repartition(3)), path, "2026-01-01T00:00:00Z", chunk, codec)
        got = {}
        for r in warc.read_records(spark, path).collect():
            assert r.payload_digest == r.stated_digest
            if r.record_id:
                got[int(r.record_id)] = (r.payload_bytes, r.payload_digest, r.kind)
        parts = defaultdict(dict)
        for r in warc.read_chunks(spark, path).collect():
            assert len(r.data) <= chunk
            if r.record_id:
                parts[int(r.record_id)][r.chunk] = bytes(r.data)
        assert len(got) == len(PAYLOADS)
        for i, p in enumerate(PAYLOADS):
            raw = (p or "").encode()
            assert got[i][0] == len(raw) and got[i][1] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
            if got[i][2] == "response":
                assert b"".join(parts[i][k] for k in sorted(parts[i])) == raw
        kinds = {i: got[i][2] for i in got}
        assert kinds[16] == "response" and kinds[2] == kinds[15] == "revisit" and kinds[1] == "response" and kinds[0] == "revisit"


def test_repeated_rows_and_threshold(spark):
    rows = [(5, "u", "same", "", 0), (5, "u", "same", "", 0), (4, "u", "same", "", 0), (9, "u", "ab", "", 0), (8, "u", "ab", "", 0)]
    found = warc.records(pages(spark, rows), revisit_from=3).collect()
    assert sorted((r._id, r._refers or "") for r in found) == [("4", "5"), ("5", ""), ("5", ""), ("8", ""), ("9", "")]
    assert warc.records(pages(spark, [])).collect() == []
