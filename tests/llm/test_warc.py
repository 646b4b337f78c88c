"""WARC archives: exact round trip, single members, revisits."""

import base64
import glob
import gzip
import hashlib
import io
import json

import pytest
from pyspark.sql import functions as F

from headway.llm import warc
from headway.llm.store import new_folder

SCHEMA = "page_id long, url string, html string, uri string, offset long, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "u", 1, "d") for r in rows], SCHEMA)


ROWS = [
    (1, "http://a.example/x", "<p>one</p>"),
    (2, "http://a.example/é \r\nX: y", "<p>one</p>"),
    (3, None, None),
    (4, "", ""),
    (None, "http://b.example", "<p>one</p>"),
    (5, "http://b.example", "WARC/1.1\r\n\r\n" * 50 + "é\r\n\r\n"),
    (6, "http://b.example", "x" * 3_000_000),
    (7, "http://b.example", "lone"),
    (8, "http://b.example", "twice"),
    (8, "http://b.example", "twice"),
    (None, "http://b.example", "unnamed"),
]


def expected(rows):
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        refers = last.get(h or "")
        refers = None if refers == i else refers
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = warc.warc_round_trip(spark, pages(spark, ROWS)).collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS)
    assert warc.warc_round_trip(spark, pages(spark, [])).collect() == []


def test_members_stand_alone_and_index_is_a_sidecar(spark, monkeypatch):
    folder = new_folder(spark, "warc-test")
    raw = warc.write_archives(warc.resolve_revisits(pages(spark, ROWS).select("page_id", "url", "html")), f"{folder}/raw")
    index = warc.normalise_archives(raw, f"{folder}/records")
    local = folder.removeprefix("file://").removeprefix("file:")
    raw_files = glob.glob(f"{local}/raw/*.gz")
    files = glob.glob(f"{local}/records/*.warc.gz")
    assert len(raw_files) == len(files) == raw.count() and not glob.glob(f"{local}/*/*.part")
    # the same bytes inflate from the one stream and from the members
    whole = {f.rpartition("raw-")[2]: gzip.open(f).read() for f in raw_files}
    assert {f.rpartition("records-")[2]: gzip.open(f).read() for f in files} == whole
    lines = [json.loads(x) for f in files for x in open(f"{f}.index.jsonl")]
    assert sorted(map(str, lines)) == sorted(str(r.asDict()) for r in index.collect()) and len(lines) == len(ROWS)
    for x in lines:
        with open(x["uri"].removeprefix("file://").removeprefix("file:"), "rb") as f:
            f.seek(x["offset"])
            record = gzip.GzipFile(fileobj=io.BytesIO(f.read(x["length"]))).read()
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"WARC-Record-ID: {x['record_id']}\r\n".encode() in record
        payload = record.partition(b"\r\n\r\n")[2].partition(b"\r\n\r\n")[2][:-4]
        if x["record_type"] == "revisit":
            assert payload == b""
    refers = index.where(F.col("record_type") == "revisit").count()
    assert refers == sum(r[3] == "revisit" for r in expected(ROWS))


def test_damage_is_reported():
    body = warc.record(1, "u", b"abc", warc.payload_digest(b"abc"), None, "0")
    packed = gzip.compress(body + body[:-10])
    records = warc._records(io.BytesIO(packed))
    assert next(records)[1] == body
    with pytest.raises(ValueError, match="ends within"):
        next(records)
