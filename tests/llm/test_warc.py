import io
from hashlib import sha256

import pytest

from hourmart.llm import warc
from hourmart.llm.common import Scratch


def pages():
    big = "<p>" + "x" * 200 + "</p>"
    return [
        (5, "http://a/1", big), (3, "http://a/2 b\n", big), (9, None, big), (None, "http://n", big),
        (4, "http://a/3", "short"), (1, "http://a/4", "short"), (2, None, None), (6, "", ""),
        (7, "http://ü", "é" * 99), (8, "http://b", "é" * 99), (10, "http://c", "y" * 99), (11, "http://c", "y" * 99),
        (12, "u", "\r\n\r\nWARC/1.1\r\n" * 40), (13, "u", "z" * 700_000), (7, "http://ü", "é" * 99),
    ]


def brute(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = min(same, default=None) if len(data) >= 100 else None
        again = first is not None and first != page
        out.append((page, len(data), sha256(data).hexdigest(), "revisit" if again else "response", first if again else None, True))
    return sorted(out, key=repr)


@pytest.mark.parametrize("file_bytes", [500, 1 << 26])
def test_round_trip(spark, file_bytes):
    frame = spark.createDataFrame(pages(), "page_id long, url string, html string").repartition(3)
    scratch = Scratch(spark, "test")
    files = scratch.store(warc.write_archives(frame, scratch.path("files"), file_bytes=file_bytes), "listed")
    assert files.agg({"records": "sum"}).first()[0] == len(pages())
    found = warc.read_archives(spark, files, 4)
    assert sorted((tuple(r)[:6] for r in found.collect()), key=repr) == brute(pages())
    texts = {r["page_id"]: r["payload"] for r in found.collect() if r["record_type"] == "response"}
    assert bytes(texts[13]).decode() == "z" * 700_000


def test_empty(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    scratch = Scratch(spark, "test")
    files = scratch.store(warc.write_archives(frame, scratch.path("files")), "listed")
    assert warc.read_archives(spark, files).collect() == []


def record(payload=b"hello", **fields):
    digest = sha256(payload).hexdigest()
    return warc.record_bytes(1, "http://a", payload, digest, len(payload), None)


@pytest.mark.parametrize("read_bytes", [1, 7, 1 << 18])
def test_sequence_of_members(read_bytes):
    data = b"".join(record(p) for p in (b"", b"a" * 5000, b"\r\n\r\n"))
    found = list(warc.read_records(io.BytesIO(data), read_bytes))
    assert [r.http()[1] for r in found] == [b"", b"a" * 5000, b"\r\n\r\n"]
    assert all(r.fields["warc-block-digest"] == warc._sha256(r.block) for r in found)


@pytest.mark.parametrize("fault", ["cut", "noise", "length", "other"])
def test_broken_files_raise(fault):
    import gzip

    good = record(b"x" * 1000)
    data = {
        "cut": good[:-20],
        "noise": good + b"no member",
        "length": gzip.compress(gzip.decompress(good)[:-4] + b"tail\r\n\r\n"),
        "other": gzip.compress(b"something else\r\n\r\n"),
    }[fault]
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data)))


def test_wrong_digest_is_told(spark, tmp_path):
    data = warc.record_bytes(1, "u", b"right", sha256(b"wrong").hexdigest(), 5, None)
    (tmp_path / "a.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "path string")
    assert [r["digest_ok"] for r in warc.read_archives(spark, files).collect()] == [False]
