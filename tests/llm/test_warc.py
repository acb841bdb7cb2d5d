import base64
import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from wattframe.llm import warc

SCHEMA = "page_id long, url string, html string, first string, salt string, sha1 string, path string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunked_framing(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload


def test_framing_with_extensions_and_damage():
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


@pytest.fixture(scope="module")
def page_rows():
    same = "<p>same ü</p>" * 20
    rows = [(5, "http://h/5", same), (3, "http://h/3", same), (9, None, same), (1, "u\r\nX: 1", "x" * 200_000)]
    rows += [(2, "", ""), (4, "http://h/4", None), (6, "http://h/6", "\r\n\r\nWARC/1.1\r\n\r\n"), (7, "http://h/7", "y" * 1000)]
    return rows + [(7, "http://h/7", "y" * 1000), (7, "http://h/7b", "other"), (None, "http://n", "alone"), (None, "n", same)]


def want(rows, least=0):
    out = []
    for i, _, html in rows:
        size = len((html or "").encode())
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(ids, default=None) if size >= least else None
        revisit = first is not None and first != i
        out.append((i, size, digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(repr, out))


@pytest.mark.parametrize("least", [0, 300])
def test_round_trip(spark, page_rows, least):
    pages = spark.createDataFrame([(*r, *"abcd") for r in page_rows], SCHEMA).repartition(3)
    files = warc.write_archives(pages, revisit_from=least, segment_bytes=700)
    got = warc.read_archives(files)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    rows = got.collect()
    assert sorted(repr(tuple(r[n] for n in names)) for r in rows) == want(page_rows, least)
    assert all(r.complete for r in rows) and len({r.record_id for r in rows}) == len(rows)
    html = {(i, (h or "").encode()) for i, _, h in page_rows}
    assert all((r.page_id, bytes(r.payload)) in html for r in rows if r.record_type == "response")
    assert sum(r.records for r in files.collect()) > len(rows) + 200_000 // 700


def test_a_lost_segment_is_told(spark, page_rows):
    pages = spark.createDataFrame([(*r, *"abcd") for r in page_rows], SCHEMA).coalesce(1)
    files = warc.write_archives(pages, segment_bytes=700).collect()
    more = [f.path for f in files if "-more" in f.path]
    assert more
    path = more[0].removeprefix("file:")
    records = list(warc.records_in(path))
    assert [r[0]["warc-type"] for r in records] == ["continuation"] * len(records)
    kept = [r for r in records if not r[0]["warc-segment-number"] == "3"]
    with open(path, "wb") as out:
        for fields, block in kept:
            head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
            import gzip

            out.write(gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"))
    read = warc.read_archives(spark.createDataFrame([(f.path,) for f in files], "path string")).collect()
    broken = [r for r in read if not r.complete]
    assert {r.page_id for r in broken} >= {1} and all(r.payload is None for r in broken)
    assert len(read) == len(page_rows)


def test_nothing(spark):
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], SCHEMA))).collect() == []


def test_records_are_standard(spark, page_rows):
    pages = spark.createDataFrame([(*r, *"abcd") for r in page_rows], SCHEMA)
    for f in warc.write_archives(pages, segment_bytes=700).collect():
        for fields, block in warc.records_in(f.path.removeprefix("file:")):
            assert {"warc-type", "warc-record-id", "warc-date", "content-length"} <= fields.keys()
            assert re.fullmatch(r"<urn:[^\s<>]+>", fields["warc-record-id"]) and len(block) == int(fields["content-length"])
