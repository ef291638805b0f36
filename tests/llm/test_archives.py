"""ARC to WARC: formats by hand, round trips through files, odd pages."""

import hashlib

import pytest

from basketlens.llm import warc

PAGES = "page_id long, url string, html string"


def record(url="http://a/", body=b"hi", mime="text/html"):
    return warc.ArcRecord(url, "1.2.3.4", "20240102030405", mime, 200, b"HTTP/1.1 200 OK\r\nX-Page-Id: 7\r\n\r\n" + body)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip_by_declared_lengths(version):
    tricky = b"WARC/1.1\r\n\r\n\nhttp://x 1.2.3.4 20240102030405 text/html 5\nabcde\n\n" + bytes(range(256))
    records = [record(), record("http://b/", tricky), record("http://c/", b"")]
    data = warc.arc_file("x.arc", version, records)
    assert [(r.url, r.date, r.block) for r in warc.read_arc(data)] == [(r.url, r.date, r.block) for r in records]
    assert data.startswith(b"filedesc://x.arc ")


def test_header_lines_of_both_versions():
    one, two = (warc.arc_file("x.arc", v, [record()]).decode() for v in (1, 2))
    assert "http://a/ 1.2.3.4 20240102030405 text/html 35\n" in one
    offset = two.index("http://a/")
    assert f"http://a/ 1.2.3.4 20240102030405 text/html 200 - - {offset} x.arc 35\n" in two
    with pytest.raises(ValueError):
        list(warc.read_arc(one.replace(" 35\n", " 99\n").encode()))
    with pytest.raises(ValueError):
        list(warc.read_arc(two.replace(" 200 - - ", " 200 - ", 2).encode()))


def test_warc_record_fields():
    data = warc.warc_record(record()) + warc.END.encode() + warc.warc_record(record(), ("3", "http://z/", "20240101000000", "d")) + warc.END.encode()
    (a, block), (b, head) = warc.read_warc(data)
    assert a["WARC-Type"] == "response" and a["WARC-Date"] == "2024-01-02T03:04:05Z" and block.endswith(b"hi")
    assert b["WARC-Type"] == "revisit" and head.endswith(b"\r\n\r\n") and b["WARC-Refers-To-Date"] == "2024-01-01T00:00:00Z"
    assert a["WARC-Record-ID"].startswith("<urn:uuid:") and a["WARC-Record-ID"] != b["WARC-Record-ID"] != b["WARC-Refers-To"]
    with pytest.raises(ValueError):
        list(warc.read_warc(data[:-2]))


def test_pages_through_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3_000)
    long = "é<p>" * 60
    rows = [(5, "http://a/ b\n", long), (3, None, long), (9, "", long), (4, "http://x", "short"), (6, "http://x", "short"), (7, "u", None),
            (8, "u", ""), (10, "u", "x" * 20_000), (11, "u", "\r\n\r\nWARC/1.1\r\n" * 30), (None, "u", long), (5, "http://a/ b\n", long), (12, "u", "y" * 100)]
    found = warc.through_archives(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert len(found) == len(rows)
    assert [(r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found if r["page_id"] is None] == [("response", None, len(long.encode()))]
    for r in (r for r in found if r["page_id"] is not None):
        html = next(h for i, _, h in rows if i == r["page_id"]) or ""
        assert r["payload_bytes"] == len(html.encode()) and r["payload_digest"] == hashlib.sha256(html.encode()).hexdigest()
    kinds = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in found}
    assert kinds[3] == ("response", None) and kinds[5] == ("revisit", 3) and kinds[9] == ("revisit", 3)
    assert all(kinds[i] == ("response", None) for i in (4, 6, 7, 8, 10, 11, 12))


def test_no_pages(spark):
    assert warc.through_archives(spark.createDataFrame([], PAGES)).count() == 0


def test_one_id_with_several_payloads(spark):
    p, q = "p" * 150, "q" * 150
    rows = [(1, "u", p), (2, "u", p), (2, "u", q), (3, "u", q), (4, "u", "z" * 150), (None, "u", p)]
    found = warc.through_archives(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    key = lambda r: (r[0] or 0, r[1])
    assert sorted([(r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found], key=key) == sorted([
        (1, sha(p), "response", None), (2, sha(p), "revisit", 1), (2, sha(q), "response", None), (3, sha(q), "revisit", 2),
        (4, sha("z" * 150), "response", None), (None, sha(p), "response", None)], key=key)
    assert len({r["record_id"] for r in found}) == len(rows)


def test_a_revisit_names_its_response(spark):
    rows = [(i, "http://same/", "x" * 200) for i in range(1, 5)]
    path = warc.scratch_path(spark, "test-warc")
    warc.convert(warc.pages_to_arc(spark.createDataFrame(rows, PAGES).repartition(2)), path)
    import gzip

    files = spark.read.format("binaryFile").load(path).select("content").collect()
    records = [f for x in files for f, _ in warc.read_warc(gzip.decompress(bytes(x["content"]))) if f["WARC-Type"] != "warcinfo"]
    response = [f["WARC-Record-ID"] for f in records if f["WARC-Type"] == "response"]
    again = [f for f in records if f["WARC-Type"] == "revisit"]
    assert len(response) == 1 and len(again) == 3 and {f["WARC-Refers-To"] for f in again} == set(response)
    assert len({f["WARC-Record-ID"] for f in records}) == 4
