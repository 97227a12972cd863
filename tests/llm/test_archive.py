"""ARC files to WARC and back."""

import gzip
import hashlib

import pytest

from glimmerdex.llm import archive as A

HTTP = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n"
RECORDS = [
    ("http://a.org/", "1.2.3.4", "20010203040506", "text/html", HTTP + b"<p>one\r\n\r\ntwo</p>\n"),
    ("http://b.org/x", "0.0.0.0", "2002", "text/html", HTTP),
    ("dns:c.org", "0.0.0.0", "20030101000000", "text/dns", b"20030101\nc.org. 1 IN A 1.2.3.4"),
    ("http://d.org/", "1.2.3.4", "20010203040506", "text/html", HTTP + b"<p>one\r\n\r\ntwo</p>\n"),
]


@pytest.mark.parametrize("version", [1, 2])
def test_both_versions_are_parsed_by_declared_lengths(version):
    data = A.arc_file("x.arc", RECORDS, version)
    got = list(A.parse_arc("x.arc", data))
    assert [(r.fields["URL"], r.fields["IP-address"], r.fields["Archive-date"], r.fields["Content-type"], r.block) for r in got] == RECORDS
    assert all(data[r.offset :].startswith(r.fields["URL"].encode()) for r in got)


def test_files_that_do_not_fit_are_errors():
    data = A.arc_file("x.arc", RECORDS)
    with pytest.raises(ValueError, match="x.arc.*cut short"):
        list(A.parse_arc("x.arc", data[:-10]))
    with pytest.raises(ValueError, match="does not fit"):
        list(A.parse_arc("x.arc", data + b"http://e.org/ 1 2\n"))
    with pytest.raises(ValueError, match="version"):
        list(A.parse_arc("x.arc", data.replace(b"1 0 archive", b"7 0 archive")))


def test_members_of_gzip_are_joined():
    assert A.inflated(gzip.compress(b"ab") + gzip.compress(b"c")) == b"abc"
    assert A.inflated(b"plain") == b"plain"


@pytest.mark.parametrize("version", [1, 2])
def test_conversion(spark, tmp_path, version):
    arcs = [("x.arc.gz", bytearray(gzip.compress(A.arc_file("x", RECORDS, version)))), ("y.arc", bytearray(A.arc_file("y", RECORDS[:1], version)))]
    arcs = spark.createDataFrame(arcs, "name string, content binary")
    A.write(arcs, str(tmp_path / "warc"))
    rows = {r["record_id"]: r.asDict() for r in A.read(spark, str(tmp_path / "warc")).collect()}
    assert len(rows) == len({*rows}) == 5
    by_uri = {}
    for r in rows.values():
        by_uri.setdefault(r["uri"], []).append(r)
    assert {r["record_type"] for r in by_uri["dns:c.org"]} == {"resource"}
    assert by_uri["http://b.org/x"][0]["date"] == "2002-00-00T00:00:00Z"
    equal = by_uri["http://a.org/"] + by_uri["http://d.org/"]
    assert sorted(r["record_type"] for r in equal) == ["response", "revisit", "revisit"]
    first = next(r for r in equal if r["record_type"] == "response")
    assert {r["refers_id"] for r in equal} == {None, first["record_id"]}
    assert bytes(first["payload"]) == b"<p>one\r\n\r\ntwo</p>\n"
    assert first["payload_digest"] == A.digest(b"<p>one\r\n\r\ntwo</p>\n")


def test_pages_there_and_back(spark, tmp_path, monkeypatch, shuffled_joins):
    monkeypatch.setattr(A, "ARC_BYTES", 3000)
    monkeypatch.setattr(A, "ARCS_PER_WARC", 2)
    pages = [(i, f"http://x.org/{i}", f"<p>{i % 7}</p>" * 40) for i in range(60)]
    pages += [(100, None, None), (101, "http://a b\nc/é", ""), (102, "", "é\r\n\r\nWARC/1.1\r\n"), (None, "n", "<p>1</p>" * 40), (3, "again", "<p>3</p>" * 40)]
    pages += [(200, "long", "z" * 500000)]
    table = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    arcs = A.written(A.pages_to_arc(table), "arc")
    assert arcs.count() > 4
    A.write(arcs, str(tmp_path / "warc"))
    got = A.resolved(A.read(spark, str(tmp_path / "warc"))).collect()
    assert len(got) == len(pages)
    first = {}
    for page_id, _, html in sorted((p for p in pages if p[0] is not None), key=lambda p: p[0]):
        first.setdefault(html or "", page_id)
    seen = set()
    for r in got:
        html = next(h or "" for p, _, h in pages if p == r["page_id"])
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html.encode()), A.digest(html.encode()))
        if r["record_type"] == "response":
            assert r["page_id"] == first[html] and html not in seen
            seen.add(html)
        else:
            assert r["refers_to"] == first[html]
    assert seen == set(first)


def test_digest():
    assert A.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ" and len(hashlib.sha1(b"").digest()) == 20
