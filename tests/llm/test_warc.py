import base64
import gzip
import hashlib

import pytest

from quillgrid.llm import warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc(version, records):
    about = f"{version} 0 test\n{' '.join(warc.ARC_FIELDS[version])}\n".encode()
    out = f"filedesc://a.arc 0.0.0.0 2001 text/plain {len(about)}\n".encode() + about + b"\n"
    for url, date, mime, block in records:
        line = f"{url} 1.2.3.4 {date} {mime}" + (" 200 - - 0 a.arc" if version == "2" else "")
        out += f"{line} {len(block)}\n".encode() + block + b"\n"
    return out


def archives(spark, *pairs):
    return spark.createDataFrame([(n, bytearray(c) if c is not None else None) for n, c in pairs], "path string, content binary")


BODY = b"<p>WARC/1.1\r\n\r\nhttp://x 1.1.1.1 2001 a 5\n\n</p>"
RECORDS = [
    ("http://x/1", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n" + BODY),
    ("dns:x", "20010203", "text/dns", b"1.2.3.4"), ("http://x/2", "bad", "text/html", b"HTTP/1.0 404 No"), ("http://x/3", "2001", "a/b", b""),
]


@pytest.mark.parametrize("version", ["1", "2"])
def test_conversion_of_both_versions(spark, version):
    data = arc(version, RECORDS)
    found = warc.convert_arc(archives(spark, ("a.arc", data), ("b.arc.gz", gzip.compress(data[:90]) + gzip.compress(data[90:])), ("c", None), ("d", b"")))
    rows = [r for r in found.collect() if r.archive == "a.arc"]
    assert found.count() == 10 and len({r.record_id for r in found.collect()}) == 10
    assert [(r.record_type, r.uri, r.date) for r in rows[1:]] == [
        ("response", "http://x/1", "2001-02-03T04:05:06Z"), ("resource", "dns:x", "2001-02-03T00:00:00Z"),
        ("resource", "http://x/2", "1970-01-01T00:00:00Z"), ("resource", "http://x/3", "2001-01-01T00:00:00Z")]
    assert rows[0].record_type == "warcinfo" and bytes(rows[1].payload) == BODY and rows[1].http.endswith("A: b\r\n\r\n")
    assert rows[1].payload_digest == digest(BODY) and rows[1].block_digest == digest(RECORDS[0][3]) and rows[4].payload_bytes == 0


@pytest.mark.parametrize("damage", [lambda d: d[:-20], lambda d: d + b"http://y 1.2.3.4 x\n", lambda d: d.replace(b"1 0 test", b"7 0 test")])
def test_damage_stops(spark, damage):
    with pytest.raises(Exception, match="a.arc"):
        warc.convert_arc(archives(spark, ("a.arc", damage(arc("1", RECORDS))))).collect()


def test_pages_there_and_back(spark, tmp_path):
    html = [BODY.decode(), None, "", BODY.decode(), "é\r\n\r\n" * 50_000, "", "one", "WARC/1.1\r\n"]
    pages = spark.createDataFrame([(10 - i, "http://x/a b\n" if i else None, h) for i, h in enumerate(html)], "page_id long, url string, html string")
    records = warc.convert_arc(warc.pack_arc(pages.repartition(3), "page_id", "url", "html", size=200)).where("record_type <> 'warcinfo'")
    from pyspark.sql import functions as F

    records = records.withColumn("page_id", F.regexp_extract("http", r"X-Record: (\d+)", 1).cast("long"))
    path = str(tmp_path / "out")
    warc.write_warc(warc.revisits(records, "page_id"), path)
    back = {r.page_id: r for r in warc.read_warc(spark, path).withColumn("page_id", F.regexp_extract("http", r"X-Record: (\d+)", 1).cast("long")).collect()}
    first = {}
    for i in sorted(range(len(html)), key=lambda i: 10 - i):
        first.setdefault(html[i] or "", 10 - i)
    for i, h in enumerate(html):
        r, raw = back[10 - i], (h or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), digest(raw))
        if first[h or ""] == 10 - i:
            assert r.record_type == "response" and bytes(r.payload) == raw and r.refers_to is None
        else:
            assert r.record_type == "revisit" and bytes(r.payload) == b"" and r.refers_to == back[first[h or ""]].record_id
    larger = {r.page_id for r in warc.revisits(records, "page_id", at_least=1).where("refers_to IS NOT NULL").collect()}
    assert larger == {10}


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    records = warc.convert_arc(warc.pack_arc(none, "page_id", "url", "html"))
    assert records.count() == 0
    warc.write_warc(warc.revisits(records, "offset"), str(tmp_path / "o"))
    assert warc.read_warc(spark, str(tmp_path / "o")).count() == 0


def test_the_query_as_registered(spark, tmp_path):
    from quillgrid.llm.queries import QUERIES

    html = {7: "a", 3: "a", 9: None, 2: "", 5: "é" * 1000, 8: "a", 1: "<p>b</p>"}
    spark.createDataFrame([(i, f"http://x/{i}", h) for i, h in html.items()], "page_id long, url string, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["op5_warc"](spark, str(tmp_path))
    assert set(found.columns) == {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"}
    first = {}
    for i in sorted(html):
        first.setdefault(html[i] or "", i)
    want = {
        i: (len((h or "").encode()), digest((h or "").encode()), "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""])
        for i, h in html.items()
    }
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()} == want
