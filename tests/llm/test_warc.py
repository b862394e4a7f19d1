import base64
import gzip
import hashlib
import io

import pytest
from casemill.llm import warc
from casemill.session import scratch_path

PAGES = "page_id long, url string, html string"


def sha(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def expected(rows, min_bytes=0):
    largest = {}
    for i, _, h in rows:
        b = (h or "").encode()
        largest.setdefault(b, []).append(-1 if i is None else i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        top = max(largest[b])
        revisit = len(b) >= min_bytes and (-1 if i is None else i) != top
        out.append((-1 if i is None else i, len(b), sha(b), "revisit" if revisit else "response", top if revisit else -1))
    return sorted(out)


def run(spark, rows, min_bytes=0, archive_bytes=4 << 20):
    path = scratch_path(spark, "warc-test")
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS uri", "'x' AS payload_digest")
    warc.convert_to_files(warc.export_arc(df, archive_bytes=archive_bytes), path, min_bytes=min_bytes)
    n = lambda x: -1 if x is None else x
    got = warc.read_warc(spark, path).collect()
    return sorted((n(r.key), r.payload_bytes, r.payload_digest, r.record_type, n(r.refers_to)) for r in got), got, path


ROWS = [(1, "http://a/", "same"), (2, "http://b/ x", "same"), (3, None, None), (4, "", ""), (5, "dns:a", "WARC/1.1\r\n\r\n\n\nétat"),
        (6, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (None, "http://n/", "same"), (9, "http://big/", "é" * 400_000),
        (7, "http://c/ ", "same"), (8, "x" * 5000, "filedesc://x 1\n")]


def test_round_trip_and_revisits(spark):
    got, rows, _ = run(spark, ROWS)
    assert got == expected(ROWS)
    ids = {r.rec_id: r.key for r in rows}
    assert all(ids[r.refers_to_id] == r.refers_to for r in rows if r.record_type == "revisit")


def test_minimum_size_and_small_archives(spark):
    got, _, path = run(spark, ROWS, min_bytes=5, archive_bytes=1)
    assert got == expected(ROWS, 5)
    for r in spark.read.format("binaryFile").load(path).collect():
        raw = bytes(r.content)
        first = next(warc.warc_records(io.BytesIO(gzip.decompress(raw))))[0]
        assert first["warc-type"] == "warcinfo"


def test_empty_table_and_repeated_rows(spark):
    assert run(spark, [])[0] == []
    got = run(spark, [(1, "u", "z"), (1, "u", "z")])[0]
    assert sorted(x[3] for x in got) == ["response", "revisit"] and {x[4] for x in got} == {-1, 1}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(spark, version):
    made = warc.arc_archive("x.arc", version, [("http://a b/", "20010203040506", "text/html", b"HTTP/1.0 200 OK\r\n\r\nhi\n"),
                                               ("dns:a.org", "2001", "text/dns", b"\n20010203\n")])
    recs = list(warc.arc_records(made))
    assert [r.fields["URL"] for r in recs] == ["http://a b/", "dns:a.org"] and recs[1].content == b"\n20010203\n"
    assert list(warc.arc_records(gzip.compress(made))) == recs
    out = warc.convert(spark.createDataFrame([("x.arc", bytearray(made))], "path string, content binary")).collect()
    assert [(r.date, r.payload_bytes, r.payload_digest) for r in out] == [
        ("2001-02-03T04:05:06Z", 3, sha(b"hi\n")), ("2001-01-01T00:00:00Z", 10, sha(b"\n20010203\n"))]
    kinds = [next(warc.warc_records(io.BytesIO(gzip.decompress(r.member))))[0] for r in out]
    assert [(k["warc-type"], k["content-type"]) for k in kinds] == [
        ("response", "application/http; msgtype=response"), ("resource", "text/dns")]
    assert len({r.rec_id for r in out}) == 2
    with pytest.raises(ValueError):
        list(warc.arc_records(made[:-8]))


def test_members_end_in_zero_even_when_large():
    big = b"a" * ((16 << 20) + 5)
    made = warc.gzip_member(big)
    assert made[-1] == 0 and gzip.decompress(made) == big
