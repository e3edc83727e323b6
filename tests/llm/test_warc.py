"""WARC archives and the capture index against plain versions."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from careweave.llm import queries, warc

PAGES = "page_id long, url string, html string, key string, file string, digest string"


def plain(rows, min_bytes=0):
    """(page_id, bytes, digest, type, refers_to) of every row."""
    out = []
    for i, url, html, *_ in rows:
        data = (html or "").encode()
        same = [(r[0] is None, r[0] or 0, r[1] or "", r[0]) for r in rows if (r[2] or "") == (html or "")]
        first = min(same, key=lambda x: x[:3])
        response = len(data) < min_bytes or (i is None, i or 0, url or "") == first[:3]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if response else "revisit", None if response else first[3]))
    return sorted(out, key=repr)


def as_rows(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    rows = [(i, f"http://h{rng.randrange(9)}.example.com/{rng.randrange(40)}", f"<p>{rng.randrange(150)}</p>") for i in range(300)]
    rows += [(1000 + i, "http://hot.example.com/x", "<p>same</p>") for i in range(150)]
    rows += [(None, "http://a.b/c", "<p>7</p>"), (-3, None, None), (-2, None, ""), (7, "no scheme", "é" * 200_000),
             (8, "http://x y/\r\nWARC-Type: response\r\n\r\n", "a\r\n\r\nb"), (None, None, None),
             (9, "https://u@Www.Example.COM:81/Q?a=b#c", "WARC/1.1\r\n\r\n"), (10, "http://10.0.0.1/", "<p>ü</p>"),
             (11, "http://l/" + "z" * 5000, "x"), (12, "http://l/" + "z" * 5001, "y")]
    rows += [rows[0], rows[0], rows[310], (5, "http://other.example.com/", rows[5][2])]
    return [(*r, "clash", "clash", "clash") for r in rows]


@pytest.mark.parametrize("min_bytes", [0, 12])
def test_every_capture_is_found_and_read(spark, rows, min_bytes):
    assert as_rows(warc.archive(spark.createDataFrame(rows, PAGES), min_bytes)) == plain(rows, min_bytes)


def test_small_blocks_and_files(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, PAGES)
    index = warc.write(pages, block_lines=3, archive_bytes=2000, folder=str(tmp_path / "w"))
    assert index.captures.select("file").distinct().count() > 5
    assert index.shards.agg({"captures": "sum", "blocks": "sum"}).head()[0] == len(rows)
    got = warc.fetch(index, warc.lookup(index, warc.capture_ranges(pages)))
    assert as_rows(got) == plain(rows)
    texts = {(r.page_id, r.payload.decode()) for r in got.collect() if r.record_type == "response"}
    assert texts == {(r[0], r[2] or "") for r, p in zip(rows, [plain([x]) for x in rows])
                     if (r[0], "response") in {(q[0], q[3]) for q in plain(rows)}
                     and any(q[0] == r[0] and q[2] == p[0][2] and q[3] == "response" for q in plain(rows))}


def test_lookup_by_url_and_host(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, PAGES)
    index = warc.write(pages, block_lines=7, folder=str(tmp_path / "w"))

    def found(ranges):
        return sorted((r.page_id for r in warc.fetch(index, warc.lookup(
            index, warc.range_frame(spark, ranges))).collect()), key=repr)

    assert found([warc.captures_of("HTTP://hot.EXAMPLE.com/x#y".replace("HTTP", "http"))]) == sorted(
        (r[0] for r in rows if r[1] == "http://hot.example.com/x"), key=repr)
    assert found([warc.captures_of(None)]) == sorted((r[0] for r in rows if r[1] is None), key=repr)
    assert found(warc.captures_under("example.com")) == sorted(
        (r[0] for r in rows if "example.com" in (r[1] or "").lower()), key=repr)
    assert found(warc.captures_under("www.example.com")) == [9]
    assert found([warc.captures_of("http://nowhere/")]) == [] and found([(None, None), ("", "")]) == []
    assert found([("", "\U0010FFFF")]) == sorted((r[0] for r in rows), key=repr)


def test_records_are_gzip_members(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x"), (2, "http://b/", "x")], PAGES[:37]).coalesce(1)
    index = warc.write(pages, folder=str(tmp_path / "w"))
    r = index.captures.orderBy("offset").collect()
    data = (tmp_path / "w" / r[0].file).read_bytes()
    whole = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
    assert whole.count(b"WARC/1.1\r\n") == 2 and b"WARC-Type: revisit" in whole
    assert b"WARC-Refers-To: " + warc.record_id(1, "http://a/").encode() in whole
    second = gzip.decompress(data[r[1].offset:r[1].offset + r[1].length])
    assert second.startswith(b"WARC/1.1\r\nWARC-Type: revisit")


def test_damaged_record_is_an_error():
    record = warc.make_record(1, "http://a/", hashlib.sha1(b"good").hexdigest(), 4, b"good", None, "1970-01-01T00:00:00Z")
    assert warc.read_record(record)["payload"] == b"good"
    with pytest.raises(ValueError, match="damaged"):
        warc.read_record(record.replace(b"good", b"evil"))


def test_keys():
    assert warc.url_key("https://u@Www.Example.COM:81/Q?a=b#c") == "com,example,www:81)/Q?a=b"
    assert warc.url_key("http://10.0.0.1?x") == "10.0.0.1)?x" and warc.url_key(None) == "-"
    assert warc.url_key("a b") == ")a%20b"
    long = [warc.url_key("http://l/" + "z" * n) for n in (5000, 5001)]
    assert long[0] != long[1] and len(long[0]) < 1100
    ids = [-2**63, -1, 0, 5, 2**63 - 1]
    assert sorted(warc.capture_key("x", i) for i in ids) == [warc.capture_key("x", i) for i in ids]


def test_empty_table(spark, sf):
    pages = spark.createDataFrame([], PAGES)
    assert warc.archive(pages).count() == 0
    assert queries.op12_warc(spark, sf).columns == [
        "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
