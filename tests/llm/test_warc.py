"""WARC archives: exact round trips, revisits beside brute force, damaged and foreign records."""

import glob
import gzip
import hashlib
import io
import random

import pytest

from tillcast.llm import warc

from conftest_llm import CLASHES, SF, values


def brute(rows):
    """Contract columns of (page_id, html) rows."""
    low = {}
    for page_id, html in rows:
        data = (html or "").encode()
        if page_id is not None:
            low[data] = min(page_id, low.get(data, page_id))
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and data in low and low[data] != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", low[data] if again else None))
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


@pytest.fixture(scope="module")
def edge_pages(spark):
    dice = random.Random(3)
    text = "Seite mit Größe und \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n " + "wort " * 30
    long = "".join(chr(dice.choice([10, 13, 48, 97, 228, 8364, 128512])) for _ in range(150_000))
    rows = [
        (7, "http://a.example/\r\nx: y", text), (3, "http://b.example", text), (9, None, text), (None, "http://c.example", text),
        (1, "u", None), (2, "u", ""), (4, "u", "x" * 99), (5, "u", "x" * 99), (6, "u", "x" * 100), (8, "u", "x" * 100),
        (10, "ü", long), (11, "ü", long), (12, "v", long + "!"), (12, "v", long + "!"), (12, "v", long + "!"), (12, "other", long + "!"),
        (None, None, None), (None, "w", "nobody has an id here " * 9), (None, "w", "nobody has an id here " * 9), (8, "u", "x" * 100),
    ]
    from pyspark.sql import functions as F

    clashes = [*CLASHES, "salt", "payload", "digest", "first_id", "held", "copies", "record"]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return rows, frame.select("*", *[F.lit("clash").alias(c) for c in dict.fromkeys(clashes)])


@pytest.mark.parametrize("options", [{}, {"segment_bytes": 64, "chunk_bytes": 10, "records_per_file": 3}, {"segment_bytes": 5_000, "chunk_bytes": 1}])
def test_round_trip_beside_brute_force(spark, edge_pages, options):
    rows, pages = edge_pages
    if options.get("segment_bytes") == 64:
        rows, pages = [r for r in rows if len(r[2] or "") < 1000], pages.filter("html is null or length(html) < 1000")
    index = warc.round_trip(pages, **options)
    assert values(index, *COLUMNS) == brute([(r[0], r[2]) for r in rows])
    assert index.filter("problem is not null").count() == 0


def test_payloads_come_back(spark, edge_pages, tmp_path):
    rows, pages = edge_pages
    warc.write_archives(pages, f"{tmp_path}/w", segment_bytes=1_000)
    read = warc.read_archives(spark, f"{tmp_path}/w")
    got = sorted((r.page_id or -1, bytes(r.payload)) for r in read.filter("record_type = 'response'").collect())
    low = {}
    for page_id, _, html in rows:
        if page_id is not None:
            low[html] = min(page_id, low.get(html, page_id))
    want = [
        (page_id or -1, (html or "").encode()) for page_id, _, html in rows
        if len((html or "").encode()) < 100 or html not in low or low[html] == page_id
    ]
    assert got == sorted(want)
    urls = {r.url for r in read.collect()}
    assert "http://a.example/%0D%0Ax: y" in urls and None in urls and "ü" in urls


def test_archives_are_warc_files(spark, tmp_path):
    pages = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet")
    warc.write_archives(pages, f"{tmp_path}/w", records_per_file=50)
    files = glob.glob(f"{tmp_path}/w/*.gz")
    assert len(files) > 1
    segmented = set()
    for name in files:
        with gzip.open(name) as stream:
            data = stream.read()
        for fields, block in warc.records_of(io.BytesIO(data)):
            assert len(block) <= warc.SEGMENT_BYTES
            assert {"warc-type", "warc-record-id", "warc-date", "content-length"} <= set(fields)
            if fields["warc-type"] == "continuation":
                segmented.add(fields["warc-segment-origin-id"])
        assert data.endswith(b"\r\n\r\n") or not data
    html = {r.page_id: r.html.encode() for r in pages.collect()}
    read = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, f"{tmp_path}/w").collect()}
    assert read == html and segmented


@pytest.mark.parametrize("data", [b"", b"a", bytes(range(256)) * 40, b"0\r\n\r\n", b"\r\n" * 50])
@pytest.mark.parametrize("size", [1, 7, 4096])
def test_chunked_framing(data, size):
    assert warc.dechunked(warc.chunked(data, size)) == data


def test_foreign_chunked_framing():
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n00A \r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n") == b"abc0123456789"
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi") == b"hi"
    assert warc.http_payload(b"HTTP/1.1 200 OK\r\ntransfer-encoding: gzip, CHUNKED\r\n\r\n1\r\nx\r\n0\r\n\r\n") == b"x"


@pytest.mark.parametrize("body", [b"", b"zz\r\nab", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc", b"-1\r\n\r\n", b"3\r\nabc\r\n"])
def test_broken_chunked_framing(body):
    with pytest.raises(ValueError):
        warc.dechunked(body)


def _archive(path, records, name="x.warc"):
    path.mkdir(exist_ok=True)
    (path / name).write_bytes(b"".join(r + b"\r\n\r\n" for r in records))


def _records(page_id, payload, segment=40):
    digest = hashlib.sha256(payload).hexdigest()
    return warc.page_records(page_id, "http://x", payload, digest, None, None, segment, 16, warc.WARC_DATE)


def test_segments_in_any_order_and_file(spark, tmp_path):
    records = [r for i in range(20) for r in _records(i, f"page {i} ".encode() * (10 + i))]
    random.Random(1).shuffle(records)
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 3\r\n\r\nabc"
    _archive(tmp_path / "w", [info, *records[::2]], "a.warc")  # not compressed
    (tmp_path / "w" / "b.warc.gz").write_bytes(b"".join(gzip.compress(r + b"\r\n\r\n") for r in records[1::2]))  # a member a record
    read = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert {r.page_id: bytes(r.payload) for r in read} == {i: f"page {i} ".encode() * (10 + i) for i in range(20)}
    assert not any(r.problem for r in read)


def test_damage_is_named(spark, tmp_path):
    page = lambda i: _records(i, f"content of page {i} ".encode() * 8)
    second, third, fourth, fifth, sixth = page(2), page(3), page(4), page(5), page(6)
    wrong = [r.replace(b"Total-Length: ", b"Total-Length: 9") for r in third]
    changed = [r.replace(b"conte", b"Conte") for r in fifth]
    lost = warc.page_records(7, "u", b"", "0" * 64, 99, "u", 40, 16, warc.WARC_DATE)  # a revisit of nothing
    _archive(tmp_path / "w", [*page(1), *second[:1], *second[2:], *wrong, *fourth[1:], *changed, *sixth[:-1], *lost])
    index = {r.page_id: r for r in warc.archive_index(spark, str(tmp_path / "w")).collect()}
    assert index[1].problem is None and index[1].payload_bytes == 8 * len("content of page 1 ")
    for number, words in ((2, "missing"), (3, "total"), (5, "digest"), (6, "last"), (7, "response")):
        assert words in index[number].problem and index[number].payload_bytes is None, number
    assert "origin" in index[None].problem or "missing" in index[None].problem  # page 4 without its first segment


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string, salt string")
    assert warc.round_trip(none).count() == 0


def test_many_rows_of_one_payload(spark):
    """A third of all rows revisit one response, a third is one repeated row."""
    body, own = "the same page for everyone " * 700, "repeated row " * 2_000
    rows = [(i, f"http://{i}", body) for i in range(300)] + [(1000, "r", own)] * 300 + [(2000 + i, "o", f"own {i} " * 30) for i in range(300)]
    index = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert values(index, *COLUMNS) == brute([(r[0], r[2]) for r in rows])
