"""WARC archives of pages: written with revisits, segments and chunked framing, and read back.

Writing. A page becomes a `response` record: HTTP headers and its payload (the html in UTF-8) in chunked transfer
framing. Of equal payloads of at least `REVISIT_BYTES` bytes the one with the smallest page_id is written, the others
become `revisit` records that name it. A block longer than `segment_bytes` is cut: its first part stays in the
response record with segment number 1, each further part is a `continuation` record that names its origin and its number,
the last one with the total length. Archives are files of whole records, gzip as a whole.

Reading. Files are parsed in their tasks. Whole records are decoded where they lie. Segments alone are shuffled: they are
grouped by their origin, ordered by number, checked for gaps and against the total length, joined, and freed from
the chunked framing. Every decoded payload is hashed and compared with the digest its record declares; what does not
add up is named in `problem`, and such a record has no payload.

A revisit finds its response by record id. Both lookups (payload digest when writing, record id when reading) may
have a third of all rows on one key, so they are salted.

Defined results: a null html is an empty payload; a null page_id or url is left out of the header and comes back null.
Rows with the smallest page_id of their payload are all responses; a row without page_id revisits one that has it. Repeated
rows are records of one id: equal segments are counted, not collected, and the record comes back as often as it was
written. Line breaks in a url are written as %0D and %0A. Empty tables make archives without records and read
as no rows.
"""

import gzip
import hashlib
import io
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import map_rows, salted_lookup
from tillcast.session import cut_lineage, shared_folder

REVISIT_BYTES = 100
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
RECORDS_PER_FILE = 4_000
WARC_DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = b"WARC/1.1"
BETWEEN = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
# What one part of a record is, on the way to its reassembly.
_PART = {
    "record_id": "string", "record_type": "string", "page_id": "long", "url": "string", "declared": "string",
    "refers_to_id": "string", "segment": "int", "total": "long", "block": "binary",
}
_DECODED = {
    "record_id": "string", "record_type": "string", "page_id": "long", "url": "string", "refers_to_id": "string",
    "payload_bytes": "long", "payload_digest": "string", "problem": "string", "copies": "long",
}


def record_id(*parts) -> str:
    """A URN that depends on what is recorded, so that a repeated task writes the same one."""
    name = hashlib.sha256("\0".join("" if p is None else str(p) for p in parts).encode()).hexdigest()
    return f"<urn:uuid:{name[:8]}-{name[8:12]}-{name[12:16]}-{name[16:20]}-{name[20:32]}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += (b"%x\r\n" % len(part), part, b"\r\n")
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def dechunked(body: bytes) -> bytes:
    """The content of chunked framing; extensions and trailers are allowed. Broken framing is a ValueError."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without size")
        digits = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", digits):
            raise ValueError("chunk size is no number")
        size, at = int(digits, 16), end + 2
        if size == 0:
            return b"".join(out)
        out.append(body[at : at + size])
        at += size + 2
        if body[at - 2 : at] != b"\r\n":
            raise ValueError("chunk is shorter than its size")


def http_payload(block: bytes) -> bytes:
    """Body of an HTTP response without its transfer framing."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("HTTP headers do not end")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and b"chunked" in value.lower():
            return dechunked(body)
    return body


def _head(fields) -> bytes:
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in fields if value is not None), b"", b""]
    return b"\r\n".join(lines)


def page_records(page_id, url, payload, digest, first_id, first_url, segment_bytes, chunk_bytes, date):
    """The records of a page as bytes; with `first_id` it revisits that page's record."""
    url = url and url.replace("\r", "%0D").replace("\n", "%0A")
    own = record_id(page_id, url, digest)
    shared = [
        ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", url), ("Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    if first_id is not None:
        first_url = first_url and first_url.replace("\r", "%0D").replace("\n", "%0A")
        fields = [
            ("WARC-Type", "revisit"), *shared, ("WARC-Refers-To", record_id(first_id, first_url, digest)),
            ("WARC-Refers-To-Target-URI", first_url), ("WARC-Profile", PROFILE), ("Content-Length", len(HTTP_HEAD)),
        ]
        return [_head(fields) + HTTP_HEAD]
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    number = 1 if len(parts) > 1 else None
    out = [_head([("WARC-Type", "response"), *shared, ("WARC-Segment-Number", number), ("Content-Length", len(parts[0]))]) + parts[0]]
    for number, part in enumerate(parts[1:], 2):
        fields = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(own, number)), ("WARC-Date", date),
            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number),
            ("WARC-Segment-Total-Length", len(block) if number == len(parts) else None), ("Content-Length", len(part)),
        ]
        out.append(_head(fields) + part)
    return out


def _payloads(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
                   records_per_file: int = RECORDS_PER_FILE, date: str = WARC_DATE) -> None:
    """Writes the archives of `pages` (page_id, url, html) below `path`. What is known of equal payloads (digest, first
    page) is a table of its own beside them, so that Spark knows its size before it joins."""
    rows = _payloads(pages)
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url"))
    seen = rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.count(F.lit(1)).alias("held"), first.alias("first"))
    equal = shared_folder(pages.sparkSession, "equal-payloads")
    seen.filter("held > 1").select(
        "digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")
    ).write.parquet(equal)
    firsts = pages.sparkSession.read.parquet(equal)
    marked = salted_lookup(rows, firsts, "digest")
    again = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    marked = marked.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "digest",
        F.when(again, F.col("first_id")).alias("first_id"), "first_url",
    )

    def make():
        records = page_records
        return lambda *row: ((r,) for r in records(*row, segment_bytes, chunk_bytes, date))

    # The text writer puts out a value's bytes as they are, and the separator is what ends a WARC record.
    map_rows(marked, make, record="binary").select(F.col("record").cast("string").alias("value")).write.options(
        lineSep=BETWEEN, compression="gzip", maxRecordsPerFile=records_per_file
    ).text(path)


def records_of(stream):
    """(header fields by lower-case name, block) of every record of an archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields, last = {}, None
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and last:
                fields[last] += " " + line.decode().strip()
            else:
                last, _, value = line.decode().partition(":")
                last = last.strip().lower()
                fields[last] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("archive ends inside a record")
        yield fields, block


def archive_parts(content):
    """Parts of responses, resources, revisits and continuations of an archive's bytes, as rows of _PART; segment 0 is
    a whole record. Other records, such as an archive's own description, are passed over."""
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    for fields, block in records_of(stream):
        kind, get = fields.get("warc-type"), fields.get
        if kind not in ("response", "resource", "revisit", "continuation"):
            continue
        page = get("page-id")
        total, segment = get("warc-segment-total-length"), get("warc-segment-number")
        yield (
            get("warc-segment-origin-id") if kind == "continuation" else get("warc-record-id"), kind,
            int(page) if page else None, get("warc-target-uri"), (get("warc-payload-digest") or "").removeprefix("sha256:") or None,
            get("warc-refers-to"), int(segment or 0), int(total) if total else None, block,
        )


def joined_segments(segments) -> bytes:
    """Block of [(segment, total, block, times)], ordered by number. What does not add up is a ValueError."""
    numbers = [s[0] for s in segments]
    if numbers != list(range(1, len(segments) + 1)):
        raise ValueError("segments missing, or different ones of one number")
    if len({s[3] for s in segments}) > 1:
        raise ValueError("segments occur differently often")
    if segments[-1][1] is None:
        raise ValueError("last segment missing")
    block = b"".join(s[2] for s in segments)
    if len(block) != segments[-1][1]:
        raise ValueError("segments do not add up to the total length")
    return block


def decoded(identifier, kind, page_id, url, declared, refers_to, segments, payloads):
    """A row of _DECODED, with the payload behind it if wanted. `segments` as for `joined_segments`; a whole record is
    one with number 0."""
    payload = problem = digest = None
    copies = max(s[3] for s in segments)
    try:
        block = segments[0][2] if segments[0][0] == 0 else joined_segments(segments)
        if kind == "continuation":
            raise ValueError("origin of the segments missing")
        if kind == "response":
            payload = http_payload(block)
        elif kind == "resource":
            payload = block
        if payload is not None:
            digest = hashlib.sha256(payload).hexdigest()
            if declared and declared != digest:
                raise ValueError("payload differs from its digest")
        else:
            digest = declared
    except ValueError as error:
        payload = digest = None
        problem = str(error)
    size = None if payload is None else len(payload)
    row = (identifier, kind, page_id, url, refers_to, size, digest, problem, copies)
    return (*row, payload) if payloads else row


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row a record: record_id, record_type, page_id, url, refers_to_id, payload_bytes, payload_digest, problem, and the
    payload if wanted. A revisit has the digest that it declares and no payload of its own. Unsegmented records
    stay in the task that parsed them."""
    files = spark.read.format("binaryFile").load(path).select("content")
    columns = _DECODED | ({"payload": "binary"} if payloads else {})

    def parse(whole: bool):
        def make():
            parts, decode = archive_parts, decoded

            def each(content):
                for part in parts(content):
                    *known, segment, total, block = part
                    if whole and not segment:
                        yield decode(*known, [(0, total, block, 1)], payloads)
                    elif segment and not whole:
                        yield part

            return each

        return make

    unsegmented = map_rows(files, parse(True), **columns)
    segments = map_rows(files, parse(False), **_PART)
    # Equal segments of records written several times are counted in their tasks first.
    once = segments.groupBy(*_PART).agg(F.count(F.lit(1)).alias("times"))
    kind = F.coalesce(F.max(F.when(F.col("record_type") != "continuation", F.col("record_type"))), F.lit("continuation"))
    grouped = once.groupBy("record_id").agg(
        kind.alias("record_type"), *[F.max(c).alias(c) for c in ("page_id", "url", "declared", "refers_to_id")],
        F.array_sort(F.collect_list(F.struct("segment", "total", "block", "times"))).alias("segments"),
    )

    def assemble():
        decode = decoded
        return lambda *row: (decode(*row[:-1], [tuple(s.values()) for s in row[-1]], payloads),)

    both = unsegmented.union(map_rows(grouped, assemble, **columns))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return both.withColumn("copy", copies).drop("copies", "copy")


def archive_index(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, problem of every record, revisits with what
    their response has."""
    records = cut_lineage(read_archives(spark, path, payloads=False))
    revisits = records.filter("record_type = 'revisit'")
    wanted = revisits.select(F.col("refers_to_id").alias("record_id")).distinct()
    targets = records.filter("record_type <> 'revisit'").join(wanted, "record_id", "left_semi").groupBy(
        F.col("record_id").alias("refers_to_id")
    ).agg(
        F.min("page_id").alias("refers_to"), F.max("payload_bytes").alias("target_bytes"),
        F.max("payload_digest").alias("target_digest"),
    )
    found = salted_lookup(revisits, cut_lineage(targets), "refers_to_id")
    problem = F.when(F.col("target_digest").isNull(), "response of the revisit missing").when(
        F.col("target_digest") != F.col("payload_digest"), "revisit differs from its response"
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "problem"]
    resolved = found.withColumns({
        "payload_bytes": F.col("target_bytes"), "payload_digest": F.col("target_digest"),
        "problem": F.coalesce("problem", problem),
    }).select(*columns)
    return records.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long")).select(*columns).union(resolved)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes the archives of `pages` to the shared folder and returns the index read back from them."""
    path = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return archive_index(pages.sparkSession, path)
