"""WARC archives: a writer with payload revisits, and a splittable reader.

The reader cuts archives into byte ranges that tasks read on their own.  A task looks for
gzip magic in its range, takes a place for a member's start only if decoding it gives a WARC
header, owns the records that start in its range (the last may reach past its end), and goes
from each record's end to the next.  Archives need no index, and one large archive is read
by many tasks.

Of records with equal payloads of at least `least_revisit` bytes, the one of the smallest id
is a response and the others are revisits that refer to it, without payload.  Rows of one id
with one payload are all responses (or all revisits); a null id revisits if any other id
has the payload.  Null html is an empty payload, null urls are written as the record's urn.
A very long payload is held whole, one record at a time.
An empty table gives no archives and no rows.  Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .components import join_by_count
from .shared import fresh_path, parts, stored, table

LEAST_REVISIT = 100
ARCHIVE_BYTES, SPLIT_BYTES, READ_BYTES = 32 << 20, 8 << 20, 1 << 20
TASK_BYTES = 128 << 20  # of ranges that one task reads where there are more than enough of them
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, first: the id that a revisit refers to, else null)."""
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= least
    firsts = own.where(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("members")).where("members > 1")
    joined = join_by_count(own, firsts, "digest", own.count(), "left")  # a payload of a large share of all pages doesn't come into one task
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), F.octet_length("payload").cast("long").alias("size"), "digest", F.when(again, F.col("first")).alias("first"))


def _urn(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


def record(page: int | None, url: str | None, payload: bytes | None, size: int, digest: str, first: int | None, level: int = 3) -> bytes:
    kind = "response" if payload is not None else "revisit"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else _urn(page)[1:-1]
    headers = [("WARC-Type", kind), ("WARC-Record-ID", _urn(page)), ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(first))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _member(headers, http + (payload or b""), level)


def write_archives(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 3) -> DataFrame:
    """Write records (page_id, url, payload, size, digest, first) as archives under path; their list (uri, bytes, records)."""

    def run(batches):
        name, number = uuid.uuid4().hex, 0
        parts: list[bytes] = []

        def archive():
            uri = f"{path}/pages-{name}-{number:05d}.warc.gz"
            info = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}-{number}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", level)
            size = files.put(uri, info + b"".join(parts))
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([size], pa.int64()), pa.array([len(parts)], pa.int64())], ["uri", "bytes", "records"])

        held = 0
        for batch in batches:
            for page, url, payload, size, digest, first in zip(*(batch.column(i) for i in range(6))):
                parts.append(record(page.as_py(), url.as_py(), payload.as_py(), size.as_py(), digest.as_py(), first.as_py(), level))
                held += len(parts[-1])
                if held >= archive_bytes:
                    yield archive()
                    parts, held, number = [], 0, number + 1
        if parts:
            yield archive()

    return stored(records.select("page_id", "url", "payload", "size", "digest", "first").mapInArrow(run, "uri string, bytes long, records long"), "archives")


def _whole_member(src, at: int, limit: int) -> tuple[bytes, int] | None:
    """(content, where the member ends) of the gzip member at `at`, or None if it isn't one of a WARC record."""
    unpack, out, place = zlib.decompressobj(31), [], at
    start = b""
    while not unpack.eof:
        src.seek(place)
        data = src.read(min(READ_BYTES, limit - place))
        if not data:
            return None
        place += len(data)
        try:
            out.append(unpack.decompress(data))
        except zlib.error:
            return None
        if len(start) < 5:
            start = b"".join(out)[:5]
            if start != b"WARC/"[: len(start)]:
                return None
    return b"".join(out), place - len(unpack.unused_data)


def records_in(src, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, headers, block) of the records of an open archive that start in [start, end)."""
    place, window, base = start, b"", start
    while place < end:
        if not base <= place <= base + len(window) - len(MAGIC):
            src.seek(place)
            base, window = place, src.read(min(READ_BYTES, min(end + len(MAGIC) - 1, size) - place))
        found = window.find(MAGIC, place - base)
        if found < 0:
            place = base + max(1, len(window) - len(MAGIC) + 1)
            if base + len(window) >= min(end + len(MAGIC) - 1, size):
                return
            continue
        place = base + found
        if place >= end:
            return
        got = _whole_member(src, place, size)
        if got is None:
            place += 1
            continue
        content, after = got
        head, _, rest = content.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        if lines[0].startswith("WARC/1.") and headers.get("content-length", "").isdigit():
            yield place, headers, rest[: int(headers["content-length"])]
            place = after
        else:
            place += 1


def _page_of(urn: str) -> int | None:
    last = urn.strip("<>").rpartition(":")[2]
    return None if last == "null" else int(last)


def read_archives(archives: DataFrame, split_bytes: int = SPLIT_BYTES, keep_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of the page records of the listed archives (uri, bytes)."""

    def run(batches):
        import pyarrow.fs as pafs

        for batch in batches:
            for uri, size, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows = []
                fs, path = pafs.FileSystem.from_uri(uri)
                with fs.open_input_file(path) as src:
                    for _, headers, block in records_in(src, size, start, min(start + split_bytes, size)):
                        if (kind := headers.get("warc-type")) not in ("response", "revisit"):
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        if kind == "response":
                            length, digest, first = len(payload), hashlib.sha256(payload).hexdigest(), None
                            if headers.get("warc-payload-digest", f"sha256:{digest}") != f"sha256:{digest}":
                                raise ValueError(f"{uri}: the payload of {headers['warc-record-id']} isn't the one that was written")
                        else:
                            length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
                            digest, first = headers["warc-payload-digest"].partition(":")[2], _page_of(headers["warc-refers-to"])
                        rows.append((_page_of(headers["warc-record-id"]), headers.get("warc-target-uri"), kind, first, length, digest, payload if keep_payload and kind == "response" else None))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])

    ranges = archives.select("uri", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    size = archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes)).alias("ranges"), F.sum("bytes").alias("bytes")).first()
    n = min(int(size["ranges"] or 1), max(4 * archives.sparkSession.sparkContext.defaultParallelism, parts(size["bytes"], TASK_BYTES)))
    return ranges.repartition(n, "uri", "start").mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(with_revisits(table(spark, sf_dir, "pages")), fresh_path(spark, "warc"))
    return read_archives(archives, keep_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The rows that the archives must give back.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
