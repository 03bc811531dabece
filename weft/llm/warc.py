"""WARC archives with deduplicated payloads, an index, and reads by byte range.

Writing: each task writes WARC/1.1 files of at most about ``FILE_BYTES``, one gzip member a
record. A record holds an HTTP response whose body is the page. Of records with equal
payloads (same SHA-1 and length) of at least ``LEAST_BYTES`` bytes, the one with the largest id is a
``response``; the others are ``revisit`` records that name it and hold the HTTP headers only.
For each record path, offset, length, URL and payload digest are kept: the index,
committed by Spark, so files of lost attempts are never listed (file names hold the attempt).

Reading: the index rows of the selected records are dealt by file and ``SPLIT_BYTES`` of offset and
sorted; neighbouring ranges with gaps of at most ``GAP_BYTES`` are fetched by one read of at most ``READ_BYTES``
(a longer record by itself). A record is parsed and its payload checked against its digest.

A null payload is empty; a null URL leaves the header out. A null id sorts below all others; if equal
payloads have several rows of the largest id (or null ids only), all of these are responses.
Control characters and spaces in a URL are percent-encoded. An empty table gives no files and no rows."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import by_size, materialise, open_store, read_range, table
from weft.session import scratch_path

LEAST_BYTES = 1000
FILE_BYTES = 64 << 20
SPLIT_BYTES = 16 << 20
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
GZIP_LEVEL = 4
DATE = "1970-01-01T00:00:00Z"  # the tables have no time of capture
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool, date: str = DATE) -> bytes:
    """One uncompressed record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{_number(page_id)}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{_number(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(page_id: int | None) -> str:
    return "none" if page_id is None else str(page_id)


def parse_record(packed: bytes) -> dict:
    """The parts of one record; raises if its payload does not match its digest."""
    raw = zlib.decompress(packed, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    own = lambda name: None if (x := fields[name][10:-1]) == "none" else int(x)
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"page_id": own("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload": None if revisit else payload,
            "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": own("WARC-Refers-To") if revisit else None}


INDEX_SCHEMA = "page_id long, url string, payload_digest string, record_type string, path string, offset long, length long"


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write every row as a record; returns the index."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    # only digests that occur more than once meet the pages again
    kept = (rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest", "size")
            .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n").withColumn("several", F.lit(True)))
    rows = rows.join(kept, ["digest", "size"], "left")
    rows = rows.withColumn("revisit", F.coalesce(F.col("several") & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False)))

    def write(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, path, at, files = TaskContext.get(), None, "", 0, 0
        for batch in found:
            for part in by_size(batch, "payload", READ_BYTES):
                listed = []
                for page_id, url, payload, digest, first, revisit in zip(
                        *(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first", "revisit")), strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        path = f"{folder}/pages-{context.partitionId():06d}-{context.taskAttemptId()}-{files:04d}.warc.gz"
                        store, place = open_store(path)
                        store.create_dir(os.path.dirname(place))
                        out, at, files = store.open_output_stream(place, compression=None), 0, files + 1
                    squeeze = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                    packed = squeeze.compress(record_bytes(page_id, url, payload, digest, first, revisit)) + squeeze.flush()
                    out.write(packed)
                    listed.append((page_id, url, digest, "revisit" if revisit else "response", path, at, len(packed)))
                    at += len(packed)
                columns = list(zip(*listed, strict=True))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                                 ["page_id", "url", "payload_digest", "record_type", "path", "offset", "length"])
        if out is not None:
            out.close()

    return materialise(rows.select("page_id", "url", "payload", "digest", "first", "revisit").mapInArrow(write, INDEX_SCHEMA), "warc-index")


def ranges(wanted: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Coalesce sorted (offset, length) pairs to reads (offset, size, pairs inside)."""
    start, stop, inside = 0, 0, []
    for k, (offset, length) in enumerate(wanted):
        if inside and (offset - stop > GAP_BYTES or max(stop, offset + length) - start > READ_BYTES):
            yield start, stop - start, inside
            inside = []
        if not inside:
            start, stop = offset, offset
        inside.append(k)
        stop = max(stop, offset + length)
    if inside:
        yield start, stop - start, inside


RECORD_SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the index rows; without ``payloads`` these are checked but not returned."""
    def read(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for batch in found:
            paths = batch.column("path").to_pylist()
            places = list(zip(batch.column("offset").to_pylist(), batch.column("length").to_pylist(), strict=True))
            a = 0
            while a < len(paths):
                b = a
                while b < len(paths) and paths[b] == paths[a]:
                    b += 1
                if opened != paths[a]:
                    if file is not None:
                        file.close()
                    store, place = open_store(paths[a])
                    file, opened = store.open_input_file(place), paths[a]
                own = places[a:b]
                for start, size, inside in ranges(own):
                    data = memoryview(read_range(file, start, size))
                    records = [parse_record(data[own[k][0] - start:own[k][0] - start + own[k][1]]) for k in inside]
                    if not payloads:
                        records = [r | {"payload": None} for r in records]
                    yield pa.RecordBatch.from_pylist(records, pa.schema([
                        ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))
                a = b
        if file is not None:
            file.close()

    part = (F.col("offset") / SPLIT_BYTES).cast("long")
    # a set number of partitions: the index is small beside the records it leads to, so
    # partitions joined by its size would read too much each
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (index.select("path", "offset", "length").repartition(n, "path", part).sortWithinPartitions("path", "offset")
            .mapInArrow(read, RECORD_SCHEMA))


def op3_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages to WARC files and read every record back through the index."""
    index = write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_warc(index, payloads=False).drop("payload", "url")


OP3_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM g
"""
