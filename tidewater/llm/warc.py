"""WARC archives with revisit resolution.

Headers (id, digest, size) are shuffled by payload digest, and beyond ``BROADCAST_IDS // 8``
repeated digests the payloads too: of the records with
equal payloads of at least ``min_bytes`` that with the largest id stays the response,
the others become revisits that name it. The archives are then written with fresh
headers, one gzip member per record, and no payload in a revisit.

Each task writes files under names of its own into the shared folder and reports them;
the manifest of the tasks that succeeded says which files count, so a retried or lost
task leaves nothing that a reader would see.

Null payloads are empty, null addresses are written as ``about:blank``, records of a
null id get no id header; equal rows with one id are one capture and both stay
responses. Empty tables give an empty manifest. Further columns are dropped.
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

from tidewater.llm.common import BROADCAST_IDS, cut
from tidewater.session import work_dir

MIN_BYTES = 1000
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def resolve(records: DataFrame, id_col: str = "page_id", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Add ``refers_to`` (null for responses) to rows with ``digest`` and ``size``."""
    big = F.col("size") >= min_bytes
    kept = (records.where(big).groupBy("digest").agg(F.max(id_col).alias("_original"), F.count(F.lit(1)).alias("_n"))
            .where((F.col("_n") > 1) & F.col("_original").isNotNull()).drop("_n"))
    kept = cut(kept, "originals")
    if kept.count() <= BROADCAST_IDS // 8:
        kept = F.broadcast(kept)
    original = F.when(big & ~F.col(id_col).eqNullSafe(F.col("_original")), F.col("_original"))
    return records.join(kept, "digest", "left").withColumn("refers_to", original).drop("_original")


def _filesystem(path: str):
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def record_urn(record: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(record))}>"


def _record(record, url, payload: bytes, digest: str, original, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original is not None else http + payload
    # White space and control characters would end a header early.
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}", f"WARC-Record-ID: {record_urn(record)}",
             f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if original is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_urn(original)}"]
    if record is not None:
        lines.append(f"X-Record-Number: {record}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress("\r\n".join(lines).encode() + END + block + END) + member.flush()


def write(resolved: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
          date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write archives; returns their manifest (path, records), itself a stored table."""

    def run(batches: Iterator[pa.RecordBatch]):
        files, root = _filesystem(folder)
        files.create_dir(root, recursive=True)
        out, name, rows, done = None, "", 0, 0
        for batch in batches:
            for record, link, body, digest, original in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, rows, done = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(name, compression=None)
                data = _record(record, link, (body or "").encode(), digest, original, date)
                out.write(data)
                rows, done = rows + 1, done + len(data)
                if done >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [name], "records": [rows]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "records": [rows]})

    return cut(resolved.select(id_col, url, payload, "digest", "refers_to").mapInArrow(run, "path string, records long"), "manifest")


def _headers(stream) -> dict[str, str]:
    out, line = {}, stream.readline()
    while line not in (b"\r\n", b""):
        k, _, v = line.decode().rstrip("\r\n").partition(": ")
        out[k.lower()] = v
        line = stream.readline()
    return out


def records(path: str) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """Headers, HTTP headers and payload of every record of one archive."""
    import gzip

    files, name = _filesystem(path)
    with files.open_input_stream(name, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
        while version := stream.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError(f"not a record: {version[:40]!r}")
            head = _headers(stream)
            block = stream.read(int(head["content-length"]))
            if stream.read(4) != END:
                raise ValueError("a record has no end")
            http, _, payload = block.partition(END)
            first = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
            yield head, {k.lower(): v for k, v in first.items()}, payload


def read(spark: SparkSession, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record: urn, record, url, record_type, payload_digest, payload_bytes, refers_to_urn, payload.

    A response whose payload does not have the digest of its header stops the job.
    """
    names = ("urn", "record", "url", "record_type", "payload_digest", "payload_bytes", "refers_to_urn", "payload")
    schema = ("urn string, record long, url string, record_type string, payload_digest string, payload_bytes long, "
              "refers_to_urn string, payload string")

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for head, http, payload in records(path):
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: a payload differs from its digest")
                    number = head.get("x-record-number")
                    rows.append((head["warc-record-id"], number and int(number), head["warc-target-uri"], head["warc-type"], digest,
                                 int(http["content-length"]), head.get("warc-refers-to"),
                                 payload.decode() if payloads and head["warc-type"] == "response" else None))
                    if len(rows) == 1000:
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    many = max(1, min(manifest.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.select("path").repartition(many).mapInArrow(run, schema)


def _batch(rows, names):
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def archive(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """Resolve, write and read back: the records of the archives with ``refers_to``, the number of the original."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias(id_col), F.col(url), body.alias(payload),
                        F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    manifest = write(resolve(rows, id_col, min_bytes), work_dir(spark, "warc"), id_col, url, payload)
    back = read(spark, manifest).drop("payload")
    origin = back.where("record_type = 'response' AND record IS NOT NULL").select(
        F.col("urn").alias("refers_to_urn"), F.col("record").alias("refers_to")).distinct()
    # Only originals that a revisit names: most responses have none.
    named = back.where("record_type = 'revisit'").select("refers_to_urn").distinct()
    return back.join(origin.join(named, "refers_to_urn", "left_semi"), "refers_to_urn", "left")
