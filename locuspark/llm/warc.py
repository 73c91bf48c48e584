"""Content-addressed WARC archive: payload bytes once per digest, record headers apart.

``write_archive`` makes two tables below a shared folder:

* ``payloads`` (digest, n_bytes, body): each distinct payload once, addressed by
  its SHA-256 and verified by length; the body is zstd-compressed;
* ``headers`` (page_id, rid, digest, head): the exact header block of every
  record, up to and including its blank line.

``read_archive`` joins them back to the original records and verifies them.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.llm.common import attach, numbered

DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"
SEEN = 1_000_000  # digests a task remembers; a forgotten one only travels twice


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the payload by its length and digests."""
    for batch in batches:
        payloads = [html.as_py() or b"" for html in batch.column("html").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array([hashlib.sha256(p).hexdigest() for p in payloads]),
             pa.array([len(p) for p in payloads], pa.int64()), pa.array([base32_sha1(p) for p in payloads], pa.string())],
            ["page_id", "url", "digest", "n_bytes", "sha1"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed payloads with their digest, each once in a task as far as the task remembers."""
    pack, seen = zstandard.ZstdCompressor(level=3), set()
    for batch in batches:
        out = ([], [], [])
        for html in batch.column("html").cast(pa.binary()):
            payload = html.as_py() or b""
            strong = hashlib.sha256(payload).hexdigest()
            if strong in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(strong)
            for column, value in zip(out, (strong, len(payload), pack.compress(payload))):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.binary())], ["digest", "n_bytes", "body"])


def _line(name: str, value: Column) -> Column:
    """A header line; line breaks in a value are percent-encoded, a null value gives no line."""
    safe = F.regexp_replace(F.regexp_replace(value.cast("string"), "\r", "%0D"), "\n", "%0A")
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), safe, F.lit("\r\n"))).otherwise("")


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_bytes: int = 0) -> None:
    """Write ``pages`` as an archive below ``path`` (a folder that all executors share).

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest id (null ids last, then the first in table order) is a
    response, the others are revisits that refer to it; smaller payloads are
    all responses.  A null payload is empty; a null url gives no target line.
    """
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(payload_col).cast("string").alias("html"))
    bodies = slim.select("html").mapInArrow(_bodies, "digest string, n_bytes long, body binary")
    bodies.dropDuplicates(["digest", "n_bytes"]).write.mode("overwrite").parquet(f"{path}/payloads")
    rows = numbered(slim.mapInArrow(_digests, "page_id long, url string, digest string, n_bytes long, sha1 string"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("void"), "page_id", "rid")).alias("first")
    firsts = rows.groupBy("digest").agg(first)
    known = attach(rows, firsts, ["digest"])
    again = (F.col("n_bytes") >= min_bytes) & (F.col("rid") != F.col("first.rid"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))), _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(again, _record_id(F.col("first.page_id")))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(again, 0).otherwise(F.col("n_bytes"))), F.lit("\r\n"))
    known.select("page_id", "rid", "digest", "n_bytes", F.encode(head, "UTF-8").alias("head")).write.mode(
        "overwrite").parquet(f"{path}/headers")


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Original record bytes from header and payload; raises where they do not fit each other."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        records = []
        for head, body, digest, size in zip(batch.column("head"), batch.column("body"), batch.column("digest"),
                                            batch.column("n_bytes")):
            head = head.as_py()
            payload = b"" if body.as_py() is None else unpack.decompress(body.as_py())
            if re.search(rb"^WARC-Type: response\r$", head, re.M):
                named = re.search(rb"^WARC-Payload-Digest: sha1:([A-Z2-7]+)\r$", head, re.M)[1].decode()
                if (body.as_py() is None or len(payload) != size.as_py() or base32_sha1(payload) != named
                        or hashlib.sha256(payload).hexdigest() != digest.as_py()):
                    raise ValueError(f"payload {digest.as_py()} does not match its record")
            records.append(head + payload + END)
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("n_bytes"),
                                          pa.array(records, pa.binary())], ["page_id", "n_bytes", "record"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, n_bytes, record``: every record of an archive, byte for byte.

    Only responses carry a payload, and (from ``min_bytes`` on) each digest has
    one response, so the join has no hot key; revisits are not joined at all.
    """
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    revisit = F.contains(F.decode("head", "UTF-8"), F.lit("\r\nWARC-Type: revisit\r\n"))
    whole = headers.where(~revisit).join(payloads, ["digest", "n_bytes"], "left")
    columns = ["page_id", "digest", "n_bytes", "head", "body"]
    bare = headers.where(revisit).withColumn("body", F.lit(None).cast("binary"))
    return whole.select(columns).union(bare.select(columns)).mapInArrow(
        _rebuild, "page_id long, n_bytes long, record binary")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the records themselves say: type, payload digest, reference; responses are digested anew."""
    for batch in batches:
        kinds, digests, refers = [], [], []
        for record in batch.column("record"):
            head, _, rest = record.as_py().partition(END)
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            payload = rest[:int(fields["Content-Length"])]
            kinds.append(fields["WARC-Type"])
            digests.append(base32_sha1(payload) if kinds[-1] == "response"
                           else fields["WARC-Payload-Digest"].removeprefix("sha1:"))
            target = fields.get("WARC-Refers-To", "<urn:page:none>")[len("<urn:page:"):-1]
            refers.append(None if target == "none" else int(target))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("n_bytes"), pa.array(digests, pa.string()),
             pa.array(kinds, pa.string()), pa.array(refers, pa.int64())],
            ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def record_index(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of reconstructed records.

    The type, the reference and a revisit's digest come from the record's own
    header; a response's digest is taken from its payload bytes.
    """
    return records.select("page_id", "n_bytes", "record").mapInArrow(
        _parse, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
