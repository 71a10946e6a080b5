"""WARC writing, and reading by boundary-chain verification.

Writing: one response record per page, or an identical-payload-digest revisit of the page with the largest
identifier. Spark's text sink writes them, the record separator being its line separator, so any store it reaches
will do. A task begins a new archive when its open one has ARCHIVE_BYTES. Reading: a task searches its archive for record
magic; each place that parses as a header is a candidate and names its successor, the end of its block. Only what
pointer jumping reaches from the start of the file is a record, so magic inside payloads is rejected however well
formed it is. An archive's candidates are a few bytes a record and stay in the task that read it; nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.shared import BATCH_BYTES, exists, key_filter, key_hash, lean, lookup, materialize, prepare, scratch_path, with_filter_flag

#: An archive is closed by the record that takes it to this many bytes. It is read as one value, so it must stay well
#: under 2 GB, and in the memory of a task.
ARCHIVE_BYTES = 1 << 25
MAGIC = b"WARC/1.1\r\n"
SEPARATOR = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(body: Column) -> Column:
    """Upper-case base32 of the SHA-1, from four groups of 40 bits."""
    h = F.sha1(body)
    parts = [F.lpad(F.conv(F.substring(h, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def _records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """Columns id, uri, body, digest, refers_to (null for a response)."""
    body = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    ident = F.col(f"`{id_col}`").cast("long")
    uri = F.coalesce(F.regexp_replace(F.col(f"`{url_col}`").cast("string"), r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:x-page:"), F.coalesce(ident.cast("string"), F.lit("null"))))
    rows = pages.select(
        ident.alias("id"), uri.alias("uri"), body.alias("body"), sha1_base32(body.cast("binary")).alias("digest"), F.sha2(body.cast("binary"), 256).alias("sha"), F.octet_length(body).alias("n")
    )
    # Payloads are equal when length, SHA-1 and SHA-256 are; copies fold before the shuffle.
    keys = ["digest", "sha", "n"]
    groups = materialize(
        rows.where(F.col("n") >= min_bytes).groupBy(*keys).agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "payload-groups"
    )
    flagged = with_filter_flag(rows, key_hash("sha"), key_filter(groups, key_hash("sha")), "maybe")
    alone = flagged.where("not maybe").drop("maybe").withColumn("first", F.lit(None).cast("long"))
    shared = lookup(flagged.where("maybe").drop("maybe"), groups, keys, "copies", pages.count(), "id", "left").drop("copies")
    refers = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return alone.unionByName(shared).select("id", "uri", "body", "n", "digest", refers.alias("refers_to"))


def _dealt(most: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the number of the task's archive that a record goes to."""
        archive = size = 0
        for b in batches:
            numbers = []
            for n in pa.compute.binary_length(b.column(0)).to_pylist():
                if size >= most:
                    archive, size = archive + 1, 0
                size += n + len(SEPARATOR)
                numbers.append(archive)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(numbers, pa.int32())], ["value", "archive"])

    return deal


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Writes `pages` as WARC files under `path`. Of payloads that are equal and of at least `min_bytes` bytes the
    one with the largest identifier is written whole; rows that repeat that identifier are written whole too.

    Null html is an empty payload, a null identifier loses against any other. A record has at most the 2 GB of a Spark
    string, header and all. Other columns of `pages` are left out. An empty table gives no archive.
    """
    prepare(pages.sparkSession)
    r = _records(pages, id_col, url_col, html_col, min_bytes)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit("\r\n\r\n"))
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, "body"))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        name(F.col("id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.col("uri"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), name(F.col("refers_to")), F.lit(f"\r\nWARC-Profile: {PROFILE}"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block),
        F.lit(SEPARATOR),
    )
    records = r.select(F.concat(head, block).alias("value")).mapInArrow(lean(_dealt(archive_bytes)), "value string, archive int")
    records.write.partitionBy("archive").option("lineSep", SEPARATOR).text(path)


#: A header ends at its first line that is no field, so that magic by the thousand is still read in one pass.
_HEADER = re.compile(rb"WARC/1\.1\r\n((?:[!-9;-~]++: ?+[^\r\n]*+\r\n)*+)\r\n")
_FIELD = re.compile(rb"([!-9;-~]++): ?+([^\r\n]*+)\r\n")


def _header(data: bytes, at: int) -> tuple[dict[bytes, bytes], int] | None:
    """The fields of a header at `at` and where its block begins, if it parses."""
    m = _HEADER.match(data, at)
    if not m:
        return None
    fields = {k.lower(): v for k, v in _FIELD.findall(m[1])}
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    return fields, m.end()


def candidates(data: bytes) -> Iterator[tuple[int, int, dict[bytes, bytes], int]]:
    """(offset, successor, fields, start of block) of every place that reads as a record."""
    at = data.find(MAGIC)
    while at >= 0:
        found = _header(data, at)
        if found:
            fields, block = found
            yield at, block + int(fields[b"content-length"]) + 4, fields, block
        at = data.find(MAGIC, at + 1)


def _page(name: bytes | None) -> int | None:
    tail = (name or b"").rpartition(b":")[2].rstrip(b">")
    return int(tail) if re.fullmatch(rb"-?\d+", tail) else None


def reachable(at: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which candidates the chain from offset 0 reaches; `at` ascends, and a successor that is no candidate ends it.

    Pointer jumping: with every round the reached set doubles along the chain, and so do the jumps.
    """
    n = len(at)
    jump = np.searchsorted(at, successor)
    jump[jump < n] = np.where(at[jump[jump < n]] == successor[jump < n], jump[jump < n], n)
    jump = np.append(jump, n)  # the end leads to itself
    reached = np.append(at == 0, False)
    for _ in range(n.bit_length() + 1):
        reached[jump[reached]] = True
        jump = jump[jump]
    return reached[:n]


def records(data: bytes) -> Iterator[tuple[int, dict[bytes, bytes], bytes]]:
    """(offset, fields, block) of the records of an archive."""
    found = [c for c in candidates(data) if c[1] <= len(data)]
    kept = reachable(np.array([c[0] for c in found], dtype=np.int64), np.array([c[1] for c in found], dtype=np.int64))
    for i in np.flatnonzero(kept):
        at, successor, fields, block = found[i]
        yield at, fields, data[block : successor - len(SEPARATOR)]


def _scan(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, size = [], 0
                for at, f, body in records(content.as_py()):
                    http, _, payload = body.partition(b"\r\n\r\n")
                    revisit = f[b"warc-type"] == b"revisit"
                    length = re.search(rb"(?i)\r\nContent-Length: (\d+)", http)
                    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    digest = f.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:") if revisit else own
                    n = int(length[1]) if revisit and length else len(payload)
                    refers = _page(f.get(b"warc-refers-to")) if revisit else None
                    rows.append((path, at, _page(f.get(b"warc-record-id")), f[b"warc-type"].decode(), n, digest, refers, payload if with_payload else None))
                    size += len(payload) if with_payload else 0
                    if size > BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _NAMES)


_NAMES = ["archive", "at", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
_SCHEMA = "archive string, at long, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of the WARC files under `path`: archive, at, page_id, record_type, payload_bytes, payload_digest
    (computed from the payload, or for a revisit as stated), refers_to, and payload if asked for.

    A file that doesn't begin with a record has none; one that ends early keeps the records before the break. A file
    beyond 2 GB is refused by Spark. A folder without archives gives an empty result.
    """
    prepare(spark)
    if not exists(spark, path):
        return spark.createDataFrame([], _SCHEMA).drop(*[] if payload else ["payload"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("path", "content")
    found = files.mapInArrow(lean(_scan(payload)), _SCHEMA)
    return found if payload else found.drop("payload")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
d AS (SELECT *, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS keeper FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       translate(to_base(CAST('0x' || substr(h, 1, 10) AS BIGINT), 32, 8) || to_base(CAST('0x' || substr(h, 11, 10) AS BIGINT), 32, 8)
              || to_base(CAST('0x' || substr(h, 21, 10) AS BIGINT), 32, 8) || to_base(CAST('0x' || substr(h, 31, 10) AS BIGINT), 32, 8),
              '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM d
"""
