"""WARC archives: a monolithic gzip is normalised to one gzip member a record, with a sidecar offset index.

``write_archives`` deals records to archives and writes each as a single gzip stream, as careless crawlers do.
``normalise`` inflates such a stream once, in pieces, cuts it at the records' Content-Length and writes every record
as a gzip member of its own, so that a reader can seek; the sidecar holds offset, compressed and payload length, id and
digest of every record. ``read_archives`` reads records back through the sidecar.

Duplicates: pages with equal payloads of at least MIN_REVISIT bytes share one response, that of the largest page_id;
the others are written as revisit records without payload that refer to it. Payloads are grouped by SHA-1 in Spark.

Defined cases: null html is an empty payload; payloads under MIN_REVISIT bytes are always responses; rows repeated
whole (same page_id) each get a record of the same kind; a null page_id sorts below all others; an empty table writes no archive and gives no rows; other columns are not read.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow_words import pieces
from .common import materialize, read, shared_dir
from .files import read_file, write_file

MIN_REVISIT, ARCHIVE_BYTES, PIECE = 1000, 16 << 20, 1 << 18
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = struct.Struct("<QQQ")  # offset, compressed bytes, inflated bytes


def record_bytes(page_id: int | None, url: str | None, kind: str, payload: bytes, full_bytes: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; digest (hex SHA-1) and full_bytes are those of the full payload, which revisits leave out."""
    target = "".join(c for c in (url or "") if c > " " and c != "\x7f")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {WARC_DATE}", f"WARC-Target-URI: {target}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {full_bytes}", "Content-Type: application/octet-stream", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    return fields, rest[: int(fields["content-length"])]


def split_records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """The whole records of an inflated stream, which comes in pieces; no more than a record and a piece is held."""
    held = bytearray()
    need = None
    for piece in stream:
        held += piece
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                lengths = [x for x in bytes(held[:end]).split(b"\r\n") if x.lower().startswith(b"content-length:")]
                need = end + 4 + int(lengths[0].partition(b":")[2]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the archive ends inside a record")


def inflate(data: bytes) -> Iterator[bytes]:
    """A gzip file's content in pieces, be it one member or many; each byte is read once."""
    view, at = memoryview(data), 0
    while at < len(view):
        z = zlib.decompressobj(31)
        chunk = b""
        while not z.eof:
            if not chunk:
                chunk = view[at : at + PIECE]
                at += len(chunk)
            out = z.decompress(chunk, PIECE)
            if not out and not len(chunk) and not z.eof:
                raise ValueError("the archive ends inside a member")
            yield out
            chunk = z.unconsumed_tail
        at -= len(z.unused_data)  # of the last chunk: the next member's


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def normalise(data: bytes) -> tuple[bytes, list[tuple[int, int, int]]]:
    """A monolithic gzip of records -> one member a record, and the offset index: offset, bytes, inflated bytes of each."""
    out, index = io.BytesIO(), []
    for record in split_records(inflate(data)):
        member = _gzip(record)
        index.append((out.tell(), len(member), len(record)))
        out.write(member)
    return out.getvalue(), index


def index_bytes(index: list[tuple[int, int, int]]) -> bytes:
    return b"".join(_ENTRY.pack(*x) for x in index)


def read_index(data: bytes) -> list[tuple[int, int, int]]:
    return list(_ENTRY.iter_unpack(data))


def write_archives(records: DataFrame, base: str) -> DataFrame:
    """Writes records (page_id, url, kind, payload, full_bytes, digest, refers_to) as monolithic archives; one row each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n, made = TaskContext.get(), 0, []
        z, out, size, held = zlib.compressobj(1, zlib.DEFLATED, 31), [], 0, 0

        def flush() -> None:
            nonlocal z, out, size, held
            if held:
                out.append(z.flush())
                path = f"{base}/raw/{task.partitionId():06d}-{len(made):06d}.warc.gz"
                write_file(path, b"".join(out), str(task.taskAttemptId()))
                made.append((path, held))
            z, out, size, held = zlib.compressobj(1, zlib.DEFLATED, 31), [], 0, 0

        for batch in pieces(batches, text=3):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, kind, payload, full, digest, refers_to = row
                data = record_bytes(page_id, url, kind, payload, full, digest, refers_to)
                out.append(z.compress(data))
                size, held, n = size + len(data), held + 1, n + 1
                if size >= ARCHIVE_BYTES:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["path", "n"])

    columns = records.select("page_id", "url", "kind", "payload", "full_bytes", "digest", "refers_to")
    return columns.mapInArrow(write, "path string, n long")


def normalise_archives(archives: DataFrame, base: str) -> DataFrame:
    """Rewrites each archive of the column path under base with a sidecar (.idx) of its members; one row each."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = str(TaskContext.get().taskAttemptId())
        for batch in batches:
            for path in batch.column(0).to_pylist():
                data, index = normalise(read_file(path))
                to = f"{base}/members/{path.rpartition('/')[2]}"
                write_file(to, data, attempt)
                write_file(f"{to}.idx", index_bytes(index), attempt)
                yield pa.RecordBatch.from_arrays([pa.array([to]), pa.array([len(index)], pa.int64())], names=["path", "n"])

    return archives.select("path").mapInArrow(rewrite, "path string, n long")


def read_archives(archives: DataFrame) -> DataFrame:
    """page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to of every record, by the sidecars."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda urn: int(x) if (x := urn.removeprefix("<urn:page:").removesuffix(">")) else None
        for batch in batches:
            for path in batch.column(0).to_pylist():
                data, rows, size = read_file(path), [], 0
                for offset, packed, inflated in read_index(read_file(f"{path}.idx")):
                    record = zlib.decompress(data[offset : offset + packed], 31)
                    if len(record) != inflated:
                        raise ValueError("the index does not fit the archive")
                    f, payload = parse_record(record)
                    refers = number(f["warc-refers-to"]) if "warc-refers-to" in f else None
                    rows.append((number(f["warc-record-id"]), f["warc-target-uri"], f["warc-type"], payload, int(f["x-payload-length"]), f["warc-payload-digest"].removeprefix("sha1:"), refers))
                    size += inflated
                    if size > 4 << 20:
                        yield _batch(rows, kinds, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, kinds, names)

    return archives.select("path").mapInArrow(parse, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, kind, payload, full_bytes, digest, refers_to for pages (page_id, url, html).

    Only ids and digests are shuffled: the largest id of each digest that comes more than once, which adaptive
    execution joins back to the pages. Payloads stay where they are read.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"full_bytes": F.length("payload").cast("long"), "digest": F.sha1("payload")})
    large = rows.where(F.col("full_bytes") >= min_revisit)
    top = large.groupBy("digest").agg(F.count("*").alias("copies"), F.max("page_id").alias("top")).where("copies > 1")
    top = materialize(top)
    found = rows.join(top.select(F.col("digest").alias("_d"), "top"), (F.col("digest") == F.col("_d")) & (F.col("full_bytes") >= min_revisit), "left")
    revisit = F.col("_d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return found.select("page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload")).alias("payload"), "full_bytes", "digest", F.when(revisit, F.col("top")).alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages as monolithic archives, normalises those and reads the result back."""
    base = shared_dir(pages.sparkSession)
    raw = materialize(write_archives(plan_records(pages), base))
    n = max(1, min(10_000, raw.count()))
    members = materialize(normalise_archives(raw.repartition(n), base))
    return read_archives(members.repartition(n))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
t AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN top <> page_id THEN top END AS refers_to FROM p LEFT JOIN t ON p.payload_digest = t.payload_digest AND payload_bytes >= 1000
"""
