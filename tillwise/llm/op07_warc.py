"""WARC: a deterministic sharded writer and its reader.

Pages are range-sorted by page id into buckets (one shuffle of the payloads); each bucket's stream is
cut into ``.warc.gz`` files that roll when their compressed size passes ``roll_bytes``.  Every record
is its own gzip member with regenerated headers, record id and SHA-256 digests, none of which depend
on the clock, the task or the number of executors, so a rerun writes the same bytes.  Files are
written under temporary names and renamed; the manifest (file, records, bytes, digest of the file) is
committed by Spark after all of them, and readers open only what it names.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the smallest page id is a
``response``; the others are ``revisit`` records that refer to it.  The groups are found on digests
alone (pre-aggregated minimum, then a join that AQE splits on a hot digest) and reach the writer as
small rows that sort just before their page: payloads are shuffled once.

Defined results: null html is an empty payload; a null url is written as ``urn:page:<id>``; control
characters in urls are percent-encoded; null page ids sort first and are never referred to while the
group has another id; repeated rows (same id and payload) give one response and revisits of it.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import materialize, range_number, range_starts, scratch, slices, table
from tillwise.llm.files import AtomicFile, filesystem

MANIFEST = "bucket int, seq int, file string, records long, bytes long, sha256 string"
RECORDS = ("file string, page_id long, url string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, payload binary")
BUCKET_BYTES = 32 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{copy}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers: tuple | None,
                copy: int, date: str) -> bytes:
    """One WARC/1.1 record; ``refers`` is (page id,) of the response that a revisit repeats."""
    block = HTTP % len(payload) + (b"" if refers else payload)
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}",
            f"WARC-Record-ID: {record_id(page_id, digest, copy)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}",
            f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
            f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers:
        head += [f"WARC-Refers-To: {record_id(refers[0], digest, 0)}", f"WARC-Profile: {PROFILE}"]
        if refers[0] is not None:
            head.append(f"X-Refers-To-Page: {refers[0]}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()  # zlib writes no time into the header


def _writer(folder: str, roll_bytes: int, min_revisit: int, date: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("seq", pa.int32()), ("file", pa.string()),
                            ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
        out, bucket, seq, records, digest_of = None, None, 0, 0, None
        done: list[dict] = []

        def close():
            nonlocal out, seq, records
            if out:
                out.commit()
                done.append({"bucket": bucket, "seq": seq, "file": out.name, "records": records,
                             "bytes": out.size, "sha256": digest_of.hexdigest()})
                out, seq, records = None, seq + 1, 0

        page, refs, seen = object(), {}, {}
        for batch in slices(batches, 100):
            for row in zip(*[batch.column(c).to_pylist() for c in ("bucket", "page_id", "is_page", "url",
                                                                   "html", "digest", "first")]):
                b, page_id, is_page, url, html, ref_digest, first = row
                if b != bucket:
                    close()
                    bucket, seq, page = b, 0, object()
                if page_id != page:
                    page, refs, seen = page_id, {}, {}
                if not is_page:
                    refs[ref_digest] = first
                    continue
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                copy = seen.get(digest, 0)
                seen[digest] = copy + 1
                refers = None
                if len(payload) >= min_revisit and digest in refs and (refs[digest] != page_id or copy):
                    refers = (refs[digest],)
                data = gzip_member(make_record(page_id, url, payload, digest, refers, copy, date), level)
                if out is None:
                    out = AtomicFile(folder, f"part-{bucket:05d}-{seq:05d}.warc.gz")
                    digest_of = hashlib.sha256()
                out.write(data)
                digest_of.update(data)
                records += 1
                if out.size >= roll_bytes:
                    close()
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return write


def write_warc(pages: DataFrame, folder: str, roll_bytes: int = 64 << 20, min_revisit: int = 100,
               date: str = "2000-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files in ``folder``; returns the manifest."""
    payload = F.coalesce("html", F.lit(""))
    # One row of ids and digests per page; equal (id, payload) rows are counted together.
    ids = materialize(pages.select("page_id", F.sha2(payload, 256).alias("digest"),
                                   F.octet_length(payload).cast("long").alias("n"))
                      .groupBy("page_id", "digest").agg(F.first("n").alias("n"), F.count("*").alias("rows")),
                      "warc-ids")
    firsts = (ids.where(F.col("n") >= min_revisit).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.sum("rows").alias("rows")).where("rows > 1")
              .select("digest", "first"))
    refs = ids.where(F.col("n") >= min_revisit).join(firsts, "digest").select("page_id", "digest", "first")
    total = ids.agg(F.sum(F.col("n") * F.col("rows"))).first()[0] or 0
    buckets = int(max(pages.sparkSession.sparkContext.defaultParallelism, -(-total // BUCKET_BYTES)))
    starts = range_starts(ids, "page_id", buckets)
    rows = pages.select("page_id", F.lit(True).alias("is_page"), "url", "html",
                        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("first"))
    notes = refs.select("page_id", F.lit(False).alias("is_page"), F.lit(None).cast("string").alias("url"),
                        F.lit(None).cast("string").alias("html"), "digest", "first")
    sorted_rows = (rows.union(notes).withColumn("bucket", range_number("page_id", starts))
                   .repartitionById(len(starts) + 1, "bucket")
                   .sortWithinPartitions("bucket", "page_id", "is_page", "url", "html"))
    written = sorted_rows.mapInArrow(_writer(folder, roll_bytes, min_revisit, date, level), MANIFEST)
    return materialize(written, "warc-manifest")


def read_record(stream) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of each record of an open ``.warc.gz`` stream, one gzip member at a time."""
    unpacker, data, pending = zlib.decompressobj(31), [], b""
    while True:
        chunk = pending or stream.read(1 << 20)
        if not chunk:
            break
        data.append(unpacker.decompress(chunk))
        pending = unpacker.unused_data
        if unpacker.eof:
            head, _, rest = b"".join(data).partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            yield fields, rest[:int(fields["Content-Length"])]
            unpacker, data = zlib.decompressobj(31), []
    if data:
        raise ValueError("the last record is cut off")


def _reader(folder: str, keep_payload: bool):
    names = [x.split()[0] for x in RECORDS.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        schema = pa.schema(list(zip(names, types)))
        for batch in batches:
            for name, records in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist()):
                rows, held, n = [], 0, 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for fields, block in read_record(stream):
                        payload = block.partition(b"\r\n\r\n")[2]
                        kind = fields["WARC-Type"]
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        size = int(fields["X-Payload-Length"])
                        if kind == "response":
                            if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                                raise ValueError(f"payload digest differs in {name}")
                        to_int = lambda key: int(fields[key]) if key in fields else None
                        rows.append((name, to_int("X-Page-Id"), fields["WARC-Target-URI"], size, digest, kind,
                                     to_int("X-Refers-To-Page"),
                                     payload if keep_payload and kind == "response" else None))
                        held, n = held + (len(payload) if keep_payload else 0), n + 1
                        if len(rows) >= 5000 or held > 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)
                            rows, held = [], 0
                if n != records:
                    raise ValueError(f"{name} holds {n} records, its manifest {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)

    return read


def read_warc(manifest: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """Records of the files that the manifest names, each verified against its digests."""
    files = manifest.count()
    numbered = manifest.select("file", "records", (F.row_number().over(Window.orderBy("bucket", "seq")) - 1).alias("no"))
    return numbered.repartitionById(max(1, files), "no").select("file", "records").mapInArrow(
        _reader(folder, keep_payload), RECORDS)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = scratch(spark, "warc")
    manifest = write_warc(pages, folder)
    return read_warc(manifest, folder, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS dig FROM pages),
f AS (SELECT dig, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY dig)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.dig AS payload_digest,
       CASE WHEN f.first IS NULL OR f.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first IS NULL OR f.first = page_id THEN NULL ELSE f.first END AS refers_to
FROM p LEFT JOIN f USING (dig)
"""
