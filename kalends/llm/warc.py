"""Operator 2: WARC archives, index first.

Writing: each task writes gzip-membered WARC files, one member per record, and returns the index:
file, offset, length, URL, digest. The index is a table that Spark commits; files of lost attempts
are never named in it. Reading: the selected index rows are sorted by file and offset, neighbours
are coalesced into one byte-range read, and records are parsed from the bytes read.

Among pages with equal payloads (by SHA-1 and length) of at least ``revisit_bytes`` the one with the
largest page_id is the response and the others are revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyarrow import fs as pafs

from kalends.llm.common import scratch, slices

FILE_BYTES = 256 << 20
BLOCK_BYTES = 32 << 20
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string"
CRLF = b"\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def clean_url(url: str | None) -> str:
    """A header value holds no line breaks."""
    return " ".join((url or "").split())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    body = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Target-URI: {clean_url(url)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {urn(refers_to)}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return CRLF.join([*(h.encode("utf-8", "replace") for h in head), b"", body, b"", b""])


def member(raw: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(CRLF + CRLF)
    fields = dict(h.decode("utf-8", "replace").split(": ", 1) if b": " in h else (h.decode().rstrip(":"), "") for h in head.split(CRLF)[1:])
    return fields, rest[: int(fields["Content-Length"])]


def page_of(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:page:").rstrip(">")
    return int(digits) if digits else None


def write_archives(pages: DataFrame, folder: str, revisit_bytes: int = 0) -> DataFrame:
    """Writes one record per row of pages (null html: empty) and returns the index.

    Rows with a null page_id are never referred to. Of repeated rows with the same page_id and
    payload each is a response, for none of them is an earlier record of another page.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"sha": F.unhex(F.sha1("payload")), "size": F.octet_length("payload")})
    # only payloads that several pages hold are looked up, by digest, after a partial aggregation
    held = rows.filter(F.col("size") >= revisit_bytes).groupBy("sha", "size").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies"))
    rows = rows.join(held.filter("copies > 1").drop("copies"), ["sha", "size"], "left").select("page_id", "url", "payload", F.when(F.col("page_id") < F.col("keeper"), F.col("keeper")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, out, name, at = TaskContext.get().partitionId(), None, "", 0
        for batch in slices(batches, 256):
            index = []
            for page_id, url, payload, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                if out is None or at >= FILE_BYTES:
                    if out:
                        out.close()
                    name, at = f"{part:06d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                digest, revisit = base32_sha1(payload), refers_to is not None
                raw = member(record(page_id, url, payload, digest, refers_to, revisit))
                out.write(raw)
                index.append((name, at, len(raw), page_id, url, digest, "revisit" if revisit else "response"))
                at += len(raw)
            if index:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*index), kinds)], names=["file", "offset", "length", "page_id", "url", "digest", "record_type"])
        if out:
            out.close()

    return rows.mapInArrow(run, INDEX)


def ranges(spans: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, list[int]]]:
    """Sorted (offset, length) spans coalesced into reads (offset, length, spans inside)."""
    reads: list[tuple[int, int, list[int]]] = []
    first, end, inside = 0, -1, []
    for k, (at, n) in enumerate(spans):
        if not inside or at - end > gap or at + n - first > most:
            if inside:
                reads.append((first, end - first, inside))
            first, end, inside = at, at + n, []
        end = max(end, at + n)
        inside.append(k)
    if inside:
        reads.append((first, end - first, inside))
    return reads


def read_records(selected: DataFrame, folder: str) -> DataFrame:
    """The selected index rows' records: parsed headers and payload facts, computed from the bytes read."""
    block = F.floor(F.col("offset") / F.lit(BLOCK_BYTES))
    sorted_rows = selected.select("file", "offset", "length").repartition("file", block).sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            files, offsets, lengths = (batch.column(c).to_pylist() for c in ("file", "offset", "length"))
            out, k = [], 0
            while k < len(files):
                end = k
                while end < len(files) and files[end] == files[k]:
                    end += 1
                with store.open_input_file(f"{root}/{files[k]}") as f:
                    for first, n, inside in ranges(list(zip(offsets[k:end], lengths[k:end]))):
                        raw = f.read_at(n, first)
                        for i in inside:
                            at = offsets[k + i] - first
                            fields, body = parse(zlib.decompress(raw[at : at + lengths[k + i]], 31))
                            revisit = fields["WARC-Type"] == "revisit"
                            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base32_sha1(body)
                            size = int(fields["WARC-Payload-Length"]) if revisit else len(body)
                            out.append((page_of(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], page_of(fields.get("WARC-Refers-To")), fields["WARC-Target-URI"]))
                k = end
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    return sorted_rows.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive_round_trip(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    folder = scratch(pages.sparkSession, "warc")
    write_archives(pages, f"{folder}/archives", revisit_bytes).write.parquet(f"{folder}/index")
    return read_records(pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index"), f"{folder}/archives")
