"""WARC archives with an index: write, index, read back by byte ranges.

Every record is a gzip member of its own, so (file, offset, length) is enough
to read it.  The writer returns the index (a CDX-like table) before anything
is read; the reader sorts the selected index rows by place, joins neighbouring
byte ranges into one read and parses the records.

Defined results: null html is an empty payload; a null url has no target
header; rows with equal payloads of at least `min_bytes` bytes are one group,
whose rows with the smallest page_id (nulls last) are responses and all others
revisits; rows that repeat that page_id with the same payload are responses as
well.  Columns other than the three named are ignored.  An empty table gives an
empty index.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import scratch, stash

DATE = "2024-01-01T00:00:00Z"
#: Selected records whose gap is at most GAP bytes are read together, up to SPAN bytes.
GAP, SPAN = 64 << 10, 4 << 20

INDEX = ("file string, offset long, length long, page_id long, url string, "
         "payload_bytes long, payload_digest string, record_type string, refers_to long")
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload binary, file string, offset long")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 SHA-1: five hex digits are four base-32 digits."""
    h = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(h, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
            f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(block)}"]
    if url is not None:
        # characters that no header line may hold are percent-encoded
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else quote(c) for c in url))
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write_files(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, name = None, 0, ""
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if out is None:   # one file for each attempt of a task; only a finished one's rows are indexed
                    name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    store, path = fs.FileSystem.from_uri(name)
                    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(path, compression=None)
                payload = r["body"].encode()
                z = zlib.compressobj(3, zlib.DEFLATED, 31)
                member = z.compress(_record(r["page_id"], r["url"], payload, r["payload_digest"], r["record_type"],
                                            r["refers_to"])) + z.flush()
                out.write(member)
                rows.append({"file": name, "offset": at, "length": len(member)}
                            | {k: r[k] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type",
                                                 "refers_to")})
                at += len(member)
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow(INDEX))
        if out is not None:
            out.close()
    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(","))])


def write_archive(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write a record for each row of pages(page_id, url, html) and return the
    index of the archive, itself written to the shared folder."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    body = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("body"))
    body = body.withColumns({"payload_bytes": F.octet_length("body").cast("long"),
                             "payload_digest": base32_sha1(F.col("body"))})
    first = (body.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id")).withColumn("grouped", F.lit(True)))
    rows = body.join(first, "payload_digest", "left")
    revisit = F.col("grouped") & ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("payload_bytes") >= min_bytes)
    rows = rows.select("page_id", "url", "body", "payload_bytes", "payload_digest",
                       F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                       F.when(revisit, F.col("first_id")).alias("refers_to"))
    return stash(rows.mapInArrow(_write_files(folder), INDEX), "warc-index")


def _parse(member: bytes) -> tuple[dict[str, str], bytes]:
    raw = zlib.decompress(member, 31)
    head, block = raw.split(b"\r\n\r\n", 1)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    return fields, block.split(b"\r\n\r\n", 1)[1]


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opened: tuple[str, object] = ("", None)

    def fetch(group: list[dict]) -> pa.RecordBatch:
        nonlocal opened
        if opened[0] != group[0]["file"]:
            store, path = fs.FileSystem.from_uri(group[0]["file"])
            opened = group[0]["file"], store.open_input_file(path)
        base, end = group[0]["offset"], max(r["offset"] + r["length"] for r in group)
        opened[1].seek(base)
        data = memoryview(opened[1].read(end - base))
        rows = []
        for r in group:
            at = r["offset"] - base
            head, payload = _parse(data[at:at + r["length"]])
            kind, ident, refers = head["WARC-Type"], head["WARC-Record-ID"][10:-1], head.get("WARC-Refers-To")
            if kind == "response":
                size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if "sha1:" + digest != head["WARC-Payload-Digest"]:
                    raise OSError(f"{r['file']} at {r['offset']}: the payload differs from its digest")
            else:   # the payload is with the record it refers to; the index has its size
                size, digest, payload = r["payload_bytes"], head["WARC-Payload-Digest"][5:], None
            rows.append((int(ident) if ident else None, head.get("WARC-Target-URI"), size, digest, kind,
                         int(refers[10:-1]) if refers else None, payload, r["file"], r["offset"]))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _arrow(RECORD))],
                                          schema=_arrow(RECORD))

    group: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if group and (r["file"] != group[0]["file"] or r["offset"] - group[-1]["offset"] - group[-1]["length"] > GAP
                          or r["offset"] + r["length"] - group[0]["offset"] > SPAN):
                yield fetch(group)
                group = []
            group.append(r)
    if group:
        yield fetch(group)


def read_records(index: DataFrame) -> DataFrame:
    """The records of the selected index rows, with payloads (null for
    revisits).  Rows are dealt by file and SPAN-sized stretch, so that no task
    holds more than a few stretches, and read in the order of their places.
    The number of tasks follows the bytes to read, not the size of the index."""
    total = index.agg(F.sum("length")).first()[0] or 0
    placed = (index.select("file", "offset", "length", "payload_bytes")
              .withColumn("stretch", F.floor(F.col("offset") / SPAN))
              .repartition(1 + total // (2 * SPAN), "file", "stretch").sortWithinPartitions("file", "offset"))
    return placed.mapInArrow(_read_ranges, RECORD)
