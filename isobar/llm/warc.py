"""Web archives: records, revisits, segments.

Pages are written as gzipped records, one member each, in files that tasks
rotate by size.  Of pages with equal payloads of ``MIN_SHARED`` bytes or more
the one with the smallest id is a response and the others revisit it.  Blocks
longer than a segment go on in continuation records.  Bodies have chunked
transfer framing.  Every record has a date and an identifier of its own, which
follows from the page, the payload and the task, so a task that is repeated
gives the same ones.  Responses are written first, and revisits then refer to
their records.

Reading splits files into records, groups continuations by the identifier of
their origin, orders them by segment number, verifies the total length, takes
the chunks apart and verifies length and digest of the payload.  Revisits take
theirs from the response whose identifier they name; without one reading fails.

A null or empty html is an empty payload.  A null page_id is kept, and is never
the page that others refer to.  Rows that share page_id and payload are all
responses where their page is.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.natives import maybe_broadcast
from isobar.llm.store import shared_dir, ship, written

MIN_SHARED = 100
SEGMENT_BYTES = 16_384
FILE_BYTES = 32_000_000
CHUNK_BYTES = 4_096
BROADCAST_ROWS = 200_000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; trailers and chunk extensions are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk ends early")
        out.append(body[at : at + size])
        at += size + 2


def record(fields: dict[str, object], block: bytes) -> bytes:
    """One gzipped record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in ({"Content-Length": len(block)} | fields).items())
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + z.flush()


def page_records(name: str, date: str, page: str, url: str, payload: bytes, digest: str, refers: str | None, segment: int) -> Iterator[bytes]:
    about = {"WARC-Record-ID": f"<urn:uuid:{name}>", "WARC-Date": date, "WARC-Page": page, "WARC-Target-URI": re.sub(r"[\s\x00-\x1f]", "%20", url), "WARC-Payload-Digest": f"sha256:{digest}"}
    if refers is not None:
        yield record({"WARC-Type": "revisit", **about, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": f"<urn:uuid:{refers}>"}, b"")
        return
    block = _HTTP + chunked(payload)
    about["Content-Type"] = "application/http; msgtype=response"
    if len(block) <= segment:
        yield record({"WARC-Type": "response", **about}, block)
        return
    yield record({"WARC-Type": "response", **about, "WARC-Segment-Number": 1}, block[:segment])
    n = -(-len(block) // segment)
    for k in range(2, n + 1):
        own = uuid.uuid5(uuid.UUID(name), str(k))
        fields = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:uuid:{own}>", "WARC-Date": date, "WARC-Segment-Origin-ID": f"<urn:uuid:{name}>", "WARC-Segment-Number": k}
        yield record(fields | ({"WARC-Segment-Total-Length": len(block)} if k == n else {}), block[(k - 1) * segment : k * segment])


_WRITTEN = "path string, page long, digest string, name string"


def _write(path: str, kind: str, date: str, segment: int, file_bytes: int):
    """Rows (page_id, url, html, digest, refers, referred) into files; gives these, and the names of the records that others refer to."""
    spaces = uuid.uuid5(uuid.NAMESPACE_URL, f"{path}/{kind}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        out, n, times, named = None, 0, Counter(), []

        def close() -> pa.RecordBatch:
            out.close()
            final = f"{kind}-{part:06d}-{n:04d}.warc.gz"
            store.move(temporary, f"{folder}/{final}")
            rows = [(f"{path}/{final}", None, None, None), *named]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["path", "page", "digest", "name"])

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    temporary = f"{folder}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(temporary, compression=None)
                    named.clear()
                payload = (row["html"] or "").encode()
                page = "null" if row["page_id"] is None else str(row["page_id"])
                what = f"{page}:{row['digest']}:{row['url']}"
                times[what] += 1  # rows that are equal have names of their own
                name = str(uuid.uuid5(spaces, f"{part}:{times[what]}:{what}"))
                for r in page_records(name, date, page, row["url"] or "", payload, row["digest"], row["refers"], segment):
                    out.write(r)
                if row["referred"]:
                    named.append((None, row["page_id"], row["digest"], name))
                if out.tell() >= file_bytes:
                    yield close()
                    out, n = None, n + 1
        if out is not None:
            yield close()

    return run


def members(stream, size: int = 65_536) -> Iterator[bytes]:
    """The gzip members of a file."""
    z, parts = zlib.decompressobj(31), []
    while data := stream.read(size):
        while data:
            parts.append(z.decompress(data))
            data = z.unused_data
            if z.eof:
                yield b"".join(parts)
                z, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the last member is cut off")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """A record's fields and block."""
    end = raw.index(b"\r\n\r\n")
    first, *lines = raw[:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no record begins here")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    size = int(fields["Content-Length"])
    block = raw[end + 4 : end + 4 + size]
    if len(block) != size or raw[end + 4 + size :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, block


_RECORDS = pa.schema([("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("kind", pa.string()), ("page", pa.string()), ("digest", pa.string()), ("refers", pa.string()), ("block", pa.binary())])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["path"].to_pylist():
            store, name = fs.FileSystem.from_uri(path)
            rows, held = [], 0
            with store.open_input_stream(name, compression=None) as stream:
                for raw in members(stream):
                    f, block = parsed(raw)
                    number = int(f.get("WARC-Segment-Number", 0))
                    rows.append({"origin": f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]), "number": number, "total": int(f.get("WARC-Segment-Total-Length", 0)), "kind": f["WARC-Type"], "page": f.get("WARC-Page"), "digest": f.get("WARC-Payload-Digest"), "refers": f.get("WARC-Refers-To"), "block": block})
                    held += len(block)
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_pylist(rows, _RECORDS)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _RECORDS)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            block = b"".join(row["blocks"])
            if row["total"] not in (0, len(block)) or (len(row["blocks"]) > 1 and not row["total"]):
                raise ValueError(f"segments of {row['page']} don't add up")
            size, digest = None, row["digest"].removeprefix("sha256:")
            if row["kind"] == "response":
                payload = unchunked(block[block.index(b"\r\n\r\n") + 4 :])
                size = len(payload)
                if hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"the payload of {row['page']} is damaged")
            page = None if row["page"] == "null" else int(row["page"])
            out.append((page, size, digest, row["kind"], row["origin"], row["refers"]))
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "name", "refers"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=names)


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) under ``path``; returns the files' paths."""
    ship(pages.sparkSession)
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("digest"))
    long = F.coalesce(F.octet_length("html"), F.lit(0)) >= MIN_SHARED
    shared = written(rows.where(long).groupBy("digest").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "least"))
    rows = rows.join(maybe_broadcast(shared, BROADCAST_ROWS), "digest", "left")
    again = F.coalesce(F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least")), F.lit(False))
    put = lambda rows, kind: written(rows.mapInArrow(_write(path, kind, date, segment, file_bytes), _WRITTEN))
    columns = ["page_id", "url", "html", "digest"]
    responses = put(rows.where(~again).select(*columns, F.lit(None).cast("string").alias("refers"), F.col("least").isNotNull().alias("referred")), "response")
    names = responses.where("name is not null").groupBy(F.col("page").alias("least"), "digest").agg(F.min("name").alias("refers"))  # rows may share page and payload
    visits = rows.where(again).select("page_id", "url", F.lit(None).cast("string").alias("html"), "digest", "least")
    visits = visits.join(maybe_broadcast(names, BROADCAST_ROWS), ["least", "digest"], "left").select(*columns, "refers", F.lit(False).alias("referred"))
    return responses.where("path is not null").select("path").union(put(visits, "revisit").where("path is not null").select("path"))


def read_archives(files: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page in the files."""
    ship(files.sparkSession)
    schema = "origin string, number long, total long, kind string, page string, digest string, refers string, block binary"
    found = files.repartition(max(1, files.count())).mapInArrow(_records, schema)  # a task for each file
    columns = ["origin", "kind", "page", "digest", "refers", "total"]
    whole = found.where("number = 0").select(*columns, F.array("block").alias("blocks"))
    parts = F.array_sort(F.collect_list(F.struct("number", "block")))  # one record's segments
    split = found.where("number > 0").groupBy("origin").agg(
        F.max(F.when(F.col("number") == 1, F.col("kind"))).alias("kind"), F.max("page").alias("page"), F.max("digest").alias("digest"), F.max("refers").alias("refers"), F.max("total").alias("total"), parts.alias("parts")
    )
    split = split.select(*columns, F.col("parts.block").alias("blocks"))
    pages = written(whole.union(split).mapInArrow(_decoded, "page_id long, payload_bytes long, payload_digest string, record_type string, name string, refers string"))
    visits = pages.where("record_type = 'revisit'").drop("payload_bytes", "name")
    responses = pages.where("record_type = 'response'")
    named = responses.join(visits.select(F.col("refers").alias("name")).distinct(), "name", "left_semi")
    named = named.select(F.col("name").alias("refers"), F.col("page_id").alias("refers_to"), "payload_bytes", F.col("payload_digest").alias("held"))
    visits = visits.join(maybe_broadcast(named, BROADCAST_ROWS), "refers", "left")
    known = F.when(F.col("held") == F.col("payload_digest"), F.col("payload_bytes")).otherwise(F.raise_error(F.lit("a revisit refers to no response with its payload")))
    result = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    visits = visits.withColumn("payload_bytes", known).select(*result)
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(*result).unionByName(visits)


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes and reads back, by default in a new folder on shared storage."""
    path = path or shared_dir(pages.sparkSession)
    return read_archives(write_archives(pages, path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}"))
