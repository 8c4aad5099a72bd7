"""WARC archives of pages: a writer, and a reader that splits compressed archives.

Each record is a gzip member of its own. A reading task takes a byte range of an archive,
looks for gzip's magic bytes in it, accepts a place only if what follows inflates to a record
header, and owns exactly the records that start inside its range, whose ends may lie beyond.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from opsledger.llm.common import checkpoint, shared_dir, table

LEAST = 1000  # bytes of a payload that others may revisit
RANGE = 32 << 20
MAGIC = b"\x1f\x8b\x08"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    body = b"" if refers_to is not None else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", "WARC-Record-ID: <urn:page:%s>" % ("" if page_id is None else page_id), "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.encode("unicode_escape").decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


def decide(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with digest and refers_to (null: a response).

    Of equal payloads of LEAST bytes or more the largest page_id is the response; rows that
    repeat it are responses too, and so is every row of a payload whose ids are all null. A null
    html is an empty payload; an empty table gives an empty result; other columns play no part.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    long, short = p.where(F.octet_length("html") >= LEAST), p.where(F.octet_length("html") < LEAST)
    # stored, so that the join has plain exchanges on both sides, of which Spark splits the one with many equal payloads
    largest = checkpoint(long.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n"))
    met = long.join(largest, "digest", "left").withColumn("refers_to", F.expr("if(page_id <=> response, null, response)")).drop("response")
    return met.unionByName(short.withColumn("refers_to", F.lit(None).cast(pages.schema["page_id"].dataType)))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``pages`` (as of ``decide``) as archives under ``folder``; (path, bytes) of each.

    A task's archive has a name of its own attempt, so only those of tasks that succeeded count.
    No rows make no archive.
    """
    where, root = _place(folder)
    where.create_dir(root, recursive=True)

    def put(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = TaskContext.get()
        path = f"{folder}/{t.partitionId():06d}-{t.taskAttemptId()}.warc.gz"
        where, name = _place(path)
        size, out = 0, None
        for p in parts:
            for page_id, url, html, digest, refers in zip(p["page_id"], p["url"], p["html"], p["digest"], p["refers_to"], strict=True):
                out = out or where.open_output_stream(name, compression=None, buffer_size=1 << 20)
                b = _member(None if page_id is None else int(page_id), url, html.encode("utf-8", "surrogatepass"), digest, None if refers is None else int(refers))
                out.write(b)
                size += len(b)
        if out:
            out.close()
            yield pd.DataFrame({"path": [path], "bytes": [size]})

    ids = pages.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return checkpoint(ids.select("page_id", "url", "html", "digest", "refers_to").mapInPandas(put, "path string, bytes long"))


def _header(b: bytes) -> bool:
    """Whether a record's header inflates from the start of ``b``."""
    try:
        return zlib.decompressobj(31).decompress(b, 16).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _record(b: bytes) -> tuple:
    head, _, rest = b.partition(b"\r\n\r\n")
    f = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    page = f["WARC-Record-ID"][10:-1]
    url = f.get("WARC-Target-URI")
    kind = f["WARC-Type"]
    body = rest[: int(f["Content-Length"])]
    if kind == "revisit":
        size, digest, payload = int(f["X-Payload-Length"]), f["WARC-Payload-Digest"].split(":")[1], None
    else:
        payload = body.partition(b"\r\n\r\n")[2]
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if f["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"the payload of record {page} doesn't match its digest")
    refers = f["WARC-Refers-To"][10:-1] if kind == "revisit" else None
    return page or None, None if url is None else url.encode().decode("unicode_escape"), size, digest, kind, refers, payload


def scan(path: str, start: int, end: int, step: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive that start in bytes [start, end)."""
    where, name = _place(path)
    with where.open_input_file(name) as f:
        total, at, held, base = f.size(), start, b"", start  # held: bytes from base on

        def more() -> bool:
            nonlocal held
            f.seek(base + len(held))
            got = f.read(step)
            held += got
            return bool(got)

        while at < end:
            held, base = held[at - base :], at
            if len(held) < 4096:
                more()
            k = held.find(MAGIC)
            if k < 0:
                at = base + max(1, len(held) - 2)
                if at >= total - 2:
                    return
                continue
            at = base + k
            if at >= end:
                return
            if len(held) - k < 512 and more():
                continue
            if not _header(held[k : k + 512]):
                at += 1
                continue
            z, out = zlib.decompressobj(31), []
            held, base = held[k:], at
            feed, used = held, len(held)
            while True:
                out.append(z.decompress(feed))
                if z.eof:
                    break
                f.seek(base + used)
                feed = f.read(step)
                if not feed:
                    raise EOFError(f"{path}: the record at {at} has no end")
                held += feed
                used += len(feed)
            at = base + used - len(z.unused_data)
            yield b"".join(out)


def read(archives: DataFrame, span: int = RANGE, payloads: bool = True) -> DataFrame:
    """The records of ``archives`` (path, bytes), as of READ; ``span``: bytes of a task's range. No archives, or empty ones, give no records."""

    def records(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in READ.split(", ")]
        for p in parts:
            for path, start, end in zip(p["path"], p["start"], p["end"], strict=True):
                rows, held = [], 0
                for b in scan(path, int(start), int(end)):
                    r = _record(b)
                    rows.append(r if payloads else (*r[:6], None))
                    held += len(b) if payloads else 200
                    if held > 4 << 20:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    ranges = archives.where("bytes > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(span).cast("long"))).alias("start"), "bytes").select("path", "start", F.least(F.col("start") + span, F.col("bytes")).alias("end"))
    out = ranges.repartition(max(1, ranges.count())).mapInPandas(records, READ.replace("page_id long", "page_id string").replace("refers_to long", "refers_to string"))  # a task a range
    return out.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    archives = write(decide(table(spark, sf_dir, "pages")), folder)
    return read(archives, payloads=False).drop("payload", "url")
