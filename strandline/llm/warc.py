"""WARC archives: writing, normalising a monolithic gzip stream, reading by offset.

``write`` gives each task's pages as one gzip stream per archive (the monolithic form, whose
records cannot be reached singly).  ``normalise`` inflates every such file once, front to
back, rewrites each record as its own gzip member and writes a sidecar of offsets beside it, one JSON
line per record.  ``read`` goes through the sidecars and opens each record by its offset.

Equal payloads (of at least ``min_bytes``) are stored once: by the record of the smallest page id;
the others are revisits that hold headers only.

Defined cases: a null html is an empty payload; a null url leaves its header out; a null page id is a
response of its own and never the target of a revisit; rows that repeat the smallest id are all
responses; payloads of any length pass through a stream, one record at a time; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import saved, shared_path
from strandline.llm.files import new_file, opened

ARCHIVE_BYTES = 64 << 20  # payload bytes after which a new archive is begun
LEVEL = 1
CHUNK = 1 << 20
GROUPS_BROADCAST = 1_000_000  # groups of equal payloads (about 40 bytes each) that may be broadcast, after counting
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id) -> str:
    return f"<urn:page:{'' if pd.isna(page_id) else int(page_id)}>"


def _page(name: str | None) -> int | None:
    number = (name or "").rpartition(":")[2].rstrip(">")
    return int(number) if number else None


def record(page_id, url: str | None, payload: bytes, first=None) -> bytes:
    """One WARC record: a response, or with ``first`` (a page id) a revisit of that page."""
    revisit = first is not None
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _name(page_id), "WARC-Date": DATE,
            "WARC-Payload-Digest": f"sha1:{digest(payload)}", "X-Payload-Length": str(len(payload)),
            "Content-Type": "application/http; msgtype=response"}
    if url is not None:
        head["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    if revisit:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = _name(first)
    body = HTTP if revisit else HTTP + payload
    head["Content-Length"] = str(len(body))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + body + b"\r\n\r\n"


def headers(raw: bytes) -> dict[str, str]:
    found = {}
    for line in raw.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        k, sep, v = line.partition(":")
        if sep:
            found[k.strip().lower()] = v.strip()
    return found


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file, chunk by chunk, whatever its number of members.  A file that ends before its last
    member's check sum raises."""
    unzip, inside = zlib.decompressobj(31), False
    while data := stream.read(CHUNK):
        while data:
            out = unzip.decompress(data)
            if out:
                yield out
            data, inside = unzip.unused_data, not unzip.eof
            if unzip.eof:
                unzip = zlib.decompressobj(31)
    if inside:
        raise ValueError("the archive ends inside a gzip member")


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of each record of a WARC byte stream; holds one record at a time."""
    buffer = bytearray()
    for chunk in chunks:
        buffer += chunk
        at = 0
        while True:
            end = buffer.find(b"\r\n\r\n", at)
            if end < 0:
                break
            head = headers(bytes(buffer[at:end]))
            stop = end + 4 + int(head["content-length"]) + 4
            if len(buffer) < stop:
                break
            yield head, bytes(buffer[at:stop])
            at = stop
        del buffer[:at]
    if buffer.strip():
        raise ValueError("the archive ends inside a record")


def with_first(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, first): ``first`` is the smallest page id with an equal payload where that is
    another page."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    key = F.unhex(F.sha1("payload"))
    groups = saved(rows.where((F.length("payload") >= min_bytes) & F.col("page_id").isNotNull())
                   .select("page_id", key.alias("key")).groupBy("key")
                   .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
                   .where("first < last").select("key", "first"), "payload-groups")
    if groups.limit(GROUPS_BROADCAST + 1).count() <= GROUPS_BROADCAST:
        groups = F.broadcast(groups)
    out = rows.withColumn("key", key).join(groups, "key", "left")
    first = F.when((F.length("payload") >= min_bytes) & (F.col("first") < F.col("page_id")), F.col("first"))
    return out.select("page_id", "url", "payload", first.alias("first"))


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Archives of ``pages`` below ``folder``, each one gzip stream; returns (file, records)."""
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rows = (r for pdf in batches for r in zip(*(pdf[c] for c in ("page_id", "url", "payload", "first"))))
        made, row = [], next(rows, None)
        while row is not None:
            name, n, size = f"crawl-{part:06d}-{len(made):04d}.warc.gz", 0, 0
            zipped = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            with new_file(folder, name) as out:
                while row is not None and size < ARCHIVE_BYTES:
                    page_id, url, payload, first = row
                    payload = bytes(payload)
                    out.write(zipped.compress(record(page_id, url, payload, None if pd.isna(first) else first)))
                    n, size, row = n + 1, size + len(payload), next(rows, None)
                out.write(zipped.flush())
            made.append((name, n))
        yield pd.DataFrame(made, columns=["file", "records"])

    return saved(with_first(pages, min_bytes).mapInPandas(run, "file string, records long"), "archives")


def normalise(archives: DataFrame, source: str, folder: str) -> DataFrame:
    """Rewrite the archives (file) of ``source`` below ``folder``, one gzip member per record, each with a
    sidecar ``<file>.idx``; returns (file, records)."""
    def run(batches):
        system, path = opened(source)
        for pdf in batches:
            made = []
            for name in pdf["file"]:
                at = n = 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream, \
                        new_file(folder, name) as out, new_file(folder, f"{name}.idx") as index:
                    for head, raw in records(inflated(stream)):
                        pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = pack.compress(raw) + pack.flush()
                        out.write(member)
                        index.write(json.dumps({
                            "file": name, "offset": at, "length": len(member), "type": head["warc-type"],
                            "record_id": head["warc-record-id"], "uri": head.get("warc-target-uri")}).encode() + b"\n")
                        at, n = at + len(member), n + 1
                made.append((name, n))
            yield pd.DataFrame(made, columns=["file", "records"])

    spread = archives.select("file").repartition(max(1, archives.count()), "file")
    return saved(spread.mapInPandas(run, "file string, records long"), "archives")


INDEX = "file string, offset long, length long, type string, record_id string, uri string"
READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "file string, offset long")


def read_index(archives: DataFrame, folder: str) -> DataFrame:
    spark = archives.sparkSession
    if archives.limit(1).count() == 0:
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).json(f"{folder}/*.idx")


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of ``index`` (file, offset, length), each opened by its offset; a response's payload
    is checked against its digest."""
    def run(batches):
        system, path = opened(folder)
        name, file = None, None
        for pdf in batches:
            out = []
            for f, offset, length in zip(pdf["file"], pdf["offset"], pdf["length"]):
                if f != name:
                    name, file = f, system.open_input_file(f"{path}/{f}")
                raw = zlib.decompress(file.read_at(int(length), int(offset)), 31)
                end = raw.index(b"\r\n\r\n")
                head = headers(raw[:end])
                body = raw[end + 4:end + 4 + int(head["content-length"])]
                own = head["warc-payload-digest"].removeprefix("sha1:")
                size = int(head["x-payload-length"])
                if head["warc-type"] == "response":
                    payload = body[body.index(b"\r\n\r\n") + 4:]
                    if len(payload) != size or digest(payload) != own:
                        raise ValueError(f"{f} at {offset}: the payload does not match its digest")
                out.append((_page(head["warc-record-id"]), head.get("warc-target-uri"), size, own, head["warc-type"],
                            _page(head.get("warc-refers-to")), f, offset))
            cols = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset"]
            yield pd.DataFrame(out, columns=cols).astype({"page_id": "Int64", "refers_to": "Int64"})

    return index.mapInPandas(run, READ)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` through monolithic archives, normalised ones and back."""
    spark = pages.sparkSession
    raw, tidy = shared_path(spark, "warc-raw"), shared_path(spark, "warc")
    made = normalise(write(pages, raw, min_bytes), raw, tidy)
    return read(read_index(made, tidy), tidy)
