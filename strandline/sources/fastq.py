"""FASTQ reader as a Python Data Source.

    spark.dataSource.register(FastqDataSource)
    reads = spark.read.format("fastq").option("readtag", "_R[12]_").load("/data/*.fastq.gz")

Rows: sample, mate (1/2), ordinal (0-based record index in the file), read_id,
seq, qual, handed over in Arrow batches.  Paths are local ones or URIs of any file system that Arrow
knows (``file:``, ``hdfs:``, ``s3:``, ``gs:``), listed and opened through it, so files need only be on shared
storage.  ``max_reads`` stops each file after n records (the first-n screen
input), so the rest of a large file is never decompressed.  A file is one partition, since gzip is not
splittable; ``split_bytes`` reads plain and block-gzip files in byte ranges instead, where ``ordinal`` is the
record's byte offset (growing along the file, not dense); in block-gzip files, whose blocks of at most 64 KB can
be inflated one by one, it is the virtual offset: the block's offset times 65,536 plus the offset inside it.

Filters on ``sample`` and ``mate`` leave out whole files, a filter ``ordinal < n`` ends each file after n
records (``spark.sql.python.filterPushdown.enabled``, which ``session.configure`` sets).  Land the result
once as Parquet: every later job then reads a splittable, column-pruned table.
"""

from __future__ import annotations

import fnmatch
import io
import os
import re
import struct
import zlib

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import LongType, StringType, StructField, StructType, ByteType

BATCH_RECORDS = 8192

FASTQ_SCHEMA = StructType([
    StructField("sample", StringType()), StructField("mate", ByteType()), StructField("ordinal", LongType()),
    StructField("read_id", StringType()), StructField("seq", StringType()), StructField("qual", StringType()),
])
DEFAULT_READTAG = "_R[12]_"


def sample_and_mate(path: str, readtag: str = DEFAULT_READTAG) -> tuple[str, int]:
    """Path -> (sample, mate): the folders ``sample=.../mate=...`` that the FASTQ sink writes; else of the file name the
    part before the read tag, and the tag's digit (1 when absent)."""
    name = os.path.basename(path)
    folder = re.search(r"/sample=([^/]*)/(?:mate=(\d)/)?[^/]*$", path)
    if folder:
        return folder[1], int(folder[2] or 1)
    m = re.search(readtag, name) if readtag else None
    if m:
        digits = re.findall(r"\d", m.group(0))
        return name[:m.start()], int(digits[-1]) if digits else 1
    return re.sub(r"\.(fastq|fq)(\.gz)?$", "", name), 1


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else f"file://{os.path.abspath(path)}")


def expand(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that a comma list of paths, folders and name patterns stands for."""
    from pyarrow import fs

    found = []
    for part in path.split(","):
        folder, _, name = part.rpartition("/")
        if not re.search(r"[*?\[]", name):
            system, inner = _file_system(part)
            info = system.get_file_info(inner)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(part)
            if info.type == fs.FileType.File:
                found.append((part, info.size))
                continue
            folder, name = part.rstrip("/"), "*"
        system, inner = _file_system(folder or ".")
        files = system.get_file_info(fs.FileSelector(inner, recursive=name == "*"))
        below = {i.path: i.path[len(inner.rstrip("/")) + 1:] for i in files}
        found += [(f"{folder}/{below[i.path]}" if folder else below[i.path], i.size) for i in files
                  if i.type == fs.FileType.File and fnmatch.fnmatch(i.base_name, name) and i.base_name[0] not in "_."
                  and all(x.startswith(("sample=", "mate=")) for x in below[i.path].split("/")[:-1])]
    return sorted(found)


class _FilePartition(InputPartition):
    def __init__(self, path: str, start: int, stop: int | None):
        super().__init__(path)
        self.path, self.start, self.stop = path, start, stop


def _lines(stream, at: int):
    """(offset, line) of a binary stream that begins at offset ``at``."""
    reader = io.BufferedReader(stream, 1 << 20)
    for line in reader:
        yield at, line
        at += len(line)


def _from_record(lines):
    """``lines`` from the first record on: an @ line whose next but one is a + line, with sequence and qualities of one
    length.  The first line given is what is left of the line that the range begins in."""
    next(lines, None)
    window = []
    for pair in lines:
        window.append(pair)
        if len(window) == 4:
            (_, head), (_, seq), (_, plus), (_, qual) = window
            if head[:1] == b"@" and plus[:1] == b"+" and len(seq.rstrip()) == len(qual.rstrip()):
                yield from window
                yield from lines
                return
            window.pop(0)


BLOCK_MAX = 1 << 16  # fixed value: no block of a block-gzip file is longer


def _block_size(head: bytes) -> int:
    """Length of the block-gzip block that begins with ``head``, 0 if none does."""
    if len(head) < 18 or head[:4] != b"\x1f\x8b\x08\x04":
        return 0
    extra, at = head[12:12 + struct.unpack_from("<H", head, 10)[0]], 0
    while at + 4 <= len(extra):
        name, n = extra[at:at + 2], struct.unpack_from("<H", extra, at + 2)[0]
        if name == b"BC" and n == 2 and at + 6 <= len(extra):
            return struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + n
    return 0


def _blocks(f, at: int):
    """(offset, bytes) of each block from ``at`` to the end of a block-gzip file."""
    size = f.size()
    while at < size:
        f.seek(at)
        head = f.read(min(BLOCK_MAX, size - at))
        n = _block_size(head)
        if not n or n > len(head):
            raise ValueError(f"no block-gzip block at {at}")
        yield at, zlib.decompress(head[:n], 31)
        at += n


def _block_before(f, start: int) -> int:
    """Offset of a block that begins before ``start`` and ends at or behind it, or of one before that: a place in the
    64 KB before from which headers chain up to ``start``."""
    low = max(0, start - 2 * BLOCK_MAX)
    if not low:
        return 0
    f.seek(low)
    data = f.read(min(f.size(), start + 3 * BLOCK_MAX) - low)
    at = data.find(b"\x1f\x8b\x08\x04")
    while 0 <= at < start - low:
        p, steps = at, 0
        while (n := _block_size(data[p:p + 512])) and p + n <= len(data):
            p, steps = p + n, steps + 1
            if p >= start - low and steps > 1 and (p == len(data) or _block_size(data[p:p + 512])):
                return low + at
        at = data.find(b"\x1f\x8b\x08\x04", at + 1)
    raise ValueError(f"no block-gzip block near {start}")


def _block_lines(blocks):
    """(virtual offset, line) of consecutive blocks."""
    rest, begun = b"", None
    for at, data in blocks:
        lo = 0
        while (end := data.find(b"\n", lo)) >= 0:
            yield (begun if rest else at << 16 | lo), rest + data[lo:end + 1]
            rest, lo = b"", end + 1
        if lo < len(data):
            begun = begun if rest else at << 16 | lo
            rest += data[lo:]
    if rest:
        yield begun, rest


def _block_range(f, start: int):
    """(virtual offset, line) from the end of the line that is open when the block at or behind ``start`` begins."""
    def seen():
        last = b"\n"
        for at, data in _blocks(f, _block_before(f, start)):
            if at < start:
                last = data[-1:] or last
            else:
                if last is not None:
                    # one byte of what came before, so that a line that begins with the block is not taken for a rest
                    yield None, last
                    last = None
                yield at, data

    blocks = seen()
    first = next(blocks, None)
    if first is None:
        return
    lines = _block_lines(blocks)
    if first[1] == b"\n":
        yield start << 16, b"\n"  # the line before is whole
    yield from lines


class FastqReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], readtag: str, max_reads: int, split_bytes: int):
        self.files, self.readtag, self.max_reads, self.split_bytes = files, readtag, max_reads, split_bytes

    @staticmethod
    def _splits(path: str) -> bool:
        """Plain files, and gzip files whose first member is a block."""
        if not path.endswith(".gz"):
            return True
        system, inner = _file_system(path)
        with system.open_input_file(inner) as f:
            return _block_size(f.read(512)) > 0

    def partitions(self):
        out = []
        for path, size in self.files:
            if self.split_bytes > 0 and size and self._splits(path):
                out += [_FilePartition(path, a, min(a + self.split_bytes, size)) for a in range(0, size, self.split_bytes)]
            else:
                out.append(_FilePartition(path, 0, None))
        return out

    def _records(self, partition):
        system, inner = _file_system(partition.path)
        if partition.stop is None:
            with system.open_input_stream(inner, compression="detect") as stream:
                yield from ((k, *r) for k, r in enumerate(self._four(_lines(stream, 0), None)))
            return
        begin, stop = partition.start, partition.stop
        with system.open_input_file(inner) as f:
            if partition.path.endswith(".gz"):
                lines = _from_record(_block_range(f, begin)) if begin else _block_lines(_blocks(f, 0))
                stop <<= 16
            else:
                f.seek(max(0, begin - 1))
                lines = _from_record(_lines(f, begin - 1)) if begin else _lines(f, 0)
            for at, *r in self._four(lines, stop, offsets=True):
                yield (at, *r)

    @staticmethod
    def _four(lines, stop, offsets: bool = False):
        for at, head in lines:
            if stop is not None and at >= stop:
                return
            seq, _, qual = (next(lines, (0, b""))[1] for _ in range(3))
            head = head.decode().rstrip("\r\n")
            read_id = head[1:].split()[0] if head.startswith("@") and len(head) > 1 else head.strip()
            record = (read_id, seq.decode().rstrip("\r\n"), qual.decode().rstrip("\r\n"))
            yield (at, *record) if offsets else record

    def read(self, partition):
        import pyarrow as pa

        sample, mate = sample_and_mate(partition.path, self.readtag)
        schema = pa.schema([("sample", pa.string()), ("mate", pa.int8()), ("ordinal", pa.int64()), ("read_id", pa.string()),
                            ("seq", pa.string()), ("qual", pa.string())])

        def batch(rows):
            ordinal, read_id, seq, qual = zip(*rows)
            n = len(rows)
            return pa.record_batch([pa.array(c, t.type) for c, t in zip(
                ([sample] * n, [mate] * n, ordinal, read_id, seq, qual), schema)], schema=schema)

        rows, n = [], 0
        for record in self._records(partition):
            if 0 <= self.max_reads <= n:
                break
            rows.append(record)
            n += 1
            if len(rows) == BATCH_RECORDS:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)


class FilteringFastqReader(FastqReader):
    """Takes filters on sample and mate as a choice of files, and ``ordinal < n`` as the place to stop."""

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in ("sample", "mate") and isinstance(f, (EqualTo, In)):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                at = ("sample", "mate").index(column)
                self.files = [x for x in self.files if sample_and_mate(x[0], self.readtag)[at] in wanted]
            elif column == "ordinal" and isinstance(f, (LessThan, LessThanOrEqual)) and not self.split_bytes:
                n = max(0, int(f.value) + isinstance(f, LessThanOrEqual))
                self.max_reads = n if self.max_reads < 0 else min(n, self.max_reads)
            else:
                yield f


class FastqDataSource(DataSource):
    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return FASTQ_SCHEMA

    def reader(self, schema):
        split, most = int(self.options.get("split_bytes", "0")), int(self.options.get("max_reads", "-1"))
        if split > 0 and most >= 0:
            raise ValueError("max_reads counts from the start of a file; it does not go with split_bytes")
        kind = FilteringFastqReader if self.options.get("push_filters", "false") == "true" else FastqReader
        return kind(expand(self.options.get("path")), self.options.get("readtag", DEFAULT_READTAG), most, split)


def read_fastq(spark, path: str, *, readtag: str = DEFAULT_READTAG, max_reads: int = -1, split_bytes: int = 0):
    """FASTQ file(s) (folder, name pattern or comma list, plain or gz) -> reads."""
    spark.dataSource.register(FastqDataSource)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return (spark.read.format("fastq").option("readtag", readtag).option("max_reads", str(max_reads))
            .option("split_bytes", str(split_bytes)).option("push_filters", push).load(path))


def land_fastq(spark, path: str, out: str, **kw) -> None:
    """Read FASTQ once and land it as Parquet partitioned by sample (splittable for every later job)."""
    read_fastq(spark, path, **kw).write.mode("overwrite").partitionBy("sample").parquet(out)
