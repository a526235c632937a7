"""WARC archives as record tables ``(file, rec_no, payload)``.

A payload is the record text after its ``WARC/1.0`` marker line and before
the next one (the text before the first marker is an empty payload).

* ``read_warc`` (fast path): Spark's text source with the marker as line
  separator, gzip included.  Needs CRLF marker lines; a line that merely
  *ends* in the marker also splits.  Invalid UTF-8 becomes U+FFFD.
* ``read_warc_exact`` (the default of the jobs): a Python data source that
  streams files in blocks as Arrow batches with undecodable bytes dropped and
  newlines unified; only a line equal to ``WARC/1.0`` (after strip) splits.
  Files are listed on the driver and read by the tasks through pyarrow's
  file systems (local, S3, HDFS, GCS).  A ``.gz`` file of many members (as
  crawls write them) is read in byte ranges of ``splitBytes``, one task each.

Both give ``rec_no`` as an order key (increasing in file order, not dense).
A gzip file of one member is one task: ``spread`` re-partitions the
records by (file, rec_no) before the costly per-record work.

Byte ranges: a gzip member is found by its magic bytes and verified by
inflating it to its end, checksum included, and by what follows it.  A range reads the members that begin
in it.  A record belongs to the range in whose members its marker line
begins: text before a range's first marker is left to the ranges before, and
the last record is read on through the members that follow, up to the next
marker.  Whether a member begins at a line start is told by the member before
it, which is searched backwards in the same way.
"""

from __future__ import annotations

import fnmatch
import gzip
import itertools
import os
import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MARKER = "WARC/1.0"
SCHEMA = "file string, rec_no bigint, payload string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Fast path: one row per record via a multi-character line separator."""
    raw = spark.read.option("lineSep", MARKER + "\r\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"),
                      F.monotonically_increasing_id().alias("rec_no"),
                      F.col("value").alias("payload"))


# A marker line: the marker with any white space around it.
_MARKER_LINE = re.compile(rf"^[^\S\n]*{re.escape(MARKER)}[^\S\n]*(?:\n|\Z)", re.MULTILINE)


def scan_blocks(blocks):
    """Payloads between marker lines of a text that arrives in blocks of any size.

    Each block is searched up to its last line end; what follows waits for
    the next block, so a marker line is seen whole wherever blocks are cut.
    """
    open_record, tail = [], ""
    for block in itertools.chain(blocks, [None]):
        text = tail if block is None else tail + block
        stop = len(text) if block is None else text.rfind("\n") + 1
        begin = 0
        for mark in _MARKER_LINE.finditer(text, 0, stop):
            yield "".join([*open_record, text[begin:mark.start()]])
            open_record, begin = [], mark.end()
        open_record.append(text[begin:stop])
        tail = text[stop:]
    yield "".join(open_record)


class _FilePartition(InputPartition):
    """A whole file (``stop`` None), or the gzip members that begin at bytes ``start`` to ``stop``."""

    def __init__(self, path: str, start: int = 0, stop: int | None = None):
        super().__init__((path, start, stop))
        self.path, self.start, self.stop = path, start, stop


SPLIT_BYTES = 64 << 20
MAGIC = b"\x1f\x8b\x08"


def inflate_member(data, at: int, piece: int = 1 << 18):
    """The member of ``data`` (anything with ``read_at`` and ``size``) that begins at ``at``, in pieces: (bytes, end).

    ``end`` is None until the last piece, then where the member ends.  Raises ``zlib.error`` where no whole
    member with a right checksum begins.
    """
    z, pos = zlib.decompressobj(31), at
    while not z.eof:
        raw = data.read_at(min(piece, data.size - pos), pos) if pos < data.size else b""
        if not raw:
            raise zlib.error("no whole member")
        pos += len(raw)
        out = z.decompress(raw)
        yield out, pos - len(z.unused_data) if z.eof else None


def member_end(data, at: int) -> tuple[int, bytes] | None:
    """Where the verified member at ``at`` ends, and its last byte; None where none begins."""
    last = b""
    try:
        for out, end in inflate_member(data, at):
            last = out[-1:] or last
    except zlib.error:
        return None
    return end, last


STORED = 65_535  # bytes of the longest stored (uncompressed) block


def is_member(data, at: int) -> bool:
    """Whether a member of the file itself begins at ``at``.

    A record may hold a gzip file, and a stored block holds its bytes as they
    are; such an inner member is followed by the rest of the outer one.  So the
    members from ``at`` on must follow each other to the file's end or beyond a stored block.
    """
    pos = at
    while pos < data.size and pos - at <= STORED:
        whole = member_end(data, pos)
        if whole is None:
            return False
        pos = whole[0]
    return True


def first_member(data, start: int, stop: int, window: int = 1 << 20) -> int | None:
    """The first verified member start in bytes ``start`` to ``stop``."""
    while start < stop:
        raw = data.read_at(min(window, data.size - start), start)
        at = raw.find(MAGIC)
        while at >= 0 and start + at < stop:
            if is_member(data, start + at):
                return start + at
            at = raw.find(MAGIC, at + 1)
        start += max(1, len(raw) - len(MAGIC) + 1)
    return None


def byte_before(data, at: int, window: int = 1 << 20) -> bytes:
    """The last inflated byte before the member at ``at``; empty at the file's start.

    Members that are empty have no last byte: the search goes on before them.
    """
    while at:
        found, low = None, at
        while found is None and low:
            high, low = low, max(0, low - window)
            raw = data.read_at(min(high - low + len(MAGIC) - 1, at - low), low)
            pos = raw.rfind(MAGIC)
            while pos >= 0 and found is None:
                whole = member_end(data, low + pos)
                if whole and whole[0] == at:
                    found = low + pos, whole[1]
                pos = raw.rfind(MAGIC, 0, pos + len(MAGIC) - 1) if pos else -1
        if found is None:
            return b""
        at, last = found
        if last:
            return last
    return b""


class _Unified:
    """Bytes to text as the text mode does it: undecodable bytes dropped, line ends unified."""

    def __init__(self):
        import codecs
        import io

        self.decoder = io.IncrementalNewlineDecoder(codecs.getincrementaldecoder("utf-8")("ignore"), translate=True)

    def text(self, raw: bytes, final: bool = False) -> str:
        return self.decoder.decode(raw, final)


def range_records(data, start: int, stop: int):
    """Payloads of the records whose marker line begins in a gzip member that begins in bytes ``start`` to ``stop``.

    The range at 0 also has the text before the first marker, as the whole file read at once has.
    """
    first = 0 if start == 0 else first_member(data, start, stop)
    if first is None or first >= data.size:
        return
    fresh = byte_before(data, first) in (b"", b"\n", b"\r")

    def blocks():
        """(text, whether it begins in the range): one block or more for each member."""
        at, unify = first, _Unified()
        while at < data.size:
            end = None
            for out, end in inflate_member(data, at):
                yield unify.text(out), at < stop
            at = end
        yield unify.text(b"", True), False

    record: list[str] | None = [] if start == 0 else None  # None: no marker seen yet
    tail, tail_own = "", True  # the line begun but not ended, and whether it began in the range
    at_line_start = fresh
    for text, own in itertools.chain(blocks(), [(None, False)]):
        final = text is None
        if not tail:
            tail_own = own
        whole = tail + (text or "")
        cut = len(whole) if final else whole.rfind("\n") + 1
        done, tail_len = whole[:cut], len(tail)
        pos = 0
        if not at_line_start and done:  # the rest of a line that began before the range is no marker line
            pos = (done.find("\n") + 1) or len(done)
            if record is not None:
                record.append(done[:pos])
            at_line_start = True
        for mark in _MARKER_LINE.finditer(done, pos):
            mine = tail_own if mark.start() < tail_len else own
            if record is not None:
                yield "".join([*record, done[pos:mark.start()]])
            record = [] if mine else None
            pos = mark.end()
            if not mine:
                return
        if record is not None:
            record.append(done[pos:])
        elif not own and not tail_own:
            return  # past the range without a marker in it
        tail_own = own if cut > tail_len or not tail else tail_own
        tail = whole[cut:]
    if record is not None:
        yield "".join(record)


def _fs_and_path(uri: str):
    """A pyarrow file system for any URI it supports (local, s3, hdfs, gs)."""
    from pyarrow import fs as pafs

    if "://" not in uri:
        uri = "file://" + os.path.abspath(uri[len("file:"):] if uri.startswith("file:") else uri)
    elif uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options.get("path")
        self.split = int(options.get("splitBytes") or SPLIT_BYTES)

    def partitions(self):
        """The data files, listed once on the driver; a large ``.gz`` file in byte ranges."""
        from pyarrow import fs as pafs

        fsys, base = _fs_and_path(self.path)
        info = fsys.get_file_info(base)
        if info.type == pafs.FileType.Directory:
            infos = fsys.get_file_info(pafs.FileSelector(base, recursive=True))
            files = sorted((i.path, i.size) for i in infos if i.type == pafs.FileType.File
                           and not os.path.basename(i.path).startswith(("_", ".")))
        elif info.type == pafs.FileType.File:
            files = [(base, info.size)]
        else:  # a pattern over the files of one folder
            folder, _, pattern = base.rpartition("/")
            wanted = re.compile(fnmatch.translate(pattern))
            infos = fsys.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
            files = sorted((i.path, i.size) for i in infos if i.type == pafs.FileType.File and wanted.match(i.base_name))
        if not files:
            raise FileNotFoundError(f"no WARC file at {self.path}")
        scheme = self.path.split("://", 1)[0] + "://" if "://" in self.path else ""
        parts = []
        for f, size in files:
            uri = scheme + f if scheme and not f.startswith(scheme) else f
            if f.endswith(".gz") and size > self.split:
                parts += [_FilePartition(uri, at, min(size, at + self.split)) for at in range(0, size, self.split)]
            else:
                parts.append(_FilePartition(uri))
        return parts

    def read(self, partition):
        """Stream one file (gzip by name) or one range of it as Arrow batches, undecodable bytes dropped."""
        import io

        import pyarrow as pa

        f = partition.path
        fsys, p = _fs_and_path(f)

        def batch(first, rows):
            numbers = pa.array(range(first, first + len(rows)), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([f] * len(rows)), numbers, pa.array(rows, pa.string())],
                                              ["file", "rec_no", "payload"])

        def batches(payloads, first):
            rows, size = [], 0
            for payload in payloads:
                rows.append(payload)
                size += len(payload)
                if size > 1 << 22:
                    yield batch(first, rows)
                    rows, first, size = [], first + len(rows), 0
            if rows:
                yield batch(first, rows)

        if partition.stop is not None:
            with fsys.open_input_file(p) as raw:
                # a number above those of all ranges before: a range has fewer records than bytes times the largest ratio of gzip
                yield from batches(range_records(_Bytes(raw), partition.start, partition.stop), partition.start * 1032)
            return
        with fsys.open_input_stream(p, compression=None) as raw:  # python gzip: multi-member files
            binary = gzip.GzipFile(fileobj=raw) if f.endswith(".gz") else raw
            with io.TextIOWrapper(binary, encoding="utf-8", errors="ignore") as text:
                yield from batches(scan_blocks(iter(lambda: text.read(1 << 20), "")), 0)


class _Bytes:
    """Reads of a pyarrow file at any place."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def read_at(self, n: int, at: int) -> bytes:
        return self.file.read_at(n, at)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)`` after ``register_warc(spark)``."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)


def register_warc(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def read_warc_exact(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    register_warc(spark)
    return spark.read.format("warc").option("splitBytes", str(split_bytes)).load(path)


def spread(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread records of few large files over the cluster (hash of file, rec_no)."""
    n = partitions or records.sparkSession.sparkContext.defaultParallelism
    return records.repartition(n, "file", "rec_no")


def write_warc(records: DataFrame, path: str, payload_col: str = "payload", compression: str = "gzip") -> None:
    """Write payloads as WARC text files: marker line + payload, CRLF line ends."""
    body = F.regexp_replace(F.col(payload_col), r"\r?\n", "\r\n")
    records.select(F.concat(F.lit(MARKER + "\r\n"), body).alias("value")).write.mode("overwrite") \
        .option("lineSep", "\r\n").option("compression", compression).text(path)
