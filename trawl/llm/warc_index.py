"""WARC archives with payload deduplication, and their index by external merge.

``write_archives`` writes one gzip member per record; a task writes its own
files and returns their names, and only files named by finished tasks belong
to the archive, so a retried task leaves no half-written record behind.
``read_runs`` reads every archive file back and yields its captures sorted by
(URL key, timestamp, page): a run.  ``merge_runs`` deals all runs out over
key ranges (of key, timestamp and page, so one URL with very many captures
is split as well) and merges the slices of each range with a loser tree; the
ranges in order are the globally ordered capture histories.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trawl.llm.common import Scratch

MIN_REVISIT_BYTES = 100
FIRST_CAPTURE = datetime.datetime(2024, 1, 1)
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CAPTURES = ("page_id long, url_key string, captured_at string, payload_bytes long, payload_digest string, "
            "record_type string, refers_to long, file string, offset long, length long")
ORDER = ("url_key", "captured_at", "page_id")


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: captures of a host sort together."""
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", url or "")
    if not m:
        return url or ""
    return ",".join(reversed(m[1].lower().split("."))) + ")" + (m[2] or "/")


def capture_time(page_id: int | None) -> str:
    """The capture time given to a page that has none: seconds spread over a year by its id."""
    at = FIRST_CAPTURE + datetime.timedelta(seconds=(page_id or 0) * 7919 % 31_536_000)
    return at.strftime("%Y-%m-%dT%H:%M:%SZ")


def _fields(**items) -> bytes:
    lines = [f"{k.replace('_', '-')}: {v}" for k, v in items.items() if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def record_bytes(page_id, url, html: str | None, digest: str, n_bytes: int, refers_to) -> bytes:
    """One WARC record; a revisit carries the HTTP head only."""
    block = HTTP_HEAD if refers_to is not None else HTTP_HEAD + (html or "").encode("utf-8", "surrogatepass")
    head = _fields(
        WARC_Type="response" if refers_to is None else "revisit", WARC_Date=capture_time(page_id),
        WARC_Record_ID=f"<urn:page:{'' if page_id is None else page_id}>",
        WARC_Target_URI=None if url is None else re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url),
        WARC_Payload_Digest=f"sha256:{digest}", X_Payload_Bytes=n_bytes,
        WARC_Refers_To=None if refers_to is None else f"<urn:page:{refers_to}>",
        Content_Type="application/http; msgtype=response", Content_Length=len(block))
    return head + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, root: str, scratch: Scratch, max_bytes: int = 1 << 30) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``root``; returns the stored table of files (file, bytes).

    Of records with equal payloads of at least 100 bytes the one with the
    smallest page_id is the response and the others revisit it.  Digests
    that occur once (nearly all) are dropped before the join, whose other
    side is broadcast only if its counted rows allow it.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n"))
    twice = rows.where(F.col("n") >= MIN_REVISIT_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("least"), F.count(F.lit(1)).alias("k")).where("k > 1").select("digest", "least")
    twice = scratch.keep(twice, "digests")
    few = twice.count() <= 200_000
    rows = rows.join(F.broadcast(twice) if few else twice, "digest", "left").select(
        "page_id", "url", "html", "digest", F.col("n").cast("long"),
        F.when(F.coalesce(F.col("page_id") != F.col("least"), F.col("least").isNotNull()), F.col("least")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pafs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        out, name, size = None, None, 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{folder}/{name}", compression=None)
                member = gzip.compress(record_bytes(*row), 6, mtime=0)
                out.write(member)
                size += len(member)
                if size >= max_bytes:
                    out.close()
                    yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [size]})
                    out = None
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [size]})

    return scratch.keep(rows.mapInArrow(run, "file string, bytes long"), "files")


def read_records(stream) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, length, header fields, block) of every gzip member of an open archive."""
    offset, rest = 0, b""
    while True:
        rest = rest or stream.read(1 << 20)
        if not rest:
            return
        member, taken, parts = zlib.decompressobj(31), 0, []
        while not member.eof:
            if not rest:
                rest = stream.read(1 << 20)
                if not rest:
                    raise EOFError("archive ends inside a record")
            parts.append(member.decompress(rest))
            taken += len(rest) - len(member.unused_data)
            rest = member.unused_data
        head, _, block = b"".join(parts).partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield offset, taken, fields, block[:int(fields["Content-Length"])]
        offset += taken


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def capture(file: str, offset: int, length: int, fields: dict, block: bytes) -> tuple:
    """Index row of a record; a response's digest and size are taken from the payload itself."""
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Bytes"])
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload digest of the record at {offset} in {file} is wrong")
        size = len(payload)
    when = re.sub(r"[^0-9]", "", fields["WARC-Date"])
    return (_page(fields["WARC-Record-ID"]), url_key(fields.get("WARC-Target-URI")), when, size, digest,
            fields["WARC-Type"], _page(fields.get("WARC-Refers-To")), file, offset, length)


def _place(row: tuple) -> tuple:
    """Sort key of a capture: URL key, timestamp, page (a record without page id first), then its place."""
    return row[1], row[2], row[0] is not None, row[0] or 0, row[7], row[8]


def read_runs(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """Captures of every archive file, sorted within the file (its run); one file is one unit of work."""
    names = [f.name for f in pa_schema()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pafs.FileSystem.from_uri(root)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    rows = sorted((capture(name, *r) for r in read_records(stream)), key=_place)
                for lo in range(0, len(rows), 8192):
                    part = rows[lo:lo + 8192]
                    columns = [*zip(*part), range(lo, lo + len(part))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t.type) for c, t in zip(columns, pa_schema())], names)

    parts = max(1, files.count())
    return files.select("file").repartition(parts, "file").mapInArrow(run, CAPTURES + ", seq long")


def pa_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in (CAPTURES + ", seq long").split(", "))])


def loser_tree_merge(runs: list[Iterable], key) -> Iterator:
    """Merge sorted runs: the winner leaves and its path to the root is replayed against the losers."""
    heads = [iter(r) for r in runs]
    k = len(heads)
    if k == 0:
        return
    done = (1,)

    def pull(i):
        for x in heads[i]:
            return (0, key(x), i), x
        return done + ((), i), None

    now = [pull(i) for i in range(k)]
    loser = [-1] * k

    def replay(i):
        at = (i + k) // 2
        while at:
            if loser[at] < 0:
                loser[at] = i
                return None  # still building: waits here for the other side
            if now[loser[at]][0] < now[i][0]:
                loser[at], i = i, loser[at]
            at //= 2
        return i

    winner = 0
    for i in range(k):
        top = replay(i)
        winner = i if top is None else top
    if k > 1:
        winner = top
    while now[winner][0][0] == 0:
        yield now[winner][1]
        now[winner] = pull(winner)
        if k > 1:
            winner = replay(winner)


def merge_runs(runs: DataFrame, scratch: Scratch, rows_per_range: int = 50_000) -> DataFrame:
    """(captures, capture_no): the global order by URL key, timestamp and page, numbered from 1."""
    names = [f.name for f in pa_schema()][:-1]
    types = [f.type for f in pa_schema()][:-1]
    ranges = max(1, -(-runs.count() // rows_per_range))
    key = [F.col(c).asc_nulls_first() for c in (*ORDER, "file", "offset")]
    dealt = runs.repartitionByRange(ranges, *key).withColumn("part", F.spark_partition_id())
    dealt = dealt.sortWithinPartitions("file", "seq").drop("seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        part = None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                part = row[-1]
                slices.setdefault(row[7], []).append(row[:-1])
        out: list[tuple] = []
        pos = 0

        def cut():
            cols = [pa.array(list(c), t) for c, t in zip(zip(*out), types)]
            return pa.RecordBatch.from_arrays(
                [*cols, pa.array([part] * len(out), pa.int32()), pa.array(range(pos - len(out) + 1, pos + 1), pa.int64())],
                [*names, "part", "pos"])

        for row in loser_tree_merge(list(slices.values()), _place):
            out.append(row)
            pos += 1
            if len(out) == 8192:
                yield cut()
                out = []
        if out:
            yield cut()

    merged = scratch.keep(dealt.mapInArrow(run, CAPTURES + ", part int, pos long"), "index")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    starts = merged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return merged.join(starts, "part").select(*names, (F.col("start") + F.col("pos")).alias("capture_no"))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as WARC, read the archives back and merge their index; one row per page row.

    A null or empty html is an empty payload (a response), a null url has the
    empty key, a null page_id is written without a number and comes first
    among equal keys and times; of rows that repeat the smallest page_id of a
    payload all are responses.  Other columns are ignored.  An empty table
    writes no file and gives an empty index.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    root = scratch.path("archives")
    if "://" not in root:
        root = "file://" + root if root.startswith("/") else re.sub(r"^file:/+", "file:///", root)
    files = write_archives(pages, root, scratch)
    runs = scratch.keep(read_runs(pages.sparkSession, files, root), "runs")
    return merge_runs(runs, scratch)
