"""Removal of repeated passages by recompression.

A document's words become symbols (hashes).  Rounds rename them: a maximal
run of equal words gets the name of (word, length), then, in every pair
round, a fixed coin per symbol makes it a left or a right one and every left
symbol followed by a right one is replaced by the name of the pair.  Names
are hashes of what they stand for, so all tasks name alike without asking
each other, and whether a symbol forms depends on its neighbours only: every
symbol knows the words that decide it (its context).  Equal passages
therefore hold the same symbols wherever the context lies inside them.

A window of ``width`` words is represented by the smallest of the symbols of
the last round whose context it contains (by its own name if there is none):
equal windows have equal representatives, and neighbouring windows mostly
share theirs.  The steps:

1. documents are packed into compressed blocks; each block lists its
   representatives once, with the smallest and largest doc_id that has them;
2. representatives meet by value; those of one document only drop out, the
   others return to their blocks;
3. blocks name (64 bits) all windows with a returned
   representative; names meet by value, and each block learns the smallest
   doc_id of its names;
4. words covered by a window that also starts in a smaller doc_id go.

Values travel in sorted packs, one per block and hash range, so a passage
that very many documents share costs one entry per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Scratch

WIDTH = 13
PAIR_ROUNDS = 2
BLOCK_BYTES = 6 << 20
LAST = np.iinfo(np.int64).max  # stands for a null doc_id: after all others
_BLOCK = "block string, doc_id array<long>, n_words array<long>, z binary, buckets array<int>, packs array<binary>"
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def symbols(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, context begin, context end) of the last round's symbols, in order; ``doc`` tells documents apart."""
    n = len(words)
    new = np.ones(n, bool)
    new[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], n)
    name, at = words[begin], doc[begin]
    size = (end - begin).astype(np.uint64)
    name = np.where(size > 1, mix(name ^ mix(size)), name)
    low, high = begin - 1, end + 1  # a run is known once the words beside it are
    for r in range(PAIR_ROUNDS):
        right = (mix(name + _U(0x632BE59BD9B4E019 * (r + 1) & (1 << 64) - 1)) & _U(1)).astype(bool)
        same = at[1:] == at[:-1]
        first = np.append(~right[:-1] & right[1:] & same, False)  # begins a pair
        second = np.append(False, first[:-1])
        # a symbol that stays single is decided by the neighbour it could have joined
        after = np.append(np.where(same, high[1:], end[:-1] + 1), n + 1)
        before = np.append(-1, np.where(same, low[:-1], begin[1:] - 1))
        alone = ~first & ~second
        low = np.where(alone & right, np.minimum(low, before), low)
        high = np.where(alone & ~right, np.maximum(high, after), high)
        i = np.flatnonzero(~second)
        j = np.where(first[i], i + 1, i)
        name = np.where(first[i], mix(name[i] * _U(0x9E3779B97F4A7C15) + mix(name[j])), name[i])
        begin, end, low, high, at = begin[i], end[j], low[i], high[j], at[i]
    return name, low, high


def window_names(words: np.ndarray, at: np.ndarray, width: int, salt: int) -> np.ndarray:
    """Name of the window of ``width`` words that starts at each of ``at``."""
    name = np.full(len(at), salt, np.uint64)
    for k in range(width):
        name = mix(name) + words[at + k]
    return mix(name)


def representatives(words: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(window starts, representative of each window)."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(doc[:n - width + 1] == doc[width - 1:])
    name, low, high = symbols(words, doc)
    rank = mix(name)
    first = np.cumsum(np.bincount(np.maximum(low, -1) + 1, minlength=n + 2))  # [p]: symbols whose context begins before p
    last = np.cumsum(np.bincount(np.minimum(high, n + 1), minlength=n + 2))   # [q]: symbols whose context ends by q
    lo, hi = first[starts], last[starts + width]
    best = np.full(len(starts), np.iinfo(np.uint64).max, np.uint64)
    got = np.zeros(len(starts), bool)
    live = np.flatnonzero(lo < hi)
    while len(live):
        best[live] = np.minimum(best[live], rank[lo[live]])
        got[live] = True
        lo[live] += 1
        live = live[lo[live] < hi[live]]
    bare = np.flatnonzero(~got)
    best[bare] = window_names(words, starts[bare], width, 7)
    return starts, best


def _least_and_most(value: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values with their smallest and largest doc_id."""
    order = np.lexsort((doc, value))
    value, doc = value[order], doc[order]
    new = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
    return value[new], doc[new], doc[np.append(new[1:], len(value)) - 1] if len(value) else doc


def _pack(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(3).compress(
        b"".join([np.diff(columns[0], prepend=columns[0].dtype.type(0)).tobytes(), *(c.tobytes() for c in columns[1:])]))


def _unpack(z: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(z)
    n = len(raw) // (8 * len(types))
    out = [np.frombuffer(raw, t, n, 8 * n * k) for k, t in enumerate(types)]
    return [np.cumsum(out[0], dtype=types[0]), *out[1:]]


def _deal(value: np.ndarray, buckets: int, *more: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Sorted values cut into packs by hash range."""
    of = (value >> _U(32)) * _U(buckets) >> _U(32)
    cut = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    stops = np.append(cut[1:], len(of))
    return ([int(of[a]) for a in cut], [_pack(value[a:b], *(m[a:b] for m in more)) for a, b in zip(cut, stops)])


def _documents(doc_id: list, n_words: list) -> tuple[np.ndarray, np.ndarray]:
    """Per word: the number of its document in the block, and its doc_id."""
    ids = np.array([LAST if d is None else d for d in doc_id], np.int64)
    at = np.repeat(np.arange(len(ids)), n_words)
    return at, ids[at]


def pack_blocks(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Step 1: blocks of documents (words joined by one space, one document a line) and their representatives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, n_words, size = [], [], [], 0

        def cut():
            raw = b"\n".join(parts)
            words = hashes(raw.split())
            at, of = _documents(ids, n_words)
            starts, rep = representatives(words, at, width)
            which, packs = _deal(*(lambda v, a, b: (v, buckets, a, b))(*_least_and_most(rep, of[starts])))
            z = zstandard.ZstdCompressor(3).compress(raw)
            out = pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(
                    (uuid.uuid4().hex, list(ids), list(n_words), z, which, packs),
                    (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()),
                     pa.list_(pa.binary())))], [f.split()[0] for f in _BLOCK.split(", ")])
            ids.clear(), parts.clear(), n_words.clear()
            return out

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                part = b" ".join(words)
                if size + len(part) > BLOCK_BYTES and ids:
                    yield cut()
                    size = 0
                ids.append(doc), parts.append(part), n_words.append(len(words))
                size += len(part) + 1
        if ids:
            yield cut()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, _BLOCK)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, bytes]]]:
    """(block, pack) lists of equal bucket from rows sorted by bucket."""
    last, group = None, []
    for b in batches:
        for bucket, block, pack in zip(*(b.column(c).to_pylist() for c in ("bucket", "block", "pack"))):
            if bucket != last and group:
                yield group
                group = []
            last = bucket
            group.append((block, pack))
    if group:
        yield group


def meet(packs: DataFrame, parts: int, names: bool) -> DataFrame:
    """Steps 2 and 3: values of equal bucket meet; (block, pack) go back.

    Representatives return where they belong to two documents; window names
    return with their smallest doc_id, to blocks that have them in a larger.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            rows = [_unpack(pack, np.uint64, np.int64, np.int64) for _, pack in group]
            value, least, most = (np.concatenate(c) for c in zip(*rows))
            of = np.repeat(np.arange(len(group)), [len(r[0]) for r in rows])
            order = np.argsort(value, kind="stable")
            value, least, most, of = value[order], least[order], most[order], of[order]
            cut = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
            reach = np.diff(np.append(cut, len(value)))
            low, high = np.repeat(np.minimum.reduceat(least, cut), reach), np.repeat(np.maximum.reduceat(most, cut), reach)
            keep = most > low if names else high > low
            value, low, of = value[keep], low[keep], of[keep]
            order = np.argsort(of, kind="stable")
            value, low, of = value[order], low[order], of[order]
            cut = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else []
            out = [(group[of[a]][0], _pack(value[a:z], low[a:z])) for a, z in zip(cut, np.append(cut[1:], len(of)))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.binary())],
                                                 ["to_block", "pack"])

    dealt = packs.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "to_block string, pack binary")


def _returned(right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All values that came back to a block, sorted, with their smallest doc_ids."""
    rows = [_unpack(p, np.uint64, np.int64) for p in right.column("pack").to_pylist()]
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value, low = (np.concatenate(c) for c in zip(*rows))
    order = np.argsort(value)
    return value[order], low[order]


def _find(table: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Position of each value in a sorted table, -1 where absent."""
    if not len(table):
        return np.full(len(value), -1)
    at = np.minimum(np.searchsorted(table, value), len(table) - 1)
    return np.where(table[at] == value, at, -1)


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row per input row.

    ``kept`` are the words left, joined by one space, after removing every
    word covered by a window of ``width`` words whose words also start, in
    the same order, in a document with a smaller doc_id.  Windows are judged
    on the input.  A null text has no words; a null doc_id counts as larger
    than any other; rows that repeat a doc_id are one document and do not
    remove each other's words.  Other columns are ignored.  An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "recompression")
    n_bytes = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, min(1 << 30, n_bytes // BLOCK_BYTES))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(buckets, 100_000) // 8)
    blocks = scratch.keep(pack_blocks(docs, width, buckets), "blocks")
    packs = blocks.select(F.explode(F.arrays_zip("buckets", "packs")).alias("p"), "block").select(
        F.col("p.buckets").alias("bucket"), "block", F.col("p.packs").alias("pack"))
    body = blocks.select("block", "doc_id", "n_words", "z")

    def parse(row) -> tuple:
        doc_id, n_words, z = (row.column(c)[0].as_py() for c in ("doc_id", "n_words", "z"))
        raw = zstandard.ZstdDecompressor().decompress(z)
        at, of = _documents(doc_id, n_words)
        return doc_id, n_words, raw, raw.split(), at, of

    def name_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        shared, _ = _returned(right)
        which, out = [], []
        if len(left) and len(shared):
            _, _, _, words, at, of = parse(left)
            words = hashes(words)
            starts, rep = representatives(words, at, width)
            starts = starts[_find(shared, rep) >= 0]
            value, least, most = _least_and_most(window_names(words, starts, width, 1), of[starts])
            which, out = _deal(value, buckets, least, most)
        block = left.column("block").to_pylist()[:1] * len(which)
        return pa.table([pa.array(which, pa.int32()), pa.array(block, pa.string()), pa.array(out, pa.binary())],
                        names=["bucket", "block", "pack"])

    def strip(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if len(left):
            names, low = _returned(right)
            doc_id, n_words, raw, words, at, of = parse(left)
            gone = np.zeros(len(words) + 1, np.int32)
            if len(names):
                h = hashes(words)
                starts = np.flatnonzero(at[:len(at) - width + 1] == at[width - 1:])
                hit = _find(names, window_names(h, starts, width, 1))
                starts, hit = starts[hit >= 0], hit[hit >= 0]
                starts = starts[low[hit] < of[starts]]
                np.add.at(gone, starts, 1)
                np.add.at(gone, starts + width, -1)
            gone = np.cumsum(gone)[:-1] > 0
            edge = np.append(0, np.cumsum(n_words)).astype(np.int64)
            for doc, part, a, z in zip(doc_id, raw.split(b"\n"), edge[:-1], edge[1:]):
                g = gone[a:z]
                k = int(g.sum())
                kept = part if not k else b" ".join(words[a + i] for i in np.flatnonzero(~g))
                rows.append((doc, int(z - a), k, kept.decode("utf-8", "surrogatepass")))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                        names=["doc_id", "n_words", "n_removed", "kept"])

    shared = scratch.keep(meet(packs, parts, names=False), "shared")
    named = body.groupBy("block").cogroup(shared.groupBy("to_block")).applyInArrow(
        name_windows, "bucket int, block string, pack binary")
    back = scratch.keep(meet(named, parts, names=True), "repeats")
    return body.groupBy("block").cogroup(back.groupBy("to_block")).applyInArrow(
        strip, "doc_id long, n_words long, n_removed long, kept string")
