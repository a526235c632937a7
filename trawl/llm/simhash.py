"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is read as 32 segments of two bits; the number of set
bits of every segment (0, 1 or 2) is its embedding.  The Manhattan distance
of two embeddings never exceeds the Hamming distance of the fingerprints, so
fingerprints that differ in ``max_bits`` bits or fewer lie within
``max_bits`` of each other in the embedding, and in one of its two halves
within ``max_bits // 2``.  The grid join uses that:

* a cell is the sixteen segment counts of one half; a fingerprint lives in
  its own cell of either half and probes the cells one step above it (one
  segment count larger), so two fingerprints one step apart meet in the cell
  of the upper one;
* members of a cell are compared exactly by their differing bits.

Exact copies share one fingerprint and are one member.  A cell with many
members is dealt into blocks of ``block`` members and every pair of blocks
is a group of its own, compared in memory; only the links that join classes
(a spanning forest of the group) leave it, so neither a task nor the link
table grows with the square of a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Scratch, broadcast_checked, fresh
from trawl.llm.components import connected_components

SEED = 42
PIECE = 1 << 16  # shingles whose bits are counted at once


def simhash(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of one text: bit set where over half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    total = np.zeros(64, np.int64)
    for lo in range(0, n, PIECE):
        part = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), SEED) for i in range(lo, min(n, lo + PIECE))]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp bigint) of every whole text; a null text counts as empty (fingerprint zero)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [simhash(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def grid_members(fps: DataFrame, max_bits: int) -> DataFrame:
    """(half, cell, fp, home): every fingerprint in its own cell of each half and in those it probes."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3: a half then differs by one step at most")
    def counts(half):  # two-bit counts of a 32-bit half, all segments at once
        return half - F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555))

    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    halves = F.array(F.struct(F.lit(0).alias("half"), counts(low).alias("own")),
                     F.struct(F.lit(1).alias("half"), counts(high).alias("own")))
    rows = fps.select("fp", F.inline(halves))
    steps = F.array(F.struct(F.lit(True).alias("home"), F.col("own").alias("cell")))
    if max_bits >= 2:
        ups = [F.when(F.shiftright("own", 2 * k).bitwiseAND(F.lit(3)) < 2,
                      F.struct(F.lit(False).alias("home"), (F.col("own") + F.lit(1 << (2 * k))).alias("cell")))
               for k in range(16)]
        steps = F.concat(steps, F.array_compact(F.array(*ups)))
    return rows.select("fp", "half", F.inline(steps)).select("half", "cell", "fp", "home")


def block_groups(members: DataFrame, keys: list[str], item: str, useful, block: int) -> DataFrame:
    """Deal the members of every group into blocks; one row per member and pair of blocks.

    ``useful`` is an aggregate that says whether a group can hold a link.
    Adds columns _i, _j, _n (members of the group); a group of up to
    ``block`` members is the single pair (0, 0).
    """
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), useful.alias("_ok")).where("_ok").drop("_ok")
    m = members.join(sizes, keys)
    blocks = F.ceil(F.col("_n") / block).cast("int")
    own = F.pmod(F.xxhash64(item), blocks).cast("int")
    m = m.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return m.withColumn("_i", F.least("_own", "_other")).withColumn("_j", F.greatest("_own", "_other"))


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Re-cut a sorted stream of batches so that no group of equal keys is split."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        last = np.ones(len(t), bool)
        for k in keys:
            col = t.column(k).to_numpy()
            last &= col == col[-1] if len(t) else True
        cut = int(np.argmax(last)) if last.any() else len(t)
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut)
    if rest is not None and len(rest):
        yield rest


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Spanning links of one group from its boolean link matrix."""
    free = np.ones(len(near), bool)
    links = []
    for root in range(len(near)):
        if not free[root]:
            continue
        free[root] = False
        todo = [root]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(near[at] & free)
            free[new] = False
            links.extend((at, int(x)) for x in new)
            todo.extend(new.tolist())
    return links


def _links_in_groups(batches, keys, max_bits):
    for t in _whole_groups(batches, keys):
        fp = t.column("fp").to_numpy().view(np.uint64)
        new = np.zeros(len(fp), bool)
        new[:1] = True
        for k in keys:
            col = t.column(k).to_numpy()
            new[1:] |= col[1:] != col[:-1]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(fp)))
        a, b = [], []
        small = size <= 8
        for s in range(1, 8):  # small groups: all members a fixed distance apart, for all groups at once
            for off in range(8 - s):
                at = start[small & (size > off + s)] + off
                hit = at[np.bitwise_count(fp[at] ^ fp[at + s]) <= max_bits]
                a.append(fp[hit])
                b.append(fp[hit + s])
        for st, n in zip(start[~small], size[~small]):
            f = np.unique(fp[st:st + n])
            near = np.bitwise_count(f[:, None] ^ f[None, :]) <= max_bits
            pairs = _forest(near)
            if pairs:
                x, y = np.array(pairs).T
                a.append(f[x])
                b.append(f[y])
        if a:
            a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            keep = a != b
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


def fingerprint_links(fps: DataFrame, max_bits: int = 3, block: int = 256) -> DataFrame:
    """Links (a, b) that join all fingerprints reachable by steps of ``max_bits`` bits or fewer.

    ``fps`` has distinct fingerprints (fp).  Every link is exact; of the
    links inside one group those that add nothing to its classes are left out.
    """
    keys = ["half", "cell", "_i", "_j"]
    useful = (F.count(F.lit(1)) > 1) & F.max("home")
    groups = block_groups(grid_members(fps, max_bits), ["half", "cell"], "fp", useful, block)
    dealt = groups.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(lambda it: _links_in_groups(it, keys, max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, block: int = 256) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Fingerprints that differ in ``max_bits`` bits or fewer are linked;
    ``component_id`` is the smallest doc_id reachable over links.  Null and
    word-free texts have fingerprint zero and are linked like any other.
    Repeated rows stay repeated; a row without doc_id is fingerprinted, and
    its component is the smallest doc_id of its class (null if there is
    none).  Columns other than ``doc_id`` and ``text`` are ignored; an empty
    table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.keep(fingerprints(docs, shingle), "fingerprints")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comps = connected_components(fingerprint_links(distinct.select("fp"), max_bits, block), scratch)
    named = distinct.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = named.join(ids, "component").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` without the documents that are near duplicates of one with a smaller doc_id; columns unchanged.

    Of a class the document with the smallest doc_id stays; rows that repeat
    that doc_id are the same document and stay.  A row without doc_id stays
    only where its class has no doc_id at all.
    """
    near = near_duplicates(docs, shingle, max_bits)
    name = fresh("_gone", docs)
    gone = near.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(name)).distinct()
    gone = Scratch(docs.sparkSession, "simhash-gone").keep(gone, "doc_ids")
    return docs.join(broadcast_checked(gone), docs["doc_id"].eqNullSafe(F.col(name)), "left_anti")
