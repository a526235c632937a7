"""Document fingerprints by MinHash.

A text's shingles (five lower-cased words; a shorter text is one shingle) are
hashed to 64 bits and run through ``PERMS`` universal hash functions in
numpy; the smallest value of each function is one entry of the signature, and
the share of equal entries of two signatures estimates the Jaccard
similarity of their shingle sets.  Near duplicates are found by bands of the
signature joined in Spark and verified on the shingle sets themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Scratch, broadcast_checked
from trawl.llm.components import connected_components

PERMS, SHINGLE, PIECE = 64, 5, 4096
_rng = np.random.default_rng(20240607)
MUL = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, PERMS, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.full(PERMS, 0xFFFFFFFF, np.uint32)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit shingle hashes of a text; none for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(w))
    h = np.zeros(len(w) - width + 1, np.uint64)
    for k in range(width):
        h = (h ^ (h >> np.uint64(31))) * MIX + w[k:len(w) - width + 1 + k]
    return np.unique(h ^ (h >> np.uint64(29)))


def signature(sh: np.ndarray) -> np.ndarray:
    """``PERMS`` 32-bit minima over a shingle set."""
    out = EMPTY.copy()
    for lo in range(0, len(sh), PIECE):
        part = (sh[lo:lo + PIECE, None] * MUL + ADD) >> np.uint64(32)
        np.minimum(out, part.min(axis=0).astype(np.uint32), out=out)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def text_of(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def text_hash(raw: bytes) -> int:
    """What ``F.xxhash64`` gives for a text."""
    h = xxhash.xxh64_intdigest(raw, 42)
    return h - (1 << 64) if h >> 63 else h


def member_of(sh: np.ndarray) -> int:
    """One number for equal shingle sets."""
    return xxhash.xxh3_64_intdigest(sh.tobytes()) >> 1


def _bounds(docs: DataFrame, parts: int) -> np.ndarray:
    """Some doc_ids of the table, largest last, that cut it into about ``parts`` even ranges."""
    cuts = [k / parts for k in range(1, parts)] + [1.0]
    got = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), F.array(*map(F.lit, cuts)), F.lit(50 * parts)),
                      F.max(F.col("doc_id").cast("long"))).first()
    return np.unique(np.array([*(got[0] or []), *([] if got[1] is None else [got[1]])], np.int64))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, one row per input row.

    The edited text swaps the last half of the code points for the first as
    many of the next document in descending doc_id (after the last: the
    first).  Documents are dealt out by ranges of doc_id, compressed; each
    range also gets the document that follows it, so that one ordered pass
    per range sees every pair of neighbours and holds two texts at a time.
    A null text counts as empty, a null doc_id comes last; rows that repeat
    a doc_id follow each other in the order of a hash of their texts.  A
    single row is its own next.  Other columns are ignored.  ``text_hash`` is
    a hash of the text, ``member`` one of its shingle set.
    """
    spark = docs.sparkSession
    parts = max(2, min(1000, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    bounds = _bounds(docs, parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for b in batches:
            rows = {k: [] for k in ("part", "tail", "doc_id", "tie", "z")}

            def put(*row):
                for k, v in zip(rows, row):
                    rows[k].append(v)

            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                tie, z = text_hash(raw), pack.compress(raw)
                at = 0 if doc is None else int(np.searchsorted(bounds, doc))
                put(at, 0, doc, tie, z)
                if len(bounds) and doc is not None and bounds[at] == doc:  # closes its range: opens the one above it
                    put((at + 1) % len(bounds), 1, doc, tie, z)
                elif not len(bounds):
                    put(0, 1, doc, tie, z)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(rows.values(), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                list(rows))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        held, out = None, []

        def pair(one, two):
            text, sig = one[2:4]
            half = len(text) // 2
            edited = text[:len(text) - half] + two[2][:half]
            es = signature(shingles(edited))
            digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((one[1], len(text), digest, text_of(sig), text_of(es), likeness(sig, es), likeness(sig, two[3]), one[4],
                        one[5]))

        def cut():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                                  pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                 "text_hash", "member"])

        for b in batches:
            for part, tail, doc, tie, z in zip(*(b.column(c).to_pylist() for c in ("part", "tail", "doc_id", "tie", "z"))):
                if tail and (held is None or held[0] != part):
                    continue  # a further closing document of the same range
                text = unpack.decompress(z).decode("utf-8", "surrogatepass")
                sh = shingles(text)
                now = (part, doc, text, signature(sh), tie, member_of(sh))
                if held is not None and held[0] == part:
                    pair(held, now)
                held = None if tail else now
                if len(out) >= 512:
                    yield cut()
                    out.clear()
        if out:
            yield cut()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = narrow.mapInArrow(deal, "part int, tail int, doc_id long, tie long, z binary")
    dealt = dealt.repartition(parts, "part").sortWithinPartitions(
        "part", "tail", F.col("doc_id").desc_nulls_last(), "tie")
    return dealt.mapInArrow(walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double, text_hash long, "
                                  "member long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets of distinct hashes; ``PIECE`` of the shared hashes are counted at a time."""
    out = np.zeros((len(sets), len(sets)), np.int64)
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    value, row = value[order], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
    if not len(value):
        return out
    col = np.cumsum(np.append(True, value[1:] != value[:-1])) - 1
    shared = np.bincount(col)[col] > 1
    row, col = row[shared], col[shared]
    if not len(col):
        return out
    col = np.cumsum(np.append(True, col[1:] != col[:-1])) - 1
    for lo in range(0, int(col[-1]) + 1, PIECE):
        a, z = np.searchsorted(col, [lo, lo + PIECE])
        grid = np.zeros((len(sets), PIECE), np.float32)
        grid[row[a:z], col[a:z] - lo] = 1
        out += (grid @ grid.T).astype(np.int64)
    return out


def near_pairs(sets: list[np.ndarray], wanted: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the ``wanted`` pairs (a square of flags) have Jaccard similarity ``threshold``; two empty sets have it."""
    both = overlaps(sets)
    size = np.array([len(s) for s in sets], np.int64)
    return wanted & (both >= threshold * (size[:, None] + size[None, :] - both))


def roots(near: np.ndarray) -> np.ndarray:
    """Smallest index that each index of a square of links (either direction) can reach."""
    linked = near | near.T
    root = np.arange(len(near))
    while True:
        up = np.minimum(root, np.where(linked, root[None, :], len(near)).min(axis=1, initial=len(near)))
        up = up[up]
        if (up == root).all():
            return root
        root = up


def first_shared(band: np.ndarray, member: np.ndarray, own: np.ndarray, key: tuple[int, int, int]) -> np.ndarray:
    """Which pairs (a square of flags, smaller member first) of a group (band, i, j) share no band before that of the group.

    Of two blocks only the pairs between them count.
    """
    here = int(np.flatnonzero(band[0] == key[0])[0])
    wanted = member[:, None] < member[None]
    if key[1] != key[2]:
        wanted &= own[:, None] != own[None]
    for k in range(here):
        wanted &= band[:, None, k] != band[None, :, k]
    return wanted


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int = 16, block: int = 512) -> DataFrame:
    """(doc_id, text_hash, class_id, n_links), one row per input row: near duplicates at Jaccard ``threshold``.

    Similarity is that of the sets of five-word shingles.  Equal sets are one
    member; members that share a band of their signatures are verified on
    the shingles of their whole texts.  A band shared by many members is
    dealt into blocks of about ``block``, every two of which meet in one group; a pair is
    compared under the first band it shares only, and a text travels only to the
    groups where it has such a pair.  A group returns, per
    member, its number of links and the smallest member of the group it
    reaches, so links are counted whole but no pair becomes a row.
    ``class_id`` is the smallest doc_id reachable over links (null if its
    class has null ids only), ``n_links`` the links of the row's member to
    other members, ``text_hash`` a hash of the text.  Texts without words
    are one class; a null text counts as empty.  Repeated rows stay and
    share class and links.  Other columns are ignored; an empty table gives
    an empty result.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(text) for text in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([member_of(sh) for sh in sets], pa.int64()),
                 pa.array([text_of(signature(sh)) for sh in sets], pa.string())],
                ["doc_id", "text_hash", "member", "fingerprint"])

    rows = _narrow(docs).mapInArrow(sign, "doc_id long, text_hash long, member long, fingerprint string")
    return classes_of(docs, rows, threshold, bands, block)


def _narrow(docs: DataFrame) -> DataFrame:
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def classes_of(docs: DataFrame, prints: DataFrame, threshold: float, bands: int, block: int) -> DataFrame:
    """The rows of ``near_duplicates`` from fingerprints (doc_id, text_hash, member, fingerprint) of ``docs``."""
    scratch = Scratch(docs.sparkSession, "minhash")
    digits = 8 * PERMS // bands
    cut = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.xxhash64(
        k, F.substring(F.col("fingerprint"), k * digits + 1, F.lit(digits))))
    # the hash of a text finds a member's text again: rows that repeat a doc_id may differ in it
    narrow = _narrow(docs)
    signed = scratch.keep(prints.select("doc_id", "text_hash", "member", cut.alias("bands")), "signatures")
    members = signed.groupBy("member").agg(F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "text_hash")).alias("holder"),
                                           F.any_value("bands").alias("bands"))
    members = scratch.keep(members, "members")
    banded = members.select("member", "bands", F.explode("bands").alias("band"))
    sizes = scratch.keep(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    shared = scratch.keep(banded.join(broadcast_checked(sizes), "band"), "bands")
    # one whole text for every member that shares a band
    holder = members.join(shared.select("member").distinct(), "member", "left_semi").select(
        "member", F.col("holder.doc_id").alias("of"), F.col("holder.text_hash").alias("by"))
    holder = broadcast_checked(scratch.keep(holder, "holders"))
    texts = narrow.join(holder, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("by"))).select("member", "text")
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = shared.withColumn("own", F.pmod(F.xxhash64("member"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "member", "bands", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    keys = ["band", "i", "j"]

    def zip_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for b in batches:
            z = [pack.compress((t or "").encode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(z, pa.binary())], ["member", "z"])

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, out = [], None, []

        def close():
            member, own, band = (np.array(c) for c in zip(*group))
            wanted = first_shared(band, member, own, last)
            out.extend((*group[k], *last) for k in np.flatnonzero(wanted.any(axis=0) | wanted.any(axis=1)))

        def cut():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32(),
                                                       pa.int32()))], ["member", "own", "bands", *keys])

        for b in batches:
            for member, own, band, *key in zip(*(b.column(c).to_pylist() for c in ("member", "own", "bands", *keys))):
                if key != last:
                    if len(group) > 1:
                        close()
                    group.clear()
                    last = key
                group.append((member, own, band))
            if out:
                yield cut()
        if len(group) > 1:
            close()
        if out:
            yield cut()

    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    dealt = scratch.keep(dealt.mapInArrow(paired, "member long, own int, bands array<long>, band long, i int, j int"), "paired")
    texts = scratch.keep(texts.mapInArrow(zip_text, "member long, z binary").dropDuplicates(["member"]), "texts")
    rows = dealt.join(texts, "member").repartition(*keys).sortWithinPartitions(*keys)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        group, last, out = [], None, []

        def close():
            member, own, band = (np.array(c) for c in list(zip(*group))[:3])
            packed = [g[3] for g in group]
            group.clear()
            wanted = first_shared(band, member, own, last)
            live = np.flatnonzero(wanted.any(axis=0) | wanted.any(axis=1))
            if not len(live):
                return
            sets = [shingles(unpack.decompress(packed[k]).decode("utf-8", "surrogatepass")) for k in live]
            near = near_pairs(sets, wanted[np.ix_(live, live)], threshold)
            n, root = near.sum(axis=0) + near.sum(axis=1), roots(near)
            out.extend((int(member[live[k]]), int(member[live[root[k]]]), int(n[k])) for k in np.flatnonzero(n))

        def cut():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], ["member", "root", "n"])

        for b in batches:
            for member, own, band, z, *key in zip(*(b.column(c).to_pylist() for c in ("member", "own", "bands", "z", *keys))):
                if key != last:
                    if len(group) > 1:
                        close()
                    group.clear()
                    last = key
                group.append((member, own, band, z))
            if out:
                yield cut()
        if len(group) > 1:
            close()
        if out:
            yield cut()

    found = scratch.keep(rows.mapInArrow(verify, "member long, root long, n long"), "found")
    comps = connected_components(found.select(F.col("member").alias("a"), F.col("root").alias("b")), scratch)
    degree = found.groupBy("member").agg(F.sum("n").alias("n_links"))
    named = members.select("member", "least").join(comps.withColumnRenamed("node", "member"), "member", "left").join(
        degree, "member", "left").withColumn("component", F.coalesce("component", "member"))
    named = scratch.keep(named, "named")
    ids = named.groupBy("component").agg(F.min("least").alias("class_id"))
    of = named.join(ids, "component").select("member", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    of = broadcast_checked(scratch.keep(of, "classes"))
    return signed.select("doc_id", "text_hash", "member").join(of, "member").select("doc_id", "text_hash", "class_id", "n_links")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``edited_fingerprints`` with each row's class_id and n_links of ``near_duplicates``; one row per input row."""
    rows = Scratch(docs.sparkSession, "fingerprints").keep(edited_fingerprints(docs), "rows")
    near = classes_of(docs, rows, 0.8, 16, 512).groupBy("doc_id", "text_hash").agg(
        F.any_value("class_id").alias("class_id"), F.any_value("n_links").alias("n_links"))
    near = near.withColumnsRenamed({"doc_id": "of", "text_hash": "by"})
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("by"))
    return rows.join(near, same, "left").drop("of", "by", "member")
