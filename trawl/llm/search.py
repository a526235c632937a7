"""Ranked lexical search: short lists by term, long lists by document.

One map over the documents builds a document-partitioned index: each row is a
shard of at most ``SHARD_DOCS`` documents with the posting lists (document
ordinals and occurrences) of every query term, written to the shared folder.
Corpus counts (documents, terms, document frequencies) are summed from the
stored rows, over all documents.  A second map ranks shard by shard:

* the posting lists of an item's rare terms are added up term at a time into
  accumulators, sorted by document, with the largest sum of each document
  range as their bound;
* the accumulators then count as one more list beside the long lists, and
  documents are scored range by range, the range with the largest summed
  bound first; ranges whose bound stays under the tenth best score so far are
  skipped, and within a range the long lists are read in falling order of
  their bound until no document can reach that score.

A task keeps the best documents over all of its shards, so its later shards
skip more.  Scores are integers, so the order of addition does not matter.
Items are taken in blocks of ``block`` (item, term) pairs, so what travels to the
tasks is bounded; each block reads the documents once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import Scratch, ascii_lower

# Fixed value: a term is a maximal run of ASCII letters, digits and characters beyond ASCII.
TERM_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

SHARD_DOCS = 8192
RANGE = 128  # documents in a range
SHORT = 64  # a list with under one posting per this many documents of its shard is short

INDEX_SCHEMA = ("n_docs long, n_terms long, ids array<long>, sizes array<long>, terms array<int>, lens array<long>, "
                "ords binary, tfs binary")


def fold(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order."""
    return raw.translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term); rows that share an item_id, null included, pool their terms."""
    terms = F.regexp_extract_all(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), F.lit(TERM_RE), F.lit(0))
    return items.select("item_id", F.explode(F.array_distinct(terms)).alias("term")).distinct()


def build_index(docs: DataFrame, number: dict[bytes, int], shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Shards (``INDEX_SCHEMA``) of the posting lists of the numbered terms, without a shuffle.

    ``n_docs`` and ``n_terms`` count every document with at least one term,
    also those that hold none of the numbered terms.
    """
    def pack(n_docs, n_terms, ids, sizes, posts):
        lists = sorted(posts.items())
        ords = np.concatenate([np.array(o, np.uint32) for _, (o, _) in lists]) if lists else np.zeros(0, np.uint32)
        tfs = np.concatenate([np.array(f, np.int64) for _, (_, f) in lists]) if lists else np.zeros(0, np.int64)
        one = [n_docs, n_terms, ids, sizes, [t for t, _ in lists], [len(o) for _, (o, _) in lists],
               ords.tobytes(), tfs.tobytes()]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()),
                 pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(one, kinds)],
                                          [c.split()[0] for c in INDEX_SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        ids, sizes, posts = [], [], {}
        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1)):
                found = fold(raw.as_py() or b"")
                if not found:
                    continue
                n_docs += 1
                n_terms += len(found)
                held = [(number[t], c) for t, c in Counter(found).items() if t in number]
                if held:
                    for t, c in held:
                        if t not in posts:
                            posts[t] = ([], [])
                        posts[t][0].append(len(ids))
                        posts[t][1].append(c)
                    ids.append(doc_id)
                    sizes.append(len(found))
                if len(ids) >= shard_docs:
                    yield pack(n_docs, n_terms, ids, sizes, posts)
                    n_docs = n_terms = 0
                    ids, sizes, posts = [], [], {}
        if n_docs:
            yield pack(n_docs, n_terms, ids, sizes, posts)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return narrow.mapInArrow(run, INDEX_SCHEMA)


class Shard:
    """One shard's lists with the weight of every posting and its bounds per document range."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int):
        sizes = row["sizes"]
        self.ids = row["ids"]
        self.n = len(sizes)
        self.n_ranges = -(-self.n // RANGE)
        m = np.array([10 + 90 * s * n_docs // n_terms for s in sizes], np.int64)
        self.ords = np.frombuffer(row["ords"], np.uint32).astype(np.int64)
        tf = np.frombuffer(row["tfs"], np.int64)
        lens = np.array(row["lens"], np.int64)
        ends = np.cumsum(lens)
        self.at = {t: (e - k, e) for t, k, e in zip(row["terms"], lens.tolist(), ends.tolist())}
        w = np.repeat(weights[np.array(row["terms"], np.int64)], lens)
        self.impact = w * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.ords]))
        self.long: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bounds(self, ords: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per document range: where it starts in the sorted list, and its largest value (0 if it has none)."""
        cuts = np.searchsorted(ords, np.arange(self.n_ranges + 1) * RANGE)
        top = np.zeros(self.n_ranges, np.int64)
        full = np.flatnonzero(cuts[1:] > cuts[:-1])
        if len(full):
            top[full] = np.maximum.reduceat(values, cuts[full])
        return cuts, top

    def lists(self, terms: list[int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(ordinals, values, range starts, range bounds): the accumulators of the short lists, then each long list."""
        short, out = [], []
        for t in terms:
            lo, hi = self.at.get(t, (0, 0))
            if hi - lo and (hi - lo) * SHORT < self.n:
                short.append((lo, hi))
            elif hi - lo:
                if t not in self.long:
                    self.long[t] = self.bounds(self.ords[lo:hi], self.impact[lo:hi])
                out.append((self.ords[lo:hi], self.impact[lo:hi], *self.long[t]))
        if short:
            ords = np.concatenate([self.ords[lo:hi] for lo, hi in short])
            order = np.argsort(ords, kind="stable")
            ords, values = ords[order], np.concatenate([self.impact[lo:hi] for lo, hi in short])[order]
            first = np.flatnonzero(np.r_[True, ords[1:] != ords[:-1]])
            ords, values = ords[first], np.add.reduceat(values, first)
            out.insert(0, (ords, values, *self.bounds(ords, values)))
        return out

    def search(self, terms: list[int], best: list[tuple[int, int, int]], k: int) -> list[tuple[int, int, int]]:
        """The ``k`` best (-score, null doc_id last, doc_id) of ``best`` and this shard, in order."""
        lists = self.lists(terms)
        if not lists:
            return best
        total = sum(top for _, _, _, top in lists)
        for r in np.argsort(-total, kind="stable").tolist():
            least = max(1, -best[-1][0]) if len(best) == k else 1
            if total[r] < least:
                break
            sums, left = np.zeros(RANGE, np.int64), int(total[r])
            for ords, values, cuts, top in sorted(lists, key=lambda x: -x[3][r]):
                if int(sums.max()) + left < least:
                    break
                lo, hi = cuts[r], cuts[r + 1]
                sums[ords[lo:hi] - r * RANGE] += values[lo:hi]
                left -= int(top[r])
            else:
                hits = np.flatnonzero(sums >= least)
                if len(hits):
                    new = [(-int(sums[h]), self.ids[r * RANGE + h] is None, self.ids[r * RANGE + h] or 0) for h in hits.tolist()]
                    best = sorted(best + new)[:k]
        return best


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item, ranked; a first pass within 64 parts of an item keeps every task small."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).where(
        F.col("rank") <= k).drop("part", "rank")
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)).cast("int")).where(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block: int = 200_000,
                   shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0.

    A null or empty text has no terms: such a document is not counted and
    such an item returns nothing.  Every document row counts for itself, so a
    repeated row ranks twice; equal scores go by ascending doc_id, null last.
    Item rows that share an item_id (null is one) form one item.  Only
    doc_id, item_id and text are read.  Empty tables give an empty result.
    One item's distinct terms are held whole in a task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    pairs = scratch.keep(item_terms(items), "item-terms")
    blocks = max(1, -(-pairs.count() // block))
    found = []
    for b in range(blocks):
        rows = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow().to_pydict()
        number = {t: i for i, t in enumerate(sorted(set(rows["term"])))}
        by_item: dict[int | None, list[int]] = {}
        for item, term in zip(rows["item_id"], rows["term"]):
            by_item.setdefault(item, []).append(number[term])
        index = scratch.keep(build_index(docs, {t.encode(): i for t, i in number.items()}, shard_docs), f"index-{b}")
        n = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
        df = index.select(F.explode(F.arrays_zip("terms", "lens")).alias("p")).groupBy(F.col("p.terms").alias("t")).agg(
            F.sum("p.lens").alias("df")).toArrow().to_pydict()
        weights = np.zeros(len(number), np.int64)
        for t, f in zip(df["t"], df["df"]):
            weights[t] = math.floor(1000 * math.log((2 * n["docs"] + 2) / (2 * f + 1)))
        found.append(_ranked(index, by_item, weights, n["docs"], n["terms"], k, items.schema["item_id"].dataType.simpleString()))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return best_of(out, k)


def _ranked(index: DataFrame, by_item: dict, weights: np.ndarray, n_docs: int, n_terms: int, k: int, kind: str) -> DataFrame:
    """(item_id, doc_id, score): the ``k`` best documents of each item in each task's shards."""
    arrow = pa.string() if kind == "string" else pa.int64()
    kind = "string" if kind == "string" else "long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, list] = {item: [] for item in by_item}
        for b in batches:
            for row in b.to_pylist():
                shard = Shard(row, weights, n_docs, n_terms)
                for item, terms in by_item.items():
                    best[item] = shard.search(terms, best[item], k)
        rows = [(item, None if none else d, -s) for item, hits in best.items() for s, none, d in hits]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], arrow), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int64())], ["item_id", "doc_id", "score"])

    return index.mapInArrow(run, f"item_id {kind}, doc_id long, score long")
