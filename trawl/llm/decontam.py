"""Benchmark decontamination by spaced-seed hashing (native).

A window of ``span`` consecutive words is hashed under ``max_subst + 1``
fixed masks; mask ``r`` keeps the positions that are ``r`` modulo the number
of masks, and the other positions may hold any word.  Benchmark windows and
training windows meet where a masked hash agrees, and each meeting is
verified word by word on its alignment: at most ``max_subst`` of the ``span``
words may differ.  So many substitutions leave at least one mask whole,
wherever they fall, so no window within the allowance is missed.  Windows
shorter than ``4 * max_subst + 1`` words allow fewer substitutions and have
as many masks as they need.

The benchmark is a query set: its masked windows are broadcast in blocks of
at most ``block`` windows, each block against all documents; documents are
hashed in place and never shuffled for the search.  Items shorter than
``span`` words are searched with windows of their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.plan import compute_once
from trawl.llm.common import Scratch, ascii_lower, broadcast_checked, words, fresh

SPAN = 13
MAX_SUBST = 2


def word_hashes(text: Column | str) -> Column:
    """64-bit hashes of the lower-cased (A-Z) words of a text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.transform(words(ascii_lower(F.coalesce(text, F.lit("")))), lambda w: F.xxhash64(w))


def allowance(span: int, max_subst: int) -> int:
    """Substitutions that a window of ``span`` words may have."""
    return min(max_subst, (span - 1) // 4)


def masked_windows(h: Column, span: int, masks: int) -> Column:
    """array<array<long>>: the ``masks`` masked hashes of every window of ``span`` words, by start.

    ``masks`` must not exceed ``span``, so that each mask keeps a word.
    """
    def one(x, i):
        at = [x, *[F.get(h, i + k) for k in range(1, span)]]
        return F.when(i <= F.size(h) - span, F.array(*[F.xxhash64(F.lit(r), *at[r::masks]) for r in range(masks)]))

    return F.slice(F.transform(h, one), 1, F.greatest(F.size(h) - span + 1, F.lit(0)))


def benchmark_items(benchmark: DataFrame, span: int) -> DataFrame:
    """(item_id, h, span): word hashes and window length of every item that has words."""
    # computed once: an expression that lambda bodies refer to would run again for every window
    items = compute_once(benchmark.select("item_id", "text"), ["item_id"], h=word_hashes("text")).where(F.size("h") > 0)
    return items.withColumn("span", F.least(F.size("h"), F.lit(span)))


def benchmark_windows(items: DataFrame, span: int, masks: int) -> DataFrame:
    """(item_id, win, seed): the masked seeds of every window of the items with this window length."""
    w = items.where(F.col("span") == span).select(
        "item_id", "h", F.posexplode(masked_windows(F.col("h"), span, masks)).alias("j", "w"))
    return w.select("item_id", F.slice("h", F.col("j") + 1, span).alias("win"), F.explode("w").alias("seed"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, max_subst: int = MAX_SUBST,
               block: int = 250_000) -> DataFrame:
    """(doc_id, item_id, n_windows, n_exact, first_word): one row per document and item that share a window.

    ``n_windows`` counts the document's windows that match a window of the
    item, ``n_exact`` those that match without a substitution, ``first_word``
    is the word position of the first.  Null or empty texts and items match
    nothing; a null doc_id or item_id is kept as a value; repeated rows add
    up in one row.  Only doc_id, text, item_id are read.
    """
    scratch = Scratch(docs.sparkSession, "decontam")
    items = benchmark_items(benchmark, span)
    n_windows = F.sum(F.size("h") - F.col("span") + 1)
    sizes = {r["span"]: r["n"] for r in items.groupBy("span").agg(n_windows.alias("n")).collect()}  # up to ``span`` rows
    found = None
    hashed = compute_once(docs.select("doc_id", "text"), ["doc_id"], h=word_hashes("text"))
    for s, n in sorted(sizes.items()):
        allowed = allowance(s, max_subst)
        masks = allowed + 1
        blocks = -(-n * masks // block)
        rows = benchmark_windows(items, s, masks)
        if blocks > 1:
            rows = scratch.keep(rows, f"windows-{s}")
        d = hashed.select("doc_id", "h", F.flatten(masked_windows(F.col("h"), s, masks)).alias("seeds"))
        d = d.select("doc_id", "h", F.posexplode("seeds").alias("p", "seed"))
        for b in range(blocks):
            part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == b)
            hit = d.join(F.broadcast(part), "seed")
            start = F.floor(F.col("p") / masks).cast("int")
            miss = sum((F.get("h", start + k) != F.get("win", k)).cast("int") for k in range(s))
            hit = hit.select("doc_id", "item_id", start.alias("i"), miss.alias("miss")).where(F.col("miss") <= allowed)
            found = hit if found is None else found.unionByName(hit)
    if found is None:
        ends = [docs.schema["doc_id"], benchmark.schema["item_id"], T.StructField("i", T.IntegerType()), T.StructField("miss", T.IntegerType())]
        found = docs.sparkSession.createDataFrame([], T.StructType(ends))
    windows = found.groupBy("doc_id", "item_id", "i").agg(F.min("miss").alias("miss"))
    return windows.groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_windows"), F.sum((F.col("miss") == 0).cast("long")).alias("n_exact"),
        F.min("i").alias("first_word"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, max_subst: int = MAX_SUBST) -> DataFrame:
    """The rows of ``docs`` that share no window with a benchmark item; columns unchanged."""
    name = fresh("_leak", docs)
    leaks = find_leaks(docs, benchmark, span, max_subst).select(F.col("doc_id").alias(name)).distinct()
    leaks = Scratch(docs.sparkSession, "leaks").keep(leaks, "doc_ids")
    return docs.join(broadcast_checked(leaks), docs["doc_id"].eqNullSafe(F.col(name)), "left_anti")
