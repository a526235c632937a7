"""Known names in page tokens, by a token trie walked inside each page.

The trie over the name table is kept as the set of its nodes: a node is a
64-bit hash chained over the tokens from the root, with a flag where a name ends.
The nodes are a few bytes each, counted before they are broadcast, and cut
into shards by their first token where there are too many; a page is
walked once per shard.  The walk starts at every token of a page at once and
goes down level by level in numpy, so its work is the number of trie nodes
met, and only token hashes, not tokens, decide.  No token is shuffled and no
sentence border is looked at: a name may hold a sentence end ("St. Louis").

What the walk finds is joined with the name table by its full text, so a name
is only reported if it is equal token by token.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.plan import compute_once
from trawl.session import stage_dir, stored

NODES = 4_000_000  # trie nodes in one shard: 36 MB
STEP = 400_000  # tokens walked at once
NAME_ROWS = 300_000  # rows of (text, label) up to which the name table itself is broadcast


def name_table(gazetteer: DataFrame) -> DataFrame:
    """(text, label, toks): names as token sequences of any length, ``text`` joins them by one blank."""
    from trawl.operators.annotate import TOKEN_RE

    names = compute_once(gazetteer.select("name", "label"), ["label"], toks=F.regexp_extract_all("name", F.lit(TOKEN_RE), 0))
    return names.where(F.size("toks") > 0).select(F.array_join("toks", " ").alias("text"), "label", "toks").distinct()


def token_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def child(node: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The trie node reached from ``node`` by a token hash (arrays of uint64)."""
    x = node * np.uint64(0x9E3779B97F4A7C15) + token
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets of a list column."""
    lens = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return col.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lens)])


def trie_nodes(names: DataFrame) -> DataFrame:
    """(root, node, last): the distinct trie nodes of (text, label, toks); ``root`` is the node of the first token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, at = _flat(b.column(0))
            h, pos, node, depth = h.astype(np.int64).view(np.uint64), at[:-1], np.zeros(len(b), np.uint64), 0
            ends, root = at[1:], None
            while len(pos):
                node = child(node, h[pos + depth])
                root = node if root is None else root
                depth += 1
                last = pos + depth == ends
                yield pa.RecordBatch.from_arrays([pa.array(root.view(np.int64)), pa.array(node.view(np.int64)), pa.array(last)],
                                                 ["root", "node", "last"])
                pos, node, ends, root = pos[~last], node[~last], ends[~last], root[~last]

    rows = names.select(token_hashes(F.col("toks")).alias("h")).mapInArrow(run, "root long, node long, last boolean")
    return rows.groupBy("root", "node").agg(F.max("last").alias("last"))


def walk(tokens: np.ndarray, offsets: np.ndarray, nodes: np.ndarray, last: np.ndarray, shard: int = 0,
         shards: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(position, length) of every path from the root that ends a name, by position, shorter first.

    ``tokens`` holds the token hashes of all rows, row r at ``offsets[r]:offsets[r + 1]``; no path crosses rows.
    Only tokens whose first node belongs to ``shard`` are looked up.
    """
    ends = np.repeat(offsets[1:], np.diff(offsets))
    pos, depth = np.arange(len(tokens)), 0
    if shards > 1:
        pos = pos[child(np.zeros(len(tokens), np.uint64), tokens).view(np.int64) % shards == shard]
    node = np.zeros(len(pos), np.uint64)
    found, sizes = [], []
    while len(pos) and len(nodes):
        node = child(node, tokens[pos + depth])
        i = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
        here = nodes[i] == node
        pos, node, i = pos[here], node[here], i[here]
        depth += 1
        found.append(pos[last[i]])
        sizes.append(np.full(len(found[-1]), depth))
        more = pos + depth < ends[pos]
        pos, node = pos[more], node[more]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, sizes = np.concatenate(found), np.concatenate(sizes)
    order = np.lexsort((sizes, found))
    return found[order], sizes[order]


def spaced_text(tokens: Column, ws: Column, start: Column, n: Column) -> Column:
    """``n`` tokens from ``start`` (0-based) as written; white space between them becomes one blank."""
    return F.array_join(F.zip_with(F.slice(tokens, start + 1, n), F.slice(ws, start + 1, n - 1), lambda t, w: F.concat(
        t, F.when(F.length(w) > 0, F.lit(" ")).otherwise(F.lit("")))), "")


def is_word(t: Column) -> Column:
    """Whether a token begins with a letter or a digit; most are told by their first byte."""
    def within(lo, hi):
        return (t >= lo) & (t < hi)

    return within("a", "{") | within("A", "[") | within("0", ":") | ((t >= "\x80") & t.rlike(r"^[\p{L}\p{N}]"))


def slices(b: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose lists in ``column`` hold about ``most`` items (one row at least)."""
    total = np.cumsum(b.column(column).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(b):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")))
        yield b.slice(lo, hi - lo)
        lo = hi


_BLANK = np.isin(np.arange(256), [ord(c) for c in "\t\n\x0b\f\r "])  # white space, as in the token rule


def gaps(tokens: pa.Array, spacing: pa.Array) -> np.ndarray:
    """Whether white space follows each of the tokens, by the ``ws`` of their rows or by their texts.

    A text without its white space is its tokens; so the bytes are counted, and a
    token's last byte and the next one's first are looked up.  What follows a row's last token is not told.
    """
    if not pa.types.is_string(spacing.type):
        return pc.greater(pc.binary_length(spacing.flatten()), 0).fill_null(False).to_numpy(zero_copy_only=False)
    lo, hi = (int(x) for x in np.frombuffer(spacing.buffers()[1], np.int32)[[spacing.offset, spacing.offset + len(spacing)]])
    place = np.flatnonzero(~_BLANK[np.frombuffer(spacing.buffers()[2], np.uint8, hi - lo, lo)]) if hi > lo else np.zeros(0, np.int64)
    ends = np.cumsum(pc.binary_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64))
    if len(place) != (ends[-1] if len(ends) else 0):
        raise ValueError("the tokens are not those of their texts")
    return np.append(place[ends[:-1]] - place[ends[:-1] - 1] > 1, False)


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The whole numbers of ``first[i]:first[i] + n[i]``, one range behind the other."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _lists(n: np.ndarray, items: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), items)


def _walk_pages(pages: DataFrame, ids: list[str], nodes: np.ndarray, last: np.ndarray, context: int, k: int, shards: int) -> DataFrame:
    """(ids, at, n, sent_no, first, text, mention[, context]): trie hits of one shard in (ids, tokens, ws or text, starts) rows.

    Texts and contexts are cut out beside the walk, so no page comes back from it.
    """
    spark = pages.sparkSession
    shard = spark.sparkContext.broadcast((nodes, last))
    rows = pages.select(*ids, "tokens", _spacing(pages), "starts", token_hashes(F.col("tokens")).alias("hashes"))
    schema = T.StructType([*(rows.schema[c] for c in ids), *(T.StructField(c, T.IntegerType()) for c in ("at", "n", "sent_no", "first")),
                           *(T.StructField(c, T.StringType()) for c in ("text", "mention")),
                           *([T.StructField("context", T.ArrayType(T.StringType()))] if context else [])])
    w = len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, last = shard.value
        for b in (part for whole in batches for part in slices(whole, w + 3, STEP)):
            h, offsets = _flat(b.column(w + 3))
            pos, n = walk(h.astype(np.int64).view(np.uint64), offsets, nodes, last, k, shards)
            if not len(pos):
                continue
            row = np.searchsorted(offsets, pos, "right") - 1
            s, s_offsets = _flat(b.column(w + 2))
            absolute = s.astype(np.int64) + np.repeat(offsets[:-1], np.diff(s_offsets))
            sent = np.searchsorted(absolute, pos, "right") - 1
            numbers = [pos - offsets[row], n, sent - s_offsets[row], s[sent]]
            tokens = b.column(w).flatten()
            here = ranges(pos, n)
            named = tokens.take(pa.array(here))
            blank = gaps(tokens, b.column(w + 1))[here]
            blank[np.cumsum(n) - 1] = False  # behind the name
            written = pc.binary_join_element_wise(named, pc.if_else(pa.array(blank), " ", ""), "")
            cols = [*(b.column(i).take(pa.array(row)) for i in range(w)), *(pa.array(c.astype(np.int32)) for c in numbers),
                    pc.binary_join(_lists(n, named), " "), pc.binary_join(_lists(n, written), "")]
            if context:
                lo, hi = np.maximum(pos - context, offsets[row]), np.minimum(pos + n + context, offsets[row + 1])
                before, after = pos - lo, hi - (pos + n)
                around = ranges(np.stack([lo, pos + n], 1).ravel(), np.stack([before, after], 1).ravel())
                cols.append(_lists(before + after, tokens.take(pa.array(around))))
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    found = rows.mapInArrow(run, schema)
    return found.withColumn("context", F.transform(F.filter("context", is_word), F.lower)) if context else found


def _spacing(pages: DataFrame) -> str:
    return "ws" if "ws" in pages.columns else "text"


@dataclass
class NameIndex:
    """A gazetteer's names, written once, for any number of searches."""

    labels: DataFrame  # text, label; no row twice, as a text has one token sequence
    n_labels: int
    nodes: DataFrame  # as of trie_nodes
    n_nodes: int


def name_index(gazetteer: DataFrame) -> NameIndex:
    spark = gazetteer.sparkSession
    folder = stage_dir(spark, "names")
    name_table(gazetteer).write.parquet(f"{folder}/names")
    names = spark.read.parquet(f"{folder}/names")
    trie_nodes(names.where(F.col("toks").isNotNull())).write.parquet(f"{folder}/nodes")
    nodes, labels = spark.read.parquet(f"{folder}/nodes"), names.select("text", "label")
    return NameIndex(labels, labels.count(), nodes, nodes.count())


def find_names(pages: DataFrame, gazetteer: DataFrame | NameIndex, ids: list[str], hot_rows: int = 1_000_000, context: int = 0,
               nodes: int = NODES, name_rows: int = NAME_ROWS) -> DataFrame:
    """(ids, at, n, sent_no, first, text, mention, label) for every name of ``gazetteer`` in (ids, tokens, ws or text, starts).

    ``at`` counts the page's tokens from 0, ``sent_no`` is the sentence the name begins
    in and ``first`` that sentence's first token.  A name with two
    labels gives two rows.  With ``context``, ``n_labels`` counts the labels of the name and
    ``context`` holds the words within so many tokens of it.  Up to ``name_rows`` the name table is broadcast;
    beyond, the hits are written, and the distinct texts of each block of them are looked up, so that a page is cut into
    tokens and walked once and ``hot_rows`` no longer matters.  Pages walked for several shards are written first.
    """
    index = gazetteer if isinstance(gazetteer, NameIndex) else name_index(gazetteer)
    shards = max(1, -(-index.n_nodes // nodes))
    if shards > 1:
        pages = stored(pages.select(*ids, "tokens", _spacing(pages), "starts"), "pages")
    found = None
    for k in range(shards):
        part = index.nodes.where(F.pmod("root", F.lit(shards)) == k).select("node", "last").toArrow()
        node = part.column("node").to_numpy().view(np.uint64)
        order = np.argsort(node)
        hits = _walk_pages(pages, ids, node[order], part.column("last").to_numpy(zero_copy_only=False)[order].astype(bool),
                           context, k, shards)
        found = hits if found is None else found.unionByName(hits)
    labels = index.labels
    if context:
        labels = labels.join(labels.groupBy("text").agg(F.count(F.lit(1)).alias("n_labels")), "text")
    if index.n_labels <= name_rows:
        return found.join(F.broadcast(labels), "text")
    return _looked_up(found, labels, context)


def _looked_up(found: DataFrame, labels: DataFrame, context: int) -> DataFrame:
    """``found`` with the labels of its texts, a row each; a text is asked for once a block of hits, and no hit is dealt out by its text."""
    from trawl.operators.blocks import with_answers

    more = [F.max("n_labels")] if context else [F.count(F.lit(1))]
    by_text = labels.groupBy("text").agg(F.collect_set("label").alias("labels"), *(m.alias("n_labels") for m in more))

    def ask(texts: DataFrame) -> DataFrame:
        return texts.withColumnRenamed("tok", "text").join(by_text, "text").select("block", "i", "labels", "n_labels")

    def decode(answers: pa.Table) -> Callable[[np.ndarray, np.ndarray, pa.Table], pa.Array]:
        i, table = answers.column("i").to_numpy(), answers.combine_chunks()
        row = np.full(i.max(initial=-1) + 2, -1)  # the last stands for all texts without a label
        row[i] = np.arange(len(i))

        def of(codes: np.ndarray, lens: np.ndarray, rows: pa.Table) -> pa.Array:
            at = row[np.minimum(codes, len(row) - 1)]
            at = pa.array(at, mask=at < 0)
            parts = [pa.concat_arrays(table.column(c).chunks).take(at) if len(table) else pa.nulls(len(at), table.schema.field(c).type)
                     for c in ("labels", "n_labels")]
            return pa.StructArray.from_arrays(parts, ["labels", "n_labels"])

        return of

    kind = T.StructType([T.StructField("labels", T.ArrayType(T.StringType())), T.StructField("n_labels", T.LongType())])
    hits = with_answers(found.withColumn("tokens", F.array("text")), found.columns, ask, T.StructField("_known", kind), decode)[0]
    n_labels = ["_known.n_labels"] if context else []
    return hits.where(F.col("_known.labels").isNotNull()).select(*found.columns, *n_labels, F.explode("_known.labels").alias("label"))
