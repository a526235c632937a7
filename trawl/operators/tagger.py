"""Part-of-speech tags from context, by a bigram model and Viterbi decoding.

``train_tagger`` counts, in Spark, how often a tag follows another, how often a
word has a tag, and what shapes (suffix and spelling rules) the words seen
once have under each tag; the last stands in for words never seen.  Costs are
whole numbers (thousandths of a negative natural logarithm), so a best path
is exact and ties are settled by rule.

``tag_in_context`` decodes many sentences together in numpy.  The word
table travels to the tasks if its counted rows are within a bound; a larger table is
joined to the distinct words of each block of sentences instead (``blocks``), so a
frequent word is one row a block.  No token is shuffled either way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.operators.annotate import RULE_TAGS, default_tag
from trawl.operators.blocks import counted_tokens, joined, with_answers
from trawl.session import stored

EDGE = "^"  # before the first and after the last token
NEVER = 1 << 40
WORD_ROWS = 1_000_000  # rows of (word, tag, cost) up to which the word table travels whole
ABREAST = 1000  # sentences of about a length that are decoded side by side


def cost(seen: Column, of: Column) -> Column:
    return F.floor(-1000 * F.log(seen / of)).cast("int")


@dataclass
class Tagger:
    """Word costs as a table; the costs between tags and of shapes are a few hundred numbers."""

    words: DataFrame  # word, tag, cost
    tags: list[str]
    steps: np.ndarray  # from tag (last row: edge) to tag (last column: edge)
    shapes: dict[str, np.ndarray]  # shape letter -> cost by tag
    other: np.ndarray  # cost by tag of a shape never seen


def train_tagger(tagged: DataFrame) -> Tagger:
    """A model from (tokens, pos) rows, ``pos`` one letter per token.

    Rows whose lengths differ, empty and null rows are left out.  Repeated rows count
    again.  An empty table gives a model without tags, under which every token keeps its shape's letter.
    """
    counted = counted_tokens(tagged, EDGE).withColumn("word", F.lower("t")).repartition("before", "word")  # so summed in one place at once
    all_counts = stored(counted.groupBy("before", "word", "tag").agg(F.sum("n").alias("n"), F.min("t").alias("t")), "counts")
    pairs = all_counts.where("before IS NOT NULL").select(F.col("before").alias("a"), F.col("tag").alias("b"), "n").collect()  # tags x tags rows
    tags = sorted({r["a"] for r in pairs} - {EDGE})
    at = {t: i for i, t in enumerate([*tags, EDGE])}
    seen = np.ones((len(at), len(at)))
    for r in pairs:
        seen[at[r["a"]], at[r["b"]]] += r["n"]
    steps = np.floor(-1000 * np.log(seen / seen.sum(1, keepdims=True))).astype(np.int64)
    counts = all_counts.where("before IS NULL").drop("before")
    of_tag = counts.groupBy("tag").agg(F.sum("n").alias("of"))  # one row a tag
    words = counts.join(F.broadcast(of_tag), "tag").select("word", "tag", cost(F.col("n"), F.col("of")).alias("cost"))
    total = {r["tag"]: r["of"] for r in of_tag.collect()}
    once = counts.where("n = 1").groupBy(default_tag(F.col("t")).alias("shape"), "tag").agg(F.count(F.lit(1)).alias("n")).collect()
    all_shapes = sorted({r["shape"] for r in once})
    by = {s: np.ones(len(tags)) for s in all_shapes}
    for r in once:
        by[r["shape"]][at[r["tag"]]] += r["n"]
    size = np.array([total.get(t, 0) + len(all_shapes) + 1.0 for t in tags])
    shapes = {s: np.floor(-1000 * np.log(v / size)).astype(np.int64) for s, v in by.items()}
    return Tagger(words, tags, steps, shapes, np.floor(-1000 * np.log(1 / size)).astype(np.int64))


def best_paths(costs: list[np.ndarray], steps: np.ndarray) -> list[np.ndarray]:
    """The cheapest tag path of each sentence; ``costs`` holds tokens x tags.

    Of equally cheap paths the one with the smallest last tag wins, then the smallest before it, and so on.
    """
    if not costs:
        return []
    lens = np.fromiter(map(len, costs), np.int64, len(costs))
    flat = np.concatenate(costs)
    return np.split(best_tags(flat, lens, steps), np.cumsum(lens)[:-1])


def best_tags(costs: np.ndarray, lens: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """``best_paths`` of sentences of ``lens`` tokens laid end to end."""
    return best_coded(costs, np.arange(len(costs)), lens, steps)


def best_coded(costs: np.ndarray, codes: np.ndarray, lens: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """``best_tags`` of tokens that are rows ``codes`` of ``costs``; sentences of like length go forward, then back, side by side."""
    out = np.zeros(len(codes), np.int64)
    starts, order, tags = np.cumsum(lens) - lens, np.argsort(-lens, kind="stable"), len(steps) - 1
    order = order[:int((lens > 0).sum())]
    bits = max(tags - 1, 1).bit_length()
    # the tag a step comes from stands in its lowest bits, so that one minimum finds cost and tag, the smallest of equals
    step = ((steps[:-1, :-1] << bits) | np.arange(tags)[:, None])[:, :, None]
    for lo in range(0, len(order), ABREAST):
        size, start = lens[order[lo:lo + ABREAST]], starts[order[lo:lo + ABREAST]]
        live = [int(n) for n in np.searchsorted(-size, -np.arange(int(size[0])), "left")]  # sentences longer than p
        back: list[np.ndarray] = []
        best = steps[-1, :-1, None] + costs[codes[start]].T
        for p in range(1, len(live)):
            found = ((best[:, None, :live[p]] << bits) + step).min(0)
            back.append((found & ((1 << bits) - 1)).astype(np.int16))
            best[:, :live[p]] = np.minimum((found >> bits) + costs[codes[start[:live[p]] + p]].T, NEVER)
        tag = (best + steps[:-1, -1, None]).argmin(0)
        for p in range(len(live) - 1, -1, -1):
            out[start[:live[p]] + p] = tag[:live[p]]
            if p:
                tag[:live[p]] = back[p - 1][tag[:live[p]], np.arange(live[p])]
    return out


def tag_in_context(sents: DataFrame, model: Tagger, word_rows: int = WORD_ROWS, hot_rows: int = 1_000_000,
                   block: int = 2000, keep: list[str] | None = None) -> DataFrame:
    """``sents`` (with ``tokens``), or its columns ``keep``, plus ``pos``, one letter per token by the cheapest path of each sentence.

    A known word may only have tags it was seen with; an unknown one has a cost by its
    shape.  Null or empty tokens give an empty ``pos``.  Where the word table is too large
    to travel, the distinct words of blocks of sentences are joined with it, so no
    word is frequent and ``hot_rows`` no longer matters.
    """
    spark = sents.sparkSession
    tags, steps = model.tags, model.steps
    names = [c for c in keep or sents.columns if c != "pos"]
    at = {t: i for i, t in enumerate(tags)}
    shape_names = [*model.shapes]
    shape_costs = np.array([*model.shapes.values(), model.other], np.int64).reshape(len(shape_names) + 1, len(tags))
    by_rule = shape_costs[[shape_names.index(r) if r in shape_names else len(shape_names) for r in RULE_TAGS]]
    letters = pa.array(tags, pa.string())
    field = T.StructField("pos", T.StringType())

    if tags and model.words.count() > word_rows:
        number = F.create_map(*(F.lit(x) for t, i in at.items() for x in (t, i << 32)))

        def ask(tokens: DataFrame) -> DataFrame:
            """An answer is a tag and its cost; of an unknown word its rule, under zero."""
            rule = -F.instr(F.lit(RULE_TAGS), default_tag(F.col("tok"))).cast("bigint")
            asked = tokens.select("block", "i", F.lower("tok").alias("word"), rule.alias("rule"))
            return asked.join(model.words, "word", "left").select("block", "i", F.coalesce(number[F.col("tag")] + F.col("cost"), "rule").alias("v"))

        def decode(found: pa.Table) -> Callable[[np.ndarray, np.ndarray, pa.Table], pa.Array]:
            i, v = found.column("i").to_numpy(), found.column("v").to_numpy()
            costs, known = np.full((i.max(initial=-1) + 1, len(tags)), NEVER, np.int64), v >= 0
            costs[i[~known]] = by_rule[-v[~known] - 1]
            costs[i[known], v[known] >> 32] = v[known] & 0xFFFFFFFF
            return lambda codes, lens, _: joined(letters.take(pa.array(best_coded(costs, codes, lens, steps))), lens)

        return with_answers(sents, names, ask, field, decode)[0]

    tokens = F.coalesce("tokens", F.array().cast("array<string>"))
    rows = sents.select(*names, F.transform(tokens, default_tag).alias("_shapes"), F.transform(tokens, F.lower).alias("_words"))
    schema = T.StructType([*(sents.schema[c] for c in names), field])
    table = model.words.toArrow().to_pydict()
    every: dict[str, list[tuple[int, int]]] = {}
    for w, t, c in zip(table["word"], table["tag"], table["cost"]):
        every.setdefault(w, []).append((at[t], c))
    shared = spark.sparkContext.broadcast(every)

    def tagged(shapes: pa.Array, words: pa.Array, known: dict[str, list[tuple[int, int]]]) -> pa.Array:
        """``pos`` of rows; words and shapes are looked up once for all of them."""
        lens = shapes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        if not tags:
            return joined(shapes.flatten(), lens)
        shape, word = shapes.flatten().dictionary_encode(), words.flatten().dictionary_encode()
        row = {s: i for i, s in enumerate(RULE_TAGS)}
        costs = by_rule[[row[s] for s in shape.dictionary.to_pylist()]][shape.indices.to_numpy()]
        distinct = word.dictionary.to_pylist()
        by_word, seen = np.full((len(distinct), len(tags)), NEVER, np.int64), np.zeros(len(distinct), bool)
        for i, w in enumerate(distinct):
            for t, c in known.get(w, ()):
                by_word[i, t] = c
                seen[i] = True
        at_word = word.indices.to_numpy()
        costs = np.where(seen[at_word][:, None], by_word[at_word], costs)
        return joined(letters.take(pa.array(best_tags(costs, lens, steps))), lens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, k = shared.value, len(names)
        for b in batches:
            for lo in range(0, len(b), block):
                part = b.slice(lo, block)
                pos = tagged(part.column(k), part.column(k + 1), known)
                yield pa.RecordBatch.from_arrays([*part.columns[:k], pos], schema.names)

    return rows.mapInArrow(run, schema)
