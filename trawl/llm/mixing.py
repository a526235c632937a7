"""Mixing sources to target weights by pivotal dependent rounding (native).

Every source gets a number of words to give (its target).  A document of the
source is expected ``target / source_size`` times; the whole part of that is
given to every document, and the fractional part is rounded so that the
words add up:

* a document with ``size`` words holds ``x = size * fraction`` words of mass;
* two documents pool their mass and a hash-seeded coin moves it to one of
  them until one is empty or full, with the coin's odds chosen so that each
  document's expected mass is unchanged; the other carries the remainder;
* documents of one source are split into hash groups of about ``group``
  documents (a large source has many groups), each group leaves one
  undecided document, and these meet in the next level's groups, up to one
  per source, which goes the nearer way.

Within a group long documents meet first.  The mass of a source is therefore
exact up to half of one document.  Coins are
hashes of the seed and the two documents, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trawl.llm.common import Scratch, word_count


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) from (source, size): one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and
    share ``share`` times all words; a target stops at ``cap`` times its
    source's words and the excess is shared by weight among the others.  The
    level of the others is the largest quotient of remaining words and
    remaining weight along the sources sorted by ``cap * size / weight``.
    The windows run over one row per source, not over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                      F.sum((F.col("size") > 0).cast("long")).alias("n"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")))
    full = W.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, rest = full.rowsBetween(W.unboundedPreceding, -1), full.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    spare = F.lit(share) * F.sum("source_size").over(everything) - F.lit(cap) * F.coalesce(
        F.sum("source_size").over(before), F.lit(0))
    per = per.withColumn("level", spare / F.sum("weight").over(rest))
    per = per.withColumn("level", F.max("level").over(everything))
    return per.select("source", "source_size", "n",
                      F.least(F.lit(cap) * F.col("source_size"), F.col("level") * F.col("weight")).alias("target"))


def _unit(*cols: Column) -> Column:
    """Uniform number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))


def _pivot(acc: Column, e: Column, seed: int) -> Column:
    """One pivotal step: the undecided document of ``acc`` meets document ``e``."""
    i, j = acc["rest"], e
    pool = i["x"] + j["x"]
    up_i = F.least(i["size"].cast("double"), pool) - i["x"]
    up_j = F.least(j["size"].cast("double"), pool) - j["x"]
    to_i = _unit(F.lit(seed), i["doc_id"], j["doc_id"], i["size"], j["size"]) * (up_i + up_j) < up_j
    i_full, j_full = to_i & (pool >= i["size"]), ~to_i & (pool >= j["size"])

    def item(d, x):
        return F.struct(d["doc_id"].alias("doc_id"), d["size"].alias("size"), x.alias("x"))

    one, zero = F.lit(1.0), F.lit(0.0)
    rest = (F.when(i_full, item(j, pool - i["size"])).when(to_i, item(i, pool))
            .when(j_full, item(i, pool - j["size"])).otherwise(item(j, pool)))
    done = (F.when(i_full, item(i, one)).when(to_i, item(j, zero))
            .when(j_full, item(j, one)).otherwise(item(i, zero)))
    return F.struct(rest.alias("rest"), F.concat(acc["done"], F.array(done)).alias("done"))


def pivotal_rounding(items: DataFrame, scratch: Scratch, group: int = 256, seed: int = 17) -> DataFrame:
    """(source, doc_id, size, take 0/1) from (source, doc_id, size > 0, x in [0, size]).

    Equal rows are separate documents.  A group holds about ``group`` rows,
    whatever the size of its source.
    """
    n = items.groupBy("source").agg(F.count(F.lit(1)).alias("k"))
    widest = n.agg(F.max("k")).first()[0] or 0
    key = F.xxhash64(F.lit(seed), "doc_id", "size")
    item = F.struct("doc_id", "size", "x")
    cur = items.join(n.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", "doc_id", "size", "x", F.pmod(key, F.ceil(F.col("k") / group)).alias("b"))
    empty = F.array_remove(F.array(F.get("a", 0)), F.get("a", 0))
    levels = max(1, math.ceil(math.log(max(widest, 2), group)))
    if group ** levels < widest:
        levels += 1
    decided = None
    for level in range(levels):
        grouped = cur.groupBy("source", "b").agg(F.array_sort(F.collect_list(
            F.struct((-F.col("size")).alias("s"), F.xxhash64(F.lit(seed + level), "doc_id", "size").alias("h"),
                     item.alias("i")))).alias("a"))
        grouped = grouped.select("source", "b", F.transform("a", lambda r: r["i"]).alias("a"))
        first = F.struct(F.get("a", 0).alias("rest"), empty.alias("done"))
        out = grouped.select("source", "b", F.aggregate(
            F.slice("a", 2, F.greatest(F.size("a") - 1, F.lit(1))), first, lambda acc, e: _pivot(acc, e, seed + level)).alias("g"))
        out = scratch.keep(out, f"pivot-{level}")
        done = out.select("source", F.explode("g.done").alias("d")).select(
            "source", "d.doc_id", "d.size", F.col("d.x").cast("int").alias("take"))
        decided = done if decided is None else decided.unionByName(done)
        cur = out.select("source", F.col("g.rest.doc_id").alias("doc_id"), F.col("g.rest.size").alias("size"),
                         F.col("g.rest.x").alias("x"), F.floor(F.col("b") / group).alias("b"))
    nearer = (F.col("x") * 2 >= F.col("size")).cast("int")
    return decided.unionByName(cur.select("source", "doc_id", "size", nearer.alias("take")))


def mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0, group: int = 256,
        seed: int = 17) -> DataFrame:
    """Copies of every document: (doc_id, size, source_size, target, taken, copies).

    ``size`` is the number of words (null or empty text: 0, taken 0 times),
    ``taken`` the words the mix takes, repeats counted.  One row per input
    row; rows that repeat are separate documents; a null ``doc_id`` or
    ``source`` is a value like any other (the null source comes last); only
    ``doc_id``, ``source`` and ``text`` are read, other columns are ignored.
    An empty table gives an empty mix.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.keep(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    targets = scratch.keep(source_targets(sizes, weights, share, cap), "targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(copies + F.lit(1e-12)).cast("int")
    t = targets.select(F.col("source").alias("_s"), "source_size", "target", whole.alias("whole"),
                       F.greatest(copies - whole, F.lit(0.0)).alias("part"))
    same = F.col("source").eqNullSafe(F.col("_s"))
    items = sizes.where("size > 0").join(t, same).select(
        "source", "doc_id", "size", (F.col("size") * F.col("part")).alias("x"))
    rounded = pivotal_rounding(items, scratch, group, seed).unionByName(
        sizes.where("size = 0").select("source", "doc_id", "size", F.lit(0).alias("take")))
    n = F.when(F.col("size") > 0, F.col("whole") + F.col("take")).otherwise(0)
    return rounded.join(t, same).select("doc_id", "size", "source_size", "target",
                                        (F.col("size") * n).alias("taken"), n.cast("int").alias("copies"))


def repeat_documents(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The mix itself: every document as often as ``plan`` (from ``mix``) says; ids must be unique."""
    times = plan.where("copies > 0").select("doc_id", F.sequence(F.lit(1), F.col("copies")).alias("_copies"))
    out = docs.join(times, "doc_id").withColumn("_copy", F.explode("_copies"))
    return out.select(*[docs[c] for c in docs.columns])
