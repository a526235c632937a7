"""One label per mention, chosen by the words around it.

Names with a single label in the name table teach which words stand near
mentions of that label.  A mention of a name with several labels takes the
label with the highest naive Bayes score: the share of mentions with that
label, and for every word around the mention its share among the words around
that label.  Scores are sums of whole numbers (millionths of a logarithm), so the
order of addition does not matter.  The words around a mention are looked up once a
block of mentions (``blocks``); the rest is joins and aggregations.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.operators.blocks import with_answers
from trawl.session import stored


def micro_log(x):
    return F.floor(F.log(x) * 1_000_000).cast("bigint")


def choose_labels(hits: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """The mentions of ``hits`` with one label each, columns as given, less ``n_labels`` and ``context``.

    ``hits`` has a row for each mention (key, at, n) and label, ``n_labels`` of its name
    and ``context``, the words around it.  Equal scores take the smallest
    label; without any mention that teaches, all labels score alike.  Rows that share key, at, n are one
    mention, without a key one whose words say nothing.  An empty table gives an empty result.  A
    word is one row a block of mentions, so none is frequent and ``hot_rows`` no longer matters.
    """
    names = [c for c in hits.columns if c not in ("n_labels", "context", "label")]
    taught = hits.where("n_labels = 1")
    near = stored(taught.select("label", F.explode("context").alias("word")).groupBy("label", "word").agg(
        F.count(F.lit(1)).alias("c")), "near")
    size = near.agg(F.count_distinct("word").alias("v")).first()["v"]
    # a row for each label of the name table: a few
    n_taught = {r["label"]: r["m"] for r in hits.groupBy("label").agg(F.count_if(F.col("n_labels") == 1).alias("m")).collect()}
    n_near = {r["label"]: r["t"] for r in near.groupBy("label").agg(F.sum("c").alias("t")).collect()}
    total, labels = sum(n_taught.values()), list(n_taught)
    if not labels:
        return hits.select(*names, "label")
    counts = hits.sparkSession.range(1).select(F.inline(F.array(*(F.struct(
        F.lit(x).cast("string").alias("label"), F.lit(n_taught[x]).cast("bigint").alias("m"), F.lit(n_near.get(x, 0)).cast("bigint").alias("t"))
        for x in labels))))
    stats = counts.select("label", micro_log((F.col("m") + 1) / F.lit(float(total + len(labels)))).alias("prior"),
                          (F.col("t") + F.lit(size + 1)).cast("double").alias("of"))
    unseen = {r["label"]: r["s"] for r in stats.select("label", micro_log(F.lit(1) / F.col("of")).alias("s")).collect()}
    base = np.array([unseen[x] for x in labels], np.int64)
    place = {x: i for i, x in enumerate(labels)}
    open_ = hits.where("n_labels > 1").drop("n_labels").withColumnRenamed("context", "tokens")

    def ask(tokens: DataFrame) -> DataFrame:
        known = tokens.withColumnRenamed("tok", "word").join(near, "word").join(F.broadcast(stats), "label")
        return known.select("block", "i", "label", micro_log((F.col("c") + 1) / F.col("of")).alias("s"))

    def decode(found: pa.Table) -> Callable[[np.ndarray, np.ndarray, pa.Table], pa.Array]:
        i = found.column("i").to_numpy()
        n = i.max(initial=-1) + 1
        scores = np.repeat(base[:, None], n + 1, 1)  # the last of each stands for all words not found
        scores[[place[x] for x in found.column("label").to_pylist()], i] = found.column("s").to_numpy()

        def sums(codes: np.ndarray, lens: np.ndarray, rows: pa.Table) -> pa.Array:
            at = np.array([place[x] for x in rows.column("label").to_pylist()], np.int64)
            run = np.concatenate([[0], np.cumsum(scores[np.repeat(at, lens), np.minimum(codes, n)])])
            ends = np.cumsum(lens)
            return pa.array(run[ends] - run[ends - lens])

        return sums

    scored = with_answers(open_, [c for c in open_.columns if c != "tokens"], ask, T.StructField("s", T.LongType()), decode)[0]
    scored = scored.withColumn("s", F.when(F.col("key").isNull(), F.lit(0)).otherwise(F.col("s")))
    rest = [c for c in names if c not in ("key", "at", "n")]
    by_label = scored.repartition("key", "at", "n").groupBy("key", "at", "n", "label").agg(
        F.sum("s").alias("s"), F.first(F.struct("label", *rest)).alias("b")).join(F.broadcast(stats), "label")
    best = by_label.groupBy("key", "at", "n").agg(F.min_by("b", F.struct(-(F.col("prior") + F.col("s")), F.col("label"))).alias("b"))
    chosen = best.select("key", "at", "n", "b.*")
    return taught.select(*names, "label").unionByName(chosen.select(*names, "label"))
