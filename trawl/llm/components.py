"""Connected components of a link table, as DataFrame rounds.

Every round replaces the links by stars: each node points its larger
neighbours at the smallest node of its neighbourhood, then its smaller
neighbours likewise.  Only (node, smallest neighbour) pairs are shuffled
after partial aggregation, so a node with very many links is one row per
task; the joins have one row per node on one side, which AQE can split.
The links never leave the executors; the driver sees one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Scratch


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step on links (u, v) with u > v."""
    if large:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        out = near.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) for every node of links (a, b); component is the smallest node.

    ``links`` holds bigint pairs in any order; loops, nulls and repeats are
    ignored.  An empty table gives an empty result.
    """
    cur = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("u") != F.col("v"))).distinct()
    cur = scratch.keep(cur, f"{name}-0")
    checksum = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
    last = None
    step = 0
    while True:
        now = cur.select(checksum.alias("c")).first()["c"]
        if now == last or now[0] == 0:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        last = now
        step += 1
        cur = scratch.keep(_star(_star(cur, True), False), f"{name}-{step}")
