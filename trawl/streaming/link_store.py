"""L5 across batches: a store of resolved mentions that grows by sorted runs.

A batch writes the answers it has found (misses included) as one run: rows in
``buckets`` folders by a hash of the key, sorted by that hash inside.  When a tier
holds ``fan`` runs they are merged into one run of the next tier, so the number
of runs grows with the logarithm of the number of batches.  A manifest for
each epoch lists the live runs with the least and largest hash of every bucket.

A batch asks for its own keys only: of each run it reads the buckets its keys fall in,
where their hashes can lie between the run's bounds, and inside them the row groups of those
hashes (sorted files have tight bounds).  Answers never change, so a key is in one run only.

An epoch that is run again starts from the manifest before it and writes the
same folders anew.  Runs that neither of the last two manifests names are deleted.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import delete_path, path_status, read_text, write_text

KEYS = ["mention_key", "class"]
ROW = "mention_key string, class string, link string, h long, bucket int"


@dataclass
class LinkStore:
    spark: SparkSession
    path: str
    buckets: int = 16
    fan: int = 4

    def _hashed(self, df: DataFrame) -> DataFrame:
        h = F.xxhash64(*KEYS)
        return df.withColumn("h", h).withColumn("bucket", F.pmod(h, F.lit(self.buckets)).cast("int"))

    def manifest(self, epoch: int) -> list[dict]:
        """Live runs after the last epoch up to ``epoch``: name, tier, bounds by bucket."""
        for e in range(epoch, -1, -1):
            text = read_text(self.spark, f"{self.path}/manifest-{e}.json")
            if text is not None:
                return json.loads(text)
        return []

    def lookup(self, keys: DataFrame, epoch: int) -> DataFrame:
        """(mention_key, class, link) of those ``keys`` that epochs before ``epoch`` have answered."""
        asked = self._hashed(keys.select(*KEYS).distinct())
        bounds = {r["bucket"]: (r["lo"], r["hi"]) for r in asked.groupBy("bucket").agg(
            F.min("h").alias("lo"), F.max("h").alias("hi")).collect()}  # one row a bucket
        found = None
        for run in self.manifest(epoch - 1):
            met = {int(b): (lo, hi) for b, (lo, hi) in run["bounds"].items()
                   if int(b) in bounds and lo <= bounds[int(b)][1] and bounds[int(b)][0] <= hi}
            if met:
                part = self._read(run["name"]).where(F.col("bucket").isin(*met) & F.col("h").between(
                    min(bounds[b][0] for b in met), max(bounds[b][1] for b in met)))
                found = part if found is None else found.unionByName(part)
        if found is None:
            return self.spark.createDataFrame([], "mention_key string, class string, link string")
        return found.join(asked.select("h", *KEYS), ["h", *KEYS], "left_semi").select(*KEYS, "link")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(ROW).parquet(f"{self.path}/{name}")

    def _write(self, rows: DataFrame, name: str, tier: int) -> dict | None:
        """One run; None where there are no rows."""
        out = f"{self.path}/{name}"
        rows.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "h").write.mode("overwrite").partitionBy(
            "bucket").parquet(out)
        bounds = self._read(name).groupBy("bucket").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).collect() if any(
            path_status(self.spark, f"{out}/bucket={b}")[0] is not None for b in range(self.buckets)) else []
        return {"name": name, "tier": tier, "bounds": {r["bucket"]: [r["lo"], r["hi"]] for r in bounds}} if bounds else None

    def append(self, answers: DataFrame, epoch: int) -> DataFrame:
        """Store the (mention_key, class, link) rows an epoch has found, merge full tiers; the rows as stored.

        A null link is a known miss.  An epoch without rows adds no run.
        """
        before = self.manifest(epoch - 1)
        own = self._write(self._hashed(answers.select(*KEYS, "link")), f"run-{epoch}", 0)
        live = [*before, *([own] if own else [])]
        dropped: list[str] = []
        tier = 0
        while sum(r["tier"] == tier for r in live) >= self.fan:
            full = [r for r in live if r["tier"] == tier]
            rows = self._read(full[0]["name"])
            for r in full[1:]:
                rows = rows.unionByName(self._read(r["name"]))
            merged = self._write(rows, f"run-{epoch}-tier-{tier + 1}", tier + 1)
            live = [r for r in live if r["tier"] != tier] + [merged]
            dropped += [r["name"] for r in full]
            tier += 1
        write_text(self.spark, f"{self.path}/manifest-{epoch}.json", json.dumps(live))
        self._clean(epoch, live, before)
        if own is None:
            return self.spark.createDataFrame([], "mention_key string, class string, link string")
        return self._read(own["name"]).select(*KEYS, "link")

    def _clean(self, epoch: int, live: list[dict], before: list[dict]) -> None:
        """Delete runs that only manifests before the last two name, and those manifests."""
        named = {r["name"] for r in [*live, *before]} | {f"run-{epoch}"}
        for e in range(epoch - 2, -1, -1):
            text = read_text(self.spark, f"{self.path}/manifest-{e}.json")
            if text is None:
                break
            for r in json.loads(text):
                if r["name"] not in named:
                    delete_path(self.spark, f"{self.path}/{r['name']}")
            delete_path(self.spark, f"{self.path}/manifest-{e}.json")
        stale = f"run-{epoch - 1}"
        if stale not in named:
            delete_path(self.spark, f"{self.path}/{stale}")
