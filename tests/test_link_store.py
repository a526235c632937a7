"""The link store over many epochs."""

import os

from pyspark.sql import functions as F

from trawl.streaming.link_store import LinkStore


def rows(spark, ids):
    return spark.createDataFrame([(f"m{i}", "c" if i % 3 else "d", None if i % 5 == 0 else f"l{i}") for i in ids],
                                 "mention_key string, class string, link string")


def test_seven_epochs(spark, tmp_path):
    store = LinkStore(spark, str(tmp_path / "s"), buckets=4, fan=2)
    want = {}
    for epoch in range(7):
        ids = range(epoch * 40, epoch * 40 + 40) if epoch != 4 else range(0)
        asked = rows(spark, range(max(0, epoch * 40 - 60), epoch * 40 + 40))
        known = {(r.mention_key, r["class"]): r.link for r in store.lookup(asked.unionByName(asked), epoch).collect()}
        assert known == {k: v for k, v in want.items() if k in {(r.mention_key, r["class"]) for r in asked.collect()}}
        new = rows(spark, ids)
        assert sorted(map(str, store.append(new, epoch).collect())) == sorted(map(str, new.collect()))
        want |= {(r.mention_key, r["class"]): r.link for r in new.collect()}
        assert len(store.manifest(epoch)) <= 2 * 2
    everything = store.lookup(rows(spark, range(500)), 7)
    assert {(r.mention_key, r["class"]): r.link for r in everything.collect()} == want and everything.count() == len(want)
    files = [f for d, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 4 * 2 * (2 * 2 + 3)  # buckets x (runs of the last two manifests), not epochs
    # an epoch run again gives the same answers, and a batch reads only the buckets of its keys
    again = store.lookup(rows(spark, range(220, 280)), 6).collect()
    assert len(again) == 20
    store.append(rows(spark, range(240, 280)), 6)
    assert store.lookup(rows(spark, range(500)), 7).count() == len(want)
    one = rows(spark, [7])
    bucket = store._hashed(one).first().bucket
    plan = store.lookup(one, 7)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and f" = {bucket})" in plan and "PushedFilters: [IsNotNull(h), GreaterThanOrEqual(h" in plan
    assert store.lookup(one.limit(0), 7).count() == 0 and LinkStore(spark, str(tmp_path / "none")).lookup(one, 5).count() == 0


def test_nulls_in_keys_stay_unknown(spark, tmp_path):
    store = LinkStore(spark, str(tmp_path / "s"))
    df = spark.createDataFrame([(None, "c", "x"), ("m", None, "y"), ("m", "c", "z")], "mention_key string, class string, link string")
    store.append(df, 0)
    assert [r.link for r in store.lookup(df, 1).collect()] == ["z"]
    assert store.lookup(df.withColumn("extra", F.lit(1)), 1).columns == ["mention_key", "class", "link"]
