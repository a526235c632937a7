"""Frequent keys by a sketch, salted in-links, backlink answers, page order."""

import json

import pytest
from pyspark.sql import functions as F

from trawl.functions.plan import frequent_keys, hot_split_join
from trawl.operators.link import most_popular
from trawl.plans import fixtures as fx
from trawl.sources import kb as K
from trawl.sources.lines import result_lines


def test_frequent_keys_without_a_shuffle_of_keys(spark):
    n = 20_000
    big = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("the")).when(F.col("id") % 50 == 1, F.lit("of")).otherwise(
        F.col("id").cast("string")).alias("w"), "id").unionByName(spark.createDataFrame([(None, -1)], "w string, id long"))
    hot = {r["_hot"] for r in frequent_keys(big, ["w"], 200).collect()}
    want = {r.h for r in big.groupBy("w").count().where("count >= 200").select(F.xxhash64("w").alias("h")).collect()}
    assert hot == want and len(hot) == 2
    small = big.select("w").distinct().where("w <> '7'").withColumn("x", F.length("w"))
    for how in ("inner", "left"):
        want = sorted(map(str, big.join(small, ["w"], how).collect()))
        for rows in (1, 200, 10 ** 9):
            assert sorted(map(str, hot_split_join(big, small, ["w"], rows, how=how).collect())) == want
    plan = frequent_keys(big, ["w"], 200)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "partial_approx_top_k" in plan
    assert hot_split_join(big.limit(0), small, ["w"], 1).count() == 0


def test_hot_item_is_dealt_over_parts(spark, tmp_path):
    """A third of all links on one item: no part of the stored link table holds over twice the median."""
    links = spark.range(9000).select(F.concat(F.lit("s"), "id").alias("source"), F.when(F.col("id") % 3 == 0, F.lit("hub")).otherwise(
        F.concat(F.lit("t"), F.col("id") % 2000)).alias("target"))
    kb = fx.derived_kb(fx.read_table(spark, "/root/testdata/sf0.001", "documents").limit(5))
    kb.link = links
    kb.save(str(tmp_path / "kb"), rows_per_part=300)
    stored = spark.read.parquet(str(tmp_path / "kb" / "kb_link"))
    sizes = sorted(r["count"] for r in stored.groupBy(F.input_file_name()).count().collect())
    assert sum(sizes) == 9000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert sorted(map(str, stored.select("source", "target").collect())) == sorted(map(str, links.collect()))
    assert {r.item: r.in_degree for r in K.KnowledgeGraph.load(spark, str(tmp_path / "kb")).in_degree().collect()}["hub"] == 3000


def test_backlink_answers(spark, tmp_path):
    answers = {"New_York": {"batchcomplete": "", "query": {"backlinks": [{"pageid": 1, "ns": 4, "title": "Project:A"}, {"pageid": 2, "ns": 4, "title": "Project:B"}]}},
               "York": {"query": {"backlinks": [{"pageid": 3, "ns": 0, "title": "C"}]}}, "Nowhere": {"error": "x"}, "Empty": {"query": {"backlinks": []}}}
    for title, answer in answers.items():
        (tmp_path / f"{title}.json").write_text(json.dumps(answer, indent=1))
    table = K.read_backlink_answers(spark, str(tmp_path))
    assert sorted(map(tuple, table.collect())) == [("New_York", "Project:A", 4), ("New_York", "Project:B", 4), ("York", "C", 0)]
    cands = spark.createDataFrame([("ny", "c", "ny", "i1", "New York", "http://x/New_York", 1), ("ny", "c", "ny", "i2", "York", "http://x/York", 9)],
                                  "mention_key string, class string, rep string, item string, name string, page string, cnt long")
    assert [r.page for r in most_popular(cands, table).collect()] == ["http://x/New_York"]


@pytest.mark.parametrize("with_order", [True, False])
def test_lines_in_page_order(spark, with_order):
    ents = spark.createDataFrame([("k1", "Zoe", "L1"), ("k1", "Ann", "L2"), ("k2", "Bob", "L3")], "key string, mention string, link string")
    rels = spark.createDataFrame([("k1", 2, 5, "A", "B", "r2"), ("k1", 2, 1, "A", "B", "r1"), ("k2", 0, 0, "A", "B", "r0")],
                                 "key string, sent long, start int, link1 string, link2 string, rel string")
    places = spark.createDataFrame([("k1", 3, 0, "Ann"), ("k1", 1, 4, "Zoe"), ("k1", 1, 9, "Ann"), ("k2", 0, 0, "Bob"), ("k1", 0, 2, "not linked")],
                                   "key string, sent long, start int, mention string")
    order = spark.createDataFrame([("k2", ("a", 1)), ("k1", ("b", 0))], "key string, page_no struct<file:string,rec_no:bigint>")
    got = [r.value.replace("\t", " ") for r in result_lines(ents, rels, True, order if with_order else None, places).collect()]
    k1 = ["ENTITY: k1 Zoe L1", "ENTITY: k1 Ann L2", "RELATION: k1 A B r1", "RELATION: k1 A B r2"]
    k2 = ["ENTITY: k2 Bob L3", "RELATION: k2 A B r0"]
    assert got == (k2 + k1 if with_order else k1 + k2)
    assert sorted(r.value for r in result_lines(ents, rels).collect()) == sorted(v.value for v in result_lines(ents, rels, True, order, places).collect())
