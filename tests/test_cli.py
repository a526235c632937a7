"""The command line jobs on a small WARC file and a derived graph."""

import datetime

from pyspark.sql import functions as F

from trawl.plans import fixtures as fx
from trawl.plans import run
from trawl.sources import warc as W

SF = "/root/testdata/sf0.001"


def test_default_output_name():
    assert run.default_output_name(datetime.datetime(2012, 2, 10, 21, 49, 39)) == "warcs-20120210-214939"


def test_preprocess_link_score(spark, tmp_path, capsys):
    recs = fx.warc_payloads(fx.read_table(spark, SF, "pages"))
    W.write_warc(recs.coalesce(2), str(tmp_path / "warcs"))
    fx.derived_kb(fx.read_table(spark, SF, "documents")).save(str(tmp_path / "kb"), partitions=4)

    run.main(["preprocess", "--warc", str(tmp_path / "warcs"), "--pre-proc-dir", str(tmp_path / "pp"),
              "--name", "x", "--csv"])
    run.main(["preprocess", "--warc", str(tmp_path / "warcs"), "--pre-proc-dir", str(tmp_path / "pp"),
              "--name", "y", "--fast"])
    assert spark.read.parquet(str(tmp_path / "pp" / "y")).count() == 40
    n_csv = spark.read.option("lineSep", "\r\n").text(str(tmp_path / "pp" / "x.csv")).count()
    assert n_csv == 40  # 50 pages, 5 without key, 5 not HTML

    assert capsys.readouterr().out.count("no_key 5, not_html 5 of ") == 2

    spark.createDataFrame([("is", "V"), ("The", "D"), ("the", "D")], "form string, mark string").write.parquet(
        str(tmp_path / "tagged"))
    run.main(["lexicon", "--tagged", str(tmp_path / "tagged"), "--word", "form", "--tag", "mark",
              "--out", str(tmp_path / "lex")])
    assert {(r.word, r.tag, r.n) for r in spark.read.parquet(str(tmp_path / "lex")).collect()} == {
        ("is", "V", 1), ("the", "D", 2)}

    out = str(tmp_path / "out")
    run.main(["link", "--lexicon", str(tmp_path / "lex"), "--warc", str(tmp_path / "warcs"), "--kb", str(tmp_path / "kb"), "--out", out,
              "--ordered", "--stage-dir", str(tmp_path / "stages")])
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines and all(v.startswith(("ENTITY: fixture-", "RELATION: fixture-")) for v in lines)

    run.main(["score", out, out, "ENTITY"])
    printed = capsys.readouterr().out
    assert "rejected records" in printed and "skipped gold lines: 0" in printed and "skipped pred lines: 0" in printed
    assert "precision: 1.0" in printed and "f1: 1.0" in printed


def test_stages_follow_their_input(spark, tmp_path):
    from trawl.plans.linking import materialise

    assert materialise(spark.range(3).toDF("x"), str(tmp_path), "s").count() == 3
    assert materialise(spark.range(10).toDF("x"), str(tmp_path), "s").count() == 10


def test_graph_from_dumps(spark, tmp_path, capsys):
    from trawl.sources import kb as K

    made = fx.derived_kb(fx.read_table(spark, SF, "documents"))
    K.to_ntriples(made).write.text(str(tmp_path / "nt"))
    spark.createDataFrame([("no triple",), ("# remark",), ("",), ("<a> <http://other/p> <b> .",)], "value string").write.mode(
        "append").text(str(tmp_path / "nt"))
    run.main(["graph", "--dumps", str(tmp_path / "nt"), "--out", str(tmp_path / "kb")])
    assert "rejected lines: 1" in capsys.readouterr().out
    got = K.KnowledgeGraph.load(spark, str(tmp_path / "kb"))
    for name in K.TABLES:
        a, b = getattr(got, name), getattr(made, name)
        assert a.count() == b.count() and a.select(b.columns).exceptAll(b).count() == 0, name


def test_skipped_score_lines(spark):
    from trawl.operators.score import skipped

    lines = spark.createDataFrame([("ENTITY: k\ta\tb", 0), ("ENTITY: k\ta", 1), ("RELATION: k\ta\tb\tc", 2),
                                   ("RELATION: k\ta", 3)], "value string, line_no long")
    assert [r.line_no for r in skipped(lines, "ENTITY", "pred").collect()] == [1]
    assert [r.line_no for r in skipped(lines, "ENTITY", "gold").collect()] == [1]
    assert [r.line_no for r in skipped(lines, "RELATION", "pred").collect()] == [3]
