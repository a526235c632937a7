"""E1-E10, S2-S10 and S1/S9 sources."""

import csv
import gzip
import io
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from trawl.operators.score import score
from trawl.sources import kb as K
from trawl.sources import lines as LN
from trawl.sources import warc as W


def lines(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, line_no bigint")


def result(df):
    r = df.first()
    return (r.gold, r.predicted, r.correct, r.precision, r.recall, r.f1)


def test_score_self_is_one(spark):
    ls = ["ENTITY: r1\ta\tA", "ENTITY: r1\tb\tB", "ENTITY: r2\ta\tC"]
    assert result(score(lines(spark, ls), lines(spark, ls), "ENTITY")) == (3, 3, 3, 1.0, 1.0, 1.0)


def test_score_zero_predictions_gives_nulls(spark):
    assert result(score(lines(spark, ["ENTITY: r\ta\tA"]), lines(spark, ["nothing"]), "ENTITY")) == \
        (1, 0, 0, None, 0.0, None)


def test_score_last_line_wins_and_field_counts(spark):
    gold = ["ENTITY: r\ta\tA", "ENTITY: r\ta\tB", "ENTITY: r\tbad", "ENTITY: r\tb\tB"]
    pred = ["ENTITY: r\ta\tB", "ENTITY: r\tb\tX", "text with ENTITY inside\tx\ty"]
    # gold: (r,a)->B (last wins), (r,b)->B; "ENTITY: r\tbad" skipped (2 fields)
    # pred: (r,a)->B, (r,b)->X, and a line containing the type word with 3 fields -> parsed too
    g, p, c, prec, rec, f1 = result(score(lines(spark, gold), lines(spark, pred), "ENTITY"))
    assert (g, p, c) == (2, 3, 1)
    g, p, c, *_ = result(score(lines(spark, gold), lines(spark, pred), "ENTITY", strict=True))
    assert (g, p, c) == (2, 2, 1)


def test_score_relations_4_and_5_fields(spark):
    gold = ["r\tRELATION\tmet\tS\tO\tid1", "r\tRELATION\tsaw\tS\tO\tid2"]
    pred = ["RELATION: r\tS\tO\tmet", "RELATION: r\tS\tO\tsaw\tidX", "RELATION: r\tS\tbad"]
    assert result(score(lines(spark, gold), lines(spark, pred), "RELATION"))[:3] == (2, 2, 2)


def test_entity_relation_line_format_roundtrip(spark):
    sample = ["RELATION: clue-1\thttp://en.wikipedia.org/wiki/A\thttp://en.wikipedia.org/wiki/B\tsaid it",
              "RELATION: clue-2\thttp://en.wikipedia.org/wiki/Ä\thttp://en.wikipedia.org/wiki/Ä\tcomprised of"]
    df = LN.parse_relation_lines(spark.createDataFrame([(s,) for s in sample], "value string"))
    assert [r.value for r in LN.relation_lines(df).collect()] == sample


def py_csv_line(row):
    buf = io.StringIO()
    csv.writer(buf, quoting=csv.QUOTE_NONE, escapechar="\\").writerow(row)
    return buf.getvalue()[:-2]  # drop the \r\n terminator


def test_csv_escape_matches_python_and_roundtrips(spark):
    rnd = random.Random(3)
    alphabet = list("ab,\\\"\r\n é")
    rows = [tuple("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(4))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    got = [r.value for r in LN.csv_lines(df, ["a", "b", "c", "d"]).collect()]
    assert got == [py_csv_line(r) for r in rows]
    back = LN.parse_csv_lines(LN.csv_lines(df, ["a", "b", "c", "d"]), ["a", "b", "c", "d"])
    assert [tuple(r) for r in back.collect()] == rows


def test_csv_file_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("k,1", "t\r\nx", "h\\", 'say "hi"')], "key string, title string, headers string, text string")
    LN.write_csv(df, ["key", "title", "headers", "text"], str(tmp_path / "csv"))
    back = LN.read_csv(spark, str(tmp_path / "csv"), ["key", "title", "headers", "text"])
    assert [tuple(r) for r in back.collect()] == [tuple(r) for r in df.collect()]


def write_warc_gz(path, payloads, crlf=True):
    nl = "\r\n" if crlf else "\n"
    with gzip.open(path, "wt", encoding="utf-8", newline="") as f:
        for p in payloads:
            f.write("WARC/1.0" + nl + p.replace("\n", nl))


def test_warc_fast_and_exact_paths(spark, tmp_path):
    p1 = "WARC-Type: x\nA\nWARC-TREC-ID: k1\n" + "h\n" * 7 + "Content-Type: text/html\n\n<p>One</p>\n"
    p2 = "WARC-Type: x\nA\nWARC-TREC-ID: k2\n" + "h\n" * 7 + "Content-Type: text/html\n\n<p>Two</p>\n"
    write_warc_gz(str(tmp_path / "a.warc.gz"), [p1, p2])
    fast = [r.payload for r in W.read_warc(spark, str(tmp_path / "a.warc.gz")).orderBy("rec_no").collect()]
    exact = [r.payload for r in W.read_warc_exact(spark, str(tmp_path)).orderBy("rec_no").collect()]
    assert exact == ["", p1, p2]
    assert [x.replace("\r\n", "\n") for x in fast] == ["", p1, p2]
    # a marker line inside a record body splits it (exact path: only a whole line)
    write_warc_gz(str(tmp_path / "b.warc.gz"), ["x\n WARC/1.0 \ny\n"], crlf=False)
    exact_b = [r.payload for r in W.read_warc_exact(spark, str(tmp_path / "b.warc.gz")).orderBy("rec_no").collect()]
    assert exact_b == ["", "x\n", "y\n"]


def test_ntriples_roundtrip_and_sparql_json(spark, tmp_path):
    nt = [
        '<http://dbpedia.org/resource/A> <http://www.w3.org/2000/01/rdf-schema#label> "A \\"x\\""@en .',
        "<http://dbpedia.org/resource/A> <http://www.w3.org/1999/02/22-rdf-syntax-ns#type> "
        "<http://dbpedia.org/ontology/Person> .",
        "<http://dbpedia.org/resource/B> <http://dbpedia.org/ontology/wikiPageRedirects> "
        "<http://dbpedia.org/resource/A> .",
        "not a triple",
    ]
    (tmp_path / "kb.nt").write_text("\n".join(nt) + "\n")
    kb = K.read_ntriples(spark, str(tmp_path / "kb.nt"))
    assert [tuple(r) for r in kb.label.collect()] == [("http://dbpedia.org/resource/A", 'A "x"', "en")]
    assert [r["class"] for r in kb.type.collect()] == ["dbo:Person"]
    assert sorted(r.value for r in K.to_ntriples(kb).collect()) == sorted(nt[:3])
    doc = {"head": {"vars": ["item", "name", "page", "count"]}, "results": {"bindings": [
        {"item": {"value": "I"}, "name": {"value": "N"}, "page": {"value": "P"}, "count": {"value": "12"}}]}}
    (tmp_path / "q1.json").write_text(json.dumps(doc, indent=1))
    got = K.read_sparql_results(spark, str(tmp_path / "q1.json")).select("item", "name", "page", "cnt").collect()
    assert [tuple(r) for r in got] == [("I", "N", "P", 12)]


def test_ntriples_escapes_blank_nodes_comments(spark):
    label = "<http://www.w3.org/2000/01/rdf-schema#label>"
    lines = [f'<x> {label} "Beyonc\\u00E9\\tA\\\\n\\U0001F600"@en . # note', f"_:b1 {label} _:b2 .", "# only a comment", "", "junk",
             f'<\\u00e9> {label} "q\\"\\n"@fr .']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {(r.s, r.o, r.lang) for r in K.parse_ntriples(df).collect()}
    assert got == {("x", "Beyoncé\tA\\n\U0001F600", "en"), ("_:b1", "_:b2", ""), ("é", 'q"\n', "fr")}
    assert [r.value for r in K.rejected_lines(df).collect()] == ["junk"]


def test_ordered_lines_across_files_and_splits(spark, tmp_path):
    big = [f"ENTITY: r\tk\tv{i}" for i in range(3000)]
    (tmp_path / "a.txt").write_text("\n".join(big) + "\n")
    (tmp_path / "b.txt").write_text("ENTITY: r\tk\tlast\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits of a.txt
    try:
        lines = LN.read_ordered_lines(spark, str(tmp_path))
        got = [r.value for r in lines.orderBy("line_no").collect()]
        r = score(lines, lines, "ENTITY").first()
        pred = [r2.value for r2 in lines.orderBy(F.col("line_no").desc()).limit(1).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == big + ["ENTITY: r\tk\tlast"]
    assert pred == ["ENTITY: r\tk\tlast"] and r.gold == 1
