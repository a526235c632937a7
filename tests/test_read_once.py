"""Steps that read their input once, hold little of it, or meet tables stored as folders."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from trawl.functions import text as T
from trawl.functions.html import page_batches
from trawl.operators import abbrev as AB
from trawl.operators import annotate as N
from trawl.operators import names as NM
from trawl.operators import tagger as TG


def counted(spark, rows, schema):
    """A table and a counter of how often its rows are computed."""
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.createDataFrame(rows, schema)
    return df.mapInArrow(note, df.schema), seen


def test_linking_reads_mentions_once(spark):
    """Resolution and the joins of its answers share one pass over the mentions."""
    from trawl.operators import link as L
    from trawl.plans import fixtures as fx

    docs = spark.createDataFrame([(i, "Anna met Robert Lee in Trondheim. Robertson of Trondheim wrote.") for i in range(20)],
                                 "doc_id long, text string")
    kb = fx.derived_kb(docs)
    ments, seen = counted(spark, [(i, m, "PERSON") for i in range(20) for m in ("Robert", "Trondheim")],
                          "key long, mention string, label string")
    ents, _ = L.link_entities(ments, kb, L.label_class_table(spark))
    ents.count()
    assert seen.value == 40


def test_titles_cut_heads_only(spark):
    """The head of a text has the text's first tokens; a text without a key is named by all of it."""
    from trawl.operators.names import spaced_text
    from trawl.plans import fixtures as fx

    texts = [" 1,000.5 men-at-arms, L'Aquila!  (2) end of it", "\n\ta", "a b", "", None, "x" * 300 + " y . z - 4 5 6 7 8 9",
             "don't 3.x 3.4.5. é-è ñ ’a’b", "\u00a0one\u00a0two \u2028 three four five six seven", "1.1.1.1 a-b-c-d e f g h i"]
    docs = spark.createDataFrame([(k, t) for t in texts for k in (0, 1, 2, 3, 4, None)], "doc_id long, text string")
    t = N.page_tokens(docs, "doc_id", "text").where(F.size("tokens") >= 2)
    n = F.least(F.size("tokens"), (F.lit(2) + F.pmod("key", F.lit(5))).cast("int"))
    want = t.select("key", spaced_text(F.col("tokens"), F.col("ws"), F.lit(0), n).alias("name"))
    assert sorted(map(str, fx.titles(docs).collect())) == sorted(map(str, want.collect()))
    heads = docs.select(F.length(N.leading_tokens(F.col("text"), 6)).alias("n")).where("n > 400")
    assert heads.count() == 0


TEXTS = [(i, "Anna met Bob Lee in Oslo. The Oslo pact of Anna Lee holds.") for i in range(20)]
NAMES = [("Anna", "PERSON"), ("Anna Lee", "PERSON"), ("Oslo", "GPE"), ("Oslo", "ORG"), ("Bob Lee", "PERSON")]


def test_label_choice_cuts_pages_once(spark):
    """F1."""
    pages, seen = counted(spark, TEXTS, "key long, text string")
    gaz = spark.createDataFrame(NAMES, "name string, label string")
    got = N.gazetteer_mentions(N.page_tokens(pages, "key", "text"), gaz, by_context=4)
    assert got.count() == 20 * 6
    assert seen.value == 20


def test_name_search_cuts_pages_once(spark):
    """also with a name table too large to travel, and with several shards."""
    gaz = spark.createDataFrame(NAMES, "name string, label string")
    for limits in ({"name_rows": 0}, {"nodes": 2}, {"name_rows": 0, "nodes": 2}):
        pages, seen = counted(spark, TEXTS, "key long, text string")
        got = N.gazetteer_mentions(N.page_tokens(pages, "key", "text"), gaz, **limits)
        assert got.count() == 20 * 8
        assert seen.value == 20


def test_longest_mentions_settles_runs_alone(spark):
    """one row of spans per run of overlapping spans, not per page."""
    rng = np.random.default_rng(3)
    rows = []
    for key in (1, 2, None):
        at = np.sort(rng.choice(400, 150, replace=False))
        rows += [(key, 0, int(a), int(a + n), f"m{a}", "L", int(a)) for a, n in zip(at, rng.integers(1, 6, 150))]
    m = spark.createDataFrame(rows, "key long, sent long, start int, end int, mention string, label string, at int")
    want = []
    for key in (1, 2, None):
        taken = set()
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[2] - r[3], r[2])):
            if taken.isdisjoint(range(r[2], r[3])):
                taken |= set(range(r[2], r[3]))
                want.append(r[:6])
    kept = N.longest_mentions(m)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
    assert "Window" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_sentences_are_read_once_by_the_taggers(spark):
    """F2, F13."""
    rows = [(i, 0, ["the", "dog", "ran", "Quickly"]) for i in range(30)]
    sents, seen = counted(spark, rows, "key long, sent long, tokens array<string>")
    lex = spark.createDataFrame([("the", "D", 1), ("dog", "N", 1)], "word string, tag string, n long")
    assert {r.pos for r in N.tag_tokens(sents, lex).collect()} == {"DNNX"}
    assert seen.value == 30
    tagged = spark.createDataFrame([(["the", "dog", "ran"], "DNV")], "tokens array<string>, pos string")
    model = TG.train_tagger(tagged)
    want = {r.pos for r in TG.tag_in_context(spark.createDataFrame(rows, sents.schema), model).collect()}
    sents, seen = counted(spark, rows, "key long, sent long, tokens array<string>")
    got = TG.tag_in_context(sents, model, word_rows=0).collect()
    assert len(got) == 30 and {r.pos for r in got} == want
    assert seen.value == 30


def test_abbreviations_read_texts_once(spark):
    """F16."""
    docs, seen = counted(spark, [("Dr. Lee met Dr. Ray. They met.",)] * 10, "text string")
    got = AB.learn_abbreviations(docs).collect()
    assert {r.word: (r.n_dot, r.n_plain) for r in got}["dr"] == (20, 0)
    assert seen.value == 10


def test_mention_forms_once_a_row(spark):
    """the title case of a text is computed once."""
    d = spark.createDataFrame([(1, " 'the lord of iPhone'"), (2, "NASA OF MARS"), (3, "(a) van der b."), (4, None)], "k long, line string")
    forms = T.with_mention_forms(d, "line", ["k"])
    plain = d.select("k", *[c.alias(n) for c, n in zip(T.mention_forms("line"), ("m0", "m1", "m2", "m3"))])
    assert sorted(map(str, forms.collect())) == sorted(map(str, plain.collect()))
    assert {r.k: r.m2 for r in forms.collect()} == {1: "The Lord of iPhone", 2: "Nasa of Mars", 3: "(A) Van Der B.", 4: None}
    assert forms._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1


def test_pages_are_handed_on_in_parts():
    """a batch of many pages is not held whole."""
    page = "<html><body><h1>T</h1>" + "<p>some words" * 40 + "</body></html>"
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([page] * 49 + [None])], ["key", "body"])
    schema = pa.schema([("key", pa.int64()), ("title", pa.string()), ("headers", pa.list_(pa.string())), ("paras", pa.list_(pa.string()))])
    whole = pa.Table.from_batches(page_batches(iter([batch]), schema, "nested", 1 << 40))
    parts = list(page_batches(iter([batch]), schema, "nested", 50_000))
    assert len(parts) > 5 and pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()
    assert whole.column("key").to_pylist() == list(range(50))


def test_token_batches_are_walked_in_slices():
    """the walk holds the tokens of a slice."""
    b = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([[1] * 3, None, [2] * 9, [], [3] * 2], pa.list_(pa.int64()))], ["k", "h"])
    got = [p.to_pylist() for p in NM.slices(b, 1, 4)]
    assert [r for p in got for r in p] == b.to_pylist() and len(got) == 3


def test_stream_reads_a_folder_of_pages(spark, tmp_path):
    """the pages table may be a folder of files or one file, and the names are indexed once for all batches."""
    from __spark_entry__ import queries

    docs = spark.createDataFrame([(i, "Anna Leeds saw Berlin and Mercy Town. Berlin saw Anna.", "en", "s", 10) for i in range(3)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    pages = spark.createDataFrame([(i, "u", "<html><body><p>Anna Leeds saw Berlin today</p></body></html>") for i in range(12)],
                                  "page_id long, url string, html string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    pages.repartition(3, "page_id").write.parquet(f"{tmp_path}/pages.parquet")
    lines = {name: sorted(r.value for r in queries()[name](spark, str(tmp_path)).collect())
             for name in ("stream_entity_lines", "stream_link_store")}
    want = sorted(f"ENTITY: {r.key}\t{r.mention}\t{r.link}" for r in queries()["page_entities_nested"](spark, str(tmp_path)).collect())
    assert want and lines["stream_entity_lines"] == want and lines["stream_link_store"] == want
    one = tmp_path / "one"
    one.mkdir()
    docs.coalesce(1).write.parquet(f"{one}/documents.parquet")
    pq.write_table(pages.toArrow(), f"{one}/pages.parquet")
    assert sorted(r.value for r in queries()["stream_entity_lines"](spark, str(one)).collect()) == want
