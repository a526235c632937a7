"""N1-N4 and R1-R6 hand cases, plus the R2 regex against brute force."""

import itertools
import random
import re

from pyspark.sql import functions as F

from trawl.operators import annotate as N
from trawl.operators.relations import linked_relations, pattern_regex, phrase_spans, sentence_relations

ENT = "array<struct<start:int,end:int,text:string,label:string>>"


def sents(spark, rows):
    """rows: (key, tokens, pos, ents[(start, end, text)])"""
    data = [(k, 0, toks, pos, [(s, e, t, "PERSON") for s, e, t in ents]) for k, toks, pos, ents in rows]
    return spark.createDataFrame(data, f"key string, sent bigint, tokens array<string>, pos string, ents {ENT}")


def triples(df):
    return sorted((r.e1, r.rel, r.e2) for r in df.collect())


def test_basic_and_nearest(spark):
    # Ann met with Bob and Carl
    s = sents(spark, [("k", ["Ann", "met", "with", "Bob", "and", "Carl"], "XVPXCX",
                       [(0, 1, "Ann"), (3, 4, "Bob"), (5, 6, "Carl")])])
    assert triples(sentence_relations(s)) == [("Ann", "met with", "Bob")]


def test_entity_inside_phrase_counts_right(spark):
    # a NOUN entity inside the phrase span starts at/after the phrase start: right end
    s = sents(spark, [("k", ["Ann", "sells", "apples", "to", "Bob"], "XVNPX",
                       [(0, 1, "Ann"), (2, 3, "apples"), (4, 5, "Bob")])])
    assert triples(sentence_relations(s)) == [("Ann", "sells apples to", "apples")]


def test_one_sided_and_fewer_than_two(spark):
    s = sents(spark, [("k1", ["runs", "Ann", "Bob"], "VXX", [(1, 2, "Ann"), (2, 3, "Bob")]),
                      ("k2", ["Ann", "runs"], "XV", [(0, 1, "Ann")])])
    assert triples(sentence_relations(s)) == []


def test_two_verbs_and_same_entity_both_ends(spark):
    s = sents(spark, [("k", ["Ann", "is", "said", "Ann"], "XVVX", [(0, 1, "Ann"), (3, 4, "Ann")])])
    assert triples(sentence_relations(s)) == [("Ann", "is", "Ann"), ("Ann", "said", "Ann")]


def test_pattern_at_sentence_end_and_f9(spark):
    s = sents(spark, [("k", ["Ann", "and", "Bob", "went", "home", "quickly"], "XCXVNR",
                       [(0, 1, "Ann"), (2, 3, "Bob")]),
                      ("k2", ["big", "Ann", "saw", "Bob"], "JXVX", [(0, 1, "big"), (3, 4, "Bob")])])
    # k: no entity right of the phrase; k2: "big" is ADJ only -> dropped by F9, one entity left
    assert triples(sentence_relations(s)) == []


def test_spacing_kept_with_ws(spark):
    df = spark.createDataFrame([("k", 0, ["Ann", "Met", "-", "With", "Bob"], [" ", "", "", " ", ""], "XVURX",
                                 [(0, 1, "Ann", "P"), (4, 5, "Bob", "P")])],
                               f"key string, sent bigint, tokens array<string>, ws array<string>, pos string, ents {ENT}")
    assert triples(sentence_relations(df)) == [("Ann", "met", "Bob")]


def test_linked_relations_both_ends(spark):
    s = sents(spark, [("k", ["Ann", "met", "Bob"], "XVX", [(0, 1, "Ann"), (2, 3, "Bob")]),
                      ("j", ["Ann", "met", "Bob"], "XVX", [(0, 1, "Ann"), (2, 3, "Bob")])])
    ents = spark.createDataFrame([("k", "Ann", "L1"), ("k", "Bob", "L2"), ("j", "Ann", "L1")],
                                 "key string, mention string, link string")
    got = [(r.key, r.link1, r.link2, r.rel) for r in linked_relations(sentence_relations(s), ents).collect()]
    assert got == [("k", "L1", "L2", "met")]


def brute_force(tags, rx="VT?R?[JRNOD]*[TP]?"):
    """All matches of the token pattern, then longest-first non-overlapping filter."""
    def ok(seq):
        return re.fullmatch(rx, seq) is not None
    spans = [(i, j) for i in range(len(tags)) for j in range(i + 1, len(tags) + 1) if ok(tags[i:j])]
    spans.sort(key=lambda s: (-(s[1] - s[0]), s[0]))
    kept = []
    for s in spans:
        if all(s[1] <= k[0] or k[1] <= s[0] for k in kept):
            kept.append(s)
    return sorted((i, j - i) for i, j in kept)


def test_phrase_regex_against_brute_force(spark):
    rnd = random.Random(7)
    tags = ["".join(rnd.choice("VTRJNODPXM") for _ in range(rnd.randint(1, 14))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in tags], "pos string")
    got = df.select("pos", phrase_spans(F.col("pos")).alias("p")).collect()
    for r in got:
        assert sorted((x.start, x.len) for x in r.p) == brute_force(r.pos), r.pos
    assert pattern_regex() == "^VT?R?[JRNOD]*[TP]?"


def test_custom_patterns_against_brute_force(spark):
    rnd = random.Random(11)
    tags = ["NNN", "", "VVV", *("".join(rnd.choice("VAPNX") for _ in range(rnd.randint(1, 12))) for _ in range(150))]
    df = spark.createDataFrame([(t,) for t in tags], "pos string")
    patterns = [[{"POS": {"IN": ["VERB", "AUX"]}}, {"POS": "ADP", "OP": "?"}], [{"POS": "NOUN"}, {"POS": "NOUN", "OP": "*"}],
                [{"POS": "NOUN", "OP": "?"}, {"POS": "VERB"}, {"POS": "VERB"}], [{"POS": "VERB"}, {"POS": "NOUN", "OP": "+"}, {"POS": "ADP"}]]
    for p in patterns:
        rx = pattern_regex(p)
        for r in df.select("pos", phrase_spans(F.col("pos"), rx).alias("p")).collect():
            assert sorted((x.start, x.len) for x in r.p) == brute_force(r.pos, rx.removeprefix("^")), (rx, r.pos)


def test_random_patterns_against_brute_force():
    """Sets first, optional first, repeats anywhere, patterns that could match nothing."""
    from trawl.operators.patterns import TagPattern

    rnd = random.Random(3)
    for _ in range(400):
        rx = "".join(rnd.choice(["V", "N", "[VN]", "[NP]", "[AVP]", "P"]) + rnd.choice(["", "", "?", "*", "+"]) for _ in range(rnd.randint(1, 5)))
        tags = "".join(rnd.choice("VANP") for _ in range(rnd.randint(0, 13)))
        assert TagPattern("^" + rx).spans(tags) == brute_force(tags, rx), (rx, tags)


def test_patterns_on_long_sentences():
    """Sentences of 10,000 and 20,000 tags: the work grows about as the length, also where matches number its square."""
    import time

    from trawl.operators.patterns import TagPattern

    for rx, tags in (("N+", "N"), ("NN", "N"), ("[NV]*V", "NV"), ("N?V+N*", "NVVN"), ("N+V?N", "NNA")):
        took = []
        for n in (10_000, 20_000):
            t = time.process_time()
            spans = TagPattern(rx).spans((tags * n)[:n])
            took.append(time.process_time() - t)
            assert spans and all(a + k <= b for (a, k), (b, _) in zip(spans, spans[1:]))
        assert took[1] < 2, (rx, took)


def test_sentences_split_rule(spark):
    df = spark.createDataFrame([("k", 'Hello world. "Quoted!" Then 3.5 more? Yes')], "key string, text string")
    got = [r.tokens for r in N.sentences(df, "key", "text").orderBy("sent").collect()]
    # sentencizer rule: punctuation after a sentence end stays with that sentence
    assert got == [["Hello", "world", ".", '"'], ["Quoted", "!", '"'], ["Then", "3.5", "more", "?"], ["Yes"]]


def test_longest_spans_and_gazetteer(spark):
    df = spark.createDataFrame([("k", "New York City is in New York.")], "key string, text string")
    s = N.sentences(df, "key", "text")
    gaz = spark.createDataFrame([("New York", "GPE"), ("New York City", "GPE"), ("York", "PERSON")],
                                "name string, label string")
    hits = N.gazetteer_mentions(s, gaz)
    ents = N.sentence_entities(s, hits).first().ents
    assert [(e.start, e.end, e.text) for e in ents] == [(0, 3, "New York City"), (5, 7, "New York")]


def test_gazetteer_finds_names_as_written(spark):
    text = 'She left the University of New South Wales for Google, Inc. and eBay; AT&T and Yahoo! too.'
    s = N.sentences(spark.createDataFrame([("k", text)], "key string, text string"), "key", "text")
    names = ["University of New South Wales", "New South Wales", "Wales", "Google, Inc", "eBay", "AT&T", "Yahoo!"]
    gaz = spark.createDataFrame([(n, "ORG") for n in names], "name string, label string")
    hits = N.gazetteer_mentions(s, gaz)
    assert sorted(r.mention for r in hits.collect()) == sorted(names)
    kept = [r.mention for r in N.longest_mentions(hits).orderBy("sent", "start").collect()]
    assert kept == ["University of New South Wales", "Google, Inc", "eBay", "AT&T", "Yahoo!"]


def test_pos_lexicon_and_tagging(spark):
    tagged = spark.createDataFrame([("run", "V"), ("Run", "V"), ("run", "N")], "word string, tag string")
    lex = N.pos_lexicon(tagged)
    assert {(r.word, r.tag, r.n) for r in lex.collect()} == {("run", "V", 2)}
    s = N.sentences(spark.createDataFrame([("k", "They run quickly to Paris.")], "key string, text string"),
                    "key", "text")
    # unknown words: capitalised -> X (PROPN), -ly -> R, otherwise N; punctuation -> U
    assert N.tag_tokens(s, lex).first().pos == "XVRNXU"


def test_annotator_plug_feeds_relations(spark):
    def toy_annotator(texts):
        """A user model stand-in: whitespace tokens, capitalised words are PROPN entities."""
        out = []
        for t in texts:
            toks = t.split()
            pos = "".join("X" if w[:1].isupper() else ("V" if w.endswith("s") else "N") for w in toks)
            ents = [{"start": i, "end": i + 1, "text": w, "label": "PERSON"}
                    for i, w in enumerate(toks) if w[:1].isupper()]
            out.append([{"tokens": toks, "ws": [" "] * len(toks), "pos": pos, "ents": ents}])
        return out

    df = spark.createDataFrame([("k", "Ann likes Bob")], "key string, text string")
    ann = N.annotate_with(df, toy_annotator)
    assert ann.first().pos == "XVX"
    assert triples(sentence_relations(ann)) == [("Ann", "likes", "Bob")]


def test_tag_tokens_paths_agree(spark):
    tagged = spark.createDataFrame([("the", "D"), ("run", "V"), ("quickly", "R"), ("paris", "X")],
                                   "word string, tag string")
    lex = N.pos_lexicon(tagged)
    text = "The dog and the cat run quickly. The end of the road to Paris."
    s = N.sentences(spark.createDataFrame([("k", text), ("j", "the the the")], "key string, text string"),
                    "key", "text")
    def pos(df):
        return sorted((r.key, r.sent, r.pos) for r in df.collect())
    want = pos(N.tag_tokens(s, lex))
    for hot in (1, 3, 10**9):  # all words hot / some / none
        assert pos(N.tag_tokens(s, lex, hot_rows=hot)) == want


def py_sentencizer(tokens):
    """The sentencizer rule as a loop: a sentence starts at the first word after . ! ? (+ punctuation)."""
    out, cur, seen_end = [], [], False
    for t in tokens:
        is_end = t in (".", "!", "?")
        is_punct = not (t[:1].isalnum())
        if seen_end and not is_punct and not is_end:
            out.append(cur)
            cur, seen_end = [], False
        cur.append(t)
        if is_end:
            seen_end = True
    if cur:
        out.append(cur)
    return out


def test_sentence_split_against_loop(spark):
    rnd = random.Random(11)
    vocab = ["a", "Bob", "3.5", "x-y", ".", "!", "?", ",", '"', ")", "(", "é"]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 25))) for _ in range(300)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "key string, text string")
    got = {}
    for r in N.sentences(df, "key", "text").collect():
        got.setdefault(r.key, []).append((r.sent, list(r.tokens)))
    for i, t in enumerate(texts):
        toks = re.findall(r"\d+(?:[.,]\d+)*|\w+(?:[-'’]\w+)*|[^\s\w]", t)
        assert [s for _, s in sorted(got[str(i)])] == py_sentencizer(toks), t


def test_gazetteer_hot_split_agrees(spark):
    df = spark.createDataFrame([("k", "The Paris and The Rome. The New York is big."), ("j", "The end. Paris.")],
                               "key string, text string")
    s = N.sentences(df, "key", "text")
    gaz = spark.createDataFrame([("Paris", "GPE"), ("New York", "GPE"), ("The", "WORK_OF_ART")],
                                "name string, label string")
    def hits(h):
        return sorted(tuple(r) for r in N.gazetteer_mentions(s, gaz, hot_rows=h).collect())
    want = hits(10**9)
    assert want and hits(1) == want and hits(2) == want


def test_longest_spans_sql_form_against_array_form(spark):
    """The list form of N4 (query twin) equals the bitmap form on random overlaps, also far apart and long ones."""
    import duckdb
    import pandas as pd

    from trawl.plans.catalog import longest_sql

    rnd = random.Random(5)
    rows = []
    for sent in range(200):
        far = rnd.choice([10, 40, 200])
        for _ in range(rnd.randint(0, 25)):
            st = rnd.randint(0, far)
            ln = rnd.choice([1, 2, 3, 6, 33, 70])
            rows.append(("k", sent, st, st + ln, f"t{st}_{ln}", rnd.choice(["GPE", "PERSON", "ORG"])))
    hits = pd.DataFrame([(k, n, s, e, lb) for k, n, s, e, _, lb in rows], columns=["key", "sent", "beg", "stop", "label"])
    con = duckdb.connect()
    con.register("hits", hits)
    want = sorted(con.execute("WITH " + longest_sql("hits", "key, sent") + " SELECT key, sent, beg, stop, label FROM longest").fetchall())
    sdf = spark.createDataFrame(rows, "key string, sent bigint, start int, end int, mention string, label string")
    sents = sdf.select("key", "sent").distinct()
    got = N.sentence_entities(sents, sdf).select("key", "sent", F.explode("ents").alias("e")).select(
        "key", "sent", "e.start", "e.end", "e.label")
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 400
    absolute = sdf.select("key", "sent", "start", "end", "mention", "label", F.col("start").alias("at")).where("sent = 7")
    by_page = N.longest_mentions(absolute).select("key", "sent", "start", "end", "label")
    assert sorted(tuple(r) for r in by_page.collect()) == [w for w in want if w[1] == 7]


def test_longest_spans_of_a_page_of_ten_thousand(spark):
    """Overlapping spans over one long page: the kept ones never meet, and every other meets one as good or better."""
    rnd = random.Random(9)
    spans = [(s, s + rnd.randint(1, 9), "X") for s in (rnd.randint(0, 30000) for _ in range(10000))]
    df = spark.createDataFrame([(spans,)], "spans array<struct<start:int,end:int,label:string>>")
    kept = [(s.start, s.end) for s in df.select(N.longest_spans(F.col("spans")).alias("k")).first().k]
    assert kept == sorted(kept) and all(a[1] <= b[0] for a, b in zip(kept, kept[1:]))
    at = {p: k for k in kept for p in range(*k)}
    for s, e, _ in spans:
        met = {at[p] for p in range(s, e) if p in at}
        assert any((k[1] - k[0], -k[0]) >= (e - s, -s) for k in met)


NAMES = ["St. Louis", "J. K. Rowling", "U.S. Army", "New York", "York City", "New York City", "Berlin", "Rome", "Louis",
         "São Paulo", "Éire", "a b c d e f g h", "Yahoo!"]
TEXT = ("She saw St. Louis and J. K. Rowling.\nThe U.S. Army; New\n York \t City, in Berlin\nand Rome.\tAlso São Paulo\n\n"
        "Éire Yahoo! a b c d e f g h")


def test_names_across_sentence_ends_and_line_ends(spark):
    pages = N.page_tokens(spark.createDataFrame([("k", TEXT), ("j", ""), ("i", None), ("h", "St.")], "key string, text string"))
    gaz = spark.createDataFrame([(n, "ORG") for n in NAMES] + [("Rome", "GPE")], "name string, label string")
    hits = N.gazetteer_mentions(pages, gaz)
    toks = re.findall(r"\w+|[^\w\s]", TEXT)
    want = sorted((i, " ".join(toks[i:i + n])) for i in range(len(toks)) for n in range(1, 9)
                  for name in NAMES if toks[i:i + n] == re.findall(r"\w+|[^\w\s]", name))
    got = [(r["at"], " ".join(re.findall(r"\w+|[^\w\s]", r.mention))) for r in hits.where("label = 'ORG'").collect()]
    assert sorted(got) == want
    assert not [r.mention for r in hits.collect() if r.mention != " ".join(r.mention.split())]
    kept = [(r.sent, r.mention) for r in N.longest_mentions(hits).orderBy("sent", "start").collect()]
    assert [m for _, m in kept] == ["St. Louis", "J. K. Rowling", "U.S. Army", "New York City", "Berlin", "Rome", "São Paulo",
                                    "Éire", "Yahoo!", "a b c d e f g h"]
    # a few nodes to a shard, and a name table too large to broadcast, give the same rows
    for limits in ({"nodes": 4}, {"name_rows": 0}, {"name_rows": 0, "hot_rows": 1}):
        assert sorted(N.gazetteer_mentions(pages, gaz, **limits).collect()) == sorted(hits.collect())
    assert N.gazetteer_mentions(pages, gaz.limit(0)).count() == 0
    assert N.gazetteer_mentions(pages.limit(0), gaz).count() == 0


def test_no_line_is_broken_by_a_mention(spark):
    from trawl.sources.lines import entity_lines

    pages = N.page_tokens(spark.createDataFrame([("k", TEXT)], "key string, text string"))
    gaz = spark.createDataFrame([(n, "ORG") for n in NAMES], "name string, label string")
    ments = N.longest_mentions(N.gazetteer_mentions(pages, gaz)).withColumn("link", F.lit("http://x"))
    lines = [r.value for r in entity_lines(ments).collect()]
    assert len(lines) == 10 and all(len(v.split("\t")) == 3 and "\n" not in v for v in lines)


def test_names_shuffle_no_tokens(spark):
    """The plan of the name search exchanges neither tokens nor texts of pages."""
    pages = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    gaz = spark.createDataFrame([("The", "ORG")], "name string, label string")
    plan = N.gazetteer_mentions(N.page_tokens(pages, "doc_id", "text"), gaz)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
