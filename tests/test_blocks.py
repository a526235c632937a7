"""Blocks of sentences: words looked up once a block, sentences moved as numbers."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.operators import annotate as N
from trawl.operators import blocks as B
from trawl.operators import names as NM
from trawl.operators import tagger as G
from trawl.operators.senses import choose_labels

WORDS = ["The", "the", "run", "Élan", "ünder", "3.5", ".", "“", "quickly", "𝒳", "walked", ""]


def sentences(spark, n=300, seed=5):
    rnd = random.Random(seed)
    rows = [(k // 5, k % 5, [rnd.choice(WORDS) for _ in range(rnd.randint(0, 9))]) for k in range(n)]
    rows += [(n, 0, None), (n + 1, 0, ["run", None, "The"])]
    return rows, spark.createDataFrame(rows, "key long, sent long, tokens array<string>").repartition(3)


def test_numbers_come_back():
    for x in ([], [0], [1, 300, 70_000, (1 << 32) - 1]):
        assert B.restored(B.squeezed(np.array(x, np.int64))).tolist() == x


def test_blocks_hold_every_sentence(spark):
    """several blocks in a task, each with its own words, give the tokens back."""
    rows, sents = sentences(spark)

    def decode(found):
        words = dict(zip(found.column("i").to_pylist(), found.column("word").to_pylist()))
        return lambda codes, lens, _: B.joined(pa.array([f"<{words[c]}>" for c in codes.tolist()], pa.string()), lens)

    got, runs = B.with_answers(sents, ["key", "sent"], lambda a: a.withColumnRenamed("tok", "word"), T.StructField("x", T.StringType()),
                               decode, tokens=7, run=("key", "sent"))
    assert {(r.key, r.sent): r.x for r in got.collect()} == {(k, s): "".join(f"<{t}>" for t in toks or []) for k, s, toks in rows}
    assert B.pack(sents, ["key"], 7).where("words IS NOT NULL").count() > 30
    assert {r.key for r in runs.collect()} == {r[0] for r in rows}
    assert B.with_answers(sents.limit(0), ["key"], lambda a: a, T.StructField("x", T.StringType()), decode)[0].count() == 0


def test_lexicon_tags_move_no_tokens(spark):
    """neither tokens nor sentences are dealt out by word or by key."""
    rows, sents = sentences(spark)
    sents = sents.coalesce(1).sortWithinPartitions("key", "sent")
    lex = spark.createDataFrame([("the", "D", 1), ("run", "V", 1), ("élan", "N", 1), ("", "E", 1)], "word string, tag string, n long")
    plan = N.tag_tokens(sents, lex)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" not in plan and "tokens" not in plan.split("Exchange hashpartitioning(block")[1]
    rule = dict(zip(WORDS, "XNNXNMUURXVN")) | {None: "N"}
    known = {"the": "D", "run": "V", "élan": "N", "": "E"}
    want = sorted((k, s, "".join(known.get(t and t.lower(), rule[t]) for t in toks or [])) for k, s, toks in rows)
    assert sorted(map(tuple, N.tag_tokens(sents, lex, keep=["key", "sent"]).collect())) == want
    whole = N.tag_tokens(sents.withColumn("more", F.struct("sent", F.lit("x"))), lex)
    assert whole.columns == ["key", "sent", "tokens", "more", "pos"]
    assert sorted((r.key, r.sent, r.tokens, r.pos) for r in whole.collect()) == sorted((k, s, t, p) for (k, s, t), (_, _, p) in zip(sorted(rows, key=lambda r: r[:2]), want))


def test_sentences_of_one_name_share_their_letters(spark):
    """A key that comes back: each of its sentences has the letters of all, by position; none without a key."""
    lex = spark.createDataFrame([("a", "A", 1), ("b", "B", 1)], "word string, tag string, n long")
    s = spark.createDataFrame([(1, 0, ["a", "b"], "x"), (1, 0, ["b"], "y"), (1, 1, ["b"], "x"), (None, 0, ["a"], "x"), (2, None, ["a"], "x"),
                               (2, 0, [], "x"), (None, 0, ["b"], "z")], "key long, sent long, tokens array<string>, more string")
    want = sorted([(1, 0, "x", "ABB"), (1, 0, "y", "ABB"), (1, 1, "x", "B"), (None, 0, "x", ""), (None, 0, "z", ""), (2, None, "x", ""), (2, 0, "x", "")], key=str)
    for parts in (1, 4):
        got = N.tag_tokens(s.repartition(parts), lex).select("key", "sent", "more", "pos")
        assert sorted(map(tuple, got.collect()), key=str) == want
    alone = s.where("more = 'x' AND sent = 0")
    assert sorted(map(tuple, N.tag_tokens(alone, lex, keep=["key", "sent"]).collect()), key=str) == sorted([(1, 0, "AB"), (None, 0, ""), (2, 0, "")], key=str)


def test_counted_tokens_against_a_loop(spark):
    """tokens and pairs of letters counted per block, in one pass."""
    rnd = random.Random(8)
    rows = [([rnd.choice(WORDS) for _ in range(n)], "".join(rnd.choice("VNé𝒳^") for _ in range(n))) for n in (rnd.randint(0, 8) for _ in range(400))]
    rows += [(["a", None], "VN"), (["a"], "VN"), (None, "V"), (["a"], None)]
    tagged = spark.createDataFrame(rows, "tokens array<string>, pos string").repartition(3)
    good = [(t, p) for t, p in rows if t and p and len(t) == len(p)]
    words = Counter(x for t, p in good for x in zip(t, p))
    pairs = Counter(x for _, p in good for x in zip("^" + p, p + "^"))
    for size in (1, 50, B.TOKENS):
        got: dict = defaultdict(Counter)
        for r in B.counted_tokens(tagged, "^", size).collect():
            got[r.before is None][(r.t, r.tag) if r.before is None else (r.before, r.tag)] += r.n
        assert got[True] == words and got[False] == pairs
    lex = N.pos_lexicon(B.counted_tokens(tagged), "t", n_col="n")
    flat = spark.createDataFrame([x for t, p in good for x in zip(t, p)], "word string, tag string")
    assert sorted(map(str, lex.collect())) == sorted(map(str, N.pos_lexicon(flat).collect()))


def test_paths_with_forbidden_tags():
    """costs taken by number, forbidden tags and long sentences give the paths of the plain recurrence."""
    rng = np.random.default_rng(4)
    for tags in (1, 3, 17):
        steps, costs = rng.integers(0, 9, (tags + 1, tags + 1)), rng.integers(0, 9, (40, tags))
        costs[rng.random((40, tags)) < 0.5] = G.NEVER
        costs[costs.min(1) == G.NEVER, 0] = 3
        lens = np.array([0, 1, 5, 3000, 2, 0, 7] + [4] * 1500)
        codes = rng.integers(0, 40, lens.sum())
        got, lo = G.best_coded(costs, codes, lens, steps), 0
        for n in lens.tolist():
            best, back = steps[-1, :-1] + costs[codes[lo]] if n else None, []
            for p in range(1, n):
                through = best[:, None] + steps[:-1, :-1]
                back.append(through.argmin(0))
                best = through.min(0) + costs[codes[lo + p]]
            way = [int((best + steps[:-1, -1]).argmin())] if n else []
            for step in reversed(back):
                way.append(int(step[way[-1]]))
            assert got[lo:lo + n].tolist() == way[::-1]
            lo += n


def test_context_tags_move_no_tokens(spark):
    """with a word table too large to travel only numbers of tokens are shuffled."""
    rows, sents = sentences(spark)
    tagged = spark.createDataFrame([(["the", "run", "walked"], "DNV"), (["run", "the", "Élan"], "VDN"), (["run"], "V")] * 3, "tokens array<string>, pos string")
    model = G.train_tagger(tagged)
    want = sorted(map(str, G.tag_in_context(sents.where("key <= 300"), model, keep=["key", "sent"]).collect()))
    joined = G.tag_in_context(sents.where("key <= 300"), model, word_rows=0, keep=["key", "sent"])
    assert sorted(map(str, joined.collect())) == want
    assert "tokens" not in joined._jdf.queryExecution().executedPlan().toString()


def test_sentence_starts_against_the_classes(spark):
    """positions of the tokens that are no words give the starts of the class string."""
    rnd = random.Random(2)
    vocab = [".", "!", "?", ",", "”", "—", "٣", "é", "a", "Z", "0", "[", "{", ":", "@", "", "Ω", "\u0080x", "-b"]
    rows = [([rnd.choice(vocab) for _ in range(rnd.randint(1, 30))],) for _ in range(400)] + [([".", ".", "a"],), (["a", None, ".", None, "b"],)]
    df = spark.createDataFrame(rows, "tokens array<string>").withColumn("others", N.other_tokens(F.col("tokens")))
    got = df.select("tokens", N.token_classes(F.col("tokens")).alias("cls"), N.sentence_starts(F.col("tokens"), F.col("others")).alias("starts"))
    for r in got.collect():
        starts, final = [0], False
        for i, c in enumerate(r.cls):
            if c == "W" and final:
                starts.append(i)
            final = c == "S" or (final and c == "P")
        assert r.starts == starts, r


def test_names_are_cut_by_the_text(spark):
    """the text beside the tokens tells what stands between them as ``ws`` does, and no page comes back from the walk."""
    texts = ["New  York Times\tof\nNew York, U.S.A.!", " St. Louis\x0b(St.Louis) é-é", "", None, "New\u00a0York New York", "York New"]
    pages = spark.createDataFrame(list(enumerate(texts)) + [(None, "New York")], "key long, text string")
    names = ["New York", "New York Times", "York, U", "St. Louis", "é-é", "U.S.A", "York", "St"]
    gaz = spark.createDataFrame([(n, lb) for n in names for lb in ("A", "B")[:1 + len(n) % 2]], "name string, label string")
    for context in (0, 3):
        for limits in ({}, {"nodes": 2, "name_rows": 0}):
            by_ws = N.gazetteer_mentions(N.page_tokens(pages), gaz, by_context=context, **limits)
            by_text = N.gazetteer_mentions(N.page_tokens(pages, ws=False, text=True), gaz, by_context=context, **limits)
            got = sorted(map(str, by_text.collect()))
            assert got == sorted(map(str, by_ws.collect())) and len(got) > 10
    mentions = {r.mention for r in N.gazetteer_mentions(N.page_tokens(pages, ws=False, text=True), gaz).collect()}
    assert {"New York", "New York Times", "York, U", "St. Louis", "St.Louis", "é-é", "New\u00a0York"} - mentions == {"New\u00a0York"}
    hits = NM.find_names(N.page_tokens(pages, ws=False, text=True), gaz, ["key"], context=3)
    assert hits._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0].count("tokens") == 0


def test_labels_of_mentions_that_come_back(spark):
    """rows of one key, at and n are one mention whose words all count; without a key words say nothing."""
    rows = [(1, 0, 1, "m", "A", 1, ["x", "y"]), (2, 0, 1, "m", "B", 1, ["z", "z"]), (2, 5, 1, "m", "B", 1, None)]
    for key, at, words in ((3, 0, ["x", "q"]), (3, 0, ["z", "z", "z"]), (4, 0, ["x"]), (None, 0, ["x", "x", "x"]), (5, 1, []), (5, 2, None)):
        rows += [(key, at, 1, "m", lb, 2, words) for lb in "AB"]
    hits = spark.createDataFrame(rows, "key long, at int, n int, mention string, label string, n_labels long, context array<string>").repartition(3)
    got = choose_labels(hits)
    assert got.columns == ["key", "at", "n", "mention", "label"]
    assert sorted((str(r.key), r["at"], r.label) for r in got.collect()) == sorted(
        [("1", 0, "A"), ("2", 0, "B"), ("2", 5, "B"), ("3", 0, "B"), ("4", 0, "A"), ("None", 0, "B"), ("5", 1, "B"), ("5", 2, "B")])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(context" not in plan and choose_labels(hits.limit(0)).count() == 0
