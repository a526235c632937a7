"""Learnt abbreviations, tags by context and labels by context, against plain Python."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from trawl.operators import abbrev as A
from trawl.operators import annotate as N
from trawl.operators import tagger as G

ABBREVIATED = ["He met Dr. Smith in St. Louis today.", "The U.S. Army came to St. Paul.", "Dr. Who said no.",
               "Then they left. It was late.", "J. K. Rowling wrote it. The end.",
               "We left today, late in the end with no one but Paul and Who and late left end"] * 12


def pages(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "key long, text string")


def py_scores(texts):
    dot, plain = Counter(), Counter()
    for t in texts:
        for c in re.findall(r"[^\t\n\x0b\f\r ]+", t or ""):
            m = re.match(r"^[\W_]*([^\W_]+(?:[-'’.][^\W_]+)*)(\.?)[^\w.]*$", c)
            if m and re.search(r"[^\W\d_]", m[1]):
                (dot if m[2] else plain)[m[1].lower()] += 1
    p0 = (sum(dot.values()) + 0.5) / (sum(dot.values()) + sum(plain.values()) + 1)
    out = {}
    for w, c in dot.items():
        k, size = plain[w], len(w.replace(".", ""))
        ratio = 2 * (c * math.log(0.99 / p0) + k * math.log(0.01 / (1 - p0)))
        out[w] = ratio * (w.count(".") + 1) * math.exp(-size) * size ** -k
    return {w: s for w, s in out.items() if s >= 0.3}


def test_abbreviations_against_loop(spark):
    want = py_scores(ABBREVIATED)
    got = {r.word: r.score for r in A.learn_abbreviations(pages(spark, ABBREVIATED + [None, ""]).repartition(3)).collect()}
    assert set(got) == set(want) >= {"dr", "st", "u.s", "j", "k"} and not {"left", "late", "today", "end"} & set(got)
    assert all(abs(got[w] - want[w]) < 1e-9 for w in want)
    assert A.learn_abbreviations(pages(spark, ABBREVIATED).limit(0)).count() == 0


def test_sentences_keep_abbreviations_together(spark):
    known = A.learn_abbreviations(pages(spark, ABBREVIATED))
    texts = ["He saw St. Louis. The U.S. Army (St. Paul) left.", "No. Yes. st.", None, "", "St\ue000 Louis. St. Paul."]
    got = defaultdict(list)
    for r in N.sentences(pages(spark, texts), "key", "text", known).orderBy("key", "sent").collect():
        got[r.key].append("".join(t + w for t, w in zip(r.tokens, r.ws)).strip())
    assert got[0] == ["He saw St. Louis.", "The U.S. Army (St. Paul) left."]
    assert got[1] == ["No.", "Yes.", "st."]
    assert 2 not in got and 3 not in got and got[4][-1] == "Paul."  # a text that holds the mark is left as it is
    listed = A.guard_dots(pages(spark, texts).withColumnRenamed("text", "_text"), known).collect()
    joined = A.guard_dots(pages(spark, texts).withColumnRenamed("text", "_text"), known, listed=0).collect()
    assert sorted(map(tuple, listed), key=lambda r: r[0]) == sorted(map(tuple, joined), key=lambda r: r[0])
    plain = N.sentences(pages(spark, texts), "key", "text")
    none = N.sentences(pages(spark, texts), "key", "text", known.limit(0))
    assert sorted(map(str, plain.collect())) == sorted(map(str, none.collect()))


def test_best_paths_against_all_paths():
    rng = np.random.default_rng(3)
    for tags in (1, 2, 4):
        steps = rng.integers(0, 6, (tags + 1, tags + 1))
        costs = [rng.integers(0, 6, (int(rng.integers(0, 6)), tags)) for _ in range(60)]
        for c, path in zip(costs, G.best_paths(costs, steps)):
            def total(p):
                way = [tags, *p, tags]
                return sum(steps[a, b] for a, b in zip(way, way[1:])) + sum(c[i, t] for i, t in enumerate(p))
            if len(c):
                want = min(itertools.product(range(tags), repeat=len(c)), key=lambda p: (total(p), p[::-1]))
                assert tuple(path) == want
            else:
                assert len(path) == 0


def tagged_rows(seed, n):
    """A toy language: ``run`` is a verb after a noun and a noun after a determiner."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        toks, pos = ["the", rnd.choice(["run", "dog", "walk", f"x{rnd.randint(0, 400)}"])], "DN"
        toks += [rnd.choice(["run", "walk", "sees"])]
        pos += "V"
        if rnd.random() < 0.6:
            toks += ["the", rnd.choice(["dog", "run", "walk"])]
            pos += "DN"
        rows.append((toks, pos))
    return rows


def test_tags_by_context_beat_the_lexicon_on_held_out_sentences(spark):
    learn, held = tagged_rows(1, 400), tagged_rows(2, 200)
    tagged = spark.createDataFrame(learn + [([], ""), (["odd"], "DD"), (None, None)], "tokens array<string>, pos string")
    model = G.train_tagger(tagged)
    sents = spark.createDataFrame([(0, i, t, "clash") for i, (t, _) in enumerate(held)] + [(1, 0, [], "x"), (1, 1, None, "x")],
                                  "key long, sent long, tokens array<string>, _words string")
    got = {(r.key, r.sent): r.pos for r in G.tag_in_context(sents.drop("_words"), model).collect()}
    assert got[1, 0] == "" and got[1, 1] == ""
    words = tagged.where(F.size("tokens") == F.length("pos")).select(F.explode(F.arrays_zip(
        F.col("tokens").alias("word"), F.split("pos", "", -1).alias("tag"))).alias("t")).select("t.word", "t.tag")
    plain = {(r.key, r.sent): r.pos for r in N.tag_tokens(sents.where("size(tokens) > 0"), N.pos_lexicon(words)).collect()}

    def agreement(tags):
        return np.mean([a == b for i, (_, pos) in enumerate(held) for a, b in zip(tags[0, i], pos)])
    assert agreement(got) > 0.99 > 0.9 > agreement(plain)
    # the joined form of the word table tags alike
    again = {(r.key, r.sent): r.pos for r in G.tag_in_context(sents.drop("_words"), model, word_rows=0).collect()}
    hot = {(r.key, r.sent): r.pos for r in G.tag_in_context(sents.drop("_words"), model, word_rows=0, hot_rows=1).collect()}
    assert again == got == hot


def test_tags_without_a_model_follow_the_shape(spark):
    model = G.train_tagger(spark.createDataFrame([], "tokens array<string>, pos string"))
    s = spark.createDataFrame([(0, 0, ["They", "run", "quickly", "."])], "key long, sent long, tokens array<string>")
    assert G.tag_in_context(s, model).first().pos == "XNRU"
    assert G.tag_in_context(s.limit(0), model).count() == 0


CITIES = ["Paris is a city on the river.", "We went to Lyon by train, a city far away.", "The city of Lyon is old.",
          "A train goes to Lyon city.", "Then Anna said hello to her friend.", "Anna laughed and said no.",
          "Her friend Anna said yes.", "Paris laughed and said hello to her friend.", "A train to Paris city on the river.", "Paris"]


def test_labels_by_context_against_loop(spark):
    gaz = [("Lyon", "GPE"), ("Anna", "PERSON"), ("Paris", "GPE"), ("Paris", "PERSON")]
    hits = N.gazetteer_mentions(N.page_tokens(pages(spark, CITIES)), spark.createDataFrame(gaz, "name string, label string"), by_context=4)
    got = {(r.key, r["at"]): r.label for r in hits.collect()}
    labels = defaultdict(set)
    for n, lb in gaz:
        labels[n].add(lb)
    found = []
    for key, text in enumerate(CITIES):
        toks = re.findall(r"\w+|[^\w\s]", text)
        for i, t in enumerate(toks):
            if t in labels:
                found.append((key, i, t, [w.lower() for w in toks[max(0, i - 4):i] + toks[i + 1:i + 5] if w[0].isalnum()]))
    near, seen = defaultdict(Counter), Counter()
    for _, _, t, ctx in found:
        if len(labels[t]) == 1:
            near[min(labels[t])].update(ctx)
            seen[min(labels[t])] += 1
    v = len({w for c in near.values() for w in c})

    def micro(x):
        return math.floor(math.log(x) * 1_000_000)

    def score(lb, ctx):
        return micro((seen[lb] + 1) / (sum(seen.values()) + 2)) + sum(micro((near[lb][w] + 1) / (sum(near[lb].values()) + v + 1)) for w in ctx)
    want = {(k, i): min(labels[t], key=lambda lb: (-score(lb, ctx) if len(labels[t]) > 1 else 0, lb)) for k, i, t, ctx in found}
    assert got == want
    assert got[0, 0] == "GPE" and got[7, 0] == "PERSON" and got[8, 3] == "GPE"
    # nothing teaches: equal scores, the smallest label
    alone = N.gazetteer_mentions(N.page_tokens(pages(spark, CITIES)), spark.createDataFrame(gaz[2:], "name string, label string"), by_context=4)
    assert {r.label for r in alone.collect()} == {"GPE"} and alone.count() == 4
    empty = N.gazetteer_mentions(N.page_tokens(pages(spark, CITIES).limit(0)), spark.createDataFrame(gaz, "name string, label string"), by_context=4)
    assert empty.count() == 0
