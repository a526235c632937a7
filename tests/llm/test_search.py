"""Ranked search, whitening and toxicity against plain Python on small tables, odd rows and empty tables."""

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from trawl.llm import search, toxicity, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def ranked(docs, items, k=10):
    held = [(d, terms(t)) for d, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = Counter(w for _, t in held for w in set(t))
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    out = []
    for i, q in queries.items():
        scored = []
        for d, t in held:
            tf, m = Counter(t), 10 + 90 * len(t) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * tf[w] // (1000 * tf[w] + 8 * m))
                    for w in q if tf[w])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(i, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


ITEMS = [(1, "The of river stone"), (2, "lamp0 GREEN1, door2-door2"), (3, None), (4, ""), (5, "nowhere"), (5, "über ñandú"),
         (None, "x of the"), (1, "x"), (2, "lamp0 GREEN1, door2-door2")]


@pytest.mark.parametrize("shard_docs", [3, 8192])
def test_search_against_brute_force(odd_docs, lspark, shard_docs):
    items = lspark.createDataFrame([(i, t, 0, 1) for i, t in ITEMS], "item_id long, text string, score int, rank int")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = Counter(map(tuple, search.rank_documents(odd_docs, items, shard_docs=shard_docs).collect()))
    assert got == ranked(docs, ITEMS)
    assert Counter(map(tuple, search.rank_documents(odd_docs, items, block=3).collect())) == got


def test_search_skips_without_loss(lspark):
    """Frequent and rare words, ties and repeated texts over several ranges of one shard."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(200)]
    share = 1 / np.arange(1, 201)
    docs = [(int(i), " ".join(rng.choice(words, int(rng.integers(1, 60)), p=share / share.sum()))) for i in rng.permutation(1500)]
    docs += [(9000 - i, docs[i][1]) for i in range(200)]
    items = [(j, " ".join(rng.choice(words, 12))) for j in range(25)]
    got = search.rank_documents(lspark.createDataFrame(docs, "doc_id long, text string").repartition(2),
                                lspark.createDataFrame(items, "item_id long, text string"))
    assert Counter(map(tuple, got.collect())) == ranked(docs, items)


def test_search_reads_only_part_of_the_ranges():
    """Ranges under the bound are not scored: only the list holding the rare term is opened."""
    row = {"ids": list(range(1024)), "sizes": [10] * 1024, "terms": [0, 1], "lens": [1024, 1],
           "ords": np.r_[np.arange(1024), 5].astype(np.uint32).tobytes(), "tfs": np.ones(1025, np.int64).tobytes()}
    shard = search.Shard(row, np.array([1, 900]), 1024, 10240)
    opened: list[int] = []
    lists = shard.lists([0, 1])
    assert len(lists) == 2 and len(lists[0][0]) == 1  # accumulators first

    class Seen(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                opened.append(key.start)
            return super().__getitem__(key)

    shard.lists = lambda terms: [(o.view(Seen), *rest) for o, *rest in lists]
    best = shard.search([0, 1], [(-10 ** 9, False, d) for d in range(2000, 2009)] + [(-10 ** 7, False, 2010)], 10)
    assert best[-1][2] == 5 and set(opened) <= {0, 1, 128 * 0}


def test_search_empty_tables(odd_docs, lspark):
    items = lspark.createDataFrame(ITEMS, "item_id long, text string")
    none = lspark.createDataFrame([], "doc_id long, text string")
    for d, i in ((odd_docs.limit(0), items), (odd_docs, items.limit(0)), (none, items.limit(0)), (odd_docs, items.where("item_id = 4"))):
        out = search.rank_documents(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def vectors(lspark, rows):
    return lspark.createDataFrame([(i, v, 7, 0.5) for i, v in rows], "vec_id long, embedding array<float>, n int, whitened double")


def test_whitening_against_exact_sums(lspark):
    rng = np.random.default_rng(2)
    mix = rng.normal(size=(12, 12))
    rows = [(i, (rng.normal(size=12) @ mix / 4 + 3).astype(np.float32).tolist()) for i in range(300)]
    odd = [(1000, None), (1001, [1.0] * 11 + [None]), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1004, [])]
    rows += [(None, rows[0][1]), (5, rows[5][1]), (5, rows[5][1])]
    got = whitening.whiten(vectors(lspark, rows + odd)).toPandas()
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    assert len(got) == 8 * n and set(got.n) == {n}
    cov = [[float(sum((Fraction(n * r[i] - s[i], n)) * Fraction(n * r[j] - s[j], n) for r in x) / n) for j in range(12)] for i in range(12)]
    fitted = whitening.fit(whitening.finite_vectors(vectors(lspark, rows + odd)))[12]
    assert np.array_equal(fitted.covariance, np.array(cov))
    values = np.sort(np.linalg.eigvalsh(np.array(cov)))[::-1]
    first = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(first, values[:8] / np.trace(np.array(cov)), rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    z = (np.array(x) - np.array(s) / n) @ fitted.axes / np.sqrt(fitted.values)
    want = Counter((i, c + 1, sum((n * a - b) ** 2 for a, b in zip(r, s)), round(z[k, c], 9))
                   for k, ((i, _), r) in enumerate(zip(rows, x)) for c in range(8))
    have = Counter((None if i != i else int(i), int(c), int(d), round(w, 9)) for i, c, d, w in
                   zip(got.vec_id, got.component, got.deviation, got.whitened))
    assert have == want


def test_whitening_of_flat_and_mixed_lengths(lspark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.0, 1.0, 5.0]), (4, [2.0, 1.0, 5.0]), (5, [1.0, 1.0, 5.0])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(vectors(lspark, rows)).collect()}
    assert len(got) == 2 * 2 + 3 * 3
    assert got[1, 1].whitened is None and got[1, 1].explained is None and got[1, 1].identity_error is None and got[1, 1].n == 2
    assert abs(abs(got[3, 1].whitened) - math.sqrt(1.5)) < 1e-12 and got[3, 1].explained == 1.0 and got[3, 2].whitened is None
    assert whitening.whiten(vectors(lspark, rows).limit(0)).count() == 0
    huge = [(1, [3e38, 0.0]), (2, [-3e38, 1.0])]
    r = whitening.whiten(vectors(lspark, huge)).first()
    assert r.deviation is None and int(r.deviation_text) > 1 << 63


def toxic_table(lspark, n=900):
    rng = np.random.default_rng(8)
    words = {lang: [f"{lang}{i}" for i in range(300)] for lang in ("aa", "bb")}
    bad = {"aa": ["vile", "grubby"], "bb": ["schlim", "bö"]}
    rows, labels = [], []
    for d in range(n):
        lang = "aa" if d % 3 else "bb"
        text = rng.choice(words[lang], int(rng.integers(3, 200))).tolist()
        toxic = int(rng.random() < 0.3)
        if toxic:
            text[int(rng.integers(len(text)))] = str(rng.choice(bad[lang]))
        rows.append((d, " ".join(text), lang, "clash", 1))
        labels.append((d, 1, toxic))
    return (lspark.createDataFrame(rows, "doc_id long, text string, lang string, score string, y int"),
            lspark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_held_out_accuracy(lspark):
    docs, labels = toxic_table(lspark)
    model = toxicity.fit(docs, labels, min_steps=400)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    want = {r.doc_id: r.toxic for r in labels.collect()}
    held = [d for d, r in got.items() if r.held_out]
    assert len(got) == 900 and 200 < len(held) < 400
    assert np.mean([got[d].predicted == want[d] for d in held]) > 0.9
    assert all(got[d].predicted == int(got[d].score >= 0.7) and 0 <= got[d].score <= 1 for d in got)
    # neither lang nor doc_id nor source is an input
    other = docs.selectExpr("doc_id + 7000 AS doc_id", "text", "'zz' AS lang")
    moved = {r.doc_id - 7000: r.score for r in toxicity.score(other, model).collect()}
    assert all(abs(moved[d] - got[d].score) < 1e-6 for d in got)


def test_toxicity_labels_of_the_held_out_fold_are_not_learnt(lspark):
    docs, labels = toxic_table(lspark, 200)
    flipped = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    a = {r.doc_id: r.score for r in toxicity.classify(docs, labels, min_steps=60).collect()}
    b = {r.doc_id: r.score for r in toxicity.classify(docs, flipped, min_steps=60).collect()}
    assert a == b


def test_toxicity_odd_and_empty_tables(odd_docs, lspark):
    docs, labels = toxic_table(lspark, 200)
    model = toxicity.fit(docs, labels, min_steps=60)
    got = toxicity.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[5].score == by[6].score and by[None].held_out is False
    assert toxicity.score(odd_docs.limit(0), model).count() == 0
    few = lspark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.classify(odd_docs, few).collect()} == {0.5}
    assert toxicity.classify(odd_docs.limit(0), labels.limit(0)).count() == 0


def test_toxicity_learns_from_every_labelled_text(lspark):
    """All labelled texts of the training fold teach, dealt to several tasks; tables of one task are no special case."""
    docs, labels = toxic_table(lspark)
    words = toxicity.labelled_words(docs.repartition(5), labels)
    assert words.count() == labels.where("crc32(cast(doc_id as string)) % 3 <> 1").count() > 500
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    lspark.conf.set(key, "false")  # several files, so several tasks
    try:
        model = toxicity.fit(docs, labels, shard=70)
    finally:
        lspark.conf.set(key, "true")
    want = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.score(docs, model).collect()
    assert np.mean([r.predicted == want[r.doc_id] for r in got if r.held_out]) > 0.9


def test_toxicity_copies_are_averaged_over_those_that_changed_a_row(lspark):
    import pyarrow as pa

    def copy(shard, at, value):
        theta = np.full((len(at), toxicity.DIM), value, np.float32).tobytes()
        return {"k": 1, "block": 0, "shard": shard, "at": np.array(at, np.int32).tobytes(), "theta": theta, "seen": theta}

    got = toxicity.average(pa.Table.from_pylist([copy(2, [3, 9], 4.0), copy(1, [9, 11], 2.0)])).to_pylist()[0]
    assert np.frombuffer(got["at"], np.int32).tolist() == [3, 9, 11]
    assert np.frombuffer(got["theta"], np.float32).reshape(-1, toxicity.DIM)[:, 0].tolist() == [4.0, 3.0, 2.0]
