"""Operators against plain Python on a small table of odd rows, and on empty tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from trawl.llm import decontam, fingerprints, line_dedup, mixing, pii, ppm, quality, recompression, simhash, warc_index

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return SPACE.findall(t or "")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def classes(items, linked):
    up = {i: i for i in items}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {i: top(i) for i in items}


def test_simhash_against_brute_force(odd_docs):
    def fp(t):
        w = tokens(lower(t))
        sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    rows = [(r.doc_id, fp(r.text)) for r in odd_docs.collect()]
    fps = {f for _, f in rows}
    top = classes(fps, [(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 3])
    least = defaultdict(list)
    for d, f in rows:
        least[top[f]].append(d)
    want = Counter((d, f"{f:016x}", min((x for x in least[top[f]] if x is not None), default=None)) for d, f in rows)
    assert Counter(map(tuple, simhash.near_duplicates(odd_docs).collect())) == want
    kept = [r.doc_id for r in simhash.keep_one(odd_docs).collect()]
    assert 2 not in kept and 1 in kept and kept.count(11) == 2


def test_simhash_hot_group_in_blocks(lspark):
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)})
    far = [x ^ 0x7FFF00000000FFFF for x in fps[:50]]
    df = lspark.createDataFrame([(x,) for x in {*fps, *far}], "fp long")
    links = [(r.a, r.b) for r in simhash.fingerprint_links(df, 3, block=64).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    want = classes({*fps, *far}, [(a, b) for a in {*fps, *far} for b in {*fps, *far} if a < b and (a ^ b).bit_count() <= 3])
    assert classes({*fps, *far}, links) == want


def test_mixing_targets_and_bounds(odd_docs):
    rows = mixing.mix(odd_docs, group=3).collect()
    again = mixing.mix(odd_docs, group=3).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    sizes, per = Counter(), Counter()
    for r in odd_docs.collect():
        sizes[r.source] += len(tokens(r.text))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, goal = 1.5 * sum(sizes.values()), {}
    open_ = set(order)
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            goal[s] = 2.0 * sizes[s]
            left -= goal[s]
        open_ -= over
    goal |= {s: level * weight[s] for s in open_}
    assert sorted(round(r.target, 6) for r in rows) == sorted(round(goal[r.source], 6) for r in odd_docs.collect())
    assert len(rows) == odd_docs.count() and all(0 <= r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0 for r in rows)


def test_mixing_is_exact_up_to_half_a_document(lspark):
    df = lspark.createDataFrame([(i, "w " * (1 + i * 37 % 90), "s" if i % 3 else "t") for i in range(900)],
                                "doc_id long, text string, source string")
    for r in mixing.mix(df, group=16).groupBy("target").agg({"taken": "sum", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["target"]) <= r["max(size)"] / 2 + 1


def test_repeats_against_brute_force(odd_docs, lspark):
    extra = lspark.createDataFrame([(20, " ".join(["run"] * 60)), (21, "x " + " ".join(["run"] * 30) + " y"),
                                    (22, "a " * 40), (23, "a " * 12 + "b")], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra)
    rows = [(r.doc_id, tokens(r.text)) for r in docs.collect()]
    first = {}
    for d, w in rows:
        for p in range(len(w) - 12):
            k = tuple(w[p:p + 13])
            first[k] = min(first.get(k, 1 << 63), (1 << 62) if d is None else d)
    want = Counter()
    for d, w in rows:
        gone = {p + i for p in range(len(w) - 12) for i in range(13)
                if first[tuple(w[p:p + 13])] < ((1 << 62) if d is None else d)}
        want[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert Counter(map(tuple, recompression.remove_repeats(docs).collect())) == want


def test_symbols_agree_inside_equal_windows():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 5, 4000).astype(np.uint64)
    starts, rep = recompression.representatives(words, np.zeros(len(words), np.int64), 13)
    seen = {}
    for p, r in zip(starts, rep):
        assert seen.setdefault(words[p:p + 13].tobytes(), r) == r


def test_fingerprints_edit_and_neighbours(odd_docs):
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    want = {}
    for i, (d, t) in enumerate(rows):
        h = len(t) // 2
        edited = t[:len(t) - h] + rows[(i + 1) % len(rows)][1][:h]
        want[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest())
    got = fingerprints.edited_fingerprints(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint and by[2].near_next == 1.0 and 0.0 <= by[3].near_next < 0.3
    assert len(fingerprints.edited_fingerprints(odd_docs).collect()) == odd_docs.count()


def shingle_set(t):
    w = tokens(lower(t))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_by_brute_force(rows):
    """(doc_id, class_id, n_links) of rows (doc_id, text): Jaccard 0.8 of all pairs of distinct shingle sets."""
    sets = {shingle_set(t) for _, t in rows}
    linked = [(a, b) for a in sets for b in sets if a != b and len(a & b) >= 0.8 * len(a | b)]
    number = {s: k for k, s in enumerate(sets)}
    top = classes(range(len(sets)), [(number[a], number[b]) for a, b in linked])
    least = defaultdict(list)
    for d, t in rows:
        least[top[number[shingle_set(t)]]].append(d)
    degree = Counter(a for a, _ in linked)
    return Counter((d, min((x for x in least[top[number[shingle_set(t)]]] if x is not None), default=None),
                    degree[shingle_set(t)]) for d, t in rows)


def test_minhash_classes_against_brute_force(odd_docs, lspark):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in fingerprints.near_duplicates(odd_docs).collect())
    assert got == near_by_brute_force(rows)
    assert {(1, 1), (2, 1), (8, 8), (9, 8), (5, 5), (6, 5), (7, 5), (3, 3), (4, 4)} <= {x[:2] for x in got}
    # similar far above or below the threshold, so that bands meet surely; a hot group of near copies in blocks of four
    rng = np.random.default_rng(5)
    rows = [(None, None), (None, ""), (-1, "few words"), (-2, "Few  WORDS")]
    for family in range(12):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
        for copy in range(60 if family == 0 else 5):
            text = list(words)
            for at in rng.integers(0, 200, 1 + copy % 2):
                text[at] = f"new{rng.integers(10**9)}"
            rows.append((len(rows) // 2 if family == 1 else len(rows), " ".join(text)))  # family 1 repeats doc_ids
        rows.append((len(rows), " ".join(words[:100] + [f"x{x}" for x in rng.integers(0, 10**6, 100)])))
    docs = lspark.createDataFrame(rows, "doc_id long, text string").withColumn("member", F.lit(1)).withColumn("band", F.lit(2))
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in fingerprints.near_duplicates(docs, block=4).collect())
    assert got == near_by_brute_force(rows)
    whole = fingerprints.fingerprint_documents(docs).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in whole) == got


def test_leaks_against_brute_force(odd_docs, lspark):
    text = {r.doc_id: tokens(r.text) for r in odd_docs.collect()}
    one = text[3][5:25]
    two = text[8][100:120]
    two[4], two[6] = "other", "words"
    bench = lspark.createDataFrame([(1, " ".join(one)), (2, " ".join(two)), (3, None), (4, ""), (5, " ".join(text[10][:5])),
                                    (6, "nowhere " * 20)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_windows for r in decontam.find_leaks(odd_docs, bench).collect()}
    want = Counter()
    for r in odd_docs.dropDuplicates(["doc_id"]).collect():
        w = tokens(lower(r.text))
        for b in bench.collect():
            v = tokens(lower(b.text))
            n = min(13, len(v))
            for i in range(len(w) - n + 1 if n else 0):
                def meets(j):
                    bad = [k for k in range(n) if w[i + k] != v[j + k]]
                    return len(bad) <= min(2, (n - 1) // 4)
                want[r.doc_id, b.item_id] += any(meets(j) for j in range(len(v) - n + 1))
    assert got == {k: v for k, v in want.items() if v}
    kept = decontam.drop_leaks(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum((r.doc_id, i) not in got for r in odd_docs.collect() for i in [1]) - len(
        {d for d, i in got if (d, 1) not in got})


def test_leaks_with_substitutions_anywhere(lspark):
    """Every pair of positions in a window, at any distance, and items shorter than a window."""
    words = [f"w{i}" for i in range(60)]
    rows, items = [], [(1, " ".join(words[:20])), (2, " ".join(words[20:33])), (3, " ".join(words[40:46]))]
    for lo, size in ((0, 20), (20, 13), (40, 6)):
        for a in range(size):
            for b in range(a, size):
                text = words[lo:lo + size]
                text[a], text[b] = "other", "words"
                rows.append((len(rows), " ".join(["before", *text, "after"])))
    docs = lspark.createDataFrame(rows, "doc_id long, text string")
    bench = lspark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t in rows:
        w = t.split()
        for i, u in items:
            v = u.split()
            n = min(13, len(v))
            bad = [min(sum(w[p + k] != v[j + k] for k in range(n)) for j in range(len(v) - n + 1)) for p in range(len(w) - n + 1)]
            fit = [p for p, x in enumerate(bad) if x <= min(2, (n - 1) // 4)]
            if fit:
                want[d, i] = (len(fit), bad.count(0), fit[0])
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_exact, r.first_word) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == want
    assert any(t.split()[11:13] == ["other", "words"] and (d, 1) in got for d, t in rows)


def edits(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        e = [i]
        for j, y in enumerate(b, 1):
            e.append(min(d[j] + 1, e[-1] + 1, d[j - 1] + (x != y)))
        d = e
    return d[-1]


def test_banded_distance(lspark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    rows = []
    for k in (1, 2, 3):
        for _ in range(80):
            a = list(rng.choice(list("abñ"), rng.integers(2 * k + 3, 20)))
            b = list(a)
            for _ in range(rng.integers(0, k + 2)):
                p = int(rng.integers(0, len(b)))
                b[p:p + int(rng.integers(0, 2))] = list(rng.choice(list("abñ"), int(rng.integers(0, 2))))
            if abs(len(a) - len(b)) <= k < len(b):
                rows.append((k, [str(x) for x in a], [str(x) for x in b]))

    df = lspark.createDataFrame(rows, "k int, a array<string>, b array<string>")
    for k in (1, 2, 3):
        for r in df.where(F.col("k") == k).select("a", "b", line_dedup.banded_distance(F.col("a"), F.col("b"), k).alias("d")).collect():
            assert min(r.d, k + 1) == min(edits(r.a, r.b), k + 1)


def test_line_links_against_brute_force(lspark):
    """Every pair within one edit for each 8 characters (two at most) is a link, in groups of more than one block and with characters of any width."""
    from trawl.llm.common import Scratch

    rng = np.random.default_rng(11)
    letters = list("abc de\u00f1\u20ac\U0001f600")
    lines = []
    for size in (9, 14, 17, 33, 90):
        root = list(rng.choice(letters, size))
        for _ in range(45):
            t = list(root)
            for _ in range(rng.integers(0, 4)):
                p = int(rng.integers(0, len(t)))
                t[p:p + int(rng.integers(0, 2))] = list(rng.choice(letters, int(rng.integers(0, 2))))
            lines.append("".join(t))
    lines += lines[:10]
    docs = lspark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    occ = line_dedup.occurrences(docs)
    text_of = {r.id: r.line for r in occ.select("id", "line").collect()}
    got = {(r.a, r.b) for r in line_dedup.near_lines(occ.select("id", "line"), Scratch(lspark, "t"), 2, 8).collect()}
    ids = sorted(text_of)
    want = {(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
            if 0 < edits(text_of[a], text_of[b]) <= min(2, min(len(text_of[a]), len(text_of[b])) // 8)}
    assert got == want and len(want) > 200


def kept_in_order(lines, near):
    """Greedy by first occurrence: a line stays unless a near copy that stays came before it."""
    stay = set()
    for t in dict.fromkeys(lines):
        if not stay & near[t]:
            stay.add(t)
    return stay


def test_short_lines_against_brute_force(lspark):
    """Lines of 1 to 70 characters with the defaults: equality under 16, one edit from there, two from 32; no removal by transitive reach."""
    rng = np.random.default_rng(23)
    letters = list("abcdefgh 1\u00f1\U0001f600")
    lines = ["Click here to subscribe!", "Click here to subscribe.", "Read more", "Read more>", "next", "nexT", "next"]
    for size in (3, 5, 8, 14, 15, 16, 17, 24, 30, 31, 32, 33, 70):
        for _ in range(3):
            t = list(rng.choice(letters[:8], size))
            for _ in range(8):  # a chain: each is an edit or two of the one before
                for _ in range(rng.integers(0, 3)):
                    p = int(rng.integers(0, len(t))) if t else 0
                    t[p:p + int(rng.integers(0, 2))] = list(rng.choice(letters, int(rng.integers(0, 2))))
                if "".join(t).strip():
                    lines.append("".join(t))
    rng.shuffle(lines)
    every, near = sorted(set(lines)), defaultdict(set)
    for n, a in enumerate(every):
        for b in every[n + 1:]:
            if min(len(a), len(b)) >= 16 and edits(a, b) <= min(2, min(len(a), len(b)) // 16):
                near[a].add(b)
                near[b].add(a)
    assert sum(map(len, near.values())) > 200
    stay, seen, want = kept_in_order(lines, near), set(), {}
    for i, t in enumerate(lines):
        want[i] = (int(t not in stay or t in seen), len(near[t]))
        seen.add(t)
    docs = lspark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_links) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == want
    reach = classes(every, [(a, b) for a in near for b in near[a]])
    assert len(stay) > len(set(reach.values()))  # transitive reach would have removed more


def test_unrelated_short_lines_stay(lspark):
    """Numbers, dates and random short lines are no copies of each other, however many there are."""
    rng = np.random.default_rng(31)
    lines = ["$1,300", "$1,200", "2020-01-02", "2019-01-02", "Page 11 of 99", "Page 10 of 99"]
    lines += sorted({"".join(rng.choice(list("abcdefghijkl "), int(rng.integers(6, 10)))).strip() for _ in range(4000)} - {""})
    docs = lspark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).agg({"n_removed": "sum"}).first()[0] == 0


def test_removal_rounds_against_greedy(lspark):
    """Chains longer than the rounds are decided by hash: a removed line always has a linked line that stays."""
    from trawl.llm.common import Scratch

    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (100, 102), (200, 201)]
    edges = lspark.createDataFrame([(b, a) for a, b in links], "u long, v long")
    greedy = {r.id for r in line_dedup.copies_to_remove(edges, Scratch(lspark, "t"), 1000).collect()}
    assert greedy == {*range(1, 61, 2), 101, 102, 201}
    gone = {r.id for r in line_dedup.copies_to_remove(edges, Scratch(lspark, "t"), 3).collect()}
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    assert all(near[x] - gone for x in gone) and all(near[x] <= gone for x in set(near) - gone)


def test_clashing_helper_names(odd_docs, lspark):
    """Columns named like the operators' own helper columns pass through."""
    names = ["_gone", "_doc", "_hash", "_links", "_leak", "_GONE_"]
    docs = odd_docs.where("doc_id < 9").select("doc_id", "text")
    for n in names:
        docs = docs.withColumn(n, docs["doc_id"] * 2)
    bench = lspark.createDataFrame([(1, "a b")], "item_id long, text string")
    for out in (line_dedup.dedup_lines(docs).select(*docs.columns), simhash.keep_one(docs), decontam.drop_leaks(docs, bench)):
        assert out.columns == docs.columns
        assert all(r[n] == 2 * r.doc_id for r in out.collect() for n in names)


def test_line_dedup(odd_docs, lspark):
    base = "a line that is long enough to be compared by edits"
    rows = [(1, base + "\nshort\n\nshort"), (2, base.replace("long", "lang") + "\nonly here"), (3, "x" + base + "?"),
            (4, base[:20]), (5, None), (6, ""), (7, "short\nother")]
    docs = lspark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (base + "\nshort\n", 4, 1), 2: ("only here", 2, 1), 3: ("", 1, 1), 4: (base[:20], 1, 0),
                   5: (None, 0, 0), 6: ("", 1, 0), 7: ("other", 2, 1)}
    out = line_dedup.dedup_lines(odd_docs)
    assert out.count() == odd_docs.count() and set(odd_docs.columns) <= set(out.columns)
    both = [r.text for r in out.where("doc_id = 11").collect()]
    assert len(both) == 2 and both[0] == both[1] != ""


def test_quality_learns_only_the_training_fold(lspark):
    rows, labels = [], []
    for i in range(600):
        good = i % 5 > 0
        rows.append((i, " ".join(f"word{(i * j) % 91}x, and" for j in range(40)) + "." if good else "BUY!! NOW!! " * 40))
        labels.append((i, int(good), 0))
    docs = lspark.createDataFrame([*rows, (None, None), (1000, "")], "doc_id long, text string")
    lab = lspark.createDataFrame([*labels, (None, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.classify(docs, lab).collect()}
    truth = {i: q for i, q, _ in labels}
    assert np.mean([got[i].predicted == q for i, q in truth.items()]) > 0.98
    assert got[None].held_out is False and 0 <= got[1000].score <= 1
    few = quality.classify(docs.limit(5), lab.limit(3)).collect()
    assert [r.score for r in few] == [0.5] * 5


def test_pii_base_spans(lspark):
    texts = ["a@b.c_d@e.f x@y", "a.b.c@d..e@f.g.h", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255", "4111 1111 1111 1111 5",
             "++1 (2) 3-4.5 67890 +1 2", "ñ \U0001F600 a@b.cd 1.1.1.1", "", None, "+1(23)4567)8 9)", "1 " * 3000,
             "z" * 20000, "a@b.c@d.e@f.g"]
    docs = lspark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(k, m):
        d = re.sub("[^0-9]", "", m)
        if k == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if k == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
            return 16 <= len(d) <= 19 and sum(v - 9 * (v > 9) for v in twice) % 10 == 0
        return k == "email" or 8 <= len(d) <= 15

    for r in pii.personal_data(docs).collect():
        want = [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(plain[k], texts[r.doc_id] or "") if ok(k, m[0])]
        said = ",".join(f"{k}:{a}:{z}" for k, a, z in want)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert {x for x in said.split(",") if x} <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in want) for k in pii.KINDS]
    found = pii.find(docs, pii.fit(docs))
    assert {r.doc_id: r.text for r in pii.redact(found).collect()}[5] == "ñ \U0001F600 <email> <ip>"


def test_pii_additions_learnt_from_announced_spans(lspark):
    """Formats that no base pattern takes are added where the text names them; the same digits elsewhere are not."""
    def luhn_card(i):
        body = f"4{i:014d}"
        twice = [int(c) * (2 - j % 2) for j, c in enumerate(reversed(body))]
        return body + str(-sum(v - 9 * (v > 9) for v in twice) % 10)

    rows, want, decoys = [], {}, set()
    for i in range(120):
        n, card = f"(555) 123-{4000 + i}", luhn_card(i * 7919)
        dotted = ".".join(card[j:j + 4] for j in range(0, 16, 4))
        wrong = dotted[:-1] + str((int(dotted[-1]) + 1) % 10)
        texts = [(f"Please call {n} before noon.", n, "phone"), (f"Your card {dotted} was charged.", dotted, "card"),
                 (f"The table has {n} rows in it.", None, None), (f"It says {wrong} in row nine.", None, None),
                 (f"mail joe{i}@localhost now", f"joe{i}@localhost", "email"), (f"server 10,0,{i},1 is up", f"10,0,{i},1", "ip")]
        for t, span, kind in texts:
            d = len(rows)
            rows.append((d, t))
            if span:
                want[d] = f"{kind}:{t.index(span)}:{t.index(span) + len(span)}"
            else:
                decoys.add(d)
    got = {r.doc_id: r for r in pii.personal_data(lspark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(r.n_email + r.n_ip + r.n_card + r.n_phone == 0 for r in got.values())
    caught = [d for d, w in want.items() if got[d].spans == w]
    assert len(caught) > 0.95 * len(want) and not [d for d in decoys if got[d].spans]


def test_pii_groups_of_long_runs(lspark):
    """Two cards with a blank between them are one run of 32 digits: both are proposed."""
    two = "4111 1111 1111 1111 5500 0000 0000 0004"
    df = lspark.createDataFrame([(two,)], "text string").select(pii.candidates(F.col("text"))["card"].alias("c"))
    assert {(c.start, c.stop) for c in df.first().c} >= {(0, 19), (20, 39)}


def test_ppm_base_score_and_total_probability(odd_docs):
    import zlib

    got = ppm.score_documents(odd_docs).collect()
    assert len(got) == odd_docs.count()
    count = Counter()
    rows = [(r.doc_id, [*tokens(lower(r.text)), None]) for r in odd_docs.collect()]
    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 10:
            count.update(t)
    n, v = sum(count.values()), len(count)
    want = sorted((str(d), len(t), sum(count[x] > 0 for x in t), n,
                   round(float(sum(np.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)), 4)) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want


def test_ppm_probabilities_add_up_to_one():
    """After any context, seen or not, the 256 bytes share the whole probability."""
    rng = np.random.default_rng(6)
    text = rng.choice(list(b"abcab \xc3"), 3000).astype(np.int64)
    code = sum(text[k:len(text) - 4 + k] << 8 * (4 - k) for k in range(5))
    pairs = np.zeros((256, 256), np.int64)
    np.add.at(pairs, (code >> 8 & 255, code & 255), 1)
    seen, n = np.unique(code, return_counts=True)
    for context in (code[7] >> 8, code[7] >> 8 ^ 1 << 24, 0x61616161, 0x7A7A7A7A):
        asked = (int(context) << 8) + np.arange(256)
        every = np.union1d(seen, asked)
        count = np.zeros(len(every), np.int64)
        count[np.searchsorted(every, seen)] = n
        p = 10 ** ppm.fold(every, count, pairs)
        assert abs(p[np.searchsorted(every, asked)].sum() - 1) < 1e-9


def test_ppm_packs_round_trip():
    rng = np.random.default_rng(1)
    code = np.unique(rng.integers(0, 1 << 40, 500))
    assert np.array_equal(ppm._code(ppm._turn(code)), code)
    words = np.sort(rng.integers(-(1 << 63), (1 << 63) - 1, 200))
    for is_code, names in ((True, np.sort(ppm._turn(code))), (False, words)):
        for parts in (1, 8, 3000):
            packs = ppm._packs(is_code, names, np.arange(len(names)), parts)
            got = {int(k): int(v) for p in packs for k, v in zip(ppm._names(p["names"]), ppm._unplanes(p["n"]))}
            assert got == dict(zip(names.tolist(), range(len(names))))


def test_ppm_scores_use_every_context(lspark):
    """The score of every text against a direct escape chain over all training contexts; more of them than 50,000."""
    import random
    import zlib

    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz\u00f1\u03b1\u20ac"
    rows = [(i, " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8))) for _ in range(rnd.randint(0, 90))))
            for i in range(240)]
    rows += [(500, "Q\U0001F600"), (501, None)]
    seen = defaultdict(Counter)
    for d, t in rows:
        if zlib.crc32(str(d).encode()) % 10:
            raw = b"\n" * 4 + " ".join(tokens(lower(t))).encode() + b"\n"
            for p in range(4, len(raw)):
                for k in range(5):
                    seen[raw[p - k:p]][raw[p]] += 1
    assert len(seen) > 50_000

    def score(t):
        raw, total = b"\n" * 4 + " ".join(tokens(lower(t))).encode() + b"\n", 0.0
        for p in range(4, len(raw)):
            prob, gone = 1.0, set()
            for k in range(4, -1, -1):
                left = {s: c for s, c in seen.get(raw[p - k:p], {}).items() if s not in gone}
                both = sum(left.values()) + len(left)
                if raw[p] in left:
                    prob *= left[raw[p]] / both
                    break
                if left:
                    prob *= len(left) / both
                    gone |= set(left)
            else:
                prob /= 256 - len(gone)
            total += np.log10(prob)
        return total

    docs = lspark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in ppm.score_documents(docs).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        assert abs(got[d] - score(t)) < 1e-6 * max(1, abs(got[d]))


def test_warc_round_trip_and_merge(lspark):
    big = "<p>é</p>" * 20
    rows = [(3, "http://b.Example.com/x?q#f", big), (1, "https://a.example.com", big), (2, None, ""), (4, "odd", None),
            (5, "http://b.example.com/x?q", "small"), (6, "http://b.example.com/\r\nX: y", "small"), (None, "http://n.org/", big)]
    pages = lspark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc_index.archive_pages(pages).collect()}
    assert len(got) == 7 and sorted(r.capture_no for r in got.values()) == list(range(1, 8))
    for i, _, html in rows:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
    assert [(got[i].record_type, got[i].refers_to) for i in (1, 3, None, 5, 6)] == [
        ("response", None), ("revisit", 1), ("revisit", 1), ("response", None), ("response", None)]
    assert got[3].url_key == "com,example,b)/x?q" and got[1].url_key == "com,example,a)/"
    runs = [[1, 4, 9], [], [2, 2, 3], [0], [5]]
    for k in range(len(runs) + 1):
        assert list(warc_index.loser_tree_merge(runs[:k], lambda x: x)) == sorted(x for r in runs[:k] for x in r)


def test_empty_tables(odd_docs, lspark):
    none = odd_docs.limit(0)
    bench = lspark.createDataFrame([], "item_id long, text string")
    labels = lspark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = lspark.createDataFrame([], "page_id long, url string, html string")
    for df in (simhash.near_duplicates(none), simhash.keep_one(none), mixing.mix(none), recompression.remove_repeats(none),
               fingerprints.edited_fingerprints(none), fingerprints.near_duplicates(none), decontam.find_leaks(none, bench),
               decontam.find_leaks(odd_docs, bench), line_dedup.dedup_lines(none), quality.classify(none, labels),
               pii.personal_data(none), ppm.score_documents(none), warc_index.archive_pages(pages)):
        assert df.count() == 0


def test_line_keys_are_compiled(lspark):
    """The code that makes line keys stays under the 8,000 bytes of a method that the JVM compiles."""
    import contextlib
    import io
    import re

    lines = lspark.range(5).selectExpr("id", "repeat('x y', 20) AS line", "60 AS n")
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        line_dedup.segment_keys(lines, 2, 16).select("id", "key", "home").explain("codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue()))) < 8000
    assert line_dedup.segment_keys(lines, 2, 16).count() == 5 * len(line_dedup.segment_slots(2))


def test_texts_travel_to_groups_with_pairs_only():
    """A member meets another under the first band they share; of two blocks only across."""
    band = np.array([[1, 5, 9], [1, 5, 8], [2, 5, 9], [2, 5, 8]])
    member, own = np.array([10, 20, 30, 40]), np.array([0, 0, 1, 1])
    def pairs(*key):
        return [(int(member[a]), int(member[b])) for a, b in zip(*np.nonzero(fingerprints.first_shared(band, member, own, key)))]
    assert pairs(5, 0, 0) == [(10, 30), (10, 40), (20, 30), (20, 40)]
    assert pairs(5, 0, 1) == pairs(5, 0, 0)
    same = fingerprints.first_shared(band[[0, 2]], member[[0, 2]], own[[0, 2]], (9, 0, 0))
    assert not same.any()
