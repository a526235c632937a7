"""Personal data by candidate gradient boosting (native).

High-recall generators propose spans of four kinds that may overlap, also
within a kind: a long run of digits is proposed whole and in the groups that
cards and phone numbers are written in.  Every candidate has small integer
features of its format and its context.  The trees are taught by two things
that do not need each other: a candidate is a positive if it is a base span
(the strict pattern and its check), or if its own check holds and a word that announces
its kind stands before it.  So a number in a format the base patterns do not
know is learnt from the places where the text names it.  Because the features
are bounded integers, all candidates of the corpus fit into one table of
distinct feature vectors with counts, from one aggregation; boosted trees are
grown on that table, and a threshold per kind is calibrated on the documents
held back from growing, so that at least ``precision`` of the candidates above
it are positives.  The trees then run as column expressions.  Base spans always
stay; other candidates above the threshold are added where they overlap no base
span and no better addition.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.plan import compute_once

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Possessive quantifiers and the looks
# behind change no match (nothing that follows could use what they give back,
# and a later start in the same run reaches the same end); they keep the
# matcher linear on long runs and off the stack.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The generators: what any of these may look like.
LOOSE = {
    "email": r"(?:(?<![^\x20\x09-\x0D@<>()\[\],;:\"])|\G)[^\x20\x09-\x0D@<>()\[\],;:\"]++@[^\x20\x09-\x0D@<>()\[\],;:\"]++",
    "ip": r"(?<![0-9])[0-9]++(?:[.,][0-9]++){3,}+",
    "card": r"[0-9](?:[\x20.-]?[0-9])++",
    "phone": r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])++",
}
# Groups that long runs of digits are also proposed in.
GROUPED = {
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CUE = r"(?i)(?:mail|contact|tel|phone|call|fax|mobil|fon|card|visa|credit|karte|tarjeta|carte|host|addr|server|\bip)\W*\z"
N_FEATURES = 9
CHECK, ANNOUNCED = 4, 6  # places of two of the features


def _with(fn, *fixed):
    """A one-argument lambda body: ``fn`` of the fixed values and the element."""
    return lambda s: fn(*fixed, s)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Luhn's check of a string of digits (a lambda variable or column)."""
    n = F.length(d)

    def add(acc, k):
        v = F.substring(d, n - k, F.lit(1)).cast("int") * F.when(k % 2 == 1, 2).otherwise(1)
        return acc + v - F.when(v > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, m, before, after>> of all leftmost matches, by code points.

    The pieces between the matches give the positions.
    """
    z = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))
    kind = "struct<at:int,out:array<struct<start:int,stop:int,m:string,before:string,after:string>>>"
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int,m:string,before:string,after:string>>")
                     .alias("out")).cast(kind)

    def step(acc, x):
        start = acc["at"] + F.length(x["p"])
        stop = start + F.coalesce(F.length(x["m"]), F.lit(0))
        item = F.struct(start.alias("start"), stop.alias("stop"), x["m"].alias("m"),
                        F.right(x["p"], F.lit(24)).alias("before"), F.lit("").alias("after"))
        return F.struct(stop.alias("at"), F.when(x["m"].isNull(), acc["out"]).otherwise(
            F.concat(acc["out"], F.array(item))).alias("out")).cast(kind)

    return F.aggregate(z, first, step, lambda acc: acc["out"])


def is_base(kind: str, m: Column) -> Column:
    """The check of a base match; ``m`` must be a lambda variable or column."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"\A{OCTET}(?:\.{OCTET}){{3}}\z")
    n = F.length(digits(m))
    if kind == "phone":
        return n.between(8, 15)
    return F.when(n.between(16, 19), F.get(F.transform(F.array(digits(m)), luhn), 0)).otherwise(F.lit(False))


def base_spans(text: Column) -> dict[str, Column]:
    """Valid base spans of every kind; texts without the kind's characters are not searched."""
    none = F.array().cast("array<struct<start:int,stop:int,m:string,before:string,after:string>>")
    may = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]"),
           "phone": text.rlike(r"\+[0-9]")}
    return {k: F.when(may[k], F.filter(spans(text, BASE[k]), _with(lambda k, s: is_base(k, s["m"]), k))).otherwise(none)
            for k in KINDS}


def loose_spans(text: Column) -> dict[str, Column]:
    """Candidates of every kind."""
    none = F.array().cast("array<struct<start:int,stop:int,m:string,before:string,after:string>>")
    has = text.rlike("[0-9]")
    size = {"email": (3, 400), "ip": (4, 400), "card": (13, 19), "phone": (7, 15)}

    def fits(k, m):
        n = F.length(m) if k in ("email", "ip") else F.length(digits(m))
        return n.between(*size[k])

    may = {"email": F.contains(text, F.lit("@")), "ip": has, "card": has, "phone": has}
    def found(k):
        whole = F.filter(spans(text, LOOSE[k]), _with(lambda k, s: fits(k, s["m"]), k))
        if k not in GROUPED:
            return whole
        # what the whole runs already are is not proposed twice
        return F.get(F.transform(F.array(whole), lambda w: F.concat(w, F.filter(spans(text, GROUPED[k]), lambda s: ~F.exists(
            w, lambda t: (t["start"] == s["start"]) & (t["stop"] == s["stop"]))))), 0)

    return {k: F.when(may[k], found(k)).otherwise(none) for k in KINDS}


def features(kind: str, s: Column) -> list[Column]:
    """``N_FEATURES`` bounded integers of one candidate."""
    m = s["m"]
    inner = F.regexp_replace(m, "[0-9A-Za-z]", "")
    n = F.length(digits(m))
    check = {
        "email": m.rlike(r"\A[^@]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\z"),
        "ip": m.rlike(rf"\A{OCTET}(?:[.,]{OCTET}){{3}}\z"),
        "card": F.get(F.transform(F.array(digits(m)), luhn), 0),
        "phone": m.rlike(r"\A\+?\(?[0-9]{1,4}\)?(?:[\x20.-]{1,2}\(?[0-9]{2,4}\)?)+\z"),
    }[kind]
    separator = F.when(inner == "", 0).when(inner.rlike(r"\A[+]?[ ]+\z"), 1).when(inner.rlike(r"\A[+]?-+\z"), 2).when(
        inner.rlike(r"\A[+]?\.+\z"), 3).when(inner.rlike(r"[()]"), 4).otherwise(5)
    last = F.right(s["before"], F.lit(1))
    touch = F.when(s["before"] == "", 0).when(last.rlike(r"[ \t\n\x0B\f\r]"), 1).when(last.rlike(r"\p{L}"), 2).when(
        last.rlike(r"[0-9]"), 3).when(last.rlike(r"[=:\"'#/\\_-]"), 4).otherwise(5)
    return [F.least(n, F.lit(20)), F.least(F.floor(F.length(m) / 4), F.lit(12)).cast("int"),
            F.least(F.length(inner), F.lit(8)), separator, check.cast("int"), touch,
            s["before"].rlike(CUE).cast("int"), m.rlike(r"\A\p{ASCII}*\z").cast("int"),
            F.least(F.regexp_count(m, F.lit(r"\.")), F.lit(6)).cast("int")]


def candidates(text: Column) -> dict[str, Column]:
    """array<struct<start, stop, m, f array<int>>> of every kind."""
    def one(k, s):
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"),
                        F.array(*[F.coalesce(c, F.lit(0)).cast("int") for c in features(k, s)]).alias("f"))

    return {k: F.transform(v, _with(one, k)) for k, v in loose_spans(text).items()}


@dataclass
class Trees:
    """One kind's boosted trees: nested (feature, cut, left, right) tuples with numbers at the leaves."""

    start: float
    trees: list
    cut: float  # log odds a candidate must reach

    def logit(self, f: Column) -> Column:
        def value(t):
            if not isinstance(t, tuple):
                return F.lit(float(t))
            return F.when(F.get(f, t[0]) <= t[1], value(t[2])).otherwise(value(t[3]))

        out = F.lit(self.start)
        for t in self.trees:
            out = out + value(t)
        return out


def _values(t, x: np.ndarray) -> np.ndarray:
    if not isinstance(t, tuple):
        return np.full(len(x), t)
    return np.where(x[:, t[0]] <= t[1], _values(t[2], x), _values(t[3], x))


def _grow(x, g, h, depth: int, ridge: float = 1.0):
    """Regression tree on gradient and curvature sums: the cut with the largest gain, down to ``depth``."""
    best, leaf = (1e-6, None), float(np.clip(-g.sum() / (h.sum() + ridge), -4, 4)) * 0.3
    if depth:
        whole = g.sum() ** 2 / (h.sum() + ridge)
        for j in range(x.shape[1]):
            for cut in np.unique(x[:, j])[:-1]:
                left = x[:, j] <= cut
                gl, hl = g[left].sum(), h[left].sum()
                gr, hr = g.sum() - gl, h.sum() - hl
                gain = gl * gl / (hl + ridge) + gr * gr / (hr + ridge) - whole
                if gain > best[0]:
                    best = (gain, (j, int(cut)))
    if best[1] is None:
        return leaf
    left = x[:, best[1][0]] <= best[1][1]
    return (*best[1], _grow(x[left], g[left], h[left], depth - 1), _grow(x[~left], g[~left], h[~left], depth - 1))


def boost(x: np.ndarray, n: np.ndarray, pos: np.ndarray, cal_n: np.ndarray, cal_pos: np.ndarray, rounds: int = 24,
          depth: int = 3, precision: float = 0.95) -> Trees:
    """Log-loss boosting on distinct vectors with counts; the threshold comes from the calibration counts."""
    share = (pos.sum() + 1) / (n.sum() + 2)
    start = math.log(share / (1 - share))
    f, trees = np.full(len(x), start), []
    for _ in range(rounds if n.sum() else 0):
        p = 1 / (1 + np.exp(-f))
        t = _grow(x, n * p - pos, n * p * (1 - p), depth)
        trees.append(t)
        f += _values(t, x)
    cut = math.inf
    order = np.argsort(-f, kind="stable")
    total, right = np.cumsum(cal_n[order]), np.cumsum(cal_pos[order])
    good = np.flatnonzero((total > 0) & (right >= precision * total))
    if len(good):  # all vectors of the last good score belong above the cut
        cut = float(f[order[good[-1]]])
        above = f >= cut
        if cal_pos[above].sum() < precision * cal_n[above].sum():
            cut = float(np.nextafter(cut, np.inf))
    return Trees(start, trees, max(cut, 0.0))


def fit(docs: DataFrame, precision: float = 0.95) -> dict[str, Trees]:
    """Trees of every kind from all candidates of ``docs``; documents of odd doc_id hash calibrate."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = compute_once(docs.select("doc_id", text.alias("text")), ["doc_id"],
                        **{f"c_{k}": v for k, v in candidates(F.col("text")).items()},
                        **{f"b_{k}": F.transform(v, lambda s: F.struct(
                            s["start"].alias("start"), s["stop"].alias("stop"))) for k, v in base_spans(F.col("text")).items()})
    cal = (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1).alias("cal")

    def taught(i, k, s):
        base = F.array_contains(F.col(f"b_{k}"), F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
        named = (F.get(s["f"], CHECK) == 1) & (F.get(s["f"], ANNOUNCED) == 1)
        return F.struct(F.lit(i).alias("kind"), s["f"].alias("f"), (base | named).alias("hit"))

    # one array, so a text's candidates are found once
    every = rows.select(cal, F.inline(F.concat(*[F.transform(f"c_{k}", _with(taught, i, k)) for i, k in enumerate(KINDS)])))
    table = every.groupBy("kind", "f").agg(
        F.sum((~F.col("cal")).cast("long")).alias("n"), F.sum((~F.col("cal") & F.col("hit")).cast("long")).alias("pos"),
        F.sum(F.col("cal").cast("long")).alias("cal_n"), F.sum((F.col("cal") & F.col("hit")).cast("long")).alias("cal_pos"))
    got = sorted(table.collect(), key=lambda r: (r["kind"], r["f"]))  # one row per distinct feature vector
    out = {}
    for i, k in enumerate(KINDS):
        mine = [r for r in got if r["kind"] == i]
        x = np.array([r["f"] for r in mine], np.int64).reshape(len(mine), N_FEATURES)
        out[k] = boost(x, *(np.array([r[c] for r in mine], np.float64) for c in ("n", "pos", "cal_n", "cal_pos")),
                       precision=precision)
    return out


def find(docs: DataFrame, trees: dict[str, Trees]) -> DataFrame:
    """``docs`` columns doc_id, text with ``base`` and ``spans``: arrays of (kind number, start, stop).

    Both are in the order of kind, then start; ``spans`` holds the base and
    what the trees add.  A null text counts as empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = compute_once(docs.select("doc_id", text.alias("text")), ["doc_id", "text"],
                        **{f"c_{k}": v for k, v in candidates(F.col("text")).items()},
                        **{f"b_{k}": v for k, v in base_spans(F.col("text")).items()})

    def item(i, s):
        return F.struct(F.lit(i).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))

    base = F.concat(*[F.transform(F.col(f"b_{k}"), _with(item, i)) for i, k in enumerate(KINDS)])
    def rated(i, k, s):
        return F.struct(F.lit(i).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
                        trees[k].logit(s["f"]).alias("score"))

    scored = F.concat(*[F.filter(F.transform(F.col(f"c_{k}"), _with(rated, i, k)), _with(
        lambda k, s: s["score"] >= F.lit(min(trees[k].cut, 1e9)), k)) for i, k in enumerate(KINDS)])
    rows = compute_once(rows, ["doc_id", "text"], base=base, scored=scored)

    def overlap(a, b):
        return (a["start"] < b["stop"]) & (b["start"] < a["stop"])

    def better(a, b):  # a wins over b: score, then kind, then start
        return (a["score"] > b["score"]) | ((a["score"] == b["score"]) & (
            (a["kind"] < b["kind"]) | ((a["kind"] == b["kind"]) & (a["start"] < b["start"]))))

    # nearly all candidates above the cut are base spans: drop those by equality first
    plain = F.transform("scored", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    rows = compute_once(rows, ["doc_id", "text", "base", "scored"], more=F.size(F.array_except(plain, F.col("base"))) > 0)
    free = F.when(F.col("more"), F.filter("scored", lambda a: ~F.exists("base", lambda b: overlap(a, b)))).otherwise(
        F.slice("scored", 1, 0))
    rows = compute_once(rows, ["doc_id", "text", "base"], free=free)
    added = F.filter("free", lambda a: ~F.exists("free", lambda b: overlap(a, b) & better(b, a)))
    added = F.transform(added, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return rows.select("doc_id", "text", "base", F.when(F.size("free") > 0, F.array_sort(
        F.concat("base", added))).otherwise(F.col("base")).alias("spans"))


def as_text(found: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(found: DataFrame) -> DataFrame:
    """(doc_id, text) with every span of ``find`` replaced by its kind in angle brackets, overlaps as one."""
    def step(acc, s):
        new = s["start"] >= acc["at"]
        piece = F.concat(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"),
                         F.get(F.array(*map(F.lit, KINDS)), s["kind"]), F.lit(">"))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.when(new, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    order = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), (-s["stop"]).alias("back"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    rest = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    rows = compute_once(found, ["doc_id", "text"], r=rest)
    return rows.select("doc_id", F.concat("r.out", F.substring(F.col("text"), F.col("r.at") + 1, F.length("text"))).alias("text"))


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per input row.

    Counts and ``base_sha256`` are of the base spans, ``spans`` are all.  A
    null text counts as empty; a null doc_id and repeated rows are rows like
    any other; other columns are ignored.
    """
    found = find(docs, fit(docs))
    count = [F.size(F.filter("base", _with(lambda i, s: s["kind"] == i, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *count, F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
                        as_text(F.col("spans")).alias("spans"))
