"""Quality classifier by positive-unlabelled learning with non-negative risk.

Trusted positives are training rows labelled 1; every other text counts as
unlabelled (labels 0 are not used).  With p the positives, u the unlabelled
texts and c the share of positives among the unlabelled, the risk

    c * R(p, 1)  +  max(0, R(u, 0) - c * R(p, 0))

is minimised by a small network over surface features of the whole text; when
the bracket turns negative its gradient is reversed, which stops the network
from fitting the unlabelled texts as negatives.  c is estimated from the data:
a first network tells positives from unlabelled texts, and on held-back rows
the smallest ratio of the two survival functions (with confidence margins),
over all score thresholds, bounds c from above.

The fit uses a bounded sample (``max_rows`` positives and as many unlabelled
texts, chosen by hash of doc_id); everything else reads all documents.
Scoring is one map over the documents without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: str | None) -> np.ndarray:
    """Surface features of one whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    freq = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n
    words = raw.split()
    k = max(1, len(words))
    counts = Counter(words)
    lens = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    lines = raw.split(b"\n")
    line_counts = Counter(lines)
    same = sum(a == b for a, b in zip(words, words[1:]))
    top = counts.most_common(1)[0][1] if words else 0
    upper = sum(w.isupper() for w in words)
    ends = Counter(w[-1:] for w in words)
    out = [
        math.log1p(len(raw)), math.log1p(len(words)), lens.mean(), lens.std(), lens.max() ** 0.5,
        len(counts) / k, len(counts) / math.sqrt(k), top / k, same / k, upper / k,
        len(line_counts) / len(lines), math.log1p(len(lines)), len(raw) / len(lines) / 500,
        freq[97:123].sum(), freq[65:91].sum(), freq[48:58].sum(), freq[128:].sum(), freq[32], freq[10],
        sum(freq[b] for b in PUNCT), ends.get(b".", 0) / k, ends.get(b",", 0) / k,
        sum(v for e, v in ends.items() if e in PUNCT) / k,
        sum(len(w) == 1 and w in PUNCT for w in words) / k,
        -float(sum(p * math.log(p) for p in freq if p > 0)),
    ]
    out += [math.sqrt(freq[b]) for b in PUNCT]
    return np.array(out, np.float64)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _fit(pos: np.ndarray, unl: np.ndarray, prior: float | None, hidden: int, epochs: int, seed: int) -> Model:
    """Network by Adam: non-negative risk with ``prior``, or plain positives against unlabelled (None)."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(0), both.std(0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (pos, unl))
    d = p.shape[1]
    theta = [rng.normal(0, 1 / math.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), hidden),
             np.zeros(1)]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    step, size = 0, 256

    def back(x, h, g):
        gh = np.outer(g, theta[2]) * (1 - h * h)
        return [x.T @ gh, gh.sum(0), h.T @ g, np.array([g.sum()])]

    for _ in range(epochs):
        ip, iu = rng.permutation(len(p)), rng.permutation(len(u))
        for lo in range(0, max(len(p), len(u)), size):
            xp, xu = p[np.take(ip, range(lo, lo + size), mode="wrap")], u[np.take(iu, range(lo, lo + size), mode="wrap")]
            hp, hu = np.tanh(xp @ theta[0] + theta[1]), np.tanh(xu @ theta[0] + theta[1])
            fp, fu = hp @ theta[2] + theta[3], hu @ theta[2] + theta[3]
            sp, su = 1 / (1 + np.exp(-np.clip(fp, -30, 30))), 1 / (1 + np.exp(-np.clip(fu, -30, 30)))
            # log loss: d/df of loss(f, 1) is s - 1, of loss(f, 0) is s
            if prior is None:
                gp, gu = (sp - 1) / len(xp), su / len(xu)
            else:
                negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
                if negative >= 0:
                    gp, gu = prior * (sp - 1) / len(xp) - prior * sp / len(xp), su / len(xu)
                else:
                    gp, gu = prior * sp / len(xp), -su / len(xu)
            grads = [a + b for a, b in zip(back(xp, hp, gp), back(xu, hu, gu))]
            step += 1
            for i, g in enumerate(grads):
                g = g + 1e-4 * theta[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                theta[i] = theta[i] - 0.01 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, theta[0], theta[1], theta[2], float(theta[3][0]), -1.0 if prior is None else prior)


def class_prior(pos: np.ndarray, unl: np.ndarray, hidden: int = 16, epochs: int = 15, seed: int = 5) -> float:
    """Share of positives among the unlabelled: the smallest bounded ratio of survival functions."""
    half_p, half_u = len(pos) // 2, len(unl) // 2
    model = _fit(pos[:half_p], unl[:half_u], None, hidden, epochs, seed)
    sp, su = np.sort(model.logit(pos[half_p:])), np.sort(model.logit(unl[half_u:]))
    cuts = sp[: max(1, int(0.95 * len(sp)))]  # at least a twentieth of the positives above the cut
    qp = 1 - np.searchsorted(sp, cuts) / len(sp)
    qu = 1 - np.searchsorted(su, cuts) / len(su)
    margin = math.sqrt(math.log(40) / 2 / len(sp)) + math.sqrt(math.log(40) / 2 / len(su))
    best = int(np.argmin((qu + margin) / qp))
    return float(np.clip(qu[best] / qp[best], 0.05, 0.98))


def training_fold(doc_id: Column) -> Column:
    """Rows whose label may be learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8192, hidden: int = 24, epochs: int = 30,
        seed: int = 3) -> Model | None:
    """Fit on up to about ``max_rows`` positives and ``max_rows`` unlabelled texts of the training fold.

    None where there are fewer than 16 of either.  A document labelled both
    ways is no trusted positive.
    """
    fold = training_fold(F.col("doc_id"))
    good = labels.where(F.col("doc_id").isNotNull() & fold).groupBy("doc_id").agg(
        F.min("quality").alias("_q")).where("_q = 1").select("doc_id")
    n_good = good.count()
    n_docs = docs.where(fold).select("doc_id").count()
    span = float(1 << 32)

    def chosen(salt: int, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt + seed), "doc_id"), F.lit(1 << 32)) < span * max_rows / max(n, 1)

    text = F.col("text").cast("string").alias("text")
    pos = docs.where(chosen(100, n_good)).join(good.where(chosen(100, n_good)), "doc_id", "left_semi").select(
        "doc_id", text, F.lit(1).alias("kind"))
    unl = docs.where(fold & chosen(200, n_docs)).select("doc_id", text, F.lit(0).alias("kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "kind", "x"])

    rows = pos.unionByName(unl).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "kind").mapInArrow(
        run, "doc_id long, kind int, x array<double>").toArrow().to_pydict()
    order = sorted(range(len(rows["kind"])), key=lambda i: (hash((rows["doc_id"][i], 7)), rows["kind"][i], rows["x"][i]))
    p = np.array([rows["x"][i] for i in order if rows["kind"][i] == 1])
    u = np.array([rows["x"][i] for i in order if rows["kind"][i] == 0])
    if len(p) < 16 or len(u) < 16:
        return None
    return _fit(p, u, class_prior(p, u), hidden, epochs, seed)


def score(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row, without a shuffle.

    A null text scores as the empty text.  A null doc_id is not held out.
    Without a model (too few labels) every score is 0.5.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                s = np.full(len(b), 0.5) if model is None else model.score(np.array([features(t.as_py()) for t in b.column(2)]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` the model accepts, columns and order of columns unchanged, without a shuffle.

    Texts are scored in place; a null text is judged as the empty text.
    """
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                s = model.score(np.array([features(t.as_py()) for t in b.column(at)]))
                yield b.filter(pa.array(s >= threshold))

    return docs if model is None else docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 8192) -> DataFrame:
    """Fit on ``labels`` and score every document; see ``fit`` and ``score``."""
    return score(docs, fit(docs, labels, max_rows))
