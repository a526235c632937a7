"""Toxicity: a convolutional text classifier with thresholds calibrated by language.

A text's words (folded to lower case, cut at ASCII punctuation) are hashed to
two embeddings each, one of the whole word and one of its first bytes, and
added.  Filters of several widths run over the word vectors, each filter
keeps its largest response over the whole text, and a logistic unit on
those gives the logit.  The network learns from every labelled text of the
training fold: tasks of a Spark job each train a copy in numpy on their share of
the texts, and an aggregation averages the copies, row by row over the tasks that
changed a row, after each of ``ROUNDS`` passes.  Gradients flow through the maxima
only, so a step touches few embeddings.

Thresholds: every labelled text is judged by a network that has not seen it (one
network for each of ``FOLDS`` parts); from the counts of these logits, to three decimals, the cut
with the best F1 (at the true share of toxic texts) is found for each
language, and the score of the network trained on all parts is shifted so that this cut lies at ``THRESHOLD`` for every language.  The
language of a text is judged from its words alone, by word frequencies
counted over all labelled texts; the lang column of a scored row is never read.

Scoring is one map over the documents without a shuffle.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Scratch

BUCKETS = 1 << 15
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
PAD = max(WIDTHS) - 1
PREFIX = 6  # bytes
THRESHOLD = 0.7
FOLDS = 3
ROUNDS = 2  # passes over all labelled texts, where more than one task trains
SHARD = 8192  # labelled texts for each training task, until there are SHARDS of them
SHARDS = 64
SHAPES = [*((w, DIM, FILTERS) for w in WIDTHS), (FILTERS * len(WIDTHS),), (FILTERS * len(WIDTHS),), (1,)]
ROWS = 2 * BUCKETS + -(-sum(map(math.prod, SHAPES)) // DIM)  # of all parameters, laid out in rows of DIM
BLOCK = 4096  # rows averaged in one group
_SPLIT = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Words:
    """Word numbers of texts: whole word and first bytes, hashed; the memo is bounded."""

    def __init__(self, most: int = 200_000):
        self.memo: dict[bytes, int] = {}
        self.most = most

    def number(self, word: bytes) -> int:
        if len(self.memo) >= self.most:
            self.memo.clear()
        a = 1 + zlib.crc32(word) % (BUCKETS - 1)
        b = 1 + zlib.crc32(word[:PREFIX], 1) % (BUCKETS - 1)
        out = self.memo[word] = a * BUCKETS + b
        return out

    def of(self, text: str | None) -> np.ndarray:
        """One number per word of the whole text; a text without words gives one blank."""
        get, number = self.memo.get, self.number
        words = (text or "").lower().encode("utf-8", "replace").translate(_SPLIT).split()
        return np.array([get(w) or number(w) for w in words] or [0], np.int64)


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts laid end to end with blanks between, and where each begins and ends."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lens + PAD) - lens - PAD
    flat = np.zeros(int(lens.sum()) + PAD * len(texts), np.int64)
    for t, s in zip(texts, starts):
        flat[s:s + len(t)] = t
    return flat, starts, starts + lens


@dataclass
class Model:
    whole: np.ndarray  # BUCKETS x DIM
    prefix: np.ndarray
    filters: list[np.ndarray]  # by width: width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    langs: np.ndarray  # BUCKETS x languages, log frequencies of words
    cuts: np.ndarray  # logit cut by language

    def vectors(self, flat: np.ndarray) -> np.ndarray:
        return self.whole[flat // BUCKETS] + self.prefix[flat % BUCKETS]

    def responses(self, x: np.ndarray) -> list[np.ndarray]:
        """By width: the response of each filter at each word."""
        out = []
        for w in self.filters:
            n = len(x) - len(w) + 1
            r = x[:n] @ w[0]
            for j in range(1, len(w)):
                r += x[j:j + n] @ w[j]
            out.append(r)
        return out

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        flat, starts, ends = joined(texts)
        spans = np.ravel([starts, ends], order="F")
        pools = [np.maximum.reduceat(np.concatenate([r, np.full((PAD + 1, r.shape[1]), -np.inf, np.float32)]), spans)[::2]
                 for r in self.responses(self.vectors(flat))]
        h = np.maximum(np.concatenate(pools, axis=1) + self.bias, 0)
        return (h @ self.out + self.out_bias).astype(np.float64)

    def languages(self, texts: list[np.ndarray]) -> np.ndarray:
        """The likeliest language of each text by its words."""
        flat, starts, ends = joined(texts)
        sums = np.add.reduceat(self.langs[flat // BUCKETS], np.ravel([starts, ends - 1], order="F"))[::2] + self.langs[flat[ends - 1] // BUCKETS]
        return sums.argmax(1)

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(texts))
        for part in blocks(texts):
            some = [texts[i] for i in part]
            z = self.logits(some) - self.cuts[self.languages(some)] + math.log(THRESHOLD / (1 - THRESHOLD))
            out[part] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def blocks(texts: list[np.ndarray], words: int = 65_536) -> Iterator[list[int]]:
    """Row numbers in order, in blocks of about ``words`` words (one text at least)."""
    part, n = [], 0
    for i, t in enumerate(texts):
        if part and n + len(t) > words:
            yield part
            part, n = [], 0
        part.append(i)
        n += len(t)
    if part:
        yield part


class Adagrad:
    """Steps by accumulated squares, over the touched rows only."""

    def __init__(self, theta: np.ndarray, rate: float, seen: np.ndarray):
        self.theta, self.rate, self.seen = theta, rate, seen

    def step(self, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        if rows is None:
            self.seen += grad * grad
            self.theta -= self.rate * grad / np.sqrt(self.seen)
            return
        rows, at = np.unique(rows, return_inverse=True)
        total = np.zeros((len(rows), grad.shape[1]), np.float32)
        np.add.at(total, at, grad)
        self.seen[rows] += total * total
        self.theta[rows] -= self.rate * total / np.sqrt(self.seen[rows])


def views(flat: np.ndarray) -> list[np.ndarray]:
    """Whole words, prefixes, filters by width, bias, output and its bias in an array of ``ROWS`` rows."""
    rest, out, at = flat[2 * BUCKETS:].reshape(-1), [flat[:BUCKETS], flat[BUCKETS:2 * BUCKETS]], 0
    for shape in SHAPES:
        out.append(rest[at:at + math.prod(shape)].reshape(shape))
        at += math.prod(shape)
    return out


@dataclass
class State:
    """All parameters of a network in training and their accumulated squares."""
    theta: np.ndarray  # ROWS x DIM
    seen: np.ndarray

    @staticmethod
    def first(seed: int) -> "State":
        rng = np.random.default_rng(seed)
        state = State(np.zeros((ROWS, DIM), np.float32), np.full((ROWS, DIM), 1e-6, np.float32))
        whole, prefix, *filters, _, out, _ = views(state.theta)
        for part, scale in ((whole, 0.02), (prefix, 0.02), *((w, 1 / math.sqrt(w.shape[0] * DIM)) for w in filters),
                            (out, 1 / math.sqrt(len(out)))):
            part[:] = rng.normal(0, scale, part.shape)
        whole[0] = prefix[0] = 0
        return state

    def copy(self) -> "State":
        return State(self.theta.copy(), self.seen.copy())

    def model(self) -> Model:
        whole, prefix, *filters, bias, out, out_bias = views(self.theta)
        return Model(whole, prefix, filters, bias, out, float(out_bias[0]), np.zeros((BUCKETS, 1), np.float32), np.zeros(1))


def train(state: State, texts: list[np.ndarray], y: np.ndarray, class_weight: tuple[float, float], rng: np.random.Generator,
          epochs: int = 1, batch: int = 32, rate: float = 0.05, drop: float = 0.3) -> None:
    """``epochs`` rounds of steps over the texts with labels ``y``, in place.  ``drop`` of the words are blanked in a step."""
    model = state.model()
    out_bias = views(state.theta)[-1]
    steps = [Adagrad(p, rate, q) for p, q in zip(views(state.theta), views(state.seen))]
    weight = np.where(y == 1, class_weight[1], class_weight[0])
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    for _ in range(epochs):
        # texts of about the same length share a step
        order = np.argsort(np.log1p(lens) + rng.uniform(0, 0.7, len(texts)))
        parts = [order[lo:lo + batch] for lo in range(0, len(order), batch)]
        for p in rng.permutation(len(parts)):
            rows = parts[p]
            flat, starts, ends = joined([texts[i] for i in rows])
            flat = np.where(rng.random(len(flat)) < drop, 0, flat)
            x = model.vectors(flat)
            pooled, where = [], []
            for r in model.responses(x):
                at = np.stack([s + r[s:e].argmax(0) for s, e in zip(starts, np.minimum(ends, len(r)))])
                pooled.append(np.take_along_axis(r, at, 0))
                where.append(at)
            pre = np.concatenate(pooled, axis=1) + model.bias
            h = np.maximum(pre, 0)
            z = h @ model.out + out_bias[0]
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            gh = np.outer(g, model.out) * (pre > 0)
            touched, grads, gf = [], [], []
            for c, (w, at) in enumerate(zip(model.filters, where)):
                gc = gh[:, c * FILTERS:(c + 1) * FILTERS]
                gw = np.empty_like(w)
                for j in range(len(w)):
                    pos = at + j
                    gw[j] = np.einsum("nfd,nf->df", x[pos], gc)
                    touched.append(pos.ravel())
                    grads.append((gc[:, :, None] * w[j].T[None]).reshape(-1, DIM))
                gf.append(gw + 1e-4 * w)
            pos, gx = np.concatenate(touched), np.concatenate(grads)
            real = (flat[pos] > 0) & (np.abs(gx).max(1) > 0)
            pos, gx = flat[pos[real]], gx[real]
            if len(pos):
                steps[0].step(gx, pos // BUCKETS)
                steps[1].step(gx, pos % BUCKETS)
            for s, gw in zip(steps[2:], [*gf, gh.sum(0), h.T @ g + 1e-4 * model.out, g.sum(keepdims=True)]):
                s.step(gw)


def best_cut(z: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The logit cut with the best F1, midway between the two logits beside it; ``toxic`` and ``clean`` weigh at each logit."""
    order = np.argsort(-z)
    z, right, wrong = z[order], np.cumsum(toxic[order]), np.cumsum(clean[order])
    i = int((2 * right / (right + wrong + right[-1])).argmax())
    return float(z[i] - 0.5 if i + 1 == len(z) else (z[i] + z[i + 1]) / 2)


def training_fold(doc_id: Column) -> Column:
    """Rows whose label may be learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def labelled_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, fold, y, lang, ids): the words of every labelled text of the training fold.

    A document labelled both ways is left out; of rows that share a doc_id the
    smallest text counts.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            ids = [words.of(t.as_py()).astype(np.int32) for t in b.column(4)]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))],
                ["doc_id", "fold", "y", "lang", "ids"])

    sure = labels.where(F.col("doc_id").isNotNull() & training_fold(F.col("doc_id"))).groupBy("doc_id").agg(
        F.min("toxic").cast("int").alias("y"), F.max("toxic").cast("int").alias("z")).where("y = z AND y IN (0, 1)").select(
        "doc_id", "y")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.where(training_fold(F.col("doc_id"))).select(
        "doc_id", F.col("text").cast("string").alias("text"), lang.alias("lang")).join(sure, "doc_id")
    rows = rows.groupBy("doc_id", "y").agg(F.min(F.struct("text", "lang")).alias("t"))
    fold = F.pmod(F.crc32(F.concat(F.lit("fold"), F.col("doc_id").cast("string"))), F.lit(FOLDS)).cast("int")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), fold.alias("fold"), "y",
                       F.coalesce("t.lang", F.lit("")).alias("lang"), "t.text").mapInArrow(
        run, "doc_id long, fold int, y int, lang string, ids array<int>")


def texts_of(column: pa.Array) -> list[np.ndarray]:
    """The word numbers of each row."""
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    return [flat[a:z] for a, z in zip(ends[:-1], ends[1:])]


def train_copies(rows: DataFrame, k: int, state: State, class_weight: tuple[float, float], epochs: int | None, seed: int) -> DataFrame:
    """(k, block, shard, at, theta, seen): what each task's copy of ``state`` changed after it went over its rows.

    With ``epochs`` the rows of a task are gathered and gone over that often;
    without, each Arrow batch is one step of a single pass.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        now, rng, any_rows = state.copy(), np.random.default_rng([seed, shard]), False
        if epochs is not None:
            # of a stored table the order of files is not fixed
            table = pa.Table.from_batches(list(batches), _WORDS).sort_by("doc_id").combine_chunks()
            batches = table.to_batches(max_chunksize=max(1, len(table)))
        for b in batches:
            if len(b):
                any_rows = True
                train(now, texts_of(b.column(2)), b.column(1).to_numpy(), class_weight, rng, epochs or 1)
        if not any_rows:
            return
        changed = np.flatnonzero((now.seen != state.seen).any(axis=1))
        for block in np.unique(changed // BLOCK):
            at = changed[changed // BLOCK == block]
            theta, seen = (((new[at] - old[at]).astype(np.float32)).tobytes() for new, old in (
                (now.theta, state.theta), (now.seen, state.seen)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([int(block)], pa.int32()), pa.array([shard], pa.int32()),
                 pa.array([at.astype(np.int32).tobytes()]), pa.array([theta]), pa.array([seen])],
                ["k", "block", "shard", "at", "theta", "seen"])

    return rows.select("doc_id", "y", "ids").mapInArrow(run, "k int, block int, shard int, at binary, theta binary, seen binary")


_WORDS = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("ids", pa.list_(pa.int32()))])


def average(copies: pa.Table) -> pa.Table:
    """One row for the changes of a block of rows: each row's mean over the copies that changed it."""
    copies = copies.sort_by("shard")
    at = np.concatenate([np.frombuffer(v.as_py(), np.int32) for v in copies.column("at")])
    rows, into = np.unique(at, return_inverse=True)
    means = []
    for c in ("theta", "seen"):
        total = np.zeros((len(rows), DIM))
        np.add.at(total, into, np.concatenate([np.frombuffer(v.as_py(), np.float32) for v in copies.column(c)]).reshape(-1, DIM))
        means.append((total / np.bincount(into)[:, None]).astype(np.float32).tobytes())
    return pa.table({"k": copies.column("k")[:1], "at": pa.array([rows.astype(np.int32).tobytes()]),
                     "theta": pa.array([means[0]]), "seen": pa.array([means[1]])})


def train_all(words: DataFrame, n: dict[int, tuple[int, int]], epochs: int, min_steps: int, seed: int, shard: int) -> list[State]:
    """The networks that have not seen fold 0, 1, ..., and last the one that has seen all of ``words``.

    ``n`` has the clean and toxic texts of each fold; both classes weigh the same.  A network with up to ``shard`` texts is trained by one task
    in at least ``epochs`` rounds and at least about ``min_steps`` steps; with more, a task
    for each ``shard`` of them, ``SHARDS`` at most, makes ``ROUNDS`` passes.
    """
    states, jobs = [], []
    for k in range(FOLDS + 1):
        clean, toxic = (sum(c[i] for fold, c in n.items() if fold != k) for i in (0, 1))
        weight = ((clean + toxic) / (2 * max(1, clean)), (clean + toxic) / (2 * max(1, toxic)))
        tasks = min(SHARDS, max(1, -(-(clean + toxic) // shard)))
        rounds = max(epochs, -(-min_steps * 32 // max(1, clean + toxic))) if tasks == 1 else None
        states.append(State.first(seed + k))
        jobs.append((words.where(F.col("fold") != k).coalesce(tasks), weight, rounds))
    for step in range(1 if all(rounds for _, _, rounds in jobs) else ROUNDS):
        todo = [train_copies(rows, k, states[k], weight, rounds, seed + 101 * step + k)
                for k, (rows, weight, rounds) in enumerate(jobs) if step == 0 or rounds is None]
        copies = functools.reduce(DataFrame.unionByName, todo)
        done = copies.groupBy("k", "block").applyInArrow(average, "k int, at binary, theta binary, seen binary").toArrow()
        for k, at, theta, seen in zip(*(done.column(c).to_pylist() for c in ("k", "at", "theta", "seen"))):
            rows = np.frombuffer(at, np.int32)
            states[k].theta[rows] += np.frombuffer(theta, np.float32).reshape(-1, DIM)
            states[k].seen[rows] += np.frombuffer(seen, np.float32).reshape(-1, DIM)
    return states


def word_frequencies(words: DataFrame, langs: list[str]) -> np.ndarray:
    """Log frequency of each hashed word in each of ``langs``, smoothed; blanks count for none."""
    counts = np.full((BUCKETS, len(langs)), 0.1)
    if len(langs) > 1:
        at = {v: i for i, v in enumerate(langs)}
        each = words.where(F.col("lang").isin(langs)).select("lang", F.explode("ids").alias("id"))
        got = each.groupBy("lang", F.shiftright("id", BUCKETS.bit_length() - 1).alias("w")).agg(F.count(F.lit(1)).alias("n")).toArrow()
        counts[got.column("w").to_numpy(), [at[v] for v in got.column("lang").to_pylist()]] += got.column("n").to_numpy()
    out = np.log(counts / counts.sum(0))
    out[0] = 0
    return out.astype(np.float32)


def unseen_logits(words: DataFrame, states: list[State], langs: np.ndarray) -> pa.Table:
    """(lang, bin, toxic, clean): texts of each language by their logit, in thousandths, from the network that has not seen them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [s.model() for s in states[:FOLDS]]
        for m in models:
            m.langs = langs
        for b in batches:
            texts, fold, y = texts_of(b.column(2)), b.column(0).to_numpy(), b.column(1).to_numpy()
            out = []
            for k, m in enumerate(models):
                own = np.flatnonzero(fold == k)
                for part in blocks([texts[i] for i in own]):
                    some = [texts[i] for i in own[part]]
                    out.append(np.stack([m.languages(some), np.floor(np.clip(m.logits(some), -30, 30) * 1000), y[own[part]]]))
            if out:
                key, n = np.unique(np.concatenate(out, axis=1).astype(np.int32), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in key), pa.array(n, pa.int64())], ["lang", "bin", "y", "n"])

    found = words.select("fold", "y", "ids").mapInArrow(run, "lang int, bin int, y int, n long")
    return found.groupBy("lang", "bin").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"),
                                            F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("clean")).toArrow()


def fit(docs: DataFrame, labels: DataFrame, epochs: int = 4, min_steps: int = 800, seed: int = 11,
        shard: int = SHARD) -> Model | None:
    """Train and calibrate on every labelled text of the training fold; see ``train_all``.

    None where there are fewer than 16 of either class.  The driver holds
    networks, counts of words by language and counts of logits, none of which grow with the texts.
    """
    words = Scratch(docs.sparkSession, "toxicity").keep(labelled_words(docs, labels), "words")
    sizes = words.groupBy("fold", "lang").agg(F.count_if(F.col("y") == 0).alias("clean"), F.count_if(F.col("y") == 1).alias("toxic")).toArrow()
    n, by_lang = {}, {}
    for fold, lang, clean, toxic in zip(*(c.to_pylist() for c in sizes.columns)):
        n[fold] = tuple(map(sum, zip(n.get(fold, (0, 0)), (clean, toxic))))
        by_lang[lang] = by_lang.get(lang, 0) + clean + toxic
    if min((sum(c[i] for c in n.values()) for i in (0, 1)), default=0) < 16:
        return None
    common = sorted(v for v, c in by_lang.items() if c >= 20) or [""]
    langs = word_frequencies(words, common)
    states = train_all(words, n, epochs, min_steps, seed, shard)
    logits = unseen_logits(words, states, langs)
    model = states[-1].model()
    model.langs = langs
    model.cuts = language_cuts(*(logits.column(c).to_numpy() for c in ("lang", "bin", "toxic", "clean")), len(common), toxic_share(labels))
    return model


def toxic_share(labels: DataFrame) -> float:
    """Share of toxic rows among all labels of the training fold."""
    r = labels.where(training_fold(F.col("doc_id"))).agg(F.avg((F.col("toxic") == 1).cast("double")).alias("s")).first()
    return float(r["s"] or 0.5)


def language_cuts(lang: np.ndarray, bins: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n: int, share: float) -> np.ndarray:
    """A logit cut for each of ``n`` languages; those with under 20 texts of either class take the common cut."""
    at, into = np.unique(bins, return_inverse=True)
    heavy, light = share / toxic.sum(), (1 - share) / clean.sum()
    cuts = np.full(n, best_cut((at + 0.5) / 1000, np.bincount(into, toxic * heavy), np.bincount(into, clean * light)))
    for k in range(n):
        own = lang == k
        if min(toxic[own].sum(), clean[own].sum()) >= 20:
            cuts[k] = best_cut((bins[own] + 0.5) / 1000, toxic[own] * heavy, clean[own] * light)
    return cuts


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row, without a shuffle.

    Null and empty texts are scored as a text without words.  A null
    doc_id is not held out.  Repeated rows are scored alike.  Without a model (too few
    labels) every score is 0.5.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            if len(b):
                s = np.full(len(b), 0.5) if model is None else model.score([words.of(t.as_py()) for t in b.column(2)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, min_steps: int = 800) -> DataFrame:
    """Fit on ``labels`` and score every document; see ``fit`` and ``score``."""
    return score(docs, fit(docs, labels, min_steps=min_steps))
