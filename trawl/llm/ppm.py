"""Language-model scoring by prediction by partial matching over bytes.

Texts are scored as their lower-cased (A-Z) words joined by single spaces and
closed by one end symbol.  The model is every byte context up to ``ORDER``
bytes of the training documents; none is left out, so it grows with them.  A context predicts a
symbol it has seen c times among n symbols, d of them different, with
c / (n + d) and escapes to the next shorter context with d / (n + d) (method
C); symbols the longer context has seen are excluded there, and below the
empty context all remaining bytes are equally likely.

A code is a byte with the ``ORDER`` bytes before it.  The escape chain of
every code that occurs is folded into one log probability, so scoring looks
up the code of every byte and adds.

Passes: (1) a map packs documents into compressed blocks; the block's word and
code counts are cut into ranges, each a compressed pack of sorted differences;
(2) the packs of a range meet, their counts are added, codes are folded (all codes
of the same two bytes before the symbol are in one range, which holds every
longer context whole; of the shorter contexts the counts are one table of at
most 65,536 rows), and every block gets a pack back with the values of its own
words or codes; (3) each block meets its packs and is scored.  So a (block, code)
pair travels as a few bytes, once out and once back.  Word and code tables are never
broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Scratch

ORDER = 4
END = 10  # the end symbol, and what precedes a document's first byte
BLOCK_BYTES = 8 << 20
_PAD = bytes([END]) * ORDER
RANGE_TEXT = 32 << 20  # bytes of text to a range
PAIRS = 1 << 16  # two bytes: there are no more ranges than these
_PACK = "struct<is_code: boolean, part: int, names: binary, n: binary>"
_BLOCK = ("block long, doc_id array<long>, held_out array<boolean>, n_words array<long>, z binary, "
          f"packs array<{_PACK}>, two array<int>, two_n array<long>, train_docs long, train_words long")
_BLOCK_NAMES = ["block", "doc_id", "held_out", "n_words", "z", "packs", "two", "two_n", "train_docs", "train_words"]
_ANSWER = "of_block long, is_code boolean, names binary, value binary, kinds long"


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values and how often each occurs."""
    a = np.sort(a)
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    return a[first], np.diff(np.append(first, len(a)))


def _codes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The code of every byte after the first pad (its ORDER predecessors, oldest highest, and itself), and all bytes."""
    a = np.frombuffer(raw, np.uint8).astype(np.int64)
    code = np.zeros(len(a) - ORDER, np.int64)
    for k in range(ORDER + 1):
        code = (code << 8) | a[k:len(a) - ORDER + k]
    return code, a


def _planes(a: np.ndarray) -> bytes:
    """8-byte values by byte place, compressed."""
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unplanes(z: bytes, kind=np.int64) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).reshape(-1).view(kind)


def _sorted_names(a: np.ndarray) -> bytes:
    """Sorted values as the differences between them."""
    return _planes(np.diff(a, prepend=np.int64(0)))


def _names(z: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(z))


def _turn(code: np.ndarray) -> np.ndarray:
    """A code with the two bytes before the symbol in front, so that a range's codes lie close together; its own inverse is ``_code``."""
    return (code >> 8 & 0xFFFF) << 24 | (code >> 24) << 8 | code & 255


def _code(name: np.ndarray) -> np.ndarray:
    return (name >> 8 & 0xFFFF) << 24 | (name >> 24) << 8 | name & 255


def _packs(is_code: bool, names: np.ndarray, n: np.ndarray, parts: int) -> list[dict]:
    """Packs by range of sorted names with their counts; every range of words, the ranges of codes that have any."""
    two = names >> 24 if is_code else names.view(np.uint64) >> np.uint64(48)
    part = (two.astype(np.int64) * 40503 % PAIRS) * parts // PAIRS
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    out = []
    for p in range(parts):
        at = order[cuts[p]:cuts[p + 1]]
        if len(at) or not is_code:
            out.append({"is_code": is_code, "part": p, "names": _sorted_names(names[at]), "n": _planes(n[at])})
    return out


def _joined(parts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Documents with their pads and end symbols; where each one's scored bytes begin and end."""
    raw = b"".join(_PAD + p + b"\n" for p in parts)
    lens = np.fromiter((len(p) + ORDER + 1 for p in parts), np.int64, len(parts))
    stop = np.cumsum(lens)
    return raw, stop - lens + ORDER, stop


def _scored_codes(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all scored bytes of the texts in turn, and how many each text has."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw, begin, stop = _joined(parts)
    code, _ = _codes(raw)
    on = np.zeros(len(code) + 1, np.int8)
    on[begin - ORDER] += 1
    on[stop - ORDER] -= 1
    return code[np.cumsum(on[:-1], dtype=np.int8) > 0], stop - begin


def pack_blocks(docs: DataFrame, parts_of_all: int) -> DataFrame:
    """Blocks of documents with all their words and codes, counted in training rows (columns of ``_BLOCK``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3)
        ids, held, parts, n_words, size = [], [], [], [], 0

        def cut():
            raw = b"\n".join(parts)
            words = _hashes(raw.split())
            train = ~np.array(held)
            of_train = np.repeat(train, n_words)
            names, at = np.unique(words, return_inverse=True)
            count = np.bincount(at, weights=of_train, minlength=len(names)).astype(np.int64)
            learnt, times = _distinct(_scored_codes([p for p, t in zip(parts, train) if t])[0])
            others, _ = _distinct(_scored_codes([p for p, t in zip(parts, train) if not t])[0])
            codes = np.union1d(learnt, others)
            code_n = np.zeros(len(codes), np.int64)
            code_n[np.searchsorted(codes, learnt)] = times
            turned = _turn(codes)
            order = np.argsort(turned)
            packs = _packs(True, turned[order], code_n[order], parts_of_all) + _packs(False, names, count, parts_of_all)
            two = np.bincount(learnt & 0xFFFF, weights=times, minlength=PAIRS)
            some = np.flatnonzero(two)
            row = [uuid.uuid4().int >> 65, list(ids), list(held), list(n_words), squeeze.compress(raw), packs, some,
                   two[some].astype(np.int64), int(train.sum()), int(count.sum())]
            ids.clear(), held.clear(), parts.clear(), n_words.clear()
            pack = pa.struct([("is_code", pa.bool_()), ("part", pa.int32()), ("names", pa.binary()), ("n", pa.binary())])
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(),
                     pa.list_(pack), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)],
                                              _BLOCK_NAMES)

        for b in batches:
            for doc, out, text in zip(*(c.to_pylist() for c in b.columns)):
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                part = b" ".join(words)
                if size + len(part) > BLOCK_BYTES and ids:
                    yield cut()
                    size = 0
                ids.append(doc), held.append(out), parts.append(part), n_words.append(len(words))
                size += len(part) + 1
        if ids:
            yield cut()

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, _BLOCK)


def fold(code: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of every code from its training count ``n`` (0: not in training).

    ``code`` has no repeats and holds all codes of the two bytes before the
    symbol that it has any of; ``pairs`` has the counts of (byte, next byte).
    The symbols a context has seen are among those of the next shorter one,
    so what is excluded there is the longer context's own symbols: ``gone_n``
    and ``gone_kinds`` are their counts in the shorter context.
    """
    sym, last = code & 255, code >> 8 & 255
    singles = pairs.sum(0)
    count, total, kinds, gone_n = [singles[sym]], [np.full(len(code), singles.sum())], [np.full(len(code), (singles > 0).sum())], []
    count.append(pairs[last, sym])
    total.append(pairs.sum(1)[last])
    kinds.append((pairs > 0).sum(1)[last])
    gone_n.append(((pairs > 0) * singles).sum(1)[last])
    for k in range(2, ORDER + 1):
        key, first, at = np.unique(code & ((1 << 8 * (k + 1)) - 1), return_index=True, return_inverse=True)
        c = np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)
        of = np.cumsum(np.append(False, key[1:] >> 8 != key[:-1] >> 8)) if len(key) else np.zeros(0, np.int64)
        count.append(c[at])
        total.append(np.bincount(of, weights=c).astype(np.int64)[of][at])
        kinds.append(np.bincount(of, weights=c > 0).astype(np.int64)[of][at])
        gone_n.append(np.bincount(of, weights=(c > 0) * count[k - 1][first]).astype(np.int64)[of][at])
    p, escape, found = np.zeros(len(code)), np.ones(len(code)), np.zeros(len(code), bool)
    gone_n.append(np.zeros(len(code), np.int64))
    gone_kinds = np.zeros(len(code), np.int64)
    for k in range(ORDER, -1, -1):
        left = kinds[k] - gone_kinds
        both = np.maximum(total[k] - gone_n[k] + left, 1)
        hit = ~found & (count[k] > 0)
        p = np.where(hit, escape / both * count[k], p)
        found |= hit
        escape = np.where(left > 0, escape * left / both, escape)
        gone_kinds = kinds[k]
    return np.log10(np.where(found, p, escape / np.maximum(256 - kinds[0], 1)))


def _add(names: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names and the sums of their counts."""
    every, at = np.unique(np.concatenate(names), return_inverse=True)
    return every, np.bincount(at, weights=np.concatenate(n), minlength=len(every)).astype(np.int64)


def answer_packs(packs: DataFrame, pairs: np.ndarray, piece: int = 4 << 20) -> DataFrame:
    """A pack back for every (block, is_code, part, names, n): the counts of its words, or the log probabilities of its codes.

    ``kinds`` tells how many different training words the range has.  The packs of one range are held as they came,
    compressed, and are opened ``piece`` names at a time.
    """
    def answer(is_code, rows):
        every, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        names, n, size = [every], [total], 0
        for _, z, c in rows:
            names.append(_names(z))
            n.append(_unplanes(c))
            size += len(n[-1])
            if size > piece:
                every, total = _add(names, n)
                names, n, size = [every], [total], 0
        every, total = _add(names, n)
        value = fold(_code(every), total, pairs) if is_code else total
        kinds = 0 if is_code else int((total > 0).sum())
        for block, z, _ in rows:
            own = value[np.searchsorted(every, _names(z))]
            yield block, is_code, z, _planes(own), kinds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64()]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              ["of_block", "is_code", "names", "value", "kinds"])

        group, held = None, []
        for b in batches:
            for is_code, part, block, names, n in zip(*(c.to_pylist() for c in b.columns)):
                if (is_code, part) != group:
                    if held:
                        yield table(list(answer(group[0], held)))
                    group, held = (is_code, part), []
                held.append((block, names, n))
        if held:
            yield table(list(answer(group[0], held)))

    rows = packs.select("is_code", "part", "block", "names", "n")
    return rows.repartition("is_code", "part").sortWithinPartitions("is_code", "part").mapInArrow(run, _ANSWER)


def text_scores(parts: list[bytes], codes: np.ndarray, logp: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """log10 probability of every text (words joined by spaces), its end included; ``codes`` is sorted and has all of theirs."""
    code, sizes = _scored_codes(parts)
    got = np.concatenate([logp[np.searchsorted(codes, code[lo:lo + piece])] for lo in range(0, len(code), piece)])
    return np.add.reduceat(got, np.append(0, np.cumsum(sizes)[:-1]))


def score_documents(docs: DataFrame) -> DataFrame:
    """Base and model score of every whole text, learning from rows whose crc32(doc_id) mod 10 is not 0.

    Words are counted by their 64-bit hashes.  A null text counts as empty
    (its end symbol alone); a null doc_id is a training row; rows that repeat
    count and score as often as they occur; other columns are ignored.  With
    no training rows the model spreads evenly over the 256 bytes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ppm")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    blocks = scratch.keep(pack_blocks(docs, min(PAIRS, max(8, -(-size // RANGE_TEXT)))), "blocks")
    trained = blocks.agg(F.sum("train_docs").alias("d"), F.sum("train_words").alias("w")).first()
    n_docs = trained["d"] or 0
    n_train = (trained["w"] or 0) + n_docs
    pairs = np.zeros((256, 256), np.int64)
    two = blocks.select(F.explode(F.arrays_zip("two", "two_n")).alias("p")).groupBy("p.two").agg(F.sum("p.two_n").alias("n"))
    for r in two.collect():  # at most 65,536 rows
        pairs[r["two"] >> 8, r["two"] & 255] = r["n"]
    answers = answer_packs(blocks.select("block", F.inline("packs")), pairs)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        kinds_ = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        codes, logp = [np.zeros(0, np.int64)], [np.zeros(0)]
        known, c, kinds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], int(n_docs > 0)
        for is_code, names_, value, more in zip(*(right.column(x).to_pylist() for x in ("is_code", "names", "value", "kinds"))):
            if is_code:
                codes.append(_code(_names(names_)))
                logp.append(_unplanes(value, np.float64))
            else:
                known.append(_names(names_))
                c.append(_unplanes(value))
                kinds += more
        codes, logp, known, c = map(np.concatenate, (codes, logp, known, c))
        order = np.argsort(codes)
        codes, logp = codes[order], logp[order]
        order = np.argsort(known)
        known, c = np.append(known[order], np.iinfo(np.int64).max), np.append(c[order], 0)
        out = []
        whole = np.log10(n_train + 0.1 * (kinds + 1))
        for doc_id, held, n_words, z in zip(*(left.column(x).to_pylist() for x in ("doc_id", "held_out", "n_words", "z"))):
            raw = zstandard.ZstdDecompressor().decompress(z)
            words = _hashes(raw.split())
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            times = np.where(known[at] == words, c[at], 0)
            n_words = np.array(n_words, np.int64)
            edge = np.append(0, np.cumsum(n_words))
            hits = np.append(0, np.cumsum(times > 0))
            logs = np.append(0.0, np.log10(times + 0.1))
            base = np.array([logs[a + 1:b + 1].sum() for a, b in zip(edge[:-1], edge[1:])])
            base += np.log10(n_docs + 0.1) - (n_words + 1) * whole
            known_n = hits[edge[1:]] - hits[edge[:-1]] + (n_docs > 0)
            model = text_scores(raw.split(b"\n"), codes, logp)
            out.append(pa.table([pa.array(x, t) for x, t in zip(
                (doc_id, held, n_words + 1, known_n, np.full(len(n_words), n_train), base, model),
                kinds_)], names=names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in kinds_], names=names)

    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    left = blocks.select("block", "doc_id", "held_out", "n_words", "z")
    return left.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(run, schema)
