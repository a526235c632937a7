"""Sentences in blocks, whose words are looked up once a block.

A block is what one task has met, up to a bound: the distinct tokens, and for
each sentence the numbers of its tokens.  Only the distinct tokens are joined
with a table of words; the sentences travel as numbers, about a byte and
a half a token, to where the answers of their block are, and are put together there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trawl.operators.names import slices
from trawl.session import stored

TOKENS = 8_000_000  # tokens of a block
WORDS = 400_000  # distinct tokens at which a block ends
KEPT = 64_000_000  # bytes of the other columns of a block


def squeezed(numbers: np.ndarray) -> bytes:
    """Numbers under 2**32, their lowest bytes first: the higher ones are nearly all zero."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def restored(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    planes = np.frombuffer(pa.decompress(b[8:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Numbers:
    """Distinct tokens (a null is one of them), numbered as they are met."""

    def __init__(self) -> None:
        self.at: dict[str | None, int] = {}

    def of(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the distinct ones of ``tokens``, and for each of ``tokens`` its place among them."""
        coded = tokens.dictionary_encode("encode")
        local = [self.at.setdefault(w, len(self.at)) for w in coded.dictionary.to_pylist()]
        return np.array(local, np.int64), coded.indices.to_numpy(zero_copy_only=False)


def list_lengths(lists: pa.Array) -> np.ndarray:
    """Items of each list; a null list has none."""
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def pack(sents: DataFrame, keep: list[str], tokens: int = TOKENS, run: tuple[str, str] | None = None) -> DataFrame:
    """(block, words, codes, lens, kept): a row a batch of sentences, and a last one a block with its distinct tokens.

    With ``run``, a pair of columns of ``keep``, rows with ``run`` alone have the first of the pair once for each
    row before which it is another or the second does not rise; rows with a null are passed over.
    """
    kind = sents.schema[run[0]].dataType if run else T.NullType()
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("words", T.ArrayType(T.StringType())),
                           *(T.StructField(c, T.BinaryType()) for c in ("codes", "lens", "kept")),
                           *([T.StructField("run", kind)] if run else [])])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done, numbers, n, size = TaskContext.get().partitionId() << 32, 0, Numbers(), 0, 0
        before: tuple | None = None

        def row(words=None, codes=None, lens=None, kept=None, runs: pa.Array | None = None) -> pa.RecordBatch:
            m = 1 if runs is None else len(runs)
            cols = [pa.array([first + done] * m), pa.array([words] * m, pa.list_(pa.string())), *(pa.array([x] * m, pa.binary()) for x in (codes, lens, kept))]
            if run:
                cols.append(pa.nulls(m, key_type) if runs is None else runs)
            return pa.RecordBatch.from_arrays(cols, schema.names)

        for b in (part for whole in batches for part in slices(whole, len(keep), tokens)):
            if run:
                key, at = b.column(keep.index(run[0])), b.column(keep.index(run[1]))
                key_type, begins = key.type, []
                for i, here in enumerate(zip(key.to_pylist(), at.to_pylist())):
                    if None in here:
                        continue
                    if before is None or before[0] != here[0] or before[1] >= here[1]:
                        begins.append(i)
                    before = here
                if begins:
                    yield row(runs=key.take(pa.array(begins)))
            lists, rest = b.column(len(keep)), pa.RecordBatch.from_arrays(b.columns[:len(keep)], keep)
            number, place = numbers.of(lists.flatten())
            codes, sink = number[place], pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rest)
            yield row(None, squeezed(codes), squeezed(list_lengths(lists)), sink.getvalue().to_pybytes())
            n, size = n + len(codes), size + rest.nbytes
            if n >= tokens or len(numbers.at) >= WORDS or size >= KEPT:
                yield row(list(numbers.at))
                done, numbers, n, size = done + 1, Numbers(), 0, 0
        if numbers.at:
            yield row(list(numbers.at))

    return sents.select(*keep, "tokens").mapInArrow(packed, schema)


def with_answers(sents: DataFrame, keep: list[str], ask: Callable[[DataFrame], DataFrame], field: T.StructField,
                 decode: Callable[[pa.Table], Callable[[np.ndarray, np.ndarray, pa.Table], pa.Array]], tokens: int = TOKENS,
                 run: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The columns ``keep`` of ``sents`` and ``field``, computed from its ``tokens`` and what is known of them.

    ``ask`` gets (block, i, tok), token ``i`` of a block, and returns rows with block and i,
    none or more a token.  ``decode`` gets those of one block and returns what
    makes the column from the numbers of the tokens, end to end, the lengths of the sentences and their kept columns.
    With ``run`` (of ``pack``) the second table has the values of its first column, one row a run.
    """
    schema = T.StructType([*(sents.schema[c] for c in keep), field])
    rows = stored(pack(sents, keep, tokens, run), "blocks")
    asked = rows.where(F.col("words").isNotNull()).select("block", F.posexplode("words").alias("i", "tok"))
    answers = ask(asked).withColumnRenamed("block", "_asked")
    target = to_arrow_schema(schema)

    def put(parts: pa.Table, found: pa.Table) -> pa.Table:
        column, done = decode(found), []
        for p in parts.to_batches():
            for _, codes, lens, kept in zip(*(c.to_pylist() for c in p.columns)):
                rest = pa.ipc.open_stream(kept).read_all()
                done.append(rest.append_column(field.name, column(restored(codes), restored(lens), rest)))
        return pa.concat_tables(done).cast(target) if done else target.empty_table()

    sentences = rows.where(F.col("codes").isNotNull()).select("block", "codes", "lens", "kept")
    out = sentences.groupBy("block").cogroup(answers.groupBy("_asked")).applyInArrow(put, schema)
    return out, rows.where(F.col("run").isNotNull()).select(F.col("run").alias(run[0])) if run else None


def joined(letters: pa.Array, lens: np.ndarray) -> pa.Array:
    """The letters of each sentence as one string."""
    import pyarrow.compute as pc

    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), letters), "")


def _counted(numbers: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, all less than ``below``, and how often each occurs."""
    if below > 20_000_000:
        return np.unique(numbers, return_counts=True)
    n = np.bincount(numbers)
    found = np.flatnonzero(n)
    return found, n[found]


def counted_tokens(tagged: DataFrame, edge: str | None = None, tokens: int = TOKENS) -> DataFrame:
    """(t, tag, n, before): how often a token has a tag in (tokens, pos) rows, one row a task at least; pos has a letter a token.

    With ``edge``, rows with ``before`` count the letters that follow that letter, ``edge`` standing before the first and
    after the last of a row; in all others it is null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, n = Numbers(), 0
        seen: dict[str, int] = {}
        pairs: dict[tuple[str, str], int] = {}
        codes: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def merge() -> None:
            keys, which = np.unique(np.concatenate(codes), return_inverse=True)
            counts[:] = [np.bincount(which, np.concatenate(counts)).astype(np.int64)]
            codes[:] = [keys]

        def rows() -> Iterator[pa.RecordBatch]:
            merge()
            words, letters = pa.array(list(numbers.at), pa.string()), pa.array(list(seen), pa.string())
            for lo in range(0, len(codes[0]), 100_000):
                c, m = codes[0][lo:lo + 100_000], counts[0][lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays([words.take(pa.array(c >> 21)), letters.take(pa.array(c & 0x1FFFFF)), pa.array(m),
                                                  pa.nulls(len(c), pa.string())], ["t", "tag", "n", "before"])

        for b in (part for whole in batches for part in slices(whole, 0, tokens)):
            number, place = numbers.of(b.column(0).flatten())
            points = np.frombuffer("".join(b.column(1).to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
            kinds = np.flatnonzero(np.bincount(points))
            k = len(kinds)
            at = np.zeros(kinds.max(initial=0) + 1, np.int64)
            at[kinds] = np.arange(k)
            which = at[points]
            letter = np.array([seen.setdefault(chr(x), len(seen)) for x in kinds], np.int64)
            both = place.astype(np.int64) * k + which
            found, m = _counted(both, len(number) * k)
            codes.append((number[found // k] << 21) | letter[found % k])
            counts.append(m)
            if edge is not None:
                ends = np.cumsum(list_lengths(b.column(0)))
                after = np.insert(which, np.concatenate([[0], ends]), k)  # one edge between rows serves both
                names = [*map(chr, kinds), edge]
                for x, y in zip(*(v.tolist() for v in _counted(after[:-1] * (k + 1) + after[1:], (k + 1) ** 2))):
                    pair = names[x // (k + 1)], names[x % (k + 1)]
                    pairs[pair] = pairs.get(pair, 0) + y
            n += len(place)
            if len(codes) > 32:
                merge()
            if n >= tokens or len(numbers.at) >= WORDS:
                yield from rows()
                numbers, n, codes, counts = Numbers(), 0, [], []
        if codes:
            yield from rows()
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.string()), pa.array([p[1] for p in pairs]),
                                              pa.array([*pairs.values()], pa.int64()), pa.array([p[0] for p in pairs])],
                                             ["t", "tag", "n", "before"])

    rows = tagged.where((F.size("tokens") > 0) & (F.size("tokens") == F.length("pos"))).select("tokens", "pos")
    return rows.mapInArrow(run, "t string, tag string, n long, before string")
