"""Plan-shape helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, keep: list[str] | None = None, **cols: Column) -> DataFrame:
    """Evaluate ``cols`` once per row, behind a generator.

    A filter on a computed column is normally pushed below the projection
    that defines it, with the expression inlined, so a costly expression
    (a regex split of a whole page) runs once in the filter and again in
    the projection.  Predicates are not pushed through a ``Generate`` whose
    output they reference, so producing the columns with ``inline`` of a
    one-element array evaluates them exactly once.
    """
    keep = df.columns if keep is None else keep
    packed = F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))
    return df.select(*keep, F.inline(packed))


HOT_KEYS = 1000  # keys that may be split off: rows of a hash and a count
_TRACKED = 16_384  # keys each partial sketch keeps


def frequent_keys(df: DataFrame, keys: list[str], hot_rows: int, most: int = HOT_KEYS) -> DataFrame:
    """(_hot): hashes of the keys with about ``hot_rows`` rows or more, ``most`` of them at most.

    Found by a mergeable sketch of frequent items: one small state a task, no
    shuffle of keys.  A key the sketch loses has under one row in some ten thousand.
    """
    top = F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {most}, {_TRACKED})")
    items = df.agg(top.alias("t")).select(F.inline("t"))
    return items.where(F.col("item").isNotNull() & (F.col("count") >= hot_rows)).select(F.col("item").alias("_hot"))


def hot_split_join(big: DataFrame, small: DataFrame, keys: list[str], hot_rows: int,
                   counts: DataFrame | None = None, how: str = "inner", most: int = HOT_KEYS) -> DataFrame:
    """Join a key-skewed ``big`` side with a ``small`` side unique per key.

    Keys with at least ``hot_rows`` rows on the big side are joined against a
    broadcast copy of their ``small`` rows; there are at most ``most`` of them (the
    most frequent).  All other keys go through an ordinary shuffle join from
    which the hot rows have been split off, so no task receives a hot key.  Frequent
    keys are found by a sketch, or where the caller has counted rows per key
    (``counts`` with ``n_rows``), in its counts.  Keys are told apart by a hash here; a
    key that shares a hot one's hash is treated as hot too.  ``how`` is ``inner`` or ``left``.
    """
    if counts is None:
        hot = frequent_keys(big, keys, hot_rows, most)
    else:
        hot = counts.where(F.col("n_rows") >= hot_rows).orderBy(F.desc("n_rows")).limit(most).select(
            F.xxhash64(*keys).alias("_hot")).distinct()
    mark = F.xxhash64(*keys) == F.col("_hot")
    flagged = big.join(F.broadcast(hot), mark, "left")
    hot_small = F.broadcast(small.join(F.broadcast(hot), mark, "left_semi"))
    hot_part = flagged.where(F.col("_hot").isNotNull()).drop("_hot").join(hot_small, keys, how)
    cold_part = flagged.where(F.col("_hot").isNull()).drop("_hot").join(small, keys, how)
    return hot_part.unionByName(cold_part)
