"""Precision, recall and F1 of predictions against a gold standard.

Inputs are line tables ``(value string, line_no bigint)``; ``line_no`` is
the line order, needed because the last line of a key wins (E6).  The
result is one row: gold, predicted, correct, precision, recall, f1 (null
instead of a division error when a count is zero).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.text import py_strip

KEY = ["record", "string"]


def _kept(lines: DataFrame, kind: str, strict: bool) -> DataFrame:
    """Lines containing the type word (anywhere, or as prefix if strict)."""
    cond = F.col("value").startswith(kind) if strict else F.col("value").contains(kind)
    return lines.where(cond).select(py_strip(F.col("value")).alias("line"), "line_no")


def _last(df: DataFrame, cols: list[str]) -> DataFrame:
    """The last line per (record, string) wins."""
    best = F.max_by(F.struct(*cols), F.col("line_no"))
    return df.groupBy(*KEY).agg(best.alias("v")).select(
        *KEY, *[F.col(f"v.{c}").alias(c) for c in cols], F.lit(True).alias("line_present"))


def gold_entities(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``ENTITY: record<TAB>string<TAB>entity``, exactly 3 fields, else skipped."""
    k = _kept(lines, "ENTITY", strict)
    whole = F.split("line", "\t", -1)
    parts = F.split(F.substring("line", 9, 1 << 30), "\t", -1)
    p = k.where(F.size(whole) == 3).select(
        parts[0].alias("record"), parts[1].alias("string"), parts[2].alias("entity"), "line_no")
    return _last(p, ["entity"])


def pred_entities(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Predicted entity lines (3 fields after the prefix)."""
    k = _kept(lines, "ENTITY", strict)
    parts = F.split(F.substring("line", 9, 1 << 30), "\t", -1)
    p = k.where(F.size(parts) == 3).select(
        parts[0].alias("record"), parts[1].alias("string"), parts[2].alias("entity"), "line_no")
    return _last(p, ["entity"])


def gold_relations(lines: DataFrame, strict: bool = False) -> DataFrame:
    """``record type string s o rel_id`` (6 tab fields, no prefix)."""
    k = _kept(lines, "RELATION", strict)
    parts = F.split("line", "\t", -1)
    p = k.where(F.size(parts) == 6).select(
        parts[0].alias("record"), parts[2].alias("string"), parts[3].alias("s"), parts[4].alias("o"),
        parts[5].alias("rel_id"), "line_no")
    return _last(p, ["s", "o", "rel_id"])


def pred_relations(lines: DataFrame, strict: bool = False) -> DataFrame:
    """E5: ``RELATION: record s o string [rel_id]`` (rel_id null when absent)."""
    k = _kept(lines, "RELATION", strict)
    parts = F.split(F.substring("line", 11, 1 << 30), "\t", -1)
    p = k.where(F.size(parts).isin(4, 5)).select(
        parts[0].alias("record"), parts[3].alias("string"), parts[1].alias("s"), parts[2].alias("o"),
        F.get(parts, 4).alias("rel_id"), "line_no")
    return _last(p, ["s", "o", "rel_id"])


def skipped(lines: DataFrame, kind: str, role: str, strict: bool = False) -> DataFrame:
    """The lines of the wanted kind that E2-E5 do not take, as their number of fields is wrong."""
    k = _kept(lines, kind, strict)
    whole = F.size(F.split("line", "\t", -1))
    fits = {("ENTITY", "gold"): whole == 3, ("RELATION", "gold"): whole == 6,
            ("ENTITY", "pred"): F.size(F.split(F.substring("line", 9, 1 << 30), "\t", -1)) == 3,
            ("RELATION", "pred"): F.size(F.split(F.substring("line", 11, 1 << 30), "\t", -1)).isin(4, 5)}
    return k.where(~fits[kind, role])


def score(gold: DataFrame, pred: DataFrame, kind: str = "ENTITY", strict: bool = False) -> DataFrame:
    """E7-E10 -> one row (gold, predicted, correct, precision, recall, f1)."""
    if kind == "ENTITY":
        g, p = gold_entities(gold, strict), pred_entities(pred, strict)
        same = F.col("g.entity") == F.col("p.entity")
    elif kind == "RELATION":
        g, p = gold_relations(gold, strict), pred_relations(pred, strict)
        same = (F.col("g.s") == F.col("p.s")) & (F.col("g.o") == F.col("p.o"))
    else:
        raise ValueError("kind must be ENTITY or RELATION")
    # One full outer join on the key and one aggregation give all three counts.
    both = g.alias("g").join(p.alias("p"), KEY, "full_outer")
    row = both.agg(
        F.count(F.col("g.line_present")).alias("gold"),
        F.count(F.col("p.line_present")).alias("predicted"),
        F.count_if(F.col("g.line_present").isNotNull() & F.col("p.line_present").isNotNull() & same)
        .alias("correct"),
    )
    prec = F.try_divide(F.col("correct").cast("double"), F.col("predicted").cast("double"))
    rec = F.try_divide(F.col("correct").cast("double"), F.col("gold").cast("double"))
    return row.select(
        "gold", "predicted", F.coalesce("correct", F.lit(0)).cast("bigint").alias("correct"),
        prec.alias("precision"), rec.alias("recall"),
        F.try_divide(2 * prec * rec, prec + rec).alias("f1"),
    )
