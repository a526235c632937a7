"""R1-R6 (+F9, F10): verb-phrase relations between the nearest entities.

Input: one row per sentence with ``tokens``, optional ``ws`` (trailing
whitespace per token), ``pos`` (one letter per token, see
``annotate.POS_CODES``) and ``ents`` (entity spans sorted by start, token
offsets within the sentence).  Everything up to the two link joins runs
inside each row with higher-order functions: no shuffle, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.plan import compute_once
from trawl.operators.patterns import pattern_spans

NOMINAL = "XNM"  # PROPN, NOUN, NUM (F9)


def pattern_regex(pattern: list[dict] | None = None) -> str:
    """A token pattern (list of dicts with POS / IN / OP) as a one-letter regex.

    Supports ``POS`` (a tag), ``POS: {"IN": [...]}`` and ``OP`` ``?``/``*``/``+``.
    The default is the verb-phrase pattern
    ``VERB PART? ADV? (ADJ|ADV|NOUN|PRON|DET)* (PART|ADP)?``.
    """
    from trawl.operators.annotate import POS_CODES

    if pattern is None:  # fixed values: the verb phrase
        pattern = [
            {"POS": "VERB"},
            {"POS": "PART", "OP": "?"},
            {"POS": "ADV", "OP": "?"},
            {"POS": {"IN": ["ADJ", "ADV", "NOUN", "PRON", "DET"]}, "OP": "*"},
            {"POS": {"IN": ["PART", "ADP"]}, "OP": "?"},
        ]
    out = []
    for tok in pattern:
        pos = tok["POS"]
        tags = pos["IN"] if isinstance(pos, dict) else [pos]
        letters = "".join(POS_CODES[t] for t in tags)
        atom = letters if len(letters) == 1 else f"[{letters}]"
        out.append(atom + tok.get("OP", ""))
    return "^" + "".join(out)


def nominal_entities(ents: Column, pos: Column) -> Column:
    """keep entities with at least one PROPN/NOUN/NUM token."""
    return F.filter(ents, lambda e: F.substring(pos, e["start"] + 1, e["end"] - e["start"]).rlike(f"[{NOMINAL}]"))


def phrase_spans(pos: Column, regex: str | None = None) -> Column:
    """R2: array<struct<start, len>>: pattern matches, longer first, then earlier, without overlaps.

    A match of the default pattern holds exactly one verb, its first token, so
    matches of different verbs never overlap: one pass over the letters finds
    them, and the greedy regex gives the longest match per verb.  For any other
    pattern see ``patterns``.
    """
    pos = F.coalesce(pos, F.lit(""))
    rx = (regex or pattern_regex()).removeprefix("^")
    if rx == pattern_regex().removeprefix("^"):
        return _matches_in_order(pos, rx)
    return pattern_spans(pos, rx)


def _matches_in_order(pos: Column, rx: str) -> Column:
    """Leftmost matches of ``rx``; the pieces between them give the positions."""
    none = F.array().cast("array<struct<start:int,len:int>>")
    parts = F.arrays_zip(F.regexp_extract_all(pos, F.lit(rx), F.lit(0)).alias("m"), F.split(pos, rx, -1).alias("gap"))

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        size = F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), size.alias("len")))
        return F.struct((start + size).alias("at"), F.when(size > 0, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def span_text(tokens: Column, ws: Column | None, start: Column, length: Column) -> Column:
    """Tokens of a span with their original spacing, no trailing space."""
    toks = F.slice(tokens, start + 1, length)
    if ws is None:
        return F.array_join(toks, " ")
    spaces = F.slice(ws, start + 1, length - 1)
    body = F.array_join(F.transform(F.arrays_zip(F.slice(toks, 1, length - 1).alias("t"), spaces.alias("w")),
                                    lambda z: F.concat(z["t"], z["w"])), "")
    return F.concat(body, F.try_element_at(toks, F.lit(-1)))


def sentence_relations(sents: DataFrame, regex: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """R1-R4 + F9/F10 -> (key, sent, start, len, e1, rel, e2) per matched phrase.

    F10 (two entities needed) is applied before the phrase regex runs.
    """
    keep = keep or []
    has_ws = "ws" in sents.columns
    s = compute_once(sents, keep=["key", "sent", *keep, "tokens", *(["ws"] if has_ws else []), "pos"],
                     ents=nominal_entities(F.col("ents"), F.col("pos")))
    s = compute_once(s.where(F.size("ents") >= 2), phrases=phrase_spans(F.col("pos"), regex))

    def nearest(ph):
        left = F.try_element_at(F.filter("ents", lambda e: e["start"] < ph["start"]), F.lit(-1))
        right = F.get(F.filter("ents", lambda e: e["start"] >= ph["start"]), 0)
        return F.struct(ph["start"].alias("start"), ph["len"].alias("len"), left["text"].alias("e1"),
                        right["text"].alias("e2"))

    r = s.select("key", "sent", *keep, "tokens", *(["ws"] if has_ws else []),
                 F.explode(F.transform("phrases", nearest)).alias("r"))
    r = r.where(F.col("r.e1").isNotNull() & F.col("r.e2").isNotNull())
    ws = F.col("ws") if has_ws else None
    return r.select("key", "sent", *keep, F.col("r.start").cast("bigint").alias("start"),
                    F.col("r.len").cast("bigint").alias("len"), F.col("r.e1").alias("e1"),
                    F.lower(span_text(F.col("tokens"), ws, F.col("r.start"), F.col("r.len"))).alias("rel"),
                    F.col("r.e2").alias("e2"))


def linked_relations(rels: DataFrame, entities: DataFrame) -> DataFrame:
    """R5 + R6: both ends linked on the same page; mentions replaced by links.

    Two equi-joins on (key, mention); duplicates are kept (a bag).
    """
    e1 = entities.select("key", F.col("mention").alias("e1"), F.col("link").alias("link1"))
    e2 = entities.select("key", F.col("mention").alias("e2"), F.col("link").alias("link2"))
    return rels.join(e1, ["key", "e1"]).join(e2, ["key", "e2"]).select(
        "key", "sent", "start", "e1", "e2", "link1", "link2", "rel")
