"""String and text functions as native Column expressions (no Python UDFs).

Every function takes and returns a ``Column`` so that it stays inside
whole-stage codegen.  Java regex notes: ``\\z`` is the true end of input
(``$`` also matches before a final newline), ``\\p{Nd}`` is the Unicode
decimal digit class (Java ``\\d`` is ASCII only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.plan import compute_once

# Python ``str.isspace`` characters, as a Java regex class body.
PY_SPACE = r"\t\n\x0B\f\r\x1C-\x1F \u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# Python ``str.splitlines`` line boundaries (``\r\n`` first).
PY_LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C-\x1E\u0085\u2028\u2029]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()``: remove Python whitespace at both ends."""
    return F.regexp_replace(_c(col), f"^[{PY_SPACE}]+|[{PY_SPACE}]+\\z", "")


def collapse_ws(col) -> Column:
    """``' '.join(s.split())``: strip and collapse Python whitespace runs."""
    return F.trim(F.regexp_replace(_c(col), f"[{PY_SPACE}]+", " "))


def split_lines(col) -> Column:
    """``str.splitlines()``: no trailing empty item, ``''`` gives ``[]``."""
    c = _c(col)
    parts = F.split(c, PY_LINE_BREAK, -1)
    ends_with_break = c.rlike(f"(?:{PY_LINE_BREAK})\\z")
    return (
        F.when(c == "", F.array().cast("array<string>"))
        .when(ends_with_break, F.slice(parts, 1, F.size(parts) - 1))
        .otherwise(parts)
    )


# T1 ----------------------------------------------------------------------
def join_sentences(arr) -> Column:
    """Add ``.`` to every item not ending in one, join with one space."""
    return F.array_join(
        F.transform(_c(arr), lambda s: F.when(s.endswith("."), s).otherwise(F.concat(s, F.lit(".")))),
        " ",
    )


# T2 ----------------------------------------------------------------------
VALID_FIRST = r"^[a-zA-Z\p{Nd}$€:.,-]"
ALNUM_FIRST = r"^[a-zA-Z\p{Nd}]"


def is_valid_word(w: Column, strict: bool = False) -> Column:
    """Only the first character is tested (``re.match``), as the code does.

    ``strict=True`` is the documented meaning instead: every character must
    be in the allowed set.
    """
    if strict:
        first = w.rlike(r"^[a-zA-Z\p{Nd}$€:.,-]+\z")
    else:
        first = w.rlike(VALID_FIRST)
    return (F.length(w) > 0) & first & ((F.length(w) > 1) | w.rlike(ALNUM_FIRST))


# T3 ----------------------------------------------------------------------
def sanitize_word(w: Column) -> Column:
    """Drop one trailing symbol; ``x?.`` becomes ``x.``."""
    return F.when(w.endswith("."), F.regexp_replace(w, r"[^\p{L}\p{N}]\.\z", ".")).otherwise(
        F.regexp_replace(w, r"[^\p{L}\p{N}]\z", "")
    )


# T5 ----------------------------------------------------------------------
def sentence_marks(col) -> Column:
    """T5 + T1 on already-joined words (rule form of sentence split + join).

    After T3 a split at ``.`` changes nothing once the pieces are re-joined,
    so the visible effects are a ``.`` after a ``?``/``!`` run that ends a
    sentence and a final ``.`` when missing.  Empty text stays empty.
    """
    c = _c(col)
    marked = F.regexp_replace(c, r"([?!])( |\z)", "$1.$2")
    return F.when(c == "", F.lit("")).when(marked.endswith("."), marked).otherwise(F.concat(marked, F.lit(".")))


# T4 ----------------------------------------------------------------------
def process_text(col, strict: bool = False) -> Column:
    """T4: split on single spaces, keep valid words, sanitize, sentence-join."""
    words = F.split(_c(col), " ", -1)
    kept = F.transform(F.filter(words, lambda w: is_valid_word(w, strict)), sanitize_word)
    return sentence_marks(F.array_join(kept, " "))


# T6 ----------------------------------------------------------------------
def mention_key(col) -> Column:
    """Strip, lowercase, collapse whitespace."""
    return F.lower(collapse_ws(col))


# T7 / T8 -----------------------------------------------------------------
# The style-guide small words kept lowercase inside a title.
SMALL_WORDS = ["a", "an", "and", "as", "at", "but", "by", "en", "for", "if", "in", "of", "on", "or",
               "the", "to", "v", "v.", "via", "vs", "vs."]


def title_case(col) -> Column:
    """Title case of a single-space separated phrase (our pinned rule set).

    * a word with a capital after its first letter (``iPhone``, ``McDonald``)
      is kept as is, unless the whole phrase is upper case;
    * small words stay lower case except as first or last word;
    * otherwise the first letter or digit after leading punctuation is
      upper-cased and the rest kept (lower-cased first if the phrase is all
      upper case).
    Unlike ``initcap``, ``NASA of iPhone`` stays ``NASA of iPhone``.
    """
    c = _c(col)
    words = F.split(c, " ", -1)
    n = F.size(words)
    # Row-level values go into the zipped array once; a lambda that referred
    # to ``c`` directly would re-evaluate it for every word.
    zipped = F.arrays_zip(words.alias("w"), F.array_repeat(n, n).alias("n"),
                          F.array_repeat(c == F.upper(c), n).alias("caps"))
    small = F.array(*[F.lit(s) for s in SMALL_WORDS])

    def parts(e):
        w = e["w"]
        base = F.when(e["caps"], F.lower(w)).otherwise(w)
        lead = F.length(F.regexp_extract(base, r"^([^\p{L}\p{N}]*)", 1))
        kept = ~e["caps"] & w.rlike(r"^[^\p{L}\p{N}]*\p{L}+\p{Lu}")
        return F.struct(w.alias("w"), e["n"].alias("n"), base.alias("base"), lead.alias("lead"), kept.alias("kept"))

    def one(e, i):
        w, base, lead = e["w"], e["base"], e["lead"]
        edge = (i == 0) | (i == e["n"] - 1)
        capped = F.concat(F.substring(base, F.lit(1), lead), F.upper(F.substring(base, lead + 1, F.lit(1))),
                          F.substring(base, lead + 2, F.lit(1 << 30)))
        return (
            F.when(e["kept"], w)
            .when(~edge & F.array_contains(small, F.lower(w)), F.lower(w))
            .otherwise(capped)
        )

    # two passes: what a word's result reads several times is computed once
    return F.array_join(F.transform(F.transform(zipped, parts), one), " ")


def mention_forms(col) -> tuple[Column, Column, Column, Column]:
    """(m0, m1, m2, m3) as used by the candidate branches."""
    c = _c(col)
    m0 = collapse_ws(F.regexp_replace(py_strip(c), "^['\"]+|['\"]+\\z", ""))
    m1 = F.replace(m0, F.lit(" "), F.lit("_"))
    m2 = title_case(m0)
    m3 = F.replace(m2, F.lit(" "), F.lit("_"))
    return m0, m1, m2, m3


def with_mention_forms(df: DataFrame, col, keep: list[str]) -> DataFrame:
    """``keep`` and m0 to m3 of ``mention_forms``, the stripped text and its title case computed once a row."""
    m0 = mention_forms(col)[0]
    d = compute_once(compute_once(df, keep, m0=m0), [*keep, "m0"], m2=title_case(F.col("m0")))
    return d.select(*keep, "m0", F.replace("m0", F.lit(" "), F.lit("_")).alias("m1"), "m2",
                    F.replace("m2", F.lit(" "), F.lit("_")).alias("m3"))


# T11 / T12 -----------------------------------------------------------------
def last_url_segment(col) -> Column:
    """Page name as the last ``/`` segment."""
    return F.element_at(F.split(_c(col), "/", -1), -1)


def strip_prefix_fields(col, prefix_len: int) -> Column:
    """Drop a fixed-length line prefix, split on tabs."""
    return F.split(F.substring(py_strip(col), prefix_len + 1, 1 << 30), "\t", -1)
