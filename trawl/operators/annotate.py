"""Tokens, sentences, part of speech and mentions as data jobs.

The neural annotator of the original is a per-row model library; here the
same outputs come from table jobs, with a plug for a user model:

* N1 ``tokenize``: rule tokenizer (words, numbers, single punctuation
  characters) with each token's trailing whitespace, so spans can be
  printed with their original spacing;
* N2 sentence split on tokens, sentencizer rule: a sentence ends after a
  ``. ! ?`` token plus any punctuation tokens that follow; done inside each
  row with array/regex functions (no window, no shuffle of the tokens); the dots
  of abbreviations learnt by ``abbrev`` may be left out;
* N5 ``pos_lexicon`` / ``tag_tokens``: most frequent tag per word from any
  tagged table, suffix rules for unknown words; ``tagger`` decides by context;
* N3 ``gazetteer_mentions``: names found by a token trie inside each page (``names``);
* N4 ``longest_spans``: longest-first, then earliest, non-overlapping;
* N6 ``annotate_with``: ``mapInPandas`` around a user function.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.functions.plan import compute_once
from trawl.operators.abbrev import guard_dots, unguard
from trawl.operators.blocks import joined, with_answers
from trawl.operators.names import NameIndex, find_names, is_word
from trawl.operators.senses import choose_labels
from trawl.session import stored

# Token rule (Java and RE2 agree on it): numbers with inner . or , ; words
# with inner hyphen/apostrophe; else one non-space, non-word character.
_SP = r"\t\n\x0B\f\r "
TOKEN_RE = r"\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{N}]+(?:[-'’][\p{L}\p{N}]+)*|[^" + _SP + r"\p{L}\p{N}]"
TOKEN_WS_RE = "(" + TOKEN_RE + ")([" + _SP + "]*)"
SENT_END = ".!?"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def leading_tokens(text: Column, n: int) -> Column:
    """The text up to its ``n``-th token; it has the same first tokens, as only white space stands between tokens."""
    return F.regexp_extract(text, f"^[{_SP}]*+(?:(?>{TOKEN_RE})[{_SP}]*+){{0,{n}}}+", 0)


def token_classes(tokens: Column) -> Column:
    """One letter per token: S sentence-final punctuation, P other punctuation, W word."""
    return F.array_join(
        F.transform(tokens, lambda t: F.when(t.isin(*SENT_END), F.lit("S"))
                    .when(t.rlike(r"^[^\p{L}\p{N}]"), F.lit("P")).otherwise(F.lit("W"))), "")


def _is_word(t: Column) -> Column:
    """Whether a token is of class W, as in ``token_classes``."""
    return (t == "") | is_word(t)


def other_tokens(tokens: Column) -> Column:
    """0-based indices of the tokens that are no words."""
    return F.array_compact(F.transform(tokens, lambda t, i: F.when(~_is_word(t), i)))


def sentence_starts(tokens: Column, others: Column) -> Column:
    """N2 on one row: 0-based token indices where sentences begin.

    A word begins one if a final stands among the other tokens right before it.
    Both arguments are columns, as they are read for each of ``others`` (of ``other_tokens``): one
    letter each, S or P as in ``token_classes``, small before a word or the end;
    marking the small ones behind ``S[SP]*`` as ``B`` is one linear regex pass.
    """
    def letter(x, j):
        last = F.coalesce(F.get(others, j + 1) != x + 1, F.lit(True))
        return F.when(F.get(tokens, x).isin(*SENT_END), F.when(last, F.lit("s")).otherwise(F.lit("S"))).when(
            last, F.lit("p")).otherwise(F.lit("P"))

    cls = F.translate(F.regexp_replace(F.array_join(F.transform(others, letter), ""), "S([SP]*)[sp]", "S$1B"), "s", "B")
    later = F.zip_with(others, F.split(cls, "", -1), lambda x, c: F.when((c == "B") & (x + 1 < F.size(tokens)), x + 1))
    return F.concat(F.array(F.lit(0)), F.array_compact(later))


def page_tokens(df: DataFrame, key_col: str = "key", text_col: str = "text",
                abbreviations: DataFrame | None = None, ws: bool = True, text: bool = False) -> DataFrame:
    """N1 + N2 per page: (key, tokens, ws, starts), ``starts`` = the first token of each sentence; map-side only.

    With ``abbreviations`` (``abbrev.learn_abbreviations``) their dots end no sentence.  ``ws`` may be left
    out; ``text`` beside the tokens tells what stands between them as well, and is cheaper.
    """
    if text and abbreviations is not None:
        raise ValueError("a text whose dots are marked is not its tokens")
    t = df.select(F.col(key_col).alias("key"), _c(text_col).alias("_text"))
    if abbreviations is not None:
        t = guard_dots(t, abbreviations)
    blanks = {"ws": F.regexp_extract_all("_text", F.lit(TOKEN_WS_RE), 2)} if ws else {}
    if text:
        blanks["text"] = F.make_valid_utf8("_text")  # what the token rule reads
    t = compute_once(t, keep=[c for c in t.columns if c != "_text"], tokens=F.regexp_extract_all("_text", F.lit(TOKEN_RE), 0), **blanks)
    t = compute_once(t.where(F.size("tokens") > 0), _others=other_tokens(F.col("tokens")))
    t = compute_once(t, [c for c in t.columns if c != "_others"], starts=sentence_starts(F.col("tokens"), F.col("_others")))
    return t if abbreviations is None else t.withColumn("tokens", unguard(F.col("tokens"), F.col("_marked"))).drop("_marked")


def sentence_rows(pages: DataFrame) -> DataFrame:
    """(key, sent, tokens, ws), one row per sentence of ``page_tokens`` rows (without ``ws`` if they have none).

    Each sentence is a slice of the token arrays between consecutive starts;
    the lambdas read only materialised columns, so the work is linear.
    """
    n = F.size("tokens")
    cut = [c for c in ("tokens", "ws") if c in pages.columns]

    def one(st, j):
        stop = F.coalesce(F.get(F.col("starts"), j + 1), n)
        return F.struct(*(F.slice(c, st + 1, stop - st).alias(c) for c in cut))

    s = pages.select("key", F.posexplode(F.transform("starts", one)).alias("sent", "s"))
    return s.select("key", F.col("sent").cast("bigint").alias("sent"), *(f"s.{c}" for c in cut))


def sentences(df: DataFrame, key_col: str = "key", text_col: str = "text",
              abbreviations: DataFrame | None = None, ws: bool = True) -> DataFrame:
    """N1 + N2: (key, sent, tokens, ws), one row per sentence, map-side only; ``abbreviations`` and ``ws`` as in ``page_tokens``."""
    return sentence_rows(page_tokens(df, key_col, text_col, abbreviations, ws))


# N5 ------------------------------------------------------------------------
# One-letter codes of the universal POS tags used by R2/F9.
POS_CODES = {
    "VERB": "V", "PART": "T", "ADV": "R", "ADJ": "J", "NOUN": "N", "PRON": "O", "DET": "D", "ADP": "P",
    "PROPN": "X", "NUM": "M", "PUNCT": "U", "AUX": "A", "CCONJ": "C", "SCONJ": "S", "INTJ": "I", "SYM": "Y",
    "X": "Z", "SPACE": "_",
}


def pos_lexicon(tagged: DataFrame, word_col: str = "word", tag_col: str = "tag", n_col: str | None = None) -> DataFrame:
    """(word, tag, n): most frequent tag per lower-cased word, ties by larger tag.

    A row of ``tagged`` counts once, or as often as its ``n_col`` says.
    """
    word, n = F.lower(word_col).alias("word"), F.count(F.lit(1)) if n_col is None else F.sum(n_col)
    if n_col is not None:  # counted before, so the counts of a word go to one place at once
        tagged = tagged.select(word, tag_col, n_col).repartition("word")
        word = F.col("word")
    counts = tagged.groupBy(word, F.col(tag_col).alias("tag")).agg(n.alias("n"))
    best = F.max_by(F.struct("tag", "n"), F.struct("n", "tag"))
    return counts.groupBy("word").agg(best.alias("b")).select("word", "b.tag", "b.n")


RULE_TAGS = "UMXRVJN"  # the letters of default_tag


def default_tag(tok: Column) -> Column:
    """Suffix and shape rules for words missing from the lexicon (one-letter codes)."""
    return (
        F.when(tok.isin(*SENT_END) | tok.rlike(r"^[^\p{L}\p{N}]+\z"), F.lit("U"))
        .when(tok.rlike(r"^\p{N}"), F.lit("M"))
        .when(tok.rlike(r"^\p{Lu}"), F.lit("X"))
        .when(tok.rlike(r"ly\z"), F.lit("R"))
        .when(tok.rlike(r"(ing|ed|ize|ise)\z"), F.lit("V"))
        .when(tok.rlike(r"(ous|ful|ive|able|ible|al)\z"), F.lit("J"))
        .otherwise(F.lit("N"))
    )


def tag_tokens(sents: DataFrame, lexicon: DataFrame | None, hot_rows: int = 1_000_000, keep: list[str] | None = None) -> DataFrame:
    """(key, sent, tokens, ...), or the columns ``keep`` of it with key and sent, and ``pos``, one letter per token.

    The distinct tokens of each block of sentences are looked up in the lexicon, so a
    frequent word ("the" can be a large share of all tokens) is one row a block, ``hot_rows`` no
    longer matters, and no token is shuffled (``blocks``).  Rows that share key and sent
    are one sentence: each gets the letters of all of them, by position; a row without key or sent gets none.
    """
    if lexicon is None:
        return sents.select(*(keep or sents.columns), F.array_join(F.transform("tokens", default_tag), "").alias("pos"))
    names = [c for c in keep or sents.columns if c != "pos"]
    lex = lexicon.select("word", F.col("tag").alias("lex_tag"))

    def ask(tokens: DataFrame) -> DataFrame:
        asked = tokens.select("block", "i", F.lower("tok").alias("word"), default_tag(F.col("tok")).alias("rule"))
        return asked.join(lex, "word", "left").select("block", "i", F.coalesce("lex_tag", "rule").alias("tag"))

    def decode(found: pa.Table) -> Callable[[np.ndarray, np.ndarray, pa.Table], pa.Array]:
        at = found.column("i").to_numpy()
        row = np.zeros(at.max(initial=-1) + 1, np.int64)
        row[at] = np.arange(len(at))
        tags = found.column("tag").combine_chunks().take(pa.array(row))
        return lambda codes, lens, _: joined(tags.take(pa.array(codes)), lens)

    tagged, runs = with_answers(sents, names, ask, T.StructField("pos", T.StringType()), decode, run=("key", "sent"))
    placed = F.col("key").isNotNull() & F.col("sent").isNotNull()
    if runs.groupBy("key").count().where("count > 1").isEmpty():  # no key comes back, so no two rows are one sentence
        return tagged.withColumn("pos", F.when(placed, F.col("pos")).otherwise(F.lit("")))
    rest = [c for c in names if c not in ("key", "sent")]
    same = tagged.withColumn("_alone", F.when(~placed, F.monotonically_increasing_id())).groupBy("key", "sent", "_alone").agg(
        F.collect_list(F.struct(*rest, "pos")).alias("_rows"))
    letters = F.flatten(F.transform("_rows", lambda r: F.transform(F.split(r["pos"], "", -1), lambda c, i: F.struct(i, c.alias("c")))))
    pos = F.when(F.col("_alone").isNotNull(), F.lit("")).when(F.size("_rows") == 1, F.col("_rows")[0]["pos"]).otherwise(
        F.array_join(F.transform(F.array_sort(letters), lambda x: x["c"]), ""))
    return compute_once(same, ["key", "sent", "_rows"], pos=pos).select("key", "sent", "pos", F.inline("_rows").alias(
        *(f"_{c}" for c in [*rest, "pos"]))).select(*(c if c in ("key", "sent") else F.col(f"_{c}").alias(c) for c in names), "pos")


# N3 / N4 ----------------------------------------------------------------------
def gazetteer_mentions(pages: DataFrame, gazetteer: DataFrame | NameIndex, hot_rows: int = 1_000_000, by_context: int = 0,
                       **limits) -> DataFrame:
    """Token sequences equal to a known name -> (key, sent, start, end, mention, label) and, of pages, ``at``.

    Names and text are compared token by token, so spacing does not matter
    ("Google, Inc." and "Google , Inc ."), and names have any length, case and
    punctuation; the mention keeps the spelling of the text, with white space
    inside it as one blank.  ``pages`` has the columns of ``page_tokens``: a
    name may then hold a sentence end; it belongs to the sentence it begins in
    (``start`` and ``end`` count from there, ``at`` from the page's
    first token).  With rows of ``sentences`` names are found inside each sentence.
    A name with several labels gives a row for each; with ``by_context``, that many
    tokens on either side choose one label (``senses.choose_labels``).
    """
    if "starts" in pages.columns:
        rows, ids = pages.select("key", "tokens", "ws" if "ws" in pages.columns else "text", "starts"), ["key"]
        sent = F.col("sent_no").cast("bigint")
    else:
        rows, ids = pages.select("key", "sent", "tokens", "ws", F.array(F.lit(0)).alias("starts")), ["key", "sent"]
        sent = F.col("sent")
    if by_context and ids != ["key"]:
        raise ValueError("labels are chosen by context on page_tokens rows")
    hits = find_names(rows, gazetteer, ids, hot_rows, by_context, **limits)
    if by_context:
        hits = choose_labels(stored(hits, "hits"), hot_rows)  # read some ten times
    start = F.col("at") - F.col("first")
    at = ["at"] if "starts" in pages.columns else []
    return hits.select("key", sent.alias("sent"), start.alias("start"), (start + F.col("n")).alias("end"), "mention", "label", *at)


def longest_mentions(mentions: DataFrame) -> DataFrame:
    """N4 on a mention table: of overlapping mentions the longest, then the earliest, stays.

    With page positions (``at``) mentions of a whole page are compared, so
    one that crosses a sentence end keeps what it covers; else each sentence is on its own.
    """
    if "at" not in mentions.columns:
        spans = F.collect_list(F.struct("start", "end", F.col("mention").alias("text"), "label"))
        kept = mentions.groupBy("key", "sent").agg(spans.alias("spans")).select(
            "key", "sent", F.explode(longest_spans(F.col("spans"))).alias("s"))
        return kept.select("key", "sent", "s.start", "s.end", F.col("s.text").alias("mention"), "s.label")
    first = F.col("at") - F.col("start")
    placed = mentions.select("key", F.col("at").alias("start"), (first + F.col("end")).alias("end"),
                             F.col("mention").alias("text"), "label", "sent", first.alias("first"))
    # spans that no span connects never meet, so each run of overlapping spans is settled alone
    before = Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce((F.col("start") >= F.max("end").over(before)).cast("int"), F.lit(1))
    runs = placed.withColumn("begins", begins).withColumn(
        "run", F.sum("begins").over(Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)))
    spans = F.collect_list(F.struct("start", "end", "text", "label", "sent", "first"))
    kept = runs.groupBy("key", "run").agg(spans.alias("spans"))
    kept = kept.select("key", F.inline(F.when(F.size("spans") == 1, F.col("spans")).otherwise(longest_spans(F.col("spans")))))
    return kept.select("key", "sent", (F.col("start") - F.col("first")).alias("start"),
                       (F.col("end") - F.col("first")).alias("end"), F.col("text").alias("mention"), "label")


_BITS = 32  # positions in one word of the occupancy bitmap


def longest_spans(spans: Column) -> Column:
    """N4 on an array of span structs (start, end, label, ...) of one position or more: longer first, then earlier.

    Taken positions are bits of an array of longs, so a span is tested against
    the one or two words it touches instead of all spans kept so far.
    """
    ordered = F.array_sort(
        spans,
        lambda a, b: F.when((a["end"] - a["start"]) != (b["end"] - b["start"]),
                            (b["end"] - b["start"]) - (a["end"] - a["start"]))
        .when(a["start"] != b["start"], a["start"] - b["start"])
        .when(a["label"] < b["label"], F.lit(-1)).when(a["label"] > b["label"], F.lit(1)).otherwise(F.lit(0)),
    )
    base = F.array_min(F.transform(spans, lambda s: s["start"]))
    width = F.array_max(F.transform(spans, lambda s: s["end"])) - base

    def mask(s, word):
        """Bits of ``word`` that the span takes."""
        lo = F.greatest(s["lo"] - word * _BITS, F.lit(0))
        hi = F.least(s["hi"] - word * _BITS, F.lit(_BITS))
        ones = F.call_function("shiftleft", F.lit(1).cast("bigint"), hi - lo) - 1
        return F.call_function("shiftleft", ones, lo)

    def step(acc, s):
        first, stop = F.floor(s["lo"] / _BITS).cast("int"), F.floor((s["hi"] - 1) / _BITS).cast("int")
        taken = F.exists(F.sequence(first, stop), lambda w: F.get(acc["bits"], w).bitwiseAND(mask(s, w)) != 0)
        bits = F.transform(acc["bits"], lambda v, w: F.when((w >= first) & (w <= stop), v.bitwiseOR(mask(s, w))).otherwise(v))
        return F.when(taken, acc).otherwise(F.struct(bits.alias("bits"), F.concat(acc["kept"], F.array(s["s"])).alias("kept")))

    # the bounds are computed once per array and travel with each span, not per test
    placed = F.transform(F.arrays_zip(ordered.alias("s"), F.array_repeat(base, F.size(spans)).alias("base")), lambda z: F.struct(
        (z["s"]["start"] - z["base"]).cast("int").alias("lo"), (z["s"]["end"] - z["base"]).cast("int").alias("hi"), z["s"].alias("s")))
    empty = F.struct(F.array_repeat(F.lit(0).cast("bigint"), F.ceil(width / _BITS).cast("int") + 1).alias("bits"),
                     F.slice(ordered, 1, 0).alias("kept"))
    kept = F.aggregate(placed, empty, step, lambda acc: acc["kept"])
    return F.array_sort(kept, lambda a, b: a["start"] - b["start"])


def sentence_entities(sents: DataFrame, mentions: DataFrame, min_entities: int = 0) -> DataFrame:
    """Attach N4-filtered entity spans to each sentence as ``ents`` (sorted by start).

    With ``min_entities`` > 0 only sentences with at least that many spans
    are kept (F10 applied before the join), so the sentence side of the
    join can be pruned early and later steps see only candidate sentences.
    """
    per_sent = mentions.groupBy("key", "sent").agg(
        F.collect_list(F.struct("start", "end", F.col("mention").alias("text"), "label")).alias("spans"))
    per_sent = per_sent.select("key", "sent", longest_spans(F.col("spans")).alias("ents"))
    if min_entities > 0:
        return sents.join(per_sent.where(F.size("ents") >= min_entities), ["key", "sent"])
    empty = F.array().cast("array<struct<start:int,end:int,text:string,label:string>>")
    return sents.join(per_sent, ["key", "sent"], "left").withColumn("ents", F.coalesce("ents", empty))


# N6 ------------------------------------------------------------------------
ANNOTATION_SCHEMA = (
    "key {key}, sent bigint, tokens array<string>, ws array<string>, pos string, "
    "ents array<struct<start:int,end:int,text:string,label:string>>"
)


def annotate_with(df: DataFrame, fn: Callable, key_col: str = "key", text_col: str = "text",
                  key_type: str = "string") -> DataFrame:
    """Run a user annotator over (key, text) batches with ``mapInPandas``.

    ``fn(texts: list[str]) -> list[list[dict]]`` returns, per text, a list of
    sentences ``{tokens, ws, pos, ents}`` (``pos`` one letter per token as
    in ``POS_CODES``).  A model is loaded once per Python worker by ``fn``
    itself (module-level cache); the key passes through untouched.
    """
    import pandas as pd

    schema = ANNOTATION_SCHEMA.format(key=key_type)

    def run(batches):
        for pdf in batches:
            rows = []
            for key, doc in zip(pdf[key_col], fn(list(pdf[text_col]))):
                for i, s in enumerate(doc):
                    rows.append({"key": key, "sent": i, "tokens": s["tokens"], "ws": s["ws"], "pos": s["pos"],
                                 "ents": s["ents"]})
            yield pd.DataFrame(rows, columns=["key", "sent", "tokens", "ws", "pos", "ents"])

    return df.select(F.col(key_col), F.col(text_col)).mapInPandas(run, schema)
