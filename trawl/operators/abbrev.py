"""Abbreviations learnt from a corpus, so that their dot ends no sentence.

A word is written with a dot behind it more often than chance only if the dot
belongs to it.  For every word type the counts with and without a following
dot are compared by a log-likelihood ratio (the dot follows at the corpus rate,
or in 99 of 100 uses), weighted as published for unsupervised sentence
detection (Kiss and Strunk, 2006): short words and inner dots speak for an
abbreviation, uses without the dot against it.

Counting is one aggregation over word types.  In use, the dots of a page's
abbreviations are replaced by a mark before the text is cut into tokens and put
back afterwards, so positions do not move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.session import stored

SPACE = r"\t\n\x0B\f\r "
CHUNK_RE = f"([^{SPACE}]+)([{SPACE}]*)"  # what stands between white space, and the white space after it
_WORD = r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+(?:[-'’.][\p{L}\p{N}]+)*)"
DOTTED_RE = _WORD + r"\.[^\p{L}\p{N}.]*$"
PLAIN_RE = _WORD + r"[^\p{L}\p{N}.]*$"
MARK = "\ue000"  # stands for a dot that belongs to its word; a text that holds it is left as it is

THRESHOLD = 0.3  # fixed value, as published
LISTED = 10_000  # abbreviations up to which the list is compared inside each row


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHUNK_RE), F.lit(1))


def dotted(chunk: Column) -> Column:
    """The lower-cased word of a chunk that ends in one dot (before closing punctuation), else empty."""
    return F.when(F.contains(chunk, F.lit(".")), F.lower(F.regexp_extract(chunk, DOTTED_RE, 1))).otherwise(F.lit(""))


def learn_abbreviations(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(word, n_dot, n_plain, score): word types whose dot belongs to them, from every whole text.

    Words are lower-cased and hold a letter.  Null and empty texts count for nothing.
    """
    # equal chunks are counted first, so each is taken apart once
    c = docs.select(F.explode(chunks(F.col(text_col))).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    words = c.select("n", dotted(F.col("c")).alias("d"), F.lower(F.regexp_extract("c", PLAIN_RE, 1)).alias("p"))
    counts = words.select(F.when(F.col("d") != "", F.col("d")).otherwise(F.col("p")).alias("word"), "n",
                          (F.col("d") != "").cast("bigint").alias("dot")).where(F.col("word").rlike(r"\p{L}"))
    counts = counts.groupBy("word").agg(F.sum(F.col("dot") * F.col("n")).alias("n_dot"),
                                        F.sum((1 - F.col("dot")) * F.col("n")).alias("n_plain"))
    counts = stored(counts, "words")  # read twice
    # one row: all words, and those with a dot
    total = counts.agg(F.sum("n_dot").alias("d"), F.sum(F.col("n_dot") + F.col("n_plain")).alias("n"))
    share = total.select((F.col("d") + 0.5) / (F.col("n") + 1.0)).scalar()
    scored = counts.where(F.col("n_dot") > 0).withColumn("p0", share)
    size = F.length(F.regexp_replace("word", r"\.", ""))
    ratio = 2 * (F.col("n_dot") * (F.log(F.lit(0.99)) - F.log("p0")) + F.col("n_plain") * (F.log(F.lit(0.01)) - F.log(1 - F.col("p0"))))
    weight = (F.length("word") - size + 1) * F.exp(-size - F.col("n_plain") * F.log(size.cast("double")))
    return scored.withColumn("score", ratio * weight).where(F.col("score") >= threshold).select("word", "n_dot", "n_plain", "score")


def guard_dots(pages: DataFrame, abbreviations: DataFrame, listed: int = LISTED) -> DataFrame:
    """(key, _text, _marked) with the dots of abbreviations replaced by ``MARK``; ``_marked`` tells if there were any.

    Up to ``listed`` abbreviations each page's dotted words are compared with the
    list inside the row; beyond, they are joined with the table and regrouped by
    key (one row a page).
    """
    words = F.array_distinct(F.filter(F.transform(chunks(F.col("_text")), dotted), lambda w: w != ""))
    kept = pages.withColumn("_found", F.when(F.contains(F.col("_text"), F.lit(MARK)), F.array().cast("array<string>")).otherwise(words))
    if abbreviations.count() <= listed:
        every = abbreviations.agg(F.collect_set("word").alias("w")).scalar()
        kept = kept.withColumn("_found", F.array_intersect("_found", every))
    else:
        hit = kept.select("key", F.explode("_found").alias("word")).join(abbreviations.select("word"), "word", "left_semi")
        hit = hit.groupBy("key").agg(F.collect_set("word").alias("_hit"))
        kept = kept.join(hit, "key", "left").withColumn("_found", F.coalesce("_hit", F.array().cast("array<string>"))).drop("_hit")
    blanks = F.regexp_extract_all("_text", F.lit(CHUNK_RE), F.lit(2))
    text = F.array_join(F.zip_with(chunks(F.col("_text")), blanks, lambda c, b: F.concat(
        F.when(F.array_contains("_found", dotted(c)), F.translate(c, ".", MARK)).otherwise(c), b)), "")
    marked = F.coalesce(F.size("_found") > 0, F.lit(False))
    return kept.select("key", F.when(marked, text).otherwise(F.col("_text")).alias("_text"), marked.alias("_marked"))


def unguard(tokens: Column, marked: Column) -> Column:
    return F.when(marked, F.transform(tokens, lambda t: F.when(t == MARK, F.lit(".")).otherwise(t))).otherwise(tokens)
